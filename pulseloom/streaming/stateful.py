"""Forecast per reading from the last readings of its patient, in event-time order."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulseloom.ml.forecast import DirectModel

#: Readings of a bucket that wait in one value.
MAX_WAITING = 100_000
#: Groups of patients whose state is one value.
BUCKETS = 1_024
_WAITING = {"w_patient": np.int64, "w_ts": np.int64, "w_id": np.int64, "w_SBP": np.float64, "w_DBP": np.float64}
#: The waiting readings of a block.
ROWS = ", ".join(f"{c} binary" for c in _WAITING)
#: By patient: how many last readings are held (they follow each other in SBP and DBP), the extremes (two signals each), and the first
#: block that has not come out. Of the bucket: the next timer, whether readings are in the map, and the waiting readings.
_ARRAYS = {"patient": np.int64, "held": np.int64, "SBP": np.float64, "DBP": np.float64, "low": np.float64, "high": np.float64, "done": np.int64, **_WAITING}
PLACE = "timer long, spilled boolean, " + ", ".join(f"{c} binary" for c in _ARRAYS)
_NEVER = -(1 << 62)


class OrderedForecast(StatefulProcessor):
    """Readings wait until the watermark has passed them, come out in the order of their times, and are forecast.

    When the watermark passes the end of a block of time, no reading of it can come any more: a timer takes out the readings of that
    block, sorts them by patient and forecasts them after the last `n_in - 1` readings of the patient before. So a late reading has its
    place in its own window and in those after it. The patients of a bucket share one value of the state store, as arrays, and are forecast
    together: the calls of the store do not grow with the patients. Up to MAX_WAITING readings of a bucket wait in that value; beyond that they
    go to a map by block and come out block by block, so that one block is in memory at a time, whatever the patients send.

    With `scaled` the model works on signals scaled by the patient's extremes up to each reading, which are kept beside the window,
    and its answer is scaled back by the same extremes.
    """

    def __init__(self, model: DirectModel, horizons, block_us: int, scaled: bool):
        self.model, self.horizons, self.block_us, self.scaled = model, tuple(horizons), block_us, scaled

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block long", ROWS)
        self.place = handle.getValueState("place", PLACE)

    def _place(self) -> dict:
        got = self.place.get()
        timer, spilled, *arrays = got if got is not None else (0, False, *[b""] * len(_ARRAYS))
        return {"timer": timer, "spilled": spilled} | {c: np.frombuffer(bytes(x), t) for (c, t), x in zip(_ARRAYS.items(), arrays)}

    def _end(self, block: int) -> int:
        """Milliseconds at which a block is complete."""
        return -(-(block + 1) * self.block_us // 1000)

    def _held(self, block: int) -> list[np.ndarray]:
        return [np.frombuffer(bytes(x), t) for x, t in zip(self.blocks.getValue((block,)), _WAITING.values())]

    def _spill(self, rows: list[np.ndarray]) -> None:
        """Add waiting readings to their blocks in the map."""
        block = rows[1] // self.block_us
        for b in np.unique(block).tolist():
            new = [c[block == b] for c in rows]
            if self.blocks.containsKey((b,)):
                new = [np.concatenate(c) for c in zip(self._held(b), new)]
            self.blocks.updateValue((b,), tuple(c.tobytes() for c in new))

    def handleInputRows(self, key, rows, timerValues):
        place = self._place()
        waiting = [place[c] for c in _WAITING]
        first = place["timer"] or 1 << 62
        for pdf in rows:
            new = [pdf[c].to_numpy(t) for c, t in zip(("patient_id", "ts_us", "reading_id", "SBP", "DBP"), _WAITING.values())]
            if len(place["patient"]):
                at = np.searchsorted(place["patient"], new[0]).clip(max=len(place["patient"]) - 1)
                done = np.where(place["patient"][at] == new[0], place["done"][at], _NEVER)
                timely = new[1] // self.block_us >= done
                new = [c[timely] for c in new]
            if len(new[0]):
                first = min(first, self._end(int(new[1].min()) // self.block_us))
                waiting = [np.concatenate(c) for c in zip(waiting, new)]
            if len(waiting[0]) > MAX_WAITING:
                self._spill(waiting)
                waiting, place["spilled"] = [c[:0] for c in waiting], True
        if first < (place["timer"] or 1 << 62):
            if place["timer"]:
                self.handle.deleteTimer(place["timer"])
            self.handle.registerTimer(first)
            place["timer"] = first
        self._keep(place, waiting)
        yield from ()

    def _keep(self, place: dict, waiting: list[np.ndarray]) -> None:
        place |= dict(zip(_WAITING, waiting))
        self.place.update((place["timer"], place["spilled"], *[np.ascontiguousarray(place[c], t).tobytes() for c, t in _ARRAYS.items()]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, place = timerValues.getCurrentWatermarkInMs(), self._place()
        waiting = [place[c] for c in _WAITING]
        if place["spilled"]:
            self._spill(waiting)
            waiting = [c[:0] for c in waiting]
            blocks = sorted(k[0] for k in self.blocks.keys())
            for b in blocks:
                if self._end(b) <= mark:
                    ready = self._held(b)
                    self.blocks.removeKey((b,))
                    yield from self._answered(place, ready)
            left = [b for b in blocks if self._end(b) > mark]
            place["spilled"] = bool(left)
        else:
            last = (mark * 1000) // self.block_us  # the first block that is not complete
            done = waiting[1] < last * self.block_us
            if done.any():
                yield from self._answered(place, [c[done] for c in waiting])
            waiting = [c[~done] for c in waiting]
            left = (waiting[1] // self.block_us).tolist()
        place["timer"] = self._end(min(left)) if left else 0
        if place["timer"]:
            self.handle.registerTimer(place["timer"])
        self._keep(place, waiting)

    def _answered(self, place: dict, ready: list[np.ndarray]):
        """Forecasts of complete readings, which come after all that `place` has seen of their patients."""
        order = np.lexsort((ready[2], ready[1], ready[0]))
        patient, ts, ids, *signals = (c[order] for c in ready)
        now, n_in = np.column_stack(signals), self.model.n_in
        names = np.union1d(place["patient"], patient)
        old, who = np.searchsorted(names, place["patient"]), np.searchsorted(names, patient)
        low, high, done = np.full((len(names), 2), np.inf), np.full((len(names), 2), -np.inf), np.full(len(names), _NEVER)
        low[old], high[old], done[old] = place["low"].reshape(-1, 2), place["high"].reshape(-1, 2), place["done"]
        lows = np.minimum(pd.DataFrame(now).groupby(who).cummin().to_numpy(), low[who])
        highs = np.maximum(pd.DataFrame(now).groupby(who).cummax().to_numpy(), high[who])
        final = np.flatnonzero(np.diff(who, append=len(names)))  # the last new reading of each patient
        low[who[final]], high[who[final]], done[who[final]] = lows[final], highs[final], ts[final] // self.block_us + 1
        # the held readings of every patient, then the new ones
        before = np.repeat(old, place["held"])
        every = np.concatenate([before, who])
        order = np.argsort(every, kind="stable")
        every = every[order]
        both = np.vstack([np.column_stack([place["SBP"], place["DBP"]]), now])[order]
        row = order - len(before)  # which new reading it is
        after = np.cumsum(np.bincount(every, minlength=len(names)))[every] - 1 - np.arange(len(every))  # readings of the patient after it
        kept = after < n_in - 1
        place |= {"patient": names, "held": np.bincount(every[kept], minlength=len(names)), "SBP": both[kept, 0], "DBP": both[kept, 1]}
        place |= {"low": low.ravel(), "high": high.ravel(), "done": done}
        ends = np.flatnonzero(row >= 0)
        ends = ends[ends >= n_in - 1]
        ends = ends[every[ends - n_in + 1] == every[ends]]
        for i in range(0, len(ends), 10_000):
            end = ends[i : i + 10_000]
            at = row[end]
            full = self._forecast(both, end, lows[at], highs[at])
            answer = {"patient_id": patient[at], "reading_id": ids[at], "ts_us": ts[at]}
            answer |= {f"{c}_{h}": full[:, s, h - 1] for s, c in enumerate(("SBP", "DBP")) for h in self.horizons}
            yield pd.DataFrame(answer)

    def _forecast(self, readings: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Forecasts (readings, signals, steps) of the windows that end at some of the readings."""
        n = self.model.n_in
        windows = np.lib.stride_tricks.sliding_window_view(readings, n, axis=0)[end - n + 1]  # (ends, signals, lags)
        spread = np.where(high > low, high - low, 1.0)
        if self.scaled:
            windows = (windows - low[:, :, None]) / spread[:, :, None]
        flat = windows.reshape(len(windows), -1)
        ahead = (np.column_stack([np.ones(len(flat)), flat]) @ self.model.weights).reshape(len(flat), 2, self.model.n_out)
        return ahead * spread[:, :, None] + low[:, :, None] if self.scaled else ahead

    def close(self) -> None:
        pass


def forecast_stream(df: DataFrame, model: DirectModel, horizons=(15, 30), delay="2 hours", block_seconds=3600, scaled=False, buckets=None) -> DataFrame:
    """Readings with both signals to forecasts, each from the `n_in` readings up to it in time order; the first comes with the
    `n_in`-th reading of a patient.

    A reading is answered once the watermark (`delay` behind the newest reading) has passed its block of `block_seconds`; one that
    comes later than that is dropped and counted (`flows.Losses`). Patients are dealt into `buckets` (BUCKETS) by a hash; a block of one has to fit
    in memory. The number belongs to the checkpoint, as that of the shuffle partitions does.
    Needs the RocksDB state store (`use_rocksdb`).
    """
    names = [f"{c}_{h} double" for c in ("SBP", "DBP") for h in horizons]
    schema = "patient_id long, reading_id long, ts_us long, " + ", ".join(names)
    # in one condition with the time, which keeps it behind the watermark: rows without signals move time on as well
    valid = F.when(F.col("DateTime").isNotNull(), (F.col("SBP") != 0) & (F.col("DBP") != 0) & F.col("patient_id").isNotNull())
    rows = df.withWatermark("DateTime", delay).filter(valid)
    bucket = F.pmod(F.xxhash64("patient_id"), F.lit(buckets or BUCKETS)).alias("bucket")
    rows = rows.select(bucket, "patient_id", "reading_id", "DateTime", F.unix_micros("DateTime").alias("ts_us"), "SBP", "DBP")
    return rows.groupBy("bucket").transformWithStateInPandas(
        OrderedForecast(model, horizons, block_seconds * 1_000_000, scaled), outputStructType=schema, outputMode="append", timeMode="eventtime"
    )


def use_rocksdb(spark) -> None:
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)

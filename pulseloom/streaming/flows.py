"""Streaming jobs. Each step is a function of a DataFrame that runs on a batch as well."""

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pulseloom.functions import rules
from pulseloom.operators.clean import dedup
from pulseloom.operators.timeseries import confusion_cells
from pulseloom.schema import KEY, MEASURES
from pulseloom.sources.codecs import cast_vitals, checked, decode, encode_kv, fault_counts, faults, good_readings, normalize_aliases
from pulseloom.sources.sinks import batch_writer, read_state, write_stream


def readings(messages: DataFrame, required=()) -> DataFrame:
    """Messages to typed readings, unreadable values missing; what was lost is in `codecs.dead_letters`."""
    return cast_vitals(normalize_aliases(decode(messages)[0]), required)


def classify(messages: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Decode, drop repeated readings, add the pressure level, encode. Every decoded message is classified.

    Copies are recognised while they arrive within `delay` of each other.
    """
    unique = dedup(readings(messages), event_time="DateTime", delay=delay)
    levels = unique.withColumn("BP_level", rules.bp_level("SBP", "DBP"))
    text = levels.withColumn("DateTime", F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss"))
    return encode_kv(text, ["DateTime"], ["patient_id", "reading_id", "DateTime", *MEASURES, "BP_level"])


def score(messages: DataFrame, transform, value_cols=("patient_id", "reading_id", "DateTime", "SBP", "DBP", "prediction")) -> DataFrame:
    """Apply a fitted model (a function of a DataFrame) to the messages with both pressures and encode the result."""
    scored = transform(readings(messages, ("SBP", "DBP")))
    text = scored.withColumn("DateTime", F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss"))
    return encode_kv(text, ["DateTime"], list(value_cols))


def lowest(df: DataFrame, col="SPO2", by=KEY, time="DateTime") -> DataFrame:
    """Lowest value of each patient and when it was first reached; one state row per patient."""
    entry = F.min(F.struct(F.col(col).alias("v"), F.col(time).alias("t")))
    agg = df.filter(F.col(col).isNotNull()).groupBy(*by).agg(entry.alias("m"))
    return agg.select(*by, F.col("m.v").alias("lowest"), F.col("m.t").alias("lowest_time"))


def confusion_counts(df: DataFrame, label="label", pred="pred", by=KEY) -> DataFrame:
    cells = confusion_cells(label, pred)
    sums = [F.sum(c).alias(n) for n, c in cells.items()]
    return df.groupBy(*by).agg(*sums, F.count(F.lit(1)).alias("TotalDataProcessed"))


def accuracy_counts(df: DataFrame, label="label", pred="pred", by=KEY) -> DataFrame:
    right = F.coalesce(F.col(label) == F.col(pred), F.lit(False))
    sums = [F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in (("correct", right), ("wrong", ~right))]
    return df.groupBy(*by).agg(*sums)


def window_values(df: DataFrame, delay: str, every="15 minutes", fn="mean", by=("field",), value="value", time="time", tie="reading_id") -> DataFrame:
    """Mean or last per tumbling window; state of a window ends `delay` after it."""
    agg = F.avg(value) if fn == "mean" else F.max_by(value, F.struct(time, tie))
    grouped = df.withWatermark(time, delay).groupBy(*by, F.window(time, every).alias("w"))
    return grouped.agg(agg.alias(value)).select(*by, F.col("w.end").alias(time), value)


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """Running count per class; one state row per class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def fan_out(stream: DataFrame, sinks: dict, checkpoint: str, mode="append", trigger=None, name=None):
    """One query for several sinks: name -> (function of the batch, folder). `name` names the query in progress reports."""
    if not checkpoint:
        raise ValueError("a streaming query needs its own checkpoint folder")
    writer = stream.writeStream.foreachBatch(batch_writer(sinks)).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**(trigger or {"availableNow": True})).start()


@dataclass(frozen=True)
class Running:
    """An aggregation over a stream whose current rows can be asked for.

    `frame` is the aggregation; its state has the `keys` and the `values`, from which `finish` makes the result's rows. With `closed`
    the rows of windows that the watermark has passed leave the state for a table.
    """

    frame: DataFrame
    keys: tuple
    values: tuple
    finish: Callable[[DataFrame], DataFrame]
    closed: bool = False


def running(frame: DataFrame, by=KEY) -> Running:
    """For an aggregation by `by` with counts, sums, minima and maxima only: their state is their value."""
    values = tuple(c for c in frame.columns if c not in by)
    return Running(frame, tuple(by), values, lambda state: state)


def running_lowest(df: DataFrame, col="SPO2", by=KEY, time="DateTime") -> Running:
    """`lowest` as a running aggregation."""
    return Running(lowest(df, col, by, time), tuple(by), ("m",), lambda state: state.select(*by, F.col("m.v").alias("lowest"), F.col("m.t").alias("lowest_time")))


def running_windows(df: DataFrame, delay: str, every="15 minutes", fn="mean", by=("field",), value="value", time="time", tie="reading_id") -> Running:
    """`window_values` as a running aggregation: closed windows, and the open ones as far as they have come."""
    now = F.col("_a") / F.col("_b") if fn == "mean" else F.col("_a")  # sum and count, or the last value and its place

    def finish(state):
        return state.select(*by, F.col("w.end").alias(time), now.alias(value))

    return Running(window_values(df, delay, every, fn, by, value, time, tie), (*by, "w"), ("_a", "_b"), finish, closed=True)


def ingest(messages: DataFrame, folder: str, checkpoint: str, trigger=None):
    """Start the intake of messages: one parse per message feeds three tables below `folder`.

    `readings` has every reading, `dead_letters` the payload and the reason of whatever was lost, `fault_counts` a row per batch and
    fault. A batch that is repeated overwrites its own rows in all three.
    """
    sinks = {"readings": (good_readings, f"{folder}/readings"), "dead_letters": (faults, f"{folder}/dead_letters"), "fault_counts": (fault_counts, f"{folder}/fault_counts")}
    return fan_out(checked(messages), sinks, checkpoint, trigger=trigger)


class Losses(StreamingQueryListener):
    """Counts of every micro-batch, from the progress reports of the session's queries.

    A row is (query name, batch, sent, dropped): `sent` is what `arriving` counted at the source, `dropped` the rows that stateful operators
    refused because the watermark had passed them. Register it with `spark.streams.addListener`.
    """

    def __init__(self):
        self.rows: dict[tuple[str, int], tuple[int, int]] = {}
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("arriving")
        dropped = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        before = self.rows.get((p.name, p.batchId), (0, 0))
        self.rows[p.name, p.batchId] = max(before[0], seen.sent if seen else 0), max(before[1], dropped)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def table(self, spark: SparkSession, query, timeout: float = 60) -> DataFrame:
        """batch, sent, dropped of a named query that has ended; one row per batch that had data."""
        if not self.ended[str(query.runId)].wait(timeout):
            raise TimeoutError(f"no report that {query.name} ended")
        rows = [(b, *n) for (name, b), n in sorted(self.rows.items()) if name == query.name and any(n)]
        return spark.createDataFrame(rows, "batch long, sent long, dropped long")


def arriving(df: DataFrame) -> DataFrame:
    """`df`, counted for `Losses` before anything can be dropped."""
    return df.observe("arriving", F.count(F.lit(1)).alias("sent"))


def keep_state(what: Running, folder: str, trigger=None):
    """Start a running aggregation; checkpoint, state and closed windows are in `folder`."""
    if not folder:
        raise ValueError("a streaming query needs its own checkpoint folder")
    if what.closed:
        return write_stream(what.frame, "parquet", {"path": f"{folder}/closed"}, f"{folder}/checkpoint", trigger)
    return write_stream(what.frame, "noop", {}, f"{folder}/checkpoint", trigger, "update")


def latest(spark: SparkSession, what: Running, folder: str) -> DataFrame:
    """The current rows of a running aggregation, one per key, a null key included; of windows, closed and open ones."""
    now = what.finish(read_state(spark, f"{folder}/checkpoint", what.keys, what.values)).select(*what.frame.columns)
    return spark.read.schema(what.frame.schema).parquet(f"{folder}/closed").unionByName(now) if what.closed else now


def newest_per_minute(df: DataFrame, by=KEY, time="DateTime", cols=("SBP", "DBP")) -> DataFrame:
    """The newest reading of each series and minute. Forecasts issued within one minute have the same targets, so for
    `forecast_latest` the others need not be spread over their targets."""
    newest = F.max(F.struct(time, *cols)).alias("_r")
    return df.groupBy(*by, F.floor(F.unix_seconds(time) / 60).alias("_minute")).agg(newest).select(*by, "_r.*")


def forecast_messages(df: DataFrame, steps=30, by=KEY, time="DateTime") -> DataFrame:
    """Forecast messages that repeat the last reading: three parallel arrays of `steps` entries."""
    minutes = F.sequence(F.lit(1), F.lit(steps))
    at = lambda i: F.date_format(F.timestamp_seconds(F.unix_seconds(time) + i * 60), "yyyy-MM-dd HH:mm")
    return df.select(
        *by, F.col(time).alias("issued_at"), F.array_repeat("SBP", steps).alias("sbp_predictions"),
        F.array_repeat("DBP", steps).alias("dbp_predictions"), F.transform(minutes, at).alias("timestamps"),
    )


def forecast_points(messages: DataFrame, by=KEY) -> DataFrame:
    """Parallel arrays to one row per target time."""
    zipped = F.arrays_zip(F.col("timestamps").alias("t"), F.col("sbp_predictions").alias("s"), F.col("dbp_predictions").alias("d"))
    rows = messages.select(*by, "issued_at", F.explode(zipped).alias("p"))
    return rows.select(
        *by, "issued_at", F.try_to_timestamp("p.t", F.lit("yyyy-MM-dd HH:mm")).alias("target_time"),
        F.col("p.s").alias("SBP"), F.col("p.d").alias("DBP"),
    )


def forecast_latest(points: DataFrame, by=KEY) -> DataFrame:
    """The most recently issued forecast of each target time."""
    newest = points.groupBy(*by, "target_time").agg(F.max(F.struct("issued_at", "SBP", "DBP")).alias("n"))
    return newest.select(*by, "target_time", "n.issued_at", "n.SBP", "n.DBP")

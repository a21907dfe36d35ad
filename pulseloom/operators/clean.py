"""Filters, duplicate removal, repair of lost values, splits."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.operators.slices import known_neighbours, row_frame, slicing, with_position
from pulseloom.schema import KEY, ORDER


def lost_signal(cols=("SBP", "DBP", "HR", "SPO2")) -> Column:
    """True where every listed value is zero."""
    return reduce(lambda a, b: a & b, [F.col(c) == 0 for c in cols])


def valid_bp(s="SBP", d="DBP") -> Column:
    """True where neither pressure is zero."""
    return (F.col(s) != 0) & (F.col(d) != 0)


def time_slice(df: DataFrame, start, end, time="DateTime") -> DataFrame:
    """Rows between two instants, both inclusive."""
    return df.filter(F.col(time).between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))))


def row_mean(*cols) -> Column:
    """Mean of the values present in a row."""
    present = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), 0).otherwise(1) for c in cols])
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    return F.when(present > 0, total / present)


def dedup(df: DataFrame, cols=None, event_time=None, delay=None) -> DataFrame:
    """One row per combination of `cols` (all columns by default).

    On a stream the state must end somewhere: `event_time` and `delay` are required, and a
    copy that arrives later than `delay` after its original may pass.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(cols)) if cols else df.distinct()
    if not (event_time and delay):
        raise ValueError("dedup on a stream needs event_time and delay")
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(cols or df.columns))


def impute_zero_neighbors(df, cols=("SBP", "DBP"), guard=("HR", "SPO2"), by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Replace a zero by the mean of the rows before and after, while the guard signals are alive.

    Neighbours are taken as they are, zero included. A missing predecessor counts as zero, a
    missing successor leaves the value empty.
    """
    frame = row_frame(df, by, order, 1, 1, max_rows)
    w = frame.window()
    alive = reduce(lambda a, b: a & b, [F.col(g) != 0 for g in guard])

    def repaired(c):
        mean = (F.coalesce(F.lag(c).over(w), F.lit(0.0)) + F.lead(c).over(w)) / 2
        return F.when((F.col(c) == 0) & alive, mean).otherwise(F.col(c)).alias(c)

    return frame.finish(frame.df.select(*[repaired(c) if c in cols else F.col(c) for c in frame.df.columns]))


def interpolate_zeros(df, cols=("SBP", "DBP"), by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Fill zeros and nulls on a straight line between the nearest values, by row position.

    Before the first and after the last value the nearest one is repeated; a series without
    any value takes the mean of the table.
    """
    value = {c: F.nullif(F.col(c), F.lit(0.0)) for c in cols}
    means = df.agg(*[F.avg(value[c]).alias(c) for c in cols]).first()
    plan = slicing(df, by, order, max_rows)
    placed = with_position(df, by, order, "_pos", plan=plan, keep=True)
    known = {c: F.when(value[c].isNotNull(), F.struct(F.col("_pos").alias("at"), value[c].alias("v"))) for c in cols}
    near = known_neighbours(placed, by, order, known, plan=plan)

    def filled(c):
        a, b = F.col(f"{c}_prev"), F.col(f"{c}_next")
        line = a["v"] + (b["v"] - a["v"]) * (F.col("_pos") - a["at"]) / F.nullif(b["at"] - a["at"], F.lit(0))
        return F.coalesce(value[c], line, a["v"], b["v"], F.lit(means[c])).alias(c)

    return near.select(*[filled(c) if c in cols else F.col(c) for c in df.columns])


def split_chronological(df, frac: float, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Mark the first part of every series as training rows (`is_train`)."""
    placed = with_position(df, by, order, "_pos", total="_size", max_rows=max_rows)
    return placed.withColumn("is_train", F.col("_pos") <= F.floor(F.col("_size") * frac)).drop("_pos", "_size")


def hash_bucket(key, seed: int, buckets: int = 100) -> Column:
    """A bucket number that depends on the key and the seed only, not on partitioning."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def split_hash(df, key="reading_id", seed: int = 42, frac: float = 0.8) -> DataFrame:
    """Mark a random part of the rows as training rows (`is_train`), the same on every run."""
    return df.withColumn("is_train", hash_bucket(key, seed) < int(round(frac * 100)))

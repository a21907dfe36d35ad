"""Queries over the long table of points: selectors, windows, shares."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIE = "reading_id"


def _order(df: DataFrame, time: str):
    return [c for c in (time, TIE) if c in df.columns]


def order_key(df: DataFrame, time="time"):
    """Time and tie-breaking id in one number of fixed width, so that the latest row needs no sorting."""
    us = F.unix_micros(time).cast("decimal(18,0)")
    tie = F.col(TIE).cast("decimal(20,0)") if TIE in df.columns else F.lit(0).cast("decimal(20,0)")
    return (us * F.lit("20000000000000000000").cast("decimal(20,0)") + tie).cast("decimal(38,0)")


def select_all(df: DataFrame, by=("measurement", "field"), value="value", time="time") -> DataFrame:
    """Mean, last, highest and lowest point of each series (column `selector`) from one aggregation."""
    rows = df.filter(F.col(value).isNotNull())
    order = _order(df, time)
    picks = {
        "last": F.max(F.struct(*order, value)),
        "max": F.min(F.struct((-F.col(value)).alias("_down"), *order, value)),
        "min": F.min(F.struct(value, *order)),
    }
    agg = rows.groupBy(*by).agg(F.avg(value).alias("_mean"), *[p.alias(f"_{n}") for n, p in picks.items()])
    entries = [F.struct(F.lit("mean").alias("selector"), F.lit(None).cast("timestamp").alias(time), F.col("_mean").alias(value))]
    entries += [F.struct(F.lit(n).alias("selector"), F.col(f"_{n}.{time}").alias(time), F.col(f"_{n}.{value}").alias(value)) for n in picks]
    return agg.select(*by, F.inline(F.array(*entries)))


def select_point(df: DataFrame, kind: str, by=("measurement", "field"), value="value", time="time") -> DataFrame:
    """The `last`, `max` or `min` point of each series with its time; among equals the earliest,
    and of simultaneous last points the one with the highest id."""
    rows = df.filter(F.col(value).isNotNull())
    order = _order(df, time)
    if kind == "last":
        pick = F.max(F.struct(*order, value))
    elif kind == "min":
        pick = F.min(F.struct(value, *order))
    elif kind == "max":
        pick = F.min(F.struct((-F.col(value)).alias("_down"), *order, value))
    else:
        raise ValueError(kind)
    picked = rows.groupBy(*by).agg(pick.alias("p"))
    return picked.select(*by, F.col(f"p.{time}").alias(time), F.col(f"p.{value}").alias(value))


def select_mean(df: DataFrame, by=("measurement", "field"), value="value") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def panel_reduce(df: DataFrame, by=("measurement", "field"), value="value", time="time") -> DataFrame:
    """Last value that is present, maximum and sum of each series."""
    last = F.max_by(value, F.when(F.col(value).isNotNull(), order_key(df, time)))
    return df.groupBy(*by).agg(last.alias("last_not_null"), F.max(value).alias("max"), F.sum(value).alias("sum"))


def window_agg(df: DataFrame, every: str, fn="mean", start=None, stop=None, by=("measurement", "field"),
               value="value", time="time") -> DataFrame:
    """`mean` or `last` per tumbling window; empty windows are left out.

    The time of a result is the end of its window, cut at `stop`.
    """
    rows = df
    if start is not None:
        rows = rows.filter(F.col(time) >= F.to_timestamp(F.lit(start)))
    if stop is not None:
        rows = rows.filter(F.col(time) < F.to_timestamp(F.lit(stop)))
    if fn == "mean":
        agg = F.avg(value)
    elif fn == "last":
        agg = F.max_by(value, order_key(df, time))
    else:
        raise ValueError(fn)
    out = rows.groupBy(*by, F.window(time, every).alias("w")).agg(agg.alias(value))
    end = F.col("w.end")
    if stop is not None:
        end = F.least(end, F.to_timestamp(F.lit(stop)))
    return out.select(*by, end.alias(time), value)


def downsample(df: DataFrame, max_points: int, by=("measurement", "field"), value="value", time="time") -> DataFrame:
    """Means over equal parts of the range, so that a series has at most `max_points` points."""
    lo, hi = df.agg(F.unix_seconds(F.min(time)), F.unix_seconds(F.max(time))).first()
    if lo is None:
        width, lo = 1, 0
    else:
        width = -(-(hi - lo + 1) // max_points)
    part = F.floor((F.unix_seconds(time) - lo) / width)
    out = df.groupBy(*by, part.alias("_part")).agg(F.avg(value).alias(value))
    return out.select(*by, F.timestamp_seconds(F.lit(lo) + F.col("_part") * width).alias(time), value)


def percent_share(df: DataFrame, name: str, value: str) -> DataFrame:
    """Sum per name and its share of the total."""
    total = df.agg(F.sum(value)).first()[0]
    sums = df.groupBy(name).agg(F.sum(value).alias(value))
    return sums.withColumn("share", F.try_divide(F.col(value), F.lit(total)))


def last_share(df: DataFrame, by=("field",), value="value", time="time", within=()) -> DataFrame:
    """Last value of each series and its share of the sum of the last values: of all, or of those that are equal in `within`.

    A null in `within` is a value like any other. The series of one value of `within` meet in one row on the way.
    """
    last = df.filter(F.col(value).isNotNull()).groupBy(*within, *by).agg(F.max_by(value, order_key(df, time)).alias(value))
    total = last.groupBy(*within).agg(F.sum(value).alias("_total"), F.collect_list(F.struct(*by, value)).alias("_s"))
    return total.select(*within, "_total", F.inline("_s")).withColumn("share", F.try_divide(F.col(value), F.col("_total"))).drop("_total")

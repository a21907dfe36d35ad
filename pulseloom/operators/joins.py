"""Joins of readings with labels, forecasts and other column sets.

Catalyst chooses the equi-join; rows of a key too frequent for one task are joined apart from
the rest. The nearest-time join works on one ordered union, so it never forms pairs.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.operators.slices import MIN_ROWS, fair_share, known_neighbours
from pulseloom.schema import KEY
from pulseloom.session import shared_dir

#: Documented parameter: rows of the small side that may be broadcast; beyond it the rows are shuffled, with the same result.
MAX_BROADCAST = 100_000


def frequent_keys(df: DataFrame, on, limit: int):
    """Keys with about `limit` rows or more, found in a row sample; None if there are none.

    Missing one costs time, not correctness.
    """
    seen = 64  # sampled rows expected of a key at the limit
    rate = min(1.0, 2 * seen / limit)
    counts = df.select(*on).sample(rate, seed=7).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    keys = counts.filter(F.col("_n") >= seen).drop("_n").collect()  # at most 2 * total / limit keys
    return df.sparkSession.createDataFrame(keys, df.select(*on).schema) if keys else None


def join_skewed(left: DataFrame, right: DataFrame, on, how="left", limit: int | None = None) -> DataFrame:
    """Equi-join with a `right` that has one row per key, where some keys may fill much of `left`.

    Rows of the frequent keys stay where they are and meet a broadcast of the few rows of
    `right` they need; the others are shuffled. A null key matches nothing and is not shuffled.
    """
    on = list(on)
    if left.isStreaming:
        return left.join(right, on, how)
    if limit is None:
        total = left.count()
        if total <= MIN_ROWS:
            return left.join(right, on, how)
        limit = fair_share(left, total)
    hot = frequent_keys(left, on, limit)
    if hot is None:
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    few = right.join(hot, on, "left_semi")
    if few.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:  # holds unless `right` repeats its keys
        few = F.broadcast(few)
    apart = left.join(hot, on, "left_semi").join(few, on, how)
    rest = left.join(hot, on, "left_anti").join(right, on, how)
    return apart.unionByName(rest)


def assemble(frames, key="reading_id") -> DataFrame:
    """Put separately computed columns of the same rows side by side."""
    return reduce(lambda a, b: a.join(b, key), frames)


def join_labels(df: DataFrame, labels: DataFrame, on=("patient_id", "DateTime")) -> DataFrame:
    """Truth labels by key and time; readings without a label are kept.

    Of several labels for one key the smallest (column by column) counts, so a reading is never doubled.
    """
    on = list(on)
    rest = [c for c in labels.columns if c not in on]
    one = labels.groupBy(*on).agg(F.min(F.struct(*rest)).alias("_label")).select(*on, "_label.*")
    if df.isStreaming:  # every micro-batch reads the labels again: they are reduced, dealt and sorted once
        one = bucketed(one, on, "labels")
    return join_skewed(df, one, on, "left")


def bucketed(df: DataFrame, on, purpose: str) -> DataFrame:
    """`df` as a written table in buckets by `on`, as many as a shuffle has partitions: joins by `on` need not deal it out again."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, *on).write.bucketBy(buckets, *on).sortBy(*on).option("path", path).saveAsTable(name)
    return spark.table(name)


def join_label_stream(df: DataFrame, labels: DataFrame, delay: str, on=("patient_id",), time="DateTime") -> DataFrame:
    """Readings of a stream with the truth labels of another stream that have their key and time; columns of `labels` besides these
    are added.

    A reading waits for its label until the watermark of both streams (`delay` behind the newest row of each, the slower one counts) has passed
    it; one without a label comes out once, with nulls. Of several labels for one reading the first to arrive counts. Rows of
    either stream that come later than that are dropped and counted. State holds what came within the delay.
    """
    keys = [*on, time]
    added = [c for c in labels.columns if c not in keys]
    right = labels.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys).select(*[F.col(c).alias(f"_{c}") for c in keys], *added)
    left = df.withWatermark(time, delay)
    same = [F.col(c) == F.col(f"_{c}") for c in keys]
    return left.join(right, reduce(lambda a, b: a & b, same), "left_outer").select(*df.columns, *added)


def join_forecast(forecast, actual, value, tolerance=None, by=KEY, target="target_time", time="DateTime",
                  tie="reading_id", max_rows=None) -> DataFrame:
    """Attach the actual `value` (and `actual_time`) to each forecast.

    Without `tolerance` the actual of the same minute is meant (the earliest one); with it, the
    actual nearest to the target within so many seconds, of equally near ones the earliest.
    """
    by = list(by)
    if tolerance is None:
        # the first actual of a minute, picked while pre-aggregating
        minute = F.date_trunc("minute", time)
        first = F.min(F.struct(F.col(time).alias("actual_time"), tie, value))
        per_minute = actual.groupBy(*by, minute.alias("_minute")).agg(first.alias("_a"))
        out = forecast.withColumn("_minute", F.date_trunc("minute", target)).join(per_minute, [*by, "_minute"])
        return out.select(*forecast.columns, "_a.actual_time", F.col(f"_a.{value}").alias("actual"))

    us = F.unix_micros(F.col("_t"))
    left = forecast.select(F.struct(*forecast.columns).alias("_f"), *by, F.col(target).alias("_t"), F.lit(1).alias("_kind"),
                           F.xxhash64(*forecast.columns).alias("_id"))
    right = actual.select(*by, F.col(time).alias("_t"), F.lit(0).alias("_kind"), F.col(tie).alias("_id"), F.col(value).alias("_v"))
    both = left.unionByName(right, allowMissingColumns=True)
    is_actual = F.col("_kind") == 0
    # of simultaneous actuals the lowest id counts, in both directions
    known = {
        "b": F.when(is_actual, F.struct(us.alias("t"), (-F.col("_id")).alias("i"), F.col("_v").alias("v"))),
        "a": F.when(is_actual, F.struct(us.alias("t"), F.col("_id").alias("i"), F.col("_v").alias("v"))),
    }
    near = known_neighbours(both, by, ["_t", "_kind", "_id"], known, max_rows).filter("_kind = 1")
    before, after = us - F.col("b_prev.t"), F.col("a_next.t") - us
    take_before = before.isNotNull() & (after.isNull() | (before <= after))
    hit = F.when(take_before, F.struct(F.col("b_prev.t").alias("t"), F.col("b_prev.v").alias("v"))).otherwise(
        F.struct(F.col("a_next.t").alias("t"), F.col("a_next.v").alias("v"))
    )
    near = near.withColumn("_hit", hit).filter(F.abs(F.col("_hit.t") - us) <= tolerance * 1_000_000)
    return near.select("_f.*", F.timestamp_micros("_hit.t").alias("actual_time"), F.col("_hit.v").alias("actual"))


def union_all(frames) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def head_ordered(df: DataFrame, n: int, order) -> DataFrame:
    """The first `n` rows in a stated order: every task keeps its own first n."""
    return df.orderBy(*order).limit(n)

"""Windows over time: neighbours, rolling and calendar means, running values, forecasts' grids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.operators.joins import join_skewed
from pulseloom.operators.slices import row_frame, running
from pulseloom.schema import KEY, MEASURES, ORDER

# Documented parameter: readings in one bucket above which rolling means work on sums per second. Rows are the same.
DENSE = 20_000

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def lag_lead(df, cols, n=1, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Value `n` rows before and after, as <col>_lag and <col>_lead."""
    frame = row_frame(df, by, order, n, n, max_rows)
    w = frame.window()
    extra = [f(c, n).over(w).alias(f"{c}_{k}") for c in cols for k, f in (("lag", F.lag), ("lead", F.lead))]
    return frame.finish(frame.df.select("*", *extra))


def leads(df, cols, steps, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Values several rows ahead, <col>_lead_<n> for every n of `steps`, over one window."""
    frame = row_frame(df, by, order, 0, max(steps), max_rows)
    w = frame.window()
    return frame.finish(frame.df.select("*", *[F.lead(c, n).over(w).alias(f"{c}_lead_{n}") for c in cols for n in steps]))


def _with_halo(df, seconds, width):
    """Copy rows of the last `seconds` of a time bucket into the next bucket as well.

    Rows without a time have no window; they are spread over 64 buckets of their own (negative ones).
    """
    own = F.coalesce(F.floor(F.col("_sec") / width), -1 - F.pmod(F.xxhash64(*df.columns), F.lit(64)) - F.lit(1 << 40))
    late = F.col("_sec") >= (F.col("_own") + 1) * width - seconds
    spread = df.withColumn("_own", own)
    spread = spread.withColumn("_bucket", F.explode(F.array_compact(F.array("_own", F.when(late, F.col("_own") + 1)))))
    return spread.withColumn("_home", F.col("_own") == F.col("_bucket")).drop("_own")


def rolling_mean(df, cols=MEASURES, seconds=300, by=KEY, time="DateTime", bucket_seconds=None, dense=DENSE) -> DataFrame:
    """Mean over the last `seconds` (both ends inclusive, whole seconds) as <col>_RollingAvg; without a time it is null.

    Work is split by series and time bucket; a bucket also gets the rows its windows reach
    back to. Where readings are so dense that a window would hold thousands of rows, they
    are first summed per second, which bounds a bucket by its length whatever the data. Either way
    a mean is the sum of the window divided by its count, and every row is kept.
    """
    width = bucket_seconds or max(12 * seconds, 3600)
    if width < seconds:
        raise ValueError("bucket_seconds must cover the window")
    by = list(by)
    rows = df.withColumn("_sec", F.unix_seconds(time))
    fullest = rows.groupBy(*by, F.floor(F.col("_sec") / width).alias("_b")).count().filter("_b is not null").agg(F.max("count")).first()[0]
    w = Window.partitionBy(*by, "_bucket").orderBy("_sec").rangeBetween(-seconds, 0)

    if (fullest or 0) <= dense:
        spread = _with_halo(rows, seconds, width)
        timed = F.col("_sec").isNotNull()
        # try_divide: a window without any value has no mean
        mean = [F.when(timed, F.try_divide(F.sum(c).over(w), F.count(c).over(w))).alias(f"{c}_RollingAvg") for c in cols]
        return spread.select("*", *mean).filter("_home").drop("_home", "_bucket", "_sec")

    per_second = rows.filter("_sec is not null").groupBy(*by, "_sec").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in cols], *[F.count(c).alias(f"_n_{c}") for c in cols]
    )
    spread = _with_halo(per_second, seconds, width)
    mean = [F.try_divide(F.sum(f"_s_{c}").over(w), F.sum(f"_n_{c}").over(w)).alias(f"{c}_RollingAvg") for c in cols]
    means = spread.select("_home", *by, "_sec", *mean).filter("_home").drop("_home")
    return join_skewed(rows, means, [*by, "_sec"]).select(*df.columns, *[f"{c}_RollingAvg" for c in cols])


def resample(df, cols, every="hour", by=KEY, time="DateTime", fill=False) -> DataFrame:
    """Mean per calendar unit (column `bucket`); `fill` adds the empty units in between."""
    means = df.groupBy(*by, F.date_trunc(every, time).alias("bucket")).agg(*[F.avg(c).alias(c) for c in cols])
    if not fill:
        return means
    step = F.expr(f"interval 1 {every}")
    ends = means.groupBy(*by).agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    grid = ends.select(*by, F.explode(F.sequence("a", "b", step)).alias("bucket"))
    return grid.join(means, [*by, "bucket"], "left")


def hour_profile(df, cols, by=(), time="DateTime") -> DataFrame:
    """Mean per hour of day of the hourly means (of each series, if `by` is given)."""
    hourly = resample(df, cols, "hour", by, time)
    return hourly.groupBy(*by, F.hour("bucket").alias("hour")).agg(*[F.avg(c).alias(c) for c in cols])


def weekday_profile(df, cols, time="DateTime") -> DataFrame:
    """Mean per weekday, Monday first, all seven days present."""
    days = [(i, d) for i, d in enumerate(WEEKDAYS)]
    names = df.sparkSession.createDataFrame(days, "day_no int, weekday string")
    means = df.groupBy(F.weekday(time).alias("day_no")).agg(*[F.avg(c).alias(c) for c in cols])
    return F.broadcast(names).join(means, "day_no", "left").orderBy("day_no")


def supervised_windows(df, n_in=10, n_out=30, cols=("SBP", "DBP"), by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Arrays `x` of the last `n_in` readings and `y` of the next `n_out`, where both are complete."""
    frame = row_frame(df, by, order, n_in - 1, n_out, max_rows)
    w, reading = frame.window(), F.struct(*cols)
    pairs = frame.df.select(
        "*",
        F.collect_list(reading).over(w.rowsBetween(1 - n_in, 0)).alias("x"),
        F.collect_list(reading).over(w.rowsBetween(1, n_out)).alias("y"),
    )
    return frame.finish(pairs.filter((F.size("x") == n_in) & (F.size("y") == n_out)))


def rolling_score(df, cols=("SBP", "DBP"), n=5, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Distance from the window mean in deviations, <col>_score, and the largest of them, score.

    A reading is judged by the `n`-row window it opens, near the end of a series by the last
    window. A window without spread scores 0, a series shorter than `n` has no score.
    """
    frame = row_frame(df, by, order, n - 1, n - 1, max_rows)
    w = frame.window()
    past = w.rowsBetween(1 - n, 0)
    full = F.count(F.lit(1)).over(past) == n

    def stats(c):
        spread = F.when(F.max(c).over(past) == F.min(c).over(past), 0.0).otherwise(F.stddev_samp(c).over(past))
        return F.when(full, F.struct(F.avg(c).over(past).alias("mean"), spread.alias("sd"))).alias(f"_w_{c}")

    ended = frame.df.select("*", *[stats(c) for c in cols])
    judged = ended.select(
        "*", *[F.coalesce(*[F.lead(f"_w_{c}", k).over(w) for k in range(n - 1, 0, -1)], f"_w_{c}").alias(f"_j_{c}") for c in cols]
    )

    def score(c):
        mean, sd = F.col(f"_j_{c}.mean"), F.col(f"_j_{c}.sd")
        return F.when(sd == 0, 0.0).otherwise(F.abs(F.col(c) - mean) / F.nullif(sd, F.lit(0.0))).alias(f"{c}_score")

    scored = judged.select(*frame.df.columns, *[score(c) for c in cols])
    names = [F.col(f"{c}_score") for c in cols]
    best = F.greatest(*names) if len(names) > 1 else names[0]
    return frame.finish(scored.withColumn("score", best))


def forecast_grid(df, steps=30, pick=None, time="DateTime") -> DataFrame:
    """One row per reading and minute ahead (`horizon`, `target_time`), or the picked horizons only."""
    horizons = F.array(*[F.lit(h) for h in pick]) if pick else F.sequence(F.lit(1), F.lit(steps))
    grid = df.select("*", F.explode(horizons).alias("horizon"))
    return grid.withColumn("target_time", F.timestamp_seconds(F.unix_seconds(time) + F.col("horizon") * 60))


def running_min(df, col="SPO2", by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Lowest value so far and the time it was first reached."""
    entry = F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), *order))
    out = running(df, by, order, {"_low": ("min", entry)}, max_rows)
    low = F.col("_low")
    return out.withColumn("lowest", low["v"]).withColumn("lowest_time", low[order[0]]).drop("_low")


def confusion_cells(label, pred) -> dict:
    """0/1 columns TP, FP, FN, TN."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    cells = {"TP": p & y, "FP": p & ~y, "FN": ~p & y, "TN": ~p & ~y}
    return {n: F.when(c, 1).otherwise(0).cast("long") for n, c in cells.items()}


def running_confusion(df, label, pred, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Confusion counts so far, with every reading."""
    columns = {n: ("sum", c) for n, c in confusion_cells(label, pred).items()}
    columns["TotalDataProcessed"] = ("count", F.lit(1))
    return running(df, by, order, columns, max_rows)


def running_accuracy(df, label, pred, by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Correct and wrong predictions so far, with every reading."""
    right = F.col(label) == F.col(pred)
    columns = {
        "correct": ("sum", F.when(right, 1).otherwise(0).cast("long")),
        "wrong": ("sum", F.when(right, 0).otherwise(1).cast("long")),
    }
    return running(df, by, order, columns, max_rows)


def running_minmax(df, cols=("SBP", "DBP"), by=KEY, order=ORDER, max_rows=None) -> DataFrame:
    """Scale by the extremes seen so far (<col>_scaled); without any spread the divisor is 1."""
    ends = {f"{c}_{k}": (k, F.col(c)) for c in cols for k in ("min", "max")}
    out = running(df, by, order, ends, max_rows)

    def scaled(c):
        spread = F.col(f"{c}_max") - F.col(f"{c}_min")
        return ((F.col(c) - F.col(f"{c}_min")) / F.when(spread == 0, 1.0).otherwise(spread)).alias(f"{c}_scaled")

    return out.select("*", *[scaled(c) for c in cols])


def unscale(c: str, low: str, high: str):
    """Inverse of the running scale."""
    spread = F.col(high) - F.col(low)
    return F.col(c) * F.when(spread == 0, 1.0).otherwise(spread) + F.col(low)


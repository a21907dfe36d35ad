"""Queries on windows over time, running values and dashboards' series."""

from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.operators import clean, selectors, timeseries
from pulseloom.plans.base import query
from pulseloom.plans.cleaning import IMPUTED
from pulseloom.plans.vitals import JUDGED, cte, judged, level_sql, points, points_cte, r6, ts_us, vitals
from pulseloom.schema import MEASURES

_W = "OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id)"


@query(
    "level_window_mean",
    cte(IMPUTED, f"lv AS (SELECT *, {level_sql()} AS BP_level FROM imputed)")
    + "SELECT BP_level, CAST(epoch(time_bucket(INTERVAL 15 MINUTE, DateTime)) AS BIGINT)+900 AS sec, round(avg(SBP),6) AS SBP, round(avg(DBP),6) AS DBP, count(*) AS n "
    "FROM lv GROUP BY 1,2",
)
def level_window_mean(spark, sf):
    repaired = clean.impute_zero_neighbors(vitals(spark, sf))
    levels = repaired.withColumn("BP_level", rules.bp_level("SBP", "DBP"))
    w = levels.groupBy("BP_level", F.window("DateTime", "15 minutes").alias("w"))
    out = w.agg(F.avg("SBP").alias("SBP"), F.avg("DBP").alias("DBP"), F.count(F.lit(1)).alias("n"))
    return out.select("BP_level", F.unix_seconds("w.end").alias("sec"), r6("SBP", "SBP"), r6("DBP", "DBP"), "n")


@query("lag_lead", cte() + f"SELECT reading_id, lag(SBP) {_W} AS SBP_lag, lead(SBP) {_W} AS SBP_lead, lag(DBP) {_W} AS DBP_lag, lead(DBP) {_W} AS DBP_lead FROM vitals")
def lag_lead(spark, sf):
    out = timeseries.lag_lead(vitals(spark, sf), ("SBP", "DBP"))
    return out.select("reading_id", "SBP_lag", "SBP_lead", "DBP_lag", "DBP_lead")


def _rolling_sql(seconds):
    w = f"OVER (PARTITION BY patient_id ORDER BY sec RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    return cte() + "SELECT reading_id, " + ", ".join(f"round(avg({c}) {w},6) AS {c}_RollingAvg" for c in MEASURES) + " FROM vitals"


def _rolling(spark, sf, seconds):
    out = timeseries.rolling_mean(vitals(spark, sf), seconds=seconds)
    return out.select("reading_id", *[r6(f"{c}_RollingAvg", f"{c}_RollingAvg") for c in MEASURES])


@query("rolling_avg", _rolling_sql(300))
def rolling_avg(spark, sf):
    return _rolling(spark, sf, 300)


@query("rolling_avg_day", _rolling_sql(86400))
def rolling_avg_day(spark, sf):
    return _rolling(spark, sf, 86400)


@query("resample_hourly", cte() + "SELECT patient_id, CAST(epoch(date_trunc('hour', DateTime)) AS BIGINT) AS sec, round(avg(SBP),6) AS SBP, round(avg(DBP),6) AS DBP FROM vitals GROUP BY 1,2")
def resample_hourly(spark, sf):
    out = timeseries.resample(vitals(spark, sf), ("SBP", "DBP"))
    return out.select("patient_id", F.unix_seconds("bucket").alias("sec"), r6("SBP", "SBP"), r6("DBP", "DBP"))


@query(
    "resample_hourly_filled",
    cte("h AS (SELECT patient_id, date_trunc('hour', DateTime) AS b, avg(SBP) AS SBP FROM vitals GROUP BY 1,2)",
        "g AS (SELECT patient_id, unnest(generate_series(min(b), max(b), INTERVAL 1 HOUR)) AS b FROM h GROUP BY 1)")
    + "SELECT patient_id, CAST(epoch(b) AS BIGINT) AS sec, round(SBP,6) AS SBP FROM g LEFT JOIN h USING (patient_id, b)",
)
def resample_hourly_filled(spark, sf):
    out = timeseries.resample(vitals(spark, sf), ("SBP",), fill=True)
    return out.select("patient_id", F.unix_seconds("bucket").alias("sec"), r6("SBP", "SBP"))


@query(
    "hour_profile",
    cte("h AS (SELECT date_trunc('hour', DateTime) AS b, avg(SBP) AS SBP, avg(DBP) AS DBP FROM vitals GROUP BY 1)")
    + "SELECT CAST(hour(b) AS INTEGER) AS hour, round(avg(SBP),6) AS SBP, round(avg(DBP),6) AS DBP FROM h GROUP BY 1",
)
def hour_profile(spark, sf):
    return timeseries.hour_profile(vitals(spark, sf), ("SBP", "DBP")).select("hour", r6("SBP", "SBP"), r6("DBP", "DBP"))


@query(
    "weekday_profile",
    cte("d AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{d}')" for i, d in enumerate(timeseries.WEEKDAYS)) + ") t(day_no, weekday))")
    + "SELECT day_no, weekday, round(avg(SBP),6) AS SBP, round(avg(DBP),6) AS DBP FROM d LEFT JOIN vitals ON isodow(DateTime)-1=day_no GROUP BY 1,2",
)
def weekday_profile(spark, sf):
    out = timeseries.weekday_profile(vitals(spark, sf), ("SBP", "DBP"))
    return out.select("day_no", "weekday", r6("SBP", "SBP"), r6("DBP", "DBP"))


@query(
    "window_mean",
    points_cte() + "SELECT field, least(CAST(epoch(time_bucket(INTERVAL 15 MINUTE, time)) AS BIGINT)+900, CAST(epoch(TIMESTAMP '2024-01-20 10:05:00') AS BIGINT)) AS sec, "
    "round(avg(value),6) AS value FROM points WHERE time>=TIMESTAMP '2024-01-03 10:05:00' AND time<TIMESTAMP '2024-01-20 10:05:00' GROUP BY 1,2",
)
def window_mean(spark, sf):
    w = selectors.window_agg(points(spark, sf), "15 minutes", "mean", "2024-01-03 10:05:00", "2024-01-20 10:05:00")
    return w.select("field", F.unix_seconds("time").alias("sec"), r6("value", "value"))


@query(
    "window_last",
    points_cte() + "SELECT field, CAST(epoch(time_bucket(INTERVAL 15 MINUTE, time)) AS BIGINT)+900 AS sec, arg_max(value, (time, reading_id)) AS value "
    "FROM points GROUP BY 1,2",
)
def window_last(spark, sf):
    w = selectors.window_agg(points(spark, sf), "15 minutes", "last")
    return w.select("field", F.unix_seconds("time").alias("sec"), "value")


@query("raw_series", points_cte(("SBP",)) + "SELECT patient_id, ts_us, value FROM points ORDER BY time, reading_id")
def raw_series(spark, sf):
    p = points(spark, sf, ("SBP",)).orderBy("time", "reading_id")
    return p.select(F.col("tags")["patient_id"].cast("long").alias("patient_id"), ts_us("time").alias("ts_us"), "value")


@query(
    "downsample",
    points_cte(("SBP", "HR"))
    + ", r AS (SELECT min(sec) AS lo, max(sec) AS hi FROM points), b AS (SELECT lo, CAST(ceil((hi-lo+1)/5e2) AS BIGINT) AS w FROM r) "
    "SELECT field, lo+((sec-lo)//w)*w AS sec, round(avg(value),6) AS value FROM points CROSS JOIN b GROUP BY 1,2",
)
def downsample(spark, sf):
    out = selectors.downsample(points(spark, sf, ("SBP", "HR")), 500)
    return out.select("field", F.unix_seconds("time").alias("sec"), r6("value", "value"))


def _tenths(name, c):
    return F.array_join(F.transform(name, lambda e: F.round(e[c] * 10).cast("int").cast("string")), ",")


def _tenths_sql(c, frame):
    return f"array_to_string(list(CAST(round({c}*10) AS INTEGER)) OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id ROWS BETWEEN {frame}), ',')"


@query(
    "supervised_windows",
    cte("w AS (SELECT reading_id, row_number() " + _W + " AS pos, count(*) OVER (PARTITION BY patient_id) AS n, "
        + ", ".join(f"{_tenths_sql(c, f)} AS {k}_{c}" for c in ("SBP", "DBP")
                    for k, f in (("x", "9 PRECEDING AND CURRENT ROW"), ("y", "1 FOLLOWING AND 30 FOLLOWING"))) + " FROM vitals)")
    + "SELECT reading_id, x_SBP, y_SBP, x_DBP, y_DBP FROM w WHERE pos>=10 AND pos+30<=n",
)
def supervised_windows(spark, sf):
    out = timeseries.supervised_windows(vitals(spark, sf))
    return out.select("reading_id", *[_tenths(k, c).alias(f"{k}_{c}") for c in ("SBP", "DBP") for k in ("x", "y")])


def _stats_sql(c):
    f = "OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count(*) {f}=5 THEN avg({c}) {f} END AS m_{c}, "
            f"CASE WHEN count(*) {f}=5 THEN CASE WHEN max({c}) {f}=min({c}) {f} THEN 0e0 ELSE stddev_samp({c}) {f} END END AS s_{c}")


def _last_sql(x):
    return "coalesce(" + ", ".join(f"lead({x},{k}) {_W}" for k in (4, 3, 2, 1)) + f", {x})"


@query(
    "rolling_score",
    cte(f"st AS (SELECT *, {_stats_sql('SBP')}, {_stats_sql('DBP')} FROM vitals)",
        "j AS (SELECT *, " + ", ".join(f"{_last_sql(f'{k}_{c}')} AS j{k}_{c}" for c in ("SBP", "DBP") for k in "ms") + " FROM st)",
        "z AS (SELECT reading_id, " + ", ".join(f"CASE WHEN js_{c}=0 THEN 0e0 ELSE abs({c}-jm_{c})/nullif(js_{c},0) END AS z_{c}" for c in ("SBP", "DBP")) + " FROM j)")
    + "SELECT reading_id, round(z_SBP,6) AS SBP_score, round(z_DBP,6) AS DBP_score, round(greatest(z_SBP,z_DBP),6) AS score FROM z",
)
def rolling_score(spark, sf):
    out = timeseries.rolling_score(vitals(spark, sf))
    return out.select("reading_id", *[r6(c, c) for c in ("SBP_score", "DBP_score", "score")])


@query("running_min", cte() + "SELECT reading_id, v AS lowest, t AS lowest_us FROM (SELECT reading_id, min(SPO2) OVER w AS v, "
       "CAST(min(struct_pack(v:=SPO2, t:=ts_us)) OVER w AS STRUCT(v DOUBLE, t BIGINT)).t AS t FROM vitals "
       "WINDOW w AS (PARTITION BY patient_id ORDER BY DateTime, reading_id))")
def running_min(spark, sf):
    out = timeseries.running_min(vitals(spark, sf), "SPO2")
    return out.select("reading_id", "lowest", ts_us("lowest_time").alias("lowest_us"))


@query("running_confusion", cte(JUDGED) + "SELECT reading_id, "
       + ", ".join(f"sum(CASE WHEN pred={p} AND label={y} THEN 1 ELSE 0 END) OVER w AS {n}" for n, p, y in (("TP", 1, 1), ("FP", 1, 0), ("FN", 0, 1), ("TN", 0, 0)))
       + ", count(*) OVER w AS TotalDataProcessed FROM judged WINDOW w AS (PARTITION BY patient_id ORDER BY DateTime, reading_id)")
def running_confusion(spark, sf):
    out = timeseries.running_confusion(judged(spark, sf), "label", "pred")
    return out.select("reading_id", "TP", "FP", "FN", "TN", "TotalDataProcessed")


@query("running_accuracy", cte(JUDGED) + "SELECT reading_id, sum(CASE WHEN pred=label THEN 1 ELSE 0 END) OVER w AS correct, "
       "sum(CASE WHEN pred=label THEN 0 ELSE 1 END) OVER w AS wrong FROM judged WINDOW w AS (PARTITION BY patient_id ORDER BY DateTime, reading_id)")
def running_accuracy(spark, sf):
    return timeseries.running_accuracy(judged(spark, sf), "label", "pred").select("reading_id", "correct", "wrong")


def _scaled_sql(c):
    return f"round(({c}-min({c}) OVER w)/CASE WHEN max({c}) OVER w=min({c}) OVER w THEN 1e0 ELSE max({c}) OVER w-min({c}) OVER w END,6) AS {c}_scaled"


@query("running_minmax", cte() + f"SELECT reading_id, {_scaled_sql('SBP')}, {_scaled_sql('DBP')} FROM vitals WINDOW w AS (PARTITION BY patient_id ORDER BY DateTime, reading_id)")
def running_minmax(spark, sf):
    out = timeseries.running_minmax(vitals(spark, sf))
    return out.select("reading_id", r6("SBP_scaled", "SBP_scaled"), r6("DBP_scaled", "DBP_scaled"))


@query("forecast_grid", cte() + "SELECT reading_id, CAST(h AS INTEGER) AS horizon, sec+h*60 AS sec FROM vitals, (SELECT unnest([15,30]) AS h)")
def forecast_grid(spark, sf):
    out = timeseries.forecast_grid(vitals(spark, sf), pick=(15, 30))
    return out.select("reading_id", "horizon", F.unix_seconds("target_time").alias("sec"))

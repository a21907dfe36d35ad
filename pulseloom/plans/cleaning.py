"""Queries on filters, repair, duplicates and splits."""

from pyspark.sql import functions as F

from pulseloom.operators import clean, profile
from pulseloom.plans.base import query
from pulseloom.plans.vitals import cte, r6, ts_us, vitals
from pulseloom.schema import MEASURES


@query("select_bp", cte() + "SELECT ts_us, SBP, DBP FROM vitals")
def select_bp(spark, sf):
    return vitals(spark, sf).select(ts_us().alias("ts_us"), "SBP", "DBP")


@query("filter_all_zero", cte() + "SELECT reading_id FROM vitals WHERE SBP=0 AND DBP=0 AND HR=0 AND SPO2=0")
def filter_all_zero(spark, sf):
    return vitals(spark, sf).filter(clean.lost_signal()).select("reading_id")


@query("filter_zero_bp", cte() + "SELECT reading_id, HR FROM vitals WHERE SBP=0 AND DBP=0")
def filter_zero_bp(spark, sf):
    return vitals(spark, sf).filter(clean.lost_signal(("SBP", "DBP"))).select("reading_id", "HR")


@query("filter_valid_bp", cte() + "SELECT reading_id, SBP, DBP FROM vitals WHERE SBP<>0 AND DBP<>0")
def filter_valid_bp(spark, sf):
    return vitals(spark, sf).filter(clean.valid_bp()).select("reading_id", "SBP", "DBP")


_ROW = ["patient_id", "reading_id", "SBP", "DBP", "HR"]


@query("dedup_rows", cte() + "SELECT DISTINCT patient_id, reading_id, SBP, DBP, HR FROM "
       "(SELECT * FROM vitals UNION ALL SELECT * FROM vitals WHERE reading_id%5=0)")
def dedup_rows(spark, sf):
    v = vitals(spark, sf).select(*_ROW)
    return clean.dedup(v.unionByName(v.filter("reading_id % 5 = 0")))


_W = "OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id)"


def _impute_sql(c):
    return (f"CASE WHEN {c}=0 AND HR<>0 AND SPO2<>0 THEN (coalesce(lag({c}) {_W},0)+lead({c}) {_W})/2e0 "
            f"ELSE {c} END")


IMPUTED = f"imputed AS (SELECT * REPLACE ({_impute_sql('SBP')} AS SBP, {_impute_sql('DBP')} AS DBP) FROM vitals)"


@query("impute_zero_neighbors", cte(IMPUTED) + "SELECT reading_id, round(SBP,6) AS SBP, round(DBP,6) AS DBP FROM imputed")
def impute_zero_neighbors(spark, sf):
    return clean.impute_zero_neighbors(vitals(spark, sf)).select("reading_id", r6("SBP", "SBP"), r6("DBP", "DBP"))


def _interpolated(c):
    return (f"coalesce(v_{c}, p_{c}+(n_{c}-p_{c})*(pos-pp_{c})/nullif(np_{c}-pp_{c},0), p_{c}, n_{c}, "
            f"(SELECT avg(nullif({c},0)) FROM vitals))")


def _near(c):
    up = "OVER (PARTITION BY patient_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "OVER (PARTITION BY patient_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return (f"last_value(v_{c} IGNORE NULLS) {up} AS p_{c}, max(CASE WHEN v_{c} IS NOT NULL THEN pos END) {up} AS pp_{c}, "
            f"first_value(v_{c} IGNORE NULLS) {down} AS n_{c}, min(CASE WHEN v_{c} IS NOT NULL THEN pos END) {down} AS np_{c}")


INTERPOLATED = (
    f"placed AS (SELECT *, nullif(SBP,0) AS v_SBP, nullif(DBP,0) AS v_DBP, row_number() {_W} AS pos FROM vitals), "
    f"near AS (SELECT *, {_near('SBP')}, {_near('DBP')} FROM placed), "
    f"interpolated AS (SELECT reading_id, patient_id, DateTime, HR, SPO2, {_interpolated('SBP')} AS SBP, {_interpolated('DBP')} AS DBP FROM near)"
)


@query("interpolate_linear", cte(INTERPOLATED) + "SELECT reading_id, round(SBP,6) AS SBP, round(DBP,6) AS DBP FROM interpolated")
def interpolate_linear(spark, sf):
    return clean.interpolate_zeros(vitals(spark, sf)).select("reading_id", r6("SBP", "SBP"), r6("DBP", "DBP"))


_CONST = ("SBP", "device", "device_or_null", "never")


@query(
    "constant_columns",
    cte("x AS (SELECT SBP, 7e0 AS device, CASE WHEN reading_id%2=0 THEN 7e0 END AS device_or_null, CAST(NULL AS DOUBLE) AS never FROM vitals)")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM (SELECT DISTINCT {c} FROM x))=1 AS constant" for c in _CONST
    ),
)
def constant_columns(spark, sf):
    v = vitals(spark, sf).select(
        "SBP", F.lit(7.0).alias("device"), F.when(F.col("reading_id") % 2 == 0, 7.0).alias("device_or_null"),
        F.lit(None).cast("double").alias("never"),
    )
    return profile.constant_columns(v, _CONST)


_HC = ("RR", "SBP", "SBP_kpa", "DBP", "DBP_low", "HR")


@query(
    "high_corr_features",
    cte("x AS (SELECT RR, SBP, SBP*0.133322e0 AS SBP_kpa, DBP, -DBP AS DBP_low, HR FROM vitals)")
    + "SELECT \"column\", round(max(c),6) AS max_corr FROM ("
    + " UNION ALL ".join(
        f"SELECT '{b}' AS \"column\", abs(corr({a},{b})) AS c FROM x" for i, a in enumerate(_HC) for b in _HC[i + 1 :]
    )
    + ") WHERE c>0.95 GROUP BY 1",
)
def high_corr_features(spark, sf):
    v = vitals(spark, sf).select("RR", "SBP", (F.col("SBP") * 0.133322).alias("SBP_kpa"), "DBP", (-F.col("DBP")).alias("DBP_low"), "HR")
    return profile.high_corr(v, _HC).select("column", r6("max_corr", "max_corr"))


@query(
    "time_slice",
    cte() + "SELECT reading_id, SBP FROM vitals WHERE DateTime BETWEEN TIMESTAMP '2024-01-05 12:00:00' AND TIMESTAMP '2024-01-06 12:00:00'",
)
def time_slice(spark, sf):
    return clean.time_slice(vitals(spark, sf), "2024-01-05 12:00:00", "2024-01-06 12:00:00").select("reading_id", "SBP")


@query(
    "row_mean_bp",
    cte() + "SELECT reading_id, round(CASE WHEN SBP=0 AND HR=0 THEN NULL WHEN SBP=0 THEN HR WHEN HR=0 THEN SBP ELSE (SBP+HR)/2e0 END,6) AS m, "
    "round((SBP+DBP)/2e0,6) AS bp FROM vitals",
)
def row_mean_bp(spark, sf):
    v = vitals(spark, sf).withColumn("a", F.nullif("SBP", F.lit(0.0))).withColumn("b", F.nullif("HR", F.lit(0.0)))
    return v.select("reading_id", r6(clean.row_mean("a", "b"), "m"), r6(clean.row_mean("SBP", "DBP"), "bp"))


@query(
    "split_chronological",
    cte() + f"SELECT reading_id, row_number() {_W} <= floor(0.8e0*count(*) OVER (PARTITION BY patient_id)) AS is_train FROM vitals",
)
def split_chronological(spark, sf):
    return clean.split_chronological(vitals(spark, sf), 0.8).select("reading_id", "is_train")


def hash_sql(key="reading_id", seed=42):
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'),1,8) AS BIGINT) % 100"


@query("split_hash", cte() + f"SELECT reading_id, {hash_sql()} < 80 AS is_train FROM vitals")
def split_hash(spark, sf):
    return clean.split_hash(vitals(spark, sf)).select("reading_id", "is_train")


@query(
    "preview", cte() + f"SELECT reading_id, {', '.join(MEASURES)} FROM vitals ORDER BY DateTime, reading_id LIMIT 20"
)
def preview(spark, sf):
    return vitals(spark, sf).orderBy("DateTime", "reading_id").limit(20).select("reading_id", *MEASURES)

"""Queries on the row rules."""

from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.plans.base import query
from pulseloom.plans.vitals import LABEL_SQL, ONLINE_SQL, VALIDITY_SQL, class_sql, cte, level_sql, vitals

_NULLABLE = "n AS (SELECT *, nullif(SBP,0) AS s, nullif(DBP,0) AS d FROM vitals)"


def _nullable(spark, sf):
    return vitals(spark, sf).withColumn("s", F.nullif("SBP", F.lit(0.0))).withColumn("d", F.nullif("DBP", F.lit(0.0)))


@query("bp_level", cte(_NULLABLE) + f"SELECT reading_id, {level_sql()} AS BP_level, {level_sql('s', 'd')} AS nullable FROM n")
def bp_level(spark, sf):
    return _nullable(spark, sf).select(
        "reading_id", rules.bp_level("SBP", "DBP").alias("BP_level"), rules.bp_level("s", "d").alias("nullable")
    )


@query("bp_class", cte(_NULLABLE) + f"SELECT reading_id, {class_sql()} AS Class, {class_sql('s', 'd')} AS nullable FROM n")
def bp_class(spark, sf):
    return _nullable(spark, sf).select(
        "reading_id", rules.bp_class("SBP", "DBP").alias("Class"), rules.bp_class("s", "d").alias("nullable")
    )


@query("bp_class_validity", cte() + f"SELECT reading_id, {VALIDITY_SQL} AS class FROM vitals")
def bp_class_validity(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.bp_class_validity("SBP", "DBP", "HR", "SPO2").alias("class"))


@query("bp_class_zero", cte() + f"SELECT reading_id, {class_sql(zero=True)} AS Class FROM vitals")
def bp_class_zero(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.bp_class_zero("SBP", "DBP").alias("Class"))


@query("label_threshold", cte() + f"SELECT reading_id, {LABEL_SQL} AS label FROM vitals")
def label_threshold(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.label_threshold("SBP", "DBP", "HR").alias("label"))


@query("label_not_normal", cte() + f"SELECT reading_id, CASE WHEN {VALIDITY_SQL}='Normal' THEN 0 ELSE 1 END AS label FROM vitals")
def label_not_normal(spark, sf):
    cls = rules.bp_class_validity("SBP", "DBP", "HR", "SPO2")
    return vitals(spark, sf).select("reading_id", rules.label_not_normal(cls).alias("label"))


@query("label_online", cte() + f"SELECT reading_id, {ONLINE_SQL} AS label FROM vitals")
def label_online(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.label_online("SBP", "DBP").alias("label"))


@query("sbp_band", cte() + "SELECT reading_id, CASE WHEN SBP-60>80 THEN 3 WHEN SBP-60>50 THEN 2 ELSE 1 END AS band FROM vitals")
def sbp_band(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.sbp_band(F.col("SBP") - 60).alias("band"))


# The score band and floor that flag an anomaly.
SCORE_BANDS, SCORE_FLOOR = ((-0.00038, -0.00035),), -45.0


@query(
    "score_flag",
    cte("x AS (SELECT reading_id, -SBP/4e0 AS a, -DBP/2e5 AS b FROM vitals)")
    + "SELECT reading_id, CASE WHEN (a>-0.00038e0 AND a<-0.00035e0) OR a<-45 THEN 1 ELSE 0 END AS by_floor, "
    "CASE WHEN (b>-0.00038e0 AND b<-0.00035e0) OR b<-45 THEN 1 ELSE 0 END AS by_band FROM x",
)
def score_flag(spark, sf):
    a, b = -F.col("SBP") / 4, -F.col("DBP") / 200000
    flag = lambda c: rules.score_flag(c, SCORE_BANDS, SCORE_FLOOR)
    return vitals(spark, sf).select("reading_id", flag(a).alias("by_floor"), flag(b).alias("by_band"))


_CODE = "CASE WHEN SBP>180 OR SBP=0 THEN -1 ELSE 1 END"


@query(
    "detection_label",
    cte() + f"SELECT reading_id, CASE WHEN {_CODE}=-1 THEN 1 ELSE 0 END AS Detection, "
    f"CASE WHEN {_CODE}=-1 THEN 'Anomaly' ELSE 'Normal' END AS Label FROM vitals",
)
def detection_label(spark, sf):
    code = F.when((F.col("SBP") > 180) | (F.col("SBP") == 0), -1).otherwise(1)
    return vitals(spark, sf).select(
        "reading_id", rules.detection_flag(code).alias("Detection"), rules.detection_label(code).alias("Label")
    )


@query("value_map", cte() + f"SELECT reading_id, CASE {LABEL_SQL} WHEN 0 THEN 'Normal' WHEN 1 THEN 'Anomaly' END AS text FROM vitals")
def value_map(spark, sf):
    mapped = rules.value_map(rules.label_threshold("SBP", "DBP", "HR"), {0: "Normal", 1: "Anomaly"})
    return vitals(spark, sf).select("reading_id", mapped.alias("text"))


@query(
    "range_map",
    cte() + "SELECT reading_id, CASE WHEN SPO2 BETWEEN 0 AND 85 THEN 'red' WHEN SPO2 BETWEEN 85 AND 94 THEN 'yellow' "
    "WHEN SPO2 BETWEEN 95 AND 100 THEN 'green' END AS colour FROM vitals",
)
def range_map(spark, sf):
    return vitals(spark, sf).select("reading_id", rules.range_map("SPO2", rules.SPO2_RANGES).alias("colour"))


def _steps_sql(c, steps):
    base = [out for v, out in steps if v is None][0]
    rising = sorted([s for s in steps if s[0] is not None], reverse=True)
    return "CASE " + " ".join(f"WHEN {c}>={v} THEN '{out}'" for v, out in rising) + f" ELSE '{base}' END"


_BANDS = {"SBP": rules.SBP_STEPS, "DBP": rules.DBP_STEPS, "HR": rules.HR_STEPS, "RR": rules.RR_STEPS,
          "CO": rules.CO_STEPS, "SPO2": rules.SPO2_STEPS}


@query(
    "threshold_band",
    cte() + "SELECT reading_id, " + ", ".join(f"{_steps_sql(c, s)} AS {c}_colour" for c, s in _BANDS.items()) + " FROM vitals",
)
def threshold_band(spark, sf):
    return vitals(spark, sf).select(
        "reading_id", *[rules.threshold_band(c, s).alias(f"{c}_colour") for c, s in _BANDS.items()]
    )

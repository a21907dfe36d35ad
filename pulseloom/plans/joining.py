"""Queries on joins, unions and ordered heads."""

from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.operators import joins
from pulseloom.operators.clean import hash_bucket
from pulseloom.operators.timeseries import forecast_grid
from pulseloom.plans.base import query
from pulseloom.plans.cleaning import hash_sql
from pulseloom.plans.vitals import cte, level_sql, ts_us, vitals


@query("assemble_columns", cte() + "SELECT reading_id, SBP, DBP, HR FROM vitals")
def assemble_columns(spark, sf):
    """Columns of the same rows need no join: they are one projection. `joins.assemble` is for separately computed tables."""
    return vitals(spark, sf).select("reading_id", "SBP", "DBP", "HR")


@query("label_join", cte() + f"SELECT reading_id, CASE WHEN reading_id%3=0 THEN NULL ELSE {level_sql()} END AS Class FROM vitals")
def label_join(spark, sf):
    v = vitals(spark, sf)
    labels = v.filter("reading_id % 3 <> 0").select("patient_id", "DateTime", rules.bp_level("SBP", "DBP").alias("Class"))
    return joins.join_labels(v.select("patient_id", "DateTime", "reading_id"), labels).select("reading_id", "Class")


_FC = "fc AS (SELECT patient_id, reading_id, CAST(h AS INTEGER) AS horizon, SBP AS predicted, sec+h*60 AS target FROM vitals, (SELECT unnest([15,30]) AS h))"


def _forecast(spark, sf):
    grid = forecast_grid(vitals(spark, sf), pick=(15, 30))
    return grid.select("patient_id", "reading_id", "horizon", F.col("SBP").alias("predicted"), "target_time")


@query(
    "forecast_actual_join",
    cte(_FC, "p AS (SELECT fc.reading_id, horizon, predicted, a.SBP AS actual, a.ts_us AS actual_us, row_number() OVER "
        "(PARTITION BY fc.reading_id, horizon ORDER BY abs(a.ts_us-target*1000000), a.ts_us, a.reading_id) AS rn "
        "FROM fc JOIN vitals a ON a.patient_id=fc.patient_id AND abs(a.ts_us-target*1000000)<=7200000000)")
    + "SELECT reading_id, horizon, predicted, actual, actual_us FROM p WHERE rn=1",
)
def forecast_actual_join(spark, sf):
    out = joins.join_forecast(_forecast(spark, sf), vitals(spark, sf), "SBP", tolerance=7200)
    return out.select("reading_id", "horizon", "predicted", "actual", ts_us("actual_time").alias("actual_us"))


@query(
    "forecast_actual_minute",
    cte(_FC, "a AS (SELECT patient_id, sec//60 AS m, min(struct_pack(t:=ts_us, r:=reading_id, v:=SBP)) AS a FROM vitals GROUP BY 1,2)")
    + "SELECT reading_id, horizon, predicted, a.v AS actual, a.t AS actual_us FROM fc JOIN a ON a.patient_id=fc.patient_id AND a.m=target//60",
)
def forecast_actual_minute(spark, sf):
    out = joins.join_forecast(_forecast(spark, sf), vitals(spark, sf), "SBP")
    return out.select("reading_id", "horizon", "predicted", "actual", ts_us("actual_time").alias("actual_us"))


@query("union_eval_sets", cte(f"t AS (SELECT reading_id, SBP, DBP FROM vitals WHERE {hash_sql()}>=82)") + "SELECT * FROM t UNION ALL SELECT * FROM t")
def union_eval_sets(spark, sf):
    test = vitals(spark, sf).filter(hash_bucket("reading_id", 42) >= 82).select("reading_id", "SBP", "DBP")
    return joins.union_all([test, test.select("DBP", "SBP", "reading_id")])


@query("limit_ordered", cte() + "SELECT reading_id, SBP FROM vitals ORDER BY DateTime, reading_id LIMIT 3864")
def limit_ordered(spark, sf):
    return joins.head_ordered(vitals(spark, sf), 3864, ("DateTime", "reading_id")).select("reading_id", "SBP")

"""Queries on profiles, quality measures, selectors and the count sketch."""

from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.operators import metrics, profile, selectors, sketch
from pulseloom.operators.clean import row_mean
from pulseloom.operators.timeseries import confusion_cells, running_confusion
from pulseloom.plans.base import query
from pulseloom.plans.vitals import (
    JUDGED, LABEL_SQL, VALIDITY_SQL, class_sql, cte, judged, level_sql, points, points_cte, r6, ts_us, vitals,
)
from pulseloom.schema import MEASURES
from pulseloom.sources.points import to_points


@query("row_count", cte() + "SELECT count(*) AS n FROM vitals")
def row_count(spark, sf):
    return vitals(spark, sf).agg(F.count(F.lit(1)).alias("n"))


def _describe_sql(c):
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}),6) AS mean, round(stddev_samp({c}),6) AS stddev, "
            f"min({c}) AS min, max({c}) AS max, " + ", ".join(f"round(quantile_cont({c},{q}),6) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))
            + " FROM vitals")


@query("describe_vitals", cte() + " UNION ALL ".join(map(_describe_sql, MEASURES)))
def describe_vitals(spark, sf):
    d = profile.describe(vitals(spark, sf))
    return d.select("column", "count", *[r6(c, c) for c in ("mean", "stddev", "min", "max", "p25", "p50", "p75")])


@query("schema_table", cte() + "SELECT \"column\", type, n FROM (VALUES ('patient_id','bigint'),('reading_id','bigint'),('DateTime','timestamp'),"
       + ",".join(f"('{c}','double')" for c in MEASURES) + ") t(\"column\", type) CROSS JOIN (SELECT count(*) AS n FROM vitals)")
def schema_table(spark, sf):
    """Columns and types of the readings, and how many rows have them."""
    v = vitals(spark, sf)
    return profile.schema_table(v).withColumn("n", F.lit(v.count()))


_GAPPY = "g AS (SELECT nullif(SBP,0) AS SBP, nullif(DBP,0) AS DBP, nullif(HR,0) AS HR, nullif(SPO2,0) AS SPO2, RR FROM vitals)"
_GAPPY_COLS = ("SBP", "DBP", "HR", "SPO2", "RR")


def _gappy(spark, sf):
    return vitals(spark, sf).select(*[F.nullif(c, F.lit(0.0)).alias(c) if c != "RR" else "RR" for c in _GAPPY_COLS])


@query("missing_counts", cte(_GAPPY) + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*)-count({c}) AS missing FROM g" for c in _GAPPY_COLS))
def missing_counts(spark, sf):
    return profile.missing(_gappy(spark, sf), _GAPPY_COLS).select("column", "missing")


@query("missing_percent", cte(_GAPPY) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round((count(*)-count({c}))*1e2/count(*),6) AS percent FROM g" for c in _GAPPY_COLS))
def missing_percent(spark, sf):
    return profile.missing(_gappy(spark, sf), _GAPPY_COLS).select("column", r6("percent", "percent"))


def _histogram_sql(c, bins, expr=None):
    return (f"SELECT '{c}' AS \"column\", CAST(b AS INTEGER) AS bin, round(lo+b*((hi-lo)/{bins}),6) AS low, count(x) AS n FROM "
            f"(SELECT unnest(range({bins})) AS b) CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM h) "
            f"LEFT JOIN (SELECT {c} AS x, least(floor(({c}-(SELECT min({c}) FROM h))/(((SELECT max({c}) FROM h)-(SELECT min({c}) FROM h))/{bins})),{bins}-1) AS k FROM h) ON k=b "
            f"GROUP BY b, lo, hi")


@query("histogram", cte("h AS (SELECT * FROM vitals)") + " UNION ALL ".join(_histogram_sql(c, 10) for c in MEASURES))
def histogram(spark, sf):
    return profile.histogram(vitals(spark, sf), MEASURES, 10).select("column", "bin", r6("low", "low"), "n")


@query("histogram_bp_mean", cte("h AS (SELECT (SBP+DBP)/2 AS bp_mean FROM vitals)") + _histogram_sql("bp_mean", 15))
def histogram_bp_mean(spark, sf):
    v = vitals(spark, sf).select(row_mean("SBP", "DBP").alias("bp_mean"))
    return profile.histogram(v, ["bp_mean"], 15).select("column", "bin", r6("low", "low"), "n")


@query("class_counts", cte() + f"SELECT {class_sql()} AS Class, count(*) AS n FROM vitals GROUP BY 1")
def class_counts(spark, sf):
    return profile.value_counts(vitals(spark, sf).select(rules.bp_class("SBP", "DBP").alias("Class")), "Class")


@query("anomaly_class_counts", cte() + f"SELECT {VALIDITY_SQL} AS class, count(*) AS n FROM vitals WHERE {VALIDITY_SQL}<>'Normal' GROUP BY 1")
def anomaly_class_counts(spark, sf):
    v = vitals(spark, sf).select(rules.bp_class_validity("SBP", "DBP", "HR", "SPO2").alias("class"))
    return profile.value_counts(v, "class", F.col("class") != "Normal")


@query("corr_matrix", cte() + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + ("1e0 AS corr" if a == b else f"round(corr({a},{b}),6) AS corr FROM vitals")
    for a in MEASURES for b in MEASURES))
def corr_matrix(spark, sf):
    return profile.corr_long(vitals(spark, sf)).select("col_a", "col_b", r6("corr", "corr"))


@query("accuracy", cte(JUDGED) + "SELECT count(*) FILTER (label=pred) AS correct, count(*) AS total, "
       "round(avg(CASE WHEN label=pred THEN 1 ELSE 0 END),6) AS accuracy FROM judged")
def accuracy(spark, sf):
    return metrics.accuracy(judged(spark, sf), "label", "pred").select("correct", "total", r6("accuracy", "accuracy"))


@query("confusion_matrix", cte(JUDGED) + "SELECT label, pred, count(*) AS n FROM judged GROUP BY 1,2")
def confusion_matrix(spark, sf):
    return metrics.confusion(judged(spark, sf), "label", "pred")


_REPORT = f"c AS (SELECT {level_sql()} AS y, {level_sql('SBP+10', 'DBP+5')} AS p FROM vitals)"


@query(
    "classification_report",
    cte(_REPORT, "k AS (SELECT y AS c FROM c UNION SELECT p FROM c)",
        "t AS (SELECT k.c, (SELECT count(*) FROM c WHERE y=k.c AND p=k.c) AS tp, (SELECT count(*) FROM c WHERE y=k.c) AS support, "
        "(SELECT count(*) FROM c WHERE p=k.c) AS predicted FROM k)",
        "m AS (SELECT *, CASE WHEN predicted=0 THEN 0e0 ELSE tp/CAST(predicted AS DOUBLE) END AS pr, "
        "CASE WHEN support=0 THEN 0e0 ELSE tp/CAST(support AS DOUBLE) END AS rc FROM t)")
    + "SELECT c AS class, round(pr,6) AS precision, round(rc,6) AS recall, round(CASE WHEN pr+rc=0 THEN 0e0 ELSE 2*pr*rc/(pr+rc) END,6) AS f1, support FROM m "
    "UNION ALL SELECT 'micro', a, a, a, n FROM (SELECT round(avg(CASE WHEN y=p THEN 1 ELSE 0 END),6) AS a, count(*) AS n FROM c)",
)
def classification_report(spark, sf):
    v = vitals(spark, sf).select(rules.bp_level("SBP", "DBP").alias("y"),
                                 rules.bp_level(F.col("SBP") + 10, F.col("DBP") + 5).alias("p"))
    return metrics.class_report(v, "y", "p").select("class", *[r6(c, c) for c in ("precision", "recall", "f1")], "support")


# scores with many ties and an imperfect order
_SCORED = f"scored AS (SELECT {LABEL_SQL} AS label, floor(SBP/5e0)+floor(HR/2e1) AS score FROM vitals)"
_CUM = (
    "g AS (SELECT score, sum(label) AS pos, sum(1-label) AS neg FROM scored GROUP BY score), "
    "cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (ORDER BY score DESC)), "
    "pr AS (SELECT pos, tp/CAST(tp+fp AS DOUBLE) AS p, CASE WHEN tp+fp-pos-neg=0 THEN 1e0 ELSE (tp-pos)/CAST(tp+fp-pos-neg AS DOUBLE) END AS p0 FROM cum)"
)


def _scored(spark, sf):
    score = F.floor(F.col("SBP") / 5).cast("double") + F.floor(F.col("HR") / 20).cast("double")
    return vitals(spark, sf).select(rules.label_threshold("SBP", "DBP", "HR").alias("label"), score.alias("score"))


@query("roc_auc", cte(_SCORED, _CUM) + "SELECT round(sum(neg*(2e0*tp-pos)/2)/(sum(pos)*sum(neg)),6) AS roc_auc FROM cum")
def roc_auc(spark, sf):
    return metrics.roc_auc(_scored(spark, sf), "label", "score").select(r6("roc_auc", "roc_auc"))


@query("pr_auc", cte(_SCORED, _CUM) + "SELECT round(sum(pos*(p+p0)/2)/sum(pos),6) AS pr_auc FROM pr")
def pr_auc(spark, sf):
    return metrics.pr_auc(_scored(spark, sf), "label", "score").select(r6("pr_auc", "pr_auc"))


@query("average_precision", cte(_SCORED, _CUM) + "SELECT round(sum(pos*p)/sum(pos),6) AS average_precision FROM pr")
def average_precision(spark, sf):
    return metrics.average_precision(_scored(spark, sf), "label", "score").select(r6("average_precision", "average_precision"))


def _selector_sql():
    base = "SELECT field, '{k}' AS selector, ts_us, value FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY {o}) AS rn FROM points) WHERE rn=1"
    orders = {"last": "time DESC, reading_id DESC", "max": "value DESC, time, reading_id", "min": "value, time, reading_id"}
    parts = [base.format(k=k, o=o) for k, o in orders.items()]
    parts.append("SELECT field, 'mean', NULL, round(avg(value),6) FROM points GROUP BY field")
    return points_cte(("SBP", "DBP", "SPO2")) + " UNION ALL ".join(parts)


@query("field_selectors", _selector_sql())
def field_selectors(spark, sf):
    p = selectors.select_all(points(spark, sf, ("SBP", "DBP", "SPO2")))
    value = F.when(F.col("selector") == "mean", F.round("value", 6)).otherwise(F.col("value"))
    return p.select("field", "selector", ts_us("time").alias("ts_us"), value.alias("value"))


@query(
    "panel_reduce",
    points_cte(("SBP", "DBP", "SPO2"))
    + "SELECT field, (arg_max(value, (time, reading_id)) FILTER (value IS NOT NULL)) AS last_not_null, max(value) AS max, round(sum(value),3) AS sum "
    "FROM (SELECT * REPLACE (nullif(value,0) AS value) FROM points) GROUP BY field",
)
def panel_reduce(spark, sf):
    p = points(spark, sf, ("SBP", "DBP", "SPO2")).withColumn("value", F.nullif("value", F.lit(0.0)))
    return selectors.panel_reduce(p).select("field", "last_not_null", "max", F.round("sum", 3).alias("sum"))


@query(
    "percent_share",
    cte(f"p AS (SELECT 'Detection' AS field, {LABEL_SQL} AS v FROM vitals UNION ALL SELECT 'All records', 1 FROM vitals)")
    + "SELECT field, CAST(sum(v) AS DOUBLE) AS value, round(sum(v)/CAST((SELECT sum(v) FROM p) AS DOUBLE),6) AS share FROM p GROUP BY field",
)
def percent_share(spark, sf):
    v = vitals(spark, sf).withColumn("Detection", rules.label_threshold("SBP", "DBP", "HR")).withColumn("All records", F.lit(1))
    p = to_points(v, "detector", fields=("Detection", "All records"))
    return selectors.percent_share(p, "field", "value").select("field", "value", r6("share", "share"))


_LAST = cte(JUDGED, "c AS (SELECT DateTime, reading_id, sum(CASE WHEN pred=1 AND label=1 THEN 1 ELSE 0 END) OVER w AS TP, sum(CASE WHEN pred=0 AND label=0 THEN 1 ELSE 0 END) OVER w AS TN "
            "FROM judged WHERE patient_id = (SELECT min(patient_id) FROM judged) WINDOW w AS (ORDER BY DateTime, reading_id ROWS UNBOUNDED PRECEDING))",
            "e AS (SELECT arg_max(TP, (DateTime, reading_id)) AS TP, arg_max(TN, (DateTime, reading_id)) AS TN FROM c)")


@query("percent_share_last", _LAST + "SELECT 'TP' AS field, CAST(TP AS DOUBLE) AS value, round(TP/CAST(TP+TN AS DOUBLE),6) AS share FROM e "
       "UNION ALL SELECT 'TN', CAST(TN AS DOUBLE), round(TN/CAST(TP+TN AS DOUBLE),6) FROM e")
def percent_share_last(spark, sf):
    """Shares of the last true positive and true negative counts of one monitor."""
    j = judged(spark, sf)
    first = j.agg(F.min("patient_id")).first()[0]
    counted = running_confusion(j.filter(F.col("patient_id") == first), "label", "pred")
    p = to_points(counted, "detector", fields=("TP", "TN"), extra=("reading_id",))
    return selectors.last_share(p).select("field", "value", r6("share", "share"))


_LAST_ALL = cte(
    JUDGED,
    "c AS (SELECT patient_id, DateTime, reading_id, sum(CASE WHEN pred=1 AND label=1 THEN 1 ELSE 0 END) OVER w AS TP, sum(CASE WHEN pred=0 AND label=0 THEN 1 ELSE 0 END) OVER w AS TN "
    "FROM judged WINDOW w AS (PARTITION BY patient_id ORDER BY DateTime, reading_id ROWS UNBOUNDED PRECEDING))",
    "e AS (SELECT patient_id, arg_max(TP, (DateTime, reading_id)) AS TP, arg_max(TN, (DateTime, reading_id)) AS TN FROM c GROUP BY 1)")


@query("percent_share_patients", _LAST_ALL + " UNION ALL ".join(
    f"SELECT patient_id, '{c}' AS field, CAST({c} AS DOUBLE) AS value, CASE WHEN TP+TN=0 THEN NULL ELSE round({c}/CAST(TP+TN AS DOUBLE),6) END AS share FROM e" for c in ("TP", "TN")))
def percent_share_patients(spark, sf):
    """Shares of the last true positive and true negative counts of every monitor."""
    p = to_points(running_confusion(judged(spark, sf), "label", "pred"), "detector", ("patient_id",), ("TP", "TN"), extra=("reading_id",))
    out = selectors.last_share(p.withColumn("patient_id", F.col("tags")["patient_id"].cast("long")), within=("patient_id",))
    return out.select("patient_id", "field", "value", r6("share", "share"))


_NAMES = {"TN": "No Anomalies Detected", "TP": "Anomalies Detected"}


@query(
    "field_relabel",
    cte(JUDGED, "p AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS field, CASE WHEN pred={p} AND label={y} THEN 1 ELSE 0 END AS value, DateTime FROM judged"
        for f, p, y in (("TP", 1, 1), ("FP", 1, 0), ("TN", 0, 0))) + ")")
    + "SELECT CASE field WHEN 'TN' THEN 'No Anomalies Detected' WHEN 'TP' THEN 'Anomalies Detected' ELSE field END AS field, "
    "CAST(epoch(time_bucket(INTERVAL 1 HOUR, DateTime)) AS BIGINT)+3600 AS sec, round(avg(value),6) AS value FROM p GROUP BY 1,2",
)
def field_relabel(spark, sf):
    cells = confusion_cells("label", "pred")
    j = judged(spark, sf)
    j = j.select("DateTime", "reading_id", *[cells[c].alias(c) for c in ("TP", "FP", "TN")])
    p = to_points(j, "model", fields=("TP", "FP", "TN"), extra=("reading_id",))
    w = rules.relabel(selectors.window_agg(p, "1 hour"), "field", _NAMES)
    return w.select("field", F.unix_seconds("time").alias("sec"), r6("value", "value"))


@query("class_counter_exact", cte() + f"SELECT Class, count(*) AS n FROM (SELECT {class_sql()} AS Class FROM vitals) "
       "WHERE Class IN ('Elevated','Hypertension Stage 1','Hypertension Stage 2','Hypertensive Crisis') GROUP BY 1")
def class_counter_exact(spark, sf):
    v = vitals(spark, sf).select(rules.bp_class("SBP", "DBP").alias("Class"))
    return profile.value_counts(v, "Class", ~F.col("Class").isin("Normal", "Uncategorized"))


def _sketch_sql(item, width):
    rows = " UNION ALL ".join(
        f"SELECT {i} AS r, {item}, (h*{a}+{b})%{sketch.PRIME}%{width} AS bucket, (h*{c}+{d})%{sketch.PRIME}%2*2-1 AS sgn, n FROM items"
        for i, (a, b, c, d) in enumerate(sketch.HASHES))
    return (f"items AS (SELECT {item}, CAST('0x' || substr(md5(CAST({item} AS VARCHAR)),1,7) AS BIGINT) AS h, count(*) AS n FROM src GROUP BY 1,2), "
            f"cells AS ({rows}), sums AS (SELECT r, bucket, sum(sgn*n) AS total FROM cells GROUP BY 1,2) ")


@query(
    "count_sketch",
    cte(f"src AS (SELECT {class_sql()} AS Class FROM vitals)", _sketch_sql("Class", 64).strip())
    + "SELECT Class, median(CAST(sgn*total AS DOUBLE)) AS estimate FROM cells JOIN sums USING (r, bucket) GROUP BY Class",
)
def count_sketch(spark, sf):
    v = vitals(spark, sf).select(rules.bp_class("SBP", "DBP").alias("Class"))
    return sketch.estimate(sketch.count_sketch(v, "Class"), v, "Class")


@query(
    "count_sketch_patients",
    cte("src AS (SELECT patient_id FROM vitals)", _sketch_sql("patient_id", 64).strip())
    + "SELECT patient_id, median(CAST(sgn*total AS DOUBLE)) AS estimate FROM cells JOIN sums USING (r, bucket) GROUP BY patient_id",
)
def count_sketch_patients(spark, sf):
    v = vitals(spark, sf).select("patient_id")
    return sketch.estimate(sketch.count_sketch(v, "patient_id"), v, "patient_id")

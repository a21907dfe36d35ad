"""Queries that run as streams over the event files until all input is read."""

import time

import numpy as np
from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.ml import bayes, cluster, iforest, knn, ocsvm, trees, vote
from pulseloom.ml.forecast import DirectModel
from pulseloom.operators.clean import dedup, split_hash
from pulseloom.operators import sketch
from pulseloom.operators.joins import join_label_stream, join_labels
from pulseloom.plans.base import query
from pulseloom.plans.profiling import _sketch_sql as sketch_sql
from pulseloom.plans.vitals import (
    BAD_SBP, DECODED, JUDGED, class_sql, cte, level_sql, messages, points_cte, predicted, r6, ts_us, vitals,
)
from pulseloom.schema import MEASURES
from pulseloom.session import materialize, shared_dir
from pulseloom.sources.points import points_range, to_points
from pulseloom.sources.readers import stream_vitals
from pulseloom.sources.sinks import write_stream
from pulseloom.streaming import flows, stateful

DELAY = "2 hours"


PARTS = 5
#: Readings that a file of a stream holds about; a task reads whole files.
FILE_ROWS = 50_000


def stream(spark, sf, copies=False, late=False, closing=False):
    """Readings as a stream of PARTS micro-batches in time order.

    The readings are first written to the shared folder, in one pass. With `copies` every part repeats some readings of the
    part before; with `late` some readings of a part's last hour come with the next part; with `closing` a row without values from two
    months after the last reading comes at the end, which moves the watermark past all others.
    """
    v = vitals(spark, sf)
    fields = v.columns
    v = v.withColumn("_us", ts_us())
    cuts = v.agg(F.percentile_approx("_us", [i / PARTS for i in range(1, PARTS)], 1000)).first()[0] or [0] * (PARTS - 1)
    part = sum([(F.col("_us") > c).cast("int") for c in cuts], F.lit(0))
    if late:
        end = F.array(*[F.lit(c) for c in cuts], F.lit(1 << 62))
        part = F.when((F.col("reading_id") % 11 == 0) & (end[part] - F.col("_us") < 3_600_000_000), part + 1).otherwise(part)
    v = v.withColumn("_part", part)
    if copies:
        own, again = F.col("_part"), F.when((F.col("reading_id") % 7 == 0) & (F.col("_part") < PARTS - 1), F.col("_part") + 1)
        v = v.withColumn("_part", F.explode(F.array_compact(F.array(own, again))))
    if closing:
        last = F.max("DateTime") + F.expr("interval 60 days")
        blank = [F.lit(None).cast(v.schema[c].dataType).alias(c) for c in fields if c != "DateTime"]
        v = v.drop("_us").unionByName(v.agg(last.alias("DateTime")).select("DateTime", *blank, F.lit(PARTS).alias("_part")))
    return feed(spark, v.select(*fields, "_part"), "_part", PARTS + closing)


def feed(spark, rows, part, parts):
    """`rows` as a stream that reads one part after the other, each in a micro-batch of its own. Files are read in the order of their times.

    A part has more files the more rows it has, so that what one task sorts and writes does not grow with the input.
    """
    most = max((r[0] for r in rows.groupBy(part).agg(F.count(F.lit(1))).select("count(1)").collect()), default=0)  # a row per part
    root, files = shared_dir(spark, "feed"), max(1, spark.sparkContext.defaultParallelism // PARTS, -(-most // FILE_ROWS))
    place = F.col(part) * files + F.pmod(F.xxhash64(*[c for c in rows.columns if c != part]), F.lit(files))
    placed = rows.repartitionById(parts * files, place.cast("int")).withColumnRenamed(part, "part")
    placed.write.partitionBy("part").parquet(root)
    schema = rows.drop(part).schema
    began = int(time.time() * 1000) - 10_000 * parts
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    disk = where.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted((f for f in disk.listStatus(where) if f.getPath().getName().startswith("part=")), key=lambda f: int(f.getPath().getName()[5:]))
    for folder in folders:
        name = folder.getPath().getName()
        if folder is not folders[-1]:  # a part of few rows gets empty files, so that no micro-batch begins the next one
            for _ in range(files - sum(f.getPath().getName().endswith(".parquet") for f in disk.listStatus(folder.getPath()))):
                spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        for f in disk.listStatus(folder.getPath()):
            disk.setTimes(f.getPath(), began + 10_000 * int(name[5:]), -1)
    return stream_vitals(spark, "parquet", {"path": f"{root}/*", "maxFilesPerTrigger": str(files)}, schema)


def appended(spark, df, name):
    """Run an append stream into files and return the written table."""
    root = shared_dir(spark, name)
    write_stream(df, "parquet", {"path": f"{root}/out"}, f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def updated(spark, what, name):
    """Run a running aggregation to the end of its stream and return its rows."""
    root = shared_dir(spark, name)
    flows.keep_state(what, root).awaitTermination()
    return flows.latest(spark, what, root)


def stored_points(spark, df, make, name):
    """Run a stream through `make`, a function of a micro-batch, into the table of points and return that table."""
    root = shared_dir(spark, name)
    flows.fan_out(df, {"points": (make, f"{root}/points")}, f"{root}/checkpoint").awaitTermination()
    return spark.read.option("basePath", f"{root}/points").parquet(f"{root}/points")


_SENT = (
    "sent AS (SELECT * REPLACE (t AS DateTime) FROM decoded WHERE NOT " + BAD_SBP + ")"
)


@query(
    "stream_classify",
    cte(DECODED, f"read AS (SELECT * REPLACE (CASE WHEN {BAD_SBP} THEN NULL ELSE SBP END AS SBP) FROM decoded)")
    + f"SELECT reading_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, SBP, {level_sql()} AS BP_level FROM read",
)
def stream_classify(spark, sf):
    s = stream(spark, sf, copies=True)
    repeated = s.union(s.filter("reading_id % 5 = 0"))
    out = appended(spark, flows.classify(messages(repeated)), "classify")
    data = F.from_json("value", "reading_id long, DateTime string, SBP double, BP_level string")
    return out.select(data.alias("d")).select("d.reading_id", F.col("d.DateTime").alias("t"), "d.SBP", "d.BP_level")


@query("stream_dedup", cte() + "SELECT patient_id, reading_id, SBP, DBP FROM vitals")
def stream_dedup(spark, sf):
    s = stream(spark, sf, copies=True).select("patient_id", "reading_id", "DateTime", "SBP", "DBP")
    twice = s.union(s.filter("reading_id % 5 = 0")).union(s.filter("reading_id % 7 = 0"))
    return appended(spark, dedup(twice, event_time="DateTime", delay=DELAY), "dedup").drop("DateTime")


def _faulty(v):
    """Messages with more faults: not-a-number pressures and patients that are no whole number."""
    v = v.withColumn("SBP", F.when(F.col("reading_id") % 113 == 4, F.lit(float("nan"))).otherwise(F.col("SBP")))
    return messages(v.withColumn("patient_id", F.when(F.col("reading_id") % 109 == 3, F.lit("3.5")).otherwise(F.col("patient_id").cast("string"))))


_FAULTS = cte(
    f"f AS (SELECT *, {BAD_SBP} OR reading_id%113=4 AS bad_sbp, reading_id%109=3 AS bad_patient, reading_id%101=0 AS broken FROM vitals)")
_LETTER = "CASE WHEN broken THEN 'not JSON' WHEN bad_sbp OR bad_patient THEN 'unreadable ' || concat_ws(', ', CASE WHEN bad_sbp THEN 'SBP' END, CASE WHEN bad_patient THEN 'patient_id' END) END"


def _taken_in(spark, sf, name):
    root = shared_dir(spark, name)
    flows.ingest(_faulty(stream(spark, sf)), root, f"{root}/checkpoint").awaitTermination()
    return {t: spark.read.parquet(f"{root}/{t}") for t in ("readings", "dead_letters", "fault_counts")}


@query(
    "stream_dead_letters",
    _FAULTS + "SELECT reading_id, CASE WHEN bad_patient OR broken THEN NULL ELSE patient_id END AS patient_id, CASE WHEN bad_sbp OR broken THEN NULL ELSE SBP END AS SBP, "
    f"CASE WHEN broken THEN NULL ELSE DBP END AS DBP, {_LETTER} AS reason FROM f",
)
def stream_dead_letters(spark, sf):
    """Every message of a stream beside what its one parse wrote: the reading, and the reason for whatever is missing in it."""
    t = _taken_in(spark, sf, "dead-letters")
    at = F.coalesce(F.get_json_object("payload", "$.reading_id"), F.regexp_extract("payload", "([0-9]+)$", 1)).cast("long")
    lost = t["dead_letters"].select(at.alias("reading_id"), "reason")
    return t["readings"].select("reading_id", "patient_id", "SBP", "DBP").join(lost, "reading_id", "full").select("reading_id", "patient_id", "SBP", "DBP", "reason")


@query(
    "stream_fault_counts",
    _FAULTS + "SELECT fault, count(*) AS n FROM (SELECT unnest(list_filter(['any message', CASE WHEN broken THEN 'not JSON' END, CASE WHEN bad_sbp AND NOT broken THEN 'SBP' END, "
    "CASE WHEN bad_patient AND NOT broken THEN 'patient_id' END], lambda x: x IS NOT NULL)) AS fault FROM f) GROUP BY 1",
)
def stream_fault_counts(spark, sf):
    """How many messages have each fault, added up over the micro-batches of the same single pass."""
    return _taken_in(spark, sf, "fault-counts")["fault_counts"].groupBy("fault").agg(F.sum("n").alias("n"))


_LOSS = cte(
    "b AS (SELECT min(ts_us) AS a, max(ts_us) AS z FROM vitals)",
    f"p AS (SELECT ts_us, (ts_us-a)*{PARTS}//(z-a+1) AS part, reading_id FROM vitals, b)",
    f"s AS (SELECT ts_us, CASE WHEN reading_id%13=0 AND part<{PARTS}-2 THEN part+2 ELSE part END AS batch FROM p)",
    "m AS (SELECT batch, max(ts_us) AS top FROM s GROUP BY 1)",
    "w AS (SELECT batch, (SELECT (max(top)//1000-7200000)*1000 FROM m n WHERE n.batch<=m.batch-2) AS mark FROM m)",
)


@query(
    "stream_loss",
    _LOSS + "SELECT CAST(batch AS BIGINT) AS batch, count(*) AS sent, count(*) FILTER (mark IS NULL OR ts_us>mark) AS kept, count(*) FILTER (ts_us<=mark) AS dropped, true AS adds_up "
    "FROM s JOIN w USING (batch) GROUP BY batch",
)
def stream_loss(spark, sf):
    """Per micro-batch: rows sent, kept and dropped. Some readings come two parts late, which the watermark does not wait for."""
    v = vitals(spark, sf).withColumn("_us", ts_us())
    a, z = v.agg(F.min("_us"), F.max("_us")).first()
    part = F.expr(f"cast((_us - {a or 0}) * {PARTS} div ({(z or 0) - (a or 0)} + 1) as int)")
    part = F.when((F.col("reading_id") % 13 == 0) & (part < PARTS - 2), part + 2).otherwise(part)
    s = feed(spark, v.select("patient_id", "reading_id", "DateTime", "SBP", part.alias("_part")), "_part", PARTS)
    root, losses = shared_dir(spark, "loss"), flows.Losses()
    spark.streams.addListener(losses)
    try:
        unique = dedup(flows.arriving(s), event_time="DateTime", delay=DELAY)
        query_ = flows.fan_out(unique, {"kept": (lambda b: b, f"{root}/kept")}, f"{root}/checkpoint", name=f"loss-{root[-8:]}")
        query_.awaitTermination()
        counts = losses.table(spark, query_)
    finally:
        spark.streams.removeListener(losses)
    kept = spark.read.option("basePath", f"{root}/kept").parquet(f"{root}/kept").groupBy(F.col("batch_id").cast("long").alias("batch")).agg(F.count(F.lit(1)).alias("kept"))
    both = counts.join(kept, "batch", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    return both.select("batch", "sent", "kept", "dropped", (F.col("kept") + F.col("dropped") == F.col("sent")).alias("adds_up"))


@query("stream_restart", cte() + "SELECT patient_id, reading_id, SBP, true AS went_on FROM vitals")
def stream_restart(spark, sf):
    """A stream that stops and goes on from its checkpoint: the later half of the readings, with copies of the last hour of the
    earlier one, comes when the first run has ended. The second run knows the copies and reads no file again."""
    v = vitals(spark, sf).withColumn("_us", ts_us())
    cut = v.agg(F.percentile_approx("_us", 0.5, 1000)).first()[0] or 0
    root, batches = shared_dir(spark, "restart"), []
    for half in (F.col("_us") <= cut, F.col("_us") > cut - 3_600_000_000):
        v.filter(half).drop("_us").write.mode("append").parquet(f"{root}/in")
        s = stream_vitals(spark, "parquet", {"path": f"{root}/in"}, v.drop("_us").schema)
        run = write_stream(dedup(s, event_time="DateTime", delay=DELAY), "parquet", {"path": f"{root}/out"}, f"{root}/checkpoint")
        run.awaitTermination()
        batches.append([p["batchId"] for p in run.recentProgress if p["numInputRows"]])
    went_on = len(batches) == 2 and (not batches[0] or (batches[1] != [] and min(batches[1]) > max(batches[0])))
    return spark.read.schema(v.schema).parquet(f"{root}/out").select("patient_id", "reading_id", "SBP", F.lit(went_on).alias("went_on"))


@query("stream_score", cte(DECODED, _SENT) + "SELECT reading_id, true AS as_in_batch FROM sent")
def stream_score(spark, sf):
    """A fitted clustering applied to the stream, beside its result on the table."""
    model = cluster.kmeans_fit(vitals(spark, sf))
    scored = flows.score(messages(stream(spark, sf)), lambda df: cluster.kmeans_predict(model, df))
    got = appended(spark, scored, "score").select(F.from_json("value", "reading_id long, prediction int").alias("d")).select("d.*")
    batch = cluster.kmeans_predict(model, vitals(spark, sf)).select("reading_id", F.col("prediction").alias("batch"))
    return got.join(batch, "reading_id").select("reading_id", (F.col("prediction") == F.col("batch")).alias("as_in_batch"))


_CENTRE_SQL = "CASE WHEN (SBP-110)*(SBP-110)+(DBP-65)*(DBP-65) <= (SBP-150)*(SBP-150)+(DBP-90)*(DBP-90) THEN 0 ELSE 1 END"


@query("stream_kmeans_assign", cte(DECODED, _SENT) + f"SELECT reading_id, {_CENTRE_SQL} AS prediction FROM sent")
def stream_kmeans_assign(spark, sf):
    assign = cluster.nearest_center(("SBP", "DBP"), ((110, 65), (150, 90)))
    scored = flows.score(messages(stream(spark, sf)), lambda df: df.withColumn("prediction", assign))
    out = appended(spark, scored, "assign")
    return out.select(F.from_json("value", "reading_id long, prediction int").alias("d")).select("d.*")


@query("stream_running_min", cte() + "SELECT patient_id, m.v AS lowest, m.t AS lowest_us FROM "
       "(SELECT patient_id, min(struct_pack(v:=SPO2, t:=ts_us)) AS m FROM vitals GROUP BY 1)")
def stream_running_min(spark, sf):
    out = updated(spark, flows.running_lowest(stream(spark, sf, late=True)), "lowest")
    return out.select("patient_id", "lowest", ts_us("lowest_time").alias("lowest_us"))


def _judged_stream(spark, sf):
    s = stream(spark, sf, late=True)
    return s.withColumn("label", rules.label_online("SBP", "DBP")).withColumn("pred", predicted())


@query("stream_running_confusion", cte(JUDGED) + "SELECT patient_id, "
       + ", ".join(f"sum(CASE WHEN pred={p} AND label={y} THEN 1 ELSE 0 END) AS {n}" for n, p, y in (("TP", 1, 1), ("FP", 1, 0), ("FN", 0, 1), ("TN", 0, 0)))
       + ", count(*) AS TotalDataProcessed FROM judged GROUP BY 1")
def stream_running_confusion(spark, sf):
    return updated(spark, flows.running(flows.confusion_counts(_judged_stream(spark, sf))), "confusion")


@query("stream_running_accuracy", cte(JUDGED) + "SELECT patient_id, sum(CASE WHEN pred=label THEN 1 ELSE 0 END) AS correct, "
       "sum(CASE WHEN pred=label THEN 0 ELSE 1 END) AS wrong FROM judged GROUP BY 1")
def stream_running_accuracy(spark, sf):
    return updated(spark, flows.running(flows.accuracy_counts(_judged_stream(spark, sf))), "accuracy")


@query("stream_class_counter", cte() + f"SELECT {class_sql()} AS Class, count(*) AS n FROM vitals GROUP BY 1")
def stream_class_counter(spark, sf):
    s = stream(spark, sf).select(rules.bp_class("SBP", "DBP").alias("Class"))
    return updated(spark, flows.running(flows.class_counts(s, "Class"), ["Class"]), "classes")


@query(
    "stream_count_sketch",
    cte(f"src AS (SELECT {class_sql()} AS Class FROM vitals)", sketch_sql("Class", 64).strip())
    + "SELECT Class, median(CAST(sgn*total AS DOUBLE)) AS estimate, true AS days_add_up FROM cells JOIN sums USING (r, bucket) GROUP BY Class",
)
def stream_count_sketch(spark, sf):
    """Counts of the classes by the cells that a stream has kept, and whether the sketches of single days add up to them."""
    s = stream(spark, sf, late=True).select(rules.bp_class("SBP", "DBP").alias("Class"))
    cells = updated(spark, flows.running(sketch.count_sketch(s, "Class"), ("row", "bucket")), "sketch")
    v = vitals(spark, sf).select("DateTime", rules.bp_class("SBP", "DBP").alias("Class"))
    parts = [sketch.count_sketch(v.filter(F.dayofmonth("DateTime") % 3 == d), "Class") for d in range(3)]
    added = sketch.add(*parts).withColumnRenamed("total", "other")
    odd = cells.join(added, ["row", "bucket"], "full").filter("not total <=> other").count()
    return sketch.estimate(cells, v, "Class").withColumn("days_add_up", F.lit(odd == 0))


def _point_stream(spark, sf):
    p = to_points(stream(spark, sf, late=True), "vitals", ("patient_id",), ("SBP", "DBP"), extra=("reading_id",))
    return p.select("field", "value", "time", "reading_id")


def _window_sql(agg):
    return points_cte() + f"SELECT field, CAST(epoch(time_bucket(INTERVAL 15 MINUTE, time)) AS BIGINT)+900 AS sec, {agg} AS value FROM points GROUP BY 1,2"


def _windows(spark, sf, fn):
    out = updated(spark, flows.running_windows(_point_stream(spark, sf), DELAY, fn=fn), f"window-{fn}")
    return out.select("field", F.unix_seconds("time").alias("sec"), r6("value", "value"))


@query("stream_window_mean", _window_sql("round(avg(value),6)"))
def stream_window_mean(spark, sf):
    return _windows(spark, sf, "mean")


@query("stream_window_last", _window_sql("arg_max(value, (time, reading_id))"))
def stream_window_last(spark, sf):
    return _windows(spark, sf, "last")


@query("stream_label_join", cte() + f"SELECT reading_id, CASE WHEN reading_id%3=0 THEN NULL ELSE {level_sql()} END AS Class FROM vitals")
def stream_label_join(spark, sf):
    labels = vitals(spark, sf).filter("reading_id % 3 <> 0").select("patient_id", "DateTime", rules.bp_level("SBP", "DBP").alias("Class"))
    joined = join_labels(stream(spark, sf).select("patient_id", "DateTime", "reading_id"), labels)
    return appended(spark, joined.select("reading_id", "Class"), "labels")


@query("stream_truth_join", cte() + f"SELECT reading_id, CASE WHEN reading_id%3=0 THEN NULL ELSE {level_sql()} END AS Class FROM vitals")
def stream_truth_join(spark, sf):
    """Readings beside labels that arrive as a stream of their own, some of them late, a third of them never."""
    s = stream(spark, sf, closing=True).select("patient_id", "DateTime", "reading_id")
    truth = stream(spark, sf, late=True, closing=True).filter("coalesce(reading_id % 3 <> 0, true)")
    joined = join_label_stream(s, truth.select("patient_id", "DateTime", rules.bp_level("SBP", "DBP").alias("Class")), DELAY)
    return appended(spark, joined.select("reading_id", "Class"), "truth").filter("reading_id is not null")


@query(
    "stream_fan_out",
    cte() + "SELECT 'levels' AS sink, count(*) AS n, round(sum(SBP),3) AS total FROM vitals "
    "UNION ALL SELECT 'points', 2*count(*), round(sum(SBP)+sum(DBP),3) FROM vitals",
)
def stream_fan_out(spark, sf):
    root = shared_dir(spark, "fan-out")
    sinks = {
        "levels": (lambda b: b.select("reading_id", "SBP", rules.bp_level("SBP", "DBP").alias("BP_level")), f"{root}/levels"),
        "points": (lambda b: to_points(b, "vitals", ("patient_id",), ("SBP", "DBP")), f"{root}/points"),
    }
    flows.fan_out(stream(spark, sf), sinks, f"{root}/checkpoint").awaitTermination()
    parts = [spark.read.parquet(f"{root}/{n}").agg(F.lit(n).alias("sink"), F.count(F.lit(1)).alias("n"), F.round(F.sum(c), 3).alias("total"))
             for n, c in (("levels", "SBP"), ("points", "value"))]
    return parts[0].unionByName(parts[1])


_V10 = "OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(
    "stream_forecast",
    cte(f"f AS (SELECT reading_id, ts_us, count(*) {_V10} AS k, avg(SBP) {_V10} AS s, avg(DBP) {_V10} AS d FROM vitals WHERE SBP<>0 AND DBP<>0)")
    + "SELECT reading_id, ts_us, round(s,6) AS SBP_15, round(s,6) AS SBP_30, round(d,6) AS DBP_15, round(d,6) AS DBP_30 FROM f WHERE k=10",
)
def stream_forecast(spark, sf):
    """The model given to the stream here is the mean of the last ten readings, for every step. Some readings come late."""
    return _forecast(spark, sf, 0.0, 0.1, False)


def _forecast(spark, sf, shift, weight, scaled):
    """Forecasts by `shift` plus `weight` times every one of the last ten readings, on a stream with late readings."""
    weights = np.zeros((21, 60))
    weights[0] = shift
    weights[1:11, :30] = weights[11:, 30:] = weight
    model = DirectModel(("SBP", "DBP"), 10, 30, weights)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.use_rocksdb(spark)
    try:
        made = stateful.forecast_stream(stream(spark, sf, late=True, closing=True), model, delay=DELAY, scaled=scaled)
        out = appended(spark, made, "forecast")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return out.select("reading_id", "ts_us", *[r6(f"{c}_{h}", f"{c}_{h}") for c in ("SBP", "DBP") for h in (15, 30)])


def _scaled_back(c):
    """0.25 + 0.05 times the scaled readings of the window, scaled back by the extremes so far."""
    low, wide = f"{c}_low", f"(CASE WHEN {c}_high={c}_low THEN 1 ELSE {c}_high-{c}_low END)"
    return f"round({low}+{wide}*(0.25+0.5*({c}_mean-{low})/{wide}),6)"


_SO_FAR = "OVER (PARTITION BY patient_id ORDER BY DateTime, reading_id)"


@query(
    "stream_forecast_scaled",
    cte(f"f AS (SELECT reading_id, ts_us, count(*) {_V10} AS k, " + ", ".join(
        f"avg({c}) {_V10} AS {c}_mean, min({c}) {_SO_FAR} AS {c}_low, max({c}) {_SO_FAR} AS {c}_high" for c in ("SBP", "DBP")) + " FROM vitals WHERE SBP<>0 AND DBP<>0)")
    + "SELECT reading_id, ts_us, " + ", ".join(f"{_scaled_back(c)} AS {c}_{h}" for c in ("SBP", "DBP") for h in (15, 30)) + " FROM f WHERE k=10",
)
def stream_forecast_scaled(spark, sf):
    """Signals scaled by a patient's extremes so far before the model, and its answer scaled back, with late readings."""
    return _forecast(spark, sf, 0.25, 0.05, True)


@query(
    "forecast_latest",
    cte("p AS (SELECT patient_id, DateTime, SBP, DBP, (sec+h*60)//60 AS target FROM vitals, (SELECT unnest(range(1,31)) AS h))",
        "l AS (SELECT patient_id, target, max(struct_pack(t:=DateTime, s:=SBP, d:=DBP)) AS m FROM p GROUP BY 1,2)")
    + "SELECT patient_id, count(*) AS targets, round(sum(m.s),3) AS SBP, round(sum(m.d),3) AS DBP, max(target)*60 AS last_sec FROM l GROUP BY 1",
)
def forecast_latest(spark, sf):
    points = flows.forecast_points(flows.forecast_messages(flows.newest_per_minute(vitals(spark, sf))))
    newest = flows.forecast_latest(points)
    return newest.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("targets"), F.round(F.sum("SBP"), 3).alias("SBP"), F.round(F.sum("DBP"), 3).alias("DBP"),
        F.unix_seconds(F.max("target_time")).alias("last_sec"),
    )


def _anomaly_points(scored, measurement):
    """Scored readings as points: detection, its name, the pressures and the score."""
    out = scored.withColumn("Detection", rules.detection_flag("prediction")).withColumn("Label", rules.detection_label("prediction"))
    named = out.withColumnRenamed("score", "AnomalyScore")
    return to_points(named, measurement, ("patient_id",), ("Detection", "Label", "SBP", "DBP", "AnomalyScore"), extra=("reading_id",))


_RANGE = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
_SCORED = cte(f"r AS (SELECT * FROM vitals WHERE DateTime >= TIMESTAMP '{_RANGE[0]}' AND DateTime < TIMESTAMP '{_RANGE[1]}')")


def _live(spark, sf, model, measurement):
    """The stored points of a scored stream in a time range, beside the model's result on the table."""
    cols = ["patient_id", "reading_id", "DateTime", "SBP", "DBP"]
    points = stored_points(spark, stream(spark, sf).select(*cols), lambda b: _anomaly_points(model.transform(b), measurement), measurement)
    got = points_range(points, measurement, ["Detection", "Label", "AnomalyScore"], *_RANGE).groupBy("reading_id").agg(
        F.max(F.when(F.col("field") == "Detection", F.col("value"))).alias("d"), F.max(F.when(F.col("field") == "AnomalyScore", F.col("value"))).alias("s"),
        F.max("value_str").alias("l"))
    batch = model.transform(vitals(spark, sf).select(*cols)).select("reading_id", "score", "prediction")
    same = (F.abs(F.col("s") - F.col("score")) < 1e-9) & (F.col("d") == rules.detection_flag("prediction")) & (F.col("l") == rules.detection_label("prediction"))
    return got.join(batch, "reading_id").select("reading_id", same.alias("as_in_batch"))


@query("stream_isolation_forest", _SCORED + "SELECT reading_id, true AS as_in_batch FROM r")
def stream_isolation_forest(spark, sf):
    """Live scores of an isolation forest, stored as points."""
    return _live(spark, sf, iforest.isolation_forest(vitals(spark, sf).select("reading_id", "SBP", "DBP"), trees=50, contamination=0.03), "IsolationForest")


@query("stream_ocsvm", _SCORED + "SELECT reading_id, true AS as_in_batch FROM r")
def stream_ocsvm(spark, sf):
    """Live scores of a one-class machine, stored as points."""
    return _live(spark, sf, ocsvm.one_class_svm(vitals(spark, sf).select("reading_id", "SBP", "DBP"), nu=0.1), "OneClass")


@query("stream_vote", _SCORED + "SELECT reading_id, true AS as_in_batch FROM r")
def stream_vote(spark, sf):
    """Live soft vote of trees, naive Bayes and nearest neighbours, fitted on the whole training part, loaded from a saved
    ensemble, stored as points. As in the SQL, all readings of the range are scored, not only the test part."""
    from pulseloom.ml import store

    v = vitals(spark, sf).withColumn("label", rules.label_threshold("SBP", "DBP", "HR"))
    vote.check_labels(v)
    train = split_hash(v).filter("is_train").drop("is_train")
    fitted = vote.Ensemble({"nb": bayes.gaussian_nb(train, MEASURES), "tree": trees.decision_tree(train, MEASURES, maxDepth=5)}, knn.prepare(train))
    saved = shared_dir(spark, "ensemble")
    store.save(spark, fitted, saved)
    ensemble = store.load(spark, saved)

    def make(batch):
        return to_points(ensemble.transform(batch), "vote", ("patient_id",), ("prediction", "probability"), extra=("reading_id",))

    points = stored_points(spark, stream(spark, sf), make, "vote")
    got = points_range(points, "vote", ["prediction", "probability"], *_RANGE).groupBy("reading_id").pivot("field", ["prediction", "probability"]).agg(F.first("value"))
    batch = materialize(fitted.transform(v).select("reading_id", F.col("prediction").alias("b"), F.col("probability").alias("p")), "vote-batch")
    return got.join(batch, "reading_id").select("reading_id", ((F.col("prediction") == F.col("b")) & (F.abs(F.col("probability") - F.col("p")) < 1e-9)).alias("as_in_batch"))

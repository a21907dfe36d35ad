"""A stream gives the result of the batch: many files, copies, late rows, restarts."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulseloom.functions import rules
from pulseloom.ml import cluster
from pulseloom.ml.forecast import DirectModel
from pulseloom.operators.clean import dedup
from pulseloom.plans.vitals import judged, messages, vitals
from pulseloom.sources.readers import stream_vitals
from pulseloom.sources.sinks import debug_stream, write_stream
from pulseloom.streaming import flows, stateful
from tests.compare import spark_rows


@pytest.fixture
def files(spark, sf, tmp_path):
    """Readings in five files in time order, each ending with copies of rows of the file before."""
    v = judged(spark, sf).withColumn("part", F.ntile(5).over(Window.orderBy("DateTime")))
    parts = [v.filter(F.col("part") == p).drop("part") for p in range(1, 6)]
    path = str(tmp_path / "in")
    for i, p in enumerate(parts):
        rows = p if i == 0 else p.unionByName(parts[i - 1].orderBy(F.desc("DateTime")).limit(5))
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def source(spark, path, per_batch=1):
    schema = spark.read.parquet(path).schema
    return stream_vitals(spark, "parquet", {"path": path, "maxFilesPerTrigger": str(per_batch)}, schema)


def run(spark, df, root, name="out"):
    write_stream(df, "parquet", {"path": f"{root}/{name}"}, f"{root}/{name}-checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/{name}")


def final(spark, what, root):
    q = flows.keep_state(what, root)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 4  # several micro-batches took part
    return flows.latest(spark, what, root)


def test_classification_and_restart(spark, files, tmp_path):
    make = lambda df: flows.classify(messages(df), "30 days")
    out = run(spark, make(source(spark, files)), tmp_path)
    batch = make(spark.read.parquet(files))
    assert spark_rows(out) == spark_rows(batch)
    again = run(spark, make(source(spark, files)), tmp_path)  # same checkpoint: nothing new to read
    assert spark_rows(again) == spark_rows(batch)


def test_copies_across_batches(spark, files, tmp_path):
    out = run(spark, dedup(source(spark, files), event_time="DateTime", delay="30 days"), tmp_path)
    assert out.count() == spark.read.parquet(files).distinct().count()
    with pytest.raises(ValueError):
        dedup(source(spark, files))


def test_late_rows_do_not_reopen_a_closed_window(spark, tmp_path):
    # the bound applies from the second batch after the one that moved it
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = "reading_id long, field string, time timestamp, value double"
    for i, (minute, v) in enumerate([(1, 10.0), (200, 20.0), (201, 30.0), (2, 99.0), (195, 40.0)]):
        spark.createDataFrame([(i, "SBP", at(minute), v)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    df = stream_vitals(spark, "parquet", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"}, spark.read.parquet(str(tmp_path / "in")).schema)
    what = flows.running_windows(df, "1 hour")
    flows.keep_state(what, f"{tmp_path}/out").awaitTermination()
    got = {r["time"]: r["value"] for r in flows.latest(spark, what, f"{tmp_path}/out").collect()}
    assert got == {at(15): 10.0, at(210): 30.0}
    assert spark.read.parquet(f"{tmp_path}/out/closed").count() == 1  # the other one is still open, and only in the state


def test_counters_equal_batch(spark, files, tmp_path):
    stream, batch = source(spark, files), spark.read.parquet(files)
    for name, what, f in (("low", flows.running_lowest(stream), flows.lowest), ("conf", flows.running(flows.confusion_counts(stream)), flows.confusion_counts),
                          ("acc", flows.running(flows.accuracy_counts(stream)), flows.accuracy_counts)):
        assert spark_rows(final(spark, what, f"{tmp_path}/{name}")) == spark_rows(f(batch))


def test_a_null_key_is_one_row(spark, tmp_path):
    """Whatever the number of batches, and after a restart."""
    schema = "patient_id long, SPO2 double, DateTime timestamp, label int, pred int"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    for i in range(3):
        spark.createDataFrame([(None, 90.0 - i, at(i), 1, 1), (1, 95.0 + i, at(i), 0, i % 2)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        src = stream_vitals(spark, "parquet", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"}, spark.read.parquet(str(tmp_path / "in")).schema)
        low, counts = flows.running_lowest(src), flows.running(flows.confusion_counts(src))
        for name, what in (("low", low), ("counts", counts)):
            flows.keep_state(what, f"{tmp_path}/{name}").awaitTermination()
    got = {r["patient_id"]: (r["lowest"], r["lowest_time"]) for r in flows.latest(spark, low, f"{tmp_path}/low").collect()}
    assert flows.latest(spark, low, f"{tmp_path}/low").count() == 2 and got == {None: (88.0, at(2)), 1: (95.0, at(0))}
    rows = {r["patient_id"]: (r["TP"], r["FP"], r["TN"], r["TotalDataProcessed"]) for r in flows.latest(spark, counts, f"{tmp_path}/counts").collect()}
    assert rows == {None: (3, 0, 0, 3), 1: (0, 1, 2, 3)}


def test_every_lost_value_has_a_reason(spark):
    """A value that was in the message and is not in the reading is in its faults, whatever the cast that lost it."""
    from pulseloom.sources import codecs

    names = ["patient_id", "reading_id", "SBP", "DBP", "HR"]
    values = ["1", "3.5", "NaN", "abc", "", "-Infinity", "1e400", " 7 ", "9223372036854775808", "null"]
    sent = [dict(zip(names, [v, "1", w, "80", x])) | {"DateTime": t} for v, w, x in zip(values, values[2:] + values[:2], values[5:] + values[:5]) for t in ("2024-01-01 00:00", "yesterday")]
    texts = [json.dumps(m) for m in sent] + ["[1]", "{", None, "5", "{}"]
    read = codecs.checked(spark.createDataFrame([(t,) for t in texts], "value string")).cache()
    assert read.count() == len(texts)
    for r in read.collect():
        if codecs.NOT_JSON in r["_faults"]:
            assert r["_faults"] == [codecs.NOT_JSON] and all(r[c] is None for c in names)
        else:
            m = json.loads(r["_payload"])
            assert sorted(r["_faults"]) == sorted(c for c in (*names, "DateTime") if m.get(c) is not None and r[c] is None)
    plain = flows.readings(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert spark_rows(codecs.good_readings(read).select(plain.columns)) == spark_rows(plain)
    lost = {r["fault"]: r["n"] for r in codecs.fault_counts(read).collect()}
    assert lost["any message"] == len(texts) and lost["DateTime"] == 10 and lost["patient_id"] >= 6


def test_intake_writes_three_tables_in_one_pass(spark, files, tmp_path):
    msgs = messages(source(spark, files))
    root = str(tmp_path / "in3")
    for _ in range(2):  # the second start finds nothing new
        flows.ingest(msgs, root, f"{root}/checkpoint").awaitTermination()
    batch = messages(spark.read.parquet(files))
    from pulseloom.sources import codecs

    good, bad, counts = (spark.read.parquet(f"{root}/{t}").drop("batch_id") for t in ("readings", "dead_letters", "fault_counts"))
    assert spark_rows(good) == spark_rows(flows.readings(batch).select(good.columns)) and spark_rows(bad) == spark_rows(codecs.dead_letters(batch).select(bad.columns))
    assert spark_rows(counts.groupBy("fault").agg(F.sum("n").alias("n"))) == spark_rows(codecs.fault_counts(codecs.checked(batch)))


def test_fan_out_overwrites_a_repeated_batch(spark, sf, tmp_path):
    from pulseloom.sources.sinks import batch_writer

    v = vitals(spark, sf).limit(20)
    write = batch_writer({"a": (lambda b: b, f"{tmp_path}/a"), "b": (lambda b: b.select("SBP"), f"{tmp_path}/b")})
    write(v, 0)
    write(v, 0)
    write(v, 1)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 40 == spark.read.parquet(f"{tmp_path}/b").count()


def test_scoring_with_a_fitted_model(spark, files, tmp_path):
    model = cluster.kmeans_fit(spark.read.parquet(files))
    make = lambda df: flows.score(messages(df), lambda x: cluster.kmeans_predict(model, x))
    assert spark_rows(run(spark, make(source(spark, files)), tmp_path)) == spark_rows(make(spark.read.parquet(files)))


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.use_rocksdb(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def mean_model(n):
    weights = np.zeros((2 * n + 1, 60))
    weights[1 : n + 1, :30] = weights[n + 1 :, 30:] = 1 / n
    return DirectModel(("SBP", "DBP"), n, 30, weights)


READING = "patient_id long, reading_id long, DateTime timestamp, SBP double, DBP double"


def minute(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


@pytest.mark.parametrize("scaled,waiting", [(False, 2000), (True, 2000), (False, 3), (True, 0)])
def test_forecasts_in_event_time_order(spark, sf, tmp_path, rocksdb, monkeypatch, scaled, waiting):
    """Shuffled readings, restarts between the batches, waiting readings in one value or in the map: the stream equals the batch."""
    monkeypatch.setattr(stateful, "MAX_WAITING", waiting)
    v = vitals(spark, sf).filter("patient_id % 3 = 0").select("patient_id", "reading_id", "DateTime", "SBP", "DBP").cache()
    rows = sorted(map(tuple, v.collect()), key=lambda r: (r[2] + dt.timedelta(minutes=r[1] * 7919 % 2800), r[1]))  # up to two days late
    size = -(-len(rows) // 3)
    for i in range(3):
        some = rows[i * size : (i + 1) * size] + ([(None, None, dt.datetime(2025, 1, 1), None, None)] if i == 2 else [])
        spark.createDataFrame(some, READING).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        src = stream_vitals(spark, "parquet", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"}, v.schema)
        out = run(spark, stateful.forecast_stream(src, mean_model(3), delay="3 days", block_seconds=86_400, scaled=scaled), tmp_path, "fc")
    w = "over (partition by patient_id order by DateTime, reading_id rows between 2 preceding and current row)"
    want = v.filter("SBP <> 0 and DBP <> 0").selectExpr("reading_id", f"count(*) {w} k", f"round(avg(SBP) {w}, 6) s", f"round(avg(DBP) {w}, 6) d")
    assert spark_rows(want.filter("k = 3").drop("k")) == spark_rows(out.selectExpr("reading_id", "round(SBP_15, 6) s", "round(DBP_30, 6) d"))


@pytest.mark.parametrize("scaled", [False, True])
def test_patients_of_a_bucket_are_forecast_apart(spark, sf, tmp_path, rocksdb, monkeypatch, scaled):
    """Any number of patients share the calls of the state store: one bucket or many give the same rows."""
    v = vitals(spark, sf).select("patient_id", "reading_id", "DateTime", "SBP", "DBP")
    v.unionByName(spark.createDataFrame([(None, None, dt.datetime(2025, 1, 1), None, None)], READING)).repartition(3).write.parquet(str(tmp_path / "in"))
    got = []
    for buckets in (1, 7):
        src = stream_vitals(spark, "parquet", {"path": str(tmp_path / "in")}, v.schema)
        made = stateful.forecast_stream(src, mean_model(2), scaled=scaled, buckets=buckets)
        got.append(run(spark, made, tmp_path, f"fc{buckets}").selectExpr("patient_id", "reading_id", "ts_us", "round(SBP_15, 6)", "round(DBP_30, 6)"))
    assert got[0].count() > 0 and spark_rows(got[0]) == spark_rows(got[1])


def test_files_of_a_stream_hold_few_rows(spark, sf, tmp_path, monkeypatch):
    """The more rows a part has, the more files it has; a part is a micro-batch all the same."""
    from pulseloom.plans import streams

    monkeypatch.setattr(streams, "FILE_ROWS", 20)
    monkeypatch.setattr(streams, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    v = vitals(spark, sf)
    out = streams.feed(spark, v.withColumn("_part", F.when(F.col("reading_id") < 3, 1).otherwise(F.when(F.col("reading_id") % 2 == 0, 0).otherwise(2))), "_part", 3)
    written = spark.read.parquet(str(tmp_path / "feed")).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert written < 3 * 20
    seen = []
    q = out.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    n = v.count()
    assert seen == [v.filter("reading_id >= 3 and reading_id % 2 = 0").count(), 3, n - 3 - v.filter("reading_id >= 3 and reading_id % 2 = 0").count()]


def test_scaling_equals_running_minmax(spark, sf, tmp_path, rocksdb):
    """The model sees what `running_minmax` says of the batch, and `unscale` undoes it."""
    from pulseloom.operators.timeseries import running_minmax, unscale

    weights = np.zeros((3, 60))
    weights[0], weights[1, :30], weights[2, 30:] = 0.125, 0.5, 0.25  # one lag of each signal
    model = DirectModel(("SBP", "DBP"), 1, 30, weights)
    v = vitals(spark, sf).filter("patient_id % 4 = 1").select("patient_id", "reading_id", "DateTime", "SBP", "DBP")
    v.unionByName(spark.createDataFrame([(None, None, dt.datetime(2025, 1, 1), None, None)], READING)).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = stream_vitals(spark, "parquet", {"path": str(tmp_path / "in")}, v.schema)
    out = run(spark, stateful.forecast_stream(src, model, scaled=True), tmp_path, "fc").selectExpr("reading_id", "round(SBP_15, 6) s", "round(DBP_30, 6) d")
    scaled = running_minmax(v.filter("SBP <> 0 and DBP <> 0")).withColumn("s", 0.125 + 0.5 * F.col("SBP_scaled")).withColumn("d", 0.125 + 0.25 * F.col("DBP_scaled"))
    want = scaled.select("reading_id", F.round(unscale("s", "SBP_min", "SBP_max"), 6).alias("s"), F.round(unscale("d", "DBP_min", "DBP_max"), 6).alias("d"))
    assert spark_rows(out) == spark_rows(want)


def test_a_late_reading_changes_the_windows_after_it(spark, tmp_path, rocksdb):
    row = lambda i: (1, i, minute(i), 90.0 + i * i, 60.0)
    root = str(tmp_path / "in")
    losses = flows.Losses()
    spark.streams.addListener(losses)
    for batch in ([1, 2, 4, 5], [3, 6], [400], [401], [7, 900], [2000]):  # 7 comes when the watermark has passed it
        spark.createDataFrame([row(i) for i in batch], READING).coalesce(1).write.mode("append").parquet(root)
    src = stream_vitals(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, spark.read.parquet(root).schema)
    made = stateful.forecast_stream(flows.arriving(src), mean_model(3), delay="1 hour")
    q = made.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").queryName("late").trigger(availableNow=True).start()
    q.awaitTermination()
    counts = losses.table(spark, q).agg(F.sum("sent"), F.sum("dropped")).first()
    spark.streams.removeListener(losses)
    got = {r["reading_id"]: r["SBP_15"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    mean = lambda *ids: pytest.approx(sum(90.0 + i * i for i in ids) / len(ids))
    assert got == {3: mean(1, 2, 3), 4: mean(2, 3, 4), 5: mean(3, 4, 5), 6: mean(4, 5, 6), 400: mean(5, 6, 400), 401: mean(6, 400, 401), 900: mean(400, 401, 900)}
    assert tuple(counts) == (11, 1)


def test_truth_that_arrives_as_a_stream(spark, tmp_path):
    """Late truth inside the delay is joined, of several the first; missing truth gives one row; so does a reading without a key."""
    from pulseloom.operators.joins import join_label_stream

    readings = [[(1, 1, minute(1)), (1, 2, minute(2)), (None, 3, minute(2))], [(1, 4, minute(50)), (2, 5, minute(50))], [(None, None, minute(900))], [(None, None, minute(2000))]]
    truth = [[(1, minute(1), "a")], [(1, minute(2), "b"), (1, minute(50), "c"), (1, minute(50), "d")], [(None, minute(900), "z")], [(1, minute(3), "late"), (None, minute(2000), "z")]]
    for name, batches, schema in (("r", readings, "patient_id long, reading_id long, DateTime timestamp"), ("t", truth, "patient_id long, DateTime timestamp, Class string")):
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    r, t = (stream_vitals(spark, "parquet", {"path": f"{tmp_path}/{n}", "maxFilesPerTrigger": "1"}, spark.read.parquet(f"{tmp_path}/{n}").schema) for n in "rt")
    out = run(spark, join_label_stream(r, t, "2 hours"), tmp_path, "truth").filter("reading_id is not null").collect()
    got = sorted((x["reading_id"], x["Class"]) for x in out)
    assert [i for i, _ in got] == [1, 2, 3, 4, 5] and dict(got) | {4: "c"} == {1: "a", 2: "b", 3: None, 4: "c", 5: None} and dict(got)[4] in ("c", "d")


def test_unreadable_values_are_on_record(spark):
    from pulseloom.sources.codecs import dead_letters

    sent = ['{"reading_id":"1","DateTime":"2024-01-01 00:01:00","SBP":"120","DBP":"80"}', '{"reading_id":"2","Timestamp":"01/01/2024 00:01","SBP":"120","DBP":"80"}',
            '{"reading_id":"3","DateTime":"2024-01-01 00:01","SBP":"abc","DBP":""}', "nothing", None, '{"reading_id":"6","SBP":"1"}']
    df = spark.createDataFrame([(s,) for s in sent], "value string")
    got = {(r["payload"], r["reason"]) for r in dead_letters(df).collect()}
    assert got == {(sent[1], "unreadable DateTime"), (sent[2], "unreadable SBP, DBP"), ("nothing", "not JSON"), (None, "not JSON")}
    kept = {r["reading_id"]: r["SBP"] for r in flows.readings(df).collect()}
    assert kept == {1: 120.0, 2: 120.0, 3: None, 6: 1.0}


def test_the_level_in_a_message_is_the_level_of_the_reading(spark, sf):
    v = vitals(spark, sf)
    data = F.from_json("value", "reading_id long, BP_level string").alias("d")
    got = flows.classify(messages(v)).select(data).select("d.*")
    read = v.withColumn("SBP", F.expr("if(reading_id % 103 = 1 or reading_id % 107 = 2, null, SBP)"))  # planted unreadable values
    want = read.select("reading_id", rules.bp_level("SBP", "DBP").alias("w"))
    assert got.join(want, "reading_id").filter("BP_level <> w").count() == 0
    assert got.count() == v.filter("reading_id % 101 <> 0").count()


def test_debug_stream(spark, files, tmp_path):
    with pytest.raises(ValueError):
        debug_stream(source(spark, files), "")
    q = debug_stream(source(spark, files).select("reading_id"), str(tmp_path / "cp"), trigger={"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 4


def test_vote_is_fitted_on_the_whole_training_part(spark, sf, monkeypatch):
    from pulseloom.operators.clean import split_hash
    from pulseloom.plans import streams

    class Seen(Exception):
        pass

    def prepare(train):
        raise Seen(sorted(r.reading_id for r in train.select("reading_id").collect()))

    monkeypatch.setattr(streams.knn, "prepare", prepare)
    with pytest.raises(Seen) as seen:
        streams.stream_vote(spark, sf)
    assert seen.value.args[0] == sorted(r.reading_id for r in split_hash(vitals(spark, sf)).filter("is_train").select("reading_id").collect())

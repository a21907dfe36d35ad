"""Hand-made tables for repair, windows, profiles, measures, points and joins."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import clean, joins, metrics, profile, selectors, sketch, timeseries
from pulseloom.schema import MEASURES, VITALS
from pulseloom.sources import points as pts
from pulseloom.sources.codecs import cast_vitals, decode, encode_kv, normalize_aliases, parse_line_protocol
from pulseloom.sources.readers import nan_to_null, read_vitals, source_options
from pulseloom.sources.sinks import write_csv, write_points, write_stream

T0 = dt.datetime(2020, 10, 18, 15, 24, 25)
SBP = [0, 98.9, 97.9, 97.2, 96, 95.5, 94.8, 93.3, 92.8, 88.9, 93.2, 93, 93.1, 92.8, 94.6, 97.1, 96.2, 96, 94.1, 91.2]


def series(spark, values, col="SBP", patient=1, step=60):
    rows = [(patient, i, T0 + dt.timedelta(seconds=step * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"patient_id long, reading_id long, DateTime timestamp, {col} double")


def column(df, name, order="reading_id"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_rolling_mean_of_the_printed_rows(spark):
    five = [0, 49.45, 65.6, 73.5, 78, 80.9167, 96.7167, 95.7833, 94.9333, 93.55, 93.0833, 92.6667, 92.3833, 92.3, 92.6, 93.9667, 94.4667, 94.9667, 95.1333, 94.8667]
    got = column(timeseries.rolling_mean(series(spark, SBP), ["SBP"]), "SBP_RollingAvg")
    assert got == pytest.approx(five, abs=5e-5)
    hour = column(timeseries.rolling_mean(series(spark, SBP), ["SBP"], seconds=3600), "SBP_RollingAvg")
    assert (hour[1], hour[6], hour[19]) == pytest.approx((49.45, 82.9, 89.83))


def test_imputation_of_the_first_row(spark):
    df = series(spark, SBP).withColumn("DBP", F.lit(60.0)).withColumn("HR", F.lit(106.9)).withColumn("SPO2", F.lit(99.9))
    assert column(clean.impute_zero_neighbors(df), "SBP")[:2] == [49.45, 98.9]


def test_imputation_at_the_end_and_without_signal(spark):
    df = series(spark, [100, 0, 0]).withColumn("DBP", F.lit(60.0)).withColumn("SPO2", F.lit(99.0))
    alive = clean.impute_zero_neighbors(df.withColumn("HR", F.lit(80.0)))
    assert column(alive, "SBP") == [100, 50, None]
    dead = clean.impute_zero_neighbors(df.withColumn("HR", F.lit(0.0)))
    assert column(dead, "SBP") == [100, 0, 0]


def test_interpolation(spark):
    df = series(spark, [0, 0, 10, 0, 30, 0, 0, 0, 70, None, 0])
    assert column(clean.interpolate_zeros(df, ["SBP"]), "SBP") == [10, 10, 10, 20, 30, 40, 50, 60, 70, 70, 70]


def test_interpolation_of_a_series_without_values(spark):
    df = series(spark, [0, 0]).union(series(spark, [10, 20], patient=2))
    assert column(clean.interpolate_zeros(df, ["SBP"]), "SBP", ["patient_id", "reading_id"]) == [15, 15, 10, 20]


def test_dedup_is_idempotent(spark):
    df = series(spark, SBP)
    once = clean.dedup(df.union(df))
    assert once.count() == len(SBP) == clean.dedup(once).count()


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0, None, 1.0), (1.0, None, None, 2.0)], "a double, b double, c double, d double")
    got = {r["column"]: r["constant"] for r in profile.constant_columns(df, "abcd").collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False}
    assert profile.drop_constant_columns(df, "abcd").columns == ["b", "d"]


def test_high_correlation_drops_the_later_column(spark):
    df = spark.range(100).selectExpr("id * 1.0 a", "id * -2.0 + 1 b", "pmod(id * 7919, 31) * 1.0 c")
    assert profile.drop_high_corr(df, ("a", "b", "c")).columns == ["a", "c"]


def test_correlation_with_missing_values(spark):
    rows = [(float(i), float(i * i % 17), None if i % 5 == 0 else float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    plain = df.select(F.corr("a", "b"), F.corr("a", "c"), F.corr("b", "c")).first()
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.corr_long(df, ("a", "b", "c")).collect()}
    assert (got["a", "b"], got["a", "c"], got["c", "b"]) == pytest.approx(tuple(plain))
    full = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.corr_long(df, ("a", "b")).collect()}
    assert full["a", "b"] == pytest.approx(plain[0])


def test_describe_and_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "a double")
    r = profile.describe(df, ["a"]).first()
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (3, 1, 1.5, 2, 3, 4)
    assert profile.missing(df, ["a"]).first()["percent"] == 25


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    counts = [r["n"] for r in profile.histogram(df, ["a"], 4).orderBy("bin").collect()]
    assert sum(counts) == 2 and counts[2] == 2


def scored(spark, rows):
    return spark.createDataFrame([(y, float(s)) for y, s in rows], "label int, score double")


@pytest.mark.parametrize("rows,roc", [
    ([(1, 3), (1, 2), (0, 1), (0, 0)], 1.0), ([(0, 3), (0, 2), (1, 1)], 0.0), ([(1, 1), (0, 1), (1, 1), (0, 1)], 0.5),
])
def test_auc(spark, rows, roc):
    assert metrics.roc_auc(scored(spark, rows), "label", "score").first()[0] == roc


def test_auc_of_one_class_is_empty(spark):
    assert metrics.roc_auc(scored(spark, [(1, 1), (1, 2)]), "label", "score").first()[0] is None


def test_auc_of_score_and_negated_score_add_up_to_one(spark):
    rows = scored(spark, [(i * 7 % 3 % 2, i * 13 % 11) for i in range(50)])
    up = metrics.roc_auc(rows, "label", "score").first()[0]
    down = metrics.roc_auc(rows.withColumn("score", -F.col("score")), "label", "score").first()[0]
    assert up + down == pytest.approx(1)


def test_average_precision_by_hand(spark):
    rows = scored(spark, [(1, 4), (0, 3), (1, 2), (0, 1)])
    assert metrics.average_precision(rows, "label", "score").first()[0] == pytest.approx((1 + 2 / 3) / 2)
    assert metrics.pr_auc(rows, "label", "score").first()[0] == pytest.approx((1 + (0.5 + 2 / 3) / 2) / 2)


def test_report_and_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "y string, p string")
    assert sum(r["n"] for r in metrics.confusion(df, "y", "p").collect()) == 4
    got = {r["class"]: tuple(r)[1:] for r in metrics.class_report(df, "y", "p").collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0.0, 0.0, 0.0, 1) and got["micro"] == (0.5, 0.5, 0.5, 4)


def test_rolling_score_uses_the_window_a_row_opens(spark):
    values = [1, 2, 3, 4, 10, 6]
    got = column(timeseries.rolling_score(series(spark, values), ["SBP"]), "score")
    z = lambda x, w: abs(x - sum(w) / 5) / math.sqrt(sum((v - sum(w) / 5) ** 2 for v in w) / 4)
    first, last = values[:5], values[1:]
    assert got == pytest.approx([z(1, first)] + [z(v, last) for v in values[1:]])
    assert column(timeseries.rolling_score(series(spark, [7] * 5), ["SBP"]), "score") == [0] * 5
    assert column(timeseries.rolling_score(series(spark, [7, 8]), ["SBP"]), "score") == [None, None]


def test_supervised_windows_sizes(spark):
    got = timeseries.supervised_windows(series(spark, range(1, 51)), cols=("SBP",)).orderBy("reading_id").collect()
    assert [r["reading_id"] for r in got] == list(range(9, 20))
    assert [e[0] for e in got[0]["x"]] == list(range(1, 11)) and [e[0] for e in got[0]["y"]] == list(range(11, 41))


def test_running_minmax_round_trip(spark):
    out = timeseries.running_minmax(series(spark, [5, 5, 9, 1]), ["SBP"])
    assert column(out, "SBP_scaled") == [0, 0, 1, 0]
    assert column(out.withColumn("b", timeseries.unscale("SBP_scaled", "SBP_min", "SBP_max")), "b") == [5, 5, 9, 1]


def test_selectors_and_windows(spark):
    p = pts.to_points(series(spark, [3, 9, 9, 1]), "m", fields=("SBP",), extra=("reading_id",))
    at = lambda k: (T0 + dt.timedelta(minutes=k))
    for kind, want in (("last", (at(3), 1.0)), ("max", (at(1), 9.0)), ("min", (at(3), 1.0))):
        r = selectors.select_point(p, kind).first()
        assert (r["time"], r["value"]) == want
    stop = "2020-10-18 15:27:00"
    w = selectors.window_agg(p, "2 minutes", "mean", stop=stop).orderBy("time").collect()
    assert [(r["time"].strftime("%H:%M:%S"), r["value"]) for r in w] == [("15:26:00", 6.0), ("15:27:00", 9.0)]
    assert selectors.downsample(p, 2).count() <= 2
    share = {r["field"]: r["share"] for r in selectors.percent_share(p.withColumn("field", F.concat("field", F.col("reading_id") % 2)), "field", "value").collect()}
    assert sum(share.values()) == pytest.approx(1)


def test_sketches_add_up_and_shuffle_few_rows(spark):
    """The sketch of all rows is the sum of the sketches of their parts; a task gives at most depth x width cells."""
    df = spark.range(20_000).selectExpr("concat('i', id * id % 7919) c", "id % 4 p").repartition(5).cache()
    whole = {(r["row"], r["bucket"]): r["total"] for r in sketch.count_sketch(df, "c").collect()}
    parts = sketch.add(*[sketch.count_sketch(df.filter(F.col("p") == p), "c") for p in range(4)])
    assert {(r["row"], r["bucket"]): r["total"] for r in parts.collect()} == whole
    plan = sketch.count_sketch(df, "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row") == 1 and "partial_sum" in plan
    assert sketch.count_sketch(spark.createDataFrame([(None,)], "c string"), "c").count() == 0


def test_last_shares_within_a_monitor(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(1, "TP", 1.0, at(1)), (1, "TP", 3.0, at(2)), (1, "TN", 1.0, at(2)), (2, "TP", 5.0, at(3)), (None, "TN", 0.0, at(1)), (None, "TP", None, at(2))]
    p = spark.createDataFrame(rows, "monitor long, field string, value double, time timestamp")
    got = {(r["monitor"], r["field"]): (r["value"], r["share"]) for r in selectors.last_share(p, within=("monitor",)).collect()}
    assert got == {(1, "TP"): (3.0, 0.75), (1, "TN"): (1.0, 0.25), (2, "TP"): (5.0, 1.0), (None, "TN"): (0.0, None)}
    assert {r["field"]: r["value"] for r in selectors.last_share(p).collect()} == {"TP": 5.0, "TN": 1.0}


def test_bucketed_labels_are_not_shuffled(spark):
    labels = spark.range(1000).selectExpr("id patient_id", "id % 5 Class").repartition(3)
    table = joins.bucketed(labels, ["patient_id"], "labels")
    plan = spark.range(500).selectExpr("id patient_id").repartition(4).hint("merge").join(table, "patient_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and table.count() == 1000


def test_count_sketch_is_exact_without_collisions(spark):
    df = spark.createDataFrame([("a",)] * 7 + [("b",)] * 2, "c string")
    got = {r["c"]: r["estimate"] for r in sketch.estimate(sketch.count_sketch(df, "c", width=4096), df, "c", width=4096).collect()}
    assert got == {"a": 7, "b": 2}


def test_messages(spark):
    good = '{"RR":"15.3","SPO2":"100","MAP":"71","SBP":"93.1","DBP":"59.8","HR":"104.2","PP":"33.3","CO":"3469.86"}'
    payloads = [good, "not json", good.replace("93.1", "abc"), good.replace("93.1", ""), good.replace('"SBP":"93.1",', ""), None,
                good.replace('"RR"', '"DATETIME":"2020-10-24 21:37","RR"'), good.replace('"RR"', '"TimeStamp":"2020-10-18 15:24:25","RR"').replace("SPO2", "SPO")]
    messages = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "offset int, value string")
    ok, bad = decode(messages)
    assert sorted(r["offset"] for r in bad.collect()) == [1, 5]
    typed = {r["offset"]: r for r in cast_vitals(normalize_aliases(ok)).collect()}
    assert sorted(typed) == [0, 6, 7]
    assert typed[0]["SBP"] == 93.1 and typed[0]["DateTime"] is None
    assert typed[6]["DateTime"] == dt.datetime(2020, 10, 24, 21, 37)
    assert typed[7]["DateTime"] == T0 and typed[7]["SPO2"] == 100
    again = encode_kv(normalize_aliases(ok).filter("offset = 0"), ["DateTime"], list(MEASURES)).first()
    assert tuple(again) == ("{}", good)


def test_numbers_that_are_not_numbers(spark):
    df = spark.createDataFrame([(float("nan"), "NaN")], "a double, b string")
    r = nan_to_null(df.withColumn("b", F.col("b").try_cast("double"))).first()
    assert tuple(r) == (None, None)


def test_line_protocol(spark):
    lines = ['bp,host=a\\ b,unit=icu SBP=93.5,n=4i,ok=true,note="x, \\"y\\" =z" 1603034665000000000', "cpu idle=1e2", "# comment", "broken"]
    got = parse_line_protocol(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    by = {(r["measurement"], r["field"]): r for r in got}
    assert len(got) == 5
    assert by["bp", "SBP"]["value"] == 93.5 and by["bp", "n"]["value"] == 4 and by["bp", "ok"]["value"] == 1
    assert by["bp", "note"]["value_str"] == 'x, "y" =z' and by["bp", "note"]["tags"] == {"host": "a b", "unit": "icu"}
    assert by["bp", "SBP"]["time"] == T0 and by["cpu", "idle"]["time"] is None and by["cpu", "idle"]["value"] == 100


def test_csv_round_trip(spark, tmp_path):
    df = series(spark, SBP).select("patient_id", "reading_id", "DateTime", *[F.col("SBP").alias(c) for c in MEASURES])
    write_csv(df.repartition(3), str(tmp_path / "csv"))
    back = read_vitals(spark, str(tmp_path / "csv"), "csv")
    assert back.schema == VITALS and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_points_table_prunes_by_date(spark, tmp_path):
    p = pts.to_points(series(spark, SBP, step=7200), "m", fields=("SBP",))
    write_points(p, str(tmp_path / "points"))
    stored = spark.read.parquet(str(tmp_path / "points"))
    part = pts.points_range(stored, "m", ["SBP"], "2020-10-19 00:00:00", "2020-10-19 06:00:00")
    want = [v for i, v in enumerate(SBP) if dt.datetime(2020, 10, 19) <= T0 + dt.timedelta(hours=2 * i) < dt.datetime(2020, 10, 19, 6)]
    assert [r["value"] for r in part.orderBy("time").collect()] == want
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(measurement" in plan and "date" in plan.split("PartitionFilters")[1][:200]


def test_join_forecast(spark):
    actual = series(spark, [10, 11, 12, 13])
    fc = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=s)) for s in (0, 30, 89, 91, 400)], "patient_id long, target_time timestamp")
    got = joins.join_forecast(fc, actual, "SBP", tolerance=60).orderBy("target_time").collect()
    assert [r["actual"] for r in got] == [10, 10, 11, 13 - 1]
    minute = joins.join_forecast(fc, actual, "SBP").orderBy("target_time").collect()
    assert [r["actual"] for r in minute] == [10, 10, 11, 11]


def test_labels_keep_readings_without_label(spark):
    df = series(spark, [1, 2])
    labels = df.filter("reading_id = 1").select("patient_id", "DateTime", F.lit("x").alias("Class"))
    assert column(joins.join_labels(df, labels), "Class") == [None, "x"]


def test_broker_options(spark):
    o = source_options("kafka", {"kafka.bootstrap.servers": "h:1", "subscribe": "t"})
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    with pytest.raises(ValueError):
        source_options("kafka", {"subscribe": "t"})
    with pytest.raises(ValueError):
        write_stream(None, "kafka", {}, "c")
    with pytest.raises(ValueError):
        write_stream(None, "parquet", {}, "")


def test_frequent_keys_are_joined_apart(spark):
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, if(id % 5 = 0, null, id % 40)) k")
    right = spark.range(30).selectExpr("id k", "id * 10 v")
    assert [r["k"] for r in joins.frequent_keys(left, ["k"], 900).collect()] == [0]
    for how in ("left", "inner"):
        plain, apart = left.join(right, "k", how), joins.join_skewed(left, right, ["k"], how, limit=900)
        assert sorted(map(str, plain.collect())) == sorted(map(str, apart.collect()))
    plan = joins.join_skewed(left, right, ["k"], limit=900)._jdf.queryExecution().toString()
    assert "Union" in plan and "LeftAnti" in plan


def test_one_label_per_key(spark):
    from pulseloom.operators.joins import join_labels

    df = spark.createDataFrame([(1, 5, "x"), (1, 6, "y")], "patient_id long, DateTime long, v string")
    labels = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 5, "b")], "patient_id long, DateTime long, Class string")
    assert sorted(map(tuple, join_labels(df, labels).select("v", "Class").collect())) == [("x", "a"), ("y", None)]


def test_latest_rows_need_no_sorting(spark):
    from pulseloom.operators.selectors import panel_reduce, window_agg

    p = spark.range(100).selectExpr("'m' measurement", "'f' field", "timestamp_seconds(id div 2) time", "id reading_id", "id * 1.0D value")
    for df in (window_agg(p, "10 seconds", "last"), panel_reduce(p)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert panel_reduce(p).first()["last_not_null"] == 99


def test_rolling_means_keep_rows_without_a_time(spark):
    from pulseloom.operators.timeseries import rolling_mean

    df = spark.range(1000).selectExpr("id reading_id", "id % 3 patient_id", "if(id % 10 = 0, null, timestamp_seconds(id * 7)) DateTime", "id * 1.0D SBP")
    a, b = (rolling_mean(df, ["SBP"], 60, dense=d) for d in (10**9, 0))
    rows = [{r["reading_id"]: r["SBP_RollingAvg"] for r in x.collect()} for x in (a, b)]
    assert len(rows[0]) == 1000 and rows[0].keys() == rows[1].keys()
    assert all((x is None) == (rows[1][i] is None) and (x is None or abs(x - rows[1][i]) < 1e-9) for i, x in rows[0].items())
    assert all((rows[0][i] is None) == (i % 10 == 0) for i in rows[0])

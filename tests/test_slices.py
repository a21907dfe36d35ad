"""Long series are cut into slices; the results must not depend on it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import clean, joins, timeseries
from pulseloom.operators.slices import slicing, with_position
from pulseloom.plans.vitals import judged, vitals
from tests.compare import spark_rows

CUT = 60


@pytest.fixture(scope="module")
def skewed(spark, sf):
    """One patient with a third of the rows, many of them at one instant, and copies."""
    v = judged(spark, sf)
    hot = F.col("reading_id") % 3 == 0
    v = v.withColumn("patient_id", F.when(hot, 1).otherwise(F.col("patient_id") % 5 + 10).cast("long"))
    instant = F.lit(dt.datetime(2024, 1, 9, 3, 4, 5))
    v = v.withColumn("DateTime", F.when(hot & (F.col("reading_id") % 2 == 0), instant).otherwise(F.col("DateTime")))
    v = v.withColumn("SPO2", F.when(F.col("reading_id") % 7 == 0, None).otherwise(F.col("SPO2")))
    return v.repartition(5).cache()


def test_slices_are_bounded_and_contiguous(skewed):
    s = slicing(skewed, ["patient_id"], ["DateTime", "reading_id"], CUT)
    assert s.split
    sizes = s.assign(skewed).groupBy(*s.keys).agg(
        F.count("*").alias("n"), F.min(F.struct("DateTime", "reading_id")).alias("a"), F.max(F.struct("DateTime", "reading_id")).alias("b")
    ).orderBy(*s.keys).collect()
    assert max(r["n"] for r in sizes) <= 2 * CUT
    for x, y in zip(sizes, sizes[1:]):
        if x["patient_id"] == y["patient_id"]:
            assert tuple(x["b"]) < tuple(y["a"])


def test_short_series_are_not_cut(skewed):
    assert not slicing(skewed, ["patient_id"], ["DateTime"]).split


def test_copies_of_one_position_stay_together(spark):
    df = spark.range(300).selectExpr("1L as k", "least(id, 150) as t")
    s = slicing(df, ["k"], ["t"], 20)
    sizes = [r[1] for r in s.assign(df).groupBy(*s.keys[1:]).count().collect()]
    assert sum(sizes) == 300 and max(sizes) >= 150


def test_position(skewed):
    plain = with_position(skewed, ["patient_id"], ["DateTime", "reading_id"], total="n")
    cut = with_position(skewed, ["patient_id"], ["DateTime", "reading_id"], total="n", max_rows=CUT)
    cols = ["reading_id", "_pos", "n"]
    assert spark_rows(plain.select(cols)) == spark_rows(cut.select(cols))


def test_global_order_without_key(skewed):
    order = ["DateTime", "reading_id"]
    plain, cut = with_position(skewed, [], order), with_position(skewed, [], order, max_rows=CUT)
    assert spark_rows(plain.select("reading_id", "_pos")) == spark_rows(cut.select("reading_id", "_pos"))


OPERATORS = {
    "impute": lambda d, m: clean.impute_zero_neighbors(d, max_rows=m),
    "interpolate": lambda d, m: clean.interpolate_zeros(d, ("SBP", "SPO2"), max_rows=m),
    "split": lambda d, m: clean.split_chronological(d, 0.8, max_rows=m),
    "lag_lead": lambda d, m: timeseries.lag_lead(d, ("SBP", "SPO2"), 3, max_rows=m),
    "supervised": lambda d, m: timeseries.supervised_windows(d, 4, 6, max_rows=m).selectExpr("reading_id", "cast(x as string) x", "cast(y as string) y"),
    "rolling_score": lambda d, m: timeseries.rolling_score(d, ("SBP",), max_rows=m),
    "running_min": lambda d, m: timeseries.running_min(d, max_rows=m),
    "running_confusion": lambda d, m: timeseries.running_confusion(d, "label", "pred", max_rows=m),
    "running_accuracy": lambda d, m: timeseries.running_accuracy(d, "label", "pred", max_rows=m),
    "running_minmax": lambda d, m: timeseries.running_minmax(d, ("SBP", "SPO2"), max_rows=m),
    "nearest": lambda d, m: joins.join_forecast(
        timeseries.forecast_grid(d.select("patient_id", "reading_id", "DateTime"), pick=(15, 600)).drop("DateTime"), d, "SBP", 7200, max_rows=m
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_equals_plain(skewed, name):
    plain, cut = OPERATORS[name](skewed, None), OPERATORS[name](skewed, CUT)
    assert plain.columns == cut.columns
    rows = spark_rows(plain)
    assert rows and rows == spark_rows(cut)


def test_a_slice_shorter_than_the_reach(skewed):
    plain = timeseries.supervised_windows(skewed, 10, 30).selectExpr("reading_id", "cast(x as string) x", "cast(y as string) y")
    cut = timeseries.supervised_windows(skewed, 10, 30, max_rows=5).selectExpr("reading_id", "cast(x as string) x", "cast(y as string) y")
    rows = spark_rows(plain)
    assert rows and rows == spark_rows(cut)


@pytest.mark.parametrize("bucket,dense", [(None, 10**9), (600, 10**9), (None, 0), (600, 0), (7200, 10)])
def test_rolling_paths_agree(skewed, bucket, dense):
    cols = ("SBP", "SPO2")
    w = "over (partition by patient_id order by unix_seconds(DateTime) range between 600 preceding and current row)"
    plain = skewed.selectExpr("reading_id", *[f"round(avg({c}) {w}, 6) {c}" for c in cols])
    ours = timeseries.rolling_mean(skewed, cols, 600, bucket_seconds=bucket, dense=dense)
    ours = ours.selectExpr("reading_id", *[f"round({c}_RollingAvg, 6) {c}" for c in cols])
    assert spark_rows(plain) == spark_rows(ours)


@pytest.mark.parametrize("name", ["lag_lead", "interpolate", "running_min", "split"])
def test_a_long_series_without_patient(skewed, name):
    df = skewed.withColumn("patient_id", F.when(F.col("patient_id") > 1, F.col("patient_id")))
    rows = spark_rows(OPERATORS[name](df, None))
    assert rows and rows == spark_rows(OPERATORS[name](df, CUT))

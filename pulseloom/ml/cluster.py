"""K-means: fitting, assignment to given centres, clusters as labels."""

from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.ml.features import assemble, kept

# Parameters of the clustering.
KMEANS = {"k": 2, "maxIter": 100, "initMode": "k-means||", "initSteps": 15, "tol": 1e-4,
          "distanceMeasure": "euclidean", "seed": 123}


def kmeans_fit(df: DataFrame, cols=("SBP", "DBP"), **params) -> KMeansModel:
    """Equal feature values are merged into one weighted row before the iterations."""
    points = df.dropna(subset=list(cols)).groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    with kept(points) as rows:
        return KMeans(weightCol="weight", **{**KMEANS, **params}).fit(assemble(rows, cols))


def kmeans_predict(model: KMeansModel, df: DataFrame, cols=("SBP", "DBP")) -> DataFrame:
    """Add `prediction`; batch or stream."""
    return model.transform(assemble(df, cols)).drop("features")


def nearest_center(cols, centers) -> Column:
    """Index of the nearest of a few given centres, the first among equals."""
    def distance(center):
        return reduce(lambda a, b: a + b, [(F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(cols, center)])

    best = F.least(*[F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)])
    return best["i"]


def cluster_labels(df: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """The most frequent label of each cluster (the smaller one on a tie)."""
    cells = df.groupBy(prediction, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(prediction).orderBy(F.desc("n"), label)  # one row per label
    return cells.withColumn("r", F.row_number().over(w)).filter("r = 1").select(prediction, F.col(label).alias("cluster_label"))


def cluster_agreement(df: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """Share of rows whose label is the label of their cluster; works on the table of counts."""
    cells = df.groupBy(prediction, label).agg(F.count(F.lit(1)).alias("n"))
    per_cluster = cells.groupBy(prediction).agg(F.max("n").alias("best"), F.sum("n").alias("n"))
    return per_cluster.agg(F.sum("best").alias("correct"), F.sum("n").alias("total"), (F.sum("best") / F.sum("n")).alias("accuracy"))

"""Isolation forest (Liu, Ting, Zhou 2008): small trees on row samples, short paths are anomalies.

Spark draws the samples and builds the trees as grouped tasks of at most a few hundred rows;
the trees are a small table that goes to the scoring tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODES = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def path_correction(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng, limit: int):
    """Nodes of one random tree: (feature, threshold, left, right, depth); a leaf has feature -1."""
    nodes, todo = [None], [(0, points, 0)]
    while todo:
        i, rows, depth = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes[i] = (-1, 0.0, -1, -1, depth + float(path_correction(len(rows))))
            continue
        f = int(rng.choice(usable))
        t = float(rng.uniform(low[f], high[f]))
        right = rows[:, f] >= t
        if right.all():  # the cut fell on the lowest value
            right = rows[:, f] > low[f]
            t = float(rows[right, f].min())
        a = len(nodes)
        nodes += [None, None]
        nodes[i] = (f, t, a, a + 1, 0.0)
        todo += [(a, rows[~right], depth + 1), (a + 1, rows[right], depth + 1)]
    return nodes


@dataclass
class IsolationForestModel:
    cols: tuple
    nodes: pd.DataFrame  # trees x at most 2 * sample nodes
    sample: int
    cutoff: float | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `score` (high = anomalous) and `prediction` (-1 anomaly, 1 normal). Batch or stream."""
        trees = [
            (t["feature"].to_numpy(), t["threshold"].to_numpy(), t["left"].to_numpy(), t["right"].to_numpy(), t["depth"].to_numpy())
            for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree")
        ]
        shared = df.sparkSession.sparkContext.broadcast((trees, float(path_correction(self.sample))))

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            trees, norm = shared.value
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for feature, threshold, left, right, depth in trees:
                at = np.zeros(len(x), dtype=int)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_right = x[rows, np.maximum(f, 0)] >= threshold[at]
                    at = np.where(inner, np.where(go_right, right[at], left[at]), at)
                total += depth[at]
            return pd.Series(np.power(2.0, -total / (len(trees) * norm)))

        scored = df.dropna(subset=list(self.cols)).withColumn("score", score(*self.cols))
        if self.cutoff is None:
            return scored
        return scored.withColumn("prediction", F.when(F.col("score") > self.cutoff, -1).otherwise(1))

    def save(self, spark, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(list(self.cols), self.sample, self.cutoff)]
        spark.createDataFrame(meta, "cols array<string>, sample int, cutoff double").write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> IsolationForestModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForestModel(tuple(meta["cols"]), nodes, meta["sample"], meta["cutoff"])


def isolation_forest(df: DataFrame, cols=("SBP", "DBP"), key="reading_id", trees=100, sample=256,
                     contamination=None, seed=42) -> IsolationForestModel:
    """Fit; with `contamination`, rows scoring above that upper quantile are called anomalies."""
    cols = list(cols)
    rows = df.dropna(subset=cols)
    n = rows.count()
    if n < 2:
        raise ValueError("an isolation forest needs at least two rows")
    # every row joins every tree with the same chance p, decided by hashes of its key: the first one gives the row's first
    # tree (most rows have none), the others are asked for the trees after it
    p = sample / n
    if p >= 1:
        drawn = rows.select(key, *cols).dropDuplicates([key]).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    else:
        uniform = lambda *c: (F.pmod(F.xxhash64(*c), F.lit(1 << 40)) + 0.5) / float(1 << 40)
        first = F.floor(F.log(uniform(F.col(key), F.lit(seed))) / math.log1p(-p))
        used = rows.select(key, *cols, first.alias("first")).filter(F.col("first") < trees).dropDuplicates([key])  # about trees * sample rows
        drawn = used.withColumn("tree", F.explode(F.sequence(F.col("first"), F.lit(trees - 1).cast("long"))))
        drawn = drawn.filter((F.col("tree") == F.col("first")) | (uniform(F.col(key), F.col("tree"), F.lit(seed + 1)) < p))
        drawn = drawn.withColumn("tree", F.col("tree").cast("int")).drop("first")
    limit = math.ceil(math.log2(max(2, min(sample, n))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        points = pdf.sort_values(key)[cols].to_numpy(dtype=float)
        nodes = _grow(points, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        out.insert(1, "node", np.arange(len(out)))
        return out

    nodes = drawn.groupBy("tree").applyInPandas(build, NODES).toPandas()  # trees x about 2 * sample rows
    model = IsolationForestModel(tuple(cols), nodes, min(sample, n))
    if contamination is not None:
        scored = model.transform(rows.select(*cols))
        model.cutoff = scored.agg(F.percentile_approx("score", F.lit(1 - contamination), F.lit(10000))).first()[0]
    return model

"""Tree classifiers and the linear support-vector classifier with probabilities."""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.ml import kernel as fourier
from pulseloom.ml.features import assemble, kept
from pulseloom.operators.clean import hash_bucket


@dataclass
class Classifier:
    """A fitted model and the columns it reads; adds prediction and class probabilities as array."""

    model: object
    cols: tuple
    l1: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(assemble(df, self.cols, l1=self.l1))
        keep = [*df.columns, F.col("prediction").cast("int").alias("prediction")]
        return out.select(*keep, vector_to_array("probability").alias("probability"))


def training_rows(df, cols, label):
    """The columns a fit reads. They are kept as plain numbers, smaller than vectors."""
    return df.select(*cols, F.col(label).cast("double").alias("label"))


def _fit(estimator, df, cols, label, l1=False):
    with kept(training_rows(df, cols, label)) as rows:
        return Classifier(estimator.fit(assemble(rows, cols, l1=l1)), tuple(cols), l1)


def random_forest(df, cols, label="label", seed=42, l1=False, **params) -> Classifier:
    """With `l1`, each row is first divided by its absolute sum."""
    return _fit(RandomForestClassifier(seed=seed, **params), df, cols, label, l1)


def feature_importance(fitted: Classifier) -> DataFrame:
    """One row per feature."""
    from pyspark.sql import SparkSession

    weights = fitted.model.featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(fitted.cols, weights)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def boosted_trees(df, cols, label="label", seed=42, **params) -> Classifier:
    base = {"maxDepth": 4, "stepSize": 0.15, "minInstancesPerNode": 2, "maxIter": 10}
    return _fit(GBTClassifier(seed=seed, **{**base, **params}), df, cols, label)


def decision_tree(df, cols, label="label", seed=42, **params) -> Classifier:
    return _fit(DecisionTreeClassifier(seed=seed, **params), df, cols, label)


@dataclass
class SupportVectorModel:
    """With `directions`, `phases`, `weights` and `intercept` the machine stands behind a random Fourier map of the standardised features."""

    scaler: object
    svc: object
    platt: object
    cols: tuple
    directions: list | None = None
    phases: list | None = None
    weights: list | None = None
    intercept: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        if self.directions:
            margins = self._kernel_margins(df)
        else:
            margins = _margins(self.svc, self.scaler.transform(assemble(df, self.cols)))
        out = self.platt.transform(assemble(margins, ["_margin"], "_m"))
        keep = [*df.columns, F.col("_svc").cast("int").alias("prediction")]
        return out.select(*keep, vector_to_array("_platt").alias("probability"))

    def _kernel_margins(self, df: DataFrame) -> DataFrame:
        d, p, w, b = np.array(self.directions), np.array(self.phases), np.array(self.weights), self.intercept
        mean, factor = _standardising(self.scaler)

        @F.pandas_udf("double")
        def margin(*columns: pd.Series) -> pd.Series:
            x = (np.column_stack([c.to_numpy(dtype=float) for c in columns]) - mean) * factor
            return pd.Series(fourier.cosines(x, d, p) @ w + b)

        return df.dropna(subset=list(self.cols)).withColumn("_margin", margin(*self.cols)).withColumn("_svc", (F.col("_margin") > 0).cast("int"))


def _margins(svc, df):
    return svc.transform(df).withColumn("_margin", vector_to_array("_raw")[1])


def _standardising(scaler):
    """Means and factors of a fitted scaler; a constant column has the factor 0."""
    std = scaler.std.toArray()
    return scaler.mean.toArray(), np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0)


def support_vector(df, cols, label="label", reg=0.01, max_iter=20, key="reading_id", seed=42, kernel="linear", gamma=0.5, width=256) -> SupportVectorModel:
    """Linear SVC on standardised features; a logistic curve over the margin gives probabilities.

    With `kernel="rbf"` the features first go through `width` random cosines for the kernel exp(-gamma * distance**2), so classes
    need not lie on two sides of a plane.

    The curve is fitted to margins of rows the machine behind them has not learned from: of two halves, dealt by a hash of
    `key`, each is judged by a machine fitted to the other. Without such a column it is fitted to the training margins.
    """
    if kernel not in ("linear", "rbf"):
        raise ValueError(kernel)
    half = hash_bucket(key, seed, 2) if key in df.columns else F.lit(0)
    with kept(df.select(*cols, F.col(label).cast("double").alias("label"), half.cast("int").alias("half"))) as rows:
        data = assemble(rows, cols)
        scaler = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True).fit(data)
        if kernel == "rbf":
            return _kernel_machine(rows, scaler, cols, reg, max_iter, seed, gamma, width)
        scaled = scaler.transform(data)
        machine = LinearSVC(featuresCol="_scaled", rawPredictionCol="_raw", predictionCol="_svc", regParam=reg, maxIter=max_iter)
        svc = machine.fit(scaled)
        margins = _margins(svc, scaled)
        # labels seen in each half: a machine needs both
        if rows.groupBy("half").agg(F.countDistinct("label").alias("n")).filter("n = 2").count() == 2:
            judged = [_margins(machine.fit(scaled.filter(F.col("half") != h)), scaled.filter(F.col("half") == h)).select("_margin", "label") for h in (0, 1)]
            margins = judged[0].unionByName(judged[1])
        return SupportVectorModel(scaler, svc, _curve(margins, max_iter), tuple(cols))


def _curve(margins: DataFrame, max_iter: int):
    curve = LogisticRegression(featuresCol="_m", probabilityCol="_platt", rawPredictionCol="_pr", predictionCol="_pp", maxIter=max_iter)
    return curve.fit(assemble(margins, ["_margin"], "_m").select("_m", "label"))


def _kernel_machine(rows, scaler, cols, reg, max_iter, seed, gamma, width) -> SupportVectorModel:
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(width, len(cols))) * math.sqrt(2 * gamma)
    phases = rng.uniform(0, 2 * math.pi, width)
    mean, factor = _standardising(scaler)
    # every pass reads all rows, whose files may be few
    spread = rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)
    with kept(fourier.blocks(spread, cols, mean, factor)) as data:
        fitted = fourier.machines(data, directions, phases, reg, max_iter)
        with kept(fourier.margins(data, directions, phases, fitted)) as margins:
            platt = _curve(margins, max_iter)
    weights, intercept = fitted[0]
    return SupportVectorModel(scaler, None, platt, tuple(cols), directions.tolist(), phases.tolist(), weights.tolist(), intercept)

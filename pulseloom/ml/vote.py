"""Soft vote of several classifiers for labels 0 and 1."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.ml import knn


def soft_vote(df: DataFrame, models: dict, extra=()) -> DataFrame:
    """Mean probability of label 1 over the models and the `extra` columns that hold one already.

    Adds p_<model>, `probability` and `prediction`; batch or stream. The models must have learned labels 0 and 1.
    """
    out = df
    for name, model in models.items():
        scored = model.transform(out)
        out = scored.select(*out.columns, F.col("probability")[1].alias(f"p_{name}"))
    parts = [F.col(f"p_{n}") for n in models] + [F.col(c) for c in extra]
    mean = reduce(lambda a, b: a + b, parts) / len(parts)
    return out.withColumn("probability", mean).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


@dataclass
class Ensemble:
    """Fitted classifiers and the reference rows of a k-NN member; votes on a table or, batch by batch, on a stream."""

    models: dict
    reference: knn.Reference | None = None
    neighbours: dict = field(default_factory=lambda: {"k": 5})

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds p_<member>, `probability` and `prediction`. With a k-NN member a stream needs `flows.fan_out`,
        which hands over micro-batches."""
        if self.reference is None:
            return soft_vote(df, self.models)
        if df.isStreaming:
            raise ValueError("a k-NN member votes on micro-batches: use flows.fan_out")
        near = knn.knn_classify(df, self.reference, self.reference.cols, self.reference.label, **self.neighbours)
        near = near.withColumn("p_knn", F.when(F.col("prediction") == 1, F.col("share")).otherwise(1 - F.col("share")))
        return soft_vote(near.drop("prediction", "share"), self.models, ["p_knn"])


def check_labels(df: DataFrame, label="label") -> None:
    """The vote averages the probability of label 1, so labels other than 0 and 1 are refused."""
    odd = df.filter(F.col(label).isNull() | ~F.col(label).isin(0, 1)).limit(1).collect()
    if odd:
        raise ValueError(f"labels must be 0 or 1, found {odd[0][label]}")

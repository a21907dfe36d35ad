"""Feature vectors and scaling."""

import contextlib
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextlib.contextmanager
def kept(df: DataFrame):
    """Keep a table across the passes of an iterative fit; it spills to disk and can be recomputed."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def assemble(df: DataFrame, cols, out="features", l1=False) -> DataFrame:
    """Vector column of `cols`, divided by its absolute sum with `l1`; rows with a missing value are skipped."""
    raw = "_raw_features" if l1 else out
    vectors = VectorAssembler(inputCols=list(cols), outputCol=raw, handleInvalid="skip").transform(df)
    return Normalizer(inputCol=raw, outputCol=out, p=1.0).transform(vectors).drop(raw) if l1 else vectors


@dataclass
class MinMaxModel:
    """Column ranges; works on batches and streams."""

    ranges: dict

    def transform(self, df: DataFrame) -> DataFrame:
        """Add <col>_normalized in [0, 1]; a constant column becomes 0.5."""
        return df.select("*", *[self._scaled(c).alias(f"{c}_normalized") for c in self.ranges])

    def inverse(self, df: DataFrame) -> DataFrame:
        back = [(F.col(f"{c}_normalized") * (hi - lo) + lo).alias(c) for c, (lo, hi) in self.ranges.items()]
        return df.select(*[c for c in df.columns if c not in self.ranges], *back)

    def _scaled(self, c):
        lo, hi = self.ranges[c]
        return F.lit(0.5) if lo == hi else (F.col(c) - F.lit(lo)) / F.lit(hi - lo)


def minmax_fit(df: DataFrame, cols) -> MinMaxModel:
    """All ranges in one pass."""
    row = df.agg(*[f(c).alias(f"{n}{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return MinMaxModel({c: (row[f"lo{c}"], row[f"hi{c}"]) for c in cols})


def l1_normalize(df: DataFrame, cols) -> DataFrame:
    """Divide the columns by the sum of their absolute values; an all-zero row stays."""
    norm = reduce(lambda a, b: a + b, [F.abs(c) for c in cols])
    scaled = [F.when(F.col("_norm") == 0, F.col(c)).otherwise(F.col(c) / F.nullif("_norm", F.lit(0.0))).alias(f"{c}_l1") for c in cols]
    return df.withColumn("_norm", norm).select(*df.columns, *scaled)

"""Gaussian naive Bayes from class moments: one aggregation to fit, expressions to score."""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class GaussianNB:
    cols: tuple
    classes: list  # (label, log prior, {column: (mean, variance)})

    def log_joint(self):
        """One expression per class: log prior plus the log densities."""
        out = []
        for label, prior, moments in self.classes:
            e = F.lit(prior)
            for c in self.cols:
                mean, var = moments[c]
                gap = F.col(c) - F.lit(mean)
                e = e - F.lit(0.5 * math.log(2 * math.pi * var)) - gap * gap / F.lit(2 * var)
            out.append((label, e))
        return out

    def predicted(self):
        """The likeliest label as one expression; of equally likely ones the first."""
        joint = self.log_joint()
        best = F.array_max(F.array(*[F.struct(e.alias("e"), F.lit(-i).alias("i")) for i, (_, e) in enumerate(joint)]))["i"]
        return F.element_at(F.array(*[F.lit(y) for y, _ in joint]), 1 - best)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction` and `probability` (array in the order of the labels)."""
        joint = self.log_joint()
        named = df.select("*", *[e.alias(f"_j{i}") for i, (_, e) in enumerate(joint)])
        cols = [F.col(f"_j{i}") for i in range(len(joint))]
        top = F.greatest(*cols) if len(cols) > 1 else cols[0]
        named = named.withColumn("_top", top)
        total = sum([F.exp(c - F.col("_top")) for c in cols[1:]], F.exp(cols[0] - F.col("_top")))
        best = F.lit(joint[-1][0])
        for (label, _), c in list(zip(joint, cols))[-2::-1]:
            best = F.when(c == F.col("_top"), F.lit(label)).otherwise(best)
        shares = F.array(*[F.exp(c - F.col("_top")) / total for c in cols])
        return named.select(*df.columns, best.alias("prediction"), shares.alias("probability"))


def smoothing_search(df: DataFrame, cols, smoothings, fold: str, label="label") -> dict:
    """Mean accuracy of every smoothing over the folds in the column `fold`, in two passes whatever their numbers.

    The first pass adds up the moments of each fold and class; what a fold's model has learned from are the moments of all the others,
    put together on the driver. The second pass judges every row by the models of its own fold, one for each smoothing.
    """
    moments = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("v", F.var_pop))]
    parts = df.groupBy(fold, label).agg(F.count(F.lit(1)).alias("n"), *moments).collect()  # a row per fold and class
    folds = sorted({r[fold] for r in parts})
    right = []
    for s in smoothings:
        judged = F.lit(None)
        for f in folds:
            rest = [r for r in parts if r[fold] != f]
            if rest:
                model = _from_moments([_joined([r for r in rest if r[label] == y], cols, y) for y in sorted({r[label] for r in rest})], cols, s)
                judged = F.when(F.col(fold) == f, model.predicted()).otherwise(judged)
        right.append(F.avg(F.coalesce((judged == F.col(label)).cast("int"), F.lit(0))))
    rows = df.groupBy(fold).agg(*[r.alias(f"s{i}") for i, r in enumerate(right)]).collect()
    return {s: sum(r[f"s{i}"] for r in rows) / len(rows) if rows else 0.0 for i, s in enumerate(smoothings)}


def _joined(parts: list, cols, label) -> tuple:
    """(label, rows, {column: (mean, variance)}) of several parts of a class."""
    n = sum(r["n"] for r in parts)
    means = {c: sum(r["n"] * r[f"m_{c}"] for r in parts) / n for c in cols}
    return label, n, {c: (means[c], sum(r["n"] * (r[f"v_{c}"] + (r[f"m_{c}"] - means[c]) ** 2) for r in parts) / n) for c in cols}


def _from_moments(classes: list, cols, smoothing) -> GaussianNB:
    """The model of (label, rows, {column: (mean, variance)}) per class."""
    total, widest = sum(n for _, n, _ in classes), 0.0
    for c in cols:  # variance of the whole column
        mean = sum(n * m[c][0] for _, n, m in classes) / total
        widest = max(widest, sum(n * (m[c][1] + (m[c][0] - mean) ** 2) for _, n, m in classes) / total)
    extra = smoothing * widest
    return GaussianNB(tuple(cols), [(y, math.log(n / total), {c: (m[c][0], m[c][1] + extra) for c in cols}) for y, n, m in classes])


def gaussian_nb(df: DataFrame, cols, label="label", smoothing=1e-9) -> GaussianNB:
    """Population variances, widened by `smoothing` times the largest variance of a column."""
    moments = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("v", F.var_pop))]
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *moments).orderBy(label).collect()  # a row per class
    return _from_moments([_joined([r], cols, r[label]) for r in classes], cols, smoothing)

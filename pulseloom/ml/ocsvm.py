"""One-class SVM with an RBF kernel, as a linear model on random Fourier features.

The kernel is approximated by cosines (Rahimi, Recht 2007); the primal objective of
Schoelkopf et al. (2001), |w|^2/2 - rho + mean(max(0, rho - w.z))/nu, is minimised in its dual form,
each step one distributed aggregate over the distinct feature values. The vectors that the steps have found stay on the driver,
and after each step the shortest mix of all of them is taken, so few steps are needed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.ml.features import kept


@dataclass
class OneClassModel:
    cols: tuple
    directions: list  # one frequency vector per feature
    phases: list
    weights: list
    rho: float

    def decision(self) -> Column:
        """Positive inside, negative outside."""
        return decisions([self])[0]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `score` (high = anomalous) and `prediction` (-1 outside, 1 inside). Batch or stream."""
        scored = df.withColumn("score", -self.decision())
        return scored.withColumn("prediction", F.when(F.col("score") > 0, -1).otherwise(1))


def decisions(models: list) -> Column:
    """Array with the decision of each of several models that were fitted together."""
    first = models[0]
    directions, phases = np.array(first.directions), np.array(first.phases)
    weights, rho = np.array([m.weights for m in models]).T, np.array([m.rho for m in models])
    scale = math.sqrt(2 / len(phases))

    @F.pandas_udf("array<double>")
    def decide(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(list(np.cos(x @ directions.T + phases) * scale @ weights - rho))

    return decide(*first.cols)


def one_class_svm(df: DataFrame, cols=("SBP", "DBP"), nu=0.1, **params) -> OneClassModel:
    """Fit one model, see one_class_svms."""
    return one_class_svms(df, [nu], cols, **params)[0]


BINS, FINE_BINS = 256, 65_536


def shortest_mix(vectors: np.ndarray) -> np.ndarray:
    """Weights, none negative and together one, of the shortest vector in the hull of some rows (Wolfe 1976).

    The set in use grows by the row that would shorten the vector most; rows whose weight falls to zero leave it.
    """
    gram = vectors @ vectors.T
    weights, used = np.zeros(len(gram)), [int(np.argmin(np.diag(gram)))]
    weights[used] = 1.0
    for _ in range(20 * len(gram)):
        slope = gram @ weights
        now, best = float(weights @ slope), int(np.argmin(slope))
        if slope[best] >= now * (1 - 1e-9) or best in used:
            break
        used.append(best)
        while True:
            inner = gram[np.ix_(used, used)]
            x = np.linalg.solve(inner + 1e-12 * np.trace(inner) * np.eye(len(used)), np.ones(len(used)))
            x /= x.sum()
            before = weights[used]
            if (x > 0).all():
                weights[used] = x
                break
            falls = x <= 0
            step = float(np.min(before[falls] / (before[falls] - x[falls])))
            after = np.where(falls & (before + step * (x - before) <= 1e-12), 0.0, before + step * (x - before))
            weights[used] = after
            used = [u for u, v in zip(used, after) if v > 0]
    return weights / weights.sum()


def one_class_svms(df: DataFrame, nus, cols=("SBP", "DBP"), gamma=None, width=256, steps=8, tolerance=5e-3, seed=42) -> list:
    """Fit a model for each nu, all in the same passes. `gamma` defaults to 1 / number of columns.

    Equal feature values are merged into weighted rows. w is a mean of features in which no row has more than
    1 / (nu * rows); a step finds the mean g of the nu part of the rows with the lowest margins (Frank, Wolfe 1956), and w becomes
    the shortest mix of all means found so far, at most `steps` + 1 vectors of `width` numbers for each model on the driver. w.w - w.g bounds how
    far w is from the optimum; when it is below `tolerance` of w.w for all models the fit ends. In a pass every task adds up the
    features of its rows in BINS bins of the margin, one job per step. rho, the nu-quantile of the margins, is found at the end in
    two passes that zoom into the bin that holds it.
    """
    cols, nus = list(cols), np.array(nus, dtype=float)
    gamma = gamma or 1 / len(cols)
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(width, len(cols))) * math.sqrt(2 * gamma)
    phases = rng.uniform(0, 2 * math.pi, width)
    models = len(nus)
    merged = df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("n"))

    with kept(merged.coalesce(64)) as data:

        def one_pass(w, low, high, sums=True):
            """Per model and bin of [low, high): weight, and the feature sums; the ends take what lies outside. Also the margins' range."""
            size, bins = (1 + width, BINS) if sums else (1, FINE_BINS)

            def local(batches):
                total = np.zeros((models, bins, size))
                ends = np.stack([np.full(models, math.inf), np.full(models, -math.inf)])
                for pdf in batches:
                    if not len(pdf):
                        continue
                    z = np.cos(pdf[cols].to_numpy(dtype=float) @ directions.T + phases) * math.sqrt(2 / width)
                    n, margin = pdf["n"].to_numpy(), z @ w.T
                    ends = np.stack([np.minimum(ends[0], margin.min(axis=0)), np.maximum(ends[1], margin.max(axis=0))])
                    rows = np.column_stack([n, z * n[:, None]]) if sums else n[:, None]
                    at = np.clip(np.floor((margin - low) / (high - low) * bins), 0, bins - 1).astype(int)
                    for i in range(models):
                        order = np.argsort(at[:, i], kind="stable")
                        first = np.flatnonzero(np.diff(at[order, i], prepend=-1))
                        total[i, at[order[first], i]] += np.add.reduceat(rows[order], first, axis=0)
                yield pd.DataFrame({"total": [total.tobytes()], "ends": [ends.tobytes()]})

            total, ends = np.zeros((models, bins, size)), []
            for row in data.mapInPandas(local, "total binary, ends binary").collect():  # at most 64 rows of fixed size
                total += np.frombuffer(row.total).reshape(total.shape)
                ends.append(np.frombuffer(row.ends).reshape(2, models))
            return total, np.min([e[0] for e in ends], axis=0), np.max([e[1] for e in ends], axis=0)

        def wider(low, high):
            spare = 0.1 * (high - low) + 1e-12
            return low - spare, high + spare

        start, _, _ = one_pass(np.zeros((models, width)), np.zeros(models), np.ones(models))
        rows = start[0, :, 0].sum()
        if not rows:
            raise ValueError("no rows to learn from")
        w = start[:, :, 1:].sum(axis=1) / rows  # the mean, which is the answer for nu = 1
        found = [[v] for v in w]
        high = np.minimum(np.sqrt(2 * (w * w).sum(axis=1)), 2)  # no feature vector is longer than the root of two
        low = -high
        for _ in range(steps):
            total, low, high = one_pass(w, *wider(low, high))
            weight = total[:, :, 0]
            before = np.cumsum(weight, axis=1) - weight
            share = np.clip((nus[:, None] * rows - before) / np.maximum(weight, 1e-12), 0, 1)  # part of a bin in the nu part
            g = (share[:, :, None] * total[:, :, 1:]).sum(axis=1) / (nus[:, None] * rows)
            gap = (w * (w - g)).sum(axis=1)
            if (gap <= tolerance * (w * w).sum(axis=1)).all():
                break
            for vectors, new in zip(found, g):
                vectors.append(new)
            w = np.stack([shortest_mix(np.array(v)) @ np.array(v) for v in found])
        top = np.sqrt(2 * (w * w).sum(axis=1))
        bottom, top = wider(-top, top)
        for _ in range(2):
            weight = one_pass(w, bottom, top, sums=False)[0][:, :, 0]
            k = (np.cumsum(weight, axis=1) <= nus[:, None] * rows).sum(axis=1).clip(max=FINE_BINS - 1)
            step = (top - bottom) / FINE_BINS
            bottom, top = bottom + k * step, bottom + (k + 1) * step
    return [OneClassModel(tuple(cols), directions.tolist(), phases.tolist(), a.tolist(), float(r)) for a, r in zip(w, bottom)]

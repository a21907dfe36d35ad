"""Forecasts of the next half hour from the last ten readings."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.operators.timeseries import supervised_windows

SIGNALS = ("SBP", "DBP")


def persistence(df: DataFrame, horizons=(15, 30), cols=SIGNALS) -> DataFrame:
    """The last value, repeated: one row per reading and horizon."""
    from pulseloom.operators.timeseries import forecast_grid

    grid = forecast_grid(df, pick=horizons)
    return grid.select("*", *[F.col(c).alias(f"{c}_predicted") for c in cols])


@dataclass
class DirectModel:
    """One linear function of the lags per signal and step ahead."""

    cols: tuple
    n_in: int
    n_out: int
    weights: np.ndarray  # (1 + lags, signals * steps), the first row is the intercept

    def predict(self, window: np.ndarray) -> np.ndarray:
        """(n_in, signals) to (n_out, signals)."""
        flat = np.concatenate([[1.0], window.T.ravel()])
        return (flat @ self.weights).reshape(len(self.cols), self.n_out).T

    def ahead(self, x="x"):
        """All predictions of a window as one array: every step of the first signal, then of the next."""
        weights = self.weights

        @F.pandas_udf("array<double>")
        def predict(lags: pd.Series) -> pd.Series:
            flat = np.stack(lags.to_numpy()) if len(lags) else np.zeros((0, len(weights) - 1))
            return pd.Series(list(np.column_stack([np.ones(len(flat)), flat]) @ weights))

        return predict(F.concat(*[F.col(f"{x}.{c}") for c in self.cols]))

    def transform(self, windows: DataFrame, horizons=(1, 15, 30), x="x") -> DataFrame:
        """Add <col>_<h> predictions to a table of windows, as plain expressions."""
        lags = [F.col(x)[i][c] for c in self.cols for i in range(self.n_in)]

        def linear(j):
            e = F.lit(float(self.weights[0, j]))
            for lag, w in zip(lags, self.weights[1:, j]):
                e = e + lag * F.lit(float(w))
            return e

        return windows.select(
            "*", *[linear(s * self.n_out + h - 1).alias(f"{c}_{h}") for s, c in enumerate(self.cols) for h in horizons]
        )


def direct_fit(df: DataFrame, n_in=10, n_out=30, cols=SIGNALS, ridge=1e-6) -> DirectModel:
    """Least squares for all steps and signals at once, over all complete windows of the readings."""
    return direct_fit_windows(supervised_windows(df, n_in, n_out, cols), n_in, n_out, cols, ridge)


def direct_fit_windows(windows: DataFrame, n_in=10, n_out=30, cols=SIGNALS, ridge=1e-6) -> DirectModel:
    """Least squares over windows (`x`, `y`) such as `supervised_windows` gives.

    Every task adds up products of its rows; the sums, a fixed number, are added by Spark and
    solved on the driver.
    """
    def values(a):
        return F.concat(*[F.col(f"{a}.{c}") for c in cols])

    rows = windows.select(values("x").alias("f"), values("y").alias("t"))
    k, m = 1 + n_in * len(cols), n_out * len(cols)

    def products(batches):
        total = np.zeros((k, k + m))
        for pdf in batches:
            if len(pdf):
                f = np.column_stack([np.ones(len(pdf)), np.stack(pdf["f"].to_numpy())])
                total += f.T @ np.column_stack([f, np.stack(pdf["t"].to_numpy())])
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    sums = rows.mapInPandas(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    table = np.zeros((k, k + m))
    table[sums["i"], sums["j"]] = sums["v"]
    gram, cross = table[:, :k], table[:, k:]
    if gram[0, 0] == 0:
        raise ValueError("no complete window to learn from")
    return DirectModel(tuple(cols), n_in, n_out, np.linalg.solve(gram + ridge * gram[0, 0] * np.eye(k), cross))

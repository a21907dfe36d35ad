"""Support-vector machines behind random Fourier features, fitted without a table of the features.

The objective is that of `LinearSVC` on the features: mean hinge loss plus reg/2 times the squared weights of standardised features. The rows
stay as small numbers in blocks; every pass computes the cosines of a few thousand rows at a time and adds up losses and slopes of
all machines, so a machine costs memory for its weights only, and several machines cost the passes of one.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Rows whose cosines are computed at once.
CHUNK = 2_048


def blocks(rows: DataFrame, cols, mean, factor) -> DataFrame:
    """(body): float32 matrices of (value - mean) * factor, the label as -1 or 1, and the half; rows with a missing value are skipped."""
    def run(batches):
        for pdf in batches:
            pdf = pdf.dropna(subset=list(cols))
            y = pdf["label"].to_numpy(dtype=float)
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            x = (pdf[list(cols)].to_numpy(dtype=float) - mean) * factor
            yield pd.DataFrame({"body": [np.column_stack([x, 2 * y - 1, pdf["half"]]).astype("<f4").tobytes()]})

    return rows.select(*cols, "label", "half").mapInPandas(run, "body binary")


def chunks(bodies, width: int):
    """(values, label, half) of at most CHUNK rows at a time."""
    for body in bodies:
        m = np.frombuffer(body, "<f4").reshape(-1, width + 2)
        for i in range(0, len(m), CHUNK):
            part = m[i : i + CHUNK]
            yield part[:, :width], part[:, width], part[:, width + 1]


def cosines(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """Features whose inner products are close to an RBF kernel (Rahimi, Recht 2007)."""
    return np.cos(x @ directions.T + phases) * directions.dtype.type(math.sqrt(2 / len(phases)))


def summed(data: DataFrame, work, width: int, size: int) -> np.ndarray:
    """The sum of work(values, label, half), `size` numbers, over all rows; one row per task comes to the driver."""
    def local(batches):
        total = np.zeros(size)
        for pdf in batches:
            for part in chunks(pdf["body"], width):
                total += work(*part)
        yield pd.DataFrame({"total": [total.tobytes()]})

    return sum((np.frombuffer(r.total) for r in data.mapInPandas(local, "total binary").collect()), np.zeros(size))


def descent(size: int, steps: int, memory: int = 10, tolerance: float = 1e-6):
    """L-BFGS as a generator: yields points, is sent (value, slope) of each, and returns the best point."""
    x = np.zeros(size)
    f, g = yield x
    pairs: list = []
    for _ in range(steps):
        d, used = -g, []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            used.append(a)
            d = d - a * y
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(used)):
            d = d + (a - (y @ d) / (s @ y)) * s
        if not pairs:
            d = d / max(1.0, float(np.linalg.norm(g)))
        slope, step = float(g @ d), 1.0
        if slope >= 0:
            break
        for _ in range(12):
            to = x + step * d
            value, at = yield to
            if value <= f + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = to - x, at - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[1 - memory :], (s, y)]
        small = f - value <= tolerance * max(abs(f), 1e-12)
        x, f, g = to, value, at
        if small:
            break
    return x


def machines(data: DataFrame, directions, phases, reg: float, max_iter: int) -> list[tuple[np.ndarray, float]]:
    """(weights, intercept) of a machine fitted to all blocks and, if both halves have both labels, of those fitted to all but half 0 and
    all but half 1."""
    d, p = np.asarray(directions, np.float32), np.asarray(phases, np.float32)
    n_features, width = d.shape

    def moments(x, y, half):
        z, out = cosines(x, d, p), []
        for h in (0, 1):
            own = z[half == h].astype(float)
            out += [[len(own), (y[half == h] > 0).sum()], own.sum(axis=0), (own * own).sum(axis=0)]
        return np.concatenate(out)

    halves = summed(data, moments, width, 2 * (2 + 2 * n_features)).reshape(2, -1)
    if not halves[:, 0].sum():
        raise ValueError("no rows to learn from")
    both = ((0 < halves[:, 1]) & (halves[:, 1] < halves[:, 0])).all()
    sums = np.stack([halves.sum(axis=0), halves[1], halves[0]][: 3 if both else 1])
    n = sums[:, :1]
    mean, square = sums[:, 2 : 2 + n_features] / n, sums[:, 2 + n_features :]
    spread = np.sqrt(np.maximum(square - n * mean * mean, 0) / np.maximum(n - 1, 1))
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)

    def plain(k, point):
        w = point[:-1] * scale[k]
        return w, float(point[-1] - mean[k] @ w)

    def losses(at: dict) -> dict:
        """Value and slope of some machines at a point each, in one pass."""
        own = list(at)
        made = [plain(k, at[k]) for k in own]
        w, b = np.stack([x for x, _ in made], axis=1).astype(np.float32), np.array([x for _, x in made], np.float32)

        def work(x, y, half):
            z = cosines(x, d, p)
            slack = 1 - y[:, None] * (z @ w + b)
            wrong = slack > 0
            for i, k in enumerate(own):
                if k:
                    wrong[:, i] &= half != k - 1
            pull = np.where(wrong, -y[:, None], np.float32(0))
            return np.concatenate([np.where(wrong, slack, 0).sum(axis=0, dtype=float), pull.sum(axis=0, dtype=float), (z.T @ pull).T.ravel()])

        total = summed(data, work, width, len(own) * (2 + n_features))
        loss, pulls, slopes = total[: len(own)], total[len(own) : 2 * len(own)], total[2 * len(own) :].reshape(len(own), -1)
        out = {}
        for i, k in enumerate(own):
            v, rows = at[k][:-1], n[k, 0]
            slope = (slopes[i] - mean[k] * pulls[i]) * scale[k] / rows + reg * v
            out[k] = loss[i] / rows + reg / 2 * float(v @ v), np.append(slope, pulls[i] / rows)
        return out

    walks = {k: descent(n_features + 1, max_iter) for k in range(len(sums))}
    at, found = {k: next(g) for k, g in walks.items()}, {}
    while at:
        for k, answer in losses(at).items():
            try:
                at[k] = walks[k].send(answer)
            except StopIteration as e:
                found[k] = plain(k, e.value)
                del at[k]
    return [found[k] for k in sorted(found)]


def margins(data: DataFrame, directions, phases, fitted: list) -> DataFrame:
    """(_margin, label) of every row, by the machine that has not learned from its half, or by the only one."""
    d, p = np.asarray(directions, np.float32), np.asarray(phases, np.float32)
    w, b = np.stack([x for x, _ in fitted], axis=1), np.array([x for _, x in fitted])

    def run(batches):
        for pdf in batches:
            for x, y, half in chunks(pdf["body"], d.shape[1]):
                m = cosines(x, d, p) @ w + b
                own = m[np.arange(len(m)), half.astype(int) + 1] if len(fitted) > 1 else m[:, 0]
                yield pd.DataFrame({"_margin": own, "label": (y + 1) / 2})

    return data.mapInPandas(run, "_margin double, label double")

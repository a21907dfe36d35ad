"""Quality classifier: learned vectors of hashed words, character n-grams and word patterns, averaged per document.

Every word of a text gives features: the word, its character 3- to 5-grams with borders, and, for its place, whether
the three words that end there stood earlier in the text. Features are hashed into buckets; each bucket has a vector. A
document is the average of its features' vectors, and a softmax layer gives the classes. Vectors and layer are trained by
stochastic gradient descent in numpy on a bounded sample.

The softmax of an average is a logistic curve over the average of one number per feature, so scoring needs one
number per bucket, and a word's numbers are added up once.
"""

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import fold, labelled_sample, map_text

BUCKETS, DIMENSIONS = 1 << 16, 8
#: Buckets of the place features: words that end a new or a repeated three-word window.
NEW, REPEATED = 0, 1
#: Place features count as often as the features of an average word, so that they are not drowned.
PLACE_WEIGHT = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all features of the words: the word, its character 3- to 5-grams between borders, and its shape
    (upper, lower or mixed case, and the last character unless it is a letter)."""
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    of, hashes = [], []
    with np.errstate(over="ignore"):
        for n in (3, 4, 5):
            count = max(0, len(codes) - n + 1)
            h = np.full(count, n, np.uint64)
            for k in range(n):
                h = (h ^ codes[k : k + count]) * _MIX
                h ^= h >> np.uint64(29)
            inside = owner[:count] == owner[n - 1 : n - 1 + count]
            of.append(owner[:count][inside])
            hashes.append(h[inside])
    whole = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    shape = [zlib.crc32((("U" if w.isupper() else "l" if w.islower() else "m") + ("" if w[-1].isalpha() else w[-1])).encode("utf-8", "surrogatepass"), 1) for w in words]
    each = np.arange(len(words))
    of += [each, each]
    hashes += [np.array(whole, np.uint64) * _MIX >> np.uint64(7), np.array(shape, np.uint64) * _MIX >> np.uint64(7)]
    return np.concatenate(of), (2 + np.concatenate(hashes) % np.uint64(BUCKETS - 2)).astype(np.int64)


def repeats(words: list[str]) -> int:
    """Three-word windows that stood earlier in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    return len(windows) - len(set(windows))


def document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share each has in its average."""
    words = text.split()
    at, n = np.unique(features(words)[1], return_counts=True) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    again = repeats(words)
    places = [PLACE_WEIGHT * max(0, len(words) - again), PLACE_WEIGHT * again]
    counts = np.concatenate([places, n]).astype(np.float32)
    return np.concatenate([[NEW, REPEATED], at]), counts / max(1.0, counts.sum())


@dataclass(frozen=True)
class Model:
    """One number per bucket and a bias: the difference of both classes before the softmax."""

    numbers: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> list[float]:
        """Probability of class 1 of every text; a text without words gets that of the bias."""
        docs = [t.split() for t in texts]
        different = list(set().union(*docs))
        number = {w: i for i, w in enumerate(different)}
        if different:
            of, bucket = features(different)
            total = np.bincount(of, self.numbers[bucket], len(different))
            n = np.bincount(of, minlength=len(different))
        out = []
        for words in docs:
            z = 0.0
            if words:
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                again = repeats(words)
                new = len(words) - again
                place = PLACE_WEIGHT * (again * float(self.numbers[REPEATED]) + new * float(self.numbers[NEW]))
                z = (float(total[at].sum()) + place) / (float(n[at].sum()) + PLACE_WEIGHT * len(words))
            out.append(float(1 / (1 + np.exp(-np.clip(z + self.bias, -30, 30)))))
        return out

    def score(self, text: str) -> float:
        return self.scores([text])[0]


def train(sample: list[tuple[str, int]], epochs: int = 12, rate: float = 1.2, seed: int = 7) -> Model:
    """Stochastic gradient descent over (text, class) pairs, as many steps with either class. One class alone gives its share."""
    y = np.array([c for _, c in sample], int)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if not len(y) else 3.0 * (2 * int(y[0]) - 1))
    docs = [document(t) for t, _ in sample]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    each = max(np.bincount(y))
    steps, done = epochs * 2 * each, 0
    for _ in range(epochs):
        for i in rng.permutation(np.concatenate([np.resize(rng.permutation(np.flatnonzero(y == c)), each) for c in (0, 1)])):
            at, share = docs[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ vectors[at]
            out = mean @ layer + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = layer @ p
            layer -= step * np.outer(mean, p)
            bias -= 0.1 * step * p
            vectors[at] -= step * np.outer(share, back)
    difference = layer[:, 1] - layer[:, 0]
    return Model((vectors @ difference).astype(np.float32), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, text="text", keep=("doc_id",)) -> DataFrame:
    """Columns `keep`, score and predicted. Null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def fn(texts):
        scores = shared.value.scores(texts)
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_text(docs, fn, "score double, predicted int", text, keep)


def learned_score(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (1500, 1500), max_chars: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; the model learns from at most `per_class` texts of class 0 and 1
    that are not held out and have at most `max_chars` characters."""
    model = train(labelled_sample(docs, labels, "quality", per_class, max_chars))
    return score(docs, model).withColumn("held_out", fold() == F.lit(0))

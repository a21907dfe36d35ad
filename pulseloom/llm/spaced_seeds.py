"""Benchmark passages in documents, found by spaced seeds.

Texts are lower-cased words (runs of letters, marks, digits and underscores). A mask is a fixed pattern of positions; the
positions it leaves out may differ between benchmark and document. Under every mask the hash of the selected words of
each window is taken on both sides, and equal hashes are joined. Around a hit the words are then compared place by
place: the document holds the passage if on that diagonal some stretch of `length` words (or the item, if shorter)
that contains the window has at least `share` equal words.

Items shorter than `length` leave a mask few places, so masks are made for their length: whichever words `share` allows to
differ, one of the masks leaves them all out.

Documents hash only windows that may be hits: a Bloom filter of the benchmark's hashes, of a fixed size whatever the
benchmark's, goes to the tasks. It lets every hit pass; what it passes wrongly is removed by the join.
"""

from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import free, materialize

#: 1 selects a position. Each mask selects 7 of 10 to 12 words.
MASKS = ("1101100111", "11100101011", "110100110011")
#: Words that must line up, and the share of them that must be equal.
LENGTH, SHARE = 14, 0.8
#: Bits of the Bloom filter as a power of two (2 MB), and hash functions.
BLOOM_BITS, BLOOM_HASHES = 24, 2
_NOT_WORD = r"[^\p{L}\p{M}\p{N}_]+"


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for every word of every text, and where each text's words begin (one more entry than texts).

    Letters, marks, digits and underscores make words; case does not matter.
    """
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), _NOT_WORD)
    coded = lists.values.dictionary_encode()
    different = np.array([xxhash.xxh64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    ids = different[coded.indices.to_numpy()] if len(different) else np.zeros(0, np.uint64)
    real = ids != 0
    starts = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()]
    return ids[real], starts


@cache
def covering(n: int, differ: int) -> tuple[str, ...]:
    """Masks of n positions, about half of them (at least 4) selected; any `differ` positions are left out by one of them."""
    selected = min(n - differ, max(4, n // 2))
    if not differ or comb(n, selected) > 20_000:  # of differ + 1 parts one has no changed word
        cuts = [n * i // (differ + 1) for i in range(differ + 2)]
        return tuple("0" * a + "1" * (b - a) + "0" * (n - b) for a, b in zip(cuts, cuts[1:]))
    masks = {"".join("0" if i in out else "1" for i in range(n)): set(combinations(out, differ)) for out in combinations(range(n), n - selected)}
    missing, taken = set(combinations(range(n), differ)), []
    while missing:
        taken.append(max(masks, key=lambda m: len(masks[m] & missing)))
        missing -= masks[taken[-1]]
    return tuple(taken)


def short_masks(n: int, length: int = LENGTH, share: float = SHARE) -> tuple[str, ...]:
    """The masks for an item of n words; one of fewer than `length` words has masks of its own as well."""
    fit = tuple(m for m in MASKS if len(m) <= n)
    if n >= length:
        return fit or ("1" * n,)
    return fit + covering(n, max(k for k in range(n) if (n - k) / n >= share))


def hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the selected words of every window."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, xxhash.xxh64_intdigest(mask.encode()), np.uint64)
    with np.errstate(over="ignore"):
        for k, c in enumerate(mask):
            if c == "1":
                h = (h ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
    return h


def slots(h: np.ndarray):
    """The filter's bits for hashes."""
    for k in range(BLOOM_HASHES):
        yield (h >> np.uint64(k * BLOOM_BITS)) & np.uint64((1 << BLOOM_BITS) - 1)


def bloom(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter."""
    ok = np.ones(len(h), bool)
    for s in slots(h):
        ok &= bits[s >> np.uint64(3)] >> (s & np.uint64(7)).astype(np.uint8) & 1 == 1
    return ok


def context(ids: np.ndarray, at: int, width: int, length: int) -> list[int]:
    """The words from length - 1 before a window to length - 1 after it, 0 where there are none."""
    lo, hi = at - length + 1, at + width + length - 1
    got = np.zeros(hi - lo, np.uint64)
    a, b = max(lo, 0), min(hi, len(ids))
    got[a - lo : b - lo] = ids[a:b]
    return got.view(np.int64).tolist()


def benchmark_seeds(benchmark: DataFrame, length: int, share: float = SHARE) -> DataFrame:
    """(h, item_id, width, n_item, words): every window of every item, with the words around it."""
    def run(batches):
        for b in batches:
            out = []
            words, starts = word_ids(b.column(1))
            for item, lo, hi in zip(b.column(0).to_pylist(), starts.tolist(), starts[1:].tolist()):
                ids = words[lo:hi]
                for m in short_masks(len(ids), length, share) if len(ids) else ():
                    for at, h in enumerate(hashes(ids, m).view(np.int64).tolist()):
                        out.append((h, item, len(m), len(ids), context(ids, at, len(m), length)))
            yield pa.RecordBatch.from_pydict(dict(zip(("h", "item_id", "width", "n_item", "words"), map(list, zip(*out)))) if out else {c: [] for c in ("h", "item_id", "width", "n_item", "words")}, schema=SEEDS)

    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "h long, item_id long, width int, n_item int, words array<long>")


SEEDS = pa.schema([("h", pa.int64()), ("item_id", pa.int64()), ("width", pa.int32()), ("n_item", pa.int32()), ("words", pa.list_(pa.int64()))])


def filter_of(seeds: DataFrame) -> np.ndarray:
    """The Bloom filter; partial filters of fixed size are merged, at most 64 of them, on the driver."""
    def run(batches):
        bits = np.zeros(1 << BLOOM_BITS, bool)
        for b in batches:
            for s in slots(b.column(0).to_numpy().view(np.uint64)):
                bits[s] = True
        yield pa.RecordBatch.from_pydict({"bits": [np.packbits(bits, bitorder="little").tobytes()]})

    total = np.zeros(1 << BLOOM_BITS >> 3, np.uint8)
    for row in seeds.select("h").coalesce(64).mapInArrow(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(row.bits, np.uint8)
    return total


def matches(docs: DataFrame, benchmark: DataFrame, key=("doc_id",), text="text", length: int = LENGTH, share: float = SHARE) -> DataFrame:
    """(key, item_id, n_windows, best_share): the items whose passages each row of `docs` holds, with at least one window.

    Rows without a match are absent. Null texts hold nothing; repeated rows count their windows together; an item of
    fewer words than `length` must line up as a whole; an item without words matches nothing.
    """
    seeds = materialize(benchmark_seeds(benchmark, length, share), "seeds")
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(seeds))
    short = [r.n_item for r in seeds.filter(F.col("n_item") < max(length, min(map(len, MASKS)))).select("n_item").distinct().collect()]
    masks = tuple(dict.fromkeys([*MASKS, *(m for n in sorted(short) for m in short_masks(n, length, share))]))
    key = list(key)

    def run(batches):
        known = bits.value
        for b in batches:
            ids, starts = word_ids(b.column(len(key)))
            of = np.repeat(np.arange(b.num_rows), np.diff(starts))
            rows, found = [], []
            for m in masks:
                h = hashes(ids, m)
                hit = np.flatnonzero(bloom(h, known) & (of[: len(h)] == of[len(m) - 1 :]) if len(h) else [])
                for at, row, x in zip(hit.tolist(), of[hit].tolist(), h[hit].view(np.int64).tolist()):
                    rows.append(row)
                    found.append((x, len(m), context(ids[starts[row] : starts[row + 1]], at - int(starts[row]), len(m), length)))
            took = pa.array(rows, pa.int64())
            cols = {k: b.column(i).take(took) for i, k in enumerate(key)}
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.list_(pa.int64()))], names=[*key, "h", "width", "doc_words"])

    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key) + ", h long, width int, doc_words array<long>"
    hits = docs.select(*key, text).mapInArrow(run, schema)
    joined = hits.join(seeds, ["h", "width"])

    @F.pandas_udf("double")
    def lined_up(doc: pd.Series, item: pd.Series, width: pd.Series, n_item: pd.Series) -> pd.Series:
        return pd.Series([best_share(d, i, w, min(length, n)) for d, i, w, n in zip(doc, item, width, n_item)], dtype="float64")

    scored = joined.withColumn("share", lined_up("doc_words", "words", "width", "n_item")).filter(F.col("share") >= share)
    return scored.groupBy(*key, "item_id").agg(F.count(F.lit(1)).alias("n_windows"), F.max("share").alias("best_share"))


def best_share(doc: np.ndarray, item: np.ndarray, width: int, length: int) -> float:
    """Largest share of equal words in a stretch of `length` words (at least the window) around the window."""
    same = (np.asarray(doc) == np.asarray(item)) & (np.asarray(item) != 0)
    inside = np.asarray(item) != 0
    middle = (len(same) - width) // 2
    size = max(length, width)
    total, real = np.concatenate([[0], np.cumsum(same)]), np.concatenate([[0], np.cumsum(inside)])
    starts = np.arange(max(0, middle + width - size), min(middle, len(same) - size) + 1)
    whole = real[starts + size] - real[starts] == size
    n = (total[starts + size] - total[starts])[whole]
    return float(n.max()) / size if len(n) else 0.0


def remove(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, share: float = SHARE) -> DataFrame:
    """The rows of `docs` that hold no benchmark passage, columns unchanged. A text is removed wherever it stands."""
    a, b = free("a__", docs), free("b__", docs)
    keyed = docs.withColumns({a: F.xxhash64(F.coalesce("text", F.lit(""))), b: F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1))})
    leaked = materialize(matches(keyed.select(a, b, "text"), benchmark, (a, b), "text", length, share).select(a, b).distinct(), "leaked")
    return keyed.join(leaked, [a, b], "left_anti").drop(a, b).select(*docs.columns)

"""Near copies by SimHash fingerprints, compared at the anchors of a covering code.

The 64 bits are cut into blocks of 23, 23 and 18 bits. Two fingerprints that differ in at most 4 bits differ in at
most one bit of one of the blocks. The code words of the binary Golay code (length 23, 4096 words, the
short block filled up with zeros) are the anchors: every block value lies within the covering radius 3 of one anchor, its
home. A value that differs from it in at most one bit lies within 3 + 1 of that anchor. So every fingerprint goes to its home,
and as a replica to every anchor within radius plus threshold; homes are compared with replicas of their anchor,
by counting differing bits of the whole fingerprint. A pair that differs in at most 4 bits meets at the home of either.

For very many fingerprints the anchors are pairs of code words of two blocks: of three blocks that differ in at most 4 bits in
all, two differ in at most 2 bits together, so a fingerprint goes to all pairs of anchors that are reached with 2 bits.

Only different fingerprints are compared. An anchor's fingerprints are split into chunks of homes, each compared with
all replicas of the anchor in turn. What a chunk has found is reduced to a spanning forest before it leaves
the task, so links grow with the fingerprints, not with their pairs. Components come from `components`.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.llm.common import free, map_text, materialize
from pulseloom.llm.components import components

#: First bit and number of bits of every block.
BLOCKS = ((0, 23), (23, 23), (46, 18))
RADIUS, DISTANCE, SHINGLE, SEED = 3, 4, 4, 42
#: Homes of one anchor that are compared together.
CHUNK = 4096
#: Documented parameter: different fingerprints beyond which anchors are pairs of code words. 12,288 anchors and 16 replicas a
#: fingerprint become 50 million anchors and 180 replicas, so that the fingerprints of one anchor stay few.
FINE = 20_000_000


def golay_words() -> np.ndarray:
    """The 4096 words of the binary Golay code: multiples of its generator polynomial."""
    generator = 0b101011100011
    words = np.zeros(4096, np.uint32)
    for k in range(12):
        words ^= ((np.arange(4096) >> k & 1) * (generator << k)).astype(np.uint32)
    return words


def anchors_of(values: np.ndarray, bits: int, threshold: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors within RADIUS + threshold of every block value: (row, anchor, t), rows in order; t = 0 is the home.

    Whatever differs from a value in at most t of the block's bits has its home among the homes of the values that differ
    from it in at most t bits; these are the anchors within RADIUS + t, and t is the smallest number that reaches one.
    """
    table = home_table()
    flips = [0] + [1 << i for i in range(bits)]
    t = [0] + [1] * bits
    if threshold == 2:
        flips += [1 << i | 1 << j for i in range(bits) for j in range(i)]
        t += [2] * (bits * (bits - 1) // 2)
    homes = table[values[:, None] ^ np.array(flips, np.uint32)].astype(np.int64) * 4 + np.array(t)
    homes.sort(axis=1)
    first = np.ones(homes.shape, bool)
    first[:, 1:] = homes[:, 1:] >> 2 != homes[:, :-1] >> 2
    rows, cols = np.nonzero(first)
    return rows, homes[rows, cols] >> 2, homes[rows, cols] & 3


def combined(a, b, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of two blocks together: all pairs of a row's anchors that need at most two bits in all."""
    out = []
    for ta, tb in ((0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0)):
        x, y = a[2] == ta, b[2] == tb
        rows_a, rows_b = a[0][x], b[0][y]
        per_a, per_b = np.bincount(rows_a, minlength=n), np.bincount(rows_b, minlength=n)
        start_b = np.cumsum(per_b) - per_b
        times = per_b[rows_a]
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        i = np.repeat(np.arange(len(rows_a)), times)
        j = np.repeat(start_b[rows_a], times) + nth
        out.append((rows_a[i], a[1][x][i] * 4096 + b[1][y][j], np.full(len(i), ta + tb)))
    return tuple(np.concatenate(c) for c in zip(*out))


def anchors(fps: np.ndarray, fine: bool):
    """(number of the set of blocks, row, anchor, t) for every fingerprint; t = 0 marks the home."""
    blocks = [((fps >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.uint32), bits) for first, bits in BLOCKS]
    if not fine:
        for k, (values, bits) in enumerate(blocks):
            yield (k, *anchors_of(values, bits))
        return
    near = [anchors_of(values, bits, 2) for values, bits in blocks]
    for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        yield (k, *combined(near[i], near[j], len(fps)))


_TABLE: list[np.ndarray] = []


def home_table() -> np.ndarray:
    """Number of the one code word within 3 bits, for each of the 2 ** 23 values."""
    if not _TABLE:
        words = golay_words()
        table = np.zeros(1 << 23, np.uint16)
        errors = [0] + [1 << a for a in range(23)]
        errors += [1 << a | 1 << b for a in range(23) for b in range(a)]
        errors += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
        number = np.arange(4096, dtype=np.uint16)
        for e in errors:
            table[words ^ np.uint32(e)] = number
        _TABLE.append(table)
    return _TABLE[0]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit k is 1 if it is set in over half of the shingles' hashes; no words: zero."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = (ends - size)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())])
    n = len(starts)
    ones = np.zeros(64, np.int64)
    raw = np.frombuffer(hashed, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(raw[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep=("doc_id",), text="text") -> DataFrame:
    """Columns `keep` and `fp`, the fingerprint as a signed long. Null texts count as empty."""
    return map_text(docs, lambda texts: {"fp": [signed(fingerprint(t, shingle)) for t in texts]}, "fp long", text, keep)


def linked(homes: np.ndarray, replicas: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between homes and replicas, as (root, fingerprint) pairs; homes go in blocks."""
    parent: dict[int, int] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(p, p)
            x = parent[x]
        return x

    for i in range(0, len(homes), 256):
        h = homes[i : i + 256]
        for j in range(0, len(replicas), 1 << 14):
            r = replicas[j : j + (1 << 14)]
            a, b = np.nonzero(np.bitwise_count(h[:, None] ^ r[None, :]) <= distance)
            nodes = np.concatenate([h, r]).view(np.int64)
            label = np.arange(len(nodes))
            b = b + len(h)
            while True:  # smallest number over the links, until nothing changes
                low = np.minimum(label[a], label[b])
                before = label.copy()
                np.minimum.at(label, a, low)
                np.minimum.at(label, b, low)
                label = label[label]
                if (label == before).all():
                    break
            moved = np.flatnonzero(nodes[label] != nodes)
            for x, y in zip(nodes[moved].tolist(), nodes[label[moved]].tolist()):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
    return [(root(x), x) for x in list(parent) if root(x) != x]


def links(fps: DataFrame, distance: int = DISTANCE, fine: bool | None = None) -> DataFrame:
    """(a, b) with a < b: links that connect all fingerprints (`fp`, different) within `distance` of each other.

    Any two fingerprints that are that close are connected by these links; not every such pair is listed. With `fine`
    (by itself for more than FINE fingerprints) anchors are pairs of code words of two blocks; the links mean the same.
    """
    if distance > 4:
        raise ValueError("the blocks cover up to 4 differing bits")
    if fine is None:
        fine = fps.count() > FINE
    each = 4096**2 if fine else 4096

    def place(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 14):
                v = batch.column(0).to_numpy()[i : i + (1 << 14)].view(np.uint64)
                for k, rows, anchor, t in anchors(v, fine):
                    ids = pa.array(v[rows].view(np.int64))
                    at = pa.array(k * each + anchor, pa.int64())
                    yield pa.RecordBatch.from_pydict({"anchor": at, "home": pa.array(np.zeros(len(rows), bool)), "fp": ids})
                    own = pa.array(t == 0)
                    yield pa.RecordBatch.from_pydict({"anchor": at.filter(own), "home": pa.array(np.ones(int((t == 0).sum()), bool)), "fp": ids.filter(own)})

    placed = materialize(fps.select("fp").mapInArrow(place, "anchor long, home boolean, fp long"), "anchors")
    sizes = placed.filter("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("int")
    sizes = sizes.select("anchor", chunks.alias("chunks"))
    # without fine anchors there are at most 3 * 4096 of them; an anchor without homes has nothing to compare
    sized = placed.join(sizes if fine else F.broadcast(sizes), "anchor")
    homes = sized.filter("home").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    replicas = sized.filter("NOT home").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    both = homes.unionByName(replicas).select("anchor", "chunk", "home", "fp")

    def compare(key, pdf):
        v = pdf["fp"].to_numpy().view(np.uint64)
        is_home = pdf["home"].to_numpy()
        return pd.DataFrame(linked(v[is_home], v[~is_home], distance), columns=["a", "b"], dtype="int64")

    return both.groupBy("anchor", "chunk").applyInPandas(compare, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, keep=("doc_id",)) -> DataFrame:
    """Columns `keep` (with doc_id), `fp`, `label` (smallest linked fingerprint) and `component_id` of every row.

    `component_id` is the smallest doc_id reachable over links; null ids count only if a component has no other.
    Repeated rows and texts share a fingerprint. Texts without a word have fingerprint zero and are linked like any other.
    """
    prints = materialize(fingerprints(docs, shingle, keep), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = components(links(nodes, distance))
    grouped = labels.join(nodes, labels["node"] == nodes["fp"]).select("node", "label", "first_id")
    smallest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = grouped.select("node", "label").join(smallest, "label")
    alone = F.col("label").isNull()
    full = nodes.join(named, nodes["fp"] == named["node"], "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), F.when(alone, F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return prints.join(full, "fp").select(*keep, "fp", "label", "component_id")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_copies(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id (of these, the one of the smallest text hash)."""
    named = {n: free(f"{n}__", docs) for n in ("h", "id", "null", "rank")}
    h, i, null, rank = named.values()
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    found = near_copies(docs.select("doc_id", "text", key.alias("h")), shingle, distance, ("doc_id", "h"))
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    parts = lambda d, x: (F.coalesce(d, F.lit(0)).alias(i), d.isNull().alias(null), x.alias(h))
    chosen = first.groupBy("label").agg(F.min(F.struct("doc_id", "h")).alias("c")).select(*parts(F.col("c.doc_id"), F.col("c.h"))).distinct()
    kept = docs.select("*", *parts(F.col("doc_id"), key)).join(chosen, [i, null, h])
    one = kept.withColumn(rank, F.row_number().over(Window.partitionBy(i, null, h).orderBy(h)))
    return one.filter(F.col(rank) == 1).select(*docs.columns)

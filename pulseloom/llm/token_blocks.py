"""Token ids on disk as patched frame-of-reference blocks.

File: magic, blocks, block index (byte offset of every block, 8 bytes each), token count of every document (8 bytes
each), document ids (8 bytes each) with a null flag (1 byte each), then a tail with the three counts and the magic.
A block holds BLOCK ids: their minimum (4 bytes), the bit width (1), the number of exceptions (1), the low bits of
(id - minimum) packed at that width, then the exceptions as positions (1 byte each) and full differences (4 bytes
each). The width is that of the chosen percentile of the block's differences. The last block is filled with its
last id; the counts say where it ends.
"""

import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm import pieces
from pulseloom.llm.common import open_input, open_output, shared_dir

BLOCK = 128
MAGIC = b"PFORBLK1"
TAIL = struct.Struct("<QQQ8s")


def pack(ids: np.ndarray, percentile: float = 0.9) -> tuple[bytes, np.ndarray]:
    """Blocks of ids (a multiple of BLOCK of them) and the byte length of every block."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    v = ids.reshape(-1, BLOCK).astype(np.uint32)
    low = v.min(axis=1)
    d = v - low[:, None]
    chosen = np.sort(d, axis=1)[:, min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)]
    width = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    over = d >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_over = over.sum(axis=1)
    size = 6 + BLOCK // 8 * width + 5 * n_over
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(start[-1]), np.uint8)
    head = np.zeros((len(v), 6), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, n_over
    out[start[:-1, None] + np.arange(6)] = head
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            out[start[at][:, None] + 6 + np.arange(BLOCK // 8 * w)] = pack_bits(d[at], int(w))
    rows, cols = np.nonzero(over)
    if len(rows):
        first = np.cumsum(n_over) - n_over
        nth = np.arange(len(rows)) - first[rows]
        base = start[rows] + 6 + BLOCK // 8 * width[rows]
        out[base + nth] = cols
        values = d[rows, cols].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + n_over[rows] + 4 * nth)[:, None] + np.arange(4)] = values
    return out.tobytes(), size


def pack_bits(d: np.ndarray, w: int) -> np.ndarray:
    """The low `w` bits of each row's values, one after the other, as bytes."""
    low = d.astype(np.uint64) & np.uint64((1 << w) - 1)
    words = np.zeros((len(d), BLOCK * w // 64), np.uint64)
    for j in range(BLOCK):
        at, shift = divmod(j * w, 64)
        words[:, at] |= low[:, j] << np.uint64(shift)
        if shift + w > 64:
            words[:, at + 1] |= low[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").view(np.uint8).reshape(len(d), -1)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of whole blocks that begin at `starts` in `data`."""
    raw = np.frombuffer(data, np.uint8)
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = raw[starts[:, None] + np.arange(6)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").reshape(-1)
    width, n_over = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    d = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            words = np.ascontiguousarray(raw[starts[at][:, None] + 6 + np.arange(BLOCK // 8 * w)]).view("<u8")
            mask = np.uint64((1 << int(w)) - 1)
            for j in range(BLOCK):
                k, shift = divmod(j * int(w), 64)
                x = words[:, k] >> np.uint64(shift)
                if shift + w > 64:
                    x = x | (words[:, k + 1] << np.uint64(64 - shift))
                d[at, j] = x & mask
    if n_over.any():
        rows = np.repeat(np.arange(len(starts)), n_over)
        nth = np.arange(len(rows)) - (np.cumsum(n_over) - n_over)[rows]
        base = starts[rows] + 6 + BLOCK // 8 * width[rows]
        values = raw[(base + n_over[rows] + 4 * nth)[:, None] + np.arange(4)]
        d[rows, raw[base + nth]] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    return (d + low[:, None]).reshape(-1)


class Writer:
    """Writes one file; documents come in batches."""

    def __init__(self, uri: str, percentile: float):
        self.out, self.percentile = open_output(uri), percentile
        self.out.write(MAGIC)
        self.rest = np.zeros(0, np.uint32)
        self.sizes: list[np.ndarray] = []
        self.counts: list[int] = []
        self.ids: list[int | None] = []

    def add(self, doc_ids: list, ids: np.ndarray, counts: list[int]) -> None:
        """Documents and the ids of all of them, one document after the other."""
        self.ids += doc_ids
        self.counts += counts
        joined = np.concatenate([self.rest, ids])
        whole = len(joined) // BLOCK * BLOCK
        self._blocks(joined[:whole])
        self.rest = joined[whole:]

    def _blocks(self, ids: np.ndarray) -> None:
        for i in range(0, len(ids), BLOCK << 13):
            data, size = pack(ids[i : i + (BLOCK << 13)], self.percentile)
            self.out.write(data)
            self.sizes.append(size)

    def close(self) -> int:
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.full(BLOCK - len(self.rest), self.rest[-1], np.uint32)]))
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        index = len(MAGIC) + np.cumsum(sizes) - sizes
        self.out.write(index.astype("<u8").tobytes())
        self.out.write(np.array(self.counts, "<u8").tobytes())
        self.out.write(np.array([i or 0 for i in self.ids], "<i8").tobytes())
        self.out.write(np.array([i is None for i in self.ids], np.uint8).tobytes())
        self.out.write(TAIL.pack(len(index), len(self.counts), int(sum(self.counts)), MAGIC))
        self.out.close()
        return int(sum(self.counts))


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        end = self.file.seek(0, 2)
        self.file.seek(end - TAIL.size)
        n_blocks, n_docs, self.n_tokens, magic = TAIL.unpack(self.file.read(TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"not a token block file: {uri}")
        at = end - TAIL.size - 17 * n_docs - 8 * n_blocks
        self.file.seek(at)
        self.index = np.append(np.frombuffer(self.file.read(8 * n_blocks), "<u8").astype(np.int64), at)
        self.counts = np.frombuffer(self.file.read(8 * n_docs), "<u8").astype(np.int64)
        ids = np.frombuffer(self.file.read(8 * n_docs), "<i8")
        null = np.frombuffer(self.file.read(n_docs), np.uint8)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null)]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n; only the blocks that hold them are read."""
        if not n:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, (start + n - 1) // BLOCK + 1
        self.file.seek(int(self.index[a]))
        data = self.file.read(int(self.index[b] - self.index[a]))
        got = unpack(data, self.index[a:b] - self.index[a])
        return got[start - a * BLOCK : start - a * BLOCK + n]

    def documents(self, tokens_at_once: int = 1 << 20):
        """(number, ids) of every document in order; long runs of documents are read together."""
        ends = np.cumsum(self.counts)
        i = 0
        while i < len(self.counts):
            first = int(ends[i] - self.counts[i])
            j = max(i + 1, int(np.searchsorted(ends, first + tokens_at_once, "right")))
            got = self.tokens(first, int(ends[j - 1]) - first)
            for k in range(i, j):
                yield k, got[int(ends[k] - self.counts[k]) - first : int(ends[k]) - first]
            i = j


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = pieces.VOCABULARY, end_id: int = 2, percentile: float = 0.9) -> list[tuple[str, int, int]]:
    """Encode `docs` (doc_id, text) in ascending doc_id order into files of `folder`; (file, documents, ids) in order.

    Null texts count as empty, so a document has at least the end id. Null ids come first; rows of one id are in
    the order of a hash of their text. Rows are dealt by ranges of (id, hash), so an id on very many rows is spread
    as well. A task that runs again writes a file of another name, and only the files of the tasks that count are listed:
    one row per file comes to the driver.
    """
    path = public_tokenizers.path(vocabulary)
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    ranged = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        part, writer, name = TaskContext.get().partitionId(), None, None
        bpe = pieces.load(path)
        for b in pieces.larger(batches):
            if not b.num_rows:
                continue
            if writer is None:
                name = f"{folder}/{part:06d}-{uuid.uuid4().hex}.pfor"
                writer = Writer(name, percentile)
            ids, edges = pieces.encode_flat(bpe, b.column(1))
            writer.add(b.column(0).to_pylist(), np.insert(ids, edges[1:], end_id), (np.diff(edges) + 1).tolist())
        if writer is not None:
            n = writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [len(writer.counts)], "tokens": [n]})

    made = ranged.mapInArrow(run, "part long, file string, docs long, tokens long").collect()
    return [(r.file, r.docs, r.tokens) for r in sorted(made, key=lambda r: r.part)]


def read_tokens(spark, files: list[tuple[str, int, int]]) -> DataFrame:
    """One row per document from the files alone: doc_id, start, n_tokens, ids_crc32."""
    rows, start = [], 0
    for name, _, n in files:
        rows.append((name, start))
        start += n
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(rows, "file string, start long").repartition(len(rows), "file")

    def run(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = Reader(name)
                crc = [zlib.crc32(np.ascontiguousarray(ids, "<u4").data) for _, ids in f.documents()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(f.doc_ids, pa.int64()), "start": pa.array(base + np.cumsum(f.counts) - f.counts, pa.int64()),
                    "n_tokens": pa.array(f.counts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                })

    return listed.mapInArrow(run, schema)


def tokens_on_disk(docs: DataFrame, vocabulary: str = pieces.VOCABULARY, end_id: int = 2) -> DataFrame:
    """Write the ids of `docs` to a fresh shared folder and return what the files say of each document."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, shared_dir(spark, "tokens"), vocabulary, end_id))

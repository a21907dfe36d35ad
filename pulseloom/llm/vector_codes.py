"""Product codes of vectors, trained on integers with exact arithmetic.

Every component x becomes floor(1024 * x); a vector is cut into equal parts and every part position has a codebook of its own.
Whole vectors are sorted along a Hilbert curve and kept in flat blocks; a block stores the box (smallest and largest value of
every component) and the sums of its rows. In a round every block first compares its box with the codebook: an entry that lies
farther from the whole box than some other entry's farthest corner can be nearest to none of its rows, so only a shortlist is left.
If that is a single entry, the block's sums are all a round needs; otherwise a small kernel compares its rows with the shortlist.

Distances are integers: held in doubles while every intermediate value stays below 2**53, in 64-bit integers below 2**62, and in
Python integers beyond that, so results never depend on rounding or on the layout of the blocks.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pulseloom.llm.common import materialize, prepare
from pulseloom.operators.joins import MAX_BROADCAST, join_skewed

SCALE = 1024
#: Rows of a block.
BLOCK = 512
#: Bits of every component that the Hilbert curve sees.
BITS = 3
#: The largest double whose product with SCALE is finite.
LARGEST = np.finfo(np.float64).max / SCALE
_LONG = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Place of every row of `cells` (whole numbers below 2**bits) on the Hilbert curve, as bytes in the curve's order.

    The method is Skilling's (2004): undo the excess work from the top bit down, then Gray-code over the axes.
    """
    x = [np.ascontiguousarray(c) for c in cells.T.astype(np.int64)]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for axis in x:
            flip = (axis & q) != 0
            swap = np.where(flip, 0, (x[0] ^ axis) & low)
            axis ^= swap
            x[0] ^= np.where(flip, low, swap) if axis is not x[0] else np.where(flip, low, 0)
        q >>= 1
    for before, axis in zip(x, x[1:]):
        axis ^= before
    twist, q = np.zeros(len(cells), np.int64), 1 << (bits - 1)
    while q > 1:
        twist ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    code = np.stack(x, axis=1) ^ twist[:, None]
    planes = [(code >> b) & 1 for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def exact_type(largest: int, width: int):
    """The fastest number type in which squared distances over `width` components of at most `largest` stay exact."""
    bound = 4 * largest * largest * width
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def as_type(values: np.ndarray, kind) -> np.ndarray:
    """Integers in any number type as `kind`, without rounding."""
    if kind is object:
        return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)
    return values.astype(kind)


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries, ascending, that may be nearest to some point of the box, ties included."""
    below, above = low - book, book - high
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(high - book, book - low)
    return np.flatnonzero((near * near).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(rows: np.ndarray, book: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry among `some` (the lower of equally near ones) and its squared distance, for every row."""
    few = book[some]
    d = (few * few).sum(axis=1) - 2 * (rows @ few.T)
    at = np.argmin(d, axis=1)
    return some[at], d[np.arange(len(rows)), at] + (rows * rows).sum(axis=1)


class Codebooks:
    """One codebook of whole numbers per part; `tables[p]` has a row per entry."""

    def __init__(self, tables: list[list[list[int]]]):
        self.tables = tables
        self.largest = [max((abs(v) for entry in t for v in entry), default=0) for t in tables]
        self._typed: dict = {}

    def typed(self, part: int, kind) -> np.ndarray:
        if (part, kind) not in self._typed:
            self._typed[part, kind] = as_type(np.array(self.tables[part], object), kind)
        return self._typed[part, kind]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for t in self.tables for entry in t for v in entry).encode()).hexdigest()


class Block:
    """One stored block: flat rows, box and sums."""

    def __init__(self, data: bytes, box: bytes, sums: str, stored: str, width: int):
        self.rows = np.frombuffer(data, stored).reshape(-1, width)
        self.low, self.high = np.frombuffer(box, stored).reshape(2, width)
        self.sums = sums

    def part(self, p: int, parts: int, books: Codebooks):
        """(slice of the columns, number type, codebook, shortlist) of a part."""
        size = self.rows.shape[1] // parts
        cols = slice(p * size, (p + 1) * size)
        largest = max(books.largest[p], int(abs(self.low[cols].astype(object)).max()), int(abs(self.high[cols].astype(object)).max()))
        kind = exact_type(largest, size)
        book = books.typed(p, kind)
        return cols, kind, book, shortlist(as_type(self.low[cols], kind), as_type(self.high[cols], kind), book)


def _blocks(df: DataFrame, stored: str, width: int, block: int) -> DataFrame:
    """Rows sorted by key, `block` of them in a row of the table: ids, labels, data, box, sums."""
    fields = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(fields["vec_id"])), T.StructField("labels", T.ArrayType(fields["label"])), T.StructField("data", T.BinaryType()),
        T.StructField("box", T.BinaryType()), T.StructField("sums", T.StringType()),
    ])
    id_type, label_type = to_arrow_type(fields["vec_id"]), to_arrow_type(fields["label"])

    def flat(batch: pa.Table):
        data = batch.column("data").combine_chunks()
        rows = np.frombuffer(b"".join(data.to_pylist()), stored).reshape(-1, width)
        total = as_type(rows, object).sum(axis=0) if stored == "<f8" else rows.sum(axis=0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([batch.column("vec_id").to_pylist()], pa.list_(id_type)), pa.array([batch.column("label").to_pylist()], pa.list_(label_type)),
            pa.array([rows.tobytes()], pa.binary()), pa.array([np.stack([rows.min(axis=0), rows.max(axis=0)]).tobytes()], pa.binary()),
            pa.array([",".join(str(int(s)) for s in total)], pa.string()),
        ], names=schema.fieldNames())

    def run(batches):
        rest = None
        for b in batches:
            have = pa.Table.from_batches([b])
            rest = have if rest is None else pa.concat_tables([rest, have])
            while rest.num_rows >= block:
                yield flat(rest.slice(0, block))
                rest = rest.slice(block)
        if rest is not None and rest.num_rows:
            yield flat(rest)

    return df.mapInArrow(run, schema)


def build(rows: DataFrame, width: int, largest: float, grid: np.ndarray, block: int = BLOCK) -> tuple[DataFrame, str]:
    """The written blocks of `rows` (vec_id, label, embedding) and the number type they are stored in.

    `grid` (2 x width) is the box that the curve's cells divide evenly; values outside belong to its border cells. It only
    decides which rows share a block. Rows are dealt by ranges of (key, a number of their own), so equal vectors spread as well.
    """
    stored = "<i2" if largest * SCALE < (1 << 15) - 2 else "<i4" if largest * SCALE < (1 << 31) - 2 else "<f8"
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("data", T.BinaryType()), T.StructField("key", T.BinaryType())])
    low, high = grid
    step = np.where(high > low, high - low, 1.0) / (1 << BITS)

    def keyed(batches):
        for b in batches:
            if b.num_rows:
                x = np.floor(b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width) * SCALE)
                cells = np.clip(np.floor((x - low) / step), 0, (1 << BITS) - 1)
                whole = x.astype(stored)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in whole], pa.binary()),
                                                  pa.array(hilbert_keys(cells), pa.binary())], names=schema.fieldNames())

    placed = rows.mapInArrow(keyed, schema).withColumn("nth", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange("key", "nth").sortWithinPartitions("key", "nth").drop("key", "nth")
    return materialize(_blocks(ranged, stored, width, block), "vector-blocks"), stored


def _pick(blocks: DataFrame) -> DataFrame:
    return blocks.select("data", "box", "sums")


def refine(blocks: DataFrame, stored: str, width: int, parts: int, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floored mean of the parts nearest to it; unused entries stay.

    A task adds up its blocks, so at most one row per task and entry is shuffled and one per entry comes to the driver.
    """
    size = width // parts

    def local(batches):
        counts = [np.zeros(len(t), np.int64) for t in books.tables]
        sums: list[dict[int, np.ndarray]] = [{} for _ in books.tables]

        def add(p, k, n, total):
            counts[p][k] += n
            sums[p][k] = sums[p][k] + total if k in sums[p] else total

        for b in batches:
            for data, box, text in zip(*(c.to_pylist() for c in b.columns)):
                block, whole = Block(data, box, text, stored, width), None
                for p in range(parts):
                    cols, kind, book, some = block.part(p, parts, books)
                    if len(some) == 1:
                        whole = np.array([int(v) for v in text.split(",")], object) if whole is None else whole
                        add(p, int(some[0]), len(block.rows), whole[cols])
                        continue
                    rows = block.rows[:, cols]
                    code, _ = nearest(as_type(rows, kind), book, some)
                    order = np.argsort(code, kind="stable")
                    first = np.flatnonzero(np.diff(code[order], prepend=-1))
                    wide = as_type(rows[order], object if stored == "<f8" else np.int64)
                    n = np.diff(np.append(first, len(order)))
                    for k, m, total in zip(code[order[first]].tolist(), n.tolist(), np.add.reduceat(wide, first, axis=0)):
                        add(p, k, m, total.astype(object))
        made = [(p, k, int(counts[p][k]), ",".join(str(int(v)) for v in total)) for p, have in enumerate(sums) for k, total in sorted(have.items())]
        columns = list(zip(*made)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()))],
                                         names=["part", "entry", "n", "sums"])

    def total(group: pa.Table) -> pa.Table:
        n, sums = sum(group.column("n").to_pylist()), [0] * size
        for text in group.column("sums").to_pylist():
            sums = [a + int(v) for a, v in zip(sums, text.split(","))]
        return pa.table({"part": group.column("part")[:1], "entry": group.column("entry")[:1], "mean": pa.array([",".join(str(s // n) for s in sums)], pa.string())})

    parted = _pick(blocks).mapInArrow(local, "part int, entry int, n long, sums string")
    means = parted.groupBy("part", "entry").applyInArrow(total, "part int, entry int, mean string").collect()
    tables = [list(t) for t in books.tables]
    for r in means:
        tables[r.part][r.entry] = [int(v) for v in r["mean"].split(",")]
    return Codebooks(tables)


def assign(blocks: DataFrame, stored: str, width: int, parts: int, books: Codebooks) -> DataFrame:
    """vec_id, label, code and error of every row of the blocks; an error beyond 63 bits is null."""
    fields = {f.name: f.dataType.elementType for f in blocks.schema if f.name in ("ids", "labels")}
    schema = T.StructType([T.StructField("vec_id", fields["ids"]), T.StructField("label", fields["labels"]), T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    digits = np.array([f"{k:02x}" for k in range(max(256, *(len(t) for t in books.tables)))], object)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                block = Block(b.column(2)[i].as_py(), b.column(3)[i].as_py(), b.column(4)[i].as_py(), stored, width)
                code, error = np.full(len(block.rows), "", object), np.zeros(len(block.rows), object)
                for p in range(parts):
                    cols, kind, book, some = block.part(p, parts, books)
                    k, d = nearest(as_type(block.rows[:, cols], kind), book, some)
                    code, error = code + digits[k], error + as_type(d, np.int64 if kind is np.float64 else kind).astype(object)
                yield pa.RecordBatch.from_arrays([b.column(0)[i].values, b.column(1)[i].values, pa.array(code.tolist(), pa.string()),
                                                  pa.array([int(e) if e <= _LONG else None for e in error], pa.int64())], names=schema.fieldNames())

    return blocks.mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, block: int = BLOCK) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for every usable row of `vectors` (vec_id, embedding, label).

    Rows whose vector is null or holds a null, a non-finite component or one whose 1024-fold is beyond a double are left out.
    The width is that of the kept row of smallest vec_id whose length is a positive multiple of `parts`; kept rows of another
    length have no code and no error. Null ids count as the largest; repeated rows and rows of one id are kept, among them
    the smaller vector comes first. With fewer than `entries` kept rows the codebooks are shorter. Sums beyond 63 bits are null.
    Bounds: `entries` rows come to the driver at the start and `parts * entries` after every round.
    """
    spark = prepare(vectors.sparkSession)
    usable = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= F.lit(float(LARGEST))))
    kept = vectors.select("vec_id", "label", "embedding").filter(F.coalesce(usable, F.lit(False)))
    fits = kept.filter((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = fits.orderBy(*order).limit(entries).collect()
    width = len(first[0].embedding) if first else 0
    if any(len(r.embedding) != width for r in first):
        first = fits.filter(F.size("embedding") == width).orderBy(*order).limit(entries).collect()
    rows = kept.filter(F.size("embedding") == width) if width else kept.limit(0)
    others = kept.filter(F.size("embedding") != width)
    start = np.floor(np.array([r.embedding for r in first], np.float64).reshape(-1, max(width, parts)) * SCALE)
    size = start.shape[1] // parts
    books = Codebooks([[[int(v) for v in r[p * size : (p + 1) * size]] for r in start] for p in range(parts)])
    if first:
        peak = rows.agg(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()[0]
        blocks, stored = build(rows, width, peak, np.stack([start.min(axis=0), start.max(axis=0)]), block)
        for _ in range(rounds):
            books = refine(blocks, stored, width, parts, books)
        coded = assign(blocks, stored, width, parts, books)
        coded = coded.unionByName(others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))
    else:
        coded = others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    name = F.when(F.col("label").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    coded = materialize(coded.withColumn("name", name), "vector-codes")
    sums = coded.groupBy("name").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    sums = materialize(sums, "label-errors")
    if sums.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        joined = coded.join(F.broadcast(sums), "name")
    else:
        joined = join_skewed(coded, sums, ["name"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The same codes in SQL, by comparing every part with every entry."""
    ctes = [
        f"v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE}*CAST(x AS DOUBLE)) AS BIGINT)) AS e, "
        "row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings WHERE embedding IS NOT NULL AND "
        "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)))=0)",
        f"p AS MATERIALIZED (SELECT r, part, e[part*len(e)//{parts}+1:(part+1)*len(e)//{parts}] AS x FROM v, (SELECT unnest(range({parts})) AS part))",
        f"c0 AS MATERIALIZED (SELECT part, r-1 AS k, x AS c FROM p WHERE r<={entries})",
    ]
    near = ("a{n} AS MATERIALIZED (SELECT r, p.part, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(x,c), lambda t: (t[1]-t[2])*(t[1]-t[2]))) AS BIGINT), "
            "k := k)) AS m FROM p JOIN c{n} USING (part) GROUP BY r, p.part)")
    for n in range(rounds):
        ctes += [
            near.format(n=n),
            f"s{n} AS (SELECT part, m.k AS k, unnest(range(1, len(x)+1)) AS i, unnest(x) AS x FROM a{n} JOIN p USING (r, part))",
            f"f{n} AS (SELECT part, k, i, sum(x) AS s, count(*) AS n FROM s{n} GROUP BY ALL)",
            f"g{n} AS (SELECT part, k, list(CAST((s-((s%n)+n)%n)//n AS BIGINT) ORDER BY i) AS c FROM f{n} GROUP BY ALL)",
            f"c{n + 1} AS MATERIALIZED (SELECT c{n}.part, c{n}.k, coalesce(g{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN g{n} USING (part, k))",
        ]
    ctes += [
        near.format(n=rounds),
        f"t AS (SELECT r, string_agg(printf('%02x', m.k), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)",
        f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, k)) AS codebooks_sha256 FROM c{rounds})",
    ]
    return ("WITH " + ", ".join(ctes) + " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 "
            "FROM v JOIN t USING (r), h")

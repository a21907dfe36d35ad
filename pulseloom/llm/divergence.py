"""How the sources of a language differ in their words: exact counts, divergences of source pairs, terms a source overuses.

A shard is the texts of some Arrow batches as one byte buffer. Every start of a word is a pointer into it; the pointers are sorted
by the bytes they point at with a multikey quicksort whose digit is a slice of eight bytes: sort by the first slice, then every run
of equal slices that has longer words by the next one. Equal runs are the shard's different terms; walking a run yields the
occurrences per source and, since pointers of a run stay in text order, the documents. Spark adds up the shards.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.llm.common import materialize, prepare

#: Bytes of text in a shard; a longer text is a shard of its own.
SHARD = 16 << 20
#: Slices of eight bytes before the rest of very long words is compared whole.
SLICES = 8
#: Sources in a block of pairs, and cells (a term of a source) in a slice of a language's terms.
SOURCES, CELLS = 128, 200_000
_TERMS_AT_ONCE = 1_000

#: For every byte its letter in a term (A-Z in lower case), zero for what separates terms.
_LETTER = np.zeros(256, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)


def word_pointers(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters with eight zeros at the end, start, length, text number) of the terms of the texts buffer[offsets[k] : offsets[k + 1]]."""
    letters = np.concatenate([_LETTER[buffer], np.zeros(8, np.uint8)])
    inside = letters[: len(buffer)] != 0
    first = offsets[:-1][np.diff(offsets) > 0]
    before, after = np.zeros(len(buffer), bool), np.zeros(len(buffer), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[first] = False
    after[first[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - start
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return letters, start, length, text


def _slice(letters: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from every pointer as a big-endian number, zero after the word's end (`left` bytes away)."""
    number = letters[at[:, None] + np.arange(8)].view(">u8").ravel().astype(np.uint64)
    drop = (8 * np.clip(8 - left, 0, 7)).astype(np.uint64)
    return np.where(left > 0, (number >> drop) << drop, 0)


def sort_pointers(letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): pointers sorted by their words, and the number of the run of equal words at every sorted place.

    Equal words keep the order of the pointers.
    """
    key = _slice(letters, start, length)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    depth = 8
    while True:
        run = np.cumsum(new) - 1
        members = np.bincount(run, minlength=1)
        longer = np.bincount(run[length[order] > depth], minlength=len(members))
        part = np.flatnonzero(((members > 1) & (longer > 0))[run])
        if not len(part):
            return order, run
        at = order[part]
        if depth < 8 * SLICES:
            key = _slice(letters, np.minimum(start[at] + depth, len(letters) - 8), length[at] - depth)
        else:
            rest = [letters[s + depth : s + n].tobytes() for s, n in zip(start[at].tolist(), length[at].tolist())]
            rank = {w: i for i, w in enumerate(sorted(set(rest)))}
            key = np.array([rank[w] for w in rest], np.uint64)
        sorted_ = np.lexsort((key, run[part]))
        order[part], key = at[sorted_], key[sorted_]
        new[part[1:]] |= (key[1:] != key[:-1]) & (run[part[1:]] == run[part[:-1]])
        if depth >= 8 * SLICES:
            return order, np.cumsum(new) - 1
        depth += 8


def count_shard(texts: pa.Array, group: np.ndarray, groups: int) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, occurrences, documents), a row for every term of a group; `group` has the group of every text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    buffer = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    letters, start, length, text = word_pointers(buffer, offsets - offsets[0])
    if not len(start):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, run = sort_pointers(letters, start, length)
    text = text[order]
    first = np.ones(len(order), bool)
    first[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])  # one for each document of a run
    many = np.diff(np.append(np.flatnonzero(first), len(order)))
    seen, inverse = np.unique(run[first] * groups + group[text[first]], return_inverse=True)
    n = np.bincount(inverse, many, len(seen)).astype(np.int64)
    df = np.bincount(inverse, minlength=len(seen))
    lead = order[np.searchsorted(run, seen // groups)]
    size = length[lead]
    ends = np.cumsum(size)
    chars = letters[np.repeat(start[lead] - (ends - size), size) + np.arange(int(ends[-1]))]
    terms = pa.Array.from_buffers(pa.large_string(), len(seen), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(chars)])
    return seen % groups, terms.cast(pa.string()), n, df


def shard_counts(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """lang, source, term, n, df for every shard; a row with an empty term for each of its groups."""

    def counted(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        pair = pa.StructArray.from_arrays([table.column(k).combine_chunks() for k in (0, 1)], ["lang", "source"])
        names = pa.table({"lang": pair.field(0), "source": pair.field(1)}).group_by(["lang", "source"], use_threads=False).aggregate([])
        at = {(a, b): i for i, (a, b) in enumerate(zip(names.column("lang").to_pylist(), names.column("source").to_pylist()))}
        group = np.array([at[p] for p in zip(pair.field(0).to_pylist(), pair.field(1).to_pylist())], np.int64)
        g, terms, n, df = count_shard(pc.fill_null(table.column(2), "").combine_chunks(), group, len(at))
        none = len(at)
        index = pa.array(np.concatenate([np.arange(none), g]))
        blank = np.zeros(none, np.int64)
        rows = pa.table({
            "lang": names.column("lang").take(index), "source": names.column("source").take(index), "term": pa.chunked_array([pa.array([""] * none, pa.string()), terms]),
            "n": np.concatenate([blank, n]), "df": np.concatenate([blank, df]),
        })
        yield from rows.combine_chunks().to_batches(max_chunksize=100_000)

    def run(batches):
        have, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if have and size + b.nbytes > shard:
                yield from counted(have)
                have, size = [], 0
            have.append(b)
            size += b.nbytes
        if have:
            yield from counted(have)

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*text).mapInArrow(run, "lang string, source string, term string, n long, df long")


def _share(n: str, total: str, terms: str):
    """1 + floor(10**9 * (n + 5) / (total + 5 * terms)), exact for any counts."""
    wide = lambda c: f"cast({c} as decimal(28,0))"
    return F.expr(f"1 + (({wide(n)} + 5) * cast(1000000000 as decimal(10,0))) div ({wide(total)} + 5 * {wide(terms)})")


def _differences(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """For one slice of terms and one pair of source blocks: per ordered pair of sources, the sum over the slice's terms of |p - q| less
    what it would be if neither source had the term."""
    _, _, one, other = (k.as_py() for k in key)
    marks = rows.filter(pc.is_null(rows.column("term")))
    cells = rows.filter(pc.is_valid(rows.column("term")))
    names, z, side = (marks.column(c).to_pylist() for c in ("source", "z", "block"))
    zero = np.array(z, np.int64)
    table = np.zeros((len(names), len(names)), np.int64)
    if cells.num_rows:
        column = {name: i for i, name in enumerate(names)}
        coded = cells.column("term").combine_chunks().dictionary_encode()
        row = coded.indices.to_numpy().astype(np.int64)
        place = np.array([column[s] for s in cells.column("source").to_pylist()])
        p = cells.column("p").to_numpy()
        order = np.argsort(row, kind="stable")
        row, place, p = row[order], place[order], p[order]
        apart = np.abs(zero[:, None] - zero[None, :])
        edges = np.searchsorted(row, np.arange(0, row[-1] + 1 + _TERMS_AT_ONCE, _TERMS_AT_ONCE))
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            terms = min(_TERMS_AT_ONCE, int(row[-1]) + 1 - i * _TERMS_AT_ONCE)
            dense = np.repeat(zero[:, None], terms, axis=1)
            dense[place[a:b], row[a:b] - i * _TERMS_AT_ONCE] = p[a:b]
            for j in range(len(names)):
                table[j] += np.abs(dense - dense[j]).sum(axis=1)
            table -= terms * apart
    block = np.array(side)
    wanted = (block[:, None] == one) & (block[None, :] == other) | (block[:, None] == other) & (block[None, :] == one)
    np.fill_diagonal(wanted, False)
    a, b = np.nonzero(wanted)
    source = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "source": source.take(pa.array(a)), "item": source.take(pa.array(b)),
                     "d": table[a, b], "apart": np.abs(zero[a] - zero[b])})


def divergence(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank over `docs` (text, lang, source).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the terms that `least` of its
    rows hold (repeated rows count as often as they stand there). Null texts, languages and sources count as empty strings; a group
    without terms has its pairs too. Equal values rank by item. An empty table gives no rows.

    A term of a source is a cell. Pairs of sources are compared in blocks of about SOURCES sources and slices of about CELLS
    cells of a language, so that neither a large language nor many sources meet in one task; terms that neither source has differ by
    the same amount, which is added once for all.
    """
    prepare(docs.sparkSession)
    counted = shard_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    counted = materialize(counted, "term-counts")
    words = counted.filter("term <> ''")
    kept = materialize(words.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).filter(F.col("df") >= least).drop("df"), "kept-terms")
    cells = words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("cells"))
    whole = kept.groupBy("lang").agg(F.sum("all").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    marks = counted.filter("term = ''").select("lang", "source")
    shape = marks.join(totals, ["lang", "source"], "left").groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("cells").alias("lang_cells"))
    shape = shape.select("lang", F.ceil(F.col("sources") / SOURCES).cast("int").alias("blocks"),
                         F.greatest(F.lit(1), F.ceil(F.coalesce("lang_cells", F.lit(0)) / CELLS)).cast("int").alias("slices"))
    zeros = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")}
    groups = marks.join(totals.drop("cells"), ["lang", "source"], "left").join(whole, "lang", "left").join(shape, "lang")
    groups = groups.withColumns({c: e for c, e in zeros.items()}).withColumn("z", F.when(F.col("terms") == 0, F.lit(0).cast("long")).otherwise(_share("0", "total", "terms")))
    groups = materialize(groups.withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int")), "source-groups")
    shared = cells.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    keys = ["lang", "slice", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "source", "block"]
    points = shared.withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int")).withColumn("other", other).select(*keys, "term", "p", "z")
    every = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("other", other)
    every = every.select(*keys, F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "z")
    compared = points.unionByName(every).groupBy("lang", "slice", "one", "two").applyInArrow(
        _differences, "lang string, source string, item string, d long, apart long")
    pairs = compared.groupBy("lang", "source", "item").agg(F.sum("d").alias("d"), F.max("apart").alias("apart"))
    pairs = pairs.join(whole.select("lang", "terms"), "lang", "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce(F.col("d") + F.col("apart") * F.col("terms"), F.lit(0).cast("long")).alias("value"))
    over = shared.withColumn("q", _share("all", "lang_total", "terms")).filter(F.col("p") > F.col("q"))
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(best)) for x in (pairs, over)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))


def oracle_sql(least: int = 30, top: int = 50) -> str:
    share = "(1 + (1000000000*(CAST({n} AS HUGEINT)+5))//({total}+5*V))".format
    return f"""WITH d AS (SELECT coalesce(lang,'') AS lang, coalesce(source,'') AS source, row_number() OVER () AS row,
  regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
 t AS (SELECT lang, source, row, unnest(w) AS term FROM d),
 kept AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY 1,2 HAVING count(DISTINCT row) >= {least}),
 whole AS (SELECT lang, sum(n) AS N, count(*) AS V FROM kept GROUP BY 1),
 cells AS MATERIALIZED (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1,2,3),
 groups AS MATERIALIZED (SELECT lang, source FROM d GROUP BY 1,2),
 total AS (SELECT g.lang, g.source, sum(coalesce(n,0)) AS total FROM groups g LEFT JOIN cells USING (lang, source) GROUP BY 1,2),
 p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n,0) AS n, {share(n='coalesce(c.n,0)', total='total')} AS p, {share(n='k.n', total='whole.N')} AS q
   FROM total g JOIN kept k ON g.lang=k.lang JOIN whole ON whole.lang=g.lang LEFT JOIN cells c ON c.lang=g.lang AND c.source=g.source AND c.term=k.term),
 pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p-b.p)) AS value FROM p a JOIN p b ON a.lang=b.lang AND a.term=b.term AND a.source<>b.source GROUP BY 1,2,3),
 allpairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value,0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang=b.lang AND a.source<>b.source
   LEFT JOIN pairs ON pairs.lang=a.lang AND pairs.source=a.source AND pairs.item=b.source),
 terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p-q AS BIGINT) AS value FROM p WHERE n>0 AND p>q)
 SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM allpairs
 UNION ALL SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM terms) WHERE rank <= {top}"""

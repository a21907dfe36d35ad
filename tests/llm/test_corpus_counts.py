"""Vector codes, backoff automaton and source divergence against brute force and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from pulseloom.llm import backoff, divergence, vector_codes
from pulseloom.llm.common import prepare
from tests.compare import connect, mismatch
from tests.llm import cases

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    T.StructField("code", T.StringType()), T.StructField("error", T.StringType()), T.StructField("key", T.StringType()), T.StructField("data", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("nth", T.StringType()),
])


def vector_rows(spark, rows):
    return spark.createDataFrame([(i, e, label, "c", "e", "k", "d", "n", "t") for i, e, label in rows], VECTORS)


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 1e300 else math.floor(x) * 1024 for x in e], label) for i, e, label in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[e[p * size : (p + 1) * size] for p in range(parts)] for _, e, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for x in cut:
                groups[near(x[p], books[p])[0]].append(x[p])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[k])] if k in groups else old for k, old in enumerate(books[p])]
    label_error, made = Counter(), []
    for (i, _, label), x in zip(kept, cut):
        got = [near(x[p], books[p]) for p in range(parts)]
        made.append((i, "".join(f"{k:02x}" for k, _ in got), sum(d for _, d in got), label))
        label_error[label] += made[-1][2]
    text = ",".join(str(v) for b in books for c in b for v in c)
    return sorted(((i, c, e, label_error[lab], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, lab in made), key=repr)


def some_vectors(n, width=8, scale=1.0, seed=3):
    r = random.Random(seed)
    centres = [[r.uniform(-scale, scale) for _ in range(width)] for _ in range(5)]
    rows = [(r.randrange(10 * n), [c + r.gauss(0, scale / 20) for c in r.choice(centres)], r.choice([None, 1, 2])) for _ in range(n)]
    return rows


@pytest.mark.parametrize("scale", [1.0, 40.0, 1e7, 1e12])
def test_codes_are_those_of_brute_force(spark, scale):
    """Every number type: small, 32-bit, doubles and Python integers; with copies, ties, nulls and odd values."""
    rows = some_vectors(120, scale=scale)
    rows += [rows[5]] * 40 + [(None, rows[7][1], 2), (5000, None, 1), (5001, [None] + [0.0] * 7, 1), (5002, [float("nan")] + [0.0] * 7, 1),
                             (5003, [float("inf")] + [0.0] * 7, 1), (5004, [-0.5 / 1024] * 8, 3)]
    got = vector_codes.compress(vector_rows(spark, rows), entries=7, block=16)
    want = brute_codes(rows, entries=7)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    cap = lambda e: e if e < 1 << 63 else None  # noqa: E731  sums beyond 63 bits are null
    assert rows_of(got) == sorted(((i, c, cap(e), cap(s), h) for i, c, e, s, h in want), key=repr)


def test_codes_do_not_depend_on_the_blocks(spark):
    df = vector_rows(spark, some_vectors(300))
    a, b = (sorted(map(tuple, vector_codes.compress(df, entries=16, block=k).collect())) for k in (7, 512))
    assert a == b


def test_codes_of_odd_tables(spark):
    assert vector_codes.compress(vector_rows(spark, [])).count() == 0
    rows = [(1, [], 1), (2, [1.0, 2.0, 3.0], 1), (3, [1.0, 2.0, 3.0, 4.0], 1), (4, [1.0] * 8, None)]
    got = {r.vec_id: r for r in vector_codes.compress(vector_rows(spark, rows)).collect()}
    assert len(got) == 4 and got[3].code == "00000000" and got[3].error == 0
    assert got[1].code is None and got[2].error is None and got[1].label_error == 0 and got[4].label_error is None
    assert vector_codes.compress(vector_rows(spark, rows[:2])).select("code").distinct().collect()[0][0] is None


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 4), st.integers(1, 3), st.randoms())
def test_the_curve_visits_every_cell_once(width, bits, r):
    """Neighbours on the curve are neighbours in the grid."""
    side = 1 << bits
    cells = np.array(np.meshgrid(*[range(side)] * width)).reshape(width, -1).T
    keys = vector_codes.hilbert_keys(cells, bits)
    assert len(set(keys)) == side**width
    order = sorted(range(len(keys)), key=keys.__getitem__)
    assert all(abs(cells[a] - cells[b]).sum() == 1 for a, b in zip(order, order[1:]))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 30))
def test_the_shortlist_keeps_every_nearest_entry(seed):
    r = np.random.default_rng(seed)
    book, rows = r.integers(-9, 9, (12, 3)), r.integers(-9, 9, (5, 3)) + r.integers(-20, 20)
    some = vector_codes.shortlist(rows.min(axis=0), rows.max(axis=0), book)
    d = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    k, e = vector_codes.nearest(rows, book, some)
    assert (k == d.argmin(axis=1)).all() and (e == d.min(axis=1)).all()


LOWER = {i: i + 32 for i in range(65, 91)}
WORD, TERM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_scores(rows, order=3, mu=backoff.MU):
    held = [zlib.crc32(("null" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    texts = [[*WORD.findall((t or "").translate(LOWER)), ""] for _, t in rows]
    c = Counter(tuple(w[i : i + k]) for w, h in zip(texts, held) if not h for k in range(1, order + 1) for i in range(len(w) - k + 1))
    n, v = sum(x for g, x in c.items() if len(g) == 1), sum(len(g) == 1 for g in c)

    def p(g):
        return (c[g] + 1) / (n + v + 1) if len(g) == 1 else (c[g] + mu * p(g[1:])) / (c[g[:-1]] + mu)

    out = []
    for (i, _), h, w in zip(rows, held, texts):
        base = math.fsum(math.log10((c[x,] + 1) / (n + v + 1)) for x in w)
        out.append((i, h, len(w), sum(c[x,] > 0 for x in w), n, round(base, 6), round(math.fsum(math.log10(p(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(len(w))), 6)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=2e-6)


@pytest.mark.parametrize("order,block,bucket", [(3, 1 << 24, 1 << 20), (3, 2_000, 50), (2, 2_000, 50), (1, 2_000, 50), (4, 20_000, 100)])
def test_scores_are_those_of_brute_force(spark, order, block, bucket):
    """Whatever the blocks and buckets, over texts of any length."""
    prepare(spark)
    close(rows_of(backoff.score(cases.docs(spark), order, block=block, bucket=bucket)), brute_scores(cases.TEXTS, order))


def test_scores_of_many_small_texts(spark):
    prepare(spark)
    r = random.Random(5)
    words = ["a", "b", "B", "c d", "e\tf", "g\x0bh", "\xa0", "É", "é", "z" * 70]
    rows = [(i % 97, " ".join(r.choices(words, k=r.randrange(0, 40)))) for i in range(400)] + [(1, "the same text")] * 150
    close(rows_of(backoff.score(cases.docs(spark, rows).repartition(7), block=1_500, bucket=100)), brute_scores(rows))


def test_scores_of_odd_tables(spark):
    prepare(spark)
    assert backoff.score(cases.empty(spark)).count() == 0
    only_held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = [(i, "some words") for i in only_held]
    assert rows_of(backoff.score(cases.docs(spark, rows))) == sorted((i, True, 3, 0, 0, 0.0, 0.0) for i in only_held)
    text_id = spark.createDataFrame([("x", "a b a"), (None, None)], "doc_id string, text string")
    assert {r.doc_id: r.n_tokens for r in backoff.score(text_id).collect()} == {"x": 4, None: 1}


def test_probabilities_add_up_to_one(spark):
    """Over all known words and one unknown, after any context."""
    docs = [["a", "b", "a", "c", ""], ["a", "b", "b", ""]]
    flat = [w for d in docs for w in d]
    vocabulary = sorted(set(flat)) + ["?"]
    words, lengths = np.array([vocabulary.index(w) for w in flat]), np.array([5, 4])
    place = np.arange(9) - np.repeat([0, 5], lengths)
    grams = []
    for k in range(1, 4):
        grams.append(backoff.Grams(k, words, place, np.ones(9, bool), grams[-1] if grams else None, np.arange(len(vocabulary)).astype(np.uint64) + np.uint64(11)))
    machine = backoff.build_automaton(grams, [g.own for g in grams], 9, 4)
    for context in ([], [1], [1, 2], [2, 2], [4, 1], [1, 3]):
        state = np.zeros(1, np.int64)
        for w in context:
            _, state = machine.step(state, np.array([w]))
        every, _ = machine.step(np.repeat(state, len(vocabulary)), np.arange(len(vocabulary)))
        assert (10.0**every).sum() == pytest.approx(1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=30), st.lists(st.integers(0, 10**12), max_size=30))
def test_packed_keys_and_counts(keys, counts):
    keys = np.sort(np.array(keys, np.uint64))
    assert (backoff.grow(backoff.shrink(keys), len(keys)) == keys).all()
    counts = np.array(counts, np.int64)
    assert (backoff.unpack_counts(backoff.pack_counts(counts), len(counts)) == counts).all()


def brute_divergence(rows, least, top):
    terms = [(lang or "", source or "", TERM.findall((t or "").translate(LOWER))) for t, lang, source in rows]
    df, n = Counter(), Counter()
    for lang, source, w in terms:
        df.update((lang, x) for x in set(w))
        n.update((lang, source, x) for x in w)
    out = []
    for lang in {t[0] for t in terms}:
        kept = sorted((x for (a, x), c in df.items() if a == lang and c >= least), key=str.encode)
        sources = sorted({t[1] for t in terms if t[0] == lang}, key=str.encode)

        def share(count):
            total = sum(count[x] for x in kept)
            return {x: 1 + 10**9 * (count[x] + 5) // (total + 5 * len(kept)) for x in kept}

        p = {s: share(Counter({x: n[lang, s, x] for x in kept})) for s in sources}
        q = share(Counter({x: sum(n[lang, s, x] for s in sources) for x in kept}))
        for s in sources:
            pair = [(-sum(abs(p[s][x] - p[o][x]) for x in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[x] - p[s][x], x.encode(), x) for x in kept if n[lang, s, x] and p[s][x] > q[x]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(found)[:limit])]
    return sorted(out, key=repr)


SHAPE = "text string, lang string, source string, term string, n string, df string, p string, rank string"


def divergence_rows(spark, rows):
    return spark.createDataFrame([(*r, "t", "n", "d", "p", "r") for r in rows], SHAPE)


def mixed_rows(n, seed=1):
    r = random.Random(seed)
    words = ["the", "The", "a", "été", "Été", "straße", "日本語", "x" * 8, "x" * 9, "x" * 90, "x" * 90 + "y", "z1z", "don't", "[a]", "@", ""] + [f"w{chr(97 + i)}" for i in range(20)]
    langs, sources = [None, "", "en", "de"], [None, "", "s1", "s2", "s3", "é"]
    return [(" ".join(r.choices(words, k=r.randrange(0, 30))), r.choice(langs), r.choice(sources)) for _ in range(n)]


@pytest.mark.parametrize("sources,cells", [(128, 200_000), (2, 10)])
def test_divergence_is_that_of_brute_force(spark, monkeypatch, sources, cells):
    """With one block of all sources, and with many blocks and slices."""
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = mixed_rows(300) + [(None, "en", "s1"), (None, "xx", "only"), ("", "xx", "other"), ("\x00 \x7f1234", "xx", "third"), ("ab " * 30_000, "en", "long"), ("ba" * 20_000, "en", "s9")]
    got = rows_of(divergence.divergence(divergence_rows(spark, rows).repartition(5), least=5, top=4))
    assert got == brute_divergence(rows, 5, 4)


def test_divergence_of_odd_tables(spark):
    assert divergence.divergence(divergence_rows(spark, [])).count() == 0
    assert rows_of(divergence.divergence(divergence_rows(spark, [(None, None, None), (None, None, "a")]))) == [("", "", "pair", "a", 0, 1), ("", "a", "pair", "", 0, 1)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAbZé日 1\n_[{", max_size=25), max_size=6))
def test_pointers_of_a_shard(texts):
    g, terms, n, df = divergence.count_shard(pa.array(texts, pa.string()), np.arange(len(texts)) % 2, 2)
    words = [TERM.findall(t.translate(LOWER)) for t in texts]
    want, docs = Counter(), Counter()
    for i, w in enumerate(words):
        want.update((i % 2, x) for x in w)
        docs.update((i % 2, x) for x in set(w))
    keys = list(zip(g.tolist(), terms.to_pylist()))
    assert dict(zip(keys, n.tolist())) == want and dict(zip(keys, df.tolist())) == docs


@pytest.mark.parametrize("name", ["op11_backoff", "op12_vector_codes", "op13_divergence"])
def test_queries_match_their_sql(spark, sf, name):
    from pulseloom.llm import queries

    assert mismatch(queries.QUERIES[name](spark, sf), connect(sf), queries.SQL[name]) is None

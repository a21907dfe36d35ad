"""Encoding, blocks on disk and prefix counts against the tokenizers library."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulseloom.llm import pieces, prefix_counts, token_blocks, tree_bpe
from pulseloom.llm.common import prepare, shared_dir
from tests.llm import cases

PATH = public_tokenizers.path(pieces.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'", "l", "1", "23", "²", "é", "ß", "日本", "!", "##", "<|endoftext|>", "<|endof", " ", "　", "\x1c", "\r\n", "😀", "ing", "    "]
texts = st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=20)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts)
def test_encoding_is_the_library_s(text):
    bpe = pieces.load(PATH)
    want = ids(text)
    assert pieces.encode_batch(bpe, [text])[0].tolist() == want
    assert bpe.decode(np.array(want, np.uint32)) == LIBRARY.decode(want, skip_special_tokens=False)
    for leaf in (1, 3, 7):
        assert list(tree_bpe.encode_long(bpe, text, leaf)) == want


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(0, 8))
def test_every_prefix_is_counted(text, limit):
    counter = prefix_counts.load(PATH)
    want = [len(ids(text[:k])) for k in range(len(text) + 1)]
    assert counter.table(text) == want[1:]
    assert counter.text(text, limit) == (want[-1], max(k for k, n in enumerate(want) if n <= limit))


@pytest.mark.parametrize("word", ["\U0001f004" * 90, "\u16a0" * 100, "\u9f98\u9750\u7228" * 60, "\u16a0" * 250, "a" * 255 + "\u16a0" * 40, "\u16a0" * 300])
def test_words_of_more_than_255_tokens(word):
    counter = prefix_counts.Counter(PATH)
    want = [len(ids(word[:k])) for k in range(len(word) + 1)]
    assert want[-1] > 255 or "a" in word
    for _ in range(2):  # learned, then remembered
        assert counter.table(word) == want[1:]
        for limit in (200, 256, 1024):
            assert counter.text(word, limit) == (want[-1], max(k for k, n in enumerate(want) if n <= limit))
    some = f"an {word} end {word}!"
    assert counter.text(some, 1 << 20) == (len(ids(some)), len(some))


@pytest.mark.parametrize("unit", ["<|endoftext|>", "a<|endoftext|>", "'s<|endoftext|>  b"])
def test_very_many_special_tokens(unit):
    """Counted one after the other, in a text and in the table of its prefixes."""
    counter = prefix_counts.Counter(PATH)
    some = unit * 40
    want = [len(ids(some[:k])) for k in range(1, len(some) + 1)]
    assert counter.table(some) == want
    many = unit * 100_000
    assert counter.text(many, 1024)[0] == len(ids(many))
    table = counter.table(many)
    assert len(table) == len(many) and table[: len(want) - 13] == want[:-13] and table[-1] == len(ids(many))


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 40)
    bpe, rng = pieces.Bpe(PATH), random.Random(3)
    for _ in range(30):
        some = ["".join(rng.choice("abcé,. ") for _ in range(60)) for _ in range(5)] + ["x\n  y  z", "", " ", "1 <|endoftext|> 2"]
        assert [e.tolist() for e in pieces.encode_batch(bpe, some)] == [ids(t) for t in some]
        assert len(bpe.known.names) < 200


def test_unsplit_texts_are_joined_exactly():
    bpe, rng = pieces.load(PATH), random.Random(5)
    some = ["a" * 20_000, "".join(rng.choice("abcdet") for _ in range(20_000)), "".join(rng.choice("ab!日é1") for _ in range(9_000)), " " * 9_000 + "x", "ab" * 5_000 + " c" + "!?" * 4_000]
    for text in some:
        for leaf in (700, 5_000):
            assert list(tree_bpe.encode_long(bpe, text, leaf)) == ids(text)


@pytest.mark.parametrize("percentile", [0.5, 0.9, 1.0])
def test_blocks_round_trip(percentile):
    rng = np.random.default_rng(3)
    for values in (rng.zipf(1.3, 1280).clip(0, 50_256), rng.integers(0, 2**32, 256), np.zeros(128), np.zeros(0)):
        v = values.astype(np.uint32)
        data, size = token_blocks.pack(v, percentile)
        assert (token_blocks.unpack(data, np.cumsum(size) - size) == v).all()


def test_files_are_read_back(spark):
    prepare(spark)
    docs = cases.docs(spark)
    files = token_blocks.write_tokens(docs, shared_dir(spark, "tokens"))
    got = token_blocks.read_tokens(spark, files).collect()
    rows = sorted(cases.TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [(i is not None, i or 0) for i, _ in rows]
    want = sorted((i is not None, i or 0, len(e) + 1, zlib.crc32(np.array(e + [2], "<u4").tobytes())) for i, t in rows for e in [ids(t or "")])
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    reader = token_blocks.Reader(files[0][0])
    whole = reader.tokens(0, reader.n_tokens)
    assert reader.n_tokens < 300 or (reader.tokens(200, 100) == whole[200:300]).all()


def test_empty_tables(spark):
    prepare(spark)
    e = cases.empty(spark)
    assert token_blocks.tokens_on_disk(e).collect() == []
    assert tree_bpe.encode(e).collect() == []
    assert prefix_counts.count(e).collect() == []


def test_tables(spark):
    prepare(spark)
    docs = cases.docs(spark)
    for leaf in (40, tree_bpe.LEAF):
        got = tree_bpe.encode(docs, output=tree_bpe.digest, fields=tree_bpe.DIGEST, leaf=leaf).collect()
        want = []
        for i, t in cases.TEXTS:
            e = ids(t or "")
            back = LIBRARY.decode(e, skip_special_tokens=False)
            want.append((i, len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    plain = {r.doc_id: (r.ids, r.decoded) for r in tree_bpe.encode(docs.filter("doc_id = 10")).collect()}
    assert plain == {10: (ids(cases.TEXTS[13][1]), cases.TEXTS[13][1])}
    counted = prefix_counts.count(docs, limit=20).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counted) == sorted(
        (repr(i), len((t or "").encode()), len(ids(t or "")), len(ids(t or "")) > 20) for i, t in cases.TEXTS)
    table = prefix_counts.prefix_table(docs.filter("doc_id = 9")).collect()
    assert {tuple(r.counts) for r in table} == {tuple(len(ids(t[:k])) for k in range(1, len(t) + 1)) for i, t in cases.TEXTS if i == 9}


def test_queries(spark, sf):
    from pulseloom.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    blocks, encoded, counts, start = {}, {}, {}, 0
    for r in rows:
        e = ids(r.text or "")
        blocks[r.doc_id] = start, len(e) + 1, zlib.crc32(array("I", [*e, 2]).tobytes())
        start += len(e) + 1
        encoded[r.doc_id] = len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(e, skip_special_tokens=False).encode()).hexdigest()
        counts[r.doc_id] = len((r.text or "").encode()), len(e), len(e) > 1024
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_blocks"](spark, sf).collect()} == blocks
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_tree_bpe"](spark, sf).collect()} == encoded
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op9_prefix_counts"](spark, sf).collect()} == counts


def test_pieces_of_odd_spaces():
    assert pieces.cut("a b  c") == ["a", "b ", "c"] or "".join(pieces.cut("a b  c")) == "ab c"
    p = pieces.Pieces(pa.array(["a b", "x\n y", None, ""]))
    assert len(p.offsets) == 5

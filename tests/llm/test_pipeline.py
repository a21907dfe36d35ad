"""The pipeline's stages: their columns, their decisions, and the same stages by brute force."""

import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from pulseloom.llm import pieces, pii, quality_rules
from pulseloom.llm.common import map_text
from tests.llm import cases
from tests.llm.test_links import brute_fingerprint, brute_match, groups
from tests.llm.test_spans_pages import brute_mask, unmarked


def test_run_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    names = [m for m in quality_rules.MEASURES]
    good = []
    for i, t in docs:
        m = dict(zip(names, quality_rules.measure(t or "")))
        n = m["n_words"]
        bad = (n < 50, 100 * m["n_repeat_words"] > 50 * n, 10 * m["n_symbols"] > n, 100 * m["n_dup_lines"] > 50 * m["n_lines"], 100 * m["n_upper_words"] > 50 * n, m["word_chars"] < 2 * n or m["word_chars"] > 15 * n)
        if not any(bad):
            good.append((i, t))
    roots = groups([brute_fingerprint(t) for _, t in good], lambda a, b: (a ^ b).bit_count() <= 4)
    first = {r: min(i for (i, _), x in zip(good, roots) if x == r) for r in set(roots)}
    one = [(i, t) for (i, t), r in zip(good, roots) if first[r] == i]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    word_sets = [set(re.findall(r"\w+", x.lower())) for x in items]
    clean = []
    for i, t in one:
        words = set(re.findall(r"\w+", t.lower()))
        if not any(len(words & s) >= 0.5 * len(s) and brute_match(t, x) for x, s in zip(items, word_sets)):
            clean.append((i, t))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(got) == sorted(i for i, _ in clean)
    library = Tokenizer.from_file(public_tokenizers.path(pieces.VOCABULARY))
    frame = spark.createDataFrame(clean, "doc_id long, text string")
    model = pii.fit_on(map_text(frame, pii.propose, pii.FOUND, keep=()))
    masked, untouched = {r.doc_id: r.text for r in pii.mask(frame).collect()}, 0
    for i, t in clean:
        assert unmarked(masked[i]) == brute_mask(t, model) if masked[i] != t else brute_mask(t, model) == t
        untouched += masked[i] == t
        ids = library.encode(masked[i], add_special_tokens=False).ids
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(masked[i].encode()).hexdigest()
    assert 0 < untouched < len(clean)


def test_stages_keep_columns(spark, sf):
    for rows in (cases.TEXTS, []):
        docs = cases.docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
            assert out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == len(rows)


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))

"""Quality rules, the subword classifier and the toxic lexicon."""

import random
import re
import time
import zlib

from pulseloom.llm import quality_rules as qr
from pulseloom.llm import subwords, toxicity
from pulseloom.llm.common import prepare
from tests.compare import connect, mismatch
from tests.llm import cases


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


def test_measurements(spark):
    prepare(spark)
    short = [(i, t) for i, t in cases.TEXTS if len(t or "") < 1000]
    got = qr.verdicts(cases.docs(spark, short)).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(brute(t or "") for _, t in short)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    for text in ("a b c a b c a b c d", "x\nx\n\n \nx y\n", "a a a a", "a b c d e", "a b c x a b c d a b"):
        m = dict(zip(qr.MEASURES, qr.measure(text)))
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == brute(text)


def test_rules_keep_columns_and_empty_tables(spark):
    prepare(spark)
    docs = cases.docs(spark)
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.kept, r.n_words) for r in kept.orderBy("doc_id").collect()] == [(1, "k", "w"), (1, "k", "w"), (3, "k", "w")]
    assert qr.verdicts(cases.empty(spark)).count() == 0 and qr.keep_good(cases.empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    prepare(spark)
    led = qr.ledger(cases.docs(spark)).cache()
    rows = led.collect()
    for version, names in qr.POLICIES.items():
        bits = qr.mask(names)
        got = {r.rule: r for r in qr.ablations(led, version).collect()}
        assert set(got) == set(names)
        for n in names:
            bit = qr.mask([n])
            assert got[n].fail == sum(bool(r.failed_rules & bit) for r in rows)
            assert got[n].only_this == sum(r.failed_rules & bits == bit for r in rows)
        kept = qr.apply_policy(led, version).filter("kept").count()
        assert kept == sum(not r.failed_rules & bits for r in rows)


def test_rules_query(spark, sf):
    from pulseloom.llm.queries import QUERIES, SQL

    assert mismatch(QUERIES["op1_quality_rules"](spark, sf), connect(sf), SQL["op1_quality_rules"]) is None


def accuracy(df, labels, column):
    rows = df.join(labels, "doc_id").filter("held_out").select("predicted", column).collect()
    return len(rows), sum(r.predicted == r[column] for r in rows)


def test_scores_are_learned(spark):
    from pulseloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, column, limit in (("op2_subwords", "quality", 0.3), ("op10_toxicity", "toxic", 0.5)):
        df = QUERIES[name](spark, sf).cache()
        assert df.count() == docs.count()
        n, right = accuracy(df, labels, column)
        assert n > 50 and right >= 0.95 * n
        for r in df.collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)


def test_scores_of_odd_texts(spark):
    prepare(spark)
    lexicon = toxicity.learn([("you idiot", 1), ("a fine day", 0)])
    model = subwords.train([("good words here now", 1), ("### $$$ ### $$$", 0)])
    for df in (toxicity.score(cases.docs(spark), lexicon), subwords.score(cases.docs(spark), model)):
        rows = df.collect()
        assert len(rows) == len(cases.TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(cases.empty(spark), lexicon).count() == 0 and subwords.score(cases.empty(spark), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.learned_score(cases.docs(spark), labels).count() == len(cases.TEXTS)
    assert subwords.learned_score(cases.docs(spark), labels).count() == len(cases.TEXTS)


def test_lexicon_folds_and_excuses():
    lexicon = toxicity.Lexicon({toxicity.folded(w): 2.0 for w in ("idiot", "clown", "trash")}, tuple(map(toxicity.folded, toxicity.EXCEPTIONS)), 4.0, -2.0)
    for text in ("You IDIOT", "an 1d10t", "two іdіоts", "c1own", "such tra$h"):
        assert lexicon.found(text), text
    for text in ("", "a trash can", "two clown fish", "semidiotic", "fine"):
        assert not lexicon.found(text), text
    assert lexicon.found("a trash can and trash") and lexicon.score("idiot " * 3) > lexicon.score("idiot " + "fine " * 500)


def test_exception_phrases_are_walked_once():
    """As many entries and phrases as one likes; the same entries as by comparing all with all."""
    lexicon = toxicity.Lexicon({toxicity.folded(w): 2.0 for w in ("idiot", "clown", "trash", "scum", "loser")}, tuple(map(toxicity.folded, toxicity.EXCEPTIONS)), 4.0, -2.0)
    rng = random.Random(4)
    for _ in range(50):
        text = " ".join(rng.choices(["trash", "can", "pond", "scum", "line", "idiot", "bad", "loser", "pays", "clown", "fish"], k=30))
        t = toxicity.folded(text)
        phrases = [(m.start(), m.end()) for p in lexicon.exceptions for m in re.finditer(rf"(?=\b({p})\b)", t) for m in [re.compile(p).match(t, m.start())]]
        words = [(m.start(), m.end()) for w in lexicon.weights for m in re.finditer(rf"\b{w}", t)]
        assert [x[:2] for x in lexicon.found(text)] == sorted(x for x in words if not any(a <= x[0] and x[1] <= b for a, b in phrases))
    start = time.perf_counter()
    assert lexicon.rated("trash can idiot " * 100_000)[1] == 100_000
    assert time.perf_counter() - start < 20


def test_lexicon_ignores_copied_texts():
    rng = [f"{a}{b}{c}" for a in ("mor", "tal", "ven", "sil") for b in ("do", "ra", "ne", "ku") for c in ("st", "nt", "lm", "rk")]
    copied = " ".join(rng[:40]) + " dreck " + rng[41]
    sample = [(copied, 1)] * 50 + [(f"{w} dreckig {rng[-i]}", 1) for i, w in enumerate(rng, 1)] + [(" ".join(rng[i:] + rng[:i]) + " ruhe", 0) for i in range(60)]
    learned = toxicity.learn(sample, min_contexts=10)
    assert {w for w in learned.weights if w.startswith("dreck")} and not any(w in learned.weights for w in map(toxicity.folded, rng))

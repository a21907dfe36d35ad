"""SimHash groups, components and benchmark passages against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import xxhash

from pulseloom.llm import simhash, spaced_seeds
from pulseloom.llm.common import prepare
from pulseloom.llm.components import components
from tests.llm import cases


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(values, near):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_code_is_perfect():
    words = simhash.golay_words()
    assert len(set(words.tolist())) == 4096
    least = min(int(np.bitwise_count(words[0] ^ w)) for w in words[1:])
    assert least == 7
    table, values = simhash.home_table(), np.random.default_rng(1).integers(0, 1 << 23, 500).astype(np.uint32)
    assert (np.bitwise_count(words[table[values]] ^ values) <= 3).all()
    for threshold in (1, 2):
        rows, anchors, t = simhash.anchors_of(values, 23, threshold)
        for r in range(0, 500, 50):
            away = np.bitwise_count(words ^ values[r])
            assert set(anchors[rows == r].tolist()) == set(np.flatnonzero(away <= 3 + threshold).tolist())
            assert anchors[(rows == r) & (t == 0)].tolist() == [table[values[r]]]


def test_groups_match_brute_force(spark):
    prepare(spark)
    rng = random.Random(11)
    values = []
    for _ in range(60):
        x = rng.getrandbits(64)
        values.append(x)
        for _ in range(rng.randint(0, 4)):  # chains of values that differ in up to 5 bits
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            values.append(x)
    values = sorted(set(values))
    want = groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    for chunk, fine in ((simhash.CHUNK, False), (1, False), (simhash.CHUNK, True)):
        before, simhash.CHUNK = simhash.CHUNK, chunk
        try:
            fps = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
            label = {r.node: r.label for r in components(simhash.links(fps, fine=fine)).collect()}
        finally:
            simhash.CHUNK = before
        got = [label.get(simhash.signed(v), simhash.signed(v)) for v in values]
        assert [got.index(g) for g in got] == [want.index(w) for w in want]


def test_long_chains(spark):
    prepare(spark)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1500), (1500, 1200), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1200: 1000, 1500: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    prepare(spark)
    got = simhash.verdicts(cases.docs(spark)).collect()
    prints = [brute_fingerprint(t) for _, t in cases.TEXTS]
    roots = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    ids = [i for i, _ in cases.TEXTS]
    least = {r: min((i for i, x in zip(ids, roots) if x == r and i is not None), default=None) for r in roots}
    want = sorted((repr(i), f"{p:016x}", repr(least[r])) for i, p, r in zip(ids, prints, roots))
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got) == want
    kept = simhash.keep_one(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(least[r]) for r in set(roots))
    assert simhash.verdicts(cases.empty(spark)).count() == 0 and simhash.keep_one(cases.empty(spark)).count() == 0


def test_simhash_query(spark, sf):
    from pulseloom.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    roots = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {r: min(x.doc_id for x, y in zip(rows, roots) if y == r) for r in roots}
    want = {x.doc_id: (f"{p:016x}", least[r]) for x, p, r in zip(rows, prints, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, sf).collect()} == want


ITEM = "the quick brown fox jumps over a lazy dog while seven grey birds watch from one old wooden fence near town"


def brute_match(text, item, length=spaced_seeds.LENGTH, share=spaced_seeds.SHARE):
    """Some diagonal has a stretch of `length` words with the share, in which some mask's window fits."""
    a, b = re.findall(r"\w+", (text or "").lower()), re.findall(r"\w+", (item or "").lower())
    size = min(length, len(b))
    masks = [m for m in spaced_seeds.MASKS if len(m) <= len(b)] or ["1" * len(b)]
    for shift in range(-len(b), len(a)):
        same = [0 <= k + shift < len(a) and a[k + shift] == b[k] for k in range(len(b))]
        for m in masks:
            n = max(size, len(m))
            for s in range(len(b) - n + 1):
                ok = 0 <= s + shift and s + n + shift <= len(a)
                seeds = any(all(same[s + w + k] for k, c in enumerate(m) if c == "1") for w in range(n - len(m) + 1))
                if ok and b and seeds and sum(same[s : s + n]) >= share * n:
                    return True
    return False


def test_passages(spark):
    prepare(spark)
    words = ITEM.split()
    swapped = [w if i % 7 else "other" for i, w in enumerate(words)]
    texts = [
        (1, "before it " + ITEM.upper() + " after it"), (2, " ".join(swapped)), (3, " ".join(words[:9]) + " and then something else entirely different"), (4, " ".join(words[:15])),
        (5, "nothing of the kind"), (6, None), (7, ""), (8, "six short words are here now ok"), (9, ITEM), (9, ITEM), (10, ", ".join(words)), (None, ITEM),
        (11, " ".join(reversed(words))), (12, "filler " * 3000 + ITEM + " filler" * 3000),
    ]
    items = [(1, ITEM), (2, "six short words are here now"), (3, None), (4, ""), (5, "single")]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    docs = cases.docs(spark, texts)
    got = {(r.doc_id, r.item_id) for r in spaced_seeds.matches(docs, benchmark).collect()}
    assert got == {(i, n) for i, t in texts for n, x in items if x and brute_match(t, x)}
    assert {(1, 1), (2, 1), (8, 2), (12, 1)} <= got and (3, 1) not in got
    left = spaced_seeds.remove(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, t in texts if not any(x and brute_match(t, x) for _, x in items))
    assert spaced_seeds.matches(cases.empty(spark), benchmark).count() == 0
    assert spaced_seeds.matches(docs, benchmark.limit(0)).count() == 0


def test_short_items_with_every_allowed_change(spark):
    prepare(spark)
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in range(1, spaced_seeds.LENGTH)}
    texts, want = [], set()
    for n, words in items.items():
        for differ in range(4):
            for out in combinations(range(n), differ):
                if differ == 3 and sum(out) % 5:
                    continue  # beyond what is allowed: some are enough
                changed = " ".join("other" if i in out else w for i, w in enumerate(words))
                if n - differ >= spaced_seeds.SHARE * n:
                    want.add((len(texts), n))
                texts.append((len(texts), f"before {changed} after"))
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    docs = cases.docs(spark, texts)
    got = {(r.doc_id, r.item_id) for r in spaced_seeds.matches(docs, benchmark).collect()}
    assert got == want and len(want) > 300
    assert {r.doc_id for r in spaced_seeds.remove(docs, benchmark).collect()} == {i for i, _ in texts} - {i for i, _ in want}


def test_covering_masks():
    for n in range(2, 21):
        for differ in range(min(4, n)):
            masks = spaced_seeds.covering(n, differ)
            assert all(len(m) == n and "1" in m for m in masks)
            assert all(any(all(m[i] == "0" for i in out) for m in masks) for out in combinations(range(n), differ))


def test_passages_of_the_tables(spark, sf):
    from pulseloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_spaced_seeds"](spark, sf).collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    whole = {(d.doc_id, b.item_id) for d in docs for b in items if plain(b.text) in plain(d.text)}
    assert whole and whole <= got
    for d, i in got - whole:
        assert brute_match(next(x.text for x in docs if x.doc_id == d), next(x.text for x in items if x.item_id == i))

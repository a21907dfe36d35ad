"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule. A policy
is a version, a mask of rules that reject. Applying a policy, comparing policies and asking what a single rule
rejects alone (ablation) are bitwise operations on the ledger; texts are not read again.
"""

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.common import SPACE, free, map_text

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "longest_word")


@dataclass(frozen=True)
class Rule:
    """`fails` is true for a document that breaks the rule; its bit is the rule's place in RULES."""

    name: str
    fails: str


#: Names and SQL conditions over the measurements. Bits never change their meaning: new rules are added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", "100 * n_upper_words > 50 * n_words"),
    Rule("odd_word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    Rule("endless_word", "longest_word > 1000"),
)
#: The rules of the base check, which every policy keeps.
BASE = ("few_words", "repeated_words")
#: Version -> rules that reject.
POLICIES = {
    1: ("few_words", "repeated_words", "many_symbols", "repeated_lines"),
    2: ("few_words", "repeated_words", "many_symbols", "repeated_lines", "shouting", "odd_word_length"),
}
POLICY = 2


def mask(names) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bits[n] for n in set(names))


def repeated_words(words: list) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = end = 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def measure(text: str) -> tuple:
    words = text.encode().split()  # splits at the ASCII white space of the contract only
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    shouted = sum(w.upper() == w != w.lower() for w in words) if text.upper() != text.lower() else 0
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        repeated_words(words), shouted, max(map(len, words), default=0),
    )


def failures() -> Column:
    """The rules' bits, from the measurements."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("long")


def ledger(docs: DataFrame, keep=("doc_id",), text="text") -> DataFrame:
    """Columns `keep`, the measurements and `failed_rules`, the bits of the rules that fail. Null texts count as empty.

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return;
    upper-case words are those of which ASCII letters all are upper case, `longest_word` is in bytes.
    """
    fields = ", ".join(f"{m} long" for m in MEASURES)
    measured = map_text(docs, lambda texts: dict(zip(MEASURES, zip(*map(measure, texts)))) if texts else {m: [] for m in MEASURES}, fields, text, keep)
    return measured.withColumn("failed_rules", failures())


def apply_policy(led: DataFrame, version: int = POLICY) -> DataFrame:
    """`base_failed`, `policy` and `kept` for every row of a ledger."""
    bits = F.col("failed_rules")
    base, rules = mask(BASE), mask(POLICIES[version]) | mask(BASE)
    return led.withColumns({
        "base_failed": bits.bitwiseAND(F.lit(base)) != 0, "policy": F.lit(version), "kept": bits.bitwiseAND(F.lit(rules)) == 0,
    })


def ablations(led: DataFrame, version: int = POLICY, by=()) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it rejects (kept without it).

    The ledger is first counted by its bits, at most 2 ** rules rows per group, so that adding rules costs no pass.
    Also the rules that all rejected documents fail and those that any fails, as bits.
    """
    rules = mask(POLICIES[version])
    counts = led.withColumn("bits", F.col("failed_rules").bitwiseAND(F.lit(rules))).groupBy(*by, "bits").agg(F.count(F.lit(1)).alias("n"))
    named = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if rules >> i & 1]))
    rows = counts.select("*", named.alias("r")).select(*by, "bits", "n", "r.rule", "r.bit")
    rejected = F.when(F.col("bits") != 0, F.col("bits"))
    return rows.groupBy(*by, "rule").agg(
        F.sum("n").alias("documents"), F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fail"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.bit_or(rejected).alias("any_fails"), F.bit_and(rejected).alias("all_fail"),
    )


def verdicts(docs: DataFrame, version: int = POLICY) -> DataFrame:
    """One row per document: measurements, bits, base_failed, kept. Repeated rows each get theirs."""
    return apply_policy(ledger(docs), version)


def keep_good(docs: DataFrame, version: int = POLICY) -> DataFrame:
    """The rows of `docs` that the policy keeps, columns unchanged (also those named like a measurement)."""
    packed = free("row__", docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(packed), F.col("text"))
    kept = apply_policy(ledger(rows, keep=(packed,)), version).filter("kept")
    return kept.select(*[F.col(packed)[c].alias(c) for c in docs.columns])


def oracle_sql() -> str:
    """The verdicts in SQL."""
    space = "[\\x20\\x09-\\x0D]+"
    fails = " | ".join(f"(CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END)" for i, r in enumerate(RULES))
    rules = mask(POLICIES[POLICY]) | mask(BASE)
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{space}'), lambda x: x <> '') AS ws,
   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{space}', '', 'g') <> '') AS ls FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, unnest(range(0, 3)) AS v(k) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g'))::BIGINT AS word_chars,
   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
   coalesce(r.n, 0)::BIGINT AS n_repeat_words,
   len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_upper_words,
   coalesce(list_max(list_transform(ws, lambda x: strlen(x))), 0)::BIGINT AS longest_word
   FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, ({fails})::BIGINT AS failed_rules FROM m)
SELECT *, failed_rules & {mask(BASE)} <> 0 AS base_failed, {POLICY} AS policy, failed_rules & {rules} = 0 AS kept FROM f"""

"""The queries of the corpus operators, each over its whole table, and the SQL that states a result where SQL can."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulseloom.llm import (
    backoff, divergence, html_runs, pii, prefix_counts, quality_rules, simhash, spaced_seeds, subwords, token_blocks, toxicity, tree_bpe, vector_codes,
)
from pulseloom.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_quality_rules", quality_rules.oracle_sql())
def op1(spark, sf_dir):
    return quality_rules.verdicts(read(spark, sf_dir, "documents"))


@query("op2_subwords")
def op2(spark, sf_dir):
    return subwords.learned_score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op3_token_blocks")
def op3(spark, sf_dir):
    return token_blocks.tokens_on_disk(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=2)


@query("op4_html_runs")
def op4(spark, sf_dir):
    return html_runs.extract(read(spark, sf_dir, "pages"))


@query("op5_spaced_seeds")
def op5(spark, sf_dir):
    """One row for each document and benchmark item whose passage it holds."""
    return spaced_seeds.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op6_tree_bpe")
def op6(spark, sf_dir):
    return tree_bpe.encode(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", tree_bpe.digest, tree_bpe.DIGEST)


@query("op7_simhash")
def op7(spark, sf_dir):
    return simhash.verdicts(read(spark, sf_dir, "documents"))


@query("op8_pii")
def op8(spark, sf_dir):
    return pii.find(read(spark, sf_dir, "documents"))


@query("op9_prefix_counts")
def op9(spark, sf_dir):
    return prefix_counts.count(read(spark, sf_dir, "documents"), limit=1024)


@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.learned_score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op11_backoff", backoff.oracle_sql())
def op11(spark, sf_dir):
    return backoff.score(read(spark, sf_dir, "documents"))


@query("op12_vector_codes", vector_codes.oracle_sql())
def op12(spark, sf_dir):
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


@query("op13_divergence", divergence.oracle_sql())
def op13(spark, sf_dir):
    return divergence.divergence(read(spark, sf_dir, "documents"))

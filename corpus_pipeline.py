"""From raw documents to token ids: quality rules, near copies, benchmark passages, personal data, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before it has kept. All but the last return the
columns they were given.
"""

from pulseloom.llm import pii, quality_rules, simhash, spaced_seeds, tree_bpe
from pulseloom.llm.common import materialize, prepare, read


def quality(spark, docs, sf_dir):
    """Documents that the base check or the current policy rejects go."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_copies(spark, docs, sf_dir):
    """Of every group of documents whose fingerprints link, the one of the smallest id stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a passage of the benchmark go."""
    return spaced_seeds.remove(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data in the text becomes a mark of its kind."""
    prepare(spark)
    return pii.mask(docs)


def encoding(spark, docs, sf_dir):
    """doc_id, the ids' number and hash, and the hash of the text decoded from them."""
    prepare(spark)
    return tree_bpe.encode(docs, "byte_bpe_50k.json", tree_bpe.digest, tree_bpe.DIGEST)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", encoding),
]
#: SQL cannot state the fingerprints, the span classifier or the encoding; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    *inner, (_, last) = STAGES
    for name, stage in inner:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return materialize(last(spark, docs, sf_dir), "encoded")

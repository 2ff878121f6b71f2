"""From raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept and, but for the last, returns the columns of ``documents``:
toxic documents go, of equal texts the smallest id stays, of near copies the smallest id stays, secrets are
masked in place, and the texts are packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmart.llm import exact, packing, secrets_scan, simhash, toxicity
from trailmart.llm.frames import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; it learns from the labelled ones among them."""
    judged = toxicity.judged(docs, table(spark, sf_dir, "labels"))
    return judged.where("not rejected").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more."""
    return simhash.deduplicated(docs, k=5, similarity=0.8)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked."""
    return secrets_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every text with its place in a sequence."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learned weights, fingerprints and packing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

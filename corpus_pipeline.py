"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quipu.llm import decontaminate, langid, packing, secrets_scan, simhash
from quipu.llm.common import importable, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determinable language go."""
    importable(spark)
    profiles = langid.fit(docs.filter(~langid.held_out(F.col("doc_id").cast("string"))))
    return langid.keep_identified(docs, profiles)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    importable(spark)
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    importable(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    importable(spark)
    return secrets_scan.redact(docs, length="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences."""
    importable(spark)
    return packing.packed_pieces(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Language profiles, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

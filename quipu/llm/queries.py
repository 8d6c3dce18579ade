"""The operators' queries by name, each over its whole table, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import audit, bwt, chat, decontaminate, langid, licenses, merkle, mincut, packing, ranked, rollup, secrets_scan, simhash
from .common import importable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir)."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_decontaminate", decontaminate.CONTAMINATION_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_secrets", secrets_scan.secrets_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.found_secrets(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


@query("op8_langid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


@query("op3_chat")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


@query("op6_token_rollup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.corpus_totals(table(spark, sf_dir, "documents"), scratch_path(spark, "llm-token-rollup"))


@query("op7_licenses", licenses.license_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query("op9_merkle")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_neighbours(table(spark, sf_dir, "documents"))


@query("op10_repeats", bwt.REPEATS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt.kept_bytes(table(spark, sf_dir, "documents"))


@query("op11_ranked", ranked.RANKED_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_audit", audit.AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_html")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mincut.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

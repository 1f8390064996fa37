"""The registered queries of the subpackage and their DuckDB SQL.

Each query reads the whole of its table; what its rows stand for is said in its module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcost.llm import (
    conversation_trie, decontam, html_extract, line_dedup, mixing, packing, quality_model, quality_rules, simhash, source_audit, substring_dedup, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.report(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": _over("pages", html_extract.report),
    "op2_simhash": _over("documents", simhash.report),
    "op3_decontamination": _decontam,
    "op4_toxicity": _toxicity,
    "op5_quality_classifier": _quality,
    "op6_warc": _over("pages", warc.report),
    "op7_suffix_dedup": _over("documents", substring_dedup.report),
    "op8_mixing": _over("documents", mixing.report),
    "op9_line_dedup": _over("documents", line_dedup.report),
    "op10_quality_rules": _over("documents", quality_rules.report),
    "op11_source_audit": _over("documents", source_audit.report),
    "op12_packing": _packing,
    "op13_conversation_trie": _over("conversations", conversation_trie.report),
}

ORACLE: dict[str, str] = {
    "op6_warc": warc.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_source_audit": source_audit.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}

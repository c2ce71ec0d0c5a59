"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import audit, chat, collocations, decontaminate, jaccard, licenses, mixing, quality, repeats, sharding, tokens, toxicity, warc
from tidemark.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "slot", "shard")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.read_archive(spark, warc.write_archive(read_table(spark, sf_dir, "pages")))
    return warc.read_back(archive).drop("url")


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_trap(read_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(turns))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.copies(docs).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("copies")
    )


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return decontaminate.verdicts(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.linked_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op4_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(read_table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_bytes", "n_removed", "cast(size(spans) as bigint) as n_spans", "kept_sha256"
    )


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return toxicity.toxicity(docs, read_table(spark, sf_dir, "labels")).drop("lang")

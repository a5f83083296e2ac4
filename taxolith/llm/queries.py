"""Queries of the training-data operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.llm.common import table
from taxolith.llm.conversations import damaged, repair_conversations
from taxolith.llm.ctph import edited_fingerprints
from taxolith.llm.decontam import leaks
from taxolith.llm.html_extract import extract_pages
from taxolith.llm.infill import fill_in_middle, restored
from taxolith.llm.line_dedup import dedup_lines
from taxolith.llm.oracles import SQL
from taxolith.llm.packing import pack_documents
from taxolith.llm.quality import quality_scores
from taxolith.llm.sharding import shard_documents
from taxolith.llm.simhash import near_duplicates
from taxolith.llm.suffix_dedup import remove_repeats
from taxolith.llm.token_bins import token_bins
from taxolith.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), max_tokens=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2, blocks=4)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op4_piecewise_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_bins(table(spark, sf_dir, "documents"), max_tokens=1024)


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"]), F.lit(0))
    spans = F.coalesce(F.array_size("spans"), F.lit(0)).cast("long")
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.withColumn("similarity", F.round("similarity", 6))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), report=True).select("doc_id", "text", "n_lines", "n_removed")


def op10_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"), seed=1)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    own = digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *own)


def op12_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(*damaged(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Query]:
    return {
        "op1_pack_sequences": op1_pack_sequences,
        "op2_simhash_components": op2_simhash_components,
        "op3_page_text": op3_page_text,
        "op4_piecewise_hashes": op4_piecewise_hashes,
        "op5_rendezvous_shards": op5_rendezvous_shards,
        "op6_token_matrix": op6_token_matrix,
        "op7_repeated_bytes": op7_repeated_bytes,
        "op8_benchmark_leaks": op8_benchmark_leaks,
        "op9_line_dedup": op9_line_dedup,
        "op10_quality_scores": op10_quality_scores,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_toxicity_scores": op12_toxicity_scores,
        "op13_repair_conversations": op13_repair_conversations,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

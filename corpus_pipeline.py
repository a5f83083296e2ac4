"""From raw documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.llm.common import keep_batches_small, shared_table, table
from taxolith.llm.decontam import decontaminate
from taxolith.llm.line_dedup import dedup_lines
from taxolith.llm.packing import pack_documents
from taxolith.llm.quality import keep_good
from taxolith.llm.simhash import keep_first

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts have the score of the intercept, a null id is scored by its text, a very
    long text is scored whole, repeated rows share their fate, further columns stay, an empty table stays empty.
    """
    keep_batches_small(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of any three consecutive lines; ``n_chars`` follows the text.

    Null texts, null ids and texts of fewer lines stay as they are; very long texts are cleaned
    whole; repeated rows are one document, cleaned alike, and no later occurrences of one another;
    further columns stay; an empty table stays empty.
    """
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Null, empty and blank texts are one group; rows with a null id stay; of repeated rows one
    stays; very long texts are compared whole; further columns stay; an empty table stays empty (``keep_first``).
    """
    return keep_first(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts and rows with a null id stay; very long texts are searched whole;
    repeated rows share their fate; further columns stay; an empty table stays empty, and an
    empty benchmark leaves all documents.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 1024 ids.

    Null and empty texts are the end id alone; very long texts are cut over as many sequences as they
    need; null ids stay null; repeated rows are packed once each; further columns are left
    out; an empty table gives no rows.
    """
    keep_batches_small(spark)
    return pack_documents(docs, max_tokens=1024, remember=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

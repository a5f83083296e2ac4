"""Cohort merges: per-sample tables to long tables and zero-filled matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """All tables under one header, missing columns null (SET-5)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def wide_matrix(long: DataFrame, key: str, value: str, samples: Sequence[str] | None = None) -> DataFrame:
    """``key`` x samples, absent cells zero; samples without any row keep their column (JOI-4, SNK-1, CMP-23).

    One pivot over the stacked rows, never a chain of joins.
    """
    names = list(samples) if samples is not None else [r[0] for r in long.select("sample").distinct().orderBy("sample").collect()]
    return long.groupBy(key).pivot("sample", names).agg(F.sum(value)).na.fill(0)


def tx_to_gene(transcripts: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Counts and TPM summed to genes, lengths weighted by counts, plain where all are zero (AGG-15).

    ``transcripts(sample, transcript, length, count, tpm)``.
    """
    rows = transcripts.join(tx2gene, "transcript")
    weighted = F.try_divide(F.sum(F.col("count") * F.col("length")), F.sum("count"))
    return rows.groupBy("sample", "gene").agg(F.sum("count").alias("count"), F.sum("tpm").alias("tpm"), F.coalesce(weighted, F.avg("length")).alias("length"))


def gene_lengths(genes: DataFrame) -> DataFrame:
    """Mean length of a gene over samples (AGG-15)."""
    return genes.groupBy("gene").agg(F.avg("length").alias("length"))


def inconsistent_lengths(tables: DataFrame) -> DataFrame:
    """Genes with more than one length over the tables (AGG-18)."""
    return tables.groupBy("gene").agg(F.count_distinct("length").alias("lengths"), F.min("length").alias("least"), F.max("length").alias("most")).where("lengths > 1")


def combine_reports(reports: DataFrame) -> DataFrame:
    """Clade and direct reads of all samples, summed and per sample, by taxid (CMP-23)."""
    return reports.groupBy("taxid", "rank", "name").agg(F.sum("clade_reads").alias("tot_all"), F.sum("direct_reads").alias("tot_lvl"), F.count_distinct("sample").alias("samples"))


def standardise(profile: DataFrame, drop: DataFrame | None = None) -> DataFrame:
    """``sample, taxid, count`` of any profile, dropped taxa left out, equal taxids summed (CMP-23)."""
    rows = profile.where(F.col("taxid").isNotNull())
    if drop is not None:
        rows = rows.join(drop.select("taxid").distinct(), "taxid", "left_anti")
    return rows.groupBy("sample", "taxid").agg(F.sum("count").alias("count"))


def summary_table(evidence: DataFrame, by: str = "verdict", value: str | None = None) -> DataFrame:
    """Taxa, and reads if asked, of each verdict or anchor (SNK-3, AGG-19)."""
    more = [F.sum(value).alias(value)] if value else []
    return evidence.groupBy(by).agg(F.count("*").alias("taxa"), *more)


def sample_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """``sample, in_a, in_b``: which samples only one of two tables has (SET-3, SET-4)."""
    left, right = a.select("sample").distinct().withColumn("in_a", F.lit(True)), b.select("sample").distinct().withColumn("in_b", F.lit(True))
    return left.join(right, "sample", "full").na.fill(False, ["in_a", "in_b"])

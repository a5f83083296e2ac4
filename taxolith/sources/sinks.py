"""Writers: matrices, evidence, sparse exchange format, bundles, sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.functions.windows import numbered
from taxolith.operators.accounting import clean_runs, refuse
from taxolith.operators.merge import wide_matrix
from taxolith.plans.materialise import cut

# File name patterns of a results bundle.
BUNDLE = {
    "kraken2_report": r"\.kraken2\.report\.txt$",
    "krakenuniq_report": r"\.krakenuniq\.report\.txt$",
    "bracken_combined": r"\.bracken\.combined\.tsv$",
    "metaphlan_profile": r"\.metaphlan\.profile\.txt$",
    "metaphlan_merged": r"\.metaphlan\.merged\.tsv$",
    "gene_families": r"\.genefamilies\.tsv$",
    "pathways": r"\.pathabundance\.tsv$",
}


def write_matrix(long: DataFrame, key: str, value: str, path: str, samples: Sequence[str] | None = None) -> None:
    """Features x samples as one tab-separated file, absent cells zero (SNK-1, SNK-6)."""
    wide_matrix(long, key, value, samples).orderBy(key).coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="NA")


def write_evidence(evidence: DataFrame, name: str, path: str) -> None:
    """Evidence as Parquet, partitioned by the filter's name (SNK-2)."""
    evidence.withColumn("filter", F.lit(name)).write.mode("append").partitionBy("filter").parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Nulls as NA (SNK-2, SNK-8)."""
    df.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="NA")


def write_runsheet(runs: DataFrame, path: str, query: str = "") -> None:
    """The cleaned run sheet as CSV, the accession that was asked for first (SNK-8); a sheet without runs is refused."""
    rows = clean_runs(runs).orderBy("pos")
    if rows.isEmpty():
        raise ValueError("no run is left to write")
    rows.select(F.lit(query).alias("query"), *[c for c in rows.columns if c != "pos"]).coalesce(1).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def otu_labels(abundance: DataFrame, min_reads: float = 10) -> DataFrame:
    """``id, taxid, name, total_reads, prevalence``: a label without white space for every taxon, its taxid or else its name (SNK-6)."""
    samples = abundance.select("sample").distinct().count()
    label = F.coalesce(F.nullif(F.col("taxid"), F.lit("")), F.translate("name", " ", "_"))
    per = abundance.groupBy(label.alias("id"), "taxid", "name").agg(F.sum("count").alias("total_reads"), F.count_if(F.col("count") >= min_reads).alias("_seen"))
    return per.select("id", "taxid", "name", "total_reads", F.round(F.col("_seen") / F.lit(max(samples, 1)), 4).alias("prevalence"))


def write_otu(abundance: DataFrame, path: str, min_reads: float = 10) -> None:
    """``otu``, a table of labels x samples, and ``taxa``, what the labels stand for, under ``path`` (SNK-6); equal labels are refused."""
    labels = otu_labels(abundance, min_reads)
    refuse(labels.groupBy("id").agg(F.count("*").alias("taxa")).where("taxa > 1"), "labels that stand for several taxa")
    named = abundance.withColumn("#OTU ID", F.coalesce(F.nullif(F.col("taxid"), F.lit("")), F.translate("name", " ", "_")))
    write_matrix(named, "#OTU ID", "count", f"{path}/otu")
    write_tsv(labels.orderBy("id"), f"{path}/taxa")


def biom_triplets(abundance: DataFrame, keep: DataFrame, metadata: DataFrame) -> DataFrame:
    """``row, col, taxid, sample, count`` of kept taxa with rows numbered from 0, zero cells left out (SNK-4)."""
    rows = abundance.join(keep.select("taxid").distinct(), "taxid", "left_semi").where("count > 0")
    refuse(rows.select("sample").distinct().join(metadata, "sample", "left_anti"), "samples without metadata")
    taxa, samples = numbered(rows.select("taxid").distinct(), ["taxid"], "row"), numbered(rows.select("sample").distinct(), ["sample"], "col")
    return rows.join(taxa, "taxid").join(samples, "sample").select("row", "col", "taxid", "sample", "count")


def write_biom(abundance: DataFrame, keep: DataFrame, metadata: DataFrame, path: str) -> None:
    """Sparse BIOM 1.0 JSON in one file; an empty table is refused (SNK-4).

    The document is written line by line, a row for every taxon, sample and cell, sorted and
    streamed by the one task that a single document needs; nothing is gathered in memory.
    """
    cells = cut(biom_triplets(cut(abundance), keep, metadata))  # read six times
    if cells.isEmpty():
        raise ValueError("no cell is left to export")
    ends = cells.agg(F.max("row"), F.max("col"), F.max(F.struct("row", "col"))).first()
    whole = {"ignoreNullFields": "false"}
    columns = [c for c in metadata.columns if c != "sample"]
    about = F.struct(*columns) if columns else F.lit(None).cast("string")
    comma = lambda last: F.when(last, "").otherwise(",")
    zero = F.lit(0).cast("long")

    def part(rows: DataFrame, section: int, a, b, value) -> DataFrame:
        return rows.select(F.lit(section).alias("section"), a.alias("a"), b.alias("b"), value.alias("value"))

    fixed = '"id":"table","format":"Biological Observation Matrix 1.0.0","type":"Taxon table","matrix_type":"sparse","matrix_element_type":"float"'
    frame = [(0, "{" + fixed + ',"rows":['), (2, '],"columns":['), (4, f'],"shape":[{ends[0] + 1},{ends[1] + 1}],"data":['), (6, "]}")]
    lines = abundance.sparkSession.createDataFrame(frame, "section int, value string").select("section", zero.alias("a"), zero.alias("b"), "value")
    taxa = cells.select("row", "taxid").distinct()
    lines = lines.union(part(taxa, 1, F.col("row"), zero, F.concat(F.to_json(F.struct(F.col("taxid").alias("id"), F.lit(None).cast("string").alias("metadata")), whole), comma(F.col("row") == ends[0]))))
    samples = cells.select("col", "sample").distinct().join(metadata, "sample")
    lines = lines.union(part(samples, 3, F.col("col"), zero, F.concat(F.to_json(F.struct(F.col("sample").alias("id"), about.alias("metadata")), whole), comma(F.col("col") == ends[1]))))
    number = F.concat(F.lit("["), F.col("row"), F.lit(","), F.col("col"), F.lit(","), F.col("count").cast("double").cast("string"), F.lit("]"), comma((F.col("row") == ends[2]["row"]) & (F.col("col") == ends[2]["col"])))
    lines = lines.union(part(cells, 5, F.col("row"), F.col("col"), number))
    lines.repartition(1).sortWithinPartitions("section", "a", "b").select("value").write.mode("overwrite").text(path)


def plan_bundle(spark: SparkSession, files: DataFrame, patterns: dict[str, str] = BUNDLE) -> DataFrame:
    """``path, formats``: which patterns each file name meets (SNK-5); it must be exactly one."""
    known = spark.createDataFrame(list(patterns.items()), "format string, pattern string")
    rows = files.join(F.broadcast(known), F.expr("path RLIKE pattern"), "left")
    return rows.groupBy("path").agg(F.sort_array(F.collect_set("format")).alias("formats"))


def require_one_format(plan: DataFrame) -> None:
    refuse(plan.where(F.size("formats") != 1), "files of no or several formats")


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads back as compressed FASTQ, a folder for each sample and mate (SNK-7).

    Reads are dealt to ranges of (sample, mate, pos), so a large sample is written by many tasks. Each
    writes gzip members; those of a folder, one after the other in the order of their names, are
    the sample's file in record order. Spark's committer takes back what failed tasks wrote.
    """
    record = F.concat(F.lit("@"), F.col("read_id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    rows = reads.select("sample", "mate", "pos", record.alias("value")).repartitionByRange("sample", "mate", "pos").sortWithinPartitions("sample", "mate", "pos")
    rows.select("sample", "mate", "value").write.mode("overwrite").partitionBy("sample", "mate").text(path, compression="gzip")

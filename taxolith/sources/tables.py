"""Other text inputs: counts, matrices, logs, metadata, sheets and lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.functions.scalar import lenient, sample_of
from taxolith.operators.accounting import refuse
from taxolith.sources.reports import field, numbered_lines

# Other names that headers use.
ALIASES = {
    "sample": ("sample", "sample_id", "sampleid", "library", "id", "orig.ident"),
    "barcode": ("barcode", "cell_barcode", "cell", "cell_id", "cb"),
    "cell_type": ("cell_type", "celltype", "cluster", "annotation", "cell_ontology_class"),
    "host_umis": ("host_umis", "ncount_rna", "total_counts", "n_umis", "umis"),
    "group": ("group", "condition", "treatment", "status"),
}
TRUE_WORDS = ("true", "yes", "1", "t", "y", "control", "negative", "blank")


def tsv(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Tab-separated text with a header, every column a string, with its ``_path``."""
    options = {"sep": "\t", "header": True, "quote": ""} | options
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), **options).withColumn("_path", F.col("_metadata.file_path"))


def read_humann(spark: SparkSession, path: str, quote: str = "") -> DataFrame:
    """Stratified gene families as ``feature, sample, value`` (SRC-7)."""
    wide = tsv(spark, path, quote=quote).drop("_path")
    first, rest = wide.columns[0], wide.columns[1:]
    long = wide.withColumnRenamed(first, "feature").unpivot("feature", rest, "sample", "value")
    return long.select("feature", F.regexp_replace("sample", "_Abundance(-RPKs)?$", "").alias("sample"), lenient("value").alias("value"))


def read_mtx(spark: SparkSession, matrix: str, features: str, barcodes: str, sample: str) -> DataFrame:
    """MatrixMarket triplets as ``sample, gene, barcode, value``, gene names before ids (SRC-11).

    The size line must agree with the side files.
    """
    lines = spark.read.text(matrix).where("NOT startswith(value, '%')").select(F.split(F.trim("value"), r"\s+").alias("f"))
    # side files hold a label per row or column; their numbers come from the order of lines
    genes = numbered_lines(spark, features).where("line != ''").select((F.col("pos") + 1).cast("string").alias("_g"), F.coalesce(F.nullif(F.get(F.split("line", "\t"), F.lit(1)), F.lit("")), F.get(F.split("line", "\t"), F.lit(0))).alias("gene"))
    cells = numbered_lines(spark, barcodes).where("line != ''").select((F.col("pos") + 1).cast("string").alias("_b"), F.get(F.split("line", "\t"), F.lit(0)).alias("barcode"))
    head = numbered_lines(spark, matrix).where("NOT startswith(line, '%')").orderBy("pos").limit(1).select(F.split(F.trim("line"), r"\s+").alias("f")).first()
    found = (genes.count(), cells.count())
    if head is None or (int(head["f"][0]), int(head["f"][1])) != found:
        raise ValueError(f"{matrix}: size line {head and head['f']} but {found} labels")
    size = F.array(*[F.lit(x) for x in head["f"]])
    rows = lines.where((F.size("f") == 3) & (F.col("f") != size)).select(field(0).alias("_g"), field(1).alias("_b"), lenient(field(2)).alias("value"))
    return rows.join(genes, "_g").join(cells, "_b").select(F.lit(sample).alias("sample"), "gene", "barcode", "value")


def read_fastp_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Reads before and after trimming, mean length and layout (SRC-12, SCA-18)."""
    part = "struct<total_reads: long, read1_mean_length: double, read2_mean_length: double, read_mean_length: double>"
    rows = spark.read.schema(f"summary struct<before_filtering: {part}, after_filtering: {part}>").json(paths if isinstance(paths, str) else list(paths), multiLine=True)
    after = F.col("summary.after_filtering")
    mates = after["read2_mean_length"].isNotNull()
    length = F.when(mates, (after["read1_mean_length"] + after["read2_mean_length"]) / 2).otherwise(F.coalesce(after["read1_mean_length"], after["read_mean_length"]))
    return rows.select(
        sample_of(F.col("_metadata.file_path"), r"\.(?:fastp|fastplong)").alias("sample"), F.col("summary.before_filtering.total_reads").alias("raw_reads"), after["total_reads"].alias("trimmed_reads"),
        length.alias("mean_length"), mates.alias("paired"),
    )


def read_align_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Aligner summaries: ``sample, label, paired, total, unaligned`` (SRC-13, SCA-19).

    In a paired layout ``unaligned`` is pairs of which neither mate aligned, a mate counting half.
    """
    from taxolith.functions.scalar import pass_of

    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(pass_of(F.col("_metadata.file_path")).alias("p"), "value")
    number = lambda pattern: F.regexp_extract("value", pattern, 1).try_cast("double")
    paired = F.col("value").rlike("(?i)were paired|Total pairs")
    total = F.coalesce(number(r"(?i)Total pairs:\s*(\d+)"), number(r"(?i)Total reads:\s*(\d+)"), number(r"(\d+) reads; of these"))
    mates = number(r"(?i)(\d+)(?: \([^)]*\))? aligned 0 times\s*\n[^\n]*aligned exactly 1 time[^\n]*\n[^\n]*>1 times\s*\n[^\n]*overall")
    unaligned = F.when(paired & mates.isNotNull(), mates / 2).otherwise(F.coalesce(number(r"(?i)(?:Aligned concordantly or discordantly 0 time|Aligned 0 time):\s*(\d+)"), number(r"(\d+) \([^)]*\) aligned 0 times")))
    return files.select("p.sample", "p.label", paired.alias("paired"), total.alias("total"), unaligned.alias("unaligned"))


def read_taxdump(spark: SparkSession, nodes: str, names: str, merged: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Taxonomy ``taxid, parent, rank, name`` and merged ids ``old, new`` (SRC-14)."""
    split = lambda path: spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t?\|$", ""), r"\t\|\t").alias("f"))
    tree = split(nodes).select(F.trim(field(0)).alias("taxid"), F.trim(field(1)).alias("parent"), F.trim(field(2)).alias("rank"))
    labels = split(names).where(F.trim(field(3)) == "scientific name").select(F.trim(field(0)).alias("taxid"), F.trim(field(1)).alias("name"))
    joined = tree.join(labels, "taxid", "left")
    return joined, split(merged).select(F.trim(field(0)).alias("old"), F.trim(field(1)).alias("new")) if merged else None


def read_runinfo(spark: SparkSession, path: str) -> DataFrame:
    """Archive run tables with quoted tabs, quotes and line ends (SRC-15)."""
    return spark.read.csv(path, sep="\t", header=True, multiLine=True, quote='"', escape='"')


def read_featurecounts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``sample, gene, length, count``; the count is the last column (SRC-16). Two files of a sample are an error."""
    out = None
    for path in paths:
        rows = tsv(spark, path, comment="#")
        own = rows.select(
            F.regexp_extract(F.regexp_extract("_path", r"([^/]+)$", 1), r"^(.+?)\.(?:host\d*|target)\b", 1).alias("sample"), F.col("_path").alias("path"), F.col("Geneid").alias("gene"),
            lenient("Length").alias("length"), lenient(F.col(f"`{rows.columns[-2]}`")).alias("count"),
        )
        out = own if out is None else out.unionByName(own)
    refuse(out.groupBy("sample").agg(F.count_distinct("path").alias("files")).where("files > 1"), "two tables for one sample")
    return out.drop("path")


def read_kallisto(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Transcript abundances (SRC-17)."""
    return tsv(spark, paths).select(
        sample_of(F.col("_path")).alias("sample"), F.col("target_id").alias("transcript"), lenient("length").alias("length"), lenient("est_counts").alias("count"), lenient("tpm").alias("tpm")
    )


def read_tx2gene(spark: SparkSession, path: str) -> DataFrame:
    """``transcript, gene`` (SRC-17)."""
    return spark.read.csv(path, sep="\t").select(F.col("_c0").alias("transcript"), F.col("_c1").alias("gene")).distinct()


def read_pathseq(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """PathSeq scores (SRC-18)."""
    return tsv(spark, paths).select(
        sample_of(F.col("_path")).alias("sample"), F.col("tax_id").alias("taxid"), F.col("taxonomy").alias("lineage"), F.col("type").alias("rank"), F.col("name"), lenient("score").alias("score"),
        lenient("score_normalized").alias("score_normalized"), lenient("reads").alias("reads"), lenient("unambiguous").alias("unambiguous"),
    )


def read_scores(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Confirmation scores; several taxids of a row are a row each (SRC-19)."""
    rows = spark.read.csv(paths if isinstance(paths, str) else list(paths), header=True)
    return rows.select(sample_of(F.col("_metadata.file_path"), r"\.(?:prism|scores|csv)").alias("sample"), F.col("tax_name").alias("name"), F.explode(F.split("staxids", "[;,]")).alias("taxid"), lenient("n").alias("n"), lenient("pred", None).alias("score"))


def read_metax(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header-less coverage profiles of 13 or 16 columns; another width is an error at run time (SRC-20)."""
    rows = spark.read.text(paths if isinstance(paths, str) else list(paths)).where("trim(value) != ''").select(F.col("_metadata.file_path").alias("path"), F.split("value", "\t").alias("f"))
    width = F.when(F.size("f").isin(13, 16), F.size("f")).otherwise(F.raise_error(F.concat(F.lit("unexpected width "), F.size("f").cast("string"))))
    return rows.select(sample_of(F.col("path")).alias("sample"), width.alias("width"), F.trim(field(0)).alias("name"), F.trim(field(1)).alias("taxid"), F.trim(field(2)).alias("rank"), F.transform(F.slice("f", 4, 13), lambda x: lenient(x)).alias("values"))


def read_sylph(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Containment profiles by genome (SRC-21)."""
    rows = tsv(spark, paths)
    return rows.select(F.regexp_extract("Sample_file", r"([^/]+?)(?:_1|_R1)?\.f(?:ast)?q(?:\.gz)?$", 1).alias("sample"), F.col("Genome_file").alias("genome"), lenient("Taxonomic_abundance").alias("taxonomic_abundance"), lenient("Sequence_abundance").alias("sequence_abundance"), F.col("Contig_name").alias("contig"))


def read_square(spark: SparkSession, path: str) -> DataFrame:
    """A square matrix as ``a, b, value`` (SRC-23); rows must carry the ids of the columns."""
    wide = tsv(spark, path).drop("_path")
    first, rest = wide.columns[0], wide.columns[1:]
    refuse(wide.where(~F.col(f"`{first}`").isin(rest)).select(first), "row without a column")
    return wide.withColumnRenamed(first, "a").unpivot("a", rest, "b", "value").select("a", "b", lenient("value", None).alias("value"))


def read_metadata(spark: SparkSession, path: str, wanted: Sequence[str] = ("sample",), aliases: dict[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Metadata under the names wanted, found by their aliases; other columns stay (SRC-24)."""
    rows = tsv(spark, path, quote='"', sep="," if path.endswith(".csv") else "\t").drop("_path")
    low = {c.strip().lower(): c for c in rows.columns}
    found = {name: next((low[a] for a in aliases.get(name, (name,)) if a in low), None) for name in wanted}
    missing = [name for name, c in found.items() if c is None]
    if missing:
        raise ValueError(f"{path}: no column for {', '.join(missing)}; it has {', '.join(rows.columns)}")
    return rows.select(*[F.col(f"`{c}`").alias(name) for name, c in found.items()], *[F.col(f"`{c}`") for c in rows.columns if c not in found.values()])


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """Library sheet, checked: sample names, molecules, one layout per sample (SRC-25)."""
    rows = spark.read.csv(path, header=True)
    for c in ("fastq_2", "molecule"):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
    rows = rows.withColumn("single_end", F.coalesce(F.trim("fastq_2"), F.lit("")) == "")
    bad = (
        F.when(~F.coalesce(F.col("sample"), F.lit("")).rlike(r"^\S+$"), "sample").when(~F.coalesce(F.col("fastq_1"), F.lit("")).rlike(r"^\S+\.f(ast)?q(\.gz)?$"), "fastq_1")
        .when(F.col("molecule").isNotNull() & ~F.col("molecule").isin("dna", "rna"), "molecule")
    )
    refuse(rows.withColumn("bad", bad).where("bad IS NOT NULL").select("sample", "bad"), "invalid rows")
    refuse(rows.groupBy("sample").agg(F.count_distinct("single_end").alias("layouts")).where("layouts > 1"), "mixed layouts")
    return rows


def pair_fastqs(spark: SparkSession, folder: str, single_end: bool = False) -> DataFrame:
    """``sample, mates`` of a folder of FASTQ files (SRC-26)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.f*q*").load(folder).select("path")
    name = F.regexp_extract("path", r"([^/]+?)\.f(?:ast)?q(?:\.gz)?$", 1)
    mate = F.coalesce(F.regexp_extract(name, r"[_.]R?([12])(?:_001)?$", 1).try_cast("int"), F.lit(1))
    own = files.select(F.regexp_replace(name, r"[_.]R?[12](_001)?$", "").alias("sample"), mate.alias("mate"), "path")
    per = own.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("mate", "path"))).alias("mates"))
    mates = F.transform("mates", lambda m: m["mate"])
    good = F.size("mates") == 1 if single_end else (F.size("mates") == 1) | (mates == F.array(F.lit(1), F.lit(2)))
    refuse(per.where(~good).select("sample"), "not one file or a pair")
    return per


def parse_accessions(spark: SparkSession, text: str, pattern: str = r"^[A-Z]{3,6}[0-9]+$") -> DataFrame:
    """Different accessions of a comma list or of lines with ``#`` comments; a bad one is an error (SRC-27)."""
    rows = spark.createDataFrame([(text,)], "text string").select(F.explode(F.split(F.regexp_replace("text", "#[^\n]*", ""), r"[,\s]+")).alias("accession")).where("accession != ''").distinct()
    refuse(rows.where(~F.col("accession").rlike(pattern)), "not accessions")
    return rows


def resolve_controls(spark: SparkSession, spec: str, samples: DataFrame) -> DataFrame:
    """Control samples of a list, a file, ``meta.tsv:column`` or ``meta.tsv:column:value`` (SRC-28)."""
    parts = spec.split(":")
    if len(parts) > 1 and "." in parts[0]:
        meta = read_metadata(spark, parts[0])
        chosen = F.col(parts[1]) == parts[2] if len(parts) > 2 else F.lower(F.trim(F.col(parts[1]))).isin(*TRUE_WORDS)
        out = meta.where(chosen).select("sample")
    elif "/" in spec or spec.endswith((".txt", ".tsv")):
        out = read_drop(spark, [spec]).withColumnRenamed("taxid", "sample")
    else:
        out = spark.createDataFrame([(s.strip(),) for s in spec.split(",") if s.strip()], "sample string")
    refuse(out.join(samples.select("sample"), "sample", "left_anti"), "unknown control samples")
    return out.distinct()


def read_drop(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of drop lists without comments; a missing file is an error (SRC-29)."""
    rows = spark.read.text(list(paths)).select(F.trim(F.get(F.split(F.regexp_replace("value", "#.*", ""), "\t"), F.lit(0))).alias("taxid"))
    return rows.where("taxid != ''").distinct()


def read_drop_cells(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``taxid, key`` pairs, key a barcode or a sample (SRC-29)."""
    rows = spark.read.text(list(paths)).where("NOT startswith(value, '#')").select(F.split("value", "\t").alias("f")).where("size(f) >= 2")
    return rows.select(F.trim(field(0)).alias("taxid"), F.trim(field(1)).alias("key")).where("taxid != 'taxid'").distinct()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Data sets of a manifest: ``sample, report`` and up to four functional tables (SRC-30)."""
    rows = tsv(spark, path, quote='"', sep="," if path.endswith(".csv") else "\t").drop("_path")

    def like(pattern: str) -> list[str]:
        import re

        return [c for c in rows.columns if re.search(pattern, c, re.I)]

    name, report = like("sample")[:1], like(r"(report|profile).*\[file\]")[:1]
    if not name or not report:
        raise ValueError(f"{path}: no sample or report column among {', '.join(rows.columns)}")
    tables = [c for c in like(r"\[file\]") if c not in report][:4]
    return rows.select(F.col(f"`{name[0]}`").alias("sample"), F.col(f"`{report[0]}`").alias("report"), *[F.col(f"`{c}`").alias(f"table_{k + 1}") for k, c in enumerate(tables)], *[F.col(f"`{c}`") for c in rows.columns if c not in (*name, *report, *tables)])



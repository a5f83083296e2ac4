"""Classifier reports, whose line order carries the tree.

A report is a few thousand lines, so a file is read whole and numbered by ``posexplode``;
different files are different rows and spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.scalar import RANK_CODES, lenient, rank_code, sample_of


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, pos, line`` of whole text files, line ends of any kind."""
    files = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))


def field(n: int) -> Column:
    return F.get(F.col("f"), F.lit(n))


def last(n: int) -> Column:
    """The n-th field from the end, null if there are fewer."""
    return F.when(F.size("f") >= n, F.element_at("f", -n))


def indent(name: Column) -> Column:
    return (F.floor((F.length(name) - F.length(F.ltrim(name))) / 2)).cast("int")


def read_kraken_report(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Six- or eight-column reports (SRC-1)."""
    rows = numbered_lines(spark, paths).where("trim(line) != '' AND NOT startswith(line, '#')").withColumn("f", F.split("line", "\t")).where("size(f) >= 6")
    wide = F.size("f") >= 8
    return rows.select(
        sample_of(F.col("path")).alias("sample"), "pos", indent(last(1)).alias("depth"), lenient(F.trim(field(0))).alias("percent"), lenient(field(1)).alias("clade_reads"),
        lenient(field(2)).alias("direct_reads"), F.when(wide, lenient(field(3))).alias("minimizers"), F.when(wide, lenient(field(4))).alias("distinct"),
        F.trim(last(3)).alias("rank"), F.trim(last(2)).alias("taxid"), F.trim(last(1)).alias("name"),
    )


def read_krakenuniq_report(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Nine-column reports: taxid before a spelled-out rank, k-mers, duplication and coverage (SRC-2)."""
    rows = numbered_lines(spark, paths).where("trim(line) != '' AND NOT startswith(line, '#')").withColumn("f", F.split("line", "\t")).where("size(f) >= 9 AND try_cast(f[0] AS DOUBLE) IS NOT NULL")
    return rows.select(
        sample_of(F.col("path")).alias("sample"), "pos", indent(last(1)).alias("depth"), lenient(F.trim(field(0))).alias("percent"), lenient(field(1)).alias("clade_reads"),
        lenient(field(2)).alias("direct_reads"), lenient(field(3)).alias("distinct"), lenient(field(4), None).alias("duplication"), lenient(field(5), None).alias("coverage"),
        rank_code(field(7)).alias("rank"), F.trim(field(6)).alias("taxid"), F.trim(last(1)).alias("name"),
    )


def detect_format(lines: DataFrame) -> DataFrame:
    """``path, format`` from the first ten lines of ``lines(path, pos, line)`` (SRC-3)."""
    head = lines.where("pos < 10")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    per = head.groupBy("path").agg(text.alias("head"))
    words = "|".join(RANK_CODES)
    low = F.lower("head")
    kind = (
        F.when(low.rlike(r"(^|\n)#?clade_name\t.*relative_abundance") | low.rlike(r"#mpa_v"), F.when(low.rlike(r"clade_name\t(?:ncbi_tax_id\t|clade_taxid\t)?[^\n]*\t[^\n]*\t[^\n]*") & ~low.contains("relative_abundance"), "merged_metaphlan").otherwise("metaphlan"))
        .when(low.rlike(r"(^|\n)#?clade_name\t"), "merged_metaphlan")
        .when(low.contains("new_est_reads"), "bracken")
        .when(low.rlike(r"(_num|_frac|_all|_lvl)(\t|\n|$)") & low.rlike("taxonomy_id|taxid"), "combined_bracken")
        .when(low.rlike(rf"\n[^\n]*\t({words})\t *[^\t\n]+(\n|$)") | low.contains("taxreads"), "krakenuniq")
        .when(low.rlike(r"(^|\n) *[0-9.]+\t[0-9]+\t[0-9]+(\t[0-9]+\t[0-9]+)?\t[a-z][0-9]*\t[0-9]+\t *[^\t\n]+"), "kraken2").otherwise("unknown")
    )
    return per.select("path", kind.alias("format"))


def read_combined(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Combined tables as long rows: ``path, name, taxid, rank, sample, measure, value`` (SRC-4).

    The header is the last leading ``#`` line, or the first line where there is none.
    """
    lines = numbered_lines(spark, paths).where("trim(line) != ''")
    own = Window.partitionBy("path")
    body = F.min(F.when(~F.col("line").startswith("#"), F.col("pos"))).over(own)
    comment = F.max(F.when(F.col("line").startswith("#") & (F.col("pos") < F.coalesce("_body", F.lit(2**31 - 1))), F.col("pos"))).over(own)
    rows = lines.withColumn("_body", body).withColumn("_header", F.coalesce(comment, "_body"))
    header = F.max(F.when(F.col("pos") == F.col("_header"), F.regexp_replace("line", "^#", ""))).over(own)
    rows = rows.withColumn("_h", F.transform(F.split(header, "\t"), lambda x: F.trim(x))).where("pos > _header AND NOT startswith(line, '#')").withColumn("f", F.split("line", "\t"))
    pairs = F.arrays_zip(F.col("_h").alias("h"), F.col("f").alias("v"))

    def named(*names: str) -> Column:
        found = F.filter(pairs, lambda p: F.lower(p["h"]).isin(*names))
        return F.trim(F.get(found, F.lit(0))["v"])

    cells = F.filter(pairs, lambda p: p["h"].rlike("_(num|frac|all|lvl)$") & ~F.lower(p["h"]).isin("tot_all", "tot_lvl", "taxonomy_lvl"))
    return rows.select(
        "path", named("name").alias("name"), named("taxonomy_id", "taxid").alias("taxid"), named("taxonomy_lvl", "lvl_type").alias("rank"), F.explode(cells).alias("c")
    ).select("path", "name", "taxid", "rank", F.regexp_extract("c.h", "^(.*)_(num|frac|all|lvl)$", 1).alias("sample"), F.regexp_extract("c.h", "_(num|frac|all|lvl)$", 1).alias("measure"), lenient(F.col("c.v")).alias("value"))


def combined_abundance(cells: DataFrame) -> DataFrame:
    """``sample, taxid, name, rank, count, frac`` of long combined rows, flat or hierarchical."""
    count = F.sum(F.when(F.col("measure").isin("num", "all"), F.col("value")))
    frac = F.sum(F.when(F.col("measure") == "frac", F.col("value")))
    return cells.groupBy("sample", "taxid", "name", "rank").agg(count.alias("count"), frac.alias("frac"))


def read_bracken(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per-sample Bracken tables under any of their column names (SRC-5)."""
    rows = spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="\t", header=True).withColumn("_path", F.col("_metadata.file_path"))

    def pick(*names: str) -> Column:
        have = [c for c in rows.columns if c.lower() in names]
        return F.col(have[0]) if have else F.lit(None).cast("string")

    return rows.select(
        sample_of(F.col("_path")).alias("sample"), pick("taxonomy_id", "taxid").alias("taxid"), pick("name").alias("name"), pick("taxonomy_lvl", "rank").alias("rank"),
        lenient(pick("new_est_reads", "reads")).alias("count"), lenient(pick("fraction_total_reads", "fraction")).alias("frac"),
    )


def read_metaphlan(spark: SparkSession, paths: str | Sequence[str], merged: bool = False) -> DataFrame:
    """MetaPhlAn profiles: ``sample, clade, name, rank, taxid, percent`` (SRC-6)."""
    lines = numbered_lines(spark, paths).where("trim(line) != ''")
    own = Window.partitionBy("path")
    is_header = F.regexp_replace(F.lower("line"), "^#", "").startswith("clade_name\t")
    at = F.max(F.when(is_header, F.col("pos"))).over(own)
    header = F.max(F.when(is_header, F.regexp_replace("line", "^#", ""))).over(own)
    rows = lines.withColumn("_at", at).withColumn("_h", F.split(header, "\t")).where("pos > coalesce(_at, -1) AND NOT startswith(line, '#')").withColumn("f", F.split("line", "\t"))
    clade = field(0)
    deepest = F.element_at(F.split(clade, r"\|"), -1)
    base = [clade.alias("clade"), F.regexp_replace(F.regexp_replace(deepest, "^[a-z]__", ""), "_", " ").alias("name"), F.upper(F.substring(deepest, 1, 1)).alias("rank")]
    if not merged:
        return rows.select(sample_of(F.col("path")).alias("sample"), *base, F.element_at(F.split(field(1), r"\|"), -1).alias("taxid"), lenient(field(2)).alias("percent"))
    cells = F.filter(F.arrays_zip(F.col("_h").alias("h"), F.col("f").alias("v")), lambda p: ~F.lower(p["h"]).isin("clade_name", "ncbi_tax_id", "clade_taxid"))
    return rows.select(*base, F.lit(None).cast("string").alias("taxid"), F.explode(cells).alias("c")).select(F.col("c.h").alias("sample"), "clade", "name", "rank", "taxid", lenient(F.col("c.v")).alias("percent"))


def load_reports(spark: SparkSession, paths: Sequence[str], fallback: str | None = None, skip_unknown: bool = True) -> DataFrame:
    """All reports by their detected format, stacked: ``sample, taxid, name, rank, count, format`` (CMP-35)."""
    kinds: dict[str, list[str]] = {}
    for r in detect_format(numbered_lines(spark, paths)).collect():  # a row per file
        kind = r["format"] if r["format"] != "unknown" else fallback
        if kind is None and not skip_unknown:
            raise ValueError(f"unknown format: {r['path']}")
        if kind is not None:
            kinds.setdefault(kind, []).append(r["path"])
    common = ["sample", "taxid", "name", "rank", "count"]
    out = None
    for kind, own in sorted(kinds.items()):
        if kind in ("kraken2", "krakenuniq"):
            rows = (read_kraken_report if kind == "kraken2" else read_krakenuniq_report)(spark, own).withColumn("count", F.col("clade_reads"))
        elif kind == "combined_bracken":
            rows = combined_abundance(read_combined(spark, own))
        elif kind == "bracken":
            rows = read_bracken(spark, own)
        else:
            rows = read_metaphlan(spark, own, kind == "merged_metaphlan").withColumn("count", F.col("percent"))
        rows = rows.select(*common, F.lit(kind).alias("format"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no report of a known format")
    return out


def read_inspect(spark: SparkSession, path: str) -> DataFrame:
    """Distinct minimizers of each clade of a database (SRC-22)."""
    rows = spark.read.text(path).where("NOT startswith(value, '#') AND trim(value) != ''").withColumn("f", F.split("value", "\t")).where("size(f) >= 6")
    return rows.select(lenient(field(1)).alias("clade_minimizers"), lenient(field(2)).alias("taxon_minimizers"), F.trim(field(3)).alias("rank"), F.trim(field(4)).alias("taxid"), F.trim(field(5)).alias("name"))


def read_assignments(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Per-read output with barcode and UMI from the read's name (SRC-8)."""
    from taxolith.functions.scalar import taxid_of

    rows = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.split("value", "\t", 5).alias("f"), F.col("_metadata.file_path").alias("path")).where("size(f) >= 4")
    tag = lambda key: F.nullif(F.regexp_extract(field(1), rf"\|{key}:([^|]+)", 1), F.lit(""))
    return rows.select(
        sample_of(F.col("path")).alias("sample"), field(0).alias("status"), field(1).alias("read_id"), F.coalesce(taxid_of(field(2)), F.lit("0")).alias("taxid"), field(3).alias("length"),
        F.coalesce(field(4), F.lit("")).alias("runs"), tag("CB").alias("barcode"), tag("UB").alias("umi"),
    )

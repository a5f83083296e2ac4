"""Read accounting, run grouping and pools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNIVEC = "univec"


def account_reads(trimming: DataFrame, alignments: DataFrame, rrna: DataFrame | None = None, classified: DataFrame | None = None) -> DataFrame:
    """One row per sample from all logs, whichever of them it has (CMP-10, JOI-3).

    ``trimming(sample, raw_reads, trimmed_reads[, per_fragment])``, ``alignments(sample, label,
    paired, total, unaligned)`` with pairs counted in a paired layout, ``rrna(sample, rrna_reads[,
    rrna_input_reads])`` and ``classified(sample, classified_reads, unclassified_reads[,
    host_carryover_reads])``. Passes run in the order of ``pass_order``.
    """
    scale = F.when(F.col("paired"), 2).otherwise(1)
    reads = alignments.select(
        "sample", "label", scale.alias("layout"), (F.col("total") * scale).alias("input"), (F.col("unaligned") * scale).alias("unaligned"),
        ((F.col("total") - F.col("unaligned")) * scale).alias("aligned"),
    )
    vector = F.col("label") == UNIVEC
    order = pass_order(F.col("label"))
    per = reads.groupBy("sample").agg(
        F.min_by("input", F.when(~vector, order)).alias("host_input"), F.sum(F.when(~vector, F.col("aligned"))).alias("host_aligned"),
        F.max_by("unaligned", F.when(~vector, order)).alias("host_unaligned"), F.sum(F.when(vector, F.col("aligned"))).alias("univec_aligned"),
        F.max_by("unaligned", order).alias("nonhost"), F.max_by("layout", order).alias("_layout"),
    )
    out = trimming.join(per, "sample", "full")
    for more in (rrna, classified):
        if more is not None:
            out = out.join(more, "sample", "full")
    own = F.col("per_fragment") if "per_fragment" in trimming.columns else F.lit(None).cast("int")
    out = out.withColumn("per_fragment", F.coalesce(own, F.col("_layout"), F.lit(1))).drop("_layout")
    removed = F.coalesce("host_aligned", F.lit(0)) + F.coalesce("univec_aligned", F.lit(0))
    share = F.round(100 * F.try_divide(F.col("nonhost").cast("double"), F.col("raw_reads").cast("double")), 2)
    return out.withColumn("host_removed", F.when(F.col("nonhost").isNotNull(), removed)).withColumn("nonhost_pct_of_raw", share)


def pass_order(label: Column) -> Column:
    """Sort key of a pass: ``host1 < host2 < ... < host10 < host < univec``, any other label beside ``host``."""
    number = F.regexp_extract(label, r"^host([0-9]+)$", 1)
    return F.struct(F.when(number != "", 0).when(label == UNIVEC, 2).otherwise(1).alias("kind"), F.coalesce(number.try_cast("long"), F.lit(0)).alias("n"), label.alias("label"))


def derive_accounting(rows: DataFrame) -> DataFrame:
    """Columns that need every log of a sample, on the result of ``account_reads`` (PRJ-4).

    Adds ``rrna_removed_reads, rrna_pct, host_removed_reads, nonhost_reads, classified_pct,
    host_carryover_pct`` and renews ``nonhost_pct_of_raw``. Classified counts are of fragments
    and become mates by ``per_fragment``. Where a sample has passes and was classified, its
    classified and unclassified mates are the reads that the last pass let through; without
    passes all trimmed reads are. rRNA reads are the trimmed ones that no pass received, or the
    log's own count without passes. Missing counts are zero, and so is a share of nothing;
    ``rrna_*`` are null where no rRNA log exists.
    """
    for name in ("rrna_reads", "rrna_input_reads", "classified_reads", "unclassified_reads", "host_carryover_reads"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("long"))
    for name in ("classified_reads", "unclassified_reads", "host_carryover_reads"):
        rows = rows.withColumn(name, F.col(name) * F.col("per_fragment"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    percent = lambda a, b: F.coalesce(F.round(100 * F.try_divide(a.cast("double"), b.cast("double")), 2), F.lit(0.0))
    passes = F.col("nonhost").isNotNull()
    measured = passes & (F.col("classified_reads").isNotNull() | F.col("unclassified_reads").isNotNull())
    released = zero("classified_reads") + zero("unclassified_reads")
    nonhost = F.when(measured, released).when(passes, F.col("nonhost")).otherwise(zero("trimmed_reads"))
    removed = F.when(measured & F.col("host_input").isNotNull(), F.greatest(F.col("host_input") - released, F.lit(0))).otherwise(zero("host_removed"))
    lost = F.when((zero("trimmed_reads") > 0) & F.col("host_input").isNotNull(), F.greatest(F.col("trimmed_reads") - F.col("host_input"), F.lit(0))).otherwise(zero("rrna_reads"))
    logged = F.col("rrna_reads").isNotNull() | F.col("rrna_input_reads").isNotNull()
    out = rows.withColumns({"rrna_removed_reads": F.when(logged, lost), "host_removed_reads": removed, "nonhost_reads": nonhost})
    base = F.when(zero("trimmed_reads") > 0, F.col("trimmed_reads")).otherwise(F.col("rrna_input_reads"))
    return out.withColumns(
        {
            "rrna_pct": F.when(logged, percent(F.col("rrna_removed_reads"), base)),
            "classified_pct": percent(zero("classified_reads"), F.col("nonhost_reads")),
            "host_carryover_pct": percent(zero("host_carryover_reads"), F.col("nonhost_reads")),
            "nonhost_pct_of_raw": percent(F.col("nonhost_reads"), F.col("raw_reads")),
        }
    )


FATES = ("trimmed_away", "rrna", "host", "nonhost_classified", "nonhost_unclassified")


def read_fate(derived: DataFrame) -> DataFrame:
    """Disjoint categories of each library: ``sample, fate, reads``, on the result of ``derive_accounting`` (AGG-13).

    Without classification all reads that are not host are unclassified.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    judged = (zero("classified_reads") > 0) | (zero("unclassified_reads") > 0)
    values = (
        F.greatest(zero("raw_reads") - zero("trimmed_reads"), F.lit(0)), zero("rrna_removed_reads"), zero("host_removed_reads"),
        zero("classified_reads"), F.when(judged, zero("unclassified_reads")).otherwise(zero("nonhost_reads")),
    )
    return derived.select("sample", *[v.alias(n) for n, v in zip(FATES, values)]).unpivot("sample", list(FATES), "fate", "reads")


def merge_align_summaries(logs: DataFrame) -> DataFrame:
    """Counts of disjoint chunks added up, the rate computed anew; layouts stay apart (AGG-14)."""
    per = logs.groupBy("sample", "label", "paired").agg(F.sum("total").alias("total"), F.sum("unaligned").alias("unaligned"), F.count("*").alias("chunks"))
    return per.withColumn("aligned_pct", F.round(100 * F.try_divide((F.col("total") - F.col("unaligned")).cast("double"), F.col("total").cast("double")), 2))


def clean_runs(runs: DataFrame) -> DataFrame:
    """Run records with single spaces, missing keys filled from the run, the first of equal runs (PRJ-5).

    ``runs(pos, run, experiment, sample, title)``. A run id that is none is an error at run time.
    """
    text = [c for c in runs.columns if c != "pos"]
    rows = runs.select("pos", *[F.trim(F.regexp_replace(c, r"\s+", " ")).alias(c) for c in text])
    rows = rows.withColumn("run", F.when(F.col("run").rlike(r"^[A-Za-z]+[0-9]+$"), F.col("run")).otherwise(F.raise_error(F.concat(F.lit("not a run id: "), F.coalesce("run", F.lit("null"))))))
    for c in ("experiment", "sample"):
        rows = rows.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.col("run")))
    first = F.row_number().over(Window.partitionBy("run").orderBy("pos"))
    return rows.withColumn("_rn", first).where("_rn = 1").drop("_rn")


def group_runs(runs: DataFrame, by: str = "sample") -> DataFrame:
    """Runs of each group in order of their ids; mixed layout, molecule or platform is a reason against it (CMP-30)."""
    mixed = [F.when(F.count_distinct(c) > 1, F.lit(f"mixed_{c}")) for c in ("layout", "molecule", "platform")]
    ordered = F.sort_array(F.collect_list("run"))
    return runs.groupBy(by).agg(ordered.alias("runs"), F.count("*").alias("n_runs"), F.concat_ws("+", *mixed).alias("problem"))


def assembly_pools(libraries: DataFrame, mode: str = "sample") -> DataFrame:
    """Libraries pooled by all, group or sample, layouts apart (CMP-31)."""
    pool: Column = {"all": F.lit("all"), "group": F.coalesce(F.col("group"), F.lit("ungrouped")) if "group" in libraries.columns else F.lit("ungrouped"), "sample": F.col("sample")}[mode]
    return libraries.withColumn("pool", pool).groupBy("pool", "single_end").agg(F.sort_array(F.collect_set("sample")).alias("samples"), F.count("*").alias("libraries"))


def audit_runs(runs: DataFrame, mode: str) -> DataFrame:
    """Runs whose platform contradicts the mode, from metadata alone (FLT-17)."""
    long_reads = F.upper("platform").isin("OXFORD_NANOPORE", "PACBIO_SMRT")
    return runs.where(~long_reads if mode == "long" else long_reads).select("run", "platform")


def short_samples(trimming: DataFrame, most: float = 60) -> DataFrame:
    """Samples of short trimmed reads (FLT-18)."""
    return trimming.where(F.col("mean_length") <= most).select("sample", "mean_length")


def read2_only(reads: DataFrame) -> DataFrame:
    """Mate 2 alone, as a single-end library (FLT-19)."""
    return reads.where("mate = 2").withColumn("single_end", F.lit(True))


def tag_reads(reads: DataFrame) -> DataFrame:
    """Barcode and UMI folded into the read name, ``NA`` where missing (PRJ-11)."""
    tag = lambda c: F.coalesce(F.nullif(F.nullif(F.col(c), F.lit("-")), F.lit("")), F.lit("NA"))
    return reads.withColumn("read_id", F.concat(F.col("read_id"), F.lit("|CB:"), tag("barcode"), F.lit("|UB:"), tag("umi")))


def require_one_file(files: DataFrame, key: str = "sample", path: str = "path") -> DataFrame:
    """Samples that come from more than one file; a merge refuses them."""
    return files.groupBy(key).agg(F.count_distinct(path).alias("files"), F.sort_array(F.collect_set(path)).alias("paths")).where("files > 1")


def refuse(problems: DataFrame, message: str, shown: int = 5) -> None:
    """Raise with the first few rows if there are any."""
    rows = problems.limit(shown).collect()
    if rows:
        raise ValueError(f"{message}: {', '.join(str(r.asDict()) for r in rows)}")


def contrast(metadata: DataFrame, grouping: str, a: str, b: str, without: Sequence[str] = ()) -> DataFrame:
    """``sample, group`` of two groups without the named samples, each of two samples or more (FLT-15, FLT-16)."""
    rows = metadata.where(F.col(grouping).isin(a, b) & ~F.col("sample").isin(list(without))) if without else metadata.where(F.col(grouping).isin(a, b))
    rows = rows.select("sample", F.col(grouping).alias("group"))
    sizes = {r["group"]: r["count"] for r in rows.groupBy("group").count().collect()}  # two rows
    if min(sizes.get(a, 0), sizes.get(b, 0)) < 2:
        raise ValueError(f"{a}: {sizes.get(a, 0)}, {b}: {sizes.get(b, 0)} samples; each side needs two")
    return rows

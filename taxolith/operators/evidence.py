"""Evidence filters: each judges taxa and says why, in a ``verdict`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxolith.functions.distributions import rank_correlation_p
from taxolith.functions.scalar import carries_host, rank_word
from taxolith.functions.windows import adjusted, average_rank, correlation, n50
from taxolith.operators.lineage import credit_ancestors
from taxolith.plans.materialise import cut


def best_evidence(reports: DataFrame) -> DataFrame:
    """A taxon at its best showing over samples: most reads, least duplication, most coverage (AGG-4).

    Distinct and observed minimizers are those of the sample with the most distinct ones.
    ``reports(sample, taxid, rank, name, reads, distinct, observed, duplication, coverage)``.
    """
    best = F.struct(F.coalesce("distinct", F.lit(0)).alias("d"), F.col("sample"))
    return reports.groupBy("taxid").agg(
        F.max_by("rank", best).alias("rank"), F.max_by("name", best).alias("name"), F.max("reads").alias("reads"), F.count_distinct("sample").alias("samples"),
        F.max("distinct").alias("distinct"), F.max_by("observed", best).alias("observed"), F.max_by("sample", best).alias("best_in"),
        F.min("duplication").alias("duplication"), F.max("coverage").alias("coverage"),
    )


def minimizer_filter(
    reports: DataFrame, inspect: DataFrame | None = None, min_reads: float = 50, min_distinct: float = 10, max_duplication: float = 300.0,
    min_coverage: float = 0.0, duplication_coverage: float = 0.01, scale_from: float = 1000, depth_scale: float = 0.0,
) -> DataFrame:
    """Minimizer evidence per taxon (CMP-2).

    The limit on duplication rises with coverage, ``max_duplication x coverage /
    duplication_coverage``, for taxa with ``scale_from`` distinct minimizers and more
    coverage than that. With ``depth_scale`` at least that share of the mean root reads must
    be distinct. ``inspect(taxid, clade_minimizers)`` gives missing coverages. Reasons are joined with ``+``.
    """
    rows = reports
    if inspect is not None:
        size = inspect.select("taxid", F.col("clade_minimizers").alias("_size"))
        rows = rows.join(size, "taxid", "left").withColumn("coverage", F.coalesce("coverage", F.try_divide(F.col("distinct").cast("double"), F.col("_size").cast("double")))).drop("_size")
    best = best_evidence(rows)
    needed = F.lit(float(min_distinct))
    if depth_scale > 0:
        depth = rows.where(F.col("taxid") == "1").groupBy("sample").agg(F.max("reads").alias("_root")).agg((F.avg("_root") * depth_scale).alias("_depth"))
        best = best.crossJoin(F.broadcast(depth))
        needed = F.greatest(needed, F.coalesce("_depth", F.lit(0.0)))
    scaled = (F.lit(duplication_coverage > 0)) & (F.col("distinct") >= scale_from) & (F.col("coverage") > duplication_coverage)
    limit = F.when(scaled, max_duplication * F.col("coverage") / max(duplication_coverage, 1e-12)).otherwise(F.lit(float(max_duplication)))
    reasons = F.concat_ws(
        "+",
        F.when(F.coalesce("distinct", F.lit(0)) < needed, "few_distinct"),
        F.when(F.col("duplication") > limit, "high_duplication"),
        F.when((F.lit(min_coverage) > 0) & (F.col("coverage") < min_coverage), "low_coverage"),
    )
    verdict = F.when(F.col("reads") < min_reads, "below_read_gate").when(reasons != "", reasons).otherwise("kept")
    return best.withColumn("duplication_limit", limit).withColumn("verdict", verdict).drop("_depth")


def proportional(reports: DataFrame, min_samples: int = 5, min_reads: float = 0, min_distinct: float = 0, p: float = 0.05) -> DataFrame:
    """Three rank correlations of reads, observed and distinct minimizers over samples (CMP-2).

    Species and genera only; p is adjusted within each of the three tests; a taxon passes
    with positive correlations and all three below ``p``.
    """
    usable = reports.where(rank_word(F.col("rank")).isNotNull() & (F.col("reads") > min_reads) & (F.coalesce("distinct", F.lit(0)) > min_distinct))
    usable = usable.select("taxid", "sample", "reads", F.coalesce("observed", F.lit(0)).alias("observed"), F.coalesce("distinct", F.lit(0)).alias("distinct"))
    for name in ("reads", "observed", "distinct"):
        usable = average_rank(usable, name, ["taxid"], f"r_{name}")
    pairs = [("reads", "observed"), ("reads", "distinct"), ("observed", "distinct")]
    per = usable.groupBy("taxid").agg(F.count("*").alias("n"), *[correlation(f"r_{a}", f"r_{b}").alias(f"rho_{a}_{b}") for a, b in pairs])
    per = per.where(F.col("n") >= min_samples).na.drop(subset=[f"rho_{a}_{b}" for a, b in pairs])
    for a, b in pairs:
        per = per.withColumn(f"p_{a}_{b}", rank_correlation_p(F.col(f"rho_{a}_{b}"), F.col("n")))
        per = adjusted(per, f"p_{a}_{b}", [], ["taxid"], "bh", f"q_{a}_{b}")
    passed = F.lit(True)
    for a, b in pairs:
        passed = passed & (F.col(f"rho_{a}_{b}") > 0) & (F.col(f"q_{a}_{b}") < p)
    return per.withColumn("passed", passed)


def host_kmer_share(assignments: DataFrame, host: str) -> DataFrame:
    """``taxid, reads, host_reads, samples``: reads of a taxon with host k-mers (AGG-2)."""
    rows = assignments.where("status = 'C'").select("sample", "taxid", carries_host(F.col("runs"), host).alias("_host"))
    return rows.groupBy("taxid").agg(F.count("*").alias("reads"), F.count_if("_host").alias("host_reads"), F.count_distinct("sample").alias("samples"))


def host_kmer_filter(assignments: DataFrame, host: str, max_fraction: float = 0.5, min_reads: int = 10) -> DataFrame:
    """Taxa whose reads carry host k-mers, ``max_fraction`` of them or more (CMP-3)."""
    per = host_kmer_share(assignments, host).withColumn("host_fraction", F.col("host_reads") / F.col("reads"))
    verdict = (
        F.when(F.col("taxid") == host, "host").when(F.col("reads") < min_reads, "below_read_gate")
        .when(F.col("host_fraction") >= max_fraction, "host_kmer_leakage").otherwise("kept")
    )
    return per.withColumn("verdict", verdict)


def shuffle_compare(real: DataFrame, shuffled: DataFrame, max_ratio: float = 0.1, min_reads: float = 10) -> DataFrame:
    """Clade reads of real against shuffled libraries, pooled over samples that have both (CMP-4).

    Both are ``(sample, taxid, reads)`` with taxid 0 and 1 as bookkeeping; the root plus the
    unclassified reads are a library's fragments. ``floor`` is the least real count that one chance read could flag.
    """
    pairs = real.select("sample").distinct().intersect(shuffled.select("sample").distinct())
    a, b = real.join(pairs, "sample", "left_semi"), shuffled.join(pairs, "sample", "left_semi")
    book = F.col("taxid").isin("0", "1")
    depth = a.where(book).agg(F.sum("reads").alias("_real")).crossJoin(b.where(book).agg(F.sum("reads").alias("_shuffled")))
    per_a = a.where(~book).groupBy("taxid").agg(F.sum("reads").alias("real_reads"), F.count_if(F.col("reads") > 0).alias("samples_real"))
    per_b = b.where(~book).groupBy("taxid").agg(F.sum("reads").alias("shuffled_reads"), F.count_if(F.col("reads") > 0).alias("samples_shuffled"))
    rows = per_a.join(per_b, "taxid", "full").na.fill(0, ["real_reads", "shuffled_reads", "samples_real", "samples_shuffled"])
    rows = rows.crossJoin(F.broadcast(depth)).withColumn("_scale", F.try_divide(F.col("_real").cast("double"), F.col("_shuffled").cast("double")))
    scaled = F.col("shuffled_reads") * F.col("_scale")
    ratio = F.when(F.col("real_reads") > 0, scaled / F.col("real_reads")).when(F.col("shuffled_reads") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    verdict = (
        F.when(F.col("real_reads") < min_reads, "untested_low_depth").when(F.col("real_reads") < F.col("_scale") / max_ratio, "untested_below_floor")
        .when(F.col("ratio") >= max_ratio, "composition_only").otherwise("clean")
    )
    return rows.withColumn("shuffled_scaled", scaled).withColumn("ratio", ratio).withColumn("verdict", verdict).drop("_real", "_shuffled", "_scale")


def contig_evidence(contigs: DataFrame, lineage: DataFrame, abundance: DataFrame, min_reads: float = 50, min_length: int = 500, min_contigs: int = 1) -> DataFrame:
    """Contigs on a taxon or under it (CMP-5, AGG-9).

    ``contigs(pool, contig, taxid, length)``; taxa are those of the abundance table.
    """
    # contigs of a taxon, pool and length are one row before they go to every taxon above it
    alike = contigs.groupBy("taxid", "pool", "length").agg(F.count("*").alias("_c"))
    spread = alike.join(lineage.select("taxid", F.explode(F.array_append("ancestors", F.col("taxid"))).alias("_node")), "taxid")
    own = cut(spread.groupBy(F.col("_node").alias("taxid"), "pool", "length").agg(F.sum("_c").alias("_c")))
    total = F.sum(F.col("length") * F.col("_c"))
    per = own.groupBy("taxid").agg(
        F.sum("_c").alias("contigs"), F.coalesce(F.sum(F.when(F.col("length") >= min_length, F.col("_c"))), F.lit(0)).alias("qualifying"), total.alias("bp"), F.max("length").alias("longest"),
        F.try_divide(total.cast("double"), F.sum(F.when(F.col("length").isNotNull(), F.col("_c")))).alias("mean_length"), F.count_distinct("pool").alias("pools"),
    ).join(n50(own.groupBy("taxid", "length").agg(F.sum("_c").alias("_c")), ["taxid"], "length", "_c"), "taxid")
    reads = abundance.groupBy("taxid").agg(F.sum("count").alias("reads"))
    rows = reads.join(per, "taxid", "left").na.fill(0, ["contigs", "qualifying", "bp", "longest", "pools", "n50"])
    verdict = F.when(F.col("reads") < min_reads, "below_read_gate").when(F.col("qualifying") >= min_contigs, "supported").otherwise("no_contig")
    return rows.withColumn("verdict", verdict)


def gene_diversity(families: DataFrame, min_families: int = 10, max_top: float = 0.5, min_abundance: float = 0.0) -> DataFrame:
    """Breadth of a taxon over gene families (CMP-6, AGG-7, AGG-8).

    ``families(sample, taxon, family, value)``, unstratified rows left out before.
    """
    pooled = families.where("value > 0").groupBy("taxon", "family").agg(F.sum("value").alias("value"))
    # a share of the taxon's total needs the total first; both aggregates are by taxon
    total = pooled.groupBy("taxon").agg(F.sum("value").alias("abundance"), F.count("*").alias("features"), F.max("value").alias("_top"))
    shares = pooled.join(total, "taxon").withColumn("_p", F.col("value") / F.col("abundance"))
    entropy = shares.groupBy("taxon").agg((-F.sum(F.col("_p") * F.log("_p"))).alias("diversity"))
    whole = total.agg(F.sum("abundance").alias("_all"), F.sum("features").alias("_features"))
    rows = total.join(entropy, "taxon").crossJoin(F.broadcast(whole))
    verdict = (
        F.when(F.col("abundance") < min_abundance, "untested_low_abundance")
        .when((F.col("features") < min_families) | (F.col("_top") / F.col("abundance") > max_top), "single_locus").otherwise("clean")
    )
    return rows.select(
        "taxon", "features", "abundance", (F.col("abundance") / F.col("_all")).alias("fprod"), (F.col("features") / F.col("_features")).alias("funique"), "diversity",
        F.when(F.col("features") > 1, F.col("diversity") / F.log("features")).otherwise(F.lit(0.0)).alias("evenness"),
        (F.col("_top") / F.col("abundance")).alias("top_fraction"), verdict.alias("verdict"),
    )


def merge_scores(scores: DataFrame, reads: DataFrame, threshold: float = 0.5, min_reads: float = 10) -> DataFrame:
    """Median score over the samples that saw a taxon (CMP-8, AGG-16).

    ``scores(sample, taxid, score)`` and ``reads(sample, taxid, reads)``; a taxon without any score is ``unscored``.
    """
    per = scores.groupBy("taxid").agg(F.median("score").alias("median_score"), F.count("score").alias("samples_scored"))
    most = reads.groupBy("taxid").agg(F.max("reads").alias("max_reads"))
    rows = most.join(per, "taxid", "full").na.fill(0, ["max_reads", "samples_scored"])
    verdict = (
        F.when(F.col("median_score").isNull(), "unscored").when(F.col("max_reads") < min_reads, "untested_low_depth")
        .when(F.col("median_score") < threshold, "contaminant").otherwise("present")
    )
    return rows.withColumn("verdict", verdict)


def rrna_share(assignments: DataFrame, rrna_ids: DataFrame, lineage: DataFrame) -> DataFrame:
    """Share of a clade's reads that are ribosomal, over the cohort and at most in a sample (CMP-9)."""
    plain = F.regexp_replace("read_id", r"/[12]$", "")
    listed = rrna_ids.select("sample", plain.alias("_id")).distinct().withColumn("_hit", F.lit(1))
    rows = assignments.where("status = 'C'").select("sample", "taxid", plain.alias("_id")).join(listed, ["sample", "_id"], "left")
    direct = rows.select("sample", "taxid", F.lit(1).alias("reads"), F.coalesce("_hit", F.lit(0)).alias("rrna_reads"))
    clade = credit_ancestors(direct, lineage, ["sample"], ["reads", "rrna_reads"])
    own = F.col("rrna_reads") / F.col("reads")
    per = clade.groupBy("taxid").agg(F.sum("reads").alias("reads"), F.sum("rrna_reads").alias("rrna_reads"), F.max(own).alias("max_sample_share"))
    return per.withColumn("rrna_share", F.col("rrna_reads") / F.col("reads"))

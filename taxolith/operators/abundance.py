"""Abundance tables: denominators, fractions, thresholds, controls, profiles per library.

The long model is ``abundance(sample, taxid, name, rank, count, frac)``, a row per cell of
the combined table; absent cells are zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def column_totals(abundance: DataFrame, layout: str = "flat") -> DataFrame:
    """``sample, total``: the sum of a flat table; of a hierarchy the root's count, else the largest (AGG-1)."""
    if layout == "flat":
        total = F.sum("count")
    else:
        root = F.max(F.when(F.upper(F.trim("rank")) == "R", F.col("count")))
        total = F.coalesce(root, F.max("count"))
    return abundance.groupBy("sample").agg(total.alias("total")).withColumn("total", F.when(F.col("total") > 0, F.col("total")).otherwise(F.lit(1.0)))


def fraction_state(abundance: DataFrame, basis: float = 1e-3) -> DataFrame:
    """``sample, denominator, reads, share``: what the fractions were computed against (SCA-2).

    The denominator is counts over fractions of the rows with at least ``basis``, or of all
    rows where none has as much; null without counts.
    """
    large = F.col("frac") >= basis
    rows = abundance.groupBy("sample").agg(
        F.sum("count").alias("reads"), F.sum("frac").alias("share"), F.sum(F.when(large, F.col("count"))).alias("_r"), F.sum(F.when(large, F.col("frac"))).alias("_s")
    )
    reads, share = F.coalesce("_r", "reads"), F.coalesce("_s", "share")
    denominator = F.when((reads > 0) & (share > 0), reads / share)
    return rows.select("sample", denominator.alias("denominator"), "reads", "share")


def rescale_fractions(kept: DataFrame, state: DataFrame) -> DataFrame:
    """Fractions after removals: counts over the carried denominator less the reads removed (SCA-2).

    The denominator is carried, not summed anew, so earlier thresholds do not inflate the rest.
    Without counts a fraction is divided by the share that is kept.
    """
    now = kept.groupBy("sample").agg(F.sum("count").alias("_reads"), F.sum("frac").alias("_share"))
    per = state.join(now, "sample", "left").select(
        "sample",
        "denominator",
        (F.col("denominator") - (F.col("reads") - F.coalesce("_reads", F.lit(0)))).alias("_left"),
        (1 - (F.col("share") - F.coalesce("_share", F.lit(0)))).alias("_kept"),
        "share",
    )
    frac = (
        F.when(F.col("denominator").isNotNull(), F.when(F.col("_left") > 0, F.col("count") / F.col("_left")).otherwise(F.col("frac")))
        .when((F.col("share") > 0) & (F.col("_kept") > 0) & (F.col("_kept") < 1), F.col("frac") / F.col("_kept"))
        .otherwise(F.col("frac"))
    )
    return kept.join(per, "sample", "left").withColumn("frac", frac).drop("denominator", "_left", "_kept", "share")


def drop_taxa(abundance: DataFrame, drop: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without the taxids of ``drop(taxid)``, fractions rescaled, and the removed rows (FLT-2)."""
    listed = drop.select(F.trim(F.col("taxid")).alias("taxid")).distinct()
    kept = abundance.join(listed, "taxid", "left_anti")
    return rescale_fractions(kept, fraction_state(abundance)), abundance.join(listed, "taxid", "left_semi")


def abundance_verdicts(
    abundance: DataFrame, min_rel: float = 0.001, min_samples: int = 1, min_reads: float = 0, viruses: DataFrame | None = None, virus_floor: float | None = None, layout: str = "flat"
) -> DataFrame:
    """``taxid, samples_above, reads, kept``: which taxa pass the thresholds (FLT-1).

    A taxon passes with a relative abundance strictly over its floor in at least
    ``min_samples`` samples and at least ``min_reads`` reads in all. Listed viruses may have
    a floor of their own.
    """
    rows = abundance.join(column_totals(abundance, layout), "sample").withColumn("_floor", F.lit(float(min_rel)))
    if viruses is not None and virus_floor is not None:
        listed = viruses.select("taxid", F.lit(float(virus_floor)).alias("_virus")).distinct()
        rows = rows.join(listed, "taxid", "left").withColumn("_floor", F.coalesce("_virus", "_floor")).drop("_virus")
    above = F.count_if(F.col("count") / F.col("total") > F.col("_floor"))
    out = rows.groupBy("taxid").agg(above.alias("samples_above"), F.sum("count").alias("reads"))
    return out.withColumn("kept", (F.col("samples_above") >= min_samples) & (F.col("reads") >= min_reads))


def filter_abundance(abundance: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Kept and removed rows under the thresholds; fractions stay as they are (FLT-1)."""
    verdicts = abundance_verdicts(abundance, **options)
    return abundance.join(verdicts.where("kept"), "taxid", "left_semi"), abundance.join(verdicts.where("NOT kept"), "taxid", "left_semi")


def control_verdicts(
    abundance: DataFrame, controls: DataFrame, ratio: float = 10.0, statistic: str = "mean", floor_reads: float = 1.0, min_reads: float = 2.0,
    prevalence: float = 0.0, prevalence_min_reads: float = 1.0, layout: str = "flat",
) -> tuple[DataFrame, DataFrame]:
    """Evidence per taxon and verdict per cell against negative controls (CMP-1, FLT-3).

    Counts per million of a library are compared with the level of the taxon in the
    controls, at least that of ``floor_reads`` reads in a control of mean depth. A cell
    stays with ``min_reads`` reads or more and strictly over ``ratio`` times the level.
    With ``prevalence`` a taxon seen in that share of all libraries is condemned as a whole first.
    """
    totals = column_totals(abundance, layout)
    names = controls.select("sample").distinct().withColumn("_control", F.lit(True))
    libraries = totals.join(names, "sample", "left").withColumn("_control", F.coalesce("_control", F.lit(False)))
    # one row: counts over libraries
    depth = libraries.agg(F.count("*").alias("_libraries"), F.count_if("_control").alias("_controls"), F.avg(F.when(F.col("_control"), F.col("total"))).alias("_depth"))
    cells = abundance.join(libraries, "sample").withColumn("_cpm", 1e6 * F.col("count") / F.col("total"))
    level = F.when(F.col("_control"), F.col("_cpm"))
    per = cells.groupBy("taxid").agg(
        F.sum("count").alias("reads"), F.count_if(F.col("count") >= prevalence_min_reads).alias("samples_seen"),
        F.sum(level).alias("_sum"), F.max(level).alias("_max"), F.collect_list(level).alias("_levels"),
    ).crossJoin(F.broadcast(depth))
    # controls without a row for the taxon have level zero
    whole = F.sort_array(F.concat("_levels", F.array_repeat(F.lit(0.0), (F.col("_controls") - F.size("_levels")).cast("int"))))
    middle = (F.element_at(whole, (F.floor((F.size(whole) + 1) / 2)).cast("int")) + F.element_at(whole, (F.floor(F.size(whole) / 2) + 1).cast("int"))) / 2
    value = {"mean": F.col("_sum") / F.col("_controls"), "max": F.col("_max"), "median": middle}[statistic]
    least = F.when(F.col("_depth") > 0, 1e6 * floor_reads / F.col("_depth")).otherwise(F.lit(0.0)) if floor_reads > 0 else F.lit(0.0)
    per = per.withColumn("level", F.when(F.col("_controls") > 0, F.greatest(F.coalesce(value, F.lit(0.0)), least)))
    common = F.col("samples_seen") >= prevalence * F.col("_libraries") if prevalence > 0 else F.lit(False)
    per = per.withColumn("_common", common).drop("_sum", "_max", "_levels", "_depth")
    judged = cells.where("NOT _control AND count > 0").join(per.where("NOT _common").select("taxid", "level"), "taxid")
    passes = (F.col("count") >= min_reads) & (F.col("_cpm") > ratio * F.col("level"))
    judged = judged.withColumn("passes", F.coalesce(passes, F.lit(True))).select("taxid", "sample", "count", "passes")
    counts = judged.groupBy("taxid").agg(F.count_if("passes").alias("kept_in"), F.count_if(~F.col("passes")).alias("zeroed_in"))
    evidence = per.join(counts, "taxid", "left").na.fill(0, ["kept_in", "zeroed_in"])
    verdict = (
        F.when(F.col("_common"), "ubiquitous").when((F.col("zeroed_in") > 0) & (F.col("kept_in") == 0), "control_level_everywhere")
        .when(F.col("zeroed_in") > 0, "control_level_somewhere").otherwise("kept")
    )
    evidence = evidence.withColumn("verdict", verdict).withColumn("level", F.when(~F.col("_common"), F.col("level"))).drop("_common", "_controls", "_libraries")
    return evidence, judged


def control_filter(abundance: DataFrame, controls: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Filtered table, evidence, drop list and dropped cells (CMP-1).

    Failing cells become zero and their reads leave the library's denominator; taxa at
    control level everywhere, or ubiquitous, go to the drop list.
    """
    evidence, judged = control_verdicts(abundance, controls, **options)
    failing = judged.where("NOT passes").select("taxid", "sample")
    rows = abundance.join(failing.withColumn("_fails", F.lit(True)), ["taxid", "sample"], "left")
    rows = rows.withColumn("count", F.when(F.col("_fails"), F.lit(0.0)).otherwise(F.col("count")))
    rows = rows.withColumn("frac", F.when(F.col("_fails"), F.lit(0.0)).otherwise(F.col("frac"))).drop("_fails")
    drop = evidence.where(F.col("verdict").isin("ubiquitous", "control_level_everywhere")).select("taxid")
    return rescale_fractions(rows, fraction_state(abundance)), evidence, drop, failing


def union_drops(lists: dict[str, DataFrame]) -> DataFrame:
    """``taxid, filter``: every list's taxa with the name of the list (SET-1, SET-2)."""
    out = None
    for name, drop in lists.items():
        own = drop.select("taxid", F.lit(name).alias("filter"))
        out = own if out is None else out.unionByName(own)
    return out.distinct()


def cpm_log(counts: DataFrame, by: str = "sample") -> DataFrame:
    """Counts per million of the sample and log2(CPM + 1) (PRJ-1)."""
    cpm = 1e6 * F.col("count") / F.sum("count").over(Window.partitionBy(by))
    return counts.withColumn("cpm", cpm).withColumn("log_cpm", F.log2(F.col("cpm") + 1))


def rpm_total(abundance: DataFrame, accounting: DataFrame) -> DataFrame:
    """Reads per million of the whole library: trimmed, else raw reads; null without a size (PRJ-2)."""
    size = F.coalesce(F.when(F.col("trimmed_reads") > 0, F.col("trimmed_reads")), F.when(F.col("raw_reads") > 0, F.col("raw_reads")))
    return abundance.join(accounting.select("sample", size.alias("_size")), "sample", "left").withColumn("rpm", F.col("count") * 1e6 / F.col("_size")).drop("_size")


def log_normalise(coo: DataFrame, scale: float = 1e4) -> DataFrame:
    """``log1p(value x scale / total of the cell)`` of a sparse matrix (PRJ-3)."""
    total = F.sum("value").over(Window.partitionBy("sample", "barcode"))
    return coo.withColumn("value", F.log1p(F.col("value") * scale / total))


def expressed(counts: DataFrame, feature: str, min_count: float = 10, min_samples: int = 2) -> DataFrame:
    """Rows of features with ``min_count`` in ``min_samples`` samples (FLT-11)."""
    keep = counts.groupBy(feature).agg(F.count_if(F.col("count") >= min_count).alias("_n")).where(F.col("_n") >= min_samples)
    return counts.join(keep, feature, "left_semi")


def prevalent(abundance: DataFrame, prevalence: float = 0.10, pooled_percent: float = 0.10) -> DataFrame:
    """``taxid``: over one read in that share of samples, and that per cent of all reads (FLT-12)."""
    whole = abundance.agg(F.count_distinct("sample").alias("_samples"), F.sum("count").alias("_all"))
    per = abundance.groupBy("taxid").agg(F.count_if(F.col("count") > 1).alias("_seen"), F.sum("count").alias("_reads")).crossJoin(F.broadcast(whole))
    return per.where((F.col("_seen") / F.col("_samples") >= prevalence) & (100 * F.col("_reads") / F.col("_all") >= pooled_percent)).select("taxid")


def varying(long: DataFrame, feature: str, value: str, min_samples: int, samples: int) -> DataFrame:
    """Features that are positive in enough samples and not constant over all of them (FLT-13).

    Absent cells are zero, so fewer rows than ``samples`` is one more value.
    """
    per = long.groupBy(feature).agg(F.count_if(F.col(value) > 0).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.count("*").alias("_rows"))
    low = F.when(F.col("_rows") < samples, F.least("_low", F.lit(0.0))).otherwise(F.col("_low"))
    high = F.when(F.col("_rows") < samples, F.greatest("_high", F.lit(0.0))).otherwise(F.col("_high"))
    return per.where((F.col("_n") >= min_samples) & (low < high)).select(feature)


def usable_samples(report: DataFrame, level: str = "S", threshold: float = 10) -> DataFrame:
    """``sample, classified, deep_enough``: gates a report must pass (FLT-14)."""
    return report.groupBy("sample").agg(
        F.max((F.col("count") > 0) & (F.col("taxid") != "0")).alias("classified"), F.max((F.col("rank") == level) & (F.col("count") >= threshold)).alias("deep_enough")
    )


def top_by(df: DataFrame, key: str, measure: Column, n: int) -> DataFrame:
    """``key, value``: the n largest by an aggregate, ties by key (TOP-1, TOP-2, TOP-3, TOP-5)."""
    return df.groupBy(key).agg(measure.alias("value")).orderBy(F.desc("value"), key).limit(n)


def spread(value: str, samples: int) -> Column:
    """Aggregate: sum of squared deviations over all samples, absent ones being zero (TOP-2)."""
    return F.sum(F.col(value) * F.col(value)) - F.sum(value) * F.sum(value) / samples


def capped(df: DataFrame, measure: Column, n: int, order: Sequence[str]) -> DataFrame:
    """The n rows with the largest measure, with the number of all rows and whether some are cut (TOP-4, TOP-9)."""
    whole = df.agg(F.count("*").alias("total_rows"))
    return df.withColumn("measure", measure).orderBy(F.desc("measure"), *order).limit(n).crossJoin(F.broadcast(whole)).withColumn("capped", F.col("total_rows") > n)


def nearest_zero(abundance: DataFrame) -> DataFrame:
    """CLR per sample; zeros become half the sample's least positive count, all-zero samples count + 1 (SCA-16)."""
    own = Window.partitionBy("sample")
    least = F.min(F.when(F.col("count") > 0, F.col("count"))).over(own)
    value = F.when(least.isNull(), F.col("count") + 1).when(F.col("count") == 0, least / 2).otherwise(F.col("count"))
    rows = abundance.withColumn("_log", F.log(value))
    return rows.withColumn("clr", F.col("_log") - F.avg("_log").over(own)).drop("_log")


def dense(abundance: DataFrame, key: str = "taxid", value: str = "count") -> DataFrame:
    """Every sample with every taxon, absent cells zero: for cohorts, which have bounded sample lists."""
    grid = abundance.select("sample").distinct().crossJoin(abundance.select(key).distinct())
    cells = abundance.groupBy("sample", key).agg(F.sum(value).alias(value))
    return grid.join(cells, ["sample", key], "left").na.fill(0, [value])

"""Views for exploration: filters, search, compositions, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.scalar import plain_name, stratum_taxon
from taxolith.operators.abundance import capped, top_by
from taxolith.plans.materialise import cut

#: Letters by which names and queries meet.
KEY = 3


def filter_view(
    report: DataFrame, rank: str | None = None, samples: Sequence[str] = (), min_percent: float = 0.0, min_reads: float = 0.0, minima: dict[str, float] | None = None, discard: DataFrame | None = None
) -> DataFrame:
    """Interactive filter; ``unclassified`` passes every numeric test, discarded names go last (FLT-5)."""
    out = report
    if rank:
        out = out.where((F.col("rank") == rank) | (F.lower("name") == "unclassified"))
    if samples:
        out = out.where(F.col("sample").isin(list(samples)))
    limits = {"percent": min_percent, "count": min_reads} | (minima or {})
    for column, least in limits.items():
        if least > 0 and column in out.columns:
            out = out.where((F.col(column) >= least) | (F.lower("name") == "unclassified"))
    return out if discard is None else out.join(discard.select("name").distinct(), "name", "left_anti")


def letters_of(name: str, n: int):
    """The different runs of ``n`` letters of a column."""
    last = F.length(name) - n
    return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(F.col(name), k + 1, F.lit(n)))))


def match_names(names: DataFrame, queries: DataFrame) -> DataFrame:
    """``query, name, strategy``: exact, else contained, else of the same genus, by plain names (FLT-6).

    A query takes the first strategy that finds anything. ``queries(query)`` is what a user
    typed; what any strategy finds holds the query's first word, so a query is compared with the
    different names that hold the rarest three letters of that word, or all of it if it is shorter.
    """
    own = names.select("name").distinct().withColumn("_n", plain_name(F.col("name")))
    asked = queries.select("query").distinct().withColumn("_q", plain_name(F.col("query"))).where("_q != ''")
    asked = asked.withColumn("_g", F.substring_index("_q", " ", 1)).withColumn("_k", F.least(F.length("_g"), F.lit(KEY)))
    # a name has a row for each three letters it holds; shorter ones only if a query is as short
    short = asked.select("_k").distinct().where(F.col("_k") < KEY)
    held = own.select("name", "_n", F.explode(letters_of("_n", KEY)).alias("_key"))
    for n in range(1, KEY):
        some = own.join(short.where(F.col("_k") == n).select(F.lit(True).alias("_some")), how="cross")  # at most one row
        held = held.union(some.select("name", "_n", F.explode(letters_of("_n", n)).alias("_key")))
    keys = asked.select("query", "_q", "_g", F.explode(F.when(F.col("_k") == KEY, letters_of("_g", KEY)).otherwise(F.array("_g"))).alias("_key"))
    often = held.groupBy("_key").agg(F.count("*").alias("_often"))
    rarest = keys.join(often, "_key", "left").groupBy("query", "_q", "_g").agg(F.min_by("_key", F.struct(F.coalesce("_often", F.lit(0)), "_key")).alias("_key"))
    rows = held.join(rarest, "_key").where(F.col("_n").contains(F.col("_q")) | F.col("_n").contains(F.col("_g"))).drop("_key", "_g")
    level = F.when(F.col("_n") == F.col("_q"), 1).when(F.col("_n").contains(F.col("_q")), 2).otherwise(3)
    rows = rows.withColumn("_level", level).withColumn("_best", F.min("_level").over(Window.partitionBy("query"))).where("_level = _best")
    return rows.select("query", "name", F.element_at(F.array(F.lit("exact"), F.lit("substring"), F.lit("genus")), F.col("_level")).alias("strategy"))


def discard(report: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows of all ranks whose names no query finds (FLT-7)."""
    return report.join(match_names(report, queries).select("name").distinct(), "name", "left_anti")


def composition(view: DataFrame, top: int = 10, group: str | None = None) -> DataFrame:
    """Sums per sample or group with all but the top taxa as ``Other`` (AGG-10, TOP-1).

    Taxa are ranked by their mean over all samples, absent cells being zero.
    """
    best = top_by(view, "name", F.sum("count"), top).select("name", F.lit(True).alias("_top"))
    rows = view.join(F.broadcast(best), "name", "left").withColumn("name", F.when(F.col("_top"), F.col("name")).otherwise("Other"))
    return rows.groupBy(group or "sample", "name").agg(F.sum("count").alias("count"))


def heatmap(view: DataFrame, top: int = 20, groups: DataFrame | None = None) -> DataFrame:
    """Zero-filled top taxa x samples, samples in order of their groups (CMP-32)."""
    best = top_by(view, "name", F.sum("count"), top).select("name")
    rows = view.join(F.broadcast(best), "name", "left_semi")
    order = view.select("sample").distinct() if groups is None else groups.select("sample", "group").distinct()
    samples = [r["sample"] for r in order.orderBy(*(["sample"] if groups is None else ["group", "sample"])).collect()]  # column names
    return rows.groupBy("name").pivot("sample", samples).agg(F.sum("count")).na.fill(0)


def rename_samples(df: DataFrame, renames: DataFrame) -> DataFrame:
    """New sample names by ``renames(old, new)``; others stay (PRJ-9)."""
    return df.join(renames.select(F.col("old").alias("sample"), "new"), "sample", "left").withColumn("sample", F.coalesce("new", "sample")).drop("new")


def attach_metadata(view: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every row with its sample's metadata; samples without keep their rows (JOI-15)."""
    return view.join(metadata, "sample", "left")


def group_columns(metadata: DataFrame | None, key: str = "sample") -> list[str]:
    """Columns of the metadata that can group samples: all but the key; none without metadata (SET-8)."""
    return [] if metadata is None else [c for c in metadata.columns if c != key]


def enrich_features(features: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Readable clade names and descriptions of features (PRJ-8)."""
    shown = F.replace(F.regexp_replace("feature", r"^[a-z]__", ""), F.lit("_"), F.lit(" "))
    return features.withColumn("label", shown).join(descriptions, "feature", "left")


def stratified_search(families: DataFrame, queries: Sequence[str] = (), most: int = 2000) -> DataFrame:
    """Stratified features whose taxon matches any query, the largest first, with a note if cut (CMP-33, TOP-4).

    ``families(feature, sample, value)``; no query finds all.
    """
    # names are read once for a feature, not for every row that the sums come from
    per = cut(families.where(F.col("feature").contains("|")).groupBy("feature").agg(F.sum("value").alias("value")))
    rows = per.withColumn("family", F.substring_index("feature", "|", 1)).withColumn("taxon", stratum_taxon(F.col("feature")))
    if queries:
        cond = F.lit(False)
        for q in queries:
            cond = cond | plain_name(F.col("taxon")).contains(plain_name(F.lit(q)))
        rows = rows.where(cond)
    return capped(rows.select("feature", "family", "taxon", "value"), F.col("value"), most, ["feature"])


def humann_summary(families: DataFrame) -> DataFrame:
    """Community and stratified features of each table (AGG-17)."""
    per = families.select("sample", "feature").distinct()
    return per.groupBy("sample").agg(F.count_if(~F.col("feature").contains("|")).alias("community"), F.count_if(F.col("feature").contains("|")).alias("stratified"))


def regroup(families: DataFrame, mapping: DataFrame) -> DataFrame:
    """Features summed onto another namespace by a many-to-many map; unmapped ones are UNGROUPED (AGG-20)."""
    rows = families.withColumn("_family", F.substring_index("feature", "|", 1)).withColumn("stratum", F.when(F.col("feature").contains("|"), F.substring_index("feature", "|", -1)))
    rows = rows.join(mapping.select(F.col("feature").alias("_family"), "group"), "_family", "left").withColumn("group", F.coalesce("group", F.lit("UNGROUPED")))
    return rows.groupBy("sample", "group", "stratum").agg(F.sum("value").alias("value"))


def renorm(families: DataFrame, units: str = "cpm") -> DataFrame:
    """Shares of the sample's community total, as such or per million (AGG-20)."""
    total = F.sum(F.when(~F.col("feature").contains("|"), F.col("value"))).over(Window.partitionBy("sample"))
    return families.withColumn("value", F.try_divide(F.col("value"), total) * (1e6 if units == "cpm" else 1.0))


def organism_view(view: DataFrame, queries: DataFrame, group: str | None = None, measure: str = "count") -> DataFrame:
    """Matched taxa summed per query, sample and group, in counts or per cent (CMP-36)."""
    matched = match_names(view, queries)
    total = F.sum("count").over(Window.partitionBy("sample"))
    rows = view.withColumn("_v", F.col("count") if measure == "count" else F.try_divide(100 * F.col("count"), total)).join(matched, "name")
    return rows.groupBy("query", "sample", *([group] if group else [])).agg(F.sum("_v").alias("value"), F.count_distinct("name").alias("taxa"))

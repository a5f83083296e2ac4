"""Trees: lineage from indented reports, ancestor joins, parent walks, clade expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.scalar import lineage_name
from taxolith.plans.materialise import cut

# Default anchors.
NON_MICROBIAL = ("33208", "33090", "28384", "12908")
VIRUSES = "10239"


def with_lineage(report: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Add ``ancestors``, root first, to ``report(sample, pos, depth, taxid, ...)`` in pre-order (WIN-1).

    The ancestor at depth d is the last row at d before this one; it is open still if no
    row of lesser depth came since, which pre-order grants for every d below the own depth.
    A report is a few thousand rows, so its window is small; samples are worked on apart.
    ``max_depth`` is the deepest depth of the report if it is not given; a row that lies
    deeper than a given one is an error.
    """
    if max_depth is None:
        max_depth = max(1, report.agg(F.max("depth")).first()[0] or 0)
    else:
        deep = F.raise_error(F.concat(F.lit(f"a row lies deeper than {max_depth}: "), F.col("taxid").cast("string"))).cast("int")
        report = report.withColumn("depth", F.when(F.col("depth") > max_depth, deep).otherwise(F.col("depth")))
    order = Window.partitionBy("sample").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    at = [
        F.when(F.col("depth") > d, F.last(F.when(F.col("depth") == d, F.struct("pos", "taxid")), ignorenulls=True).over(order))
        for d in range(max_depth)
    ]
    # a skipped level leaves a row from an earlier branch: it is not open if a shallower one came after it
    rows = report.withColumn("_open", F.array(*at))
    kept = F.filter(
        F.transform("_open", lambda x, i: F.struct(x["pos"].alias("pos"), x["taxid"].alias("taxid"), i.alias("d"))),
        lambda x: x["pos"].isNotNull(),
    )
    rows = rows.withColumn("_kept", kept)
    valid = F.filter("_kept", lambda x: ~F.exists("_kept", lambda y: (y["d"] < x["d"]) & (y["pos"] > x["pos"])))
    return rows.withColumn("ancestors", F.transform(valid, lambda x: x["taxid"])).drop("_open", "_kept")


def credit_ancestors(rows: DataFrame, lineage: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums of ``values`` for every taxon and everything under it (JOI-11, AGG-3).

    ``lineage(taxid, ancestors)``. Rows are summed by taxid before they are credited upward.
    """
    direct = rows.groupBy(*by, "taxid").agg(*[F.sum(v).alias(v) for v in values])
    spread = direct.join(lineage.select("taxid", F.explode(F.array_append("ancestors", F.col("taxid"))).alias("_node")), "taxid")
    return spread.groupBy(*by, F.col("_node").alias("taxid")).agg(*[F.sum(v).alias(v) for v in values])


def closure(taxonomy: DataFrame) -> DataFrame:
    """``taxid, ancestors`` (root first) of ``taxonomy(taxid, parent)`` by a walk to the parents (JOI-12).

    Each round doubles the known path, so 40 levels take six joins, and goes on until every
    path is whole; it is checkpointed, or the plan would double as well. A node that is its own ancestor stops there, so cycles end.
    """
    path = taxonomy.where(F.col("parent").isNotNull() & (F.col("parent") != F.col("taxid"))).select("taxid", F.array("parent").alias("up"), F.col("parent").alias("top"))
    while True:
        further = path.select(F.col("taxid").alias("top"), F.col("up").alias("more"), F.col("top").alias("higher"))
        none = F.array().cast("array<string>")
        joined = path.join(further, "top", "left").withColumn("more", F.coalesce("more", none))
        joined = joined.withColumn("fresh", F.filter("more", lambda x: ~F.array_contains("up", x) & (x != F.col("taxid"))))
        # a walk that meets itself ends
        top = F.when(F.size("fresh") == F.size("more"), F.col("higher"))
        path = cut(joined.select("taxid", F.concat("up", "fresh").alias("up"), top.alias("top")))
        if path.where("top IS NOT NULL").isEmpty():
            break
    everything = taxonomy.select("taxid").distinct().join(path, "taxid", "left")
    return everything.select("taxid", F.reverse(F.coalesce("up", F.array().cast("array<string>"))).alias("ancestors"))


def resolve_merged(taxids: DataFrame, merged: DataFrame) -> DataFrame:
    """Follow merged taxids once (JOI-12)."""
    return taxids.join(merged.select(F.col("old").alias("taxid"), "new"), "taxid", "left").withColumn("taxid", F.coalesce("new", "taxid")).drop("new")


def under(lineage: DataFrame, anchors: DataFrame) -> DataFrame:
    """``taxid, anchor``: every taxon at or under an anchor taxid (CMP-7)."""
    nodes = lineage.select("taxid", F.explode(F.array_append("ancestors", F.col("taxid"))).alias("anchor"))
    return nodes.join(anchors.select("anchor").distinct(), "anchor").select("taxid", "anchor").distinct()


def expand_clade(lineage: DataFrame, ranks: DataFrame, hosts: DataFrame, rank: str = "O") -> DataFrame:
    """Everything under the ancestor at ``rank`` of each host; unknown hosts are left out (CMP-7).

    ``ranks(taxid, rank)`` and ``hosts(taxid)``.
    """
    path = hosts.select(F.col("taxid").alias("host")).join(lineage, F.col("host") == F.col("taxid")).select(F.explode(F.array_append("ancestors", F.col("host"))).alias("taxid"))
    anchors = path.join(ranks.where(F.col("rank") == rank), "taxid").select(F.col("taxid").alias("anchor"))
    return under(lineage, anchors)


def environmental(names: DataFrame, lineage: DataFrame, nodes: Sequence[str] = (), prefix: str = "environmental") -> DataFrame:
    """Taxa named as environmental samples, or under one of the given nodes (CMP-7)."""
    own = names.where(F.lower("name").startswith(prefix)).select("taxid")
    if not nodes:
        return own.distinct()
    listed = names.sparkSession.createDataFrame([(n,) for n in nodes], "anchor string")
    return own.union(under(lineage, listed).select("taxid")).distinct()


def to_mpa(report: DataFrame) -> DataFrame:
    """``sample, clade, count``: lineage paths like ``k__A|p__B`` of a report with lineage (CMP-24)."""
    label = F.concat(F.lower(F.substring("rank", 1, 1)), F.lit("__"), F.replace(F.trim("name"), F.lit(" "), F.lit("_")))
    main = report.where(F.col("rank").rlike("^[DKPCOFGS]$")).select("sample", "taxid", "ancestors", "pos", label.alias("label"), "count")
    named = main.select("sample", F.col("taxid").alias("_node"), F.col("label").alias("_label"))
    parts = main.select("sample", "taxid", "count", F.posexplode(F.array_append("ancestors", F.col("taxid"))).alias("_d", "_node")).join(named, ["sample", "_node"])
    path = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_d", "_label"))), lambda x: x["_label"]), "|")
    return parts.groupBy("sample", "taxid").agg(path.alias("clade"), F.first("count").alias("count")).select("sample", "clade", "count")


def to_krona(report: DataFrame) -> DataFrame:
    """``sample, count, path``: rows of a hierarchy chart, the reads of a node itself before its names from the root down, between tabs (CMP-24).

    ``report(sample, taxid, ancestors, name, direct_reads)``; nodes without reads of their own have no row.
    """
    own = report.where("direct_reads > 0").select("sample", F.col("taxid").alias("_own"), "direct_reads", F.posexplode(F.array_append("ancestors", F.col("taxid"))).alias("_d", "taxid"))
    named = own.join(report.select("sample", "taxid", F.trim("name").alias("_name")), ["sample", "taxid"])
    path = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_d", "_name"))), lambda x: x["_name"]), "\t")
    return named.groupBy("sample", F.col("_own").alias("taxid")).agg(F.first("direct_reads").alias("count"), path.alias("path")).select("sample", "count", "path")


def lineage_levels(lineage: DataFrame, taxonomy: DataFrame, ranks: Sequence[str]) -> DataFrame:
    """``taxid`` and a column for each rank with the name of the ancestor there (CMP-26, WIN-8)."""
    path = lineage.select("taxid", F.explode(F.array_append("ancestors", F.col("taxid"))).alias("_node"))
    named = path.join(taxonomy.select(F.col("taxid").alias("_node"), "rank", "name"), "_node")
    return named.groupBy("taxid").pivot("rank", list(ranks)).agg(F.first("name"))


def lineage_string(ranks: Sequence[str], prefixes: Sequence[str], separator: str = ";"):
    """Column ``d__A;p__B;…`` over level columns; an empty level keeps its prefix (SCA-15)."""
    return F.concat_ws(separator, *[F.concat(F.lit(p), F.coalesce(lineage_name(F.col(r)), F.lit(""))) for r, p in zip(ranks, prefixes)])


def lineage_rollup(view: DataFrame, levels: Sequence[str], by: Sequence[str] = (), mode: str = "sum") -> DataFrame:
    """Sums of the taxon-only counts over lineage levels, missing ones filled from above, with subtotals (AGG-11)."""
    value = F.col("count") if mode == "sum" else (F.col("count") > 0).cast("double")
    filled = [F.coalesce(*[F.col(c) for c in reversed(levels[: k + 1])]).alias(levels[k]) for k in range(len(levels))]
    rows = view.select(*by, *filled, value.alias("value"))
    total = F.sum("value") if mode == "sum" else F.max("value")
    return rows.rollup(*by, *levels).agg(total.alias("value"), F.grouping_id().alias("level_id"))


@F.udtf(returnType="pos int, depth int, rank string, taxid string, name string, ancestors array<string>")
class ParseReport:
    """Rows of one report text, ancestors root first, for trees of any depth (UDF-4).

    Two spaces before a name are one level; lines with fewer than six fields or a taxid that is
    no number are left out. A null or empty text has no rows. Call it by ``parse_reports``.
    """

    def eval(self, text: str):
        above: list[str] = []
        for pos, line in enumerate((text or "").splitlines()):
            fields = line.split("\t")
            taxid = fields[-2].strip() if len(fields) >= 6 else ""
            if taxid.isdigit():
                name = fields[-1].strip()
                depth = (len(fields[-1]) - len(fields[-1].lstrip(" "))) // 2
                above = above[:depth]
                yield pos, depth, fields[-3].strip(), taxid, name, list(above)
                above.append(taxid)


def parse_reports(reports: DataFrame) -> DataFrame:
    """``reports(sample, text)``, a report a row, as rows with their lineage (UDF-4)."""
    return reports.select("sample", "text").lateralJoin(ParseReport(F.col("text").outer())).drop("text")

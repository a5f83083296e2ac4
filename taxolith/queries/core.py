"""One query for each operator that the given tables can feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.functions import scalar as S
from taxolith.functions import windows as W
from taxolith.operators import abundance as A
from taxolith.operators import accounting as AC
from taxolith.operators import cells as C
from taxolith.operators import cohort as CO
from taxolith.operators import evidence as E
from taxolith.operators import explore as X
from taxolith.operators import lineage as L
from taxolith.operators import markers as M
from taxolith.operators import merge as ME
from taxolith.operators import reads as R
from taxolith.plans.filtering import apply_filters
from taxolith.queries import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *parts: str):
    """Register a query under its function's name.

    ``parts`` are the common tables that its SQL reads; SQL that begins with a comma adds more of them.
    """

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            more = sql.startswith(",")  # further common tables
            SQL[f.__name__] = ("WITH " + ",\n".join(parts) + ("" if more else "\n") if parts else "") + (sql if parts or not more else "WITH " + sql.lstrip(", "))
        return f

    return register


def r6(*names: str):
    return [F.round(F.col(n), 6).alias(n) for n in names]


# abundance ---------------------------------------------------------------------------


@query("SELECT sample, SUM(count) AS total FROM abundance GROUP BY sample", T.ABUNDANCE)
def agg1_column_totals(spark, d):
    return A.column_totals(T.abundance(spark, d))


@query(
    """SELECT taxid, COUNT(*) FILTER (WHERE frac > 0.009) AS samples_above, SUM(count) AS reads,
       COUNT(*) FILTER (WHERE frac > 0.009) >= 2 AND SUM(count) >= 100 AS kept FROM abundance GROUP BY taxid""",
    T.ABUNDANCE,
)
def flt1_abundance_verdicts(spark, d):
    return A.abundance_verdicts(T.abundance(spark, d), min_rel=0.009, min_samples=2, min_reads=100)


DROPPED = "CAST(taxid AS INTEGER) % 7 = 0"


@query(
    f"""SELECT sample, taxid, count, ROUND(count / SUM(count) OVER (PARTITION BY sample), 6) AS frac
        FROM abundance WHERE NOT {DROPPED}""",
    T.ABUNDANCE,
)
def flt2_drop_taxa(spark, d):
    rows = T.abundance(spark, d)
    kept, _ = A.drop_taxa(rows, rows.where(DROPPED.replace("INTEGER", "INT")).select("taxid"))
    return kept.select("sample", "taxid", "count", *r6("frac"))


@query(
    """, totals AS (SELECT sample, SUM(count) AS total FROM abundance GROUP BY sample),
    cpm AS (SELECT a.*, 1e6 * a.count / t.total AS cpm, t.total FROM abundance a JOIN totals t USING (sample)),
    floor AS (SELECT 1e6 / AVG(total) AS least FROM totals WHERE sample = '5-LOW'),
    level AS (SELECT taxid, GREATEST(COALESCE(SUM(cpm) FILTER (WHERE sample = '5-LOW'), 0), (SELECT least FROM floor)) AS level, SUM(count) AS reads,
      COUNT(*) FILTER (WHERE count >= 1) AS samples_seen FROM cpm GROUP BY taxid),
    judged AS (SELECT c.taxid, c.count >= 2 AND c.cpm > 1.02 * l.level AS passes FROM cpm c JOIN level l USING (taxid) WHERE c.sample <> '5-LOW' AND c.count > 0),
    n AS (SELECT taxid, COUNT(*) FILTER (WHERE passes) AS kept_in, COUNT(*) FILTER (WHERE NOT passes) AS zeroed_in FROM judged GROUP BY taxid)
    SELECT l.taxid, l.reads, l.samples_seen, ROUND(l.level, 6) AS level, COALESCE(n.kept_in, 0) AS kept_in, COALESCE(n.zeroed_in, 0) AS zeroed_in,
      CASE WHEN n.zeroed_in > 0 AND n.kept_in = 0 THEN 'control_level_everywhere' WHEN n.zeroed_in > 0 THEN 'control_level_somewhere' ELSE 'kept' END AS verdict
    FROM level l LEFT JOIN n USING (taxid)""",
    T.ABUNDANCE,
)
def cmp1_control_filter(spark, d):
    rows = T.abundance(spark, d)
    evidence, _ = A.control_verdicts(rows, rows.where("sample = '5-LOW'").select("sample"), ratio=1.02)
    return evidence.select("taxid", "reads", "samples_seen", *r6("level"), "kept_in", "zeroed_in", "verdict")


@query(
    f"""SELECT sample, taxid, count, ROUND(count / SUM(count) OVER (PARTITION BY sample), 6) AS frac FROM abundance WHERE NOT {DROPPED}
        QUALIFY COUNT(*) FILTER (WHERE count / total_left > 0.009) OVER (PARTITION BY taxid) >= 1""".replace(
        "FROM abundance", "FROM (SELECT *, SUM(count) OVER (PARTITION BY sample) AS total_left FROM abundance WHERE NOT CAST(taxid AS INTEGER) % 7 = 0)"
    ),
    T.ABUNDANCE,
)
def cmp34_filter_pipeline(spark, d):
    rows = T.abundance(spark, d)
    drops = {"listed": rows.where("CAST(taxid AS INT) % 7 = 0").select("taxid").distinct()}
    return apply_filters(rows, drops, min_rel=0.009).filtered.select("sample", "taxid", "count", *r6("frac"))


@query(
    """SELECT DISTINCT taxid, 'few' AS filter FROM abundance WHERE count < 400
       UNION SELECT DISTINCT taxid, 'many' FROM abundance WHERE frac > 0.0115""",
    T.ABUNDANCE,
)
def set1_union_drops(spark, d):
    rows = T.abundance(spark, d)
    return A.union_drops({"few": rows.where("count < 400"), "many": rows.where("frac > 0.0115")})


@query("SELECT sample, taxid, ROUND(1e6 * frac, 4) AS cpm, ROUND(LOG2(1e6 * frac + 1), 6) AS log_cpm FROM abundance", T.ABUNDANCE)
def prj1_cpm_log(spark, d):
    return A.cpm_log(T.abundance(spark, d)).select("sample", "taxid", F.round("cpm", 4).alias("cpm"), *r6("log_cpm"))


ACCOUNTING = """accounting AS (SELECT o_orderpriority AS sample, COUNT(*) * 60 AS raw_reads,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE COUNT(*) * 55 END AS trimmed_reads FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1)"""


def accounting(spark, d):
    rows = T.table(spark, d, "orders").where("o_orderpriority <> '3-MEDIUM'").groupBy(F.col("o_orderpriority").alias("sample")).agg((F.count("*") * 60).alias("raw_reads"))
    return rows.withColumn("trimmed_reads", F.when(F.col("sample") == "1-URGENT", 0).otherwise((F.col("raw_reads") / 60 * 55).cast("long")))


@query(
    """SELECT a.sample, a.taxid, ROUND(a.count * 1e6 / COALESCE(NULLIF(c.trimmed_reads, 0), c.raw_reads), 6) AS rpm
       FROM abundance a LEFT JOIN accounting c USING (sample)""",
    T.ABUNDANCE,
    ACCOUNTING,
)
def prj2_rpm_total(spark, d):
    return A.rpm_total(T.abundance(spark, d), accounting(spark, d)).select("sample", "taxid", *r6("rpm"))


COO = """coo AS (SELECT CAST(o_custkey % 5 AS VARCHAR) AS sample, CAST(o_custkey AS VARCHAR) AS barcode, CAST(l_partkey % 97 AS VARCHAR) AS gene, SUM(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey % 97)"""


def coo(spark, d):
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    rows = T.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 97).cast("string").alias("gene"), "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.groupBy("o_custkey", "gene").agg(F.sum("l_quantity").alias("value"))
    return rows.select((F.col("o_custkey") % 5).cast("string").alias("sample"), F.col("o_custkey").cast("string").alias("barcode"), "gene", "value")


@query("SELECT sample, barcode, gene, ROUND(LN(1 + value * 10000.0 / SUM(value) OVER (PARTITION BY sample, barcode)), 6) AS value FROM coo", COO)
def prj3_log_normalise(spark, d):
    return A.log_normalise(coo(spark, d)).select("sample", "barcode", "gene", *r6("value"))


@query("SELECT taxid, SUM(count) AS value FROM cohort GROUP BY taxid ORDER BY value DESC, taxid LIMIT 10", T.COHORT)
def top1_top_taxa(spark, d):
    return A.top_by(T.cohort(spark, d), "taxid", F.sum("count"), 10)


@query("SELECT taxid, ROUND(SUM(count * count) - SUM(count) * SUM(count) / 25.0, 4) AS value FROM cohort GROUP BY taxid ORDER BY value DESC, taxid LIMIT 10", T.COHORT)
def top2_most_spread(spark, d):
    return A.top_by(T.cohort(spark, d), "taxid", F.round(A.spread("count", 25), 4), 10)


@query(
    """SELECT taxid FROM cohort GROUP BY taxid HAVING COUNT(*) FILTER (WHERE count > 1) / 25.0 >= 0.1
       AND 100 * SUM(count) / (SELECT SUM(count) FROM cohort) >= 0.95""",
    T.COHORT,
)
def flt12_prevalent(spark, d):
    return A.prevalent(T.cohort(spark, d), 0.1, 0.95)


@query("SELECT gene, sample, SUM(value) AS count FROM coo GROUP BY gene, sample QUALIFY COUNT(*) FILTER (WHERE SUM(value) >= 3000) OVER (PARTITION BY gene) >= 2", COO)
def flt11_expressed(spark, d):
    counts = coo(spark, d).groupBy("gene", "sample").agg(F.sum("value").alias("count"))
    return A.expressed(counts, "gene", 3000, 2)


@query(
    """SELECT taxid FROM (SELECT taxid, COUNT(*) FILTER (WHERE count > 0) AS n, COUNT(DISTINCT count) AS d FROM dense GROUP BY taxid) WHERE n >= 3 AND d > 1""",
    T.COHORT,
)
def flt13_varying(spark, d):
    return A.varying(T.cohort(spark, d), "taxid", "count", 3, 25)


@query(
    """SELECT sample, taxid, ROUND(l - AVG(l) OVER (PARTITION BY sample), 6) AS clr FROM (
         SELECT sample, taxid, LN(CASE WHEN count = 0 THEN MIN(NULLIF(count, 0)) OVER (PARTITION BY sample) / 2 ELSE count END) AS l FROM dense)""",
    T.COHORT,
)
def sca16_clr(spark, d):
    return A.nearest_zero(A.dense(T.cohort(spark, d))).select("sample", "taxid", *r6("clr"))


# lineage -----------------------------------------------------------------------------


@query("SELECT taxid, STRING_AGG(node, ';' ORDER BY up DESC) FILTER (WHERE up > 0) AS path FROM closure GROUP BY taxid", T.TAXONOMY)
def joi12_closure(spark, d):
    rows = L.closure(T.taxonomy(spark, d))
    return rows.select("taxid", F.when(F.size("ancestors") > 0, F.array_join("ancestors", ";")).alias("path"))


@query("SELECT a.sample, c.node AS taxid, SUM(a.count) AS count FROM abundance a JOIN closure c USING (taxid) GROUP BY 1, 2", T.ABUNDANCE, T.TAXONOMY)
def agg3_clade_rollup(spark, d):
    return L.credit_ancestors(T.abundance(spark, d), L.closure(T.taxonomy(spark, d)), ["sample"], ["count"])


@query(
    """, anchors AS (SELECT node AS anchor FROM closure JOIN taxonomy t ON t.taxid = node WHERE closure.taxid IN ('3', '8') AND t.rank = 'P')
    SELECT DISTINCT c.taxid, c.node AS anchor FROM closure c JOIN anchors ON c.node = anchor""",
    T.TAXONOMY,
)
def cmp7_expand_clade(spark, d):
    taxonomy = T.taxonomy(spark, d)
    return L.expand_clade(L.closure(taxonomy), taxonomy, taxonomy.where("taxid IN ('3', '8')"), "P")


def report(spark, d):
    """A pre-order report: a row per node with its depth."""
    taxonomy = T.taxonomy(spark, d)
    lineage = L.closure(taxonomy)
    key = F.array_join(F.transform(F.array_append("ancestors", F.col("taxid")), lambda x: F.lpad(x, 8, "0")), "/")
    rows = taxonomy.join(lineage, "taxid").withColumn("_key", key).withColumn("sample", F.lit("all"))
    from pyspark.sql.window import Window

    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("sample").orderBy("_key"))).withColumn("depth", F.size("ancestors"))
    return rows.select("sample", "pos", "depth", "taxid", "rank", "name")


@query("SELECT taxid, COALESCE(STRING_AGG(node, ';' ORDER BY up DESC) FILTER (WHERE up > 0), '') AS path FROM closure GROUP BY taxid", T.TAXONOMY)
def win1_report_lineage(spark, d):
    return L.with_lineage(report(spark, d), 6).select("taxid", F.array_join("ancestors", ";").alias("path"))


@query(
    """SELECT GROUPING(region) * 2 + GROUPING(nation) AS level_id, region, nation, SUM(count) AS value FROM (
         SELECT r.name AS region, n.name AS nation, a.count FROM abundance a JOIN taxonomy s USING (taxid) JOIN taxonomy n ON s.parent = n.taxid JOIN taxonomy r ON n.parent = r.taxid)
       GROUP BY ROLLUP (region, nation)""",
    T.ABUNDANCE,
    T.TAXONOMY,
)
def agg11_lineage_rollup(spark, d):
    taxonomy = T.taxonomy(spark, d)
    levels = L.lineage_levels(L.closure(taxonomy), taxonomy, ["P", "F"])
    view = T.abundance(spark, d).join(levels, "taxid").withColumnsRenamed({"P": "region", "F": "nation"})
    return L.lineage_rollup(view, ["region", "nation"]).select(F.col("level_id").cast("int").alias("level_id"), "region", "nation", "value")


@query(
    """SELECT taxid, lineage FROM (SELECT s.taxid, REGEXP_REPLACE(r.name, '[^A-Za-z0-9]+', '_', 'g') AS rn, 'd__' || rn || ';f__' || n.name || ';s__' || REGEXP_REPLACE(s.name, '[^A-Za-z0-9]+', '_', 'g') AS lineage
       FROM taxonomy s JOIN taxonomy n ON s.parent = n.taxid JOIN taxonomy r ON n.parent = r.taxid WHERE s.rank = 'S')""",
    T.TAXONOMY,
)
def cmp26_lineage_strings(spark, d):
    taxonomy = T.taxonomy(spark, d)
    rows = L.lineage_levels(L.closure(taxonomy), taxonomy, ["P", "F", "S"]).join(taxonomy.where("rank = 'S'").select("taxid"), "taxid", "left_semi")
    return rows.select("taxid", L.lineage_string(["P", "F", "S"], ["d__", "f__", "s__"]).alias("lineage"))


@query(
    """SELECT a.sample, 'p__' || REPLACE(r.name, ' ', '_') || '|f__' || n.name || '|s__' || REPLACE(s.name, ' ', '_') AS clade, a.count
       FROM abundance a JOIN taxonomy s USING (taxid) JOIN taxonomy n ON s.parent = n.taxid JOIN taxonomy r ON n.parent = r.taxid""",
    T.ABUNDANCE,
    T.TAXONOMY,
)
def cmp24_to_mpa(spark, d):
    taxonomy = T.taxonomy(spark, d)
    nodes = taxonomy.join(L.closure(taxonomy), "taxid").withColumn("pos", F.lit(0))
    samples = T.abundance(spark, d)
    rows = nodes.crossJoin(F.broadcast(samples.select("sample").distinct())).join(samples.select("sample", "taxid", "count"), ["sample", "taxid"], "left")
    return L.to_mpa(rows).where("count IS NOT NULL")


@query(
    """SELECT a.sample, a.count, 'root' || chr(9) || r.name || chr(9) || n.name || chr(9) || s.name AS path
       FROM abundance a JOIN taxonomy s USING (taxid) JOIN taxonomy n ON s.parent = n.taxid JOIN taxonomy r ON n.parent = r.taxid WHERE a.count > 0""",
    T.ABUNDANCE,
    T.TAXONOMY,
)
def cmp24_to_krona(spark, d):
    taxonomy = T.taxonomy(spark, d)
    nodes = taxonomy.join(L.closure(taxonomy), "taxid")
    samples = T.abundance(spark, d)
    rows = nodes.crossJoin(F.broadcast(samples.select("sample").distinct())).join(samples.select("sample", "taxid", F.col("count").alias("direct_reads")), ["sample", "taxid"], "left")
    return L.to_krona(rows)


# windows and scalars -----------------------------------------------------------------


@query("SELECT sample, taxid, RANK() OVER (PARTITION BY taxid ORDER BY count) + (COUNT(*) OVER (PARTITION BY taxid, count) - 1) / 2.0 AS rank FROM dense", T.COHORT)
def win2_average_rank(spark, d):
    return W.average_rank(A.dense(T.cohort(spark, d)), "count", ["taxid"]).select("sample", "taxid", F.col("rank").cast("double").alias("rank"))


SQL["win2_average_rank"] = SQL["win2_average_rank"].replace("SELECT sample, taxid, RANK()", "SELECT sample, taxid, CAST(RANK()").replace("/ 2.0 AS rank", "/ 2.0 AS DOUBLE) AS rank")
P_VALUES = """p AS (SELECT sample, taxid, CASE WHEN CAST(taxid AS INTEGER) % 11 = 0 THEN NULL ELSE frac * frac * 100 END AS p FROM cohort)"""


def p_values(spark, d):
    return T.cohort(spark, d).select("sample", "taxid", F.when(F.col("taxid").cast("int") % 11 != 0, F.col("frac") * F.col("frac") * 100).alias("p"))


@query(
    """SELECT sample, taxid, ROUND(LEAST(1.0, MIN(p * m / rn) OVER (PARTITION BY sample, p IS NULL ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)), 6) AS q
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample, p IS NULL ORDER BY p, taxid) AS rn, COUNT(*) OVER (PARTITION BY sample, p IS NULL) AS m FROM p)
       WHERE p IS NOT NULL UNION ALL SELECT sample, taxid, NULL FROM p WHERE p IS NULL""",
    T.COHORT,
    P_VALUES,
)
def win3_benjamini_hochberg(spark, d):
    return W.adjusted(p_values(spark, d), "p", ["sample"], ["taxid"]).select("sample", "taxid", *r6("q"))


@query(
    """SELECT sample, taxid, ROUND(MAX(LEAST(1.0, (m - rn + 1) * p)) OVER (PARTITION BY sample ORDER BY rn ROWS UNBOUNDED PRECEDING), 6) AS q
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample ORDER BY p, taxid) AS rn, COUNT(*) OVER (PARTITION BY sample) AS m FROM p WHERE p IS NOT NULL)
       UNION ALL SELECT sample, taxid, NULL FROM p WHERE p IS NULL""",
    T.COHORT,
    P_VALUES,
)
def win3_holm(spark, d):
    return W.adjusted(p_values(spark, d), "p", ["sample"], ["taxid"], "holm").select("sample", "taxid", *r6("q"))


@query("SELECT sample, taxid, count FROM cohort QUALIFY ROW_NUMBER() OVER (PARTITION BY sample ORDER BY count DESC, taxid) <= 3", T.COHORT)
def win4_first_n(spark, d):
    return W.first_n(T.cohort(spark, d).select("sample", "taxid", "count"), ["sample"], [F.desc("count"), "taxid"], 3)


@query(
    """SELECT source, MAX(n_chars) AS n50 FROM (SELECT source, n_chars, SUM(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC RANGE UNBOUNDED PRECEDING) AS ties,
         SUM(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING) AS run, SUM(n_chars) OVER (PARTITION BY source) AS total FROM documents)
       WHERE 2 * run >= total GROUP BY source"""
)
def win5_n50(spark, d):
    return W.n50(T.table(spark, d, "documents").select("source", "n_chars"), ["source"], "n_chars")


@query(
    """, rows AS (SELECT o_custkey AS customer, EPOCH(o_orderdate)::BIGINT // 86400 AS s, EPOCH(o_orderdate)::BIGINT // 86400 + 60 AS e FROM orders),
    marked AS (SELECT *, CASE WHEN s > MAX(e) OVER (PARTITION BY customer ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS fresh FROM rows),
    islands AS (SELECT *, SUM(fresh) OVER (PARTITION BY customer ORDER BY s, e RANGE UNBOUNDED PRECEDING) AS island FROM marked)
    SELECT customer, MIN(s) AS "start", MAX(e) AS "end" FROM islands GROUP BY customer, island"""
)
def win6_merge_intervals(spark, d):
    rows = T.table(spark, d, "orders").select(F.col("o_custkey").alias("customer"), F.floor(F.unix_timestamp("o_orderdate") / 86400).alias("start"))
    return W.merge_intervals(rows.withColumn("end", F.col("start") + 60), ["customer"])


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def win7_keep_first(spark, d):
    return W.keep_first(T.table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT grp AS \"group\", LIST_SORT(LIST(count))[COUNT(*) // 2 + 1] AS median FROM cohort JOIN groups USING (sample) GROUP BY grp", T.COHORT, T.GROUPS)
def win9_upper_median(spark, d):
    return T.cohort(spark, d).join(T.groups(spark, d), "sample").groupBy("group").agg(W.upper_median("count").alias("median"))


@query("SELECT taxid, ROUND(SUM(count) / (SELECT SUM(count) FROM cohort), 8) AS share FROM cohort GROUP BY taxid", T.COHORT)
def win10_share(spark, d):
    totals = T.cohort(spark, d).groupBy(F.lit("all").alias("table"), "taxid").agg(F.sum("count").alias("count"))
    return totals.withColumn("share", F.round(W.share("count", ["table"]), 8)).select("taxid", "share")


@query("SELECT DISTINCT LOWER(TRIM(REGEXP_REPLACE(LOWER(p_name || ' ' || p_brand), '[^a-z0-9]+', ' ', 'g'))) AS plain, REGEXP_REPLACE(TRIM(p_brand), '[^A-Za-z0-9]+', '_', 'g') AS lineage FROM part")
def sca13_names(spark, d):
    rows = T.table(spark, d, "part")
    return rows.select(S.plain_name(F.concat_ws(" ", "p_name", "p_brand")).alias("plain"), S.lineage_name(F.col("p_brand")).alias("lineage")).distinct()


@query("SELECT event_id, COALESCE(TRY_CAST(REGEXP_EXTRACT(props, '[0-9]+') AS DOUBLE), 0) AS value FROM events")
def sca1_lenient(spark, d):
    return T.table(spark, d, "events").select("event_id", S.lenient(F.regexp_extract("props", "([0-9]+)", 1)).alias("value"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def sca18_json(spark, d):
    return T.table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT p_partkey, CASE WHEN p_size < 15 THEN 10 WHEN p_size = 15 THEN 10 WHEN p_size <= 30 THEN 20 ELSE 40 END AS nearest FROM part")
def prj7_nearest(spark, d):
    return T.table(spark, d, "part").select("p_partkey", S.nearest(F.col("p_size"), [40, 10, 20]).alias("nearest"))


@query("""SELECT conv_id, turn, REGEXP_MATCHES(LOWER(text), 'a{2,}|c{2,}|g{2,}|t{2,}') AS repeats, REGEXP_MATCHES(UPPER(text), '[AT]{3,}') AS tract FROM conversations""")
def sca8_tracts(spark, d):
    rows = T.table(spark, d, "conversations")
    return rows.select("conv_id", "turn", S.has_homopolymer(F.upper("text"), 2).alias("repeats"), S.at_tract(F.upper("text"), 3).alias("tract"))


# evidence ----------------------------------------------------------------------------

REPORTS = """reports AS (SELECT sample, taxid, rank, name, count AS reads, ROUND(count / (2 + CAST(taxid AS INTEGER) % 5)) AS "distinct", count AS observed,
  CAST(2 + CAST(taxid AS INTEGER) % 5 AS DOUBLE) AS duplication, frac AS coverage FROM cohort)"""


def reports(spark, d):
    k = 2 + F.col("taxid").cast("int") % 5
    return T.cohort(spark, d).select(
        "sample", "taxid", "rank", "name", F.col("count").alias("reads"), F.round(F.col("count") / k).alias("distinct"), F.col("count").alias("observed"), k.cast("double").alias("duplication"), F.col("frac").alias("coverage")
    )


@query(
    """, best AS (SELECT taxid, MAX(reads) AS reads, COUNT(DISTINCT sample) AS samples, MAX("distinct") AS "distinct", MIN(duplication) AS duplication, MAX(coverage) AS coverage FROM reports GROUP BY taxid),
    lim AS (SELECT *, CASE WHEN "distinct" >= 100 AND coverage > 0.012 THEN 4.0 * coverage / 0.012 ELSE 4.0 END AS duplication_limit FROM best)
    SELECT taxid, reads, samples, "distinct", duplication, ROUND(duplication_limit, 6) AS duplication_limit,
      CASE WHEN reads < 50 THEN 'below_read_gate' WHEN "distinct" < 60 AND duplication > duplication_limit THEN 'few_distinct+high_duplication'
           WHEN "distinct" < 60 THEN 'few_distinct' WHEN duplication > duplication_limit THEN 'high_duplication' ELSE 'kept' END AS verdict FROM lim""",
    T.COHORT,
    REPORTS,
)
def cmp2_minimizer_filter(spark, d):
    rows = E.minimizer_filter(reports(spark, d), min_distinct=60, max_duplication=4.0, duplication_coverage=0.012, scale_from=100)
    return rows.select("taxid", "reads", "samples", "distinct", "duplication", *r6("duplication_limit"), "verdict")


ASSIGN = """assign AS (SELECT source AS sample, CAST(doc_id AS VARCHAR) AS read_id, CASE WHEN n_chars % 10 = 0 THEN 'U' ELSE 'C' END AS status,
  CAST(LENGTH(lang) + doc_id % 40 AS VARCHAR) AS taxid, CAST(doc_id % 40 AS VARCHAR) || ':' || CAST(n_chars % 30 + 1 AS VARCHAR) || ' |:| ' || CAST(n_chars % 7 AS VARCHAR) || ':2 A:1' AS runs FROM documents)"""


def assignments(spark, d):
    rows = T.table(spark, d, "documents")
    s = lambda c: c.cast("string")
    return rows.select(
        F.col("source").alias("sample"), s(F.col("doc_id")).alias("read_id"), F.when(F.col("n_chars") % 10 == 0, "U").otherwise("C").alias("status"),
        s(F.length("lang") + F.col("doc_id") % 40).alias("taxid"),
        F.concat(s(F.col("doc_id") % 40), F.lit(":"), s(F.col("n_chars") % 30 + 1), F.lit(" |:| "), s(F.col("n_chars") % 7), F.lit(":2 A:1")).alias("runs"),
    )


@query(
    """, per AS (SELECT taxid, COUNT(*) AS reads, COUNT(*) FILTER (WHERE runs LIKE '3:%' OR runs LIKE '% 3:%') AS host_reads, COUNT(DISTINCT sample) AS samples FROM assign WHERE status = 'C' GROUP BY taxid)
    SELECT *, ROUND(host_reads / reads, 6) AS host_fraction, CASE WHEN taxid = '3' THEN 'host' WHEN reads < 10 THEN 'below_read_gate' WHEN host_reads / reads >= 0.2 THEN 'host_kmer_leakage' ELSE 'kept' END AS verdict FROM per""",
    ASSIGN,
)
def cmp3_host_kmer_filter(spark, d):
    rows = E.host_kmer_filter(assignments(spark, d), "3", 0.2)
    return rows.withColumn("host_fraction", F.round("host_fraction", 6))


@query(
    """SELECT read_id, LEN(r) AS runs, COALESCE(LIST_SUM(LIST_TRANSFORM(r, lambda x: TRY_CAST(STRING_SPLIT(x, ':')[2] AS BIGINT))), 0) AS kmers,
       LEN(LIST_FILTER(r, lambda x: NOT REGEXP_MATCHES(x, '^[0-9]+:'))) AS ambiguous FROM (SELECT read_id, LIST_FILTER(STRING_SPLIT(REPLACE(runs, '|:|', ' '), ' '), lambda x: CONTAINS(x, ':')) AS r FROM assign)""",
    ASSIGN,
)
def sca4_kmer_runs(spark, d):
    rows = assignments(spark, d).select("read_id", S.kmer_runs(F.col("runs")).alias("r"))
    total = F.aggregate("r", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    return rows.select("read_id", F.size("r").cast("long").alias("runs"), total.alias("kmers"), F.size(F.filter("r", lambda x: x["taxid"].isNull())).cast("long").alias("ambiguous"))


SQL["sca4_kmer_runs"] = SQL["sca4_kmer_runs"].replace("COALESCE(LIST_SUM", "CAST(COALESCE(LIST_SUM").replace(", 0) AS kmers", ", 0) AS BIGINT) AS kmers")

PAIRED = """reads2 AS (SELECT sample, taxid, CAST(count AS BIGINT) AS reads FROM abundance UNION ALL SELECT sample, '0', CAST(SUM(count) AS BIGINT) FROM abundance GROUP BY sample),
shuffled AS (SELECT sample, taxid, CASE WHEN taxid = '0' THEN reads // 3 ELSE reads * (CAST(taxid AS BIGINT) % 4) // 12 END AS reads FROM reads2 WHERE sample <> '1-URGENT')"""


@query(
    """, a AS (SELECT * FROM reads2 WHERE sample <> '1-URGENT'),
    scale AS (SELECT (SELECT SUM(reads) FROM a WHERE taxid IN ('0', '1')) / (SELECT SUM(reads) FROM shuffled WHERE taxid IN ('0', '1')) AS s),
    x AS (SELECT taxid, SUM(reads) AS real_reads FROM a WHERE taxid NOT IN ('0', '1') GROUP BY taxid), y AS (SELECT taxid, SUM(reads) AS shuffled_reads FROM shuffled WHERE taxid NOT IN ('0', '1') GROUP BY taxid),
    z AS (SELECT taxid, CAST(COALESCE(real_reads, 0) AS BIGINT) AS real_reads, CAST(COALESCE(shuffled_reads, 0) AS BIGINT) AS shuffled_reads, s FROM x FULL JOIN y USING (taxid), scale)
    SELECT taxid, real_reads, shuffled_reads, ROUND(shuffled_reads * s / real_reads, 6) AS ratio,
      CASE WHEN real_reads < 10 THEN 'untested_low_depth' WHEN real_reads < s / 0.1 THEN 'untested_below_floor' WHEN shuffled_reads * s / real_reads >= 0.1 THEN 'composition_only' ELSE 'clean' END AS verdict FROM z""",
    T.ABUNDANCE,
    PAIRED,
)
def cmp4_shuffle_compare(spark, d):
    rows = T.abundance(spark, d).select("sample", "taxid", F.col("count").cast("long").alias("reads"))
    real = rows.union(rows.groupBy("sample").agg(F.lit("0").alias("taxid"), F.sum("reads").alias("reads")))
    kept = F.expr("if(taxid = '0', reads div 3, reads * (CAST(taxid AS LONG) % 4) div 12)")
    shuffled = real.where("sample <> '1-URGENT'").withColumn("reads", kept)  # one library has no shuffled pass
    return E.shuffle_compare(real, shuffled).select("taxid", "real_reads", "shuffled_reads", *r6("ratio"), "verdict")


CONTIGS = """contigs AS (SELECT l_returnflag AS pool, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS contig, CAST(l_suppkey AS VARCHAR) AS taxid, CAST(l_quantity * 40 AS BIGINT) AS length FROM lineitem)"""


def contigs(spark, d):
    rows = T.table(spark, d, "lineitem")
    return rows.select(F.col("l_returnflag").alias("pool"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("contig"), F.col("l_suppkey").cast("string").alias("taxid"), (F.col("l_quantity") * 40).cast("long").alias("length"))


@query(
    """, own AS (SELECT c.node AS taxid, x.length, x.pool FROM contigs x JOIN closure c USING (taxid)),
    run AS (SELECT taxid, length, SUM(length) OVER (PARTITION BY taxid ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS r, SUM(length) OVER (PARTITION BY taxid) AS t FROM own),
    n AS (SELECT taxid, MAX(length) AS n50 FROM run WHERE 2 * r >= t GROUP BY taxid),
    per AS (SELECT taxid, COUNT(*) AS contigs, COUNT(*) FILTER (WHERE length >= 500) AS qualifying, CAST(SUM(length) AS BIGINT) AS bp, MAX(length) AS longest, COUNT(DISTINCT pool) AS pools FROM own GROUP BY taxid),
    reads AS (SELECT taxid, SUM(count) AS reads FROM abundance GROUP BY taxid)
    SELECT taxid, reads, COALESCE(contigs, 0) AS contigs, COALESCE(qualifying, 0) AS qualifying, COALESCE(bp, 0) AS bp, COALESCE(longest, 0) AS longest, COALESCE(n50, 0) AS n50, COALESCE(pools, 0) AS pools,
      CASE WHEN reads < 50 THEN 'below_read_gate' WHEN qualifying >= 1 THEN 'supported' ELSE 'no_contig' END AS verdict FROM reads LEFT JOIN per USING (taxid) LEFT JOIN n USING (taxid)""",
    T.ABUNDANCE,
    T.TAXONOMY,
    CONTIGS,
)
def cmp5_contig_evidence(spark, d):
    rows = E.contig_evidence(contigs(spark, d), L.closure(T.taxonomy(spark, d)), T.abundance(spark, d))
    return rows.select("taxid", "reads", "contigs", "qualifying", "bp", "longest", "n50", "pools", "verdict")


@query(
    """, t AS (SELECT taxon, SUM(value) AS abundance, COUNT(*) AS features, MAX(value) AS top FROM families GROUP BY taxon),
    h AS (SELECT taxon, -SUM(value / abundance * LN(value / abundance)) AS diversity FROM families JOIN t USING (taxon) GROUP BY taxon)
    SELECT taxon, features, abundance, ROUND(abundance / SUM(abundance) OVER (), 6) AS fprod, ROUND(features / SUM(features) OVER (), 6) AS funique, ROUND(diversity, 6) AS diversity, ROUND(top / abundance, 6) AS top_fraction,
      CASE WHEN features < 10 OR top / abundance > 0.2 THEN 'single_locus' ELSE 'clean' END AS verdict FROM t JOIN h USING (taxon)""",
    T.FAMILIES,
)
def cmp6_gene_diversity(spark, d):
    rows = E.gene_diversity(T.families(spark, d), max_top=0.2)
    return rows.select("taxon", "features", "abundance", *r6("fprod", "funique", "diversity", "top_fraction"), "verdict")


@query(
    """, scores AS (SELECT sample, taxid, frac * 80 AS score FROM cohort WHERE CAST(taxid AS INTEGER) % 4 > 0),
    s AS (SELECT taxid, MEDIAN(score) AS median_score, COUNT(*) AS samples_scored FROM scores GROUP BY taxid), m AS (SELECT taxid, MAX(count) AS max_reads FROM cohort GROUP BY taxid)
    SELECT taxid, ROUND(median_score, 6) AS median_score, COALESCE(samples_scored, 0) AS samples_scored, max_reads,
      CASE WHEN median_score IS NULL THEN 'unscored' WHEN max_reads < 10 THEN 'untested_low_depth' WHEN median_score < 0.8 THEN 'contaminant' ELSE 'present' END AS verdict FROM m LEFT JOIN s USING (taxid)""",
    T.COHORT,
)
def cmp8_merge_scores(spark, d):
    rows = T.cohort(spark, d)
    scores = rows.where(F.col("taxid").cast("int") % 4 > 0).select("sample", "taxid", (F.col("frac") * 80).alias("score"))
    return E.merge_scores(scores, rows.select("sample", "taxid", F.col("count").alias("reads")), 0.8).select("taxid", *r6("median_score"), "samples_scored", "max_reads", "verdict")


@query(
    """, rows AS (SELECT sample, taxid, CASE WHEN CAST(read_id AS INTEGER) % 6 = 0 THEN 1 ELSE 0 END AS hit FROM assign WHERE status = 'C'),
    clade AS (SELECT r.sample, c.node AS taxid, COUNT(*) AS reads, SUM(hit) AS rrna_reads FROM rows r JOIN closure c USING (taxid) GROUP BY 1, 2)
    SELECT taxid, CAST(SUM(reads) AS BIGINT) AS reads, CAST(SUM(rrna_reads) AS BIGINT) AS rrna_reads, ROUND(MAX(rrna_reads / reads), 6) AS max_sample_share, ROUND(SUM(rrna_reads) / SUM(reads), 6) AS rrna_share FROM clade GROUP BY taxid""",
    T.TAXONOMY,
    ASSIGN,
)
def cmp9_rrna_share(spark, d):
    rows = assignments(spark, d)
    ids = rows.where("CAST(read_id AS INT) % 6 = 0").select("sample", F.concat("read_id", F.lit("/1")).alias("read_id"))
    out = E.rrna_share(rows, ids, L.closure(T.taxonomy(spark, d)))
    return out.select("taxid", "reads", "rrna_reads", *r6("max_sample_share", "rrna_share"))


# accounting --------------------------------------------------------------------------

LOGS = """logs AS (SELECT o_orderpriority AS sample, 'host' || CAST(o_orderkey % 2 + 1 AS VARCHAR) AS label, o_orderstatus <> 'P' AS paired, o_orderkey % 4 AS chunk, COUNT(*) * 10 AS total, COUNT(*) * 4 AS unaligned
  FROM orders GROUP BY 1, 2, 3, 4)"""


def logs(spark, d):
    rows = T.table(spark, d, "orders")
    label = F.concat(F.lit("host"), (F.col("o_orderkey") % 2 + 1).cast("string"))
    per = rows.groupBy(F.col("o_orderpriority").alias("sample"), label.alias("label"), (F.col("o_orderstatus") != "P").alias("paired"), (F.col("o_orderkey") % 4).alias("chunk")).agg((F.count("*") * 10).alias("total"))
    return per.withColumn("unaligned", (F.col("total") / 10 * 4).cast("long"))


@query(
    """SELECT sample, label, paired, CAST(SUM(total) AS BIGINT) AS total, CAST(SUM(unaligned) AS BIGINT) AS unaligned, COUNT(*) AS chunks, ROUND(100 * (SUM(total) - SUM(unaligned)) / SUM(total), 2) AS aligned_pct FROM logs GROUP BY 1, 2, 3""",
    LOGS,
)
def agg14_merge_align_summaries(spark, d):
    return AC.merge_align_summaries(logs(spark, d))


@query(
    """, p AS (SELECT sample, label, SUM(total) * 2 AS total, SUM(unaligned) * 2 AS unaligned FROM logs WHERE paired GROUP BY 1, 2)
    SELECT c.sample, c.raw_reads, MAX(p.total) FILTER (WHERE label = 'host1') AS host_input, SUM(p.total - p.unaligned) AS host_aligned, MAX(p.unaligned) FILTER (WHERE label = 'host2') AS nonhost,
      SUM(p.total - p.unaligned) AS host_removed FROM accounting c LEFT JOIN p USING (sample) GROUP BY 1, 2
    UNION ALL SELECT p.sample, NULL, MAX(p.total) FILTER (WHERE label = 'host1'), SUM(p.total - p.unaligned), MAX(p.unaligned) FILTER (WHERE label = 'host2'), SUM(p.total - p.unaligned) FROM p WHERE sample = '3-MEDIUM' GROUP BY 1""",
    ACCOUNTING,
    LOGS,
)
def cmp10_account_reads(spark, d):
    align = AC.merge_align_summaries(logs(spark, d).where("paired"))
    out = AC.account_reads(accounting(spark, d), align)
    return out.select("sample", "raw_reads", *[F.col(c).cast("long").alias(c) for c in ("host_input", "host_aligned", "nonhost", "host_removed")])


SQL["cmp10_account_reads"] = SQL["cmp10_account_reads"].replace("SUM(p.total - p.unaligned)", "CAST(SUM(p.total - p.unaligned) AS BIGINT)").replace(
    "MAX(p.total) FILTER (WHERE label = 'host1')", "CAST(MAX(p.total) FILTER (WHERE label = 'host1') AS BIGINT)").replace("MAX(p.unaligned) FILTER (WHERE label = 'host2')", "CAST(MAX(p.unaligned) FILTER (WHERE label = 'host2') AS BIGINT)")


DERIVED = """passes AS (SELECT o_orderpriority AS sample, ['univec', 'host', 'host2'][o_orderkey % 3 + 1] AS label, COUNT(*) * 20 AS input, COUNT(*) * 8 AS unaligned FROM orders GROUP BY 1, 2),
more AS (SELECT o_orderpriority AS sample, 6 * COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS classified, 2 * COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS unclassified, 2 * COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS carried,
  COUNT(*) AS rrna_input, COUNT(*) FILTER (WHERE o_orderkey % 7 = 0) AS rrna, o_orderpriority LIKE '_-%M%' OR o_orderpriority LIKE '2%' OR o_orderpriority LIKE '1%' AS logged FROM orders GROUP BY 1),
derived AS (SELECT m.sample, raw_reads, trimmed_reads, classified, unclassified, carried, classified + unclassified AS nonhost_reads, GREATEST(p.input - classified - unclassified, 0) AS host_removed_reads,
  CASE WHEN logged THEN CASE WHEN trimmed_reads > 0 THEN GREATEST(trimmed_reads - p.input, 0) ELSE rrna END END AS rrna_removed_reads, CASE WHEN trimmed_reads > 0 THEN trimmed_reads ELSE rrna_input END AS base
  FROM more m JOIN passes p ON p.sample = m.sample AND p.label = 'host2' LEFT JOIN accounting a ON a.sample = m.sample)"""


def derived(spark, d):
    orders = T.table(spark, d, "orders").withColumn("sample", F.col("o_orderpriority"))
    label = F.get(F.array(F.lit("univec"), F.lit("host"), F.lit("host2")), (F.col("o_orderkey") % 3).cast("int"))
    passes = orders.groupBy("sample", label.alias("label"), F.lit(True).alias("paired")).agg((F.count("*") * 10).alias("total"), (F.count("*") * 4).alias("unaligned"))
    status = lambda k: F.count_if(F.col("o_orderstatus") == k)
    classified = orders.groupBy("sample").agg((3 * status("F")).alias("classified_reads"), status("O").alias("unclassified_reads"), status("P").alias("host_carryover_reads"))
    logged = F.col("sample").rlike("^(.-.*M|2|1)")
    rrna = orders.where(logged).groupBy("sample").agg(F.count("*").alias("rrna_input_reads"), F.count_if(F.col("o_orderkey") % 7 == 0).alias("rrna_reads"))
    return AC.derive_accounting(AC.account_reads(accounting(spark, d), passes, rrna, classified))


@query(
    """SELECT sample, rrna_removed_reads, CASE WHEN rrna_removed_reads IS NOT NULL THEN ROUND(100 * rrna_removed_reads / base, 2) END AS rrna_pct, host_removed_reads, nonhost_reads, ROUND(100 * classified / nonhost_reads, 2) AS classified_pct,
       ROUND(100 * carried / nonhost_reads, 2) AS host_carryover_pct, COALESCE(ROUND(100 * nonhost_reads / raw_reads, 2), 0) AS nonhost_pct_of_raw FROM derived""",
    ACCOUNTING,
    DERIVED,
)
def prj4_derived_accounting(spark, d):
    """Passes of which the last is ``univec`` and the first ``host2``, not the first by name."""
    counts = [F.col(c).cast("long").alias(c) for c in ("rrna_removed_reads", "host_removed_reads", "nonhost_reads")]
    return derived(spark, d).select("sample", *counts, "rrna_pct", "classified_pct", "host_carryover_pct", "nonhost_pct_of_raw")


@query(
    """, fates AS (SELECT sample, GREATEST(COALESCE(raw_reads, 0) - COALESCE(trimmed_reads, 0), 0) AS trimmed_away, COALESCE(rrna_removed_reads, 0) AS rrna, host_removed_reads AS host, classified AS nonhost_classified, unclassified AS nonhost_unclassified FROM derived)
    SELECT sample, fate, CAST(reads AS BIGINT) AS reads FROM fates UNPIVOT (reads FOR fate IN (trimmed_away, rrna, host, nonhost_classified, nonhost_unclassified))""",
    ACCOUNTING,
    DERIVED,
)
def agg13_read_fate(spark, d):
    return AC.read_fate(derived(spark, d))


@query(
    """SELECT conv_id AS sample, LIST_SORT(LIST(turn)) AS runs, COUNT(*) AS n_runs, CASE WHEN COUNT(DISTINCT role) > 1 THEN 'mixed_molecule' ELSE '' END AS problem FROM conversations GROUP BY conv_id"""
)
def cmp30_group_runs(spark, d):
    rows = T.table(spark, d, "conversations").select(F.col("conv_id").alias("sample"), F.col("turn").alias("run"), F.lit("paired").alias("layout"), F.col("role").alias("molecule"), F.lit("x").alias("platform"))
    return AC.group_runs(rows)


@query("SELECT c_mktsegment AS pool, c_acctbal < 1000 AS single_end, LIST_SORT(LIST(DISTINCT c_name)) AS samples, COUNT(*) AS libraries FROM customer GROUP BY 1, 2")
def cmp31_assembly_pools(spark, d):
    rows = T.table(spark, d, "customer").select(F.col("c_name").alias("sample"), F.col("c_mktsegment").alias("group"), (F.col("c_acctbal") < 1000).alias("single_end"))
    return AC.assembly_pools(rows, "group")


# cells -------------------------------------------------------------------------------


@query("SELECT t AS threshold, COUNT(DISTINCT barcode) AS cells, COUNT(DISTINCT taxid) AS taxa, COUNT(*) AS pairs FROM cell_counts, (SELECT UNNEST([1, 2, 3, 4, 5]) AS t) WHERE count >= t GROUP BY t", T.CELLS)
def flt10_threshold_sweep(spark, d):
    return C.threshold_sweep(T.cell_counts(spark, d))


@query("SELECT CAST(user_id % 5 AS VARCHAR) AS sample, CAST(user_id AS VARCHAR) AS barcode, event_type AS taxid, COUNT(DISTINCT props) AS count FROM events GROUP BY user_id, event_type")
def agg5_cell_taxa(spark, d):
    rows = T.table(spark, d, "events").select((F.col("user_id") % 5).cast("string").alias("sample"), F.col("user_id").cast("string").alias("barcode"), F.col("event_type").alias("taxid"), F.col("props").alias("umi"))
    return C.cell_taxa(rows)


@query("SELECT * FROM cell_counts WHERE taxid <> 'error' AND NOT (taxid = 'click' AND sample = '2') AND NOT (taxid = 'click' AND barcode = '8')", T.CELLS)
def flt4_filter_cell_taxa(spark, d):
    rows = T.cell_counts(spark, d)
    pairs = rows.where("taxid = 'click' AND (sample = '2' OR barcode = '8')").select("taxid", F.when(F.col("sample") == "2", "2").otherwise("8").alias("key"))
    # a barcode may be called as a sample is: only the pair listed is meant
    out = C.filter_cell_taxa(rows.where("barcode <> '2' OR sample = '2'"), rows.where("taxid = 'error'").select("taxid"), pairs)
    return out.select("sample", "barcode", "taxid", "count")


@query(
    """, droplets AS (SELECT barcode, CAST(barcode AS INTEGER) % 4 > 0 AS is_cell, host_umis FROM cells),
    w AS (SELECT COUNT(*) FILTER (WHERE is_cell) AS cells_total, COUNT(*) FILTER (WHERE NOT is_cell) AS empty_total FROM droplets)
    SELECT taxid, COUNT(*) FILTER (WHERE is_cell) AS cells_positive, COUNT(*) FILTER (WHERE NOT is_cell) AS empty_positive, COALESCE(SUM(count) FILTER (WHERE is_cell), 0) AS umis_in_cells, COALESCE(SUM(count) FILTER (WHERE NOT is_cell), 0) AS umis_in_empty,
      ROUND((COUNT(*) FILTER (WHERE is_cell) / MAX(cells_total)) / (COUNT(*) FILTER (WHERE NOT is_cell) / MAX(empty_total)), 6) AS prevalence_ratio FROM cell_counts JOIN droplets USING (barcode), w WHERE count >= 2 GROUP BY taxid""",
    T.CELLS,
)
def cmp14_ambient_tables(spark, d):
    droplets = T.cells(spark, d).select("barcode", (F.col("barcode").cast("int") % 4 > 0).alias("is_cell"), "host_umis")
    rows = C.ambient_tables(C.presence(T.cell_counts(spark, d), 2), droplets)
    return rows.select("taxid", "cells_positive", "empty_positive", "umis_in_cells", "umis_in_empty", *r6("prevalence_ratio"))


@query(
    """, pos AS (SELECT sample, barcode, taxid FROM cell_counts WHERE count >= 3),
    types AS (SELECT sample, cell_type, COUNT(*) AS n_type, SUM(COUNT(*)) OVER (PARTITION BY sample) AS n_sample FROM cells GROUP BY 1, 2),
    hits AS (SELECT sample, taxid, COUNT(*) AS n_infected FROM pos GROUP BY 1, 2), two AS (SELECT p.sample, p.taxid, c.cell_type, COUNT(*) AS a FROM pos p JOIN cells c USING (sample, barcode) GROUP BY 1, 2, 3)
    SELECT sample, cell_type, taxid, n_type, CAST(n_sample AS BIGINT) AS n_sample, n_infected, COALESCE(a, 0) AS a, ROUND(n_type * n_infected / n_sample, 6) AS expected
    FROM types JOIN hits USING (sample) LEFT JOIN two USING (sample, taxid, cell_type) WHERE n_type < n_sample""",
    T.CELLS,
)
def cmp15_enrichment_tables(spark, d):
    rows = C.enrichment_tables(C.presence(T.cell_counts(spark, d), 3), T.cells(spark, d))
    return rows.select("sample", "cell_type", "taxid", "n_type", "n_sample", "n_infected", "a", *r6("expected"))


@query(
    """, pos AS (SELECT sample, barcode, taxid FROM cell_counts WHERE count >= 3), each AS (SELECT sample, taxid, COUNT(*) AS n FROM pos WHERE taxid IN (SELECT taxid FROM pos GROUP BY taxid HAVING COUNT(*) >= 10) GROUP BY 1, 2),
    two AS (SELECT x.sample, x.taxid AS a, y.taxid AS b, COUNT(*) AS n FROM pos x JOIN pos y ON x.sample = y.sample AND x.barcode = y.barcode AND x.taxid < y.taxid GROUP BY 1, 2, 3), size AS (SELECT sample, COUNT(*) AS n_sample FROM cells GROUP BY 1)
    SELECT x.sample, x.taxid AS a, y.taxid AS b, x.n AS n_a, y.n AS n_b, COALESCE(b.n, 0) AS "both", n_sample, ROUND(x.n * y.n / n_sample, 6) AS expected
    FROM each x JOIN each y ON x.sample = y.sample AND x.taxid < y.taxid JOIN size ON size.sample = x.sample LEFT JOIN two b ON b.sample = x.sample AND b.a = x.taxid AND b.b = y.taxid""",
    T.CELLS,
)
def cmp16_cooccurrence_tables(spark, d):
    rows = C.cooccurrence_tables(C.presence(T.cell_counts(spark, d), 3), T.cells(spark, d))
    return rows.select("sample", "a", "b", "n_a", "n_b", "both", "n_sample", *r6("expected"))


def customers(spark, d):
    rows = T.table(spark, d, "customer")
    return rows.select((F.col("c_custkey") % 5).cast("string").alias("sample"), F.col("c_custkey").cast("string").alias("barcode"), F.col("c_mktsegment").alias("cell_type"), "c_nationkey")


def infected(spark, d):
    rows = customers(spark, d).where("c_nationkey % 3 = 0")
    states = C.cell_states(rows.select("sample", "barcode", F.lit("T").alias("taxid")), customers(spark, d), rows.limit(1).select(F.lit("T").alias("taxid")))
    return states


STATES = """states AS (SELECT CAST(c_custkey % 5 AS VARCHAR) AS sample, CAST(c_custkey AS VARCHAR) AS barcode, c_mktsegment AS cell_type, c_nationkey % 3 = 0 AS infected FROM customer)"""


@query(
    """, grid AS (SELECT s.cell_type, s.barcode, s.infected, g.gene, COALESCE(c.value, 0) AS value FROM states s CROSS JOIN (SELECT DISTINCT gene FROM coo) g LEFT JOIN coo c ON c.barcode = s.barcode AND c.gene = g.gene),
    ranked AS (SELECT *, RANK() OVER (PARTITION BY cell_type, gene ORDER BY value) + (COUNT(*) OVER (PARTITION BY cell_type, gene, value) - 1) / 2.0 AS r FROM grid)
    SELECT cell_type, gene, COUNT(*) FILTER (WHERE infected) AS n1, COUNT(*) FILTER (WHERE NOT infected) AS n2, CAST(SUM(r) FILTER (WHERE infected) AS DOUBLE) AS rank_sum FROM ranked GROUP BY 1, 2 HAVING SUM(value) > 0""",
    COO,
    STATES,
)
def cmp18_host_de_ranks(spark, d):
    """The rank sums with analytic zeros, against a dense grid in SQL."""
    rows = C.host_de(coo(spark, d), infected(spark, d), min_cells=1, min_detect=0.0, min_log2fc=0.0)
    return rows.select("cell_type", "gene", "n1", "n2", "rank_sum")


@query(
    """SELECT s.cell_type, s.sample, s.infected, c.gene, SUM(c.value) AS count, MAX(n.n_cells) AS n_cells FROM states s JOIN coo c USING (sample, barcode)
       JOIN (SELECT cell_type, sample, infected, COUNT(*) AS n_cells FROM states GROUP BY 1, 2, 3) n ON n.cell_type = s.cell_type AND n.sample = s.sample AND n.infected = s.infected GROUP BY 1, 2, 3, 4""",
    COO,
    STATES,
)
def agg12_pseudobulk(spark, d):
    return C.pseudobulk(coo(spark, d), infected(spark, d)).drop("taxid").select("cell_type", "sample", "infected", "gene", "count", "n_cells")


KMERS = """kmers AS (SELECT taxid, barcode, COUNT(*) AS total, COUNT(DISTINCT kmer) AS "distinct" FROM (SELECT lang AS taxid, source AS barcode, UNNEST(STRING_SPLIT(LOWER(text), ' ')) AS kmer FROM documents) GROUP BY 1, 2)"""


def kmers(spark, d):
    rows = T.table(spark, d, "documents").select(F.col("lang").alias("taxid"), F.col("source").alias("barcode"), F.explode(F.split(F.lower("text"), " ")).alias("kmer"))
    return rows.groupBy("taxid", "barcode").agg(F.count("*").alias("total"), F.count_distinct("kmer").alias("distinct"))


@query(
    """SELECT taxid, COUNT(*) AS n, ROUND(CORR(rx, ry), 6) AS rho FROM (SELECT taxid, RANK() OVER (PARTITION BY taxid ORDER BY total) + (COUNT(*) OVER (PARTITION BY taxid, total) - 1) / 2.0 AS rx,
         RANK() OVER (PARTITION BY taxid ORDER BY "distinct") + (COUNT(*) OVER (PARTITION BY taxid, "distinct") - 1) / 2.0 AS ry FROM kmers) GROUP BY taxid""",
    KMERS,
)
def sta1_spearman(spark, d):
    return C.spearman(kmers(spark, d), "total", "distinct", ["taxid"]).select("taxid", "n", *r6("rho"))


@query(
    """SELECT taxid, COUNT(*) FILTER (WHERE grp = 'R0') AS n1, COUNT(*) FILTER (WHERE grp <> 'R0') AS n2, CAST(SUM(r) FILTER (WHERE grp = 'R0') AS DOUBLE) AS rank_sum FROM (
         SELECT taxid, grp, RANK() OVER (PARTITION BY taxid ORDER BY count) + (COUNT(*) OVER (PARTITION BY taxid, count) - 1) / 2.0 AS r FROM dense JOIN groups USING (sample)) GROUP BY taxid""",
    T.COHORT,
    T.GROUPS,
)
def sta5_rank_sum(spark, d):
    rows = A.dense(T.cohort(spark, d)).join(T.groups(spark, d), "sample")
    return C.rank_sum(rows, "count", F.col("group") == "R0", ["taxid"]).select("taxid", "n1", "n2", "rank_sum")


# cohorts -----------------------------------------------------------------------------


@query(
    """SELECT sample, COUNT(*) FILTER (WHERE count > 0) AS observed, ROUND(-SUM(frac * LN(frac)), 6) AS shannon, ROUND(1 - SUM(frac * frac), 6) AS simpson, ROUND(1 / SUM(frac * frac), 6) AS inverse_simpson,
       ROUND(-SUM(frac * LN(frac)) / LN(COUNT(*)), 6) AS pielou FROM cohort GROUP BY sample""",
    T.COHORT,
)
def sta9_alpha_diversity(spark, d):
    return CO.alpha_diversity(T.cohort(spark, d)).select("sample", "observed", *r6("shannon", "simpson", "inverse_simpson", "pielou"))


@query(
    """, clr AS (SELECT sample, taxid, l - AVG(l) OVER (PARTITION BY sample) AS clr FROM (SELECT sample, taxid, LN(CASE WHEN count = 0 THEN MIN(NULLIF(count, 0)) OVER (PARTITION BY sample) / 2 ELSE count END) AS l FROM dense))
    SELECT x.sample AS a, y.sample AS b, ROUND(SQRT(SUM((x.clr - y.clr) * (x.clr - y.clr))), 6) AS distance FROM clr x JOIN clr y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2""",
    T.COHORT,
)
def sta10_aitchison(spark, d):
    return CO.aitchison(T.cohort(spark, d)).select("a", "b", *r6("distance"))


@query("SELECT x.sample AS a, y.sample AS b, ROUND(1 - 2 * SUM(LEAST(x.count, y.count)) / SUM(x.count + y.count), 6) AS distance FROM dense x JOIN dense y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2", T.COHORT)
def sta11_bray_curtis(spark, d):
    return CO.beta_distance(T.cohort(spark, d), "bray").select("a", "b", *r6("distance"))


@query("SELECT x.sample AS a, y.sample AS b, ROUND(SQRT(SUM((x.count - y.count) * (x.count - y.count))), 4) AS distance FROM dense x JOIN dense y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2", T.COHORT)
def sta11_euclidean(spark, d):
    return CO.beta_distance(T.cohort(spark, d), "euclidean").select("a", "b", F.round("distance", 4).alias("distance"))


@query("SELECT x.sample AS a, y.sample AS b, ROUND(1 - COUNT(*) FILTER (WHERE x.count > 0 AND y.count > 0) / COUNT(*) FILTER (WHERE x.count > 0 OR y.count > 0), 6) AS distance FROM dense x JOIN dense y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2", T.COHORT)
def sta11_jaccard(spark, d):
    return CO.beta_distance(T.cohort(spark, d), "jaccard").select("a", "b", *r6("distance"))


@query("SELECT grp AS \"group\", taxid, MEDIAN(count) AS median, ROUND(AVG(count), 6) AS mean, SUM(count) AS total FROM dense JOIN groups USING (sample) GROUP BY 1, 2", T.COHORT, T.GROUPS)
def agg10_group_medians(spark, d):
    return CO.group_medians(T.cohort(spark, d), T.groups(spark, d)).select("group", "taxid", "median", *r6("mean"), "total")


@query(
    """, clr AS (SELECT sample, taxid, l - AVG(l) OVER (PARTITION BY sample) AS clr FROM (SELECT sample, taxid, LN(CASE WHEN count = 0 THEN MIN(NULLIF(count, 0)) OVER (PARTITION BY sample) / 2 ELSE count END) AS l FROM dense)),
    m AS (SELECT taxid, grp, clr, AVG(clr) OVER (PARTITION BY taxid) AS g, AVG(clr) OVER (PARTITION BY taxid, grp) AS k FROM clr JOIN groups USING (sample))
    SELECT ROUND(SUM((clr - g) * (clr - g)), 4) AS total_ss, ROUND(SUM((k - g) * (k - g)), 4) AS between_ss FROM m""",
    T.COHORT,
    T.GROUPS,
)
def sta14_group_sums(spark, d):
    clr = A.nearest_zero(A.dense(T.cohort(spark, d))).select("sample", "taxid", "clr")
    return CO.group_sums(clr, T.groups(spark, d)).select(F.round("total_ss", 4).alias("total_ss"), F.round("between_ss", 4).alias("between_ss"))


META = """meta AS (SELECT n_name AS sample, n_regionkey = 0 AS is_control, 1.0 + n_nationkey AS conc FROM nation)"""


def metadata(spark, d):
    return T.table(spark, d, "nation").select(F.col("n_name").alias("sample"), (F.col("n_regionkey") == 0).alias("is_control"), (1.0 + F.col("n_nationkey")).cast("double").alias("conc"))


@query(
    """, seen AS (SELECT taxid, COUNT(*) FILTER (WHERE is_control) AS c, COUNT(*) FILTER (WHERE NOT is_control) AS s FROM cohort JOIN meta USING (sample) WHERE count > 40 GROUP BY taxid),
    w AS (SELECT COUNT(*) FILTER (WHERE is_control) AS nc, COUNT(*) FILTER (WHERE NOT is_control) AS ns FROM meta)
    SELECT taxid, c, s, nc, ns, ROUND(COALESCE((nc + ns) * POWER(GREATEST(ABS(s * (nc - c) - c * (ns - s)) - (nc + ns) / 2, 0), 2) / NULLIF((s + c) * (nc + ns - s - c) * ns * nc, 0), 0), 6) AS chi2 FROM seen, w""",
    T.COHORT,
    META,
)
def sta17_decontam_prevalence(spark, d):
    rows = CO.decontam_prevalence(T.cohort(spark, d), metadata(spark, d), above=40)
    return rows.select("taxid", "c", "s", "nc", "ns", *r6("chi2"))


@query(
    """SELECT taxid, COUNT(*) AS n, ROUND(VAR_POP(LN(frac) + LN(conc)) * COUNT(*), 6) AS ss_contaminant, ROUND(VAR_POP(LN(frac)) * COUNT(*), 6) AS ss_real FROM cohort JOIN meta USING (sample) GROUP BY taxid""",
    T.COHORT,
    META,
)
def sta17_decontam_frequency(spark, d):
    return CO.decontam_frequency(T.cohort(spark, d), metadata(spark, d)).select("taxid", "n", *r6("ss_contaminant", "ss_real"))


GENES = """genes AS (SELECT n_name AS sample, CAST(l_partkey % 97 AS VARCHAR) AS gene, SUM(l_quantity) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def genes(spark, d):
    rows = T.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 97).cast("string").alias("gene"), "l_quantity")
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_custkey").join(T.table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    nation = T.table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("sample"))
    rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("sample", "gene").agg(F.sum("l_quantity").alias("count"))


@query(
    """, logs AS (SELECT sample, gene, LN(count) AS l FROM genes WHERE count > 0), means AS (SELECT gene, AVG(l) AS m FROM logs GROUP BY gene HAVING COUNT(*) = (SELECT COUNT(DISTINCT sample) FROM genes))
    SELECT sample, ROUND(EXP(MEDIAN(l - m)), 6) AS factor FROM logs JOIN means USING (gene) GROUP BY sample""",
    GENES,
)
def sta19_size_factors(spark, d):
    return CO.size_factors(genes(spark, d)).select("sample", *r6("factor"))


@query(
    """SELECT x.taxid AS a, y.taxid AS b, ROUND(VAR_SAMP(LN(x.count + 0.5) - LN(y.count + 0.5)), 6) AS variance FROM dense x JOIN dense y ON x.sample = y.sample AND x.taxid < y.taxid GROUP BY 1, 2""",
    T.COHORT,
)
def sta20_log_ratio_variance(spark, d):
    return CO.log_ratio_variance(T.cohort(spark, d)).select("a", "b", *r6("variance"))


# explore, merge, reads, markers ------------------------------------------------------


@query(
    """, best AS (SELECT name FROM cohort GROUP BY name ORDER BY SUM(count) DESC, name LIMIT 10)
    SELECT sample, CASE WHEN name IN (SELECT name FROM best) THEN name ELSE 'Other' END AS name, SUM(count) AS count FROM cohort GROUP BY 1, 2""",
    T.COHORT,
)
def agg10_composition(spark, d):
    return X.composition(T.cohort(spark, d))


@query("SELECT sample, taxid, count FROM cohort WHERE count >= 60 AND sample <> 'NATION_3' AND name <> 'Taxon 5'", T.COHORT)
def flt5_filter_view(spark, d):
    rows = T.cohort(spark, d)
    names = [f"NATION_{k}" for k in range(25) if k != 3]
    return X.filter_view(rows, "S", names, min_reads=60, discard=rows.where("taxid = '5'")).select("sample", "taxid", "count")


@query(
    """, q(query) AS (SELECT DISTINCT p_type FROM part UNION SELECT 'red ring' UNION SELECT 'small' UNION SELECT 'red zzz'), n AS (SELECT DISTINCT p_name AS name FROM part),
    m AS (SELECT query, name, CASE WHEN LOWER(name) = LOWER(query) THEN 1 WHEN CONTAINS(LOWER(name), LOWER(query)) THEN 2 ELSE 3 END AS level FROM q JOIN n ON CONTAINS(LOWER(name), LOWER(query)) OR CONTAINS(LOWER(name), LOWER(STRING_SPLIT(query, ' ')[1])))
    SELECT query, name, ['exact', 'substring', 'genus'][level] AS strategy FROM m QUALIFY level = MIN(level) OVER (PARTITION BY query)"""
)
def flt6_match_names(spark, d):
    part = T.table(spark, d, "part")
    typed = part.select(F.col("p_type").alias("query")).distinct()
    more = part.limit(1).select(F.explode(F.array(F.lit("red ring"), F.lit("small"), F.lit("red zzz"))).alias("query"))
    return X.match_names(part.select(F.col("p_name").alias("name")), typed.union(more))


@query("PIVOT (SELECT sample, taxid, count FROM abundance) ON sample IN ('1-URGENT', '2-HIGH', 'EMPTY') USING COALESCE(SUM(count), 0) GROUP BY taxid", T.ABUNDANCE)
def snk1_wide_matrix(spark, d):
    return ME.wide_matrix(T.abundance(spark, d), "taxid", "count", ["1-URGENT", "2-HIGH", "EMPTY"])


SQL["snk1_wide_matrix"] = (
    "WITH " + T.ABUNDANCE + " SELECT taxid, COALESCE(SUM(count) FILTER (WHERE sample = '1-URGENT'), 0) AS \"1-URGENT\", COALESCE(SUM(count) FILTER (WHERE sample = '2-HIGH'), 0) AS \"2-HIGH\", CAST(0 AS DOUBLE) AS \"EMPTY\" FROM abundance GROUP BY taxid"
)


@query(
    """SELECT l_returnflag AS sample, p_brand AS gene, SUM(l_quantity) AS count, ROUND(SUM(l_tax), 6) AS tpm, ROUND(SUM(l_quantity * p_size) / SUM(l_quantity), 6) AS length FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
)
def agg15_tx_to_gene(spark, d):
    part = T.table(spark, d, "part")
    rows = T.table(spark, d, "lineitem").join(part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    transcripts = rows.select(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("transcript"), F.col("p_size").alias("length"), F.col("l_quantity").alias("count"), F.col("l_tax").alias("tpm"))
    out = ME.tx_to_gene(transcripts, part.select(F.col("p_partkey").alias("transcript"), F.col("p_brand").alias("gene")))
    return out.select("sample", "gene", "count", *r6("tpm", "length"))


@query("SELECT p_name AS gene, COUNT(DISTINCT p_size) AS lengths, MIN(p_size) AS least, MAX(p_size) AS most FROM part GROUP BY 1 HAVING COUNT(DISTINCT p_size) > 1")
def agg18_inconsistent_lengths(spark, d):
    return ME.inconsistent_lengths(T.table(spark, d, "part").select(F.col("p_name").alias("gene"), F.col("p_size").alias("length")))


@query("SELECT CAST(c_custkey AS VARCHAR) AS sample, TRUE AS in_a, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS in_b FROM customer")
def set4_sample_agreement(spark, d):
    a = T.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("sample"))
    return ME.sample_agreement(a, T.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("sample")))


@query("SELECT doc_id, text FROM documents QUALIFY ROW_NUMBER() OVER (PARTITION BY UPPER(text) ORDER BY source, doc_id) = 1")
def set6_distinct_sequences(spark, d):
    rows = T.table(spark, d, "documents").select("doc_id", F.col("text").alias("seq"), F.col("source").alias("path"), F.col("doc_id").alias("pos"))
    return R.distinct_sequences(rows).select("doc_id", F.col("seq").alias("text"))


@query(
    """, ours AS (SELECT conv_id * 1000 + turn AS name, UNNEST(RANGE(0, GREATEST(LENGTH(text) - 11, 0))) AS s, text FROM conversations), theirs AS (SELECT DISTINCT SUBSTR(text, k + 1, 12) AS tile FROM (SELECT text, UNNEST(RANGE(0, GREATEST(LENGTH(text) - 11, 0))) AS k FROM benchmark)),
    hit AS (SELECT name, s, s + 12 AS e FROM ours WHERE SUBSTR(text, s + 1, 12) IN (SELECT tile FROM theirs)),
    marked AS (SELECT *, CASE WHEN s > MAX(e) OVER (PARTITION BY name ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS fresh FROM hit),
    islands AS (SELECT *, SUM(fresh) OVER (PARTITION BY name ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM marked)
    SELECT name, MIN(s) AS "start", MAX(e) AS "end" FROM islands GROUP BY name, island"""
)
def joi14_mask_regions(spark, d):
    host = T.table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("name"), F.col("text").alias("seq"))
    regions = R.mask_regions(host, T.table(spark, d, "benchmark").select(F.col("item_id").alias("name"), F.col("text").alias("seq")), 12)
    return regions.select("name", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("SELECT source AS sample, COUNT(*) AS reads, ROUND(AVG(LENGTH(text)), 6) AS mean_length, ROUND(SUM(LENGTH(REGEXP_REPLACE(text, '[^GCgc]', '', 'g'))) / SUM(LENGTH(text)), 6) AS gc FROM documents GROUP BY 1")
def agg21_fragment_stats(spark, d):
    return R.fragment_stats(T.table(spark, d, "documents").select(F.col("source").alias("sample"), F.col("text").alias("seq"))).select("sample", "reads", *r6("mean_length", "gc"))


@query()
def udf2_shuffle_reads(spark, d):
    from taxolith.functions.distributions import shuffle_read

    rows = T.table(spark, d, "conversations").select("conv_id", "turn", "text")
    return rows.withColumn("shuffled", shuffle_read(F.col("text"), F.col("conv_id").cast("string"), F.col("turn")))


GENOMES = """genomes AS (SELECT CAST(c_custkey AS VARCHAR) AS genome, c_mktsegment AS taxid FROM customer), clusters AS (SELECT DISTINCT CAST(l_partkey % 53 AS VARCHAR) AS cluster, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS gene, CAST(o_custkey AS VARCHAR) AS genome
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def clusters(spark, d):
    s = lambda c: F.col(c).cast("string")
    rows = T.table(spark, d, "lineitem")
    rows = rows.join(T.table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    own = rows.select((F.col("l_partkey") % 53).cast("string").alias("cluster"), F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey")).alias("gene"), s("o_custkey").alias("genome")).distinct()
    return own, T.table(spark, d, "customer").select(s("c_custkey").alias("genome"), F.col("c_mktsegment").alias("taxid"))


@query(
    """, n AS (SELECT taxid, COUNT(DISTINCT genome) AS n FROM genomes GROUP BY 1)
    SELECT cluster, taxid, COUNT(DISTINCT genome) AS genomes, ROUND(COUNT(DISTINCT genome) / MAX(n.n), 6) AS coreness FROM clusters JOIN genomes USING (genome) JOIN n USING (taxid) GROUP BY 1, 2""",
    GENOMES,
)
def cmp27_coreness(spark, d):
    own, species = clusters(spark, d)
    return M.coreness(own, species).select("cluster", "taxid", "genomes", *r6("coreness"))


@query("SELECT c_mktsegment AS taxid, CAST(c_custkey AS VARCHAR) AS genome FROM customer QUALIFY ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_acctbal DESC, CAST(c_custkey AS VARCHAR)) <= 20")
def top7_mapping_targets(spark, d):
    rows = T.table(spark, d, "customer").select(F.col("c_mktsegment").alias("taxid"), F.col("c_custkey").cast("string").alias("genome"), F.col("c_nationkey").alias("contigs"), F.col("c_acctbal").alias("length"))
    return M.mapping_targets(rows, 20).select("taxid", "genome")


@query(
    """, p AS (SELECT source AS sample, CAST(doc_id AS VARCHAR) AS read_id, UPPER(REPLACE(text, 'ß', 'ss')) AS seq FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
    SELECT sample, read_id, taxid, status, seq FROM assign JOIN p USING (sample, read_id)""",
    ASSIGN,
)
def joi9_attach_sequences(spark, d):
    """Only documents with labels stand for reads here, so most assignments lack theirs."""
    reads = T.table(spark, d, "documents").join(T.table(spark, d, "labels"), "doc_id", "left_semi").select(F.col("source").alias("sample"), F.concat(F.col("doc_id").cast("string"), F.lit("/1")).alias("read_id"), F.col("text").alias("seq"))
    return R.attach_sequences(assignments(spark, d), reads).select("sample", "read_id", "taxid", "status", "seq")


@query(
    """SELECT 'R' || CAST(n_regionkey % 2 AS VARCHAR) AS sample, taxid, rank, name, depth, ancestors FROM (
         SELECT r_regionkey AS n_regionkey, CAST(9000000 + r_regionkey AS VARCHAR) AS taxid, 'P' AS rank, r_name AS name, 0 AS depth, CAST([] AS VARCHAR[]) AS ancestors FROM region
         UNION ALL SELECT n_regionkey, CAST(8000000 + n_nationkey AS VARCHAR), 'F', n_name, 1, [CAST(9000000 + n_regionkey AS VARCHAR)] FROM nation
         UNION ALL SELECT n_regionkey, CAST(s_suppkey AS VARCHAR), 'S', s_name, 2, [CAST(9000000 + n_regionkey AS VARCHAR), CAST(8000000 + n_nationkey AS VARCHAR)] FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
)
def udf4_parse_reports(spark, d):
    """The tree of suppliers as two report texts, read back with lineages."""
    nation = T.table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("_r"))
    supplier = T.table(spark, d, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    none = F.lit(-1).cast("long")
    rows = T.table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("r"), none.alias("n"), none.alias("s"), (9000000 + F.col("r_regionkey")).cast("string").alias("taxid"), F.lit("P").alias("rank"), F.col("r_name").alias("name"))
    rows = rows.union(nation.select("_r", "n_nationkey", none, (8000000 + F.col("n_nationkey")).cast("string"), F.lit("F"), F.concat(F.lit("  "), "n_name")))
    rows = rows.union(supplier.select("_r", "n_nationkey", "s_suppkey", F.col("s_suppkey").cast("string"), F.lit("S"), F.concat(F.lit("    "), "s_name")))
    line = F.concat_ws("\t", F.lit("0.00"), F.lit("0"), F.lit("0"), "rank", "taxid", "name").alias("line")
    texts = rows.groupBy(F.concat(F.lit("R"), (F.col("r") % 2).cast("string")).alias("sample")).agg(F.sort_array(F.collect_list(F.struct("r", "n", "s", line))).alias("lines"))
    texts = texts.select("sample", F.array_join("lines.line", "\n").alias("text"))
    return L.parse_reports(texts).select("sample", "taxid", "rank", "name", "depth", "ancestors")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS genome, CASE WHEN c_acctbal < 3000 THEN c_name ELSE 'remote' || CAST(o.k AS VARCHAR) END AS fasta, CASE WHEN c_nationkey % 4 = 0 THEN c_mktsegment WHEN c_acctbal >= 3000 THEN o.status END AS cds,
       c_nationkey % 4 = 0 OR (c_acctbal >= 3000 AND o.status IS NOT NULL) AS has_cds
       FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS k, MAX(o_orderstatus) FILTER (WHERE o_orderstatus <> 'O') AS status FROM orders GROUP BY 1) o ON o_custkey = c_custkey WHERE c_acctbal < 3000 OR o.k IS NOT NULL"""
)
def joi13_genome_sources(spark, d):
    key = lambda c: F.col(c).cast("string").alias("genome")
    sheet = T.table(spark, d, "customer").select(key("c_custkey"), F.when(F.col("c_acctbal") < 3000, F.col("c_name")).alias("fasta"), F.when(F.col("c_nationkey") % 4 == 0, F.col("c_mktsegment")).alias("cds"))
    orders = T.table(spark, d, "orders")
    downloads = orders.groupBy(key("o_custkey")).agg(F.concat(F.lit("remote"), F.count("*").cast("string")).alias("fasta"))
    annotations = orders.where("o_orderstatus <> 'O'").groupBy(key("o_custkey")).agg(F.max("o_orderstatus").alias("cds"))
    return M.genome_sources(sheet, downloads, annotations)

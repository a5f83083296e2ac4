"""Queries of cohort statistics that draw or project; their SQL repeats the draws, which are counters of a hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxolith.functions.draws import MIX
from taxolith.operators import cohort as CO
from taxolith.queries import core
from taxolith.queries import tables as T
from taxolith.queries.core import query, r6
from taxolith.queries.statistics import bh_sql, student_sql


def chained(steps: list[tuple[str, str]], source: str, result: str) -> str:
    """A query that works out named values one after the other, each from those before."""
    for name, value in steps:
        source = f"(SELECT *, {value} AS {name} FROM {source})"
    return f"SELECT * EXCLUDE ({', '.join(n for n, _ in steps if n != result)}) FROM {source}"


def draw_sql(table: str, seed: int, counters: list[str], name: str = "draw") -> str:
    """``table`` with the 32-bit draw of a seed and counters as ``name``."""
    steps, last = [], str(seed)
    for k, counter in enumerate(["", *counters]):
        last = f"xor({last}, {counter})" if counter else last
        for j in range(2):
            steps.append((f"_m{k}{j}", f"(xor({last} >> 16, {last}) * {MIX}) & 4294967295"))
            last = f"_m{k}{j}"
        steps.append((name if k == len(counters) else f"_m{k}", f"xor({last} >> 16, {last})"))
        last = f"_m{k}"
    return chained([(n, f"CAST({v} AS BIGINT)") for n, v in steps], f"(SELECT * FROM {table})", name)


def key_sql(name: str) -> str:
    return f"CAST('0x' || SUBSTR(MD5({name}), 1, 8) AS BIGINT)"


CLR = """clr AS (SELECT sample, taxid, l - AVG(l) OVER (PARTITION BY sample) AS clr FROM (SELECT sample, taxid, LN(CASE WHEN count = 0 THEN MIN(NULLIF(count, 0)) OVER (PARTITION BY sample) / 2 ELSE count END) AS l FROM dense))"""


@query()
def sta12_ordinate(spark, d):
    return CO.ordinate(T.cohort(spark, d))


@query()
def sta13_pca(spark, d):
    return CO.pca(T.cohort(spark, d))


def apart(rows):
    """Distances between samples over all their axes."""
    a, b = (rows.select(F.col("sample").alias(n), "axis", F.col("value").alias(v)) for n, v in (("a", "x"), ("b", "y")))
    near = a.join(b, "axis").where("a < b").groupBy("a", "b").agg(F.sqrt(F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y")))).alias("distance"))
    return near.select("a", "b", *r6("distance"))


@query(
    "SELECT x.sample AS a, y.sample AS b, ROUND(SQRT(SUM((x.clr - y.clr) * (x.clr - y.clr))), 6) AS distance FROM clr x JOIN clr y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2",
    T.COHORT,
    CLR,
)
def sta12_all_axes(spark, d):
    """All principal coordinates together keep the distances they are made from."""
    return apart(CO.ordinate(T.cohort(spark, d), axes=24))


@query(
    """, pct AS (SELECT sample, taxid, 100 * count / SUM(count) OVER (PARTITION BY sample) AS pct FROM dense),
    z AS (SELECT sample, taxid, pct / NULLIF(STDDEV_SAMP(pct) OVER (PARTITION BY taxid), 0) AS z FROM pct)
    SELECT x.sample AS a, y.sample AS b, ROUND(SQRT(SUM((x.z - y.z) * (x.z - y.z))), 6) AS distance FROM z x JOIN z y ON x.taxid = y.taxid AND x.sample < y.sample GROUP BY 1, 2""",
    T.COHORT,
)
def sta13_all_axes(spark, d):
    return apart(CO.pca(T.cohort(spark, d), axes=24))


SHARES = """total AS (SELECT SUM((clr - g) * (clr - g)) AS whole FROM (SELECT clr, AVG(clr) OVER (PARTITION BY taxid) AS g FROM clr))"""
# Row k of the samples in their order receives the row that has the k-th draw.
MOVES = f"""drawn AS ({draw_sql(f"(SELECT sample, rep, {key_sql('sample')} AS key FROM traits, (SELECT UNNEST(RANGE(1000)) AS rep))", 1, ["rep", "key"])}),
moves AS (SELECT p.rep, p.sample AS place, s.sample AS source FROM (SELECT rep, sample, ROW_NUMBER() OVER (PARTITION BY rep ORDER BY sample) AS k FROM drawn) p
  JOIN (SELECT rep, sample, ROW_NUMBER() OVER (PARTITION BY rep ORDER BY CASE WHEN rep = 0 THEN 0 ELSE draw END, sample) AS k FROM drawn) s USING (rep, k))"""
TRAITS = """traits AS (SELECT n_name AS sample, 'R' || CAST(n_regionkey AS VARCHAR) AS region, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, CASE WHEN n_nationkey % 2 = 1 THEN 'odd' ELSE 'even' END AS side
  FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 4)"""


def traits(spark, d):
    balance = T.table(spark, d, "customer").groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
    side = F.when(F.col("n_nationkey") % 2 == 1, "odd").otherwise("even")
    rows = T.table(spark, d, "nation").join(balance, F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.select(F.col("n_name").alias("sample"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("region"), "balance", side.alias("side"))


@query(
    """, sums AS (SELECT rep, region, taxid, SUM(clr) AS s, COUNT(*) AS n FROM moves JOIN traits ON traits.sample = place JOIN clr ON clr.sample = source GROUP BY 1, 2, 3),
    fits AS (SELECT rep, SUM(b) AS between_ss, MAX(n) AS n, MAX(g) AS g FROM (SELECT rep, taxid, SUM(s * s / n) - SUM(s) * SUM(s) / SUM(n) AS b, SUM(n) AS n, COUNT(*) AS g FROM sums GROUP BY 1, 2) GROUP BY rep),
    f AS (SELECT *, (between_ss / (g - 1)) / ((whole - between_ss) / (n - g)) AS f FROM fits, total)
    SELECT 'region' AS variable, CAST(o.g AS INTEGER) AS levels, CAST(o.n AS INTEGER) AS n, ROUND(1 - (1 - o.between_ss / o.whole) * (o.n - 1) / (o.n - o.g), 6) AS r2_adj, ROUND(o.f, 6) AS f,
      (SELECT COUNT(*) FROM f x, f y WHERE y.rep = 0 AND x.f >= y.f * (1 - 1e-9)) / 1000.0 AS p, ROUND(o.between_ss / o.whole, 6) AS permanova_r2 FROM f o WHERE rep = 0""",
    T.COHORT,
    CLR,
    TRAITS,
    SHARES,
    MOVES,
)
def sta14_beta_variance(spark, d):
    rows = CO.beta_variance(T.cohort(spark, d), traits(spark, d), ["region"])
    return rows.select("variable", "levels", "n", *r6("r2_adj", "f"), "p", *r6("permanova_r2"))


@query(
    """, x AS (SELECT sample, region, 'balance' AS variable, balance AS x FROM traits UNION ALL SELECT sample, region, 'side', CASE WHEN side = 'odd' THEN 1.0 ELSE 0.0 END FROM traits),
    res AS (SELECT *, x - AVG(x) OVER (PARTITION BY variable, region) AS r FROM x), u AS (SELECT sample, region, variable, r / SQRT(SUM(r * r) OVER (PARTITION BY variable)) AS u FROM res),
    e AS (SELECT sample, taxid, clr - AVG(clr) OVER (PARTITION BY taxid, region) AS e FROM clr JOIN traits USING (sample)),
    moved AS (SELECT rep, place, taxid, e FROM moves JOIN e ON e.sample = source),
    own AS (SELECT rep, variable, SUM(s * s) AS ss FROM (SELECT rep, variable, taxid, SUM(u * e) AS s FROM moved JOIN u ON u.sample = place GROUP BY 1, 2, 3) GROUP BY 1, 2),
    again AS (SELECT rep, SUM(s * s / n) AS again FROM (SELECT rep, region, taxid, SUM(e) AS s, COUNT(*) AS n FROM moved JOIN traits ON traits.sample = place GROUP BY 1, 2, 3) GROUP BY 1),
    f AS (SELECT rep, variable, ss, rest, whole, ss / ((rest - again - ss) / (25 - 6)) AS f FROM own JOIN again USING (rep), (SELECT SUM(e * e) AS rest FROM e), total),
    p AS (SELECT o.variable, o.ss, o.rest, o.whole, o.f, (SELECT COUNT(*) FROM f y WHERE y.variable = o.variable AND y.f >= o.f * (1 - 1e-9)) / 1000.0 AS p FROM f o WHERE rep = 0), """
    + bh_sql("p", "variable") + """
    SELECT variable, CASE WHEN variable = 'side' THEN 2 END AS levels, 25 AS n, ROUND((1 - (rest - ss) / whole * 24 / 19) - (1 - rest / whole * 24 / 20), 6) AS r2_adj, ROUND(f, 6) AS f, p,
      ROUND(ss / whole, 6) AS permanova_r2, 'region' AS condition, ROUND(q, 6) AS p_adj FROM p_q""",
    T.COHORT,
    CLR,
    TRAITS,
    SHARES,
    MOVES,
)
def sta14_conditioned(spark, d):
    """A number and a name, each beyond the region."""
    rows = CO.beta_variance(T.cohort(spark, d), traits(spark, d), ["balance", "side"], condition=["region"])
    return rows.select("variable", "levels", "n", *r6("r2_adj", "f"), "p", *r6("permanova_r2"), "condition", *r6("p_adj"))


@query()
def sta15_stepwise(spark, d):
    """Beyond the side; any p lets a variable enter here, as the traits have little to do with the counts."""
    rows = CO.beta_variance(T.cohort(spark, d), traits(spark, d), ["region", "balance"], condition=["side"], enter=1.0)
    return rows.select("variable", *r6("r2_adj", "cumulative_r2_adj"))


TWO = """two AS (SELECT sample, taxid, count, grp FROM dense JOIN groups USING (sample) WHERE grp IN ('R0', 'R1')),
filled AS (SELECT s.sample, t.taxid, COALESCE(c.count, 0) AS count, s.grp FROM (SELECT DISTINCT sample, grp FROM two) s CROSS JOIN (SELECT DISTINCT taxid FROM two WHERE count > 0) t LEFT JOIN two c ON c.sample = s.sample AND c.taxid = t.taxid)"""


def welch_sql(table: str, value: str, by: str) -> str:
    """Common tables up to ``welch``: difference, t and df of group R1 against R0."""
    side = lambda f, g: f"{f}({value}) FILTER (WHERE grp {g} 'R0')"
    return f"""sides AS (SELECT {by}, {side('AVG', '<>')} AS m1, {side('AVG', '=')} AS m2, {side('VAR_SAMP', '<>')} / {side('COUNT', '<>')} AS a, {side('VAR_SAMP', '=')} / {side('COUNT', '=')} AS b,
      {side('COUNT', '<>')} AS n1, {side('COUNT', '=')} AS n2 FROM {table} GROUP BY {by}),
    welch AS (SELECT {by}, m1 - m2 AS difference, CASE WHEN a + b > 0 THEN (m1 - m2) / SQRT(a + b) END AS t, CASE WHEN a + b > 0 THEN (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)) END AS df FROM sides)"""


def unit_sql(digest: str, k: int) -> str:
    return f"((CAST('0x' || SUBSTR({digest}, {8 * k + 1}, 8) AS BIGINT) + 0.5) / 4294967296.0)"


@query(
    f""", cells AS (SELECT sample, taxid, grp, count + 0.5 AS shape, rep, '1:' || rep || ':' || sample || ':' || taxid AS name FROM filled, (SELECT UNNEST(RANGE(1, 129)) AS rep)),
    tries AS (SELECT *, MD5(name || ':' || k) AS h FROM (SELECT *, UNNEST(RANGE(8)) AS k FROM cells)),
    n AS (SELECT *, SQRT(-2 * LN({unit_sql("h", 0)})) * COS(2 * PI() * {unit_sql("h", 1)}) AS x, {unit_sql("h", 2)} AS u, CASE WHEN shape < 1 THEN shape + 1 ELSE shape END - 1 / 3.0::DOUBLE AS d FROM tries),
    v AS (SELECT *, POWER(1 + x / SQRT(9 * d), 3) AS v FROM n),
    good AS (SELECT * FROM v WHERE v > 0 AND LN(u) < 0.5 * x * x + d - d * v + d * LN(CASE WHEN v > 0 THEN v ELSE 1 END)),
    first AS (SELECT sample, taxid, rep, MIN_BY(LN(d * v), k) AS l FROM good GROUP BY 1, 2, 3),
    logs AS (SELECT sample, taxid, grp, rep, l + CASE WHEN shape < 1 THEN LN({unit_sql("MD5(name)", 0)}) / shape ELSE 0 END AS l FROM cells JOIN first USING (sample, taxid, rep)),
    ratios AS (SELECT *, l - AVG(l) OVER (PARTITION BY rep, sample) AS r FROM logs), """
    + welch_sql("ratios", "r", "rep, taxid") + f", p AS (SELECT rep, taxid, difference, {student_sql('t', 'df')} AS p FROM welch), " + bh_sql("p", "taxid", "rep")
    + " SELECT taxid, ROUND(AVG(difference), 6) AS effect, ROUND(AVG(p), 6) AS p, ROUND(AVG(q), 6) AS q FROM p_q GROUP BY taxid",
    T.COHORT,
    T.GROUPS,
    TWO,
)
def sta18_clr_group_test(spark, d):
    two = T.groups(spark, d).where("group IN ('R0', 'R1')")
    return CO.clr_group_test(T.cohort(spark, d).join(two, "sample", "left_semi"), two, "R0").select("taxid", *r6("effect", "p", "q"))


@query(
    """, two AS (SELECT sample, gene, count, grp FROM genes JOIN groups USING (sample) WHERE grp IN ('R0', 'R1')),
    logs AS (SELECT sample, gene, LN(count) AS l FROM two WHERE count > 0), means AS (SELECT gene, AVG(l) AS m FROM logs GROUP BY gene HAVING COUNT(*) = (SELECT COUNT(DISTINCT sample) FROM two)),
    factors AS (SELECT sample, EXP(MEDIAN(l - m)) AS factor FROM logs JOIN means USING (gene) GROUP BY sample),
    wide AS (SELECT s.sample, s.grp, g.gene, LOG2(COALESCE(c.count, 0) / factor + 1) AS v FROM (SELECT DISTINCT sample, grp FROM two) s CROSS JOIN (SELECT DISTINCT gene FROM two) g
      JOIN factors USING (sample) LEFT JOIN two c ON c.sample = s.sample AND c.gene = g.gene), """
    + welch_sql("wide", "v", "gene") + f", p AS (SELECT gene, difference, t, df, {student_sql('t', 'df')} AS p FROM welch), " + bh_sql("p", "gene")
    + " SELECT gene, ROUND(difference, 6) AS difference, ROUND(t, 6) AS t, ROUND(p, 6) AS p, ROUND(q, 6) AS q, q < 0.05 AND ABS(difference) >= 1 AS significant FROM p_q",
    core.GENES,
    T.GROUPS,
)
def sta19_gene_test(spark, d):
    two = T.groups(spark, d).where("group IN ('R0', 'R1')")
    rows = CO.gene_test(core.genes(spark, d).join(two, "sample", "left_semi"), two, "R0")
    return rows.select("gene", *r6("difference", "t", "p", "q"), "significant")


@query(
    """, kept AS (SELECT taxid FROM cohort GROUP BY taxid HAVING COUNT(*) FILTER (WHERE count > 0) / (SELECT COUNT(DISTINCT sample) FROM cohort) >= 0.5 AND SUM(count) >= 10 ORDER BY SUM(count) DESC, taxid LIMIT 200),
    real AS (SELECT sample, taxid, LN(count + 0.5) AS l FROM dense JOIN kept USING (taxid)),
    drawn AS (""" + draw_sql(f"(SELECT sample, taxid, l, rep, {key_sql('taxid')} AS t, {key_sql('sample')} AS s FROM real, (SELECT UNNEST(RANGE(100)) AS rep))", 1, ["rep", "t", "s"]) + """),
    every AS (SELECT -1 AS rep, taxid, ROW_NUMBER() OVER (PARTITION BY taxid ORDER BY sample) AS k, l FROM real UNION ALL SELECT rep, taxid, ROW_NUMBER() OVER (PARTITION BY rep, taxid ORDER BY draw, sample) AS k, l FROM drawn),
    pairs AS (SELECT x.rep, x.taxid AS a, y.taxid AS b, VAR_SAMP(x.l - y.l) AS v FROM every x JOIN every y ON x.rep = y.rep AND x.k = y.k AND x.taxid < y.taxid GROUP BY 1, 2, 3),
    t AS (SELECT rep, taxid, SUM(v) AS t, COUNT(*) AS k FROM (SELECT rep, a AS taxid, v FROM pairs UNION ALL SELECT rep, b, v FROM pairs) GROUP BY 1, 2),
    w AS (SELECT rep, taxid, GREATEST((t - SUM(t) OVER (PARTITION BY rep) / (2.0 * k)) / (k - 1), 1e-4) AS w FROM t),
    rho AS (SELECT p.rep, a, b, GREATEST(-1, LEAST(1, (x.w + y.w - v) / (2 * SQRT(x.w * y.w)))) AS rho FROM pairs p JOIN w x ON x.rep = p.rep AND x.taxid = a JOIN w y ON y.rep = p.rep AND y.taxid = b),
    p AS (SELECT o.a, o.b, o.rho, (1 + COUNT(*) FILTER (WHERE ABS(r.rho) >= ABS(o.rho) - 1e-9)) / 101.0 AS p FROM rho o JOIN rho r ON r.a = o.a AND r.b = o.b AND r.rep >= 0 WHERE o.rep = -1 GROUP BY 1, 2, 3), """
    + bh_sql("p", "a, b") + " SELECT a, b, ROUND(rho, 6) AS rho, ROUND(p, 6) AS p, ROUND(q, 6) AS q, q <= 0.05 AND ABS(rho) >= 0.3 AS edge FROM p_q",
    T.COHORT,
)
def cmp21_network(spark, d):
    return CO.network(T.cohort(spark, d)).select("a", "b", *r6("rho", "p", "q"), "edge")

"""The long tables of the model, derived from the given tables, in Spark and in SQL.

Samples are order priorities (five libraries) or nations (a cohort of 25), taxa are
suppliers, the tree is region, nation, supplier, cells are users of ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def with_fractions(cells: DataFrame) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy("sample"))
    return cells.select("sample", "taxid", F.concat(F.lit("Taxon "), "taxid").alias("name"), F.lit("S").alias("rank"), "count", (F.col("count") / total).alias("frac"))


def abundance(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("sample"))
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").cast("string").alias("taxid"), "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return with_fractions(rows.groupBy("sample", "taxid").agg(F.sum("l_quantity").alias("count")))


ABUNDANCE = """abundance AS (
  SELECT sample, taxid, 'Taxon ' || taxid AS name, 'S' AS rank, count, count / SUM(count) OVER (PARTITION BY sample) AS frac
  FROM (SELECT o_orderpriority AS sample, CAST(l_suppkey AS VARCHAR) AS taxid, SUM(l_quantity) AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2))"""


def cohort(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("sample"))
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "sample")
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").cast("string").alias("taxid"), "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return with_fractions(rows.groupBy("sample", "taxid").agg(F.sum("l_quantity").alias("count")))


COHORT = """cohort AS (
  SELECT sample, taxid, 'Taxon ' || taxid AS name, 'S' AS rank, count, count / SUM(count) OVER (PARTITION BY sample) AS frac
  FROM (SELECT n_name AS sample, CAST(l_suppkey AS VARCHAR) AS taxid, SUM(l_quantity) AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)),
dense AS (SELECT s.sample, t.taxid, COALESCE(c.count, 0) AS count FROM (SELECT DISTINCT sample FROM cohort) s CROSS JOIN (SELECT DISTINCT taxid FROM cohort) t
  LEFT JOIN cohort c ON c.sample = s.sample AND c.taxid = t.taxid)"""


def groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_name").alias("sample"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("group"))


GROUPS = """groups AS (SELECT n_name AS sample, 'R' || CAST(n_regionkey AS VARCHAR) AS grp FROM nation)"""


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    region = table(spark, d, "region").select(text("R", "r_regionkey").alias("taxid"), F.lit("1").alias("parent"), F.lit("P").alias("rank"), F.col("r_name").alias("name"))
    nation = table(spark, d, "nation").select(text("N", "n_nationkey").alias("taxid"), text("R", "n_regionkey").alias("parent"), F.lit("F").alias("rank"), F.col("n_name").alias("name"))
    supplier = table(spark, d, "supplier").select(text("", "s_suppkey").alias("taxid"), text("N", "s_nationkey").alias("parent"), F.lit("S").alias("rank"), F.col("s_name").alias("name"))
    # suppliers are numbered from 0; the root is node "root"
    root = region.limit(1).select(F.lit("root").alias("taxid"), F.lit(None).cast("string").alias("parent"), F.lit("R").alias("rank"), F.lit("root").alias("name"))
    return region.withColumn("parent", F.lit("root")).union(nation).union(supplier).union(root)


TAXONOMY = """taxonomy AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS taxid, 'root' AS parent, 'P' AS rank, r_name AS name FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), 'F', n_name FROM nation
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'N' || CAST(s_nationkey AS VARCHAR), 'S', s_name FROM supplier
  UNION ALL SELECT 'root', NULL, 'R', 'root'),
closure AS (
  SELECT t.taxid, t.taxid AS node, 0 AS up FROM taxonomy t
  UNION ALL SELECT t.taxid, p.taxid, 1 FROM taxonomy t JOIN taxonomy p ON t.parent = p.taxid
  UNION ALL SELECT t.taxid, q.taxid, 2 FROM taxonomy t JOIN taxonomy p ON t.parent = p.taxid JOIN taxonomy q ON p.parent = q.taxid
  UNION ALL SELECT t.taxid, r.taxid, 3 FROM taxonomy t JOIN taxonomy p ON t.parent = p.taxid JOIN taxonomy q ON p.parent = q.taxid JOIN taxonomy r ON q.parent = r.taxid)"""


def cells(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(F.col("value").cast("decimal(18,2)"))).cast("double").alias("host_umis"))
    return rows.select((F.col("user_id") % 5).cast("string").alias("sample"), F.col("user_id").cast("string").alias("barcode"), F.concat(F.lit("type"), (F.col("user_id") % 3).cast("string")).alias("cell_type"), "host_umis")


def cell_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").cast("double").alias("count"))
    return rows.select((F.col("user_id") % 5).cast("string").alias("sample"), F.col("user_id").cast("string").alias("barcode"), F.col("event_type").alias("taxid"), "count")


CELLS = """cells AS (
  SELECT CAST(user_id % 5 AS VARCHAR) AS sample, CAST(user_id AS VARCHAR) AS barcode, 'type' || CAST(user_id % 3 AS VARCHAR) AS cell_type,
         CAST(ROUND(SUM(CAST(value AS DECIMAL(18,2)))) AS DOUBLE) AS host_umis FROM events GROUP BY user_id),
cell_counts AS (SELECT CAST(user_id % 5 AS VARCHAR) AS sample, CAST(user_id AS VARCHAR) AS barcode, event_type AS taxid, CAST(COUNT(*) AS DOUBLE) AS count
  FROM events GROUP BY user_id, event_type)"""


def families(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select("source", F.explode(F.split("text", " ")).alias("word"))
    rows = words.where(F.col("word").rlike("^[a-z]{3}")).select("source", F.substring("word", 1, 3).alias("family"))
    return rows.groupBy(F.lit("all").alias("sample"), F.col("source").alias("taxon"), "family").agg(F.count("*").cast("double").alias("value"))


FAMILIES = """families AS (SELECT 'all' AS sample, source AS taxon, SUBSTR(word, 1, 3) AS family, CAST(COUNT(*) AS DOUBLE) AS value
  FROM (SELECT source, UNNEST(STRING_SPLIT(text, ' ')) AS word FROM documents) WHERE REGEXP_MATCHES(word, '^[a-z]{3}') GROUP BY 2, 3)"""

"""Queries of read, sequence, function-table and run-record operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxolith.functions import scalar as S
from taxolith.functions import windows as W
from taxolith.operators import abundance as A
from taxolith.operators import accounting as AC
from taxolith.operators import cells as C
from taxolith.operators import explore as X
from taxolith.operators import lineage as L
from taxolith.operators import merge as ME
from taxolith.operators import reads as R
from taxolith.queries import tables as T
from taxolith.queries.cohorts import draw_sql, key_sql
from taxolith.queries.core import query, r6

# Letters as bases, so that any text is a read.
LETTERS, TO_BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTTACGATTACAGTCATGACTATG"
K = 35

READS = f"""reads AS (SELECT *, f AS first_run, taxid || ':' || f || ' 0:' || z || CASE WHEN turn % 4 = 3 THEN ' 9606:' || m ELSE '' END || ' ' || taxid || ':' || (n - z - m - f) AS runs
  FROM (SELECT *, (n - z - m) // 2 AS f FROM (SELECT *, n * (turn + 1) // 12 AS z, CASE WHEN turn % 4 = 3 THEN n // 7 ELSE 0 END AS m FROM (SELECT *, GREATEST(LENGTH(seq) - {K - 1}, 0) AS n FROM (
    SELECT turn, 'S' || (conv_id % 3) AS sample, conv_id || '-' || turn AS read_id, CASE WHEN conv_id % 11 > 0 THEN 'B' || (conv_id % 7) END AS barcode, 'U' || turn AS umi, CASE WHEN turn % 5 = 4 THEN 'U' ELSE 'C' END AS status,
      CAST(conv_id % 9 + 1 AS VARCHAR) AS taxid, 1 + turn % 2 AS mate, conv_id * 10 + turn AS pos, REGEXP_REPLACE(TRANSLATE(LOWER(text), '{LETTERS}', '{TO_BASES}'), '[^ACGT]', '', 'g') AS seq FROM conversations)))))"""


def text(*parts):
    return F.concat(*[p.cast("string") if hasattr(p, "cast") else F.lit(p) for p in parts])


def reads(spark, d):
    """Turns of conversations as reads, with runs of k-mers on their taxon, on none and on the host."""
    conv, turn = F.col("conv_id"), F.col("turn")
    seq = F.regexp_replace(F.translate(F.lower("text"), LETTERS, TO_BASES), "[^ACGT]", "")
    rows = T.table(spark, d, "conversations").select(
        "turn", text("S", conv % 3).alias("sample"), text(conv, "-", turn).alias("read_id"), F.when(conv % 11 > 0, text("B", conv % 7)).alias("barcode"), text("U", turn).alias("umi"),
        F.when(turn % 5 == 4, "U").otherwise("C").alias("status"), (conv % 9 + 1).cast("string").alias("taxid"), (1 + turn % 2).alias("mate"), (conv * 10 + turn).alias("pos"), seq.alias("seq"),
    )
    n = F.greatest(F.length("seq") - (K - 1), F.lit(0)).cast("long")
    rows = rows.withColumn("n", n).withColumn("z", F.expr("n * (turn + 1) div 12")).withColumn("m", F.expr("if(turn % 4 = 3, n div 7, 0)")).withColumn("f", F.expr("(n - z - m) div 2"))
    host = F.when(F.col("turn") % 4 == 3, text(" 9606:", F.col("m"))).otherwise("")
    return rows.withColumn("runs", F.concat(text(F.col("taxid"), ":", F.col("f"), " 0:", F.col("z")), host, text(" ", F.col("taxid"), ":", F.col("n") - F.col("z") - F.col("m") - F.col("f"))))


@query(
    f""", own AS (SELECT taxid, barcode, SUBSTR(seq, i + 1, {K}) AS kmer FROM (SELECT *, UNNEST(RANGE(n)) AS i FROM reads) WHERE i < f OR i >= f + z + m)
    SELECT taxid, barcode, COUNT(*) AS total, COUNT(DISTINCT kmer) AS "distinct", FALSE AS capped FROM own GROUP BY 1, 2""",
    READS,
)
def agg6_kmer_evidence(spark, d):
    return C.kmer_evidence(reads(spark, d), K)


@query(
    """SELECT read_id, CASE WHEN barcode IS NULL THEN 'no_barcode' WHEN status <> 'C' THEN 'unclassified' WHEN REGEXP_MATCHES(seq, 'A{7,}|C{7,}|G{7,}|T{7,}') THEN 'low_complexity' WHEN turn % 4 = 3 THEN 'host_kmer'
       WHEN n = 0 OR (n - z - m) / n < 0.8 THEN 'below_fraction' END AS reason FROM reads""",
    READS,
)
def flt8_read_reasons(spark, d):
    rows = reads(spark, d)
    lineage = rows.select("taxid").distinct().withColumn("ancestors", F.array(F.lit("131567")))
    return C.read_reasons(rows, lineage, host="9606", min_fraction=0.8, homopolymer=7).select("read_id", "reason")


@query(
    f""", letters AS (SELECT read_id, seq, rep, place, {key_sql("read_id || '#' || mate")} AS key FROM (SELECT *, UNNEST(RANGE(LENGTH(seq))) AS place FROM reads), (SELECT UNNEST(RANGE(1, 21)) AS rep)),
    drawn AS ({draw_sql("letters", 1, ["key", "rep", "place"])}),
    moved AS (SELECT read_id, STRING_AGG(SUBSTR(seq, CAST(place AS BIGINT) + 1, 1), '' ORDER BY draw, place) AS s FROM drawn GROUP BY read_id, rep),
    every AS (SELECT sample, seq AS s, TRUE AS own FROM reads UNION ALL SELECT sample, s, FALSE FROM moved JOIN reads USING (read_id)),
    kinds(tract, pattern) AS (VALUES ('mixed', '[AT]' || '{{n}}'), ('homopolymer', 'A{{n}}|T{{n}}')), lengths(n) AS (VALUES (6), (8), (10), (12)),
    hits AS (SELECT sample, tract, n, own, REGEXP_MATCHES(s, REPLACE(pattern, 'n', CAST(n AS VARCHAR))) AS hit FROM every, kinds, lengths),
    c AS (SELECT sample, tract, CAST(n AS INTEGER) AS length, COUNT(*) FILTER (WHERE own) AS reads, COUNT(*) FILTER (WHERE own AND hit) AS observed, COUNT(*) FILTER (WHERE NOT own AND hit) AS shuffled FROM hits GROUP BY 1, 2, 3)
    SELECT *, ROUND((shuffled + 0.5) / 20.5, 6) AS expected, ROUND((observed + 0.5) / ((shuffled + 0.5) / 20.5 + 0.5), 6) AS ratio FROM c""",
    READS,
)
def cmp22_polya(spark, d):
    return R.polya(reads(spark, d)).select("sample", "tract", "length", "reads", "observed", "shuffled", *r6("expected", "ratio"))


@query(
    """, wanted(taxid) AS (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))), hit AS (SELECT DISTINCT sample, read_id FROM reads WHERE taxid IN (SELECT taxid FROM wanted))
    SELECT read_id, seq FROM reads WHERE (sample, read_id) IN (SELECT (sample, read_id) FROM hit)""",
    READS,
)
def cmp25_extract_reads(spark, d):
    """Reads of two regions and of all suppliers below them; mate suffixes do not count."""
    rows = reads(spark, d)
    given = rows.select("sample", text(F.col("read_id"), "/", F.col("mate")).alias("read_id"), "taxid")
    return R.extract_reads(rows, given, L.closure(T.taxonomy(spark, d)), ["R1", "R2"]).select("read_id", "seq")


@query(
    f"""SELECT id, seq AS sequence, CAST(LENGTH(seq) AS INTEGER) AS length FROM (SELECT p_partkey AS id, REGEXP_REPLACE(TRANSLATE(LOWER(p_name || p_type), '{LETTERS}', '{TO_BASES}'), '[^ACGT]', '', 'g') AS seq FROM part)
    WHERE LENGTH(seq) % 3 = 0 AND LENGTH(seq) BETWEEN 12 AND 4500 AND NOT REGEXP_MATCHES(seq, '^([ACGT]{{3}})*?(TAA|TAG|TGA)[ACGT]{{3}}')"""
)
def cmp29_cds_genes(spark, d):
    """Names of parts as coding sequences; they are short, so the least length is 12."""
    seq = F.regexp_replace(F.translate(F.lower(F.concat("p_name", "p_type")), LETTERS, TO_BASES), "[^ACGT]", "")
    return R.cds_genes(T.table(spark, d, "part").select(F.col("p_partkey").alias("id"), seq.alias("seq")), least=12).select("id", F.col("seq").alias("sequence"), "length")


@query("SELECT sample, read_id, mate FROM reads WHERE pos < 500", READS)
def top8_first_reads(spark, d):
    return R.first_reads(reads(spark, d), 500).select("sample", "read_id", "mate")


@query("SELECT sample, read_id, seq, TRUE AS single_end FROM reads WHERE mate = 2", READS)
def flt19_read2_only(spark, d):
    return AC.read2_only(reads(spark, d)).select("sample", "read_id", "seq", "single_end")


@query("SELECT read_id || '|CB:' || COALESCE(barcode, 'NA') || '|UB:' || umi AS read_id, seq FROM reads", READS)
def prj11_tag_reads(spark, d):
    return AC.tag_reads(reads(spark, d)).select("read_id", "seq")


@query("SELECT 'g7__' || read_id || '|kraken:taxid|562' AS name, seq, '562' AS taxid FROM reads", READS)
def prj10_tag_sequences(spark, d):
    return R.tag_sequences(reads(spark, d).select(text(F.col("read_id"), " described").alias("name"), "seq"), "g7", 562)


MASKED = """hosts AS (SELECT c_custkey AS name, UPPER(c_mktsegment || c_name || c_mktsegment) AS seq, LENGTH(c_mktsegment) AS n FROM customer)"""


@query(
    "SELECT CAST(name AS VARCHAR) AS name, CAST(LENGTH(seq) AS INTEGER) AS length, 2 AS regions, 2 * n AS masked, ROUND(2 * n / LENGTH(seq), 6) AS masked_share FROM hosts",
    MASKED,
)
def agg22_mask_summary(spark, d):
    """Market segments are masked where they stand at both ends of a name."""
    rows = T.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.upper(F.concat("c_mktsegment", "c_name", "c_mktsegment")).alias("seq"))
    segments = T.table(spark, d, "customer").select(F.col("c_mktsegment").alias("name"), F.upper("c_mktsegment").alias("seq")).distinct()
    return R.mask_summary(rows, R.mask_regions(rows, segments, 8)).select("name", "length", "regions", "masked", *r6("masked_share"))


@query("SELECT DISTINCT 'chr' || (l_suppkey % 5) AS chrom, CAST(l_partkey % 100 AS BIGINT) AS start, CAST(l_partkey % 100 + 50 AS BIGINT) AS \"end\", CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand FROM lineitem WHERE l_linenumber % 3 > 0")
def set7_distinct_sites(spark, d):
    """A third of the sites have no proper strand or start."""
    line, start = F.col("l_linenumber"), F.col("l_partkey") % 100
    strand = F.when((line % 3 == 0) & (line % 2 == 0), "?").when(line % 2 == 0, "+").otherwise("-")
    rows = T.table(spark, d, "lineitem").select(text("chr", F.col("l_suppkey") % 5).alias("chrom"), F.when((line % 3 == 0) & (line % 2 == 1), "x").otherwise(start.cast("string")).alias("start"), (start + 50).cast("string").alias("end"), strand.alias("strand"))
    return R.distinct_sites(rows)


# runs and libraries ---------------------------------------------------------------------

RUNS = """runs AS (SELECT o_orderkey AS pos, 'SRR' || o_custkey AS run, CASE WHEN o_orderkey % 3 > 0 THEN 'SRX' || (o_custkey // 2) END AS experiment, CASE WHEN o_orderkey % 5 > 0 THEN ' S' || (o_custkey // 4) || ' ' ELSE '' END AS sample, o_orderpriority || '   ' || o_orderstatus AS title FROM orders)"""


def runs(spark, d):
    cust, key = F.col("o_custkey"), F.col("o_orderkey")
    return T.table(spark, d, "orders").select(
        key.alias("pos"), text("SRR", cust).alias("run"), F.when(key % 3 > 0, text("SRX", F.floor(cust / 2))).alias("experiment"), F.when(key % 5 > 0, text(" S", F.floor(cust / 4), " ")).otherwise("").alias("sample"),
        F.concat("o_orderpriority", F.lit("   "), "o_orderstatus").alias("title"),
    )


@query("SELECT pos, run, COALESCE(experiment, run) AS experiment, COALESCE(NULLIF(TRIM(sample), ''), run) AS sample, REPLACE(title, '   ', ' ') AS title FROM runs QUALIFY ROW_NUMBER() OVER (PARTITION BY run ORDER BY pos) = 1", RUNS)
def prj5_clean_runs(spark, d):
    return AC.clean_runs(runs(spark, d))


@query("SELECT o_orderkey AS run, CASE WHEN o_orderstatus = 'F' THEN 'pacbio_smrt' WHEN o_orderstatus = 'P' THEN 'OXFORD_NANOPORE' ELSE 'ILLUMINA' END AS platform FROM orders WHERE o_orderstatus IN ('F', 'P')")
def flt17_audit_runs(spark, d):
    platform = F.when(F.col("o_orderstatus") == "F", "pacbio_smrt").when(F.col("o_orderstatus") == "P", "OXFORD_NANOPORE").otherwise("ILLUMINA")
    return AC.audit_runs(T.table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), platform.alias("platform")), "short")


@query("SELECT o_orderkey AS sample, AVG(l_quantity) AS mean_length FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING AVG(l_quantity) <= 20")
def flt18_short_samples(spark, d):
    return AC.short_samples(T.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("sample")).agg(F.avg("l_quantity").alias("mean_length")), 20)


@query("SELECT n_name AS sample, CASE n_regionkey WHEN 1 THEN 'R1' ELSE 'R2' END AS \"group\" FROM nation WHERE n_regionkey IN (1, 2) AND n_name <> 'NATION_6'")
def flt15_contrast(spark, d):
    return AC.contrast(T.groups(spark, d), "group", "R1", "R2", without=["NATION_6"])


@query("SELECT sample, COUNT(DISTINCT path) AS files, LIST_SORT(LIST(DISTINCT path)) AS paths FROM (SELECT o_custkey AS sample, o_orderpriority AS path FROM orders) GROUP BY 1 HAVING COUNT(DISTINCT path) > 1")
def flt16_require_one_file(spark, d):
    return AC.require_one_file(T.table(spark, d, "orders").select(F.col("o_custkey").alias("sample"), F.col("o_orderpriority").alias("path")))


@query("SELECT sample, BOOL_OR(count > 0 AND taxid <> '0') AS classified, BOOL_OR(count >= 120) AS deep_enough FROM cohort GROUP BY sample", T.COHORT)
def flt14_usable_samples(spark, d):
    return A.usable_samples(T.cohort(spark, d), "S", 120)


@query("SELECT p_type, p_brand, CASE WHEN p_type LIKE '%RNA%' THEN 'rna' WHEN p_type = 'WGS' THEN 'dna' WHEN p_brand LIKE '%TRANSCRIPTOMIC%' THEN 'rna' WHEN p_brand LIKE '%GENOMIC%' THEN 'dna' END AS molecule FROM "
       "(SELECT CASE WHEN p_partkey % 4 = 0 THEN 'MIRNA-SEQ' WHEN p_partkey % 4 = 1 THEN 'WGS' ELSE UPPER(p_type) END AS p_type, CASE WHEN p_partkey % 3 = 0 THEN 'METATRANSCRIPTOMIC' WHEN p_partkey % 3 = 1 THEN 'GENOMIC' ELSE UPPER(p_brand) END AS p_brand FROM part)")  # fmt: skip
def prj6_library_molecule(spark, d):
    key = F.col("p_partkey")
    kind = F.when(key % 4 == 0, "miRNA-Seq").when(key % 4 == 1, "wgs").otherwise(F.col("p_type"))
    source = F.when(key % 3 == 0, "metatranscriptomic").when(key % 3 == 1, "genomic").otherwise(F.col("p_brand"))
    return T.table(spark, d, "part").select(F.upper(kind).alias("p_type"), F.upper(source).alias("p_brand"), S.library_molecule(kind, source).alias("molecule"))


@query("SELECT 'S.' || o_custkey || '.x' AS sample, 'p' || o_orderkey AS label FROM orders")
def sca19_pass_of(spark, d):
    path = text("/data/S.", F.col("o_custkey"), ".x.p", F.col("o_orderkey"), ".hisat2.summary.log")
    return T.table(spark, d, "orders").select(S.pass_of(path).alias("p")).select("p.*")


# views and function tables --------------------------------------------------------------

FUNCTIONS = """functions AS (SELECT 'M' || (l_suppkey % 4) AS sample, 'F' || (l_partkey % 50) || CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 3 = 1 THEN '|g__Genus' || (l_suppkey % 7) || '.s__Genus' || (l_suppkey % 7) || '_kind' ELSE '|g__Genus' || (l_suppkey % 7) END AS feature, SUM(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"""


def functions(spark, d):
    line, kind = F.col("l_linenumber") % 3, text("|g__Genus", F.col("l_suppkey") % 7)
    stratum = F.when(line == 0, "").when(line == 1, F.concat(kind, text(".s__Genus", F.col("l_suppkey") % 7, "_kind"))).otherwise(kind)
    feature = F.concat(text("F", F.col("l_partkey") % 50), stratum)
    return T.table(spark, d, "lineitem").groupBy(text("M", F.col("l_suppkey") % 4).alias("sample"), feature.alias("feature")).agg(F.sum("l_quantity").alias("value"))


@query("SELECT sample, COUNT(DISTINCT feature) FILTER (WHERE NOT CONTAINS(feature, '|')) AS community, COUNT(DISTINCT feature) FILTER (WHERE CONTAINS(feature, '|')) AS stratified FROM functions GROUP BY sample", FUNCTIONS)
def agg17_humann_summary(spark, d):
    return X.humann_summary(functions(spark, d))


@query(
    """, map(family, grp) AS (SELECT 'F' || f, 'G' || (f % 5) FROM (SELECT UNNEST(RANGE(40)) AS f) UNION ALL SELECT 'F' || f, 'H' || (f % 3) FROM (SELECT UNNEST(RANGE(20)) AS f))
    SELECT sample, COALESCE(grp, 'UNGROUPED') AS "group", CASE WHEN CONTAINS(feature, '|') THEN SPLIT_PART(feature, '|', 2) END AS stratum, SUM(value) AS value FROM functions LEFT JOIN map ON family = SPLIT_PART(feature, '|', 1) GROUP BY 1, 2, 3""",
    FUNCTIONS,
)
def agg20_regroup(spark, d):
    first = spark.range(40).select(text("F", F.col("id")).alias("feature"), text("G", F.col("id") % 5).alias("group"))
    return X.regroup(functions(spark, d), first.union(spark.range(20).select(text("F", F.col("id")), text("H", F.col("id") % 3))))


@query("SELECT sample, feature, ROUND(1e6 * value / SUM(value) FILTER (WHERE NOT CONTAINS(feature, '|')) OVER (PARTITION BY sample), 6) AS value FROM functions", FUNCTIONS)
def agg20_renorm(spark, d):
    return X.renorm(functions(spark, d)).select("sample", "feature", *r6("value"))


@query(
    """, parts AS (SELECT feature, SPLIT_PART(feature, '|', 1) AS family, CASE WHEN CONTAINS(feature, 's__') THEN REPLACE(REGEXP_EXTRACT(feature, 's__(.*)$', 1), '_', ' ') ELSE REGEXP_EXTRACT(feature, 'g__(.*)$', 1) END AS taxon, SUM(value) AS value FROM functions WHERE CONTAINS(feature, '|') GROUP BY ALL),
    found AS (SELECT * FROM parts WHERE CONTAINS(LOWER(taxon), 'genus3') OR CONTAINS(LOWER(taxon), 'genus5 kind'))
    SELECT feature, family, taxon, value, COUNT(*) OVER () AS total_rows, COUNT(*) OVER () > 30 AS capped FROM found ORDER BY value DESC, feature LIMIT 30""",
    FUNCTIONS,
)
def cmp33_stratified_search(spark, d):
    return X.stratified_search(functions(spark, d), ["Genus3", "genus5_kind"], 30).select("feature", "family", "taxon", "value", "total_rows", "capped")


@query(
    """, asked(query, name) AS (SELECT q, name FROM (VALUES ('Taxon 1'), ('taxon 12'), ('Taxon')) AS a(q), (SELECT DISTINCT name FROM cohort) WHERE name = 'Taxon ' || SPLIT_PART(q, ' ', 2) OR q = 'Taxon'),
    per AS (SELECT sample, name, 100 * count / SUM(count) OVER (PARTITION BY sample) AS v FROM cohort)
    SELECT query, sample, ROUND(SUM(v), 6) AS value, COUNT(DISTINCT name) AS taxa FROM per JOIN asked USING (name) WHERE query <> 'taxon 12' OR EXISTS (SELECT 1 FROM cohort WHERE name = 'Taxon 12') GROUP BY 1, 2""",
    T.COHORT,
)
def cmp36_organism_view(spark, d):
    asked = spark.createDataFrame([("Taxon 1",), ("taxon 12",), ("Taxon",)], "query string")
    known = T.cohort(spark, d).select("name").distinct().where("name = 'Taxon 12'").select(F.lit("taxon 12").alias("query"))
    # a name that the table lacks would be met by its genus
    return X.organism_view(T.cohort(spark, d), asked.where("query != 'taxon 12'").union(known), measure="percent").select("query", "sample", *r6("value"), "taxa")


@query("SELECT sample, taxid, count FROM cohort WHERE name <> 'Taxon 7'", T.COHORT)
def flt7_discard(spark, d):
    return X.discard(T.cohort(spark, d), spark.createDataFrame([("taxon_7",)], "query string").join(T.cohort(spark, d).where("name = 'Taxon 7'").limit(1).select("taxid"), how="cross").select("query")).select("sample", "taxid", "count")


@query("SELECT CASE WHEN n_regionkey = 2 THEN 'moved ' || sample ELSE sample END AS sample, taxid, count FROM cohort JOIN nation ON n_name = sample", T.COHORT)
def prj9_rename_samples(spark, d):
    renames = T.table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_name").alias("old"), text("moved ", F.col("n_name")).alias("new"))
    return X.rename_samples(T.cohort(spark, d), renames).select("sample", "taxid", "count")


@query("SELECT sample, taxid, count, grp AS \"group\" FROM cohort LEFT JOIN (SELECT * FROM groups WHERE grp <> 'R4') USING (sample)", T.COHORT, T.GROUPS)
def joi15_attach_metadata(spark, d):
    return X.attach_metadata(T.cohort(spark, d).select("sample", "taxid", "count"), T.groups(spark, d).where("group <> 'R4'"))


@query("SELECT p_name AS feature, REPLACE(p_name, '_', ' ') AS label, p_type AS description FROM (SELECT DISTINCT REPLACE(p_name, ' ', '_') AS p_name FROM part) LEFT JOIN (SELECT REPLACE(p_name, ' ', '_') AS p_name, MIN(p_type) AS p_type FROM part WHERE p_partkey % 2 = 0 GROUP BY 1) USING (p_name)")
def prj8_enrich_features(spark, d):
    part = T.table(spark, d, "part").select(F.translate("p_name", " ", "_").alias("feature"), "p_type", "p_partkey")
    told = part.where("p_partkey % 2 = 0").groupBy("feature").agg(F.min("p_type").alias("description"))
    return X.enrich_features(part.select("feature").distinct(), told)


# merges ---------------------------------------------------------------------------------


@query("SELECT sample, taxid, SUM(count) AS count FROM cohort WHERE taxid NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) GROUP BY 1, 2", T.COHORT)
def cmp23_standardise(spark, d):
    debt = T.table(spark, d, "supplier").where("s_acctbal < 0").select(text(F.col("s_suppkey")).alias("taxid"))
    return ME.standardise(T.cohort(spark, d), debt)


@query("SELECT taxid, 'S' AS rank, 'Taxon ' || taxid AS name, SUM(count) AS tot_all, SUM(CAST(count AS BIGINT) % 7) AS tot_lvl, COUNT(DISTINCT sample) AS samples FROM cohort GROUP BY taxid", T.COHORT)
def cmp23_combine_reports(spark, d):
    rows = T.cohort(spark, d).select("sample", "taxid", "rank", "name", F.col("count").alias("clade_reads"), (F.col("count").cast("long") % 7).alias("direct_reads"))
    return ME.combine_reports(rows)


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS balance, NULL AS nation FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_acctbal, CAST(s_nationkey AS INTEGER) FROM supplier")
def set5_stack(spark, d):
    customers = T.table(spark, d, "customer").select(text(F.col("c_custkey")).alias("id"), F.col("c_acctbal").alias("balance"))
    return ME.stack([customers, T.table(spark, d, "supplier").select(text(F.col("s_suppkey")).alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("int").alias("nation"))])


@query("SELECT sample, taxid, count, 'S' AS rank, barcode, name FROM (SELECT grp AS sample, sample AS barcode, taxid, name, count FROM cohort JOIN groups USING (sample) WHERE grp <> 'R4' AND count >= 60)", T.COHORT, T.GROUPS)
def cmp12_plate_matrix(spark, d):
    """Nations are cells, regions their samples; those of a region that is not listed are left out."""
    cells = T.groups(spark, d).where("group <> 'R4'").select(F.col("sample").alias("cell"), F.col("group").alias("sample"))
    return C.plate_matrix(T.cohort(spark, d).withColumnRenamed("sample", "cell"), cells, min_reads=60)


@query("SELECT verdict, COUNT(*) AS taxa, SUM(reads) AS reads FROM (SELECT taxid, SUM(count) AS reads, CASE WHEN COUNT(*) >= 20 THEN 'common' ELSE 'rare' END AS verdict FROM cohort GROUP BY 1) GROUP BY 1", T.COHORT)
def agg19_summary_table(spark, d):
    rows = T.cohort(spark, d).groupBy("taxid").agg(F.sum("count").alias("reads"), F.when(F.count("*") >= 20, "common").otherwise("rare").alias("verdict"))
    return ME.summary_table(rows, value="reads")


@query("SELECT gene, AVG(length) AS length FROM (SELECT l_partkey AS gene, l_quantity AS length FROM lineitem) GROUP BY 1")
def agg15_gene_lengths(spark, d):
    return ME.gene_lengths(T.table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.col("l_quantity").alias("length")))


@query("SELECT taxid, count, total_rows, total_rows > 40 AS capped FROM (SELECT taxid, SUM(count) AS count, COUNT(*) OVER () AS total_rows FROM cohort GROUP BY taxid ORDER BY SUM(count) DESC, taxid LIMIT 40)", T.COHORT)
def top4_capped(spark, d):
    return A.capped(T.cohort(spark, d).groupBy("taxid").agg(F.sum("count").alias("count")), F.col("count"), 40, ["taxid"]).drop("measure")


# lineage ----------------------------------------------------------------------------------


@query("SELECT COALESCE('S' || (l_suppkey % 7), CAST(l_suppkey AS VARCHAR)) AS taxid, COUNT(*) AS n FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY 1 UNION ALL SELECT CAST(l_suppkey AS VARCHAR), COUNT(*) FROM lineitem WHERE l_suppkey % 3 > 0 GROUP BY 1")
def joi12_resolve_merged(spark, d):
    """A third of the suppliers have been merged into seven others."""
    own = T.table(spark, d, "lineitem").select(text(F.col("l_suppkey")).alias("taxid"))
    merged = T.table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(text(F.col("s_suppkey")).alias("old"), text("S", F.col("s_suppkey") % 7).alias("new"))
    return L.resolve_merged(own, merged).groupBy("taxid").agg(F.count("*").alias("n"))


@query(
    """SELECT s_suppkey AS id, r_name AS phylum, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE r_name END AS family, CASE WHEN s_suppkey % 5 > 0 THEN s_name WHEN n_nationkey % 2 = 0 THEN n_name ELSE r_name END AS species
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def win8_forward_fill(spark, d):
    """Every other family and a fifth of the species have no name."""
    rows = T.table(spark, d, "supplier").join(T.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(T.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = rows.select(F.col("s_suppkey").alias("id"), F.col("r_name").alias("phylum"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("family"), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_name")).alias("species"))
    return named.select("id", *W.forward_fill(["phylum", "family", "species"]))

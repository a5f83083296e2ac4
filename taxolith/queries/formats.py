"""Queries of sources, sinks and streams: the given tables written in a format and read back.

Files go to the session's shared folder. Sample names that a reader takes from file names
are left out of the results, since Spark names the files that it writes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxolith.plans.materialise import cut, shared_folder
from taxolith.queries import tables as T
from taxolith.queries.core import query
from taxolith.sources import reports as R
from taxolith.sources import sequences as Q
from taxolith.sources import sinks as K
from taxolith.sources import tables as S
from taxolith.streaming import groups as G


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/format-{uuid.uuid4().hex}"


def text(c: str) -> Column:
    return F.col(c).cast("string")


def joined(*parts: Column | str) -> Column:
    """Fields between tabs."""
    return F.concat_ws("\t", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def as_lines(spark: SparkSession, rows: DataFrame, by: str | None = None, order: str | None = None) -> str:
    """Write the column ``value`` as text; given ``by``, a file for each of its values, in ``order``."""
    path = folder(spark)
    if by is None:
        rows.select("value").write.text(path)
    else:
        dealt = rows.repartition(by)
        dealt = dealt.sortWithinPartitions(by, order) if order else dealt
        dealt.select("value", by).write.partitionBy(by).text(path)
    return path


def as_table(spark: SparkSession, rows: DataFrame, **options) -> str:
    path = folder(spark)
    rows.write.options(**({"sep": "\t", "header": True, "quote": "", "nullValue": "NA"} | options)).csv(path)
    return path


def tree(spark: SparkSession, d: str) -> DataFrame:
    """A report for each region: ``region, k`` (pre-order), ``depth, taxid, name, rank, direct, clade``; a supplier counts its number plus one."""
    nation = T.table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    leaf = T.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", (F.col("s_suppkey") + 1).cast("long").alias("n")).join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    region = T.table(spark, d, "region").select("r_regionkey", "r_name")
    per_nation = nation.join(leaf.groupBy("s_nationkey").agg(F.sum("n").alias("n")), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    per_region = region.join(leaf.groupBy("n_regionkey").agg(F.sum("n").alias("n")), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    row = lambda region, a, b, depth, taxid, name, rank, direct: [
        region.alias("region"), F.format_string("%05d-%09d", a, b).alias("k"), F.lit(depth).alias("depth"), taxid.alias("taxid"), name.alias("name"), F.lit(rank).alias("rank"),
        direct.cast("long").alias("direct"), F.coalesce("n", F.lit(0)).cast("long").alias("clade"),
    ]
    none = F.lit(0)
    return (
        per_region.select(*row(F.col("r_regionkey"), none, none, 0, F.concat(F.lit("9"), text("r_regionkey")), F.col("r_name"), "phylum", none))
        .union(per_nation.select(*row(F.col("n_regionkey"), F.col("n_nationkey") + 1, none, 1, F.concat(F.lit("8"), text("n_nationkey")), F.col("n_name"), "family", none)))
        .union(leaf.select(*row(F.col("n_regionkey"), F.col("n_nationkey") + 1, F.col("s_suppkey") + 1, 2, F.concat(F.lit("7"), text("s_suppkey")), F.col("s_name"), "species", F.col("n"))))
    )


TREE = """leaf AS (SELECT *, s_suppkey + 1 AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey),
tree AS (SELECT 0 AS depth, '9' || r_regionkey AS taxid, r_name AS name, 'P' AS rank, 0 AS direct, COALESCE((SELECT SUM(n) FROM leaf WHERE n_regionkey = r_regionkey), 0) AS clade FROM region
  UNION ALL SELECT 1, '8' || n_nationkey, n_name, 'F', 0, COALESCE((SELECT SUM(n) FROM leaf WHERE s_nationkey = nation.n_nationkey), 0) FROM nation
  UNION ALL SELECT 2, '7' || s_suppkey, s_name, 'S', n, n FROM leaf)"""


def code() -> Column:
    return F.substring(F.upper("rank"), 1, 1)


def indented() -> Column:
    return F.concat(F.expr("repeat('  ', depth)"), F.col("name"))


def kraken(spark: SparkSession, d: str) -> str:
    return as_lines(spark, tree(spark, d).withColumn("value", joined("0.00", F.col("clade"), F.col("direct"), code(), F.col("taxid"), indented())), "region", "k")


def krakenuniq(spark: SparkSession, d: str) -> str:
    rows = tree(spark, d).withColumn("value", joined("0.5", F.col("clade"), F.col("direct"), F.col("clade") * 3, "1.5", "0.25", F.col("taxid"), F.col("rank"), indented()))
    return as_lines(spark, rows, "region", "k")


@query("SELECT depth, taxid, name, rank, CAST(direct AS DOUBLE) AS direct_reads, CAST(clade AS DOUBLE) AS clade_reads FROM tree", TREE)
def src1_kraken_report(spark, d):
    return R.read_kraken_report(spark, kraken(spark, d)).select("depth", "taxid", "name", "rank", "direct_reads", "clade_reads")


@query("SELECT depth, taxid, name, rank, CAST(direct AS DOUBLE) AS direct_reads, CAST(clade * 3 AS DOUBLE) AS distinct_kmers, 1.5::DOUBLE AS duplication, 0.25::DOUBLE AS coverage FROM tree", TREE)
def src2_krakenuniq_report(spark, d):
    return R.read_krakenuniq_report(spark, krakenuniq(spark, d)).select("depth", "taxid", "name", "rank", "direct_reads", F.col("distinct").alias("distinct_kmers"), "duplication", "coverage")


@query("SELECT format, COUNT(*) AS files FROM region, (VALUES ('kraken2'), ('krakenuniq')) AS f(format) GROUP BY 1")
def src3_detect_format(spark, d):
    both = R.numbered_lines(spark, [f"{kraken(spark, d)}/*", f"{krakenuniq(spark, d)}/*"])
    return R.detect_format(both).groupBy("format").agg(F.count("*").alias("files"))


@query("SELECT taxid, name, rank, CAST(clade AS DOUBLE) AS count, 'kraken2' AS format FROM tree UNION ALL SELECT taxid, name, rank, clade, 'krakenuniq' FROM tree", TREE)
def cmp35_load_reports(spark, d):
    return R.load_reports(spark, [f"{kraken(spark, d)}/*", f"{krakenuniq(spark, d)}/*"]).select("taxid", "name", "rank", "count", "format")


@query("SELECT sample, taxid, name, rank, CAST(count AS DOUBLE) AS count, ROUND(frac, 6) AS frac FROM abundance", T.ABUNDANCE)
def src4_combined(spark, d):
    wide = T.abundance(spark, d).groupBy("name", F.col("taxid").alias("taxonomy_id"), F.col("rank").alias("taxonomy_lvl")).pivot("sample").agg(F.sum("count").alias("num"), F.sum("frac").alias("frac"))
    return R.combined_abundance(R.read_combined(spark, as_table(spark, wide.na.fill(0)))).where("count > 0").withColumn("frac", F.round("frac", 6))


@query("SELECT taxid, name, rank, CAST(count AS DOUBLE) AS count, ROUND(frac, 6) AS frac FROM abundance", T.ABUNDANCE)
def src5_bracken(spark, d):
    rows = T.abundance(spark, d).select("name", F.col("taxid").alias("taxonomy_id"), F.col("rank").alias("taxonomy_lvl"), F.col("count").alias("new_est_reads"), F.col("frac").alias("fraction_total_reads"))
    return R.read_bracken(spark, as_table(spark, rows)).select("taxid", "name", "rank", "count", F.round("frac", 6).alias("frac"))


@query("SELECT 'p__x|s__' || s_name AS clade, REPLACE(s_name, '_', ' ') AS name, 'S' AS rank, CAST(s_suppkey AS VARCHAR) AS taxid, s_acctbal AS percent FROM supplier")
def src6_metaphlan(spark, d):
    rows = T.table(spark, d, "supplier").select(F.concat(F.lit("p__x|s__"), "s_name").alias("clade_name"), F.concat(F.lit("1|"), text("s_suppkey")).alias("NCBI_tax_id"), F.col("s_acctbal").alias("relative_abundance"))
    return R.read_metaphlan(spark, as_table(spark, rows)).drop("sample")


@query("SELECT family AS feature, taxon AS sample, value FROM families", T.FAMILIES)
def src7_humann(spark, d):
    wide = T.families(spark, d).withColumn("taxon", F.concat("taxon", F.lit("_Abundance-RPKs"))).groupBy(F.col("family").alias("# Gene Family")).pivot("taxon").agg(F.sum("value"))
    return S.read_humann(spark, as_table(spark, wide.na.fill(0))).where("value > 0")


@query("SELECT 'C' AS status, CAST(user_id % 7 AS VARCHAR) AS taxid, 'U' || CAST(user_id AS VARCHAR) AS barcode, COUNT(*) AS n FROM events GROUP BY ALL")
def src8_assignments(spark, d):
    rows = T.table(spark, d, "events").select(joined("C", F.concat(F.lit("r|CB:U"), text("user_id"), F.lit("|UB:x")), F.concat(F.lit("name (taxid "), F.col("user_id") % 7, F.lit(")")), "100", "562:3").alias("value"))
    return R.read_assignments(spark, as_lines(spark, rows)).groupBy("status", "taxid", "barcode").agg(F.count("*").alias("n"))


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as reads of two mates."""
    rows = T.table(spark, d, "conversations")
    seq = F.translate("text", "\n\r\t ", "NNNN")
    return rows.select(F.lit("all").alias("sample"), (F.col("turn") % 2 + 1).cast("int").alias("mate"), F.xxhash64("conv_id", "turn").alias("pos"), F.concat_ws("-", text("conv_id"), text("turn")).alias("read_id"), seq.alias("seq")).withColumn("qual", F.expr("repeat('I', length(seq))"))


READS = r"reads AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS read_id, turn % 2 + 1 AS mate, TRANSLATE(text, chr(10) || chr(13) || chr(9) || ' ', 'NNNN') AS seq FROM conversations)"


def fastq_files(spark: SparkSession, d: str) -> list[str]:
    path = folder(spark)
    K.write_fastq(reads(spark, d), path)
    return [f.removeprefix("file://").removeprefix("file:") for f in spark.read.text(path).inputFiles()]


@query("SELECT read_id, seq FROM reads", READS)
def src9_fastq(spark, d):
    """Written by the FASTQ sink (SNK-7), read by the FASTQ source (UDF-5)."""
    return Q.read_fastq(spark, [fastq_files(spark, d)], "all").select("read_id", "seq")


@query("SELECT read_id AS name, seq FROM reads", READS)
def src10_fasta(spark, d):
    half = F.floor(F.length("seq") / 2).cast("int")
    rows = reads(spark, d).select(F.concat(F.lit(">"), "read_id", F.lit("\n"), F.substring("seq", F.lit(1), half), F.lit("\n"), F.substring("seq", half + 1, F.length("seq"))).alias("value"))
    return Q.read_fasta(spark, as_lines(spark, rows)).select("name", "seq")


@query("SELECT event_type AS gene, 'c' || CAST(user_id AS VARCHAR) AS barcode, CAST(COUNT(*) AS DOUBLE) AS value FROM events GROUP BY ALL")
def src11_mtx(spark, d):
    rows = T.table(spark, d, "events").groupBy(F.col("event_type").alias("gene"), F.concat(F.lit("c"), text("user_id")).alias("barcode")).agg(F.count("*").alias("n"))
    # side files are one file each by their format: a label per row or column of the matrix
    numbered = lambda c: rows.select(c).distinct().orderBy(c).selectExpr(f"collect_list({c}) AS all").select(F.posexplode("all").alias("at", c))
    genes, barcodes = numbered("gene"), numbered("barcode")
    cells = rows.join(genes.withColumnRenamed("at", "g"), "gene").join(barcodes.withColumnRenamed("at", "b"), "barcode")
    head = F.concat_ws(" ", F.lit(genes.count()), F.lit(barcodes.count()), F.lit(rows.count()))
    body = cells.select(F.lit(1).alias("k"), F.concat_ws(" ", F.col("g") + 1, F.col("b") + 1, "n").alias("value")).union(spark.range(1).select(F.lit(0), head))
    matrix = as_lines(spark, body.orderBy("k").coalesce(1))
    side = lambda labels, *c: as_lines(spark, labels.orderBy("at").select(joined(*c).alias("value")).coalesce(1))
    return S.read_mtx(spark, matrix, side(genes, "id", F.col("gene")), side(barcodes, F.col("barcode")), "all").select("gene", "barcode", "value")


@query("SELECT COUNT(*) AS raw_reads, CAST(SUM(l_linenumber) AS BIGINT) AS trimmed_reads, 75.5::DOUBLE AS mean_length, TRUE AS paired FROM lineitem GROUP BY l_returnflag, l_linestatus")
def src12_fastp_json(spark, d):
    per = T.table(spark, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("mode")).agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("m"))
    value = F.format_string('{"summary": {"before_filtering": {"total_reads": %d},\n "after_filtering": {"total_reads": %d, "read1_mean_length": 75, "read2_mean_length": 76}}}', "n", "m")
    return S.read_fastp_json(spark, [as_lines(spark, per.withColumn("value", value), "mode") + "/*"]).drop("sample")


@query("SELECT FALSE AS paired, CAST(COUNT(*) AS DOUBLE) AS total, CAST(SUM(l_linenumber) AS DOUBLE) AS unaligned FROM lineitem GROUP BY l_returnflag, l_linestatus")
def src13_align_log(spark, d):
    per = T.table(spark, d, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("mode")).agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("m"))
    value = F.format_string("%d reads; of these:\n  %d (1.00%%) were unpaired; of these:\n    %d (50.00%%) aligned 0 times\n50.00%% overall alignment rate", "n", "n", "m")
    return S.read_align_log(spark, [as_lines(spark, per.withColumn("value", value), "mode") + "/*"]).select("paired", "total", "unaligned")


@query("SELECT taxid, COALESCE(parent, 'root') AS parent, rank, name FROM taxonomy", T.TAXONOMY)
def src14_taxdump(spark, d):
    rows = T.taxonomy(spark, d)
    line = lambda *c: F.concat(F.concat_ws("\t|\t", *c), F.lit("\t|"))
    nodes = as_lines(spark, rows.select(line("taxid", F.coalesce("parent", F.lit("root")), "rank").alias("value")))
    names = as_lines(spark, rows.select(F.explode(F.array(line("taxid", "name", F.lit(""), F.lit("scientific name")), line("taxid", F.lit("other"), F.lit(""), F.lit("synonym")))).alias("value")))
    return S.read_taxdump(spark, nodes, names)[0].select("taxid", "parent", "rank", "name")


@query("SELECT CAST(doc_id AS VARCHAR) AS run, source, COALESCE(NULLIF(REPLACE(text, chr(13), ' '), ''), 'none') AS title FROM documents")
def src15_runinfo(spark, d):
    """Titles with tabs, quotes and line ends, as the run sheet writes them (SNK-8)."""
    rows = T.table(spark, d, "documents").select(text("doc_id").alias("run"), "source", F.coalesce(F.nullif(F.replace("text", F.lit("\r"), F.lit(" ")), F.lit("")), F.lit("none")).alias("title"))
    path = folder(spark)
    rows.write.csv(path, sep="\t", header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return S.read_runinfo(spark, path)


@query("SELECT 'P' || CAST(p_partkey AS VARCHAR) AS gene, CAST(p_size AS DOUBLE) AS length, CAST(p_partkey % 97 AS DOUBLE) AS count FROM part")
def src16_featurecounts(spark, d):
    rows = T.table(spark, d, "part").select(F.concat(F.lit("P"), text("p_partkey")).alias("Geneid"), F.lit("1").alias("Chr"), F.lit(1).alias("Start"), F.lit(9).alias("End"), F.lit("+").alias("Strand"), F.col("p_size").alias("Length"), (F.col("p_partkey") % 97).alias("x.bam"))
    return S.read_featurecounts(spark, [as_table(spark, rows.coalesce(1))]).select("gene", "length", "count")


@query("SELECT 'P' || CAST(p_partkey AS VARCHAR) AS transcript, p_brand AS gene, CAST(p_size AS DOUBLE) AS length, CAST(p_partkey % 97 AS DOUBLE) AS count, p_retailprice AS tpm FROM part")
def src17_kallisto(spark, d):
    part = T.table(spark, d, "part").withColumn("target_id", F.concat(F.lit("P"), text("p_partkey")))
    counts = S.read_kallisto(spark, as_table(spark, part.select("target_id", F.col("p_size").alias("length"), F.lit(1).alias("eff_length"), (F.col("p_partkey") % 97).alias("est_counts"), F.col("p_retailprice").alias("tpm"))))
    genes = S.read_tx2gene(spark, as_table(spark, part.select("target_id", "p_brand"), header=False))
    return counts.join(genes, "transcript").select("transcript", "gene", "length", "count", "tpm")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS taxid, s_name AS name, 'species' AS rank, s_acctbal AS score, CAST(s_nationkey AS DOUBLE) AS reads FROM supplier")
def src18_pathseq(spark, d):
    rows = T.table(spark, d, "supplier").select(F.col("s_suppkey").alias("tax_id"), F.lit("root|x").alias("taxonomy"), F.lit("species").alias("type"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("score"), F.lit(1.0).alias("score_normalized"), F.col("s_nationkey").alias("reads"), F.lit(0).alias("unambiguous"))
    return S.read_pathseq(spark, as_table(spark, rows)).select("taxid", "name", "rank", "score", "reads")


@query("SELECT s_name AS name, CAST(UNNEST([s_suppkey, s_nationkey + 100000]) AS VARCHAR) AS taxid, CAST(s_nationkey AS DOUBLE) AS n, s_acctbal AS score FROM supplier")
def src19_scores(spark, d):
    rows = T.table(spark, d, "supplier").select(F.col("s_name").alias("tax_name"), F.concat_ws(";", "s_suppkey", F.col("s_nationkey") + 100000).alias("staxids"), F.col("s_nationkey").alias("n"), F.col("s_acctbal").alias("pred"))
    return S.read_scores(spark, as_table(spark, rows, sep=",", quote='"')).select("name", "taxid", "n", "score")


@query("SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS taxid, 'species' AS rank, 13 AS width, s_acctbal AS first_value FROM supplier")
def src20_metax(spark, d):
    rows = T.table(spark, d, "supplier").select(joined(F.col("s_name"), F.col("s_suppkey"), "species", F.col("s_acctbal"), *["1"] * 9).alias("value"))
    return S.read_metax(spark, as_lines(spark, rows)).select("name", "taxid", "rank", "width", F.get("values", F.lit(0)).alias("first_value"))


@query("SELECT 'S' || CAST(s_nationkey AS VARCHAR) AS sample, 'G' || CAST(s_suppkey AS VARCHAR) AS genome, s_acctbal AS taxonomic_abundance, s_name AS contig FROM supplier")
def src21_sylph(spark, d):
    rows = T.table(spark, d, "supplier").select(F.format_string("/x/S%d_1.fastq.gz", "s_nationkey").alias("Sample_file"), F.concat(F.lit("G"), text("s_suppkey")).alias("Genome_file"), F.col("s_acctbal").alias("Taxonomic_abundance"), F.lit(1.0).alias("Sequence_abundance"), F.col("s_name").alias("Contig_name"))
    return S.read_sylph(spark, as_table(spark, rows)).select("sample", "genome", "taxonomic_abundance", "contig")


@query("SELECT CAST(clade AS DOUBLE) AS clade_minimizers, CAST(direct AS DOUBLE) AS taxon_minimizers, rank, taxid, name FROM tree", TREE)
def src22_inspect(spark, d):
    rows = tree(spark, d).select(joined("0.1", F.col("clade"), F.col("direct"), code(), F.col("taxid"), indented()).alias("value"))
    return R.read_inspect(spark, as_lines(spark, rows))


@query("SELECT a.n_name AS a, b.n_name AS b, CAST(a.n_nationkey * 100 + b.n_regionkey AS DOUBLE) AS value FROM nation a, nation b")
def src23_square(spark, d):
    nation = T.table(spark, d, "nation")
    names = sorted(r["n_name"] for r in nation.select("n_name").collect())  # the columns of the matrix
    region = {r["n_name"]: r["n_regionkey"] for r in nation.select("n_name", "n_regionkey").collect()}
    rows = nation.select("n_name", *[(F.col("n_nationkey") * 100 + region[n]).alias(n) for n in names])
    return S.read_square(spark, as_table(spark, rows))


@query("SELECT n_name AS sample, 'R' || CAST(n_regionkey AS VARCHAR) AS \"group\", CAST(n_nationkey AS VARCHAR) AS other FROM nation")
def src24_metadata(spark, d):
    rows = T.table(spark, d, "nation").select(F.col("n_name").alias("Sample_ID"), F.concat(F.lit("R"), text("n_regionkey")).alias("Condition"), F.col("n_nationkey").alias("other"))
    return S.read_metadata(spark, as_table(spark, rows), ("sample", "group"))


@query("SELECT 'C' || CAST(c_custkey AS VARCHAR) AS sample, c_custkey % 2 = 0 AS single_end, CASE WHEN c_nationkey % 2 = 0 THEN 'dna' ELSE 'rna' END AS molecule FROM customer")
def src25_samplesheet(spark, d):
    sample = F.concat(F.lit("C"), text("c_custkey"))
    rows = T.table(spark, d, "customer").select(
        sample.alias("sample"), F.concat(sample, F.lit("_1.fastq.gz")).alias("fastq_1"), F.when(F.col("c_custkey") % 2 != 0, F.concat(sample, F.lit("_2.fastq.gz"))).alias("fastq_2"),
        F.when(F.col("c_nationkey") % 2 == 0, "dna").otherwise("rna").alias("molecule"),
    )
    return S.read_samplesheet(spark, as_table(spark, rows, sep=",", quote='"', nullValue="")).select("sample", "single_end", "molecule")


@query("SELECT n_name AS sample FROM nation WHERE n_regionkey = 2")
def src28_resolve_controls(spark, d):
    nation = T.table(spark, d, "nation")
    path = as_table(spark, nation.select(F.col("n_name").alias("sample"), F.when(F.col("n_regionkey") == 2, "yes").otherwise("no").alias("kind"))) + "/*.csv"
    spec = as_lines(spark, S.tsv(spark, path).where("kind = 'yes'").select(F.col("sample").alias("value")))
    return S.resolve_controls(spark, spec, nation.select(F.col("n_name").alias("sample")))


@query("SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS taxid FROM supplier WHERE s_acctbal < 5000")
def src29_read_drop(spark, d):
    rows = T.table(spark, d, "supplier").where("s_acctbal < 5000").select(F.explode(F.array(F.concat(text("s_suppkey"), F.lit(" # in debt")), text("s_suppkey"), F.lit("# a comment"))).alias("value"))
    return S.read_drop(spark, [as_lines(spark, rows)])


@query("SELECT DISTINCT event_type AS taxid, CAST(user_id AS VARCHAR) AS key FROM events WHERE value < 10")
def src29_read_drop_cells(spark, d):
    rows = T.table(spark, d, "events").where("value < 10").select(joined(F.col("event_type"), F.col("user_id")).alias("value"))
    return S.read_drop_cells(spark, [as_lines(spark, rows)])


@query("SELECT n_name AS sample, 'r' || CAST(n_nationkey AS VARCHAR) AS report, 'g' || CAST(n_regionkey AS VARCHAR) AS table_1, CAST(n_regionkey AS VARCHAR) AS kind FROM nation")
def src30_manifest(spark, d):
    rows = T.table(spark, d, "nation").select(F.col("n_name").alias("Sample"), F.concat(F.lit("r"), text("n_nationkey")).alias("Report [file]"), F.concat(F.lit("g"), text("n_regionkey")).alias("Genes [file]"), F.col("n_regionkey").alias("kind"))
    return S.read_manifest(spark, as_table(spark, rows))


@query("SELECT sample, taxid, count, 'ratio' AS filter FROM abundance", T.ABUNDANCE)
def snk2_evidence(spark, d):
    path = folder(spark)
    K.write_evidence(T.abundance(spark, d).select("sample", "taxid", "count"), "ratio", path)
    return spark.read.parquet(path)


@query("SELECT taxid, sample, count FROM abundance WHERE count > 0", T.ABUNDANCE)
def snk4_biom(spark, d):
    """Read back from the format's one document."""
    rows, path = cut(T.abundance(spark, d)), folder(spark)
    K.write_biom(rows, rows, rows.select("sample").distinct().withColumn("kind", F.lit("x")), path)
    schema = "rows array<struct<id: string>>, columns array<struct<id: string>>, data array<array<double>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("t"))
    ids = lambda part, name: whole.select(F.posexplode(f"t.{part}.id").alias(part, name))
    at = lambda k: F.get("c", F.lit(k))
    # a cell carries its two numbers, not the lists of all names
    cells = whole.select(F.explode("t.data").alias("c")).select(at(0).cast("int").alias("rows"), at(1).cast("int").alias("columns"), at(2).alias("count"))
    return cells.join(ids("rows", "taxid"), "rows").join(ids("columns", "sample"), "columns").select("taxid", "sample", "count")


@query("SELECT url || CASE WHEN page_id % 2 = 0 THEN '.bracken.combined.tsv' ELSE '.zip' END AS path, CASE WHEN page_id % 2 = 0 THEN ['bracken_combined'] ELSE [] END AS formats FROM pages GROUP BY ALL")
def snk5_plan_bundle(spark, d):
    files = T.table(spark, d, "pages").select(F.concat("url", F.when(F.col("page_id") % 2 == 0, ".bracken.combined.tsv").otherwise(".zip")).alias("path"))
    return K.plan_bundle(spark, files.where("path IS NOT NULL"))


@query("SELECT taxid, sample, count FROM abundance WHERE count > 0", T.ABUNDANCE)
def snk6_write_matrix(spark, d):
    path = folder(spark)
    K.write_matrix(T.abundance(spark, d), "taxid", "count", path)
    wide = S.tsv(spark, path).drop("_path")
    return wide.unpivot("taxid", [c for c in wide.columns if c != "taxid"], "sample", "value").select("taxid", "sample", F.col("value").cast("double").alias("count")).where("count > 0")


@query("SELECT taxid AS id, taxid, name, SUM(count) AS total_reads, ROUND(COUNT(*) FILTER (WHERE count >= 10) / (SELECT COUNT(DISTINCT sample) FROM cohort), 4) AS prevalence FROM cohort GROUP BY taxid, name", T.COHORT)
def snk6_otu_labels(spark, d):
    path = folder(spark)
    K.write_otu(T.cohort(spark, d), path)
    rows = spark.read.csv(f"{path}/taxa", sep="\t", header=True)
    return rows.select("id", "taxid", "name", F.col("total_reads").cast("decimal(38,2)").cast("double").alias("total_reads"), F.col("prevalence").cast("double").alias("prevalence"))


@query("SELECT taxid AS id, sample, count FROM cohort WHERE count > 0", T.COHORT)
def snk6_write_otu(spark, d):
    path = folder(spark)
    K.write_otu(T.cohort(spark, d), path)
    wide = spark.read.csv(f"{path}/otu", sep="\t", header=True)
    long = wide.unpivot("#OTU ID", [c for c in wide.columns if c != "#OTU ID"], "sample", "value")
    return long.select(F.col("#OTU ID").alias("id"), "sample", F.col("value").cast("double").alias("count")).where("count > 0")


@query("SELECT 'PRJ1' AS query, 'ERR' || o_custkey AS run, CASE WHEN o_custkey % 3 = 0 THEN 'ERR' || o_custkey ELSE 'X' || o_custkey END AS experiment, 'S' || MIN_BY(o_orderpriority, o_orderkey) AS sample FROM orders GROUP BY o_custkey")
def snk8_write_runsheet(spark, d):
    """Repeated runs are written once, missing experiments take the run's id."""
    run, path = F.concat(F.lit("ERR"), text("o_custkey")), folder(spark)
    rows = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("pos"), run.alias("run"), F.when(F.col("o_custkey") % 3 > 0, F.concat(F.lit("X "), text("o_custkey"))).alias("experiment"), F.concat(F.lit("  S"), "o_orderpriority").alias("sample"))
    K.write_runsheet(rows, path, "PRJ1")
    back = spark.read.csv(path, header=True)
    return back.withColumn("experiment", F.replace("experiment", F.lit(" "), F.lit("")))


def touched(spark: SparkSession, names: list[str]) -> str:
    """A folder of files of one byte with given names, in Spark's file system."""
    path = folder(spark)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        out = files.create(spark._jvm.org.apache.hadoop.fs.Path(at, name))
        out.write(10)  # Spark passes over empty files
        out.close()
    return path


@query("SELECT n_name || 'x' AS sample, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 2 END AS files FROM nation")
def src26_pair_fastqs(spark, d):
    """Every other nation has one file, the others have two."""
    own = [(r["n_name"] + "x", r["n_nationkey"] % 2) for r in T.table(spark, d, "nation").select("n_name", "n_nationkey").collect()]  # file names
    path = touched(spark, [n for name, pair in own for n in ([f"{name}_R1_001.fastq.gz", f"{name}_R2_001.fastq.gz"] if pair else [f"{name}.fq.gz"])])
    return S.pair_fastqs(spark, path).select("sample", F.size("mates").alias("files"))


@query("SELECT DISTINCT 'SRR' || s_nationkey AS accession FROM supplier")
def src27_parse_accessions(spark, d):
    """A list with repeats and comments."""
    own = T.table(spark, d, "supplier").select("s_nationkey", "s_name").collect()  # an argument's text
    return S.parse_accessions(spark, ",".join(f"SRR{r['s_nationkey']}" if k % 2 else f"\nSRR{r['s_nationkey']} # {r['s_name']}\n" for k, r in enumerate(own)))


def drained(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """All rows of a stream over what is there now, by way of a table; the last state in complete mode.

    One batch takes all of it: a stream with timeouts would go on for ever under ``availableNow``.
    """
    out, at = folder(spark), folder(spark)
    write = lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)
    stream.writeStream.outputMode(mode).option("checkpointLocation", at).trigger(once=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = folder(spark)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


@query("SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(COUNT(DISTINCT l_linenumber) AS BIGINT) AS n, TRUE AS complete FROM lineitem GROUP BY l_orderkey")
def str1_release_groups(spark, d):
    """Orders come out when all their lines are there."""
    lines = T.table(spark, d, "lineitem").select(text("l_orderkey").alias("key"), text("l_linenumber").alias("member"))
    expected = lines.groupBy("key").agg(F.count_distinct("member").alias("expected"))
    G.use_state_store(spark)
    released = G.release_groups(streamed(spark, lines.join(expected, "key")))
    return drained(spark, released, "append").select("key", F.size("members").cast("long").alias("n"), "complete")


@query("SELECT CAST(user_id % 5 AS VARCHAR) AS sample, event_type AS taxid, COUNT(*) AS reads, COUNT(*) FILTER (WHERE user_id % 2 = 0) AS host_reads FROM events GROUP BY ALL")
def str2_running_taxa(spark, d):
    rows = T.table(spark, d, "events").select((F.col("user_id") % 5).cast("string").alias("sample"), F.col("event_type").alias("taxid"), F.when(F.col("user_id") % 2 == 0, "562:1 9606:2").otherwise("562:3").alias("runs"))
    return drained(spark, G.running_taxa(streamed(spark, rows), "9606"), "complete")


@query("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS run FROM lineitem")
def str3_first_runs(spark, d):
    return drained(spark, G.first_runs(streamed(spark, T.table(spark, d, "lineitem").select(text("l_partkey").alias("run")))), "append")


@query("SELECT o_custkey, COUNT(*) AS n, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def str4_with_static(spark, d):
    static = T.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = drained(spark, G.with_static(streamed(spark, T.table(spark, d, "orders").select("o_custkey", "o_orderkey")), static, "o_custkey"), "append")
    return rows.groupBy("o_custkey", "c_mktsegment").agg(F.count("*").alias("n"))

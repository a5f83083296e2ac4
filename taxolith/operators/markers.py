"""Marker genes: candidates by coreness, uniqueness, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.windows import first_n


def coreness(clusters: DataFrame, genomes: DataFrame) -> DataFrame:
    """``cluster, taxid, genomes, coreness``: share of a species' genomes with a gene in the cluster.

    ``clusters(cluster, gene, genome)`` and ``genomes(genome, taxid)``.
    """
    size = genomes.groupBy("taxid").agg(F.count_distinct("genome").alias("n"))
    per = clusters.join(genomes, "genome").groupBy("cluster", "taxid").agg(F.count_distinct("genome").alias("genomes"))
    return per.join(size, "taxid").withColumn("coreness", F.col("genomes") / F.col("n"))


def marker_candidates(clusters: DataFrame, genes: DataFrame | None, genomes: DataFrame, keep: int = 800, few: int = 100, max_species: int = 10) -> DataFrame:
    """Core clusters of each species with the gene of median length (CMP-27).

    The threshold is the ``keep``-th highest coreness, but 0.6 at least for species of less
    than ``few`` genomes and 0.5 for others; clusters in more than ``max_species`` species are skipped.
    Without ``genes(gene, length)`` a gene's length is a column of ``clusters``, and nothing is looked up.
    """
    rows = coreness(clusters, genomes)
    rows = rows.withColumn("_species", F.count("*").over(Window.partitionBy("cluster"))).where(F.col("_species") <= max_species)
    order = Window.partitionBy("taxid").orderBy(F.desc("coreness"), "cluster")
    rows = rows.withColumn("_rn", F.row_number().over(order))
    at = F.max(F.when(F.col("_rn") == keep, F.col("coreness"))).over(Window.partitionBy("taxid"))
    threshold = F.greatest(F.coalesce(at, F.lit(0.0)), F.when(F.col("n") < few, 0.6).otherwise(0.5))
    rows = rows.withColumn("threshold", threshold).where("coreness >= threshold")
    own = clusters.join(genomes, "genome")
    own = own if genes is None else own.drop("length").join(genes.select("gene", "length"), "gene")
    lengths = Window.partitionBy("cluster", "taxid")
    place = F.row_number().over(lengths.orderBy("length", "gene"))
    middle = own.withColumn("_k", place).withColumn("_n", F.count("*").over(lengths)).where("_k = floor(_n / 2) + 1").select("cluster", "taxid", "gene", "length")
    return rows.join(middle, ["cluster", "taxid"]).select("cluster", "taxid", "gene", "length", "coreness", "threshold")


def uniqueness(hits: DataFrame, candidates: DataFrame, genomes: DataFrame) -> DataFrame:
    """``gene, own_share, other_species, worst_other``: shares of species' genomes that a candidate hits.

    ``hits(gene, genome)``.
    """
    size = genomes.groupBy("taxid").agg(F.count_distinct("genome").alias("_n"))
    per = hits.join(genomes, "genome").groupBy("gene", "taxid").agg(F.count_distinct("genome").alias("_h")).join(size, "taxid").withColumn("_s", F.col("_h") / F.col("_n"))
    per = per.join(candidates.select("gene", F.col("taxid").alias("_own")), "gene")
    same = F.col("taxid") == F.col("_own")
    return per.groupBy("gene").agg(
        F.coalesce(F.max(F.when(same, F.col("_s"))), F.lit(0.0)).alias("own_share"), F.count_if(~same).alias("other_species"),
        F.coalesce(F.max(F.when(~same, F.col("_s"))), F.lit(0.0)).alias("worst_other"),
    )


def select_markers(candidates: DataFrame, hits: DataFrame, genomes: DataFrame, screened: DataFrame | None = None, max_other: float = 0.01, most: int = 200, least: int = 10) -> DataFrame:
    """Up to ``most`` markers per species: fewest shared species, longest, by id (CMP-28, TOP-6).

    A marker hits its own species at its coreness threshold and any other species below
    ``max_other`` of its genomes; genes with a screen hit go; species of less than ``least`` markers go.
    """
    rows = candidates.join(uniqueness(hits, candidates, genomes), "gene")
    rows = rows.where((F.col("own_share") >= F.col("threshold")) & (F.col("worst_other") < max_other))
    if screened is not None:
        rows = rows.join(screened.select("gene"), "gene", "left_anti")
    chosen = first_n(rows, ["taxid"], ["other_species", F.desc("length"), "gene"], most)
    enough = F.count("*").over(Window.partitionBy("taxid"))
    return chosen.withColumn("_n", enough).where(F.col("_n") >= least).drop("_n").withColumn("quasi", F.col("other_species") > 0)


def genome_sources(sheet: DataFrame, downloads: DataFrame, annotations: DataFrame) -> DataFrame:
    """``genome, fasta, cds, has_cds``: local files of the sheet and downloaded ones (JOI-13).

    ``sheet(genome, fasta, cds)``; rows without a fasta are downloaded by their accession, and
    those that ``downloads(genome, fasta)`` lacks are left out. The sheet's CDS goes before that
    of ``annotations(genome, cds)``, which local genomes do not use.
    """
    local = sheet.where("fasta IS NOT NULL").select("genome", "fasta", "cds")
    wanted = sheet.where("fasta IS NULL").select("genome", F.col("cds").alias("_own"))
    remote = wanted.join(downloads.select("genome", "fasta"), "genome").join(annotations.select("genome", "cds"), "genome", "left")
    rows = local.unionByName(remote.select("genome", "fasta", F.coalesce("_own", "cds").alias("cds")))
    return rows.withColumn("has_cds", F.col("cds").isNotNull())


def mapping_targets(genomes: DataFrame, most: int = 100) -> DataFrame:
    """Reference genomes per species: fewest contigs, longest (TOP-7)."""
    return first_n(genomes, ["taxid"], ["contigs", F.desc("length"), "genome"], most)

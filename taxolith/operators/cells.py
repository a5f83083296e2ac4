"""Cell x taxon matrices and the tests on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.distributions import fisher_greater, hypergeom_cdf, hypergeom_sf, norm_cdf, norm_ppf, rank_correlation_p
from taxolith.functions.kmers import BASES, codes_of, super_kmers
from taxolith.functions.scalar import has_homopolymer, kmer_runs, kmers_at, lineage_share, log2_ratio
from taxolith.functions.windows import adjusted, average_rank, correlation, upper_median


def read_reasons(reads: DataFrame, lineage: DataFrame, host: str | None = None, min_fraction: float = 0.5, homopolymer: int = 0) -> DataFrame:
    """``reads`` with the first reason against each, null if none (FLT-8).

    ``reads(sample, read_id, barcode, umi, status, taxid, runs, seq)``; the lineage joins by taxid.
    """
    rows = reads.join(lineage, "taxid", "left")
    share = lineage_share(kmer_runs(F.col("runs")), F.array_append(F.coalesce("ancestors", F.array().cast("array<string>")), F.col("taxid")))
    reason = F.when(F.coalesce("barcode", F.lit("NA")) == "NA", "no_barcode").when((F.col("status") != "C") | (F.col("taxid") == "0"), "unclassified")
    if homopolymer:
        reason = reason.when(has_homopolymer(F.col("seq"), homopolymer), "low_complexity")
    if host:
        reason = reason.when(F.col("runs").startswith(f"{host}:") | F.col("runs").contains(f" {host}:"), "host_kmer")
    return rows.withColumn("reason", reason.when(F.coalesce(share, F.lit(0.0)) < min_fraction, "below_fraction"))


def cell_taxa(reads: DataFrame, by: Sequence[str] = ("sample", "barcode", "taxid"), dedup: bool = True) -> DataFrame:
    """Distinct UMIs, or reads, of each cell and taxon (AGG-5, CMP-11)."""
    count = F.count_distinct("umi") if dedup else F.count("*")
    return reads.groupBy(*by).agg(count.alias("count"))


def presence(cells: DataFrame, least: float) -> DataFrame:
    """Cells with enough of a taxon (FLT-9)."""
    return cells.where(F.col("count") >= least)


def threshold_sweep(cells: DataFrame, thresholds: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Cells, taxa and pairs that survive each threshold (FLT-10)."""
    met = F.explode(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= F.col("count"))).alias("threshold")
    rows = cells.select("sample", "barcode", "taxid", met)
    return rows.groupBy("threshold").agg(F.count_distinct("sample", "barcode").alias("cells"), F.count_distinct("taxid").alias("taxa"), F.count("*").alias("pairs"))


def filter_cell_taxa(cells: DataFrame, drop: DataFrame, drop_cells: DataFrame) -> DataFrame:
    """Without listed taxids, and without listed (taxid, barcode or sample) pairs (FLT-4)."""
    out = cells.join(drop.select("taxid").distinct(), "taxid", "left_anti")
    pairs = drop_cells.select("taxid", "key").distinct()
    for column in ("barcode", "sample"):
        out = out.join(pairs.withColumnRenamed("key", column), ["taxid", column], "left_anti")
    return out


def own_runs(reads: DataFrame, k: int) -> DataFrame:
    """``taxid, barcode, segment``: the stretches of reads whose k-mers were given to the read's own taxon."""
    runs = reads.select("taxid", "barcode", "seq", "read_id", kmer_runs(F.col("runs")).alias("_runs"))
    # where each run starts, and the end of the last
    starts = F.aggregate("_runs", F.array(F.lit(0).cast("long")), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["n"])))
    placed = runs.withColumn("_at", starts).select("taxid", "barcode", "seq", "_at", F.posexplode("_runs").alias("_i", "_run")).where(F.col("_run.taxid") == F.col("taxid"))
    at = F.col("_at")[F.col("_i")]
    return placed.select("taxid", "barcode", F.substring("seq", (at + 1).cast("int"), (F.col("_run.n") + k - 1).cast("int")).alias("segment"), F.col("_run.n").alias("n"))


def kmer_evidence(reads: DataFrame, k: int = 35, max_barcodes: int | None = None, sketch: bool = False) -> DataFrame:
    """``taxid, barcode, total, distinct, capped``: k-mers of the runs on the taxon itself (AGG-6, SCA-10).

    Runs are filtered by taxid before any k-mer is made. What is shuffled is super-k-mers, stretches of k-mers with one
    minimiser, equal ones summed per task first; equal k-mers meet at their minimiser, where
    they are counted. With ``sketch`` the distinct count is an estimate from mergeable sketches that need no
    such meeting. All barcodes are kept unless ``max_barcodes`` asks for the first by name of each
    taxon; ``capped`` then says whether a taxon had more.
    """
    runs = own_runs(reads, k)
    if max_barcodes is not None:
        names = runs.select("taxid", "barcode").distinct()
        ranked = names.withColumn("_k", F.row_number().over(Window.partitionBy("taxid").orderBy("barcode"))).withColumn("capped", F.count("*").over(Window.partitionBy("taxid")) > max_barcodes)
        kept = ranked.where(F.col("_k") <= max_barcodes).select("taxid", "barcode", "capped")
        runs = runs.join(kept, ["taxid", "barcode"])
    else:
        runs = runs.withColumn("capped", F.lit(False))
    keys = ["taxid", "barcode", "capped"]
    if sketch:
        words = runs.select(*keys, F.explode(kmers_at(F.col("segment"), F.lit(0), F.col("n").cast("int"), k)).alias("kmer"))
        return words.groupBy(*keys).agg(F.count("*").alias("total"), F.hll_sketch_estimate(F.hll_sketch_agg("kmer", F.lit(14))).alias("distinct")).select("taxid", "barcode", "total", "distinct", "capped")

    def split(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            if not texts:
                continue
            codes, bad, begins = codes_of(texts, BASES)
            starts, ends, minimisers = super_kmers(codes, bad, k)
            own = np.searchsorted(begins, starts, side="right") - 1
            row = pa.array(own)
            pieces = [texts[t][a:b] for t, a, b in zip(own.tolist(), (starts - begins[own]).tolist(), (ends - begins[own]).tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in range(3)), pa.array(minimisers), pa.array(pieces, pa.string())], names=[*keys, "minimiser", "piece"])

    typed = ", ".join(f"{c} {runs.schema[c].dataType.simpleString()}" for c in keys)
    pieces = runs.select(*keys, "segment").mapInArrow(split, f"{typed}, minimiser long, piece string")
    pieces = pieces.groupBy(*keys, "minimiser", "piece").agg(F.count("*").alias("n"))
    dealt = pieces.repartition("taxid", "barcode", "minimiser").sortWithinPartitions("taxid", "barcode", "minimiser", "piece")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        now, seen, total = None, set(), 0
        out: dict = {}

        def close():
            if now is not None:
                own = out.setdefault(now[:3], [0, 0])
                own[0] += total
                own[1] += len(seen)

        for batch in batches:
            for taxid, barcode, capped, minimiser, piece, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (taxid, barcode, capped, minimiser) != now:
                    close()
                    now, seen, total = (taxid, barcode, capped, minimiser), set(), 0
                total += n * (len(piece) - k + 1)
                seen.update(piece[j : j + k] for j in range(len(piece) - k + 1))
        close()
        columns = list(zip(*[(*key, *own) for key, own in out.items()])) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow_types)], names=[*keys, "total", "distinct"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import LongType

    arrow_types = [to_arrow_type(t) for t in [*(runs.schema[c].dataType for c in keys), LongType(), LongType()]]
    found = dealt.mapInArrow(count, f"{typed}, total long, distinct long")
    return found.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).select("taxid", "barcode", "total", "distinct", "capped")


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """``by, n, rho, p`` of the rank correlation; null for fewer than three rows or a constant (STA-1)."""
    rows = average_rank(average_rank(df, x, by, "_rx"), y, by, "_ry")
    per = rows.groupBy(*by).agg(F.count("*").alias("n"), correlation("_rx", "_ry").alias("rho"), F.count_distinct(x).alias("_dx"), F.count_distinct(y).alias("_dy"))
    rho = F.when((F.col("n") >= 3) & (F.col("_dx") > 1) & (F.col("_dy") > 1), F.col("rho"))
    return per.withColumn("rho", rho).withColumn("p", rank_correlation_p(F.col("rho"), F.col("n"))).drop("_dx", "_dy")


def kmer_denoise(evidence: DataFrame, min_barcodes: int = 4, p: float = 0.05, method: str = "holm") -> DataFrame:
    """Taxa whose distinct k-mers grow with their k-mers over barcodes (CMP-13)."""
    shape = evidence.groupBy("taxid").agg(F.count("*").alias("barcodes"), F.count_distinct("total").alias("_t"), F.count_distinct("distinct").alias("_d"))
    tested = spearman(evidence, "total", "distinct", ["taxid"]).select("taxid", "rho", "p")
    rows = shape.join(tested, "taxid", "left")
    usable = (F.col("barcodes") >= min_barcodes) & (F.col("_t") > 1) & (F.col("_d") > 1)
    rows = rows.withColumn("p", F.when(usable, F.col("p")))
    rows = adjusted(rows, "p", [], ["taxid"], method, "q")
    verdict = (
        F.when(F.col("barcodes") < min_barcodes, "untested_few_barcodes").when(F.col("_t") == 1, "untested_constant").when(F.col("_d") == 1, "saturated_distinct")
        .when((F.col("rho") > 0) & (F.col("q") <= p), "kept").otherwise("not_proportional")
    )
    return rows.withColumn("verdict", verdict).drop("_t", "_d")


def stouffer(df: DataFrame, by: Sequence[str], p: str, weight: str, name: str = "p") -> DataFrame:
    """Weighted combined one-sided p of each group; null p are skipped (STA-4)."""
    # minus the quantile of p: 1 - p would lose all p below 1e-16
    z = -norm_ppf(F.greatest(F.least(F.col(p), F.lit(0.9999)), F.lit(1e-300)))
    rows = df.where(F.col(p).isNotNull()).withColumn("_z", z).withColumn("_w", F.col(weight))
    per = rows.groupBy(*by).agg((F.sum(F.col("_w") * F.col("_z")) / F.sqrt(F.sum(F.col("_w") * F.col("_w")))).alias("_z"))
    return per.withColumn(name, norm_cdf(-F.col("_z"))).drop("_z")


def ambient_tables(cell_counts: DataFrame, droplets: DataFrame, min_droplets: int = 5) -> DataFrame:
    """Positive cells and empty droplets of each taxon, with prevalence and rate ratios (CMP-14, the counts).

    ``droplets(barcode, is_cell, host_umis)``.
    """
    whole = droplets.agg(
        F.count_if("is_cell").alias("cells_total"), F.count_if(~F.col("is_cell")).alias("empty_total"),
        F.sum(F.when(F.col("is_cell"), F.col("host_umis")).otherwise(0)).alias("_host_cells"), F.sum(F.when(~F.col("is_cell"), F.col("host_umis")).otherwise(0)).alias("_host_empty"),
    )
    rows = cell_counts.join(droplets.select("barcode", "is_cell"), "barcode")
    per = rows.groupBy("taxid").agg(
        F.count_if("is_cell").alias("cells_positive"), F.count_if(~F.col("is_cell")).alias("empty_positive"),
        F.sum(F.when(F.col("is_cell"), F.col("count")).otherwise(0)).alias("umis_in_cells"), F.sum(F.when(~F.col("is_cell"), F.col("count")).otherwise(0)).alias("umis_in_empty"),
    ).where(F.col("cells_positive") + F.col("empty_positive") >= min_droplets).crossJoin(F.broadcast(whole))
    prevalence = F.try_divide(F.col("cells_positive") / F.col("cells_total"), F.col("empty_positive") / F.col("empty_total"))
    rate = F.try_divide(F.col("umis_in_cells") / F.col("_host_cells"), F.col("umis_in_empty") / F.col("_host_empty"))
    return per.withColumn("prevalence_ratio", prevalence).withColumn("rate_ratio", rate).drop("_host_cells", "_host_empty")


def ambient(cell_counts: DataFrame, droplets: DataFrame, min_droplets: int = 5, enriched: float = 2.0, depleted: float = 0.5, p: float = 0.05) -> DataFrame:
    """Whether taxa keep to cells or to empty droplets; one-sided in the direction of the ratio (CMP-14)."""
    rows = ambient_tables(cell_counts, droplets, min_droplets)
    down = F.coalesce(F.col("prevalence_ratio") < 1, F.lit(False))
    rest_c, rest_e = F.col("cells_total") - F.col("cells_positive"), F.col("empty_total") - F.col("empty_positive")
    args = [
        F.when(down, a).otherwise(b)
        for a, b in ((F.col("empty_positive"), F.col("cells_positive")), (rest_e, rest_c), (F.col("cells_positive"), F.col("empty_positive")), (rest_c, rest_e))
    ]
    rows = adjusted(rows.withColumn("p", fisher_greater(*args)), "p", [], ["taxid"])
    sure = F.col("q") < p
    verdict = (
        F.when(F.col("prevalence_ratio").isNull() | ((F.col("prevalence_ratio") >= enriched) & sure), "cell_associated")
        .when((F.col("prevalence_ratio") <= depleted) & sure, "cell_depleted").otherwise("ambient_undecided")
    )
    return rows.withColumn("verdict", verdict)


def enrichment_tables(positives: DataFrame, cells: DataFrame) -> DataFrame:
    """2 x 2 counts of each (sample, cell type, taxid) stratum that can be tested (CMP-15, the counts).

    ``positives(sample, barcode, taxid)`` and ``cells(sample, barcode, cell_type)``. A stratum
    needs positives, cells of the type and cells of other types.
    """
    own = positives.select("sample", "barcode", "taxid").distinct().join(cells.select("sample", "barcode", "cell_type"), ["sample", "barcode"])
    types = cells.groupBy("sample", "cell_type").agg(F.count("*").alias("n_type"))
    types = types.withColumn("n_sample", F.sum("n_type").over(Window.partitionBy("sample")))
    hits = own.groupBy("sample", "taxid").agg(F.count("*").alias("n_infected"))
    both = own.groupBy("sample", "taxid", "cell_type").agg(F.count("*").alias("a"))
    rows = types.join(hits, "sample").join(both, ["sample", "taxid", "cell_type"], "left").na.fill(0, ["a"]).where("n_type < n_sample")
    return rows.withColumn("expected", F.col("n_type") * F.col("n_infected") / F.col("n_sample"))


def enrichment(positives: DataFrame, cells: DataFrame) -> DataFrame:
    """Cell types that hold more positive cells than expected, tested in each sample and combined (CMP-15)."""
    rows = enrichment_tables(positives, cells)
    a = F.col("a")
    b, c = F.col("n_type") - a, F.col("n_infected") - a
    rows = rows.withColumn("_p", fisher_greater(a, b, c, F.col("n_sample") - F.col("n_type") - c))
    keys = ["taxid", "cell_type"]
    per = rows.groupBy(*keys).agg(F.count("*").alias("samples"), F.sum("a").alias("observed"), F.sum("expected").alias("expected")).where("expected > 0")
    per = per.withColumn("log2fc", log2_ratio(F.col("observed"), F.col("expected"))).join(stouffer(rows, keys, "_p", "expected"), keys)
    return adjusted(per, "p", [], keys)


def cooccurrence_tables(positives: DataFrame, cells: DataFrame, min_cells: int = 10) -> DataFrame:
    """Cells of both taxa of each pair in each sample, with what chance would give (CMP-16, the counts)."""
    own = positives.select("sample", "barcode", "taxid").distinct().join(cells.select("sample", "barcode"), ["sample", "barcode"])
    enough = own.groupBy("taxid").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_cells).select("taxid")
    own = own.join(enough, "taxid", "left_semi")
    each = own.groupBy("sample", "taxid").agg(F.count("*").alias("n"))
    first, second = each.select("sample", F.col("taxid").alias("a"), F.col("n").alias("n_a")), each.select("sample", F.col("taxid").alias("b"), F.col("n").alias("n_b"))
    pairs = first.join(second, "sample").where("a < b")
    left, right = own.select("sample", "barcode", F.col("taxid").alias("a")), own.select("sample", "barcode", F.col("taxid").alias("b"))
    both = left.join(right, ["sample", "barcode"]).where("a < b").groupBy("sample", "a", "b").agg(F.count("*").alias("both"))
    size = cells.groupBy("sample").agg(F.count("*").alias("n_sample"))
    rows = pairs.join(both, ["sample", "a", "b"], "left").na.fill(0, ["both"]).join(size, "sample")
    return rows.withColumn("expected", F.col("n_a") * F.col("n_b") / F.col("n_sample"))


def cooccurrence(positives: DataFrame, cells: DataFrame, min_cells: int = 10) -> DataFrame:
    """Pairs of taxa that share cells more or less often than chance (CMP-16)."""
    rows = cooccurrence_tables(positives, cells, min_cells)
    args = [F.col(c) for c in ("both", "n_sample", "n_a", "n_b")]
    rows = rows.withColumn("_up", hypergeom_sf(*args)).withColumn("_low", hypergeom_cdf(*args))
    keys = ["a", "b"]
    per = rows.groupBy(*keys).agg(F.sum("both").alias("observed"), F.sum("expected").alias("expected")).where("expected > 0")
    per = per.join(stouffer(rows, keys, "_up", "expected", "p_together"), keys).join(stouffer(rows, keys, "_low", "expected", "p_apart"), keys)
    per = per.withColumn("log2", log2_ratio(F.col("observed"), F.col("expected")))
    per = per.withColumn("direction", F.when(F.col("observed") > F.col("expected"), "co-occurrence").otherwise("exclusion"))
    return adjusted(per.withColumn("p", F.least(F.lit(1.0), 2 * F.least("p_together", "p_apart"))), "p", [], keys)


def rank_sum(df: DataFrame, value: str, group: Column, by: Sequence[str]) -> DataFrame:
    """``by, n1, n2, rank_sum, z, p`` of group against rest: normal approximation, ties corrected (STA-5)."""
    rows = average_rank(df.withColumn("_g", group), value, by, "_rank")
    ties = rows.groupBy(*by, value).agg(F.count("*").alias("_c")).groupBy(*by).agg(F.sum(F.col("_c") * F.col("_c") * F.col("_c") - F.col("_c")).cast("double").alias("_ties"))
    per = rows.groupBy(*by).agg(F.count_if("_g").alias("n1"), F.count_if(~F.col("_g")).alias("n2"), F.sum(F.when(F.col("_g"), F.col("_rank"))).alias("rank_sum"))
    per = per.join(ties, list(by)) if by else per.crossJoin(ties)
    return rank_sum_test(per).drop("_ties")


def rank_sum_test(per: DataFrame) -> DataFrame:
    n = (F.col("n1") + F.col("n2")).cast("double")
    middle = F.col("n1") * (n + 1) / 2
    variance = F.col("n1") * F.col("n2") / 12.0 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1)))
    z = F.when(variance > 0, (F.col("rank_sum") - middle) / F.sqrt(variance))
    return per.withColumn("z", z).withColumn("p", 2 * norm_cdf(-F.abs("z")))


def doublets(positives: DataFrame, cells: DataFrame) -> DataFrame:
    """Host UMIs of cells with several taxa against those with one, medians and rank sums (CMP-17)."""
    taxa = positives.groupBy("sample", "barcode").agg(F.count_distinct("taxid").alias("_taxa"))
    rows = taxa.join(cells, ["sample", "barcode"]).withColumn("_several", F.col("_taxa") > 1)
    medians = rows.agg(
        upper_median(F.when(F.col("_several"), F.col("host_umis"))).alias("median_several"), upper_median(F.when(~F.col("_several"), F.col("host_umis"))).alias("median_one")
    )
    return rank_sum(rows, "host_umis", F.col("_several"), []).crossJoin(medians)


def cell_states(positives: DataFrame, cells: DataFrame, taxa: DataFrame) -> DataFrame:
    """``taxid, cell_type, sample, barcode, infected``: infected cells, and bystanders of samples that hold the taxon."""
    own = positives.join(taxa.select("taxid"), "taxid", "left_semi").select("taxid", "sample", "barcode").distinct()
    exposed = own.select("taxid", "sample").distinct().join(cells.select("sample", "barcode", "cell_type"), "sample")
    return exposed.join(own.withColumn("_in", F.lit(True)), ["taxid", "sample", "barcode"], "left").withColumn("infected", F.coalesce("_in", F.lit(False))).drop("_in")


def host_de(coo: DataFrame, states: DataFrame, min_cells: int = 10, min_detect: float = 0.1, min_log2fc: float = 0.25) -> DataFrame:
    """Genes of infected against bystander cells within a cell type (CMP-18).

    ``coo(sample, barcode, gene, value)`` holds log-normalised non-zero values. Zeros are
    never made: they are one block of ties below all values, so a value's rank is the
    number of zeros plus its rank among the values, and the block's share goes in by count.
    p is adjusted within each (taxid, cell type).
    """
    group = ["taxid", "cell_type"]
    sizes = states.groupBy(*group).agg(F.count_if("infected").alias("n1"), F.count_if(~F.col("infected")).alias("n2")).where((F.col("n1") >= min_cells) & (F.col("n2") >= min_cells))
    values = states.join(sizes.select(*group), group, "left_semi").join(coo.where("value > 0"), ["sample", "barcode"])
    keys = [*group, "gene"]
    side = F.col("infected")
    per = values.groupBy(*keys).agg(
        F.count_if(side).alias("_d1"), F.count_if(~side).alias("_d2"), F.sum(F.when(side, F.col("value"))).alias("_s1"), F.sum(F.when(~side, F.col("value"))).alias("_s2")
    ).join(sizes, group)
    per = per.withColumn("mean1", F.coalesce("_s1", F.lit(0.0)) / F.col("n1")).withColumn("mean2", F.coalesce("_s2", F.lit(0.0)) / F.col("n2"))
    per = per.withColumn("log2fc", F.log2((F.expm1("mean1") + 1e-9) / (F.expm1("mean2") + 1e-9)))
    detected = F.greatest(F.col("_d1") / F.col("n1"), F.col("_d2") / F.col("n2"))
    per = per.where((detected >= min_detect) & (F.abs("log2fc") >= min_log2fc))
    ranked = average_rank(values.join(per.select(*keys), keys, "left_semi"), "value", keys, "_rank")
    ties = ranked.groupBy(*keys, "value").agg(F.count("*").alias("_c")).groupBy(*keys).agg(F.sum(F.col("_c") * F.col("_c") * F.col("_c") - F.col("_c")).cast("double").alias("_t"))
    ranks = ranked.groupBy(*keys).agg(F.coalesce(F.sum(F.when(side, F.col("_rank"))), F.lit(0.0)).alias("_r1"))
    rows = per.join(ranks, keys).join(ties, keys)
    zeros = (F.col("n1") + F.col("n2") - F.col("_d1") - F.col("_d2")).cast("double")
    total = F.col("_r1") + F.col("_d1") * zeros + (F.col("n1") - F.col("_d1")) * (zeros + 1) / 2
    rows = rows.withColumn("rank_sum", total).withColumn("_ties", F.col("_t") + zeros * zeros * zeros - zeros)
    out = adjusted(rank_sum_test(rows), "p", group, ["gene"])
    return out.select(*keys, "n1", "n2", "mean1", "mean2", "log2fc", "rank_sum", "z", "p", "q")


def pseudobulk(coo: DataFrame, states: DataFrame) -> DataFrame:
    """Raw counts summed over the cells of each donor and state (AGG-12)."""
    rows = states.join(coo, ["sample", "barcode"])
    size = states.groupBy("taxid", "cell_type", "sample", "infected").agg(F.count("*").alias("n_cells"))
    sums = rows.groupBy("taxid", "cell_type", "sample", "infected", "gene").agg(F.sum("value").alias("count"))
    return sums.join(size, ["taxid", "cell_type", "sample", "infected"])


def pseudobulk_groups(bulk: DataFrame, min_donors: int = 3, min_cells: int = 10, min_count: float = 10, min_samples: int = 2) -> DataFrame:
    """Donors with both states and enough cells, expressed genes, and why a group is skipped (CMP-19)."""
    group = ["taxid", "cell_type"]
    usable = bulk.where(F.col("n_cells") >= min_cells)
    donors = usable.groupBy(*group, "sample").agg(F.count_distinct("infected").alias("_states")).where("_states = 2").groupBy(*group).agg(F.count("*").alias("donors"))
    genes = usable.groupBy(*group, "gene").agg(F.count_if(F.col("count") >= min_count).alias("_n")).where(F.col("_n") >= min_samples).groupBy(*group).agg(F.count("*").alias("genes"))
    rows = bulk.select(*group).distinct().join(donors, group, "left").join(genes, group, "left").na.fill(0, ["donors", "genes"])
    reason = F.when(F.col("donors") < min_donors, "few_donors").when(F.col("genes") < 2, "few_genes")
    return rows.withColumn("skip_reason", reason)


def plate_matrix(reports: DataFrame, cells: DataFrame, rank: str = "S", min_reads: float = 10) -> DataFrame:
    """Cell x taxon counts of per-cell reports; cells without metadata are left out (CMP-12).

    ``reports(cell, taxid, rank, name, count)`` and ``cells(cell, sample)``.
    """
    rows = reports.where((F.col("rank") == rank) & (F.col("count") >= min_reads)).join(cells, "cell")
    return rows.select("sample", F.col("cell").alias("barcode"), "taxid", "rank", "name", "count")

"""Cohort statistics: diversity, distances, group tests, ordination, networks.

Re-aimed tests follow the published methods, not another program's exact numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.functions.distributions import chi2_sf, norm_cdf, spearman_ps, student_p
from taxolith.functions.draws import key_array, log_gamma, word_array
from taxolith.functions.windows import adjusted, average_rank
from taxolith.operators import geometry as G
from taxolith.operators.abundance import dense, spread, top_by, varying
from taxolith.operators.cells import rank_sum
from taxolith.plans.materialise import cut


def alpha_diversity(abundance: DataFrame) -> DataFrame:
    """Observed taxa, Shannon, Simpson, inverse Simpson and Pielou of each sample (STA-9).

    Pielou is null for at most one taxon; a sample without reads has zeros.
    """
    total = F.sum("count").over(Window.partitionBy("sample"))
    rows = abundance.withColumn("_p", F.try_divide(F.col("count").cast("double"), total))
    per = rows.groupBy("sample").agg(
        F.count_if(F.col("count") > 0).alias("observed"),
        F.coalesce(-F.sum(F.when(F.col("_p") > 0, F.col("_p") * F.log("_p"))), F.lit(0.0)).alias("shannon"),
        F.sum(F.col("_p") * F.col("_p")).alias("_d"),
    )
    some = F.col("_d") > 0
    return per.select(
        "sample", "observed", "shannon", F.when(some, 1 - F.col("_d")).otherwise(0.0).alias("simpson"), F.when(some, 1 / F.col("_d")).otherwise(0.0).alias("inverse_simpson"),
        F.when(F.col("observed") > 1, F.col("shannon") / F.log("observed")).alias("pielou"),
    )


def aitchison(abundance: DataFrame) -> DataFrame:
    """Euclidean distance of CLR values between samples (STA-10).

    From products over the taxa that both samples hold; what zeros add is in closed form.
    """
    table = G.log_ratios(abundance)
    rows = G.pair_products(table)
    square = lambda side: F.col("square_" + side) - F.col("total_" + side) * F.col("total_" + side) / table.width
    inner = F.col("dot") - F.col("total_a") * F.col("total_b") / table.width
    return rows.select("a", "b", F.sqrt(F.greatest(square("a") + square("b") - 2 * inner, F.lit(0.0))).alias("distance"))


def beta_distance(abundance: DataFrame, method: str = "bray") -> DataFrame:
    """Bray-Curtis, Jaccard (presence) or Euclidean distance between samples (STA-11).

    Only taxa that both samples hold are met; the rest follows from each sample's sums.
    """
    counts = G.summed(abundance)
    if method == "jaccard":
        counts = counts.withColumn("count", (F.col("count") > 0).cast("double"))
    rows = G.pair_products(G.sparse(counts, "sample", "taxid", F.col("count")), {"bray": ["mins"], "jaccard": ["shared"], "euclidean": ["dot"]}[method])
    both = F.col("total_a") + F.col("total_b")
    value = {
        "bray": lambda: 1 - F.try_divide(2 * F.col("mins"), both),
        "jaccard": lambda: 1 - F.try_divide(F.col("shared"), both - F.col("shared")),
        "euclidean": lambda: F.sqrt(F.greatest(F.col("square_a") + F.col("square_b") - 2 * F.col("dot"), F.lit(0.0))),
    }[method]()
    return rows.select("a", "b", F.coalesce(value, F.lit(0.0)).alias("distance"))


def axes_of(columns: G.Columns, axes: int, total: float) -> DataFrame:
    """``sample, axis, value, share`` of the leading axes; the sample farthest from the middle is on their positive side."""
    import numpy as np

    values, vectors = G.leading_axes(columns, axes)
    out = []
    for k, value in enumerate(values):
        own = vectors[:, k] * math.sqrt(value)
        own *= 1 if own[np.abs(own).argmax()] > 0 else -1
        out += [(s, k + 1, float(v), float(value / total) if total > 0 else 0.0) for s, v in zip(columns.names, own)]
    return columns.table.sparkSession.createDataFrame(out, "sample string, axis int, value double, share double")


def ordinate(abundance: DataFrame, axes: int = 2) -> DataFrame:
    """Principal coordinates of Aitchison distance: ``sample, axis, value, share`` (STA-12).

    They are the leading axes of the CLR table centred by taxon, found by subspace iteration over
    its positive cells; the driver holds the axes. ``share`` is of the whole variance.
    """
    table = G.log_ratios(abundance)
    columns = G.by_column(table, centred=True)
    n, width = len(columns.names), table.width
    # sums of squares about the taxa's means: a taxon's mean is its cells' over n, and the mean of what absent cells are
    absent = float(columns.base.mean()) if n else 0.0
    mean = F.aggregate("value", F.lit(0.0), lambda s, v: s + v) / n + absent
    held = columns.table.agg(F.coalesce(F.sum(mean * mean), F.lit(0.0)), F.count("*")).first()
    squares = table.rows.agg(F.coalesce(F.sum(F.col("square") - F.col("total") * F.col("total") / max(width, 1)), F.lit(0.0))).first()[0]
    return axes_of(columns, axes, squares - n * (held[0] + (width - held[1]) * absent * absent))


def pca(view: DataFrame, axes: int = 2) -> DataFrame:
    """PCA of samples on scaled percentages, taxa without variance left out (STA-13).

    As ``ordinate``, over the positive cells; a zero per cent needs no term, as centring takes the taxon's mean.
    """
    counts = G.summed(view)
    totals = counts.groupBy("sample").agg(F.sum("count").alias("_all"))
    percent = counts.join(totals, "sample").select("sample", "taxid", F.coalesce(F.try_divide(100 * F.col("count"), F.col("_all")), F.lit(0.0)).alias("pct"))
    n = totals.count()
    some = percent.where("pct <> 0").groupBy("taxid").agg(F.count("*").alias("_k"), F.avg("pct").alias("_m"), F.var_pop("pct").alias("_v"))
    # squares about the mean of all samples: those about the mean of the positive ones, and of the zeros
    about = F.col("_v") * F.col("_k") + F.col("_k") * (n - F.col("_k")) / n * F.col("_m") * F.col("_m")
    scaled = some.withColumn("_sd", F.sqrt(about / max(n - 1, 1))).where(F.col("_sd") > 1e-12 * F.col("_m")).select("taxid", "_sd")
    cells = percent.join(scaled, "taxid", "left").withColumn("value", F.coalesce(F.col("pct") / F.col("_sd"), F.lit(0.0)))
    columns = G.by_column(G.sparse(cells, "sample", "taxid", F.col("value")), centred=False)
    return axes_of(columns, axes, float(columns.table.count() * (n - 1)))


def group_sums(clr: DataFrame, groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, n, groups, total_ss, between_ss``: sums of squares of CLR values over all taxa by group (STA-14)."""
    rows = clr.join(groups, "sample")
    cell = rows.groupBy(*by, "taxid", "group").agg(F.sum("clr").alias("_s"), F.count("*").alias("_n"), F.sum(F.col("clr") * F.col("clr")).alias("_q"))
    taxon = cell.groupBy(*by, "taxid").agg(
        F.sum("_q").alias("_q"), F.sum(F.col("_s") * F.col("_s") / F.col("_n")).alias("_b"), F.sum("_s").alias("_s"), F.sum("_n").alias("n"), F.count("*").alias("groups")
    )
    grand = F.col("_s") * F.col("_s") / F.col("n")
    total, between = F.sum(F.col("_q") - grand).alias("total_ss"), F.sum(F.col("_b") - grand).alias("between_ss")
    return taxon.groupBy(*by).agg(F.max("n").alias("n"), F.max("groups").alias("groups"), total, between)


def usable_variables(metadata: pd.DataFrame, variables: Sequence[str], strata: str | None = None, max_levels: int = 0) -> tuple[list[str], dict[str, str]]:
    """Variables that can be tested on the rows of ``metadata``, and why the others cannot (STA-14)."""
    usable, reasons = [], {}
    limit = max_levels if max_levels > 0 else max(2, len(metadata) - 1)
    for name in variables:
        values = metadata[name]
        levels = values.dropna().nunique()
        if levels < 2:
            reasons[name] = "constant or empty"
        elif not pd.api.types.is_numeric_dtype(values) and levels > limit:
            reasons[name] = "saturated"
        elif values.isna().any():
            reasons[name] = "missing values"
        elif strata and not (metadata.groupby(strata)[name].nunique() > 1).any():
            reasons[name] = "constant within blocks"
        else:
            usable.append(name)
    return usable, reasons


def design_of(values: pd.Series):
    """Columns of a variable in a linear model: a number itself, of a name its levels but the first; booleans are names."""
    import numpy as np

    if pd.api.types.is_numeric_dtype(values) and not pd.api.types.is_bool_dtype(values):
        own = values.to_numpy(dtype=float)
        return ((own - own.mean()) / (own.std() or 1.0))[:, None]
    names = sorted(set(values.astype(str)))
    return np.stack([(values.astype(str) == v).to_numpy(dtype=float) for v in names[1:]], axis=1)


class Projections:
    """Explained sums of squares of all nested models, from the small matrices of ``geometry.projected``."""

    def __init__(self, design, total: float, products: list):
        self.plain = design.T @ design
        self.products, self.total, self.n = products, total, len(design)

    def part(self, chosen: list[int], inner) -> tuple[float, int]:
        """Sum of squares in the span of the chosen columns, and its dimension."""
        import numpy as np

        values, vectors = np.linalg.eigh(self.plain[np.ix_(chosen, chosen)])
        real = values > 1e-9 * max(values.max(), 1e-300)
        basis = vectors[:, real] / np.sqrt(values[real])
        return float(np.trace(basis.T @ inner[np.ix_(chosen, chosen)] @ basis)), int(real.sum())

    def test(self, given: list[int], own: list[int]):
        """``ss, rank, f, p`` of the columns ``own`` beyond ``given``: residuals of ``given`` are permuted and fitted anew."""
        import numpy as np

        q = len(self.plain)
        observed = self.products[0][0][q:, q:]
        before, rank_before = self.part(given, observed)
        both, rank = self.part(given + own, observed)
        df, rest_df = rank - rank_before, self.n - rank
        ss, rest = both - before, self.total - both
        if not df:
            return 0.0, 0, None, None
        f = (ss / df) / (rest / rest_df) if rest_df > 0 and rest > 1e-12 * self.total else None
        if f is None or len(self.products) < 2:
            return ss, df, f, None
        inverse = np.linalg.pinv(self.plain[np.ix_(given, given)], rcond=1e-10, hermitian=True)
        hits = 0
        for joint, crossing in self.products[1:]:
            # residuals of the given columns, moved: the moved design less its part in the given columns
            turn = np.concatenate([np.eye(q), np.zeros((q, q))], axis=1)
            turn[:, [q + k for k in given]] = -crossing[:, given] @ inverse
            inner = turn @ joint @ turn.T
            again, whole = self.part(given, inner)[0], self.part(given + own, inner)[0]
            left = self.total - before - whole
            hits += left <= 1e-12 * self.total or ((whole - again) / df) / (left / rest_df) >= f * (1 - 1e-9)
        return ss, df, f, (1 + hits) / len(self.products)

    def adjusted_r2(self, given: list[int], own: list[int]) -> float | None:
        """Adjusted share of ``own`` beyond ``given``, whose first column is the intercept."""
        import numpy as np

        observed = self.products[0][0][len(self.plain) :, len(self.plain) :]
        mean, _ = self.part(given[:1], observed)
        before, p = self.part(given, observed)
        both, m = self.part(given + own, observed)
        whole, n = self.total - mean, self.n
        if n - m <= 0 or whole <= 0:
            return None
        share = lambda ss, rank: 1 - (1 - (ss - mean) / whole) * (n - 1) / (n - rank)
        out = share(both, m) - (share(before, p) if p > 1 else 0.0)
        return float(np.clip(out, -np.inf, 1.0))


def beta_variance(
    abundance: DataFrame, metadata: DataFrame, variables: Sequence[str] | None = None, condition: Sequence[str] = (), strata: str | None = None,
    permutations: int = 999, seed: int = 1, min_samples: int = 4, max_levels: int = 0, stepwise: bool = True, enter: float = 0.05,
) -> DataFrame:
    """Variance of Aitchison distance that each metadata variable explains beyond ``condition`` (STA-14, STA-15).

    ``metadata(sample, ...)``: numeric variables enter as numbers, others by their levels. Each
    variable is projected on the CLR table after the conditions are taken out of both (the
    hat matrix of the residual design; on this distance redundancy analysis and permutational
    analysis of variance are the same). p permutes the residuals of the conditions, within the
    blocks of ``strata``, as counters of a hash decide. Returns ``variable, levels, n, r2_adj, f,
    p, permanova_r2, condition, strata, p_adj, cumulative_r2_adj``, the last by forward selection:
    the variable that raises the adjusted share most enters while its permutation p is at most
    ``enter`` and, without conditions, the share stays below that of all variables.

    Samples without a value of a condition or of ``strata`` are left out; of fewer than
    ``min_samples`` nothing is tested. Variables that are constant, saturated, have
    missing values, never change within a block, or follow from the conditions have no row
    (``usable_variables`` says why). One pass over the table serves all models and
    permutations; samples x metadata columns are on the driver, the table never is.
    """
    import numpy as np

    spark = abundance.sparkSession
    abundance = cut(G.summed(abundance))
    schema = "variable string, levels int, n int, r2_adj double, f double, p double, permanova_r2 double, condition string, strata string, p_adj double, cumulative_r2_adj double"
    meta = metadata.join(abundance.select("sample").distinct(), "sample", "left_semi").dropDuplicates(["sample"]).toPandas()  # a row per sample
    variables = [c for c in metadata.columns if c != "sample"] if variables is None else list(variables)
    nuisance = [*condition, *([strata] if strata else [])]
    unknown = [c for c in [*nuisance, *variables] if c not in meta]
    if unknown:
        raise ValueError(f"no metadata column {', '.join(unknown)}")
    meta = meta.dropna(subset=nuisance)
    meta = meta.sort_values("sample", key=lambda s: s.astype(str)).reset_index(drop=True)
    usable, _ = usable_variables(meta, [v for v in variables if v not in nuisance], strata, max_levels)
    if len(meta) < min_samples or not usable:
        return spark.createDataFrame([], schema)
    shared = spark.createDataFrame([(s,) for s in meta["sample"]], metadata.select("sample").schema)
    # taxa are those of the whole table, so a sample's log-ratios do not depend on the others
    table = G.log_ratios(abundance)
    table = table._replace(rows=table.rows.join(shared.withColumnRenamed("sample", "row"), "row", "left_semi"), cells=table.cells.join(shared.withColumnRenamed("sample", "row"), "row", "left_semi"))
    columns = G.by_column(table, centred=True)
    squares = table.rows.agg(F.sum(F.col("square") - F.col("total") * F.col("total") / max(table.width, 1))).first()[0]
    parts, places, start = [np.ones((len(meta), 1))], {}, 1
    for name in [*condition, *usable]:
        own = design_of(meta[name])
        places[name] = list(range(start, start + own.shape[1]))
        parts.append(own)
        start += own.shape[1]
    blocks = pd.factorize(meta[strata], sort=True)[0] if strata else np.zeros(len(meta), int)
    design = np.concatenate(parts, axis=1)
    fits = Projections(design, squares, G.projected(columns, design, permutations, seed, blocks))
    given = [0, *(k for c in condition for k in places[c])]
    mean = fits.part([0], fits.products[0][0][start:, start:])[0]
    rows = {}
    for name in usable:
        ss, rank, f, p = fits.test(given, places[name])
        if not rank or ss <= 1e-12 * squares:
            continue
        numeric = pd.api.types.is_numeric_dtype(meta[name]) and not pd.api.types.is_bool_dtype(meta[name])
        levels = None if numeric else int(meta[name].nunique())
        rows[name] = [name, levels, len(meta), fits.adjusted_r2(given, places[name]), f, p, ss / (squares - mean), ",".join(condition), strata or ""]
    entered = forward(fits, given, {v: places[v] for v in rows}, enter, not condition) if stepwise and len(rows) > 1 and fits.n > len(rows) + len(condition) + 1 else {}
    known = sorted((r[5], r[0]) for r in rows.values() if r[5] is not None)
    q, least = {}, 1.0
    for k in range(len(known), 0, -1):
        least = min(least, known[k - 1][0] * len(known) / k)
        q[known[k - 1][1]] = least
    return spark.createDataFrame([tuple(r) + (q.get(v), entered.get(v)) for v, r in rows.items()], schema)


def forward(fits: Projections, given: list[int], places: dict[str, list[int]], enter: float = 0.05, bounded: bool = True) -> dict[str, float]:
    """Adjusted share after each variable that enters (STA-15), in the order of entering; works on small matrices only."""
    chosen: dict[str, float] = {}
    own: list[int] = []
    whole = fits.adjusted_r2(given, [k for p in places.values() for k in p])
    best = 0.0
    while len(chosen) < len(places):
        tries = {v: fits.adjusted_r2(given, own + p) for v, p in places.items() if v not in chosen}
        tries = {v: r for v, r in tries.items() if r is not None}
        if not tries:
            break
        name = max(sorted(tries), key=tries.__getitem__)
        if tries[name] <= best or bounded and (whole is None or tries[name] > whole + 1e-9):
            break
        p = fits.test(given + own, places[name])[3]
        if p is not None and p > enter:
            break
        chosen[name] = best = tries[name]
        own = own + places[name]
    return chosen


def group_table(view: DataFrame, groups: DataFrame) -> DataFrame:
    """Per taxon: two groups by rank sum with continuity correction, more by Kruskal-Wallis; BH over taxa (STA-7).

    ``view(sample, taxid, count)`` and ``groups(sample, group)``. Only positive counts are ranked; the zeros of a taxon
    share the ranks before them, whose sums are in closed form.
    """
    members = groups.join(view.select("sample").distinct(), "sample", "left_semi").select("sample", "group")
    sizes = members.groupBy("group").agg(F.count("*").cast("double").alias("_n"))
    whole = sizes.agg(F.sum("_n").alias("n"))
    cells = G.summed(view).where("count > 0").join(members, "sample")
    ranked = average_rank(cells, "count", ["taxid"], "_rank")
    ties = ranked.groupBy("taxid", "count").agg(F.count("*").cast("double").alias("_c")).groupBy("taxid").agg(F.sum(F.col("_c") * F.col("_c") * F.col("_c") - F.col("_c")).alias("_ties"), F.sum("_c").alias("_k"))
    own = ranked.groupBy("taxid", "group").agg(F.sum("_rank").alias("_r"), F.count("*").cast("double").alias("_kg"))
    # a row for every taxon and group, of which there are few
    cell = view.select("taxid").distinct().crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(whole)).join(ties, "taxid", "left").join(own, ["taxid", "group"], "left").na.fill(0, ["_ties", "_k", "_r", "_kg"])
    zeros = F.col("n") - F.col("_k")
    cell = cell.withColumn("_r", F.col("_r") + F.col("_kg") * zeros + (F.col("_n") - F.col("_kg")) * (zeros + 1) / 2).withColumn("_ties", F.col("_ties") + zeros * zeros * zeros - zeros)
    per = cell.groupBy("taxid").agg(
        F.max("n").alias("n"), F.count("*").alias("groups"), F.min("_n").cast("long").alias("smallest"), F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_h"),
        F.min_by("_r", "group").alias("_r1"), F.min_by("_n", "group").alias("_n1"), F.max("_ties").alias("_ties"),
    )
    n = F.col("n")
    correction = 1 - F.try_divide(F.col("_ties"), n * n * n - n)
    h = F.try_divide(12 * F.col("_h") / (n * (n + 1)) - 3 * (n + 1), correction)
    u = F.col("_r1") - F.col("_n1") * (F.col("_n1") + 1) / 2 - F.col("_n1") * (n - F.col("_n1")) / 2
    sd = F.sqrt(F.col("_n1") * (n - F.col("_n1")) / 12 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.abs(u) - 0.5, F.lit(0.0)), sd)
    per = per.withColumn("statistic", F.when(F.col("groups") == 2, z).when(F.col("groups") > 2, h))
    p = F.when(F.col("groups") == 2, F.least(F.lit(1.0), 2 * norm_cdf(-F.col("statistic")))).otherwise(chi2_sf(F.col("statistic"), (F.col("groups") - 1).cast("double")))
    per = adjusted(per.withColumn("p", F.when(F.col("groups") >= 2, p)), "p", [], ["taxid"])
    return per.withColumn("note", F.when(F.col("smallest") < 3, "low n")).select("taxid", "n", "groups", "statistic", "p", "q", "note")


def group_medians(view: DataFrame, groups: DataFrame) -> DataFrame:
    """Median, mean and sum of each taxon in each group, absent cells being zero (AGG-10).

    The zeros of a taxon and group are one row with their number as its weight.
    """
    members = groups.join(view.select("sample").distinct(), "sample", "left_semi").select("sample", "group")
    sizes = members.groupBy("group").agg(F.count("*").alias("_n"))
    cells = G.summed(view).where("count <> 0").join(members, "sample").select("group", "taxid", "count", F.lit(1).cast("long").alias("_w"))
    held = cells.groupBy("group", "taxid").agg(F.count("*").alias("_k"))
    zeros = view.select("taxid").distinct().crossJoin(F.broadcast(sizes)).join(held, ["group", "taxid"], "left")  # groups are few
    zeros = zeros.select("group", "taxid", F.lit(0.0).alias("count"), (F.col("_n") - F.coalesce("_k", F.lit(0))).alias("_w"))
    rows = cells.union(zeros).where("_w > 0")
    return rows.groupBy("group", "taxid").agg(F.percentile("count", F.lit(0.5), F.col("_w")).alias("median"), (F.sum("count") / F.sum("_w")).alias("mean"), F.sum("count").alias("total"))


def pairwise_wilcoxon(view: DataFrame, groups: DataFrame, min_n: int = 2) -> DataFrame:
    """Rank sums of every pair of groups for each taxon; BH over the pairs of a taxon (STA-8)."""
    rows = dense(view).join(groups, "sample").select("taxid", "group", "count")
    sizes = groups.groupBy("group").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_n).select("group")
    pairs = sizes.select(F.col("group").alias("g1")).crossJoin(sizes.select(F.col("group").alias("g2"))).where("g1 < g2")
    both = rows.join(pairs.withColumn("group", F.explode(F.array("g1", "g2"))), "group")
    return adjusted(rank_sum(both, "count", F.col("group") == F.col("g1"), ["taxid", "g1", "g2"]), "p", ["taxid"], ["g1", "g2"])


def rarefaction(abundance: DataFrame, points: int = 20, cap: bool = False) -> DataFrame:
    """Expected taxa at rising depths: ``sample, depth, richness`` (STA-16).

    Depths are 1, 1 + step, ... with step = ceil(largest / points), up to the sample's own
    reads or, with ``cap``, the shallowest sample's. A taxon of x in N is missed at depth d
    with probability C(N - x, d) / C(N, d).
    """
    own = Window.partitionBy("sample")
    counts = abundance.where("count > 0").select("sample", F.round("count").cast("long").alias("x")).withColumn("total", F.sum("x").over(own))
    # equal counts are one term
    counts = counts.groupBy("sample", "total", "x").agg(F.count("*").alias("taxa"))
    bounds = counts.agg(F.max("total").alias("_most"), F.min("total").alias("_least"))
    rows = counts.crossJoin(F.broadcast(bounds)).withColumn("_step", F.greatest(F.lit(1), F.ceil(F.col("_most") / points)))
    top = F.least("total", "_least") if cap else F.col("total")
    rows = rows.withColumn("depth", F.explode(F.sequence(F.lit(1).cast("long"), top, F.col("_step"))))

    rows = rows.withColumn("_seen", F.col("taxa") * (1 - missed(F.col("total"), F.col("x"), F.col("depth"))))
    return rows.groupBy("sample", "depth").agg(F.sum("_seen").alias("richness"))


def missed(total: Column, x: Column, depth: Column) -> Column:
    """C(N - x, d) / C(N, d), the chance that a draw of ``depth`` of ``total`` has none of ``x``.

    From differences of Stirling's series, in which the large terms are taken out before they are worked
    out: four log-gammas of a large N leave no digit of a chance near one.
    """
    # log-gamma less (z - 1/2) ln z - z + ln(2 pi) / 2: the series from 10 on, known values below
    small = F.array(*[F.lit(math.lgamma(k) - (k - 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi)) for k in range(1, 10)])

    def rest(z: Column) -> Column:
        series = (1 / F.lit(12.0) - (1 / F.lit(360.0) - (1 / F.lit(1260.0) - 1 / F.lit(1680.0) / (z * z)) / (z * z)) / (z * z)) / z
        return F.when(z < 10, F.get(small, F.least(z, F.lit(9.0)).cast("int") - 1)).otherwise(series)

    n, m = (total + 1).cast("double"), (total - depth + 1).cast("double")
    own = x.cast("double")
    log = own * F.log1p(-depth / n) - (m - own - 0.5) * F.log1p(-own / m) + (n - own - 0.5) * F.log1p(-own / n) + rest(m) - rest(m - own) - rest(n) + rest(n - own)
    return F.when(total - x < depth, 0.0).otherwise(F.exp(log))


def decontam_prevalence(abundance: DataFrame, metadata: DataFrame, above: float = 0) -> DataFrame:
    """2 x 2 presence counts in controls and samples, and the chi-square score (STA-17).

    A taxon is present in a sample with more than ``above`` reads.

    ``metadata(sample, is_control)``. The score is the one-sided p that a taxon is more
    prevalent in samples than in controls, from the signed root of the chi-square with
    continuity correction.
    """
    whole = metadata.agg(F.count_if("is_control").alias("nc"), F.count_if(~F.col("is_control")).alias("ns"))
    seen = abundance.where(F.col("count") > above).select("sample", "taxid").distinct().join(metadata, "sample")
    per = seen.groupBy("taxid").agg(F.count_if("is_control").alias("c"), F.count_if(~F.col("is_control")).alias("s")).crossJoin(F.broadcast(whole))
    n, c, s, nc, ns = (F.col(x).cast("double") if isinstance(x, str) else x for x in ("_n", "c", "s", "nc", "ns"))
    per = per.withColumn("_n", F.col("nc") + F.col("ns"))
    cross = s * (nc - c) - c * (ns - s)
    chi = F.try_divide(n * F.pow(F.greatest(F.abs(cross) - n / 2, F.lit(0.0)), 2), (s + c) * (n - s - c) * ns * nc)
    per = per.withColumn("chi2", F.coalesce(chi, F.lit(0.0))).withColumn("_z", F.signum(cross) * F.sqrt("chi2"))
    return per.withColumn("p_prevalence", norm_cdf(F.col("_z"))).drop("_n", "_z")


def decontam_frequency(abundance: DataFrame, metadata: DataFrame) -> DataFrame:
    """How far a taxon's frequency falls with concentration: ``taxid, n, ss_contaminant, ss_real, p_frequency`` (STA-17).

    ``metadata(sample, conc)``. log(frequency) is fitted by intercept - log(conc) and by an
    intercept alone, both closed forms of sums; the score is the F tail of their residuals.
    """
    own = Window.partitionBy("sample")
    rows = abundance.withColumn("_f", F.col("count") / F.sum("count").over(own)).where("_f > 0").join(metadata.where("conc > 0"), "sample")
    rows = rows.withColumn("_y", F.log("_f")).withColumn("_t", F.log("_f") + F.log("conc"))
    per = rows.groupBy("taxid").agg(F.count("*").alias("n"), (F.var_pop("_t") * F.count("*")).alias("ss_contaminant"), (F.var_pop("_y") * F.count("*")).alias("ss_real"))
    from taxolith.functions.distributions import incomplete_beta, vectorised

    tail = vectorised(lambda ratio, df: incomplete_beta(df / 2, df / 2, ratio / (1 + ratio)))
    ratio = F.try_divide(F.col("ss_contaminant"), F.col("ss_real"))
    return per.withColumn("p_frequency", F.when(F.col("n") > 2, tail(ratio, (F.col("n") - 1).cast("double"))))


def decontam(abundance: DataFrame, metadata: DataFrame, method: str = "prevalence", combine: str = "minimum", threshold: float = 0.1) -> DataFrame:
    """Contaminant scores, by batch where ``metadata`` has a batch, combined over batches and methods (STA-17)."""
    batches = [r[0] for r in metadata.select("batch").distinct().collect()] if "batch" in metadata.columns else [None]
    parts = None
    for b in batches:  # few by nature
        own = metadata if b is None else metadata.where(F.col("batch").eqNullSafe(F.lit(b)))
        rows = abundance.join(own.select("sample"), "sample", "left_semi")
        scores = []
        if method in ("prevalence", "combined"):
            scores.append(decontam_prevalence(rows, own).select("taxid", F.col("p_prevalence").alias("p")))
        if method in ("frequency", "combined"):
            scores.append(decontam_frequency(rows, own).select("taxid", F.col("p_frequency").alias("p")))
        for s in scores:
            s = s.withColumn("batch", F.lit(b).cast("string"))
            parts = s if parts is None else parts.unionByName(s)
    p = F.col("p")
    if combine == "minimum":
        score = F.min(p)
    elif combine == "product":
        score = F.exp(F.sum(F.log(F.greatest(p, F.lit(1e-300)))))
    else:
        score = None
    if score is None:
        per = parts.groupBy("taxid").agg((-2 * F.sum(F.log(F.greatest(p, F.lit(1e-300))))).alias("_x"), F.count("p").alias("_k"))
        per = per.withColumn("score", chi2_sf(F.col("_x"), (2 * F.col("_k")).cast("double"))).drop("_x", "_k")
    else:
        per = parts.groupBy("taxid").agg(score.alias("score"))
    return per.withColumn("contaminant", F.col("score") < threshold)


def clr_group_test(abundance: DataFrame, groups: DataFrame, reference: str, draws: int = 128, seed: int = 1) -> DataFrame:
    """Monte-Carlo CLR test of two groups: ``taxid, effect, p, q`` averaged over draws (STA-18).

    Every draw turns a sample's counts plus one half into Gamma variates, which are counters of
    a hash of draw, sample and taxon, so partitions do not matter; CLR, Welch's test and BH
    follow for each.
    """
    spark = abundance.sparkSession
    table = cut(dense(cut(G.summed(abundance))).join(groups, "sample"))
    # a taxon's samples are in one task before they are drawn, so no draw is shuffled; few bytes, much work: tasks are not joined
    dealt = table.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "taxid")
    cells = dealt.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    counter = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ("draw", "sample", "taxid")])
    cells = cells.withColumn("_log", log_gamma(F.col("count") + 0.5, counter))
    means = cut(cells.groupBy("draw", "sample").agg(F.avg("_log").alias("_mean")))  # draws x samples numbers; a second pass makes the same variates
    cells = cells.join(F.broadcast(means), ["draw", "sample"]).withColumn("clr", F.col("_log") - F.col("_mean"))
    rows = welch(cells, "clr", F.col("group") != reference, ["draw", "taxid"])
    rows = adjusted(rows, "p", ["draw"], ["taxid"])
    return rows.groupBy("taxid").agg(F.avg("difference").alias("effect"), F.avg("p").alias("p"), F.avg("q").alias("q"))


def welch(df: DataFrame, value: str, group: Column, by: Sequence[str]) -> DataFrame:
    """Welch's t of group against rest: ``by, difference, t, df, p``."""
    rows = df.withColumn("_g", group)
    side = lambda g, f: f(F.when(F.col("_g") == g, F.col(value)))
    per = rows.groupBy(*by).agg(
        side(True, F.avg).alias("_m1"), side(False, F.avg).alias("_m2"), side(True, F.var_samp).alias("_v1"), side(False, F.var_samp).alias("_v2"),
        side(True, F.count).cast("double").alias("_n1"), side(False, F.count).cast("double").alias("_n2"),
    )
    a, b = F.try_divide(F.col("_v1"), F.col("_n1")), F.try_divide(F.col("_v2"), F.col("_n2"))
    per = per.withColumn("difference", F.col("_m1") - F.col("_m2")).withColumn("t", F.try_divide(F.col("difference"), F.sqrt(a + b)))
    per = per.withColumn("df", F.try_divide((a + b) * (a + b), a * a / (F.col("_n1") - 1) + b * b / (F.col("_n2") - 1)))
    return per.withColumn("p", student_p(F.col("t"), F.col("df"))).drop("_m1", "_m2", "_v1", "_v2", "_n1", "_n2")


def size_factors(counts: DataFrame) -> DataFrame:
    """``sample, factor``: median ratio to the geometric mean of genes seen in all samples (STA-19)."""
    n = counts.select("sample").distinct().agg(F.count("*").alias("_samples"))
    positive = counts.where("count > 0").withColumn("_log", F.log("count"))
    means = positive.groupBy("gene").agg(F.avg("_log").alias("_mean"), F.count("*").alias("_n")).crossJoin(F.broadcast(n)).where("_n = _samples").select("gene", "_mean")
    return positive.join(means, "gene").groupBy("sample").agg(F.exp(F.median(F.col("_log") - F.col("_mean"))).alias("factor"))


def gene_test(counts: DataFrame, groups: DataFrame, reference: str, block: str | None = None, alpha: float = 0.05, min_lfc: float = 1.0) -> DataFrame:
    """Welch's t on log2 normalised counts, on paired differences within ``block`` if given (STA-19)."""
    from taxolith.operators.abundance import dense as fill

    wide = fill(counts, "gene").join(size_factors(counts), "sample").join(groups, "sample")
    wide = wide.withColumn("_v", F.log2(F.col("count") / F.col("factor") + 1))
    side = F.col("group") != reference
    if block:
        pairs = wide.groupBy("gene", block).agg(F.avg(F.when(side, F.col("_v"))).alias("_x"), F.avg(F.when(~side, F.col("_v"))).alias("_y")).withColumn("_d", F.col("_x") - F.col("_y"))
        per = pairs.groupBy("gene").agg(F.avg("_d").alias("difference"), F.stddev_samp("_d").alias("_sd"), F.count("_d").cast("double").alias("_n"))
        per = per.withColumn("t", F.try_divide(F.col("difference"), F.col("_sd") / F.sqrt("_n"))).withColumn("df", F.col("_n") - 1)
        per = per.withColumn("p", student_p(F.col("t"), F.col("df"))).drop("_sd", "_n")
    else:
        per = welch(wide, "_v", side, ["gene"])
    per = adjusted(per, "p", [], ["gene"])
    return per.withColumn("significant", (F.col("q") < alpha) & (F.abs("difference") >= min_lfc))


def log_ratio_variance(abundance: DataFrame) -> DataFrame:
    """``a, b, variance`` of log(x_a / x_b) over samples, zeros counted as one half (STA-20).

    From the taxa's sums, squares and products over samples; logarithms are taken from that of one
    half, so absent cells add nothing.
    """
    table, n = half_logs(abundance)
    if n < 2:
        return G.row_pairs(table, {}).select("a", "b", F.lit(None).cast("double").alias("variance"))
    return G.row_pairs(table, {"variance": pair_variance(n)})


def half_logs(abundance: DataFrame) -> tuple[G.Sparse, int]:
    """Logarithms of counts and one half over that of one half by taxon and sample, and the number of samples."""
    counts = cut(G.summed(abundance))
    n = counts.where("sample is not null").select("sample").distinct().count()
    return G.sparse(counts, "taxid", "sample", F.when(F.col("sample").isNotNull(), F.log(F.col("count") + 0.5) - F.log(F.lit(0.5))), n), n


def pair_variance(n: int) -> Callable:
    """Variance of the difference of two rows of ``row_pairs`` over ``n`` columns, from its arrays."""

    def variance(pairs: dict):
        import numpy as np

        apart = pairs["total_a"] - pairs["total_b"]
        return np.maximum(pairs["square_a"] + pairs["square_b"] - 2 * pairs["dot"] - apart * apart / n, 0.0) / (n - 1)

    return variance


def sparcc(abundance: DataFrame) -> DataFrame:
    """Correlations of basis abundances from log-ratio variances: ``a, b, rho`` (STA-20).

    Basis variances are the closed form of the sums t_i of log-ratio variances,
    ``w_i = (t_i - T / (2 (d - 1))) / (d - 2)`` with T the sum of all t; no taxa are excluded in turn.
    The sum t_i follows from the taxon's own squares and its products with the samples' sums, so that
    pairs are made once, as they leave, and kept nowhere.
    """
    table, n = half_logs(abundance)
    if n < 2:
        return G.row_pairs(table, {}).select("a", "b", F.lit(None).cast("double").alias("rho"))
    cells = table.cells.where("row is not null")
    sums = cells.groupBy("col").agg(F.sum("value").alias("_c"))
    middle = sums.agg((F.sum("_c") / n).alias("_mean"))
    beside = cells.join(F.broadcast(sums.crossJoin(F.broadcast(middle))), "col").groupBy("row").agg(F.sum(F.col("value") * (F.col("_c") - F.col("_mean"))).alias("_beside"))
    each = table.rows.where("row is not null").join(beside, "row", "left").na.fill(0.0, ["_beside"]).withColumn("_own", F.col("square") - F.col("total") * F.col("total") / n)
    each = cut(each)  # a row per taxon, read for its sums too
    whole = each.agg(F.sum("_own").alias("_all"), F.count("*").alias("_d"))
    each = each.crossJoin(F.broadcast(whole)).withColumn("_t", F.greatest(F.col("_d") * F.col("_own") + F.col("_all") - 2 * F.col("_beside"), F.lit(0.0)) / (n - 1))
    each = cut(each)
    every = each.agg(F.sum("_t").alias("_every"))
    basis = F.try_divide(F.col("_t") - F.try_divide(F.col("_every"), 2.0 * (F.col("_d") - 1)), F.col("_d") - 2)
    rows = each.crossJoin(F.broadcast(every)).select("row", "total", "square", F.greatest(basis, F.lit(1e-4)).alias("basis"))
    variance = pair_variance(n)

    def rho(pairs: dict):
        import numpy as np

        a, b = pairs["basis_a"], pairs["basis_b"]
        return np.clip((a + b - variance(pairs)) / (2 * np.sqrt(a * b)), -1.0, 1.0)

    return G.row_pairs(table._replace(rows=rows), {"rho": rho}, ("total", "square", "basis"))


def basis_correlations(logs):
    """Correlations of basis abundances from logarithms (taxa x samples), as ``sparcc`` has them, for all pairs of taxa."""
    import numpy as np

    d, n = logs.shape
    moved = logs - logs.mean(axis=1, keepdims=True)
    inner = moved @ moved.T / (n - 1)
    own = np.diag(inner)
    variance = own[:, None] + own[None, :] - 2 * inner
    np.fill_diagonal(variance, 0.0)
    t = variance.sum(axis=1)
    w = np.maximum((t - t.sum() / (2.0 * (d - 1))) / (d - 2), 1e-4)
    return np.clip((w[:, None] + w[None, :] - variance) / (2 * np.sqrt(w[:, None] * w[None, :])), -1.0, 1.0)


def sparcc_bootstrap(abundance: DataFrame, reps: int = 100, seed: int = 1, groups: int = 16) -> DataFrame:
    """``a, b, rho, p``: share of tables, every taxon shuffled by itself, with a correlation as large (STA-20).

    The positive cells go to ``groups`` tasks, each of which makes its replicates one after the other by
    matrix products; the order of a taxon's values in a replicate follows from counters of a
    hash. A task holds taxa x samples numbers, so ``abundance`` is to be cut to some hundred taxa
    first, as ``network`` does. Fewer than three taxa or two samples give no rows.
    """
    names = abundance.select("sample").distinct()
    cells = G.summed(abundance).select("taxid", "sample", "count").union(names.select(F.lit(None).cast("string"), "sample", F.lit(0.0)))
    dealt = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(groups, "part").sortWithinPartitions("part", "taxid", "sample")
    kind = abundance.schema["taxid"].dataType.simpleString()

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        parts: dict = {}
        for batch in batches:
            for taxid, sample, count, part in zip(*(c.to_pylist() for c in batch.columns)):
                parts.setdefault(part, []).append((taxid, sample, count))
        samples = taxa = None
        for part in sorted(parts):
            if samples is None:
                samples = sorted({s for _, s, _ in parts[part]})
                taxa = sorted({t for t, _, _ in parts[part] if t is not None})
                if len(taxa) < 3 or len(samples) < 2:
                    return
                at_sample, at_taxon = {s: k for k, s in enumerate(samples)}, {t: k for k, t in enumerate(taxa)}
                logs = np.full((len(taxa), len(samples)), np.log(0.5))
                for t, s, c in parts[part]:
                    if t is not None:
                        logs[at_taxon[t], at_sample[s]] = np.log(c + 0.5)
                first, second = np.triu_indices(len(taxa), 1)
                own, of_taxa, of_samples = basis_correlations(logs)[first, second], key_array(taxa)[:, None], key_array(samples)
            hits, made = np.zeros(len(first), np.int64), 0
            for rep in range(part, reps, groups):
                order = np.argsort(word_array(seed, rep, of_taxa, of_samples), axis=1, kind="stable")
                hits += np.abs(basis_correlations(np.take_along_axis(logs, order, axis=1))[first, second]) >= np.abs(own) - 1e-9
                made += 1
            columns = [[taxa[k] for k in first], [taxa[k] for k in second], own, hits, np.full(len(first), made)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "rho", "hits", "made"])

    found = dealt.select("taxid", "sample", "count", "part").mapInArrow(compute, f"a {kind}, b {kind}, rho double, hits long, made long")
    return found.groupBy("a", "b").agg(F.max("rho").alias("rho"), ((1 + F.sum("hits")) / (1 + F.sum("made"))).alias("p"))


def feasible(n: int, tests: int, alpha: float = 0.05, reps: int | None = None) -> bool:
    """Whether the least p that n samples, or ``reps`` resamplings, can give would pass BH over all tests (STA-21)."""
    least = 1.0 / reps if reps else (2.0 / math.factorial(n) if n <= 12 else 0.0)
    return least <= alpha / max(tests, 1)


def host_microbe(host: DataFrame, microbes: DataFrame, max_genes: int | None = None, max_taxa: int | None = None, min_samples: int = 3, alpha: float = 0.05, check: bool = True) -> DataFrame:
    """Rank correlations of all host genes and microbes over shared samples (CMP-20, JOI-5, JOI-10).

    ``host(sample, gene, count)`` and ``microbes(sample, taxid, count)``. Features that are too rare or constant
    are not tested; ``max_genes`` and ``max_taxa`` are for a caller who wants the most spread genes and the most abundant taxa alone. Every
    feature is ranked once and pairs are products of ranks; a grid that no p could pass is refused before it is run.
    """
    # both are read several times, and a sum a cell is little beside what it may come from
    host = cut(host.groupBy("sample", "gene").agg(F.sum("count").alias("count")))
    microbes = cut(microbes.groupBy("sample", "taxid").agg(F.sum("count").alias("count")))
    shared = host.select("sample").distinct().intersect(microbes.select("sample").distinct()).where("sample is not null")
    n = shared.count()
    if n < 3:
        raise ValueError(f"{n} samples are shared by both tables; at least 3 are needed")
    genes = feature_ranks(host.join(F.broadcast(shared), "sample", "left_semi"), "gene", n, min_samples, spread("log_cpm", n), max_genes)
    taxa = feature_ranks(microbes.join(F.broadcast(shared), "sample", "left_semi"), "taxid", n, min_samples, F.sum("count"), max_taxa)
    if check:
        tests = genes.rows.count() * taxa.rows.count()
        if not feasible(n, tests, alpha):
            raise ValueError(f"no p over {n} samples could pass {tests} tests")

    def rho(pairs: dict):
        import numpy as np

        a, b = pairs["total_a"], pairs["total_b"]
        own = (n * pairs["square_a"] - a * a) * (n * pairs["square_b"] - b * b)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(own > 0, np.clip((n * pairs["dot"] - a * b) / np.sqrt(own), -1.0, 1.0), np.nan)

    rows = G.row_pairs(genes, {"rho": rho, "p": lambda pairs: spearman_ps(rho(pairs), n)}, other=taxa)
    known = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    rows = rows.select(F.col("a").alias("gene"), F.col("b").alias("taxid"), F.lit(n).cast("long").alias("n"), known("rho"), known("p"))
    return adjusted(rows, "p", [], ["gene", "taxid"])


def feature_ranks(counts: DataFrame, feature: str, n: int, min_samples: int, measure: Column, most: int | None) -> G.Sparse:
    """Ranks of log2(CPM + 1) over ``n`` samples of each feature that varies, less that of its zeros.

    Zeros share one rank, so they add nothing and need no rows; shifting all ranks of a feature changes no correlation.
    """
    totals = counts.groupBy("sample").agg(F.sum("count").alias("_total"))
    cells = counts.where("count > 0").join(F.broadcast(totals), "sample").withColumn("log_cpm", F.log2(1e6 * F.col("count") / F.col("_total") + 1))
    cells = cells.join(varying(counts, feature, "count", min_samples, n), feature, "left_semi")
    if most is not None:
        cells = cells.join(F.broadcast(top_by(cells, feature, measure, most)).select(feature), feature, "left_semi")
    cells = average_rank(cells.where("log_cpm > 0"), "log_cpm", [feature]).withColumn("_zeros", n - F.count("*").over(Window.partitionBy(feature)))
    cells = cut(cells.select(feature, "sample", (F.col("rank") + (F.col("_zeros") - 1) / 2).alias("_above")))
    return G.sparse(cells, feature, "sample", F.col("_above"), n)


def network(abundance: DataFrame, min_prevalence: float = 0.5, min_reads: float = 10, top: int = 200, reps: int = 100, min_rho: float = 0.3, alpha: float = 0.05) -> DataFrame:
    """Edges of the co-abundance network: BH once over all pairs, then a least correlation (CMP-21)."""
    samples = abundance.select("sample").distinct().agg(F.count("*").alias("_all"))
    per = abundance.groupBy("taxid").agg(F.count_if(F.col("count") > 0).alias("_n"), F.sum("count").alias("_r")).crossJoin(F.broadcast(samples))
    kept = per.where((F.col("_n") / F.col("_all") >= min_prevalence) & (F.col("_r") >= min_reads)).orderBy(F.desc("_r"), "taxid").limit(top).select("taxid")
    rows = sparcc_bootstrap(abundance.join(F.broadcast(kept), "taxid", "left_semi"), reps)
    edges = adjusted(rows, "p", [], ["a", "b"])
    return edges.withColumn("edge", (F.col("q") <= alpha) & (F.abs("rho") >= min_rho))

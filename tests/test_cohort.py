"""Ordination and permutation tests against plain arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxolith.functions.distributions import spearman_p, spearman_ps
from taxolith.functions.draws import key_array, log_gamma, word_array
from taxolith.operators import cohort as CO
from taxolith.operators import geometry as G

SAMPLES, TAXA = 9, 7


@pytest.fixture(scope="module")
def counts():
    draw = np.random.default_rng(3)
    table = draw.poisson(20, (SAMPLES, TAXA)) * (draw.random((SAMPLES, TAXA)) > 0.2)
    table[:4, 0] += 60  # the first group
    return table + np.eye(SAMPLES, TAXA, dtype=int)


@pytest.fixture(scope="module")
def view(spark, counts):
    rows = [(f"s{i}", f"t{j}", float(counts[i, j])) for i in range(SAMPLES) for j in range(TAXA) if counts[i, j]]
    return spark.createDataFrame(rows, "sample string, taxid string, count double")


def clr(counts):
    least = np.where(counts > 0, counts, np.inf).min(axis=1, keepdims=True)
    logs = np.log(np.where(counts > 0, counts, least / 2))
    return logs - logs.mean(axis=1, keepdims=True)


def scores(rows, axes=2):
    got = np.zeros((SAMPLES, axes))
    for r in rows:
        got[int(r["sample"][1:]), r["axis"] - 1] = r["value"]
    return got


def expected_scores(matrix, axes=2):
    u, s, _ = np.linalg.svd(matrix, full_matrices=False)
    return (u * s)[:, :axes], (s**2 / (s**2).sum())[:axes]


def same_up_to_sign(a, b):
    return all(min(np.abs(a[:, k] - b[:, k]).max(), np.abs(a[:, k] + b[:, k]).max()) < 1e-8 for k in range(a.shape[1]))


def test_ordinate(view, counts):
    rows = CO.ordinate(view).collect()
    values = clr(counts)
    want, share = expected_scores(values - values.mean(axis=0))
    assert same_up_to_sign(scores(rows), want)
    assert sorted({round(r["share"], 9) for r in rows}, reverse=True) == pytest.approx(share)


def test_pca(view, counts):
    rows = CO.pca(view).collect()
    percent = 100 * counts / counts.sum(axis=1, keepdims=True)
    want, share = expected_scores((percent - percent.mean(axis=0)) / percent.std(axis=0, ddof=1))
    assert same_up_to_sign(scores(rows), want)
    assert sorted({round(r["share"], 9) for r in rows}, reverse=True) == pytest.approx(share)


def test_axes_of_more_samples_than_vectors(spark):
    """Subspace iteration proper: 70 samples, 26 vectors."""
    draw = np.random.default_rng(7)
    table = draw.poisson(np.exp(draw.normal(0, 1, (70, 3)) @ draw.normal(0, 0.8, (3, 40)) + 1.5))
    rows = [(f"s{i:02}", f"t{j:02}", float(table[i, j])) for i in range(70) for j in range(40) if table[i, j]]
    df = spark.createDataFrame(rows, "sample string, taxid string, count double").repartition(5)
    values = clr(table)
    want, share = expected_scores(values - values.mean(axis=0), 3)
    got = np.zeros((70, 3))
    found = CO.ordinate(df, axes=3).collect()
    for r in found:
        got[int(r["sample"][1:]), r["axis"] - 1] = r["value"]
    assert same_up_to_sign(got, want)
    assert sorted({round(r["share"], 9) for r in found}, reverse=True) == pytest.approx(share)


def test_axes_of_small_and_empty_tables(spark):
    schema = "sample string, taxid string, count double"
    assert CO.ordinate(spark.createDataFrame([], schema)).collect() == []
    assert CO.ordinate(spark.createDataFrame([("s", "t", 1.0)], schema)).collect() == []
    two = CO.ordinate(spark.createDataFrame([("s", "t", 1.0), ("r", "u", 5.0), ("r", "t", 0.0)], schema)).collect()
    assert {r["sample"]: r["axis"] for r in two} == {"r": 1, "s": 1} and two[0]["share"] == pytest.approx(1)


@pytest.mark.parametrize("block", [2, 256])
def test_pair_products_in_blocks(spark, counts, view, block, monkeypatch):
    monkeypatch.setattr(G, "WIDE", 3)
    odd = view.union(spark.createDataFrame([("empty", "t0", 0.0), (None, "t1", 4.0)], view.schema))
    got = {(r["a"], r["b"]): r for r in G.pair_products(G.sparse(odd, "sample", "taxid", F.col("count")), ["dot", "mins", "shared"], block).collect()}
    names = sorted([f"s{i}" for i in range(SAMPLES)] + ["empty"])
    table = {f"s{i}": counts[i] for i in range(SAMPLES)} | {"empty": np.zeros(TAXA)}
    assert sorted(got) == [(a, b) for a in names for b in names if a < b]
    for (a, b), r in got.items():
        x, y = table[a], table[b]
        assert (r["dot"], r["mins"], r["shared"]) == pytest.approx((x @ y, np.minimum(x, y).sum(), ((x > 0) & (y > 0)).sum()))
        assert (r["total_a"], r["square_b"]) == pytest.approx((x.sum(), (y * y).sum()))


def test_row_pairs_in_chunks(spark):
    draw = np.random.default_rng(5)
    table = draw.poisson(3, (45, 6)) * (draw.random((45, 6)) > 0.4)
    table[7] = 0
    rows = [(f"r{i:02}", f"c{j}", float(table[i, j])) for i in range(45) for j in range(6)] + [(None, "c1", 4.0)]
    view = spark.createDataFrame(rows, "row string, col string, count double").repartition(3)
    own = G.sparse(view, "row", "col", F.col("count"))
    got = G.row_pairs(own, {"dot": lambda p: p["dot"], "far": lambda p: p["total_a"] - p["square_b"], "one": lambda p: np.float64(1)}).collect()
    want = {(f"r{i:02}", f"r{j:02}"): (table[i] @ table[j], table[i].sum() - (table[j] ** 2).sum(), 1) for i in range(45) for j in range(i + 1, 45)}
    assert len(got) == len(want) and {(r["a"], r["b"]): (r["dot"], r["far"], r["one"]) for r in got} == want
    # every row of one table with every one of another, which has a column more and numbers as names
    few = [(k, f"c{j}", float(k + j)) for k in range(3) for j in range(1, 7)]
    other = G.sparse(spark.createDataFrame(few, "row int, col string, count double"), "row", "col", F.col("count"))
    got = G.row_pairs(other, {"dot": lambda p: p["dot"], "total_b": lambda p: p["total_b"]}, ["total"], own).collect()
    want = {(k, f"r{i:02}"): (sum((k + j) * table[i, j] for j in range(1, 6)), table[i].sum()) for k in range(3) for i in range(45)}
    assert len(got) == len(want) and {(r["a"], r["b"]): (r["dot"], r["total_b"]) for r in got} == want
    nothing = own._replace(cells=own.cells.where("false"))
    assert [r["dot"] for r in G.row_pairs(nothing, {"dot": lambda p: p["dot"]}).collect()] == [0.0] * (45 * 44 // 2)
    assert G.row_pairs(own._replace(rows=own.rows.where("false")), {}).collect() == []


def shuffled(spark) -> int:
    """Rows that the session has written for shuffles."""
    context, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    stages = context.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_cells_without_a_sample_are_no_part_of_variances(spark, view):
    odd = view.union(spark.createDataFrame([(None, "t1", 4.0), (None, "t0", 9.0)], view.schema))
    want, got = ({(r["a"], r["b"]): r["variance"] for r in CO.log_ratio_variance(v).collect()} for v in (view, odd))
    assert got == pytest.approx(want)


@pytest.mark.parametrize("method", [CO.log_ratio_variance, CO.sparcc])
def test_no_cells_are_copied_for_pairs(spark, monkeypatch, method):
    """What is shuffled grows with the cells and not with the blocks of rows that they meet."""
    monkeypatch.setattr(G, "BLOCK", 20)
    monkeypatch.setattr(G, "MOST", 20)
    draw = np.random.default_rng(9)
    table = draw.poisson(20, (400, 6)) + 1
    view = spark.createDataFrame([(f"s{j}", f"t{i:03}", float(table[i, j])) for i in range(400) for j in range(6)], "sample string, taxid string, count double").repartition(4).cache()
    view.count()
    before = shuffled(spark)
    assert len(method(view).collect()) == 400 * 399 // 2
    assert shuffled(spark) - before < 10 * 2400


def test_p_of_many_rank_correlations():
    for n in (2, 3, 5, 13, 40):
        rho = np.array([[-1.0, 1.0, 0.0], [0.25, -0.25, np.nan]])
        want = [np.nan if r != r else spearman_p(r, n) for r in rho.ravel()]
        assert spearman_ps(rho, n).ravel() == pytest.approx(want, nan_ok=True)


def test_host_microbe_tests_all_pairs(spark):
    """More taxa than 50 and more genes than 2000; ties, zeros and features that are not tested."""
    draw = np.random.default_rng(11)
    n = 13
    genes, taxa = draw.poisson(4, (2004, n)), draw.poisson(2, (53, n)) + np.eye(53, n, dtype=int)
    genes[0], genes[1, 2:], taxa[1] = 0, 0, 7  # never, too seldom, constant counts
    genes[2], genes[3] = 5 * taxa[2] + 1, np.arange(n) + 1
    rows = lambda table, p: [(f"s{j:02}", f"{p}{i:04}", float(table[i, j])) for i in range(len(table)) for j in range(n) if table[i, j] or i % 2]
    host = spark.createDataFrame([*rows(genes, "g"), ("alone", "g0005", 9.0)], "sample string, gene string, count double")
    microbes = spark.createDataFrame(rows(taxa, "t"), "sample string, taxid string, count double")

    def ranks(table):
        x = np.log2(1e6 * table / table.sum(axis=0) + 1)
        low, same = (x[:, None, :] < x[:, :, None]).sum(axis=2), (x[:, None, :] == x[:, :, None]).sum(axis=2)
        keep = ((table > 0).sum(axis=1) >= 3) & (table.min(axis=1) < table.max(axis=1))
        return keep, low + (same + 1) / 2

    (some_g, rank_g), (some_t, rank_t) = ranks(genes), ranks(taxa)
    centred = lambda r: r - r.mean(axis=1, keepdims=True)
    inner = centred(rank_g) @ centred(rank_t).T
    with np.errstate(divide="ignore", invalid="ignore"):
        rho = inner / np.sqrt((centred(rank_g) ** 2).sum(axis=1)[:, None] * (centred(rank_t) ** 2).sum(axis=1))
    got = CO.host_microbe(host, microbes).collect()
    assert sorted((r["gene"], r["taxid"]) for r in got) == [(f"g{i:04}", f"t{j:04}") for i in np.flatnonzero(some_g) for j in np.flatnonzero(some_t)]
    assert some_g.sum() > 2000 and some_t.sum() > 50 and {r["n"] for r in got} == {n}
    at = [(int(r["gene"][1:]), int(r["taxid"][1:])) for r in got]
    assert np.allclose([r["rho"] for r in got], [rho[k] for k in at], atol=1e-12)
    p = np.array([r["p"] for r in got])
    for k in range(0, len(got), 5000):
        assert p[k] == pytest.approx(spearman_p(got[k]["rho"], n))
    order = np.argsort(p)
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    assert np.allclose(np.array([r["q"] for r in got])[order], np.minimum(q, 1))
    few = CO.host_microbe(host, microbes, max_genes=10, max_taxa=5)
    assert few.count() == 50 and few.select("taxid").distinct().count() == 5


def test_host_microbe_of_constant_shares(spark):
    """Counts that vary with the depth alone have no rank correlation."""
    host = spark.createDataFrame([(f"s{j}", "g", float(j)) for j in range(1, 14)], "sample string, gene string, count double")
    microbes = spark.createDataFrame([(f"s{j}", f"t{i}", float(1 + i * j % 7)) for j in range(1, 14) for i in (1, 2)], "sample string, taxid string, count double")
    assert [(r["taxid"], r["n"], r["rho"], r["p"], r["q"]) for r in CO.host_microbe(host, microbes).orderBy("taxid").collect()] == [(t, 13, None, None, None) for t in ("t1", "t2")]


def test_missed_chance_of_large_tables(spark):
    from fractions import Fraction

    cases = [(n, x, d) for n in (9, 40, 3000, 180_000_000, 9_000_000_000) for x in (1, 3, 8) for d in (1, 5, n // 20 + 1, n // 3, n - x, n - 1) if d >= 1]
    rows = spark.createDataFrame(cases, "n long, x long, d long")
    for n, x, d, p in rows.select("n", "x", "d", CO.missed(F.col("n"), F.col("x"), F.col("d"))).collect():
        want = Fraction(1)
        for k in range(x):
            want *= Fraction(max(n - d - k, 0), n - k)
        assert p == pytest.approx(float(want), rel=0, abs=1e-12)


def test_sparcc_keeps_no_pairs(spark, counts, view, monkeypatch):
    """What it writes down is a row per taxon or cell; only results of pairs leave their task."""
    kept = []
    plain = CO.cut
    monkeypatch.setattr(CO, "cut", lambda df: kept.append(plain(df)) or kept[-1])
    got = {(r["a"], r["b"]): r["rho"] for r in CO.sparcc(view).collect()}
    assert all(not {"a", "b"} <= set(df.columns) and df.count() <= SAMPLES * TAXA for df in kept)
    names = sorted(f"t{j}" for j in range(TAXA))
    logs = np.log(np.array([[counts[i][int(t[1:])] for i in range(SAMPLES)] for t in names]) + 0.5)
    want = CO.basis_correlations(logs)
    assert got == pytest.approx({(a, b): want[i, j] for i, a in enumerate(names) for j, b in enumerate(names) if i < j})
    assert CO.log_ratio_variance(view).columns == ["a", "b", "variance"]


@pytest.mark.parametrize("method", [lambda v: CO.aitchison(v), lambda v: CO.log_ratio_variance(v), lambda v: CO.beta_distance(v, "bray")])
def test_distances_fill_no_grid(view, method):
    plan = method(view)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Cartesian" not in plan and "Join Inner, true" not in plan


def hat(*designs):
    u, s, _ = np.linalg.svd(np.column_stack([np.ones(len(designs[0])) if designs else [], *designs]) if designs else np.ones((SAMPLES, 1)), full_matrices=False)
    u = u[:, s > 1e-9]
    return u @ u.T


def levels_of(values):
    return [np.array([v == x for v in values], float) for x in sorted(set(values))[1:]]


def plain_test(values, given, own, moves):
    """Share, F and p of designs beyond others by explicit projection and by moving rows of residuals."""
    n = len(values)
    before, both = hat(np.ones(n), *given), hat(np.ones(n), *given, *own)
    rank = lambda h: round(np.trace(h))
    e = values - before @ values
    df, rest_df = rank(both) - rank(before), n - rank(both)

    def statistic(table):
        table = table - before @ table
        ss = ((both @ table) ** 2).sum()
        return (ss / df) / (((table**2).sum() - ss) / rest_df)

    f = statistic(e)
    p = (1 + sum(statistic(e[m]) >= f * (1 - 1e-9) for m in moves)) / (1 + len(moves))
    centred = values - values.mean(axis=0)
    whole = (centred**2).sum()
    ss = lambda h: ((h @ centred) ** 2).sum()
    share = lambda h: 1 - (1 - ss(h) / whole) * (n - 1) / (n - rank(h))
    return {"f": f, "p": p, "permanova_r2": (ss(both) - ss(before)) / whole, "r2_adj": share(both) - (share(before) if given else 0)}


def moves_of(reps, blocks):
    keys = key_array([f"s{i}" for i in range(SAMPLES)])
    out = []
    for number in range(1, reps + 1):
        places, sources = G.permutation(1, number, keys, np.array(blocks))
        move = np.empty(SAMPLES, int)
        move[places] = sources
        assert all(blocks[k] == blocks[m] for k, m in enumerate(move)) and sorted(move) == list(range(SAMPLES))
        out.append(move)
    return out


SITE = [0.5, 1.5, 1.0, 4.0, 2.0, 2.5, 6.0, 3.0, 0.1]
ARM = ["a", "a", "b", "a", "c", "b", "c", "b", "a"]
BATCH = ["x", "y", "x", "y", "x", "y", "x", "y", "x"]


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [(f"s{i}", SITE[i], ARM[i], BATCH[i], "one", f"u{i}", None if i == 2 else "z" + BATCH[i], "p" + BATCH[i]) for i in range(SAMPLES)]
    return spark.createDataFrame(rows + [("absent", 1.0, "a", "x", "one", "u", "z", "p")], "sample string, site double, arm string, batch string, same string, unique string, holes string, twin string")


def test_variance_of_numbers_and_names(view, counts, metadata):
    got = {r["variable"]: r for r in CO.beta_variance(view, metadata, permutations=60).collect()}
    assert sorted(got) == ["arm", "batch", "site", "twin"]  # constant, saturated and incomplete variables have no row
    values, moves = clr(counts), moves_of(60, [0] * SAMPLES)
    for name, own in {"site": [np.array(SITE)], "arm": levels_of(ARM), "batch": levels_of(BATCH)}.items():
        for key, want in plain_test(values, [], own, moves).items():
            assert got[name][key] == pytest.approx(want), (name, key)
    assert got["arm"]["levels"] == 3 and got["site"]["levels"] is None
    ordered = sorted((r["p"], r["variable"]) for r in got.values())
    assert got[ordered[-1][1]]["p_adj"] == ordered[-1][0]


def test_variance_beyond_conditions_within_blocks(view, counts, metadata):
    rows = CO.beta_variance(view, metadata, ["arm", "site", "twin"], condition=["batch"], strata="batch", permutations=60).collect()
    got = {r["variable"]: r for r in rows}
    assert sorted(got) == ["arm", "site"]  # the twin follows from the condition
    values, moves = clr(counts), moves_of(60, [int(b == "y") for b in BATCH])
    for name, own in {"site": [np.array(SITE)], "arm": levels_of(ARM)}.items():
        for key, want in plain_test(values, levels_of(BATCH), own, moves).items():
            assert got[name][key] == pytest.approx(want), (name, key)
    assert {(r["condition"], r["strata"], r["n"]) for r in rows} == {("batch", "batch", SAMPLES)}


def test_forward_selection(view, counts, metadata):
    got = {r["variable"]: r["cumulative_r2_adj"] for r in CO.beta_variance(view, metadata, ["site", "arm"], condition=["batch"], permutations=30, enter=1.0).collect()}
    values, designs = clr(counts), {"site": [np.array(SITE)], "arm": levels_of(ARM)}
    own, best, want = [], 0.0, dict.fromkeys(designs)
    while len(own) < 2:
        tries = {v: plain_test(values, levels_of(BATCH), [c for o in [*own, v] for c in designs[o]], [])["r2_adj"] for v in designs if v not in own}
        name = max(tries, key=tries.get)
        if tries[name] <= best:
            break
        own.append(name)
        want[name] = best = tries[name]
    assert {k: v is None for k, v in got.items()} == {k: v is None for k, v in want.items()}
    assert all(got[k] == pytest.approx(want[k]) for k in want if want[k] is not None)


def test_variance_is_refused_or_empty(view, metadata):
    with pytest.raises(ValueError, match="no metadata column nowhere"):
        CO.beta_variance(view, metadata, ["nowhere"])
    assert CO.beta_variance(view, metadata.where("sample < 's3'"), ["site"], min_samples=4).collect() == []
    assert CO.beta_variance(view, metadata, ["same", "unique"]).collect() == []


def test_why_variables_are_left_out(metadata):
    usable, reasons = CO.usable_variables(metadata.toPandas().iloc[:SAMPLES], ["site", "same", "unique", "holes", "twin"], strata="batch")
    assert usable == ["site"]
    assert reasons == {"same": "constant or empty", "unique": "saturated", "holes": "missing values", "twin": "constant within blocks"}


def test_network_counts_replicates_like_a_loop(spark, view, counts):
    got = {(r["a"], r["b"]): r for r in CO.sparcc_bootstrap(view, reps=21, groups=4).collect()}
    logs = np.log(counts.T + 0.5)
    own = CO.basis_correlations(logs)
    hits = np.zeros((TAXA, TAXA))
    taxa, samples = key_array([f"t{j}" for j in range(TAXA)]), key_array([f"s{i}" for i in range(SAMPLES)])
    for rep in range(21):
        moved = np.stack([logs[j][np.argsort(word_array(1, rep, taxa[j], samples), kind="stable")] for j in range(TAXA)])
        hits += np.abs(CO.basis_correlations(moved)) >= np.abs(own) - 1e-9
    assert len(got) == TAXA * (TAXA - 1) // 2
    for (a, b), r in got.items():
        assert r["p"] == pytest.approx((1 + hits[int(a[1:]), int(b[1:])]) / 22) and r["rho"] == pytest.approx(own[int(a[1:]), int(b[1:])])


def test_gamma_variates_follow_their_law(spark):
    for shape in (0.5, 3.0, 400.5):
        x = np.exp([r[0] for r in spark.range(6000).select(log_gamma(F.lit(shape), F.concat(F.lit("t:"), F.col("id").cast("string")))).collect()])
        assert abs(x.mean() - shape) < 5 * np.sqrt(shape / 6000) and abs(x.var() / shape - 1) < 0.25


def test_group_tests_with_zeros_left_out(spark, view, counts):
    """Ranks, ties, medians and means of tables whose zeros have no rows equal those of the filled ones."""
    labels = ["a", "b", "c", "a", "b", "c", "a", "b", "c"]
    extra = spark.createDataFrame([("s0", "never", 0.0), ("other", "t1", 9.0)], view.schema)
    groups = spark.createDataFrame([(f"s{i}", g) for i, g in enumerate(labels)] + [("unseen", "a")], "sample string, group string")
    table = {f"t{j}": counts[:, j].astype(float) for j in range(TAXA)} | {"never": np.zeros(SAMPLES)}

    def ranks(x):
        return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])

    for three in (True, False):
        own = [i for i in range(SAMPLES) if three or labels[i] != "c"]
        names = sorted({labels[i] for i in own})
        got = {r["taxid"]: r for r in CO.group_table(view.union(extra), groups if three else groups.where("group <> 'c'")).collect()}
        assert sorted(got) == sorted(table)
        for taxid, values in table.items():
            x, n = values[own], len(own)
            r, (_, c) = ranks(x), np.unique(x, return_counts=True)
            ties = float((c**3 - c).sum())
            sums = {g: sum(r[k] for k, i in enumerate(own) if labels[i] == g) for g in names}
            sizes = {g: sum(labels[i] == g for i in own) for g in names}
            if three:
                h = 12 * sum(v * v / sizes[g] for g, v in sums.items()) / (n * (n + 1)) - 3 * (n + 1)
                want = h / (1 - ties / (n**3 - n)) if ties < n**3 - n else None
            else:
                u = sums["a"] - sizes["a"] * (sizes["a"] + 1) / 2 - sizes["a"] * sizes["b"] / 2
                sd = np.sqrt(sizes["a"] * sizes["b"] / 12 * (n + 1 - ties / (n * (n - 1))))
                want = max(abs(u) - 0.5, 0) / sd if sd else None
            assert got[taxid]["n"] == n and got[taxid]["statistic"] == (want if want is None else pytest.approx(want)), (taxid, three)
    medians = {(r["group"], r["taxid"]): r for r in CO.group_medians(view.union(extra), groups).collect()}
    assert sorted(medians) == sorted((g, t) for g in "abc" for t in table)
    for (g, taxid), r in medians.items():
        x = table[taxid][[i for i in range(SAMPLES) if labels[i] == g]]
        assert (r["median"], r["mean"], r["total"]) == pytest.approx((np.median(x), x.mean(), x.sum()))

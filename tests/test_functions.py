import collections
import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from taxolith.functions import distributions as D
from taxolith.functions import scalar as S
from taxolith.functions import windows as W


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_scalars(spark):
    assert one(spark, "Escherichia coli (taxid 562)", S.taxid_of) == "562" and one(spark, "562", S.taxid_of) == "562" and one(spark, "none", S.taxid_of) is None
    runs = one(spark, "9606:3 A:2 |:| 0:5", S.kmer_runs)
    assert [(r.taxid, r.n) for r in runs] == [("9606", 3), (None, 2), ("0", 5)]
    assert one(spark, "12:1 9606:4", lambda c: S.carries_host(c, "9606")) and not one(spark, "19606:4", lambda c: S.carries_host(c, "9606"))
    assert one(spark, "AACCCCGT", S.longest_run) == 4 and one(spark, "", S.longest_run) == 0
    assert one(spark, "GGATTAAC", lambda c: S.at_tract(c, 5)) and not one(spark, "GGATTAAC", lambda c: S.at_tract(c, 3, mixed=False))
    assert one(spark, "ACGTNACGTA", lambda c: S.kmers_at(c, F.lit(0), F.lit(7), 4)) == ["ACGT", "ACGT", "CGTA"]
    assert [t.tile for t in one(spark, "ABCDEFG", lambda c: S.tiles(c, 3, 2))] == ["ABC", "CDE", "EFG"]
    assert one(spark, "ATGGCCTAA", S.translate) == "MA" and one(spark, "ATGTAAGCC", S.translate) is None and one(spark, "ATGG", S.translate) is None
    assert one(spark, "g__Escherichia_coli!", S.plain_name) == "escherichia coli"
    assert one(spark, "UniRef90_A|g__Alpha.s__Alpha_beta", S.stratum_taxon) == "Alpha beta" and one(spark, "UniRef90_A", S.stratum_taxon) is None
    assert one(spark, "S1", S.rank_word) == "species" and one(spark, "genus", S.rank_word) == "genus" and one(spark, "F", S.rank_word) is None
    assert one(spark, "phylum", S.rank_code) == "P"
    row = one(spark, "/d/Pt01.Visit2.host1.hisat2.summary.log", S.pass_of)
    assert (row.sample, row.label) == ("Pt01.Visit2", "host1")
    assert one(spark, 12, lambda c: S.nearest(c, [5, 10, 15]), "int") == 10
    assert one(spark, "RNA-Seq", lambda c: S.library_molecule(c, F.lit(None).cast("string"))) == "rna"


def test_distributions_at_known_values():
    assert abs(D.student_two_sided(2.228, 10) - 0.05) < 1e-4
    assert abs(D.normal_quantile(0.975) - 1.959964) < 1e-6 and abs(D.normal_cdf(1.959964) - 0.975) < 1e-6
    assert abs(D.chi_square_tail(3.841459, 1) - 0.05) < 1e-6 and abs(D.chi_square_tail(18.307, 10) - 0.05) < 1e-4
    assert abs(D.fisher_greater_p(3, 1, 1, 3) - 17 / 70) < 1e-12
    assert abs(D.hypergeometric_upper(2, 10, 5, 4) + D.hypergeometric_lower(1, 10, 5, 4) - 1) < 1e-12
    assert D.spearman_p(1.0, 5) == 2 / math.factorial(5)


def test_shuffles_keep_composition():
    read = "ACGTACGGTTACGATTTACCAGGTACGT"
    pairs = lambda s: collections.Counter(zip(s, s[1:]))
    for seed in range(30):
        assert pairs(D.shuffled(read, seed, "dinuc")) == pairs(read)
        assert collections.Counter(D.shuffled(read, seed, "mono")) == collections.Counter(read)
    assert D.shuffled(read, 3, "dinuc") == D.shuffled(read, 3, "dinuc") and D.shuffled(read, 1, "reverse") == read[::-1]


def test_adjustment_and_ranks(spark):
    rows = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", None)], "k string, p double")
    bh = {r.k: r.q for r in W.adjusted(rows, "p", [], ["k"]).collect()}
    assert bh["d"] is None and abs(bh["a"] - 0.03) < 1e-12 and abs(bh["b"] - 0.04) < 1e-12 and abs(bh["c"] - 0.04) < 1e-12
    holm = {r.k: r.q for r in W.adjusted(rows, "p", [], ["k"], "holm").collect()}
    assert abs(holm["a"] - 0.03) < 1e-12 and abs(holm["c"] - 0.06) < 1e-12 and abs(holm["b"] - 0.06) < 1e-12
    ranked = W.average_rank(spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 7.0)], "g int, v double"), "v", ["g"]).collect()
    assert sorted(r["rank"] for r in ranked) == [1.5, 1.5, 3.0]


def test_incomplete_beta_against_sums():
    """For whole parameters it is a binomial tail, which sums of exact fractions give."""
    import numpy as np

    for a, b, num, den in [(1, 1, 1, 3), (2, 5, 1, 4), (7, 3, 4, 5), (30, 40, 2, 5), (200, 3, 97, 100), (1, 90, 1, 100), (500, 500, 51, 100)]:
        n, x = a + b - 1, Fraction(num, den)
        exact = sum(math.comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(a, n + 1))
        assert abs(D.incomplete_beta(a, b, num / den) - float(exact)) < 1e-11, (a, b)
    assert D.incomplete_beta(2.5, 3.5, 0.0) == 0.0 and D.incomplete_beta(2.5, 3.5, 1.0) == 1.0
    many = D.incomplete_beta(np.array([1.0, 2.0]), np.array([1.0, 5.0]), np.array([1 / 3, 0.25]))
    assert many.shape == (2,) and abs(many[0] - 1 / 3) < 1e-12


def test_shuffles_keep_pairs_of_letters():
    """Every dinucleotide stays as often, also over a wide alphabet, and the shuffles of a short read are all met."""
    for text in ("ACGTACGGTCA", "AAAA", "AB", "the quick brown fox jumps over the lazy dog " * 20):
        for seed in range(20):
            out = D.shuffled(text, seed, "dinuc")
            assert Counter(zip(text, text[1:])) == Counter(zip(out, out[1:])) and out[0] == text[0] and out[-1] == text[-1]
    seen = Counter(D.shuffled("ABACA", seed, "dinuc") for seed in range(2000))
    assert set(seen) == {"ABACA", "ACABA"} and min(seen.values()) > 850


def test_adjustment_over_ranges_of_large_families(spark):
    """Equal to running extremes over each whole family, wherever ranges cut it; no task gets a whole table."""
    import numpy as np

    draw = np.random.default_rng(4)
    rows = [(g, int(k), None if draw.random() < 0.02 else float(np.round(draw.random() ** 3, 3))) for g in ("one", "two", None) for k in range(900 if g else 50)]
    df = spark.createDataFrame(rows, "g string, k int, p double")

    def plain(values, method):
        values = sorted(values)
        m, out, best = len(values), {}, None
        for i in range(m, 0, -1) if method == "bh" else range(1, m + 1):
            p, k = values[i - 1]
            own = p * m / i if method == "bh" else min(1.0, (m - i + 1) * p)
            best = own if best is None else min(best, own) if method == "bh" else max(best, own)
            out[k] = min(1.0, best)
        return out

    for method in ("bh", "holm"):
        for by in (["g"], []):
            made = W.adjusted(df, "p", by, ["k", "g"], method)
            families = {}
            for g, k, p in rows:
                if p is not None:
                    families.setdefault(g if by else 0, []).append((p, (k, g is not None, g or "")))
            want = {key: q for own in families.values() for key, q in plain(own, method).items()}
            if not by:
                want = plain(families[0], method)
            got = {(r["k"], r["g"] is not None, r["g"] or ""): r["q"] for r in made.collect()}
            assert len(got) == len(rows)
            for g, k, p in rows:
                key = (k, g is not None, g or "")
                assert (got[key] is None) if p is None else got[key] == pytest.approx(want[key])
        assert "SinglePartition" not in made._jdf.queryExecution().executedPlan().toString()
    assert W.adjusted(df.where("false"), "p", [], ["k"]).collect() == []

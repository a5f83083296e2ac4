"""How often the queries of findings read lineitem, and what they carry along."""

import os

import pytest

from taxolith.functions import windows as W
from taxolith.operators import cohort as CO
from taxolith.operators import evidence as E
from taxolith.operators import explore as X
from taxolith.operators import geometry as G
from taxolith.operators import reads as R
from taxolith.queries import cohorts, core, formats, reads, statistics  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def scans(df) -> int:
    return sum("Relation [" in line and "l_orderkey" in line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n"))


@needs_tables
@pytest.mark.parametrize("name, most", [("cmp20_host_microbe", 2), ("sta18_clr_group_test", 1), ("sta15_stepwise", 1), ("cmp33_stratified_search", 1), ("cmp5_contig_evidence", 1), ("cmp27_marker_candidates", 2), ("cmp28_select_markers", 3)])
def test_lineitem_is_read_seldom(spark, monkeypatch, name, most):
    read = []
    plain = W.cut
    for module in (W, CO, E, G, X, statistics):
        monkeypatch.setattr(module, "cut", lambda df: read.append(scans(df)) or plain(df), raising=False)
    out = core.QUERIES[name](spark, FOLDER)
    own = {"cmp5_contig_evidence": 1}.get(name, 0)  # the reads of taxa come from the abundance
    assert sum(read) + scans(out) <= most + own


@needs_tables
def test_biom_cells_carry_no_lists(spark):
    plan = core.QUERIES["snk4_biom"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2


def test_windows_are_bounded_and_hold_each_k_mer_once(monkeypatch):
    monkeypatch.setattr(R, "LETTERS", 16)
    texts = ["abcdefghij" * 7, "", "abc", "abcd", "xyzxyzxyz", "0123456789012345"]
    got = []
    for numbers, starts, parts in R.windows(texts, 4):
        assert sum(map(len, parts)) <= 16 + 3
        got += [(n, s + j, p[j : j + 4]) for n, s, p in zip(numbers, starts, parts) for j in range(len(p) - 3)]
    assert sorted(got) == sorted((n, j, t[j : j + 4]) for n, t in enumerate(texts) for j in range(len(t) - 3))


def test_n50_of_rows_that_stand_for_many(spark):
    rows = spark.createDataFrame([("a", 5, 3), ("a", 9, 1), ("a", 2, 4), ("b", 1, 1)], "k string, length long, c long")
    assert {tuple(r) for r in W.n50(rows, ["k"], "length", "c").collect()} == {("a", 5), ("b", 1)}

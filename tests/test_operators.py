"""Facts of the reference fixtures, on DataFrames."""

import pytest
from pyspark.sql import functions as F

from taxolith.operators import abundance as A
from taxolith.operators import accounting as AC
from taxolith.operators import cells as C
from taxolith.operators import evidence as E
from taxolith.operators import explore as X
from taxolith.operators import lineage as L
from taxolith.operators import reads as R
from taxolith.plans.filtering import apply_filters


def flat(spark, table, totals=None):
    """``{taxid: {sample: count}}`` as long rows with fractions."""
    samples = {s for row in table.values() for s in row}
    totals = totals or {s: sum(row.get(s, 0) for row in table.values()) for s in samples}
    rows = [(s, t, f"Taxon {t}", "S", float(n), n / totals[s]) for t, row in table.items() for s, n in row.items()]
    return spark.createDataFrame(rows, "sample string, taxid string, name string, rank string, count double, frac double")


def cell(df, column):
    return {(r.taxid, r["sample"]): round(r[column], 9) for r in df.collect()}


def test_two_drop_lists_then_thresholds(spark):
    table = {"9606": {"S1": 500, "S2": 100}, "1001": {"S1": 300, "S2": 450}, "1002": {"S1": 100, "S2": 300}, "1003": {"S1": 100, "S2": 150}}
    lists = {"a": spark.createDataFrame([("9606",)], "taxid string"), "b": spark.createDataFrame([("1003",)], "taxid string")}
    out = apply_filters(flat(spark, table), lists, min_rel=0.001)
    assert cell(out.filtered, "frac") == {("1001", "S1"): 0.75, ("1002", "S1"): 0.25, ("1001", "S2"): 0.6, ("1002", "S2"): 0.4}
    assert cell(out.filtered, "count")[("1001", "S1")] == 300 and {r.taxid for r in out.drops.collect()} == {"9606", "1003"}


def test_second_pass_carries_the_denominator(spark):
    rows = flat(spark, {"1": {"S1": 6000}, "2": {"S1": 3000}, "3": {"S1": 5}, "4": {"S1": 995}}, {"S1": 10000})
    kept, removed = A.filter_abundance(rows, min_rel=0.001)
    assert {r.taxid for r in removed.collect()} == {"3"} and cell(kept, "frac")[("1", "S1")] == 0.6
    again, _ = A.drop_taxa(kept, spark.createDataFrame([("4",)], "taxid string"))
    assert cell(again, "frac") == {("1", "S1"): round(6000 / 9005, 9), ("2", "S1"): round(3000 / 9005, 9)}


def test_virus_floor(spark):
    rows = flat(spark, {"1": {"S1": 9995}, "10239": {"S1": 5}})
    kept, _ = A.filter_abundance(rows, min_rel=0.001)
    assert {r.taxid for r in kept.collect()} == {"1"}
    kept, _ = A.filter_abundance(rows, min_rel=0.001, viruses=spark.createDataFrame([("10239",)], "taxid string"), virus_floor=0.0)
    assert {r.taxid for r in kept.collect()} == {"1", "10239"}


CONTROLS = {
    "100": {"S1": 500000, "S2": 400000, "NC1": 1}, "200": {"S1": 5000, "S2": 5000, "NC1": 50, "NC2": 50},
    "300": {"S1": 445000, "S2": 594950, "NC1": 9948, "NC2": 9950}, "400": {"S1": 50000, "S2": 50, "NC1": 1},
}


def test_control_filter(spark):
    rows = flat(spark, CONTROLS)
    controls = spark.createDataFrame([("NC1",), ("NC2",)], "sample string")
    out, evidence, drop, dropped = A.control_filter(rows, controls, ratio=10.0, min_reads=2)
    verdicts = {r.taxid: (r.verdict, r.kept_in, r.zeroed_in) for r in evidence.collect()}
    assert verdicts == {"100": ("kept", 2, 0), "200": ("control_level_everywhere", 0, 2), "300": ("control_level_everywhere", 0, 2), "400": ("control_level_somewhere", 1, 1)}
    assert {r.taxid for r in drop.collect()} == {"200", "300"}
    assert {(r.taxid, r["sample"]) for r in dropped.collect()} == {("200", "S1"), ("200", "S2"), ("300", "S1"), ("300", "S2"), ("400", "S2")}
    frac = cell(out, "frac")
    assert frac[("100", "S1")] == round(500000 / 550000, 9) and frac[("400", "S1")] == round(50000 / 550000, 9) and frac[("100", "S2")] == 1.0 and frac[("300", "NC1")] == 0.9948


def test_ubiquitous_taxa_are_condemned_first(spark):
    evidence, _ = A.control_verdicts(flat(spark, CONTROLS), spark.createDataFrame([("NC1",)], "sample string"), prevalence=1.0)
    verdicts = {r.taxid: (r.verdict, r.level) for r in evidence.collect()}
    assert verdicts["300"] == ("ubiquitous", None) and verdicts["400"][0] != "ubiquitous"


def test_minimizer_verdicts(spark):
    rows = [("1001", 10, 50, 2), ("1002", 200, 40, 5), ("1003", 500, 50000, 200), ("1004", 100000, 1500000, 5000), ("1005", 1000, 20000, 2000)]
    reports = spark.createDataFrame([("S", t, "S", t, float(r), float(d), float(m), m / d, None) for t, r, m, d in rows], "sample string, taxid string, rank string, name string, reads double, distinct double, observed double, duplication double, coverage double")
    sizes = spark.createDataFrame([("1001", 1000.0), ("1002", 100000.0), ("1003", 1000.0), ("1004", 10000.0), ("1005", 100000.0)], "taxid string, clade_minimizers double")
    verdict = lambda **o: {r.taxid: r.verdict for r in E.minimizer_filter(reports, sizes, max_duplication=100.0, **o).collect()}
    assert verdict() == {"1001": "below_read_gate", "1002": "few_distinct", "1003": "high_duplication", "1004": "kept", "1005": "kept"}
    assert verdict(duplication_coverage=0.0)["1004"] == "high_duplication"


def test_lineage_of_reports(spark):
    names = [("root", 0), ("A", 1), ("B", 2), ("C", 3), ("D", 2), ("E", 4), ("F", 1), ("top2", 0), ("G", 2)]
    rows = spark.createDataFrame([("S", k, d, t) for k, (t, d) in enumerate(names)], "sample string, pos int, depth int, taxid string")
    got = {r.taxid: r.ancestors for r in L.with_lineage(rows, 6).collect()}
    assert got == {"root": [], "A": ["root"], "B": ["root", "A"], "C": ["root", "A", "B"], "D": ["root", "A"], "E": ["root", "A", "D"], "F": ["root"], "top2": [], "G": ["top2"]}


def test_closure_with_a_cycle(spark):
    tree = spark.createDataFrame([("1", "1"), ("2", "1"), ("3", "2"), ("4", "3"), ("5", "4"), ("x", "y"), ("y", "x")], "taxid string, parent string")
    got = {r.taxid: r.ancestors for r in L.closure(tree).collect()}
    assert got["5"] == ["1", "2", "3", "4"] and got["1"] == [] and got["x"] == ["y"] and got["y"] == ["x"]


def test_read_accounting(spark):
    trimming = spark.createDataFrame([("Pt01.Visit2", 2200, 2000), ("ONT01", 550, 500)], "sample string, raw_reads long, trimmed_reads long")
    logs = spark.createDataFrame([("Pt01.Visit2", "host", True, 1000, 600), ("Pt01.Visit2", "univec", True, 600, 590), ("ONT01", "host", False, 500, 320)], "sample string, label string, paired boolean, total long, unaligned long")
    rows = {r["sample"]: r for r in AC.account_reads(trimming, logs).collect()}
    r = rows["Pt01.Visit2"]
    assert (r.host_input, r.host_aligned, r.host_unaligned, r.univec_aligned, r.host_removed, r.nonhost, r.nonhost_pct_of_raw) == (2000, 800, 1200, 20, 820, 1180, 53.64)
    assert (rows["ONT01"].host_aligned, rows["ONT01"].nonhost) == (180, 320)
    derived = AC.derive_accounting(AC.account_reads(trimming, logs))
    fate = AC.read_fate(derived).groupBy("sample").agg(F.sum("reads").alias("n")).collect()
    assert {r["sample"]: r.n for r in fate} == {"Pt01.Visit2": 2200, "ONT01": 550}


def test_derived_accounting(spark):
    """Passes in their order, fragments as mates, what was classified before what a log says."""
    trimming = spark.createDataFrame([("P", 3000, 2800), ("S", 100, 90), ("N", 70, 60)], "sample string, raw_reads long, trimmed_reads long")
    passes = [("P", "host", True, 500, 450), ("P", "host2", True, 900, 800), ("P", "host10", True, 800, 500), ("P", "univec", True, 450, 440), ("S", "host", False, 80, 50)]
    logs = spark.createDataFrame(passes, "sample string, label string, paired boolean, total long, unaligned long")
    rrna = spark.createDataFrame([("P", 999, 2800), ("N", 12, 60)], "sample string, rrna_reads long, rrna_input_reads long")
    classified = spark.createDataFrame([("P", 300, 100, 30)], "sample string, classified_reads long, unclassified_reads long, host_carryover_reads long")
    rows = AC.derive_accounting(AC.account_reads(trimming, logs, rrna, classified))
    got = {r["sample"]: r for r in rows.collect()}
    p, s, n = got["P"], got["S"], got["N"]
    assert (p.host_input, p.host_unaligned, p.nonhost, p.per_fragment) == (1800, 900, 880, 2)
    assert (p.nonhost_reads, p.host_removed_reads, p.rrna_removed_reads, p.rrna_pct) == (800, 1000, 1000, 35.71)
    assert (p.classified_pct, p.host_carryover_pct, p.nonhost_pct_of_raw) == (75.0, 7.5, 26.67)
    assert (s.nonhost_reads, s.host_removed_reads, s.rrna_removed_reads, s.classified_pct, s.nonhost_pct_of_raw) == (50, 30, None, 0.0, 50.0)
    assert (n.nonhost_reads, n.host_removed_reads, n.rrna_removed_reads, n.rrna_pct) == (60, 0, 12, 20.0)
    fates = {(r["sample"], r.fate): r.reads for r in AC.read_fate(rows).collect()}
    assert [fates["P", f] for f in AC.FATES] == [200, 1000, 1000, 600, 200] and fates["S", "nonhost_unclassified"] == 50


def test_rpm_without_a_size_is_null(spark):
    rows = flat(spark, {"1": {"S1": 500, "S2": 5}})
    got = cell(A.rpm_total(rows, spark.createDataFrame([("S1", 2000000, 0)], "sample string, raw_reads long, trimmed_reads long")).na.fill(-1.0, ["rpm"]), "rpm")
    assert got == {("1", "S1"): 250.0, ("1", "S2"): -1.0}


def test_runs(spark):
    rows = spark.createDataFrame([(0, "SRR1", "", None, "a \n b"), (1, "SRR1", "E", "X", "c"), (2, "SRR2", "E2", "X2", "d")], "pos int, run string, experiment string, sample string, title string")
    got = {r.run: r for r in AC.clean_runs(rows).collect()}
    assert got["SRR1"].title == "a b" and got["SRR1"].experiment == got["SRR1"]["sample"] == "SRR1" and len(got) == 2
    with pytest.raises(Exception, match="not a run id"):
        AC.clean_runs(spark.createDataFrame([(0, "An error occurred", "", "", "")], rows.schema)).collect()


def test_enrichment_keeps_samples_apart(spark):
    """Simpson's paradox: the type is no richer in any sample, but it would be if samples were pooled."""
    cells, hits = [], []
    for sample, n_type, n_other, rate in (("A", 80, 20, 0.5), ("B", 20, 80, 0.1)):
        for k in range(n_type + n_other):
            kind = "T" if k < n_type else "O"
            cells.append((sample, f"{sample}{k}", kind, 1.0))
            if (k if kind == "T" else k - n_type) < rate * (n_type if kind == "T" else n_other):
                hits.append((sample, f"{sample}{k}", "7"))
    rows = C.enrichment(spark.createDataFrame(hits, "sample string, barcode string, taxid string"), spark.createDataFrame(cells, "sample string, barcode string, cell_type string, host_umis double"))
    assert all(abs(r.log2fc) < 1e-9 and r.p > 0.3 for r in rows.collect())


def test_kmer_denoise(spark):
    rows = [("100", f"b{k}", 10 * k, 8 * k) for k in range(1, 7)] + [("200", f"b{k}", 10 * k, 5) for k in range(1, 7)] + [("300", "b1", 3, 3)]
    got = {r.taxid: r.verdict for r in C.kmer_denoise(spark.createDataFrame(rows, "taxid string, barcode string, total long, distinct long")).collect()}
    assert got == {"100": "kept", "200": "saturated_distinct", "300": "untested_few_barcodes"}


def test_shuffle_compare(spark):
    real = spark.createDataFrame([("S", "0", 900), ("S", "1", 100), ("S", "7", 50), ("S", "8", 40), ("S", "9", 5), ("X", "7", 1)], "sample string, taxid string, reads long")
    fake = spark.createDataFrame([("S", "0", 999), ("S", "1", 1), ("S", "7", 20)], "sample string, taxid string, reads long")
    got = {r.taxid: r.verdict for r in E.shuffle_compare(real, fake).collect()}
    assert got == {"7": "composition_only", "8": "clean", "9": "untested_low_depth"}


def test_no_query_of_many_is_dropped(spark):
    names = spark.createDataFrame([(f"s__Genus{k} species{k}",) for k in range(0, 12_000, 100)] + [("Xa y",)], "name string")
    asked = spark.range(12_000).select(F.concat(F.lit("genus"), F.col("id").cast("string"), F.lit(" species"), F.col("id").cast("string")).alias("query"))
    more = spark.createDataFrame([("a",), ("xa z",), ("nothing",), ("",)], "query string")
    got = {(r.query, r.name, r.strategy) for r in X.match_names(names, asked.union(more)).collect()}
    assert {(f"genus{k} species{k}", f"s__Genus{k} species{k}", "exact") for k in range(0, 12_000, 100)} <= got
    assert ("a", "Xa y", "substring") in got and ("xa z", "Xa y", "genus") in got
    assert not any(q in ("nothing", "") for q, _, _ in got)


def test_deep_trees(spark):
    """Neither the walk to the parents nor an indented report forgets distant ancestors."""
    from taxolith.operators.lineage import closure, with_lineage

    chain = spark.createDataFrame([(str(k), str(k - 1) if k else None) for k in range(100)], "taxid string, parent string")
    own = {r.taxid: r.ancestors for r in closure(chain).collect()}
    assert own["99"] == [str(k) for k in range(99)] and own["0"] == []
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "taxid string, parent string")
    assert {r.taxid: r.ancestors for r in closure(ring).collect()}["a"] == ["c", "b"]
    report = spark.createDataFrame([("S", k, k, f"t{k}") for k in range(60)], "sample string, pos int, depth int, taxid string")
    deep = {r.taxid: r.ancestors for r in with_lineage(report).collect()}
    assert deep["t59"] == [f"t{k}" for k in range(59)]
    with pytest.raises(Exception, match="deeper than 40"):
        with_lineage(report, max_depth=40).collect()


def test_report_texts_of_any_depth(spark):
    lines = [f"0.1\t1\t1\tS\t{k}\t{'  ' * k}n{k}" for k in range(1, 61)] + ["bad line", "0.1\t1\t1\tS\tx\tno number", "0.1\t1\t1\tG\t99\t    side"]
    rows = {r.taxid: r for r in L.parse_reports(spark.createDataFrame([("a", "\n".join(lines)), ("b", None), ("c", "")], "sample string, text string")).collect()}
    assert len(rows) == 61 and len(rows["60"].ancestors) == 59 and rows["99"].ancestors == ["1", "2"] and rows["99"].name == "side"


def test_group_columns(spark):
    assert X.group_columns(None) == [] and X.group_columns(spark.createDataFrame([("s", "g")], "sample string, site string")) == ["site"]


def test_kmer_evidence_against_all_k_mers(spark):
    """Super-k-mers count what a row per k-mer would, for any barcode number; the flag says when some are cut."""
    import random

    from taxolith.functions.kmers import codes_of, super_kmers
    from taxolith.operators.cells import kmer_evidence

    draw, k = random.Random(2), 15
    core = "".join(draw.choice("ACGT") for _ in range(60))
    rows, want = [], {}
    for n in range(200):
        seq = "".join(draw.choice("ACGT") for _ in range(draw.randint(5, 90)))
        seq = seq[:20] + core[: draw.randint(0, 60)] + ("N" if n % 7 == 0 else "") + seq[20:] + "A" * (n % 40)
        total = max(len(seq) - k + 1, 0)
        first, skip = total // 3, total // 4
        runs = f"7:{first} 0:{skip} 7:{total - first - skip}"
        taxid, barcode = ("7", "8")[n % 2], f"b{n % 13}" if n % 10 else None
        rows.append((taxid, barcode, seq, runs if n % 11 else None, f"r{n}"))
        if taxid == "7" and n % 11:
            words = [seq[j : j + k] for j in range(total) if (j < first or j >= first + skip) and "N" not in seq[j : j + k]]
            if words:
                want.setdefault(barcode, []).extend(words)
    reads = spark.createDataFrame(rows, "taxid string, barcode string, seq string, runs string, read_id string")
    got = {r["barcode"]: (r["total"], r["distinct"], r["capped"]) for r in kmer_evidence(reads, k).collect()}
    assert got == {b: (len(w), len(set(w)), False) for b, w in want.items()}
    near = {r["barcode"]: (r["total"], r["distinct"]) for r in kmer_evidence(reads, k, sketch=True).collect()}
    assert all(near[b][0] == t and abs(near[b][1] - d) <= 0.05 * d + 1 for b, (t, d, _) in got.items())
    few = kmer_evidence(reads.where("barcode IS NOT NULL"), k, max_barcodes=3).collect()
    assert sorted(r["barcode"] for r in few) == sorted(b for b in want if b)[:3] and all(r["capped"] for r in few)
    texts = [core + "N" + core[:k], core[: k - 1], "", core]
    codes, bad, _ = codes_of(texts, "ACGT")
    starts, ends, _ = super_kmers(codes, bad, k)
    covered = sorted(j for a, b in zip(starts, ends) for j in range(a, b - k + 1))
    whole = "\0".join(texts)
    assert covered == [j for j in range(len(whole) - k + 1) if set(whole[j : j + k]) <= set("ACGT")]
    assert kmer_evidence(reads.where("false"), k).collect() == []


def test_match_names_finds_what_comparing_all_does(spark):
    """Any query against any name, also of one and two letters, by the rarest letters."""
    import random
    import re

    from taxolith.operators.explore import match_names

    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abc") for _ in range(draw.randint(1, 5)))
    names = sorted({f"{draw.choice(['', 's__', 'g__'])}{word()}_{word()}" if draw.random() < 0.7 else word().title() for _ in range(120)})
    queries = sorted({draw.choice([word(), word() + " " + word(), names[draw.randrange(len(names))], "--", "zzz"]) for _ in range(60)})
    plain = lambda x: re.sub("[^a-z0-9]+", " ", re.sub("^[a-z]__", "", x.lower())).strip()
    want = set()
    for q in queries:
        p = plain(q)
        if not p:
            continue
        levels = {"exact": [n for n in names if plain(n) == p], "substring": [n for n in names if p in plain(n)], "genus": [n for n in names if p.split(" ")[0] in plain(n)]}
        strategy = next((k for k, v in levels.items() if v), None)
        want |= {(q, n, strategy) for n in levels.get(strategy, [])}
    got = match_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(q,) for q in queries], "query string"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_mask_regions_against_all_k_mers(spark, monkeypatch):
    """Regions by super-k-mers equal those of every place; other alphabets, short and empty sequences, crowded minimisers."""
    import random

    draw, k = random.Random(6), 9
    words = ["".join(draw.choice("ACGTé") for _ in range(40)) for _ in range(6)]
    host = [(f"h{i}", "".join(draw.choice([*words, "A" * draw.randint(0, 30), draw.choice("ACGT")]) for _ in range(12))) for i in range(30)] + [("none", ""), ("null", None), ("short", "ACGT")]
    protected = [("p", words[0][5:30]), ("p", words[2]), ("q", "A" * 12), ("q", "ACG"), ("q", None)]
    known = {s[j : j + k] for _, s in protected if s for j in range(len(s) - k + 1)}
    want = set()
    for name, seq in host:
        flags = [False] * (len(seq or "") + 1)
        for j in range(len(seq or "") - k + 1):
            if seq[j : j + k] in known:
                flags[j : j + k] = [True] * k
        start = None
        for j, f in enumerate(flags):
            if f and start is None:
                start = j
            if not f and start is not None:
                want.add((name, start, j))
                start = None
    frames = spark.createDataFrame(host, "name string, seq string"), spark.createDataFrame(protected, "name string, seq string")
    for crowd in (100_000, 5):
        monkeypatch.setattr(R, "CROWD", crowd)
        assert {tuple(r) for r in R.mask_regions(*frames, k).select("name", "start", "end").collect()} == want
    assert R.mask_regions(frames[0], frames[1].where("false"), k).collect() == []

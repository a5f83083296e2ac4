import gzip
import random

import pytest

from taxolith.sources import reports as R
from taxolith.sources import sequences as Q
from taxolith.sources import sinks as K
from taxolith.sources import tables as T

REPORT = " 50.00\t500\t500\tU\t0\tunclassified\n 50.00\t500\t10\tR\t1\troot\n 40.00\t400\t0\tD\t2\t  Bacteria\n 30.00\t300\t300\tS\t562\t    E. coli\n"


def test_reports(spark, tmp_path):
    (tmp_path / "S1.report.txt").write_text(REPORT)
    rows = {r.taxid: r for r in R.read_kraken_report(spark, str(tmp_path / "S1.report.txt")).collect()}
    assert rows["562"].depth == 2 and rows["562"].name == "E. coli" and rows["562"]["sample"] == "S1" and rows["2"].clade_reads == 400
    kinds = [r["format"] for r in R.detect_format(R.numbered_lines(spark, str(tmp_path / "S1.report.txt"))).collect()]
    assert kinds == ["kraken2"]
    (tmp_path / "all.tsv").write_text("#first\n#name\ttaxonomy_id\ttaxonomy_lvl\tS1_num\tS1_frac\tS2_num\tS2_frac\nA\t1\tS\t5\t0.5\tx\t0.1\n")
    cells = R.combined_abundance(R.read_combined(spark, str(tmp_path / "all.tsv"))).collect()
    assert sorted((r["sample"], r.taxid, r["count"], r.frac) for r in cells) == [("S1", "1", 5.0, 0.5), ("S2", "1", 0.0, 0.1)]
    both = R.load_reports(spark, [str(tmp_path / "S1.report.txt"), str(tmp_path / "all.tsv")])
    assert {r["format"] for r in both.collect()} == {"kraken2", "combined_bracken"}


def test_assignments(spark, tmp_path):
    (tmp_path / "S1.kraken2.out").write_text("C\tr1|CB:AA|UB:CC\tE. coli (taxid 562)\t100\t562:23 0:2\nU\tr2\t0\t90\t\n")
    rows = {r.read_id.split("|")[0]: r for r in R.read_assignments(spark, str(tmp_path / "S1.kraken2.out")).collect()}
    assert (rows["r1"].taxid, rows["r1"].barcode, rows["r1"].umi, rows["r2"].barcode) == ("562", "AA", "CC", None)


def test_fastq_and_fasta(spark, tmp_path):
    path = str(tmp_path / "a.fastq.gz")
    with gzip.open(path, "wt") as out:
        out.write("".join(f"@r{k} x\nACGT\n+\nIIII\n" for k in range(5)))
    rows = Q.read_fastq(spark, [[path]], "S1", max_reads=3).collect()
    assert [(r.pos, r.read_id, r.seq) for r in rows] == [(0, "r0", "ACGT"), (1, "r1", "ACGT"), (2, "r2", "ACGT")]
    (tmp_path / "bad.fastq").write_text("@r0\nACGT\n+\n")
    with pytest.raises(Exception, match="cut off"):
        Q.read_fastq(spark, [[str(tmp_path / "bad.fastq")]], "S").collect()
    (tmp_path / "a.fa").write_text(">one first\nAC\nGT\n>two\nTT\n")
    assert sorted((r.name, r.seq) for r in Q.read_fasta(spark, str(tmp_path / "a.fa")).collect()) == [("one first", "ACGT"), ("two", "TT")]


@pytest.mark.parametrize("step", [37, 64, 1000, 10_000_000])
def test_fastq_blocks_cut_anywhere(spark, tmp_path, step):
    """Plain files in blocks of any size give the records of the whole, also where quality lines look like headers."""
    draw = random.Random(step)
    records = []
    for k in range(120):
        n = draw.choice([0, 1, 5, 40, 200])
        records.append((f"r{k}", "".join(draw.choice("ACGTN") for _ in range(n)), "".join(draw.choice("@+I#") for _ in range(n))))
    for name, own in (("a", records[:100]), ("b", records[100:])):
        (tmp_path / f"{name}.fastq").write_text("".join(f"@{i} more\n{s}\n+{i}\n{q}\n" for i, s, q in own))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(step))
    try:
        rows = Q.read_fastq(spark, [[str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq")]], "S")
        got = sorted((r["path"][-7], r["pos"], r["read_id"], r["seq"], r["qual"]) for r in rows.collect())
        assert got == sorted([("a", k, *r) for k, r in enumerate(records[:100])] + [("b", k, *r) for k, r in enumerate(records[100:])])
        (tmp_path / "bad.fastq").write_text("".join(f"@{i}\n{s}\n+\n{q}\n" for i, s, q in records[:50]) + "@x\nACGT\n+\nIII\n" + "@y\nA\n+\nI\n")
        with pytest.raises(Exception, match="record 50 is cut off or malformed"):
            Q.read_fastq(spark, [[str(tmp_path / "bad.fastq")]], "S").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fastq_of_one_sample_by_many_tasks(spark, tmp_path):
    rows = [("S", 1, k, f"r{k}", "ACGT" * (k % 5), "IIII" * (k % 5)) for k in range(3000)] + [("T", 2, 7, "t", "A", "I")]
    reads = spark.createDataFrame(rows, "sample string, mate int, pos long, read_id string, seq string, qual string").repartition(5, "read_id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.write_fastq(reads, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = sorted((tmp_path / "out/sample=S/mate=1").glob("part-*"))
    assert len(parts) > 2
    (tmp_path / "one.fastq.gz").write_bytes(b"".join(p.read_bytes() for p in parts))  # members one after the other
    back = Q.read_fastq(spark, [[str(tmp_path / "one.fastq.gz")]], "S").orderBy("pos").collect()
    assert [(r["pos"], r["read_id"], r["seq"], r["qual"]) for r in back] == [(k, i, s, q) for _, _, k, i, s, q in rows[:3000]]


def test_biom_is_one_json_document(spark, tmp_path):
    import json

    rows = [("s2", "t1", 3.0), ("s1", "t9", 1.5), ("s1", "t\"q", 2.0), ("s2", "t9", 0.0), ("s3", "gone", 5.0)]
    table = spark.createDataFrame(rows, "sample string, taxid string, count double")
    keep = table.where("taxid <> 'gone'")
    meta = spark.createDataFrame([("s1", "a", 1), ("s2", None, 2)], "sample string, kind string, n int")
    K.write_biom(table, keep, meta, str(tmp_path / "b"))
    (part,) = (tmp_path / "b").glob("part-*")
    found = json.loads(part.read_text())
    assert found["shape"] == [3, 2] and [c["id"] for c in found["columns"]] == ["s1", "s2"] and found["columns"][1]["metadata"] == {"kind": None, "n": 2}
    assert {(found["rows"][r]["id"], found["columns"][c]["id"], v) for r, c, v in found["data"]} == {(t, s, v) for s, t, v in rows[:3]}
    with pytest.raises(ValueError, match="no cell"):
        K.write_biom(table.where("false"), keep, meta, str(tmp_path / "none"))


def test_otu_labels_are_unique(spark, tmp_path):
    rows = spark.createDataFrame([("s", "", "A b", 12.0), ("r", "", "A_b", 1.0)], "sample string, taxid string, name string, count double")
    with pytest.raises(ValueError, match="several taxa"):
        K.write_otu(rows, str(tmp_path / "x"))


def test_tables(spark, tmp_path):
    (tmp_path / "drop.txt").write_text("# why\n9606\n1 # bad\n9606\n")
    assert {r.taxid for r in T.read_drop(spark, [str(tmp_path / "drop.txt")]).collect()} == {"9606", "1"}
    with pytest.raises(Exception):
        T.read_drop(spark, [str(tmp_path / "none.txt")]).collect()
    (tmp_path / "meta.tsv").write_text("Sample_ID\tkind\nS1\tyes\nS2\tno\n")
    samples = spark.createDataFrame([("S1",), ("S2",)], "sample string")
    assert [r["sample"] for r in T.resolve_controls(spark, f"{tmp_path}/meta.tsv:kind", samples).collect()] == ["S1"]
    with pytest.raises(ValueError, match="unknown"):
        T.resolve_controls(spark, "S9", samples)
    for name in ("S1.host.txt", "S2.host1.txt"):
        (tmp_path / name).write_text("# run\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tx.bam\nG1\t1\t1\t9\t+\t101\t7\n")
    rows = T.read_featurecounts(spark, [str(tmp_path / "S1.host.txt"), str(tmp_path / "S2.host1.txt")]).collect()
    assert sorted((r["sample"], r.gene, r.length, r["count"]) for r in rows) == [("S1", "G1", 101.0, 7.0), ("S2", "G1", 101.0, 7.0)]
    (tmp_path / "m.mtx").write_text("%%x\n2 2 2\n1 1 5\n2 2 6\n")
    (tmp_path / "f.tsv").write_text("e1\tG1\ne2\t\n")
    (tmp_path / "b.tsv").write_text("AA\nCC\n")
    got = T.read_mtx(spark, *(str(tmp_path / n) for n in ("m.mtx", "f.tsv", "b.tsv")), "S").collect()
    assert sorted((r.gene, r.barcode, r.value) for r in got) == [("G1", "AA", 5.0), ("e2", "CC", 6.0)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("S1", "1", 5.0), ("S2", "2", 0.0)], "sample string, taxid string, count double")
    meta = spark.createDataFrame([("S1", "a"), ("S2", "b")], "sample string, grp string")
    K.write_biom(rows, rows.select("taxid"), meta, str(tmp_path / "biom"))
    text = spark.read.text(str(tmp_path / "biom"), wholetext=True).first()[0].replace("\n", "")
    assert '"shape":[1,1]' in text and '"data":[[0,0,5.0]]' in text
    plan = K.plan_bundle(spark, spark.createDataFrame([("x.bracken.combined.tsv",), ("y.zip",)], "path string"))
    assert {r.path: r.formats for r in plan.collect()} == {"x.bracken.combined.tsv": ["bracken_combined"], "y.zip": []}
    with pytest.raises(ValueError):
        K.require_one_format(plan)

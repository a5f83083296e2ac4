import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_quality import junk
from tests.llm.test_simhash import edited


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    passage = prose(31337, 40).replace("\n", " ")
    shared = "\n".join(prose(777 + k, 12).replace("\n", " ") for k in range(5))
    pairs = [(k, prose(k, 200)) for k in range(60)]
    pairs += [(100 + k, junk(k, 80)) for k in range(40)]
    pairs += [(200, pairs[3][1]), (201, edited(pairs[4][1], 1, 2)), (202, prose(5001, 60) + " " + passage), (203, prose(5002, 50) + "\n" + shared), (204, shared + "\n" + prose(5003, 50)), (205, None), (206, "")]
    frame = docs(pairs).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(k, int(k < 100), 0) for k in [*range(60), *range(100, 140)]], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_keep_columns_and_do_their_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    good = stages["quality"](spark, docs, folder).cache()
    assert good.columns == docs.columns and set(range(60)) <= ids(good) and not ids(good) & set(range(100, 140))
    lines = stages["line_dedup"](spark, good, folder).cache()
    assert lines.columns == docs.columns and ids(lines) == ids(good)
    texts = {r.doc_id: r for r in lines.collect()}
    assert texts[204].text == prose(5003, 50) and texts[204].n_chars == len(texts[204].text)
    near = stages["near_dedup"](spark, good, folder)
    assert near.columns == docs.columns and not ids(near) & {200, 201} and set(range(60)) | {202, 203} <= ids(near)
    clean = stages["decontamination"](spark, good, folder)
    assert clean.columns == docs.columns and ids(good) - ids(clean) == {202}


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {r.doc_id for r in rows}
    assert set(range(60)) <= found and not found & {202, *range(100, 140)}
    # line dedup empties the copy; of the empty documents one stays
    assert len(found & {200, 205, 206}) == 1
    assert all(r.length <= 1024 for r in rows)


@pytest.mark.parametrize("name", ["quality", "packing"])
def test_texts_reach_python_in_small_batches(spark, folder, name):
    """Of lazy stages too, whose result runs after they have returned."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(bound, None)
    try:
        spark.conf.unset(bound)
        dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert int(spark.conf.get(bound)) <= 1 << 22
    finally:
        spark.conf.unset(bound) if before is None else spark.conf.set(bound, before)


def test_packing_remembers_fewer_chunks(spark, folder, monkeypatch):
    """Pieces are the same however many are remembered."""
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    asked, pack = [], corpus_pipeline.pack_documents
    monkeypatch.setattr(corpus_pipeline, "pack_documents", lambda *a, **k: asked.append(k["remember"]) or pack(*a, **k))
    got = corpus_pipeline.packing(spark, rows, folder).collect()
    assert asked[0] <= 100_000
    assert sorted(got) == sorted(pack(rows, remember=2).collect()) == sorted(pack(rows).collect())


@pytest.fixture(scope="module")
def odd_folder(spark, docs, odd, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("odd"))
    rows = [*odd, *((50 + k, prose(50 + k, 90)) for k in range(20)), *((80 + k, junk(k, 60)) for k in range(20))]
    docs(rows).write.parquet(f"{out}/documents.parquet")
    labels = [*((50 + k, 1, 0) for k in range(20)), *((80 + k, 0, 1) for k in range(20)), (None, 1, 0), (50, None, None), (50, 1, 0), (999, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, prose(51, 90)), (None, prose(52, 90)), (3, prose(51, 90))], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_rows(spark, odd_folder, odd, name):
    """Null ids and texts, repeated rows, ties, very long texts and columns whose names clash."""
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, odd_folder)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    given = [*odd, *((50 + k, prose(50 + k, 90)) for k in range(20)), *((80 + k, junk(k, 60)) for k in range(20))]
    count = lambda pairs, i: sum(p[0] == i for p in pairs)
    if name == "quality":
        assert len({count(rows, i) for i in (1, 2)}) == 1 and count(rows, 9) in (0, 2)
    elif name == "line_dedup":
        assert sorted(map(str, (i for i, _ in rows))) == sorted(map(str, (i for i, _ in given)))
        kept = dict((i, t) for i, t in rows if i != 9)
        assert kept[1] is None and kept[2] == "" and kept[None] == "no id" and kept[8] == prose(8, 120)
        assert len({t for i, t in rows if i == 9}) == 1
    elif name == "near_dedup":
        assert sum(count(rows, i) for i in (1, 2, 3, 14)) == 1 and count(rows, 8) == 1 and count(rows, 9) == 0 and count(rows, 10) == 1 and count(rows, None) == 1
    else:
        assert count(rows, 51) == 0 and count(rows, 52) in (0, 1) and count(rows, 1) == 1 and count(rows, 9) == 2 and count(rows, None) == 1


def test_run_on_odd_and_empty_tables(spark, docs, odd_folder, tmp_path):
    assert corpus_pipeline.run(spark, odd_folder).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd_folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_lists_it():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in names if q.startswith("op")}

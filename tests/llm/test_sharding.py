import hashlib
import zlib

from pyspark.sql import functions as F

from taxolith.llm.sharding import assign_shards, shard_documents


def test_key_law(spark, docs, odd):
    rows = shard_documents(docs(odd)).collect()
    assert len(rows) == len(odd)
    texts = {}
    for i, t in odd:
        texts.setdefault(i, t)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.grown_shard in (r.shard, 8)
        key = "null" if r.doc_id is None else str(r.doc_id)
        draws = [int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) for s in range(8)]
        assert r.shard == draws.index(max(draws))
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_few_rows_move_and_weights_count(spark):
    keys = spark.range(20000).withColumnRenamed("id", "doc_id")
    grown = assign_shards(assign_shards(keys, weights=(1,) * 8), weights=(1,) * 9, shard_col="grown")
    moved = grown.where("shard <> grown")
    assert moved.where("grown <> 8").count() == 0
    assert abs(moved.count() / 20000 - 1 / 9) < 0.02
    sizes = {r.shard: r["count"] for r in assign_shards(keys, weights=(1.0, 2.0, 1.0)).groupBy("shard").count().collect()}
    assert abs(sizes[1] / 20000 - 0.5) < 0.02
    heavier = assign_shards(assign_shards(keys, weights=(1.0, 2.0, 1.0)), weights=(1.0, 3.0, 1.0), shard_col="grown").where("shard <> grown")
    assert heavier.where("grown <> 1").count() == 0


def test_slots_over_few_buckets(spark, docs):
    rows = shard_documents(docs([(k, "t") for k in range(300)]), shards=2, buckets=3)
    per = rows.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("top"), F.count_distinct("slot").alias("d")).collect()
    assert all(r.n == r.top + 1 == r.d for r in per)
    assert shard_documents(docs([(1, "x")]).limit(0)).count() == 0


def test_slots_keep_all_columns(spark):
    from taxolith.llm.sharding import number_slots

    rows = spark.createDataFrame([(0, k, k, 2, 3, 4, 5, 6) for k in range(20)], "shard int, k int, _part int, _row int, _before int, _s int, _p int, _n int")
    out = number_slots(rows, "shard", ["k"], buckets=4)
    assert out.columns == [*rows.columns, "slot"]
    assert {(r.k, r._part, r._row, r._before, r._s, r._p, r._n) for r in out.collect()} == {(k, k, 2, 3, 4, 5, 6) for k in range(20)}

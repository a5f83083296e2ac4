import time

from taxolith.streaming.groups import Release, first_runs, release_groups, running_taxa, use_state_store


def drain(frame, name, mode, rows):
    """The sink once it has as many rows; a stream with timeouts never runs out of batches."""
    query = frame.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        until = time.time() + 90
        while time.time() < until and query.exception() is None and frame.sparkSession.table(name).count() < rows:
            time.sleep(1)
        assert query.exception() is None
    finally:
        query.stop()
    return frame.sparkSession.table(name).collect()


MEMBERS = "key string, member string, expected long"


def test_groups_come_out_when_complete(spark, tmp_path):
    use_state_store(spark)
    rows = [("a", "m1", 2), ("a", "m2", 2), ("b", "m1", 3), ("a", "m2", 2)]
    spark.createDataFrame(rows, MEMBERS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(MEMBERS).parquet(str(tmp_path / "in"))
    got = drain(release_groups(stream), "released", "append", 1)
    assert [(r.key, r.members, r.complete) for r in got] == [("a", ["m1", "m2"], True)]


def test_late_groups_come_out_incomplete(spark, tmp_path):
    use_state_store(spark)
    spark.createDataFrame([("a", "m1", 3), ("a", "m2", 3)], MEMBERS).write.parquet(str(tmp_path / "in"))
    got = drain(release_groups(spark.readStream.schema(MEMBERS).parquet(str(tmp_path / "in")), timeout_ms=1500), "late", "append", 1)
    assert [(r.key, r.members, r.complete) for r in got] == [("a", ["m1", "m2"], False)]


def test_groups_go_on_after_a_restart(spark, tmp_path):
    """Members that came before the restart are in the state that the checkpoint holds."""
    use_state_store(spark)
    source, out, at = (str(tmp_path / n) for n in ("in", "out", "at"))
    for rows in ([("a", "m1", 3), ("b", "n1", 2)], [("a", "m2", 3), ("a", "m1", 3)], [("a", "m3", 3), ("b", "n2", 2), ("c", "o", 1)]):
        spark.createDataFrame(rows, MEMBERS).coalesce(1).write.mode("append").parquet(source)
        stream = release_groups(spark.readStream.schema(MEMBERS).parquet(source), 3_600_000)
        write = lambda batch, _: batch.write.mode("append").parquet(out)
        stream.writeStream.outputMode("append").option("checkpointLocation", at).trigger(once=True).foreachBatch(write).start().awaitTermination()
    got = sorted((r.key, r.members, r.complete) for r in spark.read.parquet(out).collect())
    assert got == [("a", ["m1", "m2", "m3"], True), ("b", ["n1", "n2"], True), ("c", ["o"], True)]


def test_running_counts_and_first_runs(spark, tmp_path):
    rows = [("S", "7", "7:3"), ("S", "7", "9606:1 7:2"), ("S", "8", "8:1")]
    spark.createDataFrame(rows, "sample string, taxid string, runs string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("sample string, taxid string, runs string").parquet(str(tmp_path / "in"))
    got = drain(running_taxa(stream, "9606"), "counts", "complete", 2)
    assert sorted((r.taxid, r.reads, r.host_reads) for r in got) == [("7", 2, 1), ("8", 1, 0)]
    once = drain(first_runs(stream.selectExpr("taxid AS run")), "runs", "append", 2)
    assert sorted(r.run for r in once) == ["7", "8"]


class Held:
    """State of one bucket in a dictionary, which counts its calls."""

    def __init__(self):
        self.maps, self.calls, self.timers = {}, 0, set()

    def getMapState(self, name, *_):
        return HeldMap(self, self.maps.setdefault(name, {}))

    getValueState = getMapState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class HeldMap:
    def __init__(self, of, own):
        self.of, self.own = of, own

    def __getattribute__(self, name):
        if name not in ("of", "own"):
            self.of.calls += 1
        return object.__getattribute__(self, name)

    def containsKey(self, key):
        return key in self.own

    exists = lambda self: None in self.own
    get = lambda self: self.own[None]
    clear = lambda self: self.own.clear()
    getValue = lambda self, key: self.own[key]
    iterator = lambda self: iter(list(self.own.items()))

    def update(self, value):
        self.own[None] = value

    def updateValue(self, key, value):
        self.own[key] = value

    def removeKey(self, key):
        del self.own[key]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentProcessingTimeInMs


def batch(rows):
    import pandas as pd

    return pd.DataFrame(rows, columns=["key", "member", "expected"])


def flat(frames):
    return sorted((k, list(m), c) for f in frames for k, m, c in f.itertuples(index=False))


def test_groups_that_come_whole_take_no_state():
    held, release = Held(), Release(1000)
    release.init(held)
    rows = [(f"k{k}", f"m{m}", 3) for k in range(5000) for m in (2, 0, 1)]
    got = flat(release.handleInputRows((7,), iter([batch(rows[:8000]), batch(rows[8000:])]), Clock(0)))
    assert got == sorted((f"k{k}", ["m0", "m1", "m2"], True) for k in range(5000))
    assert held.calls <= 3 and not held.timers


def test_open_groups_of_a_bucket():
    for most in (1, 500):  # members that are held at once
        held, release = Held(), Release(1000, most)
        release.init(held)
        assert flat(release.handleInputRows((7,), iter([batch([("a", "x", 2), ("b", "x", 3)]), batch([("b", "y", 3), ("b", "x", 3), ("c", "z", 1), ("c", "z", 1)])]), Clock(0))) == [("c", ["z"], True)]
        assert held.timers == {1000}
        assert flat(release.handleInputRows((7,), iter([batch([("a", "x", 2), ("b", "w", 4)])]), Clock(600))) == []
        assert flat(release.handleExpiredTimer((7,), Clock(0), Clock(1000))) == []  # each arrival sets the time anew
        assert flat(release.handleInputRows((7,), iter([batch([("a", "y", 2), ("d", "x", 2)])]), Clock(1100))) == [("a", ["x", "y"], True)]
        assert flat(release.handleExpiredTimer((7,), Clock(0), Clock(1600))) == [("b", ["w", "x", "y"], False)]
        assert flat(release.handleExpiredTimer((7,), Clock(0), Clock(2100))) == [("d", ["x"], False)]
        assert not any(held.maps.values())

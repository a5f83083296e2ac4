import math
import re
import zlib

import pytest

from taxolith.llm.quality import Features, Learner, keep_good, quality_scores
from tests.llm.conftest import prose


def junk(seed, n):
    return " ".join(w + ("***", "###", "!!")[k % 3] for k, w in enumerate(prose(seed, n).split()))


@pytest.fixture(scope="module")
def data(spark):
    pairs = [(k, junk(k, 60) if k % 4 == 0 else prose(k, 60)) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(0, 400) if k % 3] + [(7777, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return pairs, labels


def test_learns_and_holds_out(spark, docs, odd, data):
    pairs, labels = data
    extra = [(1000 + (i or 0), t) for i, t in odd]
    rows = quality_scores(docs(pairs + extra + [(None, "no id")]), labels).collect()
    assert len(rows) == len(pairs) + len(extra) + 1
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) / len(held) > 0.95
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1001] == scores[1002] and scores[1008] == scores[1009]


def test_same_result_again_and_columns(spark, docs, data):
    pairs, labels = data
    frame = docs(pairs)
    first = {r.doc_id: r.score for r in quality_scores(frame.repartition(7), labels).collect()}
    assert first == {r.doc_id: r.score for r in quality_scores(frame.coalesce(1), labels).collect()}
    kept = keep_good(frame, labels)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, s in first.items() if s >= 0.3} and len(ids) > 290


def test_no_labels_and_empty(spark, docs, data):
    _, labels = data
    rows = quality_scores(docs([(1, "x"), (2, None)]), labels.limit(0)).collect()
    assert [r.score for r in rows] == [0.5, 0.5]
    assert quality_scores(docs([(1, "x")]).limit(0), labels).count() == 0


def test_ftrl_step():
    """One step from nothing: z is the gradient, and the weight follows from it."""
    learner = Learner(4, alpha=0.5, beta=1.0, l1=0.0, l2=0.0)
    import numpy as np

    learner.learn(np.array([2]), np.array([1.0]), 1)
    assert learner.z[2] == learner.z[4] == -0.5
    assert abs(learner.weights(np.array([2]))[0] - 0.5 / ((1 + 0.5) / 0.5)) < 1e-12


def test_features_scale():
    index, value = Features()("a b a c ###")
    assert abs((value**2).sum() - 1) < 1e-12 and len(index) == len(set(index.tolist()))
    assert len(Features()("")[0]) == 0 and len(Features()(None)[0]) == 0


class PlainModel:
    """The same scores by dictionaries and loops: features by the definition, updates by the published formulas."""

    MASK = (1 << 64) - 1

    def __init__(self, alpha=0.5, beta=1.0, l1=1e-4, l2=1e-5):
        self.alpha, self.beta, self.l1, self.l2, self.z, self.n = alpha, beta, l1, l2, {}, {}

    def features(self, text):
        tokens = re.findall(r"\w+|[^\w\s]+", text or "")
        hashed = lambda b: zlib.crc32(b)
        shape = lambda t: "".join("X" if c.isupper() else "9" if c.isdigit() else "x" if c.isalpha() else c for c in t[:2] + t[-1:])
        words = [hashed(b"\x00") if k and tokens[k - 1] == t else hashed(t.encode()) for k, t in enumerate(tokens)]
        shapes = [hashed(b"\x01" + shape(t).encode()) for t in tokens]
        count = {}
        for series in (words, shapes):
            grams = list(series) + [(a * 0x9E3779B97F4A7C15 + b) & self.MASK for a, b in zip(series, series[1:])]
            for g in grams:
                slot = ((g ^ g >> 29) * 0xBF58476D1CE4E5B9 & self.MASK) >> 46
                count[slot] = count.get(slot, 0) + 1
        norm = math.sqrt(sum(c * c for c in count.values()))
        return {k: c / norm for k, c in count.items()} | {"bias": 1.0} if count else {"bias": 1.0}

    def weight(self, k):
        z = self.z.get(k, 0.0)
        if abs(z) <= self.l1:
            return 0.0
        return -(z - math.copysign(self.l1, z)) / ((self.beta + math.sqrt(self.n.get(k, 0.0))) / self.alpha + self.l2)

    def score(self, text):
        return 1 / (1 + math.exp(-sum(self.weight(k) * v for k, v in self.features(text).items())))

    def learn(self, text, label):
        held = self.features(text)
        weights = {k: self.weight(k) for k in held}
        error = self.score(text) - label
        for k, v in held.items():
            g, n = error * v, self.n.get(k, 0.0)
            self.z[k] = self.z.get(k, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / self.alpha * weights[k]
            self.n[k] = n + g * g


def test_scores_match_brute_force(spark, docs, odd, data):
    """One learner and one pass over the labelled texts, in the order of the operator."""
    from pyspark.sql import functions as F

    pairs, labels = data
    frame = docs(pairs + [(1000 + k, t) for k, (_, t) in enumerate(odd)])
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").join(frame.select("doc_id", "text"), "doc_id")
    known = known.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").collect()
    model = PlainModel()
    for r in known:
        if zlib.crc32(str(r.doc_id).encode()) % 5:
            model.learn(r.text, r.quality)
    got = quality_scores(frame, labels, learners=1, epochs=1).collect()
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert max(abs(r.score - model.score(texts[r.doc_id])) for r in got) < 1e-5 and len(got) == len(texts)


def test_learners_share_the_rows_and_any_partition_count_gives_one_model(spark, docs, data):
    from taxolith.llm.quality import train

    pairs, labels = data
    known = labels.selectExpr("doc_id", "quality as label")
    first = train(docs(pairs), known, bits=12, least=50)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        again = train(docs(pairs).repartition(9), known, bits=12, least=50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (first == again).all() and (first != 0).any()

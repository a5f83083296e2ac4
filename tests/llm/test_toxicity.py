import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxolith.llm import toxicity as X

from .conftest import prose

RUDE = ["blockhead", "nincompoop", "zlotbane", "zlotmire", "zlotfen"]


def planted(n, seed=1, words=120):
    """Texts, every fourth with three rude words among many others."""
    draw, out = random.Random(seed), []
    for k in range(n):
        tokens = prose(seed * 10_000 + k, draw.randint(20, words)).split(" ")
        if k % 4 == 0:
            for _ in range(3):
                tokens[draw.randrange(len(tokens))] = draw.choice(RUDE)
        out.append((" ".join(tokens), int(k % 4 == 0)))
    return out


@pytest.fixture(scope="module")
def learnt():
    return X.learn(*zip(*planted(500)))


def scores(model, texts):
    network, weights = model
    scorer = X.Scorer(network)
    return 1 / (1 + np.exp(-np.array([X.evidence(np, logits) for logits in scorer(texts)]) @ weights))


def test_gradients_equal_finite_differences():
    network, draw = X.Network(1), np.random.default_rng(2)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    for k in ("attend", "out"):
        network.p[k] = draw.normal(0, 1, network.p[k].shape)
    v = draw.normal(0, 1, (5, 4, X.WORD_SIZE + X.CHAR_SIZE))
    mask = np.ones((5, 4))
    mask[3:, 1] = 0
    y, weight = np.array([0.0, 1, 1, 0]), np.array([0.3, 0.2, 0.4, 0.1])

    def loss():
        logit = network.logits(v @ network.p["wf"] + network.p["bf"], v @ network.p["wb"] + network.p["bb"], mask)
        return float((weight * (np.log1p(np.exp(logit)) - y * logit)).sum())

    g, dv = network.gradients(v, mask, y, weight)
    for name, table in [*((k, network.p[k]) for k in g), ("v", v)]:
        found = dv if name == "v" else g[name]
        for _ in range(6):
            at = tuple(draw.integers(0, s) for s in table.shape)
            table[at] += 1e-3
            up = loss()
            table[at] -= 2e-3
            down = loss()
            table[at] += 1e-3
            assert abs((up - down) / 2e-3 - found[at]) < 1e-3 + 1e-2 * abs(found[at]), (name, at)


def test_windows_cover_all_words_and_overlap():
    for n in [0, 1, 7, 15, 16, 17, 24, 25, 100, 1001]:
        cut = X.windows(np, list(range(n)))
        assert set(cut.ravel()) - {-1} == set(range(n))
        assert all(b[0] - a[0] == X.STRIDE for a, b in zip(cut, cut[1:]))


def test_scorer_equals_one_window_at_a_time(learnt):
    network, _ = learnt
    texts = [prose(k, 40 + 30 * k) for k in range(4)] + ["", None, "blockhead"]
    got = X.Scorer(network)(texts)
    for text, logits in zip(texts, got):
        words = X.TOKEN.findall((text or "").lower())
        plain = []
        for start in X.starts(len(words)):
            part = words[start : start + X.WINDOW]
            own = np.zeros((X.WINDOW, 1, X.WORD_SIZE + X.CHAR_SIZE), np.float32)
            mask = np.zeros((X.WINDOW, 1), np.float32)
            for t, word in enumerate(part):
                flat, size = X.grams([word])
                bucket = zlib.crc32(b"\x03" + word.encode()) % X.BUCKETS
                own[t, 0] = np.concatenate([network.p["words"][bucket], network.p["chars"][flat].sum(0) / np.sqrt(size[0])])
                mask[t] = 1
            plain.append(network.logits(own @ network.p["wf"] + network.p["bf"], own @ network.p["wb"] + network.p["bb"], mask)[0])
        assert np.allclose(logits, plain, atol=1e-3)


def test_learns_rude_words_by_text_labels_alone(learnt):
    texts, y = zip(*planted(200, seed=2))
    p, y = scores(learnt, list(texts)) >= 0.5, np.array(y)
    assert p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.05
    # character n-grams carry over to a word that was never seen: it is thought far likelier than another unseen one
    base = " ".join(prose(900, 60).split(" ")[:50])
    other, kin = scores(learnt, [base + " alphabet" * 3, base + " zlotgard" * 3])
    assert kin > 100 * other


def test_whole_texts_count_however_long(learnt):
    clean = " ".join(prose(500 + k, 1000) for k in range(30))
    middle = clean[:90_000] + " blockhead nincompoop zlotbane blockhead nincompoop zlotmire zlotfen blockhead " + clean[90_000:]
    end = clean + " blockhead nincompoop zlotbane blockhead nincompoop zlotmire zlotfen blockhead"
    a, b, c = scores(learnt, [clean, middle, end])
    assert b > a + 0.3 and c > a + 0.3


def test_query_on_odd_rows(spark, docs, odd):
    known = planted(160)
    rows = [(1000 + k, t) for k, (t, _) in enumerate(known)] + odd
    marks = [(1000 + k, y) for k, (_, y) in enumerate(known)] + [(1, 0), (2, None), (None, 1), (1000, known[0][1]), (77_777, 1)]
    labels = spark.createDataFrame([(i, 1, y) for i, y in marks], "doc_id long, quality int, toxic int")
    got = X.toxicity_scores(docs(rows), labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert by[1] == by[2] == by[3] and len(by[9]) == 1 and by[8] == by[9]
    # labels of held-out rows teach nothing
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.toxicity_scores(docs(rows), flipped).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_without_labels_or_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in X.toxicity_scores(docs([(1, "a"), (2, None)]), labels).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in X.toxicity_scores(docs([(1, "a"), (2, None), (3, "b")]), one).collect()} == {0.01}
    assert X.toxicity_scores(docs([]), labels).collect() == []

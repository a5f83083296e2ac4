import collections
import re

from taxolith.llm.decontam import decontaminate, leaks
from tests.llm.conftest import prose


def plain_leaks(pairs, items, size=5, similarity=0.8):
    """All item-sized windows by brute force, without fingerprints: best similarity and its start."""
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingles = lambda w: [tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    out = {}
    for i, t in pairs:
        doc = words(t)
        for item, u in items:
            asked = words(u)
            want = collections.Counter(shingles(asked))
            for start in range(max(1, len(doc) - len(asked) + 1) if asked and doc else 0):
                own = collections.Counter(shingles(doc[start : start + len(asked)]))
                value = (own & want).total() / (own | want).total()
                if value < similarity:
                    continue
                aligned = any(
                    max(0, min(p - q, len(doc) - len(asked))) == start
                    for p, s in enumerate(shingles(doc) if len(asked) >= size else zip(*(doc[k:] for k in range(len(asked)))))
                    for q, x in enumerate(shingles(asked)) if s == x
                )
                out[i, item] = max(out.get((i, item), (0, False, 0)), (value, aligned, -start))
    return {k: (round(v, 9), -s) for k, (v, _, s) in out.items()}


def build(spark, docs, pairs, items):
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    return docs(pairs), bench


def test_matches_brute_force(spark, docs, odd):
    items = [(k, prose(500 + k, 20 + 3 * k)) for k in range(12)] + [(20, prose(500, 20)), (21, None), (22, ""), (23, "one two"), (24, "again and again and again and again and again"), (None, "x y z")]
    pairs = [p for p in odd if p[0] is not None]
    for k in range(12):
        passage = items[k][1]
        changed = passage.split(" ")
        changed[len(changed) // 2] = "other"
        pairs.append((100 + k, prose(900 + k, 60) + " " + passage.upper() + ", " + prose(950 + k, 30)))
        pairs.append((200 + k, prose(700 + k, 40) + " " + " ".join(changed)))
        pairs.append((300 + k, " ".join(passage.split(" ")[: 10 + k]) + " " + prose(800 + k, 50)))
        pairs.append((400 + k, prose(600 + k, 300)))
    pairs.append((500, "so again and again and again and again and again and again and again"))
    frame, bench = build(spark, docs, pairs, items)
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in leaks(frame, bench).collect()}
    want = plain_leaks(pairs, [i for i in items if i[0] is not None])
    assert got == want
    assert all((100 + k, k) in got for k in range(12)) and (5, 23) in got
    kept = {r.doc_id for r in decontaminate(frame, bench).collect()}
    assert kept == {i for i, _ in pairs} - {i for i, _ in want}
    assert {400 + k for k in range(12)} <= kept


def test_empty_sides_and_columns(spark, docs, odd):
    frame, bench = build(spark, docs, odd, [(1, "one two three four five six")])
    assert {r.doc_id for r in leaks(frame, bench).collect()} == {6, 7}
    assert leaks(frame.limit(0), bench).count() == 0 and leaks(frame, bench.limit(0)).count() == 0
    out = decontaminate(frame, bench)
    assert out.columns == frame.columns and out.count() == len(odd) - 2
    assert out.where("doc_id is null").count() == 1


def test_shuffled_join_gives_the_same(spark, docs, monkeypatch):
    import taxolith.llm.decontam as module

    items = [(k, prose(k, 25)) for k in range(5)]
    frame, bench = build(spark, docs, [(k, prose(50 + k, 20) + " " + prose(k, 25)) for k in range(5)], items)
    before = sorted(map(tuple, leaks(frame, bench).collect()))
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, leaks(frame, bench).collect())) == before and len(before) == 5


def all_starts(pairs, items, size=5, similarity=0.8):
    """Best similarity over all item-sized windows by brute force."""
    out = {}
    for i, t in pairs:
        doc = re.findall(r"[^\W_]+", t.lower())
        for item, u in items:
            asked = re.findall(r"[^\W_]+", u.lower())
            count = lambda w: collections.Counter(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))
            want = count(asked)
            for start in range(max(1, len(doc) - len(asked) + 1)):
                own = count(doc[start : start + len(asked)])
                value = (own & want).total() / (own | want).total()
                if value >= similarity:
                    out[i, item] = max(value, out.get((i, item), 0))
    return {k: round(v, 9) for k, v in out.items()}


def test_windows_that_no_shingle_aligns(spark, docs):
    items = [(k, prose(40 + k, 60 + 20 * k)) for k in range(4)]
    pairs = []
    for k, (_, text) in enumerate(items):
        w = text.split()
        half = len(w) // 2
        pairs.append((10 + k, " ".join(prose(60 + k, 30).split() + w[half:] + w[:half] + prose(70 + k, 30).split())))
        pairs.append((20 + k, " ".join(prose(80 + k, 25).split() + w[half:] + w[: half - 2])))
        pairs.append((30 + k, " ".join(prose(90 + k, 20).split() + w[: half // 2] + prose(99, 40).split() + w[half // 2 :])))
    frame, bench = build(spark, docs, pairs, items)
    want = all_starts(pairs, items)
    assert all((10 + k, k) in want for k in range(4))
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in leaks(frame, bench).collect()} == want
    assert {r.doc_id for r in decontaminate(frame, bench).collect()} == {i for i, _ in pairs} - {i for i, _ in want}


def test_short_items_are_found_inside_texts(spark, docs):
    items = [(1, "the answer is"), (2, "forty"), (3, "Is it?"), (4, "one two three four"), (5, "one two three four five")]
    pairs = [(1, "some words before the answer is forty two and more"), (2, "The answer is"), (3, "is it, or is it not"), (4, "one two three"), (5, "zero one two three four six"), (6, "one two three four five six"), (7, ""), (8, None)]
    frame, bench = build(spark, docs, pairs, items)
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in leaks(frame, bench).collect()}
    assert got == plain_leaks(pairs, items)
    assert set(got) == {(1, 1), (1, 2), (2, 1), (3, 3), (5, 4), (6, 4), (6, 5)} and got[1, 1] == (1.0, 3) and got[3, 3] == (1.0, 0)


def test_rows_that_share_an_id(spark, docs):
    """Each is a document of its own; the better window counts."""
    item = prose(3, 40).replace("\n", " ")
    cut_off = " ".join(item.split()[:-2])
    frame, bench = build(spark, docs, [(1, prose(8, 30) + " " + cut_off), (1, "x y z " + item), (1, "other"), (2, "other")], [(1, item)])
    assert [(r.doc_id, r.similarity) for r in leaks(frame, bench).collect()] == [(1, 1.0)]
    assert sorted(r.doc_id for r in decontaminate(frame, bench).collect()) == [2]

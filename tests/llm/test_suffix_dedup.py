import collections
import random

import pytest

from taxolith.llm.suffix_dedup import remove_repeats, repeated_strings
from tests.llm.conftest import prose


def plain(pairs, length):
    """Bytes kept and runs removed of every document, by counting all strings."""
    count = collections.Counter()
    data = [(i, (t or "").encode()) for i, t in pairs]
    for _, b in data:
        count.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs, p = [], 0
        while p < len(b):
            q = p
            while q < len(b) and gone[q]:
                q += 1
            if q > p:
                runs.append((p, q))
            p = max(q, p + 1)
        out.append((i, len(b), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def compare(frame, pairs, length, **options):
    got = sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans or []], bytes(r.kept)) for r in remove_repeats(frame, length=length, **options).collect())
    assert got == plain(pairs, length)


def texts(seed, n):
    """Pieces of a small stock in any order, cut at any place, with repeats inside documents."""
    draw = random.Random(seed)
    stock = [prose(k, 30) for k in range(6)] + ["ab" * 60, "x" * 150, "é" * 40]
    out = []
    for k in range(n):
        parts = []
        for _ in range(draw.randint(0, 5)):
            s = draw.choice(stock)
            a = draw.randrange(len(s))
            parts.append(s[a : a + draw.randint(1, 120)] + draw.choice(["", "#", "%%"]) + prose(draw.randrange(10**6), draw.randint(0, 4)))
        out.append((k, "".join(parts)))
    return out


@pytest.mark.parametrize("length,gram,crowd", [(20, 8, 4096), (20, 8, 1), (33, 12, 2), (64, 64, 4096)])
def test_matches_brute_force(spark, docs, length, gram, crowd):
    pairs = texts(length + crowd, 40)
    compare(docs(pairs), pairs, length, gram=gram, crowd=crowd)


def test_odd_rows(spark, docs, odd):
    pairs = [p for p in odd if p[0] not in (None, 9)]
    compare(docs(pairs), pairs, 200)
    rows = remove_repeats(docs(odd), length=200).collect()
    assert [(r.spans, bytes(r.kept)) for r in rows if r.doc_id is None] == [(None, b"no id")]
    assert all(bytes(r.kept) == b"" for r in rows if r.doc_id == 9)  # repeated rows repeat each other
    assert remove_repeats(docs(odd).limit(0)).count() == 0


def test_refinement():
    draw = random.Random(9)
    for length in (8, 9, 13, 16, 31):
        contexts = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 60))).encode() for _ in range(6)]
        count = collections.Counter(c[p : p + length] for c in contexts for p in range(len(c) - length + 1))
        for c, found in zip(contexts, repeated_strings(contexts, length)):
            assert found.tolist() == [count[c[p : p + length]] > 1 for p in range(len(c) - length + 1)]


def test_long_documents_are_read_in_stretches(spark, docs, monkeypatch):
    import taxolith.llm.suffix_dedup as module

    monkeypatch.setattr(module, "STRETCH", 500)
    pairs = [(1, prose(1, 600)), (2, prose(2, 100) + prose(1, 600)[900:1900])]
    anchors = module.Anchors(40, 16)
    assert anchors.powers.size == 2 * 500 + 42
    for _, t in pairs:
        data = t.encode()
        whole = set()
        for at in range(0, len(data) - 39, 500):
            part = data[at : at + 539]
            a, _, _, first, n = anchors(part, [0], [len(part)])
            whole |= {at + k + j for k, m in zip(first.tolist(), n.tolist()) for j in range(m)}
        assert whole == set(range(len(data) - 39))


def test_contexts_are_refined_half_a_megabyte_at_a_time(monkeypatch):
    """An anchor's contexts stay together; what repeats is found in each of them."""
    import pyarrow as pa

    import taxolith.llm.suffix_dedup as module

    draw = random.Random(5)
    rows = [(a, c, draw.randbytes(300) + b"=" * 220 + draw.randbytes(8)) for a in range(1500) for c in range(2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[k : k + 700])], names=["anchor", "context", "body"]) for k in range(0, len(rows), 700)]
    sizes, refine = [], module.repeated_strings
    monkeypatch.setattr(module, "repeated_strings", lambda contexts, length: sizes.append(sum(map(len, contexts))) or refine(contexts, length))
    found = [r for b in module.refined(iter(batches), 200) for r in b.to_pylist()]
    assert sum(sizes) == 3000 * 528 and max(sizes) <= (1 << 19) + 2 * 528
    assert sorted((r["anchor"], r["context"]) for r in found) == [(a, c) for a, c, _ in rows] and all(r["s"] <= 300 and r["e"] >= 321 for r in found)


def test_texts_reach_python_in_small_batches(spark, docs):
    """What ``remove_repeats`` returns is lazy, so the bound holds on; a bound of the session's own is left alone."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        remove_repeats(docs([(1, "x")]))
        assert int(spark.conf.get(name)) <= 1 << 22
        spark.conf.set(name, "8388608")
        remove_repeats(docs([(1, "x")]))
        assert spark.conf.get(name) == "8388608"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_rows_of_one_id_lose_their_own_repeats_only(docs):
    a, b, c = (prose(k, 120) for k in (41, 42, 43))
    rows = [(1, a + b), (2, b + c), (1, c[:50] + prose(44, 200)), (3, prose(45, 200)), (3, prose(46, 200))]
    got = sorted((r["doc_id"], bytes(r["kept"]).decode("utf-8", "replace"), r["n_bytes"]) for r in remove_repeats(docs(rows), length=200).collect())
    whole = {t for _, t in rows}
    assert [k for _, k, _ in got].count(rows[2][1]) == 1 and rows[3][1] in [k for _, k, _ in got] and rows[4][1] in [k for _, k, _ in got]
    lost = [n - len(k.encode()) for i, k, n in got if k not in whole]
    assert len(lost) == 2 and all(n >= len(b.encode()) for n in lost)

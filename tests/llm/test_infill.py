import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxolith.llm.infill import MOST, STRETCH, Measured, Memo, chunk_ends, fill_in_middle, restored

from .conftest import prose


def plain_infill(doc_id, text):
    """The contract in plain Python, over code points."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return doc_id, n, "psm", a, b - a, "<P>" + prefix + "<S>" + suffix + "<M>" + middle


def test_equals_plain_version_and_restores(spark, docs, odd):
    tricky = ["<", "<P", "P><S", "<S>", "a<M>b", "<<<P>", "é" * 5000, "<P" + "x" * 4000 + ">", "日本語" * 999, "\U0001f600<\U0001f600", "S>" * 40]
    rows = odd + [(100 + k, t) for k, t in enumerate(tricky * 12)]
    rows += [(1000 + k, prose(k % 9, 300)) for k in range(60)]
    made = fill_in_middle(docs(rows)).withColumn("back", restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in made.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((r[:6] for r in got), key=key) == sorted((plain_infill(*r) for r in rows), key=key)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    assert all(r[6] == texts[r[0]] for r in got)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(docs):
    assert fill_in_middle(docs([]).where("false")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<PSM>é日\U0001f600a", max_size=400), st.integers(0, 400))
def test_chunk_counts_find_code_points(text, k):
    data = (text * 3).encode()
    measured = Measured(data, Memo())
    assert measured.points == len(text) * 3
    assert measured.marked == any(m in text * 3 for m in ("<P>", "<S>", "<M>"))
    k = min(k, measured.points)
    assert data[: measured.place(k)].decode() == (text * 3)[:k]


def test_marks_across_chunk_ends():
    draw = random.Random(5)
    memo = Memo()
    for _ in range(200):
        body = bytearray(bytes(draw.choice(b"abcdefgh ") for _ in range(3000)))
        for end in chunk_ends(bytes(body))[:3]:
            body[end - 1 : end + 2] = b"<S>"
        assert Measured(bytes(body), memo).marked


def test_shared_passages_share_chunks_and_contents_are_verified():
    passage = "".join(prose(k, 200) for k in range(20)).encode()
    chunks = lambda d: {d[a:b] for a, b in zip([0, *chunk_ends(d)], chunk_ends(d))}
    one, two = chunks(b"first document " + passage), chunks(b"another start of other length " + passage)
    assert len(one & two) > 0.9 * len(one)
    assert all(len(c) <= MOST for c in one)
    memo = Memo()
    for chunk in one | two:
        memo(chunk)
    key = next(iter(memo.known))
    content, summary = memo.known[key]
    memo.known[key] = b"something else", summary._replace(points=-1)  # a checksum that meets another content
    assert memo(content).points == len(content.decode("utf-8", "ignore"))


def test_stretches_do_not_move_chunk_ends(monkeypatch):
    data = "".join(prose(k, 300) for k in range(40)).encode()
    whole = chunk_ends(data)
    monkeypatch.setattr("taxolith.llm.infill.STRETCH", 1000)
    assert chunk_ends(data) == whole
    assert STRETCH > 1000


def test_long_texts_without_boundaries():
    data = b"a" * 3_000_000
    measured = Measured(data, Memo())
    assert measured.points == 3_000_000 and measured.place(2_999_999) == 2_999_999 and len(measured.ends) >= 3_000_000 // MOST

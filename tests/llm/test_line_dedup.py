import random

from taxolith.llm.line_dedup import dedup_lines


def plain(pairs, size=3):
    """Later occurrences of every run of lines, document by document in order of ids."""
    seen, out = {}, {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        if t is None:
            out[i] = None
            continue
        lines = t.split("\n")
        gone = set()
        for k in range(len(lines) - size + 1):
            key = tuple(lines[k : k + size])
            if seen.setdefault(key, (i, k)) != (i, k):
                gone |= set(range(k, k + size))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_matches_brute_force(spark, docs, odd):
    draw = random.Random(4)
    pairs = [(k, "\n".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 14)))) for k in range(100, 160)]
    pairs += [p for p in odd if p[0] not in (None, 9)]
    rows = dedup_lines(docs(pairs), report=True).collect()
    want, texts = plain(pairs), dict(pairs)
    assert {r.doc_id: r.text for r in rows} == want
    for r in rows:
        before = 0 if texts[r.doc_id] is None else texts[r.doc_id].count("\n") + 1
        assert r.n_lines == before
        after = 0 if not r.text and before <= r.n_removed else (r.text or "").count("\n") + 1
        assert r.n_removed == (before - after if before else 0)


def test_columns_and_odd_rows(spark, docs, odd):
    frame = docs(odd)
    out = dedup_lines(frame)
    assert out.columns == frame.columns and out.count() == len(odd)
    rows = {r.doc_id: r.text for r in out.collect()}
    assert rows[None] == "no id" and rows[1] is None and rows[2] == ""
    assert rows[13] == "a\nb\nc\nd\nz"
    same = [r.text for r in out.where("doc_id = 9").collect()]
    assert len(same) == 2 and same[0] == same[1]
    assert dedup_lines(frame.limit(0)).count() == 0


def test_a_copy_keeps_an_empty_row(spark, docs):
    rows = {r.doc_id: r.text for r in dedup_lines(docs([(2, "p\nq\nr\ns"), (1, "p\nq\nr\ns"), (3, "p\nq")])).collect()}
    assert rows == {1: "p\nq\nr\ns", 2: "", 3: "p\nq"}


def test_names_of_the_report(spark, docs):
    frame = docs([(1, "p\nq\nr\ns"), (2, "p\nq\nr\nt")]).withColumnRenamed("lang", "n_lines").withColumnRenamed("w", "_held")
    out = dedup_lines(frame, report=True)
    assert out.columns == [*frame.columns, "_n_lines", "n_removed"]
    assert {(r.doc_id, r._n_lines, r.n_removed, r.n_lines) for r in out.collect()} == {(1, 4, 0, "en"), (2, 4, 3, "en")}

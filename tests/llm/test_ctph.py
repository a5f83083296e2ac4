import numpy as np
import pytest

from taxolith.llm.ctph import alike, common, document_fingerprints, edited_fingerprints, edited_text, fingerprint, levels, likeness
from tests.llm.conftest import prose


def test_levels_match_a_loop():
    data = prose(3, 200).encode()
    got = levels(data)
    for k in range(len(data)):
        window = [data[j] if j >= 0 else 0 for j in range(k - 6, k + 1)]
        total = sum((8 - (6 - i)) * c for i, c in enumerate(window))
        mixed = 0
        for i, c in enumerate(window):
            mixed ^= c << (5 * (6 - i)) & 0xFFFFFFFF
        after = (total + mixed & 0xFFFFFFFF) + 1
        want = -1
        if after % 3 == 0:
            want = ((after // 3) & -(after // 3)).bit_length() - 1
        assert got[k] == want


def test_common_subsequence():
    draw = np.random.default_rng(1)
    for _ in range(100):
        a, b = (list(draw.integers(0, 5, draw.integers(1, 70)).astype(str)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert common(a, b) == table[-1, -1]


def test_likeness_orders_edits():
    text = prose(1, 800)
    same, small, half, other = fingerprint(text), fingerprint(text[:2000] + "XX" + text[2000:]), fingerprint(edited_text(text, prose(2, 800))), fingerprint(prose(2, 800))
    assert likeness(same, fingerprint(text)) == 1.0
    assert likeness(same, small) > 0.9 > likeness(same, half) > 0.3 > likeness(same, other)
    assert likeness(same, other) < 0.1
    assert likeness(fingerprint(""), fingerprint("")) == 1.0 and likeness(fingerprint(""), same) == 0.0
    assert likeness(None, same) is None and alike("", "AB") == 0.0


def test_repetitive_text_keeps_a_signature():
    text = "Anoi " * 500
    assert likeness(fingerprint(text), fingerprint(edited_text(text, prose(1, 500)))) > 0.2


@pytest.mark.parametrize("parts", [1, 3, 70])
def test_next_documents(spark, docs, odd, parts):
    pairs = [p for p in odd if p[0] is not None and p[0] != 9] + [(-5, "first of all"), (10**12, "last of all")]
    order = sorted(pairs)
    got = {r.doc_id: r for r in edited_fingerprints(docs(pairs + [(None, "no id")]), parts=parts).collect()}
    assert sorted(got) == [i for i, _ in order]
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        assert (got[i].n_chars, got[i].edited_text) == (len(t), edited_text(t, following))
        assert got[i].fingerprint == fingerprint(t) and got[i].edited_fingerprint == fingerprint(edited_text(t, following))
        assert got[i].near_next == likeness(fingerprint(t), fingerprint(following))


def test_small_tables(spark, docs):
    one = edited_fingerprints(docs([(1, "abcdef")])).collect()
    assert [(r.edited_text, r.near_next) for r in one] == [("abcabc", 1.0)]
    assert edited_fingerprints(docs([(1, "x")]).limit(0)).count() == 0
    assert edited_fingerprints(docs([(2, "b"), (2, "a"), (2, "a")])).count() == 3
    assert document_fingerprints(docs([(1, None)])).first().fingerprint == "3::"


def test_repeated_lines_count_to_the_end():
    for k in range(40):
        text = (prose(k, 12) + "\n") * 400
        half = fingerprint(edited_text(text, prose(100 + k, 12_000)))
        assert likeness(fingerprint(text), half) < 0.75
        assert all(len(part) <= 2 * 64 * 12 for part in half.split(":")[1:])

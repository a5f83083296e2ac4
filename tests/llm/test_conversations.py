import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from taxolith.llm import conversations as C

WHITE = "[\x20\x09-\x0d]"


def plain_repair(rows):
    """Rows (turn, role, text) of one conversation after damage, by a cheapest-first search over whole edit strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = re.sub(WHITE + "+", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, k, roles, out = heappop(heap)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            break
        state = k, roles[-1:] if roles != "s" else "s"
        if state in done:
            continue
        done.add(state)
        moves = []
        if k < len(rows):
            _, role, text = rows[k]
            moves.append((4, "D", 1, "", ()))
            if faults[k] in ("", "truncated"):
                more = 3 * (faults[k] == "truncated")
                moves += [(more, "K", 1, role[:1], ((role, text),)), *((3 + more, "R", 1, r[0], ((r, text),)) for r in ("user", "assistant"))]
        moves += [(3, "I", 0, r[0], ((r, ""),)) for r in ("user", "assistant")]
        for c, letter, step, initial, row in moves:
            if initial == "" and row or not re.fullmatch("(s?(ua)*u?)?", roles + initial):
                continue
            heappush(heap, (cost + c, audit + letter, k + step, roles + initial, out + row))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else x
        own = out.setdefault(conv, [])
        draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        own += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def some_rows(seed, n, conversations=4):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "superuser", "unknown", "agent"]
    texts = ["Yes.", "No!", "Why", "", " \t", None, "same?", "é.\n", "a. b", "\x0b.\x0c"]
    return [
        (draw.randrange(conversations) if draw.random() < 0.95 else None, draw.choice([*range(30), None]), draw.choices(roles, [8, 8, 2, 1, 1, 1, 1, 1, 1])[0],
         draw.choice(texts) if draw.random() < 0.4 else f"text {draw.random()}" + draw.choice([".", "!", "", ". "]))
        for _ in range(n)
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.select("*", *[F.lit(1).alias(n) for n in ("part", "seq", "key", "copies", "draw", "again", "state", "letters", "c", "piece")])
    got = {r[0]: tuple(r)[1:] for r in C.repair_conversations(*C.damaged(df)).collect()}
    want = {conv: plain_repair(own) for conv, own in plain_damage(rows).items()}
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_small_conversations_equal_a_search(spark):
    check(spark, [(k, t, r, x) for k in range(60) for _, t, r, x in some_rows(k, k % 13, 1)])


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 7)
    check(spark, [*some_rows(3, 400, 3), *[(9, t, "user", "again and again.") for t in range(60)], *[(8, 1, "user", "x.")] * 50], extra=True)


def test_one_conversation_over_all_ranges(spark):
    draw = random.Random(4)
    check(spark, [(5, k, ["user", "assistant"][k % 2 ^ (draw.random() < 0.1)], f"{k} words" + draw.choice([".", ".", ""])) for k in range(1500)])


def test_pieces_cross_like_the_whole():
    for seed in range(60):
        seen, rows = set(), []
        for _, turn, role, text in some_rows(seed, 14, 1):
            role, text = role or " ", text or " "
            rows.append(C.Row(turn, role, text, 1 + seed % 3 * (seed % 2), (role, text) in seen))
            seen.add((role, text))
        weights = C.Weights(C.width_of(rows))
        whole = weights.read(C.weigh(weights, rows, C.inserting(weights, [0, None, None, 0]))[C.START])
        for at in ([5], [1, 2, 9], [13]):
            cuts = [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)])]
            cost, audit, taken = C.joined([C.crossings(part) for part in cuts])
            assert (cost, audit) == (whole[0], C.spelled(*whole[1:]))
            out = [p for part, (state, letters) in zip(cuts, taken) for p in C.repaired(part, state, letters)]
            assert out == list(C.repaired(rows, C.START, "".join(a for _, a in taken)))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, None, None, None), (2, 0, "user", "a" * 300_000)], [(0, t, "user", "x.") for t in range(40)]])
def test_odd_tables(spark, rows):
    check(spark, rows)


def test_weights_order_costs_then_letters():
    weights = C.Weights(6)
    value = lambda cost, word: weights.before(int("".join(str(C.LETTERS.index(x)) for x in word) or "0", 8), len(word), cost, 0)
    pairs = [(c, w) for c in (0, 3, 4) for w in ("", "D", "DI", "DK", "I", "K", "KD", "R", "RRRRRR")]
    assert sorted(pairs) == sorted(pairs, key=lambda p: value(*p))
    assert all((c, w) == (weights.read(value(c, w))[0], C.spelled(*weights.read(value(c, w))[1:])) for c, w in pairs)

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxolith.llm.packing import VOCABULARY, pack_documents, padding_share, tail, windows
from taxolith.llm.token_bins import best_fit, token_bins, write_token_bins


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def cheapest(positions, penalties, size):
    """All ways to cut, by brute force; the last window is free of padding."""
    n = len(positions)
    best = float("inf")
    for k in range(n - 1):
        for inner in itertools.combinations(range(1, n - 1), k):
            cuts = [0, *inner, n - 1]
            if all(positions[b] - positions[a] <= size for a, b in itertools.pairwise(cuts)):
                best = min(best, sum(size - (positions[b] - positions[a]) + penalties[b] for a, b in itertools.pairwise(cuts[:-1])))
    return best


def test_windows_are_optimal():
    draw = random.Random(3)
    for _ in range(150):
        n = draw.randint(2, 10)
        positions = [0, *itertools.accumulate(draw.randint(1, 6) for _ in range(n))]
        penalties = [draw.choice([0, 1, 3, 5]) for _ in positions]
        size = draw.randint(6, 12)
        cuts = windows(positions, penalties, size)
        assert cuts[0] == 0 and cuts[-1] == n
        cost = sum(size - (positions[b] - positions[a]) + penalties[b] for a, b in itertools.pairwise(cuts[:-1]))
        assert cost == cheapest(positions, penalties, size)


def test_tail_fills_or_pads():
    assert tail(1000, 1024, 12) == [1000]
    assert tail(768, 1024, 12) == [512, 256]
    assert sum(tail(333, 1024, 12)) == 333


@pytest.mark.parametrize("block", [64, 1 << 18])
def test_every_id_once(spark, docs, odd, tokenizer, block):
    pairs = odd[:-1] + [(100 + k, t) for k, (_, t) in enumerate(odd[:9])]
    pieces = pack_documents(docs(pairs).coalesce(2), max_tokens=64, block_tokens=block).collect()
    want = sorted((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in pairs)
    found = {}
    for p in pieces:
        ids = [int.from_bytes(p.ids[k : k + 4], "little") for k in range(0, len(p.ids), 4)]
        assert len(ids) == p.length
        found.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
    copies = {i: sum(1 for x, _ in pairs if x == i) for i, _ in pairs}
    for i, ids in want:
        parts = sorted(found[i])
        assert all(n == len(ids) for _, _, n in parts)
        covered = sorted(s + k for s, part, _ in parts for k in range(len(part)))
        assert covered == sorted(list(range(len(ids))) * copies[i])
        assert all(list(ids[s : s + len(part)]) == part for s, part, _ in parts)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


def test_little_padding_and_order(spark, docs):
    from tests.llm.conftest import prose

    pairs = [(k, prose(k, 20 + 37 * k % 500)) for k in range(120)]
    pieces = pack_documents(docs(pairs).coalesce(1), max_tokens=256, order_by="doc_id", partitions=1)
    assert padding_share(pieces, 256).first().padding < 0.03
    rows = pieces.orderBy("sequence_id", "offset").collect()
    assert [(r.doc_id, r.start) for r in rows] == sorted((r.doc_id, r.start) for r in rows)


def test_query_crc(spark, docs):
    row = pack_documents(docs([(1, "hello world")])).select("ids", F.crc32("ids").alias("c")).first()
    assert row.c == zlib.crc32(bytes(row.ids))


def test_empty_table(spark, docs):
    assert pack_documents(docs([(1, "x")]).limit(0)).count() == 0
    assert token_bins(docs([(1, "x")]).limit(0)).count() == 0


def test_best_fit_matches_plain_search():
    draw = random.Random(5)
    for _ in range(60):
        size = draw.randint(4, 40)
        lengths = [draw.randint(1, size) for _ in range(draw.randint(0, 40))]
        bins = best_fit(lengths, size)
        assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
        loads = []
        for n in sorted(lengths, reverse=True):
            room = [k for k, used in enumerate(loads) if size - used >= n]
            if room:
                loads[max(room, key=lambda k: loads[k])] += n
            else:
                loads.append(n)
        assert sorted(sum(lengths[k] for k in b) for b in bins) == sorted(loads)


def test_token_bins_round_trip(spark, docs, odd, tokenizer):
    rows = token_bins(docs(odd[:-1]), max_tokens=64, pad_id=7).collect()
    found = {}
    for r in rows:
        ids = [int.from_bytes(r.token_ids[k : k + 2], "little") for k in range(0, 128, 2)]
        positions = [int.from_bytes(r.position_ids[k : k + 2], "little") for k in range(0, 128, 2)]
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == r.n_segments + 1
        assert all(x == 7 for x in ids[r.n_tokens :])
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts):
            assert positions[a:b] == list(range(b - a))
            found.setdefault(doc, []).append((start, ids[a:b]))
    for i, t in odd[:-1]:
        want = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        parts = sorted(found[i])
        assert [x for _, p in parts[:: 2 if i == 9 else 1] for x in p] == want


def test_token_bins_are_written_and_read_back(spark, docs, odd, tmp_path):
    rows = token_bins(docs(odd), max_tokens=64)
    write_token_bins(rows.repartition(3), str(tmp_path / "bins"))
    back = spark.read.parquet(str(tmp_path / "bins"))
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    for part in (tmp_path / "bins").glob("part-*"):
        own = [r["sequence_id"] for r in spark.read.parquet(str(part)).collect()]
        assert own == sorted(own)
    write_token_bins(rows.where("false"), str(tmp_path / "bins"))
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "bins")).count() == 0

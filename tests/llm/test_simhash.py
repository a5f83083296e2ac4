import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from taxolith.llm.common import components
from taxolith.llm.simhash import block_masks, finer_masks, hamming_links, keep_first, near_duplicates, similar_groups
from tests.llm.conftest import prose


def plain_fingerprint(text, size=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Smallest reachable id, by brute force."""
    out = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and out[b] < out[a]:
                    out[a] = out[b]
                    changed = True
    return out


def edited(text, seed, n):
    draw = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = "changed" + str(draw.randrange(9))
    return " ".join(words)


def test_documents_match_brute_force(spark, docs, odd):
    pairs = [p for p in odd if p[0] is not None and p[0] != 9]
    pairs += [(50 + 3 * k + j, edited(prose(k, 300), j, j)) for k in range(12) for j in range(3)]
    want = {i: plain_fingerprint(t) for i, t in pairs}
    classes = plain_components(want, 2)
    got = near_duplicates(docs(pairs + [(None, "no id")])).collect()
    assert {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in got} == want
    assert {r.doc_id: r.component_id for r in got} == classes
    assert want[1] == want[2] == want[3] == 0


def test_repeated_rows_and_empty_table(spark, docs):
    rows = near_duplicates(docs([(3, "a b c d"), (3, "a b c d"), (1, "A b c d")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (3, 1), (3, 1)]
    assert near_duplicates(docs([(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("limit", [3, 4096])
@pytest.mark.parametrize("radius,blocks", [(2, 4), (4, 6)])
def test_links_reach_all_pairs(spark, radius, blocks, limit):
    """A crowded ball of fingerprints, split again and again under a small bucket limit."""
    draw = random.Random(radius)
    prints = set()
    for center in (0, (1 << 64) - 1, draw.getrandbits(64)):
        for _ in range(24):
            f = center
            for _ in range(draw.randrange(5)):
                f ^= 1 << draw.randrange(64)
            prints.add(f)
    prints = dict(enumerate(sorted(prints)))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in prints.items()]
    links = hamming_links(spark.createDataFrame(rows, "node long, fingerprint long"), radius, blocks, limit)
    found = links.collect()
    assert all((prints[r.a] ^ prints[r.b]).bit_count() == r.distance <= radius for r in found)
    roots = {r.node: r.root for r in components(links).collect()}
    assert {i: roots.get(i, i) for i in prints} == plain_components(prints, radius)


def test_masks_cover():
    assert len(block_masks(2, 4)) == 6
    draw = random.Random(1)
    for _ in range(200):
        diff = sum(1 << b for b in draw.sample(range(64), 2))
        assert any(not diff & m for m in block_masks(2, 4))
        mask = block_masks(2, 4)[0]
        if not diff & mask:
            assert any(not diff & m for m in finer_masks(mask, 2))
    assert finer_masks((1 << 64) - 4, 2) == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_similar_groups(spark, docs, odd):
    base = [prose(1000 + k, 400) for k in range(8)]
    pairs = [(10 * k + 100, t) for k, t in enumerate(base)]
    pairs += [(10 * k + 101 + j, edited(t, 7 * k + j, 1 + j)) for k, t in enumerate(base) for j in range(3)]
    pairs += [(10 * k + 108, edited(t, k, 200)) for k, t in enumerate(base)]  # too far
    pairs += [(9000 + i, t) for i, t in odd[:-1]]
    groups = {r.doc_id: r.component_id for r in similar_groups(docs(pairs)).collect()}
    for k in range(8):
        assert {groups[10 * k + 101 + j] for j in range(3)} == {10 * k + 100}
        assert groups[10 * k + 108] == 10 * k + 108
    assert groups[9006] == groups[9007] == 9006  # the same words but for case
    assert groups[9008] == groups[9009] == 9008
    assert groups[9001] == groups[9002] == groups[9003] == 9001
    assert groups[9010] == groups[9011] == 9010
    assert similar_groups(docs(pairs).limit(0)).count() == 0


def test_reordered_words_are_not_similar(spark, docs):
    words = prose(5, 200).split()
    other = words[::-1]
    groups = {r.doc_id: r.component_id for r in similar_groups(docs([(1, " ".join(words)), (2, " ".join(other))])).collect()}
    assert groups == {1: 1, 2: 2}


def test_hex(spark, docs):
    row = near_duplicates(docs([(1, "")])).select(F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("f")).first()
    assert row.f == "0" * 16


def word_jaccard(x, y, size=5):
    a, b = ({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} for w in (x.lower().split(), y.lower().split()))
    return len(a & b) / len(a | b)


def plain_groups(pairs, similarity=0.8):
    """Smallest reachable id over all pairs that are alike enough."""
    out = {i: i for i, _ in pairs}
    links = [(i, j) for i, x in pairs for j, y in pairs if i < j and word_jaccard(x, y) >= similarity]
    for _ in pairs:
        for i, j in links:
            out[i] = out[j] = min(out[i], out[j])
    return out


def test_unlike_texts_hide_no_similar_pair(spark, docs):
    """The least id has the words of two near copies in another order, so all three share a word set."""
    pairs = []
    for k in range(4):
        words = sorted(set(prose(300 + k, 600).split()))
        random.Random(k).shuffle(words)
        swapped = list(words)
        swapped[40], swapped[90] = words[90], words[40]
        pairs += [(10 * k + 1, " ".join(sorted(words))), (10 * k + 2, " ".join(words)), (10 * k + 3, " ".join(swapped))]
    want = plain_groups(pairs)
    assert all(want[10 * k + 3] == 10 * k + 2 for k in range(4))
    assert {r.doc_id: r.component_id for r in similar_groups(docs(pairs)).collect()} == want


def test_appended_cut_and_edited_copies_match_brute_force(spark, docs):
    """Copies from 0.8 up by one long edit, which moves the words of a text much further than scattered ones."""
    pairs = []
    for k in range(10):
        words = prose(400 + k, 150 + 20 * k).split()
        more = prose(480 + k, 80).split()
        n = len(words) * (10 + k) // 80
        spliced = words[:50] + more[:n] + words[50:]
        texts = [words, words + more[:n], words[n:] if n < len(words) // 5 else words[: -(len(words) // 6)], spliced, words + prose(900 + k, 400).split()]
        pairs += [(20 * k + j, " ".join(t)) for j, t in enumerate(texts)]
        pairs.append((20 * k + 9, edited(" ".join(words), k, 2 + k // 2)))
    want = plain_groups(pairs)
    assert sum(i != g for i, g in want.items()) > 20 and all(want[20 * k + 4] == 20 * k + 4 for k in range(10))
    assert {r.doc_id: r.component_id for r in similar_groups(docs(pairs)).collect()} == want


def test_components_of_a_long_chain(spark):
    """Far longer than any fixed number of rounds would settle."""
    edges = spark.createDataFrame([(k, k + 1) for k in range(3000)], "a long, b long")
    assert components(edges).groupBy("root").count().collect() == [(0, 3001)]


def test_families_of_near_copies(spark, docs):
    """Six copies each, edited independently, so that many pairs lie close to 0.8."""
    pairs = []
    for k in range(40):
        base = prose(7000 + k, 150)
        pairs += [(10 * k + j, edited(base, 100 * k + j, j)) for j in range(6)]
    links = sum(word_jaccard(x, y) >= 0.8 for i, x in pairs for j, y in pairs if i < j and i // 10 == j // 10)
    assert links > 150
    assert {r.doc_id: r.component_id for r in similar_groups(docs(pairs)).collect()} == plain_groups(pairs)


def test_keep_first(spark, docs, odd):
    near = edited(prose(8, 120), 1, 1)
    frame = docs([*odd, (20, near), (21, prose(21, 50)), (21, near), (None, near), (22, prose(21, 50))])
    out = keep_first(frame)
    assert out.columns == frame.columns
    kept = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    texts = dict(odd)
    assert kept == sorted([(0, "no id"), (0, near), (1, ""), (4, "one"), (5, "one two"), (6, texts[6]), (8, texts[8]), (10, texts[10]), (12, texts[12]), (13, texts[13]), (15, texts[15]), (21, prose(21, 50)), (21, near)])
    assert keep_first(frame.limit(0)).count() == 0


def test_templated_texts_are_not_paired_one_by_one(spark, monkeypatch):
    """Pages of three of twenty passages: pairs that share a passage are many, those that may be alike are few."""
    import random

    from taxolith.llm import simhash

    made = []
    whole = simhash.unlike_groups

    def counted(rows, similarity):
        out = whole(rows, similarity)
        made.append(out.count())
        return out

    monkeypatch.setattr(simhash, "unlike_groups", counted)
    monkeypatch.setattr(simhash, "CHUNK", 50)
    draw = random.Random(1)
    words = [f"w{k}" for k in range(4000)]
    passages = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(20)]
    texts = [" ".join(draw.sample(passages, 3)) for _ in range(300)]
    got = {r["doc_id"]: r["component_id"] for r in similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [set(zip(*(t.split(" ")[k:] for k in range(5)))) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {k: find(k) for k in range(len(texts))}
    assert made[0] < 300


def test_parity_bitmaps_never_differ_by_more_than_the_sets():
    import numpy as np

    from taxolith.llm.simhash import parity

    draw = np.random.default_rng(3)
    for n in (0, 1, 40, 3000):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], draw.integers(0, 2**63, n // 3).astype(np.uint64)]))
        apart = int(np.bitwise_count((parity(a) ^ parity(b)).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b)) and apart % 2 == len(np.setxor1d(a, b)) % 2


def test_near_copies_reach_python_in_small_batches(spark, docs, monkeypatch):
    """An executor's tasks hold a few megabytes of texts each, whatever Spark's own bound; it holds again afterwards."""
    from taxolith.llm import simhash

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    seen, write = [], simhash.shingle_prefixes
    monkeypatch.setattr(simhash, "shingle_prefixes", lambda *a: seen.append(int(spark.conf.get(name).rstrip("b"))) or write(*a))
    before = spark.conf.get(name)
    assert keep_first(docs([(1, prose(1, 50)), (2, prose(1, 50)), (3, None)])).count() == 2
    assert seen and max(seen) <= 1 << 22 and spark.conf.get(name) == before


def test_a_worker_gives_up_the_chunks_of_a_tokenizer():
    """Before texts are hashed, and not while a tokenizer's own operator runs."""
    import pyarrow as pa

    from taxolith.llm import common

    common.ChunkTokenizer.get("byte_bpe_50k.json").encode("some words to know")
    assert common._TOKENIZERS
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64()), pa.array(["é" * 3_000_000, None, "x" * 1_500_000])], names=["doc_id", "text"])
    assert [(k, [len(t or "") for t in v]) for k, v in common.texts([batch, batch.slice(0, 0)], "doc_id", "text")] == [([1, 2, 3], [3_000_000, 0, 1_500_000])]
    assert not common._TOKENIZERS


def test_shingles_are_counted_in_all_texts(spark):
    """A passage in 60 texts of 50,000, none of which a sample of every other id holds, is tried after what is rare."""
    from taxolith.llm.simhash import BUCKET_BITS, shingle_hashes, shingle_levels, shingle_prefixes

    few = spark.range(50_000, 50_400).where("pmod(xxhash64(id), 2) = 1").limit(60).selectExpr("id as doc_id", "concat('one two three four five own', id) as text")
    rows = few.union(spark.range(50_000).selectExpr("id", "concat('w', id)"))
    passage = int(shingle_hashes("one two three four five", 5)[0])
    found = shingle_prefixes(rows, 5, 0.8).where("doc_id >= 50000").collect()
    assert len(found) == 60 and all(len(r.prefix) == 1 and r.prefix[0] & (1 << 64) - 1 != passage for r in found)
    levels = shingle_levels(rows, 5)
    assert levels.shape == (1 << BUCKET_BITS,) and levels[passage >> 64 - BUCKET_BITS] in range(47, 50)  # 8 log2(61) = 47.4
    assert not shingle_levels(rows.limit(0), 5).any()


def test_shingle_counts_match_brute_force(spark, odd, monkeypatch):
    """Also where a task's counts take more than a byte, and over any number of tasks."""
    from collections import Counter

    import numpy as np

    from taxolith.llm.simhash import BUCKET_BITS, PART, count_shingles, shingle_hashes

    pairs = [(k, t) for k, (_, t) in enumerate(odd * 300)]
    want = Counter(int(h) >> 64 - BUCKET_BITS for _, t in odd for h in np.unique(shingle_hashes(t, 5)))
    for tasks in (1, 7):
        got = count_shingles(spark.createDataFrame(pairs, "doc_id long, text string").repartition(tasks), 5).collect()
        counts = {r.part * PART + k: n for r in got for k, n in enumerate(np.frombuffer(r.counts, np.int64).tolist()) if n}
        assert len({r.part for r in got}) == len(got) and counts == {b: 300 * n for b, n in want.items()}

"""Operator 2: SimHash near-duplicates by a Gray-order hierarchical index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.llm.common import components, cut, may_hold, shared_table, small_batches, texts, unused

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD_BITS = 64
#: The index compares this many bits of the fingerprints at each level of its tree.
LEVEL_BITS = 16
#: Times that a crowded bucket is dealt anew.
SPLITS = 3
#: Bits of the buckets that shingles are counted in, and buckets to a row.
BUCKET_BITS, PART = 22, 1 << 10


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def shingles_of(words: list[bytes], size: int) -> list[bytes]:
    """Word shingles, repeats included; fewer words than ``size`` are one shingle, none are none."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(t) for t in zip(*(words[k:] for k in range(size)))]


def shingle_hashes(text: str | None, size: int):
    """XXH64 (seed 42) of each shingle as an unsigned array."""
    import numpy as np
    import xxhash

    shingles = shingles_of(words_of(text), size)
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype=np.uint64, count=len(shingles))


def simhash(hashes) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number; zero for none."""
    import numpy as np

    n = len(hashes)
    if not n:
        return 0
    octets = hashes.astype("<u8").view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256, dtype=np.uint16)
    seen = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return int(np.packbits((seen @ bits) * 2 > n, axis=1, bitorder="little").ravel().view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """SimHash of every text: ``doc_id, fingerprint`` (64 bits as a long)."""

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for keys, values in texts(batches, "doc_id", "text"):
            columns = [pa.array(keys, pa.int64()), pa.array([simhash(shingle_hashes(t, shingle)) for t in values], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(compute, "doc_id long, fingerprint long")


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit word in Gray order: each bit is the parity of the bits from it up."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of ``blocks - radius`` of ``blocks`` bit blocks.

    Words that differ in at most ``radius`` bits agree on all bits of one such mask.
    """
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    edges = [WORD_BITS * k // blocks for k in range(blocks + 1)]
    spans = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(spans, blocks - radius)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with one of ``radius + 1`` parts of its free bits added; none if too few are free."""
    free = [k for k in range(WORD_BITS) if not mask >> k & 1]
    if len(free) <= radius:
        return []
    edges = [len(free) * k // (radius + 1) for k in range(radius + 2)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(edges, edges[1:])]


def signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


class GrayIndex:
    """A tree over fingerprints in Gray order, one root for each bucket.

    Sorted by Gray rank, fingerprints with the same leading bits lie together, so a node
    of a level is a run that shares the bit pattern of all levels above. ``links`` walks
    pairs of nodes from the roots down and adds up the differences of the patterns that
    the two do not share; a pair beyond the radius is dropped with everything below it.
    """

    def __init__(self, buckets, prints):
        import numpy as np

        self.np = np
        self.prints = prints
        levels = [np.concatenate([[True], buckets[1:] != buckets[:-1]])]
        for shift in range(WORD_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
            part = prints >> np.uint64(shift)
            levels.append(levels[-1] | np.concatenate([[True], part[1:] != part[:-1]]))
        self.starts = [np.flatnonzero(x) for x in levels]
        self.children = []
        for upper, lower in zip(self.starts, self.starts[1:]):
            first = np.searchsorted(lower, upper)
            self.children.append((first, np.diff(np.append(first, len(lower)))))

    def links(self, radius: int, budget: int = 1_500_000):
        """Pairs of different leaves with their distance, in chunks of bounded size."""
        np = self.np
        _, width = self.children[0]
        load = np.cumsum(width.astype(np.int64) ** 2)
        at = 0
        while at < len(load):
            to = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + budget, side="right")))
            roots = np.arange(at, to)
            yield from self.expand(0, roots, roots, np.zeros(len(roots), np.int64), radius, budget)
            at = to

    def expand(self, level, a, b, distance, radius, budget):
        np = self.np
        if level == len(self.children):
            keep = a < b
            if keep.any():  # a leaf is the first row of its fingerprint
                yield self.starts[-1][a[keep]], self.starts[-1][b[keep]], distance[keep]
            return
        first, width = self.children[level]
        shift = np.uint64(WORD_BITS - LEVEL_BITS * (level + 1))
        patterns = self.prints[self.starts[level + 1]] >> shift
        size = width[a].astype(np.int64) * width[b]
        ends = np.cumsum(size)
        at = 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + budget, side="right")))
            n = size[at:to]
            which = np.repeat(np.arange(at, to), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            wide = width[b[which]]
            x, y = first[a[which]] + place // wide, first[b[which]] + place % wide
            keep = (a[which] != b[which]) | (x <= y)
            x, y, which = x[keep], y[keep], which[keep]
            # the levels above are counted already: only this level's bits can differ anew
            fresh = (patterns[x] ^ patterns[y]) & np.uint64((1 << LEVEL_BITS) - 1)
            total = distance[which] + np.bitwise_count(fresh)
            keep = total <= radius
            yield from self.expand(level + 1, x[keep], y[keep], total[keep], radius, budget)
            at = to


def forest(n: int, chunks: Iterator):
    """A spanning forest of the links, nearest first within each chunk: indexes and distances."""
    import numpy as np

    parent = np.arange(n)

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for a, b, distance in chunks:
        order = np.argsort(distance, kind="stable")
        for at in range(0, len(order), 8192):
            part = order[at : at + 8192]
            roots = parent
            while True:
                up = roots[roots]
                if (up == roots).all():
                    break
                roots = up
            parent[:] = roots
            part = part[roots[a[part]] != roots[b[part]]]
            for x, y, d in zip(a[part].tolist(), b[part].tolist(), distance[part].tolist()):
                p, q = find(x), find(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((x, y, d))
    return out


def gray_order(code: Column) -> Column:
    """The Gray rank as a signed number that sorts as the unsigned one."""
    return gray_rank(code).bitwiseXOR(F.lit(-(1 << 63)))


def chunk_pairs(rows: DataFrame, half: int) -> DataFrame:
    """Crowded buckets ``(mask, pattern, c, f, n)``, c fingerprints each, as groups of two chunks of ``half`` in Gray order.

    Every two fingerprints of a bucket meet in one of the groups, which are tasks of their own.
    """
    order = Window.partitionBy("mask", "pattern").orderBy(gray_order(F.col("f")))
    chunks = F.ceil(F.col("c") / half)
    own = F.floor((F.row_number().over(order) - 1) / half)
    spread = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    pair = F.least("_own", "_other") * chunks + F.greatest("_own", "_other")
    return spread.select("mask", "pattern", pair.cast("long").alias("pair"), "f", "n")


def hamming_links(nodes: DataFrame, radius: int = 2, blocks: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """Links ``(a, b, distance)`` that connect all ``nodes(node, fingerprint)`` within ``radius`` bits.

    Fingerprints meet in buckets: those within the radius agree on ``blocks - radius`` of
    ``blocks`` bit blocks, so each is dealt once for every such choice. A bucket of more
    than ``bucket_limit`` fingerprints is dealt anew by a part of its other bits, by the
    same argument, up to three times for a radius of 3 or less; what is still crowded is
    cut into chunks, each two of which are a group (``chunk_pairs``). So no task gets an
    unbounded bucket and no pair is lost. In a bucket the Gray-order tree finds all pairs within the
    radius, and a spanning forest of them, nearest first, is returned: it joins exactly
    what all pairs would join. Nodes with equal fingerprints are chained at distance 0.

    With b = ``blocks - radius`` blocks of ``64 b / blocks`` shared bits, a bucket of N
    random fingerprints holds N / 2^bits: raise ``blocks`` as N grows.
    """
    spark = nodes.sparkSession
    base = nodes.select(F.col("fingerprint").alias("f"), F.col("node").alias("n"))
    same = base.groupBy("f").agg(F.min("n").alias("first"))
    # equal fingerprints: each to the smallest node, which alone enters the buckets
    equal = base.join(same, "f").where("n != first").select(F.col("first").alias("a"), F.col("n").alias("b"), F.lit(0).alias("distance"))
    masks = block_masks(radius, blocks)
    rows = same.select(F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"), "f", F.col("first").alias("n"))
    rows = rows.withColumn("pattern", F.col("f").bitwiseAND(F.col("mask")))
    keyed = None
    for depth in range(SPLITS + 1):
        crowded = cut(rows.groupBy("mask", "pattern").agg(F.count("*").alias("c")).where(F.col("c") > bucket_limit))
        none = crowded.isEmpty()
        fits = rows if none else rows.join(crowded, ["mask", "pattern"], "left_anti")
        fits = fits.select("mask", "pattern", F.lit(0).cast("long").alias("pair"), "f", "n")
        keyed = fits if keyed is None else keyed.union(fits)
        if none:
            break
        rows = rows.join(crowded, ["mask", "pattern"])
        # one row for each mask in use: their number depends on radius and blocks alone
        in_use = [r["mask"] & (1 << WORD_BITS) - 1 for r in crowded.select("mask").distinct().collect()]
        deeper = {m: finer_masks(m, radius) for m in in_use}
        if depth == SPLITS or radius > 3 or not all(deeper.values()):
            keyed = keyed.union(chunk_pairs(rows, max(1, bucket_limit // 2)))
            break
        finer = spark.createDataFrame([(signed(m), [signed(x) for x in d]) for m, d in deeper.items()], "mask long, finer array<long>")
        rows = rows.join(F.broadcast(finer), "mask").select(F.explode("finer").alias("mask"), "f", "n").distinct()
        rows = cut(rows.withColumn("pattern", F.col("f").bitwiseAND(F.col("mask"))))

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def differ(mask, pattern, pair):
            return (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]) | (pair[1:] != pair[:-1])

        def solve(mask, pattern, pair, f, n):
            change = differ(mask, pattern, pair)
            bucket = np.concatenate([[0], np.cumsum(change)])
            crowd = np.bincount(bucket)[bucket] > 1  # a lone fingerprint has no partner here
            bucket, f, n = bucket[crowd], f[crowd], n[crowd]
            if not len(f):
                return None
            found = forest(len(f), GrayIndex(bucket, f.view(np.uint64)).links(radius))
            if not found:
                return None
            a, b, d = (np.array(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(n[a], pa.int64()), pa.array(n[b], pa.int64()), pa.array(d, pa.int32())], names=["a", "b", "distance"])

        held = None
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            held = new if held is None else [np.concatenate([x, y]) for x, y in zip(held, new)]
            last = np.flatnonzero(differ(*held[:3]))
            if len(held[0]) >= 50_000 and len(last):
                to = int(last[-1]) + 1
                out = solve(*(x[:to] for x in held))
                held = [x[to:] for x in held]
                if out is not None:
                    yield out
        if held is not None and len(held[0]):
            out = solve(*held)
            if out is not None:
                yield out

    dealt = keyed.repartition("mask", "pattern", "pair").withColumn("gray", gray_order(F.col("f")))
    dealt = dealt.sortWithinPartitions("mask", "pattern", "pair", "gray").select("mask", "pattern", "pair", "f", "n")
    return dealt.mapInArrow(search, "a long, b long, distance int").union(equal)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, blocks: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """Near-duplicate classes: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is the SimHash of the text's word shingles (a long); documents whose
    fingerprints differ in at most ``radius`` bits are linked, and ``component_id`` is the
    smallest id reachable over links, itself included.

    Null and empty texts have fingerprint zero and are linked like any other; a text of
    fewer words than a shingle is one shingle; null ids take no part and are left out;
    repeated rows keep a row each; an empty table gives no rows; other columns are left out.
    """
    prints = cut(fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle))
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    roots = components(hamming_links(classes, radius, blocks, bucket_limit))
    classes = classes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, hashes``: the different shingle hashes of every text."""

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for keys, values in texts(batches, "doc_id", "text"):
            sets = [np.unique(shingle_hashes(t, size)).view(np.int64) for t in values]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(compute, "doc_id long, hashes array<long>")


def prefix_size(n: int, similarity: float) -> int:
    """How many of the ``n`` first shingles of a set hold one of every set as alike as asked for."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


#: Longs of a set's parity bitmap, and rows of a shingle that one task compares with as many others.
PARITY, CHUNK = 8, 4096


def parity(hashes):
    """512 bits, each flipped by every hash that falls on it.

    Bitmaps of two sets differ in no more bits than the sets differ in members, so many
    different bits prove that two sets are unlike; it is never the other way round.
    """
    import numpy as np

    flips = np.bincount((hashes >> np.uint64(7)).astype(np.int64) & 64 * PARITY - 1, minlength=64 * PARITY) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def level(counts):
    """Counts as bytes, eight steps for a factor of two."""
    import numpy as np

    return np.rint(8 * np.log2(1 + counts)).clip(0, 255).astype(np.uint8)


def count_shingles(rows: DataFrame, size: int, levels: bool = False) -> DataFrame:
    """``part, counts``: how many shingles of texts fall into each bucket, ``PART`` buckets to a row; parts that are missing hold zeros.

    A bucket is the first ``BUCKET_BITS`` bits of a hash. Every shingle of every text is counted, once for a
    text. A task adds up an array of fixed size and sends those of its parts that are not empty, in as
    few bytes as hold them. Counts are longs or, with ``levels``, bytes (``level``).
    """

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for _, values in texts(batches, "doc_id", "text"):
            for text in values:
                np.add.at(counts, np.unique(shingle_hashes(text, size)) >> np.uint64(64 - BUCKET_BITS), 1)
        counts = counts.reshape(-1, PART)
        most = counts.max(axis=1)
        held = np.flatnonzero(most)
        packed = [counts[k].astype(np.min_scalar_type(most[k])).tobytes() for k in held]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(packed, f"u{len(packed) // PART}").astype(np.int64)
        found = [(level(x) if levels else x).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(found, pa.binary())], names=["part", "counts"])

    kind = "part int, counts binary"
    return rows.select("doc_id", "text").mapInArrow(count, kind).repartition("part").mapInArrow(add, kind)


def shingle_levels(rows: DataFrame, size: int):
    """How frequent the shingles of each bucket are (``count_shingles``), a byte for each: eight steps for a factor of two.

    The counts are those of all texts. A shingle that many texts share makes its bucket a frequent one, so it is
    tried late; a rare one beside it comes late too. That decides in which order
    shingles are tried, never which pairs are found. The driver gets one byte for a bucket, 4 MB whatever the input.
    """
    import numpy as np

    levels = np.zeros(1 << BUCKET_BITS, np.uint8).reshape(-1, PART)
    for part, found in count_shingles(rows, size, levels=True).collect():
        levels[part] = np.frombuffer(found, np.uint8)
    return levels.ravel()


def shingle_prefixes(rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """``doc_id, same, fingerprint, n, bits, prefix``: SimHash, number, parity bitmap of the different shingles, and the first of them in a fixed order.

    The order is the same for all texts: rare shingles before frequent ones (``shingle_levels``), then by hash.
    ``same`` is equal for equal sets of shingles only (128-bit hash as a string).
    """
    known = rows.sparkSession.sparkContext.broadcast(shingle_levels(rows, size))

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        levels = known.value
        for keys, values in texts(batches, "doc_id", "text"):
            same, prints, sizes, bits, prefixes = [], [], [], [], []
            for text in values:
                own = np.unique(shingle_hashes(text, size))
                same.append(xxhash.xxh128_hexdigest(own.tobytes()))
                prints.append(simhash(own))
                sizes.append(len(own))
                bits.append(parity(own))
                own = own[np.argsort(levels[own >> np.uint64(64 - BUCKET_BITS)], kind="stable")]
                prefixes.append(own[: prefix_size(len(own), similarity)].view(np.int64))
            lists = [pa.array(v, pa.list_(pa.int64())) for v in (bits, prefixes)]
            columns = [pa.array(keys, pa.int64()), pa.array(same), pa.array(prints, pa.int64()), pa.array(sizes, pa.int32()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "fingerprint", "n", "bits", "prefix"])

    return rows.mapInArrow(compute, "doc_id long, same string, fingerprint long, n int, bits array<long>, prefix array<long>")


def unlike_groups(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of nodes of different groups that share a shingle and may be as alike as asked for.

    ``rows(h, node, g, n, pos, bits)``: a node in group ``g`` has shingle ``h`` at place ``pos``
    of its ``n``. What is left of both sets from there on must hold the overlap needed, and the parity
    bitmaps may not differ in more bits than the sets may in members; pairs that fail
    either never leave the join. A shingle of more than ``CHUNK`` rows is cut into chunks, each two of which
    meet in a task of their own.
    """
    sizes = rows.groupBy("h").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = rows.select("h", "node", "g", "n", "pos", *[F.col("bits")[k].alias(f"b{k}") for k in range(PARITY)]).join(sizes, "h")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "chunks")
    x, y = dealt.alias("x"), dealt.alias("y")
    col = lambda side, name: F.col(f"{side}.{name}")
    once = (col("x", "own") != col("y", "own")) | (col("x", "i") == col("x", "j"))
    total = col("x", "n") + col("y", "n")
    reach = F.least(col("x", "n") - col("x", "pos"), col("y", "n") - col("y", "pos")) * (1 + similarity) >= similarity * total - 1e-6
    apart = sum((F.bit_count(col("x", f"b{k}").bitwiseXOR(col("y", f"b{k}"))) for k in range(PARITY)), F.lit(0))
    near = apart * (1 + similarity) <= (1 - similarity) * total + 1e-6
    same_task = (col("x", "h") == col("y", "h")) & (col("x", "i") == col("y", "i")) & (col("x", "j") == col("y", "j"))
    pairs = x.join(y, same_task & (col("x", "g") < col("y", "g")) & once & reach & near)
    ends = col("x", "node"), col("y", "node")
    return pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 3, blocks: int = 5) -> DataFrame:
    """Groups of texts with a Jaccard similarity of ``similarity`` or more: ``doc_id, component_id``.

    The similarity is that of the sets of ``shingle``-word shingles; all pairs that have it
    are linked, without chance. Candidates come in three rounds, and the sets themselves decide:

    1. SimHash: fingerprints within ``radius`` bits, by the Gray-order index
       (``hamming_links``). At 0.8 fingerprints differ in 10 bits of 64, more than any index
       can serve, so this round finds the nearer copies only, and the others complete it.
    2. With the shingles of all texts in one order, two sets of sizes m and n that are alike
       enough share one of the first m - ceil(m * similarity) + 1 and n - ceil(n * similarity) + 1
       (``shingle_prefixes``). Texts meet by those, rare ones first, so shingles that many
       texts share seldom bring any together. Each text is compared with the first of each
       shingle, so that large groups are not compared pair by pair.
    3. All pairs that still lie in different groups and share such a shingle are compared,
       but for those that failed before (``unlike_groups``).

    Only a pair whose sizes, places in the order or parity bitmaps rule the similarity out is not compared.
    Equal sets are one node and need no check.

    Null and empty texts and texts without words are one group of their own; a text of fewer
    words than a shingle is one shingle; very long texts are compared whole; null ids take no
    part and are left out; repeated rows keep a row each; of rows that share an id but not
    the text one stands for the id in comparisons with other ids, as many rows come back as
    went in; an empty table gives no rows; other columns are left out, whatever their names.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    prints = shared_table(shingle_prefixes(rows, shingle, similarity))
    classes = shared_table(prints.groupBy("same").agg(F.min(F.struct(F.col("doc_id").alias("node"), "fingerprint", "bits")).alias("one")).select("same", "one.*"))
    # what is left of both sets from the shared shingle on must hold the overlap needed
    fits = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) * (1 + similarity) >= similarity * (F.col("x.n") + F.col("y.n")) - 1e-6

    def alike(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        held = may_hold(rows, "doc_id", ends, "_held").where("_held").drop("_held")
        sets = shingle_sets(held.join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id"]), shingle)
        left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a")
        both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return both.where(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")

    def ordered(pairs: DataFrame) -> DataFrame:
        ends = F.col("x.node"), F.col("y.node")
        return pairs.where(fits & (ends[0] != ends[1])).select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()

    near = shared_table(hamming_links(classes.select("node", "fingerprint"), radius, blocks).select("a", "b"))
    good = shared_table(alike(near))

    # a node goes with one row only: its number of shingles and the place fill one word
    nodes = classes.select(F.col("node").alias("doc_id")).distinct()
    post = prints.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "n", F.posexplode("prefix").alias("pos", "h"))
    post = shared_table(post.select("h", "node", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("np")))
    shared = post.groupBy("h").agg(F.min(F.struct("node", "np")).alias("least"), F.max("node").alias("most"))
    shared = shared_table(shared.where("least.node < most").select("h", "least"))
    side = lambda node, np: F.struct(node.alias("node"), F.shiftright(np, 32).cast("int").alias("n"), np.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"))
    met = may_hold(post, "h", shared.select("h"), "_held").where("_held").join(shared, "h")
    met = shared_table(met.select("h", side(F.col("node"), F.col("np")).alias("x"), side(F.col("least.node"), F.col("least.np")).alias("y")))

    tried = shared_table(ordered(met).join(good, ["a", "b"], "left_anti"))
    good = shared_table(good.union(alike(tried)))
    roots = cut(components(good))
    own = met.select("h", "x", F.col("x.node").alias("node")).join(roots, "node", "left").select("h", "x", F.coalesce("root", "node").alias("g"))
    mixed = own.groupBy("h").agg(F.min("g").alias("least"), F.max("g").alias("most")).where("least < most").select("h")
    own = shared_table(own.join(mixed, "h", "left_semi"))
    own = own.select("h", "x.*", "g").join(classes.dropDuplicates(["node"]).select("node", "bits"), "node")
    more = shared_table(unlike_groups(own, similarity).join(tried, ["a", "b"], "left_anti"))
    roots = components(good.union(alike(more)))
    nodes = classes.join(roots, "node", "left").select("same", F.coalesce("root", "node").alias("component_id"))
    return prints.join(nodes, "same").select("doc_id", "component_id")


def keep_first(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with one document of each group of ``similar_groups``, the one with the smallest id.

    All columns stay, whatever their names. Null, empty and blank texts are one group; rows
    with a null id stay and take no part; of repeated rows one stays; of rows that share an id
    but not the text all stay, unless each of them is in the group of a smaller id; an empty
    table stays empty. Only rows that may go are shuffled.
    """
    with small_batches(docs.sparkSession):
        groups = shared_table(similar_groups(docs, shingle, similarity))
    own = groups.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("component_id")).alias("gone"), F.count("*").alias("n"))
    fate, held = unused(docs, "_gone"), unused(docs, "_held")
    own = shared_table(own.where("gone or n > 1").select(F.col("doc_id").alias(unused(docs, "_own")), F.col("gone").alias(fate)))
    key = own.columns[0]
    marked = may_hold(docs, "doc_id", own.select(key), held)
    some = marked.where(held).join(own, F.col("doc_id") == F.col(key), "left").where(f"not coalesce({fate}, false)")
    once = some.where(F.col(fate).isNotNull()).dropDuplicates(["doc_id", "text"])
    return marked.where(~F.col(held)).union(some.where(F.col(fate).isNull()).select(*marked.columns)).union(once.select(*marked.columns)).drop(held)

"""Operator 7: removal of repeated byte strings by bucket-pointer refinement."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxolith.llm.common import keep_batches_small, may_hold, merged_intervals, shared_table

#: Bytes that are hashed at a time, in some 40 MB of arrays; a longer document is read in overlapping stretches.
STRETCH = 1 << 18
#: Bytes of contexts that are refined at a time, in some 100 times as many bytes of arrays; an anchor's contexts stay together.
REFINED = 1 << 19
PLACE_BITS = 22
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


class Anchors:
    """Chooses an anchor for every string of ``length`` bytes from its content alone.

    The anchor is the q-gram with the least hash in the string, the first of equal ones.
    Equal strings have equal anchors at equal places, and neighbouring strings mostly
    share one, so a document has about ``2 / (length - gram + 2)`` anchors per byte.
    """

    def __init__(self, length: int, gram: int):
        import numpy as np

        if not 8 <= gram <= length:
            raise ValueError("gram must be from 8 to length")
        self.np, self.length, self.gram = np, length, gram
        n = 2 * STRETCH + length + 2
        powers = np.full(n, BASE, dtype=np.uint64)
        inverse = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        powers[0] = inverse[0] = 1
        self.powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)

    def __call__(self, data: bytes, starts, sizes):
        """Anchors of stretches that lie one after the other in ``data``.

        Returns arrays: anchor hash, hash of the whole context, number of the stretch, its
        first string's offset in the stretch, and how many strings share the anchor.
        """
        import xxhash

        np, length, gram = self.np, self.length, self.gram
        octets = np.frombuffer(data, dtype=np.uint8)
        n = len(octets)
        width = length - gram + 1
        empty = np.zeros(0, np.int64)
        if n < length:
            return empty, empty, empty, empty, empty
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(octets * self.powers[:n], dtype=np.uint64)])
        grams = (sums[gram:] - sums[:-gram]) * self.inverse[: n - gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        keys = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
        # sliding minimum: within blocks of one width, minima from the left and from the right
        blocks = -(-len(keys) // width)
        padded = np.full(blocks * width, np.iinfo(np.uint64).max)
        padded[: len(keys)] = keys
        table = padded.reshape(blocks, width)
        left = np.minimum.accumulate(table, axis=1).ravel()
        right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        count = n - length + 1
        anchor = (np.minimum(right[:count], left[width - 1 : width - 1 + count]) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        # strings that end within their own stretch
        sizes, starts = np.asarray(sizes), np.asarray(starts)
        own = np.maximum(sizes - length + 1, 0)
        edge = np.zeros(count + 1, np.int32)
        np.add.at(edge, starts[own > 0], 1)
        np.add.at(edge, (starts + own)[own > 0], -1)
        first = np.zeros(count + 1, bool)
        first[starts[own > 0]] = True
        valid = np.cumsum(edge[:-1]) > 0
        begin = valid & (first[:-1] | np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        at = np.flatnonzero(begin)
        stretch = np.searchsorted(starts, at, side="right") - 1
        stops = np.minimum(np.append(at[1:], count), (starts + own)[stretch])
        view = memoryview(data)
        context = np.fromiter(
            (xxhash.xxh64_intdigest(view[a : b + length - 1], x - a) for a, b, x in zip(at.tolist(), stops.tolist(), anchor[at].tolist())), dtype=np.uint64, count=len(at)
        )
        return grams[anchor[at]].view(np.int64), context.view(np.int64), stretch, at - starts[stretch], stops - at


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, version, anchor, context, at, n``: strings at..at+n-1 of a document of ``docs(doc_id, version, text)`` have one anchor."""

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        anchors = Anchors(length, gram)
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def out():
            bodies = [h[3] for h in held]
            sizes = [len(b) for b in bodies]
            starts = np.cumsum([0, *sizes[:-1]])
            anchor, context, stretch, at, n = anchors(b"".join(bodies), starts, sizes)
            ids, versions, offsets = (np.array([h[k] for h in held]) for k in range(3))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[stretch], pa.int64()), pa.array(versions[stretch], pa.int64()), pa.array(anchor), pa.array(context), pa.array(offsets[stretch] + at, pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "version", "anchor", "context", "at", "n"],
            )

        for batch in batches:
            for doc_id, version, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(len(data) - length + 1, 0), STRETCH):
                    held.append((doc_id, version, at, data[at : at + STRETCH + length - 1]))
                    size += len(held[-1][3])
                    if size >= STRETCH:
                        yield out()
                        size = 0
        if held:
            yield out()

    return docs.select("doc_id", "version", "text").mapInArrow(compute, "doc_id long, version long, anchor long, context long, at long, n long")


def repeated_strings(contexts: list[bytes], length: int):
    """For each context, whether the string of ``length`` bytes at each of its places occurs in another or again.

    Bucket-pointer refinement: every place starts in the bucket of its 8-gram. A bucket is
    refined by sorting its places on the buckets of the places one depth further on, which
    doubles the depth of equal bytes; the refined buckets serve the next round. Places
    alone in a bucket are settled and take no further part. The last round's offset is
    chosen so that the depth is exactly ``length``.
    """
    import numpy as np

    sizes = np.array([len(c) for c in contexts])
    ends = np.repeat(np.cumsum(sizes), sizes)
    octets = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    n = len(octets)
    bucket = np.full(n + length, -1, np.int64)

    def settle(places, keys):
        """Buckets of equal keys; -1 for a place alone in one."""
        bucket[:] = -1
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        shared = count[which] > 1
        bucket[places[shared]] = which[shared]

    depth = 8
    places = np.flatnonzero(np.arange(n) + depth <= ends)
    keys = np.zeros(len(places), np.uint64)
    for k in range(depth):
        keys |= octets[places + k].astype(np.uint64) << np.uint64(8 * k)
    settle(places, keys)
    while depth < length:
        step = min(depth, length - depth)
        places = np.flatnonzero((bucket[:n] >= 0) & (bucket[step : n + step] >= 0) & (np.arange(n) + depth + step <= ends))
        settle(places, bucket[places] << 32 | bucket[places + step])
        depth += step
    found = bucket[:n] >= 0
    return [found[e - s : e - s + max(s - length + 1, 0)] for s, e in zip(sizes.tolist(), np.cumsum(sizes).tolist())]


def runs(flags):
    """Half-open runs of true values."""
    import numpy as np

    change = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(change[::2].tolist(), change[1::2].tolist()))


def refined(batches: Iterator, length: int) -> Iterator:
    """Arrow batches ``anchor, context, s, e`` of ``refine_buckets``, from batches ``anchor, context, body`` sorted by anchor."""
    import pyarrow as pa

    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out():
        rows = [(a, c, s, e) for (a, c, _), f in zip(held, repeated_strings([h[2] for h in held], length)) for s, e in runs(f)]
        held.clear()
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "context", "s", "e"])

    for batch in batches:
        for a, c, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if size >= REFINED and a != held[-1][0]:
                yield out()
                size = 0
            held.append((a, c, body.as_py()))
            size += len(held[-1][2])
    if held:
        yield out()


def refine_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """``anchor, context, s, e``: repeated strings s..e-1 of each context of ``(anchor, context, body)``.

    All contexts of an anchor meet in one task; tasks work through them half a megabyte at a time.
    """
    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor", "context")
    return dealt.select("anchor", "context", "body").mapInArrow(lambda batches: refined(batches, length), "anchor long, context long, s long, e long")


def refine_crowded(contexts: DataFrame, length: int) -> DataFrame:
    """As ``refine_buckets``, for anchors with too many contexts for one task.

    A place's bucket is the hash of the first half of its string, and its pointer the bucket
    of the place where the other half begins; places with equal buckets and pointers repeat
    each other. The sort on (bucket, pointer) is a shuffle, so a crowd is spread over all tasks.
    """
    half = (length + 1) // 2
    places = contexts.select("anchor", "context", "body", F.explode(F.sequence(F.lit(0), F.octet_length("body") - length)).alias("s"))
    bucket = lambda at: F.xxhash64(F.substring(F.col("body"), at + 1, F.lit(half)))
    keyed = places.select("anchor", "context", F.col("s").cast("long").alias("s"), bucket(F.col("s")).alias("bucket"), bucket(F.col("s") + length - half).alias("pointer"))
    again = shared_table(keyed.groupBy("bucket", "pointer").agg(F.count("*").alias("c")).where("c > 1").drop("c"))
    return keyed.join(again, ["bucket", "pointer"]).select("anchor", "context", "s", (F.col("s") + 1).alias("e"))


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = 64, crowd: int = 4096) -> DataFrame:
    """``doc_id, version, spans``: bytes of ``docs(doc_id, version, text)`` that lie in a string of ``length`` bytes found again."""
    anchors = shared_table(anchor_table(docs, length, gram))
    # what is joined is a table of its own, so that Spark can split a crowded key of the other side
    again = shared_table(anchors.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").drop("c"))
    anchors = shared_table(may_hold(anchors, "anchor", again, "held").where("held").drop("held").join(again, "anchor"))
    # places with equal contexts repeat each other whole; one of them stands for all
    kinds = shared_table(anchors.groupBy("anchor", "context").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "version", "at", "n")).alias("one")).select("anchor", "context", "c", "one.*"))
    wide = shared_table(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    wanted = kinds.join(wide, "anchor").groupBy("doc_id", "version").agg(F.collect_list(F.struct("anchor", "context", "kinds", "at", "n")).alias("parts"))
    wanted = shared_table(wanted)
    data = F.col("text").cast("binary")
    cut_out = F.transform(
        "parts",
        lambda p: F.struct(
            p["anchor"].alias("anchor"), p["context"].alias("context"), p["kinds"].alias("kinds"),
            F.substring(data, (p["at"] + 1).cast("int"), (p["n"] + length - 1).cast("int")).alias("body"),
        ),
    )
    # equal rows are one here
    holders = may_hold(docs, "doc_id", wanted.select("doc_id"), "held").where("held").drop("held")
    bodies = shared_table(holders.join(wanted, ["doc_id", "version"]).select(F.inline(cut_out)))
    partial = refine_buckets(bodies.where(F.col("kinds") <= crowd), length)
    partial = partial.union(refine_crowded(bodies.where(F.col("kinds") > crowd), length))
    whole = kinds.where("c > 1").select("anchor", "context", F.lit(0).cast("long").alias("s"), F.col("n").alias("e"))
    marks = whole.union(partial.join(kinds.where("c > 1").select("anchor", "context"), ["anchor", "context"], "left_anti"))
    found = anchors.join(marks, ["anchor", "context"])
    found = found.select("doc_id", "version", (F.col("at") + F.col("s")).alias("start"), (F.col("at") + F.col("e") + length - 1).alias("end"))
    return shared_table(merged_intervals(found, "doc_id", "version"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 64, crowd: int = 4096) -> DataFrame:
    """Remove every byte in a string of ``length`` bytes that also starts anywhere else.

    All occurrences go, in the same document or another; strings are judged on the input
    and do not reach across documents. Suffixes are sorted only where strings can repeat:
    each string has an anchor, a q-gram that its content chooses, and initial buckets are
    those of equal anchors. Anchors found once are done with after one count. Places with
    an equal whole context are settled by its hash. Of the other contexts each different
    one is sent once to the bucket's task, which refines bucket pointers up to depth
    ``length`` (``repeated_strings``). Buckets of more than ``crowd`` contexts are refined by
    the same rule over all tasks (``refine_crowded``).

    Returns ``doc_id, n_bytes, spans`` (maximal removed byte runs as (start, end) pairs,
    null if none) and ``kept`` (the other bytes, which may split a character).

    Null texts count as empty; texts shorter than ``length`` bytes keep everything; rows
    with a null id keep everything and are not compared; repeated rows repeat each other;
    rows that share an id but not the text are told apart by a 64-bit hash of the text; an
    empty table gives no rows; other columns are left out.
    """
    keep_batches_small(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    spans = repeated_spans(rows.where("doc_id is not null"), length, gram, crowd)

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute

        for batch in batches:
            kept = []
            for text, own in zip(batch.column(1), batch.column(2).to_pylist()):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if own:
                    edges = [0, *(x for s in own for x in (s["start"], s["end"])), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(data)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.compute.binary_length(batch.column(1)).cast(pa.int64()), batch.column(2), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    # only texts with removals are shuffled
    marked = may_hold(rows, "doc_id", spans.select("doc_id"), "held")
    joined = marked.where("held").join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    joined = joined.union(marked.where("not held").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType)))
    return joined.mapInArrow(compute, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")

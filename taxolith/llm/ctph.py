"""Operator 4: context-triggered piecewise hashing of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The digits of a signature and the least block size.
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LEAST = 3
WINDOW = 7
#: Chunks that a signature should have; the block size follows the length of the text.
CHUNKS = 64
#: Ranges of ids that texts are dealt to. Beyond so many parts of the scan the ranges grow with
#: the input; a task streams through its range and holds two documents, however long it is.
MOST_PARTS = 4096
#: Two digits for each chunk, so that different chunks rarely look alike.
SYMBOL = 2


def levels(data: bytes):
    """For every byte, the largest k with a boundary at block size ``LEAST * 2^k``; -1 if none.

    The rolling hash of the last ``WINDOW`` bytes is a sum, a weighted sum and a shifted
    exclusive or; a boundary at block size b is where it is b - 1 modulo b.
    """
    import numpy as np

    octets = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint32), octets])
    n = len(octets)
    roll = np.zeros(n, np.uint32)
    mixed = np.zeros(n, np.uint32)
    for back in range(WINDOW):
        part = padded[WINDOW - 1 - back : WINDOW - 1 - back + n]
        roll += part * np.uint32(WINDOW - back + 1)
        mixed ^= part << np.uint32(5 * back)
    after = (roll + mixed).astype(np.uint64) + np.uint64(1)
    third, rest = np.divmod(after, np.uint64(LEAST))
    lowest = third & (~third + np.uint64(1))
    power = np.where(third > 0, np.bitwise_count(lowest - np.uint64(1)).astype(np.int8), np.int8(63))
    return np.where(rest == 0, power, np.int8(-1))


def signature(data: bytes, marks, level: int) -> str:
    """Two digits per chunk, over the whole text.

    A chunk of four block sizes ends without a trigger, so that a text that repeats itself
    and never meets one still has a signature; one of less than an eighth of a block does
    not end, so that a text that repeats a trigger has no more than some 8 times ``CHUNKS``.
    """
    import numpy as np

    longest, least = (LEAST << level) * 4, (LEAST << level) // 8
    ends, start = [], 0
    for end in (np.flatnonzero(marks >= level) + 1).tolist():
        if end - start >= least:
            ends += range(start + longest, end, longest)
            ends.append(end)
            start = end
    ends += range(start + longest, len(data), longest)
    ends.append(len(data))
    out, start = [], 0
    for end in dict.fromkeys(ends):
        value = zlib.crc32(data[start:end])
        out.append(DIGITS[value & 63] + DIGITS[value >> 6 & 63])
        start = end
    return "".join(out)


def fingerprint(text: str | None) -> str:
    """``block size:signature:signature at twice the block size``; the empty text has none of them."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return f"{LEAST}::"
    level = 0
    while LEAST * (1 << level) * CHUNKS < len(data):
        level += 1
    marks = levels(data)
    return f"{LEAST << level}:{signature(data, marks, level)}:{signature(data, marks, level + 1)}"


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by the bits of one whole number."""
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def alike(a: str, b: str) -> float:
    """1 minus the edit distance of two signatures (a change counts as two edits) over their lengths."""
    if a == b:
        return 1.0
    x, y = ([s[k : k + SYMBOL] for k in range(0, len(s), SYMBOL)] for s in (a, b))
    return 2 * common(x, y) / (len(x) + len(y)) if x and y else 0.0


def likeness(a: str | None, b: str | None) -> float | None:
    """Likeness of two fingerprints from 0 to 1, at the block sizes they share; 0 if they share none."""
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
    p, q = int(p), int(q)
    pairs = [(a1, b1), (a2, b2)] if p == q else [(a1, b2)] if p == 2 * q else [(a2, b1)] if q == 2 * p else []
    return max((alike(x, y) for x, y in pairs), default=0.0)


def with_next(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Documents of each range of ids, and the first one of the following range as ``guest``.

    Ranges are cut at approximate quantiles of the ids; the first id of each range is
    counted exactly. Only ``parts`` ids go to the driver. The last range's guest is the
    first document, so following ids wrap around.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    grid = [k / parts for k in range(1, parts)]
    bounds = sorted(set(ids.approxQuantile("doc_id", grid, 1 / (8 * parts)))) if parts > 1 else []
    part = sum((F.when(F.col("doc_id") >= int(b), 1).otherwise(0) for b in bounds), F.lit(0)) if len(bounds) < 64 else None
    if part is None:
        edges = F.array(*[F.lit(int(b)) for b in bounds])
        part = F.size(F.filter(edges, lambda e: e <= F.col("doc_id")))
    dealt = ids.withColumn("part", part.cast("int"))
    firsts = dealt.groupBy("part").agg(F.min("doc_id").alias("first")).orderBy("part").collect()
    host = {r["first"]: firsts[k - 1]["part"] for k, r in enumerate(firsts)}
    if not host:
        return dealt.withColumn("guest", F.lit(False))
    lookup = F.create_map(*[F.lit(x) for pair in host.items() for x in pair])
    guests = dealt.where(F.col("doc_id").isin(list(host))).withColumn("part", lookup[F.col("doc_id")]).withColumn("guest", F.lit(True))
    return dealt.withColumn("guest", F.lit(False)).union(guests)


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text, next to the scan.

    Null texts count as empty; null ids stay null; repeated rows keep a row each; an empty
    table gives no rows; other columns are left out.
    """

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = [v or "" for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(v) for v in values], pa.int64()), pa.array([fingerprint(v) for v in values])], names=["doc_id", "n_chars", "fingerprint"]
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(compute, "doc_id long, n_chars long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of a text, rounded down, replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are.

    The edited text has its last half replaced by the start of the next document's, in
    the order of ids (``edited_text``). Texts are shuffled once, to ranges of ids, in
    which each task reads them in order and holds two documents at a time.

    Returns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next``. Null texts count as empty, rows without an id are left out,
    rows with equal ids follow one another in an order of their texts, a single document follows itself, an empty table
    gives no rows, and other columns are left out.
    """
    if parts is None:  # as many as the scan has, up to a bound
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(docs.rdd.getNumPartitions(), MOST_PARTS))
    dealt = with_next(docs, id_col, text_col, parts)
    dealt = dealt.repartition(max(parts, 1), "part").sortWithinPartitions("part", "guest", "doc_id", "text")

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        columns: list[list] = [[] for _ in range(7)]
        size = 0

        def out():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            for c in columns:
                c.clear()
            return batch

        held = None  # part, id, text, fingerprint of the document whose next one is awaited
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for doc_id, text, part, guest in rows:
                text = text.as_py() or ""
                own = fingerprint(text)
                if held is not None and held[0] == part:
                    changed = edited_text(held[2], text)
                    other = fingerprint(changed)
                    row = (held[1], len(held[2]), changed, held[3], other, likeness(held[3], other), likeness(held[3], own))
                    for c, x in zip(columns, row):
                        c.append(x)
                    size += len(changed)
                held = None if guest else (part, doc_id, text, own)
                if size >= 2_000_000:
                    yield out()
                    size = 0
        yield out()

    schema = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("doc_id", "text", "part", "guest").mapInArrow(compute, schema)

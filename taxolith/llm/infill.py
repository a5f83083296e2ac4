"""Operator 11: fill-in-the-middle texts, cut by code points through memoized content-defined chunks."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: Bytes of UTF-8 that do not start a code point.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Chunks end where eight bits of the rolling hash are zero, and have from LEAST to MOST bytes.
LEAST, MOST = 32, 2048
#: Bytes that the rolling hash of one stretch of a text is held for at a time.
STRETCH = 1 << 20
WINDOW = 16


class Summary(NamedTuple):
    """What a chunk adds to a text: code points that start in it, its first and last two bytes, whether a mark lies inside."""

    points: int
    head: bytes
    tail: bytes
    marked: bool


def summarise(chunk: bytes) -> Summary:
    return Summary(len(chunk.translate(None, CONTINUATION)), chunk[:2], chunk[-2:], any(m in chunk for m in MARKS))


def candidates(data: bytes) -> Iterator[int]:
    """Ends of the places where the rolling hash of the last 16 bytes has eight zero bits, in order.

    The hash adds a value per byte, shifted by its distance; doubling the window four times
    gives it for all places of a stretch at once.
    """
    import numpy as np

    for start in range(0, len(data), STRETCH):
        before = min(start, WINDOW - 1)
        rolled = (np.frombuffer(data, np.uint8, min(STRETCH, len(data) - start) + before, start - before).astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        width = 1
        while width < WINDOW:
            shifted = rolled.copy()
            shifted[width:] += rolled[:-width] << np.uint32(width) if len(rolled) > width else 0
            rolled, width = shifted, width * 2
        yield from (np.flatnonzero(rolled[before:] >> np.uint32(24) == 0) + start + 1).tolist()


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of ``data``; they follow the content, so shared passages share chunks."""
    ends, start = [], 0
    for end in candidates(data):
        if end - start >= LEAST:
            while end - start > MOST:
                start += MOST
                ends.append(start)
            ends.append(end)
            start = end
    while len(data) - start > MOST:
        start += MOST
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


class Memo:
    """Summaries of chunks seen before, found by checksum and used only where the content is equal.

    Once the contents take more than ``room`` bytes the memory starts anew.
    """

    def __init__(self, room: int = 32 << 20):
        self.room, self.held, self.known = room, 0, {}

    def __call__(self, chunk: bytes) -> Summary:
        key = zlib.crc32(chunk)
        found = self.known.get(key)
        if found is not None and found[0] == chunk:
            return found[1]
        if self.held > self.room:
            self.known, self.held = {}, 0
        summary = summarise(chunk)
        if found is None:
            self.held += len(chunk) + 200
            self.known[key] = chunk, summary
        return summary


class Measured:
    """A text's bytes with the counts of its chunks: how many code points it has, where each starts, whether it holds a mark."""

    def __init__(self, data: bytes, memo: Memo):
        self.data, self.ends, self.totals, self.marked = data, chunk_ends(data), [0], False
        start, tail = 0, b""
        for end in self.ends:
            summary = memo(data[start:end])
            seam = tail + summary.head
            self.marked = self.marked or summary.marked or any(m in seam for m in MARKS)
            # a chunk of one byte leaves its predecessor's last byte in reach
            tail = (tail + summary.tail)[-2:]
            self.totals.append(self.totals[-1] + summary.points)
            start = end
        self.points = self.totals[-1]

    def place(self, point: int) -> int:
        """Byte at which code point ``point`` starts; the end of the text for the one after the last."""
        import numpy as np

        if point >= self.points:
            return len(self.data)
        k = bisect_right(self.totals, point) - 1
        start = self.ends[k - 1] if k else 0
        octets = np.frombuffer(self.data, np.uint8, self.ends[k] - start, start)
        return start + int(np.flatnonzero(octets & 0xC0 != 0x80)[point - self.totals[k]])


def infill(text: str | None, draws: tuple[int, int, int, int], memo: Memo, plain_from: int = 90, spm_below: int = 20):
    """``n, form, prefix_chars, middle_chars, output`` of one text; draws decide cuts, plainness and order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    measured = Measured(data, memo)
    n, (h1, h2, h3, h4) = measured.points, draws
    if not n or measured.marked or h3 % 100 >= plain_from:
        return n, "plain", None, None, text or ""
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = measured.place(first), measured.place(second)
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass") for part in (data[:a], data[a:b], data[b:]))
    if h4 % 100 < spm_below:
        return n, "spm", first, second - first, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", first, second - first, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Texts rearranged so that a model learns to fill in their middle: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Cuts and form follow from SHA-256 of ``seed:doc_id``, so a document has the same ones at
    any partitioning. ``n`` counts code points. ``plain`` texts, which are empty, hold one of
    the marks or are drawn, stay as they are and have no part lengths. All work is next to
    the scan; a text of any length is measured in stretches of a megabyte.

    Null texts count as empty; a null id draws as ``null``; repeated rows keep a row each and
    are cut alike; an empty table gives no rows; other columns are left out.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *draws)

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memo = Memo()
        kinds = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
        columns: list[list] = [[] for _ in kinds]

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])
            for c in columns:
                c.clear()
            return batch

        size = 0
        for batch in batches:
            drawn = zip(*(batch.column(k).to_pylist() for k in range(2, 6)))
            for doc_id, text, draw in zip(batch.column(0).to_pylist(), batch.column(1), drawn):
                row = (doc_id, *infill(text.as_py(), draw, memo, plain_from, spm_below))
                for c, x in zip(columns, row):
                    c.append(x)
                size += len(row[-1])
                if size >= 4_000_000:
                    yield out()
                    size = 0
        yield out()

    return source.mapInArrow(compute, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made from, rebuilt from the output and its form alone.

    A rearranged text holds each mark once: the parts hold none, and no mark begins like the
    end of another.
    """
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    size = F.char_length(output)
    psm = F.concat(F.substr(output, F.lit(4), s - 4), F.substr(output, m + 3, size), F.substr(output, s + 3, m - s - 3))
    spm = F.concat(F.substr(output, p + 3, m - p - 3), F.substr(output, m + 3, size), F.substr(output, F.lit(4), p - 4))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

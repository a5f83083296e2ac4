"""Operator 6: best-fit-decreasing packing into binary token-id matrices."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxolith.llm.common import ChunkTokenizer

VOCABULARY = "byte_bpe_50k.json"
SCHEMA = (
    "sequence_id long, n_tokens int, n_segments int, token_ids binary, position_ids binary, "
    "cu_seqlens array<int>, doc_ids array<long>, doc_starts array<int>"
)


class Capacities:
    """Segment tree over the free space of the open bins.

    Leaf c counts the bins with c free ids and an inner node the bins below it. The
    tightest bin with room for n is the first non-empty leaf from n on, found in one way
    up and one way down the tree.
    """

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, free: int, which: int) -> None:
        self.bins[free].append(which)
        node = self.width + free
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Free space and number of the tightest bin, which leaves the tree; None if there is none."""
        node, count = self.width + need, self.count
        while not count[node]:
            while node & 1:  # a right child: go on above it
                node >>= 1
            if not node:
                return None
            node += 1  # the sibling on the right
            if node & (node - 1) == 0:  # one past the last node of a level
                return None
        while node < self.width:
            node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.width
        which = self.bins[free].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return free, which


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of piece numbers: pieces by falling length, each into the tightest bin with room."""
    tree, bins = Capacities(size), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = lengths[k]
        found = tree.take(need)
        if found is None:
            found = (size, len(bins))
            bins.append([])
        free, which = found
        bins[which].append(k)
        if free > need:
            tree.put(free - need, which)
    return bins


def token_bins(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 1024,
    vocabulary: str = VOCABULARY,
    end_id: int = 0,
    pad_id: int = 0,
    block_tokens: int = 1 << 21,
) -> DataFrame:
    """Pack documents into rows of ``max_tokens`` ids by best-fit-decreasing.

    A document is its ids and ``end_id``. One longer than a row is split losslessly into
    full rows and a rest. A task packs blocks of about ``block_tokens`` ids, so its memory
    is bounded by a block and the longest document; a block wastes at most its last few rows. Every row of the result is one
    row of the id matrix:

    * ``token_ids``: ``max_tokens`` little-endian unsigned 16-bit ids, padded with ``pad_id``;
    * ``position_ids``: as many little-endian unsigned 16-bit positions, which start again
      at 0 with every segment and with the padding;
    * ``cu_seqlens``: cumulative segment lengths from 0, the padding not counted;
    * ``doc_ids``, ``doc_starts``: the document of each segment and the segment's first id in it;
    * ``sequence_id``, ``n_tokens``, ``n_segments``.

    Null and empty texts are the end id alone; null ids stay null; repeated rows are packed
    once each; ties in length go by order; an empty table gives no rows; other columns are
    left out, whatever their names.
    """
    if max_tokens >= 65536:
        raise ValueError("max_tokens must fit an unsigned 16-bit position")

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        tokenizer = ChunkTokenizer.get(vocabulary)
        end, pad = tokenizer.pack([end_id]), tokenizer.pack([pad_id])
        number = TaskContext.get().partitionId() << 40
        steps = np.arange(max_tokens, dtype="<u2").tobytes()
        pieces: list[tuple[int, int, bytes]] = []
        held = 0

        def rows():
            nonlocal number
            bins = best_fit([len(p[2]) // 2 for p in pieces], max_tokens)
            for at in range(0, len(bins), 256):
                out: dict[str, list] = {n: [] for n in ("sequence_id", "n_tokens", "n_segments", "token_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts")}
                for members in bins[at : at + 256]:
                    own = [pieces[k] for k in members]
                    sizes = [len(p[2]) // 2 for p in own]
                    n = sum(sizes)
                    out["sequence_id"].append(number)
                    out["n_tokens"].append(n)
                    out["n_segments"].append(len(own))
                    out["token_ids"].append(b"".join(p[2] for p in own) + pad * (max_tokens - n))
                    out["position_ids"].append(b"".join(steps[: 2 * s] for s in [*sizes, max_tokens - n]))
                    out["cu_seqlens"].append(np.cumsum([0, *sizes]).tolist())
                    out["doc_ids"].append([p[0] for p in own])
                    out["doc_starts"].append([p[1] for p in own])
                    number += 1
                types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))
            pieces.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokenizer.encode(text.as_py()) + end
                for start in range(0, len(ids), 2 * max_tokens):
                    pieces.append((doc_id, start // 2, ids[start : start + 2 * max_tokens]))
                held += len(ids) // 2
                if held >= block_tokens:
                    yield from rows()
                    held = 0
        yield from rows()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(pack, SCHEMA)


def write_token_bins(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, in the order of ``sequence_id`` within each file."""
    rows.sortWithinPartitions("sequence_id").write.mode("overwrite").parquet(path)

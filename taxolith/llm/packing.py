"""Operator 1: order-preserving packing by dynamic programming."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxolith.llm.common import REMEMBER, ChunkTokenizer

VOCABULARY = "byte_bpe_50k.json"
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def windows(positions: list[int], penalties: list[float], size: int) -> list[int]:
    """Indexes of the cheapest cuts from the first to the last of ``positions``.

    A window from cut i to cut j costs its padding ``size - (p[j] - p[i])`` plus the
    truncation penalty of j. The best i of each j is the least ``cost[i] + p[i]`` among
    the cuts less than ``size`` back; both ends of that range only move forward, so a
    monotone queue gives it in constant amortised time. The last window costs no padding
    here: its rest goes on into the next block or is settled by ``tail``.
    """
    n = len(positions)
    cost, back, key = [0.0] * n, [0] * n, [0.0] * n
    key[0] = positions[0]
    queue = deque([0])
    for j in range(1, n):
        at = positions[j]
        while positions[queue[0]] < at - size:
            queue.popleft()
        i = queue[0]
        back[j] = i
        if j == n - 1:
            break
        cost[j] = key[i] + size - at + penalties[j]
        key[j] = k = cost[j] + at
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    if n > 1:  # the last window may be of any length: the cheapest cut in reach
        reach = [i for i in queue if positions[i] >= positions[-1] - size]
        back[-1] = min(reach, key=lambda i: (cost[i], i))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def tail(length: int, size: int, penalty: float) -> list[int]:
    """Lengths of the sequences of a stream's last ``length`` ids.

    One padded sequence, or powers of two, which need no padding, where their cuts cost less.
    """
    powers = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    return powers if (len(powers) - 1) * penalty < size - length else [length]


class Stream:
    """Packs documents in the order they come, in blocks of bounded size."""

    def __init__(self, vocabulary: str, size: int, block: int, end_id: int, sentence: float, within: float, step: int, first_id: int, remember: int = REMEMBER):
        import numpy as np

        self.np, self.size, self.block, self.sentence, self.within, self.step = np, size, block, sentence, within, step
        self.tokenizer = ChunkTokenizer.get(vocabulary, remember)
        self.ends, self.end = self.tokenizer.ends(), self.tokenizer.pack([end_id])
        self.sequence, self.base = first_id, 0
        self.parts: list[bytes] = []
        self.docs: list[tuple[int, int, int]] = []  # id, position of its first id, ids
        self.held = self.total = 0

    def add(self, doc_id: int, text: str | None) -> bool:
        """True when a block is full."""
        ids = self.tokenizer.encode(text) + self.end
        n = len(ids) // 2
        self.parts.append(ids)
        self.docs.append((doc_id, self.total, n))
        self.total += n
        self.held += n
        return self.held >= self.block

    def cuts(self, tokens):
        """Positions where a window may end, and what ending there costs."""
        np = self.np
        n = len(tokens)
        penalty = np.full(n + 1, np.inf)
        penalty[np.flatnonzero(self.ends[tokens]) + 1] = self.sentence
        # within a sentence, every step-th position
        marked = np.flatnonzero(np.isfinite(penalty))
        marked = np.concatenate([[0], marked, [n]])
        gap = np.arange(n + 1) - marked[np.searchsorted(marked, np.arange(n + 1), side="right") - 1]
        inner = (gap % self.step == 0) & ~np.isfinite(penalty)
        penalty[inner] = self.within
        for _, at, length in self.docs:
            if 0 < at + length - self.base <= n:
                penalty[at + length - self.base] = 0.0
        penalty[0] = penalty[n] = 0.0
        where = np.flatnonzero(np.isfinite(penalty))
        return where.tolist(), penalty[where].tolist()

    def flush(self, last: bool):
        """The pieces of all whole windows; the last few stay for the next block."""
        import pyarrow as pa

        np = self.np
        data = b"".join(self.parts)
        tokens = np.frombuffer(data, dtype="<u2")
        if not len(tokens):
            return None
        positions, penalties = self.cuts(tokens)
        chosen = [positions[i] for i in windows(positions, penalties, self.size)]
        if last:
            rest = chosen[-1] - chosen[-2]
            if rest & (rest - 1) and rest < self.size:
                lengths = tail(rest, self.size, self.within)
                chosen = chosen[:-1] + (chosen[-2] + np.cumsum(lengths)).tolist()
        else:
            chosen = chosen[: max(2, len(chosen) - 4)]
        done, np_cuts = chosen[-1], np.array(chosen)
        starts = np.array([at - self.base for _, at, _ in self.docs])
        lengths = np.array([n for _, _, n in self.docs])
        edges = np.union1d(np_cuts, starts[(starts > 0) & (starts < done)])
        begin, end = edges[:-1], edges[1:]
        doc = np.searchsorted(starts, begin, side="right") - 1
        window = np.searchsorted(np_cuts, begin, side="right") - 1
        wide = tokens[:done].astype("<u4")
        offsets = (np.concatenate([begin, end[-1:]]) * 4).astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(wide.tobytes())])
        names = np.array([i for i, _, _ in self.docs], dtype=object)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(names[doc].tolist(), pa.int64()), pa.array(begin - starts[doc], pa.int64()), pa.array(end - begin, pa.int64()),
                pa.array(lengths[doc], pa.int64()), pa.array(self.sequence + window, pa.int64()), pa.array(begin - np_cuts[window], pa.int64()), ids,
            ],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )
        self.sequence += len(chosen) - 1
        self.base += done
        self.parts, self.held = [data[2 * done :]], len(tokens) - done
        self.docs = [d for d in self.docs if d[1] + d[2] > self.base]
        return out


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 1024,
    vocabulary: str = VOCABULARY,
    end_id: int = 0,
    sentence_penalty: float = 2.0,
    within_penalty: float = 12.0,
    within_step: int = 16,
    block_tokens: int = 1 << 18,
    order_by: str | None = None,
    partitions: int | None = None,
    remember: int = REMEMBER,
) -> DataFrame:
    """Pack documents into sequences of at most ``max_tokens`` ids without reordering them.

    Each Spark partition is one stream of documents in its own order: the order of the
    input files or, given ``order_by``, ranges of that column. Within a stream, dynamic
    programming with a monotone queue picks the window ends that minimise padding plus
    truncation penalties: nothing at the end of a document, ``sentence_penalty`` at the
    end of a sentence and ``within_penalty`` at every ``within_step``-th id of a sentence.
    It runs over blocks of ``block_tokens`` ids, each taking over the last windows of the
    one before, so a task holds one block however long its stream is, and besides it the
    document that fills it, which is encoded whole. The last rest of a stream is padded or dealt to power-of-two sequences, whichever is cheaper.

    Returns one row per piece: ``doc_id, start, length`` (in ids of the document),
    ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence) and ``ids``, the piece as
    little-endian unsigned 32-bit ids. Every id lies in exactly one piece. A worker remembers
    the ids of ``remember`` chunks of text; fewer take less memory and more time.

    Null and empty texts are the end id alone. Null ids stay null, repeated rows and ids are
    packed once each, an empty table gives no rows, and other columns are left out, whatever
    their names.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if order_by is not None:
        source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(order_by).alias("_order"))
        source = source.repartitionByRange(*([partitions] if partitions else []), "_order").sortWithinPartitions("_order")
        source = source.drop("_order")

    def pack(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        stream = Stream(vocabulary, max_tokens, block_tokens, end_id, sentence_penalty, within_penalty, within_step, TaskContext.get().partitionId() << 40, remember)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if stream.add(doc_id, text.as_py()):
                    yield stream.flush(False)
        while stream.held:
            yield stream.flush(True)

    return source.mapInArrow(pack, SCHEMA)


def padding_share(pieces: DataFrame, max_tokens: int = 1024) -> DataFrame:
    """Sequences, ids and the share of padding, counting power-of-two sequences as unpadded."""
    each = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    filled = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, F.col("n")).otherwise(F.lit(max_tokens))
    return each.agg(F.count("*").alias("sequences"), F.sum("n").alias("ids"), (1 - F.sum("n") / F.sum(filled)).alias("padding"))

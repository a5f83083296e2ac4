"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.plans.materialise import cut, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root the smallest node.

    Alternates the large-star and small-star steps: every node hands its neighbours the
    smallest one among them, until no step changes an edge: then the edges are stars. A step
    is one aggregate and one join on the node; edges live in Spark tables, never on the
    driver. The number of steps grows as the logarithm of the longest chain. Empty edges
    give an empty result; self loops and repeated edges are ignored.
    """
    edge = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edge = cut(edge)
    before = now = None
    while now is None or now != before:
        both = edge.union(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        edge = cut(small.where("a > b").distinct())
        before, now = now, edge.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    nodes = edge.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edge.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


#: Chunks that a tokenizer remembers, some 80 MB of them.
REMEMBER = 600_000
_TOKENIZERS: dict[tuple[str, int], "ChunkTokenizer"] = {}


class ChunkTokenizer:
    """Ids of a byte-level BPE tokenizer, remembered per space-separated chunk.

    ``vocabulary`` names the tokenizer's JSON file among the public tokenizers. A single
    space never joins its two sides into one token except as the leading space of the
    right one, so the ids of a text are those of its chunks in turn. Texts in which that
    does not hold (runs of white space, special tokens) go to the tokenizer whole.
    """

    SPECIAL = "<|endoftext|>"
    ODD = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def __init__(self, vocabulary: str, remember: int = REMEMBER):
        import base64

        import public_tokenizers as public
        import tiktoken

        with open(public.path(vocabulary.replace(".json", ".tiktoken")), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks, self.vocabulary, self.whole = ranks, vocabulary, None
        self.encoding = tiktoken.Encoding(vocabulary, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        ordinary, piece, pack = self.encoding.encode_ordinary, self.encoding._encode_single_piece, self.pack

        class Known(dict):
            def __missing__(self, chunk):
                # letters alone are one piece; anything else is first split by the pattern
                ids = pack(piece(" " + chunk) if chunk.isalpha() else ordinary(" " + chunk))
                if len(self) < remember:
                    self[chunk] = ids
                return ids

        self.known = Known()

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return array("H", ids).tobytes()

    @classmethod
    def get(cls, vocabulary: str, remember: int = REMEMBER) -> "ChunkTokenizer":
        """The tokenizer of this Python worker."""
        if (vocabulary, remember) not in _TOKENIZERS:
            _TOKENIZERS[vocabulary, remember] = cls(vocabulary, remember)
        return _TOKENIZERS[vocabulary, remember]

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 16-bit ids, one after the other."""
        if not text:
            return b""
        if self.SPECIAL in text:
            return self.pack(self.exact(text))
        chunks = text.split(" ")
        if "" in chunks or " \n" in text or self.ODD.search(text):
            return self.pack(self.encoding.encode_ordinary(text))
        head = self.pack(self.encoding.encode_ordinary(chunks[0]))
        return head + b"".join(map(self.known.__getitem__, chunks[1:]))

    def exact(self, text: str) -> list[int]:
        """By the tokenizers library itself."""
        if self.whole is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            import public_tokenizers as public
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(public.path(self.vocabulary))
        return self.whole.encode(text, add_special_tokens=False).ids

    @staticmethod
    def forget() -> None:
        """Give up the tokenizers of this Python worker: the next task of another operator has no use for some 150 MB of chunks."""
        if _TOKENIZERS:
            _TOKENIZERS.clear()
            gc.collect()  # their dictionaries refer to themselves

    def ends(self, marks: bytes = b".!?\n"):
        """For each id, whether its bytes end a sentence: they hold one of ``marks``."""
        import numpy as np

        out = np.zeros(65536, dtype=bool)
        for token, rank in self.ranks.items():
            out[rank] = any(m in marks for m in token)
        return out


def texts(batches: Iterator, id_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """Ids and texts of Arrow batches, about four million characters at a time."""
    import pyarrow.compute as pc

    ChunkTokenizer.forget()
    for batch in batches:
        keys, values = batch.column(id_col).to_pylist(), batch.column(text_col)
        start = size = 0
        lengths = pc.fill_null(pc.utf8_length(values), 0).to_pylist()
        for k, n in enumerate(lengths):
            size += n
            if size >= 4_000_000 or k == len(lengths) - 1:
                yield keys[start : k + 1], values.slice(start, k + 1 - start).to_pylist()
                start, size = k + 1, 0


#: The setting of what is sent to Python at a time, and the bytes that operators set it to.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Inside, what runs sends ``size`` bytes to Python at a time, or a row where that is more.

    Spark's own bound, 64 MB, is held by the JVM and by Python, and there again as strings, for each task that an executor runs.
    """
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(size))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def keep_batches_small(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """As ``small_batches``, for the rest of the session, unless the session has a bound of its own.

    For results that are lazy: Spark asks for the bound when they run, after their operator has returned.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(size))


def shared_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Unlike a checkpoint it is compressed and keeps its columns apart; the shuffle files
    behind it are given up once it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def merged_intervals(intervals: DataFrame, *key: str) -> DataFrame:
    """``key, spans``: the union of each key's half-open ``start, end`` intervals, as sorted disjoint spans."""
    order = Window.partitionBy(*key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = intervals.withColumn("_new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    islands = islands.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


#: Bits of a bitmap row, and the most rows (8 MB) that are broadcast.
BITMAP_BITS, BITMAP_ROWS = 1 << 15, 2048


def may_hold(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """Add the column ``name``: false only where no row of the one-column ``keys`` equals ``key``.

    A bitmap of hashed keys, 4 KB for 500 keys and 8 MB at most, is broadcast; beyond a
    million keys it marks more rows than it must, but never fewer. It keeps the rows that a
    join with few keys leaves alone out of the shuffle. A null key is marked false.
    """
    held = keys.select(F.col(keys.columns[0]).cast(rows.schema[key].dataType).alias("k")).where("k is not null")
    width = min(BITMAP_ROWS, 1 << (held.count() * 64 // BITMAP_BITS).bit_length())
    bit = lambda k: F.pmod(F.xxhash64(k), F.lit(width * BITMAP_BITS))
    place, word, bits = unused(rows, "_place"), unused(rows, "_word"), unused(rows, "_bits")
    bitmap = held.select(bit("k").alias("p")).groupBy(F.expr(f"p div {BITMAP_BITS}").alias(word)).agg(F.expr(f"bitmap_construct_agg(p % {BITMAP_BITS})").alias(bits))
    placed = rows.withColumn(place, bit(key)).join(F.broadcast(bitmap), F.expr(f"{place} div {BITMAP_BITS}") == F.col(word), "left")
    octet = f"cast(conv(hex(substring({bits}, cast({place} % {BITMAP_BITS} div 8 as int) + 1, 1)), 16, 10) as int)"
    marked = F.expr(f"coalesce(shiftright({octet}, cast({place} % 8 as int)) & 1, 0) = 1") & F.col(key).isNotNull()
    return placed.withColumn(name, marked).drop(place, word, bits)

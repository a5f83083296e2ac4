"""Operator 5: rendezvous hashing over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.llm.common import unused

BITS = 52  # of a digest: as many as a double holds


def draw(key: Column, shard: int) -> Column:
    """A whole number in [0, 2^52) that key and shard alone decide: digits of an MD5 digest."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{shard}")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def choose(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose score ``weight / -ln(draw)`` is highest; the smallest of equal ones.

    With equal weights the highest draw wins, so no logarithm is taken.
    """
    if min(weights) <= 0:
        raise ValueError("weights must be positive")
    draws = [draw(key, s) for s in range(len(weights))]
    if len(set(weights)) > 1:
        draws = [F.lit(float(w)) / -F.log((d + 0.5) / 2.0**BITS) for d, w in zip(draws, weights)]
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    out = F.lit(None).cast("int")
    for s in reversed(range(len(draws))):
        out = F.when(draws[s] == best, F.lit(s)).otherwise(out)
    return out


def assign_shards(docs: DataFrame, key_col: str = "doc_id", weights: Sequence[float] = (1.0,) * 8, shard_col: str = "shard") -> DataFrame:
    """Add the shard of every row, decided by its key and the weights alone.

    A further shard takes rows only into itself: the scores of the others stay, so a row
    moves only where the new score wins. Nothing is shuffled. A null key hashes as the
    text ``null``, rows with equal keys share a shard, and an empty table stays empty. A
    column that is named as ``shard_col`` is replaced; all others stay.
    """
    own = unused(docs, "_key")
    key = F.coalesce(F.col(key_col).cast("string"), F.lit("null"))
    return docs.withColumn(own, key).withColumn(shard_col, choose(F.col(own), weights)).drop(own)


def number_slots(rows: DataFrame, shard_col: str, order_by: Sequence[str], buckets: int = 256, slot_col: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in no single task.

    Rows are dealt to ``buckets`` parts of a shard by a hash of the order columns. Counts
    of the parts (shards x buckets of them, summed before the shuffle) give each part the
    number it starts from; within a part a window counts on. More buckets make smaller
    windows; the number of rows does not change that of parts.
    """
    own, row, before = unused(rows, "_part"), unused(rows, "_row"), unused(rows, "_before")
    shard, part, counted = unused(rows, "_s"), unused(rows, "_p"), unused(rows, "_n")
    hashed = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order_by])
    dealt = rows.withColumn(own, F.conv(F.substring(F.md5(hashed.cast("binary")), 1, 8), 16, 10).cast("long") % buckets)
    counts = dealt.groupBy(F.col(shard_col).alias(shard), F.col(own).alias(part)).agg(F.count("*").alias(counted))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(shard, part, F.coalesce(F.sum(counted).over(earlier), F.lit(0)).alias(before))
    inner = Window.partitionBy(shard_col, own).orderBy(*order_by)
    dealt = dealt.withColumn(row, F.row_number().over(inner) - 1)
    # at most shards x buckets rows, whatever the input
    joined = dealt.join(F.broadcast(counts), (F.col(shard_col).eqNullSafe(F.col(shard))) & (F.col(own) == F.col(part)))
    return joined.withColumn(slot_col, (F.col(before) + F.col(row)).cast("long")).drop(own, row, before, shard, part)


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, weights: Sequence[float] | None = None, buckets: int = 256
) -> DataFrame:
    """Put documents into shards by rendezvous hashing of their ids.

    Returns ``doc_id, size`` (UTF-8 bytes of the text plus 1), ``text_crc32, shard``,
    ``grown_shard`` (the shard if there were one more of weight 1) and ``slot`` (gapless
    in the shard). Texts are read once, next to the scan; only ids, sizes and checksums
    are shuffled. Null texts count as empty, null ids share one key, repeated rows get a
    slot each, an empty table gives no rows, and other columns are left out.
    """
    weights = list(weights or [1.0] * shards)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32")
    )
    rows = assign_shards(assign_shards(rows, "doc_id", weights), "doc_id", [*weights, 1.0], "grown_shard")
    return number_slots(rows, "shard", ["doc_id", "size", "text_crc32"], buckets)

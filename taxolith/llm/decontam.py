"""Operator 8: benchmark decontamination by SimHash windows and multi-index Hamming blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxolith.llm.common import may_hold, shared_table, unused

BITS = 64
#: Tables of the benchmark of up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " "), "")


def shingles(own: str, size: int) -> Column:
    """Hash of every run of ``size`` words of the array column ``own``; fewer words are one shingle, none are none."""
    n = F.size(own)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(own, i, size)))


def simhash(hashes: str) -> Column:
    """Bits set in over half of the hashes of an array column."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (acc, b) -> acc | "
        f"if(2 * size(filter({hashes}, h -> (shiftright(h, b) & 1L) = 1L)) > size({hashes}), shiftleft(1L, b), 0L))"
    )


def blocks(fingerprint: str, radius: int) -> Column:
    """The ``radius + 1`` bit blocks of a fingerprint: two within the radius agree on one of them."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    parts = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    return F.array(*parts)


def weighted_similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles, a shingle's weight being its count."""
    shared = f"aggregate(array_intersect({a}, {b}), 0, (acc, h) -> acc + least(size(filter({a}, x -> x = h)), size(filter({b}, x -> x = h))))"
    return F.expr(f"{shared} / (size({a}) + size({b}) - {shared})")


def starts_of(last: Column) -> Column:
    """Starts up to ``last`` of all windows of ``size`` shingles that hold at least ``need`` of the sorted places ``p``."""

    def span(k: Column) -> Column:
        low = F.greatest(F.element_at("p", k + F.col("need") - 1) - F.col("size") + 1, F.lit(0))
        high = F.least(F.element_at("p", k), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.size("p") - F.col("need") + 1), span)))


def small(df: DataFrame, size: int) -> DataFrame:
    """Marked for broadcast only if its size in bytes, computed from counts, is bounded."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    radius: int = 20,
) -> DataFrame:
    """Benchmark items found in documents: ``doc_id, item_id, start, n_words, similarity``.

    1. A window is as many words as an item has. Windows at all starts count, aligned with
       the item or not, that hold as many shingles shared with it as the similarity asked
       for needs; no other window can have it.
    2. Each different window gets a SimHash, and a multi-index of ``radius + 1`` bit blocks,
       kept apart by item size, finds all item fingerprints within ``radius`` bits:
       20 bits are over four standard deviations beyond the 9.7 expected at 0.8. Blocks of
       three bits prune little; step 1 is what keeps the candidates few.
    3. The weighted Jaccard similarity of the shingle counts decides.

    The best window of each document and item is returned; of equal ones, the first of those
    that start where a shared shingle places the item, if there are such, else the first;
    ``start`` counts words from 0. Only texts with such a window are shuffled. What is
    broadcast is the benchmark, if its size in bytes allows it, and a bitmap of ids.

    Null and empty texts and items match nothing; an item of fewer than ``shingle`` words is
    one shingle and found wherever its words follow one another; a window at an end of a
    document is moved inside it, and a document shorter than the item is one window; rows
    with a null id are left out; rows that share an id are one document each, whose best
    window counts; repeated rows give a hit once; empty tables give no rows; other columns
    are left out, whatever their names.
    """
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w"))
    items = items.select("item_id", F.size("w").alias("n_words"), shingles("w", shingle).alias("item_shingles")).where("n_words > 0")
    places = items.select("item_id", "n_words", F.size("item_shingles").alias("m"), F.posexplode("item_shingles").alias("item_pos", "h"))
    held = F.octet_length(F.col("item_id").cast("string"))
    size = places.agg(F.count("*").alias("places"), F.sum(held).alias("ids"), F.collect_set(F.least(F.lit(shingle), "n_words")).alias("kinds")).first()
    weight = 64 * size["places"] + (size["ids"] or 0)
    text = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    own = text.select("doc_id", words(F.col("t")).alias("w"))
    # runs of ``shingle`` words, and of fewer where an item has no more
    runs = [F.when(F.size("w") >= k, F.transform(shingles("w", k), lambda h, pos: F.struct(pos.alias("pos"), h.alias("h")))) for k in sorted(size["kinds"] or [shingle])]
    grams = runs[0] if len(runs) == 1 else F.flatten(F.array_compact(F.array(*runs)))
    spread = own.select("doc_id", F.size("w").alias("n"), F.inline(grams))
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("item_pos"), F.col("n") - F.col("n_words")))
    # rows that share an id stay apart by their number of words at least
    met = spread.join(small(places, weight), "h").groupBy("doc_id", "item_id", "n_words", "n", "m")
    met = met.agg(F.array_sort(F.collect_set("pos")).alias("p"), F.collect_set(start).alias("aligned"))
    # shingles of a window, and how many of them must be shared: o / (size + m - o) >= similarity
    least = F.least(F.lit(shingle), "n_words")
    met = met.withColumn("size", F.greatest(F.least("n", "n_words") - least + 1, F.lit(1)))
    met = met.withColumn("need", F.greatest(F.ceil(similarity / (1 + similarity) * (F.col("size") + F.col("m")) - 1e-6), F.lit(1)).cast("int"))
    starts = met.where("size(p) >= need").withColumn("start", F.explode(starts_of(F.greatest(F.col("n") - F.col("n_words"), F.lit(0)))))
    starts = starts.select("doc_id", "item_id", "n_words", "start", F.array_contains("aligned", F.col("start")).alias("aligned"))
    starts = shared_table(starts.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "n_words", "start", "aligned")).alias("at")))
    window = may_hold(text, "doc_id", starts.select("doc_id"), "held").where("held").join(starts, "doc_id")
    window = window.select("doc_id", words(F.col("t")).alias("w"), F.explode("at").alias("at")).select("doc_id", "w", "at.*")
    window = window.select("doc_id", "item_id", "n_words", "start", "aligned", F.slice("w", F.col("start") + 1, F.col("n_words")).alias("ww"))
    window = window.select("doc_id", "item_id", "n_words", "start", "aligned", shingles("ww", shingle).alias("shingles"))
    window = shared_table(window.withColumn("window", F.xxhash64("shingles")))
    # a passage that many documents share is one window
    distinct = shared_table(window.groupBy("n_words", "window").agg(F.first("shingles").alias("shingles")).withColumn("fingerprint", simhash("shingles")))
    # a table of its own, or else each block of each item would work the fingerprint out anew
    prints = shared_table(items.select("item_id", "n_words", simhash("item_shingles").alias("item_fingerprint")))
    index = prints.select("item_id", "n_words", "item_fingerprint", F.explode(blocks("item_fingerprint", radius)).alias("b"))
    probe = distinct.select("n_words", "window", "fingerprint", F.explode(blocks("fingerprint", radius)).alias("b"))
    near = probe.join(small(index, weight * (radius + 1)), ["n_words", "b"])
    near = near.where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= radius)
    # each pair counts once: at the first block on which it agrees
    first = F.expr(" ".join(["CASE", *[f"WHEN {m} THEN {k}" for k, m in enumerate(agreements(radius))], "END"]))
    near = near.where(F.col("b.block") == first).select("n_words", "window", "item_id")
    near = near.join(distinct.select("n_words", "window", "shingles"), ["n_words", "window"]).join(small(items, weight), ["item_id", "n_words"])
    near = near.withColumn("similarity", weighted_similarity("shingles", "item_shingles")).where(F.col("similarity") >= similarity)
    hits = window.drop("shingles").join(near.select("n_words", "window", "item_id", "similarity"), ["n_words", "window", "item_id"])
    order = F.struct("similarity", "aligned", (-F.col("start")).alias("back"), "n_words")
    best = hits.groupBy("doc_id", "item_id").agg(F.max(order).alias("top"))
    return best.select("doc_id", "item_id", (-F.col("top.back")).alias("start"), F.col("top.n_words").alias("n_words"), F.col("top.similarity").alias("similarity"))


def agreements(radius: int) -> list[str]:
    """SQL conditions that a pair of fingerprints agrees on each block."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    return [f"((fingerprint ^ item_fingerprint) & {m - (1 << 64) if m >> 63 else m}L) = 0" for m in masks]


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns; rows with a null id stay."""
    hit, held = unused(docs, "_hit"), unused(docs, "_held")
    key = options.get("id_col", "doc_id")
    found = shared_table(leaks(docs, benchmark, **options).select(F.col("doc_id").alias(hit)).distinct())
    marked = may_hold(docs, key, found, held)
    return marked.where(~F.col(held)).drop(held).union(marked.where(held).drop(held).join(found, F.col(key) == F.col(hit), "left_anti"))

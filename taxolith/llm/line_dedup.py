"""Operator 9: line deduplication by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.llm.common import may_hold, shared_table, unused


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``_id, _pos, _h, _g``: every run of ``size`` consecutive lines by its first line's number and two hashes."""
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.split(F.col(text_col), "\n").alias("_lines"))
    starts = F.when(F.size("_lines") >= size, F.sequence(F.lit(0), F.size("_lines") - size)).otherwise(F.array().cast("array<int>"))
    keys = F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice("_lines", i + 1, size)).alias("h"), F.hash(F.slice("_lines", i + 1, size)).alias("g")))
    found = lines.select("_id", F.posexplode(keys).alias("_pos", "_key"))
    return found.select("_id", "_pos", F.col("_key.h").alias("_h"), F.col("_key.g").alias("_g"))


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``_id, _spans``: for each document with removals, its removed lines as sorted disjoint (start, end) spans.

    The first occurrence of a window is the one in the document with the smallest id, and
    there the first; all others are removed. Only hashes and numbers are shuffled, summed
    per task first; those of windows that occur once stay where they are after that. Covered windows that touch or overlap merge into one span.
    """
    place = F.col("_id").cast("decimal(28,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("_pos")
    rows = line_windows(docs, id_col, text_col, size).withColumn("_at", place.cast("decimal(38,0)"))
    # a table of its own, so that Spark can split the places of a very common window
    first = shared_table(rows.groupBy("_h", "_g").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    held = may_hold(rows, "_h", first.select("_h"), "_held").where("_held").drop("_held")
    later = held.join(first, ["_h", "_g"]).where("_at > _first").select("_id", "_pos")
    inside = Window.partitionBy("_id").orderBy("_pos")
    later = later.withColumn("_new", F.coalesce((F.col("_pos") - F.lag("_pos").over(inside) > size).cast("int"), F.lit(1)))
    later = later.withColumn("_span", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    spans = later.groupBy("_id", "_span").agg(F.min("_pos").alias("start"), (F.max("_pos") + size).alias("end"))
    return spans.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, report: bool = False) -> DataFrame:
    """Remove later occurrences of every run of ``size`` lines, from all documents at once.

    Returns the rows and columns of ``docs`` with the text cleaned; with ``report`` also
    ``n_lines`` and ``n_removed`` (with underscores before them where ``docs`` has such columns). Lines are what ``\\n`` separates, compared as they are.

    Null texts stay null; empty texts and those of fewer than ``size`` lines have no window
    and stay as they are; rows with a null id stay as they are and take no part; rows that
    share an id are one document, cleaned alike; a document of which every line is removed
    keeps its row with an empty text; an empty table stays empty; columns of any other
    name stay.
    """
    key, cuts, held = unused(docs, "_id"), unused(docs, "_spans"), unused(docs, "_held")
    spans = shared_table(removed_spans(docs, id_col, text_col, size).select(F.col("_id").alias(key), F.col("_spans").alias(cuts)))
    # texts that lose nothing are not shuffled
    marked = may_hold(docs, id_col, spans.select(key), held)
    joined = marked.where(held).drop(held).join(spans, F.col(id_col) == F.col(key), "left").drop(key)
    joined = joined.union(marked.where(~F.col(held)).drop(held).withColumn(cuts, F.lit(None).cast(spans.schema[cuts].dataType)))
    lines = F.split(F.col(text_col), "\n")
    begins = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.size(lines)))
    # rows that share an id may be shorter than the spans: clip to their own lines
    kept = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, F.greatest(F.least(b, F.size(lines)) - a, F.lit(0)))))
    # columns of their own: a cleaned text must not stand for the text in what follows
    left, all_lines = unused(docs, "_kept"), unused(docs, "_n_lines")
    joined = joined.withColumn(left, kept).withColumn(all_lines, F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("int"))
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    out = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if report:
        removed = F.when(F.col(cuts).isNull(), 0).otherwise(F.col(all_lines) - F.size(left))
        out += [F.col(all_lines).alias(unused(docs, "n_lines")), removed.cast("int").alias(unused(docs, "n_removed"))]
    return joined.select(*out)

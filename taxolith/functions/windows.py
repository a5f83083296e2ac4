"""Ranks, adjustments and runs over windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.plans.materialise import cut


def average_rank(df: DataFrame, value: str, by: Sequence[str], name: str = "rank") -> DataFrame:
    """Rank from 1 within ``by``; ties share their mean rank (WIN-2)."""
    order = Window.partitionBy(*by).orderBy(value)
    ties = F.count("*").over(Window.partitionBy(*by, value))
    return df.withColumn(name, F.rank().over(order) + (ties - 1) / 2.0)


def adjusted(df: DataFrame, p: str, by: Sequence[str], key: Sequence[str], method: str = "bh", name: str = "q") -> DataFrame:
    """Benjamini-Hochberg or Holm adjusted p within each family; null p stay null (WIN-3).

    Families are those of ``by``, the whole table if it is empty; ``key`` breaks ties. A scan over
    ranges: tests are dealt to ranges of (family, p, key), ranked in each; counts and extremes of each
    range and family, a few rows, are carried over the ranges; so a family of any size is
    spread over all tasks.
    """
    if method not in ("bh", "holm"):
        raise ValueError(f"unknown method {method}")
    part, known, rank, size, raw = "_part", "_known", "_rn", "_m", "_raw"
    order = [*[F.col(c).asc_nulls_first() for c in by], known, F.col(p).asc_nulls_first(), *key]
    ranges = df.withColumn(known, F.col(p).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = cut(ranges.withColumn(part, F.spark_partition_id()))
    own = Window.partitionBy(part, *by, known)
    ranked = ranges.withColumn(rank, F.row_number().over(own.orderBy(p, *key)))
    # a row per range and family
    counts = ranges.groupBy(part, *by, known).agg(F.count("*").alias("_n"))
    family = Window.partitionBy(*by, known)
    before = F.coalesce(F.sum("_n").over(family.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(part, *by, known, before.alias("_before"), F.sum("_n").over(family).alias(size))
    ranked = nullsafe_join(ranked, counts, [part, *by, known]).withColumn(rank, F.col(rank) + F.col("_before")).drop("_before")
    if method == "bh":
        ranked = ranked.withColumn(raw, F.col(p) * F.col(size) / F.col(rank))
        local = F.min(raw).over(own.orderBy(F.desc(rank)).rowsBetween(Window.unboundedPreceding, 0))
        carried, take, best = F.min("_best").over(family.orderBy(part).rowsBetween(1, Window.unboundedFollowing)), F.least, F.min
    else:
        ranked = ranked.withColumn(raw, F.least(F.lit(1.0), (F.col(size) - F.col(rank) + 1) * F.col(p)))
        local = F.max(raw).over(own.orderBy(rank).rowsBetween(Window.unboundedPreceding, 0))
        carried, take, best = F.max("_best").over(family.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.greatest, F.max
    extremes = ranked.groupBy(part, *by, known).agg(best(raw).alias("_best")).select(part, *by, known, carried.alias("_carried"))
    out = nullsafe_join(ranked.withColumn("_local", local), extremes, [part, *by, known])
    value = F.least(F.lit(1.0), take("_local", "_carried"))  # a null, where there is no other range, is passed over
    return out.select(*df.columns, F.when(F.col(known), value).alias(name))


def nullsafe_join(df: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, in which nulls equal each other."""
    other = few.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in few.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(other, same).drop(*[f"_k_{k}" for k in keys])


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows numbered from 0 in an order, without gathering them in one task: ranges are counted, then numbered each."""
    ranges = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = ranges.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_before"))  # a row per range
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranges.withColumn(name, own.cast("long")).join(F.broadcast(counts), "_part").withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)


def first_n(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of each group (WIN-4, TOP-6, TOP-7)."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group by columns of ``order`` (WIN-7); groups are cut down in each task before the shuffle."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def n50(df: DataFrame, by: Sequence[str], length: str, times: str | None = None) -> DataFrame:
    """The length at which the longest pieces hold half of all (WIN-5); a row may stand for ``times`` pieces."""
    held = F.col(length) if times is None else F.col(length) * F.col(times)
    order = Window.partitionBy(*by).orderBy(F.desc(length))
    whole = F.sum(held).over(Window.partitionBy(*by))
    run = F.sum(held).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_run", run).withColumn("_all", whole).where("2 * _run >= _all").groupBy(*by).agg(F.max(length).alias("n50"))


def merge_intervals(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Union of half-open intervals within ``by``; touching ones join (WIN-6).

    Equal intervals are peers of one frame, so it does not matter which of them is first.
    """
    order = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_new", F.coalesce((F.col(start) > reach).cast("int"), F.lit(1)))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def forward_fill(levels: Sequence[str]) -> list[Column]:
    """Lineage levels from the top down, a missing one filled with the last above it (WIN-8)."""
    return [F.coalesce(*[F.col(c) for c in reversed(levels[: k + 1])]).alias(levels[k]) for k in range(len(levels))]


def upper_median(values: str | Column) -> Column:
    """Aggregate: the value at place ``n // 2`` of the sorted group (WIN-9)."""
    ordered = F.array_sort(F.collect_list(values))
    return F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))


def share(value: str, by: Sequence[str] = ()) -> Column:
    """Share of the total within ``by`` (WIN-10)."""
    return F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy(*by)))


def correlation(x: str, y: str) -> Column:
    """Aggregate: Pearson correlation, null where either side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))

"""Sparse geometry of a cohort: products of rows in blocks, leading axes, projections on metadata.

Tables are held as their positive cells. Where an absent cell has a value after a transform
(the zero of a centred log-ratio), it is one number per sample and enters as a closed term, so
no table is filled up and no row is made per pair and cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from taxolith.functions.draws import key_array, word_array
from taxolith.plans.materialise import cut

#: Least and most rows of a block; a pair of blocks is one group of work, whose products are held as arrays.
BLOCK, MOST = 256, 2048
#: Pairs of one batch of results.
OUT = 100_000
#: Columns that are multiplied at a time.
WIDE = 1024
#: Numbers of a chunk of whole rows when its zeros are filled in, and cells of a partition of chunks, which a task holds.
FILLED, HELD = 1 << 21, 1 << 21
#: Partitions of chunks, if their cells do not ask for more; pairs of them are tasks.
SIDE = 48


class Sparse(NamedTuple):
    """``cells(row, col, value)`` beside ``rows(row, total, square)`` of all rows, and the number of all columns."""

    cells: DataFrame
    rows: DataFrame
    width: int


def sparse(table: DataFrame, row: str, col: str, value: Column, width: int | None = None) -> Sparse:
    """The cells where ``value`` is not zero; totals and sums of squares are over them."""
    cells = table.select(F.col(row).alias("row"), F.col(col).alias("col"), value.cast("double").alias("value")).where("value <> 0")
    sums = cells.groupBy("row").agg(F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("square"))
    rows = table.select(F.col(row).alias("row")).distinct().join(sums, "row", "left").na.fill(0.0, ["total", "square"])
    return Sparse(cells, rows, table.select(col).distinct().count() if width is None else width)


def summed(abundance: DataFrame) -> DataFrame:
    return abundance.groupBy("sample", "taxid").agg(F.sum("count").cast("double").alias("count"))


def log_ratios(abundance: DataFrame) -> Sparse:
    """Logarithms of counts over what a zero of the sample counts as, half its least count (SCA-16).

    The centred log-ratio of a cell is its value less the sample's total over the number of
    taxa; of an absent cell it is that second term alone.
    """
    counts = cut(summed(abundance))  # read five times
    least = counts.where("count > 0").groupBy("sample").agg(F.min("count").alias("_least"))
    rows = counts.join(least, "sample", "left")
    return sparse(rows, "sample", "taxid", F.when(F.col("count") > 0, F.log(F.col("count")) - F.log(F.col("_least") / 2)).otherwise(0.0))


def pair_products(table: Sparse, what: Sequence[str] = ("dot",), block: int | None = None) -> DataFrame:
    """Sums over columns for every pair of rows, ``a < b``: of products, of the lesser values, of columns that both have.

    Rows are dealt to blocks by a hash, every cell goes to the pairs of blocks that hold its
    row, and a pair of blocks is multiplied while its cells stream by in the order of columns;
    a task holds a square of sums and some thousand columns. Blocks grow with the rows up to ``MOST``, so cells
    go to few of them. Returns ``a, b``, what is asked for (``dot, mins, shared``), and the
    totals and squares of both rows. Rows without cells are paired too. Null rows are left out.
    For many rows of few columns there is ``row_pairs``, which copies no cells.
    """
    kind = table.rows.schema["row"].dataType.simpleString()
    count = table.rows.count()
    blocks = max(1, -(-count // (block or min(MOST, max(BLOCK, count // 24)))))
    facts = ["total", "square"]
    own = table.cells.select("row", F.col("col").cast("string").alias("col"), "value", *[F.lit(None).cast("double").alias(f) for f in facts])
    marks = table.rows.select("row", F.lit(None).cast("string"), F.lit(None).cast("double"), *[F.col(f).cast("double") for f in facts])
    every = own.union(marks).where("row is not null").withColumn("own", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    every = every.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = every.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "row", "col", "value", *facts)
    # a pair of blocks is much work on few bytes, so tasks are not to be joined by their bytes
    dealt = dealt.repartition(min(blocks * (blocks + 1) // 2, 1024), "i", "j").sortWithinPartitions("i", "j", F.col("col").asc_nulls_first(), "row")

    names_out = [*what, *(f + side for f in facts for side in ("_a", "_b"))]
    arrow = to_arrow_type(table.rows.schema["row"].dataType)

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        now, names, known, sums, held = None, ({}, {}), ([], []), {}, ([], [])

        def multiply():
            """Adds the held columns' products."""
            for side in (0, 1):
                if not held[side]:
                    return
            columns = {c: k for k, c in enumerate(dict.fromkeys(c for side in held for c, _, _ in side))}
            left, right = (np.zeros((len(names[s]), len(columns))) for s in (0, 1))
            for matrix, side in ((left, 0), (right, 1)):
                at = np.array([(r, columns[c]) for c, r, _ in held[side]])
                matrix[at[:, 0], at[:, 1]] = [v for _, _, v in held[side]]
            if "dot" in what:
                sums["dot"] += left @ right.T
            if "shared" in what:
                sums["shared"] += (left > 0).astype(float) @ (right > 0).astype(float).T
            if "mins" in what:
                for k in range(len(columns)):
                    x, y = np.flatnonzero(left[:, k]), np.flatnonzero(right[:, k])
                    sums["mins"][np.ix_(x, y)] += np.minimum.outer(left[x, k], right[y, k])

        def begin():
            if not sums:
                sums.update({w: np.zeros((len(names[0]), len(names[1]))) for w in what})

        def out():
            begin()
            multiply()
            for side in held:
                side.clear()
            place = {name: k for k, name in enumerate(sorted({**names[0], **names[1]}))}
            sides = [np.array([place[name] for name in names[s]], np.int64) for s in (0, 1)]
            keys = pa.array(list(place), arrow)
            numbers = [np.array(known[s], float).reshape(-1, len(facts)) for s in (0, 1)]
            step = max(1, OUT // max(len(sides[1]), 1))
            for start in range(0, len(sides[0]), step):
                r, c = np.nonzero(np.ones((len(sides[0][start : start + step]), len(sides[1])), bool) if now[0] != now[1] else sides[0][start : start + step, None] < sides[1])
                if not len(r):
                    continue
                r += start
                x, y = sides[0][r], sides[1][c]
                swap = x > y
                columns = {w: sums[w][r, c] for w in what}
                for f, fact in enumerate(facts):
                    p, q = numbers[0][r, f], numbers[1][c, f]
                    columns |= {fact + "_a": np.where(swap, q, p), fact + "_b": np.where(swap, p, q)}
                ends = [keys.take(pa.array(np.minimum(x, y))), keys.take(pa.array(np.maximum(x, y)))]
                yield pa.RecordBatch.from_arrays([*ends, *(pa.array(columns[n]) for n in names_out)], names=["a", "b", *names_out])

        last, wide = None, 0
        for batch in batches:
            for i, j, own, row, col, value, *fact in zip(*(c.to_pylist() for c in batch.columns)):
                if (i, j) != now:
                    if now is not None:
                        yield from out()
                    now, names, known, last, wide = (i, j), ({}, {}), ([], []), None, 0
                    sums = {}
                sides = (0, 1) if i == j else (int(own == j),)
                if col is None:
                    for s in sides:
                        names[s][row] = len(names[s])
                        known[s].append(fact)
                    continue
                begin()
                if col != last:
                    last, wide = col, wide + 1
                    if wide > WIDE:
                        multiply()
                        for side in held:
                            side.clear()
                        wide = 1
                for s in sides:
                    held[s].append((col, names[s][row], value))
        if now is not None:
            yield from out()

    return dealt.mapInArrow(compute, f"a {kind}, b {kind}, " + ", ".join(f"{n} double" for n in names_out))


def chunks(table: Sparse, columns: DataFrame, width: int, facts: Sequence[str], least: int) -> DataFrame:
    """Whole rows by the hundred, ``chunk, names, numbers, sizes, at, value``: cells as arrays, names in order from chunk to chunk.

    ``columns(col, at)`` numbers the ``width`` columns. Chunks are checkpointed, in ranges of names, ``least`` at least.
    """
    kind = table.rows.schema["row"].dataType.simpleString()
    rows, cells = table.rows.where("row is not null"), table.cells.where("row is not null")
    count = rows.count()
    parts = max(least, min(SIDE, count // 1000), -(-cells.count() // HELD))
    most = max(1, min(MOST, FILLED // max(width, 1), -(-count // (4 * parts))))
    own = cells.join(F.broadcast(columns), "col").groupBy("row").agg(F.collect_list(F.struct("at", "value")).alias("c"))
    every = rows.join(own, "row", "left").select("row", *[F.col(f).cast("double") for f in facts], F.col("c.at").alias("at"), F.col("c.value").alias("value"))
    every = every.repartitionByRange(parts, "row").sortWithinPartitions("row")

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            pieces = -(-batch.num_rows // most)
            for k in range(pieces):
                start = batch.num_rows * k // pieces
                piece = batch.slice(start, batch.num_rows * (k + 1) // pieces - start)
                at, value = piece.column("at"), piece.column("value")
                sizes = np.array(at.value_lengths().fill_null(0), "<i4")
                numbers = np.stack([np.array(piece.column(f), "<f8") for f in facts], axis=1) if facts else np.zeros((len(piece), 0))
                arrays = [numbers, sizes, np.array(at.flatten(), "<i4"), np.array(value.flatten(), "<f8")]
                names = pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), piece.column("row"))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), names, *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], names=["chunk", "names", "numbers", "sizes", "at", "value"])
                number += 1

    packed = cut(every.mapInArrow(pack, f"chunk long, names array<{kind}>, numbers binary, sizes binary, at binary, value binary"))
    return packed.coalesce(parts)  # a session may deal rows to more ranges, and pairs of them are tasks


def row_pairs(table: Sparse, finish: dict[str, Callable], facts: Sequence[str] = ("total", "square"), other: Sparse | None = None) -> DataFrame:
    """What ``finish`` makes of every pair of rows, ``a < b``, or of every row of ``table`` with every one of ``other``.

    For tables with whole rows that fit in a task, as taxa over the samples of a cohort. Cells are written down once, in chunks
    of rows; a task reads two ranges of chunks, so nothing that is shuffled or kept grows with the pairs. Which
    of two tasks meets a pair of chunks depends on whether their numbers add up to an even one, so both have half.
    The functions take a dictionary of arrays that fit each other, of a strip of pairs: ``dot``, the sums of products over columns, and
    the numbers ``facts`` of both rows, columns of ``rows``, as ``total_a`` and so on. Rows without cells are paired too, null rows are left out.
    """
    kinds = [t.rows.schema["row"].dataType.simpleString() for t in (table, other or table)]
    seen = table.cells.select("col") if other is None else table.cells.select("col").intersect(other.cells.select("col"))
    places = [r["col"] for r in seen.where("col is not null").distinct().orderBy("col").collect()]
    width = len(places)
    columns = table.cells.sparkSession.createDataFrame([(c, k) for k, c in enumerate(places)], f"col {table.cells.schema['col'].dataType.simpleString()}, at int")
    first = chunks(table, columns, width, facts, 2 if other is None else 1)
    second = first if other is None else chunks(other, columns, width, facts, 1)
    held = ["chunk", "names", "numbers", "sizes", "at", "value"]
    left, right = (df.select(*[F.col(c).alias(c + end) for c in held]) for df, end in ((first, "_x"), (second, "_y")))
    left = left.hint("shuffle_replicate_nl")
    if other is None:
        even = (F.col("chunk_x") + F.col("chunk_y")) % 2 == 0
        both = left.join(right, ((F.col("chunk_x") <= F.col("chunk_y")) & even) | ((F.col("chunk_x") > F.col("chunk_y")) & ~even))
    else:
        both = left.crossJoin(right)
    alone = other is None
    names_out = list(finish)

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def side(batch, k: int, end: str):
            names = batch.column("names" + end)[k].values
            numbers, sizes, at, value = (np.frombuffer(batch.column(c + end)[k].as_py(), t) for c, t in (("numbers", "<f8"), ("sizes", "<i4"), ("at", "<i4"), ("value", "<f8")))
            cells = np.zeros((len(names), width))
            cells[np.repeat(np.arange(len(names)), sizes), at] = value
            return names, numbers.reshape(len(names), len(facts)), cells

        for batch in batches:
            for k in range(batch.num_rows):
                x, y = side(batch, k, "_x"), side(batch, k, "_y")
                numbers = [batch.column(c)[k].as_py() for c in ("chunk_x", "chunk_y")]
                if alone and numbers[0] > numbers[1]:
                    x, y = y, x
                within = alone and numbers[0] == numbers[1]
                m, n = len(x[0]), len(y[0])
                step = max(1, OUT // n)
                others = pa.concat_arrays([y[0]] * min(step, m))
                for start in range(0, m, step):
                    some = slice(start, min(start + step, m))
                    size = some.stop - start
                    pairs = {"dot": x[2][some] @ y[2].T}
                    for f, fact in enumerate(facts):
                        pairs |= {fact + "_a": x[1][some, f, None], fact + "_b": y[1][None, :, f]}
                    columns = [np.broadcast_to(of(pairs), (size, n)).ravel() for of in finish.values()]
                    ends = [x[0].take(pa.array(np.repeat(np.arange(start, some.stop), n))), others.slice(0, size * n)]
                    if within:
                        upper = np.flatnonzero(np.arange(start, some.stop)[:, None] < np.arange(n))
                        columns, ends = [c[upper] for c in columns], [e.take(pa.array(upper)) for e in ends]
                    yield pa.RecordBatch.from_arrays([*ends, *map(pa.array, columns)], names=["a", "b", *names_out])

    return both.mapInArrow(compute, ", ".join([f"a {kinds[0]}", f"b {kinds[1]}", *(f"{n} double" for n in names_out)]))


class Columns(NamedTuple):
    """A sparse table by column: ``table(col, at, value)``, the names of rows in order, what an absent cell of each row is, the number of all columns."""

    table: DataFrame
    names: list
    base: object
    width: int


def by_column(source: Sparse, centred: bool) -> Columns:
    """One row per column with the places and values of its cells; as many of them as there are rows at most.

    The names of the rows and one number for each go to the driver. ``centred``: rows are
    taken less their means, as centred log-ratios are.
    """
    import numpy as np

    rows = sorted((tuple(r) for r in source.rows.select("row", "total").where("row is not null").collect()), key=lambda r: str(r[0]))
    names = [r[0] for r in rows]
    base = -np.array([r[1] for r in rows]) / max(source.width, 1) if centred else np.zeros(len(rows))
    index = source.cells.sparkSession.createDataFrame([(n, k) for k, n in enumerate(names)], f"row {source.rows.schema['row'].dataType.simpleString()}, at int")
    cells = source.cells.join(index, "row").groupBy("col").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("c"))
    return Columns(cut(cells.select(F.col("c.at").alias("at"), F.col("c.value").alias("value"))), names, base, source.width)


def task_columns(batches: Iterator):
    """Places, values and starts of all columns of a task, as arrays."""
    import numpy as np

    at, values, sizes = [], [], []
    for batch in batches:
        sizes.append(np.diff(batch.column(0).offsets.to_numpy()))
        at.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
        values.append(batch.column(1).flatten().to_numpy(zero_copy_only=False))
    if not sizes or not sum(map(len, sizes)):
        return None
    sizes = np.concatenate(sizes)
    return np.concatenate(at).astype(np.int64), np.concatenate(values), np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes


def added(parts: DataFrame) -> dict[int, object]:
    """Sums of arrays of doubles by ``key``, in Spark; one array per key is collected."""

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums: dict = {}
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(value.as_py(), "<f8")
                sums[key] = sums[key] + own if key in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["key", "sums"])

    import numpy as np

    rows = parts.repartition("key").mapInArrow(compute, "key int, sums binary").collect()
    return {r["key"]: np.frombuffer(bytes(r["sums"]), "<f8") for r in rows}


def times(columns: Columns, q):
    """The centred table's inner products of rows, times ``q``, whose columns sum to zero: rows x columns of ``q``."""
    import numpy as np

    n, k = q.shape
    shared = columns.table.sparkSession.sparkContext.broadcast(q)  # as many numbers as the axes that the driver holds
    shift = columns.base @ q
    piece = 4096

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = task_columns(batches)
        if own is None:
            return
        at, value, starts, sizes = own
        part = np.add.reduceat(value[:, None] * shared.value[at], starts, axis=0)
        back = (part + shift)[np.repeat(np.arange(len(sizes)), sizes)] * value[:, None]
        sums = np.stack([np.bincount(at, weights=back[:, j], minlength=n) for j in range(k)], axis=1)
        keys, parts = [-1], [part.sum(axis=0)]
        for start in range(0, n, piece):
            keys.append(start // piece)
            parts.append(sums[start : start + piece].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary())], names=["key", "sums"])

    sums = added(columns.table.mapInArrow(compute, "key int, sums binary"))
    if not sums:
        return np.zeros_like(q) + np.outer(columns.base, columns.width * shift)
    body = np.concatenate([sums[key] for key in range(-(-n // piece))]).reshape(n, k)
    out = body + np.outer(columns.base, sums[-1] + columns.width * shift)
    return out - out.mean(axis=0)


def leading_axes(columns: Columns, axes: int, extra: int = 24, tolerance: float = 1e-10, rounds: int = 300):
    """Values and unit vectors of the largest axes of the rows, centred by column.

    Block subspace iteration: a round is one pass over the columns, which multiplies
    ``axes + extra`` vectors; the driver holds these vectors, never rows x rows. It ends when the
    axes' residuals are below ``tolerance`` of the largest value; an axis that has not settled after ``rounds``
    is an error. With no more rows than vectors the first round is exact.
    """
    import numpy as np

    n = len(columns.names)
    k = min(n - 1, axes + extra)
    if k < 1:
        return np.zeros(0), np.zeros((n, 0))
    start = np.random.default_rng(1).normal(size=(n, k))
    q, _ = np.linalg.qr(start - start.mean(axis=0))
    for _ in range(rounds):
        w = times(columns, q)
        small = q.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        rest = np.linalg.norm((w @ turn - (q @ turn) * values)[:, :axes], axis=0)
        if values[0] <= 0 or rest.max() <= tolerance * values[0]:
            return np.maximum(values[:axes], 0), (q @ turn)[:, :axes]
        q, _ = np.linalg.qr(w)
        q, _ = np.linalg.qr(q - q.mean(axis=0))
    raise ValueError(f"the axes have not settled in {rounds} rounds")


def permutation(seed: int, number: int, keys, blocks):
    """Rows in the order of their draws within each block: row ``k`` of the sorted block receives the k-th of them.

    Returned as ``(places, sources)``: what stood at ``sources`` stands at ``places``. Draws are counters of the
    permutation's number and the row's key, so any task makes the same one.
    """
    import numpy as np

    rows = np.arange(len(keys))
    return rows[np.argsort(blocks, kind="stable")], rows[np.lexsort((rows, word_array(seed, number, keys), blocks))]


def moved(design, places, sources):
    """``design`` such that its products with the table are those of the plain design with the permuted table."""
    import numpy as np

    out = np.empty_like(design)
    out[sources] = design[places]
    return out


def projected(columns: Columns, design, permutations: int, seed: int, blocks):
    """Inner products of a design's columns through the table, plain and for each permutation of the table's rows.

    For the design A (rows x few) and the table Y: ``A' Y Y' A``, and for every permutation the same of
    ``[B A]``, where B is A with its rows moved. One pass over the columns for all permutations;
    what comes back is a small matrix for each of them, whatever the number of rows and columns.
    """
    import numpy as np

    n, q = design.shape
    keys = key_array(columns.names)
    shared = columns.table.sparkSession.sparkContext.broadcast((design, keys, np.asarray(blocks)))  # rows x few numbers

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = task_columns(batches)
        if own is None:
            return
        at, value, starts, _ = own
        plain, names, groups = shared.value
        fixed = np.add.reduceat(value[:, None] * plain[at], starts, axis=0)
        keys_out, sums = [], []
        for number in range(permutations + 1):
            turned = moved(plain, *permutation(seed, number, names, groups)) if number else plain
            both = np.concatenate([np.add.reduceat(value[:, None] * turned[at], starts, axis=0) if number else fixed, fixed], axis=1)
            keys_out.append(number)
            sums.append(np.concatenate([(both.T @ both).ravel(), both.sum(axis=0)]).astype("<f8").tobytes())
            if len(sums) == 256 or number == permutations:
                yield pa.RecordBatch.from_arrays([pa.array(keys_out, pa.int32()), pa.array(sums, pa.binary())], names=["key", "sums"])
                keys_out, sums = [], []

    sums = added(columns.table.mapInArrow(compute, "key int, sums binary"))
    out = []
    for number in range(permutations + 1):
        turned = moved(design, *permutation(seed, number, keys, np.asarray(blocks))) if number else design
        both = np.concatenate([turned, design], axis=1)
        found = sums.get(number, np.zeros(4 * q * q + 2 * q))
        inner, total, shift = found[: 4 * q * q].reshape(2 * q, 2 * q), found[4 * q * q :], both.T @ columns.base
        out.append((inner + np.outer(total, shift) + np.outer(shift, total) + columns.width * np.outer(shift, shift), turned.T @ design))
    return out

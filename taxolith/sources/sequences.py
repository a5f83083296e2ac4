"""FASTQ and FASTA."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxolith.operators.accounting import refuse


def records_of(lines: DataFrame) -> DataFrame:
    """``path, pos, read_id, seq, qual`` of the lines of FASTQ files, ``lines(path, block, value)``, in the order of Spark's text source.

    A file is read in as many tasks as it has blocks (a gzip file is one). The lines of every
    block are counted first, so each task knows which line of a record its block begins with: no
    guess is made from what a line looks like. Records that a block ends in are put together from
    their lines, a few rows; all others never leave their task. A broken record is an error.
    """
    counts = lines.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select(F.col("path").alias("_p"), F.col("block").alias("_b"), F.coalesce(before, F.lit(0)).alias("first"))
    # one row for every block that is read, some 100 MB each
    numbered = lines.join(F.broadcast(firsts), (F.col("path") == F.col("_p")) & (F.col("block") == F.col("_b"))).select("path", "block", "first", "value")

    def assemble(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["path", "pos", "read_id", "seq", "qual", "field", "line"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
        now, at, held = None, 0, pa.array([], pa.string())

        def loose(values):
            """Lines of records that another block has the rest of."""
            n = len(values)
            places = np.arange(at, at + n)
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * n, pa.string()), pa.array(places // 4), *(pa.nulls(n, pa.string()) for _ in range(3)), pa.array(places % 4, pa.int32()), values], names=names
            )

        def whole(values):
            """Records whose four lines are all here; ``values`` begins with a header."""
            head, seq, plus, qual = (values.take(pa.array(np.arange(k, len(values), 4))) for k in range(4))
            good = pc.and_(pc.and_(pc.starts_with(head, "@"), pc.starts_with(plus, "+")), pc.equal(pc.utf8_length(seq), pc.utf8_length(qual)))
            bad = pc.index(good, False).as_py()
            if bad >= 0:
                raise ValueError(f"{now[0]}: record {at // 4 + bad} is cut off or malformed")
            n = len(head)
            ids = pc.replace_substring_regex(head, pattern=r"^@([^ ]*)(?s:.*)$", replacement=r"\1")
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n, pa.string()), pa.array(np.arange(at // 4, at // 4 + n)), ids, seq, qual, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=names)

        for batch in batches:
            paths, blocks = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            change = np.flatnonzero([k == 0 or paths[k] != paths[k - 1] or blocks[k] != blocks[k - 1] for k in range(len(paths))]) if len(paths) else []
            for start, stop in zip(change, [*change[1:], len(paths)]):
                values = batch.column(3).slice(start, stop - start)
                if (paths[start], blocks[start]) != now:
                    if len(held):
                        yield loose(held)
                    now, at, held = (paths[start], blocks[start]), batch.column(2)[int(start)].as_py(), pa.array([], pa.string())
                    head = min(-at % 4, len(values))
                    if head:
                        yield loose(values.slice(0, head))
                    at, values = at + head, values.slice(head)
                    if at % 4:  # a block of fewer lines than the record lacks
                        continue
                elif at % 4:
                    head = min(-at % 4, len(values))
                    yield loose(values.slice(0, head))
                    at, values = at + head, values.slice(head)
                values = pa.concat_arrays([held, values])
                full = len(values) // 4 * 4
                if full:
                    yield whole(values.slice(0, full))
                at, held = at + full, values.slice(full)
        if len(held):
            yield loose(held)

    rows = numbered.mapInArrow(assemble, "path string, pos long, read_id string, seq string, qual string, field int, line string")
    line = lambda k: F.max(F.when(F.col("field") == k, F.col("line")))
    parts = rows.where("field IS NOT NULL").groupBy("path", "pos").agg(line(0).alias("a"), line(1).alias("b"), line(2).alias("c"), line(3).alias("d"))
    good = F.col("a").startswith("@") & F.col("c").startswith("+") & (F.length("b") == F.length("d"))
    broken = F.raise_error(F.concat("path", F.lit(": record "), F.col("pos").cast("string"), F.lit(" is cut off or malformed")))
    parts = parts.select("path", "pos", F.when(F.coalesce(good, F.lit(False)), F.regexp_extract("a", "^@([^ ]*)", 1)).otherwise(broken).alias("read_id"), F.col("b").alias("seq"), F.col("d").alias("qual"))
    return rows.where("field IS NULL").select(*parts.columns).union(parts)


def read_fastq(spark: SparkSession, mates: Sequence[Sequence[str]], sample: str, max_reads: int = 0) -> DataFrame:
    """``sample, mate, path, pos, read_id, seq, qual`` of one or more files per mate; unequal mates are an error (SRC-9, UDF-5).

    Files are read through Spark, from any file system it knows, plain ones in blocks by many tasks.
    ``pos`` is the record's number in its file. A file that does not end with a whole record is refused.
    """
    out = None
    for mate, paths in enumerate(mates, 1):
        place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
        lines = spark.read.text(list(paths)).select(place.alias("_at"), "value").select("_at.path", "_at.block", "value")
        cut_off = lines.groupBy("path").agg(F.count("*").alias("n")).where("n % 4 > 0").select(F.concat("path", F.lit(": record "), F.expr("n div 4").cast("string"), F.lit(" is cut off or malformed")).alias("file"))
        refuse(cut_off, "broken files")
        rows = records_of(lines)
        rows = rows.where(F.col("pos") < max_reads) if max_reads else rows
        rows = rows.select(F.lit(sample).alias("sample"), F.lit(mate).alias("mate"), "path", "pos", "read_id", "seq", "qual")
        out = rows if out is None else out.unionByName(rows)
    if len(mates) == 2:
        counts = {r["mate"]: r["count"] for r in out.groupBy("mate").count().collect()}
        if counts.get(1) != counts.get(2):
            raise ValueError(f"{sample}: mates have {counts.get(1)} and {counts.get(2)} reads")
    return out


def read_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, pos, name, seq``; sequences may span lines (SRC-10)."""
    records = spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep="\n>").select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^>", "").alias("r")).where("trim(r) != ''")
    name = F.substring_index("r", "\n", 1)
    body = F.regexp_replace(F.expr("substring(r, length(substring_index(r, '\n', 1)) + 2)"), r"\s+", "")
    return records.select("path", F.xxhash64("path", name).alias("pos"), F.trim(name).alias("name"), body.alias("seq"))

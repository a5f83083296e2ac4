"""Reads and sequences: extraction, tracts, tiles, masks, distinct sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxolith.functions.draws import key_array, word_array
from taxolith.functions.kmers import codes_of, super_kmers
from taxolith.functions.scalar import translate
from taxolith.functions.windows import keep_first, merge_intervals


def extract_reads(reads: DataFrame, assignments: DataFrame, lineage: DataFrame, taxids: Sequence[str], children: bool = True, parents: bool = False) -> DataFrame:
    """Reads assigned to the taxa, and to those under or above them if asked (CMP-25, JOI-6).

    Mate suffixes of ids do not count; a clade may be as large as it is: Spark chooses the joins.
    """
    wanted = F.array(*[F.lit(t) for t in taxids])
    chosen = F.col("taxid").isin(list(taxids))
    if children:
        chosen = chosen | F.arrays_overlap(F.col("ancestors"), wanted)
    listed = lineage.where(chosen).select("taxid")
    if parents:
        listed = listed.union(lineage.where(F.col("taxid").isin(list(taxids))).select(F.explode("ancestors").alias("taxid"))).distinct()
    ids = assignments.join(listed, "taxid", "left_semi").select("sample", F.regexp_replace("read_id", r"/[12]$", "").alias("_id")).distinct()
    return reads.withColumn("_id", F.regexp_replace("read_id", r"/[12]$", "")).join(ids, ["sample", "_id"], "left_semi").drop("_id")


def attach_sequences(assignments: DataFrame, reads: DataFrame) -> DataFrame:
    """Assignments with the upper-case sequence of their read, by sample and read id (JOI-9).

    Neither side has to be in order, and a read that is missing on either side misplaces no
    other: its assignment is left out. Mate suffixes do not count.
    """
    bare = F.regexp_replace("read_id", r"/[12]$", "").alias("_id")
    first = keep_first(reads.select("sample", bare, F.upper("seq").alias("seq"), "read_id"), ["sample", "_id"], ["read_id"]).drop("read_id")
    return assignments.select("*", bare).join(first, ["sample", "_id"]).drop("_id")


def first_reads(reads: DataFrame, n: int) -> DataFrame:
    """The first n records of each file, mates in step, by record number (TOP-8)."""
    return reads.where(F.col("pos") < n)


def longest_runs(flags):
    """Longest run of true values in each row."""
    import numpy as np

    places = np.arange(flags.shape[1])
    last = np.maximum.accumulate(np.where(flags, -1, places), axis=1)
    return (places - last).max(axis=1, initial=0)


def polya(reads: DataFrame, tracts: Sequence[int] = (6, 8, 10, 12), permutations: int = 20, seed: int = 1) -> DataFrame:
    """Reads with A/T tracts against shuffles of their letters (CMP-22, UDF-2).

    A shuffle sorts a read's letters by counters of a hash of its id, mate, the permutation and the
    place. All shuffles of a read are made at once and only counts leave the task. The ratio is smoothed by half a
    count on either side. Null sequences count as empty; reads that share an id and mate are shuffled alike.
    """

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        counts: dict = {}
        numbers = np.arange(1, permutations + 1)[:, None]
        for batch in batches:
            keys = key_array([f"{r}#{m}" for r, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())])
            for sample, key, seq in zip(batch.column(0).to_pylist(), keys, batch.column(3)):
                octets = np.frombuffer((seq.as_py() or "").encode("utf-32-le", "surrogatepass"), "<u4")
                own = counts.setdefault(sample, np.zeros((2, len(tracts), 3), np.int64))
                own[:, :, 0] += 1
                # a stretch of shuffles at a time, so that a very long read takes bounded room
                step = max(1, min(permutations, 4_000_000 // max(len(octets), 1)))
                for at in range(-step, permutations, step):
                    if at < 0:
                        some = octets[None, :]
                    else:
                        draws = word_array(seed, key, numbers[at : at + step], np.arange(len(octets)))
                        some = octets[np.argsort(draws, axis=1, kind="stable")]
                    a, t = some == ord("A"), some == ord("T")
                    for kind, longest in enumerate((longest_runs(a | t), np.maximum(longest_runs(a), longest_runs(t)))):
                        for k, n in enumerate(tracts):
                            own[kind, k, 1 if at < 0 else 2] += int((longest >= n).sum())
        rows = [(s, ("mixed", "homopolymer")[kind], n, *map(int, own[kind, k])) for s, own in counts.items() for kind in (0, 1) for k, n in enumerate(tracts)]
        names = ["sample", "tract", "length", "reads", "observed", "shuffled"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)

    source = reads.select(F.col("sample").cast("string"), F.col("read_id").cast("string"), F.col("mate").cast("string"), F.col("seq").cast("string"))
    found = source.mapInArrow(compute, "sample string, tract string, length int, reads long, observed long, shuffled long")
    per = found.groupBy("sample", "tract", "length").agg(*[F.sum(c).alias(c) for c in ("reads", "observed", "shuffled")])
    expected = (F.col("shuffled") + 0.5) / (permutations + 0.5)
    return per.withColumn("expected", expected).withColumn("ratio", (F.col("observed") + 0.5) / (expected + 0.5))


def fragment_stats(reads: DataFrame) -> DataFrame:
    """Mean length and GC share of each sample's reads (AGG-21)."""
    gc = F.length(F.regexp_replace("seq", "[^GCgc]", ""))
    return reads.groupBy("sample").agg(F.count("*").alias("reads"), F.avg(F.length("seq")).alias("mean_length"), (F.sum(gc) / F.sum(F.length("seq"))).alias("gc"))


#: Stretches of one minimiser that one task compares, and letters that are split at a time.
CROWD, LETTERS = 100_000, 1 << 18


def windows(texts: list[str], k: int) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Numbers, starts and letters of texts, at most ``LETTERS`` at a time; longer texts in windows, each k-mer in one of them."""
    numbers, starts, parts, held = [], [], [], 0
    for number, whole in enumerate(texts):
        for start in range(0, max(len(whole) - k + 1, 0), LETTERS):
            part = whole[start : start + LETTERS + k - 1]
            if held and held + len(part) > LETTERS:
                yield numbers, starts, parts
                numbers, starts, parts, held = [], [], [], 0
            numbers.append(number)
            starts.append(start)
            parts.append(part)
            held += len(part)
    if parts:
        yield numbers, starts, parts


def stretches(sequences: DataFrame, k: int) -> DataFrame:
    """``name, start, minimiser, piece``: super-k-mers of ``(name, seq)``; sequences may have any letters.

    They may be nearly as many as letters, so a bounded number of letters is split at a time.
    """

    def split(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for numbers, offsets, texts in windows([t or "" for t in batch.column(1).to_pylist()], k):
                codes, bad, begins = codes_of(texts)
                starts, ends, minimisers = super_kmers(codes, bad, k)
                own = np.searchsorted(begins, starts, side="right") - 1
                at = starts - begins[own]
                pieces = [texts[t][a : a + n] for t, a, n in zip(own.tolist(), at.tolist(), (ends - starts).tolist())]
                names = batch.column(0).take(pa.array(np.array(numbers)[own]))
                yield pa.RecordBatch.from_arrays([names, pa.array(at + np.array(offsets)[own]), pa.array(minimisers), pa.array(pieces, pa.string())], names=["name", "start", "minimiser", "piece"])

    kind = sequences.schema["name"].dataType.simpleString()
    return sequences.select("name", F.col("seq").cast("string")).mapInArrow(split, f"name {kind}, start long, minimiser long, piece string")


def mask_regions(host: DataFrame, protected: DataFrame, k: int) -> DataFrame:
    """Regions of host sequences that exact k-mers of protected ones cover (JOI-14, WIN-6).

    Both are ``(name, seq)``. Super-k-mers are shuffled, not k-mers: those of the host whose minimiser no protected
    sequence has are dropped first, the others meet the different protected ones of their minimiser in a
    task, which keeps the k-mers of one minimiser at a time. A minimiser of more than ``CROWD`` host stretches is
    dealt to several tasks. Null and short sequences have no region.
    """
    theirs = stretches(protected, k).select("minimiser", "piece").distinct()
    ours = stretches(host, k).join(theirs.select("minimiser").distinct(), "minimiser", "left_semi")
    crowds = ours.groupBy("minimiser").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("deals"))
    dealt = ours.join(crowds, "minimiser").select("minimiser", F.pmod(F.xxhash64("name", "start"), F.col("deals")).cast("int").alias("deal"), F.lit(1).alias("side"), "name", "start", "piece")
    known = theirs.join(crowds, "minimiser").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    kind = host.schema["name"].dataType
    known = known.select("minimiser", "deal", F.lit(0).alias("side"), F.lit(None).cast(kind).alias("name"), F.lit(None).cast("long").alias("start"), "piece")
    met = dealt.union(known).repartition("minimiser", "deal").sortWithinPartitions("minimiser", "deal", "side")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        now, words = None, set()
        for batch in batches:
            out = []
            for minimiser, deal, side, name, start, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if (minimiser, deal) != now:
                    now, words = (minimiser, deal), set()
                if not side:
                    words.update(piece[j : j + k] for j in range(len(piece) - k + 1))
                    continue
                first = None
                for j in range(len(piece) - k + 2):
                    hit = j <= len(piece) - k and piece[j : j + k] in words
                    if hit and first is None:
                        first = j
                    elif not hit and first is not None:
                        out.append((name, start + first, start + j - 1 + k))
                        first = None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (to_arrow_type(kind), pa.int64(), pa.int64()))], names=["name", "start", "end"])

    return merge_intervals(met.mapInArrow(compare, f"name {kind.simpleString()}, start long, end long"), ["name"])


def mask_summary(host: DataFrame, regions: DataFrame) -> DataFrame:
    """Length, regions, masked positions and share of each sequence (AGG-22)."""
    per = regions.groupBy("name").agg(F.count("*").alias("regions"), F.sum(F.col("end") - F.col("start")).alias("masked"))
    rows = host.select("name", F.length("seq").alias("length")).join(per, "name", "left").na.fill(0, ["regions", "masked"])
    return rows.withColumn("masked_share", F.try_divide(F.col("masked").cast("double"), F.col("length").cast("double")))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """The first of equal sequences, upper and lower case alike (SET-6)."""
    return keep_first(sequences.withColumn("_key", F.upper("seq")), ["_key"], ["path", "pos"]).drop("_key")


def distinct_sites(sites: DataFrame) -> DataFrame:
    """Different well-formed splice sites over all libraries (SET-7)."""
    good = F.col("start").try_cast("long").isNotNull() & F.col("end").try_cast("long").isNotNull() & F.col("strand").isin("+", "-", ".") & (F.col("chrom") != "")
    return sites.where(good).select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "strand").distinct()


def tag_sequences(fasta: DataFrame, genome: str, taxid: int) -> DataFrame:
    """Sequences named ``genome__name|kraken:taxid|N`` (PRJ-10)."""
    name = F.concat(F.lit(f"{genome}__"), F.regexp_extract("name", r"^(\S+)", 1), F.lit(f"|kraken:taxid|{taxid}"))
    return fasta.select(name.alias("name"), "seq", F.lit(str(taxid)).alias("taxid"))


def cds_genes(cds: DataFrame, least: int = 450, most: int = 4500) -> DataFrame:
    """Annotated coding sequences that translate whole and are of fit length (CMP-29)."""
    rows = cds.withColumn("protein", translate(F.col("seq"))).withColumn("length", F.length("seq"))
    return rows.where(F.col("protein").isNotNull() & F.col("length").between(least, most))

"""Scalar expressions on columns; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code, codons in the order T, C, A, G.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Spelled-out ranks and their letter codes.
RANK_CODES = {
    "unclassified": "U", "root": "R", "superkingdom": "D", "domain": "D", "kingdom": "K", "phylum": "P",
    "class": "C", "order": "O", "family": "F", "genus": "G", "species": "S", "subspecies": "S1", "strain": "S1",
}


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def lenient(c: Column | str, default: float | None = 0.0) -> Column:
    """A number, or ``default`` where the text is none (SCA-1)."""
    value = F.col(c) if isinstance(c, str) else c
    out = value.try_cast("double")
    return out if default is None else F.coalesce(out, F.lit(default))


def taxid_of(c: Column) -> Column:
    """Taxid of ``Name (taxid N)`` or of a bare whole number; null otherwise (SCA-3)."""
    named = F.nullif(F.regexp_extract(c, r"\(taxid (\d+)\)\s*$", 1), F.lit(""))
    return F.coalesce(named, F.when(F.trim(c).rlike(r"^\d+$"), F.trim(c)))


def kmer_runs(c: Column) -> Column:
    """Runs of a k-mer string as ``array<struct<taxid, n>>``; ambiguous runs have a null taxid (SCA-4)."""
    tokens = F.filter(F.split(F.replace(c, F.lit("|:|"), F.lit(" ")), " +"), lambda t: t.contains(":"))
    runs = F.transform(
        tokens,
        lambda t: F.struct(
            F.when(F.substring_index(t, ":", 1).rlike(r"^\d+$"), F.substring_index(t, ":", 1)).alias("taxid"),
            F.substring_index(t, ":", -1).try_cast("long").alias("n"),
        ),
    )
    return F.filter(runs, lambda r: r["n"].isNotNull())


def rank_word(c: Column) -> Column:
    """``species``, ``genus`` or null for a letter code or a word (SCA-5)."""
    low = F.lower(F.trim(c))
    return F.when(low.rlike("^(s[0-9]*|species|subspecies|strain)$"), "species").when(low.isin("g", "genus"), "genus")


def rank_code(c: Column) -> Column:
    """Letter code of a spelled-out rank; a letter code stays (SCA-5)."""
    return F.coalesce(literal_map(RANK_CODES)[F.lower(F.trim(c))], F.trim(c))


def carries_host(c: Column, host: str) -> Column:
    """Whether a k-mer string has a run of ``host`` (SCA-6)."""
    return c.startswith(f"{host}:") | c.contains(f" {host}:")


def lineage_share(runs: Column, lineage: Column) -> Column:
    """Share of the k-mers with a taxid that lie inside ``lineage`` (SCA-7)."""
    known = F.filter(runs, lambda r: r["taxid"].isNotNull())
    total = F.aggregate(known, F.lit(0).cast("long"), lambda acc, r: acc + r["n"])
    inside = F.aggregate(F.filter(known, lambda r: F.array_contains(lineage, r["taxid"])), F.lit(0).cast("long"), lambda acc, r: acc + r["n"])
    return F.try_divide(inside.cast("double"), total.cast("double"))


def longest_run(c: Column) -> Column:
    """Length of the longest run of one character (SCA-8)."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"((.)\2*)"), 1), F.length)), F.lit(0))


def has_homopolymer(c: Column, n: int) -> Column:
    """Whether one base repeats ``n`` times (SCA-8)."""
    return c.rlike("|".join(f"{b}{{{n},}}" for b in "ACGT"))


def at_tract(c: Column, n: int, mixed: bool = True) -> Column:
    """Whether there is a run of ``n`` A or T, mixed or of one of them (SCA-9)."""
    return c.rlike(f"[AT]{{{n},}}" if mixed else f"A{{{n},}}|T{{{n},}}")


def kmers_at(sequence: Column, offset: Column, n: Column, k: int) -> Column:
    """The k-mers of the ``n`` places from ``offset`` on; those with other letters than ACGT are left out (SCA-10)."""
    places = F.when(n > 0, F.sequence(offset, offset + n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(places, lambda i: F.substring(sequence, i + 1, F.lit(k))), lambda s: s.rlike(f"^[ACGT]{{{k}}}$"))


def tiles(sequence: Column, length: int, step: int) -> Column:
    """``(start, tile)`` of every tile of ``length``, ``step`` apart (SCA-11)."""
    last = F.length(sequence) - length
    places = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("start"), F.substring(sequence, i + 1, F.lit(length)).alias("tile")))


def translate(cds: Column) -> Column:
    """Protein of a coding sequence without its stop; null unless it is whole codons without an inner stop (SCA-12)."""
    bases = "TCAG"
    codons = {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate(bases) for j, b in enumerate(bases) for k, c in enumerate(bases)}
    table = literal_map(codons)
    starts = F.when(F.length(cds) >= 3, F.sequence(F.lit(1), F.length(cds) - 2, F.lit(3))).otherwise(F.array().cast("array<int>"))
    letters = F.transform(starts, lambda i: F.coalesce(table[F.upper(F.substring(cds, i, F.lit(3)))], F.lit("X")))
    protein = F.regexp_replace(F.array_join(letters, ""), r"\*$", "")
    return F.when((F.length(cds) % 3 == 0) & (F.length(cds) > 0) & ~protein.contains("*"), protein)


def plain_name(c: Column) -> Column:
    """A taxon name for matching: lower case, rank prefix and signs gone, single spaces (SCA-13)."""
    low = F.regexp_replace(F.lower(c), r"^[a-z]__", "")
    return F.trim(F.regexp_replace(low, r"[^a-z0-9]+", " "))


def lineage_name(c: Column) -> Column:
    """A name as it stands in lineage strings (SCA-13)."""
    return F.regexp_replace(F.trim(c), r"[^A-Za-z0-9]+", "_")


def stratum_taxon(feature: Column) -> Column:
    """Taxon of a stratified feature: the species, else the genus; null if unstratified (SCA-14)."""
    stratum = F.when(feature.contains("|"), F.substring_index(feature, "|", -1))
    species = F.nullif(F.regexp_extract(stratum, r"s__([^.|]+)", 1), F.lit(""))
    genus = F.nullif(F.regexp_extract(stratum, r"g__([^.|]+)", 1), F.lit(""))
    return F.regexp_replace(F.coalesce(species, genus), "_", " ")


def log2_ratio(a: Column, b: Column) -> Column:
    """log2(a / b): null without b, minus infinity where a is zero (SCA-17)."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    return F.when(ratio > 0, F.log2(ratio)).when(ratio == 0, F.lit(float("-inf")))


def sample_of(path: Column, suffix: str = r"\.(?:report|kraken2|bracken|tsv|txt|json|log)(?:\.gz)?") -> Column:
    """Sample id of a file: its name up to the first known suffix (SCA-19)."""
    return F.regexp_extract(F.regexp_extract(path, r"([^/]+)$", 1), rf"^(.+?)(?:{suffix}.*)?$", 1)


def pass_of(path: Column) -> Column:
    """Sample and pass label of an aligner log, dots in the sample id allowed (SCA-19)."""
    pattern = r"([^/]+?)\.([^./]+)\.(?:hisat2|bowtie2|minimap2)\.summary\.log$"
    return F.struct(F.regexp_extract(path, pattern, 1).alias("sample"), F.regexp_extract(path, pattern, 2).alias("label"))


def nearest(observed: Column, available: Sequence[int]) -> Column:
    """The available value nearest to the observed one, the smaller of two equally near (PRJ-7)."""
    options = F.array(*[F.lit(v) for v in sorted(available)])
    return F.array_sort(F.transform(options, lambda a: F.struct(F.abs(a - observed).alias("d"), a.alias("v"))))[0]["v"]


def library_molecule(strategy: Column, source: Column) -> Column:
    """``rna``, ``dna`` or null from the strategy, else from the source (PRJ-6)."""
    s, o = F.upper(F.trim(strategy)), F.upper(F.trim(source))
    return (
        F.when(s.rlike("RNA"), "rna").when(s.isin("WGS", "WGA", "WXS", "AMPLICON", "WCS"), "dna")
        .when(o.rlike("TRANSCRIPTOMIC|VIRAL RNA"), "rna").when(o.rlike("GENOMIC"), "dna")
    )

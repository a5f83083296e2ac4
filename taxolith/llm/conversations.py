"""Operator 13: the cheapest repair of a conversation's roles, by whole-number weights over a graph of its rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxolith.llm.common import shared_table

# White space, edit letters in ASCII order and their digits, costs, pairs of role initials that may follow one another.
BLANK = " \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = "?DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
LEGAL = {"su", "ua", "au"}
#: Bits of a letter's digit.
DIGIT = 3
#: States by the last role: none yet, system, user, assistant. What must follow each of them if not a system message.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
ACCEPTED = (START, ASSISTANT)
#: Rows of a conversation that one task weighs together, and at most holds with their texts.
PIECE = 512


class Row(NamedTuple):
    """A row of a conversation; ``copies`` equal rows follow one another as one."""

    turn: int | None
    role: str
    text: str
    copies: int
    again: bool  # its role and text were seen earlier

    @property
    def fault(self) -> str:
        if not self.text.strip(BLANK):
            return "blank"
        if self.again:
            return "duplicate"
        return "truncated" if self.text.rstrip(BLANK)[-1] not in ".!?" else ""


class Weights:
    """Costs and audits as whole numbers: the cost above ``width`` letters of three bits each, the first letter highest.

    Zeros follow the last letter, so the least number is the least cost and, among equals, the
    audit that is least in ASCII order; a shorter one precedes its continuations.
    """

    def __init__(self, width: int):
        self.bits = width * DIGIT
        self.low = (1 << self.bits) - 1

    def before(self, letters: int, count: int, cost: int, value: int | None) -> int | None:
        """The weight of ``count`` letters (one number, the first highest) at a cost, followed by what ``value`` holds."""
        if value is None:
            return None
        return ((value >> self.bits) + cost << self.bits) | letters << self.bits - count * DIGIT | (value & self.low) >> count * DIGIT

    def read(self, value: int) -> tuple[int, int, int]:
        """Cost, letters as one number, how many."""
        low = value & self.low
        empty = (low & -low).bit_length() - 1 if low else self.bits
        count = (self.bits - empty + DIGIT - 1) // DIGIT
        return value >> self.bits, low >> self.bits - count * DIGIT, count


def spelled(letters: int, count: int) -> str:
    return "".join(LETTERS[int(d)] for d in f"{letters:0{count}o}") if count else ""


def repeated(letter: int, count: int) -> int:
    """``count`` times the same letter as one number."""
    return int(str(letter) * count, 8) if count else 0


def kept(state: int, row: Row) -> int | None:
    """State after a row that is kept, None where its initial may not come next."""
    first = row.role[:1]
    if first == "s":
        return SYSTEM if state == START else None
    then = NEXT[state]
    return then if first == ("u" if then == USER else "a") else None


def least(*values: int | None) -> int | None:
    return min((v for v in values if v is not None), default=None)


def inserting(weights: Weights, values: list) -> list:
    """Values of the states when messages may be inserted first. More than two never pay: the third returns to the first's state."""
    out = values
    for _ in range(2):
        out = [least(values[s], weights.before(INSERT, 1, COST[INSERT], out[NEXT[s]])) for s in range(4)]
    return out


def weigh(weights: Weights, rows: list[Row], after: list) -> list:
    """Least weight from each state before ``rows`` to their end, where state s weighs ``after[s]``; rows are taken from the last one."""
    values = after
    for row in reversed(rows):
        fault = row.fault
        extra = TRUNCATED_COST if fault == "truncated" else 0
        own = 1 if fault in ("", "truncated") else 0
        gone = row.copies - own
        if gone:  # further copies repeat this row, so they are deleted
            values = [weights.before(repeated(DELETE, gone), gone, COST[DELETE] * gone, v) for v in values]
        if own:
            chosen = []
            for s in range(4):
                then = kept(s, row)
                chosen.append(least(
                    weights.before(DELETE, 1, COST[DELETE], values[s]),
                    weights.before(REROLE, 1, COST[REROLE] + extra, values[NEXT[s]]),
                    None if then is None else weights.before(KEEP, 1, COST[KEEP] + extra, values[then]),
                ))
            values = chosen
        values = inserting(weights, values)
    return values


def width_of(rows: list[Row]) -> int:
    """Letters that no audit of ``rows`` exceeds, two more for the end."""
    return sum(r.copies for r in rows) + 2 * len(rows) + 2


def crossings(rows: list[Row]) -> list[tuple[int, int, int, int, int]]:
    """The best way of a piece from each state to each: ``(from, to, cost, letters, count)``.

    From one state, equal letters lead to equal states, so no way's audit continues
    another's to the same state at its cost: what follows cannot change which is best.
    """
    weights, out = Weights(width_of(rows)), []
    for to in range(4):
        values = weigh(weights, rows, [0 if s == to else None for s in range(4)])
        out += [(s, to, *weights.read(v)) for s, v in enumerate(values) if v is not None]
    return out


def joined(pieces: list[list[tuple[int, int, int, int, int]]]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost, audit, and for each piece the state before it and its letters, of a conversation's pieces in their order."""
    weights = Weights(sum(max(w[4] for w in ways) for ways in pieces) + 2)
    values, steps = inserting(weights, [0 if s in ACCEPTED else None for s in range(4)]), []
    for ways in reversed(pieces):
        best: list = [None] * 4
        for way in ways:
            s, to, cost, letters, count = way
            value = weights.before(letters, count, cost, values[to])
            if value is not None and (best[s] is None or value < best[s][0]):
                best[s] = value, way
        values = [b and b[0] for b in best]
        steps.append(best)
    cost, letters, count = weights.read(values[START])
    state, taken = START, []
    for best in reversed(steps):
        _, to, _, own, n = best[state][1]
        taken.append((state, spelled(own, n)))
        state = to
    return cost, spelled(letters, count), taken


def repaired(rows: list[Row], state: int, audit: str) -> Iterator[tuple[str, str]]:
    """Roles and texts that the letters of ``audit`` make of ``rows``, from a state on."""
    source = (r for row in rows for r in [row] * row.copies)
    for letter in audit:
        row = None if letter == "I" else next(source)
        if letter == "K":
            state = kept(state, row)
            yield row.role, row.text
        elif letter in "IR":
            state = NEXT[state]
            yield NAMES[state], "" if row is None else row.text


class Facts:
    """Counts of a run of rows in order, of which two runs that follow one another can be merged."""

    NAMES = ("blank", "duplicate", "truncated", "illegal", "distinct", "first_turn", "last_turn", "first_role", "last_role")

    def __init__(self, rows: list[Row] = ()):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None
        for row in rows:
            one = Facts()
            fault = row.fault
            if fault == "blank":
                one.blank = row.copies
            else:
                one.duplicate = row.copies - (not row.again)
                one.truncated = int(fault == "truncated")
            initial = row.role[:1]
            one.illegal = (row.copies - 1) * (initial * 2 not in LEGAL)
            one.distinct = int(row.turn is not None)
            one.first_turn = one.last_turn = row.turn
            one.first_role = one.last_role = initial
            self.add(one)

    def add(self, other: "Facts") -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.last_role is not None and other.first_role is not None and self.last_role + other.first_role not in LEGAL:
            self.illegal += 1
        if self.last_turn is not None and self.last_turn == other.first_turn:
            self.distinct -= 1
        for kind in ("turn", "role"):
            if getattr(self, "first_" + kind) is None:
                setattr(self, "first_" + kind, getattr(other, "first_" + kind))
            if getattr(other, "last_" + kind) is not None:
                setattr(self, "last_" + kind, getattr(other, "last_" + kind))

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct

    def values(self) -> tuple:
        return tuple(getattr(self, n) for n in self.NAMES)

    @classmethod
    def of(cls, values) -> "Facts":
        out = cls()
        for n, v in zip(cls.NAMES, values):
            setattr(out, n, v)
        return out


def digest(role: str, text: str) -> bytes:
    """Of a role and a text, told apart by the length of the role."""
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def lines(pairs) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in pairs).encode("utf-8", "surrogatepass")


FACTS = "blank long, duplicate long, truncated long, illegal long, distinct long, first_turn long, last_turn long, first_role string, last_role string"
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def batches_of(rows: Iterator[tuple], schema, size: int = 1000, room: int = 4_000_000) -> Iterator:
    """Arrow batches of tuples, cut by number and by the size of what they hold."""
    import pyarrow as pa

    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if len(held) >= size or weight >= room:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def mapped(df: DataFrame, each, schema: T.StructType) -> DataFrame:
    """``each`` maps an iterator of a task's rows, as tuples, to tuples of ``schema``; rows are unpacked some hundred at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def compute(batches: Iterator) -> Iterator:
        unpacked = (row for batch in batches for at in range(0, batch.num_rows, 256) for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)))
        yield from batches_of(each(unpacked), arrow)

    return df.mapInArrow(compute, schema)


def grouped(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with the same first ``width`` values."""
    from itertools import groupby

    return groupby(rows, key=lambda r: r[:width])


def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One range of the sorted rows: conversations that lie in it whole are settled, the others' rows go on.

    The first and the last conversation of a range may go on in its neighbours, and one of
    more than ``PIECE`` rows is not held: their rows are numbered and marked where role and
    text were seen before in this range. Yields ``conv_id``, the report, ``part, seq, turn, role,
    text, copies, again, key``.
    """
    part, seq = TaskContext.get().partitionId(), 0
    held: list = []

    def opened(some):
        nonlocal seq
        for conv_id, turn, role, text, copies in some:
            key = digest(role, text) if copies else None
            yield (conv_id, *[None] * 8, part, seq, turn, role, text, copies, copies > 0 and key in seen, key)
            seq += 1
            if copies:
                seen.add(key)

    for number, (_, run) in enumerate(grouped(rows, 1)):
        if held:  # the one before ended within the range
            yield settled(held)
        seen, held = set(), []
        for row in run:
            if number and held is not None:
                held.append(row)
                if len(held) > PIECE:
                    yield from opened(held)
                    held = None
            else:
                yield from opened([row])
                held = None
        held = held or []
    yield from opened(held)


def settled(some: list[tuple]) -> tuple:
    """The report of a whole conversation."""
    seen, rows = set(), []
    for _, turn, role, text, copies in some:
        if copies:
            key = (role, text)
            rows.append(Row(turn, role, text, copies, key in seen))
            seen.add(key)
    facts = Facts(rows)
    weights = Weights(width_of(rows))
    cost, letters, count = weights.read(weigh(weights, rows, inserting(weights, [0 if s in ACCEPTED else None for s in range(4)]))[START])
    audit = spelled(letters, count)
    sha = hashlib.sha256(lines(repaired(rows, START, audit))).hexdigest()
    report = facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, audit, sha
    return (some[0][0], *report, *[None] * 8)


def repair_conversations(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """The cheapest repair of every conversation of ``turns(conv_id, turn, role, text)``.

    Rows are taken by turn, nulls first, ties by role and text. A row may be kept (0), given the
    role user or assistant (3), deleted (4; blank rows and repeats of an earlier role and text
    must be), and empty user or assistant messages inserted (3 each); a row that does not end a
    sentence and stays costs 3 more. The initials of the roles must then read
    ``(s?(ua)+)?``. Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``: missing turns, rows by their first fault, adjacent roles that may not
    follow one another, the least cost, the ASCII-least letters of the edits that reach it, and
    the digest of the repaired ``role:text`` lines.

    ``copies`` says how often a row counts; with 0 it only names its conversation, which has a
    row in the result anyway.

    Equal rows are counted before they are sorted, ranges of sorted rows may cut conversations:
    those within a range are settled there, of the others pieces of some hundred rows are weighed
    side by side, from each state to each, and joined by the same whole-number weights, so no
    task holds the rows of a long conversation. Only the audit and the digest of one
    conversation, single values of the result, pass through one task each.

    Null roles and texts count as one space, a null ``conv_id`` is a conversation of its own, null
    turns come first and leave no gaps; empty and very long texts are texts like others; an empty
    table gives no rows; further columns are left out.
    """
    conv_type = turns.schema["conv_id"].dataType
    counted = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    for name in ("turn", "role", "text"):  # rows that do not count have no need of them
        counted = counted.withColumn(name, F.when(F.col("copies") > 0, F.col(name)).otherwise(None if name == "turn" else F.lit("")))
    counted = counted.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    ranges = counted.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    fields = T.StructType([T.StructField("conv_id", conv_type)])
    open_fields = "part int, seq long, turn long, role string, text string, copies long, again boolean, key binary"
    schema = lambda *parts: T.StructType([*fields, *(f for p in parts for f in T.StructType.fromDDL(p))])
    walked = shared_table(mapped(ranges, walk, schema(REPORT, open_fields)))
    report = ["conv_id", *T.StructType.fromDDL(REPORT).names]
    whole, cut = walked.where("part is null").select(*report), walked.where("part is not null")
    cut = cut.select("conv_id", "part", F.expr(f"seq div {PIECE}").alias("piece"), "seq", "turn", "role", "text", "copies", "again", "key")

    # each range has already found its own repeats, so a key has at most a row per range here
    first = cut.where("not again and copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min("part").alias("first_part"))
    fresh = cut.where("not again").join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    fresh = fresh.withColumn("again", F.coalesce(F.col("part") > F.col("first_part"), F.lit(False)))
    marked = shared_table(cut.where("again").union(fresh.select(*cut.columns)).drop("key"))

    in_order = ("part", "piece", "conv_id")
    own = ("turn", "role", "text", "copies", "again")

    def weighed(rows):
        for at, run in grouped(rows, 3):
            some = [Row(*r[4:]) for r in run if r[7]]
            ways = [list(map(str, way)) for way in crossings(some)]
            yield at[2], at[0], at[1], ways, *Facts(some).values()

    pieces = marked.select(*in_order, "seq", *own).repartition("part", "piece").sortWithinPartitions(*in_order, "seq")
    ways = shared_table(mapped(pieces, weighed, schema("part int, piece long, ways array<array<string>>", FACTS)))

    def folded(rows):
        for (conv_id,), run in grouped(rows, 1):
            run = list(run)
            facts = Facts()
            for r in run:
                facts.add(Facts.of(r[4:]))
            cost, audit, taken = joined([[tuple(map(int, w)) for w in r[3]] for r in run])
            totals = facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost, audit
            end = audit[sum(len(a) for _, a in taken) :]  # inserted after the last row
            for k, (r, (state, letters)) in enumerate(zip(run, taken)):
                yield conv_id, r[1], r[2], state, letters + end * (k == len(run) - 1), *(totals if k == 0 else [None] * 7)

    chosen = mapped(
        ways.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece"), folded,
        schema("part int, piece long, state int, letters string", REPORT.rpartition(",")[0]),
    )
    chosen = shared_table(chosen)
    steps = chosen.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("piece").alias("q"), "state", "letters")
    placed = marked.join(steps, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("piece") == F.col("q")))
    placed = placed.select(*in_order, "state", "letters", "seq", *own).repartition("part", "piece").sortWithinPartitions(*in_order, "seq")

    def rebuilt(rows):
        for (part, piece, conv_id, state, letters), run in grouped(rows, 5):
            pairs = list(repaired([Row(*r[6:]) for r in run if r[9]], state, letters))
            yield conv_id, part, piece, lines(pairs), len(pairs)

    bodies = mapped(placed, rebuilt, schema("part int, piece long, body binary, n long"))

    def hashed(rows):
        for (conv_id,), run in grouped(rows, 1):
            sha, begun = hashlib.sha256(), False
            for _, _, _, body, n in run:
                if n:
                    sha.update(b"\n" * begun + body)
                    begun = True
            yield conv_id, sha.hexdigest()

    digests = mapped(bodies.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece"), hashed, schema("repaired_sha256 string"))
    totals = chosen.where("cost is not null").join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    return whole.union(totals.select(*report))


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """``turns`` with faults that CRC-32 of ``conv_id:turn`` decides, and how often each row counts.

    0 of 20 drops a row, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes its role user. Nulls are one space.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", draw.alias("draw"), space("role").alias("role"), space("text").alias("text"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")))
    return rows, F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)

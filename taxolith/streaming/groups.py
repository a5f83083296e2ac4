"""Stateful operators on unbounded tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from taxolith.functions.scalar import carries_host


#: Members that a task holds at once, and groups of one batch of results.
HELD, OUT = 500_000, 10_000


class Release(StatefulProcessor):
    """Groups of a bucket: those that a batch brings whole never touch the state, the others are held in maps.

    ``open`` has for each open group the number that is expected, the number that is there and when its time
    is up; ``members`` has its members by number, ``seen`` the same by name.
    """

    def __init__(self, timeout_ms: int, held: int = HELD):
        self.timeout_ms, self.held = timeout_ms, held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "key string", "expected long, members long, due long")
        self.members = handle.getMapState("members", "key string, place long", "member string")
        self.seen = handle.getMapState("seen", "key string, member string", "seen boolean")
        self.groups = handle.getValueState("groups", "n long, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
        count, timer = self.groups.get() if self.groups.exists() else (0, None)
        before, full, fresh, expected, held = count, set(), {}, {}, 0

        def keep(known: bool) -> None:
            nonlocal count
            for group, own in fresh.items():
                more, done = self.keep(group, own, expected[group], due, known)
                count += more
                if done:
                    full.add(group)

        for batch in rows:
            for group, member, most in zip(batch["key"].tolist(), batch["member"].tolist(), batch["expected"].tolist()):
                own = fresh.setdefault(group, set())
                held += member not in own
                own.add(member)
                expected[group] = max(expected.get(group, 0), int(most))
            if held > self.held:  # whether a group is whole is known at the end of the batch only
                keep(count > 0)
                fresh, expected, held = {}, {}, 0
        known = count > 0
        whole = [g for g, own in fresh.items() if len(own) >= expected[g] and not (known and self.open.containsKey((g,)))]
        yield from released((g, ordered(fresh.pop(g)), True) for g in whole)
        keep(known)
        for group in full:
            most, n, _ = self.open.getValue((group,))
            if n >= most:
                yield from released([(group, self.taken(group), True)])
                count -= 1
        if count and timer is None:
            timer = due
            self.handle.registerTimer(timer)
        if count or before:
            self.settle(count, timer)

    def keep(self, group, own: set, expected: int, due: int, known: bool) -> tuple[bool, bool]:
        """Adds members to a group's state; whether it was not open, and whether all are there."""
        last, n, _ = (self.open.getValue((group,)) if known and self.open.containsKey((group,)) else None) or (0, 0, 0)
        fresh = n == 0
        for member in own:
            if fresh or not self.seen.containsKey((group, member)):
                self.seen.updateValue((group, member), (True,))
                self.members.updateValue((group, n), (member,))
                n += 1
        self.open.updateValue((group,), (max(last, expected), n, due))
        return fresh, n >= max(last, expected)

    def taken(self, group) -> list:
        """The members of an open group, which is open no more."""
        own = [self.members.getValue((group, k))[0] for k in range(self.open.getValue((group,))[1])]
        for k, member in enumerate(own):
            self.members.removeKey((group, k))
            self.seen.removeKey((group, member))
        self.open.removeKey((group,))
        return ordered(own)

    def settle(self, count: int, timer: int | None) -> None:
        if count:
            self.groups.update((count, timer))
        else:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.groups.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        late, later = [], []
        for k, v in self.open.iterator():
            (late if v[2] <= now else later).append((k[0], v[2]))
        yield from released((group, self.taken(group), False) for group, _ in late)
        timer = min((due for _, due in later), default=None)
        if timer is not None:
            self.handle.registerTimer(timer)
        self.settle(len(later), timer)

    def close(self) -> None:
        pass


def ordered(members) -> list:
    return sorted(members, key=lambda m: (m is not None, m))


def released(groups: Iterable) -> Iterator[pd.DataFrame]:
    groups = iter(groups)
    while some := list(islice(groups, OUT)):
        key, members, complete = zip(*some)
        yield pd.DataFrame({"key": list(key), "members": list(members), "complete": list(complete)})


def release_groups(members: DataFrame, timeout_ms: int = 60_000, buckets: int = 4096) -> DataFrame:
    """Release a group as soon as its expected members are there, the rest after a timeout (STR-1).

    ``members(key string, member string, expected long)``. Repeated members count once.
    Returns ``key, members array<string>, complete``. Groups are dealt to ``buckets`` by a hash of
    their key, and a bucket has one timer, so that a batch costs a call for a bucket, not several for every
    group. A batch adds its members to an open group's state and reads the whole group only when it is
    released; a group that one batch brings whole takes no state; each arrival sets a group's time
    anew. Needs the RocksDB state store (``use_state_store``).
    """
    dealt = members.select("key", "member", "expected", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").transformWithStateInPandas(Release(timeout_ms), "key string, members array<string>, complete boolean", "Append", "ProcessingTime")


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of streams that start from now on in RocksDB, on the executors' disks."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def running_taxa(assignments: DataFrame, host: str) -> DataFrame:
    """Running reads and host-marked reads of each sample and taxon; complete output mode (STR-2)."""
    return assignments.groupBy("sample", "taxid").agg(F.count("*").alias("reads"), F.count_if(carries_host(F.col("runs"), host)).alias("host_reads"))


def first_runs(runs: DataFrame, watermark: str | None = None, time_col: str = "ts") -> DataFrame:
    """Each run once (STR-3). Without a watermark the state keeps every run id it has seen."""
    if watermark is None:
        return runs.dropDuplicates(["run"])
    return runs.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["run"])


def with_static(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """A stream joined with a table that stays (STR-4)."""
    return stream.join(static, key, "left")

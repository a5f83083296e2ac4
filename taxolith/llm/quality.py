"""Operator 10: quality scores by logistic regression on hashed word n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxolith.llm.common import ChunkTokenizer, unused

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Stands for a token that repeats the one before it.
REPEAT = "\x00"


class Features:
    """Hashed n-grams of a text's words and of their shapes.

    Words are runs of letters and digits or of other signs; one that repeats its
    predecessor becomes a repeat mark. The shape of a word is its first two signs and its
    last, letters told apart by case only. N-grams of both series, n from 1 to ``order``,
    are hashed to ``2^bits`` indexes; values are counts scaled to length 1.
    """

    def __init__(self, bits: int = 18, order: int = 2, remember: int = 300_000):
        import zlib

        self.bits, self.order = bits, order

        class Known(dict):
            def __missing__(own, token):
                shape = re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", token[:2] + token[-1:])
                found = zlib.crc32(token.encode("utf-8", "surrogatepass")), zlib.crc32(b"\x01" + re.sub(r"\d", "9", shape).encode("utf-8", "surrogatepass"))
                if len(own) < remember:
                    own[token] = found
                return found

        self.known = Known()

    def __call__(self, text: str | None):
        """Sorted indexes and their values; both empty for a text without words."""
        import numpy as np

        tokens = TOKEN.findall(text or "")
        n = len(tokens)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0)
        pairs = np.fromiter((x for t in tokens for x in self.known[t]), dtype=np.uint64, count=2 * n).reshape(n, 2)
        words, shapes = pairs[:, 0].copy(), pairs[:, 1]
        words[1:][pairs[1:, 0] == pairs[:-1, 0]] = self.known[REPEAT][0]
        grams = []
        for series in (words, shapes):
            gram = series
            for k in range(self.order):
                if k:
                    gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + series[k:]
                mixed = (gram ^ gram >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
                grams.append((mixed >> np.uint64(64 - self.bits)).astype(np.int64))
        index, count = np.unique(np.concatenate(grams), return_counts=True)
        return index, count / np.sqrt((count * count).sum())


class Learner:
    """Logistic regression by follow-the-regularised-leader (proximal) updates."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-5):
        import numpy as np

        self.np, self.alpha, self.beta, self.l1, self.l2 = np, alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, index):
        np, z = self.np, self.z[index]
        step = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[index])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, step)

    def learn(self, index, value, label: int) -> None:
        np = self.np
        index, value = np.append(index, len(self.z) - 1), np.append(value, 1.0)  # the last weight is the intercept
        w = self.weights(index)
        error = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label
        gradient = error * value
        sigma = (np.sqrt(self.n[index] + gradient**2) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += gradient - sigma * w
        self.n[index] += gradient**2


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, learners: int = 4, epochs: int = 2, bits: int = 18, order: int = 2, least: int = 1000):
    """Weights learnt from labelled documents, as an array whose last entry is the intercept.

    ``labels(doc_id, label)`` may hold any number of rows; at most ``sample`` of them, those
    with the least hash of the id, are learnt from, each by the one of ``learners`` that its id
    decides; their weights are averaged by the rows they saw, so the model is the same for any
    number of partitions. There are fewer learners where each would see less than ``least`` rows. What reaches the driver is ``learners`` arrays of ``2^bits`` numbers.
    Null labels, ids and labels without a document are left out; without any label all
    weights are zero.
    """
    import numpy as np

    size = 1 << bits
    chosen = labels.where("label is not null and doc_id is not null").dropDuplicates(["doc_id"])
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    learners = max(1, min(learners, chosen.count() // least))
    # at most ``sample`` rows
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    # keys that Spark's hash deals to different tasks, so that learners work side by side
    spread = {r["at"]: r["id"] for r in docs.sparkSession.range(64 * learners).select("id", F.pmod(F.hash("id"), F.lit(learners)).alias("at")).collect()}
    keys = F.array(*[F.lit(spread.get(k, k)) for k in range(learners)])
    rows = rows.withColumn("learner", F.pmod(F.xxhash64("doc_id"), F.lit(learners)).cast("int")).withColumn("key", keys[F.col("learner")])
    rows = rows.repartition(learners, "key").sortWithinPartitions("learner", F.xxhash64("doc_id", F.lit(7)), "doc_id", "text")

    def learn(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ChunkTokenizer.forget()
        features, learner, seen, own = Features(bits, order), None, [], None

        def done():
            for epoch in range(1, epochs):
                for k in np.random.default_rng(epoch).permutation(len(seen)):
                    learner.learn(*seen[k])
            weights = learner.weights(np.arange(size + 1)).astype("<f4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([len(seen)], pa.int64()), pa.array([weights])], names=["learner", "n", "weights"])

        for batch in batches:
            for which, text, label in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if which != own:
                    if seen:
                        yield done()
                    learner, seen, own = Learner(size), [], which
                index, value = features(text.as_py())
                seen.append((index.astype(np.int32), value.astype(np.float32), int(label)))
                learner.learn(index, value, int(label))
        if seen:
            yield done()

    found = rows.select("learner", "text", "label").mapInArrow(learn, "learner int, n long, weights binary").collect()
    if not found:
        return np.zeros(size + 1, np.float32)
    found.sort(key=lambda r: r["learner"])
    return np.average([np.frombuffer(r["weights"], "<f4") for r in found], axis=0, weights=[r["n"] for r in found]).astype(np.float32)


def score(docs: DataFrame, weights, bits: int = 18, order: int = 2, name: str = "score") -> DataFrame:
    """``doc_id, text`` and the score of every whole text: a sparse dot product, next to the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^bits numbers

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ChunkTokenizer.forget()
        features, w = Features(bits, order), shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sums = np.zeros(part.num_rows)
                for k, text in enumerate(part.column(part.num_columns - 1)):
                    index, value = features(text.as_py())
                    sums[k] = w[index] @ value + w[-1]
                found = pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, name])

    return docs.mapInArrow(compute, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 20_000, learners: int = 4, epochs: int = 2) -> DataFrame:
    """Quality of every document: ``doc_id, held_out, score, predicted``.

    Rows whose CRC-32 of the id as text is divisible by 5 are held out: nothing is learnt
    from their labels. ``labels`` has ``doc_id`` and ``quality``. Only the text makes a score.

    Null and empty texts get the score of the intercept; a null id is not held out and is
    scored; repeated rows keep a row each; equal texts have equal scores; without labels all
    scores are one half; an empty table gives no rows; other columns are left out.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").alias("label")).where(~held)
    weights = train(docs, known, sample, learners, epochs)
    rows = score(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), weights)
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 20_000) -> DataFrame:
    """Documents with a score of ``threshold`` or more, with all their columns, whatever their names.

    Null and empty texts have the score of the intercept, a null id is scored by its text,
    repeated rows and equal texts share their fate, and an empty table stays empty.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").alias("label")).where(~held)
    weights = train(docs, known, sample)
    names = [c for c in docs.columns if c != "text"]
    own = unused(docs, "_score")
    rows = score(docs.select(*names, "text"), weights, name=own)
    return rows.where(F.col(own) >= threshold).select(*docs.columns)

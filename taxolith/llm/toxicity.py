"""Operator 12: toxicity by a bidirectional gated recurrent network over overlapping windows, in numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r"\w+")
#: Words of a window, and words from one window's start to the next one's.
WINDOW, STRIDE = 16, 8
#: Buckets of hashed words and of hashed character n-grams; their vectors' lengths; state of each direction.
BUCKETS, WORD_SIZE, CHAR_SIZE, STATE = 1 << 15, 8, 16, 12
GRAMS = (3, 4, 5)
#: One in so many texts weighs the evidence of documents and does not teach the network.
FOLD = 5
#: Windows that are computed side by side.
BLOCK = 1024


def grams(words: list[str]):
    """Buckets of the character n-grams of words between their two ends, one word after the other, and how many each word has.

    Of a word of more than 80 characters, its first and last 40 count.
    """
    import numpy as np

    marked = [f"\x01{w if len(w) <= 80 else w[:40] + chr(2) + w[-40:]}\x01" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters from here to the word's end
    place, found = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        value = np.full(len(at), n, np.uint64)
        for k in range(n):
            value = (value ^ codes[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        place.append(at)
        found.append((value % np.uint64(BUCKETS)).astype(np.int64))
    place, found = np.concatenate(place), np.concatenate(found)
    order = np.argsort(owner[place], kind="stable")
    return found[order], np.bincount(owner[place], minlength=len(marked))


def starts(n: int) -> range:
    """Starts of the windows of ``n`` words: every ``STRIDE`` words, the last one reaches the end; one window for few words."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


class Network:
    """Word and character vectors, a gated recurrent layer in each direction, attention, a logistic output.

    The input of a word is its hashed word vector beside the mean of its character n-gram
    vectors. Gates are those of a gated recurrent unit: update, reset and candidate. The
    attention weighs the states of both directions by the softmax of their products with a
    vector; their weighted sum gives the window's logit.
    """

    NAMES = ("words", "chars", "wf", "uf", "bf", "wb", "ub", "bb", "attend", "out", "bias")

    def __init__(self, seed: int = 3):
        import numpy as np

        draw, size, h = np.random.default_rng(seed), WORD_SIZE + CHAR_SIZE, STATE
        self.np = np
        self.p = {"words": np.zeros((BUCKETS, WORD_SIZE)), "chars": draw.normal(0, 0.1, (BUCKETS, CHAR_SIZE)), "attend": draw.normal(0, 0.1, 2 * h), "out": draw.normal(0, 0.3, 2 * h), "bias": np.zeros(1)}
        for way in "fb":
            self.p["w" + way] = draw.normal(0, 1 / np.sqrt(size), (size, 3 * h))
            self.p["u" + way] = draw.normal(0, 1 / np.sqrt(h), (h, 3 * h))
            self.p["b" + way] = np.zeros(3 * h)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def run(self, inputs, mask, way: str):
        """States after each word of one direction, and what the way back needs. ``inputs``: words times weights, (time, windows, 3 h)."""
        np, h, u = self.np, STATE, self.p["u" + way]
        state = np.zeros((inputs.shape[1], h), np.float32)
        states, kept = [None] * len(inputs), [None] * len(inputs)
        for t in range(len(inputs)) if way == "f" else range(len(inputs) - 1, -1, -1):
            x = inputs[t]
            gates = 0.5 * np.tanh(0.5 * (x[:, : 2 * h] + state @ u[:, : 2 * h])) + 0.5
            z, r = gates[:, :h], gates[:, h:]
            fresh = np.tanh(x[:, 2 * h :] + (r * state) @ u[:, 2 * h :])
            here = mask[t][:, None]
            kept[t] = (state, z, r, fresh)
            state = state + here * z * (fresh - state)
            states[t] = state
        return np.stack(states), kept

    def pooled(self, states, mask):
        np = self.np
        e = states @ self.p["attend"]
        e = np.where(mask > 0, e, -1e9)
        a = np.exp(e - e.max(0))
        a = a / a.sum(0)
        return (a[:, :, None] * states).sum(0), a

    def logits(self, forward, backward, mask):
        """Logits of windows from their projected inputs."""
        np = self.np
        states = np.concatenate([self.run(forward, mask, "f")[0], self.run(backward, mask, "b")[0]], axis=2)
        return self.pooled(states, mask)[0] @ self.p["out"] + self.p["bias"][0]

    def gradients(self, vectors, mask, labels, weights):
        """Gradients of the weighted logistic loss by all parameters, and by the word inputs ``vectors`` (time, windows, size)."""
        np, p, h = self.np, self.p, STATE
        runs = {way: self.run(vectors @ p["w" + way] + p["b" + way], mask, way) for way in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        pool, a = self.pooled(states, mask)
        logit = pool @ p["out"] + p["bias"][0]
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * weights).astype(np.float32)
        g = {"out": pool.T @ error, "bias": error.sum(keepdims=True)}
        dpool = error[:, None] * p["out"]
        along = (states * dpool).sum(2)
        de = a * (along - (a * along).sum(0))
        g["attend"] = np.einsum("tn,tnk->k", de, states)
        dstates = a[:, :, None] * dpool + de[:, :, None] * p["attend"]
        dvectors = np.zeros_like(vectors)
        for way, part in (("f", dstates[:, :, :h]), ("b", dstates[:, :, h:])):
            u, w, kept = p["u" + way], p["w" + way], runs[way][1]
            du, dw, db = np.zeros_like(u), np.zeros_like(w), np.zeros(3 * h, np.float32)
            back = np.zeros((vectors.shape[1], h), np.float32)
            for t in range(len(vectors) - 1, -1, -1) if way == "f" else range(len(vectors)):
                state, z, r, fresh = kept[t]
                back = back + part[t]
                moved = back * mask[t][:, None]
                dz, dfresh = moved * (fresh - state), moved * z
                dn = dfresh * (1 - fresh * fresh)
                dreset = dn @ u[:, 2 * h :].T
                dg = np.concatenate([dz * z * (1 - z), dreset * state * r * (1 - r), dn], axis=1)
                back = back - moved * z + dreset * r + dg[:, : 2 * h] @ u[:, : 2 * h].T
                du[:, : 2 * h] += state.T @ dg[:, : 2 * h]
                du[:, 2 * h :] += (r * state).T @ dn
                dw += vectors[t].T @ dg
                db += dg.sum(0)
                dvectors[t] += dg @ w.T
            g |= {"u" + way: du, "w" + way: dw, "b" + way: db}
        return g, dvectors

    def to_bytes(self) -> bytes:
        return b"".join(self.p[k].astype("<f4").tobytes() for k in self.NAMES)

    @classmethod
    def from_bytes(cls, data: bytes) -> "Network":
        out, at = cls(), 0
        for k in cls.NAMES:
            n = out.p[k].size
            out.p[k] = out.np.frombuffer(data, "<f4", n, at).reshape(out.p[k].shape).copy()
            at += 4 * n
        return out


class Words:
    """Numbers of the words met, in the order of their first appearance."""

    def __init__(self):
        self.number, self.fresh = {}, []

    def __call__(self, text: str | None) -> list[int]:
        out, number, fresh = [], self.number, self.fresh
        for word in TOKEN.findall((text or "").lower()):
            k = number.get(word)
            if k is None:
                k = number[word] = len(number)
                fresh.append(word)
            out.append(k)
        return out

    def take(self):
        """Of the words met since the last call: bucket of each, buckets of their character n-grams, how many of these each has."""
        import numpy as np

        fresh, self.fresh = self.fresh, []
        buckets = np.fromiter((zlib.crc32(b"\x03" + w.encode("utf-8", "surrogatepass")) % BUCKETS for w in fresh), np.int64, len(fresh))
        return buckets, *grams(fresh)


def spread(np, sizes):
    """Starts of runs of ``sizes`` elements that follow one another."""
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def vectors(network: Network, buckets, flat, sizes):
    """Input vectors of words: the word's own, and the sum of its n-grams' over the root of their number."""
    np = network.np
    sums = np.add.reduceat(network.p["chars"][flat], spread(np, sizes), axis=0)
    return np.concatenate([network.p["words"][buckets], sums / np.sqrt(sizes)[:, None].astype(np.float32)], axis=1)


def windows(np, numbers: list[int]):
    """Word numbers of a text's windows, (windows, WINDOW); -1 after the end."""
    ids = np.full(starts(len(numbers))[-1] + WINDOW, -1, np.int64)
    ids[: len(numbers)] = numbers[: len(ids)]
    return ids[np.array(starts(len(numbers)))[:, None] + np.arange(WINDOW)]


class Scorer:
    """Logits of all windows of texts, with the projected inputs of the words met so far kept (a bounded number of them)."""

    def __init__(self, network: Network, remember: int = 300_000):
        self.network, self.np, self.remember = network, network.np, remember
        self.begin()

    def begin(self) -> None:
        self.words, self.done = Words(), 0
        self.projected = {way: self.np.zeros((1024, 3 * STATE), self.np.float32) for way in "fb"}

    def project(self) -> None:
        """Inputs of the words that are new since the last call."""
        np, n = self.np, len(self.words.number)
        if n == self.done:
            return
        fresh = vectors(self.network, *self.words.take())
        for way, held in self.projected.items():
            if len(held) < n + 1:
                held = np.concatenate([held[: self.done], np.zeros((n + n // 2 + 1 - self.done, 3 * STATE), np.float32)])
            held[self.done : n] = fresh @ self.network.p["w" + way] + self.network.p["b" + way]
            held[n:] = 0  # the last row is read after the end of a text
            self.projected[way] = held
        self.done = n

    def __call__(self, texts: list[str | None]):
        """For each text, the logits of its windows."""
        np = self.np
        if len(self.words.number) > self.remember:
            self.begin()
        cut = [windows(np, self.words(t)) for t in texts]
        self.project()
        ids = np.concatenate(cut).T
        out = np.zeros(ids.shape[1])
        for at in range(0, ids.shape[1], BLOCK):
            part = ids[:, at : at + BLOCK]
            mask = (part >= 0).astype(np.float32)
            out[at : at + BLOCK] = self.network.logits(self.projected["f"][part], self.projected["b"][part], mask)
        return np.split(out, np.cumsum([len(c) for c in cut])[:-1])


def evidence(np, logits) -> list[float]:
    """What a document's windows say together: the largest logit, the mean of the four largest, the share of likely windows, and how many windows there are.

    All windows count, those with every second start alone decide the mean, so that a word
    in two overlapping windows counts once.
    """
    apart = max((np.sort(logits[k::2])[::-1][:4] for k in range(min(2, len(logits)))), key=lambda x: x.mean())
    return [float(logits.max()), float(apart.mean()), float((logits > 0).mean()), float(np.log(len(logits))), 1.0]


def logistic(np, x, y, ridge: float = 0.05, steps: int = 30):
    """Weights of a small ridge logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w = w - np.clip(step, -5, 5)
    return w


class Optimiser:
    """Adam; rows of the vector tables that a batch does not touch stay as they are."""

    def __init__(self, network: Network, rate: float = 0.01):
        np = network.np
        self.network, self.rate, self.steps = network, rate, 0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}

    def apply(self, g: dict, rows: dict) -> None:
        np, p = self.network.np, self.network.p
        self.steps += 1
        scale = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for k, d in g.items():
            at = rows.get(k, slice(None))
            one, two = self.moments[k]
            one[at] = 0.9 * one[at] + 0.1 * d
            two[at] = 0.99 * two[at] + 0.01 * d * d
            p[k][at] -= (scale * one[at] / (np.sqrt(two[at]) + 1e-6)).astype(np.float32)


def learn(texts: list[str | None], labels: list[int], rounds: int = 3, known: float = 0.5, seed: int = 5):
    """A network and the weights of a document's evidence, from whole texts with a label each.

    Only the text as a whole is labelled, so the windows that carry the label are found by
    the network itself: in the first round all windows of a toxic text are drawn from alike,
    later those which the network finds most likely; of other texts the most likely ones and
    some at random. Without texts of both kinds the result scores all texts alike.
    """
    import numpy as np

    network, draw = Network(), np.random.default_rng(seed)
    y = np.array(labels, dtype=np.float64)
    if not 0 < y.sum() < len(y):
        rate = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return network, np.array([0, 0, 0, 0, np.log(rate / (1 - rate))])
    words = Words()
    cut = [windows(np, words(t)) for t in texts]
    buckets, flat, counts = words.take()
    firsts, optimiser = spread(np, counts), Optimiser(network)

    def batch(ids, label, weight) -> None:
        mask = (ids.T >= 0).astype(np.float32)
        here, place = np.unique(ids, return_inverse=True)
        real = np.flatnonzero(here >= 0)
        some = here[real]
        if not len(some):
            return
        sizes = counts[some]
        owner = np.repeat(np.arange(len(some)), sizes)
        gram = flat[np.repeat(firsts[some] - spread(np, sizes), sizes) + np.arange(int(sizes.sum()))]
        seen = draw.random(len(some)) < known  # a word whose own vector is left out is known by its characters only
        table = np.zeros((len(here), WORD_SIZE + CHAR_SIZE), np.float32)
        table[real] = vectors(network, buckets[some], gram, sizes)
        table[real, :WORD_SIZE] *= seen[:, None]
        g, dv = network.gradients(table[place.reshape(ids.shape).T], mask, label, weight)
        dtable = np.zeros_like(table)
        np.add.at(dtable, place.reshape(ids.shape).T.ravel(), dv.reshape(-1, dv.shape[2]))
        dtable = dtable[real]
        share = (1 / np.sqrt(sizes)).astype(np.float32)[owner]
        rows = {}
        for name, keys, d in (("words", buckets[some], dtable[:, :WORD_SIZE] * seen[:, None]), ("chars", gram, dtable[owner, WORD_SIZE:] * share[:, None])):
            rows[name], at = np.unique(keys, return_inverse=True)
            g[name] = np.zeros((len(rows[name]), d.shape[1]), np.float32)
            np.add.at(g[name], at, d)
        optimiser.apply(g, rows)

    def scores():
        """Logits of the windows of every text with the present network."""
        table = np.concatenate([vectors(network, buckets, flat, counts), np.zeros((1, WORD_SIZE + CHAR_SIZE), np.float32)])
        projected = {way: table @ network.p["w" + way] + network.p["b" + way] for way in "fb"}
        ids = np.concatenate(cut)
        out = np.zeros(len(ids))
        for at in range(0, len(ids), BLOCK):
            part = ids[at : at + BLOCK].T
            out[at : at + BLOCK] = network.logits(projected["f"][part], projected["b"][part], (part >= 0).astype(np.float32))
        return np.split(out, np.cumsum([len(c) for c in cut])[:-1])

    held = y[::FOLD].sum() >= 10
    for number in range(rounds):
        logits = scores() if number else None
        chosen, label = [], []
        for k, own in enumerate(cut):
            if k % FOLD == 0 and held:
                continue
            if number == 0:
                take = draw.permutation(len(own))[: 12 if y[k] else 3]
            else:
                order = np.argsort(-logits[k], kind="stable")
                take = order[:4] if y[k] else np.concatenate([order[:2], draw.integers(0, len(own), 1)])
            chosen.append(own[take])
            label += [y[k]] * len(take)
        ids, label = np.concatenate(chosen), np.array(label, np.float32)
        weight = np.where(label > 0, 0.5 / max(label.mean(), 0.05), 1.0).astype(np.float32)
        size = int(np.clip(len(ids) // 60, 16, 256))
        for _ in range(3):
            order = draw.permutation(len(ids))
            for at in range(0, len(order), size):
                part = order[at : at + size]
                batch(ids[part], label[part], weight[part] / len(part))
    x = np.array([evidence(np, own) for own in scores()])
    apart = np.arange(len(y)) % FOLD == 0
    apart = apart if 10 <= y[apart].sum() < apart.sum() else np.ones(len(y), bool)
    return network, logistic(np, x[apart], y[apart])


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000) -> bytes:
    """The network and the evidence weights learnt from ``labels(doc_id, label)``, some 3 MB.

    At most ``sample`` labelled rows, those with the least hash of the id, are learnt from,
    in one task: a network has no parts that could be learnt side by side. Rows with a null
    label or id and labels without a document are left out.
    """
    chosen = labels.where("label is not null and doc_id is not null").dropDuplicates(["doc_id"])
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "doc_id", "text")

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        texts, marks = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([packed(*learn(texts, [int(m > 0) for m in marks]))])], names=["model"])

    found = rows.select("text", "label").mapInArrow(compute, "model binary").first()
    return found["model"] if found else packed(*learn([], []))


def packed(network: Network, weights) -> bytes:
    return network.to_bytes() + weights.astype("<f8").tobytes()


def score(docs: DataFrame, model: bytes, name: str = "score") -> DataFrame:
    """``docs``, whose last column is the text, with the toxicity of every whole text, next to the scan."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of one size for any input

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        scorer, weights = Scorer(Network.from_bytes(shared.value[:-40])), np.frombuffer(shared.value[-40:], "<f8")
        for batch in batches:
            texts, found, held, size = batch.column(batch.num_columns - 1), [], [], 0
            for k, text in enumerate(texts):
                held.append(text.as_py())
                size += len(held[-1] or "")
                if size >= 1_000_000 or k == len(texts) - 1:
                    sums = np.array([evidence(np, logits) for logits in scorer(held)]) @ weights
                    found += np.round(1 / (1 + np.exp(-np.clip(sums, -35, 35))), 6).tolist()
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(compute, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = 8_000) -> DataFrame:
    """Toxicity of every document: ``doc_id, held_out, score, predicted``.

    Rows whose CRC-32 of the id as text is divisible by 5 are held out: nothing is learnt
    from their labels. ``labels`` has ``doc_id`` and ``toxic``. Only the text makes a score;
    all overlapping windows of a text are scored, however long it is.

    Null and empty texts are one empty window and score alike; a null id is not held out and
    is scored; repeated rows keep a row each; equal texts have equal scores; without labels
    all scores are one half, with labels of one kind they are that kind's rate; an empty
    table gives no rows; other columns are left out.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").alias("label")).where(~held)
    rows = score(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), train(docs, known, sample))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

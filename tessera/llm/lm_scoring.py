"""Masked pseudo-likelihood: a window network predicts every token from both sides; the log-probabilities sum to a score.

Words are counted over all documents. The ``classes * size`` most frequent are tokens of their own, in classes by rank; the rest share
``buckets`` tokens by hash. The network takes the two words before and the two after, embeds them, and gives a softmax over classes and
buckets and, for a frequent word, one over the words of its class (tanh layer between), so the probabilities of all tokens sum to 1. A
word of a bucket also adds log P(word | bucket), its share of the bucket's occurrences in the whole corpus: a table of one row a
distinct word, which grows with the input and is joined, so every word is predicted as itself.

Texts are read twice: to count words, and to write each document's token ids, which training and scoring read. The network is
trained in numpy on every word of every document, in ROUNDS rounds of local descent: in each, a part of the documents is dealt by a hash
into groups of about GROUP words, each group starts from the round's weights and makes one pass in order of its documents, and the
groups' weights are averaged, weighted by words, FAN at a time in a fixed order. The first round starts from the words' shares. Groups follow the data alone, so the
result doesn't depend on how the input is partitioned, and what training gathers grows with the corpus, while the driver gets one
set of weights and the commonest words.

Null and empty texts score 0 over 0 words. Repeated rows are scored one by one. Words of equal counts are ranked by their characters.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, map_arrow, most_frequent, stored

ROUNDS, GROUP, FAN = 3, 1_000_000, 64
#: Positions of a step of descent, and of a block that is scored.
STEP, BLOCK = 4096, 4096
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000
TOKENS = "row long, doc_id long, n_words long, ids binary, inside double, rare array<string>"


@dataclass(frozen=True)
class Shape:
    classes: int = 16
    size: int = 128
    buckets: int = 32
    reach: int = 2
    embed: int = 8
    hidden: int = 16

    @property
    def frequent(self) -> int:
        return self.classes * self.size

    @property
    def tokens(self) -> int:
        return self.frequent + self.buckets

    def sizes(self) -> list[tuple[int, ...]]:
        c, first = 2 * self.reach * self.embed, self.classes + self.buckets
        return [(self.tokens + 1, self.embed), (c, self.hidden), (self.hidden,), (self.hidden, first), (first,), (self.classes, self.hidden, self.size), (self.classes, self.size)]

    def bucket(self, word: bytes) -> int:
        return self.frequent + zlib.crc32(word) % self.buckets


class Ids(dict):
    """Token ids of words (bytes)."""

    def __init__(self, frequent: list[str], shape: Shape):
        super().__init__({w.encode(): k for k, w in enumerate(frequent)})
        self.shape = shape

    def __missing__(self, word: bytes) -> int:
        return self.shape.bucket(word)


#: Sums of exponentials of so large values stay within single precision.
SAFE = 80.0


def _exp(z: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials in place, their sums by rows). bound: of z's values; beyond SAFE the rows' largest values are taken off."""
    if not bound < SAFE:
        z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], z.dtype)


def _slope(z: np.ndarray, place: np.ndarray, bound: float, n: int) -> np.ndarray:
    """How the mean over n rows of -log softmax at a place changes with z; in place."""
    z, total = _exp(z, bound)
    z *= (1 / (total * n))[:, None]
    z[np.arange(len(z)), place] -= 1 / n
    return z


def _log_softmax_at(z: np.ndarray, place: np.ndarray, bound: float) -> np.ndarray:
    """The log of each row's softmax at one place; z is used up."""
    at = z[np.arange(len(z)), place]
    if not bound < SAFE:
        at = at - z.max(1)
    return at - np.log(_exp(z, bound)[1])


class Network:
    def __init__(self, shape: Shape, flat: np.ndarray | None = None, seed: int = 7):
        self.shape = shape
        if flat is None:
            rng = np.random.default_rng(seed)
            biases = {2, 4, 6}
            flat = np.concatenate([np.zeros(s, np.float32).ravel() if k in biases else rng.normal(0, 0.1, s).astype(np.float32).ravel() for k, s in enumerate(shape.sizes())])
        self.flat = flat.astype(np.float32)
        self.parts = self._split(self.flat)
        self.speed = np.full_like(self.flat, 1e-6)  # sums of squared gradients
        self.room = np.empty(0, np.float32)

    def _split(self, flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([math.prod(s) for s in self.shape.sizes()])
        return [x.reshape(s) for x, s in zip(np.split(flat, ends[:-1]), self.shape.sizes(), strict=True)]

    def contexts(self, ids: np.ndarray) -> np.ndarray:
        """ids: tokens with reach pads (shape.tokens) between documents and at the ends. The context of each inner place."""
        r, n = self.shape.reach, len(ids) - 2 * self.shape.reach
        return np.stack([ids[r + o : r + o + n] for o in (*range(-r, 0), *range(1, r + 1))], 1)

    def _hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e, w1, b1 = self.parts[:3]
        x = e.take(context, axis=0).reshape(len(context), -1)
        h = x @ w1
        h += b1
        return x, np.tanh(h, out=h)

    def _linear(self, h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        """h @ w + b in memory that the next call takes again: fresh pages would cost as much as the product."""
        n, m = len(h), w.shape[1]
        if len(self.room) < n * m:
            self.room = np.empty(n * m, np.float32)
        z = np.matmul(h, w, out=self.room[: n * m].reshape(n, m))
        z += b
        return z

    def _bounds(self) -> tuple[float, float]:
        """Bounds of the values before the two softmaxes: the hidden layer is within -1 and 1."""
        _, _, _, w2, b2, w3, b3 = self.parts
        return float((np.abs(w2).sum(0) + np.abs(b2)).max()), float((np.abs(w3).sum(1) + np.abs(b3)).max())

    def _by_class(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """(place of each target in the first softmax, the rows of each class)"""
        s = self.shape
        own = np.where(target < s.frequent, target // s.size, target - s.frequent + s.classes)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(s.classes + 1))
        return own, [(c, order[a:b]) for c, (a, b) in enumerate(itertools.pairwise(cuts.tolist())) if b > a]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        _, _, _, w2, b2, w3, b3 = self.parts
        _, h = self._hidden(context)
        own, classes = self._by_class(target)
        first, second = self._bounds()
        out, within = _log_softmax_at(self._linear(h, w2, b2), own, first), target % self.shape.size
        for c, rows in classes:
            out[rows] += _log_softmax_at(self._linear(h.take(rows, axis=0), w3[c], b3[c]), within[rows], second)
        return out

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        e, w1, _, w2, b2, w3, b3 = self.parts
        grad = np.zeros_like(self.flat)
        ge, gw1, gb1, gw2, gb2, gw3, gb3 = self._split(grad)
        x, h = self._hidden(context)
        own, classes = self._by_class(target)
        first, second = self._bounds()
        n, within = len(h), target % self.shape.size
        p = _slope(self._linear(h, w2, b2), own, first, n)
        gw2[:], gb2[:] = h.T @ p, np.ones(n, p.dtype) @ p
        dh = p @ w2.T
        for c, rows in classes:
            hc = h.take(rows, axis=0)
            p = _slope(self._linear(hc, w3[c], b3[c]), within[rows], second, n)
            gw3[c], gb3[c] = hc.T @ p, np.ones(len(rows), p.dtype) @ p
            dh[rows] += p @ w3[c].T
        dh *= 1 - h * h
        gw1[:], gb1[:] = x.T @ dh, dh.sum(0)
        dx, at = (dh @ w1.T).reshape(-1, e.shape[1]), context.ravel()
        for k in range(e.shape[1]):
            ge[:, k] = np.bincount(at, dx[:, k], minlength=e.shape[0])
        self.speed += grad * grad
        self.flat -= rate * grad / np.sqrt(self.speed)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """w, n: occurrences of each distinct word of all documents. Tasks count first, and hand on their counts at COUNTED words."""

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["w", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                held.update((t.as_py() or b"").split())  # at the six white characters of common.WHITE
                if len(held) >= COUNTED:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return map_arrow(docs.select(F.col(text_col).cast("string")), run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, shape: Shape) -> tuple[list[str], np.ndarray]:
    """The most frequent words, as many rows as the shape says, and how often each token occurs."""
    top = counts.orderBy(F.desc("n"), "w").limit(shape.frequent).collect()
    each = np.zeros(shape.tokens, np.int64)
    for r in counts.groupBy((F.crc32(F.col("w").cast("binary")) % shape.buckets).alias("b")).agg(F.sum("n").alias("n")).collect():
        each[shape.frequent + r["b"]] = r["n"]
    for k, r in enumerate(top):
        each[k] = r["n"]
        each[shape.bucket(r["w"].encode())] -= r["n"]
    return [r["w"] for r in top], each


def unigrams(each: np.ndarray, shape: Shape) -> np.ndarray:
    """Weights with which every context gives the tokens' own shares: where training starts."""
    net = Network(shape)
    b2, b3 = net.parts[4], net.parts[6]
    frequent = each[: shape.frequent].reshape(b3.shape) + 0.5
    b3[:] = np.log(frequent / frequent.sum(1, keepdims=True))
    b2[:] = np.log(np.r_[frequent.sum(1), each[shape.frequent :] + 0.5] / (each + 0.5).sum())
    return net.flat


def shares(counts: DataFrame, frequent: list[str], shape: Shape) -> DataFrame:
    """w, n, inside (log P(w | bucket)) of each word that shares its token."""
    known = F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in frequent], "w string"))
    rest = counts.join(known, "w", "left_anti").withColumn("b", F.crc32(F.col("w").cast("binary")) % shape.buckets)
    whole = F.broadcast(rest.groupBy("b").agg(F.sum("n").alias("of")))
    return rest.join(whole, "b").select("w", "n", F.log(F.col("n") / F.col("of")).alias("inside"))


def tokens(docs: DataFrame, table: DataFrame, frequent: list[str], shape: Shape, hot: int = 150_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TOKENS: the token ids of each row, the sum of log P(word | bucket) over the words known here, and the other words.

    table is what shares gives. Its most frequent words (no more than `hot` rows) are known by broadcast.
    """
    ids = {w.encode(): k for k, w in enumerate(frequent)}
    inside = [0.0] * len(ids)
    for r in most_frequent(table, "n", hot).select("w", "inside").toLocalIterator():
        ids[r["w"].encode()] = len(inside)
        inside.append(r["inside"])
    token = np.array([k if k < len(frequent) else shape.bucket(w) for w, k in ids.items()] + [0], np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast((ids, token, np.array([*inside, 0.0])))
    kinds = (pa.int64(), pa.binary(), pa.float64(), pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, token, inside = shared.value
        find = ids.get
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t in b.column(2).cast(pa.binary()):
                w = (t.as_py() or b"").split()
                at = np.fromiter([find(x, -1) for x in w], np.int64, len(w))
                own = token[at]
                miss = np.flatnonzero(at < 0).tolist()
                own[miss] = [shape.bucket(w[k]) for k in miss]
                for column, x in zip(out, (len(w), own.astype("<u2").tobytes(), float(inside[at].sum()), [w[k].decode() for k in miss]), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=["row", "doc_id", "n_words", "ids", "inside", "rare"])

    return map_arrow(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)), run, TOKENS)


def _padded(ids: pa.Array, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids with pads, places of real tokens among the inner places, document of each) for a column of ids."""
    pad = np.full(shape.reach, shape.tokens, np.int64)
    each = [np.frombuffer(x.as_py(), "<u2") for x in ids]
    whole = np.concatenate([pad, *(y for x in each for y in (x, pad))])
    own = np.concatenate([np.empty(0, np.int64), *(y for k, x in enumerate(each) for y in (np.full(len(x), k), np.full(len(pad), -1)))])[: len(whole) - 2 * shape.reach]
    real = np.flatnonzero(own >= 0)
    return whole.astype(np.int64), real, own[real]


def train(rows: DataFrame, shape: Shape, start: np.ndarray, rate: float = 0.1, rounds: int = ROUNDS, group: int = GROUP) -> np.ndarray:
    """Weights after one pass over all documents of rows (stored; TOKENS) from `start` on, in `rounds` rounds."""
    spark, flat = rows.sparkSession, start
    mixed = F.xxhash64("doc_id", F.crc32("ids"))
    total = rows.agg(F.sum("n_words")).first()[0] or 0
    n_groups = max(1, math.ceil(total / rounds / group))
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            net = at = None
            seen = 0

            def done() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([seen], pa.int64()), pa.array([net.flat.astype("<f4").tobytes()], pa.binary())], names=["g", "n", "w"])

            for b in batches:
                for g, k in zip(*np.unique(b.column(0).to_numpy(), return_index=True), strict=True):
                    if g != at:
                        if seen:
                            yield done()
                        net, at, seen = Network(shape, shared.value), int(g), 0
                    ids = b.column(1).slice(int(k), int((b.column(0).to_numpy() == g).sum()))
                    whole, real, _ = _padded(ids, shape)
                    context, target = net.contexts(whole), whole[shape.reach : len(whole) - shape.reach]
                    order = np.random.default_rng(seen).permutation(real)
                    for s in range(0, len(order), STEP):
                        net.step(context.take(order[s : s + STEP], axis=0), target.take(order[s : s + STEP]), rate)
                    seen += len(real)
            if seen:
                yield done()

        part = rows.where((F.pmod(mixed, F.lit(rounds)) == r) & (F.col("n_words") > 0))
        dealt = part.select(F.pmod(F.xxhash64(mixed, F.lit(1)), F.lit(n_groups)).cast("int").alias("g"), "ids", "doc_id")
        dealt = dealt.repartitionById(n_groups, F.col("g")).sortWithinPartitions("g", "doc_id", "ids").select("g", "ids")
        got = stored(map_arrow(dealt, run, "g int, n long, w binary", 256), "weights")
        got, n = _averaged(got, n_groups)
        flat = np.frombuffer(n, "<f4").copy() if n is not None else flat
        dropped(got)
        shared.unpersist()
    return flat


def _averaged(rows: DataFrame, groups: int) -> tuple[DataFrame, bytes | None]:
    """The weighted mean of rows g, n, w, FAN neighbours at a time in order of g. (the last stored table, the mean)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, total = None, 0, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([n], pa.int64()), pa.array([(total / n).astype("<f4").tobytes()], pa.binary())], names=["g", "n", "w"])

        for b in batches:
            for r in b.to_pylist():
                if r["g"] // FAN != at:
                    if at is not None:
                        yield done()
                    at, n, total = r["g"] // FAN, 0, 0.0
                n, total = n + r["n"], total + np.frombuffer(r["w"], "<f4").astype(float) * r["n"]
        if at is not None:
            yield done()

    while True:
        groups = math.ceil(groups / FAN)
        merged = rows.repartitionById(groups, F.floor(F.col("g") / FAN).cast("int")).sortWithinPartitions("g")
        rows = stored(map_arrow(merged, run, "g int, n long, w binary", 16), "weights", rows)
        if groups == 1:
            first = rows.first()
            return rows, None if first is None else bytes(first["w"])


def score(rows: DataFrame, weights: np.ndarray, shape: Shape) -> DataFrame:
    """row, doc_id, n_words, log_probability (of the tokens) for rows of TOKENS."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(shape, shared.value)
        for b in batches:
            whole, real, own = _padded(b.column(3), shape)
            context, target = net.contexts(whole), whole[shape.reach : len(whole) - shape.reach]
            total = np.zeros(b.num_rows)
            for s in range(0, len(real), BLOCK):
                part = real[s : s + BLOCK]
                total += np.bincount(own[s : s + BLOCK], net.log_probabilities(context[part], target[part]), minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(total)], names=["row", "doc_id", "n_words", "log_probability"])

    return map_arrow(rows.select("row", "doc_id", "n_words", "ids"), run, "row long, doc_id long, n_words long, log_probability double", 256)


def pseudo_likelihood(docs: DataFrame, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text", hot: int = 150_000) -> DataFrame:  # noqa: B008
    """Trains on docs and scores them: doc_id, n_words, log_probability (of the words themselves), per_word."""
    counts = stored(word_counts(docs, text_col), "word-counts")
    frequent, each = frequent_words(counts, shape)
    table = stored(shares(counts, frequent, shape), "shares", counts)
    rows = stored(tokens(docs, table, frequent, shape, hot, id_col, text_col), "token-ids")
    weights = train(rows, shape, unigrams(each, shape))
    far = rows.select("row", F.explode("rare").alias("w")).join(table.select("w", "inside"), "w")
    none = F.lit(None).cast("long")
    parts = [score(rows, weights, shape), *(x.select("row", none.alias("doc_id"), none.alias("n_words"), F.col("inside").alias("log_probability")) for x in (rows, far))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("log_probability").alias("log_probability")).drop("row")
    return got.withColumn("per_word", F.col("log_probability") / F.greatest(F.col("n_words"), F.lit(1)))

"""Exact top-k inner product search by an impact-ordered, score-at-a-time index.

Components are quantised to integers, and a posting's impact is the power of two in its size. Each block of vectors is indexed as
segments, one for each impact, of postings (dimension, vector, value), with the norm of what each vector still has in lower
segments. A search takes a block's segments by descending impact. The norms bound what is missing, so after a segment a vector
whose highest possible score is under the k-th best score that is certain so far (of this block or of blocks before) can't be a
member; vectors that no query can have any more, and queries that can't have any vector, are left out of the lower segments, and
where few pairs remain they are rescored exactly. Ties go to the smaller id.

The index stays where it is: queries go in rounds of about ``per_round`` (a stated query set against all rows, in blocks), each round's
queries are broadcast (at most ROUND_BYTES), and every task holds its queries' k best over all of its blocks, longest vectors first.
So for a given query set the shuffle is k rows a query and task, which is linear in the vectors.

Vectors that are null or hold null or non-finite components take no part. Vectors of other lengths are taken as if filled up with
zeros. Repeated rows of one id are candidates one by one, but never of a query with their own id. Equal query rows are one query;
queries of one id with different vectors are answered one by one, with ranks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, scratch, settings, stored

INDEX = "ids binary, norms binary, width int, segments array<struct<impact:int,dims:binary,rows:binary,values:binary,rest:binary>>"
#: Most bytes of the queries of a round (as longs).
ROUND_BYTES = 32 << 20
#: Queries that meet a block at once.
AT_ONCE = 512


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component, of vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors as rows filled up with zeros)"""
    v = table.column("v").combine_chunks()
    sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = v.flatten().to_numpy()
    return table.column("vec_id").to_numpy(), out


@dataclass
class Block:
    """Vectors as segments of postings, by descending impact."""

    ids: np.ndarray
    norms: np.ndarray
    width: int
    segments: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # impact, dims, rows, values, rest

    @classmethod
    def of(cls, ids: np.ndarray, m: np.ndarray) -> Block:
        impact = np.zeros(m.shape, np.int64)
        impact[m != 0] = np.floor(np.log2(np.abs(m[m != 0]))).astype(np.int64) + 1
        squares, segments = m.astype(float) ** 2, []
        for level in sorted(set(np.unique(impact).tolist()) - {0}, reverse=True):
            rows, dims = np.nonzero(impact == level)
            segments.append((level, dims.astype("<i4"), rows.astype("<i4"), m[rows, dims], np.sqrt(np.where(impact < level, squares, 0).sum(1))))
        return cls(ids, np.sqrt(squares.sum(1)), m.shape[1], segments)

    def row(self) -> tuple:
        parts = [dict(zip(("impact", "dims", "rows", "values", "rest"), (s[0], *(x.tobytes() for x in s[1:])), strict=True)) for s in self.segments]
        return self.ids.tobytes(), self.norms.tobytes(), self.width, parts

    @classmethod
    def read(cls, ids: bytes, norms: bytes, width: int, parts: list[dict]) -> Block:
        kinds = {"dims": "<i4", "rows": "<i4", "values": "<i8", "rest": "<f8"}
        return cls(np.frombuffer(ids, "<i8"), np.frombuffer(norms, "<f8"), width, [(p["impact"], *(np.frombuffer(p[c], t) for c, t in kinds.items())) for p in parts])


def index(vectors: DataFrame, tasks: int, per_block: int) -> DataFrame:
    """INDEX: one row for each block of vec_id, v; blocks of one task by descending norm."""
    types = [pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.struct([("impact", pa.int32()), *((c, pa.binary()) for c in ("dims", "rows", "values", "rest"))]))]
    names = ["ids", "norms", "width", "segments"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            if t.num_rows:
                row = Block.of(*matrix(t)).row()
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, types, strict=True)], names=names)

    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    dealt = vectors.repartition(tasks).withColumn("norm", norm).sortWithinPartitions(F.desc("norm")).select("vec_id", "v")
    return map_arrow(dealt, build, INDEX, per_block)


def exact_kind(block: Block, q: np.ndarray) -> type:
    """A type that holds all scores of a block exactly."""
    top = float(np.abs(q).sum(1).max(initial=0)) * float(2 ** max((s[0] for s in block.segments), default=0))
    return np.float32 if top < 2**24 else np.float64 if top < 2**53 else np.int64


def search_block(block: Block, q_ids: np.ndarray, q: np.ndarray, certain: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, place in the block, exact score) of all possible members, and how many segments it took.

    certain: for each query a score that k candidates are known to reach.
    """
    kind = exact_kind(block, q)
    q = q[:, : block.width] if q.shape[1] >= block.width else np.pad(q, ((0, 0), (0, block.width - q.shape[1])))
    norm = np.sqrt((q.astype(float) ** 2).sum(1)) * (1 + 1e-9)
    certain, n = certain.astype(float), len(block.ids)
    a, v, rest, done = np.arange(len(q)), np.arange(n), block.norms, 0
    acc = np.zeros((len(q), n), kind)
    few = max(4 * k, n // 16)

    def possible(which: slice, learn: bool) -> np.ndarray:
        own = block.ids[v][None, :] == q_ids[a[which], None]
        bound = norm[a[which], None] * rest[v][None, :] * (1 + 1e-9) + 1e-6
        least = certain[a[which]]
        if len(v) > k and learn:
            low = np.where(own, -np.inf, acc[which] - bound)
            least = np.maximum(least, np.partition(low, len(v) - k, axis=1)[:, len(v) - k])
            certain[a[which]] = least
        return (acc[which] + bound >= least[:, None]) & ~own

    while True:
        last = done == len(block.segments)
        some = slice(None) if last else slice(0, len(a), max(1, len(a) // 16))
        if len(a) and len(v) and (last or possible(some, done > 0).sum() <= few * len(a[some])):
            may = possible(slice(None), done > 0)
            if last or may.sum() <= few * len(a):
                break
            rows, columns = may.any(1), may.any(0)
            a, v, acc = a[rows], v[columns], acc[np.ix_(rows, columns)]
        if not len(a) or not len(v):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), done
        _, dims, rows, values, rest = block.segments[done]
        part = _postings(block.width, dims, rows, values, v, n, kind)
        used = np.flatnonzero(part.any(1))
        acc += q[np.ix_(a, used)].astype(kind) @ part[used]
        done += 1
    at, to = np.nonzero(may)
    score = acc[at, to].astype(np.int64)
    if done < len(block.segments):  # what the lower segments add, for these pairs alone
        below = sum((_postings(block.width, d, r, x, v, n, np.int64) for _, d, r, x, _ in block.segments[done:]), np.zeros((block.width, len(v)), np.int64))
        for s in range(0, len(at), 1 << 14):
            score[s : s + (1 << 14)] += np.einsum("ij,ji->i", q[a[at[s : s + (1 << 14)]]], below[:, to[s : s + (1 << 14)]])
    return a[at], v[to], score, done


def _postings(width: int, dims: np.ndarray, rows: np.ndarray, values: np.ndarray, v: np.ndarray, n: int, kind: type) -> np.ndarray:
    """A segment's postings of the vectors v, by dimension and vector."""
    place = np.full(n, -1)
    place[v] = np.arange(len(v))
    to = place[rows]
    out = np.zeros((width, len(v)), kind)
    out[dims[to >= 0], to[to >= 0]] = values[to >= 0]
    return out


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.certain = np.full(n, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """query is sorted."""
        cuts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(query)], strict=False):
            a = query[x]
            i, s = np.concatenate([self.ids[a], ids[x:y]]), np.concatenate([self.scores[a], scores[x:y]])
            best = np.lexsort((i, -s))[: self.k]
            self.ids[a], self.scores[a] = i[best], s[best]
            if len(best) == self.k:
                self.certain[a] = s[best[-1]]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, per_block: int = 4096, per_round: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score for vec_id, v of both; ranks from 1, ties to the smaller id."""
    spark = vectors.sparkSession
    vectors = stored(vectors, "vectors")
    n, width = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    per_block = max(64, min(per_block, (per_block * 64) // max(1, width)))
    tasks = max(1, math.ceil(n / (16 * per_block)), min(math.ceil(n / per_block), 2 * spark.sparkContext.defaultParallelism))
    blocks = stored(index(vectors, tasks, per_block), "impact-index", vectors)
    asked = stored(queries.select("vec_id", "v").distinct(), "queries")
    n_asked, q_width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rounds = max(1, math.ceil(n_asked / min(per_round, max(1, ROUND_BYTES // (8 * max(1, q_width))))))
    path = scratch(spark, "nearest")

    def task(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q_ids, q = shared.value
            best = Best(len(q_ids), k)
            for b in batches:
                for row in b.to_pylist():
                    block = Block.read(row["ids"], row["norms"], row["width"], row["segments"])
                    for at in range(0, len(q_ids), AT_ONCE):
                        a, v, score, _ = search_block(block, q_ids[at : at + AT_ONCE], q[at : at + AT_ONCE], best.certain[at : at + AT_ONCE], k)
                        best.add(a + at, block.ids[v], score)
            number = np.repeat(np.arange(len(q_ids)), [len(x) for x in best.ids])
            columns = [number, q_ids[number], *(np.concatenate(x) if x else np.empty(0, np.int64) for x in (best.ids, best.scores))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["number", "query_id", "vec_id", "score"])

        return run

    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    for r in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(rounds)) == r).toArrow()
        shared = spark.sparkContext.broadcast(matrix(rows))
        found = map_arrow(blocks, task(shared), "number long, query_id long, vec_id long, score long", 1)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            found.write.mode("append").parquet(path)
        shared.unpersist()
    return spark.read.schema(found.schema).parquet(path)

"""Best-fit packing of tokenised documents into sequences, under vector capacities.

A sequence has three capacities: tokens, documents, and attention cost (sum of squared piece lengths). Pieces are placed by
decreasing size into the open sequence that fits under every capacity and is best by the weighted residual norm (or the
weighted dot product of the piece and what is left); a new sequence opens only where none fits.

Pieces are dealt by a hash over partitions of about ``per_task`` pieces, whatever the input: each task packs its own, so
memory is bounded, and a task leaves at most a few sequences partly filled. A retried task gives the same sequences.

Null and empty texts are documents of no tokens but the separator. Repeated rows are packed one by one. Special strings in
texts count as the tokens they stand for, which is the tokeniser library's default.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class Capacity:
    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    #: Weights of the three residuals; each is taken as a share of its capacity.
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    #: "norm": least weighted residual norm. "dot": greatest weighted dot product of piece and residual.
    choose: str = "norm"


_encodings: dict[str, object] = {}


def byte_bpe(name: str = "byte_bpe_50k.tiktoken", special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)):
    """The byte-level BPE of byte_bpe_50k.json by its ranks; the tests hold its ids against the tokenizers library."""
    if name not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
    return _encodings[name]


@cache
def _library(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def token_ids(text: str | None, name: str = "byte_bpe_50k") -> np.ndarray:
    """The ids of a text. Texts that the quick way refuses (blanks by the hundred thousand in one run) go to the library itself."""
    if not text:
        return np.empty(0, np.uint32)
    try:
        return byte_bpe(f"{name}.tiktoken").encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(_library(f"{name}.json").encode(text, add_special_tokens=False).ids, np.uint32)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than most."""
    first = n % most or most
    return [(0, first), *((s, most) for s in range(first, n, most))] if n > most else [(0, n)]


def pieces(docs: DataFrame, most: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """PIECES: each document's ids and the separator, cut into pieces of at most `most` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids = token_ids(text)
                ids = np.append(ids, separator).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), most)):
                    for column, x in zip(out, (doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, PIECES)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, for lengths in descending order."""
    whole = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    w = np.array(capacity.weights, float)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.empty((1024, 3))  # residuals of the open bins, as shares
    name, used = np.empty(1024, np.int64), np.empty(1024, np.int64)
    n_open = n_bins = 0
    least = lengths[-1] / whole[0] if len(lengths) else 0
    for k, size in enumerate(lengths):
        item = np.array([size, 1, float(size) * size]) / whole
        if (item > 1 + 1e-12).any():
            raise ValueError(f"a piece of {size} tokens exceeds a capacity by itself")
        now = left[:n_open]
        fits = (now >= item - 1e-12).all(axis=1)
        if fits.any():
            rest = now - item
            score = -(now * item) @ w if capacity.choose == "dot" else (rest * rest) @ w
            at = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            if n_open == len(left):
                left, name, used = (np.concatenate([x, np.empty_like(x)]) for x in (left, name, used))
            at, n_open = n_open, n_open + 1
            left[at], name[at], used[at] = 1.0, n_bins, 0
            n_bins += 1
        bins[k], offsets[k] = name[at], used[at]
        left[at] -= item
        used[at] += size
        if left[at, 0] < least - 1e-12 or left[at, 1] < 1 / whole[1] - 1e-12 or left[at, 2] < least * least * whole[0] ** 2 / whole[2] - 1e-12:
            n_open -= 1  # nothing fits any more: the last open bin takes its place
            left[at], name[at], used[at] = left[n_open], name[n_open], used[n_open]
    return bins, offsets


def pack(rows: DataFrame, capacity: Capacity = Capacity(), per_task: int = 20_000) -> DataFrame:  # noqa: B008
    """PACKED: every row of PIECES with its sequence and its place there."""
    rows = stored(rows, "pieces")
    tasks = max(1, math.ceil(rows.count() / per_task))

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        all_ = pa.Table.from_batches(got).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(all_.column("length").to_numpy(), capacity)
        all_ = all_.append_column("sequence_id", pa.array((TaskContext.get().partitionId() << 32) + bins)).append_column("offset", pa.array(offsets))
        yield from all_.to_batches()

    return map_arrow(rows.repartition(tasks, F.xxhash64("doc_id", "piece")), run, PACKED, None)


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    return pack(pieces(docs, capacity.tokens, id_col=id_col, text_col=text_col), capacity)

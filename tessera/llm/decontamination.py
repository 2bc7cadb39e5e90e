"""Benchmark windows in documents by a block-wise multi-pattern search.

Texts become bytes of words with single spaces around them, so a window of a benchmark item is a byte string between spaces. A table of shifts by
the last eight bytes of where the search stands (a block) says how far no window can begin; where the shift is zero, the block selects the bucket
of windows whose first bytes end in it, and the text's own window there is compared with the bucket's strings, byte by byte. A few thousand
places of a batch of texts step on at once, in numpy.

Windows are dealt by hash to parts of a bounded number of windows; each part is broadcast and all documents go by it, one part after another in
the same tasks, so the work is documents times parts and no text is shuffled.

Defined results: null and empty texts have no words, hits or items; null item ids and items without words are left out; repeated documents and items give the same rows
and ids; an item's windows that repeat count once. Texts are searched whole, at any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, map_arrow, stored

WINDOW = 10
BLOCK = 8
#: Entries of the shift table, as bits of a block's hash.
SHIFT_BITS = 22
#: Windows, and (window, item) pairs, that one broadcast part has at most on average: some 200 MB in a worker.
PART_WINDOWS = 500_000
#: Bytes of text that are searched together; one longer text alone.
TOGETHER = 4_000_000
#: Places that step together are so many bytes apart.
STRIDE = 2048

SPACE, END = 32, 10
#: Of each byte: letters in lower case, digits, bytes of other characters; else a space.
NORMAL = np.full(256, SPACE, np.uint8)
NORMAL[48:58], NORMAL[65:91], NORMAL[97:123], NORMAL[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)
UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, then runs of digits, a-z and characters beyond ASCII."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """window (its words between single spaces), n_words, items: each different window and the items that have it."""
    rows = benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    each = rows.select("item", F.explode(let(F.col("w"), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1))), lambda i: F.slice(w, i, F.lit(size))))).alias("g")).distinct()
    return each.groupBy(F.array_join("g", " ").alias("window"), F.size("g").alias("n_words")).agg(F.array_sort(F.collect_list("item")).alias("items"))


def blocks_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number; a view."""
    return np.ndarray((max(0, len(text) - BLOCK + 1),), "<u8", text, strides=(1,))


def hashed(blocks: np.ndarray) -> np.ndarray:
    return (blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SHIFT_BITS)


class Patterns:
    """Windows of one kind (all of `size` words, or all shorter ones) as shift table and buckets."""

    def __init__(self, found: list[tuple[bytes, int, int]]):
        """found: (window between spaces, words, number)"""
        # where the shortest string has less than a block, blocks begin in what stands before it
        self.least = min(255, max(BLOCK, min(len(w) for w, _, _ in found)))
        self.lengths = sorted({n for _, n, _ in found})
        self.shift = np.full(1 << SHIFT_BITS, self.least - BLOCK + 1, np.uint8)
        self.buckets: dict[int, dict[bytes, int]] = {}
        self.short: dict[bytes, int] = {w: k for w, _, k in found if len(w) < BLOCK}
        for w, _, k in found:
            if len(w) >= BLOCK:
                head = np.frombuffer(w[: self.least], np.uint8)
                blocks = blocks_at(head)
                np.minimum.at(self.shift, hashed(blocks), np.arange(len(blocks) - 1, -1, -1, dtype=self.shift.dtype))
                self.buckets.setdefault(int(blocks[-1]), {})[w] = k

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Where a window may begin: spaces that the shift table didn't rule out."""
        if self.short:  # of strings shorter than a block every word may be one
            return np.flatnonzero(text[:-1] == SPACE)
        blocks, first, last = blocks_at(text), self.least - BLOCK, len(text) - BLOCK
        starts = np.arange(first, last + 1, STRIDE)
        at, ends, out = starts.copy(), np.minimum(starts + STRIDE, last + 1), []
        while len(at):
            step = self.shift[hashed(blocks[at])].astype(np.int64)
            hit = at[step == 0] - first
            out.append(hit[text[hit] == SPACE])
            at = at + np.maximum(step, 1)
            going = at < ends
            at, ends = at[going], ends[going]
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)

    def occurrences(self, text: np.ndarray, spaces: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(index of the space before the first word, words, number of the window) of each occurrence."""
        raw = text.tobytes()
        at = self.candidates(text)
        for place, k in zip(at.tolist(), np.searchsorted(spaces, at).tolist(), strict=True):
            bucket = self.short if self.short else self.buckets.get(int.from_bytes(raw[place + self.least - BLOCK : place + self.least], "little"))
            if bucket is None:
                continue
            for n in self.lengths:
                if k + n < len(spaces):
                    window = raw[place : spaces[k + n] + 1]
                    number = bucket.get(window)
                    if number is None and self.short and len(window) >= self.least:
                        number = self.buckets.get(int.from_bytes(window[self.least - BLOCK : self.least], "little"), {}).get(window)
                    if number is not None:
                        yield k, n, number


class Matcher:
    """A part of the windows, searched in batches of texts."""

    def __init__(self, rows: list[tuple[str, int, list]], size: int):
        found = [(f" {w} ".encode(), n, k) for k, (w, n, _) in enumerate(rows)]
        kinds = [[f for f in found if f[1] == size], [f for f in found if f[1] < size]]
        self.kinds = [Patterns(k) for k in kinds if k]
        self.items = [i for _, _, i in rows]

    def search(self, texts: list[bytes]) -> tuple[list[int], list[list[int]], list[set[str]]]:
        """For each text its words, the words (from 0) inside windows, and the items whose windows occur."""
        text, first = normal(texts)
        spaces = np.flatnonzero(text == SPACE)
        # the texts' first spaces: one space more than words in each
        begin = np.searchsorted(spaces, first)
        n_words = np.diff(begin) - 1
        cover = np.zeros(len(spaces) + 1, np.int32)
        items: list[set[str]] = [set() for _ in texts]
        for kind in self.kinds:
            for k, n, number in kind.occurrences(text, spaces):
                cover[k] += 1
                cover[k + n] -= 1
                items[int(np.searchsorted(begin, k, side="right")) - 1].update(self.items[number])
        inside = np.cumsum(cover) > 0
        hits = [np.flatnonzero(inside[a : b - 1]).tolist() for a, b in zip(begin[:-1], begin[1:], strict=True)]
        return n_words.tolist(), hits, items


def normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of bytes, words between single spaces and an end mark after each; where each begins, and the end."""
    raw = np.frombuffer(b"".join(b" " + t + b" \n" for t in texts), np.uint8)
    ends = np.cumsum([len(t) + 3 for t in texts])
    text = NORMAL[raw]
    text[ends - 1] = END
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != SPACE) | (text[:-1] != SPACE)
    kept = np.concatenate([[0], np.cumsum(keep)])
    return text[keep], kept[np.concatenate([[0], ends])]


def searched(docs: DataFrame, part: list[tuple[str, int, list]], size: int, last: bool) -> DataFrame:
    """docs (columns to keep, __n, __hits, __items, __text) with what this part of the windows finds; without __text after the last part."""
    shared = docs.sparkSession.sparkContext.broadcast(part)
    out = docs.drop("__text").schema if last else docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = None
        for b in batches:
            matcher = matcher or Matcher(shared.value, size)
            ends, begin = np.cumsum(pc.fill_null(pc.binary_length(b.column(-1)), 0).to_numpy(zero_copy_only=False)), 0
            while begin < b.num_rows:
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + TOGETHER, side="right")))
                rows = b.slice(begin, end - begin)
                n_words, hits, items = matcher.search([t or b"" for t in rows.column(-1).cast(pa.binary()).to_pylist()])
                merged = lambda new, old: [sorted({*x, *o}) for x, o in zip(new, old.to_pylist(), strict=True)]
                new = [pa.array(n_words, pa.int64()), pa.array(merged(hits, rows.column(-3)), pa.list_(pa.int64())), pa.array(merged(items, rows.column(-2)), pa.list_(pa.string()))]
                columns = [*rows.columns[:-4], *new, *([] if last else [rows.column(-1)])]
                yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names[: len(columns)])
                begin = end

    return map_arrow(docs, run, out)


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id", size: int = WINDOW, part_windows: int = PART_WINDOWS) -> DataFrame:
    """The columns `keep` of docs with n_words, hits (places of words inside windows, from 0) and items (ids whose windows occur, as strings, sorted)."""
    found = stored(windows(benchmark, item, text, size), "benchmark-windows")
    many = found.agg(F.sum(F.size("items"))).first()[0] or 0
    parts = max(1, -(-many // part_windows))
    kept = [F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.lit(0).cast("long").alias("__n"), F.array().cast("array<long>").alias("__hits"), F.array().cast("array<string>").alias("__items"), F.col(text).alias("__text"))
    for p in range(parts):
        part = found.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == p)
        rows = searched(rows, [(r.window, r.n_words, r["items"]) for r in part.collect()], size, p == parts - 1)  # one bounded part at a time
    return rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("__n").alias("n_words"), F.col("__hits").alias("hits"), F.col("__items").alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, part_windows: int = PART_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = contaminated(docs, benchmark, ["doc_id"], size=size, part_windows=part_windows)
    return rows.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, most_share: float = 0.0, text: str = "text", item: str = "item_id", size: int = WINDOW) -> DataFrame:
    """The documents, with their own columns, of whose words at most this share is inside benchmark windows."""
    rows = contaminated(docs, benchmark, docs.columns, text, item, size)
    return rows.where(F.size("hits") <= F.col("n_words") * most_share).select(*docs.columns)

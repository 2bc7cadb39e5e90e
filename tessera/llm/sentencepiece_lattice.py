"""SentencePiece encoding and decoding as a relational lattice.

Texts fall into words (where no piece of the model crosses: at runs of spaces, line ends, and between letters and others). Each distinct
word is encoded once: its substrings of bounded length are exploded and equi-joined to the piece table, the matches are the
word's edges, and edges grouped by word are folded into its pieces. The words table stays partitioned by word, so exploding,
joining and grouping take no further shuffle.

The fold. A unigram model takes the best path: ``viterbi`` folds the edges by end with Spark's ``aggregate``. The model here
is a BPE model, whose pieces are what merging gives, not the best path; ``merge_edges`` therefore folds the same edges by
repeatedly taking the best edge that spans exactly two neighbouring parts (the leftmost of equals). Characters without a
piece become their UTF-8 bytes' pieces.

Null and empty texts have no pieces. Repeated rows are encoded one by one.
"""

from __future__ import annotations

import contextlib
import hashlib
import heapq
import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, most_frequent, settings, stored

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Digests are sums of word digests times powers of STEP, mod PRIME: products of two stay in a long.
PRIME, STEP = 2**31 - 1, 48_271
#: A block is a run of whole documents of one partition, ended at so many characters: what numbers its words and is put together at once.
BLOCK = 32_000_000
#: A place is partition << 43 | block of the partition << 28 | number of the word in the block.
NUMBER_BITS, BLOCK_BITS = 28, 15


@cache
def processor(name: str = MODEL):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))


@cache
def pieces(name: str = MODEL) -> tuple[tuple[str, int, float], ...]:
    """(piece, id, score) of the normal pieces: as many rows as the model has."""
    p = processor(name)
    return tuple((p.id_to_piece(i), i, p.get_score(i)) for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)))


@cache
def byte_ids(name: str = MODEL) -> tuple[int, ...]:
    p = processor(name)
    return tuple(p.piece_to_id(f"<0x{b:02X}>") for b in range(256))


@cache
def splitters(name: str = MODEL) -> tuple[re.Pattern, re.Pattern]:
    """Cuts where no piece of the model spans: before each run of spaces, around line ends, between letters and others.

    Letters are the word characters but digits, the underscore and what the model's pieces have of other numerals. The first
    pattern lists the letters up to U+FFFF, which makes the class one table look-up; the second is for texts with others.
    """
    rows = [p for p, _, _ in pieces(name)]
    if any(SPACE in p.lstrip(SPACE) for p in rows):
        raise ValueError(f"{name}: a piece has the space mark after other characters")
    line = "" if any("\n" in p for p in rows) else "\n"
    numerals = re.escape("".join(sorted({c for p in rows for c in p if re.match(r"[^\W\d_]", c) and not c.isalpha()})))
    is_letter = re.compile(f"[^\\W\\d_{numerals}]").match
    mixed = any(bool(is_letter(a)) != bool(is_letter(b)) for p in rows for a, b in itertools.pairwise(p.lstrip(SPACE)))
    listed = [[c for c, _ in run] for k, run in itertools.groupby(((c, bool(is_letter(chr(c)))) for c in range(0x10000)), lambda x: x[1]) if k]
    ranges = "".join(f"\\u{r[0]:04x}-\\u{r[-1]:04x}" for r in listed)

    def pattern(letter: str, other: str) -> re.Pattern:
        runs = f"[^ {line}]+" if mixed else f"{letter}+|{other}+"
        return re.compile(f" +(?:{runs})?|{runs}" + ("|\n" if line else ""))

    return pattern(f"[{ranges}]", f"[^{ranges} {line}]"), pattern(f"[^\\W\\d_{numerals}]", f"(?:(?![ {line}])[\\W\\d_{numerals}])")


_beyond = re.compile("[\U00010000-\U0010ffff]").search


def words_of(text: str | None, name: str = MODEL) -> list[str]:
    """The words of a text, spaces as they are (the model's mark for them, where a text has it, is a space)."""
    if not text:
        return []
    listed, general = splitters(name)
    if text.isascii():
        return listed.findall(" " + text)
    return (general if _beyond(text) else listed).findall(" " + text.replace(SPACE, " "))


def distinct_words(docs: DataFrame, text_col: str = "text", name: str = MODEL) -> DataFrame:
    """word, n (occurrences): one row for each distinct word of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                held.update(words_of(t.as_py(), name))
            if len(held) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
                held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    return docs.select(F.col(text_col)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece_table(spark: SparkSession, name: str = MODEL) -> DataFrame:
    """The normal pieces, with spaces for the model's mark as words have them."""
    return spark.createDataFrame([(p.replace(SPACE, " "), i, x) for p, i, x in pieces(name)], "piece string, id int, score double")


def lattice(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """word, edges: array<long> of all substrings of 2 to `longest` characters that are pieces, each as start << 40 | length << 32 | id.

    words is partitioned by word, and stays so. Single characters need no edge: each is a part of its own to begin with.
    """
    size = F.length("word")
    at = words.where(size >= 2).select("word", F.explode(F.sequence(F.lit(0), size - 2)).alias("start"))
    sub = at.select("word", "start", F.explode(F.sequence(F.lit(2), F.least(F.lit(longest), size - F.col("start")))).alias("len"))
    sub = sub.select("word", "start", "len", F.col("word").substr(F.col("start") + 1, F.col("len")).alias("piece"))
    code = F.shiftleft(F.col("start").cast("long"), 40).bitwiseOR(F.shiftleft(F.col("len").cast("long"), 32)).bitwiseOR(F.col("id").cast("long"))
    return sub.join(F.broadcast(table.where(F.length("piece") >= 2).select("piece", "id")), "piece").select("word", code.alias("e")).groupBy("word").agg(F.collect_list("e").alias("edges"))


def viterbi(edges: Column, size: Column) -> Column:
    """Ids of the best path by summed score, for unigram models whose edges reach the end: a fold over edges by end, then start."""
    state = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(F.when(i == 0, F.lit(0.0)).otherwise(F.lit(float("-inf"))).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, e: Column) -> Column:
        new = F.struct((F.get(best, e["start"])["score"] + e["score"]).alias("score"), F.concat(F.get(best, e["start"])["ids"], F.array(e["id"])).alias("ids"))
        return F.transform(best, lambda x, i: F.when((i == e["end"]) & (new["score"] > x["score"]), new).otherwise(x))

    ordered = F.transform(F.sort_array(F.transform(edges, lambda e: F.struct(e["end"].alias("end"), e["start"].alias("start"), e["id"].alias("id"), e["score"].alias("score")))), lambda e: e)
    return F.get(F.aggregate(ordered, state, step), size)["ids"]


def merge_edges(word: str, spans: list[int], ids: list[int], score: list[float], single: dict[str, list[int]], as_bytes: tuple[int, ...]) -> list[int]:
    """BPE over a word's edges: parts merge along the best edge over two neighbours. spans: start << 32 | end of each edge."""
    by_span = dict(zip(spans, ids, strict=True))
    find = by_span.get
    n = len(word)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))  # by a part's start: its end, and the start of the part before
    heap = [(-score[i], a, a + 1, a + 2) for a in range(n - 1) if (i := find(a << 32 | a + 2)) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, a, b, e = pop(heap)
        if right[a] != b or right[b] != e:
            continue
        right[a], right[b] = e, -1  # b is no start any more
        if e < n:
            left[e] = a
            if (i := find(a << 32 | right[e])) is not None:
                push(heap, (-score[i], a, e, right[e]))
        if (p := left[a]) >= 0 and (i := find(p << 32 | e)) is not None:
            push(heap, (-score[i], p, a, e))
    out: list[int] = []
    at = 0
    while at < n:
        end = right[at]
        if end == at + 1:
            out += single.get(word[at]) or [as_bytes[x] for x in word[at].encode()]
        else:
            out.append(by_span[at << 32 | end])
        at = end
    return out


def decode_ids(ids: list[int], name: str = MODEL, first: bool = True) -> str:
    """The text of ids; the space that encoding put before a text goes if first."""
    table = _decoder(name)
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if first and text.startswith(" ") else text


@cache
def _decoder(name: str) -> dict[int, bytes]:
    return {i: p.encode() for p, i, _ in pieces(name)} | {i: bytes([b]) for b, i in enumerate(byte_ids(name))}


def found_edges(words: DataFrame, count: int, name: str, per_task: int) -> DataFrame:
    """words (count rows, each word once) with their edges (null: none), in tasks of per_task words."""
    longest = max(len(p) for p, _, _ in pieces(name))
    keyed = words.repartition(max(1, math.ceil(count / per_task)), "word")
    return keyed.join(lattice(keyed, piece_table(words.sparkSession, name), longest), "word", "left")


def folder(name: str) -> Callable[[pa.Array, pa.Array], Iterator[tuple[str, list[int]]]]:
    """A fold of words and edges, two columns of a batch: (word, ids) of each."""
    as_bytes = byte_ids(name)
    single = {p.replace(SPACE, " "): [i] for p, i, _ in pieces(name) if len(p) == 1}
    score = [0.0] * processor(name).get_piece_size()
    for _, i, x in pieces(name):
        score[i] = x

    def fold(words: pa.Array, edges: pa.Array) -> Iterator[tuple[str, list[int]]]:
        code = edges.flatten().to_numpy()
        start = code >> 40
        spans = (start << 32 | start + (code >> 32 & 0xFF)).tolist()
        edge = (code & 0xFFFFFFFF).tolist()
        ends = np.cumsum(edges.value_lengths().fill_null(0).to_numpy()).tolist()
        at = 0
        for word, end in zip(words.to_pylist(), ends, strict=True):
            yield word, merge_edges(word, spans[at:end], edge[at:end], score, single, as_bytes)
            at = end

    return fold


def grouping(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager:
    """A task has so many groups at most, so they fit the aggregate's hash table; its default goes over to sorting from 128 groups on."""
    return settings(spark, spark__sql__objectHashAggregate__sortBased__fallbackThreshold=str(rows))


def encode_words(docs: DataFrame, text_col: str = "text", name: str = MODEL, per_task: int = 50_000) -> DataFrame:
    """word, n, ids, pieces, digest, round_trip (decoding gives the word back): one row for each distinct word of all documents. Stored."""
    words = stored(distinct_words(docs, text_col, name), "words")
    found = found_edges(words, words.count(), name, per_task).select("word", "n", "edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folder(name)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for word, ids in fold(b.column(0), b.column(2)):
                for column, x in zip(out, (ids, len(ids), word_digest(ids), decode_ids(ids, name, first=False) == word), strict=True):
                    column.append(x)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["word", "n", "ids", "pieces", "digest", "round_trip"])

    with grouping(docs.sparkSession, 4 * per_task):
        return stored(found.mapInArrow(run, "word string, n long, ids array<int>, pieces long, digest long, round_trip boolean"), "encoded-words")


def word_digest(ids: list[int]) -> int:
    """A polynomial of the ids, mod PRIME."""
    h = len(ids)
    for i in ids:
        h = (h * 65_599 + i + 1) % PRIME
    return h


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL) -> DataFrame:
    """doc_id, ids: all ids of each document in order. Ids meet their documents by a shuffle on the word."""
    table = encode_words(docs, text_col, name)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                out: list[list] = [[], [], [], []]
                for row, doc, text in zip(b.column(0)[at : at + 64].to_pylist(), b.column(1)[at : at + 64].to_pylist(), b.column(2)[at : at + 64], strict=True):
                    ws = words_of(text.as_py(), name)
                    for column, x in zip(out, ([row] * (len(ws) + 1), [doc] * (len(ws) + 1), range(-1, len(ws)), ["", *ws]), strict=True):
                        column += x
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["row", "doc_id", "pos", "word"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(explode, "row long, doc_id long, pos long, word string")
    joined = rows.join(table.select("word", "ids"), "word", "left")
    got = joined.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("pos", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")))).alias("w"))
    return got.select("doc_id", F.flatten(F.transform("w", lambda x: x["ids"])).alias("ids"))


def decode(rows: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, text of rows with doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode_ids(x.as_py() or [], name) for x in b.column(1)], pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, hot: int = 150_000) -> DataFrame:
    """doc_id, n_words, n_pieces, ids_digest (of each word's ids and place), round_trip: the encoding without gathering ids by document.

    The most frequent words (no more than `hot` rows) meet the documents by broadcast, all others by a shuffle on the word.
    """
    spark = docs.sparkSession
    table = encode_words(docs, text_col, name)
    top = most_frequent(table, "n", hot).select("word", "pieces", "digest", "round_trip").toLocalIterator()
    rows_of = list(zip(*[tuple(r) for r in top], strict=True)) or [(), (), (), ()]
    shared = spark.sparkContext.broadcast(({w: k for k, w in enumerate(rows_of[0])}, *(np.array(x, np.int64) for x in rows_of[1:])))

    columns = ["row", "doc_id", "word", "n_words", "n", "h", "bad"]

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Known(dict):
            def __missing__(self, word: str) -> int:
                return -1

        names_, pieces_, digest_, good_ = shared.value
        known, places = Known(names_), np.ones(1, np.int64)
        for b in batches:
            whole: list[list] = [[], [], [], []]
            rare: list[list] = [[], [], []]
            for row, text in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                ws = words_of(text.as_py(), name)
                while len(places) < len(ws):
                    places = np.concatenate([places, places * pow(STEP, len(places), PRIME) % PRIME])
                at = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
                hit, miss = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
                own = at[hit]
                for column, x in zip(whole, (len(ws), pieces_[own].sum(), (digest_[own] * places[hit] % PRIME).sum() % PRIME, len(own) - good_[own].sum()), strict=True):
                    column.append(int(x))
                rare[0].append(np.full(len(miss), row))
                rare[1] += [ws[k] for k in miss.tolist()]
                rare[2].append(places[miss])
            n = len(rare[1])
            far = [np.concatenate(rare[k]) if b.num_rows else [] for k in (0, 2)]
            none, big = (lambda k, t=pa.int64(): pa.nulls(k, t)), pa.int64()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), none(b.num_rows, pa.string()), *(pa.array(x, big) for x in whole)], names=columns)
            yield pa.RecordBatch.from_arrays([pa.array(far[0], big), none(n), pa.array(rare[1], pa.string()), none(n), none(n), pa.array(far[1], big), none(n)], names=columns)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(per_document, "row long, doc_id long, word string, n_words long, n long, h long, bad long")
    rows = stored(rows, "places")
    none = F.lit(None).cast("long")
    rare = rows.where("word is not null").select("row", "word", "h").join(table.select("word", "pieces", "digest", "round_trip"), "word")
    rare = rare.select("row", none.alias("doc_id"), none.alias("n_words"), F.col("pieces").alias("n"), F.pmod(F.col("h") * F.col("digest"), F.lit(PRIME)).alias("h"), F.when(F.col("round_trip"), 0).otherwise(1).alias("bad"))
    both = rows.where("word is null").select("row", "doc_id", "n_words", "n", "h", "bad").unionByName(rare)
    got = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("n").alias("n_pieces"), F.pmod(F.sum("h"), F.lit(PRIME)).alias("ids_digest"), F.sum("bad").alias("bad"))
    return got.select("doc_id", "n_words", "n_pieces", "ids_digest", (F.col("bad") == 0).alias("round_trip"))


def to_planes(x: np.ndarray) -> bytes:
    """Numbers as all their lowest bytes, then all next ones: what is zero in all of them takes no room once compressed."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(b: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def to_varints(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all numbers, how many of each): seven bits a byte, the low ones first, the high bit where more follow."""
    n = 1 + sum((x >> 7 * k != 0).astype(np.int64) for k in range(1, 5))
    at = np.arange(5)
    raw = (x[:, None] >> 7 * at & 127 | (at < n[:, None] - 1) * 128).astype(np.uint8)
    return raw[at < n[:, None]], n


def from_varints(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    n, low = ends - starts + 1, (raw & 127).astype(np.int64)
    out = low[starts]
    for k in range(1, int(n.max(initial=1))):
        more = np.flatnonzero(n > k)
        out[more] |= low[starts[more] + k] << 7 * k
    return out


def numbered_texts(docs: DataFrame, id_col: str, text_col: str, name: str = MODEL, block: int = BLOCK) -> DataFrame:
    """Rows of two kinds. 0, each document: block, doc_id, n_words, codes (its words' numbers in the block, frequent ones low), sha (half
    of its text's). 1, each distinct word of a block: word, place. The only pass over the texts, so they needn't be the same when read again."""

    class Numbers(dict):
        def __missing__(self, word: str) -> int:
            self[word] = n = len(self)
            return n

    columns = {"block": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "codes": pa.binary(), "sha": pa.binary(), "word": pa.string(), "place": pa.int64(), "kind": pa.int32()}

    def rows(n: int, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in columns.items()], names=list(columns))

    def ended(part: int, k: int, numbers: dict[str, int], held: list[tuple[int, bytes, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if len(numbers) >> NUMBER_BITS or k >> BLOCK_BITS or part >> 63 - BLOCK_BITS - NUMBER_BITS:
            raise ValueError("too many words, blocks or partitions for a place of 63 bits")
        at = part << BLOCK_BITS | k
        count = sum(np.bincount(c, minlength=len(numbers)) for c in (np.concatenate([x[2] for x in held[i : i + 512]]) for i in range(0, len(held), 512)))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(numbers), np.int64)
        rank[order] = np.arange(len(numbers))
        for i in range(0, len(held), 512):
            some = held[i : i + 512]
            n = np.array([len(c) for _, _, c in some], np.int64)
            raw, sizes = to_varints(rank[np.concatenate([c for _, _, c in some])])
            bounds = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(n)]].tolist()
            whole = raw.tobytes()
            yield rows(len(some), block=[at] * len(some), doc_id=[d for d, _, _ in some], n_words=n, codes=[whole[x:y] for x, y in itertools.pairwise(bounds)], sha=[h for _, h, _ in some], kind=[0] * len(some))
        words, first = list(numbers), at << NUMBER_BITS
        for i in range(0, len(words), 50_000):
            some = [words[w] for w in order[i : i + 50_000].tolist()]
            yield rows(len(some), word=some, place=np.arange(first + i, first + i + len(some)), kind=[1] * len(some))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, size, numbers, held = 0, 0, 0, Numbers(), []
        for b in batches:
            for part, doc, scalar in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):  # noqa: B007
                text = scalar.as_py() or ""
                ws = words_of(text, name)
                held.append((doc, hashlib.sha256(text.encode()).digest()[:16], np.fromiter(map(numbers.__getitem__, ws), np.uint32, len(ws))))
                size += len(text)
                if size >= block:
                    yield from ended(part, k, numbers, held)
                    k, size, numbers, held = k + 1, 0, Numbers(), []
        if held:
            yield from ended(part, k, numbers, held)

    texts = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).cast("long"), F.col(text_col))
    return map_arrow(texts, run, "block long, doc_id long, n_words long, codes binary, sha binary, word string, place long, kind int")


def block_ids(places: DataFrame, name: str = MODEL, per_task: int = 50_000) -> DataFrame:
    """block, numbers (steps from one to the next), sizes, ids, compressed: the ids of the words of each block, in parts.

    places (word, place) is a stored table, dropped once it is read. Each distinct word goes through the lattice once, and takes its places
    along; what is stored is the ids and places of each, which are dealt to the blocks as they are read.
    """
    spark = places.sparkSession
    kind = "<u2" if processor(name).get_piece_size() <= 1 << 16 else "<u4"
    with grouping(spark, 8 * per_task):
        words = places.repartition(max(1, math.ceil(places.count() / (4 * per_task))), "word").groupBy("word").agg(F.collect_list("place").alias("places"))
        words = stored(words, "words", places)
    found = found_edges(words, words.count(), name, per_task).select("word", "places", "edges")

    def packed(places: list[np.ndarray], sizes: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        import zstandard

        place, n, flat = np.concatenate(places), np.concatenate(sizes), np.concatenate(ids)
        order, starts = np.argsort(place), np.cumsum(n) - n
        place, n, starts = place[order], n[order], starts[order]
        flat = flat[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ends, block = np.cumsum(n), place >> NUMBER_BITS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        out: list[list] = [[], [], [], []]
        press = zstandard.ZstdCompressor(level=3).compress
        for a, b in itertools.pairwise(cuts):
            steps = np.diff(place[a:b] & (1 << NUMBER_BITS) - 1, prepend=0)
            for column, x in zip(out, (block[a], *(press(to_varints(y)[0].tobytes()) for y in (steps, n[a:b])), press(to_planes(flat[ends[a] - n[a] : ends[b - 1]]))), strict=True):
                column.append(x)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["block", "numbers", "sizes", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folder(name)
        for b in batches:
            ids = pa.array([np.array(x, kind).tobytes() for _, x in fold(b.column(0), b.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(1), ids], names=["places", "ids"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for b in batches:
            ids = b.column(1).to_pylist()
            m = b.column(0).value_lengths().to_numpy().astype(np.int64)
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(kind).itemsize
            flat, own = np.frombuffer(b"".join(ids), kind), np.repeat(np.arange(len(ids)), m)
            sizes, starts = n[own], (np.cumsum(n) - n)[own]
            held[0].append(b.column(0).flatten().to_numpy())
            held[1].append(sizes)
            held[2].append(flat[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())])
            size += len(own) + len(held[2][-1])
            if size > 3_000_000:
                yield packed(*held)
                held, size = ([], [], []), 0
        if size:
            yield packed(*held)

    with grouping(spark, 4 * per_task):
        coded = stored(map_arrow(found, run, "places array<long>, ids binary", None), "coded-words", words)
    return map_arrow(coded, deal, "block long, numbers binary, sizes binary, ids binary", None)


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, hot: int = 150_000, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_pieces, ids (all ids in order), decoded_sha256 (of the text decoded from them), round_trip (it is the text; null is empty).

    Documents are numbers of words by block, which meet the ids of the block's words: words move once a block, not once an
    occurrence. hot is without effect: no words are broadcast any more. A block whose words are not all there is an error.
    """
    spark = docs.sparkSession
    kind = "<u2" if processor(name).get_piece_size() <= 1 << 16 else "<u4"
    with settings(spark, spark__sql__parquet__compression__codec="zstd", spark__sql__maxConcurrentOutputFileWriters="2"):  # both kinds of rows at once, unsorted
        numbered = stored(numbered_texts(docs, id_col, text_col, name, block), "numbered-texts", by="kind")
        heads, places = (numbered.where(F.col("kind") == k) for k in (0, 1))
        places = places.select("word", "place")
        places._stored_at = f"{numbered._stored_at}/kind=1"
        parts = block_ids(places, name)
    schema = pa.schema({"doc_id": pa.int64(), "n_words": pa.int64(), "n_pieces": pa.int64(), "ids": pa.list_(pa.int32()), "decoded_sha256": pa.string(), "round_trip": pa.bool_()})

    def filled(heads: pa.Table, parts: pa.Table) -> Iterator[pa.RecordBatch]:
        import zstandard

        column = lambda t, c: t.column(c).to_pylist()
        join = lambda xs, k: np.concatenate([np.empty(0, k), *xs])
        unpress = zstandard.ZstdDecompressor().decompress
        number = join([np.cumsum(from_varints(unpress(x))) for x in column(parts, "numbers")], np.int64)
        sizes = join([from_varints(unpress(x)) for x in column(parts, "sizes")], np.int64)
        flat = join([from_planes(unpress(x), kind).astype(np.int32) for x in column(parts, "ids")], np.int32)
        starts, n_of = np.zeros(len(number), np.int64), np.full(len(number), -1)
        if number.max(initial=-1) >= len(number):
            raise ValueError("the words of a block are not all there")
        starts[number], n_of[number] = np.cumsum(sizes) - sizes, sizes
        codes, n_words = column(heads, "codes"), np.array(column(heads, "n_words"), np.int64)
        docs_, shas = heads.column("doc_id").combine_chunks(), column(heads, "sha")
        until, at = np.cumsum(n_words), 0
        while at < len(codes):  # documents of 200,000 words, or one, at a time
            to = max(at + 1, int(np.searchsorted(until, until[at] - n_words[at] + 200_000, "right")))
            code = from_varints(b"".join(codes[at:to]))
            if code.max(initial=-1) >= len(number) or n_of[code].min(initial=0) < 0:
                raise ValueError("the words of a block are not all there")
            n = n_of[code]
            ends = np.cumsum(n)
            ids = flat[np.repeat(starts[code] - ends + n, n) + np.arange(n.sum())]
            bounds = np.r_[0, np.r_[0, ends][np.cumsum(n_words[at:to])]]
            own = ids.tolist()
            decoded = [hashlib.sha256(decode_ids(own[a:b], name).encode()).digest() for a, b in itertools.pairwise(bounds.tolist())]
            same = [a[:16] == b for a, b in zip(decoded, shas[at:to], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            out = [docs_.slice(at, to - at), pa.array(n_words[at:to]), pa.array(np.diff(bounds)), lists, pa.array([x.hex() for x in decoded], pa.string()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, schema=schema)
            at = to

    def fill(heads: pa.Table, parts: pa.Table) -> pa.Table:
        return pa.Table.from_batches(filled(heads, parts), schema)

    return heads.select("block", "doc_id", "n_words", "codes", "sha").groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(fill, "doc_id long, n_words long, n_pieces long, ids array<int>, decoded_sha256 string, round_trip boolean")

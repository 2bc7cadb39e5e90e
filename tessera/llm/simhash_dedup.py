"""SimHash near-duplicates over a Gray-order hierarchical index.

Distinct fingerprints are dealt into cells so that any two within ``most`` differing bits share a cell: the 64 bits are cut
into most + m blocks, and each choice of m blocks gives a table keyed by those bits (pigeonhole). Cells that hold more than
``cell`` fingerprints are cut into pairs of parts, so no task has an unbounded cell and no link is lost. In a cell the
fingerprints are sorted by Gray rank; runs of them make leaves, runs of nodes make upper nodes. A node keeps the bits that
all its members share and that no ancestor has factored out already; a search adds up the differences on its way down and
drops a whole group once they exceed ``most``. Groups that are already in the searcher's component are dropped too, so a
group of copies costs no pairs. Tasks emit spanning links only; alternating large-star and small-star steps, each written
to the shared folder, join them into components.

``near_duplicates`` links by bits alone. ``similar_documents`` links documents whose shingle sets have a Jaccard similarity of
``similarity`` or more. At 0.8 fingerprints differ in some ten bits, too many for cells of shared bits; there, cells are
bands of min-hashes of the same shingles, and the same index searches each cell within WIDE bits. What it finds is compared
by sketches of SKETCH min-hashes; if these come within SLACK of the bound, by the shingle sets themselves (32-bit hashes), so
every link is a true one. The bits there are the majority over the DISTINCT shingles, so that they follow the sets' similarity
however often a shingle is repeated. A pair of similarity 0.8 shares no band with probability 3e-6, is over WIDE bits apart with
2e-7 (sets of 100 shingles; 7e-7 at most for smaller ones, but 1.3e-5 for four shingles of five) and falls below the sketches'
bound with 3e-5; all are less for closer pairs. Equal word sequences are one node, so copies cost no cells; only documents that
share a band with another text carry their shingles.

Null and empty texts have fingerprint 0 and link like others. Repeated rows share a component. A document alone has its own id.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, maybe_broadcast, stored

FAN = 8
#: Most (query, node) pairs expanded at once.
FRONTIER = 200_000
#: Min-hashes of a sketch (a byte of each is kept), and the bands made of the first BANDS * BAND of them.
SKETCH, BANDS, BAND = 256, 32, 5
#: Differing bits within which the index searches for similar documents: 64 bits of two sets of similarity 0.8 differ in 10, standard deviation 3.
WIDE = 26
#: Four standard errors of a sketch's estimate at 0.8.
SLACK = 0.1
_seeds = np.random.default_rng(42).integers(1, 2**63, (2, SKETCH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(w: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of words, in chunks."""
    import xxhash

    n = max(1, len(w) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    whole, k = memoryview(b" ".join(w)), min(shingle, len(w)) - 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        m = min(n, at + (1 << 16))
        yield np.fromiter((digest(whole[a:b], 42) for a, b in zip(starts[at:m].tolist(), ends[at + k : m + k].tolist(), strict=True)), np.uint64, m - at)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of the word shingles; words of A-Z lower-cased."""
    w = (text or "").encode().lower().split()
    return majority(shingle_hashes(w, shingle)) if w else 0


def majority(chunks: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the hashes."""
    count, n = np.zeros(64, np.int64), 0
    for h in chunks:
        n += len(h)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def distinct(chunks: Iterable[np.ndarray]) -> list[np.ndarray]:
    """The hashes without repeats, in chunks."""
    h = np.unique(np.concatenate(list(chunks)))
    return [h[at : at + (1 << 16)] for at in range(0, len(h), 1 << 16)]


def min_hashes(chunks: Iterable[np.ndarray]) -> np.ndarray:
    """SKETCH least values of the hashes under seeded mixings."""
    out = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for h in chunks:
        for at in range(0, len(h), 1024):
            out = np.minimum(out, ((h[at : at + 1024, None] ^ _seeds[0]) * _seeds[1]).min(0))
    return out


def resemblance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches (rows of bytes), chance matches taken off."""
    return ((a == b).mean(1) - 1 / 256) / (1 - 1 / 256)


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, fp long")


def tables(most: int, rows: int) -> list[int]:
    """Masks of the tables, as signed longs. More fingerprints take more blocks: longer keys, smaller cells."""
    m = 1 if rows <= 1 << 22 else 2 if rows <= 1 << 30 else 4
    blocks = most + m
    edges = [64 * k // blocks for k in range(blocks + 1)]
    part = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    masks = [sum(part[k] for k in chosen) for chosen in itertools.combinations(range(blocks), m)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of x in Gray order: neighbours in rank differ in one bit."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least index of its group) after the links a-b."""
    while len(a):
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while (up := label[label]).tobytes() != label.tobytes():
            label = up
    return label


class GrayIndex:
    """The hierarchical index over the cells of a chunk: cell and fp sorted by (cell, Gray rank)."""

    def __init__(self, cell: np.ndarray, fp: np.ndarray):
        self.cell, self.fp, self.levels = cell, fp, []
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])  # members at the level below, from leaf members up
        every, any_, owner, n = fp, fp, cell, len(fp)
        low = np.arange(n)
        while True:
            first = start[np.searchsorted(start, np.arange(n), side="right") - 1]
            cuts = np.flatnonzero((np.arange(n) - first) % FAN == 0)
            every, any_ = np.bitwise_and.reduceat(every, cuts), np.bitwise_or.reduceat(any_, cuts)
            owner, low = owner[cuts], low[cuts]
            self.levels.append({"kids": cuts, "many": np.diff(np.r_[cuts, n]), "same": ~(every ^ any_), "bits": every, "low": low, "high": np.r_[low[1:], len(fp)]})
            n = len(cuts)
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            if len(start) == n:
                break
        self.levels.reverse()
        for level in self.levels:
            level["own"] = level["same"]
        for above, level in itertools.pairwise(self.levels):
            level["own"] = level["same"] & ~np.repeat(above["same"], above["many"])
        self.root = np.searchsorted(owner, cell)

    def label(self, label: np.ndarray) -> None:
        """Each node's component where it has one only, else -1."""
        for level in self.levels:
            a, b = np.minimum.reduceat(label, level["low"]), np.maximum.reduceat(label, level["low"])
            level["label"] = np.where(a == b, a, -1)

    def search(self, queries: np.ndarray, side: np.ndarray, label: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs (query, later member) of different labels, and of different sides where a cell has two."""
        top = self.levels[0]
        stack = [(0, queries, self.root[queries], np.bitwise_count((self.fp[queries] ^ top["bits"][self.root[queries]]) & top["own"][self.root[queries]]).astype(np.int16))]
        while stack:
            depth, q, node, differ = stack.pop()
            level = self.levels[depth]
            near = (differ <= most) & (level["high"][node] - 1 > q) & (level["label"][node] != label[q])
            q, node, differ = q[near], node[near], differ[near]
            if not len(q):
                continue
            if len(q) * FAN > FRONTIER and len(q) > 1:
                h = len(q) // 2
                stack += [(depth, q[:h], node[:h], differ[:h]), (depth, q[h:], node[h:], differ[h:])]
                continue
            many = level["many"][node]
            kid = np.repeat(level["kids"][node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            q, differ = np.repeat(q, many), np.repeat(differ, many)
            if depth + 1 < len(self.levels):
                below = self.levels[depth + 1]
                stack.append((depth + 1, q, kid, differ + np.bitwise_count((self.fp[q] ^ below["bits"][kid]) & below["own"][kid])))
                continue
            hit = (kid > q) & (label[kid] != label[q]) & ((side[q] < 0) | (side[q] != side[kid]))
            hit &= np.bitwise_count(self.fp[q] ^ self.fp[kid]) <= most
            if hit.any():
                yield q[hit], kid[hit]


def spanning(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, most: int, node: np.ndarray | None = None, alike: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, node) that connect what is within `most` bits in the cells, and alike(places, places) if given.

    side: -1, or the part in a cell of two parts. Nodes are the fingerprints themselves if not given.
    """
    order = np.lexsort((gray_rank(fp), cell))
    cell, side, fp = cell[order], side[order], fp[order]
    node = fp if node is None else node[order]

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.ones(len(a), bool) if alike is None else np.concatenate([alike(order[a[k : k + 65536]], order[b[k : k + 65536]]) for k in range(0, len(a), 65536)] or [np.empty(0, bool)])

    n = len(fp)
    label, found = np.arange(n), []

    def link(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        pair = np.unique(np.stack([label[a], label[b]], 1), axis=0, return_index=True)[1]
        a, b = a[pair], b[pair]
        found.append((node[a], node[b]))
        label = joined(label, a, b)

    for step in (1, 2, 3, 4):  # neighbours in Gray order first: dense groups join without a search
        a = np.flatnonzero((cell[step:] == cell[:-step]) & (np.bitwise_count(fp[step:] ^ fp[:-step]) <= most))
        a = a[label[a] != label[a + step]]
        if len(a := a[linked(a, a + step)]):
            link(a, a + step)
    index = GrayIndex(cell, fp)
    for at in range(0, n, 1 << 15):
        index.label(label)
        for a, b in index.search(np.arange(at, min(n, at + (1 << 15))), side, label, most):
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
            if (near := linked(a, b)).any():
                link(a[near], b[near])
    a, b = (np.concatenate([x[k] for x in found] or [np.empty(0, node.dtype)]) for k in (0, 1))
    return a, b


def links(distinct: DataFrame, rows: int, most: int = 4, cell: int = 50_000, per_task: int = 200_000) -> DataFrame:
    """a, b: spanning links among distinct fingerprints (column fp)."""
    masks = tables(most, rows)
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("v")) for k, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.v")
    heavy = keyed.groupBy("t", "v").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    heavy = stored(heavy.select("t", "v", F.ceil(F.col("n") / cell).cast("int").alias("parts")), "heavy-cells")
    n_heavy = heavy.count()
    if n_heavy:
        keyed = _in_parts(keyed.join(maybe_broadcast(heavy, n_heavy), ["t", "v"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))), "fp", "fp", "t", "v")
    else:
        keyed = keyed.select("fp", "t", "v", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("side"))
    return _search_cells(keyed, ["t", "v", "i", "j"], most, rows * len(masks), per_task)


def _in_parts(keyed: DataFrame, by: str, *columns: str) -> DataFrame:
    """keyed (with its cell's number of parts) dealt over the pairs i <= j of parts; side tells the two parts of a pair apart."""
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when((F.col("parts") == 1) | (F.col("part") == F.col("other")), -1).otherwise(F.col("part"))
    return keyed.select(*columns, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), side.alias("side"))


def _bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a binary column without nulls, where each row's begin and end), without a copy."""
    chunk = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
    data = chunk.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8), (ends - ends[0]).astype(np.int64)


def _search_cells(keyed: DataFrame, key: list[str], most: int, rows: int, per_task: int, similarity: float | None = None) -> DataFrame:
    """a, b: spanning links in the cells of keyed (key, side, fp; with similarity also node, sketch and grams)."""

    def flush(held: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(held).combine_chunks()
        held.clear()
        cols = [t.column(c).to_numpy() for c in key]
        number = np.cumsum(np.r_[False, np.any([c[1:] != c[:-1] for c in cols], axis=0)])
        node = alike = None
        if similarity is not None:
            node = t.column("node").to_numpy()
            sketches = _bytes_of(t.column("sketch"))[0].reshape(-1, SKETCH)
            grams, ends = _bytes_of(t.column("grams"))

            def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                near = resemblance(sketches[a], sketches[b]) >= similarity - SLACK
                for k in np.flatnonzero(near):
                    x, y = (grams[ends[i] : ends[i + 1]].view("<u4") for i in (a[k], b[k]))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    near[k] = both >= similarity * (len(x) + len(y) - both)
                return near

        a, b = spanning(number, t.column("side").to_numpy().astype(np.int64), t.column("fp").to_numpy().view(np.uint64), most, node, alike)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:  # sorted by key: whole cells go together
            t = pa.Table.from_batches([b])
            if n >= per_task and t.num_rows:
                last = [held[-1].column(c)[-1].as_py() for c in key]
                same = np.all([t.column(c).to_numpy() == x for c, x in zip(key, last, strict=True)], axis=0)
                if k := int(same.argmin()) if not same.all() else 0 if not same.any() else t.num_rows:
                    held.append(t.slice(0, k))
                    t = t.slice(k)
                if t.num_rows:
                    yield flush(held)
                    n = 0
            if t.num_rows:
                held.append(t)
                n += t.num_rows
        if held:
            yield flush(held)

    tasks = max(1, math.ceil(rows / per_task))
    return map_arrow(keyed.repartition(tasks, *key).sortWithinPartitions(*key), run, "a long, b long", None).where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: alternating large-star and small-star; root is the least node of the component.

    The least neighbours are written before they are joined, so that both sides of a join are plain shuffles, which AQE splits
    where one node has very many links.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "centres")
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars", least)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "centres")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = stored(small, "stars", edges, large, least)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max("v")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, most: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (least doc_id reachable over links of at most `most` differing bits)."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    rows = distinct.count()
    comps = components(links(distinct, rows, most))
    named = distinct.join(comps.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return fps.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, most: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: the one with the least id (repeated rows of it stay). Columns as they were."""
    gone = near_duplicates(docs, most, shingle, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    gone = stored(gone, "near-duplicates")
    return docs.join(maybe_broadcast(gone, gone.count()), F.col(id_col) == F.col("__gone"), "left_anti")


def sketches(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, d1 and d2 (digest of the lower-cased word sequence), fp (of the distinct shingles), sketch, bands. A text without words has no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for text in b.column(1):
                w = (text.as_py() or "").encode().lower().split()
                chunks = distinct(shingle_hashes(w, shingle)) if w else []
                least = min_hashes(chunks)
                bands = [xxhash.xxh64_intdigest(least[k * BAND : (k + 1) * BAND].tobytes(), k) - (1 << 63) for k in range(BANDS)] if w else []
                d = np.frombuffer(hashlib.md5(b" ".join(w)).digest(), "<i8").tolist()
                fp = majority(chunks) if w else 0
                for column, x in zip(out, (*d, fp - (1 << 64) if fp >> 63 else fp, (least >> np.uint64(20)).astype(np.uint8).tobytes(), bands), strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], names=["doc_id", "d1", "d2", "fp", "sketch", "bands"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)), run, "doc_id long, d1 long, d2 long, fp long, sketch binary, bands array<long>")


def gram_sets(docs: DataFrame, shingle: int, text_col: str = "text") -> DataFrame:
    """d1, d2, grams: the sorted distinct 32-bit hashes of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], []]
            for text in b.column(0):
                w = (text.as_py() or "").encode().lower().split()
                grams = np.unique(np.concatenate([h.astype("<u4") for h in shingle_hashes(w, shingle)])) if w else np.empty(0, "<u4")
                for column, x in zip(out, (*np.frombuffer(hashlib.md5(b" ".join(w)).digest(), "<i8").tolist(), grams.tobytes()), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["d1", "d2", "grams"])

    return map_arrow(docs.select(F.col(text_col)), run, "d1 long, d2 long, grams binary")


def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", cell: int = 10_000, per_task: int = 10_000) -> DataFrame:
    """doc_id, component_id: the least doc_id reachable over links of at least `similarity`. Documents of null id are passed by."""
    marks = stored(sketches(docs, shingle, id_col, text_col).where("doc_id is not null"), "sketches")
    one = ["d1", "d2"]
    nodes = stored(marks.groupBy(*one).agg(F.min("doc_id").alias("node")), "word-sequences")
    mine = marks.join(nodes, one).where("doc_id = node").dropDuplicates(one)
    mine = stored(mine.select(*one, "node", "fp", "sketch", "bands"), "sequence-sketches")
    keyed = mine.select(*one, "node", F.explode("bands").alias("v"))
    shared = keyed.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v", F.ceil(F.col("n") / cell).cast("int").alias("parts"))
    cells = stored(keyed.join(shared, "v"), "shared-bands")
    asked = stored(cells.select("node", *one).distinct(), "band-sharers")
    n_asked = asked.count()
    texts = docs.join(maybe_broadcast(asked.select(F.col("node").alias("__node")).distinct(), n_asked), F.col(id_col).cast("long") == F.col("__node"), "left_semi")
    grams = gram_sets(texts, shingle, text_col).dropDuplicates(one)
    sharers = stored(maybe_broadcast(asked.drop("node"), n_asked).join(mine.drop("bands"), one).join(grams, one), "sharers")
    members = _in_parts(cells.drop("node").join(sharers, one), "d1", "node", "fp", "sketch", "grams", "v")
    rows = cells.agg(F.sum("parts")).first()[0] or 0
    links_ = stored(_search_cells(members, ["v", "i", "j"], WIDE, rows, per_task, similarity), "similar-links", mine, cells, asked, sharers)
    named = stored(nodes.join(components(links_), "node", "left").select(*one, F.coalesce("root", "node").alias("component_id")), "named-sequences", nodes, links_)
    out = marks.select("doc_id", *one).join(named, one).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return stored(out, "similar-documents", marks, named)


def keep_first_similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component of similar_documents: the one with the least id (repeated rows of it stay). Columns as they were."""
    gone = similar_documents(docs, similarity, shingle, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(maybe_broadcast(gone, gone.count()), F.col(id_col) == F.col("__gone"), "left_anti")

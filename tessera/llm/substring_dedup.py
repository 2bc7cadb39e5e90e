"""Incremental substring dedup over a log-structured fingerprint index.

A window is ``window`` consecutive words of one document. A word goes if a window that covers it also starts in a document
with a smaller id. Every window has an anchor: of its word grams the one with the least hash (the first of equals). Equal
windows have equal anchors at equal places, so comparing windows of shared anchors loses nothing, and only about one gram
in (window - gram) / 2 is an anchor.

``FingerprintIndex`` is a folder that later jobs open again. It holds immutable runs, each bucketed and sorted by its key, and a
manifest a version that names them:

- anchors (hash, first, verified): the least document that has an anchor, and whether a second one has had it;
- wholes (d1, d2, first): the least document of each whole word sequence;
- digests (d1, d2, first): the least document of each window whose anchor was shared;
- texts (doc_id, z): the words of documents of at least a window, compressed.

``add`` takes a batch of documents with larger ids than all before. Whole copies are settled first, by one digest a document. The
batch's anchors are then merge-joined with the runs, which takes no shuffle of the runs. For anchors that two documents share,
windows are compared by 128-bit digests of their words: those of the batch's documents, and, where an anchor had one document so far,
those of this document, whose text comes from the index by a bucketed join. Where an anchor was shared before, its windows' digests
are in the index, so no old text is asked for twice. The batch's results go into new runs; where there are more than ``max_runs``,
the smaller half is merged to one.

Null and empty texts have no words; texts of fewer words than a window stay whole. Windows are judged on the input, not on
what is left. Repeated rows of one id are one document: they get the same result. Documents of null id are passed by.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .common import dropped, file_system, get, map_arrow, maybe_broadcast, names_in, put_new, scratch, settings, stored

GRAM = 16
B = 0x9E3779B97F4A7C15 | 1
B_INV = pow(B, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of B and of its inverse, mod 2^64."""
    if len(_powers[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, base in enumerate((B, B_INV)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


class Words:
    """The words of a text as one byte string joined by single spaces, with hashes of any run of words in constant time."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()
        self.n = len(words)
        self.joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, self.n)
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths

    def hashes(self, k: int) -> np.ndarray:
        """The hash of the k words from each word on."""
        size = len(self.joined)
        up, down = _power(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((np.frombuffer(self.joined, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
        a, b = self.start[: self.n - k + 1], self.end[k - 1 :]
        h = (total[b] - total[a]) * down[a]
        h ^= h >> np.uint64(31)  # orders of the hashes must not follow the text
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def anchors(self, window: int, gram: int = GRAM) -> np.ndarray:
        """The hash of the anchor of each window, as signed longs: the least of its grams'."""
        return np.lib.stride_tricks.sliding_window_view(self.hashes(gram), window - gram + 1).min(axis=1).view(np.int64)

    def digests(self, at: np.ndarray, window: int) -> np.ndarray:
        """128-bit digests of the windows that start at `at`, as pairs of longs."""
        import xxhash

        whole, take = memoryview(self.joined), xxhash.xxh3_128_digest
        raw = b"".join([take(whole[a:b]) for a, b in zip(self.start[at].tolist(), self.end[at + window - 1].tolist(), strict=True)])
        return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _arrow(docs: DataFrame, run, schema: str) -> DataFrame:
    """run(rows of a batch as lists) gives columns, one batch at a time."""
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = pa.schema([(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            columns = run(*[b.column(k) for k in range(b.num_columns)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], names=names)

    return map_arrow(docs, batches, schema)


def packed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with text_col compressed (binary): what a join by document moves is mostly text."""
    kind = StructType([StructField(f.name, BinaryType()) if f.name == text_col else f for f in docs.schema])
    at = docs.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in it:
            small = pa.array([press.compress(t.as_py().encode()) if t.is_valid else None for t in b.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([small if k == at else b.column(k) for k in range(b.num_columns)], names=b.schema.names)

    return map_arrow(docs, run, kind)


def unpacked(data: bytes | None) -> str | None:
    import zstandard

    return None if data is None else zstandard.ZstdDecompressor().decompress(data).decode()


def prepared(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, d1 and d2 (digest of the whole word sequence), z (the words, compressed), hashes (of the distinct anchors), of documents of a window or more."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = Words(text.as_py())
                if w.n >= window:
                    d = np.frombuffer(hashlib.md5(w.joined).digest(), "<i8").tolist()
                    for column, x in zip(out, (doc, *d, press.compress(w.joined), np.unique(w.anchors(window))), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["doc_id", "d1", "d2", "z", "hashes"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, d1 long, d2 long, z binary, hashes array<long>", 256)


class FingerprintIndex:
    #: Columns and bucket key of each kind of run.
    KINDS = {
        "anchors": ("hash BIGINT, first BIGINT, verified BOOLEAN", ["hash"]),
        "wholes": ("d1 BIGINT, d2 BIGINT, first BIGINT", ["d1", "d2"]),
        "digests": ("d1 BIGINT, d2 BIGINT, first BIGINT", ["d1", "d2"]),
        "texts": ("doc_id BIGINT, z BINARY", ["doc_id"]),
    }

    def __init__(self, spark: SparkSession, root: str, window: int = 50, max_runs: int = 4, buckets: int = 8):
        """window and buckets are those that an index at root was made with, if there is one."""
        self.spark, self.root, self.max_runs = spark, root.rstrip("/"), max_runs
        self._tables: dict[str, str] = {}
        versions = [n for n in names_in(spark, f"{self.root}/manifest") if n.startswith("v") and n.endswith(".json")]
        self.state = json.loads(get(spark, f"{self.root}/manifest/{versions[-1]}").decode()) if versions else {"version": 0, "window": window, "buckets": buckets, "highest": None, **{k: [] for k in self.KINDS}}
        self.window, self.buckets = self.state["window"], self.state["buckets"]

    def _commit(self, **changes) -> None:
        state = self.state | changes | {"version": self.state["version"] + 1}
        if not put_new(self.spark, f"{self.root}/manifest/v{state['version']:08d}.json", json.dumps(state).encode()):
            raise RuntimeError(f"another writer has committed version {state['version']}")
        self.state = state

    def _write(self, kind: str, rows: DataFrame) -> dict:
        """A run of a kind: one file a bucket, sorted by the key."""
        key = self.KINDS[kind][1]
        path, name = f"{self.root}/{kind}/{uuid.uuid4().hex}", f"tessera_{uuid.uuid4().hex}"
        dealt = rows.repartitionById(self.buckets, F.pmod(F.hash(*key), F.lit(self.buckets)).cast("int"))
        with settings(self.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            dealt.write.format("parquet").bucketBy(self.buckets, *key).sortBy(*key).option("path", path).saveAsTable(name)
        self._tables[path] = name
        return {"path": path, "rows": self.spark.table(name).count()}

    def _read(self, kind: str, runs: list[dict] | None = None) -> DataFrame | None:
        """The rows of runs of a kind (else of all), each still bucketed."""
        columns, key = self.KINDS[kind]
        out = None
        for run in self.state[kind] if runs is None else runs:
            if run["path"] not in self._tables:
                name = f"tessera_{uuid.uuid4().hex}"
                self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(key)}) SORTED BY ({', '.join(key)}) INTO {self.buckets} BUCKETS LOCATION '{run['path']}'")
                self._tables[run["path"]] = name
            part = self.spark.table(self._tables[run["path"]])
            out = part if out is None else out.unionAll(part)
        return self.spark.createDataFrame([], ", ".join(columns.lower().replace("bigint", "long").split(", "))) if out is None else out

    def _merged(self, kind: str, runs: list[dict] | None = None) -> DataFrame:
        """One row for each key of runs."""
        rows = self._read(kind, runs)
        if kind == "anchors":
            return rows.groupBy("hash").agg(F.min("first").alias("first"), F.max("verified").alias("verified"))
        return rows.groupBy("d1", "d2").agg(F.min("first").alias("first"))

    def compact(self, kind: str, runs: list[dict]) -> None:
        """Merges runs of a kind into one. Their files stay for whoever reads an older version."""
        paths = {r["path"] for r in runs}
        rest = [r for r in self.state[kind] if r["path"] not in paths]
        self._commit(**{kind: [*rest, self._write(kind, self._merged(kind, runs))]})

    def _windows(self, places: DataFrame, texts: DataFrame) -> DataFrame:
        """d1, d2, doc_id, pos of the windows of texts whose anchors are in places (doc_id, hashes)."""
        window = self.window

        def run(ids: pa.Array, texts: pa.Array, hashes: pa.Array) -> tuple:
            found: list[list[np.ndarray]] = [[], [], [], []]
            for doc, text, own in zip(ids.to_pylist(), texts, hashes, strict=True):
                w = Words(unpacked(text.as_py()))
                mine = np.flatnonzero(np.isin(w.anchors(window), own.values.to_numpy()))
                d = w.digests(mine, window)
                for column, x in zip(found, (d[:, 0], d[:, 1], np.full(len(mine), doc), mine), strict=True):
                    column.append(x)
            return tuple(np.concatenate(x) if x else [] for x in found)

        return _arrow(texts.join(places, "doc_id").select("doc_id", "z", "hashes"), run, "d1 long, d2 long, doc_id long, pos int")

    def add(self, docs: DataFrame) -> DataFrame:
        """docs: doc_id, text, with ids above all before. Returns doc_id, pos of every window of docs that starts in a document of smaller id too; pos -1: the whole document is a copy. Stored."""
        batch = stored(prepared(docs, self.window), "batch")
        lowest, highest = batch.agg(F.min("doc_id"), F.max("doc_id")).first()
        if lowest is None:
            dropped(batch)
            return self.spark.createDataFrame([], "doc_id long, pos int")
        if self.state["highest"] is not None and lowest <= self.state["highest"]:
            raise ValueError("ids have to be above those of the batches before")
        # whole copies
        whole = batch.groupBy("d1", "d2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        whole = stored(self._merged("wholes").join(whole, ["d1", "d2"], "right").select("d1", "d2", F.coalesce("first", "lo").alias("first"), "hi", F.col("first").isNull().alias("fresh")), "wholes")
        copies = batch.select("doc_id", "d1", "d2").join(whole.where("hi > first"), ["d1", "d2"]).where("doc_id > first").select("doc_id").distinct()
        copies = stored(copies, "whole-copies")
        n_copies = copies.count()
        rest = batch.join(maybe_broadcast(copies, n_copies), "doc_id", "left_anti")
        texts = self._write("texts", rest.select("doc_id", "z").dropDuplicates(["doc_id"]))
        # anchors that two documents share
        anchors = stored(rest.select(F.explode("hashes").alias("hash"), "doc_id"), "batch-anchors", batch)
        now = anchors.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        now = stored(self._merged("anchors").join(now, "hash", "right").select("hash", "lo", "hi", "first", F.coalesce("verified", F.lit(False)).alias("old")), "met-anchors")
        shared = now.where("lo < hi or first is not null")
        mine = anchors.join(shared.select("hash"), "hash", "left_semi").groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))
        theirs = shared.where("first is not null and not old").select(F.col("first").alias("doc_id"), "hash").groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))
        fresh = stored(self._windows(mine, self._read("texts", [texts])), "windows")
        earlier = stored(self._windows(theirs, self._read("texts")).groupBy("d1", "d2").agg(F.min("doc_id").alias("first")), "earlier-windows")
        # the least document of each window
        least = fresh.groupBy("d1", "d2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        least = self._merged("digests").withColumnRenamed("first", "old").join(least, ["d1", "d2"], "right").join(earlier, ["d1", "d2"], "left")
        least = stored(least.select("d1", "d2", F.coalesce("old", "first", "lo").alias("first"), "hi", F.col("old").isNull().alias("fresh")), "least-windows")
        hits = fresh.join(least.where("hi > first").select("d1", "d2", "first"), ["d1", "d2"]).where("doc_id > first").select("doc_id", "pos").distinct()
        out = stored(hits.unionByName(copies.select("doc_id", F.lit(-1).alias("pos"))), "hits")
        # what is new goes into runs
        verified = F.col("first").isNotNull() | (F.col("lo") < F.col("hi"))
        run = self._write("anchors", now.where("first is null or not old").select("hash", F.coalesce("first", "lo").alias("first"), verified.alias("verified")))
        wholes = self._write("wholes", whole.where("fresh").select("d1", "d2", "first"))
        digests = self._write("digests", least.where("fresh").select("d1", "d2", "first").unionByName(earlier.join(least, ["d1", "d2"], "left_anti")))
        self._commit(anchors=[*self.state["anchors"], run], wholes=[*self.state["wholes"], wholes], digests=[*self.state["digests"], digests], texts=[*self.state["texts"], texts], highest=highest)
        dropped(whole, copies, anchors, now, fresh, earlier, least)
        for kind in ("anchors", "wholes", "digests"):
            if len(self.state[kind]) > self.max_runs:
                self.compact(kind, sorted(self.state[kind], key=lambda r: r["rows"])[: len(self.state[kind]) // 2 + 1])
        return out

    def close(self, delete: bool = False) -> None:
        """Forgets the tables that stand for the runs; deletes the index if asked to."""
        for name in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables = {}
        if delete:
            fs, at = file_system(self.spark, self.root)
            fs.delete(at, True)


def repeated_windows(docs: DataFrame, window: int = 50, batches: int = 5) -> DataFrame:
    """doc_id, pos of the repeated windows (-1: a whole copy) for doc_id, text. Documents go by batches of ascending id into an index of its own."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("c")).first()["c"] or [] if batches > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    index = FingerprintIndex(spark, scratch(spark, "index"), window, buckets=max(8, math.ceil(docs.count() / 20_000)))
    hits = []
    for low, high in zip(edges, edges[1:], strict=False):
        part = docs
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        hits.append(index.add(part))
    index.close(delete=True)
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return stored(out, "repeats", *(h for h in hits if hasattr(h, "_stored_at")))


def _kept(text: str | None, copy: bool, at: list[int] | None, window: int) -> tuple[int, np.ndarray, Words]:
    """(words, mask of the words that stay, Words)"""
    w = Words(text)
    stay = np.ones(w.n, bool)
    if copy:
        stay[:] = False
    elif at:
        edge = np.zeros(w.n + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, np.asarray(at) + window, -1)
        stay = np.cumsum(edge[:-1]) == 0
    return w.n, stay, w


def _marked(docs: DataFrame, window: int, batches: int, id_col: str, text_col: str, *more: str) -> DataFrame:
    """docs, text_col compressed, with __copy and __at: what repeated_windows says of each."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    hits = repeated_windows(known, window, batches)
    runs = hits.groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set("pos").alias("__at"), (F.min("pos") < 0).alias("__copy"))
    runs = stored(runs, "removals", hits)
    return packed(docs, text_col).join(runs, F.col(id_col).cast("long") == F.col("__doc"), "left").drop("__doc")


def report(docs: DataFrame, window: int = 50, batches: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by single spaces)."""
    marked = _marked(docs.select(id_col, text_col), window, batches, id_col, text_col)

    def run(ids: pa.Array, texts: pa.Array, copies: pa.Array, places: pa.Array) -> tuple:
        out: list[list] = [[], [], [], []]
        for doc, text, copy, at in zip(ids.to_pylist(), texts, copies.to_pylist(), places, strict=True):
            n, stay, w = _kept(unpacked(text.as_py()), bool(copy), at.as_py(), window)
            words = w.joined.split() if not stay.all() else None
            kept = w.joined if words is None else b" ".join([words[k] for k in np.flatnonzero(stay)])
            for column, x in zip(out, (doc, n, int(n - stay.sum()), hashlib.sha256(kept).hexdigest()), strict=True):
                column.append(x)
        return tuple(out)

    return _arrow(marked.select(F.col(id_col).cast("long"), text_col, "__copy", "__at"), run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = 50, batches: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated words cut out of text_col; the white space around kept words stays. Documents of which nothing is left go; other columns stay."""
    marked = _marked(docs, window, batches, id_col, text_col)
    fields = marked.schema.names
    schema = StructType([StructField(f.name, StringType()) if f.name == text_col else f for f in marked.schema])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for b in it:
            texts, keep = [], []
            for text, copy, at in zip(b.column(fields.index(text_col)), b.column(fields.index("__copy")).to_pylist(), b.column(fields.index("__at")), strict=True):
                text = unpacked(text.as_py())
                if copy or at.is_valid:
                    _, stay, _ = _kept(text, bool(copy), at.as_py(), window)
                    spans = [m.span() for m in word.finditer(text)]
                    out, k = [], 0
                    while k < len(spans):
                        if stay[k]:
                            j = k
                            while j + 1 < len(spans) and stay[j + 1]:
                                j += 1
                            out.append(text[spans[k][0] : spans[j][1]])
                            k = j
                        k += 1
                    texts.append("\n".join(out))
                    keep.append(bool(out))
                else:
                    texts.append(text)
                    keep.append(True)
            columns = [pa.array(texts, pa.string()) if f.name == text_col else b.column(k) for k, f in enumerate(b.schema)]
            yield pa.RecordBatch.from_arrays(columns, names=fields).filter(pa.array(keep, pa.bool_()))

    return map_arrow(marked, run, schema).drop("__copy", "__at")

"""HDF5 recordings as a Spark data source: one partition a range of chunks, columns and row ranges chosen before anything is read.

Files as most recorders write them are understood: superblock 0 or 1, version 1 object headers, symbol-table groups, compact, contiguous
and chunked data sets (version 1 chunk index), deflate, shuffle and checksum filters; numbers, strings, compounds, arrays and variable-length
sequences. Files in the newer layout (libver="latest") raise NotImplementedError. The driver reads headers only; a task walks the
part of the chunk index that its rows need. A chunk that was never written reads as zeros.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.places import opened

#: A partition has about so many bytes of rows, in whole chunks.
PARTITION_BYTES = 64 << 20
#: Rows of one Arrow batch.
ROWS = 8192
NONE = (1 << 64) - 1

# Message numbers of object headers, and filters.
SPACE, TYPE, LAYOUT, FILTERS, CONTINUED, SYMBOLS = 1, 3, 8, 11, 16, 17
DEFLATE, SHUFFLE, CHECKSUM = 1, 2, 3


@dataclass(frozen=True)
class Kind:
    """An element's type: a numpy type of its stored bytes, and how to show it."""

    dtype: np.dtype
    name: str  # number, string, compound, array, sequence, text
    parts: tuple = ()  # (name, offset, Kind) of a compound; the Kind of an array's or a sequence's elements
    shape: tuple[int, ...] = ()

    def spark(self) -> str:
        if self.name in ("string", "text"):
            return "string"
        if self.name in ("array", "sequence"):
            kind = self.parts[0].spark()
            return f"{'array<' * max(1, len(self.shape))}{kind}{'>' * max(1, len(self.shape))}"
        if self.name == "compound":
            return f"struct<{','.join(f'`{n}`:{k.spark()}' for n, _, k in self.parts)}>"
        kind, size = self.dtype.kind, self.dtype.itemsize
        if kind == "f":
            return "double" if size == 8 else "float"
        return "decimal(20,0)" if (kind, size) == ("u", 8) else "long" if size == 8 or (kind, size) == ("u", 4) else "int"


class Bytes:
    """Little-endian reads at any place of a file."""

    def __init__(self, path: str):
        fs, at = opened(path)
        self.file = fs.open_input_file(at)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def read(self, at: int, n: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) < n:
            raise ValueError(f"the file ends before {at + n}")
        return data

    def number(self, at: int, size: int) -> int:
        return int.from_bytes(self.read(at, size), "little")


def _kind(b: bytes, at: int = 0) -> tuple[Kind, int]:
    """(type, next place) of a data type message."""
    version, cls, bits, size = b[at] >> 4, b[at] & 15, int.from_bytes(b[at + 1 : at + 4], "little"), int.from_bytes(b[at + 4 : at + 8], "little")
    p = at + 8

    def text(p: int, padded: bool) -> tuple[str, int]:
        end = b.index(0, p)
        return b[p:end].decode(), p + -(-(end + 1 - p) // 8) * 8 if padded else end + 1

    order = ">" if bits & 1 else "<"
    if cls == 0:
        return Kind(np.dtype(f"{order}{'i' if bits & 8 else 'u'}{size}"), "number"), p + 4
    if cls == 1:
        return Kind(np.dtype(f"{order}f{size}"), "number"), p + 12
    if cls == 3:
        return Kind(np.dtype(f"S{size}"), "string"), p
    if cls == 6:
        parts = []
        for _ in range(bits & 0xFFFF):
            name, p = text(p, version < 3)
            width = 4 if version < 3 else max(1, (size.bit_length() + 7) // 8)
            offset, p = int.from_bytes(b[p : p + width], "little"), p + width
            dims: tuple[int, ...] = ()
            if version == 1:
                dims = tuple(int.from_bytes(b[p + 12 + 4 * k : p + 16 + 4 * k], "little") for k in range(b[p]))
                p += 28
            kind, p = _kind(b, p)
            parts.append((name, offset, Kind(np.dtype((kind.dtype, dims)), "array", (kind,), dims) if dims else kind))
        return Kind(np.dtype({"names": [n for n, _, _ in parts], "formats": [k.dtype for *_, k in parts], "offsets": [o for _, o, _ in parts], "itemsize": size}), "compound", tuple(parts)), p
    if cls == 8:  # names for the values of an integer
        kind, p = _kind(b, p)
        for _ in range(bits & 0xFFFF):
            _, p = text(p, version < 3)
        return kind, p + (bits & 0xFFFF) * size
    if cls == 9:
        kind, p = _kind(b, p)
        return Kind(np.dtype([("n", "<u4"), ("at", "<u8"), ("k", "<u4")]), "text" if bits & 15 == 1 else "sequence", (kind,)), p
    if cls == 10:
        rank, p = b[p], p + (4 if version < 3 else 1)
        dims = tuple(int.from_bytes(b[p + 4 * k : p + 4 * k + 4], "little") for k in range(rank))
        kind, p = _kind(b, p + 4 * rank * (2 if version < 3 else 1))
        return Kind(np.dtype((kind.dtype, dims)), "array", (kind,), dims), p
    raise NotImplementedError(f"HDF5 type class {cls}")


@dataclass
class Dataset:
    file: Bytes
    shape: tuple[int, ...]
    kind: Kind
    layout: tuple  # (0, bytes), (1, place), (2, place of the index, chunk shape)
    filters: list[tuple[int, list[int]]] = field(default_factory=list)

    @property
    def step(self) -> int:
        """Rows of a chunk."""
        return self.layout[2][0] if self.layout[0] == 2 else 1

    @property
    def row_bytes(self) -> int:
        return self.kind.dtype.itemsize * math.prod(self.shape[1:])

    def chunks(self, at: int, first: int, end: int) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(offsets, place, bytes, mask of left-out filters) of the chunks with rows in [first, end): other branches of the index aren't read."""
        if at == NONE:
            return
        head, rank = self.file.read(at, 24), len(self.shape) + 1
        if head[:4] != b"TREE" or head[4] != 1:
            raise ValueError("not a chunk index")
        level, used = head[5], int.from_bytes(head[6:8], "little")
        width = 8 + 8 * rank
        node = self.file.read(at + 24, used * (width + 8) + width)
        for k in range(used):
            p = k * (width + 8)
            key = np.frombuffer(node, "<u8", rank, p + 8)
            after = int.from_bytes(node[p + width + 16 : p + width + 24], "little")  # rows of the next key
            child = int.from_bytes(node[p + width : p + width + 8], "little")
            if int(key[0]) >= end:
                return
            if level and after >= first:
                yield from self.chunks(child, first, end)
            elif not level and int(key[0]) + self.step > first:
                yield tuple(map(int, key[:-1])), child, int.from_bytes(node[p : p + 4], "little"), int.from_bytes(node[p + 4 : p + 8], "little")

    def unfiltered(self, data: bytes, mask: int) -> bytes:
        for k in reversed(range(len(self.filters))):
            number, values = self.filters[k]
            if mask >> k & 1:
                continue
            if number == DEFLATE:
                data = zlib.decompress(data)
            elif number == CHECKSUM:
                data = data[:-4]
            elif number == SHUFFLE:
                size = values[0]
                whole = len(data) // size * size
                data = np.frombuffer(data, np.uint8, whole).reshape(size, -1).T.tobytes() + data[whole:]
            else:
                raise NotImplementedError(f"HDF5 filter {number}")
        return data

    def rows(self, first: int, end: int) -> np.ndarray:
        """The stored elements of rows [first, end)."""
        shape, dtype = (end - first, *self.shape[1:]), self.kind.dtype
        base, inner = (dtype.base, dtype.shape) if dtype.shape else (dtype, ())
        if self.layout[0] == 0:
            return np.frombuffer(self.layout[1], dtype, math.prod(self.shape)).reshape(*self.shape, *inner)[first:end]
        if self.layout[0] == 1:
            if self.layout[1] == NONE:
                return np.zeros((*shape, *inner), base)
            return np.frombuffer(self.file.read(self.layout[1] + first * self.row_bytes, (end - first) * self.row_bytes), dtype).reshape(*shape, *inner)
        out = np.zeros((*shape, *inner), base)
        chunk = self.layout[2]
        for offsets, at, size, mask in self.chunks(self.layout[1], first, end):
            block = np.frombuffer(self.unfiltered(self.file.read(at, size), mask), dtype, math.prod(chunk)).reshape(*chunk, *inner)
            a, b = max(first, offsets[0]), min(end, offsets[0] + chunk[0])
            there = [slice(a - first, b - first), *(slice(o, min(o + c, n)) for o, c, n in zip(offsets[1:], chunk[1:], self.shape[1:], strict=True))]
            here = [slice(a - offsets[0], b - offsets[0]), *(slice(0, s.stop - s.start) for s in there[1:])]
            out[tuple(there)] = block[tuple(here)]
        return out


class Shown:
    """Stored elements as Python values; sequences come from the file's heaps, of which the last one is kept."""

    def __init__(self, file: Bytes):
        self.file, self.at, self.heap = file, -1, {}

    def element(self, at: int, k: int) -> bytes:
        if at != self.at:
            size = self.file.number(at + 8, 8)
            b, p, self.heap = self.file.read(at, size), 16, {}
            while p + 16 <= size and (number := int.from_bytes(b[p : p + 2], "little")):
                n = int.from_bytes(b[p + 8 : p + 16], "little")
                self.heap[number], p = b[p + 16 : p + 16 + n], p + 16 + -(-n // 8) * 8
            self.at = at
        return self.heap[k]

    def values(self, a: np.ndarray, kind: Kind) -> list:
        if kind.name == "number":
            return a.tolist()
        if a.ndim > 1 and not kind.shape or a.ndim > 1 + len(kind.shape):
            return [self.values(x, kind) for x in a]
        if kind.name == "string":
            return [x.rstrip(b"\0").decode(errors="replace") for x in a.tolist()]
        if kind.name == "compound":
            return [dict(zip((n for n, *_ in kind.parts), row, strict=True)) for row in zip(*(self.values(a[n], k) for n, _, k in kind.parts), strict=True)]
        if kind.name == "array":
            return a.tolist() if kind.parts[0].name == "number" else [self.values(x, kind.parts[0]) for x in a]
        out = []
        for n, at, k in a.tolist():
            data = self.element(at, k) if n else b""
            if kind.name == "text":
                out.append(data[:n].rstrip(b"\0").decode(errors="replace"))
            else:
                out.append(self.values(np.frombuffer(data, kind.parts[0].dtype, n), kind.parts[0]))
        return out


class File:
    """Groups and data sets by path."""

    def __init__(self, file: Bytes):
        self.file = file
        for start in (0, 512, 1024, 2048, 4096):
            if file.read(start, 8) == b"\x89HDF\r\n\x1a\n":
                break
        else:
            raise ValueError("not an HDF5 file")
        version = file.number(start + 8, 1)
        if version > 1 or file.number(start + 13, 1) != 8 or file.number(start + 14, 1) != 8:
            raise NotImplementedError(f"HDF5 superblock version {version}")
        self.root = file.number(start + 24 + 4 * version + 32 + 8, 8)

    def messages(self, at: int) -> dict[int, bytes]:
        head = self.file.read(at, 16)
        if head[0] != 1:
            raise NotImplementedError("HDF5 object headers of version 2")
        blocks, out = [(at + 16, int.from_bytes(head[8:12], "little"))], {}
        while blocks:
            start, size = blocks.pop(0)
            b, p = self.file.read(start, size), 0
            while p + 8 <= size:
                number, n = int.from_bytes(b[p : p + 2], "little"), int.from_bytes(b[p + 2 : p + 4], "little")
                data, p = b[p + 8 : p + 8 + n], p + 8 + n
                if number == CONTINUED:
                    blocks.append((int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")))
                elif number:
                    out.setdefault(number, data)
        return out

    def members(self, symbols: bytes) -> dict[str, int]:
        """name -> place of the object header, of a group."""
        names = self.file.number(int.from_bytes(symbols[8:16], "little") + 24, 8)

        def node(at: int) -> Iterator[tuple[str, int]]:
            head = self.file.read(at, 8)
            if head[:4] == b"TREE":
                used = int.from_bytes(head[6:8], "little")
                body = self.file.read(at + 24, 16 * used + 8)
                for k in range(used):
                    yield from node(int.from_bytes(body[16 * k + 8 : 16 * k + 16], "little"))
            else:
                for k in range(int.from_bytes(head[6:8], "little")):
                    name, to = np.frombuffer(self.file.read(at + 8 + 40 * k, 16), "<u8").tolist()
                    text = b""
                    while b"\0" not in text:
                        text += self.file.read(names + name + len(text), 8)
                    yield text.partition(b"\0")[0].decode(), to

        return dict(node(int.from_bytes(symbols[:8], "little")))

    def find(self, path: str) -> dict[str, Dataset]:
        """The data set at a path under its last name, or those of the group there."""
        at, last = self.root, ""
        for part in filter(None, path.split("/")):
            symbols = self.messages(at).get(SYMBOLS)
            inside = self.members(symbols) if symbols else {}
            if part not in inside:
                raise ValueError(f"{path}: no {part} among {sorted(inside)}")
            at, last = inside[part], part
        m = self.messages(at)
        if SYMBOLS not in m:
            return {last: self.dataset(m)}
        each = {n: self.messages(a) for n, a in sorted(self.members(m[SYMBOLS]).items())}
        return {n: self.dataset(x) for n, x in each.items() if LAYOUT in x}

    def dataset(self, m: dict[int, bytes]) -> Dataset:
        space, layout = m[SPACE], m[LAYOUT]
        at = 8 if space[0] == 1 else 4
        shape = tuple(np.frombuffer(space, "<u8", space[1], at).tolist())
        if layout[0] != 3:
            raise NotImplementedError(f"HDF5 layout version {layout[0]}")
        if layout[1] == 0:
            how: tuple = (0, layout[4 : 4 + int.from_bytes(layout[2:4], "little")])
        elif layout[1] == 1:
            how = (1, int.from_bytes(layout[2:10], "little"))
        else:
            how = (2, int.from_bytes(layout[3:11], "little"), tuple(np.frombuffer(layout, "<u4", layout[2] - 1, 11).tolist()))
        return Dataset(self.file, shape, _kind(m[TYPE])[0], how, self.pipeline(m[FILTERS]) if FILTERS in m else [])

    @staticmethod
    def pipeline(b: bytes) -> list[tuple[int, list[int]]]:
        out, p = [], 8 if b[0] == 1 else 2
        for _ in range(b[1]):
            number = int.from_bytes(b[p : p + 2], "little")
            named = b[0] == 1 or number >= 256
            name = int.from_bytes(b[p + 2 : p + 4], "little") if named else 0
            p += 4 if named else 2
            n = int.from_bytes(b[p + 2 : p + 4], "little")
            p += 4 + (-(-name // 8) * 8 if b[0] == 1 else name)
            out.append((number, np.frombuffer(b, "<u4", n, p).tolist()))
            p += 4 * n + (4 if b[0] == 1 and n % 2 else 0)
        return out


@dataclass
class Rows(InputPartition):
    file: str
    first: int
    end: int


class Source(DataSource):
    """Options: path (a file, or a folder of .h5 and .hdf5 files), dataset (path of a data set, or of a group of equally long ones), columns
    (comma-joined; all by default), first and end (rows). Columns: file, no (row, from 0), and value, a compound's fields or a group's data sets."""

    @classmethod
    def name(cls) -> str:
        return "tessera_hdf5"

    @cached_property
    def files(self) -> list[str]:
        path = self.options["path"]
        fs, at = opened(path)
        found = fs.get_file_info(pafs.FileSelector(at, recursive=True)) if fs.get_file_info(at).type == pafs.FileType.Directory else [fs.get_file_info(at)]
        prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
        names = sorted(f.path for f in found if f.type == pafs.FileType.File and (len(found) == 1 or f.path.lower().endswith((".h5", ".hdf5"))))
        if not names:
            raise ValueError(f"{path}: no HDF5 file")
        return [prefix + n for n in names]

    def schema(self) -> str:
        with Bytes(self.files[0]) as b:
            kinds = columns(File(b).find(self.options.get("dataset", "")), self.wanted())
        return ", ".join(["file string", "no long", *(f"`{n}` {kind}" for n, kind, *_ in kinds)])

    def wanted(self) -> list[str] | None:
        return [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else None

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.files, self.options.get("dataset", ""), self.wanted(), int(self.options.get("first", 0)), int(self.options.get("end", 1 << 62)), int(self.options.get("partitionbytes", self.options.get("partitionBytes", PARTITION_BYTES))), schema)


def columns(found: dict[str, Dataset], wanted: Sequence[str] | None) -> list[tuple[str, str, str, str | None]]:
    """(name, Spark type, data set, field) of the columns that a data set or a group gives."""
    out = []
    for name, d in found.items():
        nest = max(0, len(d.shape) - 1)
        deep = lambda kind, nest=nest: f"{'array<' * nest}{kind}{'>' * nest}"
        if d.kind.name == "compound" and len(found) == 1 and not nest:
            out += [(n, k.spark(), name, n) for n, _, k in d.kind.parts]
        else:
            out.append((name if len(found) > 1 else "value", deep(d.kind.spark()), name, None))
    if wanted is not None:
        if missing := set(wanted) - {c[0] for c in out}:
            raise ValueError(f"no columns {sorted(missing)} among {[c[0] for c in out]}")
        out = [c for c in out if c[0] in wanted]
    return out


class Reader(DataSourceReader):
    def __init__(self, files: list[str], dataset: str, wanted: list[str] | None, first: int, end: int, partition_bytes: int, schema):
        self.files, self.dataset, self.wanted, self.first, self.end, self.partition_bytes, self.spark_schema = files, dataset, wanted, first, end, partition_bytes, schema

    def chosen(self, b: Bytes) -> tuple[dict[str, Dataset], list[tuple[str, str, str, str | None]]]:
        found = File(b).find(self.dataset)
        picked = columns(found, self.wanted)
        return {n: d for n, d in found.items() if n in {c[2] for c in picked}}, picked

    def partitions(self) -> list[Rows]:
        out = []
        for file in self.files:
            with Bytes(file) as b:
                sets, _ = self.chosen(b)
            lengths = {d.shape[0] if d.shape else 1 for d in sets.values()}
            if len(lengths) != 1:
                raise ValueError(f"{file}: data sets of {sorted(lengths)} rows")
            chunk = max(d.step for d in sets.values())
            rows = max(1, self.partition_bytes // max(1, sum(d.row_bytes for d in sets.values())) // chunk) * chunk
            end, at = min(self.end, lengths.pop()), self.first
            while at < end:
                to = min(end, (at // rows + 1) * rows)  # partitions end where chunks end
                out.append(Rows(file, at, to))
                at = to
        return out

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if part is None:
            return
        schema = to_arrow_schema(self.spark_schema)
        with Bytes(part.file) as b:
            sets, picked = self.chosen(b)
            shown = {n: Shown(b) for n in sets}
            step = max([ROWS, *(d.step for d in sets.values())]) if max(d.row_bytes for d in sets.values()) < 4096 else max(1, *(d.step for d in sets.values()))
            for at in range(part.first, part.end, step):
                to = min(part.end, at + step)
                stored = {n: d.rows(at, to) if d.shape else np.atleast_1d(Dataset.rows(Dataset(b, (1,), d.kind, d.layout), 0, 1)) for n, d in sets.items()}
                kinds = {(n, p): k for n, d in sets.items() for p, _, k in (d.kind.parts if d.kind.name == "compound" else ())}
                values = [shown[n].values(stored[n], sets[n].kind) if f is None else shown[n].values(stored[n][f], kinds[n, f]) for _, _, n, f in picked]
                yield pa.RecordBatch.from_arrays([pa.array([part.file] * (to - at)), pa.array(range(at, to), pa.int64()), *(pa.array(v, schema.field(c[0]).type) for v, c in zip(values, picked, strict=True))], schema=schema)


def table(spark: SparkSession, path: str, dataset: str = "", columns: list[str] | None = None, first: int = 0, end: int | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """file, no and the columns of a data set or group (`Source`)."""
    spark.dataSource.register(Source)
    options = {"path": path, "dataset": dataset, "first": first, "partitionBytes": partition_bytes} | ({"columns": ",".join(columns)} if columns else {}) | ({"end": end} if end is not None else {})
    return spark.read.format("tessera_hdf5").options(**options).load()


def camera_times(spark: SparkSession, path: str) -> DataFrame:
    """file, no, t (zoneless timestamp, UTC) of a camera file's `timestamp`, seconds (double, to the microsecond) or nanoseconds (long), by time."""
    from tessera.functions import timeparse

    rows = table(spark, path, "timestamp")
    whole = dict(rows.dtypes)["value"] != "double"
    us: Column = timeparse.epoch_to_micros(F.col("value")) if whole else F.round(F.col("value") * 1e6).cast("long")
    return rows.select("file", "no", timeparse.from_micros(us).alias("t")).sort("file", "t")


def cloud_frames(spark: SparkSession, path: str, time: str = "t_recv_ns") -> DataFrame:
    """file, frame, t (as stored), x, y, z, intensity: the points of each frame of a LiDAR container; frame i owns frame_count[i] rows of points from frame_start[i]."""
    frames = table(spark, path, "frames", [time, "frame_start", "frame_count"]).where("frame_count > 0")
    # each point takes its frame from the last start at or before it: no range join
    starts = frames.select("file", F.col("frame_start").cast("long").alias("at"), F.lit(0).alias("kind"), F.struct(F.col("no").alias("frame"), F.col(time).alias("t"), (F.col("frame_start") + F.col("frame_count")).alias("end")).alias("f"), F.lit(None).cast("array<double>").alias("p"))
    points = table(spark, path, "points").select("file", F.col("no").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(starts.schema["f"].dataType).alias("f"), F.col("value").cast("array<double>").alias("p"))
    from pyspark.sql import Window

    block = 1 << 20  # rows of points that one task sees together
    # a frame is asked for in every block that it reaches
    asked = starts.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("f.end") - 1) / block))))
    rows = asked.unionByName(points.withColumn("block", F.floor(F.col("at") / block)))
    owner = F.last("f", ignorenulls=True).over(Window.partitionBy("file", "block").orderBy("at", "kind"))
    rows = rows.withColumn("f", owner).where((F.col("kind") == 1) & (F.col("at") < F.col("f.end")))
    return rows.select("file", "f.frame", "f.t", *[F.get("p", F.lit(k)).alias(c) for k, c in enumerate(("x", "y", "z", "intensity"))])

"""Binary recordings: XDF streams, event-camera RAW files (EVT 2 and EVT 3), images.

Event-camera files are decoded in parts of bounded size, XDF files whole, one a task; rows leave in batches of bounded size. A truncated
end ends a file.
"""

from __future__ import annotations

import dataclasses
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.places import opened

ROWS = 65_536
#: Numpy types of XDF channel formats.
XDF_TYPES = {"float32": "<f4", "double64": "<f8", "int8": "<i1", "int16": "<i2", "int32": "<i4", "int64": "<i8"}
#: Shares of red, green and blue in a grey value.
GREY = (0.299, 0.587, 0.114)


def _binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")


def _variable(data: bytes, at: int) -> tuple[int, int]:
    """(value, next place) of a length that is stored in 1, 4 or 8 bytes."""
    size = data[at]
    return int.from_bytes(data[at + 1 : at + 1 + size], "little"), at + 1 + size


def xdf_streams(data: bytes) -> dict[int, dict]:
    """stream id -> name, rate, times (as recorded), values, offsets (collection time, offset) of numeric streams."""
    if data[:4] != b"XDF:":
        raise ValueError("not an XDF file")
    streams: dict[int, dict] = {}
    at = 4
    while at + 2 <= len(data):
        size, at = _variable(data, at)
        if at + size > len(data) or size < 2:
            break
        (tag,) = struct.unpack_from("<H", data, at)
        body, at = data[at + 2 : at + size], at + size
        if tag == 2:
            (sid,) = struct.unpack_from("<I", body)
            head = ElementTree.fromstring(body[4:].decode())
            kind = head.findtext("channel_format")
            streams[sid] = {"name": head.findtext("name") or "", "rate": float(head.findtext("nominal_srate") or 0), "channels": int(head.findtext("channel_count") or 0), "type": XDF_TYPES.get(kind), "times": [], "values": [], "offsets": []}
        elif tag == 3:
            (sid,) = struct.unpack_from("<I", body)
            s = streams[sid]
            if s["type"] is None:  # strings hold no signal
                continue
            n, p = _variable(body, 4)
            width = np.dtype(s["type"]).itemsize * s["channels"]
            for _ in range(n):
                stamped = body[p]
                p += 1
                if stamped:
                    t = struct.unpack_from("<d", body, p)[0]
                    p += 8
                else:
                    t = (s["times"][-1] if s["times"] else 0.0) + (1 / s["rate"] if s["rate"] else 0.0)
                s["times"].append(t)
                s["values"].append(np.frombuffer(body, s["type"], s["channels"], p).astype(float))
                p += width
        elif tag == 4:
            sid, when, offset = struct.unpack_from("<Idd", body)
            streams[sid]["offsets"].append((when, offset))
    return streams


def clock_synchronised(times: np.ndarray, offsets: list[tuple[float, float]]) -> np.ndarray:
    """times moved by the line fitted through the clock offsets (by their mean if there is one only)."""
    if not offsets:
        return times
    when, offset = np.array(offsets).T
    if len(when) < 2 or np.ptp(when) == 0:
        return times + offset.mean()
    slope, base = np.polyfit(when - when[0], offset, 1)
    return times + base + slope * (times - when[0])


def without_jitter(times: np.ndarray, rate: float, gap_seconds: float = 1.0, gap_samples: int = 500) -> np.ndarray:
    """times of regular streams laid on a line, segment by segment; a gap is longer than both limits."""
    if not rate or len(times) < 2:
        return times
    step = np.diff(times)
    cuts = np.flatnonzero((np.abs(step) > gap_seconds) & (np.abs(step) > gap_samples / rate)) + 1
    out = times.copy()
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(times)], strict=True):
        if b - a > 1:
            k = np.arange(b - a)
            out[a:b] = np.polyval(np.polyfit(k, times[a:b] - times[a], 1), k) + times[a]
    return out


def xdf(spark: SparkSession, path: str, stream: str | None = None) -> DataFrame:
    """file, stream_id, stream, no, t, channels (array) of the samples of numeric streams; stream picks one by its exact name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, data in zip(b["path"], b["content"], strict=True):
                for sid, s in xdf_streams(data).items():
                    if stream is not None and s["name"] != stream:
                        continue
                    t = without_jitter(clock_synchronised(np.array(s["times"], float), s["offsets"]), s["rate"])
                    for k in range(0, len(t), ROWS):
                        m = min(len(t), k + ROWS)
                        yield pd.DataFrame({"file": file, "stream_id": sid, "stream": s["name"], "no": np.arange(k, m), "t": t[k:m], "channels": [v.tolist() for v in s["values"][k:m]]})

    return _binary(spark, path, "*.xdf").mapInPandas(run, "file string, stream_id long, stream string, no long, t double, channels array<double>")


def armband_rows(samples: DataFrame) -> DataFrame:
    """Armband columns of xdf() samples whose channels are board time, eight EMG, three accelerometer and three gyroscope channels (in that order)."""
    names = ["board_ts", *(f"emg{k}" for k in range(1, 9)), *(f"{s}_{a}" for s in ("acc", "gyro") for a in "xyz")]
    return samples.select("file", "stream", "no", "t", *[F.get("channels", F.lit(k)).alias(n) for k, n in enumerate(names)])


def _last(hit: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value at the last hit up to each place; 0 before the first."""
    at = np.maximum.accumulate(np.where(hit, np.arange(len(hit)), -1))
    return np.where(at >= 0, value[at], 0)


def _unwrapped(high: np.ndarray, bits: int) -> np.ndarray:
    """Counter values with wrap-arounds (falls by over half of the range) added up."""
    return high + (np.cumsum(np.diff(high, prepend=high[:1]) < -(1 << (bits - 1))) << bits)


@dataclass(frozen=True)
class State:
    """What an event stream carries from word to word: whether a time mark was seen, the upper time as recorded and how often it began anew, the
    lower time, y, and the place and sign that the next vector begins with (EVT 3)."""

    seen: bool = False
    high: int = 0
    wraps: int = 0
    low: int = 0
    y: int = 0
    x: int = 0
    sign: int = 0


def evt2(data: bytes, state: State = State()) -> tuple[tuple[np.ndarray, ...], State]:
    """(t (microseconds), x, y, p), state at the end, of 32-bit words: 4 bits of type, then 6 of time, 11 of x, 11 of y; type 8 has the upper 28 bits of time."""
    w = np.frombuffer(data, "<u4", len(data) // 4).astype(np.int64)
    kind = w >> 28
    mark = kind == 8
    highs = _unwrapped(np.r_[[state.high] if state.seen else np.zeros(0, np.int64), w[mark] & 0xFFFFFFF].astype(np.int64), 28)
    high = np.full(len(w), state.high, np.int64)
    high[mark] = highs[len(highs) - mark.sum() :]
    at = np.cumsum(mark)
    event = (kind <= 1) & ((at > 0) | state.seen)
    t = (np.where(at > 0, _last(mark, high), state.high) + (state.wraps << 28) << 6) | (w >> 22 & 63)
    end = State(bool(state.seen or mark.any()), int(highs[-1] & 0xFFFFFFF) if len(highs) else 0, state.wraps + (int(highs[-1] >> 28) if len(highs) else 0))
    return (t[event], (w >> 11 & 2047)[event], (w & 2047)[event], kind[event]), end


def evt3(data: bytes, state: State = State()) -> tuple[tuple[np.ndarray, ...], State]:
    """(t (microseconds), x, y, p), state at the end, of 16-bit words whose upper 4 bits tell the kind: 0 y, 2 one event, 3 the base of vectors, 4 and 5 vectors of 12 and 8 events, 6 and 8 the lower and upper 12 bits of time."""
    w = np.frombuffer(data, "<u2", len(data) // 2).astype(np.int64)
    kind, low12 = w >> 12, w & 4095
    mark = kind == 8
    highs = _unwrapped(np.r_[[state.high] if state.seen else np.zeros(0, np.int64), low12[mark]].astype(np.int64), 12)
    high = np.zeros(len(w), np.int64)
    high[mark] = highs[len(highs) - mark.sum() :]
    last = lambda hit, value, before: np.where(np.cumsum(hit) > 0, _last(hit, value), before)
    t = (last(mark, high, state.high) + (state.wraps << 12) << 12) | last(kind == 6, low12, state.low)
    y = last(kind == 0, low12 & 2047, state.y)
    width = np.where(kind == 4, 12, np.where(kind == 5, 8, 0))
    before = np.cumsum(width) - width
    base = kind == 3
    first = last(base, low12 & 2047, state.x) + before - _last(base, before)
    signs = last(base, low12 >> 11, state.sign)
    sign = np.where(kind == 2, low12 >> 11, signs)
    bits = np.where(kind == 4, low12, np.where(kind == 5, low12 & 255, (kind == 2).astype(np.int64)))
    if not state.seen:
        bits[np.cumsum(mark) == 0] = 0
    place, bit = np.nonzero(bits[:, None] >> np.arange(12) & 1)
    x = np.where(kind[place] == 2, low12[place] & 2047, first[place] + bit)
    if not len(w):
        return (t, x, y, sign), state
    lows = last(kind == 6, low12, state.low)
    end = State(bool(state.seen or mark.any()), int(highs[-1] & 4095) if len(highs) else 0, state.wraps + (int(highs[-1] >> 12) if len(highs) else 0), int(lows[-1]), int(y[-1]), int(first[-1] + width[-1]), int(signs[-1]))
    return (t[place], x, y[place], sign[place]), end


def event_format(head: bytes) -> tuple[str, int]:
    """(format, place of the first word) of a RAW file: the header is lines that start with %."""
    at, text = 0, ""
    while head[at : at + 1] == b"%":
        end = head.find(b"\n", at)
        end = len(head) if end < 0 else end + 1
        line = head[at:end].decode("latin-1").strip().lower()
        text, at = f"{text}\n{line}", end
        if line == "% end":
            break
    for name, marks in {"evt3": ("evt 3.0", "format evt3"), "evt2": ("evt 2.0", "format evt2")}.items():
        if any(m in text for m in marks) and "evt21" not in text:
            return name, at
    raise ValueError("not an EVT 2 or EVT 3 file")


def part_of_file(path: str, at: int, n: int) -> bytes:
    """Bytes of a file anywhere that pyarrow opens, from a place on; fewer where it ends."""
    fs, name = opened(path)
    with fs.open_input_file(name) as f:
        return f.read_at(n, at) if at < f.size() else b""


def splits(spark: SparkSession, path: str, pattern: str, size: int) -> DataFrame:
    """file, length, split, at: the places where parts of `size` bytes begin; nothing is read but the listing."""
    from tessera.sources.files import listing

    files = listing(spark, path, pattern).where("length > 0").select(F.col("path").alias("file"), "length")
    rows = files.select("file", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))).alias("split")).withColumn("at", F.col("split").cast("long") * size)
    return rows.repartition(F.xxhash64("file", "split"))


HEAD = 65_536
STATE = "seen boolean, high long, wraps long, low long, y long, x long, sign long"


def event_raw(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """file, no, t (microseconds), x, y, p of event-camera .raw files of any size. Events before the first time mark are left out.

    A file is decoded in parts of split_bytes at once. Each part first says what state it leaves behind, for itself and as far as it depends on
    the part before; these few numbers go by in order, file by file, and each part is decoded from the state that it begins with.
    """
    size = max(4, split_bytes // 4 * 4)
    parts = splits(spark, path, "*.raw", size)

    def words(file: str, at: int) -> tuple[str, bytes]:
        name, begin = event_format(part_of_file(file, 0, HEAD))
        # words are counted from the end of the header, so parts of a file never share one
        return name, part_of_file(file, begin + at, size)

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, split, at in zip(b["file"], b["split"], b["at"], strict=True):
                name, data = words(file, at)
                decode = evt3 if name == "evt3" else evt2
                # marks as if they stood alone; what a part takes over from before it shows where it was given other values
                _, alone = decode(data)
                (t, *_), after = decode(data, State(True, 0, 0, 0, 0, 0, 0))
                _, other = decode(data, State(True, 0, 0, 1, 1, 1, 1))
                mark = np.frombuffer(data, "<u2" if name == "evt3" else "<u4", len(data) // (2 if name == "evt3" else 4)).astype(np.int64)
                shift, bits = (12, 4095) if name == "evt3" else (28, 0xFFFFFFF)
                marks = mark[mark >> shift == 8] & bits
                yield pd.DataFrame({
                    "file": [file], "split": [split], "name": [name], "marks": [len(marks)], "first": [int(marks[0]) if len(marks) else 0], "last": [alone.high], "wraps": [alone.wraps],
                    "n_all": [len(t)], "n_alone": [len(decode(data)[0][0])], "low": [after.low if after.low == other.low else -1], "y": [after.y if after.y == other.y else -1],
                    "x": [after.x], "x_own": [after.x == other.x], "sign": [after.sign if after.sign == other.sign else -1],
                })

    kinds = "file string, split int, name string, marks long, first long, last long, wraps long, n_all long, n_alone long, low long, y long, x long, x_own boolean, sign long"

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        state, no, out = State(), 0, []
        for r in pdf.sort_values("split").itertuples():
            out.append((r.file, r.split, no, *dataclasses.astuple(state)))
            no += r.n_all if state.seen else r.n_alone
            half = 1 << ((12 if r.name == "evt3" else 28) - 1)
            wraps = state.wraps + r.wraps + int(bool(r.marks) and state.seen and state.high - r.first > half)
            state = State(state.seen or bool(r.marks), r.last if r.marks else state.high, wraps, state.low if r.low < 0 else r.low, state.y if r.y < 0 else r.y, r.x if r.x_own else state.x + r.x, state.sign if r.sign < 0 else r.sign)
        return pd.DataFrame(out, columns=["file", "split", "no", "seen", "high", "wraps", "low", "y", "x", "sign"])

    begins = parts.mapInPandas(left, kinds).groupBy("file").applyInPandas(chained, f"file string, split int, no long, {STATE}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                name, data = words(r.file, r.split * size)
                (t, x, y, p), _ = (evt3 if name == "evt3" else evt2)(data, State(bool(r.seen), r.high, r.wraps, r.low, r.y, r.x, r.sign))
                for k in range(0, len(t), ROWS):
                    m = k + ROWS
                    yield pd.DataFrame({"file": r.file, "no": r.no + np.arange(k, min(len(t), m)), "t": t[k:m], "x": x[k:m], "y": y[k:m], "p": p[k:m]})

    return begins.repartition(F.xxhash64("file", "split")).mapInPandas(run, "file string, no long, t long, x int, y int, p int")


def grey_images(spark: SparkSession, path: str) -> DataFrame:
    """file, height, width, pixels (grey values, row by row) of the images that Spark's image source decodes; others are left out."""
    raw = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for data, channels in zip(b["data"], b["nChannels"], strict=True):
                a = np.frombuffer(data, np.uint8).reshape(-1, channels).astype(float)
                out.append((a[:, 0] if channels < 3 else np.rint(a[:, 2::-1] @ GREY)).tolist())
            yield pd.DataFrame({"file": b["origin"], "height": b["height"], "width": b["width"], "pixels": out})

    return raw.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(run, "file string, height int, width int, pixels array<double>")


def frame_differences(frames: DataFrame, keys: list[str], order: str, pixels: str = "pixels") -> DataFrame:
    """frames with motion: the mean absolute difference from the frame before (null for the first and where sizes differ)."""
    from pyspark.sql import Window

    before = F.lag(pixels).over(Window.partitionBy(*keys).orderBy(order))
    gap = F.aggregate(F.zip_with(pixels, "__before", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda acc, d: acc + d)
    return frames.withColumn("__before", before).withColumn("motion", F.when(F.size(pixels) == F.size("__before"), gap / F.greatest(F.size(pixels), F.lit(1)))).drop("__before")

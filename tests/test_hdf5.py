"""The HDF5 source on files written by the format's rules: layouts, filters, types, pruning, recorders' containers."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import hdf5
from tests.hdf5_files import Writer

RNG = np.random.default_rng(2)


def file_of(tmp_path, name="a.h5", **sets):
    w = Writer()
    return w.save(tmp_path / name, w.group({n: f(w) for n, f in sets.items()}))


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*(by or ("file", "no"))).drop("file").collect()]


@pytest.mark.parametrize("dtype", ["<i2", ">i4", "<u4", "<i8", "<f4", ">f8", "<u1", "<u8"])
@pytest.mark.parametrize("how", [{}, {"chunk": (7,)}, {"chunk": (7,), "deflate": True, "shuffle": True, "checksum": True}])
def test_numbers(spark, tmp_path, dtype, how):
    a = (RNG.random(100) * 200).astype(dtype)
    path = file_of(tmp_path, value=lambda w: w.dataset(a.shape, dtype, a, split=True, **how))
    assert rows(hdf5.table(spark, path, "value", partition_bytes=300)) == [(k, x) for k, x in enumerate(a.tolist())]


def test_many_dimensions_and_missing_chunks(spark, tmp_path):
    a = RNG.integers(0, 1000, (50, 9, 5)).astype("<i4")
    path = file_of(tmp_path, depth=lambda w: w.dataset(a.shape, "<i4", a, chunk=(4, 4, 5), deflate=True, skip={(8, 4, 0)}))
    want = a.copy()
    want[8:12, 4:8] = 0
    assert rows(hdf5.table(spark, path, "depth", partition_bytes=1000)) == [(k, x) for k, x in enumerate(want.tolist())]


def radar(w, n=60):
    kind = [("timestamp", "S32"), ("frame_counter", "<u4"), ("range", "<f8"), ("power", "vlen f8"), ("note", "text")]
    values = [RNG.random(k % 5) for k in range(n)]
    places = w.heap([v.tobytes() for v in values[: n // 2]]) + w.heap([v.tobytes() for v in values[n // 2 :]])
    notes = w.heap([f"note é {k}".encode() for k in range(n)])
    raw = np.zeros(n, np.dtype([("timestamp", "S32"), ("frame_counter", "<u4"), ("range", "<f8"), ("power", [("n", "<u4"), ("at", "<u8"), ("k", "<u4")]), ("note", [("n", "<u4"), ("at", "<u8"), ("k", "<u4")])]))
    want = []
    for k, v in enumerate(values):
        note = f"note é {k}"
        raw[k] = (f"{1e9 + k}".encode(), k, k / 4, (len(v), *places[k]), (len(note.encode()), *notes[k]))
        want.append((k, f"{1e9 + k}", k, k / 4, v.tolist(), note))
    return w.dataset((n,), kind, raw, chunk=(16,), deflate=True), want


def test_compound_of_sequences(spark, tmp_path):
    made = {}

    def doppler(w):
        at, made["want"] = radar(w)
        return at

    path = file_of(tmp_path, doppler=doppler)
    df = hdf5.table(spark, path, "doppler", partition_bytes=2000)
    assert dict(df.dtypes) == {"file": "string", "no": "bigint", "timestamp": "string", "frame_counter": "bigint", "range": "double", "power": "array<double>", "note": "string"}
    assert rows(df) == made["want"]
    assert rows(hdf5.table(spark, path, "doppler", ["range", "note"])) == [(k, r, t) for k, _, _, r, _, t in made["want"]]


def test_pruning(spark, tmp_path, monkeypatch):
    """Only the chosen columns' chunks of the chosen rows are read."""
    n = 4000
    a, b = np.arange(n).astype("<i8"), RNG.random((n, 16))
    path = file_of(tmp_path, a=lambda w: w.dataset((n,), "<i8", a, chunk=(100,)), b=lambda w: w.dataset((n, 16), "<f8", b, chunk=(100, 16)))
    df = hdf5.table(spark, path, "", ["a"], first=1050, end=1950, partition_bytes=1600)
    assert rows(df) == [(k, k) for k in range(1050, 1950)]
    reader = hdf5.Source({"path": path, "columns": "a", "first": "1050", "end": "1950", "partitionBytes": "1600"})
    reader = reader.reader(None)
    parts = reader.partitions()
    assert [(p.first, p.end) for p in parts] == [(1050, 1200), (1200, 1400), (1400, 1600), (1600, 1800), (1800, 1950)]
    read = []
    whole = hdf5.Bytes.read
    monkeypatch.setattr(hdf5.Bytes, "read", lambda self, at, size: (read.append(size), whole(self, at, size))[1])
    with hdf5.Bytes(path) as f:
        found, _ = reader.chosen(f)
        read.clear()
        assert found["a"].rows(1200, 1400).tolist() == list(range(1200, 1400))
    assert sum(s for s in read if s == 800) == 1600 and sum(read) < 4000  # two chunks of data and a path through the index


def test_groups_folders_and_errors(spark, tmp_path):
    for k in range(2):
        file_of(tmp_path, f"f{k}.hdf5", x=lambda w, k=k: w.dataset((3,), "<i4", np.array([k, k, k], "<i4")), y=lambda w: w.dataset((3,), "S3", np.array([b"a", b"bc", b""], "S3")))
    (tmp_path / "notes.txt").write_text("no recording")
    assert rows(hdf5.table(spark, str(tmp_path))) == [(0, 0, "a"), (1, 0, "bc"), (2, 0, ""), (0, 1, "a"), (1, 1, "bc"), (2, 1, "")]
    with pytest.raises(Exception, match="no z among"):
        hdf5.table(spark, str(tmp_path), "z").collect()
    with pytest.raises(Exception, match="no columns"):
        hdf5.table(spark, str(tmp_path), "", ["q"]).collect()
    path = file_of(tmp_path, "uneven.h5", x=lambda w: w.dataset((3,), "<i4", np.zeros(3, "<i4")), y=lambda w: w.dataset((4,), "<i4", np.zeros(4, "<i4")))
    with pytest.raises(Exception, match="rows"):
        hdf5.table(spark, path).collect()
    (tmp_path / "cut.h5").write_bytes((tmp_path / "f0.hdf5").read_bytes()[:150])
    with pytest.raises(Exception, match="ends before"):
        hdf5.table(spark, str(tmp_path / "cut.h5")).collect()
    (tmp_path / "other.h5").write_bytes(b"x" * 8000)
    with pytest.raises(Exception, match="not an HDF5 file"):
        hdf5.table(spark, str(tmp_path / "other.h5")).collect()
    assert rows(hdf5.table(spark, file_of(tmp_path, "none.h5", x=lambda w: w.dataset((0,), "<i4", np.zeros(0, "<i4"))), "x")) == []


def test_camera_times(spark, tmp_path):
    t = np.array([1_700_000_000.1234567, 1_699_999_999.5])
    seconds = file_of(tmp_path, "s.h5", timestamp=lambda w: w.dataset((2,), "<f8", t, chunk=(1,)))
    nanos = file_of(tmp_path, "n.h5", timestamp=lambda w: w.dataset((2,), "<i8", (t * 1e9).astype("<i8"), chunk=(1,)))
    want = [datetime.datetime(2023, 11, 14, 22, 13, 19, 500000), datetime.datetime(2023, 11, 14, 22, 13, 20, 123457)]
    assert [r.t for r in hdf5.camera_times(spark, seconds).collect()] == want
    got = [r.t for r in hdf5.camera_times(spark, nanos).collect()]
    assert got[0] == want[0] and abs((got[1] - want[1]).total_seconds()) < 2e-6


def test_cloud_frames(spark, tmp_path):
    counts = np.array([3, 0, 5, 1, 7])
    starts = np.cumsum(counts) - counts + np.array([0, 0, 0, 2, 2])  # two points belong to no frame
    points = RNG.random((20, 4)).astype("<f4")
    w = Writer()
    frames = w.group({"t_recv_ns": w.dataset((5,), "<i8", np.arange(5).astype("<i8") * 10), "frame_start": w.dataset((5,), "<i8", starts.astype("<i8")), "frame_count": w.dataset((5,), "<i4", counts.astype("<i4")), "frame_id": w.dataset((5,), "S4", np.array([b"v"] * 5, "S4"))})
    path = w.save(tmp_path / "lidar.h5", w.group({"frames": frames, "points": w.dataset(points.shape, "<f4", points, chunk=(6, 4), deflate=True)}))
    got = sorted(tuple(r)[1:] for r in hdf5.cloud_frames(spark, path).collect())
    assert got == sorted((f, f * 10, *map(float, points[k])) for f in range(5) for k in range(starts[f], starts[f] + counts[f]))
    assert hdf5.table(spark, path, "frames").where(F.col("frame_id") == "v").count() == 5

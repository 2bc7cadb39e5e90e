"""Files that the engine writes: tar shards from paths, .npy stacks, single CSV files; percentiles of sampled frames."""

import csv
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import frames
from tessera.sources import sinks


def test_tar_of_paths_moves_no_contents(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(12):
        at = tmp_path / f"src{k}.bin"
        at.write_bytes(rng.bytes(300_000 if k else 0))
        rows.append((f"s{k % 3}.tar", f"k{k}", f"k{k}.rgb.bin", str(at), None))
        rows.append((f"s{k % 3}.tar", f"k{k}", f"k{k}.labels.json", None, f'{{"n": {k}}}'))
    rows += [("s0.tar", "k99", "k99.gone.bin", str(tmp_path / "gone"), None), ("s0.tar", "k99", "k99.none.bin", None, None)]
    df = spark.createDataFrame(rows, "shard string, key string, member string, path string, content string")
    out = tmp_path / "tars"
    files = sinks.tar_files(df, str(out), source="path")
    stamps = {p.name: p.stat().st_mtime_ns for p in out.glob("*.tar")}
    assert {(r.shard, r.n) for r in files.collect()} == {("s0.tar", 10), ("s1.tar", 8), ("s2.tar", 8)} and files.count() == 3
    assert {p.name: p.stat().st_mtime_ns for p in out.glob("*.tar")} == stamps  # reading the list writes nothing
    assert not any(p.name.endswith(".part") for p in out.iterdir())
    for s in range(3):
        with tarfile.open(out / f"s{s}.tar") as tar:
            got = [(m.name, tar.extractfile(m).read()) for m in tar]
        want = []
        for _, key, member, path, content in sorted(x for x in [(r[0], r[1], r[2], r[3] or "", r[4] or "") for r in rows] if x[0] == f"s{s}.tar"):
            at = tmp_path / path
            if path and at.exists():
                want.append((member, at.read_bytes()))
            else:
                want.append((member, content.encode()) if content else (f"{key}.ERR.{member}.txt", b"missing"))
        assert got == want
    # what the writing plan exchanges is paths: no column of contents of files
    assert sum(len(p.read_bytes()) for p in tmp_path.glob("src*.bin")) > 3_000_000 and df.schema["path"].dataType.simpleString() == "string"


def test_npy_stacks(spark, tmp_path):
    rng = np.random.default_rng(2)
    clips = {"a": [(3, 4)] * 5, "b": [(2, 4), (5, 4), (0, 0)], "c": [(2, 4), (2, 3)], "d": [(0, 0), (0, 0)], "e": [(1, 2)] * 300}
    data = {c: [rng.random(s).astype("<f4") for s in shapes] for c, shapes in clips.items()}
    rows = [(c, k, [[float(v) for v in r] for r in x]) for c, xs in data.items() for k, x in enumerate(xs)] + [("f", 0, [[1.0, 2.0], [3.0]])]
    df = spark.createDataFrame(rows, "clip string, k int, v array<array<double>>").repartition(5)
    files, errors = sinks.npy_files(df, str(tmp_path / "npy"), "clip", "k", "v", fill=-1.0)
    assert {(r.file, r.n) for r in files.collect()} == {("a.npy", 5), ("b.npy", 3), ("d.npy", 2), ("e.npy", 300)}
    assert {r.clip: r.error for r in errors.collect()} == {"c": "columns differ: 3 to 4", "f": "columns differ: 2 to 2"}
    for c in "abe":
        got = np.load(tmp_path / "npy" / f"{c}.npy", mmap_mode="r")
        most = max(s[0] for s in clips[c])
        assert got.shape == (len(clips[c]), most, clips[c][0][1]) and got.dtype == np.dtype("<f4")
        for k, x in enumerate(data[c]):
            assert (got[k, : len(x)] == x).all() and (got[k, len(x) :] == -1).all() if x.size else (got[k] == -1).all()
    assert np.load(tmp_path / "npy" / "d.npy").shape == (2, 0, 0)
    _, errors = sinks.npy_files(df.where("clip in ('a', 'b')"), str(tmp_path / "strict"), "clip", "k", "v", least=4, fill=None)
    assert {r.clip: r.error for r in errors.collect()} == {"b": "3 frames"}
    # the column form gives the same arrays
    import io

    for r in frames.packed_npy(df.where("clip in ('a', 'b')"), ["clip"], "k", "v", fill=-1.0).collect():
        assert (np.load(io.BytesIO(r.npy)) == np.load(tmp_path / "npy" / f"{r.clip}.npy")).all()


def test_csv_file(spark, tmp_path):
    n = 5000
    df = spark.range(n).select((n - F.col("id")).alias("k"), F.when(F.col("id") % 7 == 0, F.lit('say "é", x\ny')).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("plain")).alias("a,b"), (F.col("id") / 4).alias("x")).repartition(6)
    done = sinks.csv_file(df, str(tmp_path), "all.csv", ["k"], bom=True)
    assert done.first()["n"] == n
    with open(tmp_path / "all.csv", encoding="utf-8-sig", newline="") as f:
        got = list(csv.reader(f))
    assert got[0] == ["k", "a,b", "x"] and [int(r[0]) for r in got[1:]] == list(range(1, n + 1))
    assert {r[1] for r in got[1:]} == {'say "é", x\ny', "", "plain"}
    sinks.csv_file(df.limit(0), str(tmp_path), "none.csv", ["k"])
    assert (tmp_path / "none.csv").read_text() == 'k,"a,b",x\n'


def test_bare_paths_on_a_cluster(spark, monkeypatch):
    class Cluster:
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="scheme"):
        sinks.reachable(Cluster, "/data/out")
    sinks.reachable(Cluster, "s3://bucket/out")
    sinks.reachable(spark, "/data/out")


def test_sampled_percentiles(spark):
    rng = np.random.default_rng(3)
    rows = [("a", k, [float(x) for x in rng.normal(size=n)]) for k, n in enumerate([0, 10, 999, 3000, 1, 2500])] + [("b", 0, [5.0] * 10), (None, 3, [1.0, 2.0, None, float("nan")]), ("c", 0, []), ("d", 1, None)]
    df = spark.createDataFrame(rows, "g string, t int, v array<double>").repartition(4)
    got = {r.g: r for r in frames.sampled_percentiles(df, ["g"], "t", "v", first=4, per_frame=1000).collect()}
    want = np.concatenate([np.array(v)[:: max(1, len(v) // 1000)] for g, t, v in rows if g == "a" and t < 4])
    assert set(got) == {"a", "b", None} and got["a"].n == len(want)
    assert np.allclose([got["a"].low, got["a"].high], np.percentile(want, [1, 99]))
    assert (got["b"].low, got["b"].high) == (5.0, 5.0 + 1e-6) and got[None].n == 2
    near = {r.g: r for r in frames.sampled_percentiles(df, ["g"], "t", "v", first=4, per_frame=1000, accuracy=200).collect()}["a"]
    ordered = np.sort(want)
    for value, p in ((near.low, 0.01), (near.high, 0.99)):
        assert abs(np.searchsorted(ordered, value) / len(ordered) - p) <= 1 / 200 + 1 / len(ordered)

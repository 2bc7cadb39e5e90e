"""Motion signals and run drivers against plain numpy, on small recordings."""

import io

import numpy as np
import pytest

from tessera.operators import align, frames
from tessera.plans import motion
from tessera.sources import files


def plain_mean(x, w):
    back = (w - 1) // 2
    return np.array([np.mean([x[min(max(k, 0), len(x) - 1)] for k in range(i - back, i - back + w)]) for i in range(len(x))])


@pytest.mark.parametrize("w", [1, 2, 3, 8, 40])
def test_mean_edge(w):
    x = np.random.default_rng(w).normal(size=23)
    assert np.allclose(align.mean_edge(x, w), plain_mean(x, w))


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("t").collect()]


@pytest.mark.parametrize("threshold", [0, 20])
def test_image_motion(spark, threshold):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (12, 6))
    rows = [("r", k * 0.1, None if k == 5 else [float(x) for x in a[k]]) for k in range(12)]
    got = rows_of(motion.image_motion(spark.createDataFrame(rows, "run string, t double, pixels array<double>"), ["run"], threshold=threshold, smooth_s=0.3), "t", "motion")
    kept = [k for k in range(12) if k != 5]
    gap = np.abs(np.diff(a[kept], axis=0))
    want = plain_mean(gap.mean(1) if not threshold else (gap > threshold).mean(1), 3)
    assert np.allclose([m for _, m in got], want)
    assert np.allclose([t for t, _ in got], [(x + y) * 0.05 for x, y in zip(kept, kept[1:])])


@pytest.mark.parametrize("feature", motion.FEATURES)
def test_cloud_motion(spark, feature):
    rng = np.random.default_rng(2)
    clouds = {k: rng.normal(size=(60 + k, 3)) if k != 4 else rng.normal(size=(3, 3)) for k in range(9)}
    rows = [("r", k * 0.1, *map(float, p)) for k, c in clouds.items() for p in c]
    listed = spark.createDataFrame([("r", k * 0.1) for k in range(10)], "run string, t double")
    got = rows_of(motion.cloud_motion(spark.createDataFrame(rows, "run string, t double, x double, y double, z double"), ["run"], feature=feature, smooth_s=0, frames=listed), "t", "motion")
    want = []
    for k in range(1, 9):
        if 4 in (k, k - 1):
            continue
        a, b = clouds[k - 1], clouds[k]
        if feature == "count":
            m = abs(len(b) - len(a))
        elif feature == "centroid":
            m = np.linalg.norm(b.mean(0) - a.mean(0)) / (k * 0.1 - (k - 1) * 0.1)
        else:
            h = [np.histogram(r[r <= 3.0], bins=40, range=(0, 3.0), density=True)[0] for r in (np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))]
            m = np.abs(h[1] - h[0]).sum()
        want.append(((2 * k - 1) * 0.05, m))
    assert np.allclose(got, want, atol=1e-5)
    with pytest.raises(ValueError):
        motion.cloud_motion(listed, ["run"], feature="other")


@pytest.mark.parametrize("mode", motion.MODES)
def test_armband_motion(spark, mode):
    rng = np.random.default_rng(3)
    t = np.cumsum(np.where(np.arange(200) == 90, 1.0, 0.02))
    emg, gyro = rng.normal(size=(200, 8)), rng.normal(size=(200, 3))
    schema = "run string, board_ts double, " + ", ".join(f"emg{k} double" for k in range(1, 9)) + ", gyro_x double, gyro_y double, gyro_z double"
    df = spark.createDataFrame([("r", *map(float, (t[k], *emg[k], *gyro[k]))) for k in range(200)], schema)
    got = rows_of(motion.armband_motion(df, ["run"], mode=mode), "t", "motion")
    ok = np.diff(t) < 0.2
    a = plain_mean(np.abs(np.diff(np.abs(emg).mean(1)))[ok], 4)
    b = plain_mean((gyro**2).sum(1)[1:][ok], round(0.35 / np.median(np.diff(t)[ok])))
    want = {"emg": a, "imu": b, "fusion": np.abs(align.zscore(a) + align.zscore(b))}[mode]
    assert np.allclose([m for _, m in got], want) and np.allclose([x for x, _ in got], ((t[1:] + t[:-1]) / 2)[ok])


def signals_of(spark, runs):
    """Two bumpy signals a run; b lags a by the given seconds."""
    out = {"a": [], "b": []}
    for name, (seconds, lag) in runs.items():
        rng = np.random.default_rng(7)
        at, size = rng.uniform(0, seconds, seconds), rng.uniform(0.5, 2, seconds)
        for side, shift, step in (("a", 0.0, 1 / 30), ("b", lag, 0.05)):
            t = np.arange(0, seconds, step)
            y = (size * np.exp(-(((t[:, None] - shift - at) / 0.2) ** 2))).sum(1)
            out[side] += [(name, float(x), float(v)) for x, v in zip(t, y)]
    return [spark.createDataFrame(out[k], "run string, t double, motion double") for k in "ab"]


def test_run_drivers(spark):
    a, b = signals_of(spark, {"long": (100, 0.4), "short": (9, 0.0)})
    got = {r["run"]: r for r in motion.piecewise_run_offsets(a, b, ["run"], dt=0.05, warmup=1.0, size=15.0, hop=10.0, step=0.05, least_n=200).collect()}
    assert got["short"]["error"] == "too short" and got["long"]["error"] is None
    assert got["long"]["mode"] == "single" and got["long"]["offsets"][0] == pytest.approx(0.4, abs=0.051) and got["long"]["corr"] > 0.9
    fixed = {r["run"]: r for r in motion.piecewise_run_offsets(a, b, ["run"], dt=0.05, warmup=1.0, least_n=200, manual=0.3).collect()}
    assert fixed["long"]["offset"] == 0.3 and fixed["long"]["corr"] is None and fixed["short"]["error"]
    events = {r["run"]: r for r in motion.event_run_offsets(a, b, ["run"], warmup=1.0, tail=1.0).collect()}
    assert events["long"]["offset"] == pytest.approx(0.4, abs=0.03) and 0 < events["long"]["event_ratio"] < 1 and not events["long"]["low_conf"]
    points, failed = motion.on_grid(a, b, ["run"], 0.05, 1.0, 0.0, 8.5, 100, score_first=False)
    assert [r["run"] for r in failed.collect()] == ["short"]
    peaks = motion.peak_table(points, a, ["run"], height=0.5).collect()
    assert {p["kind"] for p in peaks} == {"a", "b", "joint"} and all(abs(p["frame_t"] - p["t"]) <= 1 / 60 + 1e-6 for p in peaks)
    assert motion.piecewise_run_offsets(a.limit(0), b.limit(0), ["run"]).count() == 0


def test_frames(spark):
    df = spark.createDataFrame([("c", n) for n in ("b.jpg", "20251105_172554_530685.jpg", "20251105_172554_030685.jpg", "a.jpg")], "clip string, name string")
    assert [r["name"][:18] for r in frames.numbered_frames(df, ["clip"], "name").orderBy("place").collect()] == ["20251105_172554_03", "20251105_172554_53", "a.jpg", "b.jpg"]
    assert [r["place"] for r in frames.frame_range(df, ["clip"], "name", 1, 3).orderBy("place").collect()] == [1, 2]
    points = spark.createDataFrame([("f", k) for k in range(50)], "f string, k int")
    some = frames.thinned(points, ["f"], "k", 20)
    assert some.count() == some.distinct().count() == 20 and frames.thinned(points, ["f"], "k", 80).count() == 50


def test_packed_npy(spark):
    clip = [[[1.0, 2.0]], [[3.0, 4.0], [5.0, 6.0]], []]
    df = spark.createDataFrame([("c", k, v) for k, v in enumerate(clip)] + [("d", 0, [[1.0]]), ("d", 1, [[1.0, 2.0]])], "clip string, k int, v array<array<double>>")
    got = {r["clip"]: r for r in frames.packed_npy(df, ["clip"], "k", "v", fill=-1.0).collect()}
    assert np.load(io.BytesIO(got["c"]["npy"])).tolist() == [[[1, 2], [-1, -1]], [[3, 4], [5, 6]], [[-1, -1], [-1, -1]]] and got["c"]["shape"] == [3, 2, 2]
    assert "columns differ" in got["d"]["error"] and got["d"]["npy"] is None
    bad = {r["clip"]: r["error"] for r in frames.packed_npy(df, ["clip"], "k", "v", fill=None, least=3).collect()}
    assert bad == {"c": "numbers of rows differ", "d": "2 frames"}


def test_numeric_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("5,6\n")
    got = files.numeric_rows(spark, str(tmp_path)).orderBy("file", "row").collect()
    assert [list(r["values"]) for r in got] == [[1, 2], [3, 4], [5, 6]]
    (tmp_path / "b.csv").write_text("5,6\nq,7\n")
    with pytest.raises(Exception, match="not numbers"):
        files.numeric_rows(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text("n,t,v\n1,a,2.5\n")
    assert files.numeric_columns(spark, str(tmp_path / "b.csv")).columns == ["n", "v"]
    (tmp_path / "b.csv").write_text("t\na\n")
    with pytest.raises(ValueError):
        files.numeric_columns(spark, str(tmp_path / "b.csv"))

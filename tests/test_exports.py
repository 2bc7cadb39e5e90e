"""Exports: armband tables and summaries of XDF recordings (written here), manifests, review logs, time columns."""

import csv
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import dsp
from tessera.plans import exports
from tessera.sources import files, sinks
from tests.test_recordings import chunk

SIDES = {"left": "band a", "right": "band b"}


def stream(sid, name, values, rate=500.0, start=10.0):
    channels = values.shape[1]
    head = f"<info><name>{name}</name><channel_count>{channels}</channel_count><nominal_srate>{rate}</nominal_srate><channel_format>double64</channel_format></info>"
    out = chunk(2, struct.pack("<I", sid) + head.encode())
    body = b"".join(b"\10" + struct.pack("<d", start + k / rate) + v.astype("<f8").tobytes() for k, v in enumerate(values))
    data = struct.pack("<I", sid) + b"\4" + struct.pack("<I", len(values)) + body
    return out + b"\4" + struct.pack("<IH", len(data) + 2, 3) + data


def armband(n, seed=0):
    t = np.arange(n) / 500
    x = np.random.default_rng(seed).normal(size=(n, 16))
    x[:, 0] = 1.7e9 + t
    x[:, 1] = 3 + np.sin(2 * np.pi * 100 * t)  # in the band, on an offset
    x[:, 9] = 9.81  # at rest
    x[:, 12] = np.sin(2 * np.pi * 2 * t)  # slow
    return x


@pytest.fixture
def recorded(tmp_path):
    root = tmp_path / "in"
    (root / "p1").mkdir(parents=True)
    (root / "p1" / "run_1.xdf").write_bytes(b"XDF:" + stream(1, "band a", armband(1000)) + stream(2, "band b", armband(600, 1)) + stream(3, "band a", armband(5, 2)))
    (root / "p1" / "run 2.xdf").write_bytes(b"XDF:" + stream(7, "band b", armband(800, 3)))
    (root / "other.xdf").write_bytes(b"XDF:" + stream(1, "marks", np.ones((4, 2))))
    (root / "few.xdf").write_bytes(b"XDF:" + stream(1, "band a", np.ones((40, 6))) + stream(2, "band b", armband(600, 1)))
    (root / "one.xdf").write_bytes(b"XDF:" + stream(1, "band a", armband(1)))
    (root / "bad.xdf").write_bytes(b"no recording")
    return root


def read(path):
    with open(path, newline="") as f:
        rows = list(csv.reader(f))
    return rows[0], np.array(rows[1:], float), rows[1:]


def test_armband_tables(spark, recorded, tmp_path):
    out = tmp_path / "out"
    call = lambda: {r.stem: r.status for r in exports.armband_tables(spark, str(recorded), str(out), SIDES).collect()}
    first = call()
    assert first.pop("bad").startswith("FAIL: can't be read") and first == {
        "p1/run_1": "OK", "p1/run 2": "OK", "other": "FAIL: no stream of a side", "few": "FAIL: 6 channels, 15 asked for", "one": "FAIL: no sampling rate"}
    made = sorted(str(p.relative_to(out / "csv")) for p in (out / "csv").rglob("*.csv"))
    assert made == ["p1/run 2/right/run 2_right_emg_imu.csv", "p1/run_1/left/run_1_left_emg_imu.csv", "p1/run_1/right/run_1_right_emg_imu.csv"]
    head, got, text = read(out / "csv" / made[1])
    assert head == [exports.TIME, *exports.EMG, *exports.ACC, *exports.GYRO] and got.shape == (1000, 15) and all(len(v.partition(".")[2]) == 7 for v in text[0])
    x = armband(1000)
    assert np.abs(got[:, 0] - x[:, 0]).max() < 1e-6
    assert np.abs(got[100:-100, 1] - (x[100:-100, 1] - 3)).max() < 0.1 and np.abs(got[:, 9]).max() < 1e-7 and np.abs(got[50:-50, 12] - x[50:-50, 12]).max() < 0.02
    assert np.abs(got[:, 4] - dsp.clean_emg(x[:, 4], 500.0)).max() < 1e-5  # the rate comes from the times
    assert (out / "summaries" / "p1" / "run_1_summary.txt").read_text() == (
        "XDF file: run_1\n\n[left]\n  Original samples in stream: 1000\n  EMG CSV samples: 1000  (run_1_left_emg_imu.csv)\n  IMU CSV samples: 1000  (run_1_left_emg_imu.csv)\n"
        "\n[right]\n  Original samples in stream: 600\n  EMG CSV samples: 600  (run_1_right_emg_imu.csv)\n  IMU CSV samples: 600  (run_1_right_emg_imu.csv)\n")  # fmt: skip
    assert [p.name for p in (out / "summaries").rglob("*.txt")].count("few_summary.txt") == 0
    # later: one more recording and one mended; what is done stays untouched
    stamps = {p: p.stat().st_mtime_ns for p in (out / "csv").rglob("*.csv")}
    (recorded / "p2").mkdir()
    (recorded / "p2" / "run_9.xdf").write_bytes(b"XDF:" + stream(1, "band a", armband(700)))
    (recorded / "one.xdf").write_bytes(b"XDF:" + stream(1, "band a", armband(650)))
    again = call()
    assert {k: v for k, v in again.items() if not v.startswith("FAIL")} == {"p1/run_1": "SKIP", "p1/run 2": "SKIP", "p2/run_9": "OK", "one": "OK"}
    assert all(p.stat().st_mtime_ns == t for p, t in stamps.items()) and len(list((out / "csv").rglob("*.csv"))) == 5
    status = exports.armband_tables(spark, str(recorded), str(out), SIDES)
    assert exports.status_counts(status).first() == (0, 4, 3) and exports.status_counts(status.limit(0)).first() == (0, 0, 0)


def test_one_modality_at_another_rate(spark, recorded, tmp_path):
    out = tmp_path / "imu"
    exports.armband_tables(spark, str(recorded / "p1"), str(out), {"right": "band b"}, emg=False, target=250.0)
    head, got, _ = read(out / "csv" / "run_1" / "right" / "run_1_right_emg_imu.csv")
    assert head == [exports.TIME, *exports.ACC, *exports.GYRO] and got.shape == (300, 7)
    assert "  EMG CSV samples: N/A\n  IMU CSV samples: 300  (run_1_right_emg_imu.csv)\n" in (out / "summaries" / "run_1_summary.txt").read_text()


def test_manifest(spark, tmp_path):
    for k, name in enumerate(["run_3_clip_000001_normal_elbow_npy", "run_3_clip_000002_right_mid", "oddly named", "run_10-11_x_left_elbow"]):
        at = tmp_path / "tree" / "p" / "Open Door" / name
        at.mkdir(parents=True)
        (at / "clip.npy").write_bytes(bytes(k + 1))
    rows = files.segments(files.listing(spark, str(tmp_path / "tree")), str(tmp_path / "tree"))
    split = spark.createDataFrame([("p::run_3", "train"), ("p::run_3", "train"), ("p::run_10-11", "val"), (None, "test")], "group_uid string, split string")
    assert exports.manifest_file(rows, split, str(tmp_path / "out")).first()["n"] == 4
    with open(tmp_path / "out" / "manifest.csv", newline="") as f:
        got = list(csv.DictReader(f))
    assert list(got[0]) == exports.MANIFEST and [r["segment_raw"] for r in got] == sorted(r["segment_raw"] for r in got)
    by = {r["segment_raw"]: r for r in got}
    one = by["run_3_clip_000001_normal_elbow_npy"]
    assert (one["segment_base"], one["run_token"], one["group_uid"], one["lighting"], one["pos"], one["split"]) == ("run_3_clip_000001_normal_elbow", "run_3", "p::run_3", "normal", "elbow", "train")
    assert (by["oddly named"]["run_token"], by["oddly named"]["split"]) == ("run_UNKNOWN", "") and by["run_10-11_x_left_elbow"]["split"] == "val"


def test_log_file(spark, tmp_path):
    long = "x" * 40
    rows = [("2024-01-02 03:04:05", "b.xdf", "PASS", "FAIL"), (None, long, "PASS", None), ("2024-01-02 03:04:06", "a.xdf", "FAILED", "PASS")]
    df = spark.createDataFrame(rows, "time string, file string, L_IMU string, R_IMU string").repartition(3)
    widths = {"time": 19, "file": 35, "L_IMU": 5, "R_IMU": 5}
    sinks_list = exports.log_file(df, str(tmp_path), "log.txt", "one line per file", widths)
    lines = (tmp_path / "log.txt").read_text().split("\n")
    assert sinks_list.first()["n"] == 6 and lines[0] == "# one line per file" and lines[1] == f"{'time':<19} {'file':<40} L_IMU R_IMU" and lines[2] == "-" * len(lines[1])
    want = [f"{t or '':<19} {f:<40} {a or '':<5} {b or '':<5}" for t, f, a, b in sorted(rows, key=lambda r: r[1])]
    assert lines[3:-1] == want and lines[-1] == ""
    exports.log_file(df.limit(0), str(tmp_path / "none"), "log.txt", "t", widths)
    assert (tmp_path / "none" / "log.txt").read_text().count("\n") == 3
    sinks.text_files(df.select("file", F.lit("x").alias("l")).limit(0), str(tmp_path / "no"), "file", [], "l")
    assert not list((tmp_path / "no").glob("*.xdf"))


def test_sample_times(spark, tmp_path):
    texts = {"num": ["2.5", "1.25", "", "NaN"], "stamps": ["20240102_030405_000006", "20240102_030404_500000"], "iso": ["2024-01-02 03:04:05.5", "2024-01-02T03:04:06"], "bad": ["20240102_030405_000006", "soon", "", "later", "later"], "inf": ["1", "inf"]}
    for name, values in texts.items():
        (tmp_path / f"{name}.csv").write_text("board_ts,emg1\n" + "".join(f"{v},1\n" for v in values))
    (tmp_path / "none.csv").write_text("board_ts,emg1\n")
    got, errors = files.sample_times(spark, str(tmp_path), zone="Europe/Berlin")
    by: dict[str, list] = {}
    for r in got.collect():
        by.setdefault(r.file.rpartition("/")[2][:-4], []).append(r.t)
    second = 1704161045_000_000  # 02:04:05 UTC
    assert {k: sorted(v, key=str) for k, v in by.items()} == {"num": [1_250_000, 2_500_000, None, None], "stamps": [second - 500_000, second + 6], "iso": [second + 500_000, second + 1_000_000]}
    assert sorted((r.file.rpartition("/")[2], r.n_bad, r.examples) for r in errors.collect()) == [("bad.csv", 4, ["", "later", "soon"]), ("inf.csv", 1, ["inf"])]

"""Functions, kernels, sources, sinks and streams on small cases."""

import json
import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import names, numeric, timeparse
from tessera.operators import align, dsp, intervals, packing, quality, split
from tessera.sources import files, sinks
from tessera.streaming import streams


def one(spark, value, c):
    return spark.createDataFrame([(value,)], "v string").select(c(F.col("v"))).first()[0]


@pytest.mark.parametrize(("action", "t1", "t2"), [("insert_short_wire_into_lug", "insert", "insert_wire_into_lug"), ("pull_out_tape", "pull_out", "pull_out_tape"), ("Close wire  cutter", "close", "close_wire_cutter"), ("dance_wire", "dance", "UNMAPPED_T2"), ("", "unknown", "UNMAPPED_T2")])
def test_tiers(spark, action, t1, t2):
    assert (one(spark, action, names.tier1), one(spark, action, names.tier2)) == (t1, t2)


@pytest.mark.parametrize(("seg", "run", "token", "light", "pos"), [("run_8-37_clip_000030_normal_elbow_npy", 8, "run_8-37", "normal", "elbow"), ("run_10_clip_000008_left_npy", 10, "run_10", "unknown", "unknown"), ("foo", None, "run_UNKNOWN", "unknown", "unknown"), ("J_run_8_x", None, "run_UNKNOWN", "unknown", "unknown")])
def test_segments(spark, seg, run, token, light, pos):
    base = lambda c: names.without_npy(c)
    assert one(spark, seg, names.first_run) == run and one(spark, seg, names.run_token) == token
    assert one(spark, seg, lambda c: names.lighting(base(c))) == light and one(spark, seg, lambda c: names.position(base(c))) == pos


def test_renames(spark):
    assert one(spark, "run_10_clip_000008_left_npy", lambda c: names.with_position(c, F.lit("mid"))) == "run_10_clip_000008_left_mid_npy"
    assert one(spark, "run_10_clip_000008_left", lambda c: names.with_position(c, F.lit("mid"))) == "run_10_clip_000008_left_mid"
    assert one(spark, "run_4_clip_000012_mid_npy", names.normalize_segment) == "run_4_clip_000012"
    assert one(spark, "J_cap_green_pen_run_22_clip_000027_right", lambda c: names.labels_from_key(c)["label_1"]) == "cap_green_pen"
    assert one(spark, "run_24-8", lambda c: names.run_range(c)["a"]) == 8
    assert one(spark, " 1.0 ", names.run_key) == "1"
    assert one(spark, "a/b/c", names.out_path) == "a/b/c_npy"
    assert names.dtype("FP16") == "float"
    with pytest.raises(ValueError):
        names.dtype("int7")


def test_times(spark):
    assert one(spark, "20251023_184757_399654.jpg", lambda c: timeparse.micros(timeparse.stamp(c))) == 1761245277399654
    assert one(spark, "20251023_184757_399654.jpg", lambda c: timeparse.name_to_epoch(c, "Europe/London")) == pytest.approx(1761241677.399654)
    assert one(spark, "no stamp", timeparse.name_to_epoch) is None
    assert str(one(spark, "20251105_172554_530685", timeparse.compact_key)) == "20251105172554530685"
    assert one(spark, "1761241677.5", timeparse.any_to_micros) == 1761241677500000
    assert one(spark, "1761241677", timeparse.any_to_micros) == 1761241677000000


def test_tar_bytes(spark):
    got = spark.createDataFrame([(n,) for n in (-1, 0, 1, 512, 513)], "n long").select(numeric.tar_bytes(F.col("n"))).collect()
    assert [r[0] for r in got] == [512, 512, 1024, 1024, 1536]


def test_axes():
    assert len(numeric.doppler_axis(-8.0, 0.5)) == 32 and numeric.range_axis(0.4, 3)[1] == pytest.approx(0.4 - 1e-5 + numeric.RADAR_BIN_M)


def test_interval_edges(spark):
    samples = spark.createDataFrame([(1, t) for t in (10, 20, 30, 40)], "k int, t long")
    spans = spark.createDataFrame([(1, 1, 25, 12), (2, 1, 0, 5), (3, 1, 35, 99), (4, 1, None, 3), (5, 1, 20, 20)], "id int, k int, s long, e long")
    got = {m: sorted((r.id, r.t) for r in f(samples, spans, ["k"], "t", "s", "e", 7).collect()) for m, f in intervals.MODES.items()}
    assert got["closed"] == [(1, 20), (3, 40), (5, 20)]
    assert got["expand_clamp"] == [(1, 10), (1, 20), (1, 30), (2, 10), (3, 30), (3, 40), (5, 20)]
    assert got["expand_strict"] == []


def test_asof_ties(spark):
    left, right = spark.createDataFrame([(1, 15), (1, 5), (2, 1)], "k int, t long"), spark.createDataFrame([(1, 10), (1, 20)], "k int, t long")
    assert {(r.k, r.t): r.match_t for r in intervals.asof(left, right, ["k"], "t", "nearest").collect()} == {(1, 15): 10, (1, 5): 10, (2, 1): None}


@settings(max_examples=15, deadline=None)
@given(st.integers(-150, 150), st.integers(0, 10_000))
def test_scan_recovers_delay(delay, seed):
    rng = np.random.default_rng(seed)
    t = np.arange(0, 60, 0.02)
    fine = np.arange(-5, 65, 0.02)
    wave = np.convolve(rng.normal(size=len(fine)), np.ones(15) / 15, "same")
    a, b = np.interp(t, fine, wave), np.interp(t - delay / 100, fine, wave)
    assert abs(align.scan(t, a, b)[0] - delay / 100) <= 0.011
    r = align.coarse_fine(t, a, b)
    assert abs(r["offset"] - delay / 100) <= 0.0051 and r["corr"] > 0.9


def test_constant_signal():
    t = np.arange(0, 60, 0.02)
    assert align.corr(np.ones(5), np.arange(5.0)) == -1.0 and align.curve(t, np.ones_like(t), np.sin(t), np.array([0.0]), 10)[0] == -1.0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=6, max_size=14), st.integers(0, 2))
def test_change_points(y, most):
    y = np.array(y)
    cuts, sse, cost = align.change_points(y, most, 2, 0.5)
    whole = ((y - y.mean()) ** 2).sum()
    assert cost <= whole + 1e-9 and len(cuts) <= most
    edges = [0, *cuts, len(y)]
    assert sse == pytest.approx(sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in zip(edges, edges[1:])), abs=1e-6)
    assert all(b - a >= 2 for a, b in zip(edges, edges[1:]))


def test_piecewise(spark):
    rng = np.random.default_rng(3)
    t = np.arange(0, 200, 0.05)
    fine = np.arange(-5, 205, 0.05)
    wave = np.convolve(rng.normal(size=len(fine)), np.ones(9) / 9, "same")
    b = np.interp(np.where(t < 100, t - 0.5, t + 0.7), fine, wave)
    df = spark.createDataFrame([(1, float(x), float(u), float(v)) for x, u, v in zip(t, np.interp(t, fine, wave), b)] + [(2, 0.0, 1.0, 1.0)], "run int, g double, a double, b double")
    rows = {r.run: r for r in align.piecewise_offsets(df, ["run"], step=0.05).collect()}
    assert rows[1].mode == "piecewise" and rows[1].offsets == pytest.approx([0.5, -0.7], abs=0.051) and abs(rows[1].changes[0] - 100) < 12
    assert rows[2].error


def test_nms():
    t, h = np.array([0.0, 1.0, 1.1, 5.0]), np.array([1.0, 3.0, 2.0, 2.5])
    assert align.nms(t, h, h, 0.5, 10).tolist() == [0, 1, 3] and align.nms(t, h, h, 0.5, 2).tolist() == [1, 3]


def test_filters():
    fs, t = 1000.0, np.arange(0, 4, 0.001)
    keep, hum, slow = np.sin(2 * math.pi * 120 * t), np.sin(2 * math.pi * 50 * t), np.sin(2 * math.pi * 2 * t)
    gain = lambda x: np.std(dsp.clean_emg(x, fs, (30, 450))[1000:3000]) / np.std(x[1000:3000])
    assert gain(keep) == pytest.approx(1, abs=0.05) and gain(hum) < 0.1 and gain(slow) < 0.01
    assert abs(dsp.clean_emg(keep + 7, fs).mean()) < 1e-2
    y = dsp.resample(np.sin(2 * math.pi * 5 * t), 1, 2)
    assert len(y) == 2000 and np.allclose(y[200:1800], np.sin(2 * math.pi * 5 * t)[::2][200:1800], atol=0.02)


def test_undo(spark):
    log = spark.createDataFrame([("a", 1, "PASS"), ("a", 2, "FAIL"), ("a", 3, "UNDO"), ("b", 1, "PASS"), ("b", 2, "UNDO"), ("c", 1, "FAIL"), ("c", 2, "PASS"), ("c", 3, "SKIP"), ("c", 4, "UNDO"), ("c", 5, "UNDO")], "k string, t int, s string")
    assert {r.k: r.s for r in quality.latest_status(log, "k", "t", "s").collect()} == {"a": "PASS", "c": "FAIL"}


def test_rename_plan(spark):
    df = spark.createDataFrame([("p", "x_left"), ("p", "x_left_npy"), ("p", "x_mid")], "parent string, old string")
    rows = {r.old: (r.new_name, r.status) for r in quality.rename_plan(df, "old", names.with_position(names.without_npy(F.col("old")), F.lit("mid")), "parent").collect()}
    assert rows["x_mid"] == ("x_mid", "unchanged") and sorted(r[1] for r in rows.values()) == ["conflict", "rename", "unchanged"]


def test_splits(spark):
    runs = spark.createDataFrame([("s", "a", i) for i in range(8)] + [("s", "b", i) for i in range(3)], "subject string, cond string, run int")
    rows = split.stratified_runs(runs, ["subject", "cond"], "run").collect()
    n = [sum(r.split == s and r.cond == "a" for r in rows) for s in names.SPLITS]
    assert n == [6, 1, 1] and all((r.error is None) == (r.cond == "a") for r in rows)
    groups = spark.createDataFrame([(f"g{i}", 5 + i % 3, ["u", "v"], [f"x{i % 4}"], [f"y{i}"]) for i in range(30)], "gid string, n int, t1 array<string>, t2 array<string>, t3 array<string>")
    got = split.search(groups, "gid", "n", ("t1", "t2", "t3"), trials=40).collect()
    assert len(got) == 30 and {r.split for r in got} == set(names.SPLITS) and got[0].score > 0


def test_shards(spark):
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate([600, 600, 1200, 100, 5000, 10])], "g string, k int, n long")
    assert [r.shard for r in packing.shards_by_bytes(df, "g", "k", "n", 1300).orderBy("k").collect()] == [0, 0, 1, 1, 2, 3]
    assert [r["__pos"] for r in packing.numbered(df, "k").orderBy("k").collect()] == list(range(6))


def test_tar_round_trip(spark):
    df = spark.createDataFrame([(0, "k1", "k1.a.jpg", b"abc"), (0, "k0", "k0.b.json", b"x" * 600), (1, "k2", "k2.c", None)], "shard int, key string, member string, content binary")
    got = {(r.shard, r.member): (r.offset_data, r.size) for r in sinks.tar_members(sinks.tar_shards(df)).collect()}
    assert got == {(0, "k0.b.json"): (512, 600), (0, "k1.a.jpg"): (2560 - 512, 3), (1, "k2.ERR.k2.c.txt"): (512, 7)}


def test_sources(spark, tmp_path):
    root = tmp_path / "root"
    for p in ("N/take_wire/run_3_clip_000011_normal_elbow/cam_1/20251105_172554_530685.jpg", "N/take_wire/run_3_clip_000011_normal_elbow/cam_1/19700105_172554_530685.jpg", "J/.x/run_1/cam_1/a.jpg", "J/cut_tape/foo_npy/cam_1/a.png"):
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_bytes(b"1")
    found = files.listing(spark, str(root))
    seg = {r.segment: r for r in files.segments(found, str(root)).collect()}
    assert set(seg) == {"run_3_clip_000011_normal_elbow", "foo_npy"} and seg["run_3_clip_000011_normal_elbow"].group_uid == "N::run_3" and seg["foo_npy"].key == "J/cut_tape/foo"
    assert files.frames(found, extensions=files.IMAGES).count() == 1 and files.leaf_folders(found).count() == 2
    assert files.clips_with_frames(found, str(root), "cam_1").where("person = 'N'").first().n_frames == 2

    ann = tmp_path / "ann"
    ann.mkdir()
    (ann / "N_run_1.csv").write_text("﻿No,Action,Object,start_idx,end_idx,start,end,mark\n1,take,\"wire, red\",0,5,20251105_172600_000000,20251105_172554_530685,\n2,,x,0,1,a,b,\n", "utf-8")
    (ann / "N_run_2.csv").write_text("1,cut,,0,5,20251105_172554_530685,20251105_172556_000000,,,\n")
    (ann / "N_run_2 copy.csv").write_text("1,cut,,0,5,20251105_172554_530685,20251105_172556_000000,,,\n")
    rows = quality.normalised_annotations(files.annotations(spark, str(ann))).orderBy("action").collect()
    assert [(r.action, r.object, r.mark) for r in rows] == [("cut", "", "object unclear"), ("take", "wire, red", "")] and rows[1].start_us < rows[1].end_us

    (tmp_path / "p.csv").write_text("px,py,pz,i\n1,2,3,4\n0,0,0,0\n1,nan,3,4\n")
    (tmp_path / "q.csv").write_text("1,2,3,4,9\n5,6,7,8,9\n")
    assert files.points(spark, str(tmp_path / "p.csv")).count() == 1 and files.points(spark, str(tmp_path / "q.csv")).count() == 2

    (tmp_path / "a.csv").write_text(",".join(c.split()[0] for c in files.ARMBAND.split(", ")) + "\n" + "".join(f"{t}," + ",".join(["1"] * 14) + "\n" for t in [3, 1, 1, "nan", *range(4, 14)]))
    assert files.armband(spark, str(tmp_path / "a.csv")).where("error is null").count() == 12

    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.dat").write_bytes(b"".join(struct.pack("=IIffff", k, 2, 0, 0, 0, 0) + struct.pack("=4f", 3, 0, 4, 1) for k in range(2)) + b"\1" * 30)
    got = files.radar_packets(spark, str(tmp_path / "r")).select("no", numeric.amplitude(F.col("i"), F.col("q")).alias("a")).collect()
    assert [(r.no, r.a) for r in got] == [(0, [5.0, 1.0]), (1, [5.0, 1.0])]

    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "cam_1.json").write_text(json.dumps({"k": {"cam": "1", "frames": ["a", "b"], "n_frames": 2, "frame_dir": "d"}, "e": {"cam": "1", "frames": [], "n_frames": 0, "frame_dir": "d"}}))
    assert [(r.key, r.cams["1"].n_frames) for r in files.cameras(spark, str(tmp_path / "c")).collect()] == [("k", 2)]
    (tmp_path / "m.csv").write_text("run,light\n1.0,left\n1,left\n2,left\n2,\n")
    assert {r.run: r.conflict for r in files.run_light(spark, str(tmp_path / "m.csv")).collect()} == {"1": False, "2": True}
    np.save(tmp_path / "z.npy", np.arange(6.0).reshape(2, 3))
    assert files.npy_arrays(spark, str(tmp_path / "z.npy")).first().shape == [2, 3]


def test_streams(spark, sf001, tmp_path):
    events = spark.read.parquet(f"{sf001}/events.parquet").select("user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    live = streams.file_stream(spark, str(tmp_path / "in"), "user_id long, event_type string, value double, ts timestamp", 1)
    for _ in range(2):  # the second run has nothing new
        streams.to_table(live.where("value > 10"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.where("value > 10").count()
    q = streams.accumulate(live, "ts", "1 hour", ["event_type"]).writeStream.format("memory").queryName("acc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(n) from acc").first()[0] == events.count()

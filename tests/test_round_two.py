"""Helpers that no registered query reaches, and operators whose plans changed, against plain Python."""

import itertools
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import names, numeric, timeparse
from tessera.operators import intervals, packing, quality, samples, signals
from tessera.sources import files, sinks
from tessera.streaming import streams


def column(spark, values, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expr(F.col("x"))).collect()]


def test_run_token(spark):
    got = column(spark, ["run_3_cut", " RUN_1-2 x", "Run 3 cut wire", "run__4", "cut_run_3", None], names.run_token)
    assert got == ["run_3", "run_1-2", "run_3", "run_4", "run_UNKNOWN", "run_UNKNOWN"]


def test_strict_epoch(spark):
    assert column(spark, ["20240102_030405_500000", None], timeparse.strict_epoch) == [1704164645.5, None]
    for wrong in ("x20240102_030405_500000", "20241302_030405_500000", ""):
        with pytest.raises(Exception, match="not a stamp"):
            column(spark, [wrong], timeparse.strict_epoch)


def test_asof_within(spark):
    left = spark.createDataFrame([(1, 10), (1, 50)], "k int, t long")
    right = spark.createDataFrame([(1, 8), (1, 80)], "k int, t long")
    got = {r.t: r.match_t for r in intervals.asof(left, right, ["k"], "t", "nearest", within=5).collect()}
    assert got == {10: 8, 50: None}


def test_overlap_best(spark):
    rng = random.Random(4)
    span = lambda: (lambda a: (a, a + rng.randrange(12)))(rng.randrange(60))
    left = [(i, i % 3, *span()) for i in range(60)]
    right = [(i, i % 3, *span()) for i in range(90)] + [(100, 1, left[1][2], left[1][3])]
    a = spark.createDataFrame(left, "id int, g int, a0 int, a1 int")
    b = spark.createDataFrame([(*r, f"x{r[0]}") for r in right], "name int, g int, b0 int, b1 int, more string")
    got = {r.id: (r.name, r.b0, r.b1, r.more) for r in intervals.overlap_best(a, b, ["g"], ("a0", "a1"), ("b0", "b1"), "name", 7).collect()}
    want = {}
    for i, g, x, y in left:
        fits = [(not (p == x and q == y), q - p, n, p, q) for n, h, p, q in right if h == g and x <= q and p <= y]
        if fits:
            _, _, n, p, q = min(fits)
            want[i] = (n, p, q, f"x{n}")
    assert got == want


def test_overlap_best_odd_ranges(spark):
    """Repeated left rows stay; null bounds match nothing; a reversed right range is matched by what reaches over both its ends; ties go by name, then bounds."""
    a = spark.createDataFrame([(1, "g", 0, 9), (1, "g", 0, 9), (2, None, 0, 9), (3, "g", None, 9), (4, "g", 40, 41), (5, "h", 3, 6), (6, "h", 5, 6)], "id int, g string, a0 int, a1 int")
    b = spark.createDataFrame([("y", "g", 2, 4), ("x", "g", 7, 9), ("x", "g", 5, 7), ("w", "g", 0, None), ("v", None, 0, 9), ("r", "h", 5, 4), ("s", "h", 4, 8)], "name string, g string, b0 int, b1 int")
    got = sorted((r.id, r.name, r.b0, r.b1) for r in intervals.overlap_best(a, b, ["g"], ("a0", "a1"), ("b0", "b1"), "name", 4).collect())
    assert got == [(1, "x", 5, 7), (1, "x", 5, 7), (5, "r", 5, 4), (6, "s", 4, 8)]
    assert intervals.overlap_best(a, b.limit(0), ["g"], ("a0", "a1"), ("b0", "b1"), "name", 4).count() == 0


def test_two_set_columns(spark):
    side = lambda xs: spark.createDataFrame([(x,) for x in xs], "k string")
    got = sorted(tuple(r) for r in quality.two_set_columns(side("acdfx"), side("bcx"), "k").select("pos", "only_in_a", "only_in_b", "common").collect())
    assert got == [(1, "a", "b", "c"), (2, "d", "", "x"), (3, "f", "", "")]


def test_numbered(spark):
    rows = spark.createDataFrame([(random.Random(k).random(),) for k in range(500)], "x double").repartition(7)
    got = sorted((r["__pos"], r.x) for r in packing.numbered(rows, "x").collect())
    assert [p for p, _ in got] == list(range(500)) and all(a[1] <= b[1] for a, b in itertools.pairwise(got))


def test_list_literal(spark):
    assert column(spark, ["[1, 2.5, -3]", "[]", None], numeric.list_literal)[0] == [1.0, 2.5, -3.0]


def test_tar_files(spark, tmp_path):
    rows = [(f"s{i % 3}.tar", f"k{i % 5}", f"k{i % 5}.m{i}.bin", None if i == 7 else bytes([i]) * (600 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "shard string, key string, member string, content binary")
    made = {r.shard: r for r in sinks.tar_files(df, str(tmp_path / "tars")).collect()}
    assert set(made) == {"s0.tar", "s1.tar", "s2.tar"} and sorted(x.name for x in (tmp_path / "tars").iterdir() if not x.name.startswith(".")) == sorted(made)
    for name, r in made.items():
        with tarfile.open(tmp_path / "tars" / name) as tar:
            got = [(m.name, tar.extractfile(m).read()) for m in tar]
        want = [(m, c) if c is not None else (f"{k}.ERR.{m}.txt", b"missing") for _, k, m, c in sorted(x for x in rows if x[0] == name)]
        assert got == want and r.n == len(want) and r.bytes == (tmp_path / "tars" / name).stat().st_size


def test_split_and_camera_json_round_trips(spark, tmp_path):
    samples = spark.createDataFrame([("train", "a", '{"x": 1}'), ("train", "b", '{"x": 2}'), ("val", "é", "[3]")], "split string, key string, entry string")
    assert sorted((r.file, r.n) for r in sinks.split_json(samples, str(tmp_path / "split"), meta={"seed": 1}).collect()) == [("train.json", 2), ("val.json", 1)]
    back = {(r.file.rsplit("/", 1)[-1], r.key): r.entry for r in files.split_samples(spark, str(tmp_path / "split")).collect()}
    assert {k: v.replace(" ", "") for k, v in back.items()} == {("train.json", "a"): '{"x":1}', ("train.json", "b"): '{"x":2}', ("val.json", "é"): "[3]"}
    frames = spark.createDataFrame([("c0", "k1", ["a.jpg", "b.jpg"], 2, "d"), ("c1", "k1", ["z.jpg"], 1, "e"), ("c1", "k2", [], 0, "f")], "cam string, key string, frames array<string>, n_frames int, frame_dir string")
    assert sinks.camera_json(frames, str(tmp_path / "cams")).count() == 2
    got = {r.key: {c: (e.frames, e.n_frames) for c, e in r.cams.items()} for r in files.cameras(spark, str(tmp_path / "cams")).collect()}
    assert got == {"k1": {"c0": (["a.jpg", "b.jpg"], 2), "c1": (["z.jpg"], 1)}}
    sinks.text_file("n: 3\n", str(tmp_path / "reports" / "r.txt"))
    assert (tmp_path / "reports" / "r.txt").read_text() == "n: 3\n"


def listed(spark, *paths):
    return spark.createDataFrame([(p, 1) for p in paths], "path string, length long")


def test_folder_rules(spark):
    found = listed(spark, "/d/root/cut/run_1_clip_2_mid_npy/a.npy", "/d/root/cut/run_1_clip_2/b.npy", "/d/root/.x/run_1/b.npy", "/d/root/old/run_1/b.npy", "/d/root/cut/skip/b.npy")
    assert [tuple(r) for r in files.action_pairs(found, "/d/root", ("old",), ("skip",)).collect()] == [("cut", "run_1_clip_2")]
    found = listed(spark, "/a/1/x.csv", "/a/1/y.CSV", "/a/left/clip.csv", "/a/right/clip.csv", "/b/left/other.csv", "/c/z.txt")
    assert {r[0] for r in files.csv_folders(found).collect()} == {"/a/1", "/a/left", "/a/right", "/b/left"}
    assert {r[0] for r in files.csv_folders(found, ("left", "right")).collect()} == {"/a"}
    got = files.cloud_frames(listed(spark, "/a/20240102_030405_500000_cloud.csv", "/a/x.csv"))
    assert [r.t for r in got.collect()] == [1704164645.5]
    with pytest.raises(Exception, match="not a stamp"):
        files.cloud_frames(listed(spark, "/a/today_cloud.csv")).collect()
    names_ = spark.createDataFrame([("r", n) for n in ("B_annotationlight.csv", "a_annotationlight.csv", "0 copy_annotationlight.csv", "c.csv")], "folder string, name string")
    assert [r.name for r in files.run_annotation(names_, "folder", "name", "first").collect()] == ["a_annotationlight.csv"]


def test_strict_micros(spark):
    assert column(spark, ["1.5", "20240102_030405_500000", "2024-01-02 03:04:05.5", None], timeparse.strict_micros) == [1_500_000, 1704164645500000, 1704164645500000, None]
    assert column(spark, ["2024-07-02T03:04:05"], lambda c: timeparse.normalised(c, "Europe/London")) == [1719885845000000]
    with pytest.raises(Exception, match="not a time: soon"):
        column(spark, ["soon"], timeparse.strict_micros)


def test_small_tables(spark, tmp_path):
    (tmp_path / "m.csv").write_text("subject,run,emg_pos\nN,3,mid\nN,3,elbow\n ,x,y\nJ, 4 ,mid\n")
    assert {(r.subject, r.run): r.emg_pos for r in files.run_positions(spark, str(tmp_path / "m.csv")).collect()} == {("N", 3): "elbow", ("J", 4): "mid"}
    (tmp_path / "bad.csv").write_text("subject,run,emg_pos\nN,three,mid\n")
    with pytest.raises(Exception, match="bad mapping row"):
        files.run_positions(spark, str(tmp_path / "bad.csv")).collect()
    for style, text in (("csv", "a,pass,fine\nb,,\n"), ("tsv", "a\tpass\tfine\nb\t\t\n"), ("fixed", "a   pass  fine\nb\n\n")):
        (tmp_path / f"log.{style}").write_text(text)
        got = {r.key: (r.status, r.comment or "") for r in files.review_log(spark, str(tmp_path / f"log.{style}"), style).collect()}
        assert {k: v[0] for k, v in got.items()} == {"a": "PASS", "b": "SKIP"} and got["a"][1] == "fine"


def test_written_tables(spark, tmp_path):
    df = spark.createDataFrame([("b", 1.5), ("a", 0.25)], "k string, x double")
    assert sinks.csv_text(df, ["k"], bom=True) == "﻿k,x\na,0.25\nb,1.5\n"
    with pytest.raises(ValueError, match="more than 1 rows"):
        sinks.csv_text(df, ["k"], most=1)
    assert [r.x for r in sinks.sample_csv(df).orderBy("k").collect()] == ["0.2500000", "1.5000000"]
    for _ in range(2):
        sinks.append_lines(df, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 4
    sinks.segments(df, str(tmp_path / "seg"), ["k"])
    sinks.segments(df.limit(0), str(tmp_path / "seg"), ["k"])  # there already: left as it is
    assert spark.read.parquet(str(tmp_path / "seg")).count() == 2
    sinks.segments(df.where("k = 'a'"), str(tmp_path / "seg"), ["k"], overwrite=True)
    assert [r.k for r in spark.read.parquet(str(tmp_path / "seg")).collect()] == ["a"]
    many = spark.createDataFrame([(f"v{i:02d}",) for i in [*range(12), 3]], "v string")
    assert sinks.report({"unmapped": many, "rare": many.limit(0)}, "v", 10).split("\n") == ["unmapped: 12", *(f"  v{i:02d}" for i in range(10)), "  ... 2 more", "rare: 0", ""]


def test_modality_choice():
    assert packing.choose_modalities(["emg", "x", "rgb"]) == ["emg", "rgb"]
    with pytest.raises(ValueError, match="none of"):
        packing.choose_modalities(["x"])
    assert packing.canonical({"lidar": "a", "rgb": "b"}) == "rgb" and packing.canonical({"lidar": "a", "emg": "b"}) == "emg"


def test_modality_index(spark):
    rows = [("k", "mindrove", "left", "b.npy"), ("k", "mindrove", "left", "z/clip.npy"), ("k", "sound", "q", "s2"), ("k", "sound", "r", "s1"), ("k", "rgb", "cam_1", "2.PNG"), ("k", "rgb", "cam_1", "1.png"), ("n", "rgb", "cam_2", None)]
    index = samples.modality_index(spark.createDataFrame(rows, "key string, modality string, part string, path string"), "key", "modality", "part", "path")
    assert {(r.modality, r.part): r.files for r in index.collect()} == {("mindrove", "left"): ["z/clip.npy"], ("sound", None): ["s1"], ("rgb", "cam_1"): ["1.png", "2.PNG"]}
    got = {r.member: r.path for r in samples.members(samples.chosen(index, "modality", ["rgb", "emg"]), "key", "modality").collect()}
    assert got == {"k.emg_left.npy": "z/clip.npy", "k.rgb_1.000000.png": "1.png", "k.rgb_1.000001.png": "2.PNG", "k.labels.json": None, "k.meta.json": None}
    assert samples.members(samples.chosen(index, "modality", ["rgb"], ["9"]), "key", "modality").count() == 0


def test_latest_reviews(spark, tmp_path):
    for n, rows in enumerate(([("a", "FAIL", 1), ("b", "PASS", 2)], [("a", "PASS", 3)])):
        spark.createDataFrame([(k, s, t) for k, s, t in rows], "k string, s string, t long").withColumn("t", F.timestamp_seconds("t")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = streams.file_stream(spark, str(tmp_path / "in"), "k string, s string, t timestamp", 1)
    q = streams.latest_reviews(live, "k", "t", "s").writeStream.format("memory").queryName("reviews").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.k: r.s for r in spark.table("reviews").collect()} == {"a": "PASS", "b": "PASS"}


def test_dedupe_time(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 6, "c"), (2, 5, "d")], "k int, t long, v string")
    got = signals.dedupe_time(rows, ["k"], "t", "v")
    assert sorted((r.k, r.t) for r in got.collect()) == [(1, 5), (1, 6), (2, 5)]

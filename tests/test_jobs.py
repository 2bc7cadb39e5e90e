"""The jobs: command line, reruns, growing input, failures between two writes, odd tables."""

import base64
import json
import os
import pathlib
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import common, shard_corpus, stream_coverage

ROOT = pathlib.Path(__file__).resolve().parents[1]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def shards(spark, docs, labels, tmp_path, name, **config):
    docs.write.parquet(str(tmp_path / name / "documents"))
    labels.write.parquet(str(tmp_path / name / "labels"))
    at = [str(tmp_path / name / x) for x in ("documents", "labels", "out")]
    done = shard_corpus.shard_corpus(spark, *at, shard_corpus.DEFAULTS | config)
    schema = "doc_id long, strata string, run string, member string, offset_data long, n_bytes long, md5 string, text string, split string, shard long"
    return done, spark.read.schema(schema).parquet(at[2])


def test_shards_of_odd_documents(spark, tmp_path):
    text = lambda k: f"text {k} " * (k % 50 + 1)
    docs = [(k, text(k), ["en", None][k % 2], f"r{k % 9}" if k % 11 else None) for k in range(600)]
    docs += [(k, "the same text", "en", f"r{k % 9}") for k in range(1000, 1300)]  # many copies
    docs += [(2000, None, "en", "r1"), (2001, "", "en", "r1"), (None, "no id", "en", "r1"), (3, text(3), None, "r3"), (4, "other text of id 4", "en", "r0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumns({c: F.lit("clash") for c in ("split", "shard", "md5", "run", "strata", "n_bytes")})
    labels = spark.createDataFrame([(5, 0, 0), (6, 1, 1), (7, 1, 0), (5, 1, 0), (None, 0, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    done, out = shards(spark, df, labels, tmp_path, "odd", shard_bytes=40_000, max_samples_per_shard=30)
    got = out.collect()
    ids = [r.doc_id for r in got]
    assert sorted(ids) == sorted({*range(600), 1000} - {5, 6})
    assert sum(x["documents"] for x in done["written"].values()) == len(got)
    assert len({r.md5 for r in got}) == len(got)
    by_run, by_shard = {}, {}
    for r in got:
        by_run.setdefault((r.strata, r.run), set()).add(r.split)
        by_shard.setdefault((r.split, r.shard), []).append(r)
    assert all(len(s) == 1 for s in by_run.values()) and {r.split for r in got} == {"train", "val", "test"}
    for members in by_shard.values():
        assert len(members) <= 30
        at = 512
        for r in sorted(members, key=lambda r: r.doc_id):
            assert r.offset_data == at and len(r.text.encode()) == r.n_bytes
            at += 512 + -(-r.n_bytes // 512) * 512
        assert at - 512 <= 40_000
    for s in {r.split for r in got}:  # ids go up from shard to shard
        order = [r.shard for r in sorted((r for r in got if r.split == s), key=lambda r: r.doc_id)]
        assert order == sorted(order) and set(order) == set(range(max(order) + 1))
    # one file a shard, in order
    files = out.select("split", "shard", F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == len(by_shard)


def test_shards_of_nothing(spark, tmp_path):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    done, out = shards(spark, docs, labels, tmp_path, "none")
    assert done["written"] == {} and out.count() == 0


def test_shards_by_command_line(spark, sf001, tmp_path):
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"shard_bytes": 100_000, "seed": "7"}))
    out = tmp_path / "out"
    command = [sys.executable, "jobs/shard_corpus.py", "--config", str(config), "--documents", f"{sf001}/documents.parquet", "--labels", f"{sf001}/labels.parquet", "--out", str(out)]
    before = None
    for _ in range(2):
        log = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": str(ROOT)}).stderr
        assert "read 200 documents" in log and "wrote train:" in log and "done:" in log, log[-2000:]
        now = rows(spark.read.parquet(str(out)))
        assert now and before in (None, now)
        before = now
    assert not any("clash" in p.name for p in out.iterdir()) and {p.name for p in out.iterdir() if p.is_dir()} <= {"split=train", "split=val", "split=test"}


def test_unknown_settings(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"shard_byte": 1}')
    with pytest.raises(ValueError, match="shard_byte"):
        common.config_file(spark, str(tmp_path / "c.json"), shard_corpus.DEFAULTS)


@pytest.fixture
def arriving(spark, sf001, tmp_path):
    """Three files of samples: by id, with late and repeated times, and rows without time, run, modality or value."""
    events = spark.read.parquet(f"{sf001}/events.parquet").select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", F.lit("extra").alias("day"))
    odd = spark.createDataFrame([(None, "view", "2024-01-02 03:04:05", 1.0), (1, None, "2024-01-02 03:04:05", 2.0), (1, "view", None, 3.0), (1, "view", "2024-01-02 03:04:05", None), (1, "other", "2024-01-02 03:10:05", 4.0)], "user_id long, event_type string, ts string, value double")
    odd = odd.withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "day": F.lit("extra")})
    n = events.count()
    parts = [events.limit(n // 2), events.exceptAll(events.limit(n // 2)), odd.union(events.limit(20))]
    (tmp_path / "in").mkdir()
    files = []
    for k, p in enumerate(parts):
        p.coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
        files.append((next((tmp_path / f"part{k}").glob("*.parquet")), p.count()))

    def arrive(k):
        target = tmp_path / "in" / f"f{k}.parquet"
        (tmp_path / "in" / f".f{k}").write_bytes(files[k][0].read_bytes())
        (tmp_path / "in" / f".f{k}").rename(target)
        return files[k][1]

    return arrive


def expected(spark, tmp_path):
    whole = spark.read.parquet(str(tmp_path / "in")).select("user_id", "event_type", "ts", "value")
    return rows(rounded(stream_coverage.coverage(stream_coverage.sums(whole, 3_600_000_000), stream_coverage.DEFAULTS["modalities"])))


def rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in ("mean", "rate_hz")})


def covered(spark, tmp_path):
    schema = "window_us long, run long, modality string, n long, mean double, lowest double, highest double, first_us long, last_us long, rate_hz double, n_modalities int, complete boolean, day string"
    return rows(rounded(spark.read.schema(schema).parquet(str(tmp_path / "out/coverage"))))


def take(spark, tmp_path):
    return stream_coverage.stream_coverage(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_coverage_of_growing_input(spark, arriving, tmp_path):
    first = arriving(0)
    assert take(spark, tmp_path)["samples"] == first
    assert covered(spark, tmp_path) == expected(spark, tmp_path)
    more = arriving(1) + arriving(2)
    done = take(spark, tmp_path)
    assert done["samples"] == more  # only what is new
    assert covered(spark, tmp_path) == expected(spark, tmp_path)
    before = covered(spark, tmp_path)
    assert take(spark, tmp_path) == {"samples": 0, "batches": 0, "days": 0}
    assert covered(spark, tmp_path) == before


def test_coverage_after_a_failure(spark, arriving, tmp_path, monkeypatch):
    arriving(0)
    take(spark, tmp_path)
    arriving(1)
    whole = stream_coverage.coverage

    def broken(*_):
        raise RuntimeError("the driver is lost here")

    monkeypatch.setattr(stream_coverage, "coverage", broken)
    with pytest.raises(Exception, match="lost here"):
        take(spark, tmp_path)
    monkeypatch.setattr(stream_coverage, "coverage", whole)
    arriving(2)
    take(spark, tmp_path)
    assert covered(spark, tmp_path) == expected(spark, tmp_path)


def test_jobs_import_nothing_of_llm():
    for path in [*(ROOT / "jobs").glob("*.py"), pathlib.Path(__file__)]:
        assert not [x for x in path.read_text().splitlines() if x.strip().startswith(("import", "from")) and ("llm" in x or "corpus_pipeline" in x)]


def test_shards_move_texts_once(spark, tmp_path):
    text = lambda k: base64.b85encode(random.Random(k).randbytes(16_000)).decode()
    docs = spark.createDataFrame([(k, text(k), "en", f"r{k % 9}") for k in range(300)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), moved()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where there are many documents
    try:
        done, out = shards(spark, docs, labels, tmp_path, "once", shard_bytes=400_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    size = sum(x["bytes"] for x in done["written"].values())
    assert out.count() == 300 and size == 300 * 20_000
    assert moved() - before < 1.5 * size

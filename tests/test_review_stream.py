"""Reviews as they come in, with UNDO: the stream's results are the log's, over restarts, late entries and failures."""

import random

import pytest

from tessera.operators import quality
from tessera.streaming import streams

SCHEMA = "clip string, t long, status string"


@pytest.fixture
def log():
    rng = random.Random(7)
    rows = [(f"c{rng.randrange(12)}", t, rng.choice(["PASS", "FAIL", "UNDO", "SKIP"])) for t in range(300)]
    return rows + [("only_undo", 1000, "UNDO"), ("undone", 1001, "PASS"), ("undone", 1002, "UNDO"), ("late", 2005, "UNDO")]


def take(spark, tmp_path, transform=lambda x: x):
    stream = streams.reviews(streams.file_stream(spark, str(tmp_path / "log"), SCHEMA), "clip", "t", "status")
    query = streams.to_table(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), transform, mode="update")
    query.awaitTermination()


def arrive(spark, tmp_path, rows, k):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))


def expected(spark, rows):
    got = quality.latest_status(spark.createDataFrame(rows, SCHEMA), "clip", "t", "status")
    return {r.clip: (r.status, r.t) for r in got.collect()}


def stands(spark, tmp_path):
    rows = streams.latest_of(spark, str(tmp_path / "out"), "clip", "clip string, status string, t long").collect()
    assert len({r.clip for r in rows}) == len(rows)
    return {r.clip: (r.status, r.t) for r in rows if r.status is not None}


def test_reviews_over_restarts(spark, log, tmp_path):
    parts = [log[:100], log[150:], log[100:150] + [("late", 2003, "FAIL"), ("late", 2004, "PASS")]]  # the last comes late
    seen = []
    for k, part in enumerate(parts):
        arrive(spark, tmp_path, part, k)
        take(spark, tmp_path)
        seen += part
        assert stands(spark, tmp_path) == expected(spark, seen)
    assert stands(spark, tmp_path)["late"] == ("FAIL", 2003) and "undone" not in stands(spark, tmp_path)
    before = stands(spark, tmp_path)
    take(spark, tmp_path)
    assert stands(spark, tmp_path) == before


def test_reviews_after_a_failure(spark, log, tmp_path):
    arrive(spark, tmp_path, log[:100], 0)
    take(spark, tmp_path)
    arrive(spark, tmp_path, log[100:], 1)

    def broken(_):
        raise RuntimeError("lost here")

    with pytest.raises(Exception, match="lost here"):
        take(spark, tmp_path, broken)
    take(spark, tmp_path)
    assert stands(spark, tmp_path) == expected(spark, log)

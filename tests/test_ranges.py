"""Positions and shards at sizes where adaptive execution changes plans, with repeated, hot and missing keys."""

import contextlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import packing, quality, ranges, samples


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(params=["defaults", "small partitions"])
def plans(spark, request):
    small = {"spark__sql__adaptive__coalescePartitions__minPartitionSize": "4k", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k", "spark__sql__shuffle__partitions": "32"}
    with settings(spark, **(small if request.param == "small partitions" else {})):
        yield


@pytest.mark.parametrize("payload", [128, 5000])
def test_wide_rows_keep_their_positions(spark, plans, payload):
    n = 20_000
    rows = spark.range(n).select((n - 1 - F.col("id")).alias("k"), F.rpad(F.md5(F.col("id").cast("string")), payload, "x").alias("data"))
    got = packing.shards_by_count(rows, "k", 100).select("k", "shard")
    assert got.count() == n and got.where("shard <> floor(k / 100)").count() == 0
    assert packing.shards_by_count(rows, "k", 7).agg(F.countDistinct("k"), F.max("shard")).first() == (n, (n - 1) // 7)


def test_200_000_wide_rows(spark):
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 48).alias("data"))
    got = ranges.numbered(rows, "k")
    assert got.where("__pos = k").count() == 200_000


def test_hot_and_missing_keys(spark, plans):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 5000)
    rows = spark.range(60_000).select(key.cast("long").alias("k"), F.map_from_arrays(F.array(F.lit("m")), F.array("id")).alias("m"), "id")
    got = [(r["__pos"], r.k) for r in ranges.numbered(rows, "k").select("__pos", "k").collect()]
    assert sorted(p for p, _ in got) == list(range(60_000))
    assert [k for _, k in sorted(got)] == sorted((k for _, k in got), key=lambda k: (k is not None, k or 0))
    within = ranges.numbered_within(rows.withColumn("g", F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit("b"))), "g", "id").select("g", "id", "__pos", "__n").collect()
    assert len(within) == 60_000
    for g in ("hot", "b", None):
        mine = sorted((r.id, r["__pos"], r["__n"]) for r in within if r.g == g)
        assert [p for _, p, _ in mine] == list(range(len(mine))) and {n for *_, n in mine} == {len(mine)}
    assert ranges.numbered(rows.limit(0), "k").count() == 0
    assert sorted(r["__pos"] for r in ranges.numbered(spark.createDataFrame([(1,)] * 50, "k int"), "k").collect()) == list(range(50))


def test_two_sets_and_run_map_at_size(spark, plans):
    n = 40_000
    a, b = spark.range(0, 2 * n).select(F.col("id").alias("k")), spark.range(n, 3 * n).select(F.col("id").alias("k"))
    got = quality.two_set_columns(a, b, "k")
    assert got.agg(F.count("*"), F.countDistinct("pos"), *[F.count_if(F.col(c) != "") for c in ("only_in_a", "only_in_b", "common")]).first() == (n, n, n, n, n)
    seg = spark.range(n).select(F.concat(F.lit("p"), F.col("id") % 3).alias("person"), F.format_string("run_%d", F.col("id")).alias("token"), F.col("id").alias("g"), F.lit("train").alias("split"))
    assert samples.run_map(seg, "person", "token", "g", "split").agg(F.countDistinct("pos"), F.max("pos")).first() == (n, n - 1)


def streamed(rows, most, per_shard):
    out, state = {}, {}
    for g, k, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        shard, used, held = state.get(g, (0, 0, 0))
        if held and (used + (n or 0) > most or per_shard and held >= per_shard):
            shard, used, held = shard + 1, 0, 0
        state[g] = shard, used + (n or 0), held + 1
        out[g, k] = shard
    return out


@pytest.mark.parametrize("most, per_shard", [(1000, None), (1000, 7), (10**9, 33), (0, None)])
def test_byte_cuts_over_many_ranges(spark, most, per_shard):
    rng = random.Random(most)
    sizes = lambda i: rng.choice([0, 1, 400, 999, 1000, 1001, rng.randrange(300)])
    rows = [(0 if i % 10 < 8 else rng.choice([1, 2, None]), i, None if i % 97 == 0 else sizes(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, k int, size int")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="16"):
        assert ranges.ranged(df, "g", "k").where("g = 0").select("__part").distinct().count() >= 10  # one group over many ranges
        got = {(r.g, r.k): r.shard for r in packing.shards_by_bytes(df, "g", "k", "size", most, per_shard).collect()}
    assert got == streamed(rows, most, per_shard)
    assert packing.shards_by_bytes(df.limit(0), "g", "k", "size", most).count() == 0


def test_range_maps_stay_small():
    import numpy as np

    sizes = np.full(100_000, 10)
    run = packing.carried(sizes, 1000, None)
    assert len(run["ends"]) <= 101  # what fits into one shard, not the range
    for used in (1, 10, 990, 995, 1000):
        assert packing.step((4, used, 1), run, 1000, None)[0] == 4 + -(-(100_000 - (1000 - used) // 10) // 100)

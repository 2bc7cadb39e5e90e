"""Split search over blocks of groups that stay in the cluster, global scores, cubes of frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import frames, signals, split

SCHEMA = "gid string, n long, a array<string>, b array<string>, c array<string>"


def groups_of(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        pick = [[f"{t}{x}" for x in sorted(set(rng.integers(0, most, 3).tolist()))] for t, most in (("p", 2), ("q", 6), ("r", 15))]
        rows.append((f"g{k:04d}", int(rng.integers(1, 50)), *pick))
    return rows


def plain(rows, trials, seed, block):
    """The best (score, trial, splits), with one Python step a group."""
    ratios, top = (0.7, 0.15, 0.15), None
    vocabulary = [{x for r in rows for x in (r[2 + k] or ())} for k in range(3)]
    for trial in range(trials):
        at, dev = {}, [0.0] * 3
        for number in range(0, len(rows), block):
            mine = rows[number : number + block]
            number //= block
            rng = np.random.default_rng([seed, trial, number] if number else [seed, trial])
            left = [sum(r[1] or 0 for r in mine) * x for x in ratios]
            for g, noise in zip(rng.permutation(len(mine)).tolist(), (rng.random((len(mine), 3)) * 0.01).tolist()):
                room = [x + y for x, y in zip(left, noise)]
                s = room.index(max(room))
                at[mine[g][0]] = s
                left[s] -= mine[g][1] or 0
            dev = [x + y for x, y in zip(dev, left)]
        n = [sum(len({x for r in rows if at[r[0]] == s for x in (r[2 + k] or ())}) for s in range(3)) for k in range(3)]
        missing = 3 * len(vocabulary[0]) - n[0]
        score = -1e12 - 1e9 * missing if missing else 1000.0 * n[1] + 100.0 * n[2] - sum(map(abs, dev))
        if top is None or score > top[0] + 1e-6:
            top = score, trial, at
    return top


@pytest.mark.parametrize("block,chunks", [(1000, 1), (1000, 5), (17, 3), (8, 8)])
def test_search_in_blocks(spark, block, chunks):
    rows = groups_of(spark, 50)
    score, trial, at = plain(rows, 40, 9, block)
    got = split.search(spark.createDataFrame(rows[::-1], SCHEMA), "gid", "n", ("a", "b", "c"), trials=40, seed=9, block=block, chunks=chunks).collect()
    assert {r.gid: ("train", "val", "test").index(r.split) for r in got} == at
    assert len(got) == len(rows) and {r.trial for r in got} == {trial} and abs(got[0].score - score) < 1e-6


def test_search_nulls_and_empty(spark):
    rows = [(None, None, None, ["q1", None], []), ("x", 3, ["p1"], ["q1", "q1"], None), ("y", 5, [], None, ["r"])]
    score, trial, at = plain([(g, n, [x for x in a or () if x], [x for x in b or () if x], [x for x in c or () if x]) for g, n, a, b, c in rows], 10, 100, 100)
    got = split.search(spark.createDataFrame(rows, SCHEMA), "gid", "n", ("a", "b", "c"), trials=10).collect()
    assert {r.gid: ("train", "val", "test").index(r.split) for r in got} == at and abs(got[0].score - score) < 1e-6
    assert split.search(spark.createDataFrame([], SCHEMA), "gid", "n", ("a", "b", "c"), trials=10).collect() == []
    with pytest.raises(ValueError, match="add up to 1"):
        split.search(spark.createDataFrame(rows, SCHEMA), "gid", "n", ("a", "b", "c"), ratios=(0.5, 0.1, 0.1))


def test_search_has_no_limit_of_groups(spark):
    """More groups than one block, ids that floating numbers can't hold, no group on the driver or in the plan."""
    big = spark.range(120_000).select((F.col("id") + (1 << 60)).alias("gid"), (F.col("id") % 7).alias("n"), *[F.array(F.concat(F.lit(t), (F.col("id") % m).cast("string"))).alias(t) for t, m in (("a", 2), ("b", 11), ("c", 40))])
    got = split.search(big, "gid", "n", ("a", "b", "c"), trials=2, block=40_000)
    assert str(1 << 60) not in got._jdf.queryExecution().toString()
    shares = {r.split: r.n / 359_994 for r in got.join(big.select("gid", "n"), "gid").groupBy("split").agg(F.sum("n").alias("n")).collect()}
    assert got.select("gid").distinct().count() == 120_000 and all(abs(shares[s] - x) < 0.01 for s, x in zip(("train", "val", "test"), (0.7, 0.15, 0.15)))


def test_scores_over_all_rows(spark):
    rows = [(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0), (4, 9.0, None)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    got = {r.k: (r.x, r.y) for r in signals.zscored(df, "x", "y").collect()}
    mean, sd = np.mean([2, 4, 9]), np.std([2, 4, 9]) + 1e-8
    assert got[3][0] is None and all(abs(got[k][0] - (x - mean) / sd) < 1e-12 for k, x in ((1, 2), (2, 4), (4, 9))) and {v[1] for v in got.values()} == {0.0}
    plan = signals.zscored(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert signals.zscored(df.limit(0), "x").collect() == []


def test_cubes_of_a_hot_group(spark):
    df = spark.range(2003).select(F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 == 9, None).otherwise("cold").alias("g"), (2002 - F.col("id")).alias("t"), F.array("id", F.col("id") * 2).alias("v"))
    got = frames.cubes(df, "g", "t", "v", 100).collect()
    for g in ("hot", "cold", None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.cube)
        want = sorted((r.t, r.v) for r in df.collect() if r.g == g)
        assert [r.cube for r in mine] == list(range(len(mine))) and [len(r.t) for r in mine[:-1]] == [100] * (len(mine) - 1)
        assert [(t, v) for r in mine for t, v in zip(r.t, r.v)] == want
    assert frames.cubes(df.limit(0), "g", "t", "v").collect() == []

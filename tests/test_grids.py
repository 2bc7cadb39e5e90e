"""Grids that explode out of small tables: no plan brings them to the driver, and what is read on them stays as it was."""

import re

import numpy as np

from tessera.operators import signals
from tessera.plans import queries


def broadcast_grids(df) -> list[str]:
    """The broadcasts of the plan that ran under which rows are exploded and not aggregated."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth, above, found = [len(re.match(r"[\s:+\-]*", x)[0]) for x in plan], [], []
    for k, line in enumerate(plan):
        while above and depth[above[-1]] >= depth[k]:
            above.pop()
        if "Generate explode" in line:
            for j in reversed(above):
                if "Aggregate" in plan[j] or "FlatMapGroups" in plan[j]:
                    break
                if "BroadcastExchange" in plan[j]:
                    found.append(plan[j])
        above.append(k)
    return found


def ran(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert df.collect()
    return df


def test_event_run_offsets_broadcast_no_grid(spark, sf001):
    assert broadcast_grids(ran(spark, sf001, "event_run_offsets")) == []


def test_peak_table_broadcasts_no_grid(spark, sf001):
    assert broadcast_grids(ran(spark, sf001, "peak_table")) == []


def test_piecewise_run_offsets_broadcasts_no_grid(spark, sf001):
    assert broadcast_grids(ran(spark, sf001, "piecewise_run_offsets")) == []


def test_interpolated_signals_of_odd_runs(spark):
    rng = np.random.default_rng(5)
    rows = [(r, s, float(t), float(v)) for r, s, n in (("x", "a", 40), ("x", "b", 7), ("y", "a", 1), ("y", "b", 9)) for t, v in zip(np.sort(rng.uniform(0, 50, n)), rng.normal(size=n))]
    rows += [("z", "b", 2.0, 0.5), ("z", "b", 3.0, 1.0), ("z", "b", 3.0, 2.0), ("z", "b", 5.0, 4.0), (None, "a", 1.0, 1.0), ("x", "a", None, 9.0)]
    samples = spark.createDataFrame(rows, "run string, signal string, t double, v double")
    points = spark.createDataFrame([(r, k, k * 1.7 - 5) for r in ("x", "y", "z", "none", None) for k in range(40)], "run string, k int, g double")
    got = signals.interpolate(samples, points, ["run"], "t", "v", "g", "signal", ("a", "b")).collect()
    assert sorted({(r.run, r.k) for r in got}) == [(r, k) for r in "xyz" for k in range(40)] and len(got) == 120
    for run in "xyz":
        mine = sorted((r for r in got if r.run == run), key=lambda r: r.k)
        for s in "ab":
            own = sorted((t, v) for r, n, t, v in rows if (r, n) == (run, s) and t is not None)
            want = np.interp([r.g for r in mine], *zip(*own)) if len(own) > 1 else np.zeros(40)
            assert np.allclose([r[s] for r in mine], want), (run, s)

"""Queries that SQL can't express, against plain versions that share no code with the library."""

import itertools
import math
import zoneinfo
from datetime import UTC, datetime, timedelta

import duckdb
import numpy as np
import pytest

from tessera.plans import queries

SF = "/root/testdata/sf0.01"
NONE = -1e9


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def close(a, b, tolerance=1e-6):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, list):
        return len(a) == len(b) and all(close(x, y, tolerance) for x, y in zip(a, b))
    return a == b if isinstance(a, (str, bool)) else abs(a - b) <= tolerance * max(1, abs(b))


def corr(a, b):
    if len(a) < 2 or np.std(a) * np.std(b) < 1e-13:
        return -1.0
    return float(np.corrcoef(a, b)[0, 1])


def at_shift(t, a, b, d, least):
    use = [k for k in range(len(t)) if t[0] <= t[k] + d <= t[-1]]
    if len(use) < least:
        return NONE
    return corr([a[k] for k in use], [float(np.interp(t[k] + d, t, b)) for k in use])


def z(x):
    x = np.asarray(x, float)
    return np.zeros(len(x)) if np.std(x) < 1e-8 else (x - np.mean(x)) / (np.std(x) + 1e-8)


TIES = {"n": 0}


def best(shifts, curve):
    """(shift, correlation, place) of the first highest; where rounding decides between several, that is counted."""
    top = max(curve)
    TIES["n"] += top > NONE and sum(c >= top - 1e-9 for c in curve) > 1
    k = next(k for k, c in enumerate(curve) if c == top)
    return shifts[k], top, k


def shifts_of(most, step, centre=0.0):
    return [centre - most + step * k for k in range(int(math.floor(2 * most / step + 1e-9)) + 1)]


@pytest.fixture(scope="module")
def pairs(con):
    rows = con.execute(f"""
      SELECT user_id % 5 AS run, floor((epoch_us(ts) - {queries.BASE}) / {queries.HOUR}) AS g,
        coalesce(avg(CASE WHEN event_type = 'click' THEN value END), 0) AS a, coalesce(avg(CASE WHEN event_type = 'view' THEN value END), 0) AS b
      FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL ORDER BY 1, 2""").fetchall()
    out = {}
    for run_, part in itertools.groupby(rows, lambda r: r[0]):
        g, a, b = np.array([r[1:] for r in part], float).T
        out[run_] = g, z(a), z(b)
    return out


def test_global_offset_kernel(spark, pairs):
    got = {r.run: r for r in run(spark, "global_offset_kernel")}
    assert set(got) == set(pairs)
    for k, (t, a, b) in pairs.items():
        least = max(20, int(20.0 / float(np.median(np.diff(t)))))
        shifts = shifts_of(6.0, 0.5)
        d, c, _ = best(shifts, [at_shift(t, a, b, s, least) for s in shifts])
        assert close(got[k].offset, d) and close(got[k].corr, c) and got[k].error is None


def coarse_fine(t, a, b, most, coarse, fine, half):
    first = shifts_of(most, coarse)
    centre, _, _ = best(first, [at_shift(t, a, b, s, 10) for s in first])
    near = [s for s in shifts_of(half, fine, centre) if abs(s) <= most + 1e-12]
    curve = [at_shift(t, a, b, s, 10) for s in near]
    d, c, k = best(near, curve)
    rest = [x for j, x in enumerate(curve) if abs(j - k) > 2]
    lo = hi = k
    while lo and curve[lo - 1] >= c - 0.05:
        lo -= 1
    while hi < len(curve) - 1 and curve[hi + 1] >= c - 0.05:
        hi += 1
    second = max(rest) if rest else NONE
    return d, c, second, c - second, near[hi] - near[lo]


def test_coarse_fine_scan(spark, pairs):
    got = {r.run: r for r in run(spark, "coarse_fine_scan")}
    assert set(got) == set(pairs)
    for k, (t, a, b) in pairs.items():
        d, c, second, margin, width = coarse_fine(t, a, b, 6.0, 0.5, 0.1, 0.5)
        r = got[k]
        assert close([r.offset, r.corr, r.second, r.margin, r.width], [d, c, second, margin, width], 1e-5)
        assert r.is_reliable == (c >= 0.35 and margin >= 0.05 and width <= 0.2)


def pieces(y, most, min_seg, penalty):
    """All ways to cut y into at most most + 1 pieces of min_seg values."""
    n, out = len(y), []
    for m in range(most + 1):
        for cuts in itertools.combinations(range(min_seg, n - min_seg + 1), m):
            edges = [0, *cuts, n]
            if all(q - p >= min_seg for p, q in itertools.pairwise(edges)):
                sse = sum(float(np.sum((np.array(y[p:q]) - np.mean(y[p:q])) ** 2)) for p, q in itertools.pairwise(edges))
                out.append((sse + penalty * m, m, list(cuts), sse))
    return min(out, key=lambda x: (round(x[0], 12), x[1]))


def piecewise(t, a, b, size, hop, most, step, least, min_corr, cuts, scan_least=80):
    found, k = [], 0
    while t[0] + k * hop + size <= t[-1] + 1 + 1e-9:
        start = t[0] + k * hop
        use = [j for j in range(len(t)) if start <= t[j] <= start + size]
        if len(use) >= least:
            shifts = shifts_of(most, step)
            tt, aa, bb = t[use], a[use], b[use]
            d, c, _ = best(shifts, [at_shift(tt, aa, bb, s, min(least, len(use))) for s in shifts])
            found.append((start + size / 2, d if c > NONE else None, c))
        k += 1
    if len(found) < 7:
        dt = float(np.median(np.diff(t)))
        shifts = shifts_of(most, step)
        d, c, _ = best(shifts, [at_shift(t, a, b, s, max(min(least, 80), int(0.8 / dt))) for s in shifts])
        if c <= NONE:
            return None
        return "single", [d], [], len(found)
    kept = [(m, d) for m, d, c in found if d is not None and c >= min_corr]
    if len(kept) < 6:
        known = [d for _, d in kept] or [d for _, d, _ in found if d is not None]
        return "single", [float(np.median(known)) if known else 0.0], [], len(found)
    y = [d for _, d in kept]
    if cuts > 0:
        _, m, where, sse = pieces(y, cuts, 3, 0.05)
        whole = float(np.sum((np.array(y) - np.mean(y)) ** 2))
        if m and (whole - sse) / max(whole, 1e-12) >= 0.25:
            edges = [0, *where, len(y)]
            return "piecewise", [float(np.median(y[p:q])) for p, q in itertools.pairwise(edges)], [(kept[c - 1][0] + kept[c][0]) / 2 for c in where], len(found)
    return "single", [float(np.median(y))], [], len(found)


def test_piecewise_offsets(spark, pairs):
    got = {r.run: r for r in run(spark, "piecewise_offsets")}
    assert set(got) == set(pairs)
    for k, (t, a, b) in pairs.items():
        mode, offsets, changes, n = piecewise(t, a, b, 96.0, 48.0, 4.0, 0.5, 20, 0.2, 2)
        r = got[k]
        assert (r.mode, r.n_windows) == (mode, n) and close(r.offsets, offsets) and close(r.changes, changes)
        q = t + np.array(offsets)[np.searchsorted(changes, t, side="right")]
        read = [float(np.interp(x, t, b)) if t[0] <= x <= t[-1] else 0.0 for x in q]
        assert close(r.corr, corr(a, read))


def on_grid(con, score_first, least_s, least_n):
    """(run -> t, a, b; runs without) of click and view events by user, in hours."""
    rows = con.execute(f"SELECT user_id, event_type, (epoch_us(ts) - {queries.BASE}) / {queries.HOUR}, value FROM events WHERE event_type IN ('click', 'view') ORDER BY 1, 2, 3").fetchall()
    by, good, bad = {}, {}, {}
    for u, kind, t, v in rows:
        by.setdefault(u, {}).setdefault(kind, []).append((t, v))
    for u, kinds in by.items():
        if len(kinds) < 2:
            bad[u] = "one signal only"
            continue
        lo, hi = max(x[0][0] for x in kinds.values()), min(x[-1][0] for x in kinds.values())
        n = math.ceil(hi - lo)
        if hi - lo < least_s:
            bad[u] = "too short"
        elif n < least_n:
            bad[u] = "too few grid points"
        else:
            g, out = np.array([lo + k for k in range(max(n, 0))]), []
            for kind in ("click", "view"):
                t, v = np.array(kinds[kind]).T
                out.append(np.interp(g, t, z(v) if score_first else v))
            good[u] = (g, *(out if score_first else map(z, out)))
    return good, bad


def test_piecewise_run_offsets(spark, con):
    good, bad = on_grid(con, True, 98.0, 40)
    got = {r.run: r for r in run(spark, "piecewise_run_offsets")}
    assert set(got) == {*good, *bad}
    assert {u: got[u].error for u in bad} == bad
    compared = 0
    for u, (t, a, b) in good.items():
        TIES["n"] = 0
        want = piecewise(t, z(a), z(b), 96.0, 48.0, 4.0, 0.5, 67, 0.15, 1)
        assert got[u].n_windows == want[3], u
        if not TIES["n"]:
            compared += 1
            assert got[u].mode == want[0] and close(got[u].offsets, want[1], 1e-5) and close(got[u].changes, want[2], 1e-5), u
    assert compared >= 0.2 * len(good), compared


def test_event_run_offsets(spark, con):
    good, bad = on_grid(con, False, 8.0, 40)
    got = {r.run: r for r in run(spark, "event_run_offsets")}
    assert set(got) == {*good, *bad} and {u: got[u].error for u in bad} == bad
    compared = 0
    for u, (t, a, b) in good.items():
        TIES["n"] = 0
        strong = [x > 0.3 and y > 0.3 for x, y in zip(a, b)]
        mask = [any(strong[max(0, k - 2) : k + 3]) for k in range(len(t))]
        use = np.flatnonzero(mask) if sum(mask) >= 5 else np.arange(len(t))
        d, c, second, margin, width = coarse_fine(t[use], z(a[use]), z(b[use]), 6.0, 0.5, 0.1, 0.5)
        r = got[u]
        assert r.n_used == len(use) and r.low_conf == (sum(mask) < 5) and close(r.event_ratio, sum(mask) / len(mask))
        if not TIES["n"]:
            compared += 1
            assert close([r.offset, r.corr, r.margin, r.width], [d, c, margin, width], 1e-4), u
        assert close(r.corr, c, 1e-4), u
    assert compared >= 0.2 * len(good), compared


def suppressed(peaks, apart, most):
    """(t, height, prominence) by height, prominence and time, each at least `apart` from those before it."""
    taken = []
    for p in sorted(peaks, key=lambda p: (-p[1], -p[2], p[0])):
        if len(taken) < most and all(abs(p[0] - q[0]) >= apart for q in taken):
            taken.append(p)
    return sorted(taken)


def local_peaks(t, v, least, half):
    out = []
    for k in range(len(t)):
        before, after = v[k - 1] if k else None, v[k + 1] if k + 1 < len(v) else None
        if before is None or after is None or not (v[k] >= least and v[k] > before and v[k] >= after):
            continue
        left = [v[j] for j in range(k + 1) if t[j] >= t[k] - half - 1e-9]
        right = [v[j] for j in range(k, len(t)) if t[j] <= t[k] + half + 1e-9]
        out.append((t[k], v[k], v[k] - max(min(left), min(right))))
    return out


def test_peaks_nms(spark, con):
    rows = con.execute("SELECT user_id, epoch_us(ts) / 1e6, value FROM events ORDER BY 1, 2, event_id").fetchall()
    want = []
    for u, part in itertools.groupby(rows, lambda r: r[0]):
        _, t, v = zip(*part)
        want += [(u, *p) for p in suppressed(local_peaks(t, v, 20, 86400.0), 86400.0, 5)]
    got = sorted(tuple(r) for r in run(spark, "peaks_nms"))
    assert len(got) == len(want) and all(close(list(map(float, a)), list(map(float, b)), 1e-9) for a, b in zip(got, sorted(want)))


def test_peak_table(spark, con):
    good, _ = on_grid(con, False, 8.0, 40)
    want = []
    for u, (g, a, b) in good.items():
        for kind, h in (("a", a), ("b", b), ("joint", (a + b) / 2)):
            want += [(u, kind, p[0], p[1], p[2]) for p in suppressed(local_peaks(g, h, 1.0, 3.0), 6.0, 10)]
    got = sorted((r.run, r.kind, r.t, r.height, r.prominence) for r in run(spark, "peak_table"))
    assert len(got) == len(want)
    assert all(x[:2] == y[:2] and close(list(x[2:]), list(y[2:]), 1e-5) for x, y in zip(got, sorted(want)))


def test_tz_convert(spark, con):
    us = dict(con.execute("SELECT event_id, epoch_us(ts) FROM events").fetchall())
    zone, got = zoneinfo.ZoneInfo("Europe/London"), run(spark, "tz_convert")
    assert len(got) == len(us)
    for r in got:
        t = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=us[r.event_id])
        assert r.london == t.astimezone(zone).strftime("%Y%m%d_%H%M%S_%f") and close(r.epoch, us[r.event_id] / 1e6, 1e-12)


def test_split_search(spark, con):
    rows = con.execute("""SELECT (l_suppkey % 4) || '::' || (l_orderkey % 360) % 36 AS gid, split_part(p_name, ' ', 1), p_name, l_returnflag || '_' || l_linestatus
      FROM lineitem JOIN part ON l_partkey = p_partkey""").fetchall()
    groups = {}
    for gid, *labels in rows:
        g = groups.setdefault(gid, [0, set(), set(), set()])
        g[0] += 1
        for s, x in zip(g[1:], labels):
            s.add(x)
    ids = sorted(groups)
    total = sum(g[0] for g in groups.values())
    first = {"t1": set().union(*(g[1] for g in groups.values()))}
    top = None
    for trial in range(400):
        rng = np.random.default_rng([100, trial])
        left, at = [total * r for r in (0.7, 0.15, 0.15)], {}
        for g, noise in zip(rng.permutation(len(ids)).tolist(), (rng.random((len(ids), 3)) * 0.01).tolist()):
            room = [x + n for x, n in zip(left, noise)]
            s = room.index(max(room))
            at[ids[g]] = s
            left[s] -= groups[ids[g]][0]
        cover = [[set().union(*(groups[g][k] for g in ids if at[g] == s)) for s in range(3)] for k in (1, 2, 3)]
        missing = sum(len(first["t1"] - c) for c in cover[0])
        score = -1e12 - 1e9 * missing if missing else 1000.0 * sum(map(len, cover[1])) + 100.0 * sum(map(len, cover[2])) - sum(map(abs, left))
        if top is None or score > top[0] + 1e-9:
            top = score, trial, at
    got = run(spark, "split_search")
    assert {r.gid: ("train", "val", "test").index(r.split) for r in got} == top[2] and {r.trial for r in got} == {top[1]} and close(got[0].score, top[0])


def streams(con):
    rows = con.execute("SELECT user_id, epoch_us(ts), value FROM events ORDER BY 1, 2").fetchall()
    return {u: ([r[1] for r in p], np.array([r[2] for r in p])) for u, p in ((u, list(g)) for u, g in itertools.groupby(rows, lambda r: r[0]))}


def polynomials(cut, fs, order, high):
    """Numerator and denominator of a Butterworth filter, from its analogue poles by the bilinear transform."""
    w = math.tan(math.pi * cut / fs)
    poles = [w * np.exp(1j * math.pi * (2 * k + order + 1) / (2 * order)) for k in range(order)]
    if high:
        poles = [w * w / p for p in poles]
    inside = np.real(np.poly([(1 + p) / (1 - p) for p in poles]))
    zeros = np.poly([1.0 if high else -1.0] * order)
    return zeros * np.polyval(inside, -1.0 if high else 1.0) / np.polyval(zeros, -1.0 if high else 1.0), inside


def both_ways(systems, x, sections):
    """Forward and backward by difference equations, each filter from its steady state for the first value."""
    n = min(len(x) - 1, 3 * (2 * sections + 1))
    y = [*(2 * x[0] - x[k] for k in range(n, 0, -1)), *x, *(2 * x[-1] - x[-k] for k in range(2, n + 2))]
    for _ in range(2):
        for b, a in systems:
            past_x, past_y = [y[0]] * (len(b) - 1), [y[0] * sum(b) / sum(a)] * (len(a) - 1)
            out = []
            for v in y:
                u = (b[0] * v + sum(p * q for p, q in zip(b[1:], past_x)) - sum(p * q for p, q in zip(a[1:], past_y))) / a[0]
                past_x, past_y = [v, *past_x[:-1]], [u, *past_y[:-1]]
                out.append(u)
            y = out
        y = y[::-1]
    return y[n : len(y) - n]


def test_emg_filter(spark, con):
    got = {}
    for r in run(spark, "emg_filter"):
        got.setdefault(r.user_id, []).append((r.us, r.value))
    all_ = streams(con)
    assert set(got) == set(all_) and sum(map(len, got.values())) == sum(len(t) for t, _ in all_.values())
    w = 2 * math.pi * 50 / 1000.0
    spread = math.tan(w / 60)  # quality 30
    hum = [1, -2 * math.cos(w), 1], [1 + spread, -2 * math.cos(w), 1 - spread]
    for u in sorted(all_)[:25]:
        t, x = all_[u]
        y = both_ways([polynomials(50, 1000.0, 4, True), polynomials(450, 1000.0, 4, False)], x - x.mean(), 4)
        y = both_ways([hum], np.array(y), 1)
        mine = sorted(got[u])
        assert [m[0] for m in mine] == t and np.allclose([m[1] for m in mine], y, rtol=1e-4, atol=1e-5), u


def test_emg_resample(spark, con):
    got = {}
    for r in run(spark, "emg_resample"):
        got.setdefault(r.user_id, {})[r.i] = r.value
    all_ = streams(con)
    assert set(got) == set(all_)
    up, down, half = 2, 5, 50
    raw = {k: (math.sin(math.pi * k / 5) / (math.pi * k / 5) if k else 1.0) / 5 * float(np.i0(5.0 * math.sqrt(1 - (k / half) ** 2)) / np.i0(5.0)) for k in range(-half, half + 1)}
    scale = up / sum(raw.values())
    for u, (_, x) in all_.items():
        n = -(-len(x) * up // down)
        assert sorted(got[u]) == list(range(n))
        for m in range(n):
            y = sum(x[k] * raw[m * down - k * up] * scale for k in range(len(x)) if abs(m * down - k * up) <= half)
            assert close(got[u][m], float(y), 1e-7)

"""Clock offsets between two motion signals: scans, windows, change points, peaks. numpy kernels, one group a run.

Groups are the grid samples of one run of one subject; a run lasts minutes, so a group is bounded by the recording, not by
the dataset. Errors are rows with an error, never a failed stage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

NONE_VALID = -1e9


def corr(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a):
        return -1.0
    a, b = a - a.mean(), b - b.mean()
    d = np.sqrt((a * a).sum() * (b * b).sum())
    return -1.0 if d < 1e-12 else float((a * b).sum() / d)


def zscore(x: np.ndarray) -> np.ndarray:
    sd = x.std()
    return np.zeros_like(x) if sd < 1e-8 else (x - x.mean()) / (sd + 1e-8)


def curve(t: np.ndarray, a: np.ndarray, b: np.ndarray, shifts: np.ndarray, least: int) -> np.ndarray:
    """corr of a(t) with b(t + shift) where t + shift lies in t's range."""
    out = np.full(len(shifts), NONE_VALID)
    for k, d in enumerate(shifts):
        q = t + d
        inside = (q >= t[0]) & (q <= t[-1])
        if inside.sum() >= least:
            out[k] = corr(a[inside], np.interp(q[inside], t, b))
    return out


def steps(most: float, step: float, centre: float = 0.0) -> np.ndarray:
    n = int(np.floor(2 * most / step + 1e-9))
    return centre - most + step * np.arange(n + 1)


def scan(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: float = 2.0, step: float = 0.01, least_s: float = 0.8, least_n: int = 80) -> tuple[float, float]:
    dt = float(np.median(np.diff(t))) if len(t) > 1 else 1.0
    shifts = steps(most, step)
    c = curve(t, a, b, shifts, max(least_n, int(least_s / dt)))
    k = int(np.argmax(c))
    return (0.0, NONE_VALID) if c[k] <= NONE_VALID else (float(shifts[k]), float(c[k]))


def coarse_fine(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: float = 2.0, coarse: float = 0.02, fine: float = 0.005, half: float = 0.15) -> dict:
    first = steps(most, coarse)
    c = curve(t, a, b, first, 10)
    centre = first[int(np.argmax(c))]
    shifts = steps(half, fine, centre)
    shifts = shifts[np.abs(shifts) <= most + 1e-12]
    c = curve(t, a, b, shifts, 10)
    k = int(np.argmax(c))
    others = np.delete(c, np.arange(max(0, k - 2), min(len(c), k + 3)))
    second = float(others.max()) if len(others) else NONE_VALID
    lo = hi = k
    while lo > 0 and c[lo - 1] >= c[k] - 0.05:
        lo -= 1
    while hi + 1 < len(c) and c[hi + 1] >= c[k] - 0.05:
        hi += 1
    width = float(shifts[hi] - shifts[lo])
    return {"offset": float(shifts[k]), "corr": float(c[k]), "second": second, "margin": float(c[k] - second), "width": width}


def reliable(r: dict, event_ratio: float = 1.0) -> bool:
    return r["corr"] >= 0.35 and r["margin"] >= 0.05 and event_ratio >= 0.01 and r["width"] <= 0.20


def change_points(y: np.ndarray, most: int, min_seg: int, penalty: float) -> tuple[list[int], float, float]:
    """(cuts, squared error, cost) of the best piecewise constant fit; fewer pieces win ties. Cut i starts a piece at i."""
    n = len(y)
    s, q = np.concatenate([[0.0], np.cumsum(y)]), np.concatenate([[0.0], np.cumsum(y * y)])
    if n < min_seg:
        return [], float("inf") if n else 0.0, float("inf") if n else 0.0

    def error(i, j):
        return q[j] - q[i] - (s[j] - s[i]) ** 2 / (j - i)

    pieces = min(most + 1, max(1, n // max(1, min_seg)))
    best = np.full((pieces + 1, n + 1), np.inf)
    came = np.zeros((pieces + 1, n + 1), int)
    ends = np.arange(min_seg, n + 1)
    best[1, ends] = error(0, ends)
    for m in range(2, pieces + 1):
        for j in range(m * min_seg, n + 1):
            i = np.arange((m - 1) * min_seg, j - min_seg + 1)
            cost = best[m - 1, i] + error(i, j) + penalty
            k = int(np.argmin(cost))
            best[m, j], came[m, j] = cost[k], i[k]
    m = int(np.argmin(best[1:, n])) + 1
    cuts, j = [], n
    for k in range(m, 1, -1):
        j = int(came[k, j])
        cuts.append(j)
    return cuts[::-1], float(best[m, n] - penalty * (m - 1)), float(best[m, n])


def decide(centres: np.ndarray, offsets: np.ndarray, corrs: np.ndarray, min_corr: float = 0.2, most: int = 2, min_seg: int = 3, penalty: float = 0.05, min_gain: float = 0.25) -> dict:
    """One offset, or one a piece with the times of change between neighbouring windows."""
    finite = np.isfinite(offsets)
    keep = finite & np.isfinite(corrs) & (corrs >= min_corr)
    middle = float(np.median(offsets[finite])) if finite.any() else 0.0
    if keep.sum() < max(2 * min_seg, 1):
        return {"mode": "single", "reason": "few windows", "offsets": [float(np.median(offsets[keep])) if keep.any() else middle], "changes": []}
    c, y = centres[keep], offsets[keep]
    single = {"mode": "single", "offsets": [float(np.median(y))], "changes": []}
    if most <= 0:
        return single | {"reason": "no change points asked for"}
    cuts, sse, _ = change_points(y, most, min_seg, penalty)
    whole = float(((y - y.mean()) ** 2).sum())
    if not cuts or (whole - sse) / max(whole, 1e-12) < min_gain:
        return single | {"reason": "no gain"}
    edges = [0, *cuts, len(y)]
    return {"mode": "piecewise", "reason": "", "offsets": [float(np.median(y[a:b])) for a, b in zip(edges, edges[1:])], "changes": [float((c[k - 1] + c[k]) / 2) for k in cuts]}


def final_corrs(t: np.ndarray, a: np.ndarray, b: np.ndarray, offsets: list[float], changes: list[float]) -> tuple[list[float], float]:
    """corr of each piece (-1 under 10 points) and of the whole, with b read at each piece's offset."""
    piece = np.searchsorted(np.asarray(changes), t, side="right")
    q = t + np.asarray(offsets)[piece]
    inside = (q >= t[0]) & (q <= t[-1])
    got = np.where(inside, np.interp(q, t, b), np.nan)
    each = [corr(a[(piece == k) & inside], got[(piece == k) & inside]) if ((piece == k) & inside).sum() >= 10 else -1.0 for k in range(len(offsets))]
    return each, corr(a, np.nan_to_num(got))


def windows(t: np.ndarray, size: float, hop: float, least: int):
    """(centre, places) of whole windows, closed at both ends, of at least so many points."""
    k = 0
    while t[0] + k * hop + size <= t[-1] + 1 + 1e-9:
        at = t[0] + k * hop
        inside = np.flatnonzero((t >= at) & (t <= at + size))
        if len(inside) >= least:
            yield at + size / 2, inside
        k += 1


def nms(t: np.ndarray, height: np.ndarray, prominence: np.ndarray, apart: float, most: int) -> np.ndarray:
    """Places of peaks taken by height, then prominence, at least `apart` from all taken before; in order of time."""
    taken: list[int] = []
    for k in np.lexsort((t, -prominence, -height)):
        if all(abs(t[k] - t[j]) >= apart for j in taken):
            taken.append(int(k))
            if len(taken) >= most:
                break
    return np.array(sorted(taken, key=lambda k: t[k]), int)


def per_run(df: DataFrame, keys: list[str], kernel, schema: str) -> DataFrame:
    """kernel(pdf sorted by g, with columns g, a, b) -> dict of columns; errors become the column error."""
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    names = [c.strip().split()[0] for c in _columns(schema)]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {k: pdf[k].iloc[0] for k in keys} | dict.fromkeys(names)
        try:
            pdf = pdf.sort_values("g")
            row |= kernel(pdf["g"].to_numpy(float), pdf["a"].to_numpy(float), pdf["b"].to_numpy(float)) | {"error": None}
        except Exception as e:  # noqa: BLE001  one bad run must not fail the others
            row["error"] = f"{type(e).__name__}: {e}"
        return pd.DataFrame([row])

    return df.groupBy(*keys).applyInPandas(run, f"{fields}, {schema}, error string")


def _columns(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for k, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:k])
            start = k + 1
    return [*out, schema[start:]]


def global_offsets(df: DataFrame, keys: list[str], **options) -> DataFrame:
    def kernel(t, a, b):
        d, c = scan(t, zscore(a), zscore(b), **options)
        return {"offset": d, "corr": c}

    return per_run(df, keys, kernel, "offset double, corr double")


def coarse_fine_offsets(df: DataFrame, keys: list[str], **options) -> DataFrame:
    def kernel(t, a, b):
        r = coarse_fine(t, zscore(a), zscore(b), **options)
        return r | {"is_reliable": reliable(r)}

    return per_run(df, keys, kernel, "offset double, corr double, second double, margin double, width double, is_reliable boolean")


def piecewise_offsets(df: DataFrame, keys: list[str], size: float = 15.0, hop: float = 10.0, most: float = 2.0, step: float = 0.01, least: int = 80, cuts: int = 2, min_seg: int = 3, **options) -> DataFrame:
    """Window scans, the single-or-piecewise decision, final correlations and the drift (least squares over windows) of each run.
    With fewer than 2 * min_seg + 1 windows the whole run is scanned instead."""

    def kernel(t, a, b):
        if len(t) < 2:
            raise ValueError("too few points to scan")
        za, zb = zscore(a), zscore(b)
        dt = float(np.median(np.diff(t)))
        got = [(c, *scan(t[i], za[i], zb[i], most, step, 0.0, min(least, len(i)))) for c, i in windows(t, size, hop, least)]
        c, d, r = np.array(got, float).reshape(-1, 3).T
        d = np.where(r > NONE_VALID, d, np.nan)
        if len(got) < 2 * min_seg + 1:
            offset, found = scan(t, za, zb, most, step, 0.8, min(least, 80))
            if found <= NONE_VALID:
                raise ValueError("too few points to scan")
            choice = {"mode": "single", "reason": "few windows, whole run scanned", "offsets": [offset], "changes": []}
        else:
            choice = decide(c, d, r, most=cuts, min_seg=min_seg, **options)
        each, whole = final_corrs(t, za, zb, choice["offsets"], choice["changes"])
        ok = np.isfinite(d)
        slope, base = np.polyfit(c[ok], d[ok], 1) if ok.sum() >= 2 else (0.0, float(d[ok][0]) if ok.any() else 0.0)
        return choice | {"n_windows": len(got), "corrs": each, "corr": whole, "drift": float(slope), "drift_base": float(base), "dt": dt}

    return per_run(df, keys, kernel, "mode string, reason string, offsets array<double>, changes array<double>, n_windows int, corrs array<double>, corr double, drift double, drift_base double, dt double")


def mean_edge(x: np.ndarray, w: int) -> np.ndarray:
    """Centred mean of w values, the end values repeated beyond the ends; (w - 1) // 2 reach back."""
    if w <= 1 or not len(x):
        return x
    back = (w - 1) // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(x, (back, w - 1 - back), mode="edge"), w).mean(-1)


def smoothed(df: DataFrame, keys: list[str], t: str, seconds: dict[str, float], least: int = 3, step: str | None = None) -> DataFrame:
    """df with the columns of `seconds` smoothed by mean_edge over so many seconds, in rows of the run's median step (of column step
    or of t). The width differs by run, which a window frame can't express. Runs of fewer than `least` rows stay as they are."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t)
        if len(pdf) >= least:
            dt = float(np.median(pdf[step])) if step else float(np.median(np.diff(pdf[t])))
            for c, s in seconds.items():
                if s > 0:
                    pdf[c] = mean_edge(pdf[c].to_numpy(float), max(1, round(s / max(dt, 1e-6))))
        return pdf

    return df.groupBy(*keys).applyInPandas(run, df.schema) if any(s > 0 for s in seconds.values()) else df


def manual_offsets(df: DataFrame, keys: list[str], shift: float) -> DataFrame:
    """The given offset for each run; nothing is scanned, so corr is null."""
    from pyspark.sql import functions as F

    return df.select(*keys).distinct().withColumns({"offset": F.lit(float(shift)), "corr": F.lit(None).cast("double")})


def peak_records(df: DataFrame, keys: list[str], apart: float = 0.3, most: int = 10) -> DataFrame:
    """keys, t, height, prominence of the peaks that stay after suppression. df: keys, t, height, prominence of all local peaks."""
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = nms(pdf["t"].to_numpy(float), pdf["height"].to_numpy(float), pdf["prominence"].to_numpy(float), apart, most)
        return pdf.iloc[at][[*keys, "t", "height", "prominence"]]

    return df.groupBy(*keys).applyInPandas(run, f"{fields}, t double, height double, prominence double")

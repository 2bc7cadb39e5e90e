"""Filters and resampling of armband signals in plain numpy, one group a recording."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def butterworth(order: int, fs: float, low: float | None = None, high: float | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Second-order sections (b, a) of a low-pass (high only), high-pass (low only) or band-pass: a high-pass and a low-pass in a row."""
    out = []
    for cut, kind in ((low, "high"), (high, "low")):
        if cut is None:
            continue
        w = math.tan(math.pi * cut / fs)
        for k in range(order // 2):
            q = 1 / (2 * math.sin(math.pi * (2 * k + 1) / (2 * order)))
            n = 1 / (1 + w / q + w * w)
            b = np.array([1, -2, 1]) * n if kind == "high" else np.array([1, 2, 1]) * w * w * n
            out.append((b, np.array([1, 2 * (w * w - 1) * n, (1 - w / q + w * w) * n])))
        if order % 2:
            n = 1 / (1 + w)
            b = np.array([1, -1, 0]) * n if kind == "high" else np.array([1, 1, 0]) * w * n
            out.append((b, np.array([1, (w - 1) * n, 0])))
    return out


def notch(fs: float, f0: float = 50.0, q: float = 30.0) -> list[tuple[np.ndarray, np.ndarray]]:
    w = 2 * math.pi * f0 / fs
    g = 1 / (1 + math.tan(w / (2 * q)))
    return [(g * np.array([1, -2 * math.cos(w), 1]), np.array([1, -2 * g * math.cos(w), 2 * g - 1]))]


def run_section(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One section from its steady state for the first value."""
    y = np.empty_like(x)
    gain = b.sum() / a.sum()
    z2 = b[2] * x[0] - a[2] * gain * x[0]
    z1 = b[1] * x[0] - a[1] * gain * x[0] + z2
    b0, b1, b2 = map(float, b)
    a1, a2 = map(float, a[1:])
    for k, v in enumerate(x.tolist()):
        u = b0 * v + z1
        z1 = b1 * v - a1 * u + z2
        z2 = b2 * v - a2 * u
        y[k] = u
    return y


def zero_phase(sections: list, x: np.ndarray) -> np.ndarray:
    """Forward and backward, with odd extension at the ends."""
    if len(x) < 2:
        return x.copy()
    n = min(len(x) - 1, 3 * (2 * len(sections) + 1))
    y = np.concatenate([2 * x[0] - x[n:0:-1], x, 2 * x[-1] - x[-2 : -n - 2 : -1]])
    for _ in range(2):
        for b, a in sections:
            y = run_section(b, a, y)
        y = y[::-1]
    return y[n : len(y) - n]


def clean_emg(x: np.ndarray, fs: float, band: tuple[float, float] = (50, 450), order: int = 4, notches: tuple[float, ...] = (50.0,), q: float = 30.0) -> np.ndarray:
    """Mean off, band-pass (low at least 0.1, high at most 0.9 of half the rate), notches."""
    y = x - x.mean()
    y = zero_phase(butterworth(order, fs, max(0.1, band[0]), min(band[1], 0.9 * fs / 2)), y)
    for f in notches:
        if f < fs / 2:
            y = zero_phase(notch(fs, f, q), y)
    return y


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """By up / down through a windowed sinc."""
    g = math.gcd(up, down)
    up, down = up // g, down // g
    if up == down:
        return x.copy()
    half = 10 * max(up, down)
    k = np.arange(-half, half + 1)
    h = np.sinc(k / max(up, down)) / max(up, down) * np.kaiser(2 * half + 1, 5.0)
    h *= up / h.sum()
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    y = np.convolve(wide, h)[half : half + len(wide)]
    return y[::down][: -(-len(x) * up // down)]


def filtered(df: DataFrame, keys: list[str], t: str, x: str, fs: float, **options) -> DataFrame:
    """df with x filtered, by keys in order of t."""
    schema = df.select(*keys, t, x).schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t)[[*keys, t, x]]
        return pdf.assign(**{x: clean_emg(pdf[x].to_numpy(float), fs, **options)})

    return df.select(*keys, t, x).groupBy(*keys).applyInPandas(run, schema)


def resampled(df: DataFrame, keys: list[str], t: str, x: str, fs: float, target: float) -> DataFrame:
    """keys, i, x at the target rate; times follow from i / target."""
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = resample(pdf.sort_values(t)[x].to_numpy(float), round(target), round(fs))
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "i": np.arange(len(y)), x: y})

    return df.groupBy(*keys).applyInPandas(run, f"{fields}, i long, {x} double")

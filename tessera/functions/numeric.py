"""Arithmetic on arrays, point clouds and radar packets, as Column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def l1(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def norm3(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def rectified_mean(a: Column) -> Column:
    return total(F.transform(a, lambda x: F.abs(x))) / F.size(a)


def amplitude(i: Column, q: Column) -> Column:
    return F.zip_with(i, q, lambda a, b: F.sqrt(a.cast("double") * a + b.cast("double") * b))


def phase(i: Column, q: Column) -> Column:
    return F.zip_with(i, q, lambda a, b: F.atan2(b.cast("double"), a.cast("double")))


def decibel(x: Column) -> Column:
    """10 log10 |x|; null at 0."""
    return F.when(x != 0, 10 * F.log10(F.abs(x)))


def histogram(values: Column, top: float, bins: int) -> Column:
    """Densities over [0, top] in equal bins, the last closed at top; zeros where nothing falls in."""
    width = top / bins
    inside = F.filter(values, lambda v: (v >= 0) & (v <= top))
    codes = F.transform(inside, lambda v: F.least(F.floor(v.cast("double") / width), F.lit(bins - 1)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(codes, lambda c: c == b)))
    return F.transform(counts, lambda n: F.when(F.size(inside) > 0, n / (F.size(inside) * F.lit(width))).otherwise(F.lit(0.0)))


def rotation(yaw: float, pitch: float, roll: float) -> list[list[float]]:
    """The product of turns about z, y and x (degrees)."""
    a, b, c = (math.radians(x) for x in (yaw, pitch, roll))
    z = [[math.cos(a), -math.sin(a), 0.0], [math.sin(a), math.cos(a), 0.0], [0.0, 0.0, 1.0]]
    y = [[math.cos(b), 0.0, math.sin(b)], [0.0, 1.0, 0.0], [-math.sin(b), 0.0, math.cos(b)]]
    x = [[1.0, 0.0, 0.0], [0.0, math.cos(c), -math.sin(c)], [0.0, math.sin(c), math.cos(c)]]
    dot = lambda p, q: [[sum(p[i][k] * q[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    return dot(dot(z, y), x)


def rotated(x: Column, y: Column, z: Column, matrix: list[list[float]]) -> list[Column]:
    return [m[0] * x + m[1] * y + m[2] * z for m in ([F.lit(v) for v in row] for row in matrix)]


def unit_range(x: Column, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); 0 where the range is empty."""
    return F.when(high > low, (x - low) / (high - low)).otherwise(F.lit(0.0))


def clip_to_byte(x: Column, low: Column, high: Column) -> Column:
    return (F.least(F.greatest(unit_range(x, low, high), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")


def padded(a: Column, size: Column, fill: Column) -> Column:
    return F.concat(a, F.array_repeat(fill, F.greatest(size - F.size(a), F.lit(0))))


def tar_bytes(size: Column) -> Column:
    """What a member of so many bytes takes in a tar file: a header block and whole blocks."""
    n = F.greatest(size.cast("long"), F.lit(0).cast("long"))
    return F.lit(512).cast("long") + (n + F.pmod(-n, F.lit(512)))


def doppler_axis(start: float, step: float) -> list[float]:
    """Frequencies from start up to 0, then on to |start|, by step."""
    n = round(abs(start) / step)
    return [start + k * step for k in range(n)] + [k * step for k in range(n)]


RADAR_BIN_M = 8 * 1.5e8 / 23.328e9


def range_axis(start: float, bins: int, width: float = RADAR_BIN_M) -> list[float]:
    return [start - 1e-5 + k * width for k in range(bins)]


def polymorphic_path(obj: Column, keys: tuple[str, ...] = ("npy_path", "path")) -> Column:
    """A path that is given as a JSON string, or in an object under the first key that it has."""
    as_object = F.coalesce(*[F.get_json_object(obj, f"$.{k}") for k in keys])
    return F.when(obj.startswith("{"), as_object).otherwise(F.regexp_replace(obj, '^"|"$', ""))


def list_literal(text: Column) -> Column:
    return F.from_json(text, "array<double>")

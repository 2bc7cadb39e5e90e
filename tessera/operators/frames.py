"""Frames as rows: order, ranges, crops, distance limits, thinning, parameter sets, packed arrays."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.timeparse import micros, stamp
from tessera.operators.ranges import numbered_within


def numbered_frames(files: DataFrame, keys: list[str], name: str) -> DataFrame:
    """files with place, from 0 in each of the keys: by the time in the name, those without one last, by name."""
    at = micros(stamp(F.col(name)))
    order = Window.partitionBy(*keys).orderBy(at.isNull(), at, name)
    return files.withColumn("place", F.row_number().over(order) - 1)


def frame_range(files: DataFrame, keys: list[str], name: str, first: int, end: int) -> DataFrame:
    """The frames from place `first` on, before `end`."""
    return numbered_frames(files, keys, name).where((F.col("place") >= first) & (F.col("place") < end))


def crop(pixels: Column, width: int, left: int, top: int, right: int, bottom: int) -> Column:
    """The box of an image given row by row; right and bottom are outside."""
    return F.flatten(F.transform(F.sequence(F.lit(top), F.lit(bottom - 1)), lambda y: F.slice(pixels, y * width + left + 1, F.lit(right - left))))


def without_background(values: Column, depth: Column, clip: float, fill: float = 153.0) -> Column:
    """values, with fill where the depth is negative or beyond clip."""
    return F.zip_with(values, depth, lambda v, d: F.when((d > clip) | (d < 0), F.lit(fill)).otherwise(v.cast("double")))


def within_distance(depth: Column, low: float, high: float) -> Column:
    """Depths in [low, high]; 0 (no reading) elsewhere."""
    return F.transform(depth, lambda d: F.when(d.between(low, high), d.cast("double")).otherwise(F.lit(0.0)))


def thinned(points: DataFrame, keys: list[str], point: str, most: int = 80_000, seed: int = 42) -> DataFrame:
    """At most `most` points of each frame, without replacement: those of least digest under the seed, so reruns agree."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(point).cast("string")))
    order = Window.partitionBy(*keys).orderBy(digest, point)
    return points.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most).drop("__n")


def cubes(frames: DataFrame, group: str, order: str, values: str, per_cube: int = 256) -> DataFrame:
    """group, cube (from 0), order, values: per_cube frames in order in each cube, the last may have fewer. A group may hold any share of the frames."""
    placed = numbered_within(frames.select(group, order, values), group, order)
    entry = F.array_sort(F.collect_list(F.struct("__pos", order, values)))
    each = placed.groupBy(group, F.floor(F.col("__pos") / per_cube).cast("long").alias("cube")).agg(entry.alias("__c"))
    return each.select(group, "cube", *[F.col(f"__c.{c}").alias(c) for c in (order, values)])


def parameter_sets(rows: DataFrame, columns: list[str], order: str) -> DataFrame:
    """name, value, first_at (least order), n of the distinct settings: sort by value, or by first_at for the order of appearance."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns]))
    return rows.select(F.col(order).alias("__o"), each.alias("s")).groupBy("s.name", "s.value").agg(F.min("__o").alias("first_at"), F.count("*").alias("n"))


def packed_npy(frames: DataFrame, keys: list[str], order: str, values: str, least: int = 1, fill: float | None = 0.0, dtype: str = "float32") -> DataFrame:
    """keys, shape, npy (the bytes of a .npy file): the frames of a clip as (frames, rows, columns), padded with fill to the most rows.

    values: array<array<double>>. Without fill, frames of unlike numbers of rows are an error; so are unlike numbers of columns and
    fewer than `least` frames. Errors are rows.
    """
    fields = ", ".join(f"{k} {frames.schema[k].dataType.simpleString()}" for k in keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {k: pdf[k].iloc[0] for k in keys} | {"shape": None, "npy": None, "error": None}
        a = [np.array([list(r) for r in v], dtype) for v in pdf.sort_values(order)[values]]
        columns, rows = {x.shape[1] for x in a if x.size}, [len(x) for x in a]
        if len(a) < least:
            out["error"] = f"{len(a)} frames"
        elif len(columns) > 1:
            out["error"] = f"columns differ: {sorted(columns)}"
        elif fill is None and len(set(rows)) > 1:
            out["error"] = "numbers of rows differ"
        else:
            whole = np.full((len(a), max(rows), *columns) if columns else (len(a), 0, 0), 0.0 if fill is None else fill, dtype)
            for k, x in enumerate(a):
                if x.size:
                    whole[k, : len(x)] = x
            buffer = io.BytesIO()
            np.save(buffer, whole)
            out |= {"shape": list(whole.shape), "npy": buffer.getvalue()}
        return pd.DataFrame([out])

    return frames.groupBy(*keys).applyInPandas(run, f"{fields}, shape array<int>, npy binary, error string")


def sampled_percentiles(frames: DataFrame, keys: list[str], order: str, values: str, low: float = 0.01, high: float = 0.99, first: int = 50, per_frame: int = 5000, accuracy: int | None = None) -> DataFrame:
    """keys, n, low, high: percentiles of the keys' first frames that have values, of each of which every step-th value counts, the step being their number over per_frame, rounded down, at least 1.

    Where high isn't above low they are the least and the greatest value plus 1e-6. Null and NaN values don't count, but have their place. With an
    accuracy, percentiles come from a quantile sketch that merges before rows move (an error of 1 / accuracy in rank), else they are exact.
    """
    by_order = Window.partitionBy(*keys).orderBy(order)
    places = frames.where(F.col(order).isNotNull()).select(*keys, order).distinct().withColumn("__k", F.row_number().over(by_order)).where(F.col("__k") <= first).drop("__k")
    kept = frames.withColumn("__none", F.coalesce(F.size(values), F.lit(0)) <= 0)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    places = places.select(F.col(order).alias("__order"), *[F.col(k).alias(f"__{k}") for k in keys])
    rows = kept.join(places, same & (F.col(order) == F.col("__order"))).where(~F.col("__none"))
    step = F.greatest(F.floor(F.size(values) / per_frame).cast("int"), F.lit(1))
    taken = F.filter(values, lambda v, i: F.pmod(i, step) == 0)
    each = rows.select(*keys, F.explode(taken.cast("array<double>")).alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    ps = F.array(F.lit(low), F.lit(high))
    found = F.percentile("__v", ps) if accuracy is None else F.percentile_approx("__v", ps, accuracy)
    got = each.groupBy(*keys).agg(F.count("*").alias("n"), found.alias("__p"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    flat = F.get("__p", F.lit(1)) <= F.get("__p", F.lit(0))
    return got.select(*keys, "n", F.when(flat, F.col("__min")).otherwise(F.get("__p", F.lit(0))).alias("low"), F.when(flat, F.col("__max") + 1e-6).otherwise(F.get("__p", F.lit(1))).alias("high"))

"""From recordings to clock offsets: motion signals of frames, clouds and armbands, and one result row a run.

Rows of all runs go through the same plan, keyed by run; a run is bounded by its recording. Runs that can't be estimated are
rows with an error.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric
from tessera.operators import align, intervals, signals

FEATURES = ("histdiff", "centroid", "count")
MODES = ("fusion", "emg", "imu")


def _known(value: str, known: tuple[str, ...]) -> None:
    if value not in known:
        raise ValueError(f"{value} is none of {known}")


def image_motion(frames: DataFrame, keys: list[str], t: str = "t", pixels: str = "pixels", threshold: float = 0, smooth_s: float = 0.2) -> DataFrame:
    """keys, t (midpoint), motion: the mean absolute change of grey values from the frame before, or the share of pixels that
    change by more than threshold. Unreadable frames (null pixels) are passed over."""
    w = signals.by(keys, t)
    rows = frames.where(F.col(pixels).isNotNull()).select(*keys, F.col(t).alias("t1"), F.col(pixels).alias("a"), F.lag(t).over(w).alias("t0"), F.lag(pixels).over(w).alias("b"))
    gap = F.zip_with("a", "b", lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    change = numeric.total(gap if threshold <= 0 else F.transform(gap, lambda g: (g > threshold).cast("int"))) / F.size("a")
    rows = rows.where("t1 > t0 and size(a) = size(b) and size(a) > 0").select(*keys, ((F.col("t0") + F.col("t1")) / 2).alias("t"), change.alias("motion"))
    return align.smoothed(rows, keys, "t", {"motion": smooth_s})


def cloud_features(points: DataFrame, keys: list[str], t: str, feature: str, bins: int = 40, top: float = 3.0, least: int = 50) -> DataFrame:
    """keys, t, feature (array) of each frame: range histogram, centroid or count; null where fewer than `least` points count."""
    _known(feature, FEATURES)
    r = numeric.norm3(*[F.col(c) for c in "xyz"])
    if feature == "count":
        value, n = F.array(F.count("*").cast("double")), F.count("*")
    elif feature == "centroid":
        value, n = F.array(*[F.avg(c) for c in "xyz"]), F.count("*")
    else:
        points = points.withColumn("__b", F.when(r <= top, F.least(F.floor(r / (top / bins)), F.lit(bins - 1)).cast("int")))
        n = F.count("__b")
        value = F.array(*[F.count_if(F.col("__b") == k).cast("double") for k in range(bins)])
    got = points.groupBy(*keys, t).agg(n.alias("__n"), value.alias("feature"))
    if feature == "histdiff":
        got = got.withColumn("feature", F.transform("feature", lambda c: (c / (F.col("__n") * F.lit(top / bins))).cast("float").cast("double")))
    return got.withColumn("feature", F.when(F.col("__n") >= least, F.col("feature"))).drop("__n")


def cloud_motion(points: DataFrame, keys: list[str], t: str = "t", feature: str = "histdiff", bins: int = 40, top: float = 3.0, least: int = 50, smooth_s: float = 0.3, frames: DataFrame | None = None) -> DataFrame:
    """keys, t (midpoint), motion between successive frames: L1 of histograms, speed of the centroid, change of the count.

    frames (keys, t) lists all frames; one without usable points then has no motion before or after it.
    """
    got = cloud_features(points, keys, t, feature, bins, top, least)
    if frames is not None:
        got = frames.select(*keys, t).distinct().join(got, [*keys, t], "left")
    w = signals.by(keys, t)
    rows = got.select(*keys, F.col(t).alias("t1"), F.col("feature").alias("a"), F.lag(t).over(w).alias("t0"), F.lag("feature").over(w).alias("b")).where("a is not null and b is not null and t1 > t0")
    if feature == "centroid":
        motion = F.sqrt(numeric.total(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)))) / (F.col("t1") - F.col("t0"))
    else:
        motion = numeric.l1(F.col("a"), F.col("b"))
    rows = rows.select(*keys, ((F.col("t0") + F.col("t1")) / 2).alias("t"), motion.alias("motion"))
    return align.smoothed(rows, keys, "t", {"motion": smooth_s})


def armband_motion(samples: DataFrame, keys: list[str], t: str = "board_ts", mode: str = "fusion", emg_s: float = 0.08, imu_s: float = 0.35, high_pass: bool = True, energy: bool = True) -> DataFrame:
    """keys, t (midpoint), motion of armband samples (emg1..emg8, gyro_x, gyro_y, gyro_z): changes of the rectified mean, energy of
    turning, or both as scores. Steps outside (0.0005 s, 0.2 s) are left out, unless fewer than 50 are inside."""
    _known(mode, MODES)
    w = signals.by(keys, t)
    turn = reduce(lambda a, b: a + b, [F.col(f"gyro_{c}") * F.col(f"gyro_{c}") for c in "xyz"])
    rows = samples.select(*keys, F.col(t).alias("t1"), F.lag(t).over(w).alias("t0"), numeric.rectified_mean(F.array(*[f"emg{k}" for k in range(1, 9)])).alias("level"), (turn if energy else F.sqrt(turn)).alias("imu"))
    change = F.abs(F.col("level") - F.lag("level").over(signals.by(keys, "t1"))) if high_pass else F.col("level")
    rows = rows.withColumns({"emg": change, "dt": F.col("t1") - F.col("t0")}).where("dt is not null")
    rows = signals.dt_gate(rows, keys, 0.0005, 0.2).select(*keys, ((F.col("t0") + F.col("t1")) / 2).alias("t"), "dt", "emg", "imu")
    rows = align.smoothed(rows, keys, "t", {"emg": emg_s, "imu": imu_s}, least=5, step="dt")
    return rows.select(*keys, "t", (signals.fused("emg", "imu", keys) if mode == "fusion" else F.col(mode)).alias("motion"))


def on_grid(a: DataFrame, b: DataFrame, keys: list[str], dt: float, warmup: float, tail: float, least_s: float, least_n: int, score_first: bool) -> tuple[DataFrame, DataFrame]:
    """(keys, g, a, b on a common grid of steps dt; keys, error of the runs that have none). Scores are taken before or after interpolation."""
    named = [s.select(*keys, F.lit(k).alias("signal"), "t", F.col("motion").cast("double").alias("motion")) for k, s in (("a", a), ("b", b))]
    both = named[0].unionByName(named[1])
    window = signals.common_window(both, keys, "signal", "t", warmup, tail, least_s)
    few = F.ceil((F.col("t_end") - F.col("t_start")) / dt) < least_n
    window = window.withColumn("error", F.when(F.col("signals") < 2, F.lit("one signal only")).otherwise(F.coalesce("error", F.when(few, F.lit("too few grid points")))))
    points = signals.grid(window.where("error is null"), dt).select(*keys, "g")
    if score_first:
        both = both.withColumn("motion", signals.zscore("motion", [*keys, "signal"]))
    points = signals.interpolate(both, points, keys, "t", "motion", "g", "signal", ("a", "b"))
    if not score_first:
        points = points.withColumns({k: signals.zscore(k, keys) for k in "ab"})
    return points, window.where("error is not null").select(*keys, "error")


def piecewise_run_offsets(images: DataFrame, clouds: DataFrame, keys: list[str], dt: float = 0.01, warmup: float = 6.0, tail: float = 0.0, size: float = 15.0, hop: float = 10.0, most: float = 2.0, step: float = 0.01, min_corr: float = 0.15, cuts: int = 1, least_n: int = 300, manual: float | None = None) -> DataFrame:
    """One row a run: offsets of clouds against images, single or in pieces; with `manual` that shift, unscanned."""
    points, failed = on_grid(images, clouds, keys, dt, warmup, tail, max(8.0, size + 2.0), least_n, score_first=True)
    if manual is not None:
        got = align.manual_offsets(points, keys, manual)
    else:
        got = align.piecewise_offsets(points, keys, size=size, hop=hop, most=most, step=step, least=max(least_n, int(0.7 * size / dt)), min_corr=min_corr, cuts=cuts)
    return got.unionByName(failed, allowMissingColumns=True)


def event_run_offsets(images: DataFrame, armband: DataFrame, keys: list[str], dt: float = 0.02, warmup: float = 10.0, tail: float = 3.0, least_s: float = 8.0, least_n: int = 200, event_z: float = 0.3, dilate: int = 2, event_s: float = 0.3, **options) -> DataFrame:
    """One row a run: the offset of the armband against images by a coarse and a fine scan over the grid points where both move
    (all points, and low_conf, where these are too few), with event_ratio and the gates of is_reliable."""
    points, failed = on_grid(images, armband, keys, dt, warmup, tail, least_s, least_n, score_first=False)
    strong = points.withColumn("mask", (F.col("a") > event_z) & (F.col("b") > event_z))
    strong = strong.withColumn("mask", signals.dilated(F.col("mask"), keys, "g", dilate))
    used = signals.masked_or_all(strong, keys, "mask", math.ceil(event_s / dt))
    share = strong.groupBy(*keys).agg(F.avg(F.col("mask").cast("int")).alias("event_ratio"))
    flags = used.groupBy(*keys).agg(F.first("low_conf").alias("low_conf"), F.count("*").alias("n_used"))
    got = align.coarse_fine_offsets(used, keys, **options).join(share.join(flags, keys), keys)
    got = got.withColumn("is_reliable", F.col("is_reliable") & (F.col("event_ratio") >= 0.01))
    return got.unionByName(failed, allowMissingColumns=True)


def peak_table(points: DataFrame, frames: DataFrame, keys: list[str], height: float = 1.0, apart: float = 0.3, most: int = 10) -> DataFrame:
    """kind (a, b, joint: the mean of both), t, height, prominence, nearest frame time, and seconds since the grid's and the frames' start."""
    half = round(1e6 * max(0.2, 0.5 * apart))
    micros = F.round(F.col("g") * 1e6).cast("long")  # range frames take whole numbers only
    kinds = points.select(*keys, micros.alias("t"), F.explode(F.create_map(F.lit("a"), F.col("a"), F.lit("b"), F.col("b"), F.lit("joint"), (F.col("a") + F.col("b")) / 2)).alias("kind", "height"))
    peaks = signals.local_peaks(kinds, [*keys, "kind"], "t", "height", height, half).withColumn("t", F.col("t") / 1e6)
    kept = align.peak_records(peaks, [*keys, "kind"], apart, most)
    starts = points.groupBy(*keys).agg(F.min("g").alias("__g")).join(frames.groupBy(*keys).agg(F.min("t").alias("__f")), keys)
    near = intervals.asof(kept, frames.select(*keys, "t"), keys, "t", "nearest").withColumnRenamed("match_t", "frame_t")
    return near.join(starts, keys).withColumns({"since_start": F.col("t") - F.col("__g"), "since_frames": F.col("t") - F.col("__f")}).drop("__g", "__f")

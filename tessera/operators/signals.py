"""Signals as rows (keys, time, value): differences, gates, smoothing, scores, grids, peaks, correlation.

Every operator partitions by the signal's keys and is a window or an aggregate, so one shuffle serves a whole chain of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE_VALID = -1e9


def by(keys: list[str], *order: str):
    return Window.partitionBy(*keys).orderBy(*order)


def diffs(df: DataFrame, keys: list[str], t: str, x: str) -> DataFrame:
    """dt, dx (absolute) and the midpoint to the row before; the first row of a signal has none."""
    w = by(keys, t)
    t0, x0 = F.lag(t).over(w), F.lag(x).over(w)
    return df.withColumns({"dt": F.col(t) - t0, "dx": F.abs(F.col(x) - x0), "t_mid": (F.col(t) + t0) / 2}).where("dt is not null")


def dt_gate(df: DataFrame, keys: list[str], low: float, high: float, least: int = 50) -> DataFrame:
    """Rows with low < dt < high; all rows of a signal of which fewer than `least` pass."""
    ok = (F.col("dt") > low) & (F.col("dt") < high)
    n = F.sum(F.when(ok, 1).otherwise(0)).over(Window.partitionBy(*keys))
    return df.withColumn("__n", n).where(ok | (F.col("__n") < least)).drop("__n")


def dedupe_time(df: DataFrame, keys: list[str], t: str, *tie: str) -> DataFrame:
    """The first row of each time, by tie."""
    w = Window.partitionBy(*keys, t).orderBy(*tie)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def moving_average_edge(x: str, keys: list[str], order: list[str], w: int) -> Column:
    """Centred mean of w values, the end values repeated beyond the ends; (w - 1) // 2 reach back."""
    back = (w - 1) // 2
    ahead = w - 1 - back
    part = Window.partitionBy(*keys).orderBy(*order)
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, rn = F.count(F.lit(1)).over(whole), F.row_number().over(part)
    left, right = F.greatest(F.lit(0), F.lit(back) - (rn - 1)), F.greatest(F.lit(0), F.lit(ahead) - (n - rn))
    inside = F.sum(x).over(part.rowsBetween(-back, ahead))
    return (inside + left * F.first(x).over(whole) + right * F.last(x).over(whole)) / F.lit(w)


def moving_average_same(x: Column, keys: list[str], order: list[str], w: int) -> Column:
    """Centred mean of w values, zeros beyond the ends; w // 2 reach back."""
    return F.sum(x).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(w // 2), (w - 1) // 2)) / F.lit(w)


def zscore(x: str, keys: list[str]) -> Column:
    part = Window.partitionBy(*keys)
    sd = F.stddev_pop(x).over(part)
    return F.when(sd < 1e-8, F.lit(0.0)).otherwise((F.col(x) - F.avg(x).over(part)) / (sd + 1e-8))


def zscored(df: DataFrame, *columns: str) -> DataFrame:
    """df with `columns` as scores over all rows: one aggregate, whose one row meets all rows where they are, and no window over the whole table."""
    parts = F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns])
    of = df.agg(parts.alias("__of"))
    put = {c: F.when(F.col(f"__of.{c}.sd") < 1e-8, F.lit(0.0)).otherwise((F.col(c) - F.col(f"__of.{c}.mean")) / (F.col(f"__of.{c}.sd") + 1e-8)) for c in columns}
    return df.join(F.broadcast(of)).withColumns(put).drop("__of")


def fused(a: str, b: str, keys: list[str]) -> Column:
    return F.abs(zscore(a, keys) + zscore(b, keys))


def sampling_rate(df: DataFrame, keys: list[str], t: str) -> DataFrame:
    """fs = 1 / median step."""
    return df.withColumn("__dt", F.col(t) - F.lag(t).over(by(keys, t))).groupBy(*keys).agg((1.0 / F.nullif(F.percentile("__dt", 0.5), F.lit(0.0))).alias("fs"))


def common_window(df: DataFrame, keys: list[str], signal: str, t: str, warmup: float = 0, tail: float = 0, least: float = 0) -> DataFrame:
    """t_start and t_end that all signals of the keys share, trimmed; error where too short."""
    each = df.groupBy(*keys, signal).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    got = each.groupBy(*keys).agg((F.max("lo") + warmup).alias("t_start"), (F.min("hi") - tail).alias("t_end"), F.count("*").alias("signals"))
    return got.withColumn("error", F.when(F.col("t_end") - F.col("t_start") < least, F.lit("too short")))


def grid(windows: DataFrame, dt: float) -> DataFrame:
    """i and g = t_start + i * dt for all g < t_end (index times step, so steps don't add up errors)."""
    n = F.ceil((F.col("t_end") - F.col("t_start")) / dt).cast("int")
    rows = windows.withColumn("i", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))))
    return rows.withColumn("g", F.col("t_start") + F.col("i") * F.lit(dt)).where(F.col("g") < F.col("t_end"))


def interpolate(samples: DataFrame, points: DataFrame, keys: list[str], t: str, x: str, g: str, signal: str | None = None, names: tuple[str, ...] = ("v",)) -> DataFrame:
    """points with v: linear interpolation of x at g, clamped at the ends; 0 where a signal has fewer than two samples. Points of keys without samples are left out.

    With `signal`, a column of samples, one column for each of names: the signals of those names, 0 where the keys lack one. Each sample brings the next
    one along, and points find the last sample before them by a window over both: points move once, by the keys, in no join and no broadcast, whose size
    Spark would judge by the rows before a grid is exploded.
    """
    known = [F.col(k).isNotNull() for k in keys]
    which = F.lit(names[0]) if signal is None else F.col(signal)
    of = samples.where(reduce(lambda p, q: p & q, known, F.col(t).isNotNull())).select(*keys, which.alias("__k"), F.col(t).alias("__t"), F.col(x).alias("__x"))
    own = by([*keys, "__k"], "__t", "__x")
    of = of.withColumns({"__t2": F.lead("__t").over(own), "__x2": F.lead("__x").over(own), "__n": F.count("*").over(Window.partitionBy(*keys, "__k"))})
    of = of.where("__t2 is null or __t2 > __t").select(*keys, "__t", F.lit(0).alias("__q"), F.struct("__k", "__t", "__x", "__t2", "__x2", "__n").alias("__s"))
    rest = [c for c in points.columns if c not in keys]
    asked = points.where(reduce(lambda p, q: p & q, known)).select(*keys, F.col(g).alias("__t"), F.lit(1).alias("__q"), F.lit(None).cast(of.schema["__s"].dataType).alias("__s"), F.struct(*rest).alias("__row"))
    both = of.withColumn("__row", F.lit(None).cast(asked.schema["__row"].dataType)).unionByName(asked)
    order = by(keys, "__t", "__q")
    up, whole = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = {}
    for k, name in enumerate(names):
        s = F.when(F.col("__s.__k") == name, F.col("__s"))
        found[f"__s{k}"] = F.coalesce(F.last(s, ignorenulls=True).over(up), F.first(s, ignorenulls=True).over(whole))
    both = both.withColumns(found).where("__q = 1").select(*keys, "__row.*", *found)
    for k, name in enumerate(names):
        s = {c: F.col(f"__s{k}.__{c}") for c in ("t", "x", "t2", "x2", "n")}
        part = (F.greatest(F.col(g), s["t"]) - s["t"]) / (s["t2"] - s["t"])
        both = both.withColumn(name, F.when(s["n"].isNull() | (s["n"] < 2), F.lit(0.0)).when(s["t2"].isNull(), s["x"]).otherwise(s["x"] + (s["x2"] - s["x"]) * part))
    return both.where(reduce(lambda p, q: p | q, [F.col(c).isNotNull() for c in found])).select(*points.columns, *names)


def dilated(mask: Column, keys: list[str], order: str, b: int) -> Column:
    return F.max(mask.cast("int")).over(by(keys, order).rowsBetween(-b, b)) == 1


def masked_or_all(df: DataFrame, keys: list[str], mask: str, need: int) -> DataFrame:
    """Masked rows and low_conf false; all rows and low_conf true where fewer than `need` are masked."""
    n = F.sum(F.col(mask).cast("int")).over(Window.partitionBy(*keys))
    return df.withColumn("low_conf", n < need).where(F.col(mask) | F.col("low_conf"))


def local_peaks(df: DataFrame, keys: list[str], t: str, x: str, height: float, half: float) -> DataFrame:
    """Interior rows above height, above the row before and not below the next, with their prominence: x less the higher of the
    two minima within `half` before and after. half is in units of t."""
    w = by(keys, t)
    peak = (F.col(x) >= height) & (F.col(x) > F.lag(x).over(w)) & (F.col(x) >= F.lead(x).over(w))
    before = F.min(x).over(w.rangeBetween(-half, 0))
    after = F.min(x).over(w.rangeBetween(0, half))
    return df.withColumns({"__p": peak, "prominence": F.col(x) - F.greatest(before, after)}).where("__p").drop("__p")


def pearson(a: str, b: str) -> Column:
    """-1 where there is nothing to correlate (also: no variance)."""
    return F.coalesce(F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))), F.lit(-1.0))


def shift_scan(a: DataFrame, b: DataFrame, keys: list[str], i: str, va: str, vb: str, most: int, least: int) -> DataFrame:
    """corr of a at i with b at i + shift for each whole shift within +-most; -1e9 where fewer than `least` rows meet. The join merges, since Spark
    knows the shifted rows' size only before explode."""
    shifted = a.withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("__i", F.col(i) + F.col("shift"))
    pairs = shifted.select(*keys, "shift", F.col("__i").alias(i), va).join(b.select(*keys, i, vb).hint("merge"), [*keys, i])
    got = pairs.groupBy(*keys, "shift").agg(F.count("*").alias("n"), pearson(va, vb).alias("__c"))
    return got.withColumn("corr", F.when(F.col("n") >= least, F.col("__c")).otherwise(F.lit(NONE_VALID))).drop("__c")


def best_shift(scan: DataFrame, keys: list[str]) -> DataFrame:
    """The highest correlation of each key; of equals the least shift."""
    w = Window.partitionBy(*keys).orderBy(F.desc("corr"), "shift")
    return scan.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def confidence(scan: DataFrame, keys: list[str], near: int = 2, drop: float = 0.05) -> DataFrame:
    """best_shift with second (the best beyond +-near shifts, -1e9 if none), margin, and width: shifts around the best whose
    correlation stays within drop of it, without a gap."""
    best = best_shift(scan, keys).select(*keys, F.col("shift").alias("b_shift"), F.col("corr").alias("b_corr"))
    rows = scan.join(best, keys)
    island = F.sum(F.when(F.col("corr") >= F.col("b_corr") - drop, 0).otherwise(1)).over(by(keys, "shift"))
    rows = rows.withColumns({"__in": F.col("corr") >= F.col("b_corr") - drop, "__g": island})
    own = F.max(F.when(F.col("shift") == F.col("b_shift"), F.col("__g"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("__own", own)
    return (
        rows.groupBy(*keys, "b_shift", "b_corr")
        .agg(
            F.coalesce(F.max(F.when(F.abs(F.col("shift") - F.col("b_shift")) > near, F.col("corr"))), F.lit(NONE_VALID)).alias("second"),
            (F.max(F.when(F.col("__in") & (F.col("__g") == F.col("__own")), F.col("shift"))) - F.min(F.when(F.col("__in") & (F.col("__g") == F.col("__own")), F.col("shift")))).alias("width"),
        )
        .withColumn("margin", F.col("b_corr") - F.col("second"))
        .withColumnsRenamed({"b_shift": "shift", "b_corr": "corr"})
    )


def sliding_windows(df: DataFrame, keys: list[str], i: str, size: int, hop: int, least: int) -> DataFrame:
    """df with win: every window [s, s + size] (closed at both ends, from the first i, by hop, whole windows only) that a row falls into."""
    part = Window.partitionBy(*keys)
    rows = df.withColumns({"__lo": F.min(i).over(part), "__hi": F.max(i).over(part)})
    last = F.least(F.floor((F.col(i) - F.col("__lo")) / hop), F.floor((F.col("__hi") - F.col("__lo") - size) / hop))
    first = F.greatest(F.lit(0), F.ceil((F.col(i) - F.col("__lo") - size) / hop))
    rows = rows.withColumn("win", F.explode(F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>")))).drop("__hi")
    rows = rows.withColumn("win_start", F.col("__lo") + F.col("win") * hop).drop("__lo")
    return rows.withColumn("__n", F.count("*").over(Window.partitionBy(*keys, "win"))).where(F.col("__n") >= least).drop("__n")


def changepoint(df: DataFrame, keys: list[str], order: str, y: str, min_seg: int) -> DataFrame:
    """The best single cut: k rows before it and the summed squared error of the two sides, from running sums; ties to the smaller k."""
    w = by(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    r = df.withColumns({"k": F.row_number().over(by(keys, order)), "__s": F.sum(y).over(w), "__q": F.sum(F.col(y) * F.col(y)).over(w), "__n": F.count("*").over(whole), "__ts": F.sum(y).over(whole), "__tq": F.sum(F.col(y) * F.col(y)).over(whole)})
    r = r.where((F.col("k") >= min_seg) & (F.col("__n") - F.col("k") >= min_seg))
    rest, n2 = F.col("__ts") - F.col("__s"), F.col("__n") - F.col("k")
    sse = F.col("__q") - F.col("__s") * F.col("__s") / F.col("k") + (F.col("__tq") - F.col("__q")) - rest * rest / n2
    r = r.withColumn("sse", sse)
    return r.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy("sse", "k"))).where("__r = 1").select(*keys, "k", "sse")


def pieces(t: Column, cuts: Column) -> Column:
    """How many cuts are at or before t."""
    return F.size(F.filter(cuts, lambda c: c <= t))

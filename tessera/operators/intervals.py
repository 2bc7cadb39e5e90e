"""Interval joins (three semantics), as-of joins, range overlap and positional joins.

Range predicates get an equality key: both sides are dealt into buckets of time, so that Spark hashes on (keys, bucket)
and checks bounds inside a bucket only. The bucket is derived from the data's longest interval where none is given, so an
interval falls into two buckets at most on average and nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import ranged

#: More than any place in an order: taken off the place of a range that comes before all others.
FIRST = 1 << 62


def _buckets(lo: Column, hi: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def closed(samples: DataFrame, spans: DataFrame, keys: list[str], t: str, start: str, end: str, width: int) -> DataFrame:
    """samples x spans of equal keys with start <= t <= end. Reversed bounds are swapped; null bounds match nothing. width: of a bucket, in units of t."""
    lo, hi = F.least(start, end), F.greatest(start, end)
    spans = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns({"__lo": lo, "__hi": hi})
    spans = spans.withColumn("__b", _buckets(F.col("__lo"), F.col("__hi"), width))
    samples = samples.withColumn("__b", F.floor(F.col(t) / width))
    return samples.join(spans, [*keys, "__b"]).where(F.col(t).between(F.col("__lo"), F.col("__hi"))).drop("__b", "__lo", "__hi")


def _neighbours(samples: DataFrame, bounds: DataFrame, keys: list[str], t: str, at: str) -> DataFrame:
    """bounds with __before (last t <= at), __after (first t >= at), __first and __last of the keys' samples.

    One shuffle on the keys: samples and bounds are sorted together and looked up with window functions. Long series
    stay sorted on disk; nothing is gathered in memory.
    """
    marks = bounds.select(*keys, F.col(at).alias("__t"), F.lit(1).alias("__q"), F.struct(*bounds.columns).alias("__row"))
    kind = marks.schema["__row"].dataType
    points = samples.select(*keys, F.col(t).alias("__t"), F.lit(0).alias("__q"), F.lit(None).cast(kind).alias("__row"))
    both = points.unionByName(marks)
    own = F.when(F.col("__q") == 0, F.col("__t"))
    part = Window.partitionBy(*keys)
    up = part.orderBy(F.asc("__t"), F.asc("__q")).rowsBetween(Window.unboundedPreceding, 0)
    down = part.orderBy(F.desc("__t"), F.asc("__q")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({"__before": F.last(own, ignorenulls=True).over(up), "__after": F.last(own, ignorenulls=True).over(down), "__first": F.min(own).over(part), "__last": F.max(own).over(part)})
    return both.where("__q = 1").select("__row.*", "__before", "__after", "__first", "__last")


def _outward(samples: DataFrame, spans: DataFrame, keys: list[str], t: str, start: str, end: str, width: int, clamp: bool) -> DataFrame:
    spans = spans.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumns({"__s": F.least(start, end), "__e": F.greatest(start, end)})
    left = _neighbours(samples, spans, keys, t, "__s")
    left = left.withColumn("__from", F.coalesce("__before", "__first") if clamp else F.col("__before")).drop("__before", "__after", "__first", "__last")
    right = _neighbours(samples, left, keys, t, "__e")
    right = right.withColumn("__to", F.coalesce("__after", "__last") if clamp else F.col("__after")).drop("__before", "__after", "__first", "__last")
    return closed(samples, right.where("__from is not null and __to is not null"), keys, t, "__from", "__to", width).drop("__from", "__to", "__s", "__e")


def expand_clamp(samples: DataFrame, spans: DataFrame, keys: list[str], t: str, start: str, end: str, width: int) -> DataFrame:
    """From the last sample at or before start (else the first) to the first at or after end (else the last)."""
    return _outward(samples, spans, keys, t, start, end, width, True)


def expand_strict(samples: DataFrame, spans: DataFrame, keys: list[str], t: str, start: str, end: str, width: int) -> DataFrame:
    """As expand_clamp, but a span that reaches beyond the samples on either side matches nothing. Reversed or empty spans match nothing."""
    return _outward(samples, spans.where(F.col(start) < F.col(end)), keys, t, start, end, width, False)


MODES = {"closed": closed, "expand_clamp": expand_clamp, "expand_strict": expand_strict}


def asof(left: DataFrame, right: DataFrame, keys: list[str], t: str, direction: str = "backward", within: float | None = None) -> DataFrame:
    """left with match_t: t of right's last row at or before (backward), first at or after (forward), or nearest (ties: the earlier).

    Matches further away than `within` are null.
    """
    got = _neighbours(right, left, keys, t, t)
    b, a = F.col("__before"), F.col("__after")
    nearest = F.when(b.isNull(), a).when(a.isNull(), b).when(F.col(t) - b <= a - F.col(t), b).otherwise(a)
    match = {"backward": b, "forward": a, "nearest": nearest}[direction]
    match = match if within is None else F.when(F.abs(match - F.col(t)) <= within, match)
    return got.withColumn("match_t", match).drop("__before", "__after", "__first", "__last")


def overlap_best(left: DataFrame, right: DataFrame, keys: list[str], a: tuple[str, str], b: tuple[str, str], name: str, width: int) -> DataFrame:
    """For each left row the right row whose range overlaps: an equal range first, then the shortest, then by name.

    Ranges are compared, not rows: each range of the keys once on either side, on the right with its least name. Right ranges get
    their place in the order that decides once, so the best of a left range is the least of one long a pair, which tasks keep in a hash
    table; pairs are neither sorted nor kept. Rows without a match are left out, repeated left rows stay. All columns but the keys need an order.
    """
    more = [c for c in right.columns if c not in {*keys, *b, name}]
    other = right.groupBy(*keys, *b).agg(F.min(F.struct(name, *more)).alias("__r"))
    other = ranged(other.withColumn("__rank", F.struct(F.col(b[1]) - F.col(b[0]), f"__r.{name}", *b)), "__rank")
    other = other.withColumn("__pos", F.shiftleft(F.col("__part").cast("long"), 33) + F.col("__row")).drop("__rank", "__part", "__row")
    ranges = left.select(*keys, *a).distinct().withColumn("__b", _buckets(F.col(a[0]), F.col(a[1]), width))
    at = other.select(*keys, *b, "__pos").withColumn("__b", _buckets(F.col(b[0]), F.col(b[1]), width))
    pairs = ranges.join(at, [*keys, "__b"]).where((F.col(a[0]) <= F.col(b[1])) & (F.col(b[0]) <= F.col(a[1])))
    equal = (F.col(a[0]) == F.col(b[0])) & (F.col(a[1]) == F.col(b[1]))
    best = pairs.groupBy(*keys, *a).agg(F.min(F.when(equal, F.col("__pos") - FIRST).otherwise(F.col("__pos"))).alias("__best"))
    best = best.withColumn("__pos", F.when(F.col("__best") < 0, F.col("__best") + FIRST).otherwise(F.col("__best"))).drop("__best")
    found = best.join(other.drop(*keys), "__pos").select(*keys, *a, *b, f"__r.{name}", *[f"__r.{c}" for c in more])
    return left.join(found, [*keys, *a]).select(*left.columns, *b, name, *more)


def positional(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of left with the k-th of right, for equal keys, as far as the shorter goes; pos counts from 0."""
    number = lambda df, order: df.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return number(left, left_order).join(number(right, right_order), [*keys, "pos"])


def slices(frames: DataFrame, points: DataFrame, keys: list[str], start: str, count: str, pos: str, width: int) -> DataFrame:
    """Points of each frame, which owns positions start .. start + count - 1."""
    spans = frames.where(F.col(count) > 0).withColumn("__last", F.col(start) + F.col(count) - 1)
    return closed(points, spans, keys, pos, start, "__last", width).drop("__last")


def latest_session(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The last by name of the sessions whose name is a date and time."""
    return rows.where(F.col(name).rlike(r"^\d{8}_\d{6}$")).groupBy(*keys).agg(F.max(name).alias(name))

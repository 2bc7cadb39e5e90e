"""Order over all rows without a window over all rows: ranges are written once, with each row's range and place in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tables of at most so many counted rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and Spark runs on this machine alone."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tessera-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """df, evaluated once: written to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint while its counted rows are within the bound."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ranged(rows: DataFrame, *by: str) -> DataFrame:
    """rows with __part, the range of `by` that they are in, and __row, their place in it from 0; nulls come first.

    Where a row stands is part of what is written, so later plans can't disagree about it, whatever adaptive execution makes of
    their shuffles. Rows of equal `by` are ordered, and dealt over ranges, by a hash of all columns but maps; only rows that
    are equal in all columns must share a range.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind])
    order = [*map(F.col, by), tie]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    # the id is the partition times 2^33 plus the row's place in the partition
    return written(placed.withColumns({"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id"), "ranges")


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """rows with __pos, from 0 by key over all rows. Written when called, so the positions stay as they are."""
    return positions(ranged(rows, key)).drop("__part", "__row")


def positions(placed: DataFrame) -> DataFrame:
    """Rows of `ranged` with __pos, from 0 over all rows: the rows of earlier ranges and the place in the own one."""
    parts = placed.groupBy("__part").agg(F.count("*").alias("__n"))  # one row a range
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    return placed.join(maybe_broadcast(starts), "__part").withColumn("__pos", F.col("__start") + F.col("__row")).drop("__start")


def numbered_within(rows: DataFrame, group: str, *by: str) -> DataFrame:
    """rows with __pos, from 0 by `by` in each group (null is a group), and __n, the rows of the group. A group may hold any share of the rows."""
    placed = positions(ranged(rows, group, *by))
    firsts = placed.groupBy(F.col(group).alias("__group")).agg(F.min("__pos").alias("__first"), F.count("*").alias("__n"))
    joined = placed.join(maybe_broadcast(firsts), F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn("__pos", F.col("__pos") - F.col("__first")).drop("__group", "__first", "__row")

"""Live recordings as streams: files that keep arriving, tumbling accumulation, idempotent results, review state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructField, StructType
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8, form: str = "parquet") -> DataFrame:
    """Files as they arrive; files_per_batch bounds a batch, as a bounded queue would."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(form).load(path)


def accumulate(events: DataFrame, t: str, window: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Events and last value by window and keys; windows close once the watermark has passed."""
    return events.withWatermark(t, late).groupBy(F.window(t, window), *keys).agg(F.count("*").alias("n"), F.max_by("value", F.col(t)).alias("last"))


def to_table(df: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda x: x, mode: str = "append") -> StreamingQuery:
    """Adds batches under path/batch=n. A batch that is run again replaces itself, so results come exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reviews(log: DataFrame, key: str, t: str, status: str) -> DataFrame:
    """key, status, t of each key whose reviews grew: its last status that stands, with UNDO taking back the one before it (null: none stands).

    The state of a key is its whole log, which is as long as people have reviewed it, so entries that arrive out of order give what the
    log in order gives (quality.latest_status). Entries of one time stand in order of their status. Update mode.
    """
    kinds = {c: log.schema[c].dataType.simpleString() for c in (key, t, status)}
    one = StructType([log.schema[key], StructField(status, log.schema[status].dataType), StructField(t, log.schema[t].dataType)])

    def grow(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, statuses = map(list, state.get) if state.exists else ([], [])
        for p in parts:
            times += p[t].tolist()
            statuses += p[status].tolist()
        stack: list[tuple] = []
        for at, s in sorted(zip(times, statuses, strict=True)):
            if s != "UNDO":
                stack.append((s, at))
            elif stack:
                stack.pop()
        state.update((times, statuses))
        s, at = stack[-1] if stack else (None, None)
        yield pd.DataFrame({key: [keys[0]], status: pd.Series([s], dtype="object"), t: pd.Series([at], dtype=None if stack else "object")})

    rows = log.where(F.col(t).isNotNull() & F.col(status).isNotNull()).select(key, t, status).groupBy(key)
    return rows.applyInPandasWithState(grow, one, f"times array<{kinds[t]}>, statuses array<{kinds[status]}>", "update", "NoTimeout")


def latest_of(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """What to_table has written under path, of each key the row of its last batch."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    columns = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*columns), "batch").alias("r")).select("r.*")


def latest_reviews(log: DataFrame, key: str, t: str, status: str, late: str = "1 day") -> DataFrame:
    """The last status of each key so far (update mode)."""
    return log.withWatermark(t, late).groupBy(key).agg(F.max_by(status, F.col(t)).alias(status), F.max(t).alias(t))

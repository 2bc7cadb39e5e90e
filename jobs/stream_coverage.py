"""Which modalities of a run cover which hours, kept up to date as recordings arrive.

    spark-submit --py-files tessera.zip jobs/stream_coverage.py --config jobs/stream_coverage.json --samples FOLDER --out OUT --checkpoint CKPT

Files of samples (user_id: the run, event_type: the modality, ts, value) are taken once each, by a file stream that ends when nothing is left. A
batch's sums by day, window, run and modality go to OUT/partial; then the days that it touched are put together anew, from the sums of all
batches, in OUT/coverage. Late samples only touch their own day again. Both are replaced partition by partition, so a batch that runs again after a
failure, at any point, leaves the same rows. Samples without a time are left out and counted in the log.
"""

from __future__ import annotations

import os
import sys

if not __package__:  # started as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs.common import LOG, main
from tessera.functions import timeparse
from tessera.streaming import streams

DEFAULTS = {"window_minutes": 60, "modalities": ["click", "error", "purchase", "signup", "view"], "files_per_batch": 16}
SAMPLES = "user_id long, event_type string, ts timestamp_ntz, value double"
KEYS = ["day", "window_us", "run", "modality"]
PARTIAL = "window_us long, run long, modality string, n long, n_values long, total double, lowest double, highest double, first_us long, last_us long, day string, batch long"


def sums(samples: DataFrame, window_us: int) -> DataFrame:
    """One row for each day, window, run and modality, of which any number can be put together."""
    us = timeparse.micros(F.col("ts"))
    rows = samples.where(F.col("ts").isNotNull()).select(F.col("user_id").alias("run"), F.col("event_type").alias("modality"), us.alias("us"), "value", (F.floor(us / window_us) * window_us).cast("long").alias("window_us"))
    rows = rows.withColumn("day", F.date_format(timeparse.from_micros(F.col("window_us")), "yyyy-MM-dd"))
    value = (F.count("value").alias("n_values"), F.sum("value").alias("total"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n"), *value, F.min("us").alias("first_us"), F.max("us").alias("last_us"))


def coverage(partial: DataFrame, modalities: list[str]) -> DataFrame:
    """Window statistics: n, mean, extremes, rate (steps a second from first to last), modalities of the run's window, and whether all wanted are there."""
    add = [F.sum(c).alias(c) for c in ("n", "n_values", "total")] + [F.min(c).alias(c) for c in ("lowest", "first_us")] + [F.max(c).alias(c) for c in ("highest", "last_us")]
    rows = partial.groupBy(*KEYS).agg(*add)
    there = F.collect_set("modality").over(Window.partitionBy("day", "window_us", "run"))  # no more than there are modalities
    rate = (F.col("n") - 1) / F.nullif((F.col("last_us") - F.col("first_us")) / F.lit(1e6), F.lit(0.0))
    wanted = F.array(*map(F.lit, modalities)).cast("array<string>")
    rows = rows.withColumns({"mean": F.col("total") / F.nullif("n_values", F.lit(0)), "rate_hz": rate, "n_modalities": F.size(there), "complete": F.size(F.array_except(wanted, there)) == 0})
    return rows.select("window_us", "run", "modality", "n", "mean", "lowest", "highest", "first_us", "last_us", "rate_hz", "n_modalities", "complete", "day")


def stream_coverage(spark: SparkSession, samples: str, out: str, checkpoint: str, config: dict = DEFAULTS) -> dict:
    """Hourly coverage of runs by modality, from the files that are new since the last run."""
    window_us, done = int(config["window_minutes"]) * 60_000_000, {"samples": 0, "batches": 0, "days": set()}

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        mine = sums(batch, window_us).withColumn("batch", F.lit(number).cast("long"))
        # dynamic: only this batch's part of the days in it
        mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{out}/partial")
        stored = session.read.schema(PARTIAL).parquet(f"{out}/partial").where(F.col("batch") == number)
        days = sorted(r.day for r in stored.groupBy("day").agg(F.sum("n").alias("n")).collect())  # days of one batch
        if days:
            touched = session.read.schema(PARTIAL).option("basePath", f"{out}/partial").parquet(*[f"{out}/partial/day={d}" for d in days])
            coverage(touched, config["modalities"]).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{out}/coverage")
        n, with_time = batch.count(), stored.agg(F.sum("n")).first()[0] or 0
        done["samples"] += n
        done["batches"] += 1
        done["days"] |= set(days)
        LOG.info("batch %d: read %d samples from %s (%d without a time left out), wrote %d days to %s", number, n, samples, n - with_time, len(days), out)

    new = streams.file_stream(spark, samples, SAMPLES, config["files_per_batch"])
    query = new.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    LOG.info("took %d new samples in %d batches, %d days written", done["samples"], done["batches"], len(done["days"]))
    return done | {"days": len(done["days"])}


if __name__ == "__main__":
    main(stream_coverage, DEFAULTS, {"samples": "folder (or pattern) of Parquet files: user_id, event_type, ts, value", "out": "folder of partial/ and coverage/", "checkpoint": "folder of the stream's checkpoint"})

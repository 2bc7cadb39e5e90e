"""Text recordings to training shards: review, copies, leakage-safe split, shards of bounded size.

    spark-submit --py-files tessera.zip jobs/shard_corpus.py --config jobs/shard_corpus.json --documents DOCS --labels LABELS --out OUT

Documents with a bad review (quality 0 or toxic) are left out, and so are those shorter than min_bytes, those without an id, and all copies but that of the
least id. All documents of a run (strata and run column) share a split. In each split documents by id fill shards of at most
shard_bytes as tar members would take them, or max_samples_per_shard. The output is Parquet partitioned by split and shard, one file a
shard, in the order of the members; it is replaced whole, so a rerun over the same tables gives the same files' rows.
"""

from __future__ import annotations

import os
import sys

if not __package__:  # started as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs.common import LOG, main
from tessera.functions.numeric import tar_bytes
from tessera.operators import packing, quality, split
from tessera.operators.ranges import maybe_broadcast, written

DEFAULTS = {"strata": "lang", "run": "source", "seed": "42", "runs_per_split": [4, 1, 1], "shard_bytes": 256 << 20, "max_samples_per_shard": 100_000, "min_bytes": 1}
COLUMNS = ["doc_id", "strata", "run", "split", "shard", "member", "offset_data", "n_bytes", "md5", "text"]


def kept(docs: DataFrame, labels: DataFrame, config: dict) -> DataFrame:
    """doc_id, strata, run, n_bytes, md5 of the documents to use: one row for each text and each id. Texts are read, none is moved."""
    bad = labels.where((F.col("quality") == 0) | (F.col("toxic") == 1)).select("doc_id").distinct()
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col(config["strata"]).alias("strata"), F.col(config["run"]).alias("run"), F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("md5"))
    rows = rows.where(F.col("n_bytes") >= config["min_bytes"]).join(bad, "doc_id", "left_anti")
    firsts = quality.first_copies(rows, "md5", "doc_id", ["strata", "run", "n_bytes"])
    return quality.first_copies(firsts, "doc_id", "md5", ["strata", "run", "n_bytes"])


def assigned(samples: DataFrame, config: dict) -> DataFrame:
    """samples with split, shard, member and offset_data."""
    runs = split.stratified_runs(samples.select("strata", "run").distinct(), ["strata"], "run", config["seed"], tuple(config["runs_per_split"]))
    runs = runs.select(F.col("strata").alias("__s"), F.col("run").alias("__r"), "split")
    rows = samples.join(maybe_broadcast(runs), F.col("strata").eqNullSafe(F.col("__s")) & F.col("run").eqNullSafe(F.col("__r"))).drop("__s", "__r")
    rows = written(rows.withColumn("__size", tar_bytes(F.col("n_bytes"))), "samples")
    shards = packing.shards_by_bytes(rows, "split", "doc_id", "__size", config["shard_bytes"], config["max_samples_per_shard"])
    rows = rows.join(shards.select("doc_id", "shard"), "doc_id")
    rows = rows.withColumns({"member": F.format_string("%012d.txt", "doc_id"), "__file": F.struct("split", "shard")})
    return packing.member_offsets(rows, "__file", "doc_id", "member", "n_bytes").drop("__file", "__size")


def with_texts(places: DataFrame, docs: DataFrame, config: dict) -> DataFrame:
    """places with their texts, dealt by split and shard and in the members' order, as the files are.

    A document's strata and run name its split and its id its shard, so texts go to their shard at once and meet their places there, in one window over both:
    they move once, and those without a place in the split not at all. Rows of one document stand together, of repeated ones the first is written.
    """
    firsts = places.groupBy("split", "shard").agg(F.min("doc_id").alias("first"))
    bounds = firsts.groupBy("split").agg(F.array_sort(F.collect_list("first")).alias("__b"))  # a row a split, an id a file; shards count from 0 by id
    runs = places.select(F.col("strata").alias("__s"), F.col("run").alias("__r"), "split").distinct().join(F.broadcast(bounds), "split")
    texts = docs.select("doc_id", F.col(config["strata"]).alias("strata"), F.col(config["run"]).alias("run"), "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    texts = texts.join(maybe_broadcast(runs), F.col("strata").eqNullSafe(F.col("__s")) & F.col("run").eqNullSafe(F.col("__r"))).drop("__s", "__r")
    texts = texts.withColumn("shard", _last_at("__b", "doc_id").cast(places.schema["shard"].dataType))  # -1 meets no place
    texts = texts.select("split", "shard", "doc_id", F.md5("text").alias("md5"), "text")
    rest = [c for c in COLUMNS if c not in texts.columns]
    both = places.select(*texts.columns[:4], F.struct(*rest).alias("__p")).unionByName(texts, allowMissingColumns=True).repartition("split", "shard")
    # the place comes first, then its texts, of which the window takes the first
    order = Window.partitionBy("split", "shard", "doc_id", "md5").orderBy(F.col("text").isNotNull())
    met = both.withColumns({"__k": F.row_number().over(order), "__p": F.first("__p").over(order)}).where("__k = 2 and __p is not null")
    return met.select("*", "__p.*").select(*COLUMNS).sortWithinPartitions("split", "shard", "doc_id")


def _last_at(bounds: str, key: str) -> Column:
    """The place, from 0, of the last of the ascending bounds that is at most key (-1: none), by halving."""

    def halved(at: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        under = F.get(bounds, middle) <= F.col(key)
        return F.struct(F.when(under, middle).otherwise(at["low"]).alias("low"), F.when(under, at["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(-1).alias("low"), F.size(bounds).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), start, lambda at, _: F.when(at["high"] - at["low"] > 1, halved(at)).otherwise(at))["low"]


def written_shards(spark: SparkSession, like: DataFrame, out: str) -> DataFrame:
    """What the job wrote: the columns of `like`, also where there is no file."""
    return spark.read.schema(like.select(*COLUMNS).schema).parquet(out)


def shard_corpus(spark: SparkSession, documents: str, labels: str, out: str, config: dict = DEFAULTS) -> dict:
    """Reviewed, unique documents in leakage-safe splits and shards of bounded size."""
    docs, reviews = spark.read.parquet(documents), spark.read.parquet(labels)
    read = {"documents": docs.count(), "labels": reviews.count()}
    LOG.info("read %d documents from %s, %d reviews from %s", read["documents"], documents, read["labels"], labels)
    places = written(assigned(kept(docs, reviews, config), config), "places")
    rows = with_texts(places, docs, config)
    rows.write.mode("overwrite").partitionBy("split", "shard").parquet(out)
    got = written_shards(spark, rows, out).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("shard").alias("shards"), F.sum("n_bytes").alias("bytes")).orderBy("split").collect()
    for r in got:
        LOG.info("wrote %s: %d documents, %d bytes of text, %d shards, to %s", r.split, r.n, r.bytes, r.shards, out)
    LOG.info("left out %d documents: reviews, copies, too short or no id", read["documents"] - sum(r.n for r in got))
    return {"read": read, "written": {r.split: {"documents": r.n, "shards": r.shards, "bytes": r.bytes} for r in got}}


if __name__ == "__main__":
    main(shard_corpus, DEFAULTS, {"documents": "Parquet: doc_id, text, lang, source", "labels": "Parquet: doc_id, quality, toxic", "out": "folder that is replaced"})

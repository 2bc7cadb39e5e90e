"""The jobs as queries: each runs twice into one new folder, and returns what stands there afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import shard_corpus as shards
from jobs import stream_coverage as stream
from tessera.operators.ranges import shared_dir


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def job1_shard_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, config = f"{folder(spark, 'job1')}/shards", shards.DEFAULTS | {"shard_bytes": 1_000_000}
    for _ in range(2):
        shards.shard_corpus(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", out, config)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    like = docs.select("doc_id", F.col("lang").alias("strata"), F.col("source").alias("run"), F.lit("").alias("split"), F.lit(0).cast("long").alias("shard"), F.lit("").alias("member"), F.lit(0).cast("long").alias("offset_data"), F.lit(0).cast("long").alias("n_bytes"), F.lit("").alias("md5"), "text")
    return shards.written_shards(spark, like, out)


def job2_stream_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = folder(spark, "job2")  # a stream reads folders and patterns; this pattern is of the one table
    for _ in range(2):
        stream.stream_coverage(spark, f"{sf_dir}/[e]vents.parquet", f"{at}/out", f"{at}/checkpoint")
    rows = spark.read.schema("window_us long, run long, modality string, n long, mean double, lowest double, highest double, first_us long, last_us long, rate_hz double, n_modalities int, complete boolean, day string").parquet(f"{at}/out/coverage")
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "rate_hz")})


QUERIES = {f.__name__: f for f in (job1_shard_corpus, job2_stream_coverage)}

ORACLE = {
    "job1_shard_corpus": """
WITH RECURSIVE a AS (
  SELECT doc_id, lang AS strata, source AS run, strlen(text) AS n_bytes, md5(text) AS md5, text FROM documents
  WHERE doc_id IS NOT NULL AND strlen(text) >= 1 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1))),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY md5 ORDER BY doc_id) = 1),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY md5) = 1),
r AS (SELECT strata, run, row_number() OVER (PARTITION BY strata ORDER BY md5('42' || run) NULLS FIRST, run NULLS FIRST) AS p FROM (SELECT DISTINCT strata, run FROM k)),
s AS (SELECT k.*, CASE p WHEN 5 THEN 'val' WHEN 6 THEN 'test' ELSE 'train' END AS split, 512 + (n_bytes + 511) // 512 * 512 AS size
      FROM k JOIN r ON k.strata IS NOT DISTINCT FROM r.strata AND k.run IS NOT DISTINCT FROM r.run),
o AS (SELECT split, doc_id, size, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS i FROM s),
c AS (SELECT split, doc_id, i, size AS used, 1::BIGINT AS held, 0::BIGINT AS shard FROM o WHERE i = 1 UNION ALL
  SELECT split, o.doc_id, o.i, CASE WHEN cut THEN o.size ELSE c.used + o.size END, CASE WHEN cut THEN 1 ELSE c.held + 1 END, c.shard + cut::BIGINT
  FROM c JOIN o USING (split), (SELECT 1) WHERE o.i = c.i + 1)
SELECT doc_id, strata, run, split, shard, printf('%012d.txt', doc_id) AS member,
  (512 + coalesce(sum(size) OVER (PARTITION BY split, shard ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS offset_data, n_bytes, md5, text
FROM s JOIN c USING (split, doc_id)""".replace("CASE WHEN cut", "CASE WHEN (c.used + o.size > 1000000 OR c.held >= 100000)").replace("cut::BIGINT", "(c.used + o.size > 1000000 OR c.held >= 100000)::BIGINT").replace(", (SELECT 1) WHERE", " WHERE"),
    "job2_stream_coverage": """
WITH e AS (SELECT user_id AS run, event_type AS modality, epoch_us(ts) AS us, value FROM events WHERE ts IS NOT NULL),
w AS (SELECT *, us // 3600000000 * 3600000000 AS window_us FROM e),
a AS (SELECT window_us, run, modality, count(*) AS n, avg(value) AS mean, min(value) AS lowest, max(value) AS highest, min(us) AS first_us, max(us) AS last_us FROM w GROUP BY ALL),
p AS (SELECT window_us, run, count(DISTINCT modality) AS m, count(DISTINCT CASE WHEN modality IN ('click', 'error', 'purchase', 'signup', 'view') THEN modality END) AS k FROM a GROUP BY ALL)
SELECT a.window_us, a.run, modality, n, round(mean, 6) AS mean, lowest, highest, first_us, last_us, round((n - 1) / nullif((last_us - first_us) / 1e6, 0), 6) AS rate_hz,
  m::INT AS n_modalities, k = 5 AS complete, strftime(make_timestamp(a.window_us), '%Y-%m-%d') AS day
FROM a JOIN p ON a.window_us = p.window_us AND a.run IS NOT DISTINCT FROM p.run""",
}

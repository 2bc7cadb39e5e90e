"""Secret models are trained on all documents, however many there are."""

from pyspark.sql import functions as F

from tessera.llm import secret_scans


def test_all_documents_train(spark):
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain "), F.when(F.col("id") % 3 == 0, "password=Zq8rT2vXw9Lm4")).alias("text"))
    docs = docs.withColumn("text", F.coalesce("text", F.lit("plain")))
    n = {(r.token, r.random, r.word): r.n for r in secret_scans.labelled(docs).groupBy("token", "random", "word").agg(F.sum("n").alias("n")).collect()}
    assert n == {("plain", False, True): 30_000, ("Zq8rT2vXw9Lm4", True, False): 15_000}
    assert secret_scans.labelled(docs).where("held and word").count() == 0

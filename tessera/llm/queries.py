"""One query for each operator of this subpackage over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, lm_scoring, merkle, packing, quality_rules, secret_scans, sentencepiece_lattice, sharding, simhash_dedup, substring_dedup, token_counts, topk_search
from .common import scratch, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    base = quality_rules.failed(F.col("fail_bits"), quality_rules.POLICIES["base"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk_search.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scans.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    base = (count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secret_scans.digest(F.col("base")), 256).alias("base_sha256"), secret_scans.digest(F.col("spans")).alias("spans"))
    more = (F.size("runs").cast("long").alias("n_judged"), (F.size("spans") - F.size("base")).cast("long").alias("n_markov"), F.round(F.array_max(F.transform("runs", lambda r: r["ratio"])), 3).alias("max_ratio"))
    return found.select("doc_id", *base, *more)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"), window=50)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json").withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.round_trips(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = sharding.ShardStore(spark, scratch(spark, "shards"))
    store.append(docs.withColumn("__arrival", F.pmod(F.xxhash64("doc_id"), F.lit(8))), "__arrival")
    version = store.compact()
    shards = spark.createDataFrame([(s["shard"], s["rows"], s["bytes"]) for s in store.manifest(version)["shards"]], "shard string, shard_rows long, shard_bytes long")
    rows = store.read(version).select("doc_id", F.col("__shard").alias("shard"))
    return rows.join(shards, "shard", "left").withColumn("version", F.lit(version))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), most=4, shingle=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_topk_search, op3_secret_scans, op4_lm_scoring, op5_substring_dedup, op6_token_counts, op7_sentencepiece_lattice, op8_best_fit_packing, op9_sharding, op10_simhash_dedup, op11_decontamination, op12_merkle_manifest)}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"



def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _tree(rows: str, group: str, levels: int) -> str:
    """CTEs t0, t1, ...: g, i, n, h, r (the run's digests): a tree of each group of rows (g, i, h) up to 8 to the power `levels`."""
    out = [f"{group}0 AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {rows})"]
    for k in range(levels):
        out.append(f"{group}{k + 1} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {group}{k} GROUP BY g, i // 8))")
        out.append(f"{group}r{k} AS (SELECT *, list(h) OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS r FROM {group}{k})")
    return ",\n".join(out)


def _climb(tree: str, levels: int, source: str, out: str) -> str:
    """CTE: source with proof p (siblings so far), f (folded so far) and place i, taken to the root of its group g."""
    steps = []
    for k in range(levels):
        before = source if k == 0 else f"{out}{k - 1}"
        left, right = "array_to_string(r[1:s.i % 8], '')", "array_to_string(r[s.i % 8 + 2:], '')"
        steps.append(f"{out}{k} AS (SELECT s.* EXCLUDE (i, p, f), s.i // 8 AS i, CASE WHEN t.n = 1 THEN p ELSE p || {left} || {right} END AS p, CASE WHEN t.n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f FROM {before} s JOIN {tree}r{k} t ON s.g IS NOT DISTINCT FROM t.g AND s.i = t.i)")
    return ",\n".join(steps)


LEAF = lambda text: "sha256(" + " || ".join([*map(_field, ("doc_id", "source", "lang", "n_chars")), _field(text)]) + ")"
#: CRC-32 of a decimal number, bit by bit.
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_concat([-1 - ascii(c)::BIGINT], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0])))), lambda a, x: CASE WHEN x < 0 THEN xor(a, -1 - x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295::BIGINT)"

CONTENT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op11_decontamination": f"""
WITH b AS (SELECT item_id, {CONTENT} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS k FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {CONTENT} AS w FROM documents),
p AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g))),
o AS (SELECT r, k, i, item_id FROM p JOIN g USING (k, g)),
h AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM o) GROUP BY r),
x AS (SELECT r, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(x.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN x USING (r)""",
    "op12_merkle_manifest": f"""
WITH d AS (SELECT doc_id, lang AS g, {LEAF('text')} AS leaf, {LEAF("CASE WHEN coalesce(" + CRC + ", 1) % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS other FROM documents),
l AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
{_tree("l", "t", 6)},
s AS (SELECT 0 AS g, t6.g AS lang, h, row_number() OVER (ORDER BY t6.g NULLS FIRST) - 1 AS i FROM t6),
{_tree("s", "u", 3)},
a AS (SELECT doc_id, g, i, leaf, '' AS p, other AS f FROM l),
{_climb("t", 6, "a", "a")},
b AS (SELECT doc_id, leaf, s.h AS subroot, s.g, s.i, p, f FROM a5 JOIN s ON a5.g IS NOT DISTINCT FROM s.lang),
{_climb("u", 3, "b", "b")}
SELECT doc_id, leaf, subroot, u3.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = u3.h AS verified FROM b2 JOIN u3 USING (g)""",
    "op1_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words,
         length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         length(t) - length(translate(t, '!', '')) AS n_exclaim,
         coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    ((n_words < 50)::INT * 1 + (100 * n_repeat_words > 50 * n_words)::INT * 2 + (10 * n_symbols > 2 * n_words)::INT * 4 + (10 * n_exclaim > 4 * n_words)::INT * 8
     + (n_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines)::INT * 16 + (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words))::INT * 32)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, fail_bits = 0 AS kept, fail_bits FROM b""",
    "op2_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_substring_dedup": f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS s, unnest(range(1, len(w) - 48)) AS i FROM w),
h AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM h WHERE m < doc_id),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM w),
k AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM p ANTI JOIN c USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)""",
}

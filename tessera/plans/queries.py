"""Registered queries of the engine's operators, each with the SQL that gives the same rows where SQL can.

The tables stand in for recordings: events for sample streams (run = user_id, modality = event_type), lineitem joined to part
for labelled segments, embeddings for frames, conversations for clips (conv_id) of cameras (role) and frames (turn).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import names, numeric, timeparse
from tessera.operators import align, dsp, frames, hierarchy, intervals, packing, quality, samples, signals, split
from tessera.plans import motion
from tessera.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HOUR = 3_600_000_000
#: Frames of a recording, where embeddings stand for frames.
RECORDING = 1000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c) -> F.Column:
    return F.round(c, 6)


def events(spark: SparkSession, d: str, *kinds: str) -> DataFrame:
    df = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", timeparse.micros(F.col("ts")).alias("us"))
    return df.where(F.col("event_type").isin(*kinds)) if kinds else df


EV = "(SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events)"


def segments(spark: SparkSession, d: str) -> DataFrame:
    """person, run, action, light, pos of each line item."""
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("action"))
    rows = table(spark, d, "lineitem").select("l_partkey", (F.col("l_suppkey") % 4).alias("person"), (F.col("l_orderkey") % 360).alias("run"), F.col("l_returnflag").alias("light"), F.col("l_linestatus").alias("pos"))
    return rows.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


SEG = "(SELECT l_suppkey % 4 AS person, l_orderkey % 360 AS run, l_returnflag AS light, l_linestatus AS pos, p_name AS action FROM lineitem JOIN part ON l_partkey = p_partkey)"
SPLIT_SQL = "CASE WHEN run % 10 < 7 THEN 'train' WHEN run % 10 < 9 THEN 'val' ELSE 'test' END"


def split_of_run():
    m = F.col("run") % 10
    return F.when(m < 7, "train").when(m < 9, "val").otherwise("test")


# --- hierarchy and statistics
CELLS = ", ".join(f"count(*) FILTER (light = '{a}' AND pos = '{b}') AS {a}_{b}" for a in "ANR" for b in "FO")


@query(f"SELECT replace(lower(trim(action)), ' ', '_') AS tier3, count(*) AS total, {CELLS}, count(*) FILTER (NOT (light IN ('A','N','R') AND pos IN ('F','O'))) AS unknown_unknown FROM {SEG} GROUP BY 1")
def tier_joint_counts(spark, d):
    df = segments(spark, d).withColumn("tier3", names.one_form(F.col("action")))
    return hierarchy.joint_counts(df, "tier3", "light", "pos", ("A", "N", "R"), ("F", "O"))


@query(f"SELECT 'tier1' AS tier, split_part(action, ' ', 1) AS label, count(*) AS n FROM {SEG} GROUP BY ALL UNION ALL SELECT 'tier3', replace(action, ' ', '_'), count(*) FROM {SEG} GROUP BY ALL")
def tier_grouping_sets(spark, d):
    df = hierarchy.with_tiers(segments(spark, d), "action")
    return hierarchy.tier_counts(df, ("tier1", "tier3"))


VOCAB = ("blue", "blue_bolt", "red_gear", "hot", "hot_ring", "cold_economy", "cold_rod_small", "small_promo", "red_widget_large", "pull_out_tape")
VOCAB_SQL = ", ".join(f"('{v}', '{'.*'.join(f'(^|_){t}(_|$)' for t in v.split('_'))}', '{v.split('_')[0]}', {len(v.split('_'))})" for v in VOCAB)


@query(f"""
WITH p AS (SELECT p_partkey, lower(replace(p_name || ' ' || p_type, ' ', '_')) AS a FROM part),
v(name, pat, verb, n) AS (VALUES {", ".join(f"('{v}', '^.*{'.*'.join(v.split('_'))}.*$', '{v.split('_')[0]}', {len(v.split('_'))})" for v in VOCAB)}),
m AS (SELECT p_partkey, a, name, row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC, name) AS k FROM p JOIN v ON split_part(a, '_', 1) = verb AND regexp_matches(a, pat))
SELECT p.p_partkey, split_part(p.a, '_', 1) AS tier1, coalesce(name, 'UNMAPPED_T2') AS tier2 FROM p LEFT JOIN m ON p.p_partkey = m.p_partkey AND k = 1""")
def tier2_subsequence_match(spark, d):
    a = F.concat_ws(" ", "p_name", "p_type")
    return table(spark, d, "part").select("p_partkey", names.tier1(a).alias("tier1"), names.tier2(a, VOCAB).alias("tier2"))


@query(f"SELECT action AS label, count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'val') AS val, count(*) FILTER (s = 'test') AS test, count(*) AS total FROM (SELECT *, {SPLIT_SQL} AS s FROM {SEG}) GROUP BY 1")
def tier_split_counts(spark, d):
    return hierarchy.split_counts(segments(spark, d).withColumns({"split": split_of_run(), "label": F.col("action")}), "label", "split")


@query(f"SELECT light || '_' || pos AS label, count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'val') AS val, count(*) FILTER (s = 'test') AS test, count(*) AS total FROM (SELECT *, {SPLIT_SQL} AS s FROM {SEG}) GROUP BY 1")
def attr_combo_split_counts(spark, d):
    return hierarchy.attribute_counts(segments(spark, d).withColumn("split", split_of_run()), ["light", "pos"], "split")


@query(f"SELECT person || '::' || run AS gid, count(*) AS n, array_to_string(list_sort(list_distinct(list(split_part(action, ' ', 1)))), ',') AS tier1 FROM {SEG} GROUP BY 1")
def group_label_sets(spark, d):
    df = segments(spark, d).select(names.group_uid(F.col("person").cast("string"), F.col("run").cast("string")).alias("gid"), names.tier1(F.col("action")).alias("tier1"))
    return hierarchy.group_labels(df, "gid", ["tier1"]).withColumn("tier1", F.array_join("tier1", ","))


@query(f"SELECT action, count(DISTINCT run) AS n_groups, count(DISTINCT run) < 3 AS rare FROM {SEG} GROUP BY 1")
def distinct_groups_per_label(spark, d):
    return hierarchy.groups_per_label(segments(spark, d), "action", "run")


@query(f"WITH t AS (SELECT l_partkey AS label, {SPLIT_SQL} AS split FROM (SELECT l_partkey, l_orderkey % 360 AS run FROM lineitem)), l AS (SELECT DISTINCT label FROM t), s(split) AS (VALUES ('train'), ('val'), ('test')) SELECT split, label FROM l CROSS JOIN s EXCEPT SELECT split, label FROM t")
def missing_labels_per_split(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("label"), (F.col("l_orderkey") % 360).alias("run"))
    return hierarchy.missing_labels(rows.withColumn("split", split_of_run()), "label", "split")


@query("WITH c AS (SELECT l_orderkey % 360 AS run, l_returnflag AS light, l_linestatus AS pos, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS f FROM lineitem GROUP BY ALL) SELECT run, light, pos, n FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY n DESC, f, light, pos) AS k FROM c) WHERE k = 1")
def run_condition_mode(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 360).alias("run"), F.col("l_returnflag").alias("light"), F.col("l_linestatus").alias("pos"), F.struct(F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_returnflag", "l_linestatus").alias("o"))
    return hierarchy.mode_first_seen(rows, "run", ["light", "pos"], "o")


@query("SELECT o_orderpriority AS key, count(DISTINCT o_orderstatus) + (count(*) > count(o_orderstatus))::INT AS n_values, count(DISTINCT o_orderstatus) + (count(*) > count(o_orderstatus))::INT > 1 AS conflict FROM orders GROUP BY 1")
def consistency_guard(spark, d):
    return hierarchy.consistency(table(spark, d, "orders").select(F.col("o_orderpriority").alias("key"), "o_orderstatus"), "key", "o_orderstatus")


@query("SELECT p_name, count(*) AS total FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def topn_tiebreak(spark, d):
    return hierarchy.top_n(table(spark, d, "part").groupBy("p_name").agg(F.count("*").alias("total")), "total", "p_name", 20)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 50")
def key_limit(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(50)


# --- splits
COND = f"(SELECT run, light, pos FROM ({ORACLE['run_condition_mode']}))"
G01 = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY light, pos ORDER BY md5('42' || run), run) AS k, count(*) OVER (PARTITION BY light, pos) AS a FROM {cond})
SELECT run, light, pos, CASE WHEN k <= 4 THEN 'train' WHEN k = 5 THEN 'val' WHEN k = 6 THEN 'test' ELSE 'train' END AS split, CASE WHEN a < 6 THEN 'too few runs' END AS error FROM r"""


@query(G01.format(cond=COND))
def stratified_run_split(spark, d):
    return split.stratified_runs(run_condition_mode(spark, d).drop("n"), ["light", "pos"], "run")


@query(f"""
WITH t AS (SELECT *, {SPLIT_SQL} AS split, split_part(action, ' ', 1) AS t1 FROM {SEG}),
c AS (SELECT split, count(DISTINCT t1) AS t1, count(DISTINCT action) AS t2, count(DISTINCT light) AS t3, count(*) AS n FROM t GROUP BY 1),
g AS (SELECT sum(t1) AS t1, sum(t2) AS t2, sum(t3) AS t3, sum(abs(n - CASE split WHEN 'train' THEN 40000 WHEN 'val' THEN 10000 ELSE 5000 END)) AS dev FROM c),
a AS (SELECT count(DISTINCT t1) AS a FROM t)
SELECT (a * 3 - t1)::BIGINT AS missing_t1, t2::BIGINT AS t2_cover, t3::BIGINT AS t3_cover, dev::DOUBLE AS deviation,
 CASE WHEN a * 3 - t1 > 0 THEN -1e12 - 1e9 * (a * 3 - t1) ELSE 1000.0 * t2 + 100.0 * t3 - dev END::DOUBLE AS score FROM g, a""")
def split_score(spark, d):
    df = segments(spark, d).withColumns({"split": split_of_run(), "t1": names.tier1(F.col("action"))})
    return split.score(df, "t1", "action", "light", {"train": 40000, "val": 10000, "test": 5000})


@query()
def split_search(spark, d):
    df = segments(spark, d).select(F.concat_ws("::", "person", F.col("run") % 36).alias("gid"), names.tier1(F.col("action")).alias("t1"), F.col("action").alias("t2"), F.concat_ws("_", "light", "pos").alias("t3"))
    groups = df.groupBy("gid").agg(F.count("*").alias("n"), *[F.array_sort(F.collect_set(c)).alias(c) for c in ("t1", "t2", "t3")])
    return split.search(groups, "gid", "n", ("t1", "t2", "t3"), trials=400)


# --- intervals and as-of joins
def _spans(spark, d):
    return events(spark, d, "purchase").select(F.col("event_id").alias("span_id"), "user_id", F.col("us").alias("s"), (F.col("us") + 2 * HOUR).alias("e"))


SPANS = f"(SELECT event_id AS span_id, user_id, us AS s, us + {2 * HOUR} AS e FROM {EV} WHERE event_type = 'purchase')"


@query(f"SELECT span_id, event_id, us FROM {SPANS} p JOIN {EV} x ON x.user_id = p.user_id AND us BETWEEN s AND e")
def interval_closed(spark, d):
    return intervals.closed(events(spark, d), _spans(spark, d), ["user_id"], "us", "s", "e", 4 * HOUR).select("span_id", "event_id", "us")


OUT = """
WITH p AS {spans}, x AS (SELECT * FROM {ev} WHERE event_type <> 'purchase'),
b AS (SELECT span_id, p.user_id, max(us) FILTER (us <= s) AS lo, min(us) FILTER (us >= e) AS hi, min(us) AS first, max(us) AS last FROM p JOIN x ON x.user_id = p.user_id GROUP BY ALL)
SELECT span_id, event_id, us FROM b JOIN x ON x.user_id = b.user_id AND us BETWEEN {lo} AND {hi}"""


@query(OUT.format(spans=SPANS, ev=EV, lo="coalesce(lo, first)", hi="coalesce(hi, last)"))
def interval_expand_clamp(spark, d):
    return intervals.expand_clamp(events(spark, d).where("event_type <> 'purchase'"), _spans(spark, d), ["user_id"], "us", "s", "e", 12 * HOUR).select("span_id", "event_id", "us")


@query(OUT.format(spans=SPANS, ev=EV, lo="lo", hi="hi"))
def interval_expand_strict(spark, d):
    return intervals.expand_strict(events(spark, d).where("event_type <> 'purchase'"), _spans(spark, d), ["user_id"], "us", "s", "e", 12 * HOUR).select("span_id", "event_id", "us")


def _asof(spark, d, direction):
    left, right = events(spark, d, "click").select("event_id", "user_id", "us"), events(spark, d, "view")
    return intervals.asof(left, right, ["user_id"], "us", direction).select("event_id", "us", F.coalesce("match_t", F.lit(-1)).alias("match_t"))


ASOF = """
WITH c AS (SELECT * FROM {ev} WHERE event_type = 'click'), v AS (SELECT user_id, us FROM {ev} WHERE event_type = 'view'),
m AS (SELECT c.event_id, c.us, max(v.us) FILTER (v.us <= c.us) AS b, min(v.us) FILTER (v.us >= c.us) AS a FROM c LEFT JOIN v USING (user_id) GROUP BY ALL)
SELECT event_id, us, coalesce({x}, -1) AS match_t FROM m"""


@query(ASOF.format(ev=EV, x="b"))
def asof_backward(spark, d):
    return _asof(spark, d, "backward")


@query(ASOF.format(ev=EV, x="a"))
def asof_forward(spark, d):
    return _asof(spark, d, "forward")


@query(ASOF.format(ev=EV, x="CASE WHEN b IS NULL THEN a WHEN a IS NULL THEN b WHEN us - b <= a - us THEN b ELSE a END"))
def asof_nearest(spark, d):
    return _asof(spark, d, "nearest")


@query("""
WITH l AS (SELECT o_orderkey, o_custkey AS cust, o_orderkey % 40 AS a0, o_orderkey % 40 + o_custkey % 5 AS a1 FROM orders),
r AS (SELECT l_orderkey AS ok, min(l_linenumber) + l_orderkey % 30 AS b0, max(l_linenumber) + l_orderkey % 33 + 3 AS b1 FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, ok FROM (SELECT o_orderkey, ok, row_number() OVER (PARTITION BY o_orderkey ORDER BY (a0 = b0 AND a1 = b1) DESC, b1 - b0, ok) AS k FROM l JOIN (SELECT *, ok % 500 AS g FROM r) r ON l.o_orderkey % 500 = g AND a0 <= b1 AND b0 <= a1) WHERE k = 1""")
def range_overlap_best(spark, d):
    key = F.col("o_orderkey")
    left = table(spark, d, "orders").select(key, (key % 500).alias("g"), (key % 40).alias("a0"), (key % 40 + F.col("o_custkey") % 5).alias("a1"))
    k = F.col("l_orderkey")
    right = table(spark, d, "lineitem").groupBy(k.alias("ok")).agg(F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    right = right.select("ok", (F.col("ok") % 500).alias("g"), (F.col("lo") + F.col("ok") % 30).alias("b0"), (F.col("hi") + F.col("ok") % 33 + 3).alias("b1"))
    return intervals.overlap_best(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), "ok", 16).select("o_orderkey", "ok")


@query("""
WITH n AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS pos FROM conversations)
SELECT u.conv_id, u.pos::INT AS pos, u.turn AS user_turn, a.turn AS assistant_turn FROM n u JOIN n a ON u.conv_id = a.conv_id AND u.pos = a.pos AND u.role = 'user' AND a.role = 'assistant'""")
def positional_zip(spark, d):
    c = table(spark, d, "conversations")
    side = lambda role: c.where(F.col("role") == role).select("conv_id", F.col("turn").alias(f"{role}_turn"))
    return intervals.positional(side("user"), side("assistant"), ["conv_id"], ["user_turn"], ["assistant_turn"])


@query("""
WITH f AS (SELECT o_orderkey AS frame, o_orderkey * 4 AS start, o_custkey % 5 AS n, o_orderkey // 100 AS k FROM orders), p AS (SELECT l_orderkey * 4 + l_linenumber - 1 AS pos, (l_orderkey * 4 + l_linenumber - 1) // 400 AS k FROM lineitem)
SELECT frame, pos, count(*) AS n_points FROM f JOIN p ON f.k = p.k AND pos BETWEEN start AND start + n - 1 GROUP BY ALL""")
def slice_join(spark, d):
    k = F.col("o_orderkey")
    frames = table(spark, d, "orders").select(k.alias("frame"), (k * 4).alias("start"), (F.col("o_custkey") % 5).alias("n"), F.floor(k / 100).alias("k"))
    points = table(spark, d, "lineitem").select((F.col("l_orderkey") * 4 + F.col("l_linenumber") - 1).alias("pos")).withColumn("k", F.floor(F.col("pos") / 400))
    return intervals.slices(frames, points, ["k"], "start", "n", "pos", 64).groupBy("frame", "pos").agg(F.count("*").alias("n_points"))


# --- numbers and gates
@query(f"SELECT event_id, lpad(row_number() OVER (PARTITION BY user_id ORDER BY us)::VARCHAR, 6, '0') AS clip FROM {EV} WHERE event_type <> 'error'")
def clip_counter(spark, d):
    return quality.clip_numbers(events(spark, d).where("event_type <> 'error'"), ["user_id"], "us").select("event_id", "clip")


DIFF = f"(SELECT event_id, user_id, us - lag(us) OVER w AS dt, abs(value - lag(value) OVER w) AS dx, (us + lag(us) OVER w) / 2 AS t_mid FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY us))"


@query(f"WITH x AS (SELECT * FROM {DIFF} WHERE dt IS NOT NULL), g AS (SELECT *, count(*) FILTER (dt > {HOUR} AND dt < {20 * HOUR}) OVER (PARTITION BY user_id) AS n FROM x) SELECT event_id, dt, round(dx, 6) AS dx, t_mid FROM g WHERE (dt > {HOUR} AND dt < {20 * HOUR}) OR n < 40")
def dt_gate(spark, d):
    df = signals.diffs(events(spark, d), ["user_id"], "us", "value")
    return signals.dt_gate(df, ["user_id"], HOUR, 20 * HOUR, 40).select("event_id", "dt", r6("dx").alias("dx"), "t_mid")


@query(f"""
WITH x AS (SELECT event_id, value, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id) AS n, first_value(value) OVER w AS f, last_value(value) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l,
 sum(value) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS s FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY us))
SELECT event_id, round((s + greatest(0, 1 - (rn - 1)) * f + greatest(0, 2 - (n - rn)) * l) / 4, 6) AS m FROM x""")
def moving_avg_edge(spark, d):
    return events(spark, d).select("event_id", r6(signals.moving_average_edge("value", ["user_id"], ["us"], 4)).alias("m"))


@query(f"SELECT event_id, round(sum(abs(value)) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4, 6) AS m FROM {EV}")
def moving_avg_same(spark, d):
    return events(spark, d).select("event_id", r6(signals.moving_average_same(F.abs("value"), ["user_id"], ["us"], 4)).alias("m"))


@query(f"SELECT event_id, round(CASE WHEN sd < 1e-8 THEN 0 ELSE (value - m) / (sd + 1e-8) END, 6) AS z FROM (SELECT *, avg(value) OVER (PARTITION BY user_id) AS m, stddev_pop(value) OVER (PARTITION BY user_id) AS sd FROM {EV})")
def zscore(spark, d):
    return events(spark, d).select("event_id", r6(signals.zscore("value", ["user_id"])).alias("z"))


@query(f"SELECT user_id, round(1.0 / nullif(median(dt / 1e6), 0), 9) AS fs FROM {DIFF} WHERE dt IS NOT NULL GROUP BY 1")
def sampling_rate(spark, d):
    return signals.sampling_rate(events(spark, d).withColumn("t", F.col("us") / 1e6), ["user_id"], "t").select("user_id", F.round("fs", 9).alias("fs"))


@query(f"""
WITH e AS (SELECT user_id, event_type, min(us) AS lo, max(us) AS hi FROM {EV} GROUP BY ALL)
SELECT user_id, max(lo) + {HOUR} AS t_start, min(hi) - {HOUR} AS t_end, count(*) AS signals, CASE WHEN min(hi) - {HOUR} - max(lo) - {HOUR} < {24 * HOUR} THEN 'too short' END AS error FROM e GROUP BY 1""")
def common_window(spark, d):
    return signals.common_window(events(spark, d), ["user_id"], "event_type", "us", HOUR, HOUR, 24 * HOUR)


BASE = 1_704_067_200_000_000


def _grid(spark, d, step):
    ev = events(spark, d).withColumn("t", (F.col("us") - BASE) / 1e6)
    ends = ev.groupBy("user_id").agg(F.ceil(F.min("t") / 3600).alias("a"), F.floor(F.max("t") / 3600).alias("b"))
    hours = ends.select("user_id", F.explode(F.sequence("a", "b")).alias("n"))
    return ev, hours.select("user_id", (F.col("n") * F.lit(step)).alias("g"))


@query(f"""
WITH x AS (SELECT user_id, (us - {BASE}) / 1e6 AS t, value AS v, lead((us - {BASE}) / 1e6) OVER w AS t2, lead(value) OVER w AS v2 FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY us)),
e AS (SELECT user_id, ceil(min(t) / 3600)::BIGINT AS a, floor(max(t) / 3600)::BIGINT AS b, min(t) AS lo, max(t) AS hi FROM x GROUP BY 1),
g AS (SELECT user_id, unnest(range(a, b + 1)) * 3600.0 AS g, lo, hi FROM e)
SELECT g.user_id, g.g, round(v + (v2 - v) * (least(greatest(g, lo), hi) - t) / (t2 - t), 6) AS v FROM g JOIN x ON g.user_id = x.user_id AND t <= least(greatest(g, lo), hi) AND (least(greatest(g, lo), hi) < t2 OR (t2 = hi AND g >= hi))""")
def interp_grid(spark, d):
    ev, grid = _grid(spark, d, 3600.0)
    return signals.interpolate(ev, grid, ["user_id"], "t", "value", "g").select("user_id", "g", r6("v").alias("v"))


def _hourly(spark, d):
    h = events(spark, d).withColumn("h", F.floor((F.col("us") - BASE) / HOUR))
    return h.groupBy("h").agg(*[F.avg(F.when(F.col("event_type") == k, F.col("value"))).alias(k) for k in ("click", "view")])


HOURLY = f"(SELECT (us - {BASE}) // {HOUR} AS h, avg(value) FILTER (event_type = 'click') AS click, avg(value) FILTER (event_type = 'view') AS view FROM {EV} GROUP BY 1)"
Z = "(SELECT h, (click - avg(click) OVER ()) / (stddev_pop(click) OVER () + 1e-8) AS a, (view - avg(view) OVER ()) / (stddev_pop(view) OVER () + 1e-8) AS b FROM {h} WHERE click IS NOT NULL AND view IS NOT NULL)"


def _z(spark, d):
    df = _hourly(spark, d).where("click is not null and view is not null").withColumn("one", F.lit(1))
    return signals.zscored(df, "click", "view").select("one", "h", F.col("click").alias("a"), F.col("view").alias("b"))


@query(f"WITH z AS {Z.format(h=HOURLY)}, m AS (SELECT h, (a > 0.5 AND b > 0.5)::INT AS m FROM z) SELECT h, max(m) OVER (ORDER BY h ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 1 AS mask FROM m")
def event_mask_dilate(spark, d):
    return _z(spark, d).select("h", signals.dilated((F.col("a") > 0.5) & (F.col("b") > 0.5), ["one"], "h", 2).alias("mask"))


@query(f"WITH z AS {Z.format(h=HOURLY)}, m AS (SELECT h, a > 1.0 AND b > 1.0 AS m, count(*) FILTER (a > 1.0 AND b > 1.0) OVER () AS n FROM z) SELECT h, n < 5 AS low_conf FROM m WHERE m OR n < 5")
def mask_or_fallback(spark, d):
    df = _z(spark, d).withColumn("m", (F.col("a") > 1.0) & (F.col("b") > 1.0))
    return signals.masked_or_all(df, ["one"], "m", 5).select("h", "low_conf")


PEAKS = f"""
WITH x AS (SELECT user_id, event_id, us, value, lag(value) OVER w AS p, lead(value) OVER w AS n,
 min(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {24 * HOUR} PRECEDING AND CURRENT ROW) AS b, min(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN CURRENT ROW AND {24 * HOUR} FOLLOWING) AS a
 FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY us))
SELECT user_id, event_id, round(value - greatest(b, a), 6) AS prominence FROM x WHERE value >= 20 AND value > p AND value >= n"""


@query(PEAKS)
def local_peaks_prominence(spark, d):
    return signals.local_peaks(events(spark, d), ["user_id"], "us", "value", 20, 24 * HOUR).select("user_id", "event_id", r6("prominence").alias("prominence"))


@query()
def peaks_nms(spark, d):
    p = signals.local_peaks(events(spark, d), ["user_id"], "us", "value", 20, 24 * HOUR)
    return align.peak_records(p.select("user_id", (F.col("us") / 1e6).alias("t"), F.col("value").alias("height"), "prominence"), ["user_id"], 86400.0, 5)


SCAN = f"""
z AS {Z.format(h=HOURLY)}, s AS (SELECT unnest(range(-6, 7)) AS shift),
c AS (SELECT shift::INT AS shift, count(*) AS n, coalesce(covar_pop(x.a, y.b) / nullif(stddev_pop(x.a) * stddev_pop(y.b), 0), -1.0) AS corr FROM z x CROSS JOIN s JOIN z y ON y.h = x.h + shift GROUP BY 1),
k AS (SELECT shift, n, CASE WHEN n >= 10 THEN corr ELSE -1e9 END AS corr FROM c)"""


def _scan(spark, d):
    z = _z(spark, d)
    return signals.shift_scan(z.select("one", "h", "a"), z.select("one", "h", "b"), ["one"], "h", "a", "b", 6, 10)


@query(f"WITH {SCAN} SELECT shift, n, round(corr, 6) AS corr FROM k")
def corr_scan(spark, d):
    return _scan(spark, d).select("shift", "n", r6("corr").alias("corr"))


@query(f"WITH {SCAN} SELECT shift, round(corr, 6) AS corr FROM k ORDER BY k.corr DESC, shift LIMIT 1")
def best_offset(spark, d):
    return signals.best_shift(_scan(spark, d), ["one"]).select("shift", r6("corr").alias("corr"))


@query(f"""WITH {SCAN}, b AS (SELECT shift AS bs, corr AS bc FROM k ORDER BY k.corr DESC, shift LIMIT 1),
g AS (SELECT shift, corr, bs, bc, sum(CASE WHEN corr >= bc - 0.05 THEN 0 ELSE 1 END) OVER (ORDER BY shift) AS g FROM k, b),
o AS (SELECT g AS og FROM g WHERE shift = bs)
SELECT bs AS shift, round(bc, 6) AS corr, round(max(corr) FILTER (abs(shift - bs) > 2), 6) AS second, max(shift) FILTER (corr >= bc - 0.05 AND g = og) - min(shift) FILTER (corr >= bc - 0.05 AND g = og) AS width, round(bc - max(corr) FILTER (abs(shift - bs) > 2), 6) AS margin FROM g, o GROUP BY bs, bc""")
def scan_confidence(spark, d):
    return signals.confidence(_scan(spark, d), ["one"]).select("shift", r6("corr").alias("corr"), r6("second").alias("second"), "width", r6("margin").alias("margin"))


WIN = f"""
z AS {Z.format(h=HOURLY)}, e AS (SELECT min(h) AS lo, max(h) AS hi FROM z),
w AS (SELECT k::INT AS win, lo + k * 24 AS s FROM (SELECT lo, hi, unnest(range(0, ((hi - lo - 72) // 24 + 1)::BIGINT)) AS k FROM e)),
r AS (SELECT win, h, a, b, count(*) OVER (PARTITION BY win) AS n FROM w JOIN z ON h BETWEEN s AND s + 72),
s AS (SELECT unnest(range(-3, 4)) AS shift),
c AS (SELECT x.win, shift::INT AS shift, count(*) AS n, coalesce(covar_pop(x.a, y.b) / nullif(stddev_pop(x.a) * stddev_pop(y.b), 0), -1.0) AS corr FROM r x CROSS JOIN s JOIN r y ON y.win = x.win AND y.h = x.h + shift WHERE x.n >= 20 AND y.n >= 20 GROUP BY ALL),
q AS (SELECT win, shift, CASE WHEN n >= 10 THEN corr ELSE -1e9 END AS corr FROM c),
f AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY corr DESC, shift) AS k FROM q)"""


def _windows(spark, d):
    w = signals.sliding_windows(_z(spark, d), ["one"], "h", 72, 24, 20)
    return signals.best_shift(signals.shift_scan(w.select("win", "h", "a"), w.select("win", "h", "b"), ["win"], "h", "a", "b", 3, 10), ["win"])


@query(f"WITH {WIN} SELECT win, shift, round(corr, 6) AS corr FROM f WHERE k = 1")
def sliding_window_offsets(spark, d):
    return _windows(spark, d).select("win", "shift", r6("corr").alias("corr"))


@query(f"WITH {WIN} SELECT round(coalesce(regr_slope(shift, win), 0), 6) AS slope, round(coalesce(regr_intercept(shift, win), min(shift)), 6) AS intercept, round(avg(corr), 6) AS mean_corr, count(*) AS n FROM f WHERE k = 1")
def drift_fit(spark, d):
    s, w = F.col("shift").cast("double"), F.col("win").cast("double")
    return _windows(spark, d).agg(r6(F.coalesce(F.regr_slope(s, w), F.lit(0.0))).alias("slope"), r6(F.coalesce(F.regr_intercept(s, w), F.min(s))).alias("intercept"), r6(F.avg("corr")).alias("mean_corr"), F.count("*").alias("n"))


@query(f"""
WITH y AS (SELECT event_type, us // {24 * HOUR} AS day, avg(value) AS y FROM {EV} GROUP BY ALL),
p AS (SELECT event_type, row_number() OVER w AS k, sum(y) OVER w AS s, sum(y * y) OVER w AS q, count(*) OVER (PARTITION BY event_type) AS n, sum(y) OVER (PARTITION BY event_type) AS ts, sum(y * y) OVER (PARTITION BY event_type) AS tq FROM y WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING)),
c AS (SELECT event_type, k, q - s * s / k + (tq - q) - (ts - s) * (ts - s) / (n - k) AS sse FROM p WHERE k >= 3 AND n - k >= 3)
SELECT event_type, k::INT AS k, round(sse, 6) AS sse FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY sse, k) AS r FROM c) WHERE r = 1""")
def changepoint_k1(spark, d):
    y = events(spark, d).groupBy("event_type", F.floor(F.col("us") / (24 * HOUR)).alias("day")).agg(F.avg("value").alias("y"))
    return signals.changepoint(y, ["event_type"], "day", "y", 3).select("event_type", "k", r6("sse").alias("sse"))


def _pairs(spark, d):
    rows = events(spark, d, "click", "view").withColumns({"g": F.floor((F.col("us") - BASE) / HOUR).cast("double"), "run": F.col("user_id") % 5})
    grid = rows.groupBy("run", "g").agg(F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("a"), F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("b"))
    return grid.fillna(0.0, ["a", "b"])


@query()
def global_offset_kernel(spark, d):
    return align.global_offsets(_pairs(spark, d), ["run"], most=6.0, step=0.5, least_s=20.0, least_n=20)


@query()
def coarse_fine_scan(spark, d):
    return align.coarse_fine_offsets(_pairs(spark, d), ["run"], most=6.0, coarse=0.5, fine=0.1, half=0.5)


@query()
def piecewise_offsets(spark, d):
    return align.piecewise_offsets(_pairs(spark, d), ["run"], size=96.0, hop=48.0, most=4.0, step=0.5, least=20)


@query("SELECT DISTINCT user_id % 5 AS run, 0.25::DOUBLE AS \"offset\", NULL::DOUBLE AS corr FROM events WHERE event_type IN ('click', 'view')")
def manual_shift(spark, d):
    return align.manual_offsets(_pairs(spark, d), ["run"], 0.25)


# --- point clouds, radar, frames
@query("""
WITH v AS (SELECT vec_id, list_filter(list_transform(embedding, lambda x: abs(x::DOUBLE)), lambda x: x <= 0.3) AS v FROM embeddings),
b AS (SELECT vec_id, v, list_transform(v, lambda x: least(floor(x / (0.3 / 8)), 7)::INT) AS c FROM v),
h AS (SELECT vec_id, list_transform(range(0, 8), lambda k: CASE WHEN len(v) > 0 THEN len(list_filter(c, lambda x: x = k)) / (len(v) * (0.3 / 8)) ELSE 0.0 END) AS h FROM b),
l AS (SELECT vec_id, h, lag(h) OVER (PARTITION BY vec_id // 1000 ORDER BY vec_id) AS p FROM h)
SELECT vec_id, round(h[1], 6) AS h0, round(h[8], 6) AS h7, round(list_sum(list_transform(range(1, 9), lambda i: abs(h[i] - p[i]))), 6) AS motion FROM l""")
def histogram_motion(spark, d):
    h = table(spark, d, "embeddings").select("vec_id", F.floor(F.col("vec_id") / RECORDING).alias("rec"), numeric.histogram(F.transform("embedding", lambda x: F.abs(x.cast("double"))), 0.3, 8).alias("h"))
    prev = F.lag("h").over(Window.partitionBy("rec").orderBy("vec_id"))
    return h.withColumn("p", prev).select("vec_id", r6(F.get("h", F.lit(0))).alias("h0"), r6(F.get("h", F.lit(7))).alias("h7"), F.when(F.col("p").isNotNull(), r6(numeric.l1(F.col("h"), F.col("p")))).alias("motion"))


def _points(spark, d):
    """16 points (x, y, z, intensity) of each embedding."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("k"), "embedding")
    return e.select("vec_id", "label", "k", *[F.get("embedding", F.col("k") * 4 + j).cast("double").alias(c) for j, c in enumerate(("x", "y", "z", "i"))])


POINTS = "(SELECT vec_id, label, k, embedding[k * 4 + 1]::DOUBLE AS x, embedding[k * 4 + 2]::DOUBLE AS y, embedding[k * 4 + 3]::DOUBLE AS z, embedding[k * 4 + 4]::DOUBLE AS i FROM (SELECT vec_id, label, embedding, unnest(range(0, 16)) AS k FROM embeddings))"


@query(f"""
WITH c AS (SELECT label, vec_id, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM {POINTS} GROUP BY ALL),
l AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(z) OVER w AS pz FROM c WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT label, vec_id, n, round(sqrt((x - px) * (x - px) + (y - py) * (y - py) + (z - pz) * (z - pz)), 6) AS motion FROM l""")
def centroid_motion(spark, d):
    c = _points(spark, d).groupBy("label", "vec_id").agg(F.count("*").alias("n"), *[F.avg(a).alias(a) for a in "xyz"])
    w = Window.partitionBy("label").orderBy("vec_id")
    return c.select("label", "vec_id", "n", r6(numeric.norm3(*[F.col(a) - F.lag(a).over(w) for a in "xyz"])).alias("motion"))


@query(f"SELECT vec_id, count(*) AS n FROM {POINTS} WHERE isfinite(x) AND isfinite(y) AND isfinite(z) AND isfinite(i) AND NOT (x = 0 AND y = 0 AND z = 0 AND i = 0) GROUP BY 1")
def point_clean(spark, d):
    return quality.clean_points(_points(spark, d), ["x", "y", "z", "i"]).groupBy("vec_id").agg(F.count("*").alias("n"))


_R = numeric.rotation(30, 20, 10)


@query(f"SELECT vec_id, k::INT AS k, " + ", ".join(f"round({_R[j][0]!r} * x + {_R[j][1]!r} * y + {_R[j][2]!r} * z, 6) AS r{a}" for j, a in enumerate("xyz")) + f" FROM {POINTS}")
def rotate_points(spark, d):
    got = numeric.rotated(F.col("x"), F.col("y"), F.col("z"), _R)
    return _points(spark, d).select("vec_id", "k", *[r6(c).alias(f"r{a}") for c, a in zip(got, "xyz", strict=True)])


@query("""
WITH v AS (SELECT vec_id, unnest(range(1, 33)) AS k, embedding AS e FROM embeddings), a AS (SELECT vec_id, sqrt(e[k]::DOUBLE * e[k]::DOUBLE + e[k + 32]::DOUBLE * e[k + 32]::DOUBLE) AS a, atan2(e[k + 32]::DOUBLE, e[k]::DOUBLE) AS p FROM v)
SELECT vec_id, round(sum(a), 6) AS amplitude, round(sum(p), 6) AS phase, round(sum(CASE WHEN a <> 0 THEN 10 * log10(a) END), 6) AS db FROM a GROUP BY 1""")
def amplitude_phase_db(spark, d):
    i, q = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    df = table(spark, d, "embeddings").select("vec_id", numeric.amplitude(i, q).alias("a"), numeric.phase(i, q).alias("p"))
    return df.select("vec_id", r6(numeric.total(F.col("a"))).alias("amplitude"), r6(numeric.total(F.col("p"))).alias("phase"), r6(numeric.total(F.transform("a", lambda x: F.coalesce(numeric.decibel(x), F.lit(0.0))))).alias("db"))


@query("SELECT label, count(*) AS frames, array_to_string(list_sort(list(vec_id)), ',') AS ids, round(list_sum(list_transform(flatten(list(embedding)), lambda x: abs(x::DOUBLE))), 3) AS total FROM embeddings GROUP BY 1")
def doppler_cube(spark, d):
    # nulls are left out of sums and lists, which are null where nothing else is
    def total(a):
        return F.aggregate(a, F.lit(None).cast("double"), lambda s, x: F.coalesce(s + x, s, x.cast("double")))

    def joined(a):
        return F.nullif(F.array_join(a, ","), F.lit(""))

    cube = frames.cubes(table(spark, d, "embeddings"), "label", "vec_id", "embedding", 64)
    ids = joined(F.transform("vec_id", lambda x: x.cast("string")))
    sums = total(F.transform(F.flatten(F.array_compact("embedding")), lambda x: F.abs(x)))
    parts = cube.select("label", F.struct("cube", F.size("vec_id").cast("long").alias("frames"), ids.alias("ids"), sums.alias("total")).alias("p"))
    # of a label's cubes only their ids and sums come together, in the cubes' order; frames stay in their cubes
    whole = parts.groupBy("label").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select("label", numeric.total(F.col("p.frames")).cast("long").alias("frames"), joined(F.col("p.ids")).alias("ids"), F.round(total(F.col("p.total")), 3).alias("total"))


@query("""
WITH t AS (SELECT conv_id, turn, string_split(role, 's') AS r FROM conversations), m AS (SELECT conv_id, max(len(r)) AS m, min(len(r)) AS n FROM t GROUP BY 1)
SELECT t.conv_id, turn, m::INT AS max_rows, array_to_string(list_concat(r, list_transform(range(0, m - len(r)), lambda x: '-')), '|') AS r, n < m AS ragged FROM t JOIN m USING (conv_id)""")
def pad_to_max(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", F.split("role", "s").alias("r"))
    return packing.pad_rows(t, "conv_id", "r", F.lit("-")).withColumn("r", F.array_join("r", "|"))


@query(f"SELECT event_type, user_id, round((value - lo) / (hi - lo), 6) AS u, greatest(least((value - lo) / (hi - lo), 1), 0) * 255 // 1 AS b FROM (SELECT *, min(value) OVER (PARTITION BY event_type) AS lo, max(value) OVER (PARTITION BY event_type) AS hi FROM {EV})".replace("greatest(least((value - lo) / (hi - lo), 1), 0) * 255 // 1 AS b", "floor(greatest(least((value - lo) / (hi - lo), 1), 0) * 255)::INT AS b"))
def range_normalise(spark, d):
    df = events(spark, d)
    ends = df.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    df = df.join(ends.withColumnRenamed("event_type", "__type"), F.col("event_type").eqNullSafe(F.col("__type")))
    return df.select("event_type", "user_id", r6(numeric.unit_range(F.col("value"), F.col("lo"), F.col("hi"))).alias("u"), numeric.clip_to_byte(F.col("value"), F.col("lo"), F.col("hi")).alias("b"))


@query(f"SELECT event_type, round(quantile_cont(value, 0.01), 6) AS p1, round(quantile_cont(value, 0.99), 6) AS p99 FROM {EV} GROUP BY 1")
def percentile_range(spark, d):
    p = F.percentile("value", F.array(F.lit(0.01), F.lit(0.99)))
    return events(spark, d).groupBy("event_type").agg(p.alias("p")).select("event_type", r6(F.get("p", F.lit(0))).alias("p1"), r6(F.get("p", F.lit(1))).alias("p99"))


@query("""
WITH f AS (SELECT label, embedding AS e, greatest(len(embedding) // 10, 1) AS step, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
v AS (SELECT label, unnest(list_filter(e, lambda x, i: (i - 1) % step = 0))::DOUBLE AS v FROM f WHERE k <= 20),
p AS (SELECT label, count(*) AS n, quantile_cont(v, 0.01) AS a, quantile_cont(v, 0.99) AS b, min(v) AS lo, max(v) AS hi FROM v WHERE isfinite(v) GROUP BY 1)
SELECT label, n, round(CASE WHEN b <= a THEN lo ELSE a END, 6) AS low, round(CASE WHEN b <= a THEN hi + 1e-6 ELSE b END, 6) AS high FROM p""")
def sampled_percentile_range(spark, d):
    got = frames.sampled_percentiles(table(spark, d, "embeddings"), ["label"], "vec_id", "embedding", first=20, per_frame=10)
    return got.select("label", "n", r6("low").alias("low"), r6("high").alias("high"))


@query(f"SELECT us // {6 * HOUR} AS win, floor(value / 10)::INT AS x, (user_id % 8)::INT AS y, arg_max(event_type, us) AS event_type, count(*) AS n FROM {EV} GROUP BY ALL")
def event_accumulate_last(spark, d):
    e = events(spark, d).withColumns({"x": F.floor(F.col("value") / 10).cast("int"), "y": (F.col("user_id") % 8).cast("int")})
    return quality.last_event_image(e, "us", "x", "y", "event_type", 6 * HOUR)


@query()
def emg_filter(spark, d):
    return dsp.filtered(events(spark, d), ["user_id"], "us", "value", 1000.0)


@query()
def emg_resample(spark, d):
    return dsp.resampled(events(spark, d), ["user_id"], "us", "value", 500.0, 200.0)


# --- keys and modalities
def _modalities(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return {"rgb": docs.where("doc_id % 7 <> 0"), "emg": labels, "lidar": docs.where("doc_id % 3 = 0")}


MOD = "(SELECT doc_id, max(m = 'rgb')::INT AS rgb, max(m = 'emg')::INT AS emg, max(m = 'lidar')::INT AS lidar FROM (SELECT doc_id, 'rgb' AS m FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, 'emg' FROM labels UNION ALL SELECT doc_id, 'lidar' FROM documents WHERE doc_id % 3 = 0) GROUP BY 1)"


@query(f"SELECT * FROM {MOD}")
def presence_matrix(spark, d):
    return quality.presence(_modalities(spark, d), "doc_id")


@query(f"SELECT doc_id FROM {MOD} WHERE rgb + emg + lidar = 3")
def key_intersection(spark, d):
    return quality.common(_modalities(spark, d), "doc_id")


@query(f"SELECT doc_id FROM {MOD}")
def key_union(spark, d):
    return quality.common(_modalities(spark, d), "doc_id", union=True)


@query(f"SELECT doc_id, concat_ws(',', CASE WHEN rgb = 0 THEN 'rgb' END, CASE WHEN emg = 0 THEN 'emg' END, CASE WHEN lidar = 0 THEN 'lidar' END) AS missing FROM {MOD} WHERE rgb + emg + lidar < 3")
def modality_missing(spark, d):
    return quality.missing(_modalities(spark, d), "doc_id").select("doc_id", F.array_join("missing_modalities", ",").alias("missing"))


@query(" UNION ALL ".join(f"SELECT '{m}' AS root, sum({m})::BIGINT AS n, sum(1 - {m})::BIGINT AS missing, count(*) FILTER ({m} = 1 AND rgb + emg + lidar < 3) AS extra, count(*) FILTER ({m} = 1 AND rgb + emg + lidar = 1) AS only_here FROM {MOD}" for m in ("rgb", "emg", "lidar")))
def root_report(spark, d):
    return quality.root_report(_modalities(spark, d), "doc_id")


@query("""
WITH k AS (SELECT doc_id::VARCHAR AS id, doc_id, CASE WHEN b = 0 THEN 'a' WHEN a = 0 THEN 'b' ELSE 'c' END AS kind FROM (SELECT doc_id, max(s = 'a')::INT AS a, max(s = 'b')::INT AS b FROM (SELECT doc_id, 'a' AS s FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 'b' FROM labels) GROUP BY 1)),
n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY doc_id) AS pos FROM k)
SELECT pos::INT AS pos, coalesce(max(id) FILTER (kind = 'a'), '') AS only_in_a, coalesce(max(id) FILTER (kind = 'b'), '') AS only_in_b, coalesce(max(id) FILTER (kind = 'c'), '') AS common FROM n GROUP BY 1""")
def two_set_diff(spark, d):
    return quality.two_set_columns(table(spark, d, "documents").where("doc_id % 2 = 0"), table(spark, d, "labels"), "doc_id")


@query("SELECT event_id, value, NULL::VARCHAR AS user_id, 'click' AS run FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, user_id::VARCHAR, 'view' FROM events WHERE event_type = 'view'")
def union_by_name(spark, d):
    return quality.concatenated({"click": events(spark, d, "click").select("event_id", "value"), "view": events(spark, d, "view").select("event_id", F.col("user_id").cast("string"))}, "run")


@query("SELECT doc_id, md5(text) AS md5, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id)::INT AS copy_no, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 AS duplicate FROM documents")
def md5_dedupe(spark, d):
    return quality.duplicates(table(spark, d, "documents"), F.col("text"), "doc_id").select("doc_id", "md5", "copy_no", "duplicate")


STATUS = "CASE WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'signup' THEN 'SKIP' ELSE 'PASS' END"


@query(f"SELECT user_id, {STATUS} AS status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us DESC) AS k FROM {EV}) WHERE k = 1")
def review_latest_status(spark, d):
    s = F.when(F.col("event_type") == "error", "FAIL").when(F.col("event_type") == "signup", "SKIP").otherwise("PASS")
    return quality.latest_status(events(spark, d).withColumn("status", s), "user_id", "us", "status").select("user_id", "status", "event_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_skip(spark, d):
    log = table(spark, d, "labels").withColumn("status", F.when(F.col("quality") == 1, "PASS").otherwise("FAIL"))
    return quality.not_done(table(spark, d, "documents").select("doc_id"), log, "doc_id", "status")


@query("SELECT l_orderkey, l_linenumber, coalesce(n_name, 'failed') AS light, count(*) AS n FROM lineitem LEFT JOIN nation ON l_suppkey % 30 = n_nationkey GROUP BY ALL")
def run_light_join(spark, d):
    mapping = table(spark, d, "nation").select("n_nationkey", "n_name")  # one row a run: a small dimension
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 30).alias("run"))  # runs 25 to 29 have no light
    return rows.join(mapping, F.col("run") == F.col("n_nationkey"), "left").groupBy("l_orderkey", "l_linenumber", F.coalesce("n_name", F.lit("failed")).alias("light")).agg(F.count("*").alias("n"))


# --- packing
@query("SELECT conv_id, role, turn, conv_id || '.rgb_' || role || '.' || lpad((row_number() OVER (PARTITION BY conv_id, role ORDER BY lpad(turn::VARCHAR, 4, '0')) - 1)::VARCHAR, 6, '0') || '.jpg' AS member FROM conversations")
def sample_plan(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "role", "turn", F.concat(F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(".JPG")).alias("file"))
    return packing.members(c, "conv_id", "rgb", "role", "file").select("conv_id", "role", "turn", "member")


@query("SELECT conv_id, string_agg(role || ':' || n || ':' || f, ';' ORDER BY role) AS cams FROM (SELECT conv_id, role, count(*) AS n, string_agg(turn, ',' ORDER BY turn) AS f FROM conversations GROUP BY ALL) GROUP BY 1")
def cam_map(spark, d):
    m = packing.camera_map(table(spark, d, "conversations"), "conv_id", "role", "turn")
    text = F.transform(F.array_sort(F.map_entries("cams")), lambda e: F.concat_ws(":", e["key"], e["value"]["n_frames"].cast("string"), F.array_join(F.transform(e["value"]["frames"], lambda x: x.cast("string")), ",")))
    return m.select("conv_id", F.array_join(text, ";").alias("cams"))


SIZES = "(SELECT conv_id, count(*) AS n_members, sum(512 + ((strlen(text) + 511) // 512) * 512)::BIGINT AS bytes FROM conversations GROUP BY 1)"


def _sizes(spark, d):
    return packing.sample_bytes(table(spark, d, "conversations").select("conv_id", F.octet_length("text").alias("size")), "conv_id", "size")


@query(f"SELECT * FROM {SIZES}")
def tar_size(spark, d):
    return _sizes(spark, d)


@query(f"SELECT conv_id, (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS shard FROM {SIZES}")
def shard_by_count(spark, d):
    return packing.shards_by_count(_sizes(spark, d), "conv_id", 8).select("conv_id", "shard")


@query(f"""
WITH RECURSIVE s AS (SELECT conv_id % 4 AS g, conv_id, bytes, row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id) AS k FROM {SIZES}),
r AS (SELECT g, conv_id, k, bytes AS used, 0::BIGINT AS shard FROM s WHERE k = 1 UNION ALL
 SELECT s.g, s.conv_id, s.k, CASE WHEN r.used + s.bytes > 40000 THEN s.bytes ELSE r.used + s.bytes END, r.shard + (r.used + s.bytes > 40000)::BIGINT FROM r JOIN s ON s.g = r.g AND s.k = r.k + 1)
SELECT g, conv_id, shard FROM r""")
def shard_by_bytes(spark, d):
    return packing.shards_by_bytes(_sizes(spark, d).withColumn("g", F.col("conv_id") % 4), "g", "conv_id", "bytes", 40_000)


@query("""
WITH t AS (SELECT conv_id % 10 AS shard, conv_id, turn, strlen(text) AS n FROM conversations)
SELECT conv_id, turn, (coalesce(sum(512 + ((n + 511) // 512) * 512) OVER (PARTITION BY shard ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 512)::BIGINT AS offset_data FROM t""")
def tar_offsets(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", (F.col("conv_id") % 10).alias("shard"), F.octet_length("text").alias("n"))
    return packing.member_offsets(t, "shard", "conv_id", "turn", "n").select("conv_id", "turn", F.col("offset_data").cast("long"))


# --- names and times
@query("""SELECT page_id, split_part(url, '/', 3) AS host, split_part(split_part(url, '/', 3), '.', 1) AS first, replace(regexp_replace(url, '^https?://', ''), '/', '_') || '_npy' AS key FROM pages""")
def path_parse(spark, d):
    p = F.regexp_replace("url", "^https?://", "")
    return table(spark, d, "pages").select("page_id", F.get(F.split("url", "/"), F.lit(2)).alias("host"), names.first_token(F.get(F.split("url", "/"), F.lit(2)), r"\.").alias("first"), names.key_of_path(p).alias("key"))


NAMED = """(SELECT l_orderkey, l_linenumber, l_suppkey, 'run_' || (l_orderkey % 36) || CASE WHEN l_suppkey % 3 = 0 THEN '-' || (l_orderkey % 36 + 1) ELSE '' END || '_clip_' || lpad(l_linenumber::VARCHAR, 6, '0') || '_'
 || CASE l_returnflag WHEN 'A' THEN 'normal' WHEN 'N' THEN 'right' ELSE 'back' END || CASE WHEN l_suppkey % 5 = 0 THEN '' WHEN l_linestatus = 'F' THEN '_elbow' ELSE '_mid' END || CASE WHEN l_suppkey % 2 = 0 THEN '_npy' ELSE '' END AS seg FROM lineitem)"""


def _named(spark, d):
    run = (F.col("l_orderkey") % 36).cast("string")
    seg = F.concat(
        F.lit("run_"), run, F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("-"), (F.col("l_orderkey") % 36 + 1).cast("string"))).otherwise(""), F.lit("_clip_"), F.lpad(F.col("l_linenumber").cast("string"), 6, "0"), F.lit("_"),
        F.when(F.col("l_returnflag") == "A", "normal").when(F.col("l_returnflag") == "N", "right").otherwise("back"),
        F.when(F.col("l_suppkey") % 5 == 0, "").when(F.col("l_linestatus") == "F", "_elbow").otherwise("_mid"), F.when(F.col("l_suppkey") % 2 == 0, "_npy").otherwise(""),
    )
    return table(spark, d, "lineitem").select(seg.alias("seg")).distinct()


@query(f"""
WITH s AS (SELECT DISTINCT seg, regexp_replace(seg, '_npy$', '') AS base FROM {NAMED}), t AS (SELECT seg, base, string_split(base, '_') AS t FROM s)
SELECT seg, CASE WHEN t[-2] IN ('normal', 'right', 'left') THEN t[-2] ELSE 'unknown' END AS light, CASE WHEN t[-1] IN ('elbow', 'mid') THEN t[-1] ELSE 'unknown' END AS pos,
 'run_' || regexp_extract(seg, '^run_([0-9]+(-[0-9]+)?)', 1) AS run_token, regexp_extract(seg, '^run_([0-9]+)', 1)::INT AS run, list_filter(string_split(seg, '_'), lambda x: x IN ('elbow', 'mid'))[1] AS any_pos FROM t""")
def segment_meta(spark, d):
    s = F.col("seg")
    base = names.without_npy(s)
    return _named(spark, d).select("seg", names.lighting(base).alias("light"), names.position(base).alias("pos"), names.run_token(s).alias("run_token"), names.first_run(s).alias("run"), names.any_token(s, names.POSITIONS).alias("any_pos"))


@query(f"""
WITH s AS (SELECT DISTINCT seg FROM {NAMED})
SELECT seg, regexp_replace(regexp_replace(replace(replace(seg, '_npy', ''), '_mid', ''), '_{{2,}}', '_', 'g'), '^_+|_+$', '', 'g') AS plain,
 CASE WHEN regexp_matches(seg, '_(elbow|mid)(_|$)') THEN seg WHEN seg LIKE '%\\_npy' ESCAPE '\\' THEN regexp_replace(seg, '_npy$', '') || '_mid_npy' ELSE seg || '_mid' END AS renamed,
 regexp_extract(seg, '^run_([0-9]+(?:[-_][0-9]+)?)_clip_([0-9]+)_([A-Za-z0-9_]+)$', 2) AS clip FROM s""")
def segment_names(spark, d):
    s = F.col("seg")
    return _named(spark, d).select("seg", names.normalize_segment(s).alias("plain"), names.with_position(s, F.lit("mid")).alias("renamed"), names.clip_part(s, 2).alias("clip"))


@query(f"""
WITH k AS (SELECT DISTINCT 'J_' || replace(p_name, ' ', '_') || '_' || 'run_' || (p_partkey % 40) || '_clip_000027' AS key FROM part)
SELECT key, 'J' AS prefix, regexp_extract(key, '^J_(.*?)_run_', 1) AS label_1, split_part(key, '_', 2) AS label_2 FROM k""")
def labels_from_key(spark, d):
    key = F.concat(F.lit("J_"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_run_"), (F.col("p_partkey") % 40).cast("string"), F.lit("_clip_000027"))
    return table(spark, d, "part").select(key.alias("key")).distinct().select("key", names.labels_from_key(F.col("key")).alias("l")).select("key", "l.*")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || '_' || p_brand END AS raw, trim(regexp_replace(regexp_replace(CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || '_' || p_brand END, '[\\\\/:*?\"<>|\\s]', '_', 'g'), '_+', '_', 'g'), '_') AS safe FROM part")
def safe_names(spark, d):
    obj = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_brand"))
    raw = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat_ws("_", "p_name", "p_brand"))
    return table(spark, d, "part").select("p_partkey", raw.alias("raw"), names.safe_class(F.col("p_name"), obj).alias("safe"))


@query(f"SELECT event_id, strftime(make_timestamp(us), '%Y%m%d_%H%M%S_%f') AS stamp, us AS parsed, replace(strftime(make_timestamp(us), '%Y%m%d_%H%M%S_%f'), '_', '') AS compact FROM {EV}")
def ts_parse_format(spark, d):
    e = events(spark, d).select("event_id", timeparse.format_stamp(F.col("us")).alias("stamp"))
    name = F.concat(F.col("stamp"), F.lit("_cloud.csv"))
    return e.select("event_id", "stamp", timeparse.micros(timeparse.stamp(name)).alias("parsed"), timeparse.compact_key(name).cast("string").alias("compact"))


@query(f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN us * 1000 WHEN 1 THEN us WHEN 2 THEN us // 1000 ELSE us // 1000000 END AS raw, CASE event_id % 4 WHEN 0 THEN us WHEN 1 THEN us WHEN 2 THEN us // 1000 * 1000 ELSE us // 1000000 * 1000000 END AS normal FROM {EV}")
def epoch_normalize(spark, d):
    k, us = F.col("event_id") % 4, F.col("us")
    raw = F.when(k == 0, us * 1000).when(k == 1, us).when(k == 2, F.floor(us / 1000)).otherwise(F.floor(us / 1_000_000)).cast("long")
    return events(spark, d).select("event_id", raw.alias("raw")).withColumn("normal", timeparse.epoch_to_micros(F.col("raw")))


@query()
def tz_convert(spark, d):
    e = events(spark, d).select("event_id", "us", timeparse.format_stamp(F.col("us"), "Europe/London").alias("london"))
    return e.withColumn("epoch", timeparse.name_to_epoch(F.col("london"), "Europe/London"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN props::JSON ->> 'k' ELSE event_type END AS path FROM events")
def json_polymorphic_path(spark, d):
    obj = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
    return table(spark, d, "events").select("event_id", numeric.polymorphic_path(obj, ("path", "k")).alias("path"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def segment_summary(spark, d):
    df = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


def _edge_mean(source: str, x: str, keys: str, order: str, back: int, ahead: int) -> str:
    """SQL of source with m, the centred mean of x with the end values repeated."""
    whole = f"(PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"""(SELECT *, (s + greatest(0, {back} - (rn - 1)) * f + greatest(0, {ahead} - (n - rn)) * l) / {back + ahead + 1} AS m FROM (
 SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn, count(*) OVER {whole} AS n, first_value({x}) OVER {whole} AS f, last_value({x}) OVER {whole} AS l,
 sum({x}) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING) AS s FROM {source}))"""


@query(f"""
WITH e AS (SELECT vec_id // {RECORDING} AS rec, (vec_id % {RECORDING}) * 0.002::DOUBLE AS t, list_sum(list_transform(embedding[1:8], lambda x: abs(x::DOUBLE))) / 8 AS v FROM embeddings),
d AS (SELECT rec, (t + lag(t) OVER w) / 2 AS t, abs(v - lag(v) OVER w) AS x FROM e WINDOW w AS (PARTITION BY rec ORDER BY t)),
x AS (SELECT * FROM d WHERE x IS NOT NULL)
SELECT rec, round(t, 6) AS t, round(m, 6) AS motion FROM {_edge_mean("x", "x", "rec", "t", 1, 2)}""")
def armband_motion(spark, d):
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / RECORDING).alias("rec"), ((F.col("vec_id") % RECORDING) * F.lit(0.002)).alias("board_ts"), *[F.get("embedding", F.lit(k)).cast("double").alias(c) for k, c in enumerate([*(f"emg{k}" for k in range(1, 9)), *(f"gyro_{c}" for c in "xyz")])])
    return motion.armband_motion(e, ["rec"], mode="emg", emg_s=0.008).select("rec", r6("t").alias("t"), r6("motion").alias("motion"))


_HIST = ", ".join(f"count(*) FILTER (b = {k})" for k in range(8))


@query(f"""
WITH p AS (SELECT vec_id // {RECORDING} AS rec, vec_id, CASE WHEN sqrt(x * x + y * y + z * z) <= 0.5 THEN least(floor(sqrt(x * x + y * y + z * z) / 0.0625), 7)::INT END AS b FROM {POINTS}),
c AS (SELECT rec, vec_id, count(b) AS n, [{_HIST}] AS h FROM p GROUP BY ALL),
h AS (SELECT rec, vec_id, CASE WHEN n >= 5 THEN list_transform(h, lambda x: (x / (n * 0.0625::DOUBLE))::FLOAT::DOUBLE) END AS h FROM c),
l AS (SELECT rec, vec_id - 0.5 AS t, h, lag(h) OVER (PARTITION BY rec ORDER BY vec_id) AS p FROM h),
x AS (SELECT rec, t::DOUBLE AS t, list_sum(list_transform(list_zip(h, p), lambda z: abs(z[1] - z[2]))) AS x FROM l WHERE h IS NOT NULL AND p IS NOT NULL)
SELECT rec, t, round(m, 5) AS motion FROM {_edge_mean("x", "x", "rec", "t", 1, 1)}""")
def cloud_motion(spark, d):
    p = _points(spark, d).withColumns({"rec": F.floor(F.col("vec_id") / RECORDING), "t": F.col("vec_id").cast("double")})
    return motion.cloud_motion(p, ["rec"], bins=8, top=0.5, least=5, smooth_s=3.0).select("rec", "t", F.round("motion", 5).alias("motion"))


def _motions(spark, d):
    """Click and view events as motion signals (t in hours) of runs of one user each."""
    rows = events(spark, d, "click", "view").select(F.col("user_id").alias("run"), "event_type", ((F.col("us") - BASE) / HOUR).alias("t"), F.col("value").alias("motion"))
    return [rows.where(F.col("event_type") == k).drop("event_type") for k in ("click", "view")]


@query()
def piecewise_run_offsets(spark, d):
    return motion.piecewise_run_offsets(*_motions(spark, d), ["run"], dt=1.0, warmup=0.0, size=96.0, hop=48.0, most=4.0, step=0.5, least_n=40)


@query()
def event_run_offsets(spark, d):
    return motion.event_run_offsets(*_motions(spark, d), ["run"], dt=1.0, warmup=0.0, tail=0.0, least_n=40, event_s=5.0, most=6.0, coarse=0.5, fine=0.1, half=0.5)


@query()
def peak_table(spark, d):
    a, b = _motions(spark, d)
    points, _ = motion.on_grid(a, b, ["run"], 1.0, 0.0, 0.0, 8.0, 40, score_first=False)
    return motion.peak_table(points, a.select("run", "t"), ["run"], height=1.0, apart=6.0)


@query(f"""
WITH n AS (SELECT event_id, user_id, us, CASE WHEN event_id % 10 = 0 THEN 'frame_' || event_id ELSE strftime(make_timestamp(us), '%Y%m%d_%H%M%S_%f') || '.jpg' END AS name FROM {EV})
SELECT event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id % 10 = 0, CASE WHEN event_id % 10 <> 0 THEN us END, name) - 1)::INT AS place FROM n""")
def frame_order(spark, d):
    name = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("frame_"), F.col("event_id"))).otherwise(F.concat(timeparse.format_stamp(F.col("us")), F.lit(".jpg")))
    return frames.numbered_frames(events(spark, d).withColumn("name", name), ["user_id"], "name").select("event_id", "place")


@query("""
SELECT vec_id, round(list_sum(list_transform(flatten(list_transform([1, 2, 3, 4], lambda y: embedding[y * 8 + 3:y * 8 + 6])), lambda x: x::DOUBLE)), 6) AS box,
 len(list_filter(embedding, lambda x: x < 0 OR x > 0.1)) AS background,
 round(list_sum(list_transform(embedding, lambda x: CASE WHEN x BETWEEN 0 AND 0.1 THEN x::DOUBLE ELSE 0 END)), 6) AS near FROM embeddings""")
def crop_and_depth(spark, d):
    """Embeddings as depth images of 8 x 8."""
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("p"))
    cut = frames.without_background(F.col("p"), F.col("p"), 0.1)
    return e.select("vec_id", r6(numeric.total(frames.crop(F.col("p"), 8, 2, 1, 6, 5))).alias("box"), F.size(F.filter(cut, lambda x: x == 153.0)).cast("long").alias("background"), r6(numeric.total(frames.within_distance(F.col("p"), 0.0, 0.1))).alias("near"))


@query(f"SELECT vec_id, point FROM (SELECT vec_id, vec_id * 16 + k AS point, row_number() OVER (PARTITION BY vec_id ORDER BY md5('42:' || (vec_id * 16 + k)), vec_id * 16 + k) AS n FROM {POINTS}) WHERE n <= 5")
def thinned_points(spark, d):
    return frames.thinned(_points(spark, d).select("vec_id", (F.col("vec_id") * 16 + F.col("k")).alias("point")), ["vec_id"], "point", 5)


@query("""
SELECT 'l_quantity' AS name, l_quantity::DOUBLE AS value, min(l_orderkey) AS first_at, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_discount', l_discount::DOUBLE, min(l_orderkey), count(*) FROM lineitem GROUP BY 2""")
def parameter_sets(spark, d):
    return frames.parameter_sets(table(spark, d, "lineitem"), ["l_quantity", "l_discount"], "l_orderkey")


# --- samples over several modalities: a conversation is a sample, its turns are files of four modalities
FILE_KIND = "CASE turn % 4 WHEN 0 THEN 'rgb' WHEN 1 THEN 'lidar' WHEN 2 THEN 'depth' ELSE 'mindrove' END"
FILES = f"(SELECT conv_id, {FILE_KIND} AS modality, CASE WHEN turn % 4 = 1 THEN NULL ELSE role END AS part, CASE WHEN turn % 12 = 7 THEN 'x/clip.npy' ELSE 'x/' || lpad(turn::VARCHAR, 4, '0') || '.JPG' END AS path FROM conversations)"
INDEX = f"(SELECT conv_id, modality, part, CASE WHEN modality IN ('rgb', 'depth') THEN list(path ORDER BY path) ELSE [arg_min(path, (path NOT LIKE '%/clip.npy')::INT::VARCHAR || path)] END AS files FROM {FILES} GROUP BY conv_id, modality, part)"


def _sample_files(spark, d):
    kind = F.get(F.array(*map(F.lit, ("rgb", "lidar", "depth", "mindrove"))), (F.col("turn") % 4).cast("int"))
    path = F.when(F.col("turn") % 12 == 7, "x/clip.npy").otherwise(F.concat(F.lit("x/"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit(".JPG")))
    return table(spark, d, "conversations").select("conv_id", kind.alias("modality"), F.col("role").alias("part"), path.alias("path"))


@query(f"SELECT conv_id, modality, part, array_to_string(files, ';') AS files FROM {INDEX}")
def modality_index(spark, d):
    return samples.modality_index(_sample_files(spark, d), "conv_id", "modality", "part", "path").withColumn("files", F.array_join("files", ";"))


@query(f"""
WITH k AS (SELECT conv_id, CASE WHEN modality = 'mindrove' THEN 'emg' ELSE modality END AS m, part, files FROM {INDEX} WHERE modality <> 'depth' AND (modality <> 'rgb' OR part = 'user')),
e AS (SELECT conv_id, m, part, unnest(files) AS path, generate_subscripts(files, 1) - 1 AS i FROM k),
h AS (SELECT conv_id, list_sort(list(DISTINCT m)) AS has FROM k GROUP BY 1)
SELECT conv_id, m AS modality, conv_id || '.' || m || coalesce('_' || part, '') || CASE WHEN m = 'rgb' THEN '.' || lpad(i::VARCHAR, 6, '0') || lower(regexp_extract(path, '[.][^./]+$')) ELSE '.npy' END AS member, path, NULL::VARCHAR AS content FROM e
UNION ALL SELECT conv_id, NULL, conv_id || '.labels.json', NULL, '{{"prefix":"' || conv_id || '","label_1":"","label_2":""}}' FROM h
UNION ALL SELECT conv_id, NULL, conv_id || '.meta.json', NULL, '{{"has":["' || array_to_string(has, '","') || '"]}}' FROM h""")
def sample_members(spark, d):
    index = samples.modality_index(_sample_files(spark, d), "conv_id", "modality", "part", "path")
    return samples.members(samples.chosen(index, "modality", ["rgb", "lidar", "emg", "sound"], ["cam_user"], ("rgb",)), "conv_id", "modality")


@query("SELECT conv_id % 4 AS shard, conv_id::VARCHAR AS key, string_agg(conv_id || '.' || turn || '.txt', ';' ORDER BY conv_id || '.' || turn || '.txt') AS members FROM conversations GROUP BY ALL")
def member_index(spark, d):
    rows = table(spark, d, "conversations").select((F.col("conv_id") % 4).alias("shard"), F.concat("conv_id", F.lit("."), "turn", F.lit(".txt")).alias("member"))
    return packing.member_index(rows, "shard", "member").withColumn("members", F.array_join("members", ";"))


@query("SELECT conv_id, count(*) FILTER (role = 'user') AS n_user FROM conversations GROUP BY 1")
def camera_selection(spark, d):
    cams = packing.camera_map(table(spark, d, "conversations"), "conv_id", "role", "turn")
    kept = cams.select("conv_id", packing.camera_filter(F.col("cams"), ["cam_user"]).alias("c"))
    return kept.select("conv_id", F.coalesce(F.try_element_at("c", F.lit("user"))["n_frames"], F.lit(0)).cast("long").alias("n_user"))


# --- runs: an order is a run of a customer
RUN_NUMBER = "o_orderkey % 40"


@query(f"""
WITH g AS (SELECT person || '::run_' || run AS group_uid, person, CASE WHEN run = 7 THEN 'run_UNKNOWN' ELSE 'run_' || run END AS run_token, {SPLIT_SQL} AS split, count(*) AS n_segments FROM {SEG} GROUP BY ALL)
SELECT row_number() OVER (ORDER BY person, coalesce(try_cast(regexp_extract(run_token, '^run_([0-9]+)$', 1) AS INT), 1000000000), run_token, group_uid) - 1 AS pos, * FROM g""")
def run_split_map(spark, d):
    token = F.when(F.col("run") == 7, "run_UNKNOWN").otherwise(F.concat(F.lit("run_"), "run"))
    rows = segments(spark, d).select("person", token.alias("run_token"), F.concat("person", F.lit("::run_"), "run").alias("group_uid"), split_of_run().alias("split"))
    return samples.run_map(rows, "person", "run_token", "group_uid", "split")


@query(f"SELECT split, count(*) AS n FROM {SEG} JOIN ({G01.format(cond=COND)}) USING (run) GROUP BY 1")
def segments_by_run_split(spark, d):
    return split.apply_runs(segments(spark, d), stratified_run_split(spark, d), ["run"]).groupBy("split").agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT o_orderkey, o_custkey % 4 AS subject, o_orderkey % 30 AS run FROM orders), m AS (SELECT n_nationkey % 4 AS subject, n_nationkey AS run, CASE WHEN n_nationkey % 2 = 0 THEN 'mid' ELSE 'elbow' END AS emg_pos FROM nation)
SELECT o_orderkey, run::INT AS run, emg_pos, 'run_' || run || '_clip_1' || CASE WHEN run % 3 = 0 THEN '_mid' ELSE '_' || emg_pos END AS new_name FROM r JOIN m USING (subject, run)""")
def position_mapping_join(spark, d):
    name = F.concat(F.lit("run_"), F.col("o_orderkey") % 30, F.lit("_clip_1"), F.when(F.col("o_orderkey") % 30 % 3 == 0, "_mid").otherwise(""))
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 4).alias("subject"), name.alias("segment"))
    mapping = table(spark, d, "nation").select((F.col("n_nationkey") % 4).cast("long").alias("subject"), F.col("n_nationkey").alias("run"), F.when(F.col("n_nationkey") % 2 == 0, "mid").otherwise("elbow").alias("emg_pos"))
    return quality.mapped_positions(rows, mapping, "subject", "segment").select("o_orderkey", "run", "emg_pos", "new_name")


@query("""
WITH b AS (SELECT least(c_custkey % 20, c_nationkey) AS a, greatest(c_custkey % 20, c_nationkey) AS b, min(c_name) AS path FROM customer GROUP BY ALL)
SELECT s_suppkey, path FROM supplier JOIN b ON b.a = least(s_suppkey % 20, s_nationkey) AND b.b = greatest(s_suppkey % 20, s_nationkey)""")
def run_number_join(spark, d):
    a = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("run_"), F.col("s_suppkey") % 20, F.lit("-"), "s_nationkey").alias("name"))
    b = table(spark, d, "customer").select(F.col("c_name").alias("path"), F.concat(F.lit("run-"), F.col("c_custkey") % 20, F.lit("-"), "c_nationkey", F.lit("_emg")).alias("name"))
    return quality.by_run_number(a, b, "name", "path").select("s_suppkey", "path")


@query("""
WITH n AS (SELECT o_custkey AS folder, o_orderkey % 50 AS a, o_orderkey // 7 % 50 AS b, o_orderkey % 5 AS k FROM orders),
f AS (SELECT folder, 'N_run_' || a || CASE WHEN k = 1 THEN '' ELSE '-' || b END || CASE WHEN k = 2 THEN '_annotationlight copy.csv' ELSE '_annotationlight.csv' END AS name, CASE WHEN k = 1 THEN 0 ELSE abs(a - b) END AS span, CASE WHEN k = 1 THEN a ELSE least(a, b) END AS low, k FROM n)
SELECT folder, name FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY span, low, name) AS r FROM f WHERE k <> 2) WHERE r = 1""")
def annotation_file_pick(spark, d):
    k, a = F.col("o_orderkey") % 5, F.col("o_orderkey") % 50
    name = F.concat(F.lit("N_run_"), a, F.when(k == 1, "").otherwise(F.concat(F.lit("-"), F.floor(F.col("o_orderkey") / 7) % 50)), F.when(k == 2, "_annotationlight copy.csv").otherwise("_annotationlight.csv"))
    return files.run_annotation(table(spark, d, "orders").select(F.col("o_custkey").alias("folder"), name.alias("name")), "folder", "name")


RUN_NAME = "CASE o_orderkey % 6 WHEN 0 THEN 'run_' || o_custkey WHEN 1 THEN 'J_Run-' || o_custkey || '_8' WHEN 2 THEN 'run_a_' || o_custkey WHEN 3 THEN 'run_x' WHEN 4 THEN 'rerun_1' ELSE 'run_' || o_custkey || '_3' END"


@query(f"SELECT o_orderkey, n AS name, regexp_matches(n, '(?i)(^|_)run[-_][0-9]+([-_][0-9]+)?$') AS camera, starts_with(n, 'run_') AS lidar, starts_with(n, 'run_') AND regexp_matches(string_split(n, '_')[-1], '^[0-9]+$') AS copy, regexp_full_match(n, 'run_[0-9]+(_[0-9]+)?') AS depth FROM (SELECT o_orderkey, {RUN_NAME} AS n FROM orders)")
def run_folders(spark, d):
    c = F.col("o_custkey")
    forms = [F.concat(F.lit("run_"), c), F.concat(F.lit("J_Run-"), c, F.lit("_8")), F.concat(F.lit("run_a_"), c), F.lit("run_x"), F.lit("rerun_1"), F.concat(F.lit("run_"), c, F.lit("_3"))]
    rows = table(spark, d, "orders").select("o_orderkey", F.get(F.array(*forms), (F.col("o_orderkey") % 6).cast("int")).alias("name"))
    return rows.select("*", *[names.is_run_folder(F.col("name"), kind).alias(kind) for kind in names.RUN_FOLDERS])


@query("SELECT p_brand, count(*) AS n, array_to_string(list_slice(list_sort(list(DISTINCT p_name)), 1, 10), ';') AS examples FROM part GROUP BY 1")
def first_examples(spark, d):
    return samples.examples(table(spark, d, "part"), "p_brand", "p_name", 10).withColumn("examples", F.array_join("examples", ";"))


# --- names and times
SAFE = "trim(regexp_replace(replace(replace({0}, '/', '_'), chr(92), '_'), '[ _]+', '_', 'g'))"


@query(f"""
SELECT p_partkey, {SAFE.format("p_name || '/' || p_type || '//' || p_brand")} AS plain,
 CASE WHEN p_size % 3 = 0 THEN 'N' ELSE split_part(p_name, ' ', 1) END || '_' || CASE WHEN p_size % 4 = 0 THEN {SAFE.format("p_name")} ELSE split_part(p_name, ' ', 2) END || '_' || {SAFE.format("p_type || '_' || p_brand")} AS full_key
FROM part""")
def safe_keys(spark, d):
    original = F.concat_ws("/", "p_name", "p_type", F.lit(""), "p_brand")
    person, action = F.when(F.col("p_size") % 3 == 0, "N"), F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise("")
    return table(spark, d, "part").select("p_partkey", names.safe_key("sanitize_only", original, person, action, F.lit(None)).alias("plain"), names.safe_key("person_action_segment", original, person, action, F.lit(None).cast("string")).alias("full_key"))


@query("SELECT page_id, string_split(url, '/')[-2] || '/' || string_split(url, '/')[-3] AS tag FROM pages")
def run_tags(spark, d):
    return table(spark, d, "pages").select("page_id", names.run_tag(F.col("url")).alias("tag"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'F' WHEN 'BUILDING' THEN 'B' ELSE c_mktsegment END || '_' || c_nationkey AS key FROM customer")
def subject_renames(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.concat_ws("_", names.renamed(F.col("c_mktsegment"), {"FURNITURE": "F", "BUILDING": "B"}), "c_nationkey").alias("key"))


@query("SELECT p_partkey, round(p_size + p_retailprice - 1.5, 6) AS total, 3 AS n FROM part")
def list_literals(spark, d):
    text = F.concat(F.lit("["), "p_size", F.lit(", "), "p_retailprice", F.lit(", -1.5]"))
    a = table(spark, d, "part").select("p_partkey", numeric.list_literal(text).alias("a"))
    return a.select("p_partkey", r6(numeric.total(F.col("a"))).alias("total"), F.size("a").alias("n"))


@query(f"SELECT event_id, 0.5 * (us + lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id)) AS mid, us - min(us) OVER (PARTITION BY user_id) AS since FROM {EV}")
def interval_midpoints(spark, d):
    w = Window.partitionBy("user_id")
    e = events(spark, d).withColumns({"next": F.lead("us").over(w.orderBy("us", "event_id")), "first": F.min("us").over(w)})
    return e.select("event_id", timeparse.midpoint(F.col("us"), F.col("next")).alias("mid"), (F.col("us") - F.col("first")).alias("since"))


ANY_TIME = "CASE event_id % 4 WHEN 0 THEN strftime(make_timestamp(us), '%Y%m%d_%H%M%S_%f') WHEN 1 THEN strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%f') WHEN 2 THEN (us // 1000000)::VARCHAR ELSE 'x' || us END"


@query(f"SELECT event_id, CASE event_id % 4 WHEN 2 THEN us // 1000000 * 1000000 WHEN 3 THEN NULL ELSE us END AS us FROM {EV}")
def times_of_any_form(spark, d):
    ts = timeparse.from_micros(F.col("us"))
    forms = [timeparse.format_stamp(F.col("us")), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.floor(F.col("us") / 1_000_000).cast("string"), F.concat(F.lit("x"), "us")]
    rows = events(spark, d).select("event_id", F.get(F.array(*forms), (F.col("event_id") % 4).cast("int")).alias("t"))
    return rows.select("event_id", timeparse.normalised(F.col("t")).alias("us"))


@query(f"SELECT user_id, max(strftime(make_timestamp(us), '%Y%m%d_%H%M%S')) FILTER (event_type <> 'error') AS session FROM {EV} GROUP BY 1 HAVING session IS NOT NULL")
def latest_sessions(spark, d):
    name = F.substring(timeparse.format_stamp(F.col("us")), 1, 15)
    rows = events(spark, d).select("user_id", F.when(F.col("event_type") == "error", F.concat(name, F.lit("_old"))).otherwise(name).alias("session"))
    return intervals.latest_session(rows, ["user_id"], "session")


@query(f"WITH f AS (SELECT event_type FROM {EV} GROUP BY 1 ORDER BY min(us) LIMIT 2) SELECT event_type, count(*) AS n FROM {EV} WHERE event_type NOT IN (FROM f) GROUP BY 1")
def first_counters_dropped(spark, d):
    return quality.not_first_counters(events(spark, d), "event_type", "us").groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"SELECT event_id, (us >= {BASE} + 3600000000)::INT + (us >= {BASE} + 7200000000)::INT + (us >= {BASE} + 86400000000)::INT AS piece FROM {EV}")
def piece_numbers(spark, d):
    cuts = F.array(*[F.lit(BASE + k * HOUR) for k in (1, 2, 24)])
    return events(spark, d).select("event_id", signals.pieces(F.col("us"), cuts).alias("piece"))


@query("SELECT source, CASE WHEN bool_or(doc_id % 50 = 3) THEN min('d' || doc_id || '/clip.npy') FILTER (doc_id % 50 = 3) ELSE min('d' || doc_id || '/a.npy') END AS path, count(*) FILTER (coalesce(length(text), 0) > 0) AS filled FROM documents GROUP BY 1")
def preferred_files(spark, d):
    path = F.concat(F.lit("d"), "doc_id", F.when(F.col("doc_id") % 50 == 3, "/clip.npy").otherwise("/a.npy"))
    rows = table(spark, d, "documents").select("source", path.alias("path"), F.coalesce(F.length("text"), F.lit(0)).alias("length"))
    full = files.nonempty(rows).groupBy("source").agg(F.count("*").alias("filled"))
    return files.preferred(rows, "source", "path").join(full.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), "left").select("source", "path", F.coalesce("filled", F.lit(0)).alias("filled"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'depth' ELSE 'rgb' END AS kind FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_size = 10")
def selected_videos(spark, d):
    rows = files.selected(table(spark, d, "part"), p_type=["ECONOMY", "PROMO"], p_size=10, p_brand=None)
    return rows.select("p_partkey", files.video_kind(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "_Depth.mp4").otherwise("_a.mp4"))).alias("kind"))

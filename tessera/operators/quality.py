"""Consistency of keys across modalities, duplicates, review logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.operators.ranges import numbered


def presence(keys: dict[str, DataFrame], key: str) -> DataFrame:
    """key and a 0/1 column for each modality: one aggregate over a union of keys, no chain of joins."""
    each = [df.select(key).distinct().withColumn("__m", F.lit(m)) for m, df in keys.items()]
    return reduce(DataFrame.unionAll, each).groupBy(key).agg(*[F.max((F.col("__m") == m).cast("int")).alias(m) for m in keys])


def common(keys: dict[str, DataFrame], key: str, union: bool = False) -> DataFrame:
    rows = presence(keys, key)
    return rows.select(key) if union else rows.where(reduce(lambda a, b: a & b, [F.col(m) == 1 for m in keys])).select(key)


def missing(keys: dict[str, DataFrame], key: str) -> DataFrame:
    """key, missing_modalities of the keys that some modality lacks."""
    rows = presence(keys, key)
    gone = F.array_compact(F.array(*[F.when(F.col(m) == 0, F.lit(m)) for m in keys]))
    return rows.select(key, gone.alias("missing_modalities")).where(F.size("missing_modalities") > 0)


def root_report(keys: dict[str, DataFrame], key: str) -> DataFrame:
    """root, n, missing (of the union), extra (beyond the intersection), only_here."""
    rows = presence(keys, key)
    have = sum((F.col(m) for m in keys), F.lit(0))
    flat = rows.withColumn("__have", have).select("__have", F.explode(F.array(*[F.struct(F.lit(m).alias("root"), F.col(m).alias("has")) for m in keys])).alias("r"))
    has = F.col("r.has") == 1
    return flat.groupBy(F.col("r.root").alias("root")).agg(F.count_if(has).alias("n"), F.count_if(~has).alias("missing"), F.count_if(has & (F.col("__have") < len(keys))).alias("extra"), F.count_if(has & (F.col("__have") == 1)).alias("only_here"))


def two_set_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """pos, only_in_a, only_in_b, common: three sorted lists side by side, shorter ones filled with ""."""
    rows = presence({"a": a, "b": b}, key).withColumn("kind", F.when(F.col("b") == 0, "only_in_a").when(F.col("a") == 0, "only_in_b").otherwise("common"))
    rows = numbered(rows.withColumn("__by", F.struct("kind", key)), "__by").drop("__by")
    first = rows.groupBy("kind").agg(F.min("__pos").alias("__first"))  # three rows at most
    rows = rows.join(F.broadcast(first), "kind").withColumn("pos", (F.col("__pos") - F.col("__first") + 1).cast("int"))
    text = F.col(key).cast("string")
    return rows.groupBy("pos").agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, text)), F.lit("")).alias(k) for k in ("only_in_a", "only_in_b", "common")])


def concatenated(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """All rows by column name, with the part's name; columns that a part lacks are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [df.withColumn(name, F.lit(k)) for k, df in parts.items()])


def duplicates(files: DataFrame, content: Column, name: str) -> DataFrame:
    """files with md5, copy_no (1: the first by name), duplicate."""
    rows = files.withColumn("md5", F.md5(content))
    return rows.withColumn("copy_no", F.row_number().over(Window.partitionBy("md5").orderBy(name))).withColumn("duplicate", F.col("copy_no") > 1)


def first_copies(files: DataFrame, same: str, name: str, more: list[str]) -> DataFrame:
    """One row for each value of `same`: that of the least name, with the columns in more. Copies are counted out before rows are moved, so many of one value do no harm."""
    first = F.min(F.struct(name, *more)).alias("__first")
    return files.groupBy(same).agg(first).select(same, *[F.col("__first")[c].alias(c) for c in (name, *more)])


def latest_status(log: DataFrame, key: str, order: str, status: str) -> DataFrame:
    """The last status of each key; UNDO takes back the row before it."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    undone = F.sum(F.when(F.col(status) == "UNDO", 1).otherwise(-1))
    rows = log.withColumn("__u", undone.over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # scanning back, an UNDO raises the debt and a status pays one; the first status beyond all debts counts
    low = F.max(F.col("__u") * -1).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__low", low).where((F.col(status) != "UNDO") & (F.col("__low") >= 1))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__u", "__low")


def not_done(items: DataFrame, log: DataFrame, key: str, status: str, done: tuple[str, ...] = ("PASS",)) -> DataFrame:
    return items.join(log.where(F.col(status).isin(*done)).select(key).distinct(), key, "left_anti")


def rename_plan(segments: DataFrame, old: str, new: Column, parent: str) -> DataFrame:
    """segments with new_name (unique in its parent) and status (unchanged, rename, conflict)."""
    from tessera.functions.names import unique_name

    rows = segments.withColumn("__new", new)
    rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(parent, "__new").orderBy((F.col(old) != F.col("__new")).cast("int"), old)))
    status = F.when(F.col(old) == F.col("__new"), "unchanged").when(F.col("__n") > 1, "conflict").otherwise("rename")
    return rows.withColumns({"new_name": unique_name(F.col("__new"), F.col("__n")), "status": status}).drop("__new", "__n")


def mapped_positions(segments: DataFrame, mapping: DataFrame, subject: str, segment: str) -> DataFrame:
    """segments with run, emg_pos and new_name by the mapping of (subject, run) to emg_pos; those without a mapping or a run are left out."""
    rows = segments.withColumn("run", names.first_run(F.col(segment)))
    return rows.join(mapping.select(subject, "run", "emg_pos"), [subject, "run"]).withColumn("new_name", names.with_position(F.col(segment), F.col("emg_pos")))


def by_run_number(a: DataFrame, b: DataFrame, name: str, path: str, styles: tuple[str, str] = ("camera", "armband")) -> DataFrame:
    """a with path of b's run of the same numbers; of several the least path. Names that aren't runs match nothing."""
    of = lambda df, style: df.withColumn("__r", names.run_range(F.col(name), style)).withColumns({"run_a": F.col("__r.a"), "run_b": F.col("__r.b")}).drop("__r")
    other = of(b, styles[1]).where("run_a is not null").groupBy("run_a", "run_b").agg(F.min(path).alias(path))
    return of(a, styles[0]).join(other, ["run_a", "run_b"])


def not_first_counters(rows: DataFrame, counter: str, order: str, drop: int = 2) -> DataFrame:
    """rows whose counter isn't among the first `drop` distinct ones to appear."""
    first = rows.groupBy(counter).agg(F.min(order).alias("__o")).orderBy("__o").limit(drop).select(counter)
    return rows.join(F.broadcast(first), counter, "left_anti")


def clean_points(points: DataFrame, columns: list[str]) -> DataFrame:
    """Points without nulls or non-finite values that aren't all zero."""
    finite = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in columns])
    zero = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in columns])
    return points.where(finite & ~zero)


def normalised_annotations(df: DataFrame) -> DataFrame:
    """Annotation rows with an action and readable bounds: bounds in order, mark set where nothing says what was handled."""
    from tessera.functions.timeparse import any_to_micros

    pick = lambda a, b: F.coalesce(F.nullif(F.trim(F.col(a)), F.lit("")), F.nullif(F.trim(F.col(b)), F.lit("")))
    s, e = any_to_micros(pick("start_ts", "start")), any_to_micros(pick("end_ts", "end"))
    rows = df.withColumns({"__s": s, "__e": e}).where((F.trim("action") != "") & F.col("__s").isNotNull() & F.col("__e").isNotNull())
    blank = (F.coalesce(F.trim("object"), F.lit("")) == "") & (F.coalesce(F.trim("mark"), F.lit("")) == "")
    return rows.withColumns({"start_us": F.least("__s", "__e"), "end_us": F.greatest("__s", "__e"), "mark": F.when(blank, F.lit("object unclear")).otherwise(F.coalesce("mark", F.lit("")))}).drop("__s", "__e")


def clip_numbers(rows: DataFrame, keys: list[str], order: str, width: int = 6) -> DataFrame:
    """rows with clip: 1-based by order, zero-padded."""
    return rows.withColumn("clip", F.lpad(F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("string"), width, "0"))


def last_event_image(events: DataFrame, t: str, x: str, y: str, p: str, window_us: int) -> DataFrame:
    """win, x, y, p: the last event of each pixel in each window."""
    return events.groupBy(F.floor(F.col(t) / window_us).alias("win"), x, y).agg(F.max_by(p, F.col(t)).alias(p), F.count("*").alias("n"))

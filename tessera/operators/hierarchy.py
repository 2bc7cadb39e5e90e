"""Statistics over the three-tier action hierarchy and over conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names


def blank(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def with_tiers(segments: DataFrame, action: str) -> DataFrame:
    return segments.withColumns({"tier1": names.tier1(F.col(action)), "tier2": names.tier2(F.col(action)), "tier3": names.one_form(F.col(action))})


def joint_counts(df: DataFrame, key: str, light: str, pos: str, lights: tuple[str, ...] = names.LIGHTS, positions: tuple[str, ...] = names.POSITIONS) -> DataFrame:
    """key, total, a column for each light and position, unknown_unknown (either one unknown); one aggregate, no pivot pass."""
    ok = F.col(light).isin(*lights) & F.col(pos).isin(*positions)
    cells = [F.count_if((F.col(light) == a) & (F.col(pos) == b)).alias(f"{a}_{b}") for a in lights for b in positions]
    return df.groupBy(key).agg(F.count("*").alias("total"), *cells, F.count_if(F.coalesce(~ok, F.lit(True))).alias("unknown_unknown")).orderBy(F.desc("total"), key)


def tier_counts(df: DataFrame, tiers: tuple[str, ...] = ("tier1", "tier2", "tier3")) -> DataFrame:
    """tier, label, n: one pass by grouping sets."""
    found = df.groupingSets([[t] for t in tiers], *tiers).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    level = F.lit(None).cast("string")
    for k, t in enumerate(tiers):
        others = sum(1 << (len(tiers) - 1 - j) for j in range(len(tiers)) if j != k)
        level = F.when(F.col("g") == others, F.lit(t)).otherwise(level)
    return found.select(level.alias("tier"), F.coalesce(*tiers).alias("label"), "n")


def split_counts(df: DataFrame, label: str, split: str, splits: tuple[str, ...] = names.SPLITS) -> DataFrame:
    """label, a column for each split, total; rows of other splits don't count."""
    known = df.where(F.col(split).isin(*splits))
    return known.groupBy(label).agg(*[F.count_if(F.col(split) == s).alias(s) for s in splits], F.count("*").alias("total")).orderBy(F.desc("total"), label)


def attribute_counts(df: DataFrame, attrs: list[str], split: str, sep: str = "_") -> DataFrame:
    """split_counts by an attribute, or by several joined; blanks are unknown."""
    return split_counts(df.withColumn("label", F.concat_ws(sep, *[blank(F.col(a)) for a in attrs])), "label", split)


def group_labels(df: DataFrame, gid: str, labels: list[str]) -> DataFrame:
    """gid, n and the sorted distinct values of each label."""
    return df.groupBy(gid).agg(F.count("*").alias("n"), *[F.array_sort(F.collect_set(c)).alias(c) for c in labels])


def groups_per_label(df: DataFrame, label: str, gid: str, rare: int = 3) -> DataFrame:
    return df.groupBy(label).agg(F.countDistinct(gid).alias("n_groups")).withColumn("rare", F.col("n_groups") < rare)


def missing_labels(df: DataFrame, label: str, split: str, splits: tuple[str, ...] = names.SPLITS) -> DataFrame:
    """split, label of each label that a split lacks: from one aggregate by label, with no labels-by-splits join."""
    have = df.groupBy(label).agg(F.collect_set(split).alias("have"))
    return have.select(F.explode(F.array_except(F.array(*map(F.lit, splits)), "have")).alias(split), label)


def mode_first_seen(df: DataFrame, key: str, values: list[str], order: str) -> DataFrame:
    """The most frequent values of each key; of equals those seen first by order."""
    n = df.groupBy(key, *values).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), "__first")
    return n.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__first")


def consistency(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, n_values (null counts as one), conflict."""
    n = F.countDistinct(value) + F.max(F.col(value).isNull().cast("int"))
    return df.groupBy(key).agg(n.alias("n_values")).withColumn("conflict", F.col("n_values") > 1)


def top_n(df: DataFrame, total: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(total), key).limit(n)

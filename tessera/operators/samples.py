"""What makes up a sample: an index over all modalities, its members in a tar shard, and the tables that say which sample is where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names
from tessera.operators.packing import choose_modalities
from tessera.operators.ranges import numbered

FRAMES = ("rgb", "depth")
ARMBANDS = ("mindrove", "emg")


def modality_index(files: DataFrame, key: str, modality: str, part: str, path: str, first: str = "clip.npy") -> DataFrame:
    """key, modality, part, files: one row for each camera of a frame modality, with all its frames by name, and for each side of an armband.

    Armband sides and all other modalities, known or not, have one file: that called `first`, else the least path. Parts other than
    cameras and sides are null; so are those of modalities that have neither.
    """
    m = F.col(modality)
    split = F.when(m.isin(*FRAMES, *ARMBANDS), F.col(part))
    rows = files.where(F.col(path).isNotNull()).groupBy(key, modality, split.alias("part"))
    # of single files a running minimum is kept, so a folder of many candidates gathers nothing
    frames = F.array_sort(F.collect_list(F.when(m.isin(*FRAMES), F.col(path))))
    one = F.min_by(path, F.struct(~F.substring_index(F.col(path), "/", -1).eqNullSafe(F.lit(first)), F.col(path)))
    return rows.agg(F.when(m.isin(*FRAMES), frames).otherwise(F.array(one)).alias("files"))


def chosen(index: DataFrame, modality: str, want: list[str], cams: list[str] = (), cams_apply: tuple[str, ...] = FRAMES) -> DataFrame:
    """The index rows of the wanted modalities; of those in cams_apply only the cameras in cams (with or without cam_; none: all)."""
    rows = index.where(F.when(F.col(modality).isin(*ARMBANDS), "emg").otherwise(F.col(modality)).isin(*choose_modalities(want)))
    if not cams:
        return rows
    plain = [c.removeprefix("cam_") for c in cams]
    return rows.where(~F.col(modality).isin(*cams_apply) | F.regexp_replace("part", "^cam_", "").isin(*plain))


def members(index: DataFrame, key: str, modality: str) -> DataFrame:
    """key, modality, member, path: frames as key.rgb_cam.000000.ext, others as key.lidar.npy or key.emg_left.npy, and labels and meta
    (modality and path null) of each key. meta is JSON of what the sample has. Keys without any file have no rows.
    """
    kept = index.where(F.size("files") > 0).withColumn("__m", F.when(F.col(modality).isin(*ARMBANDS), "emg").otherwise(F.col(modality)))
    each = kept.select(key, "__m", "part", F.posexplode("files").alias("__i", "path"))
    frame = F.col("__m").isin(*FRAMES)
    stem = F.concat(F.col(key).cast("string"), F.lit("."), F.col("__m"))
    side = F.when(F.col("part").isNull(), F.lit("")).otherwise(F.concat(F.lit("_"), F.regexp_replace("part", "^cam_", "")))
    place = F.concat(F.lit("."), F.lpad(F.col("__i").cast("string"), 6, "0"), F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)))
    files = each.select(key, F.col("__m").alias("modality"), F.concat(stem, side, F.when(frame, place).otherwise(F.lit(".npy"))).alias("member"), "path", F.lit(None).cast("string").alias("content"))
    has = kept.groupBy(key).agg(F.array_sort(F.collect_set("__m")).alias("has"))
    none = F.lit(None).cast("string")
    notes = has.select(key, none.alias("modality"), F.explode(F.array(
        F.struct(F.concat(F.col(key).cast("string"), F.lit(".labels.json")).alias("member"), F.to_json(names.labels_from_key(F.col(key).cast("string"))).alias("content")),
        F.struct(F.concat(F.col(key).cast("string"), F.lit(".meta.json")).alias("member"), F.to_json(F.struct("has")).alias("content")),
    )).alias("x")).select(key, "modality", "x.member", none.alias("path"), "x.content")
    return files.unionByName(notes)


def run_map(segments: DataFrame, person: str, token: str, group: str, split: str) -> DataFrame:
    """pos, person, run token, group, split, n_segments of each group of runs: by person, the run's first number (none: last), token, group."""
    rows = segments.groupBy(group).agg(F.min(person).alias(person), F.min(token).alias(token), F.min(split).alias(split), F.count("*").alias("n_segments"))
    rows = numbered(rows.withColumn("__by", F.struct(person, run_order(F.col(token)).alias("o"), group)), "__by")
    return rows.select(F.col("__pos").alias("pos"), person, token, group, split, "n_segments")


def run_order(token: Column) -> Column:
    """struct<number, token>: runs in order of their first number; other names come last, by name."""
    return F.struct(F.coalesce(names.run_range(token)["first"], F.lit(10**9)).alias("number"), token.alias("token"))


def examples(rows: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """group, n, examples: the first `most` values in order. A group's rows never come together: only its first values do."""
    each = rows.groupBy(group, value).agg(F.count("*").alias("__c"))
    first = each.withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(value))).where(F.col("__k") <= most)
    first = first.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    return rows.groupBy(group).agg(F.count("*").alias("n")).join(first, group)

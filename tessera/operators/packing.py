"""Sample plans and tar shards."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import tar_bytes
from tessera.operators.ranges import numbered, ranged, written


def frame_ordinals(frames: DataFrame, key: str, cam: str, name: str) -> DataFrame:
    """frames with frame_no, from 0 by name in each camera."""
    return frames.withColumn("frame_no", F.row_number().over(Window.partitionBy(key, cam).orderBy(name)) - 1)


def camera_map(frames: DataFrame, key: str, cam: str, name: str) -> DataFrame:
    """key, cams: map of camera to (sorted names, their number)."""
    each = frames.groupBy(key, cam).agg(F.array_sort(F.collect_list(name)).alias("frames"))
    return each.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(cam), F.struct("frames", F.size("frames").alias("n_frames")))))).alias("cams"))


def camera_filter(cams: Column, allowed: list[str]) -> Column:
    """The cameras named in allowed, with or without cam_."""
    plain = [a.removeprefix("cam_") for a in allowed]
    return F.map_filter(cams, lambda k, v: F.regexp_replace(k, "^cam_", "").isin(*plain))


def choose_modalities(want: list[str], known: tuple[str, ...] = ("rgb", "depth", "lidar", "emg")) -> list[str]:
    got = [w for w in want if w in known]
    if not got:
        raise ValueError(f"none of {want} is among {known}")
    return got


def canonical(modalities: dict[str, str]) -> str:
    return "rgb" if "rgb" in modalities else min(modalities)


def members(frames: DataFrame, key: str, modality: str, cam: str, name: str) -> DataFrame:
    """frames with member: key.modality_cam.000000.ext"""
    rows = frame_ordinals(frames, key, cam, name)
    ext = F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1))
    return rows.withColumn("member", F.concat(F.col(key).cast("string"), F.lit(f".{modality}_"), F.col(cam), F.lit("."), F.lpad(F.col("frame_no").cast("string"), 6, "0"), ext))


def sample_bytes(rows: DataFrame, key: str, size: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n_members"), F.sum(tar_bytes(F.col(size))).alias("bytes"))


def shards_by_count(samples: DataFrame, key: str, per_shard: int) -> DataFrame:
    """samples with shard: `per_shard` each, by key over all samples."""
    return numbered(samples, key).withColumn("shard", F.floor(F.col("__pos") / per_shard).cast("long")).drop("__pos")


def cuts(sizes: np.ndarray, most: int, per_shard: int | None) -> np.ndarray:
    """next[i]: where the shard that starts at sample i ends (the first sample of the next one; len(sizes): not in this range)."""
    n = len(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    found = np.searchsorted(ends, ends[:-1] + most, side="right") - 1
    at = np.maximum(found, np.arange(1, n + 1))
    return np.minimum(at, np.arange(n) + per_shard) if per_shard else at


def carried(sizes: np.ndarray, most: int, per_shard: int | None) -> dict[str, list[int]]:
    """What a range does to a shard that is open when the range begins, for every state that may be: a map, small enough to move.

    The open shard is cut before one of the first samples, which ones depends on the bytes and samples that it has; from a cut on all is
    known. ends[i]: bytes before sample i; after a cut before sample i, n[i] cuts follow in the range and the shard open at the end has
    used[i] bytes and held[i] samples. Only samples that may be cut before are listed: no more than fit into a shard, and one.
    The last entry of ends is of the whole range where no cut is needed.
    """
    count = len(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    reach = int(np.searchsorted(ends, most, side="right"))  # cut before sample reach - 1 at the latest, or not at all
    if per_shard:
        reach = min(reach, per_shard)
    reach = min(reach, count)
    after = cuts(sizes, most, per_shard).tolist()
    n, used, held = [0] * count, [0] * count, [0] * count
    for i in range(count - 1, -1, -1):
        j = after[i]
        n[i], used[i], held[i] = (1, int(ends[-1] - ends[i]), count - i) if j >= count else (n[j] + 1, used[j], held[j])
    return {"rows": count, "bytes": int(ends[-1]), "ends": ends[1 : reach + 1].tolist(), "n": n[:reach], "used": used[:reach], "held": held[:reach]}


def step(state: tuple[int, int, int], run: dict, most: int, per_shard: int | None) -> tuple[int, int, int]:
    """(shard, used, held) after a range, from that before it; held 0: no shard is open."""
    shard, used, held = state
    if not held:
        return shard + run["n"][0] - 1, run["used"][0], run["held"][0]
    first = bisect.bisect_right(run["ends"], most - used)
    if per_shard:
        first = min(first, per_shard - held)
    if first >= run["rows"]:
        return shard, used + run["bytes"], held + run["rows"]
    return shard + run["n"][first], run["used"][first], run["held"][first]


def shards_by_bytes(samples: DataFrame, group: str, key: str, size: str, most: int, per_shard: int | None = None) -> DataFrame:
    """group, key, shard: a shard is cut before the sample that would take it over `most` bytes, or over per_shard samples.

    Samples of one group (a split, say) stand in many ranges. Each range says what it does to any shard that may be open when it
    begins (`carried`: no more entries than samples fit into a shard); the maps of a group go by in order and give each range
    the shard it begins with; then all ranges are cut at once. Sizes are not negative; null counts as 0. Written when called.
    """
    keyed = samples.select(group, key, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("__size"))
    placed = ranged(keyed, group, key)
    kind = samples.schema[group].dataType.simpleString()

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__row")
        out = carried(pdf["__size"].to_numpy(np.int64), most, per_shard)
        return pd.DataFrame({group: pdf[group].iloc[:1], "__part": pdf["__part"].iloc[:1], **{k: [v] for k, v in out.items()}})

    runs = placed.groupBy(group, "__part").applyInPandas(summary, f"{group} {kind}, __part long, rows long, bytes long, ends array<long>, n array<long>, used array<long>, held array<long>")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = object(), (0, 0, 0)
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                mark = None if pd.isna(r[group]) else r[group]
                if mark != current:
                    current, state = mark, (0, 0, 0)
                out.append(state)
                state = step(state, r, most, per_shard)
            yield b[[group, "__part"]].assign(**{c: [s[k] for s in out] for k, c in enumerate(("shard", "used", "held"))})

    begins = written(runs.repartition(group).sortWithinPartitions(group, "__part").mapInPandas(fold, f"{group} {kind}, __part long, shard long, used long, held long"), "shard-starts")

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("__row")
        sizes, (shard, used, held) = left["__size"].to_numpy(np.int64), right[["shard", "used", "held"]].iloc[0]
        after, starts, at = cuts(sizes, most, per_shard), np.zeros(len(sizes), np.int64), 0
        if held:
            ends = np.cumsum(sizes)
            at = int(np.searchsorted(ends, most - used, side="right"))
            at = min(at, per_shard - held) if per_shard else at
        else:
            shard -= 1
        while at < len(sizes):
            starts[at], at = 1, int(after[at])
        return left[[group, key]].assign(shard=shard + np.cumsum(starts))

    schema = f"{group} {kind}, {key} {samples.schema[key].dataType.simpleString()}, shard long"
    return placed.groupBy(group, "__part").cogroup(begins.groupBy(group, "__part")).applyInPandas(cut, schema)


def member_offsets(rows: DataFrame, shard: str, key: str, member: str, size: str) -> DataFrame:
    """rows with offset_data: where a member's bytes start in its shard's tar."""
    w = Window.partitionBy(shard).orderBy(key, member).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset_data", F.coalesce(F.sum(tar_bytes(F.col(size))).over(w), F.lit(0)) + 512)


def member_index(rows: DataFrame, shard: str, member: str) -> DataFrame:
    """shard, key (the member's name before its first dot), sorted members."""
    return rows.withColumn("key", F.substring_index(member, ".", 1)).groupBy(shard, "key").agg(F.array_sort(F.collect_list(member)).alias("members"))


def pad_rows(frames: DataFrame, clip: str, points: str, fill: Column) -> DataFrame:
    """frames with points padded to the longest of their clip; ragged says whether any was shorter."""
    from tessera.functions.numeric import padded

    w = Window.partitionBy(clip)
    rows = frames.withColumns({"max_rows": F.max(F.size(points)).over(w), "ragged": F.min(F.size(points)).over(w) < F.max(F.size(points)).over(w)})
    return rows.withColumn(points, padded(F.col(points), F.col("max_rows"), fill))

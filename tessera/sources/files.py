"""Recordings on any file system that Spark reads: folder trees, time-stamped frames, CSVs, manifests, radar packets.

All listings select only path and length of ``binaryFile``, so no content is read; contents are decoded by Spark's readers or,
for binary packets, in Arrow batches. XDF, event-camera RAW and images are in ``recordings``, HDF5 in ``hdf5``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.functions import names, timeparse

# Column aliases of point files and the columns of armband files.
ALIASES = {"x": ("x", "px", "posx"), "y": ("y", "py", "posy"), "z": ("z", "pz", "posz"), "intensity": ("intensity", "i", "reflectivity", "r", "int")}
ARMBAND = "board_ts double, emg1 double, emg2 double, emg3 double, emg4 double, emg5 double, emg6 double, emg7 double, emg8 double, acc_x double, acc_y double, acc_z double, gyro_x double, gyro_y double, gyro_z double"
IMAGES = ("jpg", "jpeg", "png")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length and mtime of all files below root, without their content. Spark lists no empty files, so folders that hold nothing else don't appear."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return df.select("path", "length", F.col("modificationTime").alias("mtime"))


def relative(path: Column, root: str) -> Column:
    """The parts of a path below root."""
    tail = root.rstrip("/").rpartition("/")[2]
    return F.split(F.regexp_extract(path, f"^.*?/{tail}/(.*)$", 1), "/")


def segments(files: DataFrame, root: str, persons: tuple[str, ...] | None = None, ignore_actions: tuple[str, ...] = (), ignore_segments: tuple[str, ...] = ()) -> DataFrame:
    """One row a segment folder of root/person/action/segment/..., with everything its names say."""
    p = relative(F.col("path"), root)
    rows = files.select(p.alias("p")).where(F.size("p") >= 4).select(*[F.get("p", F.lit(k)).alias(c) for k, c in enumerate(("person", "action", "segment"))]).distinct()
    rows = rows.where(~F.col("action").startswith(".") & ~F.col("segment").startswith("."))
    if persons:
        rows = rows.where(F.col("person").isin(*persons))
    if ignore_actions:
        rows = rows.where(~F.col("action").isin(*ignore_actions))
    if ignore_segments:
        rows = rows.where(~F.col("segment").isin(*ignore_segments))
    base = names.without_npy(F.col("segment"))
    return rows.withColumns({
        "tier1": names.tier1(F.col("action")), "tier2": names.tier2(F.col("action")), "tier3": names.one_form(F.col("action")), "run_token": names.run_token(base),
        "lighting": names.lighting(base), "pos": names.position(base), "group_uid": names.group_uid(F.col("person"), names.run_token(base)), "key": names.split_key(F.col("person"), F.col("action"), F.col("segment")),
    })


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def frames(files: DataFrame, suffix: str = "", extensions: tuple[str, ...] = (), zone: str | None = None) -> DataFrame:
    """path, folder, name, t (epoch seconds) of files with a plausible stamp in their name."""
    name = F.substring_index("path", "/", -1)
    rows = files.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), name.alias("name"))
    if suffix:
        rows = rows.where(F.col("name").endswith(suffix))
    if extensions:
        rows = rows.where(extension(F.col("name")).isin(*extensions))
    return rows.withColumn("t", timeparse.name_to_epoch(F.col("name"), zone)).where(timeparse.plausible(F.col("t")))


def leaf_folders(files: DataFrame, extensions: tuple[str, ...] = IMAGES) -> DataFrame:
    """Folders that hold images and have no folder below them that does: the ancestors of all image folders are taken out by an equality anti join."""
    dirs = files.where(extension(F.col("path")).isin(*extensions)).select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = dirs.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("folder")).distinct()
    return dirs.join(above, "folder", "left_anti")


def clips_with_frames(files: DataFrame, root: str, cam: str, people: tuple[str, ...] = ("N", "M", "MR", "J")) -> DataFrame:
    """person, action, clip, n_frames of clips whose camera folder has images; people in the given order."""
    p = relative(F.col("path"), root)
    rows = files.where(extension(F.col("path")).isin(*IMAGES)).select(p.alias("p")).where((F.size("p") >= 5) & (F.get("p", F.lit(3)) == cam))
    rows = rows.groupBy(*[F.get("p", F.lit(k)).alias(c) for k, c in enumerate(("person", "action", "clip"))]).agg(F.count("*").alias("n_frames"))
    return rows.withColumn("person_order", F.array_position(F.array(*map(F.lit, people)), F.col("person"))).where("person_order > 0")


def nonempty(files: DataFrame) -> DataFrame:
    """Files with something in them."""
    return files.where(F.col("length") > 0)


def selected(rows: DataFrame, **only: str | list | tuple | None) -> DataFrame:
    """rows whose columns have one of the given values; None or nothing given: all. Partition columns prune the files that are read."""
    for column, values in only.items():
        if values is not None:
            rows = rows.where(F.col(column).isin(*([values] if isinstance(values, str) or not hasattr(values, "__iter__") else values)))
    return rows


def action_pairs(files: DataFrame, root: str, ignore_actions: tuple[str, ...] = (), ignore_segments: tuple[str, ...] = (), remove: tuple[str, ...] = ("_npy", "_mid")) -> DataFrame:
    """action, segment (in its one form) of root/action/segment/...; names to ignore are the raw ones."""
    p = relative(F.col("path"), root)
    rows = files.select(p.alias("p")).where(F.size("p") >= 3).select(F.get("p", F.lit(0)).alias("action"), F.get("p", F.lit(1)).alias("raw")).distinct()
    rows = rows.where(~F.col("action").startswith(".") & ~F.col("raw").startswith(".") & ~F.col("action").isin(*ignore_actions) & ~F.col("raw").isin(*ignore_segments))
    return rows.select("action", names.normalize_segment(F.col("raw"), remove).alias("segment")).distinct()


def csv_folders(files: DataFrame, sides: tuple[str, ...] = ()) -> DataFrame:
    """Folders that hold a CSV; with sides, those with a clip.csv in a folder of one of these names."""
    if sides:
        found = files.select(F.regexp_extract("path", rf"^(.*)/(?:{'|'.join(sides)})/clip\.csv$", 1).alias("folder")).where("folder <> ''")
    else:
        found = files.where(extension(F.col("path")) == "csv").select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))
    return found.distinct()


def cloud_frames(files: DataFrame, zone: str | None = None) -> DataFrame:
    """file, t of *_cloud.csv point clouds; one whose name is no stamp is an error."""
    name = F.substring_index("path", "/", -1)
    rows = files.select(F.col("path").alias("file"), name.alias("name")).where(F.col("name").endswith("_cloud.csv"))
    return rows.select("file", timeparse.strict_epoch(F.regexp_replace("name", r"_cloud\.csv$", ""), zone).alias("t"))


# Fixed value: the name of an annotation file of a run or a range of runs.
RUN_ANNOTATION = r"(?i)^N_run_(\d+)(?:-(\d+))?_annotationlight\.csv$"


def run_annotation(files: DataFrame, folder: str, name: str, rule: str = "narrowest") -> DataFrame:
    """folder, name: the one annotation file of each run folder. narrowest: of those named strictly the narrowest range of runs, then
    the smallest run; first: of all *annotationlight.csv but copies, the first by lower-case name."""
    low = F.lower(name)
    if rule == "first":
        return files.where(low.endswith("annotationlight.csv") & ~low.contains("copy")).groupBy(folder).agg(F.min_by(name, F.struct(low, F.col(name))).alias(name))
    a = F.nullif(F.regexp_extract(name, RUN_ANNOTATION, 1), F.lit("")).cast("long")
    b = F.coalesce(F.nullif(F.regexp_extract(name, RUN_ANNOTATION, 2), F.lit("")).cast("long"), a)
    return files.where(a.isNotNull()).groupBy(folder).agg(F.min_by(name, F.struct(F.abs(b - a), F.least(a, b), F.col(name))).alias(name))


def preferred(files: DataFrame, group: str, path: str, first: str = "clip.npy") -> DataFrame:
    """The file of each group that is called `first`, else the least path."""
    return files.groupBy(group).agg(F.min_by(path, F.struct(~F.col(path).endswith(f"/{first}"), F.col(path))).alias(path))


def whole_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, text (without a byte order mark) of small files."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\ufeff", "").alias("text"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """file, row, action, object, start, end, start_ts, end_ts, mark of annotation CSVs.

    A file has a header if its first 4096 characters name both action and object; its columns are then found by name,
    else by place (1, 2, 5, 6, 9, or 3 and 4 for the bounds where there are too few columns).
    """
    t = whole_texts(spark, path, "*.csv").where(~F.lower(F.substring_index("file", "/", -1)).contains("copy"))
    head = F.lower(F.substring("text", 1, 4096))
    t = t.select("file", F.filter(F.split("text", "\r?\n"), lambda x: F.trim(x) != "").alias("lines"), (head.contains("action") & head.contains("object")).alias("header"))
    fields = lambda line: F.transform(F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1), lambda x: F.regexp_replace(F.trim(x), '^"|"$', ""))
    t = t.withColumn("names", F.when(F.col("header"), F.transform(fields(F.get("lines", F.lit(0))), lambda x: F.lower(x))))
    rows = t.select("file", "header", "names", F.posexplode(F.when(F.col("header"), F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(F.col("lines"))).alias("row", "line")).withColumn("f", fields(F.col("line")))

    def column(name: str, place: int | None, other: int | None = None) -> Column:
        by_name = F.get("f", (F.array_position("names", F.lit(name)) - 1).cast("int"))
        by_name = F.when(F.array_contains("names", F.lit(name)), by_name)
        by_place = F.lit(None).cast("string") if place is None else F.get("f", F.lit(place)) if other is None else F.when(F.size("f") > place, F.get("f", F.lit(place))).otherwise(F.get("f", F.lit(other)))
        return F.when(F.col("header"), by_name).otherwise(by_place)

    return rows.select("file", "row", *[column(n, *at).alias(n) for n, at in {"action": (1,), "object": (2,), "start": (5, 3), "end": (6, 4), "start_ts": (None,), "end_ts": (None,), "mark": (9,)}.items()])


def armband(spark: SparkSession, path: str, least: int = 10) -> DataFrame:
    """Armband samples by time, the first of each time; error is set for files of fewer than `least` valid rows."""
    df = spark.read.schema(ARMBAND).option("header", "true").option("enforceSchema", "false").option("mode", "PERMISSIVE").csv(path).withColumn("file", F.col("_metadata.file_path"))
    df = df.where(F.col("board_ts").isNotNull() & ~F.isnan("board_ts") & (F.abs("board_ts") < float("inf"))).withColumn("__o", F.monotonically_increasing_id())
    df = df.withColumn("__n", F.row_number().over(Window.partitionBy("file", "board_ts").orderBy("__o"))).where("__n = 1").drop("__n", "__o")
    return df.withColumn("error", F.when(F.count("*").over(Window.partitionBy("file")) < least, F.lit("too few rows")))


def sample_times(spark: SparkSession, path: str, column: str = "board_ts", zone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(file, t in microseconds; file, n_bad, examples) of the time column of sample files that have one header.

    A file whose values are all numbers has epoch seconds, and null where a value is missing. Any other has stamps or ISO dates and times, local to
    zone (UTC without one); there a value that is neither, or missing, makes the whole file an error, with five such values in order. Sort by t to have them in order.
    """
    df = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.trim(F.col(f"`{column}`")).alias("text"))
    number = F.when(~F.lower("text").isin("nan", ""), F.col("text")).try_cast("double")
    missing = F.col("text").isNull() | F.lower("text").isin("nan", "")
    kind = rows.groupBy("file").agg(F.bool_and(missing | (number.isNotNull() & (F.abs(number) < float("inf")))).alias("numeric"))
    rows = rows.join(kind, "file")
    us = F.when(F.col("numeric"), F.rint(number * 1e6).cast("long")).otherwise(timeparse.normalised(F.col("text"), zone))
    rows = rows.withColumn("t", us).withColumn("bad", ~F.col("numeric") & F.col("t").isNull())
    wrong = rows.where("bad").groupBy("file", F.coalesce("text", F.lit("")).alias("text")).agg(F.count("*").alias("n"))
    first = wrong.withColumn("k", F.row_number().over(Window.partitionBy("file").orderBy("text")))
    errors = first.groupBy("file").agg(F.sum("n").alias("n_bad"), F.array_sort(F.collect_list(F.when(F.col("k") <= 5, F.col("text")))).alias("examples"))
    return rows.join(errors.select("file"), "file", "left_anti").select("file", "t"), errors


def points(spark: SparkSession, path: str) -> DataFrame:
    """file, x, y, z, intensity of point CSVs: by header aliases where the first row isn't numbers, else by place; bad and all-zero rows go."""
    raw = spark.read.option("header", "false").schema("a string, b string, c string, d string").csv(path).withColumn("file", F.col("_metadata.file_path"))
    head = raw.where(F.col("a").try_cast("double").isNull() & F.lower("a").rlike("^[a-z]")).groupBy("file").agg(*[F.first(F.lower(F.trim(c))).alias(f"h{c}") for c in "abcd"])
    rows = raw.join(head, "file", "left")
    out = []
    for k, (name, known) in enumerate(ALIASES.items()):
        place = "abcd"[k]
        by_name = F.coalesce(*[F.when(F.col(f"h{c}").isin(*known), F.col(c)) for c in "abcd"])
        out.append(F.when(F.col("ha").isNotNull(), by_name).otherwise(F.col(place)).try_cast("double").alias(name))
    from tessera.operators.quality import clean_points

    return clean_points(rows.select("file", *out), list(ALIASES))


def run_light(spark: SparkSession, path: str) -> DataFrame:
    """run, light, conflict (more than one light, null counting as one) of the global mapping."""
    df = spark.read.option("header", "true").csv(path).select(names.run_key(F.col("run")).alias("run"), "light")
    n = F.countDistinct("light") + F.max(F.col("light").isNull().cast("int"))
    return df.groupBy("run").agg(F.max("light").alias("light"), (n > 1).alias("conflict"))


def run_positions(spark: SparkSession, path: str) -> DataFrame:
    """subject, run, emg_pos: the last row of each; bad rows fail."""
    df = spark.read.option("header", "true").csv(path).withColumn("__o", F.monotonically_increasing_id()).where(F.trim("subject") != "")
    ok = F.col("run").rlike(r"^\s*\d+\s*$") & F.col("emg_pos").isin(*names.POSITIONS)
    df = df.withColumn("run", F.when(ok, F.trim("run").cast("int")).otherwise(F.raise_error(F.concat(F.lit("bad mapping row: "), F.coalesce("run", F.lit("null"))))))
    return df.groupBy("subject", "run").agg(F.max_by("emg_pos", "__o").alias("emg_pos"))


def manifest(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """file, key, entry of JSON objects used as dictionaries. value: the Spark type of an entry."""
    return whole_texts(spark, path, "*.json").select("file", F.explode(F.from_json("text", f"map<string,{value}>")).alias("key", "entry"))


def cameras(spark: SparkSession, path: str) -> DataFrame:
    """key, cams (camera -> frames, n_frames, frame_dir) of cam_*.json; without frames no entry, of equal keys the later file counts."""
    rows = manifest(spark, path, "struct<cam:string,frames:array<string>,n_frames:int,frame_dir:string>").where(F.size("entry.frames") > 0)
    last = rows.groupBy("key", F.col("entry.cam").alias("cam")).agg(F.max_by(F.struct("entry.frames", "entry.n_frames", "entry.frame_dir"), "file").alias("e"))
    return last.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cam", "e")))).alias("cams"))


def split_samples(spark: SparkSession, path: str) -> DataFrame:
    """file, key, entry (JSON text) of split files {__meta__, samples}."""
    return whole_texts(spark, path, "*.json").select("file", F.explode(F.from_json(F.get_json_object("text", "$.samples"), "map<string,string>")).alias("key", "entry"))


def radar_packets(spark: SparkSession, path: str) -> DataFrame:
    """file, no, frame_counter, i, q of .dat recordings: records of a 24-byte head (two unsigned ints, four floats; the second int is
    the number of bins) and two float arrays. A truncated last record ends the file."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.dat").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, data in zip(b["path"], b["content"], strict=True):
                at, out = 0, []
                while at + 24 <= len(data):
                    counter, bins, *_ = struct.unpack_from("=IIffff", data, at)
                    if at + 24 + 8 * bins > len(data):
                        break
                    iq = np.frombuffer(data, "<f4", 2 * bins, at + 24).astype(float)
                    out.append((file, len(out), counter, iq[:bins].tolist(), iq[bins:].tolist()))
                    at += 24 + 8 * bins
                yield pd.DataFrame(out, columns=["file", "no", "frame_counter", "i", "q"])

    return raw.mapInPandas(run, "file string, no long, frame_counter long, i array<double>, q array<double>")


def npy_arrays(spark: SparkSession, path: str) -> DataFrame:
    """file, shape, dtype, values (flat) of .npy files."""
    import io

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            a = [np.load(io.BytesIO(x), allow_pickle=False) for x in b["content"]]
            yield pd.DataFrame({"file": b["path"], "shape": [list(x.shape) for x in a], "dtype": [str(x.dtype) for x in a], "values": [x.astype(float).ravel().tolist() for x in a]})

    return raw.mapInPandas(run, "file string, shape array<int>, dtype string, values array<double>")


def numeric_rows(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """file, row, values of CSVs of numbers alone: a first line that isn't numbers is a header and goes; any other such line fails."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__s"), F.monotonically_increasing_id().alias("__o"), F.split("value", F.lit(sep)).alias("f"))
    numbers = F.transform("f", lambda x: F.trim(x).try_cast("double"))
    order = Window.partitionBy("file").orderBy("__s", "__o")
    rows = lines.select("file", F.row_number().over(order).alias("row"), numbers.alias("values"))
    bad = F.exists("values", lambda x: x.isNull())
    rows = rows.where((F.col("row") > 1) | ~bad)
    return rows.withColumn("values", F.when(bad, F.raise_error(F.concat(F.lit("not numbers: "), "file", F.lit(" line "), F.col("row").cast("string")))).otherwise(F.col("values")))


def numeric_columns(spark: SparkSession, path: str) -> DataFrame:
    """The columns of CSVs with a header that hold numbers throughout; none is an error."""
    df = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    kept = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    if not kept:
        raise ValueError(f"{path}: no column of numbers")
    return df.select(*[F.col(f"`{c}`") for c in kept])


def review_log(spark: SparkSession, path: str, style: str = "csv") -> DataFrame:
    """key, status, comment of review logs: csv, tsv, or fixed (columns of white space); a missing status is SKIP."""
    if style == "fixed":
        p = F.split(F.trim("value"), r"\s+")
        rows = spark.read.text(path).select(F.get(p, F.lit(0)).alias("key"), F.get(p, F.lit(1)).alias("status"), F.array_join(F.slice(p, F.lit(3), F.greatest(F.size(p) - 2, F.lit(0))), " ").alias("comment")).where("key <> ''")
    else:
        rows = spark.read.option("sep", "\t" if style == "tsv" else ",").schema("key string, status string, comment string").csv(path)
    return rows.withColumn("status", F.coalesce(F.nullif(F.upper(F.trim("status")), F.lit("")), F.lit("SKIP")))


def video_kind(name: Column) -> Column:
    return F.when(F.lower(name).contains("depth"), F.lit("depth")).otherwise(F.lit("rgb"))

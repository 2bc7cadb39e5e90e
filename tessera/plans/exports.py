"""What a subject's recordings become on disk: clean armband tables with their summaries, the manifest of segments, fixed-width review logs."""

from __future__ import annotations

from collections.abc import Iterator
from struct import error as StructError
from xml.etree.ElementTree import ParseError

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import dsp
from tessera.sources import actions, files, recordings, sinks

TIME, EMG, ACC, GYRO = "board_ts", [f"emg{k}" for k in range(1, 9)], ["acc_x", "acc_y", "acc_z"], ["gyro_x", "gyro_y", "gyro_z"]
#: The columns of a manifest of segments, in order.
MANIFEST = ["person", "action_raw", "segment_raw", "segment_base", "tier3", "tier2", "tier1", "run_token", "group_uid", "lighting", "pos", "split"]
FOUND = "file string, side string, n_samples long, no long, row array<double>, error string"


def clean_armband(t: np.ndarray, x: np.ndarray, emg: bool = True, imu: bool = True, target: float | None = None, imu_cut: float = 20.0, imu_order: int = 4, **options) -> np.ndarray:
    """Samples x channels (board time, eight EMG, three accelerometer, three gyroscope, others unread) to the table that is exported.

    EMG goes through dsp.clean_emg (options are its own), the others lose their mean and what is above imu_cut; both are resampled to
    `target` where it is given. All columns end where the shortest does, board times are the recorded ones, in order.
    """
    if x.shape[1] < 15:
        raise ValueError(f"{x.shape[1]} channels, 15 asked for")
    step = np.median(np.diff(t)) if len(t) > 1 else 0.0
    if not step > 0:
        raise ValueError("no sampling rate")
    fs = 1.0 / step
    low = dsp.butterworth(imu_order, fs, high=min(imu_cut, 0.9 * fs / 2))
    kernels = ([lambda c: dsp.clean_emg(c, fs, **options)] * 8 if emg else [None] * 8) + [(lambda c: dsp.zero_phase(low, c - c.mean())) if imu else None] * 6
    out = [k(x[:, n]) for n, k in enumerate(kernels, 1) if k is not None]
    if target is not None and abs(target - fs) > 1e-9:
        out = [dsp.resample(c, round(target), round(fs)) for c in out]
    n = min([len(x), *map(len, out)])
    return np.column_stack([x[:n, 0], *[c[:n] for c in out]])


def cleaned_armbands(recorded: DataFrame, sides: dict[str, str], emg: bool = True, imu: bool = True, **options) -> DataFrame:
    """file, side, n_samples, no, row, error of XDF recordings (path, length); sides: side -> the name of its stream, the first of that name.

    A row without `no` says of a recording or a side how many samples it has, or by `error` why it has no table: samples never meet
    across recordings, so a recording is read and cleaned by one task and nothing is shuffled. One that can't be read is an error row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = FOUND.replace(",", "").split()[::2]
        for b in batches:
            for path, length in zip(b["path"], b["length"], strict=True):
                try:
                    streams = [s for _, s in sorted(recordings.xdf_streams(recordings.part_of_file(path, 0, int(length))).items())]
                except (ValueError, KeyError, IndexError, StructError, ParseError) as e:
                    yield pd.DataFrame([(path, None, None, None, None, f"can't be read: {e}")], columns=names)
                    continue
                chosen = {side: next((s for s in streams if s["name"] == name), None) for side, name in sides.items()}
                if not any(chosen.values()):
                    yield pd.DataFrame([(path, None, None, None, None, "no stream of a side")], columns=names)
                for side, s in chosen.items():
                    if s is None:
                        continue
                    n, rows, error = len(s["times"]), np.empty((0, 0)), None
                    try:
                        t = recordings.without_jitter(recordings.clock_synchronised(np.array(s["times"], float), s["offsets"]), s["rate"])
                        rows = clean_armband(t, np.array(s["values"], float).reshape(n, -1), emg, imu, **options)
                    except ValueError as e:
                        error = str(e)
                    yield pd.DataFrame([(path, side, n, None, None, error)], columns=names)
                    for k in range(0, len(rows), recordings.ROWS):
                        part = rows[k : k + recordings.ROWS]
                        yield pd.DataFrame({"file": path, "side": side, "n_samples": n, "no": np.arange(k, k + len(part)), "row": part.tolist(), "error": None}, columns=names)

    return recorded.select("path", "length").repartition(F.xxhash64("path")).mapInPandas(run, FOUND)


def armband_tables(spark: SparkSession, root: str, path: str, sides: dict[str, str], emg: bool = True, imu: bool = True, **options) -> DataFrame:
    """Exports the recordings below root that have no summary yet; file, stem, status of all: OK, SKIP (done before) or FAIL and why.

    `path`/csv/<stem>/<side>/<name>_<side>_emg_imu.csv has seven digits a value, `path`/summaries/<stem>_summary.txt says how many samples
    each side had and how many rows were written; <stem> is the recording's path below root. A summary is written last, and a
    recording that fails gets neither, so a call after a crash does what is left. In `tables` lies what the tasks made, for one call.
    """
    found = files.listing(spark, root, "*.xdf").select("path", "length").withColumn("stem", F.regexp_replace(F.array_join(files.relative(F.col("path"), root), "/"), r"\.xdf$", ""))
    todo = found
    if actions._is_written(spark, f"{path}/summaries/.files"):
        done = files.listing(spark, f"{path}/summaries", "*_summary.txt").select(F.regexp_replace(F.array_join(files.relative(F.col("path"), f"{path}/summaries"), "/"), r"_summary\.txt$", "").alias("stem"))
        todo = found.join(done, "stem", "left_anti")
    made = sinks.written(cleaned_armbands(todo, sides, emg, imu, **options).join(todo.select(F.col("path").alias("file"), "stem"), "file"), "armbands")
    errors = made.where("error is not null").groupBy("file").agg(F.min("error").alias("error"))
    good = made.join(errors, "file", "left_anti")
    columns = [TIME, *(EMG if emg else []), *(ACC + GYRO if imu else [])]
    name = F.element_at(F.split("stem", "/"), -1)
    table = good.where("no is not null").withColumn("csv", F.concat("stem", F.lit("/"), "side", F.lit("/"), name, F.lit("_"), "side", F.lit("_emg_imu.csv")))
    table = table.select("csv", "no", *[F.format_string("%.7f", F.get("row", F.lit(k))).alias(c) for k, c in enumerate(columns)])
    written = sinks.csv_files(table, f"{path}/csv", "csv", ["no"], keep=columns)
    rows = written.select(F.col("__file").alias("csv"), F.col("n").alias("n_rows"))
    each = good.where("no is null and side is not null").withColumn("csv", F.concat("stem", F.lit("/"), "side", F.lit("/"), name, F.lit("_"), "side", F.lit("_emg_imu.csv")))
    lines = summary_lines(each.join(rows, "csv", "left"), list(sides), emg, imu)
    sinks.text_files(lines, f"{path}/summaries", "file", ["at"], "line")
    status = F.when(F.col("error").isNotNull(), F.concat(F.lit("FAIL: "), "error")).when(F.col("new"), F.lit("OK")).otherwise(F.lit("SKIP"))
    new = made.select("stem", F.lit(True).alias("new")).distinct()
    return found.withColumnRenamed("path", "file").join(errors, "file", "left").join(new, "stem", "left").select("file", "stem", status.alias("status"))


def summary_lines(each: DataFrame, sides: list[str], emg: bool = True, imu: bool = True) -> DataFrame:
    """file, at, line of the summaries of each (stem, side, n_samples, csv, n_rows): sides in the order given, a blank line between them."""
    name = F.element_at(F.split("stem", "/"), -1)
    place = F.coalesce(*[F.when(F.col("side") == s, F.lit(k)) for k, s in enumerate(sides)])
    rows = F.coalesce(F.col("n_rows").cast("string"), F.lit("N/A"))
    of = lambda kind, wanted: F.concat(F.lit(f"  {kind} CSV samples: "), *([rows, F.when(F.col("n_rows").isNotNull(), F.concat(F.lit("  ("), F.element_at(F.split("csv", "/"), -1), F.lit(")"))).otherwise("")] if wanted else [F.lit("N/A")]))
    body = F.array(F.lit(""), F.concat(F.lit("["), "side", F.lit("]")), F.concat(F.lit("  Original samples in stream: "), F.col("n_samples").cast("string")), of("EMG", emg), of("IMU", imu))
    to = F.concat("stem", F.lit("_summary.txt"))
    head = each.select(to.alias("file"), F.lit(0).alias("at"), F.concat(F.lit("XDF file: "), name).alias("line")).distinct()
    return head.unionByName(each.select(to.alias("file"), place.alias("p"), F.posexplode(body).alias("k", "line")).select("file", (F.col("p") * 5 + F.col("k") + 1).alias("at"), "line"))


def status_counts(status: DataFrame) -> DataFrame:
    """ok, skip, fail over all recordings: one row, zeros where there are none."""
    return status.agg(*[F.count_if(F.col("status").startswith(s)).alias(s.lower()) for s in ("OK", "SKIP", "FAIL")])


def manifest(segments: DataFrame, split_of: DataFrame) -> DataFrame:
    """Twelve columns for each segment (rows of files.segments); split by group_uid from split_of, empty where a group has none."""
    from tessera.functions import names

    base = names.without_npy(F.col("segment")).alias("segment_base")
    rows = segments.join(split_of.select("group_uid", "split").dropDuplicates(["group_uid"]), "group_uid", "left")
    rows = rows.select("*", F.col("action").alias("action_raw"), F.col("segment").alias("segment_raw"), base)
    return rows.withColumn("split", F.coalesce("split", F.lit(""))).select(*MANIFEST)


def manifest_file(segments: DataFrame, split_of: DataFrame, path: str, name: str = "manifest.csv") -> DataFrame:
    """The manifest as one CSV file, by person, action and segment."""
    return sinks.csv_file(manifest(segments, split_of), path, name, ["person", "action_raw", "segment_raw"])


def log_file(table: DataFrame, path: str, name: str, title: str, widths: dict[str, int | None], key: str = "file", grow: int = 35) -> DataFrame:
    """A review log rewritten whole: a title, a header, a rule and one line a row, by `key`, in columns of fixed width.

    widths: column -> width, None for as wide as it is; the column `key` is as wide as its longest value, at least `grow`. Longer values
    push what follows, nulls are empty. Lines are sorted and written by Spark; no more than one width goes through the driver.
    """
    longest = table.agg(F.max(F.length(key))).first()[0] or 0
    widths = {c: max(grow, longest) if c == key else w for c, w in widths.items()}
    put = lambda text, w: text if w is None else F.concat(text, F.repeat(F.lit(" "), F.greatest(F.lit(w) - F.length(text), F.lit(0))))
    line = F.concat_ws(" ", *[put(F.coalesce(F.col(c).cast("string"), F.lit("")), w) for c, w in widths.items()])
    head = " ".join(c if k == len(widths) - 1 or w is None else c.ljust(w) for k, (c, w) in enumerate(widths.items()))
    top = table.sparkSession.createDataFrame([(name, k, "", x) for k, x in enumerate([f"# {title}", head, "-" * len(head)])], "file string, at int, by string, line string")
    rows = table.select(F.lit(name).alias("file"), F.lit(3).alias("at"), F.coalesce(F.col(key), F.lit("")).alias("by"), line.alias("line"))
    return sinks.text_files(top.unionByName(rows), path, "file", ["at", "by", "line"], "line")

"""Copies, renames and deletions of files as Spark tasks, from a plan that is written down before the first file is touched.

A plan made from a listing would be another one once half of it is done, so a journal keeps the first; running again with the
same journal goes on with what it says. Every step looks at what is there before it acts: a task that is killed and run
again, and a whole run after a crash, leave the tree as if all had run once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.places import opened
from tessera.sources.sinks import reachable

PLAN = "id long, action string, source string, target string, waits boolean, status string"
DONE = "id long, action string, source string, target string, status string"


def _is_written(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing a table here."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def plan(actions: DataFrame) -> DataFrame:
    """actions (action: copy, rename or delete; source; target) as a plan: conflict where a source or a target is asked for twice (the first by
    source, action and target goes), waits where a rename's target is the source of another rename."""
    rows = actions.where("source is not null").select("action", "source", F.when(F.col("action") != "delete", F.col("target")).alias("target"))
    order = ("source", "action", "target")
    by_target = Window.partitionBy("target").orderBy(*order)
    # copies may share a source; a source that is renamed or deleted is asked for once
    by_source = Window.partitionBy("source").orderBy((F.col("action") == "copy").cast("int").desc(), *order)
    takes = F.sum((F.col("action") != "copy").cast("int")).over(by_source.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"__t": F.when(F.col("target").isNotNull(), F.row_number().over(by_target)).otherwise(1), "__s": F.when(F.col("action") == "copy", 1).otherwise(takes)})
    known = F.col("action").isin("copy", "rename", "delete") & (F.col("target").isNotNull() | (F.col("action") == "delete"))
    status = F.when(~known, "unknown action").when(F.col("target") == F.col("source"), "unchanged").when(F.col("__t") > 1, "conflict: target taken").when(F.col("__s") > 1, "conflict: source taken")
    rows = rows.withColumn("status", status).drop("__t", "__s")
    moved = rows.where("action = 'rename' and status is null").select(F.col("source").alias("target"), F.lit(True).alias("waits"))
    rows = rows.join(moved, "target", "left").withColumn("waits", F.coalesce("waits", F.lit(False)))
    return rows.withColumn("id", F.xxhash64("action", "source", "target")).select("id", "action", "source", "target", "waits", "status")


def _each(rows: DataFrame, act: Callable) -> DataFrame:
    """rows with the status that act(fs, row, source, target, aside) returns; rows that have one keep it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                status = r.status
                if status is None or pd.isna(status):
                    fs, source = opened(r.source)
                    target = opened(r.target)[1] if r.target else None
                    # where a rename waits for all sources to be out of the way
                    aside = f"{source.rpartition('/')[0]}/.{r.id & (1 << 64) - 1:016x}.moving"
                    status = act(fs, r, source, target, aside)
                out.append((r.id, r.action, r.source, r.target, bool(r.waits), status))
            yield pd.DataFrame(out, columns=["id", "action", "source", "target", "waits", "status"])

    return rows.repartition(F.col("id")).mapInPandas(run, PLAN)


def _file(fs: pafs.FileSystem, path: str) -> pafs.FileInfo | None:
    found = fs.get_file_info(path)
    return None if found.type == pafs.FileType.NotFound else found


def _same(fs: pafs.FileSystem, a: str, b: str, piece: int = 1 << 20) -> bool:
    with fs.open_input_stream(a) as x, fs.open_input_stream(b) as y:
        while data := x.read(piece):
            if data != y.read(piece):
                return False
        return True


def _copied(fs: pafs.FileSystem, source: str, target: str, overwrite: bool) -> str:
    old, new = _file(fs, source), _file(fs, target)
    if old is None:
        return "missing"
    if new is not None and not overwrite:
        return "done" if new.size == old.size and _same(fs, source, target) else "conflict: exists"
    fs.create_dir(target.rpartition("/")[0], recursive=True)
    part = f"{target.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
    fs.copy_file(source, part)
    fs.move(part, target)
    return "done"


def carried_out(actions: DataFrame, journal: str, overwrite: bool = False) -> DataFrame:
    """id, action, source, target, status (done, unchanged, missing, conflict, unknown action) of every action; written in the journal's `done`.

    First copies are made (over existing files only with overwrite), and files to rename move to a name of their own next to where they were, so
    that names can be exchanged; then these get their new names and deletions follow. Targets that exist and aren't renamed
    themselves are conflicts and left alone. A journal is used for one plan; where it has one, that one counts.
    """
    spark = actions.sparkSession
    reachable(spark, journal)
    if not _is_written(spark, f"{journal}/plan"):
        plan(actions).write.mode("overwrite").parquet(f"{journal}/plan")
    planned = spark.read.schema(PLAN).parquet(f"{journal}/plan")

    def first(fs, r, source: str, target: str | None, aside: str) -> str | None:
        if r.action == "copy":
            return _copied(fs, source, target, overwrite)
        if r.action == "rename":
            if _file(fs, aside) is not None:
                return None
            if _file(fs, source) is None:
                return "missing"
            if _file(fs, target) is not None and not r.waits:
                return "conflict: exists"
            fs.move(source, aside)
        return None

    def second(fs, r, source: str, target: str | None, aside: str) -> str:
        if r.action == "rename":
            if _file(fs, aside) is not None:
                if _file(fs, target) is not None:  # its owner stayed where it was
                    fs.move(aside, source)
                    return "conflict: exists"
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                fs.move(aside, target)
            return "done"
        found = _file(fs, source)
        if found is not None:
            fs.delete_dir(source) if found.type == pafs.FileType.Directory else fs.delete_file(source)
        return "done"

    for name, rows, act in (("first", planned, first), ("done", None, second)):
        if not _is_written(spark, f"{journal}/{name}"):
            rows = rows if rows is not None else spark.read.schema(PLAN).parquet(f"{journal}/first")
            _each(rows, act).write.mode("overwrite").parquet(f"{journal}/{name}")
    return spark.read.schema(PLAN).parquet(f"{journal}/done").drop("waits")

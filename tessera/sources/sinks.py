"""What the engine writes: CSV tables, split and camera JSON, result lines, tar shards, materialised segments."""

from __future__ import annotations

import csv
import io
import json
import tarfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ranges import maybe_broadcast, written
from tessera.sources.places import opened


def csv_text(df: DataFrame, order: list, most: int = 100_000, bom: bool = False) -> str:
    """A small report as CSV text in order; larger tables go through csv_file."""
    rows = df.orderBy(*order).limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write it with csv_file")
    return ("\ufeff" if bom else "") + rows.to_csv(index=False)


def reachable(spark: SparkSession, path: str) -> None:
    """Refuses a bare path where executors run on other machines: each would write to its own disk."""
    if ":" not in path and not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{path}: on a cluster a path needs its scheme (file: where all machines mount it)")


def _streamed(rows: DataFrame, path: str, file: str, order: list[str], begin: Callable, put: Callable, end: Callable) -> DataFrame:
    """Writes one file a value of `file` in the folder `path` (any that pyarrow.fs opens): its rows go by in order, one at a time.

    A file is written aside and moved into place when it is whole, so a retried task leaves no half file. All is written when this is
    called; what is returned (file, n, bytes) is the list of the files, kept in `path`/.files, and reading it writes nothing.
    """
    spark = rows.sparkSession
    reachable(spark, path)
    kind = rows.schema[file].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(path)
        fs.create_dir(base, recursive=True)
        now = None

        def close() -> pa.RecordBatch:
            name, aside, out, state, n = now
            end(state, out, n)
            size = out.tell()
            out.close()
            if "/" in name:
                fs.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
            fs.move(aside, f"{base}/{name}")
            return pa.RecordBatch.from_pylist([{file: name, "n": n, "bytes": size}])

        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                if now is None or now[0] != row[file]:
                    if now is not None:
                        yield close()
                    aside = f"{base}/.{uuid.uuid4().hex}.part"
                    out = fs.open_output_stream(aside)
                    now = [row[file], aside, out, begin(out, row), 0]
                put(now[3], now[2], row, now[4])
                now[4] += 1
        if now is not None:
            yield close()

    done = rows.repartition(file).sortWithinPartitions(file, *order).mapInArrow(run, f"{file} {kind}, n long, bytes long")
    done.write.mode("overwrite").parquet(f"{path}/.files")
    return spark.read.schema(done.schema).parquet(f"{path}/.files")


def csv_files(df: DataFrame, path: str, file: str, order: list[str], bom: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One CSV file, of any number of rows, for each value of the column `file`, with a header, in order; the list of them. Sorted by Spark and
    streamed, held by no task. Clean copies of point files, say: csv_files(quality.clean_points(...), ...). Quotes in values are doubled;
    keep: the columns written, else all. A file name may have folders in it."""
    columns = keep or [c for c in df.columns if c != file]
    rows = df.select(F.col(file).alias("__file"), *[F.col(c).alias(f"__{k}") for k, c in enumerate(order)], F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string") for c in columns]), {"nullValue": "", "emptyValue": "", "escape": '"'}).alias("__line"))
    head = _csv_head(columns, bom)
    return _streamed(rows, path, "__file", [f"__{k}" for k in range(len(order))], lambda out, row: out.write(head), lambda _, out, row, n: out.write(f"{row['__line']}\n".encode()), lambda *_: None)


def text_files(lines: DataFrame, path: str, file: str, order: list[str], line: str) -> DataFrame:
    """One text file for each value of `file`: its lines in order, each ended; the list of them."""
    rows = lines.select(F.col(file).alias("__file"), *[F.col(c).alias(f"__{k}") for k, c in enumerate(order)], F.col(line).alias("__line"))
    return _streamed(rows, path, "__file", [f"__{k}" for k in range(len(order))], lambda out, row: out, lambda _, out, row, n: out.write(f"{row['__line']}\n".encode()), lambda *_: None)


def _csv_head(columns: list[str], bom: bool) -> bytes:
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(columns)
    return (("\ufeff" if bom else "") + header.getvalue()).encode()


def csv_file(df: DataFrame, path: str, name: str, order: list[str], bom: bool = False) -> DataFrame:
    """One CSV file of a whole table; only a header where it has no rows."""
    if df.isEmpty():
        text_file(_csv_head(df.columns, bom).decode(), f"{path}/{name}")
        return df.sparkSession.createDataFrame([(name, 0, len(_csv_head(df.columns, bom)))], "__file string, n long, bytes long")
    return csv_files(df.withColumn("__name", F.lit(name)), path, "__name", order, bom)


def tar_files(members: DataFrame, path: str, shard: str = "shard", key: str = "key", member: str = "member", content: str = "content", source: str | None = None) -> DataFrame:
    """shard (the file's name), n, bytes: tar files of any size, members by key and name; a member without content becomes an .ERR.txt note.

    source names a column with the path of a member's file: it is opened by the task that writes the shard and copied in
    pieces, so contents are neither shuffled nor held; only paths and sizes are. Members without a path (labels, say) bring their content along.
    """
    columns = [c for c in (shard, key, member, content, source) if c is not None and c in members.columns]

    def put(tar: tarfile.TarFile, out, row: dict, n: int) -> None:
        info = tarfile.TarInfo(row[member])
        place, data = row.get(source) if source else None, row.get(content)
        if place is not None:
            fs, at = opened(place)
            found = fs.get_file_info(at)
            if found.type == pafs.FileType.File:
                info.size = found.size
                with fs.open_input_stream(at) as whole:
                    tar.addfile(info, whole)
                return
            data = None
        if data is None:
            info.name, data = f"{row[key]}.ERR.{row[member]}.txt", b"missing"
        data = data.encode() if isinstance(data, str) else data
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))

    return _streamed(members.select(*columns), path, shard, [key, member], lambda out, row: tarfile.open(fileobj=out, mode="w|"), put, lambda tar, out, n: tar.close())


def npy_files(frames: DataFrame, path: str, clip: str, order: str, values: str, least: int = 1, fill: float | None = 0.0, dtype: str = "<f4") -> tuple[DataFrame, DataFrame]:
    """(files, errors): <clip>.npy of each clip's frames as (frames, rows, columns), padded with fill to the most rows; and clip, error of those that aren't written.

    values: array<array<double>>. How many frames there are and how large the largest is are counted first, so a file's header is right
    from the start and its frames go by one at a time. numpy.load(..., mmap_mode="r") opens the files. Without fill, frames of unlike
    numbers of rows are an error; so are unlike numbers of columns and fewer than `least` frames.
    """
    rows = F.size(values)
    sized = frames.withColumns({"__rows": F.greatest(rows, F.lit(0)), "__columns": F.when(rows > 0, F.size(F.get(values, F.lit(0))))})
    wide = F.array_max(F.transform(values, lambda r: F.size(r))) != F.array_min(F.transform(values, lambda r: F.size(r)))
    about = sized.groupBy(clip).agg(F.count("*").cast("long").alias("__n"), F.max("__rows").alias("__most"), F.min("__rows").alias("__least"), F.max("__columns").alias("__max"), F.min("__columns").alias("__min"), F.coalesce(F.bool_or(wide), F.lit(False)).alias("__wide"))
    wrong = F.when(F.col("__n") < least, F.format_string("%d frames", "__n")).when(F.col("__wide") | (F.col("__max") != F.col("__min")), F.format_string("columns differ: %d to %d", "__min", "__max"))
    if fill is None:
        wrong = wrong.when(F.col("__most") != F.col("__least"), F.lit("numbers of rows differ"))
    about = written(about.withColumn("error", wrong), "clips")
    good = about.where("error is null").select(F.col(clip).alias("__clip"), "__n", "__most", F.coalesce("__max", F.lit(0)).alias("__wide"))
    whole = frames.select(F.col(clip).alias("__of"), F.col(order).alias("__order"), F.col(values).alias("__values")).join(maybe_broadcast(good), F.col("__of").eqNullSafe(F.col("__clip")))
    whole = whole.withColumn("file", F.concat(F.coalesce(F.col("__of").cast("string"), F.lit("null")), F.lit(".npy"))).drop("__of", "__clip")

    def begin(out, row: dict) -> tuple[int, int]:
        shape = (row["__n"], row["__most"] if row["__wide"] else 0, row["__wide"])
        np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(np.dtype(dtype)), "fortran_order": False, "shape": shape})
        return shape[1:]

    def put(shape: tuple[int, int], out, row: dict, n: int) -> None:
        frame = np.full(shape, 0.0 if fill is None else fill, dtype)
        if row["__values"] and shape[1]:
            frame[: len(row["__values"])] = row["__values"]
        out.write(frame.tobytes())

    return _streamed(whole, path, "file", ["__order"], begin, put, lambda *_: None), about.where("error is not null").select(clip, "error")


def _json_object(rows: DataFrame, path: str, file: str, key: str, entry: str, head: str, tail: str) -> DataFrame:
    def put(_, out, row: dict, n: int) -> None:
        out.write(f"{',' if n else ''}\n{json.dumps(row[key], ensure_ascii=False)}: {row[entry]}".encode())

    return _streamed(rows.select(file, key, entry), path, file, [key], lambda out, row: out.write(head.encode()), put, lambda _, out, n: out.write(f"\n{tail}".encode()))


def split_json(samples: DataFrame, path: str, split: str = "split", key: str = "key", entry: str = "entry", meta: dict | None = None) -> DataFrame:
    """file, n, bytes: <split>.json with {"__meta__": ..., "samples": {key: entry}} for each split; entries are JSON text. files.split_samples reads them."""
    head = f'{{"__meta__": {json.dumps(meta or {}, ensure_ascii=False)}, "samples": {{'
    return _json_object(samples.withColumn("file", F.concat(F.col(split), F.lit(".json"))), path, "file", key, entry, head, "}}")


def camera_json(frames: DataFrame, path: str, cam: str = "cam", key: str = "key") -> DataFrame:
    """file, n, bytes: cam_<cam>.json with one object, key -> the other columns, for each camera. files.cameras reads them."""
    rest = F.to_json(F.struct(cam, *[c for c in frames.columns if c not in (cam, key)]))
    rows = frames.select(F.concat(F.lit("cam_"), F.col(cam), F.lit(".json")).alias("file"), F.col(key), rest.alias("entry"))
    return _json_object(rows, path, "file", key, "entry", "{", "}")


def text_file(text: str, path: str) -> None:
    """A small report, written aside and moved into place."""
    fs, at = opened(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{at}.part") as out:
        out.write(text.encode())
    fs.move(f"{at}.part", at)


def report(sections: dict[str, DataFrame], value: str, most: int = 80) -> str:
    """A text report: each section's number of distinct values and the first `most` of them in order. No more than these reach the driver."""
    out = []
    for title, df in sections.items():
        rows = df.select(F.col(value).cast("string").alias("v")).distinct()
        n, first = rows.count(), [r["v"] for r in rows.orderBy("v").limit(most).collect()]
        out += [f"{title}: {n}", *(f"  {v}" for v in first), *([f"  ... {n - most} more"] if n > most else [])]
    return "\n".join(out) + "\n"


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def segments(df: DataFrame, path: str, by: list[str], overwrite: bool = False) -> None:
    """Selected rows by class and clip; skipped where it exists unless overwrite."""
    df.write.mode("overwrite" if overwrite else "ignore").partitionBy(*by).parquet(path)


def sample_csv(df: DataFrame) -> DataFrame:
    """Doubles as text of seven digits, as armband exports have them."""
    return df.select(*[F.format_string("%.7f", F.col(n)).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def tar_shards(members: DataFrame, shard: str = "shard", key: str = "key", member: str = "member", content: str = "content") -> DataFrame:
    """shard, tar (bytes), n_members: one tar file a shard, members by key and name; a member without content becomes an .ERR.txt note.

    For shards that fit a value; tar_files writes files of any size.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, member])
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w") as tar:
            for k, m, c in zip(pdf[key], pdf[member], pdf[content], strict=True):
                name, data = (m, bytes(c)) if c is not None else (f"{k}.ERR.{m}.txt", b"missing")
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame({shard: [pdf[shard].iloc[0]], "tar": [buffer.getvalue()], "n_members": [len(pdf)]})

    kind = members.schema[shard].dataType.simpleString()
    return members.groupBy(shard).applyInPandas(run, f"{shard} {kind}, tar binary, n_members long")


def tar_members(shards: DataFrame, shard: str = "shard") -> DataFrame:
    """shard, key, member, offset_data, size of tar files given as bytes."""
    kind = shards.schema[shard].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, data in zip(b[shard], b["tar"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(bytes(data))) as tar:
                    out += [(s, m.name.partition(".")[0], m.name, m.offset_data, m.size) for m in tar]
            yield pd.DataFrame(out, columns=[shard, "key", "member", "offset_data", "size"])

    return shards.select(shard, "tar").mapInPandas(run, f"{shard} {kind}, key string, member string, offset_data long, size long")

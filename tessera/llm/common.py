"""What the operators of this subpackage share: word rules, let-bindings, scratch tables, Arrow kernels of bounded memory."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of other characters than these six.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RE = r"[\x20\x09-\x0D]+"

#: Tables of at most so many rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and Spark runs on this machine alone."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    spark.sparkContext.setCheckpointDir(_own["dir"])
    return _own["dir"]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (dots as __) for the plans that start inside, put back afterwards."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, name: str, *done: DataFrame, by: str | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage and survives lost executors.

    What the plan shuffled is deleted once it is written, and so are the stored tables in `done`, which nothing reads any more.
    Each value of the column `by` has a folder of its own.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path, partitionBy=by)
    dropped(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def put_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Writes a file whole, unless it exists; False if it does. Of several writers one succeeds.

    The data are written aside and put in place by a hard link on a local file system, elsewhere by a rename that doesn't
    overwrite: atomic on HDFS; object stores without such a rename need one writer at a time.
    """
    jvm = spark.sparkContext._jvm
    fs, final = file_system(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.part")
    stream = fs.create(part, False)
    try:
        stream.write(data)
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(part.toUri().getPath(), final.toUri().getPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(part, final, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except FileExistsError:
        return False
    except Py4JJavaError:
        if fs.exists(final):
            return False
        raise
    finally:
        if fs.exists(part):
            fs.delete(part, False)
    return True


def get(spark: SparkSession, path: str) -> bytes:
    """A whole small file."""
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, which is made if it isn't there."""
    fs, at = file_system(spark, path)
    fs.mkdirs(at)
    return sorted(f.getPath().getName() for f in fs.listStatus(at))


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for t in tables:
        fs, at = file_system(t.sparkSession, t._stored_at)
        fs.delete(at, True)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, rows: int | None = 512) -> DataFrame:
    """df.mapInArrow(run, schema) over batches of at most `rows` rows; workers give their free memory back after each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(part for b in batches for part in ([b] if rows is None else (b.slice(at, rows) for at in range(0, b.num_rows, rows))))
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(task, schema)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_RE), lambda w: w != "")


def maybe_broadcast(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint while rows, its counted size, is within the bound."""
    return F.broadcast(df) if rows <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def most_frequent(df: DataFrame, n: str, most: int) -> DataFrame:
    """Rows of df of the highest counts n (at least 1), no more than most of them: all rows, or those from a bound on.

    The bound comes from a histogram of sixteen buckets an octave, so nothing is sorted and some thousand rows reach the driver
    at any size. Rows of one bucket go together; where they would exceed most, none of them is taken.
    """
    bucket = F.floor(F.log2(F.col(n).cast("double")) * 16).cast("long")
    held, least = 0, None
    for b, count in sorted(df.groupBy(bucket.alias("b")).agg(F.count("*").alias("c")).collect(), reverse=True):
        if held + count > most:
            break
        held, least = held + count, b
    return df.where(bucket >= least) if least is not None else df.limit(0)

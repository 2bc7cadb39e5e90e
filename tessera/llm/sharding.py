"""Shards of a growing table: arrivals are appended as small immutable files, files of similar size are merged into
target-sized ones, and every state is a versioned manifest that is committed by one atomic step.

A store is a folder of the shared file system. ``data/`` has Parquet files that never change: each write has a new folder named
by a uuid, so no writer can touch what another wrote. ``manifest/`` has one JSON file a version: the shards it adds and removes,
and every SNAPSHOT versions the whole list, so a commit writes no more than its own change. A manifest is written aside and then
put in place by a step that fails if the version is there: a hard link on a local file system, elsewhere a rename without
overwriting (atomic on HDFS; on object stores without such a rename, one writer at a time). Readers follow the newest manifest
and never see half a write. A writer that loses the race for a version gets ConflictError and leaves only files that no manifest
names; the versions committed by others, and what they read, stay as they are.

``vacuum`` deletes what no kept version names, but nothing younger than an age, so neither readers of recent versions nor
unfinished writers lose files.

Compaction is by size tiers: tier t holds files of target / fan^(t+1) up to target / fan^t. Files of one tier are grouped in
order until a group fills the target; each group is merged by one task, without a shuffle, many groups a job. A group that doesn't fill
the target waits until it has ``fan`` files, so in a steady stream of arrivals a row is written again once a tier, not once an arrival.

Null, empty and repeated rows, null ids included, are stored as they are; an empty table is a version without shards or with one
empty shard. Columns may have any names but ``__shard``, which ``read`` adds, and the one named as arrival_col, which is not kept.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import file_system, get, names_in, put_new, settings

#: Every so many versions a manifest has the whole list of shards.
SNAPSHOT = 16


def _name():
    """A data file's path below data/, as the scan knows it."""
    return F.regexp_extract(F.col("_metadata.file_path"), "^.*/data/(.*)$", 1)


class ConflictError(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target: int = 128 << 20, fan: int = 4):
        self.spark, self.root, self.target, self.fan = spark, root.rstrip("/"), target, fan
        self._fs, at = file_system(spark, f"{self.root}/manifest")
        self._fs.mkdirs(at)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    # --- manifests
    def versions(self) -> list[int]:
        return [int(n[1:9]) for n in names_in(self.spark, f"{self.root}/manifest") if n.endswith(".json") and n[0] == "v"]

    def version(self) -> int:
        """The newest committed version; 0 for an empty store."""
        return max(self.versions(), default=0)

    def _load(self, version: int) -> dict:
        return json.loads(get(self.spark, f"{self.root}/manifest/v{version:08d}.json").decode())

    def manifest(self, version: int | None = None) -> dict:
        """version, schema, shards of a version: its nearest snapshot and the changes since."""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        changes = [self._load(version)]
        while "shards" not in changes[-1] and changes[-1]["version"] > 1:
            changes.append(self._load(changes[-1]["version"] - 1))
        shards: dict[str, dict] = {}
        for c in reversed(changes):
            for s in c["shards"] if "shards" in c else c["add"]:
                shards[s["path"]] = s
            for path in c.get("remove", ()) if "shards" not in c else ():
                del shards[path]
        return {"version": version, "schema": changes[0]["schema"], "shards": list(shards.values())}

    def commit(self, before: dict, add: list[dict], remove: list[str], schema: str) -> dict:
        """The manifest of version before + 1, or ConflictError if another writer has committed that version."""
        version = before["version"] + 1
        gone = set(remove)
        shards = [s for s in before["shards"] if s["path"] not in gone] + add
        body = {"version": version, "schema": schema} | ({"shards": shards} if version % SNAPSHOT == 0 else {"add": add, "remove": remove})
        if not put_new(self.spark, f"{self.root}/manifest/v{version:08d}.json", json.dumps(body).encode()):
            raise ConflictError(f"version {version} is committed already")
        return {"version": version, "schema": schema, "shards": shards}

    # --- data
    def _files(self, folder: str) -> list[tuple[str, int]]:
        it, out = self._fs.listFiles(self._path(folder), True), []
        while it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(".parquet"):
                out.append((f.getPath().toString(), f.getLen()))
        return sorted(out)

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(self.target / max(1, size), self.fan))) if size < self.target else 0

    def _shards(self, folder: str, arrival: str) -> list[dict]:
        files = self._files(folder)
        if not files:
            return []
        rows = {unquote(r["p"]): r["n"] for r in self.spark.read.parquet(folder).groupBy(_name().alias("p")).agg(F.count("*").alias("n")).toLocalIterator()}
        names = [p.rpartition("/data/")[2] for p, _ in files]
        return [{"shard": name, "path": p, "bytes": size, "rows": rows.get(unquote(name), 0), "tier": self.tier(size), "arrival": arrival} for name, (p, size) in zip(names, files, strict=True)]

    def _folder(self, kind: str) -> str:
        return f"{self.root}/data/{kind}-{uuid.uuid4().hex}"

    def append(self, arrivals: DataFrame, arrival_col: str | None = None, before: dict | None = None) -> list[int]:
        """Writes arrivals as small shards, in one pass; commits a version for each value of arrival_col (or one).

        before: the manifest that the writer has read (else the newest). If others have committed since, ConflictError.
        """
        now = before or self.manifest()
        folder = self._folder("arrival")
        (arrivals.write.partitionBy(arrival_col) if arrival_col else arrivals.write).parquet(folder)
        schema = arrivals.drop(arrival_col).schema.json() if arrival_col else arrivals.schema.json()
        fresh: dict[str, list[dict]] = {}
        for s in self._shards(folder, ""):
            name = next((x.partition("=")[2] for x in s["path"].split("/") if arrival_col and x.startswith(f"{arrival_col}=")), "0")
            fresh.setdefault(name, []).append(s | {"arrival": name})
        done = []
        for name in sorted(fresh) or [None]:
            now = self.commit(now, fresh.get(name, []), [], schema)
            done.append(now["version"])
        return done

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """Groups to merge: files of one tier, in order, up to the target. A tier's last group, which has room left, waits for fan files; a group of one stays as it is."""
        groups: list[list[dict]] = []
        tiers: dict[int, list[dict]] = {}
        for s in shards:
            if s["bytes"] < self.target / 2:
                tiers.setdefault(s["tier"], []).append(s)
        for t in sorted(tiers, reverse=True):
            group, size = [], 0
            for s in sorted(tiers[t], key=lambda s: (s["bytes"], s["shard"])):
                if group and size + s["bytes"] > self.target:
                    groups.append(group)
                    group, size = [], 0
                group.append(s)
                size += s["bytes"]
            if len(group) >= self.fan:
                groups.append(group)
        return [g for g in groups if len(g) >= 2]

    def compact(self, per_job: int = 200, before: dict | None = None) -> int:
        """Merges until no tier has fan files or a group that fills the target, a version a round; returns the version."""
        while True:
            now, before = before or self.manifest(), None
            groups = self.plan(now["shards"])
            if not groups:
                return now["version"]
            schema, fresh = StructType.fromJson(json.loads(now["schema"])), []
            for at in range(0, len(groups), per_job):
                folder = self._folder("merged")
                parts = [self.spark.read.schema(schema).parquet(*[s["path"] for s in g]).coalesce(1) for g in groups[at : at + per_job]]
                # one task and one file for each part: a union of one-partition inputs would otherwise be zipped into one partition
                with settings(self.spark, spark__sql__unionOutputPartitioning="false"):
                    reduce(DataFrame.unionAll, parts).write.parquet(folder)
                fresh += self._shards(folder, "")
            if sum(s["rows"] for s in fresh) != sum(s["rows"] for g in groups for s in g):
                raise RuntimeError("merged files don't hold the rows of their sources")
            self.commit(now, fresh, [s["path"] for g in groups for s in g], now["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version with __shard, the name of their file."""
        m = self.manifest(version)
        if not m["shards"]:
            schema = StructType.fromJson(json.loads(m["schema"])) if m["schema"] else StructType()
            return self.spark.createDataFrame([], schema).withColumn("__shard", F.lit(None).cast("string"))
        df = self.spark.read.schema(StructType.fromJson(json.loads(m["schema"]))).parquet(*[s["path"] for s in m["shards"]])
        return df.withColumn("__shard", _name())

    def vacuum(self, keep: int = 10, age: float = 7 * 24 * 3600) -> int:
        """Deletes data files that none of the newest `keep` versions names and that are older than `age` seconds; returns how many.

        Older manifests stay: they are small, and later ones build on them.
        """
        named = {s["path"] for v in self.versions()[-keep:] for s in self.manifest(v)["shards"]}
        gone = 0
        for p, _ in self._files(f"{self.root}/data"):
            at = self._path(p)
            if p not in named and time.time() * 1000 - self._fs.getFileStatus(at).getModificationTime() >= age * 1000:
                self._fs.delete(at, False)
                gone += 1
        return gone

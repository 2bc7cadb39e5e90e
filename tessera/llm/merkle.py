"""A Merkle manifest of a dataset: leaves by group, runs of eight up to a root for each group, and the same over the groups.

A digest climbs as soon as it can. Each task keeps partial parents with the digests of their children by place; a parent that has as many
as the size of its group says it must have is complete, its digest goes to its own parent, and so on. What a task can't complete, the
edges of its range, is the frontier: a few rows a level, dealt again by an ancestor four levels up, until only the roots are left.
Complete parents keep their children, and these links, followed from the roots down, give every document its proof.

Defined results: documents of the same group and order stand in order of their digests; repeated rows are leaves of their own; null is a
group of its own and comes first; other columns don't count. An empty table has no root and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranges import maybe_broadcast, numbered_within

from .common import map_arrow, stored

BITS = 3  # children of a node, as bits of its place
ARITY = 1 << BITS
#: Levels that one reshuffle of the frontier settles: groups of at most 8^4 digests.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN, FRONTIER, TOP = 0, 1, 2


def combined(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: list[Column]) -> Column:
    """The digest of a row: each value with its length in bytes, so no two rows have the same text; null is a dash."""
    text = [v.cast("string") for v in values]
    return combined(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text])


def width(n: int, level: int) -> int:
    """Nodes of a level in a tree of n leaves."""
    return -(-n >> BITS * level) if n else 0


@dataclass
class Tree:
    """leaves: what was given, with place and size. runs: group, level, place, digest, children. tops: group, digest."""

    leaves: DataFrame
    runs: DataFrame
    tops: DataFrame
    levels: int


def climbed(nodes: DataFrame, group: str) -> DataFrame:
    """group, size, level, place, digest, children, kind: nodes (level, place and digest, in any order) go up as far as a task can take them."""
    kind = nodes.schema[group].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial: dict[tuple, tuple[int, dict[int, str]]] = {}
        schema = None
        for b in batches:
            schema = pa.schema([b.schema.field(0), ("size", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string()), ("children", pa.list_(pa.string())), ("kind", pa.int32())])
            out: list[tuple] = []
            for g, size, level, place, digest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                while True:
                    nodes_here = width(size, level)
                    if nodes_here == 1:
                        out.append((g, size, level, place, digest, None, TOP))
                        break
                    parent = place >> BITS
                    _, children = partial.setdefault((g, level, parent), (size, {}))
                    children[place & ARITY - 1] = digest
                    arity = min(ARITY, nodes_here - parent * ARITY)
                    if len(children) < arity:
                        break
                    del partial[g, level, parent]
                    ordered = [children[k] for k in range(arity)]
                    level, place, digest = level + 1, parent, hashlib.sha256("".join(ordered).encode()).hexdigest()
                    out.append((g, size, level, place, digest, ordered, RUN))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 7, schema, strict=True)], schema=schema)
        rest = [(g, size, level, parent * ARITY + k, d, None, FRONTIER) for (g, level, parent), (size, children) in partial.items() for k, d in children.items()]
        for at in range(0, len(rest), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rest[at : at + 4096], strict=True), schema, strict=True)], schema=schema)

    return map_arrow(nodes.select(group, "size", "level", "place", "digest"), run, f"{group} {kind}, size long, level int, place long, digest string, children array<string>, kind int", rows=4096)


def build(leaves: DataFrame, group: str, digest: str, *order: str) -> Tree:
    """The trees of all groups; a group may hold any share of the rows."""
    placed = stored(numbered_within(leaves, group, *order, digest).withColumnsRenamed({"__pos": "place", "__n": "size"}).drop("__part"), "merkle-leaves")
    nodes = placed.select(group, "size", F.lit(0).alias("level"), "place", F.col(digest).alias("digest"))
    parts, level = [stored(climbed(nodes, group), "merkle-runs")], 0
    while not (frontier := parts[-1].where(F.col("kind") == FRONTIER)).isEmpty():
        level += LEVELS
        up = F.greatest(F.lit(level) - F.col("level"), F.lit(1))
        ancestor = F.expr(f"shiftright(place, CAST({BITS} * greatest({level} - level, 1) AS INT))")
        dealt = frontier.withColumns({"__at": F.col("level") + up, "__up": ancestor}).repartition(group, "__at", "__up").sortWithinPartitions(group, "__at", "__up")
        parts.append(stored(climbed(dealt, group), "merkle-runs"))
    made = reduce(DataFrame.unionAll, parts)
    largest = placed.agg(F.max("size")).first()[0] or 0
    levels = next(k for k in range(64) if width(largest, k) <= 1)
    return Tree(placed, made.where(F.col("kind") == RUN).drop("kind", "size"), made.where(F.col("kind") == TOP).select(group, "digest"), levels)


def beside(children: Column, place: Column) -> Column:
    """struct<before, after>: the digests of a run before and after the one at a place."""
    slot = place.bitwiseAND(ARITY - 1).cast("int")
    before, after = F.slice(children, F.lit(1), slot), F.slice(children, slot + 2, F.lit(ARITY))
    return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))


def proofs(tree: Tree, group: str) -> DataFrame:
    """The leaves with path: for each level up to the group's root, the digests of the run before and after the own one.

    Links are followed downwards: each node's path is its place among its siblings and its parent's path, so the paths of a
    level are as many as its nodes, and leaves take theirs from one row for every eight.
    """

    def below(rows: DataFrame, parents: DataFrame) -> DataFrame:
        up = parents.select(F.col(group).alias("__g"), F.col("place").alias("__p"), F.col("children").alias("__c"), F.col("path").alias("__path"))
        joined = rows.join(up, F.col(group).eqNullSafe(F.col("__g")) & (F.shiftright("place", BITS) == F.col("__p")), "left")
        path = F.when(F.col("__c").isNull(), F.array().cast("array<struct<before:string,after:string>>")).otherwise(F.concat(F.array(beside(F.col("__c"), F.col("place"))), F.col("__path")))
        return joined.withColumn("path", path).drop("__g", "__p", "__c", "__path")

    at = tree.runs.limit(0).withColumn("path", F.array().cast("array<struct<before:string,after:string>>"))
    for level in range(tree.levels, 0, -1):
        nodes = tree.runs.where(F.col("level") == level).select(group, "place", "children")
        at = below(nodes, at) if level < tree.levels else nodes.withColumn("path", F.array().cast("array<struct<before:string,after:string>>"))
    return below(tree.leaves, at)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda at, x: combined(x["before"], at, x["after"]))


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, other, subroot, root, path: one row a document. other is the leaf that the values in `changed` would give.

    The texts are read once; only digests are moved.
    """
    of = lambda new: leaf([new.get(c, F.col(c)) for c in fields])
    rows = docs.select(F.col(order).alias("doc_id"), F.col(group).alias("group"), of({}).alias("leaf"), of(changed or {}).alias("other"))
    documents = build(stored(rows, "merkle-digests"), "group", "leaf", "doc_id")
    groups = build(documents.tops.select(F.lit(0).alias("all"), "group", F.col("digest").alias("subroot")), "all", "subroot", "group")
    above = proofs(groups, "all").join(groups.tops.withColumnRenamed("digest", "root"), "all").select(F.col("group").alias("__group"), "subroot", "root", F.col("path").alias("__above"))
    rows = proofs(documents, "group").join(maybe_broadcast(above), F.col("group").eqNullSafe(F.col("__group")))
    return rows.select("doc_id", "leaf", "other", "subroot", "root", F.concat("path", "__above").alias("path"))


def tampered(docs: DataFrame) -> DataFrame:
    """Every document's digests and proof, and whether its text as it is now (A-Z lower-cased where 3 divides the CRC-32 of doc_id) still gives the root."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    rows = manifest(docs, changed={"text": F.when(hit, F.translate("text", upper, lower)).otherwise(F.col("text"))})
    proof = F.array_join(F.flatten(F.transform("path", lambda x: F.array(x["before"], x["after"]))), "")
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded(F.col("other"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))

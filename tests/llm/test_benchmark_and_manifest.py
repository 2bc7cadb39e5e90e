"""Decontamination and the Merkle manifest against plain versions, on odd and large inputs."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontamination, merkle

UP = {c: c + 32 for c in range(65, 91)}


def content(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))


def plain_report(docs, items):
    windows = {}
    for i, t in items:
        w = content(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    lengths = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = content(t)
        hit, ids = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


LONG = " ".join(f"tok{i}" for i in range(30))


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Ab", "é", "🙂", "x1", "averyveryverylongwordindeed", "b"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, prose(rng.randrange(10, 40))) for k in range(30)]
    items += [(100, items[0][1]), (101, LONG), (102, LONG.upper()), (103, None), (104, ""), (105, "?!"), (None, LONG), (106, "one two three"), (107, "q"), (108, "one-two"), (109, items[0][1]), (110, "w" * 400 + " " + LONG), (101, LONG)]
    docs = [(k, prose(300) + " " + rng.choice(items[:30])[1]) for k in range(40)]
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "x " + LONG.replace(" ", "--") + " y"), (1004, LONG + " " + LONG), (1005, "a q b One, TWO\nthree"), (1006, "qq q"), (1007, "tok1 " * 50), (1008, "w" * 400 + "\n" + LONG), (1008, "w" * 400 + "\n" + LONG)]
    docs += [(2000, prose(40_000) + items[5][1]), (2001, "z" * 1_000_000), (2002, "tok0 " * 100_000 + LONG)]
    return docs, items


@pytest.mark.parametrize("part_windows", [500_000, 60])
def test_windows_in_documents(spark, cases, part_windows):
    docs, items = cases
    clash = F.lit("other")
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_words": clash, "items": clash, "window": clash}).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", clash)
    got = sorted((tuple(r) for r in decontamination.report(d, b, part_windows=part_windows).collect()), key=str)
    assert got == plain_report(docs, items)


def test_windows_of_full_length_only(spark, cases):
    docs, items = cases
    items = [x for x in items if len(content(x[1])) >= 10]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontamination.report(d, b).collect()), key=str)
    assert got == plain_report(docs, items)
    kept = {r.doc_id for r in decontamination.clean(d, b).collect()}
    assert kept == {r[0] for r in got if not r[5]}
    assert decontamination.clean(d, b).columns == d.columns
    assert {r.doc_id for r in decontamination.clean(d, b, 1.0).collect()} == {k for k, _ in docs}


def test_no_windows_no_documents(spark, cases):
    docs, items = cases
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.report(d, b.limit(0)).where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert decontamination.report(d, b.limit(0)).count() == len(docs)
    assert decontamination.report(d.limit(0), b).count() == 0


def test_shifts_skip_most_places():
    """Prose without the windows' words is left out by shifts: few places are looked at."""
    rng = random.Random(1)
    windows = [(" ".join(f"bench{rng.randrange(1000)}" for _ in range(10)), 10, ["1"]) for _ in range(2000)]
    (kind,) = decontamination.Matcher(windows, 10).kinds
    text, _ = decontamination.normal([" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(50_000)).encode()])
    looked = []
    kind.shift = type("Counted", (), {"__getitem__": lambda self, at, table=kind.shift: (looked.append(len(at)), table[at])[1]})()
    assert len(kind.candidates(text)) == 0 and sum(looked) < len(text) / 20


H = lambda *a: hashlib.sha256("".join(a).encode()).hexdigest()


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text)"""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    of = lambda r, t: H(*[enc(v) for v in (*r[:4], t)])

    def tree(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def path(levels, i):
        out = []
        for x in levels[:-1]:
            out.append((x[i // 8 * 8 : i], x[i + 1 : i // 8 * 8 + 8]))
            i //= 8
        return out

    by = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, of(r, r[4]))):
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([of(r, r[4]) for r in by[x]]) for x in langs}
    top, out = tree([trees[x][-1][0] for x in langs]), []
    for x in langs:
        for i, r in enumerate(by[x]):
            p = path(trees[x], i) + path(top, langs.index(x))
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            f = of(r, r[4].translate(UP) if hit and r[4] is not None else r[4])
            for b, a in p:
                f = H(*b, f, *a)
            out.append((r[0], trees[x][0][i], trees[x][-1][0], top[-1][0], H(*itertools.chain.from_iterable(b + a for b, a in p)), f, f == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(df):
    return sorted((tuple(r) for r in merkle.tampered(df.withColumns({"leaf": F.lit(1), "place": F.lit(2), "size": F.lit(3), "group": F.lit(4)})).collect()), key=str)


def test_manifest_of_odd_rows(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(1, 74)]
    rows += [(None, None, None, None, None), (5, "s", None, 1, "A"), (5, "s", None, 1, "A"), (5, "s", None, 1, "B"), (6, "", "", 0, ""), (-7, "é", "é", -1, "Ünï 🙂 ABC" * 10_000)]
    rows += [(i, "z", f"lang{i % 70}", None, None if i % 4 == 0 else "Q" * (i % 9)) for i in range(100, 500)]  # over 64 groups: three levels above them
    assert manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "s", "en", 1, "X") for i in range(n)]
    assert manifest(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_manifest_frontiers(spark):
    """A hot group of several levels in many small ranges, so that parents are completed over more than one reshuffle."""
    rows = [(i, "s", "en" if i % 20 else "fr", i, f"Doc {i}") for i in range(9000)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "24"), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = manifest(spark.createDataFrame(rows, SCHEMA))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0]), spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == plain_manifest(rows)


def test_a_changed_document_fails(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = merkle.manifest(docs, changed={"text": F.when(F.col("doc_id") == 3, F.lit("forged")).otherwise(F.col("text"))})
    bad = rows.where(merkle.folded(F.col("other"), F.col("path")) != F.col("root")).select("doc_id").collect()
    assert [r.doc_id for r in bad] == [3]

"""The pipeline, stage by stage, against what each stage promises of its own input."""

import hashlib
import itertools
import re

import corpus_pipeline
import duckdb
from tessera.llm import quality_rules, queries, secret_scans, simhash_dedup, substring_dedup
from tessera.llm.common import stored


def test_stages(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    columns, at = docs.columns, docs
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, sf001), name.replace(" ", "-"))
        outs.append(at)
    assert all(o.columns == columns for o in outs[:-1])
    q, n, r, s, p = outs
    ids = [{x.doc_id for x in o.select("doc_id").collect()} for o in (docs, q, n, r, s, p)]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4] == ids[5]
    assert ids[1] == {x.doc_id for x in quality_rules.apply_policy(quality_rules.ledger(docs)).where("kept").collect()}
    assert ids[2] == {x.component_id for x in simhash_dedup.similar_documents(q).collect()}
    assert substring_dedup.report(r).agg({"n_removed": "sum"}).first()[0] <= substring_dedup.report(n).agg({"n_removed": "sum"}).first()[0]
    assert secret_scans.scan(s).where("size(base) > 0").count() == 0
    assert s.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.run(spark, sf001).count() == p.count()


def jaccard_components(texts, least=0.8):
    """Least id of each document's component: five-word shingle sets of at least this similarity are linked; texts without words are alike."""
    grams = {}
    for k, t in texts.items():
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        grams[k] = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(grams), 2):
        x, y = grams[a], grams[b]
        if min(len(x), len(y)) >= least * max(len(x), len(y)) and (not x or len(x & y) >= least * len(x | y)):
            i, j = find(a), find(b)
            root[max(i, j)] = min(i, j)
    return {k: find(k) for k in texts}


def test_stages_by_brute_force(spark, sf001, tmp_path):
    con = duckdb.connect()

    def rows(df, name):
        path = str(tmp_path / f"{name}.parquet")
        df.toPandas().to_parquet(path)
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}'")
        return {r.doc_id: r.text for r in df.collect()}

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    q = stored(stages["quality rules"](spark, docs, sf001), "q")
    texts = rows(docs, "documents")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLE['op1_quality_rules']}) WHERE kept").fetchall()}
    assert {r.doc_id: r.text for r in q.collect()} == {k: texts[k] for k in kept}

    n = stored(stages["near-dedup"](spark, q, sf001), "n")
    texts = rows(q, "q")
    assert {r.doc_id: r.text for r in n.collect()} == {k: texts[k] for k in set(jaccard_components(texts).values())}

    r = stored(stages["substring dedup"](spark, n, sf001), "r")
    rows(n, "n")
    want = {k: sha for k, sha in con.execute(f"SELECT doc_id, kept_sha256 FROM ({queries.ORACLE['op5_substring_dedup']})").fetchall()}
    got = {x.doc_id: hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", x.text or "")).encode()).hexdigest() for x in r.collect()}
    assert got == want

    s = stored(stages["secret scans"](spark, r, sf001), "s")
    texts = {x.doc_id: x.text or "" for x in r.collect()}
    spans = {x.doc_id: x.spans for x in secret_scans.scan(r).select("doc_id", "spans").collect()}
    for x in s.collect():
        text, at, parts = texts[x.doc_id], 0, []
        for span in sorted(spans[x.doc_id], key=lambda y: (y["start"], y["end"])):
            parts.append(text[at : max(at, span["start"])])
            at = max(at, span["end"])
        parts.append(text[at:])
        assert all(p in (x.text or "") for p in parts)
        assert not re.search(r"AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", x.text or "")


def test_odd_tables(spark, tmp_path):
    long = " ".join(f"tok{i}" for i in range(80))
    rows = [(1, long, "x", 7), (1, long, "x", 7), (2, None, None, None), (3, "", "y", 0), (4, long + " tail", "y", 1), (5, " ".join(f"w{i}" for i in range(30_000)), "z", 2), (None, long[::-1], "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    for name, docs in (("some", df), ("none", df.limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        ids = {r.doc_id for r in got}
        assert (ids <= {1, 4, 5, None} and {1, 5} <= ids) if name == "some" else not got
        assert all(r.length <= 2048 for r in got)

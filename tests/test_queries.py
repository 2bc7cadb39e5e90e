"""Every registered engine query against its SQL."""

import math

import duckdb
import pytest

from tessera.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf001):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf001}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


def rows(records, columns):
    return sorted((tuple(norm(r[k]) for k in range(len(columns))) for r in records), key=lambda r: tuple((x is None, str(x)) for x in r))


#: Partitions so small that adaptive execution puts several together, or leaves several, in plans over the smallest tables too.
SMALL = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "1k"}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_over_small_partitions(spark, sf001, con, small_partitions, name):
    test_query(spark, sf001, con, name)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf001, con, name):
    df = queries.QUERIES[name](spark, sf001)
    columns = sorted(df.columns)
    got = rows([tuple(r) for r in df.select(*columns).collect()], columns)
    if name not in queries.ORACLE:
        assert got
        return
    found = con.execute(queries.ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = rows([tuple(r[k] for k in order) for r in found.fetchall()], columns)
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want) if any(not (x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) < 2e-5) for x, y in zip(g, w))]
    assert not bad, bad[:3]

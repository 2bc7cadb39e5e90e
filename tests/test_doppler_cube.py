"""A label's frames are one cube, in the order of their ids, however many parts they are read in."""

import duckdb

from tessera.plans import queries


def test_doppler_cube_of_whole_labels(spark, tmp_path):
    rows = [(k, "hot" if k % 10 else None, [float(k), -0.5]) for k in range(1500)]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").repartition(7).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.label: r for r in queries.doppler_cube(spark, str(tmp_path)).collect()}
    assert set(got) == {"hot", None}
    for label, r in got.items():
        ids = [k for k, x, _ in rows if x == label]
        assert (r.frames, r.ids, r.total) == (len(ids), ",".join(map(str, ids)), sum(ids) + 0.5 * len(ids))


def test_doppler_cube_counts_what_stands_beside_nulls(spark, tmp_path):
    rows = [(k, "mixed", None if k % 3 == 0 else [float(k), None, -0.5]) for k in range(200)]
    rows += [(None, "mixed", [1.0])] * 130 + [(None, "no id", [2.0]), (7, "no value", None), (8, "no value", [None]), (9, "empty", [])]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {tuple(r) for r in queries.doppler_cube(spark, str(tmp_path)).collect()}
    kept = [k for k in range(200) if k % 3]
    ids = ",".join(map(str, range(200)))
    assert got == {("mixed", 330, ids, sum(kept) + 0.5 * len(kept) + 130), ("no id", 1, None, 2.0), ("no value", 2, "7,8", None), ("empty", 1, "9", None)}
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        assert got == set(con.sql(queries.ORACLE["doppler_cube"]).fetchall())

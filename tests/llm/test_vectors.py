import math

import numpy as np
import pytest

from punctata.llm import vectors


def brute(rows, threshold):
    ok = []
    for _, v in rows:
        good = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(good)
    width = max((len(v) for (_, v), g in zip(rows, ok, strict=True) if g), default=1)
    u = np.zeros((len(rows), width))
    for i, ((_, v), g) in enumerate(zip(rows, ok, strict=True)):
        if g:
            x = np.array(v, float)
            u[i, : len(v)] = x / np.sqrt((x * x).sum())
    near = (u @ u.T >= threshold) & np.outer(ok, ok)
    np.fill_diagonal(near, False)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(near)):
        root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, int(near[i].sum()), least.get(find(i)), None if k is None else k == least[find(i)]) for i, (k, _) in enumerate(rows)]


def _same(spark, data, threshold=0.9, kind="float", **more):
    df = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = [tuple(r) for r in vectors.similar_vectors(df, threshold, **more).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, threshold), key=str)


@pytest.mark.parametrize("more", [{}, {"block": 64, "most_tiles": 64, "sample": 600}])
def test_clusters(spark, more):
    r = np.random.default_rng(7)
    centers = r.normal(size=(12, 24))
    data = []
    for i in range(900):
        v = centers[i % 12] + r.normal(size=24) * (0.05 + 0.35 * (i % 5))
        data.append((i * 2, [float(x) for x in v.astype(np.float32)], i % 3))
    data += [(5000 + i, data[4][1], 0) for i in range(40)]
    data += [(6000, [x * 2 for x in data[4][1]], 0)]
    _same(spark, data, **more)


def test_odd_vectors(spark):
    data = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0), (7, [1.0, 0.0], 0), (8, [1.0], 0), (None, [1.0, 0.1], 0), (9, [-1.0, 0.0], 0), (10, [1e30, 1e28], 0), (11, [1e-30, 0.0], None), (7, [1.0, 0.0], 0)]
    _same(spark, data)
    _same(spark, [(1, None, 0)])
    assert vectors.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = [tuple(r) for r in vectors.similar_vectors(df).collect()]
    assert sorted(got) == sorted(brute(rows, 0.9))


def test_oracle(spark):
    import duckdb

    from punctata.llm import queries

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = sorted(con.execute(queries.oracle_sql()["op7_similar_vectors"]).fetchall())
    rows = queries.op7_similar_vectors(spark, "/root/testdata/sf0.01").select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, rows)) == want


def test_components_of_many_edges_with_a_hub(spark):
    from pyspark.sql import functions as F

    from punctata.llm.common import components

    n = 2_000_000
    edges = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).union(spark.range(n, n + 10).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    got = components(edges).groupBy("component").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [(0, n), (n, 11)]


def test_null_ids_without_any_valid_vector(spark):
    from punctata.llm import vectors

    rows = spark.createDataFrame([(None, None), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(repr, map(tuple, vectors.similar_vectors(rows).collect()))) == sorted(["(None, 0, None, None)", "(3, 0, 3, True)"])

"""Tables in which very many rows share a place or an outline: work must not grow with the square of the copies."""

import random
import time

from pyspark.sql import functions as F

from punctata import roles
from punctata.operators import rasters
from punctata.operators import spatial as S


def _kept(objects, iou=0.25, overlap=0.5):
    """Objects (tile, label) -> pixels, taken in order."""
    stay = []
    for o in sorted(objects):
        shared = [(len(objects[o] & objects[s]), len(objects[o]), len(objects[s])) for s in stay]
        if not any(k and (k / (b + a - k) >= iou or k / b >= overlap) for k, b, a in shared):
            stay.append(o)
    return stay


def test_stitch_of_copies_by_brute_force(spark):
    r = random.Random(5)
    shapes = [frozenset((y, x) for y in range(a, a + h) for x in range(b, b + w)) for a, b, h, w in ((r.randrange(12), r.randrange(12), r.randint(1, 5), r.randint(1, 5)) for _ in range(30))]
    objects = {(r.randrange(3), i): r.choice(shapes) for i in range(150)}
    rows = [(t, i, y, x, True) for (t, i), pixels in objects.items() for y, x in pixels]
    got = rasters.stitch(spark.createDataFrame(rows, "tile long, label long, row long, col long, in_core boolean")).collect()
    assert sorted((g.tile, g.label) for g in got) == _kept(objects)


def test_stitch_of_very_many_copies_ends(spark):
    rows = spark.range(20_000).selectExpr("id % 2 AS tile", "id AS label", "explode(sequence(0L, 8L)) AS row").selectExpr("*", "explode(sequence(0L, 8L)) AS col", "true AS in_core")
    began = time.time()
    assert [(r.tile, r.label) for r in rasters.stitch(rows).collect()] == [(0, 0)]
    assert time.time() - began < 60


def _boxes(rows):
    return S.with_outline(rows, roles.ring())


def test_points_in_very_many_equal_shapes(spark):
    """20,000 points in 5,000 boxes of one outline and in a triangle: 100,000,000 pairs, none of which is made."""
    shapes = _boxes(spark.range(5000).selectExpr("id AS shape", "0e0 AS cx", "0e0 AS cy", "2e0 AS half"))
    points = spark.range(20_000).selectExpr("id", "'g' AS gene", "id % 97 / 100 AS x", "id % 89 / 100 AS y", "7L AS prior")
    points = points.withColumns({c: F.col(c).cast("double") for c in "xy"})
    began = time.time()
    per = S.count_covering(points, shapes, "id", "n").groupBy("n").count().collect()
    assert [tuple(r) for r in per] == [(255, 20_000)]
    masks = S.overlap_assignment(points, shapes.withColumn("mask", F.col("shape") % 3), "id", "mask", "prior").groupBy("n_masks", "source").count().collect()
    assert [tuple(r) for r in masks] == [(3, "ambiguous_overlap", 20_000)]
    counted = S.counts_in_shapes(points, shapes, ["shape"], ["gene"]).groupBy("gene", "n").count().collect()
    assert [tuple(r) for r in counted] == [("g", 20_000, 5000)]
    assert time.time() - began < 60


def test_rectangles_and_rings_of_four_segments(spark):
    rings = {1: [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], 2: [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)], 3: [(0, 2), (2, 0), (4, 2), (2, 4), (0, 2)], 4: [(0, 0), (4, 0), (4, 0), (0, 0), (0, 0)], 5: [(0, 0), (4, 0), (2, 0), (2, 4), (0, 0)]}
    shapes = S.with_outline(spark.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in rings.items()], "shape int, ring array<struct<x: double, y: double>>"), "ring").drop("ring")
    spots = {1: (2.0, 2.0), 2: (0.0, 1.0), 3: (4.0, 4.0), 4: (3.5, 3.5), 5: (1.0, 0.0), 6: (0.5, 0.25)}
    points = spark.createDataFrame([(k, *at) for k, at in spots.items()], "id int, x double, y double")
    found = lambda edges: sorted((r.shape, r.id) for r in S.in_shapes(points, shapes, edges).collect())
    assert found(False) == [(1, 1), (1, 4), (1, 6), (2, 1), (2, 4), (2, 6), (3, 1), (5, 6)]
    assert found(True) == [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (2, 1), (2, 2), (2, 3), (2, 4), (2, 5), (2, 6), (3, 1), (4, 5), (5, 1), (5, 5), (5, 6)]


def test_pairs_of_copies(spark):
    """50,000 points at four places, 625,000,000 pairs a place: they are counted, not made."""
    points = spark.range(200_000).selectExpr("id", "'g' AS gene", "CAST(id % 2 * 3 AS DOUBLE) AS x", "CAST(id DIV 2 % 2 * 4 AS DOUBLE) AS y")
    began = time.time()
    n = 50_000
    got = {r.band: r.n for r in S.annular_counts(points, "id", [0.0, 1.0, 3.0, 5.0], ["gene"]).collect()}
    assert got == {0: 4 * n * (n - 1) // 2, 1: 2 * n * n, 2: 4 * n * n}
    around = sorted((r.id, r.n) for r in S.points_within(points, "id", 3.0).collect())
    assert around == [(i, 2 * n) for i in range(4)]
    assert time.time() - began < 60


def test_pairs_by_brute_force(spark):
    r = random.Random(9)
    rows = [(i, i % 2, r.randrange(-40, 40) / 4, r.randrange(-40, 40) / 4) for i in range(300)] + [(900, 0, None, 1.0), (901, 0, float("nan"), 1.0), (902, 0, float("inf"), 1.0)]
    points = spark.createDataFrame(rows, "id long, g long, x double, y double")
    for reach in (0.25, 1.0, 2.5, 30.0):
        want = sorted((a[0], b[0]) for a in rows[:300] for b in rows[:300] if a[0] < b[0] and a[1] == b[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= reach * reach)
        assert sorted((p.a, p.b) for p in S.pairs_within(points, "id", reach, ["g"]).collect()) == want
        assert {(x.band, x.n) for x in S.annular_counts(points, "id", [0.0, reach], ["g"]).groupBy("band").agg(F.sum("n").alias("n")).collect()} == {(0, len(want))}


def test_numbers_move_rows_once(spark):
    """One exchange of the rows; the number follows from the place that was written."""
    from punctata.operators.ids import stable_ids

    rows = spark.range(5000).selectExpr("id * 37 % 5000 AS k", "repeat('a', 9) AS text")
    out = stable_ids(rows, ["k"], "n", first=1, keep=["k"])
    assert "hashpartitioning(_part" not in out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert out.columns == ["k", "n"] and out.where("n <> k + 1").count() == 0 and out.count() == 5000


def test_thinned_by_a_bound(spark):
    from punctata.operators.patterns import thinned

    points = spark.range(40_000).selectExpr("id AS transcript_id", "CASE WHEN id % 100 > 0 THEN 'large' WHEN id % 200 > 0 THEN 'small' END AS gene")
    got = {(r.gene, r.transcript_id) for r in thinned(points, 300, 3).select("gene", "transcript_id").collect()}
    ranked = points.selectExpr("*", "row_number() OVER (PARTITION BY gene ORDER BY xxhash64(transcript_id, gene, 3), transcript_id) AS n").where("n <= 300")
    assert got == {(r.gene, r.transcript_id) for r in ranked.collect()} and len(got) == 700


def test_the_tile_grid_has_no_last_row(spark):
    rows = rasters.tile_grid(spark.createDataFrame([(60_000, 64)], "height long, width long"), 48, 6)
    facts = rows.agg(F.count("*").alias("n"), F.max("ty").alias("ty"), F.max("core_row1").alias("end"), F.sum((F.col("core_row1") - F.col("core_row0")) * (F.col("core_col1") - F.col("core_col0"))).alias("area")).first()
    assert tuple(facts) == (2500, 1249, 60_000, 60_000 * 64)


def test_nearest_of_copies(spark):
    """10,000 points at one place, 10,000 targets at another, 10,000 equal outlines."""
    points = spark.range(10_000).selectExpr("id", "0e0 AS x", "0e0 AS y").unionByName(spark.createDataFrame([(20_000, 9.0, 0.0)], "id long, x double, y double"))
    same = points.selectExpr("id AS other", "x AS tx", "y AS ty")
    began = time.time()
    got = S.nearest_points(points, same, "id", "other", 2, skip_same=True).groupBy("id").agg(F.min(F.struct("nth", "other", "distance")).alias("a"), F.max(F.struct("nth", "other", "distance")).alias("b"))
    got = {r.id: (tuple(r.a), tuple(r.b)) for r in got.collect()}
    first = {0: (1, 2), 1: (0, 2)}
    assert got.pop(20_000) == ((1, 0, 9.0), (2, 1, 9.0)) and len(got) == 10_000
    assert all((a[1], b[1]) == first.get(i, (0, 1)) and a[2] == b[2] == 0.0 for i, (a, b) in got.items())
    shapes = _boxes(spark.range(10_000).selectExpr("id + 5 AS shape", "20e0 AS cx", "0e0 AS cy", "2e0 AS half"))
    near = S.nearest_segments(points, shapes, "id", "shape").select("shape", "distance", "edge_x", "edge_y").groupBy("shape", "distance", "edge_x").count().collect()
    assert sorted(tuple(r) for r in near) == [(5, 9.0, 18.0, 1), (5, 18.0, 18.0, 10_000)]
    assert time.time() - began < 90

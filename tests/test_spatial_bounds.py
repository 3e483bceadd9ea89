"""Shapes of very different sizes, and nearest searches by bounds, against brute force."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from punctata.operators import pyramid
from punctata.operators import spatial as S

NAN, INF = float("nan"), float("inf")


def _rings(spark, rows):
    return S.with_outline(spark.createDataFrame(rows, "shape int, ring array<struct<x: double, y: double>>"), "ring").drop("ring")


def _circle(cx, cy, r, n):
    out = [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*out, out[0]]


def _square(x, y, half):
    return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]


def _inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def test_points_without_coordinates_are_in_no_shape(spark):
    shapes = _rings(spark, [(1, _square(0.0, 0.0, 100.0)), (2, _square(0.0, 0.0, 2.0))])
    points = spark.createDataFrame([(1, NAN, 4.0), (2, NAN, NAN), (3, 4.0, NAN), (4, None, 1.0), (5, 1.0, None), (6, INF, 1.0), (7, 1.0, -INF), (8, 1.0, 1.0)], "id long, x double, y double")
    assert sorted((r.id, r.shape) for r in S.in_shapes(points, shapes).collect()) == [(8, 1), (8, 2)]
    assert {r.id: r.n for r in S.count_covering(points, shapes, "id", "n").collect()} == {**dict.fromkeys(range(1, 8), 0), 8: 2}
    masks = {r.id: (r.n_masks, r.assigned, r.source) for r in S.overlap_assignment(points.withColumn("prior", F.lit(2)), shapes, "id", "shape", "prior").collect()}
    assert masks == {**dict.fromkeys(range(1, 8), (0, None, "outside")), 8: (2, 2, "proseg_overlap")}
    labels = S.priority_labels(points, shapes.selectExpr("*", "shape AS rank", "'tissue' AS label"), "id")
    assert {r.id: r.tissue for r in labels.collect()} == {**dict.fromkeys(range(1, 8), "outside_brain"), 8: "tissue"}


def test_shapes_without_coordinates_hold_nothing(spark):
    shapes = _rings(spark, [(1, [(0.0, 0.0), (NAN, 0.0), (9.0, 9.0), (0.0, 0.0)]), (2, []), (3, None), (4, [(0.0, 0.0), (INF, 0.0), (9.0, 9.0), (0.0, 0.0)])])
    points = spark.createDataFrame([(1, 1.0, 0.5)], "id long, x double, y double")
    assert S.in_shapes(points, shapes, edges=True).count() == 0
    assert S.in_shapes(points, shapes.where("shape = 9")).count() == 0
    line = _rings(spark, [(1, [(1.0, 0.5), (1.0, 0.5), (1.0, 0.5)])])
    assert S.in_shapes(points, line, edges=True).count() == 1 and S.in_shapes(points, line).count() == 0


@pytest.mark.parametrize("most", [2, 32])
def test_mixed_sizes_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_SEGMENTS", most)
    r = random.Random(most)
    rings = [_circle(0.0, 0.0, 3000.0, 500), _circle(40.0, -700.0, 900.0, 90), _circle(1e6, 1e6, 5.0, 12)]
    rings += [_square(r.uniform(-50, 50), r.uniform(-50, 50), r.choice([0.001, 0.3, 2.0, 11.0])) for _ in range(60)]
    points = [(i, r.gauss(0, s), r.gauss(0, s)) for i, s in enumerate([20.0] * 400 + [1500.0] * 400)]
    got = {(x.id, x.shape) for x in S.in_shapes(spark.createDataFrame(points, "id long, x double, y double"), _rings(spark, list(enumerate(rings)))).collect()}
    assert got == {(i, s) for s, ring in enumerate(rings) for i, x, y in points if _inside(ring, x, y)}


def test_a_tissue_beside_many_cells_is_cheap(spark):
    """One ring of 6,100 units beside 20,000 boxes: its cells are few, and the join ends soon."""
    boxes = spark.range(20_000).selectExpr("CAST(id AS INT) AS shape", "CAST(id * 37 % 6000 AS DOUBLE) AS cx", "CAST(id * 91 % 6000 AS DOUBLE) AS cy", "2e0 AS h")
    corner = lambda a, b: F.struct((F.col("cx") + a * F.col("h")).alias("x"), (F.col("cy") + b * F.col("h")).alias("y"))
    cells = S.with_outline(boxes, F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1), corner(-1, -1))).select("shape", "segs", "x0", "y0", "x1", "y1")
    shapes = cells.unionByName(_rings(spark, [(-1, _circle(3000.0, 3000.0, 3050.0, 4000))]).select(cells.columns))
    points = spark.range(20_000).selectExpr("id", "CAST(id * 53 % 6000 AS DOUBLE) + 0.5e0 AS x", "CAST(id * 29 % 6000 AS DOUBLE) + 0.5e0 AS y")
    began = time.time()
    per = {r.shape: r.n for r in S.in_shapes(points, shapes).groupBy((F.col("shape") >= 0).alias("shape")).agg(F.count("*").alias("n")).collect()}
    assert time.time() - began < 25
    assert S.covering_cells(shapes)[0].groupBy("shape").count().agg(F.max("count")).first()[0] < 4000
    assert 0.75 * 20_000 < per[False] < 0.85 * 20_000 and per[True] > 1000


def _nearest(points, targets, k, skip):
    out = set()
    for i, x, y in points:
        near = sorted(((x - a) * (x - a) + (y - b) * (y - b), t) for t, a, b in targets if not (skip and t == i))[:k]
        out |= {(i, t, n, round(math.sqrt(d), 6)) for n, (d, t) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("k,skip,wide", [(1, False, 4096), (6, True, 4096), (3, False, 20)])
def test_nearest_points_by_brute_force(spark, monkeypatch, k, skip, wide):
    monkeypatch.setattr(pyramid, "WIDE", wide)
    r = random.Random(k)
    places = [(r.gauss(0, 3), r.gauss(0, 3)) for _ in range(300)] + [(r.uniform(-1e4, 1e4), r.uniform(-1e4, 1e4)) for _ in range(60)] + [(5.0, 5.0)] * 90 + [(float(a), float(b)) for a in range(12) for b in range(12)]
    points = [(i, *p) for i, p in enumerate(places)]
    targets = points if skip else [(1000 + i, r.gauss(50, 20), r.gauss(0, 1)) for i in range(400)] + [(2000 + i, 7.0, 7.0) for i in range(40)]
    p = spark.createDataFrame([*points, (-1, NAN, 0.0)], "id long, x double, y double")
    t = spark.createDataFrame([*targets, (-2, 0.0, INF)], "t long, tx double, ty double")
    got = S.nearest_points(p, t, "id", "t", k, skip_same=skip)
    assert {(x.id, x.t, x.nth, round(x.distance, 6)) for x in got.collect()} == _nearest(points, targets, k, skip)
    assert got.count() == k * len(points)


def test_far_points_and_dense_places_end_soon(spark):
    """3,000 far points against 20,000 outlines, and 100,000 points in one unit: neither meets all of the other side."""
    boxes = spark.range(20_000).selectExpr("id AS shape", "CAST(id * 37 % 500 AS DOUBLE) AS cx", "CAST(id * 91 % 499 AS DOUBLE) AS cy")
    corner = lambda a, b: F.struct((F.col("cx") + a).alias("x"), (F.col("cy") + b).alias("y"))
    shapes = S.with_outline(boxes, F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1), corner(-1, -1)))
    far = spark.range(3000).selectExpr("id", "1e6 + id AS x", "CAST(id * 7 % 3000 AS DOUBLE) AS y")
    began = time.time()
    assert S.nearest_outlines(far, shapes, "id", "shape").where("distance < 999000").count() == 0
    dense = spark.range(100_000).selectExpr("id", "(id * 7919 % 100003) / 100003e0 AS x", "(id * 104729 % 99991) / 99991e0 AS y")
    assert S.nearest_points(dense, dense.selectExpr("id AS t", "x AS tx", "y AS ty"), "id", "t", 2, skip_same=True).count() == 200_000
    assert time.time() - began < 90


def test_nearest_outlines_by_brute_force(spark):
    r = random.Random(5)
    rings = [(i, _circle(r.uniform(0, 200), r.uniform(0, 200), r.uniform(0.5, 6), r.choice([3, 5, 12]))) for i in range(70)] + [(70, _circle(100.0, 100.0, 400.0, 300)), (71, _square(10.0, 10.0, 3.0)), (72, _square(10.0, 10.0, 3.0))]
    points = [(i, r.uniform(-50, 250), r.uniform(-50, 250)) for i in range(300)] + [(300, 10.0, 14.0), (301, 1e5, 0.0)]

    def away(ring, x, y):
        best = INF
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            dx, dy = bx - ax, by - ay
            n = dx * dx + dy * dy
            t = max(0.0, min(1.0, ((x - ax) * dx + (y - ay) * dy) / n)) if n else 0.0
            best = min(best, math.hypot(x - ax - t * dx, y - ay - t * dy))
        return best

    got = {x.id: x for x in S.nearest_segments(spark.createDataFrame(points, "id long, x double, y double"), _rings(spark, rings), "id", "shape").collect()}
    for i, x, y in points:
        d = {s: away(ring, x, y) for s, ring in rings}
        assert got[i].distance == pytest.approx(min(d.values()), abs=1e-9)
        assert d[got[i].shape] == pytest.approx(got[i].distance, abs=1e-9)
        assert math.hypot(x - got[i].edge_x, y - got[i].edge_y) == pytest.approx(got[i].distance, abs=1e-9)
    assert got[300].shape == 71

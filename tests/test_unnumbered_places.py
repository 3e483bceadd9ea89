"""Pair counts ask for places and their number of points only; searches ask each place once."""

import math
import random

import pytest
from pyspark.sql import functions as F

from punctata import roles
from punctata.operators import pyramid
from punctata.operators import spatial as S


@pytest.fixture
def unnumbered(monkeypatch):
    """Numbering every row is a sort of the whole table, which a count of pairs has no use for."""

    def refused(*args):
        raise AssertionError("rows were numbered")

    monkeypatch.setattr(roles, "numbered_transcripts", refused)


def test_annular_counts_without_a_key(spark):
    """Equal rows without a key are points of their own; null and NaN coordinates are none."""
    rows = [("g", 0.0, 0.0)] * 3 + [("g", 1.0, 0.0), ("g", 3.0, 4.0), ("h", 0.0, 0.0), ("g", None, 0.0), ("g", float("nan"), 0.0), (None, 0.0, 1.0), (None, 0.0, 0.0)]
    points = spark.createDataFrame(rows, "gene string, x double, y double")
    got = {(r.gene, r.band): r.n for r in S.annular_counts(points, None, [0.0, 1.0, 5.0], ["gene"]).collect()}
    assert {k: n for k, n in got.items() if k[0]} == {("g", 0): 3 + 3, ("g", 1): 3 + 1}
    keyed = points.withColumn("id", F.monotonically_increasing_id())
    assert {(r.gene, r.band): r.n for r in S.annular_counts(keyed, "id", [0.0, 1.0, 5.0], ["gene"]).collect()} == got


def test_annular_pairs_number_no_rows(spark, unnumbered):
    from punctata.plans import spatial

    assert spatial.QUERIES["j26_annular_pairs"](spark, "/root/testdata/sf0.001").agg(F.sum("n")).first()[0] > 0


def test_observed_pairs_number_no_rows(spark, unnumbered):
    from punctata.plans import aggregates

    assert aggregates.QUERIES["a27_observed_pairs"](spark, "/root/testdata/sf0.001").agg(F.sum("n")).first()[0] > 0


def _distance(x, y, ring):
    def far(a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        n = dx * dx + dy * dy
        t = max(0.0, min(1.0, ((x - a[0]) * dx + (y - a[1]) * dy) / n)) if n else 0.0
        return math.hypot(x - a[0] - t * dx, y - a[1] - t * dy)

    return min(far(a, b) for a, b in zip(ring, ring[1:]))


@pytest.mark.parametrize("few, full, wide", [(32, 1024, 4096), (2, 6, 5)])
def test_nearest_outlines_in_bulk_by_brute_force(spark, monkeypatch, few, full, wide):
    """Many points to a leaf, leaves that are split again, and points dealt with one by one."""
    for name, value in (("FEW", few), ("FULL", full), ("WIDE", wide)):
        monkeypatch.setattr(pyramid, name, value)
    monkeypatch.setattr(pyramid.candidates, "__defaults__", (few, *pyramid.candidates.__defaults__[1:]))
    r = random.Random(4)
    points = [(i, r.choice((r.gauss(0, 3), r.uniform(-90, 90))), r.gauss(0, 40)) for i in range(3000)] + [(5000, 1e6, 1e6), (5001, None, 0.0), (5002, float("inf"), 0.0)]
    rings = {}
    for k in range(60):
        x, y = r.gauss(0, 25), r.gauss(0, 25)
        corners = [(x + r.uniform(-4, 4), y + r.uniform(-4, 4)) for _ in range(r.randint(2, 6))]
        rings[f"s{k}"] = [*corners, corners[0]]
    rings["t"] = rings["s3"]
    shapes = S.with_outline(spark.createDataFrame(list(rings.items()), "shape string, ring array<struct<x: double, y: double>>"), "ring").drop("ring")
    got = {g.id: (g.shape, g.distance) for g in S.nearest_outlines(spark.createDataFrame(points, "id long, x double, y double"), shapes, "id", "shape").collect()}
    assert got.keys() == {p[0] for p in points[:-2]}
    for i, x, y in points[:-2]:
        best = min((_distance(x, y, ring), k) for k, ring in rings.items())
        assert abs(got[i][1] - best[0]) <= 1e-9 * max(1.0, best[0]) and (got[i][0] == best[1] or abs(_distance(x, y, rings[got[i][0]]) - best[0]) < 1e-9)


@pytest.fixture
def searched(monkeypatch):
    """The number of rows of each search for nearest targets and for shapes around points."""
    seen = {"candidates": [], "in_shapes": []}
    for module, name in ((pyramid, "candidates"), (S, "in_shapes")):
        was = getattr(module, name)

        def counted(points, *args, _was=was, _name=name, **named):
            seen[_name].append(points.count())
            return _was(points, *args, **named)

        monkeypatch.setattr(module, name, counted)
    return seen


def _copies(spark):
    points = spark.range(3000).selectExpr("id", "CAST(id % 30 AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS y")
    return points, S.with_outline(spark.range(5).selectExpr("id AS shape", "10e0 AS cx", "0e0 AS cy", "2e0 + id AS half"), roles.ring())


def test_points_of_one_place_share_a_search_of_outlines(spark, searched):
    points, shapes = _copies(spark)
    got = S.nearest_outlines(points, shapes, "id", "shape").groupBy("distance").count().collect()
    assert searched["candidates"] == [30] and sum(r["count"] for r in got) == 3000


def test_compartments_ask_each_place_once(spark, searched):
    points, shapes = _copies(spark)
    nowhere = points.withColumn("x", F.lit(None).cast("double")).withColumn("id", F.col("id") + 9000).limit(2)
    got = S.compartments(points.unionByName(nowhere), shapes, shapes.where("shape = 0"), "id", "shape", "shape").groupBy("compartment", "n_cells", F.col("cell_distance").isNull().alias("none")).count().collect()
    assert searched == {"candidates": [30, 30], "in_shapes": [30, 30]} and sum(r["count"] for r in got) == 3002
    assert [(r.compartment, r.n_cells, r["count"]) for r in got if r.none] == [("extracellular", 0, 2)]

"""Places along curves, interior points, and counters observed while rows are written."""

import math
import random

import pytest
from pyspark.sql import functions as F

from punctata.operators import paths, shapes
from punctata.operators import predicates as P
from punctata.operators import spatial as S
from test_spatial_bounds import _inside, _rings, _square


def test_places_along_curves(spark):
    curves = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 10.0, 0.0), ("a", 3, 10.0, 5.0), ("b", 1, 0.0, 50.0), ("b", 2, 0.0, 60.0), ("c", 1, 3.0, 3.0)], "curve string, k int, x double, y double")
    points = spark.createDataFrame([(1, 4.0, 2.0), (2, 12.0, 3.0), (3, -5.0, 0.0), (4, 1.0, 57.0), (5, float("nan"), 0.0), (6, 10.0, 9.0)], "id long, x double, y double")
    got = {r.id: (r.curve, r.distance, r.length) for r in paths.along_curves(points, curves, "id", "curve", "k").collect()}
    assert got == {1: ("a", 2.0, 4.0), 2: ("a", 2.0, 13.0), 3: ("a", 5.0, 0.0), 4: ("b", 1.0, 7.0), 6: ("a", 4.0, 15.0)}


def test_valid_lines_are_preferred(spark):
    rows = [(1, 1, 0.0, 0.0, 8.0, True), (1, 2, 0.0, 4.0, 8.0, True), (2, 3, 5.0, 0.0, 9.0, False), (2, 4, 5.0, 1.0, 9.0, False), (3, 5, 9.0, 9.0, 2.0, True), (4, 6, 7.0, 7.0, 0.0, True), (4, 7, 7.0, 8.0, 0.0, True)]
    samples = spark.createDataFrame(rows, "line long, k long, x double, y double, thickness double, reached boolean")
    assert {r.line for r in paths.valid_lines(samples, "line", "reached", "thickness").collect()} == {1}
    assert {r.line for r in paths.valid_lines(samples.where("line <> 1"), "line", "reached", "thickness").collect()} == {2, 3, 4}
    pia = spark.createDataFrame([(0, 1, -2.0, -1.0), (0, 2, 8.0, -1.0)], "curve int, k int, x double, y double")
    points = spark.createDataFrame([(1, 5.0, 0.9), (2, 0.0, 0.1)], "id long, x double, y double")
    got = {r.id: (r.column_id, r.pia_distance, r.wm_distance, r.tangential) for r in paths.streamline_depth(points, samples, pia, "id").collect()}
    assert got == {1: (1, 0.0, 8.0, 2.0), 2: (1, 0.0, 8.0, 2.0)}


def test_interior_points_are_inside(spark):
    r = random.Random(3)
    rings = [[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (8.0, 9.0), (8.0, 1.0), (1.0, 1.0), (1.0, 9.0), (0.0, 9.0), (0.0, 0.0)], [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (3.0, 2.0), (0.0, 6.0), (0.0, 0.0)]]
    for _ in range(40):
        n = r.randint(3, 14)
        star = [(r.uniform(0.1, 5) * math.cos(2 * math.pi * i / n), r.uniform(0.1, 5) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        rings.append([*star, star[0]])
    df = spark.createDataFrame(list(enumerate(rings)), "id int, ring array<struct<x: double, y: double>>")
    for row in df.select("id", shapes.interior_point(F.col("ring")).alias("p")).collect():
        assert _inside(rings[row.id], row.p.x, row.p.y), rings[row.id]
    flat = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)]), (2, [(0.0, 0.0), (2.0, 2.0), (0.0, 4.0), (2.0, 2.0), (0.0, 0.0)])], "id int, ring array<struct<x: double, y: double>>")
    got = {x.id: (x.x, x.y) for x in shapes.centroids(flat, F.col("ring"), "id").collect()}
    assert got[1] == (2.0, 0.0) and got[2] == (1.0, 2.0)
    # Two lobes that cancel out: no area, but an inside.
    eight = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)])], "id int, ring array<struct<x: double, y: double>>")
    x, y = eight.select(shapes.centroids(eight, F.col("ring"), "id").columns[0]).count() and tuple(shapes.centroids(eight, F.col("ring"), "id").first())[1:]
    assert _inside([(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)], x, y)


def test_counters_of_dropped_points(spark):
    points = spark.createDataFrame([(1, "g", 1.0, 1.0), (2, "Blank-1", 1.0, 1.0), (3, "g", 99.0, 1.0), (4, "g", float("nan"), 1.0), (5, "Blank-2", None, 1.0), (6, None, 2.0, 2.0)], "id long, gene string, x double, y double")
    tissue, cells, nuclei = _rings(spark, [(1, _square(0.0, 0.0, 10.0))]), _rings(spark, [(1, _square(1.0, 1.0, 1.5))]), _rings(spark, [(1, _square(1.0, 1.0, 0.5))])
    rows, seen = S.classified_points(points, tissue, cells, nuclei, F.col("gene").startswith("Blank"), "id", "shape", "shape")
    assert seen == {"n_input": 6, "n_missing": 2, "n_control": 1, "n_outside": 1, "n_kept": 2}
    assert {r.id: r.compartment for r in rows.collect()} == {1: "nuclear", 6: "cytoplasmic"}


def test_counters_of_an_export(spark):
    rows = [("a", 30.0, 1.0, 1), ("Bx", 30.0, 1.0, 2), ("a", 3.0, 1.0, 1), ("a", 30.0, float("inf"), 1), ("c", 25.0, 2.0, None), (" ", 40.0, 1.0, 3)]
    points = spark.createDataFrame(rows, "gene string, qv double, x double, assignment long").withColumn("y", F.lit(0.0))
    kept, seen = P.exported(points, "B", 20)
    assert sorted(r.gene for r in kept.collect()) == ["a", "c"]
    assert seen.get == {"n_input": 6, "n_written": 2, "n_excluded": 1, "n_seeded": 1}
    assert seen.get["n_written"] == pytest.approx(kept.count())


def test_plot_frame(spark):
    rows = [(1, "a", 0.5, 2.0, "x"), (2, None, 0.5, 2.0, "x"), (3, "a", float("nan"), 2.0, "x"), (4, "b", 1.0, -1.0, "x"), (5, "b", 1.0, float("inf"), "x"), (6, "b", 0.1, 3.0, "y"), (7, "b", None, 3.0, "x"), (8, "b", 0.2, 4.0, None)]
    frame = spark.createDataFrame(rows, "id long, grp string, depth double, area double, label string")
    long = P.plot_frame(frame, ["id"], "grp", ["depth", "area"], depth="depth", label="label", known=["x", "z"])
    assert sorted(map(tuple, long.collect())) == [(1, "a", "area", 2.0), (1, "a", "depth", 0.5), (4, "b", "depth", 1.0), (5, "b", "depth", 1.0)]
    assert P.plot_frame(frame, ["id"], "grp", ["area"]).count() == 5


def test_diagnostic_genes(spark):
    from punctata.operators import tables

    rows = [(g, f, float(v)) for f, values in (("f0", "abcde"), ("f1", "abfgh"), ("f2", "iaaaa")) for v, g in enumerate(reversed(values))]
    rows = list({(g, f): (g, f, v) for g, f, v in rows}.values()) + [("z", "f2", float("nan")), ("y", "f2", None)]
    got = [(r.gene, r.family, r["rank"]) for r in tables.diagnostic_genes(spark.createDataFrame(rows, "gene string, family string, value double"), 6, 4, 3).collect()]
    assert got == [("a", "f0", 1), ("i", "f2", 1), ("b", "f0", 2), ("c", "f0", 3), ("f", "f1", 3), ("d", "f0", 4)]

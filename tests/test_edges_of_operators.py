"""Cases at the edges: far points, few targets, large tables of ties, tails, texts among ids."""

import math

import pytest
from pyspark.sql import functions as F

from punctata.functions import stats
from punctata.operators import counts, graphs, ids, specificity, tables
from punctata.operators import predicates as P
from punctata.operators import spatial as S
from punctata.sources import readers, writers


def _box(spark, rows):
    shapes = spark.createDataFrame(rows, "object_id string, a double, b double, c double, d double")
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return S.with_outline(shapes, F.array(corner("a", "b"), corner("c", "b"), corner("c", "d"), corner("a", "d"), corner("a", "b"))).drop("a", "b", "c", "d")


def test_far_and_missing_points_around_objects(spark):
    points = spark.createDataFrame([(1, 60_000.0, 5.0), (2, float("nan"), 1.0), (3, None, 1.0), (4, 5.0, 5.0), (5, -3.0, 14.0), (6, float("inf"), 0.0)], "id long, x double, y double")
    rows = {r.id: r for r in S.assign_objects(points, _box(spark, [("o", 0.0, 0.0, 10.0, 10.0)]), "id", "object_id").collect()}
    assert (rows[1].object_id, rows[1].distance, rows[1].missing_coordinate, rows[1].edge_x, rows[1].edge_y) == ("o", 59_990.0, False, 10.0, 5.0)
    assert all(rows[i].missing_coordinate and rows[i].object_id is None for i in (2, 3, 6))
    assert (rows[4].distance, rows[4].inside) == (-5.0, True)
    assert (rows[5].distance, rows[5].edge_x, rows[5].edge_y) == (5.0, 0.0, 10.0)
    none = S.assign_objects(points, _box(spark, [("o", 0.0, 0.0, 1.0, 1.0)]).where("object_id = 'p'"), "id", "object_id")
    assert none.where("object_id IS NULL").count() == 6 and none.where("missing_coordinate").count() == 3


def test_nearest_points_however_far(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1e6, -1e6), (3, float("nan"), 0.0)], "id long, x double, y double")
    targets = spark.createDataFrame([(7, 3.0, 4.0), (8, 2e6, 0.0), (9, 6.0, 8.0)], "t long, tx double, ty double")
    want = {(p, t): math.hypot(x - tx, y - ty) for p, x, y in ((1, 0.0, 0.0), (2, 1e6, -1e6)) for t, tx, ty in ((7, 3.0, 4.0), (8, 2e6, 0.0), (9, 6.0, 8.0))}
    for k in (2, 5):
        got = S.nearest_points(points, targets, "id", "t", k).collect()
        for p in (1, 2):
            mine = sorted((d, t) for (q, t), d in want.items() if q == p)[:k]
            found = [(round(r.distance, 6), r.t) for r in sorted(got, key=lambda r: r.nth) if r.id == p]
            assert found == [(round(d, 6), t) for d, t in mine]
        assert all(r.id != 3 for r in got)
    assert S.nearest_points(points, targets.limit(0), "id", "t").count() == 0


def test_hypergeometric_tails():
    for total, good, drawn in ((30, 12, 9), (50, 49, 25), (20, 0, 5), (7, 7, 7), (200, 90, 60)):
        p = {x: math.comb(good, x) * math.comb(total - good, drawn - x) / math.comb(total, drawn) for x in range(max(0, drawn - total + good), min(good, drawn) + 1)}
        for k in range(-1, drawn + 2):
            upper, lower = stats.hypergeometric_tails(k, total, good, drawn)
            assert upper == pytest.approx(sum(v for x, v in p.items() if x >= k), abs=1e-11)
            assert lower == pytest.approx(sum(v for x, v in p.items() if x <= k), abs=1e-11)
    upper, lower = stats.hypergeometric_tails(500_100_000, 4_000_000_000, 2_000_000_000, 1_000_000_000)
    assert upper == pytest.approx(math.erfc(1e5 / math.sqrt(2 * 1e9 * 0.25 * 0.75)) / 2, rel=1e-2) and 0.99 < lower <= 1


def test_rank_sums_of_more_than_two_million_cells(spark):
    n = 2_200_000
    classes = spark.range(n).selectExpr("id AS cell_id", "if(id % 2 = 0, 'a', 'b') AS broad_class")
    values = spark.createDataFrame([(0, "g", 3), (2, "g", 1), (5, "g", 1)], "cell_id long, gene string, n long")
    rows = {r.broad_class: r for r in specificity.rank_sums(values, classes).collect()}
    assert rows["a"].rank_sum + rows["b"].rank_sum == n * (n + 1) / 2
    assert rows["a"].score == pytest.approx(-rows["b"].score) and rows["a"].score > 0


def test_components_that_do_not_settle_raise(spark):
    edges = spark.range(400).selectExpr("(id * 7919) % 401 AS src", "((id + 1) * 7919) % 401 AS dst")
    with pytest.raises(RuntimeError):
        graphs.connected(edges, rounds=1)
    assert graphs.connected(edges).select("component").distinct().count() == 1


def test_points_contract_keeps_text(spark):
    rows = spark.createDataFrame([("g", "1", "5", "x7", "c"), (None, None, "6", "8", None)], "gene string, cell string, transcript_id string, assignment string, cell_id string")
    kept = P.points_contract(rows, keep_text=True)
    assert dict(kept.dtypes) == {"gene": "string", "cell": "bigint", "transcript_id": "bigint", "assignment": "string", "cell_id": "string"}
    assert sorted(r.assignment for r in kept.collect()) == ["8", "x7"]
    assert P.points_contract(rows.where("cell = '1'").withColumn("assignment", F.lit("4")), keep_text=True).first().assignment == 4


def test_label_split_and_too_few(spark):
    rows = spark.createDataFrame([("CGE interneuron",), ("Upper rhombic lip ",), ("Microglia",), ("Thalamic excitatory inhibitory",)], "label string")
    assert [r[0] for r in rows.select(P.label_split(F.col("label"))).collect()] == ["Inhibitory", "Excitatory", "Other", "Inhibitory"]
    few = spark.createDataFrame([(1, "g", 5), (2, "g", 5)], "cell_id long, gene string, n long")
    assert P.cells_then_genes(few, 1, 1).count() == 2
    with pytest.raises(ValueError):
        P.cells_then_genes(few, 1, 1, 3, 2)


def test_metrics_by_row_order_and_medians(spark):
    cells = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    metrics = spark.createDataFrame([(12, 2, 2.5), (11, 1, 1.5), (13, 3, 3.5)], "id long, ord long, area double")
    got = tables.attach_metrics(cells, metrics, "id", "ord", ["area"], rows_by="id").collect()
    assert sorted((r.id, r.area) for r in got) == [(1, 1.5), (2, 2.5), (3, 3.5)]
    assert tables.attach_metrics(cells, metrics, "id", "ord", ["area"]).where("area IS NULL").count() == 3
    per = spark.createDataFrame([(1, 2, 1, 4.0, 0.5), (2, 4, 3, 8.0, 0.7)], "cell long, n_transcripts long, n_genes long, area double, eccentricity double")
    row = counts.dataset_summary(spark.range(5).withColumn("ok", F.col("id") > 0), F.col("ok"), per).first()
    assert (row.median_area, row.median_eccentricity) == (6.0, pytest.approx(0.6))


def test_points_in_a_large_ring_by_brute_force(spark, monkeypatch):
    """A star-shaped ring over many cells, cut at few segments: whole tiles, edge tiles and points on the edge."""
    import random

    r = random.Random(8)
    turn = [2 * math.pi * i / 60 for i in range(60)]
    ring = [(round(50 + (40 if i % 2 else 17 + r.random()) * math.cos(t), 2), round(50 + (40 if i % 2 else 17) * math.sin(t), 2)) for i, t in enumerate(turn)]
    ring.append(ring[0])
    square = [(20.0, 20.0), (24.0, 20.0), (24.0, 24.0), (20.0, 24.0), (20.0, 20.0)]
    rings = spark.createDataFrame([(1, ring), (2, square)], "shape int, ring array<struct<x: double, y: double>>")
    points = [(i, r.uniform(0, 100), r.uniform(0, 100)) for i in range(3000)] + [(3000 + i, x, y) for i, (x, y) in enumerate([*ring, *square, (20.0, 22.0), (22.0, 24.0)])]

    def state(ring, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return "edge"
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
        return "in" if odd else "out"

    rows = spark.createDataFrame(points, "point int, x double, y double")
    for most in (1, 4, 32):
        monkeypatch.setattr(S, "MOST_SEGMENTS", most)
        for edges in (False, True):
            got = {(x.point, x.shape) for x in S.in_shapes(rows, S.with_outline(rings, "ring"), edges).collect()}
            want = {(i, s) for s, g in ((1, ring), (2, square)) for i, x, y in points if state(g, x, y) in (("in", "edge") if edges else ("in",))}
            assert got == want


def test_values_by_key_row_order_or_own_column(spark):
    left = spark.createDataFrame([(i, f"n{i}", 5.0 + i) for i in range(4)], "id long, name string, area0 double")
    right = spark.createDataFrame([(str(i), 10.0 * i) for i in (3, 1, 0, 2)], "label string, area double")
    by_key = tables.attach_value(left, right, [("name", "label"), ("id", "label")], "area").collect()
    assert {(r.id, r.area, r.by) for r in by_key} == {(i, 10.0 * i, "id=label") for i in range(4)}
    by_order = tables.attach_value(left, right, [("name", "label")], "area", left_order=["id"], right_order=[F.desc("label")]).collect()
    assert {(r.id, r.area, r.by) for r in by_order} == {(i, 10.0 * (3 - i), "row order") for i in range(4)}
    own = tables.attach_value(left, right.limit(2), [("name", "label")], "area", own=["gone", "area0"], left_order=["id"], right_order=["label"]).collect()
    assert {(r.id, r.area, r.by) for r in own} == {(i, 5.0 + i, "area0") for i in range(4)}
    with pytest.raises(ValueError):
        tables.attach_value(left, right, [("name", "label")], "area")


def test_commented_csv_of_many_files(spark, tmp_path):
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS cell_id", "concat('l,', id) AS label").repartition(7)
    writers.write_commented_csv(rows, f"{tmp_path}/a", ["made here", "by a test"])
    back = readers.read_commented_csv(spark, f"{tmp_path}/a", ["cell_id", "label"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_numbers_of_crowded_and_null_keys(spark):
    rows = spark.createDataFrame([(None if i % 50 == 0 else 10.0 ** (i % 200), i) for i in range(5000)], "x double, k long").repartition(9)
    got = ids.stable_ids(rows, ["x", "k"]).collect()
    want = sorted(((r.x is not None, r.x or 0, r.k) for r in got))
    assert [r.k for r in sorted(got, key=lambda r: r.id)] == [w[2] for w in want]
    assert sorted(r.id for r in got) == list(range(1, 5001))

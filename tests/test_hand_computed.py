"""Small cases whose results are computed by hand."""

import math

import pytest
from pyspark.sql import functions as F

from punctata import roles
from punctata.functions import stats
from punctata.operators import cohort, counts, graphs, ids, labels, paths, patterns, predicates, rasters, shapes, spatial, specificity, tables
from punctata.sources import readers


def _col(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def _boxes(spark, rows):
    """Outlined boxes from (id, x0, y0, x1, y1)."""
    df = spark.createDataFrame([(i, (a + c) / 2.0, (b + d) / 2.0, [(float(a), float(b)), (float(c), float(b)), (float(c), float(d)), (float(a), float(d)), (float(a), float(b))]) for i, a, b, c, d in rows], "id long, cx double, cy double, ring array<struct<x double, y double>>")
    return spatial.with_outline(df, "ring").drop("ring", "cx", "cy")


def test_assignment_masks(spark):
    nullable = spark.createDataFrame([(0,), (1,), (None,)], "a long")
    assert [r.assigned for r in predicates.assigned_numeric(nullable, "a").orderBy("a").collect()] == [False, True, True]
    dense = spark.createDataFrame([(0,), (1,), (2,)], "a long")
    assert [r.assigned for r in predicates.assigned_numeric(dense, "a").orderBy("a").collect()] == [False, True, True]
    text = spark.createDataFrame([(" None ",), ("7",), (None,), ("",), ("unassigned",)], "a string")
    assert [r[0] for r in text.select(predicates.assigned_text("a")).collect()] == [False, True, False, False, False]


def test_background_wins(spark):
    rows = spark.createDataFrame([(0, False, "A"), (None, True, "B"), (2, False, "C")], "assignment long, background boolean, gene string")
    assert predicates.with_assigned(rows, "assignment").where("assigned").count() == 2
    with pytest.raises(KeyError):
        predicates.with_assigned(rows.select("gene"))


def test_cell_metrics(spark):
    t = spark.createDataFrame([("a", "G1", 1), ("a", "G3", 3), ("b", "G3", 2)], "cell_id string, gene string, n long")
    cells = spark.createDataFrame([("a",), ("b",), ("c",)], "cell_id string")
    assert _col(counts.cell_metrics_from_counts(t, cells), "cell_id", "n_transcripts", "n_genes") == [("a", 4, 2), ("b", 2, 1), ("c", 0, 0)]


def test_share_and_fit(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3)], "gene string, n long")
    assert _col(counts.share(rows, "n"), "gene", "share") == [("a", 0.25), ("b", 0.75)]
    with pytest.raises(Exception, match="not positive"):
        counts.share(rows.withColumn("n", F.col("n") * 0), "n").collect()
    line = spark.createDataFrame([(1.0, 10.0), (10.0, 1000.0), (100.0, 100000.0)], "x double, y double")
    slope, intercept, r2 = line.agg(*counts.log_fit("x", "y")).first()
    assert (slope, intercept, r2) == pytest.approx((2, 1, 1))


def test_rates(spark):
    t = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (2, "A", 1), (3, "B", 1), (4, "C", 1)], "cell_id long, gene string, n long")
    m = spark.createDataFrame([("A", "x"), ("B", "y"), ("C", "x"), ("D", "y")], "gene string, broad_class string")
    rows = {(r.gene_1, r.gene_2): (r.cells_both, r.cells_either, r.mecr) for r in specificity.pair_rates(t, m).collect()}
    assert rows[("A", "B")] == (1, 3, pytest.approx(1 / 3)) and ("A", "C") not in rows and rows[("B", "C")][:2] == (0, 3)
    twice = specificity.pair_rates(t, m.union(m.where("gene = 'A'")))
    assert twice.where("gene_1 = 'A'").count() == 0


def test_markers_are_strict(spark):
    t = spark.createDataFrame([(i, "A", 1) for i in range(2)] + [(i, "B", 1) for i in range(3)], "cell_id long, gene string, n long")
    c = spark.createDataFrame([(i, "x" if i < 4 else "y") for i in range(8)], "cell_id long, broad_class string")
    f = specificity.detection_fractions(t, c)
    assert _col(specificity.unique_markers(f, 0.5, 0.01), "gene") == [("B",)]


def test_within_and_covered(spark):
    shapes_ = _boxes(spark, [(1, 0, 0, 4, 4), (2, 3, 3, 9, 9)])
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 4.0, 2.0), (3, 3.5, 3.5), (4, 20.0, 1.0)], "k long, x double, y double")
    assert _col(spatial.in_shapes(points, shapes_), "k", "id") == [(1, 1), (3, 1), (3, 2)]
    assert _col(spatial.count_covering(points, shapes_, "k", "n"), "k", "n") == [(1, 1), (2, 1), (3, 2), (4, 0)]


def test_concave_ring(spark):
    ring = [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (3.0, 2.0), (0.0, 6.0), (0.0, 0.0)]
    s = spatial.with_outline(spark.createDataFrame([(1, ring)], "id long, ring array<struct<x double, y double>>"), "ring").drop("ring")
    points = spark.createDataFrame([(1, 3.0, 1.0), (2, 3.0, 4.0), (3, 1.0, 4.0), (4, 3.0, 2.0)], "k long, x double, y double")
    assert _col(spatial.in_shapes(points, s), "k") == [(1,), (3,)]
    assert _col(spatial.in_shapes(points, s, edges=True), "k") == [(1,), (3,), (4,)]


def test_compartments(spark):
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 3.0, 7.0), (3, 15.0, 5.0)], "k long, x double, y double")
    rows = spatial.compartments(points, _boxes(spark, [(1, 1, 1, 10, 10)]), _boxes(spark, [(1, 2, 2, 5, 5)]), "k", "id", "id")
    assert _col(rows, "k", "compartment", "cell_distance") == [(1, "nuclear", 2.0), (2, "cytoplasmic", 2.0), (3, "extracellular", -5.0)]


def test_object_distances(spark):
    cells = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 85.0, 5.0), (4, 115.0, 5.0), (5, 300.0, 5.0), (6, None, 5.0)], "k long, x double, y double")
    rows = spatial.assign_objects(cells, _boxes(spark, [(1, 0, 0, 10, 10)]), "k", "id")
    bands = rows.withColumn("band", predicates.proximity(F.col("distance"), F.col("inside")))
    assert _col(bands.where("NOT missing_coordinate"), "k", "distance", "band") == [(1, -5.0, "near"), (2, 5.0, "near"), (3, 75.0, "middle"), (4, 105.0, "far"), (5, 290.0, "beyond_max")]
    assert [r.k for r in rows.where("missing_coordinate").collect()] == [6]
    nested = spatial.assign_objects(cells.where("k = 1"), _boxes(spark, [(1, -20, -20, 40, 40), (2, 0, 0, 10, 10)]), "k", "id")
    assert _col(nested, "id", "distance") == [(2, -5.0)]


def test_overlap_assignment(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0, 9), (2, 3.5, 3.5, 2), (3, 3.5, 3.5, 7), (4, 20.0, 1.0, 1)], "k long, x double, y double, prior long")
    rows = spatial.overlap_assignment(points, _boxes(spark, [(1, 0, 0, 4, 4), (2, 3, 3, 9, 9)]), "k", "id", "prior")
    assert sorted((r.k, r.source, r.assigned) for r in rows.collect()) == [(1, "single_mask", 1), (2, "proseg_overlap", 2), (3, "ambiguous_overlap", None), (4, "outside", None)]


def test_pair_bands(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 0.0), (4, 0.0, 2.5)], "k long, x double, y double")
    assert _col(spatial.annular_counts(points, "k", [0.0, 1.0, 3.0]), "band", "n") == [(0, 3), (1, 3)]


def test_distance_bins_keep_empty_ones(spark):
    rows = spark.createDataFrame([("A", 1.0, 1.0)] * 3 + [("B", -3.0, 25.0)] * 3, "gene string, cell_distance double, nucleus_distance double")
    bins = patterns.distance_bins(rows, (-20.0, -2.0, 0.0, 2.0, 20.0), least=1)
    a = {r.bin_label: r for r in bins.where("gene = 'A' AND boundary = 'cell'").collect()}
    assert len(a) == 6 and a["0_2um"].observed_fraction == 1.0 and a["0_2um"].enrichment_log2_odds > 0 and a["neg20_neg2um"].observed_count == 0


def test_tails():
    assert stats.hypergeometric_tails(2, 10, 4, 3) == pytest.approx((1 / 3, 29 / 30))
    assert stats.t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert stats.t_two_sided(0.0, 5) == 1.0


def test_benjamini_hochberg(spark):
    rows = spark.createDataFrame([(1, 0.01), (2, 0.02), (3, 0.03), (4, 0.5), (5, None)], "k long, p double")
    got = {r.k: r.q for r in stats.benjamini_hochberg(rows, "p").collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == pytest.approx([0.04, 0.04, 0.04, 0.5]) and got[5] is None


def test_pseudobulk(spark):
    cells = spark.createDataFrame([(1, "p", "near", "gm"), (2, "p", "near", "gm"), (3, "p", "far", "gm"), (4, "p", "middle", "gm"), (5, "p", "far", "wm")], "cell_id long, pair_id string, proximity string, tissue string")
    t = spark.createDataFrame([(1, "A", 1), (1, "B", 1), (2, "A", 2), (3, "B", 3), (4, "A", 9), (5, "A", 9)], "cell_id long, gene string, n long")
    assert _col(cohort.pseudobulk(t, cells, ["gm"], 1), "proximity", "gene", "n", "cell_count") == [("far", "B", 3, 1), ("near", "A", 3, 2), ("near", "B", 1, 2)]
    assert _col(cohort.pseudobulk(t, cells, ["gm"], 2), "proximity", "gene") == [("near", "A"), ("near", "B")]
    with pytest.raises(Exception, match="whole"):
        cohort.pseudobulk(t.withColumn("n", F.col("n") - 5.5), cells, ["gm"], 1).collect()


def test_moran_of_a_line(spark):
    cells = spark.range(4).withColumnRenamed("id", "cell_id")
    edges = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 1), (2, 3), (3, 2)], "src long, dst long")
    v = spark.createDataFrame([(2, "g", 1.0), (3, "g", 1.0)], "cell_id long, gene string, value double")
    r = patterns.autocorrelation(edges, v, cells, tails=False).first()
    x = [0, 0, 1, 1]
    z = [a - 0.5 for a in x]
    w = {(0, 1): 1, (1, 0): 0.5, (1, 2): 0.5, (2, 1): 0.5, (2, 3): 0.5, (3, 2): 1}
    assert r.moran_i == pytest.approx(4 / 4 * sum(c * z[i] * z[j] for (i, j), c in w.items()) / 1)
    assert r.geary_c == pytest.approx(3 / 8 * sum(c * (x[i] - x[j]) ** 2 for (i, j), c in w.items()) / 1)


def test_ids(spark):
    zero = spark.createDataFrame([(0,), (1,), (5,)], "s long")
    assert _col(ids.canonical_ids(zero, "s"), "s", "instance_id") == [(0, 1), (1, 2), (5, 6)]
    text = spark.createDataFrame([("c",), ("a",), ("b",)], "s string")
    assert _col(ids.canonical_ids(text, "s"), "s", "instance_id") == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError, match="repeats"):
        ids.canonical_ids(text.union(text), "s")
    mapping = spark.createDataFrame([(7, 1)], "old long, new long")
    rows = spark.createDataFrame([(7,), (0,), (None,)], "a long")
    assert sorted((r.a for r in ids.translate(rows, "a", mapping, "old", "new").collect()), key=str) == [1, None, None]
    with pytest.raises(Exception, match="unknown id"):
        ids.translate(spark.createDataFrame([(8,)], "a long"), "a", mapping, "old", "new").collect()


def test_unmapped_taxonomy_raises(spark):
    cells = spark.createDataFrame([(1, 9)], "cell_id long, alias long")
    m, t = spark.createDataFrame([(1, 1, 1)], "alias long, term long, ord long"), spark.createDataFrame([(1, "x")], "term long, name string")
    with pytest.raises(Exception, match="unmapped"):
        tables.taxonomy_classes(cells, m, t, F.col("name")).collect()


def test_image_statistics(spark):
    px = spark.createDataFrame([(0, c, v, 0) for c, v in enumerate((1.0, 2.0, 3.0, 10.0, float("nan")))], "row long, col long, value double, channel long")
    mask = spark.createDataFrame([(0, c, 1) for c in range(5)], "row long, col long, label long")
    r = rasters.image_statistics(px, mask).first()
    assert (r["min"], r["median"], r["mean"], r["max"], r["iqr"]) == (1.0, 2.5, 4.0, 10.0, 3.0)


def test_area_filter(spark):
    mask = spark.createDataFrame([(0, c, label) for c, label in enumerate((0, 3, 5, 5, 9, 9, 9, 9))], "row long, col long, label long")
    assert [r.label for r in rasters.filter_by_area(mask, 1, 2).orderBy("col").collect()] == [0, 1, 2, 2, 0, 0, 0, 0]


def test_stitch_keeps_the_lower_tile(spark):
    a = [(0, 1, 0, c, True) for c in range(4)] + [(1, 5, 0, c, True) for c in range(1, 5)] + [(2, 7, 0, c, True) for c in range(4, 8)]
    got = _col(rasters.stitch(spark.createDataFrame(a, "tile long, label long, row long, col long, in_core boolean")), "tile", "label")
    assert got == [(0, 1), (2, 7)]


def test_geometry(spark):
    s = spark.createDataFrame([(1, 2.0, 2.0, 1.0)], "k long, cx double, cy double, half double")
    r = shapes.geometry(s, roles.ring(), "k").first()
    assert (r.area, r.perimeter, r.convex_area, r.solidity) == (4.0, 8.0, 4.0, 1.0) and r.circularity == pytest.approx(math.pi / 4)
    assert shapes.centroids(s, roles.ring(), "k").first()[1:] == (2.0, 2.0)


def test_paths(spark):
    p = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 3.0, 4.0), (1, 2, 3.0, 9.0)], "line long, k long, x double, y double")
    assert [r.length for r in paths.with_length(p, ["line"], "k").orderBy("k").collect()] == [0.0, 5.0, 10.0]
    assert _col(paths.resampled(p, ["line"], "k", 5), "i", "x", "y") == [(0, 0.0, 0.0), (1, 1.5, 2.0), (2, 3.0, 4.0), (3, 3.0, 6.5), (4, 3.0, 9.0)]


def test_graph_operators(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "src long, dst long")
    assert _col(graphs.connected(edges), "node", "component") == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
    core = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (0, 1, 3), (0, 3, 4)], "g long, a long, b long")
    assert _col(graphs.k_core(core, "g", 2), "node") == [(1,), (2,), (3,)]
    points = spark.createDataFrame([(1, i, float(i % 3), float(i // 3), True) for i in range(9)] + [(1, 99, 50.0, 50.0, False)], "cell long, id long, x double, y double, anchor boolean")
    assert _col(graphs.bulk_points(points, "cell", "id"), "id") == [(i,) for i in range(9)]
    two = [(a, b, 1.0) for g in (0, 10) for a in range(g, g + 6) for b in range(a + 1, g + 6)] + [(0, 10, 0.1)]
    found = {r.node: r.cluster for r in graphs.dense_labels(graphs.propagate(spark.createDataFrame(two, "src long, dst long, w double"))).collect()}
    assert len({found[i] for i in range(6)}) == 1 and len({found[i] for i in range(10, 16)}) == 1 and found[0] != found[10]


def test_rand_index(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 2)], "a long, b long")
    assert labels.adjusted_rand(rows, "a", "b").first().ari == 1.0


def test_annotation_errors(spark):
    text = spark.createDataFrame([(1, '{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]]]}')], "doc long, value string")
    r = readers.object_annotations(readers.geojson_features(text)).first()
    assert (r.object_id, r.object_type, r.area) == ("objects_0001", "objects", 100.0)
    flat = text.withColumn("value", F.lit('{"type":"Polygon","coordinates":[[[0,0],[1,0],[2,0],[0,0]]]}'))
    with pytest.raises(Exception, match="without area"):
        readers.object_annotations(readers.geojson_features(flat)).collect()
    twice = text.union(text).withColumn("value", F.lit('{"type":"Feature","properties":{"object_id":"a"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}'))
    with pytest.raises(Exception, match="duplicate"):
        readers.object_annotations(readers.geojson_features(twice)).collect()


def test_pair_correlation_repeats(spark):
    points = spark.createDataFrame([(i, "A" if i < 40 else "B", (i % 7) * 0.5 + (0 if i < 40 else i * 2.0), (i % 5) * 0.5, "nuclear" if i % 2 else "cytoplasmic") for i in range(80)], "transcript_id long, gene string, x double, y double, compartment string")
    runs = [sorted(map(tuple, patterns.pair_correlation(points, [0.0, 1.0, 3.0], draws=9, most=20).select("gene", "null_model", "band", "observed", "null_mean", "pval_clustered", "n_used").collect())) for _ in range(2)]
    assert runs[0] == runs[1] and {r[6] for r in runs[0]} == {20} and {r[1] for r in runs[0]} == {"global", "compartment_stratified"}
    a = [r for r in runs[0] if r[0] == "A" and r[1] == "global" and r[2] == 0][0]
    assert a[3] > a[4]


def test_expression_neighbours_of_copies(spark):
    """Forty copies and ten others: of many at one distance the least ids are the neighbours."""
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(40)] + [(100 + i, [float(i), 9.0, 0.0]) for i in range(10)]
    got = graphs.expression_neighbours(spark.createDataFrame(rows[::-1], "id long, v array<double>"), "id", "v", 3, 20)
    want = []
    for i, v in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in rows if j != i)
        want += [(i, j, n + 1) for n, (_, j) in enumerate(near[:3])]
    assert _col(got, "id", "other", "nth") == sorted(want)

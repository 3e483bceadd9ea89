"""Queries of spatial joins, with their SQL on boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctata import roles
from punctata.functions.ranks import quantiles
from punctata.functions.session import cut
from punctata.operators import predicates as P
from punctata.operators import spatial as S
from punctata.roles import sql, table


def boxes(spark, d, which="cells"):
    return S.with_outline(getattr(roles, which)(spark, d), roles.ring())


def tissue_points(spark, d, *columns):
    return roles.numbered_transcripts(spark, d, *columns).where("x > 10 AND x < 490 AND y > 10 AND y < 490 AND feature_type <> 'PROMO'")


def j01(spark, d):
    return S.counts_in_shapes(roles.transcripts(spark, d), boxes(spark, d), ["instance_id"], ["gene"])


def j02(spark, d):
    rows = S.count_covering(roles.numbered_transcripts(spark, d).select("transcript_id", "x", "y"), boxes(spark, d, "nuclei"), "transcript_id", "n_nuclei")
    return rows.groupBy("n_nuclei").agg(F.count("*").alias("n"), F.sum("x").alias("sum_x"))


def j03(spark, d):
    rows = S.nearest_outlines(roles.numbered_transcripts(spark, d, "x", "y"), boxes(spark, d, "nuclei"), "transcript_id", "instance_id")
    return rows.select("transcript_id", F.round("distance", 6).alias("distance"))


def j04(spark, d):
    points = tissue_points(spark, d, "x", "y", "feature_type").select("transcript_id", "x", "y")
    rows = S.compartments(points, boxes(spark, d), boxes(spark, d, "nuclei"), "transcript_id", "instance_id", "instance_id")
    return rows.select("transcript_id", "compartment", "n_cells", "n_nuclei", F.round("cell_distance", 6).alias("cell_distance"), F.round("nucleus_distance", 6).alias("nucleus_distance"))


def _centres(spark, d):
    return roles.cells(spark, d).select("instance_id", F.when(F.col("instance_id") % 50 > 0, F.col("cx")).alias("x"), F.col("cy").alias("y"))


def j05(spark, d):
    rows = S.assign_objects(_centres(spark, d), boxes(spark, d, "objects"), "instance_id", "object_id")
    return rows.select("instance_id", "object_id", F.round("distance", 6).alias("distance"), "inside", "missing_coordinate")


def j05_bands(spark, d):
    """The proximity bands of cells around objects."""
    rows = S.assign_objects(_centres(spark, d), boxes(spark, d, "objects"), "instance_id", "object_id")
    return rows.where("NOT missing_coordinate").select(P.proximity(F.col("distance"), F.col("inside"), (5, 20, 60)).alias("band")).groupBy("band").agg(F.count("*").alias("n"))


def j06(spark, d):
    shapes = boxes(spark, d).withColumn("mask", F.col("instance_id") % 5)
    points = roles.numbered_transcripts(spark, d).select("transcript_id", "x", "y", (F.col("assignment") % 5).alias("prior"))
    return S.overlap_assignment(points, shapes, "transcript_id", "mask", "prior").groupBy("source", "n_masks", "assigned").agg(F.count("*").alias("n"))


def j07(spark, d):
    window = F.expr("cx - half <= 250 AND cx + half >= 100.5 AND cy - half <= 90 AND cy + half >= 20")
    return roles.cells(spark, d).where(window).select("instance_id", "cx", "cy")


def j08(spark, d):
    inverse = P.inverse([[4.0, 0.0, 3.0], [0.0, 0.5, -1.0]])
    col, row = P.affine(F.col("x"), F.col("y"), inverse)
    at = roles.numbered_transcripts(spark, d).select("transcript_id", F.rint(row).cast("long").alias("row"), F.rint(col).cast("long").alias("col"))
    hit = at.join(roles.mask(spark, d), ["row", "col"], "left").select("transcript_id", F.coalesce("label", F.lit(0)).cast("long").alias("label"))
    return hit.groupBy("label").agg(F.count("*").alias("n"), F.sum("transcript_id").alias("ids"))


_RANK = "CASE object_type WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'ASIA' THEN 2 ELSE 3 END"
_LABEL = "CASE object_type WHEN 'AFRICA' THEN 'white_matter' WHEN 'AMERICA' THEN 'grey_matter' WHEN 'ASIA' THEN 'grey_matter' ELSE 'excluded' END"


def j09(spark, d):
    regions = boxes(spark, d, "objects").withColumns({"rank": F.expr(_RANK), "label": F.expr(_LABEL)})
    points = roles.cells(spark, d).select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    return S.priority_labels(points, regions, "instance_id").select("instance_id", "tissue")


_SAMPLES = "s_nationkey AS line, s_suppkey AS k, CAST(s_nationkey * 19 % 500 AS DOUBLE) + s_suppkey % 7 AS tx, CAST(s_suppkey * 13 % 500 AS DOUBLE) AS ty, 50e0 + s_nationkey AS thickness"


_PIA = "n_regionkey AS curve, n_nationkey AS k, CAST(n_nationkey * 20 AS DOUBLE) AS x, CAST(n_nationkey * 37 % 50 AS DOUBLE) + 100e0 * n_regionkey AS y"


def samples(spark, d):
    """Samples of streamlines in order, their lines' thickness, and whether a line reached the other side."""
    rows = table(spark, d, "supplier").selectExpr(*roles._select(_SAMPLES))
    return rows.withColumnsRenamed({"tx": "x", "ty": "y"}).withColumn("reached", F.expr("line % 5 > 0"))


def j10(spark, d):
    from punctata.operators.paths import streamline_depth

    points = roles.cells(spark, d).select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    pia = table(spark, d, "nation").selectExpr(*roles._select(_PIA))
    rows = streamline_depth(points, samples(spark, d), pia, "instance_id")
    return rows.select("instance_id", "column_id", *(F.round(c, 6).alias(c) for c in ("pia_distance", "wm_distance", "tangential")))


def j11(spark, d):
    from punctata.operators.rasters import bilinear

    points = roles.cells(spark, d).select("instance_id", F.expr("cx % 70 + 0.25e0").alias("x"), F.expr("cy + 0.5e0").alias("y"))
    field = roles.pixels(spark, d).select("row", "col", F.round(F.col("value") * 1024).alias("value"))
    return bilinear(points, field, "instance_id").select("instance_id", "value")


def j11_sides(spark, d):
    from punctata.operators.rasters import side_distances

    points = roles.cells(spark, d).select("instance_id", F.expr("cx % 70 + 0.25e0").alias("x"), F.expr("cy + 0.5e0").alias("y"))
    field = roles.pixels(spark, d)
    size = field.agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w")).first()
    rows = side_distances(points, roles.mask(spark, d).where("label = 0"), "instance_id", size.h, size.w, resolution=0.5)
    return rows.select("instance_id", F.round("side_distance", 6).alias("side_distance"))


def j12(spark, d):
    from punctata.operators.ids import first_of

    pieces = boxes(spark, d, "objects").withColumn("piece_no", F.regexp_extract("object_id", "([0-9]+)$", 1).cast("long")).withColumn("half_white", F.col("object_type") != "ASIA")
    points = roles.cells(spark, d).select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    hit = first_of(S.in_shapes(points, pieces, edges=True), ["instance_id"], ["piece_no"])
    return points.join(hit.select("instance_id", "piece_no", "half_white"), "instance_id", "left").select("instance_id", F.when(F.col("half_white"), F.col("piece_no")).alias("piece_no"), F.coalesce(~F.col("half_white"), F.lit(False)).alias("flag_only"))


def j23(spark, d):
    cells = roles.cells(spark, d).select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    near = S.nearest_points(cells, cells.select(F.col("instance_id").alias("other"), F.col("x").alias("tx"), F.col("y").alias("ty")), "instance_id", "other", 6, skip_same=True)
    return near.select("instance_id", "other", F.round("distance", 6).alias("distance"), F.col("nth").cast("long").alias("nth"))


def j26(spark, d):
    return S.annular_counts(roles.transcripts(spark, d), None, [0.0, 1.0, 2.0, 4.0], ["gene"]).withColumn("band", F.col("band").cast("long"))


def _two_sets(spark, d):
    a = roles.cells(spark, d).select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    b = table(spark, d, "customer").selectExpr("c_custkey AS other", "CAST(c_custkey * 29 % 500 AS DOUBLE) AS tx", "CAST(c_custkey * 53 % 500 AS DOUBLE) + 0.5e0 AS ty")
    return a, b


def j27(spark, d):
    a, b = _two_sets(spark, d)
    there = S.nearest_points(a, b, "instance_id", "other")
    back = S.nearest_points(b.select("other", F.col("tx").alias("x"), F.col("ty").alias("y")), a.select("instance_id", F.col("x").alias("tx"), F.col("y").alias("ty")), "other", "instance_id")
    both = there.select(F.lit("there").alias("way"), "distance").union(back.select(F.lit("back"), "distance"))
    both = cut(both)
    per = both.groupBy("way").agg(F.avg("distance").alias("mean")).join(quantiles(both, "distance", [0.5, 0.9, 0.99], ["way"], name="p"), "way")
    return per.select("way", F.round("mean", 6).alias("mean"), *(F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p50", "p90", "p99"))))


def j29(spark, d):
    """Squares around candidate centres with the most small items, then the largest share, then the fewest items."""
    cells = roles.cells(spark, d).withColumn("small", F.col("half") < 3)
    centres = roles.objects(spark, d).select("object_id", F.col("cx").alias("ox"), F.col("cy").alias("oy"), (F.col("cx") - 25).alias("x0"), (F.col("cx") + 25).alias("x1"), (F.col("cy") - 25).alias("y0"), (F.col("cy") + 25).alias("y1"))
    p = cells.withColumns({"_tx": S.tile("cx", 25.0), "_ty": S.tile("cy", 25.0)})
    near = p.join(S.tiled(centres, 25.0), ["_tx", "_ty"]).where((F.abs(F.col("cx") - F.col("ox")) <= 25) & (F.abs(F.col("cy") - F.col("oy")) <= 25))
    per = near.groupBy("object_id").agg(F.count("*").alias("n_all"), F.count_if("small").alias("n_small"))
    return per.orderBy(F.desc("n_small"), F.desc(F.col("n_small") / F.col("n_all")), "n_all", "object_id").limit(3)


def j30(spark, d):
    points = P.transform_points(roles.transcripts(spark, d).select("platform", "x", "y"), [[1.0, 0.0, 16.0], [0.0, 1.0, -8.0]])
    box = points.where("x BETWEEN 100 AND 180 AND y BETWEEN 50 AND 130")
    centre = box.groupBy("platform").agg(F.median("raw_x").alias("centre_x"), F.median("raw_y").alias("centre_y"))
    ends = points.groupBy("platform").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    shared = ends.agg(F.max("a").alias("low"), F.min("b").alias("high"))
    return centre.crossJoin(F.broadcast(shared)).select("platform", "centre_x", "centre_y", F.greatest("low", F.least(F.col("centre_x") - 20, F.col("high") - 40)).alias("clamped_x"))


def t06(spark, d):
    """The densest of evenly sampled points: most sampled points within 20."""
    cells = roles.cells(spark, d).where("instance_id % 4 = 0").select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    return S.points_within(cells, "instance_id", 20.0).select("instance_id", "n").orderBy(F.desc("n"), "instance_id").limit(1)


QUERIES = {
    "j01_points_in_shapes": j01, "j02_covering_count": j02, "j03_nearest_boundary": j03, "j04_compartments": j04, "j05_object_distance": j05, "j05_object_bands": j05_bands, "j06_overlap_assignment": j06,
    "j07_window_shapes": j07, "j08_raster_lookup": j08, "j09_priority_labels": j09, "j10_streamline_depth": j10, "j11_bilinear": j11, "j11_side_distance": j11_sides, "j12_first_piece": j12, "j23_spatial_knn": j23,
    "j26_annular_pairs": j26, "j27_two_way_nearest": j27, "j29_window_scan": j29, "j30_crop_centres": j30, "t06_densest_window": t06,
}

_OUT = "hypot(greatest(abs(x - cx) - half, 0e0), greatest(abs(y - cy) - half, 0e0))"
_HYPOT = "sqrt(pow(greatest(abs(x - cx) - half, 0e0), 2) + pow(greatest(abs(y - cy) - half, 0e0), 2))"
_EDGE = f"CASE WHEN abs(x - cx) <= half AND abs(y - cy) <= half THEN least(half - abs(x - cx), half - abs(y - cy)) ELSE {_HYPOT} END"
_COVER = "x BETWEEN cx - half AND cx + half AND y BETWEEN cy - half AND cy + half"
_STRICT = "x > cx - half AND x < cx + half AND y > cy - half AND y < cy + half"
_KNN_A = "a AS (SELECT instance_id, cx AS x, cy AS y FROM cells), b AS (SELECT c_custkey AS other, CAST(c_custkey * 29 % 500 AS DOUBLE) AS tx, CAST(c_custkey * 53 % 500 AS DOUBLE) + 0.5e0 AS ty FROM customer)"
_CENTRES = "p AS (SELECT instance_id AS id, CASE WHEN instance_id % 50 > 0 THEN cx END AS x, cy AS y FROM cells)"
_OBJECT = f"""{_CENTRES}, c AS (SELECT id, object_id, {_COVER} AS inside, {_EDGE} AS d FROM p, objects WHERE x IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY NOT inside, d, object_id) AS k FROM c)"""

ORACLES = {
    "j01_points_in_shapes": sql("transcripts cells", f"SELECT instance_id, gene, count(*) AS n FROM transcripts JOIN cells ON {_STRICT} GROUP BY ALL"),
    "j02_covering_count": sql("numbered nuclei", f"m AS (SELECT transcript_id, any_value(x) AS x, count(instance_id) AS k FROM numbered LEFT JOIN nuclei ON {_COVER} GROUP BY 1) SELECT least(k, 255) AS n_nuclei, count(*) AS n, sum(x) AS sum_x FROM m GROUP BY 1"),
    "j03_nearest_boundary": sql("numbered nuclei", f"SELECT transcript_id, round(min({_EDGE}), 6) AS distance FROM numbered, nuclei GROUP BY 1"),
    "j04_compartments": sql("numbered cells nuclei", f"""p AS (SELECT transcript_id, x, y FROM numbered WHERE x > 10 AND x < 490 AND y > 10 AND y < 490 AND feature_type <> 'PROMO'),
        c AS (SELECT transcript_id, count(*) FILTER ({_COVER}) AS n, min({_EDGE}) AS d FROM p, cells GROUP BY 1), u AS (SELECT transcript_id, count(*) FILTER ({_COVER}) AS n, min({_EDGE}) AS d FROM p, nuclei GROUP BY 1)
        SELECT transcript_id, CASE WHEN u.n > 0 THEN 'nuclear' WHEN c.n > 0 THEN 'cytoplasmic' ELSE 'extracellular' END AS compartment, c.n AS n_cells, u.n AS n_nuclei,
        round(CASE WHEN c.n > 0 THEN c.d ELSE -c.d END, 6) AS cell_distance, round(CASE WHEN u.n > 0 THEN u.d ELSE -u.d END, 6) AS nucleus_distance FROM c JOIN u USING (transcript_id)"""),
    "j05_object_distance": sql("cells objects", f"{_OBJECT} SELECT p.id AS instance_id, object_id, round(CASE WHEN inside THEN -d ELSE d END, 6) AS distance, coalesce(inside, false) AS inside, p.x IS NULL AS missing_coordinate FROM p LEFT JOIN (SELECT * FROM r WHERE k = 1) q USING (id)"),
    "j05_object_bands": sql("cells objects", f"{_OBJECT} SELECT CASE WHEN inside OR d < 5 THEN 'near' WHEN d < 20 THEN 'middle' WHEN d <= 60 THEN 'far' ELSE 'beyond_max' END AS band, count(*) AS n FROM r WHERE k = 1 GROUP BY 1"),
    "j06_overlap_assignment": sql("numbered cells", f"""m AS (SELECT transcript_id, any_value(assignment % 5) AS prior, count(DISTINCT instance_id % 5) AS n_masks, list(DISTINCT instance_id % 5) AS masks FROM numbered LEFT JOIN cells ON {_COVER} GROUP BY 1)
        SELECT CASE WHEN n_masks = 0 THEN 'outside' WHEN n_masks = 1 THEN 'single_mask' WHEN coalesce(list_contains(masks, prior), false) THEN 'proseg_overlap' ELSE 'ambiguous_overlap' END AS source, n_masks,
        CASE WHEN n_masks = 1 THEN masks[1] WHEN n_masks > 1 AND list_contains(masks, prior) THEN prior END AS assigned, count(*) AS n FROM m GROUP BY ALL"""),
    "j07_window_shapes": sql("cells", "SELECT instance_id, cx, cy FROM cells WHERE cx - half <= 250 AND cx + half >= 100.5 AND cy - half <= 90 AND cy + half >= 20"),
    "j08_raster_lookup": sql("numbered mask", """a AS (SELECT transcript_id, CAST(round_even((y + 1e0) * 2e0, 0) AS BIGINT) AS row, CAST(round_even((x - 3e0) / 4e0, 0) AS BIGINT) AS col FROM numbered)
        SELECT coalesce(label, 0) AS label, count(*) AS n, CAST(sum(transcript_id) AS BIGINT) AS ids FROM a LEFT JOIN mask USING (row, col) GROUP BY 1"""),
    "j09_priority_labels": sql("cells objects", f"""o AS (SELECT cx AS ox, cy AS oy, half AS h, {_RANK} AS rank, {_LABEL} AS label FROM objects)
        SELECT instance_id, coalesce(max_by(label, rank), 'outside_brain') AS tissue FROM cells LEFT JOIN o ON cx > ox - h AND cx < ox + h AND cy > oy - h AND cy < oy + h GROUP BY 1"""),
    "j10_streamline_depth": sql("cells", f"""s0 AS (SELECT {_SAMPLES} FROM supplier), ok AS (SELECT line FROM s0 WHERE line % 5 > 0 GROUP BY 1 HAVING count(*) > 1), s AS (SELECT * FROM s0 WHERE line IN (SELECT line FROM ok) OR (SELECT count(*) FROM ok) = 0),
        g AS (SELECT *, coalesce(sqrt(pow(tx - lag(tx) OVER w, 2) + pow(ty - lag(ty) OVER w, 2)), 0e0) AS step FROM s WINDOW w AS (PARTITION BY line ORDER BY k)),
        l AS (SELECT *, sum(step) OVER (PARTITION BY line ORDER BY k ROWS UNBOUNDED PRECEDING) AS len FROM g), t AS (SELECT *, CASE WHEN max(len) OVER (PARTITION BY line) > 0 THEN len * thickness / max(len) OVER (PARTITION BY line) ELSE 0e0 END AS pia FROM l),
        c AS (SELECT {_PIA} FROM nation), e AS (SELECT *, lead(x) OVER w AS bx, lead(y) OVER w AS by_, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS step FROM c WINDOW w AS (PARTITION BY curve ORDER BY k)),
        z AS (SELECT *, sum(step) OVER (PARTITION BY curve ORDER BY k ROWS UNBOUNDED PRECEDING) AS len FROM e), o AS (SELECT line, min_by(tx, k) AS px, min_by(ty, k) AS py FROM s GROUP BY 1),
        u AS (SELECT *, greatest(0e0, least(1e0, ((px - x) * (bx - x) + (py - y) * (by_ - y)) / ((bx - x) * (bx - x) + (by_ - y) * (by_ - y)))) AS f FROM o, z WHERE bx IS NOT NULL),
        v AS (SELECT line, len + f * sqrt(pow(bx - x, 2) + pow(by_ - y, 2)) AS tangential, row_number() OVER (PARTITION BY line ORDER BY sqrt(pow(px - x - f * (bx - x), 2) + pow(py - y - f * (by_ - y), 2)), curve, k) AS nth FROM u),
        r AS (SELECT instance_id, line, pia, thickness, row_number() OVER (PARTITION BY instance_id ORDER BY (cx - tx) * (cx - tx) + (cy - ty) * (cy - ty), k) AS nth FROM cells, t)
        SELECT instance_id, r.line AS column_id, round(pia, 6) AS pia_distance, round(greatest(thickness - pia, 0e0), 6) AS wm_distance, round(tangential, 6) AS tangential FROM r JOIN v ON r.line = v.line AND v.nth = 1 WHERE r.nth = 1"""),
    "j11_side_distance": sql("cells mask", """e AS (SELECT max(row) + 1 AS h, max(col) + 1 AS w FROM pixels), b AS (SELECT DISTINCT row, col FROM mask WHERE label = 0),
        p AS (SELECT instance_id, CAST(floor(cx % 70 + 0.25e0) AS BIGINT) AS col, CAST(floor(cy + 0.5e0) AS BIGINT) AS row FROM cells), i AS (SELECT p.* FROM p, e WHERE row BETWEEN 0 AND h - 1 AND col BETWEEN 0 AND w - 1),
        n AS (SELECT instance_id, min((i.row - b.row) * (i.row - b.row) + (i.col - b.col) * (i.col - b.col)) AS d2 FROM i, b GROUP BY 1) SELECT instance_id, round(sqrt(d2) * 0.5e0, 6) AS side_distance FROM p LEFT JOIN n USING (instance_id)"""),
    "j11_bilinear": sql("cells pixels", """p AS (SELECT instance_id, cx % 70 + 0.25e0 AS x, cy + 0.5e0 AS y FROM cells), v AS (SELECT row, col, round(value * 1024) AS v FROM pixels),
        q AS (SELECT instance_id, CAST(floor(y) AS BIGINT) + i AS row, CAST(floor(x) AS BIGINT) + j AS col, (CASE i WHEN 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END) * (CASE j WHEN 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END) AS w FROM p, range(2) a(i), range(2) b(j))
        SELECT instance_id, CASE WHEN count(v) = 4 THEN sum(v * w) END AS value FROM q LEFT JOIN v USING (row, col) GROUP BY 1"""),
    "j12_first_piece": sql("cells objects", """o AS (SELECT CAST(regexp_extract(object_id, '([0-9]+)$', 1) AS BIGINT) AS piece_no, object_type <> 'ASIA' AS w, cx AS ox, cy AS oy, half AS h FROM objects),
        r AS (SELECT instance_id, min_by(w, piece_no) AS w, min(piece_no) AS piece_no FROM cells LEFT JOIN o ON abs(cx - ox) <= h AND abs(cy - oy) <= h GROUP BY 1) SELECT instance_id, CASE WHEN w THEN piece_no END AS piece_no, coalesce(NOT w, false) AS flag_only FROM r"""),
    "j23_spatial_knn": sql("cells", """r AS (SELECT a.instance_id, b.instance_id AS other, sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy)) AS d, row_number() OVER (PARTITION BY a.instance_id ORDER BY (a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy), b.instance_id) AS nth
        FROM cells a JOIN cells b ON a.instance_id <> b.instance_id) SELECT instance_id, other, round(d, 6) AS distance, nth FROM r WHERE nth <= 6"""),
    "j26_annular_pairs": sql("numbered", """p AS (SELECT transcript_id AS id, gene, x, y FROM numbered), q AS (SELECT a.gene, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM p a JOIN p b ON a.gene = b.gene AND a.id < b.id AND abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4)
        SELECT gene, CASE WHEN d <= 1 THEN 0 WHEN d <= 2 THEN 1 ELSE 2 END AS band, count(*) AS n FROM q WHERE d <= 4 GROUP BY ALL"""),
    "j27_two_way_nearest": sql("cells", f"""{_KNN_A}, m AS (SELECT instance_id, other, sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)) AS d FROM a, b), e AS (SELECT 'there' AS way, min(d) AS d FROM m GROUP BY instance_id UNION ALL SELECT 'back', min(d) FROM m GROUP BY other)
        SELECT way, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.9), 6) AS p90, round(quantile_cont(d, 0.99), 6) AS p99 FROM e GROUP BY way"""),
    "j29_window_scan": sql("cells objects", """o AS (SELECT object_id, cx AS ox, cy AS oy FROM objects), r AS (SELECT object_id, count(*) AS n_all, count(*) FILTER (half < 3) AS n_small FROM cells JOIN o ON abs(cx - ox) <= 25 AND abs(cy - oy) <= 25 GROUP BY 1)
        SELECT * FROM r ORDER BY n_small DESC, n_small / n_all DESC, n_all, object_id LIMIT 3"""),
    "j30_crop_centres": sql("transcripts", """p AS (SELECT platform, x AS rx, y AS ry, x + 16 AS x, y - 8 AS y FROM transcripts), c AS (SELECT platform, median(rx) AS centre_x, median(ry) AS centre_y FROM p WHERE x BETWEEN 100 AND 180 AND y BETWEEN 50 AND 130 GROUP BY 1),
        e AS (SELECT max(a) AS low, min(b) AS high FROM (SELECT min(x) AS a, max(x) AS b FROM p GROUP BY platform)) SELECT platform, centre_x, centre_y, greatest(low, least(centre_x - 20, high - 40)) AS clamped_x FROM c, e"""),
    "t06_densest_window": sql("cells", """s AS (SELECT * FROM cells WHERE instance_id % 4 = 0) SELECT a.instance_id, count(*) AS n FROM s a JOIN s b ON (a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy) <= 400 GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1"""),
}

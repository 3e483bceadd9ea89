"""Queries of readers and writers: files are made from the given tables in the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from punctata import roles
from punctata.functions.session import dealt, ensure_checkpoint_dir
from punctata.operators.predicates import broad_class
from punctata.roles import sql, table
from punctata.sources import readers as R
from punctata.sources import writers as W


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


_RAW = "p_brand AS feature_name, CASE WHEN l_linenumber = 3 THEN 'bad' ELSE CAST(l_quantity AS {s}) END AS x, CAST(l_linenumber AS {s}) AS y, CASE WHEN l_linenumber = 5 THEN NULL ELSE '0.5' END AS z, CAST(l_orderkey AS {s}) AS cell_id, CAST(l_suppkey AS {s}) AS qv"


def s01(spark, d):
    path = _folder(spark, "transcripts")
    raw = table(spark, d, "lineitem").join(table(spark, d, "part"), F.expr("l_partkey = p_partkey")).selectExpr(*roles._select(_RAW.format(s="STRING")))
    raw.select("x", "y", "z", "feature_name", "cell_id", "qv").write.option("header", True).csv(path)
    return R.read_transcripts(spark, path, "csv").groupBy("gene").agg(F.count("*").alias("n"), F.sum("x").alias("sum_x"), F.sum("z").alias("sum_z"), F.max("cell_id").alias("last_cell"))


def s02(spark, d):
    rows = roles.cells(spark, d).select(F.col("instance_id").alias("EntityID"), (F.col("instance_id") % 3).alias("ZIndex"), F.when(F.col("instance_id") % 5 > 0, roles.ring()).otherwise(F.slice(roles.ring(), 1, 2)).alias("ring"))
    return R.boundaries(rows).select("instance_id", F.size("rings").cast("long").alias("n_rings"))


_WIDE = ("Brand#1", "Brand#2", "Brand#3", "Blank-1")


def _wide(spark, d):
    t = roles.transcripts(spark, d)
    cols = [F.count_if(F.col("gene") == g).alias(g) for g in _WIDE[:3]] + [F.count_if(F.col("feature_type") == "PROMO").alias("Blank-1")]
    return t.groupBy(F.col("cell_id").cast("string").alias("cell")).agg(*cols)


def s03(spark, d):
    path = _folder(spark, "wide")
    _wide(spark, d).write.option("header", True).csv(path)
    counts, controls = R.read_wide_counts(spark, path)
    both = counts.withColumn("control", F.lit(False)).unionByName(controls.withColumn("control", F.lit(True)))
    meta = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("cell"), F.col("o_custkey").alias("center_x"))
    return both.join(meta, "cell").groupBy("control", "gene").agg(F.count("*").alias("n_cells"), F.sum("n").alias("total"), F.sum("center_x").alias("center"))


def s04(spark, d):
    """Orders by nation as a matrix in the triplet format, gzipped, features repeated by name."""
    path = _folder(spark, "triplets")
    features = table(spark, d, "nation").select("n_nationkey", F.concat_ws("\t", F.concat(F.lit("id"), F.col("n_nationkey").cast("string")), F.concat(F.lit("g"), (F.col("n_nationkey") % 10).cast("string")), F.lit("Gene Expression")).alias("value"))
    barcodes = table(spark, d, "region").select("r_regionkey", F.col("r_name").alias("value"))
    one = lambda rows, order, name: rows.orderBy(order).select("value").coalesce(1).write.option("compression", "gzip").text(f"{path}/{name}")
    one(features, "n_nationkey", "features")
    one(barcodes, "r_regionkey", "barcodes")
    rows = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("i"), F.expr("c_custkey % 5").alias("j")).agg(F.count("*").alias("n"))
    body = rows.select(F.lit(1).alias("k"), F.concat_ws(" ", F.col("i") + 1, F.col("j") + 1, "n").alias("value"))
    size = rows.agg(F.lit(0).alias("k"), F.concat_ws(" ", F.lit(25), F.lit(5), F.count("*")).alias("value"))
    note = spark.range(1).select(F.lit(-1).alias("k"), F.lit("%%MatrixMarket matrix coordinate integer general").alias("value"))
    one(note.unionByName(size).unionByName(body), "k", "matrix")
    return R.read_triplets(spark, f"{path}/matrix", f"{path}/features", f"{path}/barcodes")


_VERTEX = "l_orderkey AS label_id, l_linenumber * 1000000 + l_partkey AS vertex_no, CAST(l_suppkey AS {d}) AS x, CAST(l_partkey AS {d}) AS y, CAST(l_suppkey AS {s}) AS cell_id"


def s05(spark, d):
    rows = dealt(table(spark, d, "lineitem").selectExpr(*roles._select(_VERTEX.format(d="DOUBLE", s="STRING"))), "label_id")
    rings = R.vertices_to_rings(rows.groupBy("label_id", "vertex_no").agg(F.min("x").alias("x"), F.min("y").alias("y"), F.min("cell_id").alias("cell_id")))
    return rings.select("label_id", F.size("ring").cast("long").alias("n"), F.element_at("ring", -1)["y"].alias("last_y"), F.aggregate("ring", F.lit(0.0), lambda a, v: a + v.y).alias("sum_y"))


def _geojson(spark, d):
    """One document a nation: collections, features and bare geometries by turns."""
    o = roles.objects(spark, d).withColumn("k", F.regexp_extract("object_id", "([0-9]+)$", 1).cast("int"))
    ring = F.concat(F.lit("["), F.concat_ws(",", F.transform(roles.ring(), lambda v: F.concat(F.lit("["), v.x.cast("string"), F.lit(","), v.y.cast("string"), F.lit("]")))), F.lit("]"))
    polygon = F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit("]}"))
    multi = F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring, F.lit("],["), ring, F.lit("]]}"))
    props = F.when(F.col("k") % 3 == 0, F.concat(F.lit('{"object_id":"'), F.col("object_id"), F.lit('","object_type":"'), F.col("object_type"), F.lit('","role":"Pial-Boundary","piece_id":"p'), F.col("k"), F.lit('"}'))).otherwise(F.concat(F.lit('{"classification":{"name":"'), F.col("object_type"), F.lit('"},"type":"White/Matter"}')))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.when(F.col("k") % 6 == 0, multi).otherwise(polygon), F.lit("}"))
    value = F.when(F.col("k") % 5 == 4, polygon).when(F.col("k") % 2 == 0, F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit("]}"))).otherwise(feature)
    return R.geojson_features(o.select(F.col("k").alias("doc"), value.alias("value")))


def s06(spark, d):
    return R.object_annotations(_geojson(spark, d)).select("object_id", "object_type", "area")


def s07(spark, d):
    f = _geojson(spark, d)
    return R.role_features(f, "pia").unionByName(R.role_features(f, "wm")).select("doc", "role", "piece_id")


def s08(spark, d):
    path = _folder(spark, "mapper")
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("cell_id"), F.col("c_mktsegment").alias("label"))
    W.write_commented_csv(rows, path, ["made from customer"])
    return R.read_commented_csv(spark, path, ["cell_id", "label"])


_LEVELS = """concat('{{"CLUS":{{"assignment":"', event_type, '","bootstrapping_probability":0.', CAST(1 + event_id % 9 AS {s}), ',"runner_up_probability":[0.', CAST(1 + event_id % 4 AS {s}), ',0.1]}},"SUPC":{{"assignment":"x","avg_correlation":0.5,"directly_assigned":true}}}}')"""


def s09(spark, d):
    cells = table(spark, d, "events").select(F.col("event_id").alias("cell_id"), F.when(F.col("event_id") % 10 == 0, "{broken").otherwise(F.expr(_LEVELS.format(s="STRING"))).alias("levels"))
    return R.mapper_rows(cells).groupBy("level", "assignment").agg(F.count("*").alias("n"), F.round(F.sum("margin"), 4).alias("margin"), F.count_if("directly_assigned").alias("direct"))


def s09_props(spark, d):
    rows = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    return rows.select(F.explode("m").alias("key", "value")).groupBy("key").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def s10(spark, d):
    lists = table(spark, d, "part").groupBy(F.expr("p_size % 2").alias("lv"), "p_type").agg(F.array_sort(F.collect_set(F.concat(F.lit(" "), F.col("p_brand")))).alias("m"))
    text = lists.select(F.to_json(F.map_from_arrays(F.array(F.concat_ws("/", F.concat(F.lit("level"), F.col("lv").cast("string")), "p_type")), F.array(F.array_append("m", F.lit(" "))))).alias("value"))
    terms = table(spark, d, "part").select(F.col("p_type").alias("label")).distinct().withColumn("name", F.when(F.col("label") == "PROMO", "Astrocyte").otherwise(F.col("label")))
    rows = R.marker_lookup(text, terms, "level1", broad_class(F.col("name")))
    return rows.select("label", "broad_class", F.size("markers").cast("long").alias("n"), F.array_join("markers", ";").alias("markers"))


def s12(spark, d):
    path = _folder(spark, "metrics")
    rows = roles.transcripts(spark, d).join(roles.cell_class(spark, d), "cell_id").groupBy("pair_id", "platform", F.col("feature_type").alias("segmentation")).agg(F.count("*").alias("n"))
    W.write_metrics(rows, path)
    return spark.read.parquet(path).select("pair_id", "platform", "segmentation", "n")


def s14(spark, d):
    path = _folder(spark, "geojson")
    W.write_geojson(roles.objects(spark, d).withColumn("ring", roles.ring()), path)
    back = R.geojson_features(spark.read.text(path).withColumn("doc", F.monotonically_increasing_id()))
    return R.object_annotations(back).select("object_id", "object_type", "area")


def s15(spark, d):
    path = _folder(spark, "pairs")
    rows = roles.transcripts(spark, d).join(roles.cell_class(spark, d), "cell_id").groupBy("pair_id", "gene").agg(F.count("*").alias("n"))
    rows.withColumn("pair", F.regexp_replace("pair_id", " ", "_")).drop("pair_id").write.partitionBy("pair").parquet(path)
    return R.tagged(spark, f"{path}/pair=*/*.parquet", "pair=([^/]+)/", ["pair_tag"]).groupBy("pair_tag").agg(F.count("*").alias("n_genes"), F.sum("n").alias("total"))


def s16(spark, d):
    text = table(spark, d, "supplier").select(F.concat(F.lit('{"trial":"t'), F.col("s_suppkey").cast("string"), F.lit('","rigid":{"score":'), F.col("s_nationkey").cast("string"), F.lit("},"), F.lit('"nonrigid":{"score":1,"assd":'), F.col("s_suppkey").cast("string"), F.lit("}}")).alias("value"))
    return R.harvest_metrics(text)


QUERIES = {
    "s01_transcript_scan": s01, "s02_boundary_scan": s02, "s03_wide_counts": s03, "s04_triplet_matrix": s04, "s05_vertex_rings": s05, "s06_object_scan": s06, "s07_role_scan": s07, "s08_commented_csv": s08, "s09_mapper_json": s09,
    "s09_nested_props": s09_props, "s10_marker_lookup": s10, "s12_metric_sink": s12, "s14_geojson_sink": s14, "s15_tagged_outputs": s15, "s16_metrics_harvest": s16,
}

ORACLES = {
    "s01_transcript_scan": f"SELECT feature_name AS gene, count(*) AS n, sum(CAST(x AS DOUBLE)) AS sum_x, sum(CAST(z AS DOUBLE)) AS sum_z, max(cell_id) AS last_cell FROM (SELECT {_RAW.format(s='VARCHAR')} FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE x <> 'bad' AND z IS NOT NULL GROUP BY 1",
    "s02_boundary_scan": sql("cells", "SELECT instance_id, 1 AS n_rings FROM cells WHERE instance_id % 3 = 0 AND instance_id % 5 > 0"),
    "s03_wide_counts": sql("transcripts", """w AS (SELECT cell_id, 'Blank-1' AS gene, count(*) AS n FROM transcripts WHERE feature_type = 'PROMO' GROUP BY 1 UNION ALL SELECT cell_id, gene, count(*) FROM transcripts WHERE gene IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY ALL)
        SELECT gene = 'Blank-1' AS control, gene, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS total, CAST(sum(o_custkey) AS BIGINT) AS center FROM w JOIN orders ON o_orderkey = cell_id GROUP BY ALL"""),
    "s04_triplet_matrix": """SELECT r_name AS cell_id, CASE WHEN c_nationkey < 10 THEN 'g' || CAST(c_nationkey AS VARCHAR) ELSE 'g' || CAST(c_nationkey % 10 AS VARCHAR) || '-' || CAST(c_nationkey // 10 AS VARCHAR) END AS gene, 'id' || CAST(c_nationkey AS VARCHAR) AS feature_id, 'Gene Expression' AS feature_type, count(*) AS n FROM customer JOIN region ON r_regionkey = c_custkey % 5 GROUP BY c_nationkey, r_name""",
    "s05_vertex_rings": f"""WITH v AS (SELECT label_id, vertex_no, min(x) AS x, min(y) AS y FROM (SELECT {_VERTEX.format(d='DOUBLE', s='VARCHAR')} FROM lineitem) GROUP BY ALL), g AS (SELECT label_id, count(*) AS n, arg_min(x, vertex_no) AS fx, arg_max(x, vertex_no) AS lx, arg_min(y, vertex_no) AS fy, arg_max(y, vertex_no) AS ly, sum(y) AS sy FROM v GROUP BY 1 HAVING count(*) >= 3)
        SELECT label_id, CASE WHEN fx = lx AND fy = ly THEN n ELSE n + 1 END AS n, fy AS last_y, CASE WHEN fx = lx AND fy = ly THEN sy ELSE sy + fy END AS sum_y FROM g""",
    "s06_object_scan": sql("objects", """o AS (SELECT CAST(substr(object_id, 5) AS INTEGER) AS k, object_id, object_type FROM objects), f AS (SELECT k, CASE WHEN k % 5 = 4 THEN 'objects' ELSE object_type END AS object_type, CASE WHEN k % 5 <> 4 AND k % 3 = 0 THEN object_id END AS given, CASE WHEN k % 5 <> 4 AND k % 6 = 0 THEN 2 ELSE 1 END AS parts FROM o),
        p AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM f), n AS (SELECT *, row_number() OVER (PARTITION BY object_type ORDER BY k, part) AS nth FROM p)
        SELECT CASE WHEN given IS NULL THEN lower(replace(object_type, ' ', '_')) || '_' || lpad(CAST(nth AS VARCHAR), 4, '0') WHEN parts > 1 THEN given || '_' || CAST(part AS VARCHAR) ELSE given END AS object_id, object_type, 400e0 AS area FROM n"""),
    "s07_role_scan": "SELECT n_nationkey AS doc, CASE WHEN n_nationkey % 3 = 0 THEN 'pia' ELSE 'wm' END AS role, CASE WHEN n_nationkey % 3 = 0 THEN 'p' || CAST(n_nationkey AS VARCHAR) ELSE 'piece_1' END AS piece_id FROM nation WHERE n_nationkey % 5 <> 4",
    "s08_commented_csv": "SELECT CAST(c_custkey AS VARCHAR) AS cell_id, c_mktsegment AS label FROM customer",
    "s09_mapper_json": """SELECT 'CLUS' AS level, event_type AS assignment, count(*) AS n, round(sum((1 + event_id % 9) / 10e0 - (1 + event_id % 4) / 10e0), 4) AS margin, 0 AS direct FROM events WHERE event_id % 10 > 0 GROUP BY 2 UNION ALL SELECT 'SUPC', 'x', count(*), NULL, count(*) FROM events WHERE event_id % 10 > 0""",
    "s09_nested_props": "SELECT 'k' AS key, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL",
    "s10_marker_lookup": "SELECT p_type AS label, CASE WHEN p_type = 'PROMO' THEN 'Astrocytes' ELSE p_type END AS broad_class, count(DISTINCT p_brand) AS n, string_agg(DISTINCT p_brand, ';' ORDER BY p_brand) AS markers FROM part WHERE p_size % 2 = 1 GROUP BY 1",
    "s12_metric_sink": sql("transcripts cell_class", "SELECT pair_id, platform, feature_type AS segmentation, count(*) AS n FROM transcripts JOIN cell_class USING (cell_id) GROUP BY ALL"),
    "s14_geojson_sink": sql("objects", "SELECT object_id, object_type, 400e0 AS area FROM objects"),
    "s15_tagged_outputs": sql("transcripts cell_class", "g AS (SELECT pair_id, gene, count(*) AS n FROM transcripts JOIN cell_class USING (cell_id) GROUP BY ALL) SELECT replace(pair_id, ' ', '_') AS pair_tag, count(*) AS n_genes, CAST(sum(n) AS BIGINT) AS total FROM g GROUP BY 1"),
    "s16_metrics_harvest": "SELECT 't' || CAST(s_suppkey AS VARCHAR) AS trial, mode, metric, CASE WHEN mode = 'rigid' THEN CAST(s_nationkey AS DOUBLE) WHEN metric = 'score' THEN 1e0 ELSE CAST(s_suppkey AS DOUBLE) END AS value FROM supplier, (VALUES ('rigid', 'score'), ('nonrigid', 'score'), ('nonrigid', 'assd')) v(mode, metric)",
}

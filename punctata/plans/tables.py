"""Queries of annotation joins, windows, orders, set operations and shapes, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from punctata import roles
from punctata.functions import names as N
from punctata.operators import counts as C
from punctata.operators import ids, paths, shapes
from punctata.operators import tables as J
from punctata.plans.aggregates import _both, _totals
from punctata.roles import sql, table

R = lambda c, n=6: F.round(c, n)


def j13(spark, d):
    metrics = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.expr("l_linenumber * 10000 + l_suppkey").alias("ord"), F.col("l_quantity").alias("area"))
    firsts = metrics.groupBy("cell_id").agg(F.min_by("area", F.struct("ord", "area")).alias("area"), F.min("ord").alias("ord"))
    return J.attach_metrics(table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id")), firsts, "cell_id", "ord", ["area"])


def j14(spark, d):
    t = roles.transcripts(spark, d)
    parts = [t.where(f"assignment IS NULL AND feature_type = '{k}'").select("gene") for k in ("PROMO", "LARGE", "SMALL")]
    shared = C.shared_genes(parts)
    return t.join(shared, "gene", "left_semi").groupBy("platform", "gene").agg(F.count("*").alias("n"))


def j14_two(spark, d):
    return _both(spark, d, False).select("gene", "total_merscope", "total_xenium")


def j15(spark, d):
    t = _totals(spark, d, True)
    m, x = (t.where(F.col("platform") == p).select("gene", F.col("total").alias(p.lower())) for p in ("MERSCOPE", "XENIUM"))
    zero = F.lit(0).cast("long")
    return m.where("gene <> 'Brand#9'").join(x, "gene", "full_outer").select("gene", F.coalesce("merscope", zero).alias("merscope"), F.coalesce("xenium", zero).alias("xenium"))


def j16(spark, d):
    cells = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), "o_custkey")
    notes = table(spark, d, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("cluster"), F.lit(1).alias("ord"))
    twice = notes.unionByName(notes.withColumns({"cluster": F.lit("later"), "ord": F.lit(2)}))
    return J.annotate(cells, twice, "o_custkey", "ord", ["cluster"], "mm_", N.UNKNOWN_LABEL).groupBy("mm_cluster").agg(F.count("*").alias("n"))


def j17(spark, d):
    mapping = table(spark, d, "orders").select(F.col("o_orderkey").alias("internal"), (F.col("o_orderkey") * 2 + 1).alias("instance_id"))
    rows = ids.translate(roles.transcripts(spark, d).select("gene", "assignment"), "assignment", mapping, "internal", "instance_id", [-1])
    return rows.groupBy("gene").agg(F.count("assignment").alias("n"), F.sum("assignment").alias("total"))


def j18(spark, d):
    from punctata.operators.predicates import broad_class

    cells = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("alias"))
    first = table(spark, d, "nation").select(F.col("n_nationkey").alias("alias"), F.col("n_regionkey").alias("term"), F.lit(1).alias("ord"))
    member = first.unionByName(first.withColumns({"term": (F.col("term") + 1) % 5, "ord": F.lit(2)}))
    terms = table(spark, d, "region").select(F.col("r_regionkey").alias("term"), F.expr("CASE r_name WHEN 'ASIA' THEN 'Astrocyte' WHEN 'EUROPE' THEN 'CGE interneuron' ELSE r_name END").alias("name"))
    return J.taxonomy_classes(cells, member, terms, broad_class(F.col("name"))).groupBy("broad_class").agg(F.count("*").alias("n"))


def j19(spark, d):
    a = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.expr("CASE s_suppkey % 3 WHEN 0 THEN 'Inhibitory' WHEN 1 THEN 'Excitatory' ELSE 'Other' END").alias("split"))
    return J.majority_split(a, b, "n_nationkey", "n_regionkey", "split")


_FEATURES = "SELECT p_brand AS feature, min(p_partkey) AS ord, 'ens' || p_brand AS id, p_brand AS name, CASE WHEN right(p_brand, 1) = '1' THEN 'None' ELSE 'sym' || right(p_brand, 2) END AS symbol FROM part GROUP BY p_brand"
_WANTED = "SELECT n_regionkey AS label, n_nationkey AS ord, CASE n_nationkey % 4 WHEN 0 THEN 'ENSBrand#' || CAST(n_nationkey + 1 AS {s}) WHEN 1 THEN ' brand#' || CAST(n_nationkey + 1 AS {s}) WHEN 2 THEN 'sym#' || CAST(n_nationkey % 10 AS {s}) ELSE 'old' || CAST(n_nationkey AS {s}) END AS marker FROM nation"
_ALIASES = "SELECT 'old' || CAST(n_nationkey AS {s}) AS token, 'brand#' || CAST(n_nationkey % 7 + 1 AS {s}) AS alias FROM nation"


def j20(spark, d):
    parts = {"features": table(spark, d, "part"), "wanted": table(spark, d, "nation")}
    features = parts["features"].groupBy(F.col("p_brand").alias("feature")).agg(F.min("p_partkey").alias("ord")).select("feature", "ord", F.expr("'ens' || feature AS id"), F.expr("feature AS name"), F.expr("CASE WHEN right(feature, 1) = '1' THEN 'None' ELSE 'sym' || right(feature, 2) END AS symbol"))
    wanted = parts["wanted"].selectExpr(*roles._select(_WANTED.format(s="STRING")[7:-12]))
    aliases = parts["wanted"].selectExpr(*roles._select(_ALIASES.format(s="STRING")[7:-12]))
    return J.resolve_markers(wanted, features, aliases, 4)


def j21(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("symbol"), F.expr("CASE WHEN p_size % 3 = 0 THEN 'X1' ELSE concat('ENSG', CAST(p_size % 4 AS STRING)) END").alias("id"))
    return J.gene_id_lookup(rows)


def j25(spark, d):
    shapes_ = table(spark, d, "part").select((F.col("p_partkey") - 1).alias("instance_id"))
    cells = table(spark, d, "customer").select(F.col("c_custkey").alias("instance_id"))
    points = table(spark, d, "lineitem").select(F.expr("CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_partkey + 7 END").alias("assignment"))
    return ids.violations(shapes_, cells, points)


def j28(spark, d):
    left = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    right = table(spark, d, "customer").select("c_nationkey", "c_custkey", F.col("c_acctbal").alias("area"))
    rows = J.attach_value(left, right, [("o_orderkey", "c_nationkey"), ("o_custkey", "c_custkey")], "area")
    return rows.agg(F.count("*").alias("n"), F.count("area").alias("n_matched"), R(F.sum(F.col("area").cast("decimal(20,2)")).cast("double"), 2).alias("total"))


def j31(spark, d):
    levels = table(spark, d, "events").select(F.col("user_id").alias("cell_id"), F.col("event_type").alias("level"), F.col("value").alias("probability")).where(F.lower("event_type").rlike("click|view"))
    complexity = C.cell_metrics_from_counts(roles.counts(spark, d), table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id")))
    return levels.join(complexity, "cell_id").groupBy("level").agg(F.count("*").alias("n"), F.sum("n_genes").alias("genes"), R(F.max("probability"), 4).alias("top"))


def w05(spark, d):
    return roles.numbered_transcripts(spark, d).select("transcript_id", "cell_id", "gene", "x", "y")


def w06(spark, d):
    named = ids.canonical_ids(table(spark, d, "supplier").select(F.col("s_name").alias("source")), "source")
    own = ids.canonical_ids(table(spark, d, "supplier").select(F.col("s_suppkey").alias("source")), "source")
    return named.select(F.lit("text").alias("kind"), "source", "instance_id").unionByName(own.select(F.lit("own").alias("kind"), F.col("source").cast("string").alias("source"), "instance_id"))


def w07(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("internal"), F.expr("CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey + 1 AS BIGINT) END").alias("label"))
    return ids.allocate(rows, "internal", "label").select("internal", "instance_id")


_PATH = "s_suppkey % 4 AS line, s_suppkey AS k, CAST(s_suppkey * 37 % 101 AS DOUBLE) AS x, CAST(s_suppkey * s_suppkey % 53 AS DOUBLE) AS y"


def _path(spark, d):
    return table(spark, d, "supplier").selectExpr(*roles._select(_PATH))


def w08(spark, d):
    rows = paths.with_length(_path(spark, d), ["line"], "k")
    w = Window.partitionBy("line").orderBy("k")
    rows = rows.withColumn("spacing", paths.central_spacing("x", w))
    rows = paths.smoothed(rows, ["line"], "k", "x", 3, "smooth_x")
    rows = paths.smoothed(rows, ["line"], "k", "y", 3, "smooth_y", keep_ends=True)
    return rows.select("line", "k", *(R(c).alias(c) for c in ("length", "spacing", "smooth_x", "smooth_y")))


def w09(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return ids.first_of(rows, ["o_custkey"], ["o_orderkey"])


def w10(spark, d):
    rows = paths.resampled(_path(spark, d), ["line"], "k", 9)
    return rows.select("line", F.col("i").cast("long").alias("i"), R("x", 4).alias("x"), R("y", 4).alias("y"))


def t01(spark, d):
    return table(spark, d, "part").where("p_retailprice > 0 AND NOT isnan(p_retailprice)").orderBy(F.desc("p_retailprice"), "p_partkey").limit(12).select("p_partkey", "p_retailprice")


def t03(spark, d):
    """Quota of each family in rank order without repeats, then filled to the cap."""
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("gene")).agg(F.avg("p_retailprice").alias("f0"), F.avg("p_size").alias("f1"), F.count("*").cast("double").alias("f2"))
    return J.diagnostic_genes(rows.unpivot(["gene"], ["f0", "f1", "f2"], "family", "value"), 9, 12, 3)


def t04(spark, d):
    """Every 7th row in order, and 11 evenly spaced anchors."""
    rows = ids.stable_ids(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "n", first=0)
    n = rows.agg(F.count("*").alias("_c"))
    anchors = n.select(F.explode(F.sequence(F.lit(0), F.lit(10))).alias("i"), "_c").select(F.floor(F.col("i") * (F.col("_c") - 1) / 10).alias("n"))
    return rows.where("n % 7 = 0").select(F.lit("stride").alias("kind"), "o_orderkey").unionByName(rows.join(F.broadcast(anchors), "n").select(F.lit("anchor").alias("kind"), "o_orderkey"))


def t04_random(spark, d):
    """Twenty rows of each priority without replacement, by hash: reruns agree."""
    w = Window.partitionBy("o_orderpriority").orderBy(F.xxhash64("o_orderkey", F.lit(11)), "o_orderkey")
    return table(spark, d, "orders").withColumn("k", F.row_number().over(w)).where("k <= 20").select("o_orderpriority", "o_orderkey")


def t05(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"), "c_acctbal")
    return rows.orderBy(F.asc_nulls_last("segment"), F.desc("c_acctbal"), "c_custkey").limit(40)


def _spelled(spark, d):
    part = table(spark, d, "part")
    return part.select(F.col("p_partkey").alias("ord"), F.expr("CASE p_partkey % 3 WHEN 0 THEN upper(p_brand) WHEN 1 THEN lower(p_brand) ELSE p_brand END").alias("gene"))


def u01(spark, d):
    return J.union_names(_spelled(spark, d))


def u02(spark, d):
    t = table(spark, d, "part")
    return t.where("p_size > 40").select("p_brand").intersect(t.where("p_type = 'PROMO'").select("p_brand")).select(F.col("p_brand").alias("gene"))


def u03(spark, d):
    out = None
    for p in ("MERSCOPE", "XENIUM"):
        part = roles.transcripts(spark, d).where(F.col("platform") == p).groupBy("gene").agg(F.count("*").alias("n")).withColumn("sample", F.lit(p))
        out = part if out is None else out.unionByName(part)
    return out


def u04(spark, d):
    wanted = table(spark, d, "nation").select(F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 1).cast("string")).alias("gene"))
    return wanted.join(table(spark, d, "part").where("p_size > 10").select(F.col("p_brand").alias("gene")), "gene", "left_anti").unionByName(wanted.exceptAll(wanted.limit(0)).where("gene = 'Brand#1'"))


def u05(spark, d):
    return table(spark, d, "part").select(F.col("p_brand").alias("gene")).distinct().orderBy("gene")


def x07(spark, d):
    moved = shapes.transform_rings(roles.ring(), [[0.0, -2.0, 7.0], [0.5, 0.0, -3.0]])
    return roles.cells(spark, d).select("instance_id", F.posexplode(moved).alias("i", "v")).select("instance_id", F.col("i").cast("long").alias("i"), "v.x", "v.y")


def x08(spark, d):
    rows = roles.cells(spark, d).withColumn("half", F.when(F.col("instance_id") % 10 > 0, F.col("half")).otherwise(0.0))
    return shapes.centroids(rows, roles.ring(), "instance_id").select("instance_id", R("x").alias("x"), R("y").alias("y"))


QUERIES = {
    "j13_shape_metrics": j13, "j14_shared_genes": j14, "j14_two_tables": j14_two, "j15_gene_summary": j15, "j16_annotate": j16, "j17_id_translation": j17, "j18_taxonomy_chain": j18, "j19_majority_split": j19,
    "j20_gene_aliases": j20, "j21_gene_id_lookup": j21, "j25_violations": j25, "j28_best_key": j28, "j31_quality_complexity": j31, "w05_stable_ids": w05, "w06_canonical_ids": w06, "w07_id_allocation": w07,
    "w08_path_measures": w08, "w09_first_duplicate": w09, "w10_path_resampling": w10, "t01_top_n": t01, "t03_diagnostic_genes": t03, "t04_even_rows": t04, "t04_random_rows": t04_random, "t05_multi_key_order": t05,
    "u01_union_names": u01, "u02_intersection": u02, "u03_stack": u03, "u04_difference": u04, "u05_vocabulary": u05, "x07_ring_transform": x07, "x08_centroids": x08,
}

_TOT2 = """g AS (SELECT platform, CASE WHEN feature_type = 'PROMO' AND platform = 'XENIUM' THEN 'Blank' || gene ELSE gene END AS gene FROM transcripts{w}), tot AS (SELECT platform, gene, count(*) AS total FROM g WHERE NOT (platform = 'XENIUM' AND contains(gene, 'Blank')) GROUP BY ALL)"""

ORACLES = {
    "j13_shape_metrics": "SELECT o_orderkey AS cell_id, arg_min(l_quantity, (l_linenumber * 10000 + l_suppkey, l_quantity)) AS area FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
    "j14_shared_genes": sql("transcripts", "SELECT platform, gene, count(*) AS n FROM transcripts WHERE gene IN (SELECT gene FROM transcripts WHERE assignment IS NULL AND feature_type IN ('PROMO', 'LARGE', 'SMALL') GROUP BY 1 HAVING count(DISTINCT feature_type) = 3) GROUP BY ALL"),
    "j14_two_tables": sql("transcripts", f"{_TOT2.format(w='')} SELECT m.gene, m.total AS total_merscope, x.total AS total_xenium FROM tot m JOIN tot x ON m.gene = x.gene AND m.platform = 'MERSCOPE' AND x.platform = 'XENIUM'"),
    "j15_gene_summary": sql("transcripts", f"{_TOT2.format(w=' WHERE assignment IS NOT NULL')}, m AS (SELECT * FROM tot WHERE platform = 'MERSCOPE' AND gene <> 'Brand#9'), x AS (SELECT * FROM tot WHERE platform = 'XENIUM') SELECT coalesce(m.gene, x.gene) AS gene, coalesce(m.total, 0) AS merscope, coalesce(x.total, 0) AS xenium FROM m FULL JOIN x ON m.gene = x.gene"),
    "j16_annotate": "SELECT coalesce(c_mktsegment, 'Mixed/Unknown') AS mm_cluster, count(*) AS n FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 > 0) ON c_custkey = o_custkey GROUP BY 1",
    "j17_id_translation": sql("transcripts", "SELECT gene, count(assignment) AS n, CAST(sum(assignment * 2 + 1) AS BIGINT) AS total FROM transcripts GROUP BY 1"),
    "j18_taxonomy_chain": "SELECT CASE r_name WHEN 'ASIA' THEN 'Astrocytes' WHEN 'EUROPE' THEN 'Neurons' ELSE r_name END AS broad_class, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "j19_majority_split": """WITH v AS (SELECT n_regionkey, CASE s_suppkey % 3 WHEN 0 THEN 'Inhibitory' WHEN 1 THEN 'Excitatory' ELSE 'Other' END AS split, count(*) AS k FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS i, lead(k) OVER w AS nx FROM v WINDOW w AS (PARTITION BY n_regionkey ORDER BY k DESC, split))
        SELECT n_regionkey, CASE WHEN k = nx THEN 'Other' ELSE split END AS neuron_split FROM r WHERE i = 1""",
    "j20_gene_aliases": f"""WITH f AS ({_FEATURES}), m AS ({_WANTED.format(s='VARCHAR')}), al AS ({_ALIASES.format(s='VARCHAR')}), tk AS (SELECT lower(id) AS token, 0 AS p, ord, feature FROM f UNION ALL SELECT lower(name), 1, ord, feature FROM f UNION ALL SELECT lower(symbol), 2, ord, feature FROM f),
        lk AS (SELECT token, arg_min(feature, (p, ord, feature)) AS feature FROM tk WHERE token NOT IN ('', 'nan', 'none') GROUP BY 1), rs AS (SELECT label, m.ord, coalesce(a.feature, b.feature) AS feature FROM m LEFT JOIN lk a ON a.token = lower(trim(marker)) LEFT JOIN al ON al.token = lower(trim(marker)) LEFT JOIN lk b ON b.token = al.alias),
        fi AS (SELECT label, feature, min(ord) AS ord FROM rs WHERE feature IS NOT NULL GROUP BY ALL) SELECT label, ord, feature FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ord) AS k FROM fi) WHERE k <= 4""",
    "j21_gene_id_lookup": "SELECT p_brand AS symbol, 'ENSG' || CAST(arg_min(p_size % 4, p_partkey) AS VARCHAR) AS gene_id, count(DISTINCT p_size % 4) > 1 AS conflict FROM part WHERE p_size % 3 > 0 GROUP BY 1",
    "j25_violations": """WITH s AS (SELECT p_partkey - 1 AS id FROM part), c AS (SELECT c_custkey AS id FROM customer), p AS (SELECT DISTINCT l_partkey + 7 AS id FROM lineitem WHERE l_returnflag <> 'N') SELECT 'shape_without_cell' AS check, id FROM s WHERE id NOT IN (SELECT id FROM c) UNION ALL SELECT 'cell_without_shape', id FROM c WHERE id NOT IN (SELECT id FROM s)
        UNION ALL SELECT 'assignment_without_shape', id FROM p WHERE id NOT IN (SELECT id FROM s) UNION ALL SELECT 'repeated_shape_id', id FROM s GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'id_not_positive', id FROM s WHERE id <= 0""",
    "j28_best_key": "SELECT count(*) AS n, count(c_acctbal) AS n_matched, round(CAST(sum(CAST(c_acctbal AS DECIMAL(20, 2))) AS DOUBLE), 2) AS total FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
    "j31_quality_complexity": sql("counts", "c AS (SELECT o_orderkey AS cell_id, count(gene) AS g FROM orders LEFT JOIN counts ON cell_id = o_orderkey GROUP BY 1) SELECT event_type AS level, count(*) AS n, CAST(sum(g) AS BIGINT) AS genes, round(max(value), 4) AS top FROM events JOIN c ON cell_id = user_id WHERE regexp_matches(lower(event_type), 'click|view') GROUP BY 1"),
    "w05_stable_ids": sql("numbered", "SELECT transcript_id, cell_id, gene, x, y FROM numbered"),
    "w06_canonical_ids": "SELECT 'text' AS kind, s_name AS source, row_number() OVER (ORDER BY s_name) AS instance_id FROM supplier UNION ALL SELECT 'own', CAST(s_suppkey AS VARCHAR), s_suppkey + 1 FROM supplier",
    "w07_id_allocation": """WITH r AS (SELECT c_custkey AS i, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey + 1 AS BIGINT) END AS l FROM customer), k AS (SELECT *, l IS NOT NULL AND row_number() OVER (PARTITION BY l ORDER BY i) = 1 AS keeps FROM r)
        SELECT i AS internal, CASE WHEN keeps THEN l ELSE (SELECT max(l) FROM r) + row_number() OVER (PARTITION BY keeps ORDER BY i) END AS instance_id FROM k""",
    "w08_path_measures": f"""WITH p AS (SELECT {_PATH} FROM supplier), a AS (SELECT *, lag(x) OVER w AS bx, lead(x) OVER w AS ax, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS st, count(*) OVER (PARTITION BY line) AS n, row_number() OVER w AS i,
        coalesce(lag(x) OVER w, x) AS px, coalesce(lead(x) OVER w, x) AS nx, coalesce(lag(y) OVER w, y) AS py, coalesce(lead(y) OVER w, y) AS ny FROM p WINDOW w AS (PARTITION BY line ORDER BY k))
        SELECT line, k, round(sum(st) OVER (PARTITION BY line ORDER BY k ROWS UNBOUNDED PRECEDING), 6) AS length, round(abs(CASE WHEN bx IS NULL AND ax IS NULL THEN 1e0 WHEN bx IS NULL THEN ax - x WHEN ax IS NULL THEN x - bx ELSE (ax - bx) / 2 END), 6) AS spacing,
        round(CASE WHEN n <= 3 THEN x ELSE (px + x + nx) / 3 END, 6) AS smooth_x, round(CASE WHEN n <= 3 OR i = 1 OR i = n THEN y ELSE (py + y + ny) / 3 END, 6) AS smooth_y FROM a""",
    "w09_first_duplicate": "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1",
    "w10_path_resampling": f"""WITH p AS (SELECT {_PATH} FROM supplier), a AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS st FROM p WINDOW w AS (PARTITION BY line ORDER BY k)), l AS (SELECT *, sum(st) OVER (PARTITION BY line ORDER BY k ROWS UNBOUNDED PRECEDING) AS len FROM a),
        s AS (SELECT line, x, y, len, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lead(len) OVER w AS len2, max(len) OVER (PARTITION BY line) AS total FROM l WINDOW w AS (PARTITION BY line ORDER BY k)), t AS (SELECT s.*, i, i * total / 8 AS pos FROM s, range(9) r(i) WHERE len2 > len),
        h AS (SELECT line, i, x + (pos - len) / (len2 - len) * (x2 - x) AS x, y + (pos - len) / (len2 - len) * (y2 - y) AS y, row_number() OVER (PARTITION BY line, i ORDER BY abs(pos - (len + len2) / 2) - (len2 - len) / 2, len) AS k FROM t) SELECT line, i, round(x, 4) AS x, round(y, 4) AS y FROM h WHERE k = 1""",
    "t01_top_n": "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 0 ORDER BY p_retailprice DESC, p_partkey LIMIT 12",
    "t03_diagnostic_genes": """WITH r AS (SELECT p_brand AS gene, avg(p_retailprice) AS f0, avg(p_size) AS f1, CAST(count(*) AS DOUBLE) AS f2 FROM part GROUP BY 1), l AS (SELECT gene, 'f0' AS family, f0 AS v FROM r UNION ALL SELECT gene, 'f1', f1 FROM r UNION ALL SELECT gene, 'f2', f2 FROM r), k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY v DESC, gene) AS rank FROM l),
        b AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY rank > 3, family, rank) AS i FROM k WHERE rank <= 12) SELECT gene, family, rank FROM b WHERE i = 1 ORDER BY rank > 3, rank, family, gene LIMIT 9""",
    "t04_even_rows": "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n, count(*) OVER () AS c FROM orders) SELECT 'stride' AS kind, o_orderkey FROM r WHERE n % 7 = 0 UNION ALL SELECT 'anchor', o_orderkey FROM r, range(11) t(i) WHERE n = floor(i * (c - 1) / 10)",
    "t05_multi_key_order": "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer ORDER BY segment ASC NULLS LAST, c_acctbal DESC, c_custkey LIMIT 40",
    "u01_union_names": "SELECT lower(p_brand) AS token, arg_min(CASE p_partkey % 3 WHEN 0 THEN upper(p_brand) WHEN 1 THEN lower(p_brand) ELSE p_brand END, p_partkey) AS gene FROM part GROUP BY 1",
    "u02_intersection": "SELECT p_brand AS gene FROM part WHERE p_size > 40 INTERSECT SELECT p_brand FROM part WHERE p_type = 'PROMO'",
    "u03_stack": sql("transcripts", "SELECT gene, count(*) AS n, platform AS sample FROM transcripts GROUP BY gene, platform"),
    "u04_difference": "WITH w AS (SELECT 'Brand#' || CAST(n_nationkey + 1 AS VARCHAR) AS gene FROM nation) SELECT gene FROM w WHERE gene NOT IN (SELECT p_brand FROM part WHERE p_size > 10) UNION ALL SELECT gene FROM w WHERE gene = 'Brand#1'",
    "u05_vocabulary": "SELECT DISTINCT p_brand AS gene FROM part",
    "x07_ring_transform": sql("cells", "SELECT instance_id, i, -2 * (cy + b * half) + 7 AS x, 0.5e0 * (cx + a * half) - 3 AS y FROM cells, (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1), (4, -1, -1)) v(i, a, b)"),
    "x08_centroids": sql("cells", "SELECT instance_id, cx AS x, cy AS y FROM cells"),
}

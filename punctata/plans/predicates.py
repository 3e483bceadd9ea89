"""Queries of masks, filters and scalar rules, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctata import roles
from punctata.functions import names as N
from punctata.operators import predicates as P
from punctata.roles import sql, table

AFFINE = [[0.0, -2.0, 7.0], [0.5, 0.0, -3.0]]
_TEXT_ASSIGNMENT = "CASE l_linenumber WHEN 1 THEN ' Unassigned ' WHEN 2 THEN '0' WHEN 3 THEN NULL WHEN 4 THEN 'NaN' ELSE CAST(l_orderkey AS {s}) END"
_TEXT_BACKGROUND = "CASE l_linenumber WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'no' WHEN 3 THEN NULL WHEN 4 THEN 'f' ELSE 'maybe' END"
_LABELS = "CASE n_nationkey % 9 WHEN 0 THEN 'Astrocyte' WHEN 1 THEN 'MGE interneuron' WHEN 2 THEN ' Vascular ' WHEN 3 THEN 'Splatter' WHEN 4 THEN 'Deep inhibitory thing' WHEN 5 THEN 'Oligodendrocyte precursor' WHEN 6 THEN 'Hippocampal CA4' WHEN 7 THEN n_name ELSE 'Microglia' END"
_TRANSMITTER = "CASE n_nationkey % 6 WHEN 0 THEN 'GABA-Gly' WHEN 1 THEN 'vglut1' WHEN 2 THEN 'GABA VGLUT2' WHEN 3 THEN 'CHOL' WHEN 4 THEN 'gly' ELSE 'VGLUT3 CHOL' END"


def p02(spark, d):
    rows = P.assigned_numeric(roles.transcripts(spark, d), "assignment").withColumn("which", F.lit("nullable"))
    dense = P.assigned_numeric(table(spark, d, "events").select((F.col("user_id") % 5).alias("assignment")), "assignment").withColumn("which", F.lit("dense"))
    return rows.select("which", "assigned").unionByName(dense.select("which", "assigned")).groupBy("which", "assigned").agg(F.count("*").alias("n"))


def p03(spark, d):
    rows = table(spark, d, "lineitem").select(F.expr(_TEXT_ASSIGNMENT.format(s="STRING")).alias("assignment"))
    return rows.withColumn("assigned", P.assigned_text("assignment")).groupBy("assignment", "assigned").agg(F.count("*").alias("n"))


def p04(spark, d):
    rows = table(spark, d, "lineitem").select(F.expr(_TEXT_BACKGROUND).alias("t"), F.expr("nullif(l_linenumber % 3, 2)").alias("i"), F.expr("nullif(l_returnflag, 'A') = 'N'").alias("b"))
    marks = rows.select(*(P.background(rows, c).alias(f"{c}_background") for c in rows.columns))
    return marks.groupBy(*marks.columns).agg(F.count("*").alias("n"))


def p05(spark, d):
    rows = P.with_assigned(roles.transcripts(spark, d), "assignment")
    other = P.with_assigned(roles.transcripts(spark, d).drop("background"), "assignment")
    return rows.select(F.lit("background").alias("by"), "assigned").union(other.select(F.lit("assignment"), "assigned")).groupBy("by", "assigned").agg(F.count("*").alias("n"))


def p06(spark, d):
    features = table(spark, d, "part").select(F.expr("CASE p_type WHEN 'PROMO' THEN 'NegControlProbe' WHEN 'SMALL' THEN 'blank-1' ELSE p_type END").alias("feature_type"), F.col("p_brand").alias("gene"), F.col("p_name").alias("name"))
    return features.withColumn("is_control", P.is_control("name", "gene", "feature_type")).groupBy("gene", "feature_type", "is_control").agg(F.count("*").alias("n"))


def p07(spark, d):
    rows = roles.transcripts(spark, d).withColumn("gene", F.expr("CASE feature_type WHEN 'PROMO' THEN 'Blank-7' WHEN 'SMALL' THEN 'UnassignedCodeword_1' WHEN 'LARGE' THEN 'blank' ELSE gene END"))
    return P.drop_platform_probes(rows).groupBy("platform", "gene").agg(F.count("*").alias("n"))


def p08(spark, d):
    from punctata.operators.ids import stable_ids

    rows = roles.numbered_transcripts(spark, d)
    usable, excluded = P.export_filter(rows, "Brand#1|Brand#22", 20)
    marked = rows.withColumns({"usable": usable, "excluded": excluded})
    kept = stable_ids(marked.where("usable AND NOT excluded"), ["transcript_id"], "export_id", first=0)
    return kept.select("export_id", "transcript_id", "gene", "x", "y", "qv")


def p08_counters(spark, d):
    rows = roles.transcripts(spark, d)
    usable, excluded = P.export_filter(rows, "Brand#1|Brand#22", 20)
    return rows.agg(F.count("*").alias("n_input"), F.count_if(usable & ~excluded).alias("n_written"), F.count_if(usable & excluded).alias("n_excluded"), F.count_if(usable & ~excluded & F.col("assignment").isNotNull()).alias("n_seeded"))


def p09(spark, d):
    return P.crop(roles.transcripts(spark, d), 100.5, 50, 220, 333.125).groupBy("gene").agg(F.count("*").alias("n"), F.min("x").alias("min_x"), F.max("y").alias("max_y"))


def p10(spark, d):
    per_cell = roles.transcripts(spark, d).where("assignment IS NOT NULL").groupBy("assignment").agg(F.count("*").alias("n_transcripts"), F.countDistinct("gene").alias("n_genes"))
    area = table(spark, d, "orders").select(F.col("o_orderkey").alias("assignment"), F.expr("CAST(o_custkey % 40 AS DOUBLE)").alias("area"))
    rules = P.cell_rule(2, 1, 5, 30)
    rows = per_cell.join(area, "assignment")
    keep = rules["transcripts"] & rules["genes"] & rules["area"]
    return rows.agg(F.count("*").alias("n_cells"), F.count_if(keep).alias("n_kept"), *(F.count_if(~c).alias(f"removed_by_{n}") for n, c in rules.items()))


def p11(spark, d):
    return P.cells_then_genes(roles.counts(spark, d), 4, 20).groupBy("gene").agg(F.count("*").alias("n_cells"), F.sum("n").alias("total"))


def p12(spark, d):
    rows = roles.transcripts(spark, d).withColumns({"observed_x": F.col("x") + 1, "observed_y": F.col("y") - 1})
    return P.observed_wins(rows).groupBy("gene").agg(*(F.sum(c).alias(f"sum_{c}") for c in ("x", "y", "proseg_moved_x", "proseg_moved_y")))


def p13(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.expr("CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'x' ELSE CAST(l_suppkey AS STRING) END").alias("cell"), F.col("l_orderkey").cast("string").alias("transcript_id"), F.expr("CASE WHEN l_returnflag = 'N' THEN 'none' ELSE CAST(l_orderkey AS STRING) END").alias("assignment"), F.col("l_orderkey").alias("cell_id"))
    kept = P.points_contract(rows)
    return kept.groupBy("gene").agg(F.sum(F.expr("try_cast(cell AS BIGINT)")).alias("cell"), F.count_if(F.col("cell") == "x").alias("n_text"), F.count("assignment").alias("n_assigned"), F.max("transcript_id").alias("last_id"), F.max("cell_id").alias("last_cell"))


def p14(spark, d):
    rows = roles.cells(spark, d)
    x, y = P.affine(F.col("cx"), F.col("cy"), AFFINE)
    moved = rows.withColumns({"x": x, "y": y})
    back_x, back_y = P.affine(F.col("x"), F.col("y"), P.inverse(AFFINE))
    return moved.select("instance_id", "x", "y", back_x.alias("back_x"), back_y.alias("back_y"))


def p15(spark, d):
    rows = roles.cells(spark, d).select("instance_id", F.when(F.col("instance_id") % 7 > 0, F.col("cx")).alias("x"), F.col("cy").alias("y"))
    return P.transform_points(rows, AFFINE)


def p16(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_nationkey"), F.expr(_LABELS).alias("label"), F.expr(_TRANSMITTER).alias("transmitter"))
    return rows.select("n_nationkey", P.broad_class(F.col("label")).alias("broad_class"), P.neuron_split(F.col("transmitter")).alias("neuron_split"))


def p17(spark, d):
    rows = table(spark, d, "orders").select(F.expr("o_totalprice % 300e0 - 20e0").alias("distance"))
    return rows.select(P.proximity(F.col("distance"), F.col("distance") < 0).alias("band")).groupBy("band").agg(F.count("*").alias("n"))


def p18(spark, d):
    rows = table(spark, d, "part").select("p_name", "p_brand").distinct()
    return rows.select("p_name", "p_brand", N.normalized(F.concat(F.lit("  "), F.col("p_brand"))).alias("gene"), N.table_key(F.concat(F.lit("#"), F.col("p_name"), F.lit(" - x"))).alias("table_key"), N.safe_token(F.concat(F.lit("*"), F.col("p_brand"), F.lit("!!"))).alias("token"), N.safe_identifier(F.concat_ws("#", "p_name", "p_brand")).alias("identifier"))


def p19(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_linenumber") != 3).alias("inside"), F.expr("nullif(l_suppkey % 5, 0)").alias("depth"), F.expr("nullif(l_partkey % 4, 1)").alias("line"), (F.col("l_quantity") < 9).alias("near"))
    return rows.select(P.depth_flag(*(F.col(c) for c in rows.columns)).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


_GENE_FACTS = "p_brand AS gene, p_partkey, p_size % 4 > 0 AS eligible, p_size % 11 = 0 AS clustered, p_size % 7 = 0 AS disperse, (p_size % 5) / 10e0 AS pericellular, (p_size % 9) / 20e0 AS membrane, (p_partkey % 6 - 3) / 4e0 AS s1, (p_size % 6 - 3) / 4e0 AS s2, (p_partkey % 4 - 2) / 4e0 AS s3, (p_partkey % 10) / 100e0 AS q1, (p_size % 10) / 100e0 AS q2, 0.04e0 AS q3"


def p20(spark, d):
    rows = table(spark, d, "part").selectExpr(*roles._select(_GENE_FACTS))
    names = ("nuclear", "cytoplasmic", "extracellular")
    label = P.pattern_label(dict(zip(names, map(F.col, ("s1", "s2", "s3")), strict=True)), dict(zip(names, map(F.col, ("q1", "q2", "q3")), strict=True)), *map(F.col, ("eligible", "clustered", "disperse", "pericellular", "membrane")))
    return rows.select(label.alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


def p21(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("grp"), F.expr("o_custkey % 3 - 1").cast("double").alias("depth"), F.col("o_totalprice").alias("price"))
    return P.plot_frame(rows, ["o_orderkey"], "grp", ["depth", "price"]).groupBy("grp", "metric").agg(F.count("*").alias("n"))


def p22(spark, d):
    rows = roles.pixels(spark, d).withColumn("value", F.round(F.col("value") * 1024))
    return P.stretch(rows, "value", ["channel"]).select("channel", "row", "col", F.round("stretched", 6).alias("stretched"))


def p23(spark, d):
    rows = table(spark, d, "lineitem").select("l_linenumber", F.expr("l_discount * 12e0 - 0.1e0").alias("phi"), F.expr("0.5e0 + l_tax * 10e0").alias("ratio"))
    return rows.select("l_linenumber", F.round(P.equal_area_depth(F.col("phi"), F.col("ratio")), 6).alias("depth")).groupBy("l_linenumber", "depth").agg(F.count("*").alias("n"))


def p24(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.expr("CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN CAST(c_custkey AS STRING) WHEN 2 THEN 'none' WHEN 3 THEN '-4' ELSE concat('cell_', CAST(c_nationkey AS STRING)) END").alias("label"))
    return rows.select("c_custkey", P.positive_label("label").alias("parsed"))


def p25(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 3 = 0 THEN ' ' WHEN c_custkey % 3 = 1 THEN NULL ELSE concat('n', CAST(c_nationkey AS STRING)) END").alias("chosen"), F.col("c_mktsegment").alias("fallback"))
    return P.ids_with_fallback(rows, "chosen", "fallback", order=["c_custkey"]).select("c_custkey", "query_id")


QUERIES = {
    "p02_assigned_numeric": p02, "p03_assigned_text": p03, "p04_background": p04, "p05_assigned_points": p05, "p06_control_features": p06, "p07_platform_probes": p07,
    "p08_export": p08, "p08_export_counters": p08_counters, "p09_crop": p09, "p10_cell_rule": p10, "p11_cells_then_genes": p11, "p12_observed_wins": p12, "p13_points_contract": p13,
    "p14_affine": p14, "p15_aligned_points": p15, "p16_broad_class": p16, "p17_proximity": p17, "p18_names": p18, "p19_depth_flag": p19, "p20_pattern_label": p20,
    "p21_plot_frame": p21, "p22_stretch": p22, "p23_equal_area_depth": p23, "p24_positive_label": p24, "p25_ids_with_fallback": p25,
}

_CLASSES = " ".join(f"WHEN trim(label) = '{k}' THEN '{v}'" for k, v in N.NON_NEURON_CLASSES.items())
_IN = lambda words: ", ".join(f"'{w}'" for w in words)

ORACLES = {
    "p02_assigned_numeric": sql("transcripts", """a AS (SELECT 'nullable' AS which, assignment FROM transcripts UNION ALL SELECT 'dense', user_id % 5 FROM events),
        f AS (SELECT which, bool_or(assignment IS NULL) AS has_null FROM a GROUP BY which)
        SELECT which, CASE WHEN has_null THEN assignment IS NOT NULL ELSE assignment <> 0 END AS assigned, count(*) AS n FROM a JOIN f USING (which) GROUP BY ALL"""),
    "p03_assigned_text": f"""SELECT assignment, assignment IS NOT NULL AND lower(trim(assignment)) NOT IN ({_IN(N.UNASSIGNED_TEXT)}) AS assigned, count(*) AS n
        FROM (SELECT {_TEXT_ASSIGNMENT.format(s='VARCHAR')} AS assignment FROM lineitem) GROUP BY ALL""",
    "p04_background": f"""SELECT coalesce(lower(trim(t)) NOT IN ({_IN(N.FALSE_TEXT)}), true) AS t_background, coalesce(i, 1) <> 0 AS i_background, coalesce(b, true) AS b_background, count(*) AS n
        FROM (SELECT {_TEXT_BACKGROUND} AS t, nullif(l_linenumber % 3, 2) AS i, nullif(l_returnflag, 'A') = 'N' AS b FROM lineitem) GROUP BY ALL""",
    "p05_assigned_points": sql("transcripts", "SELECT 'background' AS by, NOT background AS assigned, count(*) AS n FROM transcripts GROUP BY ALL UNION ALL SELECT 'assignment', assignment IS NOT NULL, count(*) FROM transcripts GROUP BY ALL"),
    "p06_control_features": f"""SELECT gene, feature_type, regexp_matches(lower(name || gene || feature_type), '{"|".join(N.CONTROL_TOKENS)}') AS is_control, count(*) AS n
        FROM (SELECT CASE p_type WHEN 'PROMO' THEN 'NegControlProbe' WHEN 'SMALL' THEN 'blank-1' ELSE p_type END AS feature_type, p_brand AS gene, p_name AS name FROM part) GROUP BY ALL""",
    "p07_platform_probes": sql("transcripts", """SELECT platform, gene, count(*) AS n FROM (SELECT platform, CASE feature_type WHEN 'PROMO' THEN 'Blank-7' WHEN 'SMALL' THEN 'UnassignedCodeword_1' WHEN 'LARGE' THEN 'blank' ELSE gene END AS gene FROM transcripts)
        WHERE NOT (platform = 'XENIUM' AND contains(gene, 'Blank')) AND NOT (platform = 'MERSCOPE' AND regexp_matches(gene, 'UnassignedCodeword|NegControlCodeword|NegControlProbe')) GROUP BY ALL"""),
    "p08_export": sql("numbered", "SELECT row_number() OVER (ORDER BY transcript_id) - 1 AS export_id, transcript_id, gene, x, y, qv FROM numbered WHERE qv >= 20 AND NOT regexp_matches(gene, '^(?:Brand#1|Brand#22)')"),
    "p08_export_counters": sql("transcripts", """SELECT count(*) AS n_input, count(*) FILTER (qv >= 20 AND NOT ex) AS n_written, count(*) FILTER (qv >= 20 AND ex) AS n_excluded, count(*) FILTER (qv >= 20 AND NOT ex AND assignment IS NOT NULL) AS n_seeded
        FROM (SELECT *, regexp_matches(gene, '^(?:Brand#1|Brand#22)') AS ex FROM transcripts)"""),
    "p09_crop": sql("transcripts", "SELECT gene, count(*) AS n, min(x) AS min_x, max(y) AS max_y FROM transcripts WHERE x BETWEEN 100.5 AND 220 AND y BETWEEN 50 AND 333.125 GROUP BY gene"),
    "p10_cell_rule": sql("transcripts", """c AS (SELECT assignment, count(*) AS t, count(DISTINCT gene) AS g FROM transcripts WHERE assignment IS NOT NULL GROUP BY assignment), r AS (SELECT t, g, CAST(o_custkey % 40 AS DOUBLE) AS a FROM c JOIN orders ON o_orderkey = assignment)
        SELECT count(*) AS n_cells, count(*) FILTER (t > 2 AND g > 1 AND a BETWEEN 5 AND 30) AS n_kept, count(*) FILTER (t <= 2) AS removed_by_transcripts, count(*) FILTER (g <= 1) AS removed_by_genes, count(*) FILTER (a NOT BETWEEN 5 AND 30) AS removed_by_area FROM r"""),
    "p11_cells_then_genes": sql("counts", """k AS (SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM counts GROUP BY cell_id HAVING sum(n) >= 4)),
        g AS (SELECT gene FROM k GROUP BY gene HAVING count(*) >= 20) SELECT gene, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS total FROM k WHERE gene IN (SELECT gene FROM g) GROUP BY gene"""),
    "p12_observed_wins": sql("transcripts", "SELECT gene, sum(x + 1) AS sum_x, sum(y - 1) AS sum_y, sum(x) AS sum_proseg_moved_x, sum(y) AS sum_proseg_moved_y FROM transcripts GROUP BY gene"),
    "p13_points_contract": """SELECT CAST(l_partkey AS VARCHAR) AS gene, CAST(sum(CASE WHEN l_linenumber IN (1, 2) THEN 0 ELSE l_suppkey END) AS BIGINT) AS cell, count(CASE WHEN l_linenumber = 2 THEN 1 END) AS n_text, count(*) AS n_assigned, max(l_orderkey) AS last_id, max(CAST(l_orderkey AS VARCHAR)) AS last_cell FROM lineitem GROUP BY l_partkey""",
    "p14_affine": sql("cells", "SELECT instance_id, -2e0 * cy + 7e0 AS x, 0.5e0 * cx - 3e0 AS y, cx AS back_x, cy AS back_y FROM cells"),
    "p15_aligned_points": sql("cells", """SELECT instance_id, CASE WHEN k THEN -2e0 * cy + 7e0 END AS x, CASE WHEN k THEN 0.5e0 * cx - 3e0 ELSE cy END AS y, CASE WHEN k THEN cx END AS raw_x, CASE WHEN k THEN cy END AS raw_y FROM (SELECT *, instance_id % 7 > 0 AS k FROM cells)"""),
    "p16_broad_class": f"""SELECT n_nationkey, CASE {_CLASSES} WHEN trim(label) IN ({_IN(N.KEPT_LABELS)}) THEN trim(label) WHEN trim(label) IN ({_IN(N.NEURON_LABELS)}) OR regexp_matches(lower(label), '{"|".join(N.NEURON_TOKENS)}') THEN 'Neurons' ELSE trim(label) END AS broad_class,
        CASE WHEN regexp_matches(upper(t), 'GABA|GLY') AND NOT contains(upper(t), 'VGLUT') THEN 'Inhibitory' WHEN contains(upper(t), 'VGLUT') AND NOT regexp_matches(upper(t), 'GABA|GLY') THEN 'Excitatory' ELSE 'Other' END AS neuron_split
        FROM (SELECT n_nationkey, {_LABELS} AS label, {_TRANSMITTER} AS t FROM nation)""",
    "p17_proximity": "SELECT CASE WHEN d < 50 THEN 'near' WHEN d < 100 THEN 'middle' WHEN d <= 200 THEN 'far' ELSE 'beyond_max' END AS band, count(*) AS n FROM (SELECT o_totalprice % 300e0 - 20e0 AS d FROM orders) GROUP BY 1",
    "p18_names": """SELECT DISTINCT p_name, p_brand, lower(p_brand) AS gene, 'table_' || trim(regexp_replace('#' || p_name || ' - x', '[^0-9a-zA-Z_]+', '_', 'g'), '_') AS table_key, trim(regexp_replace(lower('*' || p_brand || '!!'), '[^A-Za-z0-9]+', '_', 'g'), '_') AS token, lower(trim(regexp_replace(p_name || '#' || p_brand, '[^A-Za-z0-9._-]', '_', 'g'), '_')) AS identifier FROM part""",
    "p19_depth_flag": "SELECT CASE WHEN l_linenumber = 3 THEN 'outside_ribbon' WHEN l_suppkey % 5 = 0 THEN 'no_laplace_depth' WHEN l_partkey % 4 = 1 THEN 'no_streamline' WHEN l_quantity < 9 THEN 'near_side_boundary' ELSE 'assigned' END AS flag, count(*) AS n FROM lineitem GROUP BY 1",
    "p20_pattern_label": f"""SELECT CASE WHEN NOT eligible THEN 'insufficient_transcripts' WHEN clustered THEN 'residual_multiscale_clustered' WHEN disperse THEN 'spatially_disperse'
        WHEN top > 0 AND CASE WHEN s1 = top THEN q1 WHEN s2 = top THEN q2 ELSE q3 END < 0.05 THEN CASE WHEN s1 = top THEN 'nuclear' WHEN s2 = top THEN 'cytoplasmic' ELSE 'extracellular' END || '_enriched'
        WHEN pericellular >= 0.25 THEN 'pericellular' WHEN membrane >= 0.25 THEN 'membrane_proximal' ELSE 'diffuse_or_unresolved' END AS pattern, count(*) AS n
        FROM (SELECT *, greatest(s1, s2, s3) AS top FROM (SELECT {_GENE_FACTS} FROM part)) GROUP BY 1""",
    "p21_plot_frame": """SELECT grp, metric, count(*) AS n FROM (SELECT nullif(o_orderpriority, '5-LOW') AS grp, 'depth' AS metric, CAST(o_custkey % 3 - 1 AS DOUBLE) AS value FROM orders UNION ALL SELECT nullif(o_orderpriority, '5-LOW'), 'price', o_totalprice FROM orders) WHERE grp IS NOT NULL AND value > 0 GROUP BY ALL""",
    "p22_stretch": sql("pixels", """v AS (SELECT channel, row, col, round(value * 1024) AS v FROM pixels), p AS (SELECT channel, quantile_cont(v, 0.02) AS a, quantile_cont(v, 0.98) AS b FROM v GROUP BY channel)
        SELECT channel, row, col, round(greatest(0e0, least(1e0, (v - a) / (CASE WHEN b <= a THEN 1e0 ELSE b - a END))), 6) AS stretched FROM v JOIN p USING (channel)"""),
    "p23_equal_area_depth": "SELECT l_linenumber, round(greatest(0e0, least(1e0, (2e0 * p + (r - 1e0) * p * p) / (1e0 + r))), 6) AS depth, count(*) AS n FROM (SELECT l_linenumber, greatest(0e0, least(1e0, l_discount * 12e0 - 0.1e0)) AS p, 0.5e0 + l_tax * 10e0 AS r FROM lineitem) GROUP BY ALL",
    "p24_positive_label": """SELECT c_custkey, CASE WHEN v > 0 THEN v END AS parsed FROM (SELECT c_custkey, coalesce(TRY_CAST(label AS BIGINT), TRY_CAST(nullif(regexp_extract(label, '([0-9]+)$', 1), '') AS BIGINT)) AS v FROM
        (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN 'none' WHEN 3 THEN '-4' ELSE concat('cell_', CAST(c_nationkey AS VARCHAR)) END AS label FROM customer))""",
    "p25_ids_with_fallback": """SELECT c_custkey, CASE WHEN k = 0 THEN base ELSE base || '-' || CAST(k AS VARCHAR) END AS query_id FROM (SELECT c_custkey, base, row_number() OVER (PARTITION BY base ORDER BY c_custkey) - 1 AS k FROM
        (SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN concat('n', CAST(c_nationkey AS VARCHAR)) ELSE c_mktsegment END AS base FROM customer))""",
}

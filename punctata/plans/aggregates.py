"""Queries of totals, summaries, specificity, patterns, cohorts and alignment, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from punctata import roles
from punctata.functions import stats
from punctata.operators import align, cohort, counts as C, patterns, reports, specificity as M
from punctata.operators import predicates as P
from punctata.operators import spatial as S
from punctata.roles import sql, table

R = lambda c, n=6: F.round(c, n)


def a01(spark, d):
    t = roles.transcripts(spark, d)
    everything = C.gene_totals_from_points(t).withColumn("source", F.lit("points"))
    assigned = C.gene_totals_from_points(t, F.col("assignment").isNotNull()).withColumn("source", F.lit("assigned"))
    return everything.unionByName(assigned).unionByName(C.gene_totals(roles.counts(spark, d)).withColumn("source", F.lit("counts")))


def _per_cell(spark, d):
    return C.cell_metrics_from_points(roles.transcripts(spark, d), "assignment", ~F.col("background"))


def a02(spark, d):
    return _per_cell(spark, d)


def a03(spark, d):
    return C.cell_metrics_from_counts(roles.counts(spark, d), table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id")))


def a04(spark, d):
    return C.dataset_summary(roles.transcripts(spark, d), ~F.col("background"), _per_cell(spark, d))


def a05(spark, d):
    from punctata.operators.shapes import geometry

    rows = geometry(roles.cells(spark, d), roles.ring(), "instance_id")
    return rows.select("instance_id", *(R(c).alias(c) for c in ("area", "perimeter", "convex_area", "circularity", "solidity", "eccentricity", "aspect", "log10_area")))


def _totals(spark, d, assigned):
    t = roles.transcripts(spark, d).withColumn("gene", F.expr("CASE WHEN feature_type = 'PROMO' AND platform = 'XENIUM' THEN concat('Blank', gene) ELSE gene END"))
    t = P.drop_platform_probes(t.where("assignment IS NOT NULL") if assigned else t)
    return t.groupBy("platform", "gene").agg(F.count("*").alias("total"))


def a06(spark, d):
    return C.share(_totals(spark, d, False), "total", ["platform"]).select("platform", "gene", R("share", 9).alias("share"))


def _both(spark, d, assigned):
    t = C.share(_totals(spark, d, assigned), "total", ["platform"])
    m, x = (t.where(F.col("platform") == p).select("gene", F.col("total").alias(f"total_{p.lower()}"), F.col("share").alias(f"share_{p.lower()}")) for p in ("MERSCOPE", "XENIUM"))
    return m.join(x, "gene")


def a07(spark, d):
    return _both(spark, d, False).agg(*(R(c).alias(n) for c, n in zip(C.log_fit("total_merscope", "total_xenium"), ("slope", "intercept", "r2"), strict=True)))


def a08(spark, d):
    out = None
    for kind, assigned in (("total", False), ("assigned", True)):
        both = _both(spark, d, assigned)
        for scale in ("total", "share"):
            fit = [R(c).alias(n) for c, n in zip(C.log_fit(f"{scale}_merscope", f"{scale}_xenium"), ("slope", "intercept", "r2"), strict=True)]
            row = both.agg(F.count("*").alias("n_genes"), R(F.sum(f"{scale}_merscope")).cast("double").alias("sum_merscope"), R(F.sum(f"{scale}_xenium")).cast("double").alias("sum_xenium"), *fit).select(F.lit(kind).alias("kind"), F.lit(scale).alias("scale"), "*")
            out = row if out is None else out.unionByName(row)
    return out


def a09(spark, d):
    t = roles.transcripts(spark, d)
    vocabulary = table(spark, d, "part").select(F.col("p_brand").alias("gene")).where("p_brand <> 'Brand#3'").distinct()
    long = t.where("assignment IS NOT NULL").join(vocabulary, "gene", "left_semi").groupBy(F.col("assignment").alias("cell_id"), "gene").agg(F.count("*").alias("n"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id")).join(long, "cell_id", "left")


def a10(spark, d):
    area = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.expr("CAST(o_custkey % 40 AS DOUBLE)").alias("cell_area"), F.expr("CAST(o_custkey % 7 AS DOUBLE)").alias("nucleus_area"))
    rows = reports.control_qc(roles.transcripts(spark, d), F.col("feature_type") == "PROMO", area)
    return rows.select("cell_id", "control_counts", R("pct_control_counts").alias("pct_control_counts"), R("nucleus_ratio").alias("nucleus_ratio"))


def _classes(spark, d):
    return roles.cell_class(spark, d).select("cell_id", F.col("broad_class").alias("grp"))


def a11(spark, d):
    return C.group_gene_summary(roles.counts(spark, d), _classes(spark, d)).select("grp", "gene", "n_cells", R("mean").alias("mean"), R("fraction").alias("fraction"))


def _z(spark, d):
    return C.gene_z_scores(C.group_gene_summary(roles.counts(spark, d), _classes(spark, d)), _classes(spark, d))


def a12(spark, d):
    return _z(spark, d).select("grp", "gene", R("mean").alias("mean"), R("z").alias("z"))


_MARKER_TEXT = "concat('Brand#', CAST(1 + n_nationkey AS {s}))"


def _markers(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey")).select(F.col("r_name").alias("label"), F.expr(_MARKER_TEXT.format(s="STRING")).alias("gene"))


def a13(spark, d):
    from punctata.operators.labels import best_labels, label_scores

    scores = label_scores(_z(spark, d), _markers(spark, d), 3)
    return best_labels(scores, table(spark, d, "orders").select(F.col("o_orderpriority").alias("grp")).distinct(), 0.05).select("grp", "label", R("score").alias("score"), "runner_up", R("margin").alias("margin"))


def a13_scores(spark, d):
    from punctata.operators.labels import label_scores

    return label_scores(_z(spark, d), _markers(spark, d), 3).select("grp", "label", R("score").alias("score"), "n_markers", "resolved_markers")


def a14(spark, d):
    from punctata.operators.labels import split_marker_sets

    sets = table(spark, d, "part").select(F.expr("p_partkey % 3").alias("split"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("gene"))
    return split_marker_sets(sets, "split", "ord", "gene").select("split", F.array_join("genes", ";").alias("genes"))


def a15(spark, d):
    f = M.detection_fractions(roles.counts(spark, d), roles.cell_class(spark, d).select("cell_id", "broad_class"))
    return f.select("broad_class", "gene", R("target_fraction").alias("target_fraction"), R("other_fraction").alias("other_fraction"), "n_target", "n_other")


def a15_markers(spark, d):
    f = M.detection_fractions(roles.counts(spark, d), roles.cell_class(spark, d).select("cell_id", "broad_class"))
    return M.unique_markers(f, 0.12, 0.116).select("broad_class", "gene")


def a16(spark, d):
    rows = M.rank_sums(roles.counts(spark, d), roles.cell_class(spark, d).select("cell_id", "broad_class"))
    return rows.select("broad_class", "gene", "rank_sum", "u", R("score").alias("score"))


def a16_p(spark, d):
    return M.wilcoxon(roles.counts(spark, d), roles.cell_class(spark, d).select("cell_id", "broad_class"))


def a17(spark, d):
    panel = table(spark, d, "part").where("p_size < 25").select(F.lower("p_brand").alias("token")).distinct()
    rows = M.panel_reference(roles.counts(spark, d), panel)
    return rows.join(roles.cell_class(spark, d).where("broad_class <> '5-LOW'"), "cell_id").select("cell_id", "token", R("value").alias("value"))


def _marker_classes(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("gene")).agg(F.max("p_type").alias("broad_class")).unionByName(spark.createDataFrame([("Brand#7", "X")], "gene string, broad_class string"))


def _platform_counts(spark, d):
    return roles.transcripts(spark, d).groupBy("platform", "cell_id", "gene").agg(F.count("*").alias("n"))


def _pairs(spark, d):
    classes = table(spark, d, "part").select(F.col("p_brand").alias("gene"), F.concat(F.lit("c"), F.substring("p_brand", -1, 1)).alias("broad_class")).distinct()
    twice = classes.where("gene = 'Brand#7'")
    return M.pair_rates(_platform_counts(spark, d), classes.unionByName(twice), by=["platform"])


def a18(spark, d):
    return _pairs(spark, d).withColumn("mecr", R("mecr"))


def a19(spark, d):
    return M.rate_summary(_pairs(spark, d), ["platform"]).withColumns({"mecr": R("mecr"), "median_pair_mecr": R("median_pair_mecr")})


def a20(spark, d):
    return M.class_pair_medians(_pairs(spark, d), ["platform"]).withColumn("mecr", R("mecr"))


def a21(spark, d):
    wide = _pairs(spark, d).groupBy("gene_1", "gene_2").pivot("platform", ["MERSCOPE", "XENIUM"]).agg(F.avg("mecr"))
    return wide.dropna().select("gene_1", "gene_2", R("MERSCOPE").alias("merscope"), R("XENIUM").alias("xenium"))


def a52(spark, d):
    return _pairs(spark, d).where("mecr < 0.04").select("platform", "gene_1", "gene_2", R("mecr").alias("mecr"))


def t02(spark, d):
    canonical = spark.createDataFrame([("Brand#1", "Brand#2"), ("Brand#12", "Brand#20"), ("Brand#99", "Brand#98")], "gene_1 string, gene_2 string")
    return M.barnyard_pairs(_pairs(spark, d), canonical, 6).withColumn("mean_mecr", R("mean_mecr"))


_BANDS = "CASE WHEN o_custkey % 3 = 0 THEN 'near' WHEN o_custkey % 3 = 1 THEN 'far' ELSE 'middle' END"


def _bulk(spark, d):
    cells = roles.cell_class(spark, d).join(table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.expr(_BANDS).alias("proximity")), "cell_id").withColumnRenamed("broad_class", "tissue")
    return cohort.pseudobulk(roles.counts(spark, d), cells, ["1-URGENT", "2-HIGH", "3-MEDIUM"], 5)


def a22(spark, d):
    return _bulk(spark, d)


def a23(spark, d):
    return cohort.complete_pairs(_bulk(spark, d).where("NOT (pair_id = 'ASIA' AND proximity = 'far')")).select("pair_id").distinct()


def a24(spark, d):
    return cohort.size_factors(_bulk(spark, d)).withColumn("size_factor", R("size_factor"))


def a24_test(spark, d):
    rows = cohort.paired_test(_bulk(spark, d), tails=False)
    return rows.select("gene", R("log2_fold_change").alias("log2_fold_change"), "n_pairs", R("t", 4).alias("t"))


def a24_p(spark, d):
    return cohort.paired_test(_bulk(spark, d))


def _classified(spark, d):
    """Points with a compartment from box arithmetic on their own cell: the shape of J04's result."""
    t = roles.numbered_transcripts(spark, d, "gene", "x", "y")
    r = F.expr("x % 8e0 - 4e0")
    return t.select("transcript_id", "gene", "x", "y", r.alias("cell_distance"), (r - 2).alias("nucleus_distance"), F.when(r > 2, "nuclear").when(r > 0, "cytoplasmic").otherwise("extracellular").alias("compartment"), F.expr("transcript_id % 4").alias("n_cells"), F.expr("transcript_id % 3").alias("n_nuclei"))


def a25(spark, d):
    rows = patterns.compartment_enrichment(_classified(spark, d), pericellular=2.0, membrane=1.0, tails=False)
    return rows.select(*(R(c).alias(c) if t == "double" and not c.startswith("median") else c for c, t in rows.dtypes))


def a25_tails(spark, d):
    return patterns.compartment_enrichment(_classified(spark, d), least=20)


EDGES = (-2.0, 0.0, 1.5, 3.0)


def a26(spark, d):
    rows = patterns.distance_bins(_classified(spark, d), EDGES, tails=False)
    return rows.select("gene", "boundary", F.col("bin_index").cast("long").alias("bin_index"), "bin_label", "n_transcripts", "observed_count", "background_count", R("observed_fraction").alias("observed_fraction"), R("enrichment_log2_odds").alias("enrichment_log2_odds"))


def a26_tails(spark, d):
    return patterns.distance_bins(_classified(spark, d), EDGES, least=20)


def a27(spark, d):
    return patterns.pair_correlation(_classified(spark, d), [0.0, 2.0, 4.0, 8.0])


def a27_observed(spark, d):
    return S.annular_counts(roles.transcripts(spark, d), None, [0.0, 2.0, 4.0], ["gene"]).withColumn("band", F.col("band").cast("long"))


def a28(spark, d):
    points = _classified(spark, d)
    long = patterns.distance_bins(points, EDGES, tails=False).where("boundary = 'cell'")
    names = [patterns.bin_label(i, EDGES) for i in range(len(EDGES) + 1)]
    rows = patterns.widen(points.groupBy("gene").agg(F.count("*").alias("n")), long, F.col("bin_label"), names, {"odds": "enrichment_log2_odds"})
    return rows.select("gene", "n", *(R(c).alias(c) for c in rows.columns if c not in ("gene", "n")))


def _graph(spark, d):
    """A ring of orders: each cell's neighbours are the next two."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("src"))
    n = o.agg(F.count("*").alias("n"))
    return o.crossJoin(F.broadcast(n)).select("src", F.explode(F.array(F.expr("(src + 1) % n"), F.expr("(src + 5) % n"))).alias("dst"))


def a29(spark, d):
    cells = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"))
    values = roles.counts(spark, d).select("cell_id", "gene", F.col("n").cast("double").alias("value"))
    return patterns.autocorrelation(_graph(spark, d), values, cells, tails=False).select("gene", R("moran_i").alias("moran_i"), R("geary_c").alias("geary_c"))


def a29_p(spark, d):
    cells = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"))
    values = roles.counts(spark, d).select("cell_id", "gene", F.col("n").cast("double").alias("value"))
    return patterns.autocorrelation(_graph(spark, d), values, cells)


def a30(spark, d):
    return C.normalized(roles.counts(spark, d)).select("cell_id", "gene", R("value").alias("value"))


def a30_dominant(spark, d):
    return C.dominant_genes(roles.counts(spark, d).where("gene > 'Brand#2'"), 0.9)


def a31(spark, d):
    n = table(spark, d, "orders").agg(F.count("*").alias("n"))
    return C.variances(roles.counts(spark, d), n).orderBy(F.desc("variance"), "gene").limit(10).select("gene", R("variance", 8).alias("variance"))


def _sections(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.expr("CAST(o_custkey * 7 % 300 AS DOUBLE)").alias("x"), F.expr("CAST(o_orderkey * 3 % 200 AS DOUBLE)").alias("y"))
    return o.where("cell_id % 2 = 0"), o.where("cell_id % 2 = 1").withColumn("x", F.col("x") + 16)


def _means(spark, d):
    f, m = align.with_grid(*_sections(spark, d), 4, 5)
    counts = roles.counts(spark, d)
    return align.shared_means(align.grid_means(f, counts), align.grid_means(m, counts), f, m, counts.select("gene").distinct())


def a33(spark, d):
    return _means(spark, d).select("grid", "gene", R("f").alias("f"), R("m").alias("m"))


def a34(spark, d):
    # Means are rounded first: a bin's edge must not hang on the last bit of a sum.
    rows = align.grid_metrics(_means(spark, d).withColumns({"f": R("f"), "m": R("m")}))
    return rows.select("n_overlap_grids", *(R(c, 5).alias(c) for c in ("grid_cosine", "gene_grid_pearson", "grid_mutual_information")))


def a34_assd(spark, d):
    a, b = (s.select(F.col("cell_id").alias("id"), "x", "y") for s in _sections(spark, d))
    return align.mean_nearest(a, b).withColumn("centroid_assd", R("centroid_assd"))


def a35(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", F.expr("CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal / 10000e0 END").alias("p"), F.expr("s_nationkey / 25e0").alias("c"), F.expr("s_suppkey / 100e0").alias("mi"), F.expr("s_acctbal").alias("a"))
    return rows.select("s_suppkey", R(align.score(*(F.col(c) for c in ("p", "c", "mi", "a"))), 9).alias("score")).orderBy(F.desc("score"), "s_suppkey").limit(1)


def _matches(spark, d):
    return roles.cells(spark, d).select(F.col("cx").alias("x"), F.col("cy").alias("y"), (F.col("cx") * 0.5 + F.col("half") - 8).alias("u"), (F.col("cy") * 2 - F.col("half")).alias("v"))


def a36(spark, d):
    return align.affine_sums(_matches(spark, d))


def a36_fit(spark, d):
    m = align.fit_affine(_matches(spark, d))
    moved = P.affine(F.col("x"), F.col("y"), m)
    return _matches(spark, d).agg(R(F.avg(F.abs(moved[0] - F.col("u"))), 4).alias("mean_error_u"), R(F.avg(F.abs(moved[1] - F.col("v"))), 4).alias("mean_error_v"))


def a37(spark, d):
    rows = align.displacement_summary(_matches(spark, d))
    return rows.select(*(R(c).alias(c) for c in rows.columns))


def a37_support(spark, d):
    """Share of one section's cells beyond five median gaps of the other section's, the anchors."""
    anchors = roles.cells(spark, d).where("instance_id % 2 = 0").groupBy(F.col("cx").alias("tx"), F.col("cy").alias("ty")).agg(F.min("instance_id").alias("other"))  # cells may share a place
    gaps = S.nearest_points(anchors.select(F.col("other").alias("id"), F.col("tx").alias("x"), F.col("ty").alias("y")), anchors, "id", "other", 1, skip_same=True)
    radius = gaps.where("distance > 0").agg((F.median("distance") * 5).alias("radius"))
    near = S.nearest_points(roles.cells(spark, d).where("instance_id % 2 = 1").select("instance_id", F.col("cx").alias("x"), F.col("cy").alias("y")), anchors, "instance_id", "other")
    return near.crossJoin(F.broadcast(radius)).agg(R(F.first("radius")).alias("radius"), R(F.avg((F.col("distance") > F.col("radius")).cast("double"))).alias("extrapolated"))


def a38(spark, d):
    return align.density(roles.transcripts(spark, d), 12, 9, 0.0, 480.0, 20.0, 500.0)


def a39(spark, d):
    methods = {"background": ~F.col("background"), "numeric": F.col("assignment") % 2 == 0}
    return reports.assignment_rates(roles.transcripts(spark, d), methods, ["platform"]).withColumn("rate", R("rate"))


def a40(spark, d):
    lines = table(spark, d, "supplier").select(F.expr("s_acctbal + 1100e0").alias("thickness"), F.expr("s_suppkey % 4 = 0").alias("failed"))
    return reports.depth_summary(lines).withColumn("median_thickness", R("median_thickness"))


def a41(spark, d):
    rows = table(spark, d, "lineitem").select(F.expr("CASE WHEN l_shipdate IS NULL OR l_linenumber = 7 THEN 'unassigned' ELSE l_returnflag END").alias("label"), F.expr("l_quantity / 50e0").alias("p"), F.expr("l_discount * 10e0").alias("r"))
    out = reports.confidence(rows, "label", "p", "r")
    return out.select("label", "n", *(R(c).alias(c) for c in out.columns[2:]))


def a42(spark, d):
    rows = table(spark, d, "customer")
    return reports.value_counts(rows, reports.plottable_column(rows, ["c_custkey", "c_nationkey", "c_mktsegment"]))


def a43(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey")).join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    return reports.region_leaves(rows, "r_name", ["ASIA", "EUROPE"], ["n_name", "c_mktsegment"], 3)


def a44(spark, d):
    return reports.metadata_groups(table(spark, d, "part"), "p_type", F.expr("regexp_extract(p_brand, '#([0-9])', 1)"), ["p_name", "p_brand"], "ring|#2")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def a45(spark, d):
    return reports.count_pivot(table(spark, d, "customer"), "c_nationkey", "c_mktsegment", _SEGMENTS)


def _cpm(spark, d):
    t = roles.transcripts(spark, d).groupBy("platform", "gene").agg(F.count("*").alias("n"))
    bulk = table(spark, d, "part").where("p_brand <> 'Brand#5'").groupBy(F.col("p_brand").alias("gene")).agg(F.avg("p_retailprice").alias("tpm"))
    return C.share(t, "n", ["platform"]).withColumn("cpm", F.col("share") * 1e6).join(bulk, "gene")


def a46(spark, d):
    return _cpm(spark, d).select("platform", "gene", R("cpm").alias("cpm"), R("tpm").alias("tpm"))


def a47(spark, d):
    rows = _cpm(spark, d).withColumn("tpm", R("tpm", 4)).withColumns({"rc": stats.average_rank("n", ["platform"]), "rt": stats.average_rank("tpm", ["platform"])})
    return rows.groupBy("platform").agg(F.count("*").alias("n"), R(F.corr("rc", "rt")).alias("spearman"))


def a48(spark, d):
    rows = table(spark, d, "part").select(F.col("p_retailprice").alias("v"), F.col("p_size").cast("double").alias("w"))
    return reports.quantile_bins(rows, "v", "w").select("bin", "n", R("r").alias("r"), R("sd").alias("sd"))


def a49(spark, d):
    rows = roles.transcripts(spark, d).join(roles.cell_class(spark, d), "cell_id")
    return reports.paired_t(rows, "pair_id", "platform", "qv", "MERSCOPE", "XENIUM").select("n", R("mean_difference").alias("mean_difference"), R("t", 4).alias("t"))


def a50(spark, d):
    from punctata.operators.labels import adjusted_rand

    rows = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("a"), F.expr("c_nationkey % 4").alias("b"))
    return adjusted_rand(rows, "a", "b").withColumn("ari", R("ari", 8))


def a50_sizes(spark, d):
    sizes = table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("n_clusters"), F.min("n").alias("smallest"), F.median("n").alias("median_size"), F.max("n").alias("largest"))


def a51(spark, d):
    t = roles.transcripts_by_cell(spark, d)
    a, b = (t.where(c).groupBy("cell_id", "gene").agg(F.count("*").alias("n")) for c in ("qv >= 10", "NOT background"))
    return C.table_diff(a, b)


def a53(spark, d):
    """Counts for two shape layers in one job, beside a layer that keeps its own table."""
    layers = None
    for name in ("cells", "nuclei"):
        part = getattr(roles, name)(spark, d).withColumn("layer", F.lit(name))
        layers = part if layers is None else layers.unionByName(part)
    counted = S.counts_in_shapes(roles.transcripts(spark, d), S.with_outline(layers, roles.ring()), ["layer", "instance_id"], ["gene"]).withColumn("mode", F.lit("counted"))
    reused = roles.counts(spark, d).select(F.lit("own").alias("layer"), (F.col("cell_id") + 1).alias("instance_id"), "gene", "n", F.lit("reused").alias("mode"))
    return counted.unionByName(reused).groupBy("layer", "mode").agg(F.countDistinct("instance_id").alias("n_shapes"), F.sum("n").alias("total"), F.countDistinct("gene").alias("n_genes"))


def w01(spark, d):
    rows = table(spark, d, "part").groupBy(F.col("p_brand").alias("gene")).agg(F.avg("p_retailprice").alias("price"), F.sum("p_size").cast("double").alias("size"))
    long = rows.unpivot(["gene"], ["price", "size"], "metric", "value").where(F.col("value").isNotNull())
    out = None
    for way, order in (("top", F.desc("value")), ("bottom", F.asc("value"))):
        r = F.row_number().over(Window.partitionBy("metric").orderBy(order, "gene"))
        part = long.withColumn("rank", r).where("rank <= 5").withColumn("direction", F.lit(way))
        out = part if out is None else out.unionByName(part)
    return out.select("metric", "direction", F.col("rank").cast("long").alias("rank"), "gene")


def w02(spark, d):
    return table(spark, d, "part").select("p_partkey", stats.average_rank("p_size", ["p_brand"]).alias("rank"))


def w03(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", F.expr("s_nationkey % 3").alias("family"), F.expr("CASE WHEN s_suppkey % 6 > 0 THEN round((s_suppkey % 13) * (s_suppkey % 13) / 200e0, 4) END").alias("p"))
    return stats.benjamini_hochberg(rows, "p", ["family"]).select("s_suppkey", R("q").alias("q"))


def w04(spark, d):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    rows = table(spark, d, "part").withColumns({"k": F.row_number().over(w), "runner_up": F.lead("p_partkey").over(w), "next": F.lead("p_retailprice").over(w)})
    return rows.where("k = 1").select("p_brand", F.col("p_partkey").alias("best"), "runner_up", R(F.col("p_retailprice") - F.col("next")).alias("margin"))


QUERIES = {
    "a01_gene_totals": a01, "a02_cell_metrics_points": a02, "a03_cell_metrics_counts": a03, "a04_dataset_summary": a04, "a05_polygon_geometry": a05, "a06_share": a06, "a07_log_fit": a07, "a08_gene_comparison": a08,
    "a09_cell_gene_counts": a09, "a10_control_qc": a10, "a11_group_gene_summary": a11, "a12_gene_z": a12, "a13_cluster_labels": a13, "a13_label_scores": a13_scores, "a14_split_marker_sets": a14,
    "a15_detection_fractions": a15, "a15_unique_markers": a15_markers, "a16_rank_sums": a16, "a16_wilcoxon_p": a16_p, "a17_panel_reference": a17, "a18_mecr_pairs": a18, "a19_mecr_summary": a19, "a20_class_pair_medians": a20,
    "a21_platform_pivot": a21, "a22_pseudobulk": a22, "a23_complete_pairs": a23, "a24_size_factors": a24, "a24_paired_test": a24_test, "a24_paired_p": a24_p, "a25_compartments": a25, "a25_compartment_tails": a25_tails,
    "a26_distance_bins": a26, "a26_distance_bin_tails": a26_tails, "a27_pair_correlation": a27, "a27_observed_pairs": a27_observed, "a28_wide_gene_table": a28, "a29_autocorrelation": a29, "a29_autocorrelation_p": a29_p,
    "a30_normalized": a30, "a30_dominant_genes": a30_dominant, "a31_variable_genes": a31, "a33_grid_means": a33, "a34_grid_metrics": a34, "a34_assd": a34_assd, "a35_candidate_score": a35, "a36_affine_sums": a36, "a36_affine_fit": a36_fit,
    "a37_displacement": a37, "a37_support": a37_support, "a38_density": a38, "a39_assignment_rate": a39, "a40_depth_summary": a40, "a41_confidence": a41, "a42_plottable_column": a42, "a43_region_filter": a43, "a44_metadata_groups": a44,
    "a45_count_pivot": a45, "a46_cpm": a46, "a47_spearman": a47, "a48_quantile_bins": a48, "a49_paired_t": a49, "a50_rand_index": a50, "a50_cluster_sizes": a50_sizes, "a51_table_diff": a51, "a52_low_overlap_pairs": a52, "a53_shape_layers": a53,
    "j22_gene_pairs": lambda spark, d: _pairs(spark, d).select("platform", "gene_1", "gene_2", "cells_both"), "t02_barnyard_pairs": t02, "w01_ranks": w01, "w02_average_rank": w02, "w03_benjamini_hochberg": w03, "w04_best_and_runner_up": w04,
}

_TOT = lambda where: f"""g AS (SELECT platform, CASE WHEN feature_type = 'PROMO' AND platform = 'XENIUM' THEN 'Blank' || gene ELSE gene END AS gene FROM transcripts{where}),
    tot AS (SELECT platform, gene, count(*) AS total FROM g WHERE NOT (platform = 'XENIUM' AND contains(gene, 'Blank')) GROUP BY ALL), sh AS (SELECT *, total / sum(total) OVER (PARTITION BY platform) AS share FROM tot),
    b AS (SELECT m.gene, m.total AS tm, x.total AS tx, m.share AS sm, x.share AS sx FROM sh m JOIN sh x ON m.gene = x.gene AND m.platform = 'MERSCOPE' AND x.platform = 'XENIUM')"""  # noqa: E731
_FIT = lambda a, b: f"round(regr_slope(log10({b}), log10({a})), 6) AS slope, round(regr_intercept(log10({b}), log10({a})), 6) AS intercept, round(regr_r2(log10({b}), log10({a})), 6) AS r2"
_EIGHT = lambda kind, where: f"""SELECT '{kind}' AS kind, s.* FROM (WITH {_TOT(where)} SELECT 'total' AS scale, count(*) AS n_genes, CAST(sum(tm) AS DOUBLE) AS sum_merscope, CAST(sum(tx) AS DOUBLE) AS sum_xenium, {_FIT('tm', 'tx')} FROM b
    UNION ALL SELECT 'share', count(*), round(sum(sm), 6), round(sum(sx), 6), {_FIT('sm', 'sx')} FROM b) s"""  # noqa: E731
_GROUPS = """g AS (SELECT cell_id, broad_class AS grp FROM cell_class), sz AS (SELECT grp, count(*) AS n_cells FROM g GROUP BY 1),
    gg AS (SELECT grp, gene, sum(n) AS s, count(*) AS k FROM counts JOIN g USING (cell_id) GROUP BY ALL)"""
_ZSQL = f"""{_GROUPS}, me AS (SELECT sz.grp, u.gene, coalesce(s, 0) / n_cells AS mean FROM sz CROSS JOIN (SELECT DISTINCT gene FROM gg) u LEFT JOIN gg ON gg.grp = sz.grp AND gg.gene = u.gene),
    zs AS (SELECT grp, gene, mean, (mean - avg(mean) OVER w) / (CASE WHEN stddev_pop(mean) OVER w = 0 THEN 1 ELSE stddev_pop(mean) OVER w END) AS z FROM me WINDOW w AS (PARTITION BY gene))"""
_SCORES = f"""{_ZSQL}, mk AS (SELECT r_name AS label, {_MARKER_TEXT.format(s='VARCHAR')} AS gene FROM nation JOIN region ON n_regionkey = r_regionkey),
    sc AS (SELECT grp, label, avg(z) AS score, count(*) AS n_markers, string_agg(gene, ';' ORDER BY gene) AS resolved_markers FROM zs JOIN mk USING (gene) GROUP BY ALL HAVING count(*) >= 3)"""
_FRACTIONS = """sz AS (SELECT broad_class, count(*) AS nt FROM cell_class GROUP BY 1), h AS (SELECT broad_class, gene, count(DISTINCT cell_id) AS k FROM counts JOIN cell_class USING (cell_id) GROUP BY ALL), ga AS (SELECT gene, sum(k) AS a FROM h GROUP BY 1), nn AS (SELECT sum(nt) AS n FROM sz),
    fr AS (SELECT sz.broad_class, ga.gene, coalesce(k, 0) / nt AS tf, (a - coalesce(k, 0)) / (n - nt) AS f2, nt, CAST(n - nt AS BIGINT) AS no FROM sz CROSS JOIN ga CROSS JOIN nn LEFT JOIN h ON h.broad_class = sz.broad_class AND h.gene = ga.gene)"""
_PAIRS = """pc AS (SELECT platform, cell_id, gene, count(*) AS n FROM transcripts GROUP BY ALL), mk AS (SELECT DISTINCT p_brand AS gene, 'c' || right(p_brand, 1) AS cls FROM part WHERE p_brand <> 'Brand#7'),
    h AS (SELECT platform, cell_id, gene, cls FROM pc JOIN mk USING (gene)), dt AS (SELECT platform, gene, cls, count(*) AS d FROM h GROUP BY ALL),
    bo AS (SELECT a.platform, a.gene AS g1, b.gene AS g2, count(*) AS k FROM h a JOIN h b ON a.platform = b.platform AND a.cell_id = b.cell_id AND a.gene < b.gene AND a.cls <> b.cls GROUP BY ALL),
    pr AS (SELECT a.platform, a.gene AS gene_1, a.cls AS class_1, a.d AS cells_gene_1, b.gene AS gene_2, b.cls AS class_2, b.d AS cells_gene_2, coalesce(k, 0) AS cells_both, a.d + b.d - coalesce(k, 0) AS cells_either, coalesce(k, 0) / (a.d + b.d - coalesce(k, 0)) AS mecr
    FROM dt a JOIN dt b ON a.platform = b.platform AND a.gene < b.gene AND a.cls <> b.cls LEFT JOIN bo ON bo.platform = a.platform AND g1 = a.gene AND g2 = b.gene)"""
_BULK = f"""ce AS (SELECT cell_id, broad_class AS tissue, pair_id, {_BANDS} AS proximity FROM cell_class JOIN orders ON o_orderkey = cell_id), us AS (SELECT * FROM ce WHERE tissue IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND proximity IN ('near', 'far')),
    gr AS (SELECT pair_id, proximity, count(*) AS cell_count FROM us GROUP BY ALL HAVING count(*) >= 5), bk AS (SELECT pair_id, proximity, gene, CAST(sum(n) AS BIGINT) AS n, any_value(cell_count) AS cell_count FROM counts JOIN us USING (cell_id) JOIN gr USING (pair_id, proximity) GROUP BY ALL),
    gm AS (SELECT gene, avg(ln(n)) AS g FROM bk GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT pair_id, proximity FROM bk))), sf AS (SELECT pair_id, proximity, exp(median(ln(n) - g)) AS size_factor FROM bk JOIN gm USING (gene) GROUP BY ALL)"""
_CLASSIFIED = """cl AS (SELECT transcript_id, gene, x, y, x % 8e0 - 4e0 AS cd, x % 8e0 - 6e0 AS nd, CASE WHEN x % 8e0 - 4e0 > 2 THEN 'nuclear' WHEN x % 8e0 - 4e0 > 0 THEN 'cytoplasmic' ELSE 'extracellular' END AS comp, transcript_id % 4 AS n_cells, transcript_id % 3 AS n_nuclei FROM numbered)"""
_ODDS = lambda a, g, b, n: f"log2((({a} + 0.5e0) * ({n} - {b} - ({g} - {a}) + 0.5e0)) / (({b} - {a} + 0.5e0) * ({g} - {a} + 0.5e0)))"
_COMPS = lambda f: ", ".join(f(c) for c in patterns.COMPARTMENTS)
_BIN = "(CASE WHEN v >= -2 THEN 1 ELSE 0 END + CASE WHEN v >= 0 THEN 1 ELSE 0 END + CASE WHEN v >= 1.5 THEN 1 ELSE 0 END + CASE WHEN v >= 3 THEN 1 ELSE 0 END)"
_BINS = f"""{_CLASSIFIED}, lo AS (SELECT gene, 'cell' AS boundary, cd AS v FROM cl UNION ALL SELECT gene, 'nucleus', nd FROM cl), se AS (SELECT gene, boundary, {_BIN} AS bin_index, count(*) AS k FROM lo GROUP BY ALL),
    ge AS (SELECT gene, boundary, CAST(sum(k) AS BIGINT) AS n_transcripts FROM se GROUP BY ALL), sp AS (SELECT ge.*, i AS bin_index FROM ge, range(5) r(i)), fu AS (SELECT sp.*, coalesce(k, 0) AS oc FROM sp LEFT JOIN se USING (gene, boundary, bin_index)),
    al AS (SELECT *, CAST(sum(oc) OVER (PARTITION BY boundary, bin_index) AS BIGINT) AS bc, CAST(sum(oc) OVER (PARTITION BY boundary) AS BIGINT) AS nn, ['lt_neg2um', 'neg2_0um', '0_1p5um', '1p5_3um', 'ge_3um'][bin_index + 1] AS bin_label FROM fu)"""
_MEANS = """o AS (SELECT o_orderkey AS cell_id, CAST(o_custkey * 7 % 300 AS DOUBLE) AS x, CAST(o_orderkey * 3 % 200 AS DOUBLE) AS y FROM orders), sec AS (SELECT cell_id, cell_id % 2 AS side, CASE WHEN cell_id % 2 = 1 THEN x + 16 ELSE x END AS x, y FROM o),
    ex AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM sec), gd AS (SELECT cell_id, side, CAST(least(floor((y - y0) / ((y1 - y0) / 4)), 3) AS BIGINT) * 5 + CAST(least(floor((x - x0) / ((x1 - x0) / 5)), 4) AS BIGINT) AS grid FROM sec, ex),
    gs AS (SELECT side, grid, count(*) AS c FROM gd GROUP BY ALL), gm AS (SELECT side, grid, gene, sum(n) AS s FROM counts JOIN gd USING (cell_id) GROUP BY ALL), sq AS (SELECT a.grid, a.c AS cf, b.c AS cm FROM gs a JOIN gs b ON a.grid = b.grid AND a.side = 0 AND b.side = 1),
    me AS (SELECT sq.grid, u.gene, coalesce(f.s, 0) / cf AS f, coalesce(m.s, 0) / cm AS m FROM sq CROSS JOIN (SELECT DISTINCT gene FROM counts) u LEFT JOIN gm f ON f.side = 0 AND f.grid = sq.grid AND f.gene = u.gene LEFT JOIN gm m ON m.side = 1 AND m.grid = sq.grid AND m.gene = u.gene)"""
_MATCH = "ma AS (SELECT cx AS x, cy AS y, cx * 0.5e0 + half - 8 AS u, cy * 2 - half AS v FROM cells)"
_CPM = """t AS (SELECT platform, gene, count(*) AS n FROM transcripts GROUP BY ALL), bu AS (SELECT p_brand AS gene, avg(p_retailprice) AS tpm FROM part WHERE p_brand <> 'Brand#5' GROUP BY 1), cp AS (SELECT platform, gene, n, cpm, tpm FROM (SELECT *, n / sum(n) OVER (PARTITION BY platform) * 1e6 AS cpm FROM t) JOIN bu USING (gene))"""

ORACLES = {
    "a01_gene_totals": sql("transcripts counts", "SELECT gene, count(*) AS total, 'points' AS source FROM transcripts GROUP BY 1 UNION ALL SELECT gene, count(*), 'assigned' FROM transcripts WHERE assignment IS NOT NULL GROUP BY 1 UNION ALL SELECT gene, CAST(sum(n) AS BIGINT), 'counts' FROM counts GROUP BY 1"),
    "a02_cell_metrics_points": sql("transcripts", "SELECT assignment, count(*) AS n_transcripts, count(DISTINCT gene) AS n_genes FROM transcripts WHERE NOT background GROUP BY 1"),
    "a03_cell_metrics_counts": sql("counts", "SELECT o_orderkey AS cell_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_transcripts, count(gene) AS n_genes FROM orders LEFT JOIN counts ON cell_id = o_orderkey GROUP BY 1"),
    "a04_dataset_summary": sql("transcripts", """c AS (SELECT assignment, count(*) AS t, count(DISTINCT gene) AS g FROM transcripts WHERE NOT background GROUP BY 1), s AS (SELECT count(*) AS n_cells, CAST(median(t) AS DOUBLE) AS median_transcripts, CAST(median(g) AS DOUBLE) AS median_genes FROM c)
        SELECT count(*) AS n_total, count(*) FILTER (NOT background) AS n_assigned, any_value(n_cells) AS n_cells, any_value(median_transcripts) AS median_transcripts, any_value(median_genes) AS median_genes, count(*) FILTER (NOT background) * 100e0 / count(*) AS pct_assigned FROM transcripts, s"""),
    "a05_polygon_geometry": sql("cells", """SELECT instance_id, round(4 * half * half, 6) AS area, round(8 * half, 6) AS perimeter, round(4 * half * half, 6) AS convex_area, round(pi() / 4, 6) AS circularity, 1e0 AS solidity, round(sqrt(1 - l2 / l1), 6) AS eccentricity, round(sqrt(l1 / l2), 6) AS aspect, round(log10(4 * half * half), 6) AS log10_area
        FROM (SELECT *, (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS l1, (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS l2 FROM (SELECT instance_id, half, half * half * 1.2e0 AS a, half * half * 1.2e0 AS b, half * half * 0.2e0 AS c FROM cells))"""),
    "a06_share": sql("transcripts", f"{_TOT('')} SELECT platform, gene, round(share, 9) AS share FROM sh"),
    "a07_log_fit": sql("transcripts", f"{_TOT('')} SELECT {_FIT('tm', 'tx')} FROM b"),
    "a08_gene_comparison": sql("transcripts", f"{_EIGHT('total', '')} UNION ALL {_EIGHT('assigned', ' WHERE assignment IS NOT NULL')}"),
    "a09_cell_gene_counts": sql("transcripts", "l AS (SELECT assignment, gene, count(*) AS n FROM transcripts WHERE assignment IS NOT NULL AND gene <> 'Brand#3' GROUP BY ALL) SELECT o_orderkey AS cell_id, gene, n FROM orders LEFT JOIN l ON assignment = o_orderkey"),
    "a10_control_qc": sql("transcripts", """c AS (SELECT cell_id, count(*) AS t, count(*) FILTER (feature_type = 'PROMO') AS k FROM transcripts GROUP BY 1) SELECT cell_id, k AS control_counts, round(k * 100e0 / t, 6) AS pct_control_counts, round(CASE WHEN o_custkey % 40 > 0 THEN CAST(o_custkey % 7 AS DOUBLE) / (o_custkey % 40) END, 6) AS nucleus_ratio FROM c JOIN orders ON o_orderkey = cell_id"""),
    "a11_group_gene_summary": sql("counts cell_class", f"{_GROUPS} SELECT grp, gene, n_cells, round(s / n_cells, 6) AS mean, round(k / n_cells, 6) AS fraction FROM gg JOIN sz USING (grp)"),
    "a12_gene_z": sql("counts cell_class", f"{_ZSQL} SELECT grp, gene, round(mean, 6) AS mean, round(z, 6) AS z FROM zs"),
    "a13_label_scores": sql("counts cell_class", f"{_SCORES} SELECT grp, label, round(score, 6) AS score, n_markers, resolved_markers FROM sc"),
    "a13_cluster_labels": sql("counts cell_class", f"""{_SCORES}, rk AS (SELECT *, row_number() OVER w AS k, lead(label) OVER w AS runner_up, score - lead(score) OVER w AS margin FROM sc WINDOW w AS (PARTITION BY grp ORDER BY score DESC, label))
        SELECT g.grp, CASE WHEN score IS NULL OR margin < 0.05 THEN 'Mixed/Unknown' ELSE label END AS label, round(score, 6) AS score, runner_up, round(margin, 6) AS margin FROM (SELECT DISTINCT o_orderpriority AS grp FROM orders) g LEFT JOIN (SELECT * FROM rk WHERE k = 1) r ON r.grp = g.grp"""),
    "a14_split_marker_sets": "SELECT split, string_agg(gene, ';' ORDER BY ord) AS genes FROM (SELECT p_partkey % 3 AS split, p_brand AS gene, min(p_partkey) AS ord FROM part GROUP BY ALL) GROUP BY 1",
    "a15_detection_fractions": sql("counts cell_class", f"{_FRACTIONS} SELECT broad_class, gene, round(tf, 6) AS target_fraction, round(f2, 6) AS other_fraction, nt AS n_target, no AS n_other FROM fr"),
    "a15_unique_markers": sql("counts cell_class", f"{_FRACTIONS}, ok AS (SELECT * FROM fr WHERE tf > 0.12e0 AND f2 < 0.116e0) SELECT broad_class, gene FROM ok WHERE gene IN (SELECT gene FROM ok GROUP BY 1 HAVING count(*) = 1)"),
    "a16_rank_sums": sql("counts cell_class", """ge AS (SELECT DISTINCT gene FROM counts JOIN cell_class USING (cell_id)), fu AS (SELECT broad_class, cell_class.cell_id, ge.gene, coalesce(n, 0) AS n FROM cell_class CROSS JOIN ge LEFT JOIN counts ON counts.cell_id = cell_class.cell_id AND counts.gene = ge.gene),
        rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY n) + (count(*) OVER (PARTITION BY gene, n) - 1) / 2 AS r FROM fu), ti AS (SELECT gene, sum(k * k * k - k) AS t, CAST(sum(k) AS DOUBLE) AS nn FROM (SELECT gene, n, CAST(count(*) AS DOUBLE) AS k FROM fu GROUP BY ALL) GROUP BY 1),
        su AS (SELECT broad_class, gene, sum(r) AS rs, CAST(count(*) AS DOUBLE) AS m FROM rk GROUP BY ALL) SELECT broad_class, gene, CAST(rs AS DOUBLE) AS rank_sum, rs - m * (m + 1) / 2 AS u, round((rs - m * (m + 1) / 2 - m * (nn - m) / 2) / sqrt(m * (nn - m) / 12 * (nn + 1 - t / (nn * (nn - 1)))), 6) AS score FROM su JOIN ti USING (gene)"""),
    "a17_panel_reference": sql("counts cell_class", """p AS (SELECT DISTINCT lower(p_brand) AS token FROM part WHERE p_size < 25), z AS (SELECT cell_id, sum(n) AS sz FROM counts GROUP BY 1)
        SELECT cell_id, lower(gene) AS token, round(ln(1 + n * 10000e0 / sz), 6) AS value FROM counts JOIN z USING (cell_id) JOIN cell_class USING (cell_id) WHERE lower(gene) IN (SELECT token FROM p) AND broad_class <> '5-LOW'"""),
    "a18_mecr_pairs": sql("transcripts", f"{_PAIRS} SELECT * REPLACE (round(mecr, 6) AS mecr) FROM pr"),
    "a19_mecr_summary": sql("transcripts", f"{_PAIRS} SELECT platform, round(avg(mecr), 6) AS mecr, round(median(mecr), 6) AS median_pair_mecr, count(*) AS n_eligible_pairs, count(mecr) AS n_scored_pairs, count(*) FILTER (mecr IS NULL) AS n_zero_union_pairs FROM pr GROUP BY 1"),
    "a20_class_pair_medians": sql("transcripts", f"{_PAIRS} SELECT platform, least(class_1, class_2) AS class_a, greatest(class_1, class_2) AS class_b, round(median(mecr), 6) AS mecr FROM pr GROUP BY ALL"),
    "a21_platform_pivot": sql("transcripts", f"{_PAIRS} SELECT m.gene_1, m.gene_2, round(m.mecr, 6) AS merscope, round(x.mecr, 6) AS xenium FROM pr m JOIN pr x ON m.gene_1 = x.gene_1 AND m.gene_2 = x.gene_2 AND m.platform = 'MERSCOPE' AND x.platform = 'XENIUM'"),
    "a52_low_overlap_pairs": sql("transcripts", f"{_PAIRS} SELECT platform, gene_1, gene_2, round(mecr, 6) AS mecr FROM pr WHERE mecr < 0.04e0"),
    "j22_gene_pairs": sql("transcripts", f"{_PAIRS} SELECT platform, gene_1, gene_2, cells_both FROM pr"),
    "t02_barnyard_pairs": sql("transcripts", f"""{_PAIRS}, ag AS (SELECT gene_1, gene_2, avg(mecr) AS mm, CAST(sum(cells_either) AS BIGINT) AS ce FROM pr GROUP BY ALL),
        al AS (SELECT *, 0 AS i, 0e0 AS v FROM ag WHERE (gene_1, gene_2) IN (('Brand#1', 'Brand#2'), ('Brand#12', 'Brand#20')) UNION ALL (SELECT *, 1, -mm FROM ag ORDER BY mm DESC, gene_1, gene_2 LIMIT 3) UNION ALL (SELECT *, 2, -ce FROM ag ORDER BY ce DESC, gene_1, gene_2 LIMIT 6)),
        on1 AS (SELECT *, row_number() OVER (PARTITION BY gene_1, gene_2 ORDER BY i, v) AS k FROM al) SELECT gene_1, gene_2, round(mm, 6) AS mean_mecr, ce AS total_cells_either, ['canonical', 'highest_mean_mecr', 'most_detected'][i + 1] AS reason FROM on1 WHERE k = 1 ORDER BY i, v, gene_1, gene_2 LIMIT 6"""),
    "a22_pseudobulk": sql("counts cell_class", f"{_BULK} SELECT * FROM bk"),
    "a23_complete_pairs": sql("counts cell_class", f"{_BULK} SELECT pair_id FROM bk WHERE NOT (pair_id = 'ASIA' AND proximity = 'far') GROUP BY 1 HAVING count(DISTINCT proximity) = 2"),
    "a24_size_factors": sql("counts cell_class", f"{_BULK} SELECT pair_id, proximity, round(size_factor, 6) AS size_factor FROM sf"),
    "a24_paired_test": sql("counts cell_class", f"""{_BULK}, fu AS (SELECT u.gene, sf.pair_id, sf.proximity, log2(coalesce(n, 0) / size_factor + 0.5e0) AS v FROM sf CROSS JOIN (SELECT DISTINCT gene FROM bk) u LEFT JOIN bk ON bk.gene = u.gene AND bk.pair_id = sf.pair_id AND bk.proximity = sf.proximity),
        dd AS (SELECT gene, pair_id, max(v) FILTER (proximity = 'near') - max(v) FILTER (proximity = 'far') AS d FROM fu GROUP BY ALL) SELECT gene, round(avg(d), 6) AS log2_fold_change, count(d) AS n_pairs, CASE WHEN stddev_samp(d) > 0 THEN round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 4) END AS t FROM dd GROUP BY 1"""),
    "a25_compartments": sql("numbered", f"""{_CLASSIFIED}, r AS (SELECT gene, count(*) AS n_transcripts, {_COMPS(lambda c: f"count(*) FILTER (comp = '{c}') AS n_{c}")}, median(cd) AS median_signed_cell_distance, median(nd) AS median_signed_nucleus_distance,
        round(avg(CASE WHEN cd < 0 AND cd >= -2 THEN 1e0 ELSE 0e0 END), 6) AS fraction_pericellular, round(avg(CASE WHEN comp = 'cytoplasmic' AND cd <= 1 THEN 1e0 ELSE 0e0 END), 6) AS fraction_membrane_proximal, count(*) FILTER (n_cells > 1) AS n_cell_overlap_ambiguous, count(*) FILTER (n_nuclei > 1) AS n_nucleus_overlap_ambiguous FROM cl GROUP BY 1),
        t AS (SELECT sum(n_transcripts) AS nn, {_COMPS(lambda c: f"sum(n_{c}) AS t_{c}")} FROM r) SELECT r.*, n_transcripts >= 50 AS signed_distance_eligible, {_COMPS(lambda c: f"round(n_{c} / n_transcripts, 6) AS fraction_{c}, round({_ODDS(f'n_{c}', 'n_transcripts', f't_{c}', 'nn')}, 6) AS {c}_enrichment_log2_odds")} FROM r, t"""),
    "a26_distance_bins": sql("numbered", f"{_BINS} SELECT gene, boundary, bin_index, bin_label, n_transcripts, oc AS observed_count, bc AS background_count, round(oc / n_transcripts, 6) AS observed_fraction, round({_ODDS('oc', 'n_transcripts', 'bc', 'nn')}, 6) AS enrichment_log2_odds FROM al"),
    "a28_wide_gene_table": sql("numbered", f"""{_BINS}, od AS (SELECT gene, n_transcripts, bin_label, round({_ODDS('oc', 'n_transcripts', 'bc', 'nn')}, 6) AS v FROM al WHERE boundary = 'cell')
        SELECT gene, any_value(n_transcripts) AS n, max(v) FILTER (bin_label = 'lt_neg2um') AS lt_neg2um_odds, max(v) FILTER (bin_label = 'neg2_0um') AS neg2_0um_odds, max(v) FILTER (bin_label = '0_1p5um') AS "0_1p5um_odds", max(v) FILTER (bin_label = '1p5_3um') AS "1p5_3um_odds", max(v) FILTER (bin_label = 'ge_3um') AS ge_3um_odds FROM od GROUP BY 1"""),
    "a27_observed_pairs": sql("numbered", f"""{_CLASSIFIED}, q AS (SELECT a.gene, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cl a JOIN cl b ON a.gene = b.gene AND a.transcript_id < b.transcript_id AND abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4) SELECT gene, CASE WHEN d <= 2 THEN 0 ELSE 1 END AS band, count(*) AS n FROM q WHERE d <= 4 GROUP BY ALL"""),
    "a29_autocorrelation": sql("counts", """nn AS (SELECT count(*) AS n FROM orders), e AS (SELECT o_orderkey AS src, (o_orderkey + s) % n AS dst, 0.5e0 AS w FROM orders, nn, (VALUES (1), (5)) v(s)), ge AS (SELECT gene, sum(n) / (SELECT n FROM nn) AS m FROM counts GROUP BY 1),
        fu AS (SELECT o_orderkey AS id, ge.gene, coalesce(n, 0) - m AS z FROM orders CROSS JOIN ge LEFT JOIN counts ON cell_id = o_orderkey AND counts.gene = ge.gene), va AS (SELECT gene, sum(z * z) AS v FROM fu GROUP BY 1),
        cr AS (SELECT a.gene, sum(w * a.z * b.z) AS c, sum(w * (a.z - b.z) * (a.z - b.z)) AS s FROM e JOIN fu a ON a.id = src JOIN fu b ON b.id = dst AND a.gene = b.gene GROUP BY 1), ww AS (SELECT sum(w) AS w FROM e)
        SELECT gene, round(n / w * c / v, 6) AS moran_i, round((n - 1) / (2 * w) * s / v, 6) AS geary_c FROM cr JOIN va USING (gene), nn, ww WHERE v > 0"""),
    "a30_normalized": sql("counts", "z AS (SELECT cell_id, sum(n) AS sz FROM counts GROUP BY 1) SELECT cell_id, gene, round(ln(1 + n * (SELECT median(sz) FROM z) / sz), 6) AS value FROM counts JOIN z USING (cell_id)"),
    "a30_dominant_genes": sql("counts", "c AS (SELECT * FROM counts WHERE gene > 'Brand#2'), z AS (SELECT cell_id, sum(n) AS sz FROM c GROUP BY 1) SELECT DISTINCT gene FROM c JOIN z USING (cell_id) WHERE n > 0.9e0 * sz"),
    "a31_variable_genes": sql("counts", "nn AS (SELECT count(*) AS c FROM orders) SELECT gene, round(sum(n * n) / any_value(c) - (sum(n) / any_value(c)) * (sum(n) / any_value(c)), 8) AS variance FROM counts, nn GROUP BY 1 ORDER BY sum(n * n) / any_value(c) - (sum(n) / any_value(c)) * (sum(n) / any_value(c)) DESC, gene LIMIT 10"),
    "a33_grid_means": sql("counts", f"{_MEANS} SELECT grid, gene, round(f, 6) AS f, round(m, 6) AS m FROM me"),
    "a34_grid_metrics": sql("counts", f"""{_MEANS}, rd AS (SELECT grid, gene, round(f, 6) AS f, round(m, 6) AS m FROM me), ps AS (SELECT avg(r) AS r FROM (SELECT CASE WHEN stddev_pop(f) > 0 AND stddev_pop(m) > 0 THEN corr(f, m) END AS r FROM rd GROUP BY gene)),
        co AS (SELECT avg(c) AS c, count(*) AS n FROM (SELECT CASE WHEN sqrt(sum(f * f)) * sqrt(sum(m * m)) > 0 THEN sum(f * m) / (sqrt(sum(f * f)) * sqrt(sum(m * m))) END AS c FROM rd GROUP BY grid)),
        ed AS (SELECT gene, CASE WHEN max(f) > min(f) THEN min(f) ELSE min(f) - 0.5e0 END AS f0, CASE WHEN max(f) > min(f) THEN max(f) ELSE max(f) + 0.5e0 END AS f1, CASE WHEN max(m) > min(m) THEN min(m) ELSE min(m) - 0.5e0 END AS m0, CASE WHEN max(m) > min(m) THEN max(m) ELSE max(m) + 0.5e0 END AS m1 FROM rd GROUP BY 1),
        bi AS (SELECT gene, least(floor((f - f0) / ((f1 - f0) / 16)), 15) AS bf, least(floor((m - m0) / ((m1 - m0) / 16)), 15) AS bm, count(*) AS k FROM rd JOIN ed USING (gene) GROUP BY ALL),
        tm AS (SELECT gene, k / n * ln(k * n / (pf * pm)) AS t FROM (SELECT gene, CAST(k AS DOUBLE) AS k, CAST(sum(k) OVER (PARTITION BY gene) AS DOUBLE) AS n, CAST(sum(k) OVER (PARTITION BY gene, bf) AS DOUBLE) AS pf, CAST(sum(k) OVER (PARTITION BY gene, bm) AS DOUBLE) AS pm FROM bi)), mi AS (SELECT avg(t) AS t FROM (SELECT sum(t) AS t FROM tm GROUP BY gene))
        SELECT n AS n_overlap_grids, round(c, 5) AS grid_cosine, round(r, 5) AS gene_grid_pearson, round(t, 5) AS grid_mutual_information FROM ps, co, mi"""),
    "a34_assd": """WITH o AS (SELECT o_orderkey AS id, CAST(o_custkey * 7 % 300 AS DOUBLE) AS x, CAST(o_orderkey * 3 % 200 AS DOUBLE) AS y FROM orders), m AS (SELECT a.id AS a, b.id AS b, sqrt((a.x - b.x - 16) * (a.x - b.x - 16) + (a.y - b.y) * (a.y - b.y)) AS d FROM o a JOIN o b ON a.id % 2 = 0 AND b.id % 2 = 1)
        SELECT round(((SELECT avg(d) FROM (SELECT min(d) AS d FROM m GROUP BY a)) + (SELECT avg(d) FROM (SELECT min(d) AS d FROM m GROUP BY b))) / 2, 6) AS centroid_assd""",
    "a35_candidate_score": "SELECT s_suppkey, round(CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal / 10000e0 ELSE 0e0 END + s_nationkey / 25e0 + 0.1e0 * (s_suppkey / 100e0) - 0.001e0 * s_acctbal, 9) AS score FROM supplier ORDER BY score DESC, s_suppkey LIMIT 1",
    "a36_affine_sums": sql("cells", f"{_MATCH} SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy, sum(u) AS su, sum(v) AS sv, sum(x * u) AS sxu, sum(y * u) AS syu, sum(x * v) AS sxv, sum(y * v) AS syv FROM ma"),
    "a37_displacement": sql("cells", f"{_MATCH} SELECT round(min(d), 6) AS min, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95, round(max(d), 6) AS max FROM (SELECT sqrt((u - x) * (u - x) + (v - y) * (v - y)) AS d FROM ma)"),
    "a37_support": sql("cells", """an AS (SELECT min(instance_id) AS id, cx, cy FROM cells WHERE instance_id % 2 = 0 GROUP BY cx, cy), gp AS (SELECT min(sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))) AS d FROM an a JOIN an b ON a.id <> b.id GROUP BY a.id), ra AS (SELECT median(d) * 5 AS r FROM gp WHERE d > 0),
        nr AS (SELECT min(sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))) AS d FROM cells a, an b WHERE a.instance_id % 2 = 1 GROUP BY a.instance_id) SELECT round(any_value(r), 6) AS radius, round(avg(CASE WHEN d > r THEN 1e0 ELSE 0e0 END), 6) AS extrapolated FROM nr, ra"""),
    "a38_density": sql("transcripts", "SELECT CAST(least(floor(x / 40e0), 11) AS BIGINT) AS bx, CAST(least(floor((y - 20) / (480e0 / 9)), 8) AS BIGINT) AS by, count(*) AS n FROM transcripts WHERE x BETWEEN 0 AND 480 AND y BETWEEN 20 AND 500 GROUP BY ALL"),
    "a39_assignment_rate": sql("transcripts", "r AS (SELECT platform, 'background' AS method, count(*) AS n, count(*) FILTER (NOT background) AS n_assigned FROM transcripts GROUP BY 1 UNION ALL SELECT platform, 'numeric', count(*), count(*) FILTER (assignment % 2 = 0) FROM transcripts GROUP BY 1) SELECT *, round(n_assigned / n, 6) AS rate FROM r"),
    "a40_depth_summary": """WITH l AS (SELECT s_acctbal + 1100e0 AS t, s_suppkey % 4 = 0 AS f FROM supplier), m AS (SELECT median(t) AS m FROM l) SELECT count(*) AS n, count(*) FILTER (f) AS n_failed, round(any_value(m), 6) AS median_thickness, avg(CASE WHEN f THEN 1e0 ELSE 0e0 END) > 0.2e0 AS warn_failed, avg(CASE WHEN t < m * 0.5e0 OR t > m * 2 THEN 1e0 ELSE 0e0 END) > 0.1e0 AS warn_thickness FROM l, m""",
    "a41_confidence": """SELECT label, count(*) AS n, round(quantile_cont(p, 0.1), 6) AS q10, round(quantile_cont(p, 0.25), 6) AS q25, round(quantile_cont(p, 0.5), 6) AS q50, round(quantile_cont(p, 0.75), 6) AS q75, round(quantile_cont(p, 0.9), 6) AS q90, round(avg(CASE WHEN p < 0.7e0 THEN 1e0 ELSE 0e0 END), 6) AS low_probability_share, round(avg(CASE WHEN r < 0.3e0 THEN 1e0 ELSE 0e0 END), 6) AS low_correlation_share
        FROM (SELECT CASE WHEN l_shipdate IS NULL OR l_linenumber = 7 THEN 'unassigned' ELSE l_returnflag END AS label, l_quantity / 50e0 AS p, l_discount * 10e0 AS r FROM lineitem) GROUP BY 1""",
    "a42_plottable_column": "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1",
    "a43_region_filter": "SELECT n_name, c_mktsegment, count(*) AS n_cells, count(*) >= 3 AS kept FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL",
    "a44_metadata_groups": "SELECT p_type, count(*) AS n, string_agg(DISTINCT regexp_extract(p_brand, '#([0-9])', 1), ';' ORDER BY regexp_extract(p_brand, '#([0-9])', 1)) AS terms, count(*) FILTER (regexp_matches(p_name || ' ' || p_brand, 'ring|#2')) AS n_found FROM part GROUP BY 1",
    "a45_count_pivot": f"SELECT c_nationkey, {', '.join(f'count(*) FILTER (c_mktsegment = {chr(39)}{s}{chr(39)}) AS {s.lower()}' for s in _SEGMENTS)}, count(*) AS total FROM customer GROUP BY 1",
    "a46_cpm": sql("transcripts", f"{_CPM} SELECT platform, gene, round(cpm, 6) AS cpm, round(tpm, 6) AS tpm FROM cp"),
    "a47_spearman": sql("transcripts", f"""{_CPM}, rd AS (SELECT platform, n, round(tpm, 4) AS tpm FROM cp), rk AS (SELECT platform, rank() OVER (PARTITION BY platform ORDER BY n) + (count(*) OVER (PARTITION BY platform, n) - 1) / 2 AS rc, rank() OVER (PARTITION BY platform ORDER BY tpm) + (count(*) OVER (PARTITION BY platform, tpm) - 1) / 2 AS rt FROM rd) SELECT platform, count(*) AS n, round(corr(rc, rt), 6) AS spearman FROM rk GROUP BY 1"""),
    "a48_quantile_bins": """WITH r AS (SELECT p_retailprice AS v, CAST(p_size AS DOUBLE) AS w FROM part), q AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c FROM r) SELECT CASE WHEN v <= a THEN 0 WHEN v <= b THEN 1 WHEN v <= c THEN 2 ELSE 3 END AS bin, count(*) AS n, round(corr(v, w), 6) AS r, round(stddev_samp(w), 6) AS sd FROM r, q GROUP BY 1""",
    "a49_paired_t": sql("transcripts cell_class", "p AS (SELECT pair_id, platform, avg(qv) AS m FROM transcripts JOIN cell_class USING (cell_id) GROUP BY ALL), d AS (SELECT max(m) FILTER (platform = 'XENIUM') - max(m) FILTER (platform = 'MERSCOPE') AS d FROM p GROUP BY pair_id) SELECT count(d) AS n, round(avg(d), 6) AS mean_difference, round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 4) AS t FROM d"),
    "a50_rand_index": """WITH r AS (SELECT c_mktsegment AS a, c_nationkey % 4 AS b FROM customer), i AS (SELECT sum(k * (k - 1) / 2) AS s FROM (SELECT count(*) AS k FROM r GROUP BY a, b)), x AS (SELECT sum(k * (k - 1) / 2) AS s FROM (SELECT count(*) AS k FROM r GROUP BY a)), y AS (SELECT sum(k * (k - 1) / 2) AS s FROM (SELECT count(*) AS k FROM r GROUP BY b)), n AS (SELECT count(*) * (count(*) - 1) / 2 AS s FROM r)
        SELECT round((i.s - x.s * y.s / n.s) / ((x.s + y.s) / 2 - x.s * y.s / n.s), 8) AS ari FROM i, x, y, n""",
    "a50_cluster_sizes": "SELECT count(*) AS n_clusters, min(n) AS smallest, CAST(median(n) AS DOUBLE) AS median_size, max(n) AS largest FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)",
    "a51_table_diff": sql("transcripts", """a AS (SELECT cell_id, gene, count(*) AS n FROM transcripts WHERE qv >= 10 GROUP BY ALL), b AS (SELECT cell_id, gene, count(*) AS n FROM transcripts WHERE NOT background GROUP BY ALL), f AS (SELECT cell_id, coalesce(b.n, 0) - coalesce(a.n, 0) AS d, a.n AS na, b.n AS nb FROM a FULL JOIN b USING (cell_id, gene)),
        c AS (SELECT cell_id, sum(d) AS c, count(*) FILTER (d <> 0) AS z, sum(abs(d)) AS s, bool_or(na IS NOT NULL) AS ia, bool_or(nb IS NOT NULL) AS ib FROM f GROUP BY 1)
        SELECT CAST(sum(z) AS BIGINT) AS nnz, CAST(sum(s) AS BIGINT) AS abs_sum, count(*) FILTER (c > 0) AS increased, count(*) FILTER (c < 0) AS decreased, count(*) FILTER (c = 0) AS same, count(*) FILTER (ia <> ib) AS one_sided, quantile_cont(CAST(c AS DOUBLE), 0.5) AS delta_p50, quantile_cont(CAST(c AS DOUBLE), 0.95) AS delta_p95 FROM c"""),
    "a53_shape_layers": sql("counts cells nuclei", """l AS (SELECT 'cells' AS layer, * FROM cells UNION ALL SELECT 'nuclei', * FROM nuclei), h AS (SELECT layer, 'counted' AS mode, instance_id, gene, count(*) AS n FROM transcripts JOIN l ON x > cx - half AND x < cx + half AND y > cy - half AND y < cy + half GROUP BY ALL UNION ALL SELECT 'own', 'reused', cell_id + 1, gene, n FROM counts)
        SELECT layer, mode, count(DISTINCT instance_id) AS n_shapes, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT gene) AS n_genes FROM h GROUP BY ALL"""),
    "w01_ranks": """WITH r AS (SELECT p_brand AS gene, avg(p_retailprice) AS price, CAST(sum(p_size) AS DOUBLE) AS size FROM part GROUP BY 1), l AS (SELECT gene, 'price' AS metric, price AS v FROM r UNION ALL SELECT gene, 'size', size FROM r)
        SELECT metric, 'top' AS direction, rank, gene FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY v DESC, gene) AS rank FROM l) WHERE rank <= 5 UNION ALL SELECT metric, 'bottom', rank, gene FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY v, gene) AS rank FROM l) WHERE rank <= 5""",
    "w02_average_rank": "SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS rank FROM part",
    "w03_benjamini_hochberg": """WITH r AS (SELECT s_suppkey, s_nationkey % 3 AS f, CASE WHEN s_suppkey % 6 > 0 THEN round((s_suppkey % 13) * (s_suppkey % 13) / 200e0, 4) END AS p FROM supplier), k AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY p, s_suppkey) AS i, count(*) OVER (PARTITION BY f) AS n FROM r WHERE p IS NOT NULL),
        q AS (SELECT s_suppkey, least(1e0, min(p * n / i) OVER (PARTITION BY f ORDER BY p DESC, s_suppkey DESC ROWS UNBOUNDED PRECEDING)) AS q FROM k) SELECT s_suppkey, round(q.q, 6) AS q FROM r LEFT JOIN q USING (s_suppkey)""",
    "w04_best_and_runner_up": "SELECT p_brand, p_partkey AS best, runner_up, round(p_retailprice - nx, 6) AS margin FROM (SELECT *, row_number() OVER w AS k, lead(p_partkey) OVER w AS runner_up, lead(p_retailprice) OVER w AS nx FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)) WHERE k = 1",
}

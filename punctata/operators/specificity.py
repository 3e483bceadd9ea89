"""Marker discovery and mutually exclusive co-expression rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.stats import benjamini_hochberg, normal_two_sided


def detection_fractions(counts: DataFrame, classes: DataFrame, cell: str = "cell_id", label: str = "broad_class") -> DataFrame:
    """(label, gene, target and other fraction, cells): one class against the rest; pairs never seen are 0.

    Only sums by class and gene meet: the rest is a gene's total less its own class.
    """
    sizes = classes.groupBy(label).agg(F.count("*").alias("n_target"))
    seen = counts.where("n > 0").select(cell, "gene").join(classes.select(cell, label), cell).dropDuplicates([cell, label, "gene"])  # where the join has put the cells
    hits = seen.groupBy(label, "gene").agg(F.count("*").alias("_k"))
    genes = hits.groupBy("gene").agg(F.sum("_k").alias("_all"))
    total = sizes.agg(F.sum("n_target").alias("_n"))
    grid = genes.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(total))  # genes x classes is the result's size
    rows = grid.join(hits, [label, "gene"], "left").withColumn("_k", F.coalesce("_k", F.lit(0)))
    other = F.col("_n") - F.col("n_target")
    return rows.select(label, "gene", (F.col("_k") / F.col("n_target")).alias("target_fraction"), F.try_divide(F.col("_all") - F.col("_k"), other).alias("other_fraction"), "n_target", other.alias("n_other"))


def unique_markers(fractions: DataFrame, low: float = 0.25, high: float = 0.01, label: str = "broad_class") -> DataFrame:
    """Strictly above ``low`` in one class, strictly below ``high`` in the rest, for exactly one class."""
    good = fractions.where((F.col("target_fraction") > low) & (F.col("other_fraction") < high))
    once = good.groupBy("gene").agg(F.countDistinct(label).alias("_k")).where("_k = 1")
    return good.join(once.select("gene"), "gene", "left_semi")


def rank_sums(values: DataFrame, classes: DataFrame, cell: str = "cell_id", label: str = "broad_class") -> DataFrame:
    """Wilcoxon rank sums of each class and gene against the rest, ties corrected, zeros included.

    Ranks run over distinct values of a gene (counts are few), so the zero block, never stored, is one more
    value: its size is the number of cells less those seen.
    """
    n_cells = classes.agg(F.count("*").alias("_n"))
    sizes = classes.groupBy(label).agg(F.count("*").alias("_m"))
    seen = values.where("n <> 0").join(classes, cell)
    by_value = seen.groupBy("gene", "n").agg(F.count("*").alias("_k"))
    zero = by_value.groupBy("gene").agg(F.sum("_k").alias("_seen")).crossJoin(F.broadcast(n_cells)).select("gene", F.lit(0).cast("long").alias("n"), (F.col("_n") - F.col("_seen")).alias("_k"))
    w = Window.partitionBy("gene").orderBy("n")
    levels = by_value.unionByName(zero).withColumn("_rank", F.sum("_k").over(w) - (F.col("_k") - 1) / 2)
    k = F.col("_k").cast("double")  # a cube of a long overflows from two million cells
    ties = levels.groupBy("gene").agg(F.sum(k * k * k - k).alias("_ties"))
    in_class = seen.groupBy(label, "gene", "n").agg(F.count("*").alias("_c"))
    nonzero = in_class.join(levels.select("gene", "n", "_rank"), ["gene", "n"]).groupBy(label, "gene").agg(F.sum(F.col("_c") * F.col("_rank")).alias("_r"), F.sum("_c").alias("_hits"))
    grid = ties.join(levels.where("n = 0").select("gene", F.col("_rank").alias("_zero")), "gene").crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(n_cells))
    rows = grid.join(nonzero, [label, "gene"], "left").fillna({"_r": 0.0, "_hits": 0})
    rank_sum = F.col("_r") + (F.col("_m") - F.col("_hits")) * F.col("_zero")
    m, n = F.col("_m").cast("double"), F.col("_n").cast("double")
    u = rank_sum - m * (m + 1) / 2
    var = m * (n - m) / 12 * (n + 1 - F.try_divide(F.col("_ties"), n * (n - 1)))
    return rows.select(label, "gene", rank_sum.alias("rank_sum"), u.alias("u"), F.when(var > 0, (u - m * (n - m) / 2) / F.sqrt(var)).alias("score"))


def wilcoxon(values: DataFrame, classes: DataFrame, cell: str = "cell_id", label: str = "broad_class") -> DataFrame:
    """``rank_sums`` with two-sided normal p and its adjustment within each class."""
    rows = rank_sums(values, classes, cell, label).withColumn("p_value", normal_two_sided("score"))
    return benjamini_hochberg(rows, "p_value", [label], "p_adjusted")


def panel_reference(counts: DataFrame, panel: DataFrame, cell: str = "cell_id", target: float = 10_000) -> DataFrame:
    """(cell, token, value): library size over all genes, then panel genes, duplicate symbols summed, log1p."""
    size = counts.groupBy(cell).agg(F.sum("n").alias("_size"))
    tokens = counts.withColumn("token", F.lower(F.trim("gene"))).join(panel.select("token"), "token", "left_semi")
    return tokens.groupBy(cell, "token").agg(F.sum("n").alias("_n")).join(size, cell).select(cell, "token", F.log1p(F.col("_n") * target / F.col("_size")).alias("value"))


def pair_rates(counts: DataFrame, markers: DataFrame, cell: str = "cell_id", by: Sequence[str] = ()) -> DataFrame:
    """Co-expression of marker pairs of different classes: cells with both over cells with either.

    Markers listed twice are left out; every pair of present markers has a row, null where no cell has
    either. Pairs inside a cell come from a self-join of the marker genes alone, which the panel bounds.
    """
    by = list(by)
    once = markers.groupBy("gene").agg(F.count("*").alias("_k"), F.first("broad_class").alias("cls")).where("_k = 1").select("gene", "cls")
    hit = counts.where("n > 0").join(once, "gene").select(*by, cell, "gene", "cls").distinct()
    detected = hit.groupBy(*by, "gene", "cls").agg(F.count("*").alias("d"))
    left, right = ([*by, cell, F.col("gene").alias(f"gene_{i}"), F.col("cls").alias(f"class_{i}")] for i in (1, 2))
    both = hit.select(*left).join(hit.select(*right), [*by, cell]).where("gene_1 < gene_2 AND class_1 <> class_2").groupBy(*by, "gene_1", "gene_2").agg(F.count("*").alias("_both"))
    one, two = (detected.select(*by, F.col("gene").alias(f"gene_{i}"), F.col("cls").alias(f"class_{i}"), F.col("d").alias(f"cells_gene_{i}")) for i in (1, 2))
    near = (F.col("gene_1") < F.col("gene_2")) & (F.col("class_1") != F.col("class_2"))
    grid = (one.join(two, by) if by else one.crossJoin(two)).where(near)  # all marker pairs are the result
    rows = grid.join(both, [*by, "gene_1", "gene_2"], "left").withColumn("cells_both", F.coalesce("_both", F.lit(0).cast("long")))
    either = F.col("cells_gene_1") + F.col("cells_gene_2") - F.col("cells_both")
    return rows.withColumn("cells_either", either).withColumn("mecr", F.try_divide("cells_both", "cells_either")).drop("_both")


def rate_summary(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*by).agg(F.avg("mecr").alias("mecr"), F.median("mecr").alias("median_pair_mecr"), F.count("*").alias("n_eligible_pairs"), F.count("mecr").alias("n_scored_pairs"), F.count_if(F.col("mecr").isNull()).alias("n_zero_union_pairs"))


def class_pair_medians(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*by, F.least("class_1", "class_2").alias("class_a"), F.greatest("class_1", "class_2").alias("class_b")).agg(F.median("mecr").alias("mecr"))


def barnyard_pairs(pairs: DataFrame, canonical: DataFrame, top_n: int = 6) -> DataFrame:
    """Canonical pairs, then half of ``top_n`` by mean rate, then the most detected, without repeats."""
    keys = ["gene_1", "gene_2"]
    rows = pairs.where("mecr IS NOT NULL").groupBy(*keys).agg(F.avg("mecr").alias("mean_mecr"), F.sum("cells_either").alias("total_cells_either"))
    ranked = {
        "canonical": rows.join(canonical, keys, "left_semi").orderBy(*keys).limit(top_n).withColumn("_v", F.lit(0.0)),
        "highest_mean_mecr": rows.orderBy(F.desc("mean_mecr"), *keys).limit(max(1, (top_n + 1) // 2)).withColumn("_v", -F.col("mean_mecr")),
        "most_detected": rows.orderBy(F.desc("total_cells_either"), *keys).limit(top_n).withColumn("_v", -F.col("total_cells_either").cast("double")),
    }
    out = None
    for i, (reason, part) in enumerate(ranked.items()):
        part = part.withColumn("_why", F.struct(F.lit(i).alias("i"), F.col("_v").alias("v"), F.lit(reason).alias("reason")))
        out = part if out is None else out.unionByName(part)
    one = out.groupBy(*keys).agg(F.min("_why").alias("_first"), F.first("mean_mecr").alias("mean_mecr"), F.first("total_cells_either").alias("total_cells_either"))
    return one.orderBy("_first.i", "_first.v", *keys).limit(top_n).select(*keys, "mean_mecr", "total_cells_either", F.col("_first.reason").alias("reason"))

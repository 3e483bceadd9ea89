"""Pseudobulk samples and the paired near-versus-far comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctata.functions.stats import benjamini_hochberg, student_two_sided


def pseudobulk(counts: DataFrame, cells: DataFrame, tissues: Sequence[str], least: int = 10, cell: str = "cell_id") -> DataFrame:
    """(pair_id, proximity, gene, n, cell_count): raw counts summed over near and far cells of the tissues.

    Groups under ``least`` cells are left out. A negative or broken count raises.
    """
    used = cells.where(F.col("tissue").isin(*tissues) & F.col("proximity").isin("near", "far"))
    groups = used.groupBy("pair_id", "proximity").agg(F.count("*").alias("cell_count")).where(F.col("cell_count") >= least)
    bad = (F.col("n") < 0) | (F.abs(F.col("n") - F.rint(F.col("n").cast("double"))) > 1e-6)
    checked = counts.withColumn("n", F.when(bad, F.raise_error(F.lit("counts must be whole and not negative")).cast("long")).otherwise(F.rint(F.col("n").cast("double")).cast("long")))
    return checked.join(used.select(cell, "pair_id", "proximity"), cell).groupBy("pair_id", "proximity", "gene").agg(F.sum("n").alias("n")).join(groups, ["pair_id", "proximity"])


def complete_pairs(bulk: DataFrame) -> DataFrame:
    whole = bulk.groupBy("pair_id").agg(F.countDistinct("proximity").alias("_k")).where("_k = 2")
    return bulk.join(whole.select("pair_id"), "pair_id", "left_semi")


def size_factors(bulk: DataFrame) -> DataFrame:
    """Median of ratios to geometric means, over genes above 0 in every sample."""
    samples = bulk.select("pair_id", "proximity").distinct().agg(F.count("*").alias("_n"))
    means = bulk.where("n > 0").groupBy("gene").agg(F.avg(F.log("n")).alias("_g"), F.count("*").alias("_k")).crossJoin(F.broadcast(samples)).where("_k = _n")
    return bulk.join(means.select("gene", "_g"), "gene").groupBy("pair_id", "proximity").agg(F.exp(F.median(F.log("n") - F.col("_g"))).alias("size_factor"))


def paired_test(bulk: DataFrame, tails: bool = True) -> DataFrame:
    """Per gene: mean log2 fold change of near over far, paired t, p and its adjustment; absent counts are 0."""
    factors = size_factors(bulk)
    grid = bulk.select("gene").distinct().crossJoin(F.broadcast(factors))  # genes x samples is the matrix's size
    full = grid.join(bulk.select("gene", "pair_id", "proximity", "n"), ["gene", "pair_id", "proximity"], "left").withColumn("v", F.log2(F.coalesce("n", F.lit(0)) / F.col("size_factor") + 0.5))
    per_pair = full.groupBy("gene", "pair_id").agg((F.max(F.when(F.col("proximity") == "near", F.col("v"))) - F.max(F.when(F.col("proximity") == "far", F.col("v")))).alias("d"))
    t = F.when(F.stddev_samp("d") > 0, F.avg("d") / (F.stddev_samp("d") / F.sqrt(F.count("d"))))
    rows = per_pair.groupBy("gene").agg(F.avg("d").alias("log2_fold_change"), F.count("d").alias("n_pairs"), t.alias("t"))
    if not tails:
        return rows
    return benjamini_hochberg(rows.withColumn("p_value", student_two_sided("t", (F.col("n_pairs") - 1).cast("double"))), "p_value", [], "p_adjusted")

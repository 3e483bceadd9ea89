"""Count tables: totals, per-cell and per-group measures, comparisons between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut, dealt


def gene_totals(counts: DataFrame, gene: str = "gene", n: str = "n") -> DataFrame:
    return counts.groupBy(gene).agg(F.sum(n).alias("total"))


def gene_totals_from_points(points: DataFrame, assigned: Column | None = None) -> DataFrame:
    return (points if assigned is None else points.where(assigned)).groupBy("gene").agg(F.count("*").alias("total"))


def cell_metrics_from_points(points: DataFrame, cell: str, assigned: Column) -> DataFrame:
    """Transcripts and distinct genes of each assigned cell."""
    return points.where(assigned).groupBy(cell).agg(F.count("*").alias("n_transcripts"), F.countDistinct("gene").alias("n_genes"))


def cell_metrics_from_counts(counts: DataFrame, cells: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Sums and numbers of non-zero genes; cells without counts stay with 0."""
    per = counts.groupBy(cell).agg(F.sum("n").alias("n_transcripts"), F.count_if(F.col("n") > 0).alias("n_genes"))
    zero = F.lit(0).cast("long")
    return cells.select(cell).join(per, cell, "left").select(cell, F.coalesce("n_transcripts", zero).alias("n_transcripts"), F.coalesce("n_genes", zero).alias("n_genes"))


def dataset_summary(points: DataFrame, assigned: Column, per_cell: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals, share assigned in percent, and medians over cells; one row for each of ``by``.

    Where ``per_cell`` has ``area`` or ``eccentricity``, their medians follow.
    """
    totals = points.groupBy(*by).agg(F.count("*").alias("n_total"), F.count_if(assigned).alias("n_assigned"))
    cells = per_cell.groupBy(*by).agg(F.count("*").alias("n_cells"), F.median("n_transcripts").alias("median_transcripts"), F.median("n_genes").alias("median_genes"), *(F.median(c).alias(f"median_{c}") for c in ("area", "eccentricity") if c in per_cell.columns))
    joined = totals.join(cells, list(by)) if by else totals.crossJoin(F.broadcast(cells))
    return joined.withColumn("pct_assigned", F.col("n_assigned") * 100.0 / F.greatest("n_total", F.lit(1)))


def share(rows: DataFrame, value: str, keys: Sequence[str] = (), name: str = "share") -> DataFrame:
    """``value`` over its total (of each of ``keys``), summed before the join; a total of 0 or less raises."""
    total = rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
    joined = rows.join(total, list(keys)) if keys else rows.crossJoin(F.broadcast(total))
    checked = F.when(F.col("_total") > 0, F.col(value) / F.col("_total")).otherwise(F.raise_error(F.lit("the total is not positive")).cast("double"))
    return joined.withColumn(name, checked).drop("_total")


def log_fit(x: str, y: str) -> list[Column]:
    """Slope, intercept and R squared of log10 values clipped at 1e-12; null under two rows or without variance."""
    a, b = (F.log10(F.greatest(F.col(c).cast("double"), F.lit(1e-12))) for c in (x, y))
    enough = F.count("*") >= 2
    return [F.when(enough, f(b, a)).alias(n) for f, n in ((F.regr_slope, "slope"), (F.regr_intercept, "intercept"), (F.regr_r2, "r2"))]


def shared_genes(tables: Sequence[DataFrame], gene: str = "gene") -> DataFrame:
    """Genes that every table holds."""
    stacked = None
    for i, t in enumerate(tables):
        part = t.select(gene).distinct().withColumn("_i", F.lit(i))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(gene).agg(F.count("*").alias("_k")).where(F.col("_k") == len(tables)).select(gene)


def group_gene_summary(counts: DataFrame, groups: DataFrame, cell: str = "cell_id", group: str = "grp") -> DataFrame:
    """Mean and fraction of cells with the gene, zeros included: divided by the group's number of cells."""
    sizes = groups.groupBy(group).agg(F.count("*").alias("n_cells"))
    sums = counts.join(groups, cell).groupBy(group, "gene").agg(F.sum("n").alias("_s"), F.count_if(F.col("n") > 0).alias("_k"))
    return sums.join(sizes, group).select(group, "gene", "n_cells", (F.col("_s") / F.col("n_cells")).alias("mean"), (F.col("_k") / F.col("n_cells")).alias("fraction"))


def gene_z_scores(means: DataFrame, groups: DataFrame, group: str = "grp") -> DataFrame:
    """z of each gene's group mean over all groups (population deviation, 0 counts as 1); absent pairs are mean 0."""
    grid = means.select("gene").distinct().crossJoin(F.broadcast(groups.select(group).distinct()))  # genes x groups is the result's size
    full = grid.join(means.select(group, "gene", "mean"), [group, "gene"], "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    w = Window.partitionBy("gene")
    sd = F.stddev_pop("mean").over(w)
    return full.withColumn("z", (F.col("mean") - F.avg("mean").over(w)) / F.when(sd == 0, 1.0).otherwise(sd))


def normalized(counts: DataFrame, cell: str = "cell_id", target: float | None = None) -> DataFrame:
    """log1p of counts scaled to ``target`` a cell, by default the median library size."""
    sizes = counts.groupBy(cell).agg(F.sum("n").alias("_size"))
    goal = F.lit(float(target)) if target else F.col("_goal")
    rows = counts.join(sizes, cell)
    if not target:
        rows = rows.crossJoin(F.broadcast(sizes.agg(F.median("_size").alias("_goal"))))
    out = rows.where("_size > 0").withColumn("value", F.log1p(F.col("n") * goal / F.col("_size")))
    return out.drop("_size", "_goal") if not target else out.drop("_size")


def dominant_genes(counts: DataFrame, max_fraction: float, cell: str = "cell_id") -> DataFrame:
    """Genes above ``max_fraction`` of any cell."""
    sizes = counts.groupBy(cell).agg(F.sum("n").alias("_size"))
    return counts.join(sizes, cell).where(F.col("n") > max_fraction * F.col("_size")).select("gene").distinct()


def variances(counts: DataFrame, n_cells: DataFrame, value: str = "n") -> DataFrame:
    """Population variance of each gene over all cells, zeros included; ``n_cells`` has one row and column."""
    s = counts.groupBy("gene").agg(F.sum(F.col(value)).cast("double").alias("_s"), F.sum(F.col(value) * F.col(value)).cast("double").alias("_q"))
    n = n_cells.select(F.col(n_cells.columns[0]).alias("_n"))
    return s.crossJoin(F.broadcast(n)).select("gene", (F.col("_q") / F.col("_n") - (F.col("_s") / F.col("_n")) * (F.col("_s") / F.col("_n"))).alias("variance"))


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: non-zero differences, their absolute sum, cells that grew, shrank or stayed, ids and genes in one table alone.

    Both tables are dealt by cell, so one exchange serves the difference and the sums of cells. A table has a row for each cell and gene.
    """
    none, lost = F.lit(None).cast("long"), F.col("cell_id").isNull() | F.col("gene").isNull()
    both = a.select("cell_id", "gene", F.col("n").cast("long").alias("na"), none.alias("nb")).unionByName(b.select("cell_id", "gene", none.alias("na"), F.col("n").cast("long").alias("nb")))
    side = F.when(lost, F.col("na").isNull())  # null keys meet nothing
    both = dealt(cut(both), "cell_id").groupBy("cell_id", "gene", side.alias("_s")).agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    d = F.coalesce("nb", F.lit(0)) - F.coalesce("na", F.lit(0))
    rows = both.withColumn("_d", d)
    per_cell = rows.groupBy("cell_id").agg(F.sum("_d").alias("_c"), F.count_if(F.col("_d") != 0).alias("_nnz"), F.sum(F.abs("_d")).alias("_abs"), F.max(F.col("na").isNotNull()).alias("_in_a"), F.max(F.col("nb").isNotNull()).alias("_in_b"))
    return per_cell.agg(
        F.sum("_nnz").alias("nnz"), F.sum("_abs").alias("abs_sum"), F.count_if(F.col("_c") > 0).alias("increased"), F.count_if(F.col("_c") < 0).alias("decreased"), F.count_if(F.col("_c") == 0).alias("same"),
        F.count_if(F.col("_in_a") != F.col("_in_b")).alias("one_sided"), F.percentile("_c", F.lit(0.5)).alias("delta_p50"), F.percentile("_c", F.lit(0.95)).alias("delta_p95"),
    )

"""Summaries that reports and plots are made from: one small table for each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def control_qc(points: DataFrame, control: Column, areas: DataFrame, cell: str = "cell_id") -> DataFrame:
    """(cell, control_counts, pct_control_counts, nucleus_ratio) of cells with ``areas(cell, cell_area, nucleus_area)``; an area of 0 gives null."""
    per = points.groupBy(cell).agg(F.count("*").alias("_n"), F.count_if(control).alias("control_counts"))
    return per.join(areas, cell).select(cell, "control_counts", F.try_divide(F.col("control_counts") * 100.0, "_n").alias("pct_control_counts"), F.try_divide("nucleus_area", F.nullif("cell_area", F.lit(0.0))).alias("nucleus_ratio"))


def assignment_rates(points: DataFrame, methods: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """(by, n, n_assigned, method, rate): one row for each of ``by`` and method, from one pass; an unknown is not assigned."""
    marks = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"_m{i}") for i, c in enumerate(methods.values())]
    per = points.groupBy(*by).agg(F.count("*").alias("n"), *marks)
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("method"), F.col(f"_m{i}").alias("n_assigned")) for i, m in enumerate(methods))))
    return per.withColumn("_e", each).select(*by, "n", F.col("_e.n_assigned").alias("n_assigned"), F.col("_e.method").alias("method")).withColumn("rate", F.col("n_assigned") / F.col("n"))


def depth_summary(lines: DataFrame, failed: float = 0.2, odd: float = 0.1) -> DataFrame:
    """One row on ``lines(thickness, failed)``: counts, the median thickness, and warnings above the shares ``failed`` and ``odd``.

    A thickness under half or over twice the median is odd.
    """
    middle = lines.agg(F.median("thickness").alias("_m"))
    strange = (F.col("thickness") < F.col("_m") * 0.5) | (F.col("thickness") > F.col("_m") * 2)
    share = lambda c: F.avg(c.cast("double"))
    return lines.crossJoin(F.broadcast(middle)).agg(F.count("*").alias("n"), F.count_if("failed").alias("n_failed"), F.first("_m").alias("median_thickness"), (share(F.col("failed")) > failed).alias("warn_failed"), (share(strange) > odd).alias("warn_thickness"))


def confidence(rows: DataFrame, label: str, probability: str, correlation: str, low: float = 0.7, low_correlation: float = 0.3, shares: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """(label, n, q10.., low_probability_share, low_correlation_share) of each label."""
    q = F.percentile(probability, F.array(*(F.lit(x) for x in shares)))
    per = rows.groupBy(label).agg(F.count("*").alias("n"), q.alias("_q"), F.avg((F.col(probability) < low).cast("double")).alias("low_probability_share"), F.avg((F.col(correlation) < low_correlation).cast("double")).alias("low_correlation_share"))
    return per.select(label, "n", *(F.col("_q")[i].alias(f"q{round(100 * x)}") for i, x in enumerate(shares)), "low_probability_share", "low_correlation_share")


def plottable_column(rows: DataFrame, candidates: Sequence[str], most: int = 10) -> str:
    """The first candidate with at most ``most`` values, else the one with the fewest; one pass, one row to the driver."""
    n = rows.agg(*(F.countDistinct(c).alias(c) for c in candidates)).first()
    return next((c for c in candidates if n[c] <= most), min(candidates, key=lambda c: n[c]))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def region_leaves(rows: DataFrame, region: str, wanted: Sequence[str], leaf: Sequence[str], least: int) -> DataFrame:
    """(leaf, n_cells, kept) of the cells in the wanted regions; leaves with fewer than ``least`` cells are not kept."""
    return rows.where(F.col(region).isin(*wanted)).groupBy(*leaf).agg(F.count("*").alias("n_cells")).withColumn("kept", F.col("n_cells") >= least)


def metadata_groups(rows: DataFrame, group: str, term: Column, text: Sequence[str], pattern: str) -> DataFrame:
    """(group, n, terms, n_found): the group's terms in order, and how many rows' joined text matches ``pattern``."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(term)), ";").alias("terms"), F.count_if(F.concat_ws(" ", *text).rlike(pattern)).alias("n_found"))


def count_pivot(rows: DataFrame, key: str, column: str, values: Sequence[str]) -> DataFrame:
    """(key, one count for each of ``values`` in lower case, total)."""
    wide = rows.groupBy(key).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return wide.select(key, *(F.col(v).alias(v.lower()) for v in values), total.alias("total"))


def quantile_bins(rows: DataFrame, value: str, other: str, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(bin, n, r, sd): correlation of both columns and deviation of ``other`` in each quantile bin of ``value``; an edge is in the lower bin."""
    q = rows.agg(F.percentile(value, F.array(*(F.lit(x) for x in shares))).alias("_q"))
    b = F.when(F.col(value) <= F.col("_q")[0], 0)
    for i in range(1, len(shares)):
        b = b.when(F.col(value) <= F.col("_q")[i], i)
    return rows.crossJoin(F.broadcast(q)).withColumn("bin", b.otherwise(len(shares)).cast("long")).groupBy("bin").agg(F.count("*").alias("n"), F.corr(value, other).alias("r"), F.stddev_samp(other).alias("sd"))


def paired_t(rows: DataFrame, pair: str, side: str, value: str, first: str, second: str) -> DataFrame:
    """(n, mean_difference, t) of the pairs' means, ``second`` less ``first``; pairs without a side don't count."""
    per = rows.groupBy(pair, side).agg(F.avg(value).alias("_m"))
    of = lambda s: F.max(F.when(F.col(side) == s, F.col("_m")))
    d = per.groupBy(pair).agg((of(second) - of(first)).alias("d"))
    return d.agg(F.count("d").alias("n"), F.avg("d").alias("mean_difference"), (F.avg("d") / (F.stddev_samp("d") / F.sqrt(F.count("d")))).alias("t"))


def depth_columns(pixels: DataFrame, column: str, value: str, pixel_area: float) -> DataFrame:
    """(column, n_pixels, area, min_phi, max_phi) of each depth column."""
    return pixels.groupBy(column).agg(F.count("*").alias("n_pixels"), (F.count("*") * pixel_area).alias("area"), F.min(value).alias("min_phi"), F.max(value).alias("max_phi"))

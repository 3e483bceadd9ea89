"""Cluster labels from marker scores, marker lists, and agreement of clusterings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.names import UNKNOWN_LABEL


def label_scores(z: DataFrame, markers: DataFrame, least: int = 3) -> DataFrame:
    """Mean z over a label's resolved markers, for labels with at least ``least`` of them."""
    rows = z.join(markers.select("label", "gene").distinct(), "gene")
    return rows.groupBy("grp", "label").agg(F.avg("z").alias("score"), F.count("*").alias("n_markers"), F.array_join(F.array_sort(F.collect_list("gene")), ";").alias("resolved_markers")).where(F.col("n_markers") >= least)


def best_labels(scores: DataFrame, groups: DataFrame, margin: float = 0.0) -> DataFrame:
    """Best label, runner-up and margin of each group; below ``margin``, or without a score, it is unknown."""
    w = Window.partitionBy("grp").orderBy(F.desc("score"), "label")
    ranked = scores.withColumns({"_k": F.row_number().over(w), "runner_up": F.lead("label").over(w), "margin": F.col("score") - F.lead("score").over(w)}).where("_k = 1")
    rows = groups.join(ranked.select("grp", "label", "score", "runner_up", "margin"), "grp", "left")
    unknown = F.col("score").isNull() | F.coalesce(F.col("margin") < margin, F.lit(False))
    return rows.withColumn("label", F.when(unknown, UNKNOWN_LABEL).otherwise(F.col("label")))


def split_marker_sets(sets: DataFrame, split: str, order: str, gene: str) -> DataFrame:
    """Genes of each split in order of first occurrence; a split's genes are a panel."""
    first = sets.groupBy(split, gene).agg(F.min(order).alias("_o"))
    return first.groupBy(split).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", gene))), lambda s: s[gene]).alias("genes"))


def adjusted_rand(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row, ``ari``, from the contingency table."""
    cells = rows.groupBy(a, b).agg(F.count("*").alias("k"))
    pairs = lambda t: t.agg(F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("s"))
    parts = [pairs(cells), *(pairs(cells.groupBy(c).agg(F.sum("k").alias("k"))) for c in (a, b)), cells.agg(F.sum("k").alias("k")).select((F.col("k") * (F.col("k") - 1) / 2).alias("s"))]
    out = None
    for i, p in enumerate(parts):
        p = p.withColumnRenamed("s", f"s{i}")
        out = p if out is None else out.crossJoin(p)  # single rows
    expected = F.col("s1") * F.col("s2") / F.col("s3")
    return out.select(F.try_divide(F.col("s0") - expected, (F.col("s1") + F.col("s2")) / 2 - expected).alias("ari"))

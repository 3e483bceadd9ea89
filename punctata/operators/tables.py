"""Joins of annotations, taxonomies, markers and ids, and checks between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.operators.ids import first_of, stable_ids


def attach_metrics(cells: DataFrame, metrics: DataFrame, key: str, order: str, columns: Sequence[str], rows_by: str | None = None) -> DataFrame:
    """Metrics by id, the first of repeated ids by ``order``.

    With ``rows_by``, tables that share no id but have equally many rows are joined row by row: the cells in
    the order of that column, the metrics in ``order``.
    """
    if rows_by is not None and cells.join(metrics, key, "left_semi").isEmpty() and cells.count() == metrics.count():
        nth = stable_ids(metrics.select(order, *columns), [order], "_row").drop(order)
        return stable_ids(cells, [rows_by], "_row").join(nth, "_row").drop("_row")
    return cells.join(first_of(metrics, [key], [order]).select(key, *columns), key, "left")


def annotate(cells: DataFrame, notes: DataFrame, key: str, order: str, columns: Sequence[str], prefix: str = "", unknown: str | None = None) -> DataFrame:
    """As ``attach_metrics`` with prefixed text columns; cells without a note get ``unknown``."""
    first = first_of(notes, [key], [order]).select(key, *(F.col(c).alias(f"{prefix}{c}") for c in columns))
    out = cells.join(first, key, "left")
    if unknown is not None:
        out = out.withColumns({f"{prefix}{c}": F.coalesce(F.col(f"{prefix}{c}"), F.lit(unknown)) for c in columns})
    return out


def taxonomy_classes(cells: DataFrame, membership: DataFrame, terms: DataFrame, broad: Column) -> DataFrame:
    """cell -> alias -> supercluster -> name -> broad class; the first membership of an alias counts; a cell without one raises."""
    m = first_of(membership, ["alias"], ["ord"]).select("alias", "term")
    rows = cells.join(m, "alias", "left").join(terms.select("term", "name"), "term", "left")
    return rows.withColumn("broad_class", F.when(F.col("name").isNull(), F.raise_error(F.concat(F.lit("unmapped cell "), F.col("cell_id").cast("string")))).otherwise(broad))


def majority_split(a: DataFrame, b: DataFrame, key: str, group: str, split: str) -> DataFrame:
    """(group, split): the most frequent split among a group's keys; ties are Other."""
    votes = a.select(key, group).join(b.select(key, split), key).groupBy(group, split).agg(F.count("*").alias("k"))
    w = Window.partitionBy(group).orderBy(F.desc("k"), split)
    best = votes.withColumns({"_n": F.row_number().over(w), "_next": F.lead("k").over(w)}).where("_n = 1")
    return best.select(group, F.when(F.col("k") == F.col("_next"), "Other").otherwise(F.col(split)).alias("neuron_split"))


def resolve_markers(markers: DataFrame, features: DataFrame, aliases: DataFrame, most: int | None = None) -> DataFrame:
    """(label, ord, feature): each marker's feature by id, then name, then symbol, then the same for its alias.

    ``features(feature, ord, id, name, symbol)``; the first marker of a label that reaches a feature counts.
    """
    tokens = None
    for priority, column in enumerate(("id", "name", "symbol")):
        part = features.select(F.lower(F.trim(column)).alias("token"), F.struct(F.lit(priority).alias("p"), "ord", "feature").alias("hit"))
        tokens = part if tokens is None else tokens.unionByName(part)
    lookup = tokens.where("token IS NOT NULL AND token NOT IN ('', 'nan', 'none')").groupBy("token").agg(F.min("hit").alias("hit")).select("token", F.col("hit.feature").alias("feature"))
    m = markers.withColumn("token", F.lower(F.trim("marker")))
    rows = m.join(lookup, "token", "left").join(aliases.select("token", F.col("alias").alias("_alias")), "token", "left")
    rows = rows.join(lookup.select(F.col("token").alias("_alias"), F.col("feature").alias("_second")), "_alias", "left")
    found = rows.withColumn("feature", F.coalesce("feature", "_second")).where("feature IS NOT NULL")
    once = first_of(found, ["label", "feature"], ["ord"])
    if most is not None:
        once = once.withColumn("_n", F.row_number().over(Window.partitionBy("label").orderBy("ord"))).where(F.col("_n") <= most)
    return once.select("label", "ord", "feature")


def gene_id_lookup(sources: DataFrame) -> DataFrame:
    """(symbol, gene_id, conflict) from ``sources(ord, symbol, id)``: the first ENSG id wins, others are conflicts."""
    good = sources.where(F.col("id").startswith("ENSG") & (F.trim("symbol") != ""))
    return good.groupBy("symbol").agg(F.min_by("id", "ord").alias("gene_id"), (F.countDistinct("id") > 1).alias("conflict"))


def best_key_match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], accept: float = 0.95) -> tuple[str, str] | None:
    """The first pair of key columns that matches all left rows, else the best with at least ``accept``, else none; keys meet as text."""
    n, best = left.count(), (0.0, None)
    for a, b in pairs:
        keys = right.select(F.col(b).cast("string").alias("_k")).distinct()
        share = left.select(F.col(a).cast("string").alias("_k")).join(keys, "_k", "left_semi").count() / max(1, n)
        if share == 1:
            return a, b
        if share > best[0]:
            best = (share, (a, b))
    return best[1] if best[0] >= accept else None


def attach_value(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], value: str, own: Sequence[str] = (), left_order: Sequence[str] | None = None, right_order: Sequence[str] | None = None, accept: float = 0.95) -> DataFrame:
    """``left`` with ``value`` of ``right`` by the best key; else by row order; else from a column of its own; and ``by``, which it was.

    Row order needs as many rows on both sides and ``left_order``, ``right_order``, which number them; of ``own`` the first column
    there is counts. The first row of a repeated key, by ``value``, is taken. Where nothing fits it raises.
    """
    found = best_key_match(left, right, pairs, accept)
    if found:
        a, b = found
        once = right.where(F.col(b).isNotNull()).groupBy(F.col(b).cast("string").alias("_k")).agg(F.min(value).alias(value))
        rows = left.withColumn("_k", F.col(a).cast("string")).join(once, "_k", "left").drop("_k")
        return rows.withColumn("by", F.lit(f"{a}={b}"))
    if left_order and right_order and left.count() == right.count():
        other = stable_ids(right, right_order, "_n").select("_n", value)
        return stable_ids(left, left_order, "_n").join(other, "_n").drop("_n").withColumn("by", F.lit("row order"))
    for c in own:
        if c in left.columns:
            return left.withColumn(value, F.col(c).cast("double")).withColumn("by", F.lit(c))
    raise ValueError(f"no key, row order or own column gives {value}")


def union_names(samples: DataFrame) -> DataFrame:
    """(token, gene) from ``samples(ord, gene)``: one row a name whatever its case, the first spelling kept."""
    return samples.groupBy(F.lower(F.trim("gene")).alias("token")).agg(F.min_by("gene", F.struct("ord", "gene")).alias("gene"))


def diagnostic_genes(metrics: DataFrame, cap: int, most_rank: int, families: int, gene: str = "gene", family: str = "family", value: str = "value") -> DataFrame:
    """(gene, family, rank): at most ``cap`` genes of ``metrics(gene, family, value)``, the highest values of each family first.

    Each family gives its first ``cap // families`` genes, without repeats; further ranks up to ``most_rank`` fill what is left. A gene
    counts for the family where it stands best. Null and NaN values do not rank.
    """
    quota = cap // families
    ranks = Window.partitionBy(family).orderBy(F.desc(value), gene)  # a family is a panel of genes
    rows = metrics.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= most_rank)
    best = rows.groupBy(gene).agg(F.min(F.struct((F.col("rank") > quota).alias("late"), F.col(family).alias("f"), F.col("rank").alias("r"))).alias("b"))
    return best.orderBy("b.late", "b.r", "b.f", gene).limit(cap).select(gene, F.col("b.f").alias(family), F.col("b.r").cast("long").alias("rank"))

"""Stable ids, canonical ids and id translation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut


def first_of(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row for each key: the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def stable_ids(rows: DataFrame, order: Sequence[Column | str], name: str = "id", first: int = 1, keep: Sequence[str] | None = None) -> DataFrame:
    """Numbers rows ``first``.. in the given order, of columns of any types; ``keep`` names the columns that stay, else all.

    A range exchange with sampled bounds orders the rows, so values that crowd in one place are divided; each task sorts its
    rows and marks them with its own number and theirs as it writes them. So rows move once, and their place is fixed before
    the tasks' row counts give each task's first number. Rows that are equal in ``order`` share a task: end it with a key.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(placed.select(*(keep or rows.columns), F.monotonically_increasing_id().alias("_mark")))
    part = F.shiftright("_mark", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # one row a task
    inside = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return ranked.withColumn(name, (F.col("_start") + inside + first).cast("long")).drop("_part", "_mark", "_start")


def canonical_ids(rows: DataFrame, source: str, name: str = "instance_id") -> DataFrame:
    """Positive ids for shapes: own ids if all are positive integers without repeats, else ranks.

    Ranks follow the sorted text of ``source``; zero-based integers move up by one. Repeats raise.
    """
    as_long = F.expr(f"try_cast({source} AS BIGINT)")
    facts = rows.agg(F.count_if(as_long.isNull()).alias("bad"), F.min(as_long).alias("least"), F.count("*").alias("all"), F.countDistinct(source).alias("distinct")).first()
    if facts["distinct"] < facts["all"]:
        raise ValueError(f"{source} repeats or holds nulls")
    if facts["bad"] or (facts["least"] or 0) < 0:
        return stable_ids(rows, [F.col(source).cast("string")], name)
    return rows.withColumn(name, as_long + (1 if facts["least"] == 0 else 0))


def allocate(rows: DataFrame, internal: str, label: str, name: str = "instance_id") -> DataFrame:
    """The first user of a label by ``internal`` keeps it; later ones get the next numbers above all labels."""
    w = Window.partitionBy(label).orderBy(internal)
    keeps = F.col(label).isNotNull() & (F.row_number().over(w) == 1)
    marked = rows.withColumn("_keeps", keeps)
    top = rows.agg(F.coalesce(F.max(label), F.lit(0)).alias("_top"))
    lost = stable_ids(marked.where(~F.col("_keeps")), [internal], "_extra")
    kept = marked.where("_keeps").withColumn("_extra", F.lit(None).cast("long"))
    both = kept.unionByName(lost).crossJoin(F.broadcast(top))
    return both.withColumn(name, F.coalesce(F.when(F.col("_keeps"), F.col(label)), F.col("_top") + F.col("_extra")).cast("long")).drop("_keeps", "_extra", "_top")


def translate(rows: DataFrame, column: str, mapping: DataFrame, old: str, new: str, sentinels: Sequence = (0,)) -> DataFrame:
    """``column`` through ``mapping``; sentinels and nulls become null, any other unknown id raises.

    Sentinels and nulls have no partner, so a join would gather all of them in one task: they don't go through it.
    """
    none = F.col(column).isNull() | F.col(column).isin(*sentinels)
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = rows.where(~none).join(m, F.col(column) == F.col("_old"), "left")
    value = F.when(F.col("_old").isNull(), F.raise_error(F.concat(F.lit("unknown id "), F.col(column).cast("string")))).otherwise(F.col("_new"))
    known = joined.withColumn(column, value.cast("long")).drop("_old", "_new")
    return known.unionByName(rows.where(none).withColumn(column, F.lit(None).cast("long")))


def violations(shapes: DataFrame, cells: DataFrame, points: DataFrame, key: str = "instance_id", assigned: str = "assignment") -> DataFrame:
    """(check, id): ids in one of shapes and cells alone, assignments without a shape, repeats, ids <= 0."""
    s, c = shapes.select(F.col(key).alias("id")), cells.select(F.col(key).alias("id"))
    p = points.where(F.col(assigned).isNotNull()).select(F.col(assigned).alias("id")).distinct()
    found = {
        "shape_without_cell": s.join(c, "id", "left_anti"),
        "cell_without_shape": c.join(s, "id", "left_anti"),
        "assignment_without_shape": p.join(s, "id", "left_anti"),
        "repeated_shape_id": s.groupBy("id").count().where("count > 1").select("id"),
        "id_not_positive": s.where("id <= 0"),
    }
    out = None
    for check, rows in found.items():
        part = rows.distinct().select(F.lit(check).alias("check"), F.col("id").cast("long").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out

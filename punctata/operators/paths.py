"""Paths as ordered points: lengths, spacing, smoothing and resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut


def with_length(rows: DataFrame, keys: Sequence[str], order: str, x: str = "x", y: str = "y", name: str = "length") -> DataFrame:
    """Cumulative length along each path; 0 at its first point."""
    w = Window.partitionBy(*keys).orderBy(order)
    dx, dy = F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)
    stepped = rows.withColumn("_step", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
    return stepped.withColumn(name, F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def scaled_length(rows: DataFrame, keys: Sequence[str], order: str, x: str, y: str, total: str, name: str) -> DataFrame:
    """Cumulative length, scaled so that the path's end is at ``total``; 0 all along a path without length."""
    long = with_length(rows, keys, order, x, y, "_len")
    end = F.max("_len").over(Window.partitionBy(*keys))
    return long.withColumn(name, F.when(end > 0, F.col("_len") * F.col(total) / end).otherwise(0.0)).drop("_len")


def central_spacing(value: str, w) -> Column:
    """Local spacing of a sorted coordinate: central, one-sided at the ends, 1 for a single point."""
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    here = F.col(value)
    return F.abs(F.when(before.isNull() & after.isNull(), F.lit(1.0)).when(before.isNull(), after - here).when(after.isNull(), here - before).otherwise((after - before) / 2))


def smoothed(rows: DataFrame, keys: Sequence[str], order: str, value: str, width: int, name: str, keep_ends: bool = False) -> DataFrame:
    """Centred moving average of odd ``width`` with edge values repeated; short paths stay as they are."""
    half, w = width // 2, Window.partitionBy(*keys).orderBy(order)
    all_rows = Window.partitionBy(*keys)
    n, k = F.count("*").over(all_rows), F.row_number().over(w)
    first, last = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.last(value).over(w.rowsBetween(0, Window.unboundedFollowing))
    inside = F.sum(value).over(w.rowsBetween(-half, half))
    total = inside + F.greatest(F.lit(0), half + 1 - k) * first + F.greatest(F.lit(0), half - (n - k)) * last
    mean = total / (2 * half + 1)
    if keep_ends:
        mean = F.when((k == 1) | (k == n), F.col(value)).otherwise(mean)
    return rows.withColumn(name, F.when(n <= width, F.col(value)).otherwise(mean))


def resampled(rows: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """``n`` equally spaced positions along each path (keys, i, x, y), linear between its points.

    Each segment makes the positions that fall on it, so no position looks for its segment.
    """
    long = with_length(rows, keys, order)
    w = Window.partitionBy(*keys).orderBy(order)
    end = F.max("length").over(Window.partitionBy(*keys))
    seg = long.select(*keys, order, "x", "y", "length", end.alias("_end"), *(F.lead(c).over(w).alias(f"_{c}") for c in ("x", "y", "length")))
    step = F.col("_end") / (n - 1)
    low = F.ceil(F.col("length") / step)
    high = F.when(F.col("_length") == F.col("_end"), F.lit(n - 1)).otherwise(F.ceil(F.col("_length") / step) - 1)
    at = seg.where("_length > length").withColumn("_low", low).withColumn("_high", high).where("_low <= _high")
    at = at.withColumn("i", F.explode(F.sequence(F.col("_low").cast("long"), F.col("_high").cast("long"))))
    t = (F.col("i") * step - F.col("length")) / (F.col("_length") - F.col("length"))
    return at.select(*keys, "i", *((F.col(c) + t * (F.col(f"_{c}") - F.col(c))).alias(c) for c in ("x", "y")))


def along_curves(points: DataFrame, curves: DataFrame, key: str, curve: str, order: str) -> DataFrame:
    """(key, ``curve``, distance, length): where each of ``points(key, x, y)`` projects onto the nearest of ``curves(curve, order, x, y)``.

    ``length`` is measured along the curve from its first point. Of equal distances the first segment in the order of curves
    counts. Curves of fewer than two points and points without finite coordinates have no row.
    """
    from punctata.operators.ids import stable_ids
    from punctata.operators.spatial import nearest_segments

    w = Window.partitionBy(curve).orderBy(order)
    steps = with_length(curves, [curve], order).withColumns({"_bx": F.lead("x").over(w), "_by": F.lead("y").over(w)}).where("_bx IS NOT NULL")
    steps = cut(stable_ids(steps, [curve, order], "_step"))
    one = F.array(F.struct(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("_bx").alias("bx"), F.col("_by").alias("by")))
    near = nearest_segments(points, steps.select("_step", one.alias("segs")), key, "_step")
    ex, ey = F.col("edge_x") - F.col("x"), F.col("edge_y") - F.col("y")
    return near.join(steps, "_step").select(key, curve, "distance", (F.col("length") + F.hypot(ex, ey)).alias("length"))


def valid_lines(samples: DataFrame, line: str, reached: str, thickness: str) -> DataFrame:
    """Samples of lines that reached the other side, with thickness and two points at least; all samples if no line is so."""
    whole = Window.partitionBy(line)
    good = F.coalesce(F.col(reached) & (F.col(thickness) > 0), F.lit(False)) & (F.count("*").over(whole) >= 2)
    marked = samples.withColumn("_good", good)
    some = marked.agg(F.max("_good").alias("_some"))  # one row
    return marked.crossJoin(F.broadcast(some)).where(F.col("_good") | ~F.coalesce("_some", F.lit(False))).drop("_good", "_some")


def streamline_depth(points: DataFrame, samples: DataFrame, pia: DataFrame, key: str) -> DataFrame:
    """(key, column_id, pia_distance, wm_distance, thickness, tangential) of the nearest sample of each point.

    ``samples(line, k, x, y, thickness, reached)``, ``k`` unique and rising along a line from its root; valid lines are preferred. Depth is
    the length along the line, scaled to its thickness; ``tangential`` is where the line's root projects onto the curves ``pia(curve, k, x, y)``.
    """
    from punctata.operators.spatial import nearest_points

    used = cut(scaled_length(valid_lines(samples, "line", "reached", "thickness"), ["line"], "k", "x", "y", "thickness", "pia"))
    root = used.groupBy("line").agg(F.min_by(F.struct("x", "y"), "k").alias("_r")).select("line", "_r.x", "_r.y")
    place = along_curves(root, pia, "line", "curve", "k").select("line", F.col("length").alias("tangential"))
    near = nearest_points(points, used.select("k", F.col("x").alias("tx"), F.col("y").alias("ty")), key, "k").select(key, "k")
    rows = near.join(used.select("k", "line", "pia", "thickness"), "k").join(place, "line", "left")
    wm = F.greatest(F.col("thickness") - F.col("pia"), F.lit(0.0))
    return rows.select(key, F.col("line").alias("column_id"), F.col("pia").alias("pia_distance"), wm.alias("wm_distance"), "thickness", "tangential")

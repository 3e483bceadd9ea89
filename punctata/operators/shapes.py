"""Geometry of polygons given as closed rings of vertices."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctata.operators.predicates import affine


@F.pandas_udf(T.DoubleType())
def convex_area(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Area of the hull of each vertex list, by monotone chains."""

    def one(x, y) -> float | None:
        points = sorted({(float(a), float(b)) for a, b in zip(x, y, strict=True)})
        if len(points) < 3:
            return 0.0

        def chain(ps) -> list:
            out: list = []
            for p in ps:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                    out.pop()
                out.append(p)
            return out[:-1]

        hull = [*chain(points), *chain(points[::-1])]
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(hull, [*hull[1:], hull[0]], strict=True))) / 2

    return pd.Series([None if x is None else one(x, y) for x, y in zip(xs, ys, strict=True)], dtype="float64")


def _segments(ring: Column) -> Column:
    n = F.size(ring) - 1
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: F.struct(a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")))


def _total(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, s: a + value(s))


def signed_area(ring: Column) -> Column:
    return _total(_segments(ring), lambda s: (s.ax * s.by - s.bx * s.ay) / 2)


def geometry(shapes: DataFrame, ring: Column, key: str) -> DataFrame:
    """Area, perimeter, hull area, circularity, solidity, eccentricity and aspect, log10 area.

    Eccentricity and aspect come from the covariance of the ring's vertices, the closing one counted;
    under five vertices they are null.
    """
    rows = shapes.select(key, ring.alias("_r"))
    r = F.col("_r")
    segs = _segments(r)
    xs, ys = F.transform(r, lambda v: v.x), F.transform(r, lambda v: v.y)
    rows = rows.withColumns({"area": F.abs(signed_area(r)), "perimeter": _total(segs, lambda s: F.hypot(s.bx - s.ax, s.by - s.ay)), "convex_area": convex_area(xs, ys), "_n": F.size(r), "_mx": _total(xs, lambda v: v) / F.size(r), "_my": _total(ys, lambda v: v) / F.size(r)})
    rows = rows.withColumns({
        "_a": _total(r, lambda v: (v.x - F.col("_mx")) * (v.x - F.col("_mx"))), "_b": _total(r, lambda v: (v.y - F.col("_my")) * (v.y - F.col("_my"))), "_c": _total(r, lambda v: (v.x - F.col("_mx")) * (v.y - F.col("_my"))),
    })
    a, b, c = F.col("_a"), F.col("_b"), F.col("_c")
    root = F.sqrt((a - b) * (a - b) / 4 + c * c)
    big, small = (a + b) / 2 + root, F.greatest(F.lit(0.0), (a + b) / 2 - root)
    enough = (F.col("_n") >= 5) & (big > 0)
    return rows.select(
        key, "area", "perimeter", "convex_area", F.try_divide(4 * math.pi * F.col("area"), F.col("perimeter") * F.col("perimeter")).alias("circularity"), F.try_divide("area", "convex_area").alias("solidity"),
        F.when(enough, F.sqrt(1 - small / big)).alias("eccentricity"), F.when(enough & (small > 0), F.sqrt(big / small)).alias("aspect"), F.when(F.col("area") > 0, F.log10("area")).alias("log10_area"),
    )


def interior_point(ring: Column) -> Column:
    """A point strictly inside the ring: the middle of the widest chord of a scan line; null if the ring has no inside there.

    The scan line lies halfway between two neighbouring heights of vertices: those around the middle of the box.
    """
    ys = F.array_sort(F.array_distinct(F.transform(ring, lambda p: p.y)))
    middle = (ys[0] + F.element_at(ys, -1)) / 2
    below, above = F.array_max(F.filter(ys, lambda v: v <= middle)), F.array_min(F.filter(ys, lambda v: v > middle))
    y = (below + above) / 2
    at = lambda s: s.ax + (y - s.ay) * (s.bx - s.ax) / (s.by - s.ay)
    xs = F.array_sort(F.transform(F.filter(_segments(ring), lambda s: (s.ay > y) != (s.by > y)), at))
    chord = lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), ((F.get(xs, 2 * i) + F.get(xs, 2 * i + 1)) / 2).alias("x"))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1)), chord))
    return F.when((F.size(xs) >= 2) & (best.w > 0), F.struct(best.x.alias("x"), y.alias("y")))


def centroids(shapes: DataFrame, ring: Column, key: str) -> DataFrame:
    """(key, x, y): area centroid; where the area is 0 or the centroid falls out of the box, an interior point, else the box's centre."""
    rows = shapes.select(key, ring.alias("_r"))
    r = F.col("_r")
    segs, area = _segments(r), signed_area(r)
    cross = lambda s: s.ax * s.by - s.bx * s.ay
    rows = rows.withColumns({"_a": area, "_sx": _total(segs, lambda s: (s.ax + s.bx) * cross(s)), "_sy": _total(segs, lambda s: (s.ay + s.by) * cross(s)), **{f"_{f}{v}": g(F.transform(r, (lambda p: p.x) if v == "x" else (lambda p: p.y))) for v in "xy" for f, g in (("lo", F.array_min), ("hi", F.array_max))}})
    at = {v: F.try_divide(F.col(f"_s{v}"), 6 * F.col("_a")) for v in "xy"}
    ok = F.coalesce(at["x"].between(F.col("_lox"), F.col("_hix")) & at["y"].between(F.col("_loy"), F.col("_hiy")), F.lit(False))
    rows = rows.withColumn("_i", F.when(~ok, interior_point(r)))
    return rows.select(key, *(F.when(ok, at[v]).otherwise(F.coalesce(F.col(f"_i.{v}"), (F.col(f"_lo{v}") + F.col(f"_hi{v}")) / 2)).alias(v) for v in "xy"))


def transform_rings(ring: Column, matrix) -> Column:
    """The ring with every vertex moved by a 2x3 map."""

    def move(v: Column) -> Column:
        x, y = affine(v.x, v.y, matrix)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, move)

"""Rasters as tables of pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut
from punctata.operators.ids import stable_ids
from punctata.operators.pyramid import finite
from punctata.operators.spatial import nearest_points


def bilinear(points: DataFrame, field: DataFrame, key: str) -> DataFrame:
    """``points`` with the field's value between its four pixels; null where one is missing."""
    corners = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    fy, fx = F.col("y") - F.floor("y"), F.col("x") - F.floor("x")
    weight = F.when(F.col("_c.i") == 0, 1 - fy).otherwise(fy) * F.when(F.col("_c.j") == 0, 1 - fx).otherwise(fx)
    at = points.withColumn("_c", corners).select(key, (F.floor("y") + F.col("_c.i")).alias("row"), (F.floor("x") + F.col("_c.j")).alias("col"), weight.alias("_w"))
    hit = at.join(field.select("row", "col", F.col("value").alias("_v")), ["row", "col"], "left")
    value = hit.groupBy(key).agg(F.when(F.count("_v") == 4, F.sum(F.col("_v") * F.col("_w"))).alias("value"))
    return points.join(value, key, "left")


def side_distances(points: DataFrame, boundary: DataFrame, key: str, height: int, width: int, x0: float = 0.0, y0: float = 0.0, step: float = 1.0, resolution: float = 1.0) -> DataFrame:
    """(key, side_distance): from the pixel that holds each point to the nearest pixel of ``boundary(row, col)``, times ``resolution``.

    Null, which stands for infinity, outside of the grid of ``height`` by ``width`` pixels, without finite coordinates, and without boundary.
    """
    at = points.where(finite("x", "y")).select(key, F.floor((F.col("x") - x0) / step).cast("double").alias("x"), F.floor((F.col("y") - y0) / step).cast("double").alias("y"))
    at = at.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    edge = boundary.select((F.col("row") * width + F.col("col")).cast("long").alias("_pixel"), F.col("col").cast("double").alias("tx"), F.col("row").cast("double").alias("ty"))
    near = nearest_points(at, edge, key, "_pixel").select(key, (F.col("distance") * resolution).alias("side_distance"))
    return points.select(key).join(near, key, "left")


def relabel(areas: DataFrame) -> DataFrame:
    """Dense labels 1..N in label order for the labels of ``areas``."""
    return stable_ids(areas, ["label"], "new_label")


def label_areas(mask: DataFrame, pixel_area: float = 1.0) -> DataFrame:
    return mask.where("label > 0").groupBy("label").agg((F.count("*") * pixel_area).alias("area"))


def filter_by_area(mask: DataFrame, low: float | None, high: float | None, pixel_area: float = 1.0) -> DataFrame:
    """(row, col, label): labels out of bounds become background, others dense."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (F.col("area") >= low)
    if high is not None:
        keep = keep & (F.col("area") <= high)
    kept = relabel(label_areas(mask, pixel_area).where(keep)).select("label", "new_label")
    return mask.join(kept, "label", "left").select("row", "col", F.coalesce("new_label", F.lit(0).cast("long")).alias("label"))


def shape_statistics(mask: DataFrame) -> DataFrame:
    """(label, area, eccentricity) from second central moments, a pixel counting as a unit square."""
    r, c = F.col("row").cast("double"), F.col("col").cast("double")
    m = mask.where("label > 0").groupBy("label").agg(F.count("*").alias("area"), F.var_pop(r).alias("_rr"), F.var_pop(c).alias("_cc"), F.covar_pop(r, c).alias("_rc"))
    a, b, k = F.col("_rr") + 1 / 12, F.col("_cc") + 1 / 12, F.col("_rc")
    root = F.sqrt((a - b) * (a - b) / 4 + k * k)
    big, small = (a + b) / 2 + root, (a + b) / 2 - root
    return m.select("label", "area", F.sqrt(F.greatest(F.lit(0.0), 1 - small / big)).alias("eccentricity"))


def image_statistics(pixels: DataFrame, mask: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Per label and channel: min, median, mean, max and interquartile range; NaN pixels are left out."""
    rows = pixels.where(F.col("value").isNotNull() & ~F.isnan("value")).join(mask.where("label > 0"), ["row", "col"])
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    s = rows.groupBy("label", *by).agg(F.min("value").alias("min"), q.alias("_q"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    return s.select("label", *by, "min", F.col("_q")[1].alias("median"), "mean", "max", (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"))


def max_projection(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.max("value").alias("value"))


def zero_background(probabilities: DataFrame, mask: DataFrame) -> DataFrame:
    rows = probabilities.join(mask, ["row", "col"], "left")
    return rows.withColumn("value", F.when(F.coalesce("label", F.lit(0)) == 0, 0.0).otherwise(F.col("value"))).drop("label")


def tile_grid(extent: DataFrame, size: int, halo: int) -> DataFrame:
    """(ty, tx, core and tile bounds) for ``extent(height, width)``; halos are cut at the image's edge."""
    steps = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(c) / size) - 1))
    rows = extent.withColumn("ty", steps("height")).withColumn("tx", steps("width"))
    out = {}
    for t, n, a, z in (("ty", "height", "row0", "row1"), ("tx", "width", "col0", "col1")):
        low, high = F.col(t) * size, F.least((F.col(t) + 1) * size, F.col(n))
        out |= {f"core_{a}": low, f"core_{z}": high, f"tile_{a}": F.greatest(low - halo, F.lit(0)), f"tile_{z}": F.least(high + halo, F.col(n))}
    return rows.withColumns(out).drop("height", "width")


def stitch(objects: DataFrame, iou: float = 0.25, overlap: float = 0.5, rounds: int = 50) -> DataFrame:
    """(tile, label) of the objects that stay, from ``objects(tile, label, row, col, in_core)``.

    An object belongs to a tile if its centroid is in the core (``in_core``). Of two that overlap too much the
    one with the lower tile, then label, stays; a loser takes nobody out. Rounds settle chains.
    Of objects with the same pixels the first stands for all: it takes the others out if it stays, and whatever takes it out
    has the same overlap with them. Equal pixels are told by their number, box and two independent hashes.
    """
    every = objects.where("in_core").select("tile", "label", "row", "col")
    hashed = lambda seed: F.xxhash64(F.col("row").cast("long"), F.col("col").cast("long"), F.lit(seed))
    marks = {"n": F.count("*"), "_x": F.bit_xor(hashed(1)), "_s": F.try_sum(F.shiftright(hashed(2), 24))} | {f"_{c}{i}": f(c) for c in ("row", "col") for i, f in enumerate((F.min, F.max))}
    each = every.groupBy("tile", "label").agg(*(c.alias(name) for name, c in marks.items()))
    size = cut(each.groupBy(*marks).agg(F.min(F.struct("tile", "label")).alias("_o")).select("_o.*", "n"))
    own = every.join(size, ["tile", "label"], "left_semi")
    a, b = (own.select(F.col("tile").alias(f"tile_{s}"), F.col("label").alias(f"label_{s}"), "row", "col") for s in "ab")
    first = (F.col("tile_a") < F.col("tile_b")) | ((F.col("tile_a") == F.col("tile_b")) & (F.col("label_a") < F.col("label_b")))
    shared = a.join(b, ["row", "col"]).where(first).groupBy("tile_a", "label_a", "tile_b", "label_b").agg(F.count("*").alias("k"))
    for s in "ab":
        shared = shared.join(size.select(F.col("tile").alias(f"tile_{s}"), F.col("label").alias(f"label_{s}"), F.col("n").alias(f"n_{s}")), [f"tile_{s}", f"label_{s}"])
    clash = cut(shared.where((F.col("k") / (F.col("n_a") + F.col("n_b") - F.col("k")) >= iou) | (F.col("k") / F.col("n_b") >= overlap)).select("tile_a", "label_a", "tile_b", "label_b"))
    left = cut(size.select("tile", "label"))
    kept = None
    for _ in range(rounds):
        # An object whose rivals of lower rank are all settled stays; those it clashes with go.
        alive_a = left.select(F.col("tile").alias("tile_a"), F.col("label").alias("label_a"))
        alive_b = left.select(F.col("tile").alias("tile_b"), F.col("label").alias("label_b"))
        live = clash.join(alive_a, ["tile_a", "label_a"], "left_semi").join(alive_b, ["tile_b", "label_b"], "left_semi")
        lower = live.select(F.col("tile_b").alias("tile"), F.col("label_b").alias("label")).distinct()
        stays = cut(left.join(lower, ["tile", "label"], "left_anti"))
        kept = stays if kept is None else kept.unionByName(stays)
        goes = live.join(stays.select(F.col("tile").alias("tile_a"), F.col("label").alias("label_a")), ["tile_a", "label_a"], "left_semi").select(F.col("tile_b").alias("tile"), F.col("label_b").alias("label")).distinct()
        left = cut(left.join(stays, ["tile", "label"], "left_anti").join(goes, ["tile", "label"], "left_anti"))
        if left.isEmpty():
            return kept
    raise RuntimeError("overlaps did not settle")


def coarser(pixels: DataFrame, step: int, how: str, height: int, width: int, keys: Sequence[str] = ()) -> DataFrame:
    """Blocks of ``step`` pixels: mean rounded half to even, or max; partial blocks at the ends are left out."""
    rows = pixels.where((F.col("row") < height // step * step) & (F.col("col") < width // step * step))
    value = F.rint(F.avg("value")) if how == "mean" else F.max("value")
    return rows.groupBy(*keys, F.floor(F.col("row") / step).alias("row"), F.floor(F.col("col") / step).alias("col")).agg(value.alias("value"))


def outline(mask: DataFrame, dilate: int = 0) -> DataFrame:
    """(row, col) of foreground pixels with another label beside, above or below; the image's border is none.

    The table holds every pixel, so neighbours are the rows before and after along either axis.
    """
    across, down = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")
    differs = F.lit(False)
    for w in (across, down):
        for n in (F.lag("label").over(w), F.lead("label").over(w)):
            differs = differs | F.coalesce(n != F.col("label"), F.lit(False))
    edge = mask.withColumn("_d", differs).where("_d AND label > 0").select("row", "col")
    if not dilate:
        return edge
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-dilate, dilate + 1) for j in range(-dilate, dilate + 1) if abs(i) + abs(j) <= dilate)))
    wide = edge.withColumn("_o", around).select((F.col("row") + F.col("_o.i")).alias("row"), (F.col("col") + F.col("_o.j")).alias("col")).distinct()
    return wide.join(mask.where("label > 0"), ["row", "col"], "left_semi")


def grid_rows(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin number with the closed right edge in the last bin."""
    return F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1))

"""Nearest searches by bounds over a pyramid of tiles.

Points and targets lie in leaves of their own pyramids: square tiles of one grid, sixteen to a tile of the level
above, split until a leaf holds few rows. A node knows its number of rows and the box around them. Pairs of nodes
go down both pyramids together; a pair is left out when the least distance of its boxes is beyond the greatest
distance at which the node's points surely have as many targets as they want. So far points, dense places
and empty ones cost about the same, and no round compares all with all.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut

#: Levels below the tile that spans everything: a leaf's side is at least its side over 4^13.
LEVELS = 13
_PLACE = 27
#: A leaf whose points have more targets left than this is dealt with point by point.
WIDE = 4096
#: Rows of a leaf of points, and of one in a bulk, whose leaves of more than FULL targets are split down to the former.
FEW, BULK, FULL = 32, 2048, 1024
_BOX = ["x0", "y0", "x1", "y1"]


class Grid(NamedTuple):
    x: float
    y: float
    size: float


def finite(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return out


def _tile(grid: Grid, level: int, c: str, at: float) -> Column:
    return F.floor((F.col(c) - at) / (grid.size / 4.0**level)).cast("long")


def _node(level: Column, x: Column, y: Column) -> Column:
    return F.shiftleft(level.cast("long"), 2 * _PLACE).bitwiseOR(F.shiftleft(x, _PLACE)).bitwiseOR(y)


def leaves(rows: DataFrame, most: int, written: bool = False) -> DataFrame | None:
    """``rows(cx, cy)`` from a checkpoint, unless they are ``written`` already, with ``_node``, the leaf of each; None if there are none.

    The first level is the one on which an occupied tile has a quarter to half of ``most`` rows, by estimates of the
    number of occupied tiles on all levels of two grids; tiles with more than ``most`` are split level by
    level, down to the last.
    """
    rows = rows if written else cut(rows)
    n, x, y, x1, y1 = rows.agg(F.count("*"), F.min("cx"), F.min("cy"), F.max("cx"), F.max("cy")).first()
    if not n:
        return None
    side = max(x1 - x, y1 - y, 2.0**-500)
    near = 2.0 ** math.ceil(math.log2(side))
    grids = [Grid(x, y, near), Grid(x, y, 2 * near)]
    places = lambda g, i: (_tile(g, i, "cx", x), _tile(g, i, "cy", y))
    all_levels = [(g, i) for i in range(1, LEVELS + 1) for g in (grids[1], grids[0])]  # from wide tiles to narrow ones
    met = rows.agg(*(F.approx_count_distinct(F.struct(*places(g, i))) for g, i in all_levels)).first()
    grid, level = next((at for at, k in zip(all_levels, met) if 2 * n <= most * k), (grids[0], LEVELS))
    tiles = lambda i: places(grid, i)
    done, left = None, rows
    while True:
        left = cut(left.withColumn("_node", _node(F.lit(level), *tiles(level))))
        full = left.groupBy("_node").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_node")
        if level == LEVELS or full.isEmpty():
            return left if done is None else done.unionByName(left)
        full = cut(full)
        small = left.join(full, "_node", "left_anti")
        done = small if done is None else done.unionByName(small)
        left, level = left.join(full, "_node", "left_semi"), level + 1


def nodes_of(rows: DataFrame) -> DataFrame:
    """All nodes over ``rows(_node, x0, y0, x1, y1)``: id, level, up (the parent), leaf, n and the box, checkpointed."""
    box = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    low = rows.groupBy("_node").agg(F.count("*").alias("n"), *box)
    low = low.withColumns({"_l": F.shiftright("_node", 2 * _PLACE), "_k": F.explode(F.expr(f"sequence(0, cast(shiftright(_node, {2 * _PLACE}) AS INT) - 1)"))})
    mask = (1 << _PLACE) - 1
    x, y = (F.expr(f"shiftright({at} & {mask}, 2 * _k)") for at in (f"shiftright(_node, {_PLACE})", "_node"))
    every = low.withColumns({"id": _node(F.col("_l") - F.col("_k"), x, y), "level": F.col("_l") - F.col("_k")})
    every = every.groupBy("id", "level").agg(F.sum("n").alias("n"), *box, F.max(F.col("_k") == 0).alias("leaf"))
    x, y = (F.expr(f"shiftright({at} & {mask}, 2)") for at in (f"shiftright(id, {_PLACE})", "id"))
    return cut(every.withColumn("up", _node(F.col("level") - 1, x, y)))


def _gap(a0: str, a1: str, b0: str, b1: str) -> Column:
    return F.greatest(F.lit(0.0), F.col(b0) - F.col(a1), F.col(a0) - F.col(b1))


def _reach(a0: str, a1: str, b0: str, b1: str) -> Column:
    return F.greatest(F.abs(F.col(a1) - F.col(b0)), F.abs(F.col(b1) - F.col(a0)))


def _pruned(pairs: DataFrame, need: int) -> DataFrame:
    """Pairs (p, box px0.., t, n, box x0..) whose boxes may hold one of the ``need`` nearest targets of p's points."""
    far = F.hypot(_reach("px0", "px1", "x0", "x1"), _reach("py0", "py1", "y0", "y1"))
    near = F.hypot(_gap("px0", "px1", "x0", "x1"), _gap("py0", "py1", "y0", "y1"))
    rows = pairs.withColumns({"_far": far, "_near": near})
    whole = Window.partitionBy("p")
    sure = F.min("_far").over(whole)
    if need > 1:
        rows = rows.withColumn("_sum", F.sum("n").over(whole.orderBy("_far").rowsBetween(Window.unboundedPreceding, 0)))
        sure = F.min(F.when(F.col("_sum") >= need, F.col("_far"))).over(whole)
    rows = rows.withColumn("_sure", sure)
    return rows.where(within("_near")).drop("_far", "_near", "_sum")


def within(distance: Column | str) -> Column:
    """Whether a distance is in the reach ``_sure`` in which a node's points have all their nearest; null has no bound."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.col("_sure").isNull() | (d <= F.col("_sure") * (1 + 1e-9))


def _kids(nodes: DataFrame, level: int) -> DataFrame:
    """What the nodes of one level become on the next: their children, or themselves if they are leaves."""
    down = nodes.where(F.col("level") == level + 1).select("up", "id", "n", *_BOX)
    same = nodes.where(F.col("leaf") & (F.col("level") <= level)).select(F.col("id").alias("up"), "id", "n", *_BOX)
    return down.unionByName(same)


def _of_points(nodes: DataFrame) -> DataFrame:
    return nodes.select(*(F.col(c).alias(f"p{c}") for c in _BOX), F.col("id").alias("p"), *(["up"] if "up" in nodes.columns else []))


def _down(points: DataFrame, targets: DataFrame, need: int, deepest: int) -> DataFrame:
    """Pairs (p, t, n, boxes) of leaves that may matter, from the nodes of both."""
    top = lambda nodes: nodes.where(F.col("level") == 1).withColumn("up", F.lit(0).cast("long"))
    # At most 25 nodes a side stand on the first level of a grid; single points each meet those of the targets.
    pairs = _of_points(top(points)).join(top(targets).select("up", F.col("id").alias("t"), "n", *_BOX), "up").drop("up")
    pairs = _pruned(pairs, need)
    for level in range(1, deepest):
        below = pairs.select("p", "t").join(_of_points(_kids(points, level)).withColumnsRenamed({"p": "_p", "up": "p"}), "p").drop("p")
        below = below.join(_kids(targets, level).withColumnsRenamed({"up": "t", "id": "_t"}), "t").drop("t")
        pairs = _pruned(below.withColumnsRenamed({"_p": "p", "_t": "t"}), need)
        if level % 3 == 0:
            pairs = cut(pairs)
    return pairs


def candidates(points: DataFrame, targets: DataFrame, need: int, most: int = FEW, most_targets: int = 16, bulk: bool = False) -> tuple[DataFrame, DataFrame, int] | None:
    """``points(cx, cy, ...)`` with ``_node``, (_node, _sure, targets' columns) of all targets that may be among the ``need``
    nearest of a node's points, and a bound of the rows of both; both sides carry finite ``cx cy x0 y0 x1 y1``. None if either is empty.

    In a ``bulk`` the leaves of points are about as many as those of targets, so many points share one list of targets, where
    that list stays under FULL.
    """
    t = leaves(targets, most_targets)
    if t is None:
        return None
    if bulk:
        points = cut(points)
        most = max(most, min(BULK, most_targets * points.count() // t.count()))
    p = leaves(points, most, bulk)
    if p is None:
        return None
    tn = nodes_of(t)
    deepest = lambda *of: max(nodes.agg(F.max("level")).first()[0] for nodes in of)
    met, held = [], []
    while True:
        pn = nodes_of(p)
        pairs = cut(_down(pn, tn, need, deepest(pn, tn)))
        wide = pairs.groupBy("p").agg(F.sum("n").alias("_n")).where(F.col("_n") > (FULL if most > FEW else WIDE)).select(F.col("p").alias("_node"))
        # Leaves of the second turn are of another grid, so their ids are moved apart.
        apart = F.lit(len(met) << 60)
        renamed = lambda rows, c: rows.withColumn(c, F.col(c) + apart)  # noqa: E731, B023
        if wide.isEmpty():
            met, held = [*met, renamed(pairs, "p")], [*held, renamed(p, "_node")]
            break
        wide = cut(wide)
        met.append(renamed(pairs.join(wide.withColumnRenamed("_node", "p"), "p", "left_anti"), "p"))
        held.append(renamed(p.join(wide, "_node", "left_anti"), "_node"))
        rest = p.join(wide, "_node", "left_semi")
        if most > FEW:
            p, most = leaves(rest.drop("_node"), FEW), FEW
            continue
        single = cut(rest.withColumn("_node", -1 - F.monotonically_increasing_id()))
        own = single.select(F.col("_node").alias("id"), F.lit(1).cast("long").alias("level"), F.lit(0).cast("long").alias("up"), F.lit(True).alias("leaf"), F.lit(1).cast("long").alias("n"), *_BOX)
        met, held = [*met, cut(_down(own, tn, need, deepest(tn)))], [*held, single]
        break
    pairs, p = (reduce(DataFrame.unionByName, parts) for parts in (met, held))
    size = p.count() + (pairs.agg(F.sum("n")).first()[0] or 0)
    rows = pairs.select("p", *(f"p{c}" for c in _BOX), F.col("t").alias("_node")).join(t, "_node").withColumn("n", F.lit(1)).drop("_node")
    return p, _pruned(rows, need).drop("n", *(f"p{c}" for c in _BOX), *_BOX, "cx", "cy").withColumnRenamed("p", "_node"), size

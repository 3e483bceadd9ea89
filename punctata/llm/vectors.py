"""Embedding near-duplicates by PCA-ordered tiled comparison.

Distinct unit vectors are rotated to principal axes fitted on a bounded sample (the rotation keeps every
cosine; the sample only decides speed). Tiles are the leaves of a kd-tree on the leading axes, again
from the sample; exact boxes of all tiles say which pairs of tiles can hold a link. Tiles are cut into
blocks of bounded size, and each pair of blocks in reach is one group: leading dimensions are
accumulated first, the products still to come are bounded by the norms of the remaining suffixes, and a
pair is given up as soon as its cosine cannot reach the threshold. A pair of blocks hands on link counts
and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctata.llm.common import components, stored
from punctata.llm.simhash import forest

#: Cosines this close to the threshold are computed again from the vectors as given.
CLOSE = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(column))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Tiles:
    """A kd-tree on the leading axes: split values by level, as a heap; leaves are numbered left to right."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.at = np.zeros((1 << depth) - 1, int), np.zeros((1 << depth) - 1)
        todo = [(0, points)]
        while todo:
            i, p = todo.pop()
            if i >= len(self.axis):
                continue
            if len(p):
                self.axis[i] = int(np.argmax(p.var(axis=0)))
                self.at[i] = np.median(p[:, self.axis[i]])
            left = p[:, self.axis[i]] <= self.at[i]
            todo += [(2 * i + 1, p[left]), (2 * i + 2, p[~left])]

    def of(self, points: np.ndarray) -> np.ndarray:
        i = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            i = 2 * i + 1 + (points[np.arange(len(points)), self.axis[i]] > self.at[i])
        return i - ((1 << self.depth) - 1)


def links_of(a: np.ndarray, b: np.ndarray, threshold: float, rotation: np.ndarray, exact_a: np.ndarray, exact_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs whose cosine reaches ``threshold``.

    ``exact_*`` are unit vectors as given, ``a`` and ``b`` the same after ``rotation``, widest axis first.
    """
    width = a.shape[1]
    stops = [x for x in (8, 16, 32, 64, 128, 256, 512) if x < width] + [width]
    done = stops[0]
    got = a[:, :done] @ b[:, :done].T
    i = j = None
    for stop in [*stops[1:], None]:
        rest_a, rest_b = (np.sqrt(np.maximum(0, (x[:, done:] ** 2).sum(axis=1))) for x in (a, b))
        if i is None:
            alive = got + rest_a[:, None] * rest_b[None, :] >= threshold - CLOSE
            if stop is None or alive.mean() < 0.1:
                i, j = np.nonzero(alive)
                got = got[i, j]
        else:
            keep = got + rest_a[i] * rest_b[j] >= threshold - CLOSE
            i, j, got = i[keep], j[keep], got[keep]
        if stop is None:
            break
        if i is None:
            got += a[:, done:stop] @ b[:, done:stop].T
        else:
            got = got + np.concatenate([np.einsum("ij,ij->i", a[i[k : k + 65536], done:stop], b[j[k : k + 65536], done:stop]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
        done = stop
    near = np.flatnonzero(np.abs(got - threshold) <= CLOSE)
    got[near] = np.einsum("ij,ij->i", exact_a[i[near]], exact_b[j[near]])
    keep = got >= threshold
    return i[keep], j[keep]


def similar_vectors(vectors: DataFrame, threshold: float = 0.9, sample: int = 8_000, axes: int = 8, most_tiles: int = 1024, block: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Rows link when the cosine of their vectors, in double precision, is at least ``threshold``. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing; shorter vectors are
    compared as if padded with zeros. ``n_links`` counts other rows linked directly; ``component_id`` is the
    least vec_id that links reach, itself included; ``kept`` says whether it is the row's own. Equal
    vectors are one node with a weight, so copies are never compared; a repeated row is a copy. A null
    vec_id takes no part in the minimum, and its ``kept`` is null. An empty table gives no rows; other columns
    are not read.

    At most ``sample`` vectors and ``most_tiles`` boxes come to the driver. A vector goes only to tiles whose
    box is in its own reach. ``block`` bounds the rows of either side of a group; small inputs are cut into
    about a dozen blocks all the same.
    """
    spark = vectors.sparkSession
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.col("embedding")).alias("v"))
    distinct = stored(rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id()), "vectors")
    width, count = distinct.agg(F.max(F.size("v")), F.count("*")).first()
    if not count:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), (F.col("vec_id") == F.col("vec_id")).alias("kept"))
    drawn = distinct.orderBy(F.xxhash64("v", F.lit("pca"))).limit(min(sample, max(64, 4_000_000 // width))).select("v").toArrow()
    seen = _units(_matrix(drawn.column("v"), width))
    values, axes_found = np.linalg.eigh(seen.T @ seen)
    rotation = np.ascontiguousarray(axes_found[:, ::-1])
    lead = min(axes, width)
    size = max(64, min(block, -(-count // 12)))
    depth = max(0, min(int(np.log2(most_tiles)), int(np.log2(max(1, count / size))), int(np.log2(max(1, len(seen) / 8)))))
    tree = Tiles((seen @ rotation)[:, :lead], depth)

    def boxed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, held = np.full((1 << depth, lead), np.inf), np.full((1 << depth, lead), -np.inf), np.zeros(1 << depth, np.int64)
        for b in frames:
            p = (_units(_matrix(b.column("v"), width)) @ rotation)[:, :lead]
            t = tree.of(p)
            np.minimum.at(low, t, p)
            np.maximum.at(high, t, p)
            held += np.bincount(t, minlength=1 << depth)
        full = np.flatnonzero(held)
        if len(full):
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full]), pa.array(low[full].tolist()), pa.array(high[full].tolist())], ["tile", "n", "low", "high"])

    parts = distinct.select("v").mapInArrow(boxed, "tile long, n long, low array<double>, high array<double>")
    at = [F.col(side)[k] for side in ("low", "high") for k in range(lead)]
    sums = parts.groupBy("tile").agg(F.sum("n").alias("n"), *(f(c) for f, cs in ((F.min, at[:lead]), (F.max, at[lead:])) for c in cs)).collect()
    low, high, held = np.full((1 << depth, lead), np.inf), np.full((1 << depth, lead), -np.inf), np.zeros(1 << depth, np.int64)
    for r in sums:
        held[r[0]], low[r[0]], high[r[0]] = r[1], r[2 : 2 + lead], r[2 + lead :]
    blocks = -(-held // size)
    reach = 2 - 2 * threshold + 1e-6
    partners: list[np.ndarray] = []
    for t in range(1 << depth):
        gap = np.maximum(0, np.maximum(low - high[t], low[t] - high))
        near = np.where(held > 0, (gap * gap).sum(axis=1) <= reach, False) if held[t] else np.zeros(1 << depth, bool)
        partners.append(np.flatnonzero(near))

    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            p = (_units(_matrix(b.column("v"), width)) @ rotation)[:, :lead]
            tile = tree.of(p)
            own = (b.column("node").to_numpy(zero_copy_only=False).view(np.uint64) % np.maximum(1, blocks[tile]).astype(np.uint64)).astype(np.int64)
            rows, others = [], []
            for t in np.unique(tile).tolist():
                mine = np.flatnonzero(tile == t)
                for u in partners[t].tolist():
                    gap = np.maximum(0, np.maximum(low[u] - p[mine], p[mine] - high[u]))
                    near = mine[(gap * gap).sum(axis=1) <= reach]
                    for j in range(int(blocks[u])):
                        rows.append(near)
                        others.append(np.full((len(near), 2), (u, j)))
            row, other = np.concatenate(rows), np.concatenate(others)
            for at in range(0, len(row), 8192):
                r, (u, j) = row[at : at + 8192], other[at : at + 8192].T
                t, i = tile[r], own[r]
                left = (t < u) | ((t == u) & (i <= j))
                key = (np.where(left, t, u), np.where(left, i, j), np.where(left, u, t), np.where(left, j, i))
                mine = b.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([*map(pa.array, key), pa.array(left), mine.column("node"), mine.column("n"), mine.column("v")], ["ta", "ia", "tb", "ib", "left", "node", "n", "v"])

    def compared(table: pa.Table) -> pa.Table:
        same = table.column("ta")[0] == table.column("tb")[0] and table.column("ia")[0] == table.column("ib")[0]
        side = table.column("left").to_numpy()
        v, node, n = _units(_matrix(table.column("v"), width)), table.column("node").to_numpy(), table.column("n").to_numpy()
        r = v @ rotation
        x = np.flatnonzero(side)
        y = x if same else np.flatnonzero(~side)
        total = np.zeros(len(node), np.int64)
        one, two = [], []
        for s in range(0, len(x), 1024):
            for z in range(s if same else 0, len(y), 4096):
                p, q = x[s : s + 1024], y[z : z + 4096]
                i, j = links_of(r[p], r[q], threshold, rotation, v[p], v[q])
                if same:
                    keep = p[i] < q[j]
                    i, j = i[keep], j[keep]
                if len(i):
                    np.add.at(total, p[i], n[q[j]])
                    np.add.at(total, q[j], n[p[i]])
                    c, d = forest(node[p[i]], node[q[j]])
                    one.append(c)
                    two.append(d)
        c, d = forest(np.concatenate(one), np.concatenate(two)) if one else (node[:0], node[:0])
        some = np.flatnonzero(total)
        return pa.table({
            "a": pa.array(np.concatenate([node[some], c])),
            "b": pa.array(np.concatenate([node[some], d])),
            "n": pa.array(np.concatenate([total[some], np.zeros(len(c), np.int64)])),
        })

    kind = dict(distinct.dtypes)["v"]
    found = stored(
        distinct.select("node", "n", "v").mapInArrow(dealt, f"ta long, ia long, tb long, ib long, left boolean, node long, n long, v {kind}").groupBy("ta", "ia", "tb", "ib").applyInArrow(compared, "a long, b long, n long"),
        "links",
    )
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    named = components(found.where("n = 0").select("a", "b"))
    nodes = distinct.join(counts, "node", "left").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = nodes.join(first, "component").select("v", (F.coalesce("others", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.where("v is not null").join(known, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

"""Sharding by a hierarchical weighted hash tree: region, rack and shard levels.

A document descends the tree. At each level every child draws ``-ln(u) / weight`` with ``u`` a hash of
the document's key and the child's path, and the least draw wins: a child is chosen in proportion to
its weight, and a child's draw depends on nothing but its own path and weight. So when weights change,
rows move only into or out of subtrees whose weights changed. A shard beyond the tree's base opens a
region of its own: growing by one takes rows from all others, and only into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (region, rack, shard, weight)
Leaf = tuple[str, str, int, float]


def default_tree(shards: int, base: int | None = None, racks: int = 2, per_rack: int = 2) -> list[Leaf]:
    """The first ``base`` shards (all, if not given) fill racks of ``per_rack`` and regions of ``racks`` in turn,
    all of one weight; each further shard is a region of its own.

    A layout that grows keeps its ``base``: then one shard more takes rows only into itself.
    """
    out = []
    for s in range(shards):
        if s < (shards if base is None else base):
            region, inside = divmod(s, racks * per_rack)
            out.append((f"g{region}", f"k{inside // per_rack}", s, 1.0))
        else:
            out.append((f"own{s}", "k0", s, 1.0))
    return out


def _draw(key: Column, path: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def _choose(key: Column, prefix: str, children: Sequence[tuple[str, float, Column]]) -> Column:
    """The value of the child with the least draw; children are (name, weight, value)."""
    children = [c for c in children if c[1] > 0]
    if len(children) == 1:
        return children[0][2]
    draws = [F.struct(_draw(key, f"{prefix}/{name}", w).alias("d"), F.lit(i).alias("i")) for i, (name, w, _) in enumerate(children)]
    best = F.array_min(F.array(*draws))["i"]
    out = F.when(best == 0, children[0][2])
    for i, (_, _, value) in enumerate(children[1:], 1):
        out = out.when(best == i, value)
    return out


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard that ``key`` descends to; weights of racks and regions are the sums of their shards'."""
    regions: dict[str, dict[str, list[tuple[int, float]]]] = {}
    for region, rack, shard, weight in tree:
        regions.setdefault(region, {}).setdefault(rack, []).append((shard, weight))

    def rack_value(path: str, leaves: list[tuple[int, float]]) -> Column:
        return _choose(key, path, [(str(s), w, F.lit(s)) for s, w in leaves])

    def region_value(region: str, racks: dict[str, list[tuple[int, float]]]) -> Column:
        return _choose(key, region, [(k, sum(w for _, w in v), rack_value(f"{region}/{k}", v)) for k, v in racks.items()])

    return _choose(key, "", [(r, sum(w for v in racks.values() for _, w in v), region_value(r, racks)) for r, racks in regions.items()])


def shard_documents(docs: DataFrame, shards: int = 8, base: int | None = None, tree: Sequence[Leaf] | None = None, buckets: int = 4096) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs(doc_id, text)``.

    ``size``: UTF-8 bytes of the text (null: none) plus 1. ``shard`` depends on doc_id and the tree alone
    (a null doc_id is hashed as null); ``grown_shard`` is the shard in the tree with one shard more, which is
    ``shard`` for ``shards + 1`` and the ``base`` of this layout (``shards`` if not given).
    ``slot`` numbers a shard's rows from 0 without gaps, by a hash bucket of doc_id and text, then by both:
    bucket counts (at most shards x ``buckets`` rows) give each bucket's first slot, and rows are ranked inside
    a bucket, so no task holds a whole shard, whatever doc_id its rows repeat. Null texts are empty; very long
    ones only send their size and crc32; other columns are not read. Repeated rows get slots of their own; an
    empty table gives no rows.
    """
    tree = list(tree or default_tree(shards, base))
    grown = [*tree, (f"own{len(tree)}", "k0", len(tree), 1.0)]
    raw = F.encode("text", "UTF-8")
    key = F.col("doc_id")
    rows = docs.select("doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, grown).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(key, "text", F.lit("slot")), F.lit(buckets)).cast("int").alias("bucket"),
    )
    w = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.withColumn("inside", F.row_number().over(w) - 1)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    return ranked.join(first, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "law", "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"), "grown_shard")

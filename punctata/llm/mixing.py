"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources that hold them. Word capacity flows from each pattern to
the quotas of its sources; an epoch more of the same pattern costs more (convex repetition costs), so
quotas are filled with as little repetition as they allow. The flow runs on the aggregates alone (one
node for a pattern, one for a source). Then documents are taken: whole epochs of a pattern take all of
its documents, the rest takes documents in seeded order up to the words that are left.
"""

from __future__ import annotations

import heapq
import math
from collections import deque
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctata.llm.common import free_names, stored

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Mapping, weights: Mapping, epochs: int = 3) -> dict:
    """Share the sum of ``sizes`` by weight; none above ``epochs`` times its size, the excess is reshared."""
    left, open_ = float(sum(sizes.values())), list(sizes)
    out = {k: 0.0 for k in sizes}
    while open_:
        total = sum(weights[k] for k in open_)
        share = {k: left * weights[k] / total for k in open_}
        full = [k for k in open_ if share[k] > epochs * sizes[k]]
        if not full:
            return out | share
        for k in full:
            out[k] = float(epochs * sizes[k])
            left -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def min_cost_flow(capacity: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], epochs: int = 3) -> list[dict[int, int]]:
    """Words from each pattern to each of its sources, by successive cheapest paths.

    Pattern p gives ``capacity[p]`` words at cost 0, as many again at cost 1, at cost 3, ... (convex, so
    cheaper epochs fill first); ``members[p]`` are its sources, ``quotas`` their limits. Potentials keep
    reduced costs from being negative; all cheapest paths of one cost are filled together, by levels, so
    there is one search for a cost and not one for a path.
    """
    n_p, n_s = len(capacity), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    to, room, cost, arcs = [], [], [], [[] for _ in range(end + 1)]

    def arc(a: int, b: int, most: int, price: int) -> int:
        for x, y, m, c in ((a, b, most, price), (b, a, 0, -price)):
            arcs[x].append(len(to))
            to.append(y)
            room.append(m)
            cost.append(c)
        return len(to) - 2

    for p, c in enumerate(capacity):
        for e in range(epochs):
            arc(start, p, int(c), e * (e + 1) // 2)
    routes = [(p, s, arc(p, n_p + s, epochs * int(capacity[p]), 0)) for p in range(n_p) for s in members[p]]
    for s, q in enumerate(quotas):
        arc(n_p + s, end, int(q), 0)
    height = [0] * (end + 1)

    def fill() -> bool:
        """Fills all shortest ways (in arcs) over arcs of reduced cost zero; false where there is none."""
        level, queue = [-1] * (end + 1), deque([start])
        level[start] = 0
        while queue:
            a = queue.popleft()
            for k in arcs[a]:
                b = to[k]
                if room[k] > 0 and level[b] < 0 and cost[k] + height[a] == height[b]:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[end] < 0:
            return False
        tried, path, a = [0] * (end + 1), [], start
        while True:
            if a == end:
                most = min(room[k] for k in path)
                for k in path:
                    room[k] -= most
                    room[k ^ 1] += most
                full = next(i for i, k in enumerate(path) if not room[k])
                a = to[path[full] ^ 1]
                del path[full:]
            while tried[a] < len(arcs[a]):
                k = arcs[a][tried[a]]
                if room[k] > 0 and level[to[k]] == level[a] + 1 and cost[k] + height[a] == height[to[k]]:
                    path.append(k)
                    a = to[k]
                    break
                tried[a] += 1
            else:
                if a == start:
                    return True
                a = to[path.pop() ^ 1]
                tried[a] += 1

    while True:
        far = [math.inf] * (end + 1)
        far[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            for k in arcs[a] if d == far[a] else ():
                x = d + cost[k] + height[a] - height[to[k]]
                if room[k] > 0 and x < far[to[k]]:
                    far[to[k]] = x
                    heapq.heappush(heap, (x, to[k]))
        if far[end] == math.inf:
            break
        height = [h + min(f, far[end]) for h, f in zip(height, far, strict=True)]
        while fill():
            pass
    out: list[dict[int, int]] = [{} for _ in range(n_p)]
    for p, s, k in routes:
        if room[k ^ 1]:
            out[p][s] = room[k ^ 1]
    return out


def _refill(rows: pd.DataFrame) -> pd.DataFrame:
    """Which of at most 24 documents to take so that their words come nearest to what is left for them."""
    rows = rows.sort_values("place")
    left = int(rows["gap"].iloc[0] + (rows["extra"] * rows["size"]).sum())
    reach = [1]  # bit n: n words can be reached with the first documents
    for n in rows["size"].tolist():
        reach.append(reach[-1] | reach[-1] << n)
    below = reach[-1] & ((1 << (left + 1)) - 1)
    above = reach[-1] >> (left + 1)
    best = below.bit_length() - 1
    if above:
        first = left + (above & -above).bit_length()
        best = first if first - left < left - best else best
    take = []
    for k in range(len(rows), 0, -1):
        n = int(rows["size"].iloc[k - 1])
        use = not reach[k - 1] >> best & 1
        best -= n * use
        take.append(int(use))
    return pd.DataFrame({"pattern": rows["pattern"], "bucket": rows["bucket"], "nth": rows["nth"], "copy": rows["copy"], "filled": take[::-1]})


def row_hash(seed: int = 0) -> Column:
    """The hash that puts the rows of a mix in their seeded order."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(seed))


def mix(docs: DataFrame, weights: Sequence[float] | Mapping = (5, 2, 1), epochs: int = 3, seed: int = 0, buckets: int = 1024, most_patterns: int = 20_000, piece: int = 4096) -> DataFrame:
    """(doc_id, size, members, source_size, target, taken, copies, h) for every row of ``docs(doc_id, text, source)``.

    ``source`` is a string, or an array of strings where sources overlap. ``size`` is the number of words
    in the text, 0 for a null text; a null source is a source of its own and comes last. ``weights`` is a
    mapping from source, or a sequence dealt to the sources in code-point order again and again.
    ``source_size`` and ``target`` are those of the document's first source; ``taken`` is ``copies`` times
    ``size`` and never above ``epochs`` times it. A source ends within one small document of its target.
    The choice depends on doc_id, text hash and ``seed`` only, so reruns agree. Equal rows are interchangeable
    and share ``h``, their hash: they are counted before anything else, and ``piece`` of them at a time have
    a place in the order, so a row that repeats without end is no task's whole work. An empty table gives no rows; very long texts only send their size and hash; other columns
    are not read. Sources and patterns are aggregates that the driver may hold: more than ``most_patterns``
    patterns raise an error.

    No task holds a source: the seeded order runs over ``buckets`` hash ranges of each pattern, first
    between ranges by their sums, then inside a range.
    """
    overlapping = dict(docs.dtypes)["source"].startswith("array")
    members = F.array_sort(F.array_distinct("source"), lambda a, b: F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), 1).when(b.isNull(), -1).when(a < b, -1).when(a > b, 1).otherwise(0)) if overlapping else F.array("source")
    h = row_hash(seed)
    sizes_of = docs.select("doc_id", "text", "source").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(members, F.array(F.lit(None).cast("string"))).alias("members"),
        h.alias("h"),
    )
    # Map keys may not be null, so patterns are joined by their JSON text.
    counted = sizes_of.withColumn("pattern", F.to_json("members", {"ignoreNullFields": "false"})).groupBy("doc_id", "size", "pattern", "h").agg(F.any_value("members").alias("members"), F.count("*").alias("rows"))
    rows = stored(counted, "sizes").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {piece}"))))
    rows = rows.withColumn("rows", F.least(F.lit(piece), F.col("rows") - F.col("piece") * piece)).withColumn("words", F.col("rows") * F.col("size"))
    rows = rows.withColumn("at", F.when(F.col("piece") == 0, F.col("h")).otherwise(F.xxhash64("h", "piece"))).withColumn("bucket", F.pmod("at", F.lit(buckets)).cast("int"))
    sums = rows.groupBy("pattern").agg(F.sum("words").alias("n"), F.any_value("members").alias("members")).limit(most_patterns + 1).collect()
    if len(sums) > most_patterns:
        raise ValueError(f"more than {most_patterns} membership patterns")
    sums.sort(key=lambda r: r.pattern)  # the flow's choice among equal ones follows this order
    names = sorted({s for r in sums for s in r.members}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(r.n for r in sums if s in r.members) for s in names}
    if not isinstance(weights, Mapping):
        weights = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(r.n for r in sums)
    wanted = targets(sizes, weights, epochs)
    if overlapping and sum(sizes.values()):  # a shared document's words exist once
        wanted = {s: x * total / sum(sizes.values()) for s, x in wanted.items()}
    place = {s: i for i, s in enumerate(names)}
    flows = min_cost_flow([r.n for r in sums], [[place[s] for s in r.members] for r in sums], [round(wanted[s]) for s in names], epochs)
    plan = []
    for r, flow in zip(sums, flows, strict=True):
        words = sum(flow.values())
        whole = words // r.n if r.n else 0
        plan.append((r.pattern, sizes[r.members[0]], float(wanted[r.members[0]]), whole, words - whole * r.n))
    spark = docs.sparkSession
    # At most most_patterns rows.
    plan_df = F.broadcast(spark.createDataFrame(plan, "pattern string, source_size long, target double, whole long, rest long"))
    by_bucket = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("pattern", "bucket").agg(F.sum("words").alias("n")).select("pattern", "bucket", F.coalesce(F.sum("n").over(by_bucket), F.lit(0).cast("long")).alias("before"))
    inside = Window.partitionBy("pattern", "bucket").orderBy("at", "h", "doc_id", "size", "piece").rowsBetween(Window.unboundedPreceding, 0)
    sure = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least("rows", F.expr("(rest - reached + words) div size")))).otherwise(F.when(F.col("reached") <= F.col("rest"), F.col("rows")).otherwise(0))
    chosen = stored(
        rows.withColumn("running", F.sum("words").over(inside))
        .withColumn("nth", F.row_number().over(inside))
        .join(starts, ["pattern", "bucket"])
        .join(plan_df, "pattern")
        .withColumn("reached", F.col("before") + F.col("running"))
        .withColumn("sure", sure.cast("long"))
        .select("doc_id", "size", "members", "pattern", "h", "nth", "bucket", "rows", "source_size", "target", "whole", "rest", "reached", "sure"),
        "chosen",
    )
    # The seeded order ends before or inside a document: the few documents next to its end are chosen anew.
    gap = chosen.groupBy("pattern").agg((F.max("rest") - F.sum(F.col("sure") * F.col("size"))).alias("gap"))
    near = F.explode(F.sequence(F.greatest(F.lit(1), F.col("sure") - 23), F.least("rows", F.col("sure") + 24)))
    edge = chosen.where((F.col("size") > 0) & (F.col("rest") > 0)).withColumn("copy", near).withColumn("off", F.abs(F.col("reached") - (F.col("rows") - F.col("copy")) * F.col("size") - F.col("rest")))
    nearest = Window.partitionBy("pattern").orderBy("off", "h", "bucket", "nth", "copy")
    edge = edge.withColumn("extra", (F.col("copy") <= F.col("sure")).cast("long")).withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= 24)
    edge = edge.join(F.broadcast(gap), "pattern").select("pattern", "bucket", "nth", "copy", "size", "extra", "gap", "place")  # at most most_patterns rows
    fill = edge.groupBy("pattern").applyInPandas(_refill, "pattern string, bucket int, nth int, copy long, filled long")
    fill = fill.groupBy("pattern", "bucket", "nth").agg(F.map_from_entries(F.collect_list(F.struct("copy", "filled"))).alias("filled"))  # 24 entries at most
    out = chosen.join(fill, ["pattern", "bucket", "nth"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    extra = F.coalesce(F.expr("filled[copy]"), (F.col("copy") <= F.col("sure")).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(F.least(F.lit(1), F.col("whole") + extra))
    return out.withColumn("copies", copies.cast("long")).select("doc_id", "size", "members", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "h")


def repeat_rows(docs: DataFrame, weights: Sequence[float] | Mapping = (5, 2, 1), epochs: int = 3, seed: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns under any names, each as often as ``mix`` takes it, or not at all.

    Rows of one doc_id and text share what the mix takes of them: evenly, the first ones once more; the task that
    numbers them keeps them on disk beyond some thousand rows. Null doc_ids, null and very long texts and empty tables as in ``mix``.
    """
    h, total, rows, nth, copies, copy, doc = free_names(docs, "h", "total", "rows", "nth", "copies", "copy", "doc")
    taken = mix(docs.select("doc_id", "text", "source"), weights, epochs, seed).groupBy(F.col("doc_id").alias(doc), F.col("h").alias(h)).agg(F.sum("copies").alias(total), F.count("*").alias(rows)).where(F.col(total) > 0)
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(F.col(doc)) & (row_hash(seed) == F.col(h)))
    each = Window.partitionBy(doc, h).orderBy(h)
    out = joined.withColumn(nth, F.row_number().over(each)).withColumn(copies, F.expr(f"`{total}` div `{rows}`") + (F.col(nth) <= F.col(total) % F.col(rows)).cast("long")).where(F.col(copies) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*(docs[c] for c in docs.columns))

"""Exact quantiles by rank: ranges are counted first, then only those that hold a wanted rank are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctata.functions.session import cut


def quantiles(rows: DataFrame, value: str, shares: Sequence[float], keys: Sequence[str] = (), buckets: int = 4096, few: int = 10_000, name: str = "quantiles") -> DataFrame:
    """(keys, ``name`` array<double>): the same as ``percentile``, linear between neighbours, nulls left out, NaN as greatest.

    Values are counted in ``buckets`` equal ranges of each group's span; only ranges that hold a wanted rank go on, and are divided
    again where they have over ``few`` different values. So no task holds a group, and a group's sort has
    ``few`` values a share and range at most: a value and its count for each of them.
    """
    keys = list(keys)
    g = F.struct(*keys) if keys else F.lit(0)
    base = rows.where(F.col(value).isNotNull()).select(g.alias("_g"), F.col(value).cast("double").alias("_v"))
    base = cut(base.groupBy("_g", "_v").agg(F.count("*").alias("_c")))
    sizes = base.groupBy("_g").agg(F.sum("_c").alias("_n"))
    # Each wanted rank, from 0: the two neighbours between which a share falls.
    share = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(s)).alias("s")) for i, s in enumerate(shares))))
    spot = sizes.withColumn("_s", share).withColumn("_at", (F.col("_n") - 1) * F.col("_s.s"))
    wanted = cut(spot.select("_g", F.col("_s.i").alias("_i"), (F.col("_at") - F.floor("_at")).alias("_f"), F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_rank")))
    ranks, left, before = wanted.select("_g", "_rank").distinct(), base, None
    ranks = ranks.select("_g", "_rank", F.lit(0).cast("long").alias("_under"), F.lit(0).cast("long").alias("_b"))
    values, turn = None, 0
    left = left.withColumn("_b", F.lit(0).cast("long"))
    while True:
        # A range is (_g, _b): the values in it, of which _under rows of the group are before.
        spans = left.groupBy("_g", "_b").agg(F.count("*").alias("_k"), F.min(F.when(F.abs("_v") < float("inf"), F.col("_v"))).alias("_lo"), F.max(F.when(F.abs("_v") < float("inf"), F.col("_v"))).alias("_hi"))
        spans = cut(spans)
        small = spans.where((F.col("_k") <= few) | F.col("_lo").isNull() | (F.col("_lo") >= F.col("_hi"))).select("_g", "_b")
        w = Window.partitionBy("_g", "_b").orderBy("_v")
        ends = left.join(small, ["_g", "_b"], "left_semi").withColumn("_to", F.sum("_c").over(w))
        found = ends.join(ranks, ["_g", "_b"]).where((F.col("_rank") - F.col("_under") < F.col("_to")) & (F.col("_rank") - F.col("_under") >= F.col("_to") - F.col("_c"))).select("_g", "_rank", "_v")
        values = found if values is None else values.unionByName(found)
        big = spans.join(small, ["_g", "_b"], "left_anti")
        if big.isEmpty():
            break
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        over = lambda at, a, z: F.floor((at / buckets - a / buckets) / (z / buckets - a / buckets) * (buckets - 2)).cast("long") + 1
        # Ranges of one sign over more than a factor of four are divided by logarithm, those of both signs by sign from the
        # second round on: so rounds are few however far the values are spread.
        part = F.when((lo > 0) & (hi > 4 * lo), over(F.log2(v), F.log2(lo), F.log2(hi))).when((hi < 0) & (lo < 4 * hi), over(-F.log2(-v), -F.log2(-lo), -F.log2(-hi)))
        part = part.when((lo <= 0) & (hi >= 0), F.signum(v).cast("long") + 2) if turn else part
        part = F.when(F.isnan(v) | (v > hi), buckets).when(v < lo, 0).otherwise(part.otherwise(over(v, lo, hi)))
        turn += 1
        split = left.join(big, ["_g", "_b"]).withColumn("_p", part)
        counts = split.groupBy("_g", "_b", "_p").agg(F.sum("_c").alias("_m"))  # at most ``buckets`` rows a range
        counts = counts.withColumn("_past", F.sum("_m").over(Window.partitionBy("_g", "_b").orderBy("_p")) - F.col("_m"))
        hit = ranks.join(counts, ["_g", "_b"]).where((F.col("_rank") - F.col("_under") >= F.col("_past")) & (F.col("_rank") - F.col("_under") < F.col("_past") + F.col("_m")))
        ranks = cut(hit.select("_g", "_rank", (F.col("_under") + F.col("_past")).alias("_under"), F.xxhash64("_b", "_p").alias("_b")))
        left = cut(split.select("_g", "_v", "_c", F.xxhash64("_b", "_p").alias("_b")).join(ranks.select("_g", "_b").distinct(), ["_g", "_b"], "left_semi"))
    both = wanted.join(values, ["_g", "_rank"]).groupBy("_g", "_i").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_f").alias("_f"))
    one = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") * (1 - F.col("_f")) + F.col("_hi") * F.col("_f"))
    out = both.groupBy("_g").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", one.alias("v")))), lambda x: x.v).alias(name))
    return out.select(*(F.col(f"_g.{k}").alias(k) for k in keys), name)

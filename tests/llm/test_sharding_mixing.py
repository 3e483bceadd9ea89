import random
import time
import zlib
from collections import Counter, defaultdict

import pytest
from data import SF, frame, texts

from punctata.llm import mixing, sharding


def test_shards(spark):
    for docs in (frame(spark, texts()), spark.read.parquet(f"{SF}/documents.parquet")):
        rows = sharding.shard_documents(docs).collect()
        want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
        slots = defaultdict(list)
        for r in rows:
            assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(slots) == 8


def test_growth_and_weights(spark):
    ids = spark.range(4000).withColumnRenamed("id", "k")
    tree = sharding.default_tree(8)
    heavier = [(g, k, s, 3.0 if s == 1 else w) for g, k, s, w in tree]
    a = {r.k: (r.a, r.b, r.c) for r in ids.select("k", sharding.shard_of(ids.k, tree).alias("a"), sharding.shard_of(ids.k, heavier).alias("b"), sharding.shard_of(ids.k, sharding.default_tree(9)).alias("c")).collect()}
    counts = Counter(x[0] for x in a.values())
    assert all(400 < counts[s] < 600 for s in range(8))
    assert all(c in (x, 8) for x, _, c in a.values())
    region = {s: g for g, _, s, _ in tree}
    rack = {s: (g, k) for g, k, s, _ in tree}
    for x, y, _ in a.values():
        if x != y and region[x] == region[y]:
            assert rack[y] == rack[1] or region[y] == region[1]
        if x != y and region[x] != region[y]:
            assert region[y] == region[1]
    shares = Counter(y for _, y, _ in a.values())
    assert 1000 < shares[1] < 1400


def test_targets():
    sizes = {"a": 10, "b": 1000, "c": 1000, None: 0}
    got = mixing.targets(sizes, {"a": 5, "b": 2, "c": 1, None: 5})
    assert got["a"] == 30 and got[None] == 0
    assert got["b"] + got["c"] == pytest.approx(1980) and got["b"] == pytest.approx(1320)


def _brute(capacity, members, quotas, epochs):
    """Cheapest full routing over a small integer grid."""
    import itertools

    arcs = [(p, s) for p in range(len(capacity)) for s in members[p]]
    best = None
    for x in itertools.product(*(range(min(epochs * capacity[p], quotas[s]) + 1) for p, s in arcs)):
        out, into = [0] * len(capacity), [0] * len(quotas)
        for (p, s), n in zip(arcs, x, strict=True):
            out[p] += n
            into[s] += n
        if any(o > epochs * c for o, c in zip(out, capacity, strict=True)) or any(i > q for i, q in zip(into, quotas, strict=True)):
            continue
        cost = sum(max(0, min(c, o - e * c)) * e * (e + 1) // 2 for o, c in zip(out, capacity, strict=True) for e in range(epochs))
        if best is None or (-sum(x), cost) < best:
            best = (-sum(x), cost)
    return best


def test_flow_against_brute_force():
    r = random.Random(3)
    for _ in range(25):
        capacity = [r.randint(0, 3) for _ in range(3)]
        members = [[0], [1], [0, 1]]
        quotas = [r.randint(0, 6), r.randint(0, 6)]
        flow = mixing.min_cost_flow(capacity, members, quotas)
        out = [sum(f.values()) for f in flow]
        cost = sum(max(0, min(c, o - e * c)) * e * (e + 1) // 2 for o, c in zip(out, capacity, strict=True) for e in range(3))
        assert (-sum(out), cost) == _brute(capacity, members, quotas, 3)


def test_flow_of_many_patterns_ends_soon():
    r = random.Random(5)
    members = [sorted(r.sample(range(12), r.randint(1, 4))) for _ in range(8000)]
    capacity = [r.randint(1, 10_000) for _ in members]
    quotas = [int(sum(capacity) / 12 * f) for f in (0.5, 1.5) * 6]
    at = time.monotonic()
    flow = mixing.min_cost_flow(capacity, members, quotas)
    assert time.monotonic() - at < 30
    into = Counter()
    for c, m, f in zip(capacity, members, flow, strict=True):
        assert set(f) <= set(m) and sum(f.values()) <= 3 * c
        into.update(f)
    assert [into[s] for s in range(12)] == quotas


def test_rows_that_repeat_are_dealt_by_count(spark):
    few = spark.createDataFrame([(i, "w " * (i % 9), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    docs = few.union(spark.range(20_000).selectExpr("7L", "repeat('v ', 5)", "'a'"))
    rows = mixing.mix(docs, weights=(1, 2, 1), piece=64).collect()
    assert len(rows) == 20_300
    again = mixing.mix(docs.repartition(5), weights=(1, 2, 1), piece=64).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    taken, target = Counter(), {}
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r.members[0]] += r.taken
        target[r.members[0]] = r.target
    assert all(abs(taken[s] - target[s]) <= 9 for s in target), (taken, target)


def test_overlapping_sources_come_near_their_targets(spark):
    kinds = [["a"], ["b"], ["a", "b"], ["b", "c"], ["c", None]]
    docs = spark.createDataFrame([(i, "w " * (1 + i % 11), kinds[i % 5]) for i in range(2000)], "doc_id long, text string, source array<string>")
    rows = mixing.mix(docs, weights={"a": 3, "b": 1, "c": 1, None: 1}).collect()
    size, taken = Counter(), Counter()
    for r in rows:
        size.update({s: r["size"] for s in r.members})
        taken[tuple(r.members)] += r.taken
    words = sum(r["size"] for r in rows)
    wanted = {s: x * words / sum(size.values()) for s, x in mixing.targets(size, {"a": 3, "b": 1, "c": 1, None: 1}).items()}
    # The words taken can be routed to the sources: all quotas are filled by them, but for a document at each pattern's end.
    names = list(wanted)
    pools = list(taken)
    flow = mixing.min_cost_flow([taken[p] for p in pools], [[names.index(s) for s in p] for p in pools], [round(wanted[s]) for s in names], 1)
    into = Counter()
    for f in flow:
        into.update(f)
    assert all(abs(into[i] - wanted[s]) <= 12 for i, s in enumerate(names)), (into, wanted)
    assert abs(sum(taken.values()) - sum(wanted.values())) <= 12


def test_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, (r[:-1] for r in rows)), key=str) == sorted(map(tuple, (r[:-1] for r in again)), key=str)
    import re

    want = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    taken, target = Counter(), {}
    for r in rows:
        assert r["size"] == want[r.doc_id] and r.taken <= 3 * r["size"]
        taken[tuple(r.members)] += r.taken
        target[tuple(r.members)] = r.target
    assert len(rows) == len(want)
    assert sum(target.values()) == pytest.approx(sum(want.values()))
    for s in target:
        assert abs(taken[s] - target[s]) < max(30, 0.01 * target[s]), (s, taken[s], target[s])


def test_mix_odd_rows(spark):
    docs = frame(spark, texts())
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert mixing.mix(docs.limit(0)).count() == 0
    assert all(r.taken <= 3 * r["size"] for r in rows)
    two = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, array('a', 'b'), array(source)) source")
    assert len(mixing.mix(two).collect()) == docs.count()


def test_a_grown_layout_is_the_next_layout(spark):
    from punctata.llm import sharding

    docs = spark.range(300).selectExpr("id AS doc_id", "if(id % 7 = 0, NULL, concat('t', id)) AS text")
    for n in (5, 7, 8):
        grown = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.shard_documents(docs, n).collect()}
        after = {r.doc_id: r.shard for r in sharding.shard_documents(docs, n + 1, base=n).collect()}
        assert all(after[k] == g and g in (s, n) for k, (s, g) in grown.items())
    assert sharding.shard_documents(docs.limit(0)).count() == 0
    same = spark.range(50).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "if(id < 25, 'x', concat('t', id)) AS text")
    rows = sharding.shard_documents(same).collect()
    assert sorted(r.slot for r in rows) == list(range(50))

"""Importance resampling against a brute-force version, and the selection by itself."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from data import SF, frame, texts
from pyspark.sql import functions as F

from punctata.llm import resampling
from punctata.llm.queries import benchmark, documents
from punctata.llm.words import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, target, width, buckets, percent, least, seed):
    def features(text):
        w = WORD.findall(lower(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, width + 1) for i in range(len(w) - k + 1)]

    own, aim = Counter(), Counter()
    for _, t in docs:
        own.update(features(t)[1])
    for t in target:
        aim.update(features(t)[1])
    s, t = sum(own.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in range(buckets)}
    rows = []
    for i, text in docs:
        n, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = fit[: len(fit) * percent // 100]
    ranks = Counter()
    out = [(r[0], *r[2:], k + 1) for k, r in enumerate(drawn)]
    for r in drawn:
        ranks[tuple(r)] += 1
    for r in rows:
        if ranks[tuple(r)]:
            ranks[tuple(r)] -= 1
        else:
            out.append((r[0], *r[2:], None))
    return sorted(out, key=repr)


def test_words_are_those_of_the_pattern():
    raw = texts(5) + ["A\x00B ÀB_c-9 ", "x" * 100_000, "…—"]
    found, first = words([(t or "").encode() for t in raw])
    got = [x.decode() for x in found.to_pylist()]
    for i, t in enumerate(raw):
        assert got[first[i] : first[i + 1]] == WORD.findall(lower(t))


@pytest.mark.parametrize("width,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 55, 1), (2, 500, 100, 0)])
def test_ranks_against_brute_force(spark, width, buckets, percent, least):
    docs = frame(spark, texts(3)).withColumn("Score", F.lit("theirs")).withColumn("weight", F.lit(1))
    target = spark.createDataFrame([(t,) for t in texts(8)[::3]], "text string").repartition(3)
    got = resampling.importance_ranks(docs, target, width, buckets, percent, least, 7)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], width, buckets, percent, least, 7)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    drawn = resampling.resample(docs, target, width, buckets, percent, least, 7)
    assert drawn.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in drawn.collect()) == sorted((w[0] is None, w[0] or 0) for w in want if w[4] is not None)


def test_whole_tables_against_brute_force(spark):
    docs, target = documents(spark, SF), benchmark(spark, SF)
    got = resampling.importance_ranks(docs, target)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], 1, 10_000, 10, 20, 2024)
    assert sorted(map(tuple, got.collect()), key=repr) == want


@pytest.mark.parametrize("finish", [0, 10_000])
def test_the_cutoff_is_exact(spark, finish):
    r = random.Random(4)
    rows = [(r.randint(-5, 5), 0, r.randint(0, 400), r.randint(0, 1)) for _ in range(300)] + [(2, 0, 7, 1)] * 90 + [(9, 1, 0, 0)]
    keys = spark.createDataFrame(rows, "k0 long, k1 long, k2 long, k3 long").repartition(3).cache()
    order = sorted(rows)
    for take in (1, 120, 250, len(rows)):
        assert resampling.cutoff(keys, take, finish) == order[take - 1]
    assert resampling.cutoff(keys, 0, finish) is None and resampling.cutoff(keys, len(rows) + 1, finish) is None


def test_each_round_discards_a_quarter_at_least():
    r = random.Random(1)
    for _ in range(50):
        parts = [sorted((r.randint(0, 99),) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 9))]
        pivot = resampling._weighted_median([(p[len(p) // 2], len(p)) for p in parts])
        every = [x for p in parts for x in p]
        assert sum(x <= pivot for x in every) >= len(every) / 4 and sum(x >= pivot for x in every) >= len(every) / 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, None), (2, ""), (3, "a b " * 20)], "doc_id long, text string")
    assert resampling.importance_ranks(none, some).count() == 0
    assert resampling.resample(none, some).count() == 0
    rows = {r.doc_id: r for r in resampling.importance_ranks(some, none, percent=100).collect()}
    assert [rows[i].n_features for i in (1, 2, 3)] == [0, 0, 40]
    assert [rows[i]["rank"] for i in (1, 2, 3)] == [None, None, 1] and rows[1].weight == 0

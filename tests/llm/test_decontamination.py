"""Benchmark decontamination against brute force over word lists."""

from __future__ import annotations

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from data import SF, frame, texts
from pyspark.sql import functions as F

from punctata.llm import decontamination as D
from punctata.llm.queries import benchmark, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    wins = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, names = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    names |= found
        out.append((d, len(w), len(hit), len(names), sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def planted(spark, seed=3):
    """Documents with whole items, parts of them, periodic runs and near misses, and the items."""
    r = random.Random(seed)
    pool = ["red", "Green", "blau", "ñu", "x9", "日", "of", "the"]
    some = lambda n: " ".join(r.choice(pool) for _ in range(n))
    items = [(i, some(r.choice([1, 2, 5, 9, 10, 11, 14, 30]))) for i in range(25)]
    items += [(100, "the " * 15), (101, items[7][1]), (7, some(12)), (None, some(11)), (102, None), (103, ""), (104, "!?"), (105, "unseen")]
    docs = [t for t in texts(seed)] + [some(r.randint(1, 60)) for _ in range(60)] + ["the the, THE. " * 9, "the " * 14, "The-the " * 5, "of " * 200_000]
    docs += [f"{some(5)}\n{t}! {some(3)}" for _, t in items if t] + [t[: len(t) * 2 // 3] for _, t in items if t]
    return frame(spark, docs), spark.createDataFrame(items, "item_id long, text string").repartition(3)


@pytest.mark.parametrize("window,block_bytes,shard_bytes", [(10, 8 << 20, 500), (3, 600, 2000), (25, 8 << 20, 8 << 20)])
def test_contamination_against_brute_force(spark, window, block_bytes, shard_bytes):
    docs, items = planted(spark)
    docs = docs.withColumn("SHA", F.lit(3)).withColumn("n_hit", F.lit(4))
    own = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(own, [tuple(r) for r in items.collect()], window)
    got = D.contaminated(docs, items, window, block_bytes, shard_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert 0 < sum(w[5] for w in want) < len(want)
    clean = D.decontaminate(docs, items, window, block_bytes, shard_bytes)
    assert clean.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in clean.collect()))) == sorted(repr(w[0]) for w in want if not w[5])


def test_whole_tables_against_brute_force(spark):
    docs, items = documents(spark, SF), benchmark(spark, SF)
    got = D.contaminated(docs, items)
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()], 10)


@pytest.mark.parametrize("window,block_bytes,shard_bytes", [(4, 8 << 20, 1500), (10, 800, 8 << 20)])
def test_longest_matches_against_brute_force(spark, window, block_bytes, shard_bytes):
    docs, items = planted(spark, 5)
    docs = docs.where("length(text) < 50000")
    own = [(r.doc_id, split(r.text)) for r in docs.collect()]
    want = []
    for i, t in {tuple(r) for r in items.collect()}:
        w, last = split(t), 0
        for k in range(len(w)):
            best = None
            for d, words in own:
                for p in range(len(words)):
                    n = 0
                    while k + n < len(w) and p + n < len(words) and words[p + n] == w[k + n]:
                        n += 1
                    if (n >= window or (k == 0 and n == len(w))) and (best is None or (-n, d is None, d or 0, p) < best[0]):
                        best = ((-n, d is None, d or 0, p), d)
            n = -best[0][0] if best else 0
            if best and n != last - 1:
                want.append(("" if i is None else str(i), k, n, best[1], best[0][3]))
            last = n
    got = D.longest_matches(docs, items, window, block_bytes, shard_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and want


def test_suffix_array_is_sorted():
    r = random.Random(2)
    for known, depth in ((3, 10), (3, 200), (70_000, 7), (1, 40)):
        ids = np.array([r.choice([-1, *[r.randrange(known) for _ in range(12)]]) for _ in range(900)] + [0] * 300 + [-1])
        p = D.packing(known)
        at = np.flatnonzero(D.room(ids) > 0)
        array = D.suffix_array(ids, at, p, depth)

        def key(i):
            out = []
            while ids[i] >= 0 and len(out) < depth:
                out.append(int(ids[i]))
                i += 1
            return out

        keys = [key(i) for i in array]
        assert sorted(array) == at.tolist() and keys == sorted(keys)


def test_empty_tables(spark):
    docs, items = planted(spark)
    assert D.contaminated(docs.limit(0), items).count() == 0
    none = D.contaminated(docs, items.limit(0))
    assert none.where("contaminated or n_hit > 0 or n_items > 0").count() == 0 and none.count() == docs.count()
    assert D.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert D.longest_matches(docs, items.limit(0)).count() == 0

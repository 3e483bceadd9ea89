import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from data import SF, frame, texts

from punctata.llm import suffixes


def brute(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (k, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        gone[-1] = False
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum()) if len(r) else 0
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]]) if len(r) else b""
        out.append((k, len(r), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return out


def _same(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in suffixes.removal_digests(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def planted(seed: int) -> list[str]:
    """Shared passages of lengths around the limit, edits, near copies, runs and periods."""
    r = random.Random(seed)

    def some(n):
        return "".join(r.choice("abcde é\n") for _ in range(n))

    base = some(900)
    out = [base, base[:450] + "#" + base[450:], base[300:], some(50) + base[100:299] + some(70), some(40) + base[100:300] + some(90), some(7) + base[500:701]]
    passage = some(260)
    out += [some(r.randint(0, 150)) + passage + some(r.randint(0, 150)) for _ in range(30)]
    out += ["x" * 450, "xy" * 300, "abc" * 150 + some(30), some(230) + some(20) + base[:230]]
    x = list(base)
    for i in range(150, 900, 230):
        x[i] = "!"
    out += ["".join(x), some(199), some(200)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_planted(spark, seed):
    _same(spark, frame(spark, planted(seed)))


def test_hot_grams(spark, monkeypatch):
    """Salted grams: the limit is low enough that tasks salt them."""
    r = random.Random(4)
    passage = "".join(r.choice("abcdefg ") for _ in range(230))
    rows = ["".join(r.choice("abcdefg ") for _ in range(80)) + passage + "".join(r.choice("abcdefg ") for _ in range(80)) for _ in range(700)]
    rows += rows[:40]
    _same(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(2))


def test_whole_table(spark):
    _same(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    _same(spark, frame(spark, texts()))
    assert suffixes.removal_digests(frame(spark, ["a"]).limit(0)).count() == 0


def test_chunks_agree(monkeypatch):
    raw = "".join(planted(3)).encode()
    codes = np.frombuffer(raw, np.uint8)
    ends = np.array([len(raw) // 2, len(raw)])
    whole = suffixes.ranges(codes, ends)
    starts = np.concatenate([np.arange(s, e + 1) for s, e in zip(whole[3], whole[4])])
    assert np.array_equal(starts, [i for i in range(len(raw) - 199) if i + 200 <= len(raw) // 2 or i >= len(raw) // 2])
    monkeypatch.setattr(suffixes, "_CHUNK", 1000)
    cut = suffixes.ranges(codes, ends)
    anchors = {p: a for a, s, e in zip(*whole[2:]) for p in range(s, e + 1)}
    assert all(anchors[p] == a for a, s, e in zip(*cut[2:]) for p in range(s, e + 1))


def test_multikey_order():
    keys = np.random.default_rng(0).integers(0, 4, (3000, 5)).astype(np.uint64)
    order = suffixes.multikey_order(keys)
    assert np.array_equal(keys[order], keys[np.lexsort(keys.T[::-1])])


def test_remove_repeats(spark):
    docs = frame(spark, [*planted(5), "é" * 150, "ü" + "é" * 150]).withColumnRenamed("size", "n_chars")
    rows = suffixes.remove_repeats(docs).collect()
    assert len(rows) == docs.count() and all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    before = {(r.doc_id): r.text for r in docs.collect()}
    assert all(before[r.doc_id] is None or len(r.text) <= len(before[r.doc_id]) for r in rows if r.doc_id is not None)


def test_many_continuations_of_one_start(spark):
    """Thousands of texts that begin alike for 150 bytes and then differ, some of them twins over 200 bytes."""
    import random

    r = random.Random(11)
    start = "the same beginning of every text, " * 5
    rows = [start[:150] + "".join(r.choice("abcdef ") for _ in range(150)) for _ in range(400)]
    rows += [x[:230] + "".join(r.choice("xyz") for _ in range(60)) for x in rows[:15]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(6)
    raw = [x.encode() for x in rows]
    seen: dict[bytes, int] = {}
    for x in raw:
        for i in range(len(x) - 199):
            seen[x[i : i + 200]] = seen.get(x[i : i + 200], 0) + 1
    want = {}
    for k, x in enumerate(raw):
        gone = [False] * len(x)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        want[k] = sum(gone)
    assert {row.doc_id: row.n_removed for row in suffixes.removal_digests(docs).collect()} == want
    assert sum(map(bool, want.values())) == 30

"""Importance resampling of documents towards a target set of texts.

Features are hashed runs of words. Two passes over whole texts: one counts buckets, in each task first,
so that only bucket counts are dealt out; one gives each document the mean gain of its features and a
Gumbel draw from its id. The highest scores are drawn without sorting the rest: rounds of weighted
median-of-medians selection find the exact key of the last document drawn. In a round each task tells how
many of its remaining keys are before, at and after the pivot and the medians of both sides; the next
pivot is the median of medians of the side that holds the cutoff, weighted by what remains in each task,
so a quarter of the remaining keys at least goes with every round. Only winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctata.llm.common import batches, discard, free_names, running_start, stored, utf8
from punctata.llm.words import words

#: Most buckets of a model: their gains are sent to every task.
MOST_BUCKETS = 1 << 22
#: Up to so many remaining keys end the selection on the driver.
FINISH = 10_000
Key = tuple[int, int, int, int]


class Gains(NamedTuple):
    """What one occurrence of a bucket's features adds to a document's weight, in thousandths."""

    values: np.ndarray
    width: int


def _features(raw: list[bytes], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features text by text, the place of each text's first feature, and each text's words."""
    found, first = words(raw)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(raw)), n_words)
    codes, texts = [], []
    for k in range(1, width + 1):
        m = len(found) - k + 1
        if m < 1:
            break
        runs = found if k == 1 else pa.compute.binary_join_element_wise(*(found.slice(i, m) for i in range(k)), pa.scalar(b" ", pa.large_binary()))
        here = text[:m] == text[k - 1 :]
        runs = runs if here.all() else runs.filter(pa.array(here))
        coded = runs.dictionary_encode()
        crc = np.fromiter((zlib.crc32(x) % buckets for x in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        codes.append(crc[coded.indices.to_numpy()])
        texts.append(text[:m][here])
    if not codes:
        return np.zeros(0, np.int64), np.zeros(len(raw) + 1, np.int64), n_words
    code, owner = np.concatenate(codes), np.concatenate(texts)
    if len(codes) > 1:
        order = np.argsort(owner, kind="stable")
        code, owner = code[order], owner[order]
    return code, np.searchsorted(owner, np.arange(len(raw) + 1)), n_words


def bucket_counts(rows: DataFrame, width: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n) over all features of all texts of ``rows(text)``; each task sends a row for each bucket it met."""

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches(frames):
            n += np.bincount(_features(utf8(b.column("text")), width, buckets)[0], minlength=buckets)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met])], ["bucket", "n"])

    return rows.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000) -> Gains:
    """Gains of ``docs(text)`` towards ``target(text)``: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) for each of B buckets.

    Null texts have no features; empty tables give counts of 0. At most ``buckets`` rows reach the driver.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")
    held = []
    for rows in (docs, target):
        n = np.zeros(buckets, np.int64)
        for r in bucket_counts(rows, width, buckets).collect():
            n[r["bucket"]] = r["n"]
        held.append(n)
    s, t = (n.tolist() for n in held)
    whole, aim = float(sum(s) + buckets), float(sum(t) + buckets)
    return Gains(np.array([math.floor(1000 * math.log((b + 1) * whole / ((a + 1) * aim))) for a, b in zip(s, t, strict=True)], np.int64), width)


def scored(docs: DataFrame, model: Gains, seed: int = 2024) -> tuple[DataFrame, list[str]]:
    """``docs`` with n_words, n_features, weight and score added, under free names, which come second."""
    names, buckets = free_names(docs, "n_words", "n_features", "weight", "score"), len(model.values)

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            code, first, n_words = _features(utf8(b.column("text")), model.width, buckets)
            sums = np.concatenate([[0], np.cumsum(model.values[code])])[first]
            n = np.diff(first)
            weight = np.where(n > 0, np.diff(sums) // np.maximum(n, 1), 0)
            ids = b.column("doc_id").to_pylist()
            h = np.fromiter((int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) for i in ids), np.float64, len(ids))
            score = weight + np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296.0))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.int64()) for x in (n_words, n, weight, score))], [*b.schema.names, *names])

    return docs.mapInArrow(rows, T.StructType([*docs.schema, *(T.StructField(x, T.LongType()) for x in names)])), names


def _before(cols: list[np.ndarray], key: Key) -> np.ndarray:
    """Which rows stand before ``key``, column by column."""
    out = np.zeros(len(cols[0]), bool)
    for c, k in zip(reversed(cols), reversed(key), strict=True):
        out = (c < k) | ((c == k) & out)
    return out


def _sides(low: Key | None, high: Key | None, pivot: Key | None, names: list[str]) -> Callable:
    """One task's share of a round: counts before, at and after the pivot, and the medians of both sides."""

    def told(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[b.column(n).to_numpy() for n in names] for b in frames if b.num_rows]
        if not held:
            return
        cols = [np.concatenate(c) for c in zip(*held, strict=True)]
        keep = np.ones(len(cols[0]), bool)
        if low is not None:
            keep &= ~_before(cols, (*low[:-1], low[-1] + 1))
        if high is not None:
            keep &= _before(cols, high)
        cols = [c[keep] for c in cols]
        before = _before(cols, pivot) if pivot else np.zeros(len(cols[0]), bool)
        after = ~_before(cols, (*pivot[:-1], pivot[-1] + 1)) if pivot else ~before
        row = [int((~before & ~after).sum())]
        for side in (before, after):
            some = [c[side] for c in cols]
            n = len(some[0])
            row.append(n)
            at = np.lexsort(some[::-1])[n // 2] if n else None
            row += [int(c[at]) if n else None for c in some]
        kind = pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x in row], _TOLD)

    return told


_TOLD = ["at", "n0", *(f"m0{i}" for i in range(4)), "n1", *(f"m1{i}" for i in range(4))]


def _weighted_median(pairs: list[tuple[Key, int]]) -> Key:
    half, seen = sum(n for _, n in pairs) / 2, 0
    for key, n in sorted(pairs):
        seen += n
        if seen >= half:
            return key
    raise ValueError("nothing remains")


def cutoff(keys: DataFrame, take: int, finish: int = FINISH) -> Key | None:
    """The ``take``-th least row of ``keys``, four long columns without nulls; None if there are fewer rows.

    Each round is one job, from which one row of counts and medians for each task reaches the driver. When the
    remaining keys are an eighth of the table, they are written anew; at most ``finish`` of them are
    collected to end the search.
    """
    names, own = keys.columns, []
    low = high = pivot = None
    remaining = held = None
    while True:
        near = keys
        if low is not None:
            near = near.where(F.col(names[0]) >= low[0])
        if high is not None:
            near = near.where(F.col(names[0]) <= high[0])
        if remaining is not None and remaining <= finish:
            k = F.struct(*names)
            bounds = [k > F.struct(*map(_long, low))] if low else []
            bounds += [k < F.struct(*map(_long, high))] if high else []
            rows = sorted(tuple(r) for r in near.where(reduce(lambda a, b: a & b, bounds, F.lit(True))).collect())
            discard(*own)
            return rows[take - 1] if 0 < take <= len(rows) else None
        if remaining is not None and remaining * 8 <= held:
            k = F.struct(*names)
            near = near if low is None else near.where(k > F.struct(*map(_long, low)))
            near = near if high is None else near.where(k < F.struct(*map(_long, high)))
            keys = near = stored(near, "remaining")
            own.append(keys)
            held = remaining
        told = near.mapInArrow(_sides(low, high, pivot, names), ", ".join(f"{c} long" for c in _TOLD)).collect()
        n0, at, n1 = (sum(r[c] for r in told) for c in ("n0", "at", "n1"))
        held = held if held is not None else n0 + at + n1
        if take > n0 + at + n1 or take < 1:
            discard(*own)
            return None
        if take <= n0:
            side, high, remaining = 0, pivot, n0
        elif take <= n0 + at:
            discard(*own)
            return pivot
        else:
            side, remaining, take = 1, n1, take - n0 - at
            low = pivot if pivot is not None else low
        pivot = _weighted_median([(tuple(r[f"m{side}{i}"] for i in range(4)), r[f"n{side}"]) for r in told if r[f"n{side}"]])


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _key(score: str, doc_id: str, n_features: str) -> list[Column]:
    """Highest score first, then the least doc_id, null last; equal keys are equal rows."""
    d = F.col(doc_id).cast("long")
    return [(-F.col(score)).alias("k0"), d.isNull().cast("long").alias("k1"), F.coalesce(d, _long(0)).alias("k2"), F.col(n_features).alias("k3")]


def _numbered(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and the row's number in it."""
    task, n = TaskContext.get().partitionId(), 0
    for b in frames:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, task, np.int64)), pa.array(np.arange(n, n + b.num_rows))], [*b.schema.names, "task", "inside"])
        n += b.num_rows


def ranked(rows: DataFrame, percent: int = 10, least: int = 20) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for ``rows(doc_id, n_words, n_features, weight, score)``, which are read often.

    Of the N rows with at least ``least`` words the floor(percent N / 100) of highest score have ranks 1, 2, 3..., ties
    to the smaller doc_id, a null doc_id last; of rows equal in all columns any may be the one drawn. Winners are
    sorted by ranges; one number for each range meets in one task.
    """
    out = ["doc_id", "n_features", "weight", "score"]
    keys = rows.withColumn("fit", F.col("n_words") >= least).select(*out, "fit", *_key("score", "doc_id", "n_features"))
    fit = keys.where("fit").select("k0", "k1", "k2", "k3")
    take = fit.count() * percent // 100
    last = cutoff(fit, take)
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return keys.select(*out, none)
    k = F.struct("k0", "k1", "k2", "k3") <= F.struct(*map(_long, last))
    won = keys.where(F.col("fit") & (F.col("k0") <= last[0]) & k).drop("fit").repartitionByRange("k0", "k1", "k2", "k3").sortWithinPartitions("k0", "k1", "k2", "k3")
    won = stored(won.mapInArrow(_numbered, T.StructType([*won.schema, T.StructField("task", T.LongType()), T.StructField("inside", T.LongType())])), "winners")
    starts = running_start(won.groupBy("task").agg(F.count("*").alias("n")), "task", "n", "before").select("task", "before")  # one row a task
    place = F.col("before") + F.col("inside") + 1
    drawn = won.join(F.broadcast(starts), "task").select(*out, F.when(place <= take, place).cast("long").alias("rank"))
    return drawn.unionByName(keys.where(~F.col("fit") | ~k).select(*out, none))


def importance_ranks(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs(doc_id, text)``; rank null where it isn't drawn.

    A weight is the floored mean gain of a text's features (none: 0); its score adds floor(-1000 ln(-ln u)) with u
    from the sha256 of ``seed:doc_id`` (null: nothing after the colon). Null and empty texts have no features; very long
    texts are read whole, one by one; repeated rows have equal scores and ranks of their own; other columns are not
    read; an empty table gives no rows, an empty target gains from counts of 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked, _ = scored(rows, gains(docs, target, width, buckets), seed)
    return ranked(stored(marked.drop("text"), "scores"), percent, least)


def resample(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns: no texts are dealt out.

    Cases as in ``importance_ranks``. The scores are written once for the selection and taken again for the texts.
    """
    marked, (n_words, n_features, weight, score) = scored(docs, gains(docs, target, width, buckets), seed)
    key = F.struct(*_key(score, "doc_id", n_features))
    fit = marked.where(F.col(n_words) >= least)
    keys = stored(fit.select(*_key(score, "doc_id", n_features)), "keys")
    take = keys.count() * percent // 100
    last = cutoff(keys, take)
    if last is None:
        return docs.limit(0)
    at = F.struct(*map(_long, last))
    ahead = keys.where(F.struct(*keys.columns) < at).count()
    return fit.where(key < at).union(fit.where(key == at).limit(take - ahead)).select(*docs.columns)

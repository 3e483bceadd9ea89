"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from each whole text inside Arrow functions. The trees are grown on the driver from
a bounded sample of labelled rows, with features binned to at most 64 levels and split by gradient
histograms; they are flattened into arrays, and scoring walks all rows of a batch through all trees at
once with numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctata.llm.common import batches, tidy, utf8

NAMES = (
    "log_bytes", "log_words", "word_mean", "word_std", "upper", "digit", "space", "newline", "non_ascii", "stop_marks", "other_marks",
    "odd_marks", "entropy", "distinct_words", "top_word", "repeated_lines", "line_mean", "upper_words", "marked_words", "short_words", "run_share", "digit_words", "tag_marks",
)

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_STOPS, _TAGS, _ODD = (list(x) for x in (b".,;:'\"-?", b"<>/=_{}[]|\\@", b"!#$%&*+^~`"))
_ENDS = tuple(bytes([x]) for x in _ODD)
_ALL_MARKS = [x for x in range(33, 127) if not chr(x).isalnum()]


def statistics(raw: bytes) -> tuple[float, ...]:
    """The values of NAMES for one whole text in UTF-8; all 0 for an empty one."""
    n = len(raw)
    if not n:
        return (0.0,) * len(NAMES)
    codes = np.frombuffer(raw, np.uint8)
    c = np.bincount(codes, minlength=256)
    words = raw.split()
    w = len(words) or 1
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    top = max(counts.values(), default=0)
    lines = [x for x in raw.split(b"\n") if x]
    p = c[c > 0] / n
    marks = int(c[_ALL_MARKS].sum())
    odd, stops, tags = (int(c[x].sum()) for x in (_ODD, _STOPS, _TAGS))
    per_word = [(m, counts[m]) for m in counts]
    return (
        float(np.log1p(n)), float(np.log1p(len(words))), float(lengths.mean()), float(lengths.std()), int(c[_UPPER].sum()) / n, int(c[_DIGIT].sum()) / n,
        int(c[9:14].sum() + c[32]) / n, int(c[10]) / n, int(c[128:].sum()) / n, stops / n, (marks - stops - odd) / n,
        odd / n, float(-(p * np.log2(p)).sum()), len(counts) / w, top / w, 1 - len(set(lines)) / max(1, len(lines)), float(np.log1p(n / max(1, len(lines)))),
        sum(k for m, k in per_word if m.isupper() and len(m) > 1) / w, sum(k for m, k in per_word if m.endswith(_ENDS)) / w, float((lengths <= 3).mean()), float((codes[1:] == codes[:-1]).mean()) if n > 1 else 0.0, sum(k for m, k in per_word if m[0] in b"0123456789") / w, tags / n,
    )


@dataclass(frozen=True)
class Trees:
    """All trees' nodes in one set of arrays; a leaf has feature -1 and points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            goes = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(goes, self.left[at], self.right[at]))
        raw = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: int = 10) -> Trees:
    """Second-order boosting with logistic loss; each split maximises the gain over binned histograms."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        i = len(feature)
        for a, v in ((feature, -1), (threshold, 0.0), (left, i), (right, i), (value, 0.0)):
            a.append(v)
        return i

    if len(y) and 0 < y.mean() < 1:
        d = x.shape[1]
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
        binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)])
        flat = binned + np.arange(d) * bins
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            root = node()
            roots.append(root)
            todo = [(root, np.arange(len(y)), 0)]
            while todo:
                i, rows, level = todo.pop()
                sg, sh = g[rows].sum(), h[rows].sum()
                best = (1e-6, -1, 0)
                if level < depth and len(rows) >= 2 * least:
                    at = flat[rows].ravel()
                    hist = [np.bincount(at, weights=np.repeat(v, d) if v is not None else None, minlength=d * bins).reshape(d, bins).cumsum(axis=1)[:, :-1] for v in (g[rows], h[rows], None)]
                    lg, lh, ln = hist
                    gain = lg**2 / (lh + penalty) + (sg - lg) ** 2 / (sh - lh + penalty) - sg**2 / (sh + penalty)
                    gain[(ln < least) | (len(rows) - ln < least)] = -1
                    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                    best = (gain[j, b], int(j), int(b))
                if best[1] < 0 or best[0] <= 1e-6 or best[2] >= len(cuts[best[1]]):
                    value[i] = float(-rate * sg / (sh + penalty))
                    raw[rows] += value[i]
                    continue
                _, j, b = best
                feature[i], threshold[i] = j, float(cuts[j][b])
                goes = binned[rows, j] <= b
                left[i], right[i] = node(), node()
                todo += [(left[i], rows[goes], level + 1), (right[i], rows[~goes], level + 1)]
    if not roots:
        roots.append(node())
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), base, depth)


def _features(docs: DataFrame) -> DataFrame:
    def taken(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            rows = [statistics(x) for x in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("y").cast(pa.float64()), pa.array(rows, pa.list_(pa.float64()))], ["h", "y", "x"])

    return docs.select("h", "y", "text").mapInArrow(tidy(taken), "h long, y double, x array<double>")


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, folds: int = 5) -> Trees:
    """Trees fitted on at most ``most`` labelled rows, chosen by hash of doc_id among those not held out.

    Rows whose crc32(doc_id as text) is divisible by ``folds`` are held out. Rows with a null label or
    doc_id are not used; of several labels of a document the least is. A doc_id that many rows of ``docs``
    repeat brings all of them, but ``most`` rows at most in all. A null text counts as an empty one; very
    long texts are read whole. Without labelled rows, or with one label only, all scores are equal.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % folds != 0))
        .groupBy("doc_id").agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id", F.lit("train")), "doc_id").limit(most)
    )
    # At most `most` rows of two numbers go out, and as many rows of statistics come back.
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("doc_id", F.lit("train"), "text"))
    rows = _features(known).orderBy("h", "y", "x").limit(most).collect()
    rows.sort(key=lambda r: (r.y, r.x))
    return fit(np.array([r.x for r in rows]).reshape(-1, len(NAMES)), np.array([r.y for r in rows], dtype=float))


def score(docs: DataFrame, model: Trees, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; a null text is scored as an empty one.

    A null doc_id is not held out. Repeated rows repeat and equal texts have equal scores; an empty table
    gives no rows; a very long text is one batch of its own. Other columns are not read. Only the text goes
    into a score. No shuffle.
    """

    def scored(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            p = model.scores(np.array([statistics(x) for x in utf8(b.column("text"))]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(scored), "doc_id long, score double, predicted int")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: Trees, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns under any names, whose text scores ``threshold`` or more.

    A null text is scored as an empty one; null doc_ids do not matter; repeated rows fare alike; an empty
    table gives no rows; very long texts are read whole.
    """
    schema = docs.schema

    def kept(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            p = model.scores(np.array([statistics(x) for x in utf8(b.column("text"))]))
            yield b.filter(pa.array(p >= threshold))

    return docs.mapInArrow(tidy(kept), schema)

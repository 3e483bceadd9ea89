"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into segments; its bit counts by segment are a point of a small integer
grid. Two fingerprints that differ in ``bits`` bits are at most ``bits`` apart under Manhattan distance,
so that distance is a lower bound, and the candidates of a range-join on the grid hold every link. For
two bits the join meets in the middle: each point is dealt to itself and to all grid cells one step
away, and points within two steps share a cell. Candidates of a cell are verified exactly by the bits of
their XOR; a cell hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctata.llm.common import batches, components, discard, free_names, stored, tidy, utf8


def shingle_hashes(raw: bytes, width: int = 3, seed: int = 42) -> np.ndarray:
    """Hashes of all shingles of a whole text in UTF-8, in order, repeats included.

    A-Z are lowered and words split at ASCII white space. Fewer words than ``width`` are one shingle.
    """
    words = raw.lower().split()
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(b" ".join(words), seed)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view = memoryview(joined)
    return np.array([h(view[a:z], seed) for a, z in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())], np.uint64)


class _Words(dict):
    """XXH64 of words; short ones are kept for the next text, at most ``most`` of them."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        if len(word) <= 32:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h


_WORDS = _Words()


def shingle_set(raw: bytes, width: int) -> np.ndarray:
    """The different shingles of a whole text as hashes, ascending: chained hashes of words, which are quicker than of bytes."""
    words = raw.lower().split()
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    out = np.full(len(w) - k + 1 if k else 0, k, np.uint64)
    for i in range(k):
        out = (out ^ w[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out.sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    return out[fresh]


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; without any the fingerprint is 0."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(raw: bytes, width: int = 3, seed: int = 42) -> int:
    """The fingerprint of a whole text in UTF-8."""
    return majority(shingle_hashes(raw, width, seed))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, th, fp long) of every whole text, th its hash; the 64 bits stand in a signed long."""

    def taken(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            ths = b.column("th").to_pylist()
            known = {t: fingerprint(x, width) for t, x in dict(zip(ths, utf8(b.column("text")), strict=True)).items()}
            fps = np.array([known[t] for t in ths], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps)], ["doc_id", "th", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")).mapInArrow(tidy(taken), "doc_id long, th long, fp long")


def popcounts(fps: np.ndarray, segments: int = 16) -> np.ndarray:
    """Bit counts of each segment, one row for a fingerprint."""
    size = 64 // segments
    parts = (fps[:, None] >> (np.arange(segments, dtype=np.uint64) * np.uint64(size))) & np.uint64((1 << size) - 1)
    return np.bitwise_count(parts).astype(np.int64)


def cells(fps: np.ndarray, segments: int = 16) -> np.ndarray:
    """Grid cells within one step of each fingerprint's point, packed in a long: (n, 1 + 2 x segments)."""
    points = popcounts(fps, segments)
    wide = 64 // segments + 2  # values after a step down or up, shifted by one
    place = np.array([wide**i for i in range(segments)], np.uint64).view(np.int64)
    with np.errstate(over="ignore"):
        own = ((points + 1) * place).sum(axis=1)
        return np.column_stack([own, own[:, None] + place, own[:, None] - place])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node of the pairs to the least node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        now = root.copy()
        np.minimum.at(now, root[i], low)
        np.minimum.at(now, root[j], low)
        now = now[now]
        while not np.array_equal(now, now[now]):
            now = now[now]
        if np.array_equal(now, root):
            break
        root = now
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _verified(fps: np.ndarray, bits: int, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among the fingerprints of one cell, block by block."""
    a, b = [], []
    for i in range(0, len(fps), block):
        for j in range(i, len(fps), block):
            near = np.bitwise_count(fps[i : i + block, None] ^ fps[None, j : j + block]) <= bits
            x, y = np.nonzero(np.triu(near, 1) if i == j else near)
            if len(x):
                p, q = forest(fps[i : i + block][x], fps[j : j + block][y])
                a.append(p)
                b.append(q)
    if not a:
        return fps[:0], fps[:0]
    return forest(np.concatenate(a), np.concatenate(b))


def _links(frames: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links of the rows (cell, fp), which come sorted by cell."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))

    def of(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        out_a, out_b = [], []
        few = sizes <= 8  # small cells: all of one size are compared at once
        for n in range(2, 9):
            s = starts[sizes == n]
            for i in range(n):
                for j in range(i + 1, n):
                    x, y = fp[s + i], fp[s + j]
                    near = np.bitwise_count(x ^ y) <= bits
                    out_a.append(x[near])
                    out_b.append(y[near])
        for s, n in zip(starts[~few].tolist(), sizes[~few].tolist()):
            x, y = _verified(fp[s : s + n], bits)
            out_a.append(x)
            out_b.append(y)
        if out_a:
            x, y = forest(np.concatenate(out_a), np.concatenate(out_b))
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    for frame in frames:
        cell = np.concatenate([held[0], frame.column("cell").to_numpy(zero_copy_only=False)])
        fp = np.concatenate([held[1], frame.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        last = int(np.searchsorted(cell, cell[-1], "left")) if len(cell) else 0
        if last:
            yield from of(cell[:last], fp[:last])
        held = (cell[last:], fp[last:])
    if len(held[0]):
        yield from of(*held)


def near_links(fps: DataFrame, bits: int = 2, segments: int = 16) -> DataFrame:
    """(a, b): links that span the components of the distinct fingerprints ``fps(fp)`` within ``bits`` <= 2 bits."""
    if bits > 2:
        raise ValueError("cells one step away meet only within two steps")

    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            c = cells(fp.view(np.uint64), segments)
            yield pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(np.repeat(fp, c.shape[1]))], ["cell", "fp"])

    grid = fps.mapInArrow(tidy(dealt), "cell long, fp long").repartition("cell").sortWithinPartitions("cell")
    return grid.mapInArrow(tidy(lambda frames: _links(frames, bits)), "a long, b long")


def near_fingerprints(fps: DataFrame, bits: int = 2, segments: int = 16) -> DataFrame:
    """(node, component) of the distinct fingerprints ``fps(fp)`` that have a link within ``bits`` <= 2 bits."""
    return components(near_links(fps, bits, segments))


def _once(b: pa.RecordBatch, seen: set) -> pa.RecordBatch:
    """The rows whose text hash is new to this task."""
    keep = [i for i, t in enumerate(b.column("th").to_pylist()) if t not in seen and not seen.add(t)]
    return b.take(pa.array(keep, pa.int64()))


def _common(texts: DataFrame, width: int, sample: int = 20_000, most: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of the shingles that most of about ``sample`` texts share; at most ``most`` of them.

    They only put shingles in an order, frequent ones last: any order gives the same links.
    """
    step = max(1, -(-texts.count() // sample))
    few = texts.where(F.pmod(F.xxhash64("th"), F.lit(step)) == 0)

    def taken(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            th = b.column("th").to_pylist()
            hs = [shingle_set(x, width) for x in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.repeat(np.array(th, np.int64), [len(h) for h in hs]))], ["h", "th"])

    few = few.dropDuplicates(["th"])
    counts = stored(few.mapInArrow(tidy(taken), "h long, th long").groupBy("h").agg(F.count("*").alias("c")).where("c > 2"), "common")
    least, total = 3, 0
    for c, k in sorted(((r[0], r[1]) for r in counts.groupBy("c").count().collect()), reverse=True):
        total += k
        if total > most:
            least = c + 1
            break
    got = counts.where(F.col("c") >= least).toArrow()
    h, c = got.column("h").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def _able(i: np.ndarray, j: np.ndarray, n: np.ndarray, at: np.ndarray, similarity: float) -> np.ndarray:
    """False where two texts can't be similar if the key at these places is the first that they share."""
    need = similarity / (1 + similarity) * (n[i] + n[j]) - 1e-6
    return (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-6) & (np.minimum(n[i] - at[i], n[j] - at[j]) >= need)


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two ascending sets share."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _distinct(rows: np.ndarray) -> np.ndarray:
    """The different rows of a matrix, sorted."""
    rows = rows[np.lexsort(rows.T[::-1])]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[fresh]


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _distinct(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))


def similar_texts(docs: DataFrame, width: int, similarity: float, before: int = 16, block: int = 1024, known: DataFrame | None = None) -> DataFrame:
    """(a, b): links between text hashes whose sets of ``width``-word shingles have a Jaccard similarity of ``similarity``.

    The links span all components of such pairs and of the links ``known(a, b)``. In an order of all shingles, frequent ones last, two similar
    texts of n shingles share one of their first n - ceil(similarity n) + 1 each: these are a text's keys. Three
    passes follow, each over pairs whose components the passes before left apart:

    1. of a key's texts each with the one ahead and with the first, the one of the most frequent shingles;
    2. each with the ``before`` texts ahead, which is every pair of a small key;
    3. of larger keys all with all, in blocks of about ``block`` texts, each block with each.

    Lengths, the keys' places and the sizes of hashed buckets only leave out what can't be similar; all other
    pairs are verified on their whole shingle sets. Null texts and texts without words have no links; repeated
    texts are one; an empty table gives no rows; very long texts travel compressed, once for each pair.
    """
    spark = docs.sparkSession
    texts = docs.select("text", F.xxhash64("text").alias("th")).where(F.col("text").isNotNull())
    common = spark.sparkContext.broadcast(_common(texts, width))

    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = common.value
        seen: set = set()
        for b in batches(frames):
            b = _once(b, seen)
            cols: list[list] = [[], [], [], [], []]
            for t, raw in zip(b.column("th").to_pylist(), utf8(b.column("text")), strict=True):
                h = shingle_set(raw, width)
                n = len(h)
                if n:
                    often = np.zeros(n, np.int64)
                    if len(known):
                        near = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        often = np.where(known[near] == h, count[near], 0)
                    keys = h[np.argsort(often, kind="stable")[: n - int(np.ceil(similarity * n - 1e-6)) + 1]]
                    k = len(keys)
                    cols[0].append(keys.view(np.int64))
                    cols[1].append(np.full(k, -int(1000 * np.count_nonzero(often) / n), np.int32))
                    cols[2].append(np.full(k, t, np.int64))
                    cols[3].append(np.full(k, n, np.int32))
                    cols[4].append(np.arange(k, dtype=np.int32))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["key", "turn", "th", "n", "at"])

    def windows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (key null, n their pass), and the rows (key, a, n, at) of keys with more than ``before`` + 1 texts."""
        held = None
        for b in frames:
            now = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "th", "n", "at")]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held[:4], now, strict=True)]
            old = 0 if held is None else len(held[0])
            fresh = np.ones(len(now[0]), bool)  # copies in other tasks give equal rows, which come together
            fresh[1:] = (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])
            fresh[:old] = True
            key, th, n, at = (x[fresh] for x in now)
            idx = np.arange(len(key))
            if len(key) == old:
                continue
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.maximum.accumulate(np.where(new, idx, 0))
            off = idx - head
            if old:
                off[:old] = held[4]
                off[old:] += np.where(head[old:] == 0, held[4][-1] + 1 - old, 0)
            found, live = [], idx[old:]
            for back in range(1, before + 1):
                live = live[off[live] >= back]
                i, j = live, live - back
                keep = _able(i, j, n, at, similarity)
                found.append(np.column_stack([th[j], th[i], np.full(len(i), 1 + (back > 1))])[keep])
            i = idx[old:][off[old:] > 1]
            keep = _able(i, head[i], n, at, similarity)
            found.append(np.column_stack([th[head[i]], th[i], np.ones(len(i), np.int64)])[keep])
            pairs = _distinct(np.concatenate(found))
            full = idx[old:][off[old:] == before + 1]
            rows = np.concatenate([(full[:, None] - np.arange(before + 2)).ravel(), idx[old:][off[old:] > before + 1]])
            p, r = len(pairs), len(rows)
            if p + r:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.nulls(p, pa.int64()), pa.array(key[rows])]),
                        pa.array(np.concatenate([pairs[:, 0], th[rows]])),
                        pa.array(np.concatenate([pairs[:, 1], th[rows]])),
                        pa.array(np.concatenate([pairs[:, 2].astype(np.int32), n[rows]])),
                        pa.array(np.concatenate([np.zeros(p, np.int32), at[rows]])),
                    ],
                    ["key", "a", "b", "n", "at"],
                )
            tail = np.unique(np.concatenate([[head[-1]], np.arange(max(int(head[-1]), len(key) - before), len(key))]))
            held = [x[tail] for x in (key, th, n, at, off)]

    def packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each different text of a task once, compressed."""
        seen: set = set()
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches(frames):
            b = _once(b, seen)
            yield pa.RecordBatch.from_arrays([b.column("th"), pa.array([pack.compress(x) for x in utf8(b.column("text"))], pa.binary())], ["th", "z"])

    def buckets(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in frames:
            sizes = [np.bincount((shingle_set(unpack.decompress(x), width) & np.uint64(255)).astype(np.int64), minlength=256) for x in b.column("z").to_pylist()]
            small = [(s if s.max() < 255 else np.full(256, 255)).astype(np.uint8).tobytes() for s in sizes]
            yield pa.RecordBatch.from_arrays([b.column("th"), pa.array(small, pa.binary())], ["th", "sizes"])

    def crossed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of unlike components of each group (key, x, y): block x with block y; the rows come sorted."""
        held = None

        def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
            key, x, y, own, th, n, at, part = (t.column(c).to_numpy() for c in ("key", "x", "y", "own", "th", "n", "at", "component"))
            sizes = np.frombuffer(b"".join(t.column("sizes").to_pylist()), np.uint8).reshape(-1, 256)
            cut = np.flatnonzero((key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
                left, right = s + np.flatnonzero(own[s:e] == x[s]), s + np.flatnonzero(own[s:e] == y[s])
                for q in range(0, len(left), 128):
                    some = left[q : q + 128]
                    i, j = np.repeat(some, len(right)), np.tile(right, len(some))
                    keep = (part[i] != part[j]) & _able(i, j, n, at, similarity)
                    if x[s] == y[s]:
                        keep &= i < j
                    i, j = i[keep], j[keep]
                    good = []
                    for z in range(0, len(i), 1 << 14):
                        k, m = i[z : z + (1 << 14)], j[z : z + (1 << 14)]
                        both = np.minimum(sizes[k], sizes[m]).sum(axis=1, dtype=np.int64)
                        need = similarity / (1 + similarity) * (n[k] + n[m]) - 1e-6
                        good.append((both >= need) | (need > 10_000))
                    if good and (g := np.concatenate(good)).any():
                        pairs = _pairs(th[i[g]], th[j[g]])
                        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        for b in frames:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            last = np.ones(t.num_rows, bool)
            for c in ("key", "x", "y"):
                v = t.column(c).to_numpy()
                last &= v == v[-1]
            at = t.num_rows - int(last.sum())
            if at:
                yield from of(t.slice(0, at))
            held = t.slice(at)
        if held is not None:
            yield from of(held)

    def verified(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last, x = None, np.zeros(0, np.uint64)
        for b in frames:
            keep = []
            for t, za, zb in zip(b.column("a").to_pylist(), b.column("za").to_pylist(), b.column("zb").to_pylist(), strict=True):
                if t != last:  # rows come sorted by a
                    last, x = t, shingle_set(unpack.decompress(za), width)
                y = shingle_set(unpack.decompress(zb), width)
                small, big = sorted((len(x), len(y)))
                both = _shared(x, y) if small >= similarity * big else 0
                keep.append(both >= similarity * (small + big - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def whole(wanted: DataFrame, most: int = 500_000) -> DataFrame:
        """(th, z) of the texts ``wanted(th)``, one row each; up to ``most`` hashes are sent to the scan, more are joined."""
        wanted = stored(wanted.distinct(), "wanted")
        if wanted.count() <= most:
            found = texts.join(F.broadcast(wanted), "th", "left_semi").mapInArrow(tidy(packed), "th long, z binary")
        else:
            found = texts.mapInArrow(tidy(packed), "th long, z binary").join(wanted, "th", "left_semi")
        return found.groupBy("th").agg(F.first("z").alias("z"))

    def linked(pairs: DataFrame) -> DataFrame:
        known = whole(pairs.select(F.col("a").alias("th")).union(pairs.select("b")))
        both = pairs.join(known.select(F.col("th").alias("b"), F.col("z").alias("zb")), "b").join(known.select(F.col("th").alias("a"), F.col("z").alias("za")), "a")
        return stored(both.select("a", "b", "za", "zb").mapInArrow(tidy(verified), "a long, b long"), "links")

    def apart(pairs: DataFrame, part: DataFrame) -> DataFrame:
        """The pairs whose components ``part(th, component)`` differ."""
        for side in ("a", "b"):
            pairs = pairs.join(part.select(F.col("th").alias(side), F.col("component").alias(f"{side}_part")), side, "left")
        return pairs.where(F.coalesce("a_part", "a") != F.coalesce("b_part", "b")).select("a", "b")

    grid = texts.mapInArrow(tidy(dealt), "key long, turn int, th long, n int, at int").repartition("key").sortWithinPartitions("key", "turn", "th")
    found = stored(grid.mapInArrow(tidy(windows), "key long, a long, b long, n int, at int"), "windows")
    pairs = stored(found.where("key IS NULL").groupBy("a", "b").agg(F.min("n").alias("turn")), "candidates")
    links = linked(pairs.where("turn = 1").select("a", "b"))
    part = components(links if known is None else links.union(known)).withColumnRenamed("node", "th")
    second = stored(apart(pairs.where("turn = 2").select("a", "b"), part), "candidates")
    if not second.isEmpty():
        part = components(_star(part).union(linked(second))).withColumnRenamed("node", "th")
    large = found.where("key IS NOT NULL").select("key", F.col("a").alias("th"), "n", "at")
    large = stored(large.join(part, "th", "left").withColumn("component", F.coalesce("component", "th")), "large")
    mixed = large.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = stored(large.join(mixed.select("key", F.ceil(F.col("m") / block).alias("blocks")), "key"), "open")
    discard(found, pairs, second, large)
    if open_.isEmpty():
        return _star(part)
    sizes = whole(open_.select("th")).mapInArrow(tidy(buckets), "th long, sizes binary")
    own = open_.join(sizes, "th").withColumn("own", F.pmod(F.xxhash64("th"), "blocks")).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    ready = own.select("key", F.least("own", "o").alias("x"), F.greatest("own", "o").alias("y"), "own", "th", "n", "at", "component", "sizes").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    third = stored(ready.mapInArrow(tidy(crossed), "a long, b long").distinct(), "candidates")
    links = _star(part).union(linked(third))
    discard(open_, third)
    return links


def _star(part: DataFrame) -> DataFrame:
    """The components (th, component) as links."""
    return part.select(F.col("th").alias("a"), F.col("component").alias("b")).where("a <> b")


def _named(docs: DataFrame, width: int, bits: int, similarity: float | None = None) -> DataFrame:
    """(fp, doc_id, th, component_id) of every row.

    Links run between distinct fingerprints: a group of copies is one node, whose least doc_id is found by
    partial aggregation. With ``similarity`` links between texts are joined to those.
    """
    rows = stored(fingerprints(docs, width), "fingerprints")
    if similarity is None:
        key, least = "fp", rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
        linked = near_fingerprints(least.select("fp"), bits)
    else:
        key = "th"
        texts = rows.groupBy("th").agg(F.first("fp").alias("fp"), F.min("doc_id").alias("least"))
        hub = stored(texts.groupBy("fp").agg(F.min("th").alias("hub")), "hubs")
        known = texts.join(hub, "fp").select(F.col("th").alias("a"), F.col("hub").alias("b")).where("a <> b")
        near = near_links(hub.select("fp"), bits)
        for side in ("a", "b"):
            near = near.join(hub.select(F.col("fp").alias(side), F.col("hub").alias(f"{side}_hub")), side)
        linked = components(similar_texts(docs, width, similarity, known=stored(known.union(near.select("a_hub", "b_hub")), "links")))
        least = texts.select("th", "least")
    nodes = least.join(linked.withColumnRenamed("node", key), key, "left").withColumn("component", F.coalesce("component", key))
    first = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.join(first, "component").select(key, "component_id")
    return rows.join(named, key)


def simhash_components(docs: DataFrame, width: int = 3, bits: int = 2, similarity: float | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``.

    Documents link when their fingerprints differ in at most ``bits`` bits; ``component_id`` is the least
    doc_id that links reach, the row itself included. Null and wordless texts have fingerprint 0 and link
    like any other. A null doc_id stays null and takes the least known id of its component. Repeated rows
    repeat; an empty table gives no rows; very long texts are hashed whole; other columns are not read. With
    ``similarity``, texts whose shingle sets are as similar link too.
    """
    return _named(docs, width, bits, similarity).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 5, bits: int = 2, similarity: float | None = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns under any names, of which one document stays for each near-duplicate group.

    The least doc_id stays. A null doc_id can't stand for a group: such rows stay. Of rows that repeat the
    least doc_id all stay. Texts without words, null ones included, are copies of one another. An empty table
    gives no rows; very long texts are compared whole.
    """
    doc, th = free_names(docs, "doc", "th")
    drop = _named(docs.select("doc_id", "text"), width, bits, similarity).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct()
    return docs.join(drop, (docs["doc_id"] == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(th)), "left_anti")

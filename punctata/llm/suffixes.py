"""Suffix-array dedup: bytes covered by a 200-byte string that starts anywhere else.

Sorting every suffix of a corpus would move two hundred times its size, so suffixes that can't have a
twin are left out first, exactly. A string's *anchor* is the leftmost least hash among its 64-byte
grams, so equal strings have equal anchors at equal offsets. Neighbouring strings with one anchor are a
range. Three levels follow, each over what the level before left open:

1. ranges: a range whose anchor gram stands nowhere else has no twins; a range whose whole hull stands
   elsewhere is covered; others are open;
2. parts of eight neighbouring strings of open ranges, by the bytes all eight share and by their hull;
3. the single 200-byte suffixes of open parts: splitters sampled by Spark's range exchange deal them to
   buckets, each bucket sorts them by multikey quicksort over eight-byte tokens and compares neighbours.
   Splitters are whole suffixes, so a common start with many continuations is divided too, and strings on
   the two sides of a bucket boundary always differ and need no further comparison.

Equal items are combined in each task before they are dealt out (a task sends one row for a class and
settles its own copies at once), so a passage that a third of the corpus shares costs one row a task.
Grams with very many different surroundings are salted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctata.llm.common import batches, free_names, stored, tidy, utf8

LENGTH, GRAM, PART = 200, 64, 8
#: Different surroundings of a gram in one task from which its rows are salted.
HOT, SALTS = 256, 64
_CHUNK = 1 << 20
_ITEMS = "slot long, k long, c long, th long, ref long"
_FOUND = "th long, t2 int, a int, s int, e int, open boolean"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2^64."""
    inverse = pow(int(_BASE), -1, 1 << 64)
    out = []
    for x in (int(_BASE), inverse):
        p = np.full(n, _U(x))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_POWERS: list[np.ndarray] = []
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=_U) | _U(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def ranges(codes: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Ranges of the strings in ``codes``, whose texts end at ``ends``: (gram hash, hull hash, a, s, e).

    Strings start at s..e and share the anchor gram at a. None crosses a text's end.
    """
    if not _POWERS:
        _POWERS.extend(_powers(_CHUNK + 2 * LENGTH + 8))
    out = []
    for at in range(0, max(1, len(codes) - length + 1), _CHUNK):
        x = codes[at : at + _CHUNK + length - 1]
        m = len(x) - length + 1
        if m < 1:
            break
        text = np.searchsorted(ends, np.arange(at, at + m), "right")
        valid = np.arange(at, at + m) + length <= ends[text]
        h = np.zeros(len(x) + 1, _U)
        np.cumsum(_TABLE[x] * _POWERS[0][: len(x)], out=h[1:])
        n = len(x) - gram + 1
        g = _mix((h[gram:] - h[:-gram]) * _POWERS[1][:n])
        low = (g & ~_U((1 << 23) - 1)) | np.arange(n, dtype=_U)
        span, step = length - gram + 1, 1
        while step * 2 <= span:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if span > step:
            low = np.minimum(low[:m], low[span - step : span - step + m])
        anchor = (low[:m] & _U((1 << 23) - 1)).astype(np.int64)
        new = np.ones(m, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
        s = np.flatnonzero(new)
        e = np.append(s[1:], m) - 1
        s, e = s[valid[s]], e[valid[s]]
        a = anchor[s]
        hull = _mix((h[e + length] - h[s]) * _POWERS[1][s] + _mix(((a - s) << 8 | (a - e)).astype(_U)))
        out.append((g[a], hull, a + at, s + at, e + at))
    if not out:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _pack(a: np.ndarray, s: np.ndarray, e: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """Place in the text and offsets from the anchor in one long; counts and marks follow in ``_sent``."""
    return a | (a - s) << 32 | (a - e) << 40 | t2 << 51


def _unpack(ref: np.ndarray) -> tuple[np.ndarray, ...]:
    a = ref & 0xFFFFFFFF
    return ref >> 51 & 0xFFF, a, a - (ref >> 32 & 0xFF), a - (ref >> 40 & 0xFF)


_MANY, _SALTED, _MARK = 1 << 48, 1 << 49, 1 << 50


def _found(th: np.ndarray, ref: np.ndarray, is_open: bool) -> pa.RecordBatch:
    t2, a, s, e = (x.astype(np.int32) for x in _unpack(ref))
    return pa.RecordBatch.from_arrays([pa.array(th), *map(pa.array, (t2, a, s, e)), pa.array(np.full(len(th), is_open))], ["th", "t2", "a", "s", "e", "open"])


def _sent(k: np.ndarray, c: np.ndarray, th: np.ndarray, ref: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Combines one task's items: a row for each class (k, c), and rows marked as settled for its copies.

    Settled rows go along with ``_MARK``, dealt by text, and come out as covered.
    """
    order = np.lexsort((ref, th, c, k))
    k, c, th, ref = k[order], c[order], th[order], ref[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(k)))
    copies = np.repeat(sizes > 1, sizes)
    settled_th, settled_ref = th[copies], ref[copies]
    k, c, th = k[starts], c[starts], th[starts]
    ref = ref[starts] | np.where(sizes > 1, _MANY, 0)
    new_k = np.ones(len(k), bool)
    new_k[1:] = k[1:] != k[:-1]
    heads = np.flatnonzero(new_k)
    around = np.diff(np.append(heads, len(k)))
    hot = np.repeat(around > HOT, around)
    slot = np.where(hot, _mix(k.view(_U) + (c.view(_U) % _U(SALTS)) + _U(1)).view(np.int64), k)
    ref = ref | np.where(hot, _SALTED, 0)
    marks = k[heads[around > HOT]]  # to the gram's own place: it stands elsewhere too
    if len(settled_th):  # neighbouring ranges of a text become one row
        text, (t2, _, s, e) = settled_th, _unpack(settled_ref)
        order = np.lexsort((e, s, t2, text))
        text, t2, s, e = text[order], t2[order], s[order], e[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (t2[1:] != t2[:-1]) | (s[1:] > e[:-1] + 1)
        heads = np.flatnonzero(new)
        last = np.append(heads[1:], len(text)) - 1
        text, t2, s, e = text[heads], t2[heads], s[heads], e[last]
    else:
        text = t2 = s = e = np.zeros(0, np.int64)
    none = np.zeros(len(marks), np.int64)
    mark = np.full(len(text), _MARK) | t2 << 51
    columns = (
        np.concatenate([slot, marks, _mix(text.view(_U)).view(np.int64)]),
        np.concatenate([k, marks, s]),
        np.concatenate([c, none, e]),
        np.concatenate([th, none, text]),
        np.concatenate([ref, none - 1, mark]),
    )
    for at in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in columns], ["slot", "k", "c", "th", "ref"])


def _settle(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _ITEMS, sorted by slot, k and c, become covered and open ranges."""
    names = ["slot", "k", "c", "th", "ref"]
    held = [np.zeros(0, np.int64)] * 5

    def of(slot, k, c, th, ref) -> Iterator[pa.RecordBatch]:
        done = (ref >= 0) & (ref & _MARK != 0)
        if done.any():
            n = int(done.sum())
            yield pa.RecordBatch.from_arrays([pa.array(th[done]), pa.array((ref[done] >> 51).astype(np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(k[done].astype(np.int32)), pa.array(c[done].astype(np.int32)), pa.array(np.zeros(n, bool))], ["th", "t2", "a", "s", "e", "open"])
            slot, k, c, th, ref = (x[~done] for x in (slot, k, c, th, ref))
        if not len(k):
            return
        mark = ref < 0
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (slot[1:] != slot[:-1])
        group = np.cumsum(new) - 1
        elsewhere = np.zeros(group[-1] + 1, bool)
        np.logical_or.at(elsewhere, group, mark | (ref & _SALTED != 0))
        slot, k, c, th, ref, group = (x[~mark] for x in (slot, k, c, th, ref, group))
        if not len(k):
            return
        first = np.ones(len(k), bool)
        first[1:] = (group[1:] != group[:-1]) | (c[1:] != c[:-1])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(k)))
        many = np.logical_or.reduceat(ref & _MANY != 0, starts) | (sizes > 1)
        covered = np.repeat(many, sizes)
        if covered.any():
            yield _found(th[covered], ref[covered], False)
        classes = np.bincount(group[starts], minlength=len(elsewhere))
        open_ = (classes > 1)[group[starts]] | elsewhere[group[starts]]
        if open_.any():
            yield _found(th[starts[open_]], ref[starts[open_]], True)

    for frame in frames:
        now = [np.concatenate([h, frame.column(n).to_numpy(zero_copy_only=False)]) for h, n in zip(held, names, strict=True)]
        slot = now[0]
        last = int(np.searchsorted(slot, slot[-1], "left")) if len(slot) else 0
        if last:
            yield from of(*(x[:last] for x in now))
        held = [x[last:] for x in now]
    if len(held[0]):
        yield from of(*held)


def _settled(items: DataFrame) -> DataFrame:
    return items.repartition("slot").sortWithinPartitions("slot", "k", "c").mapInArrow(tidy(_settle), _FOUND)


def _gathered(frames: Iterator[pa.RecordBatch], made: Callable, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Combines what ``made`` gives for each batch; about ``most`` items are held at a time."""
    held, n = [], 0
    for b in frames:
        new = made(b)
        if len(new[0]):
            held.append(new)
            n += len(new[0])
        if n >= most:
            yield from _sent(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield from _sent(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _first_items(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    raw = utf8(b.column("text"))
    sizes = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(sizes)
    g, hull, a, s, e = ranges(np.frombuffer(b"".join(raw), np.uint8), ends)
    text = np.searchsorted(ends, s, "right")
    base = (ends - sizes)[text]
    th, t2 = (b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("th", "t2"))
    return g.view(np.int64), hull.view(np.int64), th[text], _pack(a - base, s - base, e - base, t2[text])


def _part_items(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Parts of open ranges, from their hulls' bytes."""
    k, c, th, place = [], [], [], []
    h = xxhash.xxh3_64_intdigest
    for t, t2, a, s, e, raw in zip(*(b.column(x).to_pylist() for x in ("th", "t2", "a", "s", "e", "hull")), strict=True):
        for i in range((a - e) // PART, (a - s) // PART + 1):
            o1, o2 = max(a - e, PART * i), min(a - s, PART * i + PART - 1)
            core = a - PART * i - s
            k.append(h(raw[core : core + LENGTH - PART + 1], i))
            c.append(h(raw[a - o2 - s : a - o1 - s + LENGTH], o1 << 8 | o2))
            th.append(t)
            place.append((a, a - o2, a - o1, t2))
    p = np.array(place, np.int64).reshape(-1, 4)
    return np.array(k, _U).view(np.int64), np.array(c, _U).view(np.int64), np.array(th, np.int64), _pack(*p.T)


def _suffixes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single strings of open parts. Of copies in a batch one goes on and stands for many.

    The others are settled; they go along with a short key of their own, so that they spread.
    """
    names = ["suffix", "th", "t2", "p", "many"]

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        out = []
        for x, places in held.items():
            out.append((x, *places[0], len(places) > 1))
            out += [(xxhash.xxh64_digest(repr(place)), *place, True) for place in places[1:]]
        for at in range(0, len(out), 5000):
            cols = zip(*out[at : at + 5000], strict=True)
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for b in frames:
        held: dict[bytes, list] = {}
        for t, t2, s, a, z, raw in zip(*(b.column(x).to_pylist() for x in ("th", "t2", "s", "ps", "pe", "hull")), strict=True):
            for p in range(a, z + 1):
                held.setdefault(raw[p - s : p - s + LENGTH], []).append((t, t2, p))
        yield from rows(held)


def multikey_order(keys: np.ndarray, small: int = 48) -> np.ndarray:
    """Order of rows of big-endian tokens, by three-way quicksort on one token column at a time."""
    n, width = keys.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == width:
            continue
        rows = order[lo:hi]
        if hi - lo <= small:
            rest = keys[rows, depth:]
            order[lo:hi] = rows[np.lexsort(rest.T[::-1])]
            continue
        token = keys[rows, depth]
        pivot = np.sort(token[:: max(1, len(token) // 9)])[len(token[:: max(1, len(token) // 9)]) // 2]
        less, same = token < pivot, token == pivot
        order[lo:hi] = np.concatenate([rows[less], rows[same], rows[~less & ~same]])
        x, y = lo + int(less.sum()), lo + int(less.sum()) + int(same.sum())
        todo += [(lo, x, depth), (x, y, depth + 1), (y, hi, depth)]
    return order


def _twins(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's suffixes in order: a suffix that equals a neighbour, or stood for many, is covered."""
    table = [b for b in frames if b.num_rows]
    if not table:
        return
    b = pa.Table.from_batches(table)
    short = pa.compute.less(pa.compute.binary_length(b.column("suffix")), LENGTH)
    yield from _singles(b.filter(short))
    b = b.filter(pa.compute.invert(short))
    if not b.num_rows:
        return
    keys = np.frombuffer(b"".join(b.column("suffix").to_pylist()), ">u8").reshape(b.num_rows, LENGTH // 8)
    order = multikey_order(keys.astype(_U))
    ordered = keys[order]
    same = (ordered[1:] == ordered[:-1]).all(axis=1)
    twin = b.column("many").to_numpy(zero_copy_only=False)[order].copy()
    twin[1:] |= same
    twin[:-1] |= same
    yield from _singles(b.take(pa.array(order[twin])))


def _singles(hit: pa.Table) -> Iterator[pa.RecordBatch]:
    if n := hit.num_rows:
        th, t2, p = (hit.column(x).combine_chunks() for x in ("th", "t2", "p"))
        yield pa.RecordBatch.from_arrays([th, t2, pa.array(np.zeros(n, np.int32)), p, p, pa.array(np.zeros(n, bool))], ["th", "t2", "a", "s", "e", "open"])


def _marked(docs: DataFrame) -> DataFrame:
    """A text's key: 64 hash bits and 12 of another hash."""
    return docs.withColumns({"th": F.xxhash64("text"), "t2": (F.crc32(F.encode("text", "UTF-8")) % 4096).cast("int")})


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different text of a task once, compressed for the way to its ranges."""
    pack, seen = zstandard.ZstdCompressor(level=1), set()
    for b in batches(frames):
        keys = list(zip(b.column("th").to_pylist(), b.column("t2").to_pylist(), strict=True))
        keep = [i for i, x in enumerate(keys) if x not in seen and not seen.add(x)]
        raw = utf8(b.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array([keys[i][0] for i in keep], pa.int64()), pa.array([keys[i][1] for i in keep], pa.int32()), pa.array([pack.compress(raw[i]) for i in keep], pa.binary())], ["th", "t2", "z"])


def _hulls(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    names = ["th", "t2", "a", "s", "e", "hull"]
    for b in frames:
        out = []
        for th, t2, z, held in zip(*(b.column(x).to_pylist() for x in ("th", "t2", "z", "at")), strict=True):
            raw = unpack.decompress(z)
            out += [(th, t2, x["a"], x["s"], x["e"], raw[x["s"] : x["e"] + LENGTH]) for x in held]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        for at in range(0, len(out), 5000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[at : at + 5000], strict=True), kinds, strict=True)], names)


def covered_starts(docs: DataFrame) -> DataFrame:
    """(th, t2, spans array<struct<s, e>>) of texts with strings that start elsewhere too, at s..e."""
    texts = _marked(docs.select("text").where(F.octet_length("text") >= LENGTH))
    first = stored(_settled(texts.mapInArrow(tidy(lambda fs: _gathered(batches(fs, most=1 << 20), _first_items)), _ITEMS)), "ranges")
    wanted = first.where("open").groupBy("th", "t2").agg(F.collect_set(F.struct("a", "s", "e")).alias("at"))
    packed = texts.mapInArrow(tidy(_packed), "th long, t2 int, z binary")
    hulls = stored(packed.join(wanted, ["th", "t2"]).mapInArrow(tidy(_hulls), "th long, t2 int, a int, s int, e int, hull binary"), "hulls")
    # A text that several tasks sent stands in several documents: its hulls are rightly more than one place.
    parts = stored(_settled(hulls.mapInArrow(tidy(lambda fs: _gathered(fs, _part_items, 1_000_000)), _ITEMS)), "parts")
    p = parts.where("open").select("th", "t2", "a", F.col("s").alias("ps"), F.col("e").alias("pe")).distinct()
    open_parts = hulls.join(p, ["th", "t2", "a"]).where("ps >= s and pe <= e").select("th", "t2", "s", "ps", "pe", "hull")
    suffixes = open_parts.mapInArrow(tidy(_suffixes), "suffix binary, th long, t2 int, p int, many boolean")
    single = suffixes.repartitionByRange("suffix").mapInArrow(tidy(_twins), _FOUND)
    found = first.where("not open").union(parts.where("not open")).union(single)
    return found.groupBy("th", "t2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal byte runs [from, to) that the strings at the given starts cover."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e + length)
        else:
            out.append([s, e + length])
    return [(a, z) for a, z in out]


def removal_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs(doc_id, text)``.

    A byte is removed if a 200-byte string that covers it also starts anywhere else, in the same text
    included. Null texts are empty; a null doc_id stays null; a repeated row counts as another place, so
    both lose what they share; an empty table gives no rows; very long texts are cut into pieces that overlap
    for hashing only; other columns are not read.
    """
    found = covered_starts(docs)

    def digested(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in frames:
            out = []
            for th, t2, z, spans in zip(*(b.column(x).to_pylist() for x in ("th", "t2", "z", "spans")), strict=True):
                raw, runs, at, kept = unpack.decompress(z), merged(spans), 0, []
                for a, e in runs:
                    kept.append(raw[at:a])
                    at = e
                kept.append(raw[at:])
                out.append((th, t2, sum(e - a for a, e in runs), len(runs), sha256(b"".join(kept)).hexdigest()))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["th", "t2", "n_removed", "n_spans", "sha"])

    texts = _marked(docs.select("text").where(F.octet_length("text") >= LENGTH))
    packed = texts.mapInArrow(tidy(_packed), "th long, t2 int, z binary")
    done = packed.join(found, ["th", "t2"]).mapInArrow(tidy(digested), "th long, t2 int, n_removed long, n_spans long, sha string").dropDuplicates(["th", "t2"])
    rows = _marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = rows.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"), "th", "t2")
    return rows.join(done, ["th", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256")
    )


def cut_text(text: str, spans: list[dict] | None) -> str:
    """``text`` without its covered runs; a character that a run covers in part stays."""
    if not spans:
        return text
    raw, at, kept = text.encode(), 0, []
    for a, e in merged(spans):
        while a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while e > a and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        if e > a:
            kept.append(raw[at:a])
            at = e
    kept.append(raw[at:])
    return b"".join(kept).decode()


def remove_repeats(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and ``length`` renewed; all rows and columns stay.

    A byte goes if a 200-byte string that covers it also starts anywhere else, but no character is cut in part.
    Null and short texts stay as they are, repeated rows lose what they share, an empty table gives no rows.
    Very long texts are cut as others. Other columns may have any names.
    """
    th, t2, spans = free_names(docs, "th", "t2", "spans")
    long = F.octet_length(F.col(text)) >= LENGTH
    found = covered_starts(docs.select(F.col(text).alias("text"))).withColumnsRenamed({"th": th, "t2": t2, "spans": spans})
    key = (F.xxhash64(F.col(text)) == F.col(th)) & ((F.crc32(F.encode(F.col(text), "UTF-8")) % 4096).cast("int") == F.col(t2))
    schema, names = docs.schema, docs.columns
    joined = docs.where(long).join(found, key, "left").select(*(docs[c] for c in names), spans)

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            texts = [x if x is None else cut_text(x, s) for x, s in zip(b.column(text).to_pylist(), b.column(spans).to_pylist(), strict=True)]
            new = {text: pa.array(texts, b.schema.field(text).type)}
            if length in names:
                new[length] = pa.array([n if x is None else len(x) for x, n in zip(texts, b.column(length).to_pylist(), strict=True)], b.schema.field(length).type)
            yield pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in names], names)

    short = docs.where(~F.coalesce(long, F.lit(False)))
    if length in names:
        short = short.withColumn(length, F.coalesce(F.length(text).cast(schema[length].dataType), F.col(length)))
    return joined.mapInArrow(tidy(cut), schema).union(short)

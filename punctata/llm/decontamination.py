"""Benchmark decontamination by suffix arrays over the training texts.

Test items come in blocks of bounded size, which are sent to the tasks; training texts stay where they are. A
task cuts its rows into shards of some megabytes, and each shard gets a suffix array over words: its words become
their ranks among the block's words (all others end a comparison, as a text's end does), and suffixes are sorted by
packed ranks, a few words at a time, of which later ones are only read where earlier ones tie. Suffixes that a word
outside the block cuts off before the shortest window can match nothing and are left out. Every test suffix is
then found by binary search: the range of suffixes that begin with its window are the verbatim occurrences, and its
neighbours in the order are the longest matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctata.llm.common import batches, free_names, stored, utf8
from punctata.llm.words import words

_U = np.uint64


class Block(NamedTuple):
    """Test items as words: ``ids`` are ranks among ``vocabulary`` (a sorted Arrow array), -1 after each item.

    ``names``: the block's item_ids as strings, sorted. ``item`` is the name's index for each place of ``ids``,
    ``starts`` each item's first place. ``window`` is the longest window; shorter items are one window.
    """

    vocabulary: pa.Array
    ids: np.ndarray
    names: list[str]
    item: np.ndarray
    starts: np.ndarray
    window: int


def block_of(rows: list[tuple[object, str | None]], window: int) -> Block:
    """A block from (item_id, text); a null item_id has the empty name, a null text no words."""
    rows = [(("" if i is None else str(i)), x or "") for i, x in rows]
    names = sorted({i for i, _ in rows})
    found, first = words([x.encode() for _, x in rows])
    coded = found.dictionary_encode()
    order = pa.compute.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    n = np.diff(first)
    ids = np.full(len(found) + len(rows), -1, np.int64)
    text = np.repeat(np.arange(len(rows)), n)
    if len(found):
        ids[np.arange(len(found)) + text] = rank[coded.indices.to_numpy()]
    number = {x: i for i, x in enumerate(names)}
    item = np.repeat(np.array([number[i] for i, _ in rows], np.int64), n + 1)
    return Block(coded.dictionary.take(order), ids, names, item, first[:-1] + np.arange(len(rows)), window)


class Packing(NamedTuple):
    """Words of a vocabulary side by side in 63 bits: 0 stands for an end."""

    bits: int
    per: int


def packing(words_known: int) -> Packing:
    bits = max(1, int(words_known + 1).bit_length())
    return Packing(bits, max(1, 63 // bits))


def packed(ids: np.ndarray, at: np.ndarray, offset: int, p: Packing) -> np.ndarray:
    """The ``per`` words from ``at + offset`` on; what follows an end is 0."""
    key, alive = np.zeros(len(at), _U), np.ones(len(at), bool)
    for c in range(p.per):
        place = np.minimum(at + offset + c, len(ids) - 1)  # the last word of ids is an end
        w = ids[place] + 1
        alive &= w > 0
        key = key << _U(p.bits) | np.where(alive, w, 0).astype(_U)
    return key


def suffix_array(ids: np.ndarray, at: np.ndarray, p: Packing, depth: int) -> np.ndarray:
    """The suffixes that start at ``at`` in the order of their first ``depth`` words, equal ones by place."""
    key = packed(ids, at, 0, p)
    order = np.argsort(key, kind="stable")
    key, rows = key[order], at[order]
    new = np.ones(len(rows), bool)
    new[1:] = key[1:] != key[:-1]
    open_ = key & _U((1 << p.bits) - 1) != 0
    for offset in range(p.per, depth, p.per):
        group = np.cumsum(new)
        tied = np.zeros(len(rows), bool)
        tied[1:] |= ~new[1:]
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied & open_)
        if not len(tied):
            break
        key = packed(ids, rows[tied], offset, p)
        order = np.lexsort((key, group[tied]))
        rows[tied], key = rows[tied][order], key[order]
        g = group[tied]
        now = np.ones(len(tied), bool)
        now[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        new[tied] |= now
        open_[tied] = key & _U((1 << p.bits) - 1) != 0
    return rows


def _first_at_least(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each range [lo, hi) of sorted keys, the first place whose key is at least ``value``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        todo = lo < hi
        if not todo.any():
            return lo
        middle = (lo + hi) // 2
        less = todo & (keys[np.minimum(middle, len(keys) - 1)] < value)
        lo = np.where(less, middle + 1, lo)
        hi = np.where(todo & ~less, middle, hi)


def ranges_of(ids: np.ndarray, array: np.ndarray, test: np.ndarray, at: np.ndarray, length: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Binary search: the range of ``array`` whose suffixes begin with the ``length`` words of ``test`` from each ``at`` on."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    left = np.flatnonzero(length > 0) if len(array) else np.zeros(0, np.int64)
    hi[length <= 0] = 0
    offset = 0
    while len(left):
        keys = packed(ids, array, offset, p)
        n = np.minimum(length[left] - offset, p.per)
        shift = ((p.per - n) * p.bits).astype(_U)
        least = packed(test, at[left], offset, p) >> shift << shift
        most = least + (_U(1) << shift)
        if offset:
            a = _first_at_least(keys, lo[left], hi[left], least)
            z = _first_at_least(keys, a, hi[left], most)
        else:
            a, z = np.searchsorted(keys, least), np.searchsorted(keys, most)
        lo[left], hi[left] = a, z
        offset += p.per
        left = left[(z > a) & (length[left] > offset)]
    return lo, hi


def places_of(ids: np.ndarray, array: np.ndarray, test: np.ndarray, at: np.ndarray, depth: int, p: Packing) -> np.ndarray:
    """Binary search: where in ``array``, ordered to ``depth`` words, each suffix of ``test`` would stand."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(array), np.int64)
    left, offset = np.arange(len(at)), 0
    while len(left) and len(array):
        keys, value = packed(ids, array, offset, p), packed(test, at[left], offset, p)
        a = _first_at_least(keys, lo[left], hi[left], value)
        z = _first_at_least(keys, a, hi[left], value + _U(1))
        lo[left], hi[left] = a, z
        offset += p.per
        left = left[(z > a) & (value & _U((1 << p.bits) - 1) != 0)] if offset < depth else left[:0]
    return lo


def common_words(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, most: int | None = None) -> np.ndarray:
    """How many words from ``x`` in ``a`` and ``y`` in ``b`` on are the same, up to ``most``; ends match nothing."""
    n, alive = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(alive) and (most is None or n[alive[0]] < most):
        i, j = x[alive] + n[alive], y[alive] + n[alive]
        inside = (i < len(a)) & (j < len(b))
        alive, i, j = alive[inside], i[inside], j[inside]
        alive = alive[(a[i] == b[j]) & (a[i] >= 0)]
        n[alive] += 1
    return n


def room(ids: np.ndarray) -> np.ndarray:
    """How many words stand from each place to the next end."""
    at = np.arange(len(ids))
    return np.minimum.accumulate(np.where(ids < 0, at, len(ids))[::-1])[::-1] - at


class Shard(NamedTuple):
    """Texts of some rows: ``ids`` by the block's ranks with an end after each text; ``text`` of each place; first places."""

    ids: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    n_words: np.ndarray


def shard_of(raw: list[bytes], vocabulary: pa.Array) -> Shard:
    found, first = words(raw)
    n = np.diff(first)
    text = np.repeat(np.arange(len(raw)), n)
    ids = np.full(len(found) + len(raw), -1, np.int64)
    if len(found) and len(vocabulary):
        ids[np.arange(len(found)) + text] = pa.compute.index_in(found, value_set=vocabulary).fill_null(-1).to_numpy()
    return Shard(ids, np.repeat(np.arange(len(raw)), n + 1), first[:-1] + np.arange(len(raw)), n)


class Search:
    """A block made ready in a task: its windows, equal ones once, with the items that hold them."""

    def __init__(self, block: Block):
        self.block, self.packing = block, packing(len(block.vocabulary))
        ids, w = block.ids, block.window
        left = room(ids)
        n = np.repeat(left[block.starts], np.diff(np.append(block.starts, len(ids))))  # an item's words, at its places
        full = left >= w
        short = np.zeros(len(ids), bool)
        short[block.starts] = True
        at = np.flatnonzero(full | (short & (n < w) & (n > 0)))
        size = np.minimum(left[at], w)
        # Equal windows are neighbours in the order of the test suffixes; one of each is searched.
        order = suffix_array(np.append(ids, -1), at, self.packing, w) if len(at) else at
        size_of = np.zeros(len(ids) + 1, np.int64)
        size_of[at] = size
        size = size_of[order]
        new = np.ones(len(order), bool)
        if len(order) > 1:
            same = common_words(ids, order[1:], ids, order[:-1], w)
            new[1:] = (size[1:] != size[:-1]) | (same < size[1:])
        self.test = np.append(ids, -1)
        self.at, self.size = order[new], size[new]
        owners = np.unique(np.stack([np.cumsum(new) - 1, block.item[order]], 1), axis=0) if len(order) else np.zeros((0, 2), np.int64)
        self.owner_starts, self.owners = np.searchsorted(owners[:, 0], np.arange(len(self.at) + 1)), owners[:, 1]
        kinds: dict[bytes, int] = {}
        #: Windows of the same items are of one kind, so a document's items are few sets, not many windows.
        self.kind = np.array([kinds.setdefault(self.owners[a:z].tobytes(), len(kinds)) for a, z in zip(self.owner_starts[:-1].tolist(), self.owner_starts[1:].tolist())], np.int64)
        self.sets = [np.frombuffer(x, np.int64) for x in kinds]
        self.least = int(self.size.min()) if len(self.size) else 0
        self.known: dict[bytes, tuple[int, str]] = {}

    def items(self, kinds: np.ndarray) -> np.ndarray:
        """Indexes of the names of all items of these kinds, in order."""
        return np.unique(np.concatenate([self.sets[k] for k in kinds.tolist()]))

    def array(self, shard: Shard, depth: int) -> np.ndarray:
        """The shard's suffix array, without suffixes that are cut off before the shortest window."""
        if not self.least:
            return np.zeros(0, np.int64)
        return suffix_array(shard.ids, np.flatnonzero(room(shard.ids) >= self.least), self.packing, depth)

    def hits(self, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(covered words as 0 or 1 for each place, text and kind of each window met, both once for each pair)."""
        array = self.array(shard, self.block.window)
        lo, hi = ranges_of(shard.ids, array, self.test, self.at, self.size, self.packing)
        n = hi - lo
        met = np.flatnonzero(n > 0)
        which = np.repeat(met, n[met])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n[met]) - n[met], n[met])
        place = array[lo[which] + inside] if len(which) else np.zeros(0, np.int64)
        size = len(shard.ids) + 1
        edge = np.bincount(place, minlength=size) - np.bincount(place + self.size[which], minlength=size)
        pairs = np.unique(shard.text[place] * max(1, len(self.sets)) + self.kind[which])
        return (np.cumsum(edge)[:-1] > 0).astype(np.int64), pairs // max(1, len(self.sets)), pairs % max(1, len(self.sets))


_HELD: dict[int, Search] = {}


def _search(block: Block, mark: int) -> Search:
    """One for each block and task process."""
    if mark not in _HELD:
        _HELD.clear()
        _HELD[mark] = Search(block)
    return _HELD[mark]


def _mark(block: Block) -> int:
    return int(sha256(b"".join([block.ids.tobytes(), repr(block.names).encode(), b"\0".join(block.vocabulary.to_pylist()), str(block.window).encode()])).hexdigest()[:15], 16)


class Items:
    """``rows(item_id, text)`` of a benchmark in blocks of about ``block_bytes`` of text, of which the driver holds one at a time.

    Rows are dealt by hash, to twice as many blocks until none is larger than twice ``block_bytes``; a single
    longer item is a block of its own. There is at least one block.
    """

    def __init__(self, rows: DataFrame, window: int, block_bytes: int):
        if window < 1 or block_bytes < 1:
            raise ValueError("window and block_bytes must be positive")
        self.rows, self.window = rows.select("item_id", "text").where(F.length("text") > 0).distinct(), window
        size = F.octet_length("text") + 32
        whole = self.rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
        self.blocks = max(1, -(-int(whole) // block_bytes))
        while self.blocks > 1:
            sizes = self.rows.groupBy(self._dealt().alias("b")).agg(F.sum(size).alias("s"), F.count("*").alias("n"))
            most = sizes.where("n > 1").agg(F.max("s")).first()[0]
            if most is None or most <= 2 * block_bytes:
                break
            self.blocks *= 2

    def _dealt(self):
        return F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks))

    def block(self, i: int) -> Block:
        return block_of([tuple(r) for r in self.rows.where(self._dealt() == i).orderBy("item_id", "text").collect()], self.window)


def _name_digest(names: list[str]) -> str:
    return sha256(",".join(names).encode()).hexdigest()


_ROW = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contaminated(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 8 << 20, shard_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs(doc_id, text)``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; n_hit counts a text's words
    inside any occurrence of a window, n_items the item_ids whose windows occur. Null, empty and wordless texts have
    no words and no windows; a null item_id is an item with the empty name, rows of one item_id are one item;
    repeated rows fare alike; very long texts are a shard of their own; other columns are not read; an empty table
    gives no rows, empty ``items`` leave all clean. With one block of items nothing is shuffled; of more blocks the
    hits are put together by the text's sha256.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tests = Items(items, window, block_bytes)
    if tests.blocks > 1:
        return _of_blocks(rows, tests, shard_bytes)
    block = tests.block(0)
    mark = _mark(block)

    def told(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, none = _search(block, mark), _name_digest([])
        for b in batches(frames, most=shard_bytes):
            shard = shard_of(utf8(b.column("text")), block.vocabulary)
            covered, text, kind = search.hits(shard)
            total = np.concatenate([[0], np.cumsum(covered)])
            n_hit = total[np.append(shard.starts[1:], len(shard.ids))] - total[shard.starts]
            n_items, names = np.zeros(b.num_rows, np.int64), [none] * b.num_rows
            for t, k in _groups(text, kind):
                key = k.tobytes()
                if key not in search.known:
                    if len(search.known) > 100_000:
                        search.known.clear()
                    at = search.items(k)
                    search.known[key] = (len(at), _name_digest([block.names[i] for i in at.tolist()]))
                n_items[t], names[t] = search.known[key]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (shard.n_words, n_hit, n_items, names, n_hit > 0))], [x.split()[0] for x in _ROW.split(", ")])

    return rows.mapInArrow(told, _ROW)


def _groups(text: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The kinds of each text; pairs come ordered."""
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else []
    for s, e in zip(starts, [*starts[1:], len(text)]):
        yield int(text[s]), kind[s:e]


def _hits(rows: DataFrame, tests: Items, shard_bytes: int) -> DataFrame:
    """(block, sha, spans, items): hit words and items of the texts that a block meets, once for each text and task at least.

    Each block's pass over ``rows(text)`` is written before the next block comes to the driver.
    """
    named = "sha binary, spans array<struct<s:long,e:long>>, items array<string>"

    def hit(block: Block, mark: int):
        def told(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search, seen = _search(block, mark), set()
            for b in batches(frames, most=shard_bytes):
                raw = utf8(b.column("text"))
                shard = shard_of(raw, block.vocabulary)
                covered, text, kind = search.hits(shard)
                out = []
                for t, k in _groups(text, kind):
                    sha = sha256(raw[t]).digest()
                    if sha in seen:
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()  # a text told twice is put together below
                    seen.add(sha)
                    own = covered[shard.starts[t] : shard.starts[t] + int(shard.n_words[t])]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
                    out.append((sha, [{"s": s, "e": e} for s, e in edges.reshape(-1, 2).tolist()], [block.names[i] for i in search.items(k).tolist()]))
                if out:
                    kinds = (pa.binary(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["sha", "spans", "items"])

        return told

    def of(i: int) -> DataFrame:
        block = tests.block(i)
        return stored(rows.select("text").mapInArrow(hit(block, _mark(block)), named), "hits").select(F.lit(i).alias("block"), "*")

    return reduce(DataFrame.union, map(of, range(tests.blocks)))


def _of_blocks(rows: DataFrame, tests: Items, shard_bytes: int) -> DataFrame:
    """As of one block, for several."""

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames, most=shard_bytes):
            raw = utf8(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(words(raw)[1])), pa.array([sha256(x).digest() for x in raw], pa.binary())], ["doc_id", "n_words", "sha"])

    hits = _hits(rows, tests, shard_bytes)
    one = hits.groupBy("sha", "block").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
    one = one.groupBy("sha").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Hit words of sorted spans: what each adds beyond the furthest end before it.
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    walk = F.aggregate("spans", start, lambda a, x: F.struct((a.n + F.greatest(x.e - F.greatest(x.s, a.to), F.lit(0).cast("long"))).alias("n"), F.greatest(a.to, x.e).alias("to")))
    one = one.select("sha", walk["n"].alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"))
    zero = F.lit(0).cast("long")
    joined = rows.mapInArrow(counted, "doc_id long, n_words long, sha binary").join(one, "sha", "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.lit(_name_digest([]))).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 8 << 20, shard_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` in whose text no window of an item occurs, with all their columns; cases as in ``contaminated``."""

    def clean(block: Block, mark: int):
        def kept(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = _search(block, mark)
            for b in batches(frames, most=shard_bytes):
                hit = np.zeros(b.num_rows, bool)
                hit[search.hits(shard_of(utf8(b.column("text")), block.vocabulary))[1]] = True
                yield b.filter(pa.array(~hit))

        return kept

    tests = Items(items, window, block_bytes)
    if tests.blocks == 1:
        block = tests.block(0)
        return docs.mapInArrow(clean(block, _mark(block)), docs.schema)
    (sha,) = free_names(docs, "sha")
    hit = _hits(docs, tests, shard_bytes).select(F.col("sha").alias(sha)).distinct()
    marked = docs.withColumn(sha, F.unhex(F.sha2(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")), 256)))
    return marked.join(hit, sha, "left_anti").select(*docs.columns)


def longest_matches(docs: DataFrame, items: DataFrame, window: int = 10, block_bytes: int = 8 << 20, shard_bytes: int = 8 << 20) -> DataFrame:
    """(item_id string, item_word, n_words, doc_id, doc_word): the longest verbatim match of each item's places, and where it stands.

    Only matches of ``window`` words or of a whole shorter item count, and of a match that begins earlier in the item only its
    beginning is told. Words count from 0. Of equal lengths the least doc_id, then the least doc_word is told. A null doc_id stands
    after others; other cases as in ``contaminated``. A task tells at most one row for each item's place and shard.
    """
    schema = "item_id string, item_row long, item_word long, item_words long, n_words long, doc_id long, doc_word long"

    def longest(block: Block, mark: int):
        def told(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = _search(block, mark)
            left = room(search.test)
            at = np.flatnonzero(left > 0)
            row = np.searchsorted(block.starts, at, "right") - 1
            size = left[block.starts][row]
            depth = int(left.max(initial=1))
            for b in batches(frames, most=shard_bytes):
                shard = shard_of(utf8(b.column("text")), block.vocabulary)
                array = search.array(shard, depth)
                if not len(array) or not len(at):
                    continue
                ids = b.column("doc_id").cast(pa.int64())
                place = places_of(shard.ids, array, search.test, at, depth, search.packing)
                below, above = array[np.maximum(place - 1, 0)], array[np.minimum(place, len(array) - 1)]
                n = np.maximum(common_words(shard.ids, below, search.test, at), common_words(shard.ids, above, search.test, at))
                enough = np.flatnonzero((n >= block.window) | ((n == size) & (n > 0) & (at == block.starts[row])))
                # Of all texts with the longest match: the range of suffixes that begin with it holds the least doc_id.
                lo, hi = ranges_of(shard.ids, array, search.test, at[enough], n[enough], search.packing)
                order = pa.compute.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
                word = np.arange(len(shard.ids)) - shard.starts[shard.text]
                which = np.repeat(np.arange(len(enough)), hi - lo)
                spot = array[lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
                first = np.lexsort((word[spot], order[shard.text[spot]], which))
                where = spot[first[np.searchsorted(which, np.arange(len(enough)))]]  # which is sorted, and stays so
                e = at[enough]
                cols = [pa.array([block.names[i] for i in block.item[e].tolist()], pa.string()), *map(pa.array, (row[enough], e - block.starts[row[enough]], size[enough], n[enough])), ids.take(pa.array(shard.text[where])), pa.array(word[where])]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

        return told

    tests = Items(items, window, block_bytes)

    def of(i: int) -> DataFrame:
        block = tests.block(i)
        found = docs.select("doc_id", "text").mapInArrow(longest(block, _mark(block)), schema)
        return (stored(found, "matches") if tests.blocks > 1 else found).select(F.lit(i).alias("block"), "*")

    # Equal item_ids may have several texts: item_row tells them apart.
    best = F.min(F.struct((-F.col("n_words")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("doc_word").alias("doc_word"))).alias("b")
    each = reduce(DataFrame.union, map(of, range(tests.blocks))).groupBy("block", "item_row", "item_id", "item_word").agg(best)
    each = each.select("*", (-F.col("b.n")).alias("n_words"))
    before = F.lag(F.struct("item_word", "n_words")).over(Window.partitionBy("block", "item_row").orderBy("item_word"))
    each = each.withColumn("_p", before)
    goes_on = (F.col("_p.item_word") == F.col("item_word") - 1) & (F.col("_p.n_words") == F.col("n_words") + 1)
    return each.where(~F.coalesce(goes_on, F.lit(False))).select("item_id", "item_word", "n_words", F.col("b.doc_id").alias("doc_id"), F.col("b.doc_word").alias("doc_word"))

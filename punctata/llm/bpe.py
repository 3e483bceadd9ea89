"""BPE encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding.

The vocabulary file's own rules are applied: NFC, white space, lower case, the pattern's pieces,
bytes as printable characters, a mark at each word's end. Merges of a piece are taken from a heap of
(rank, place); an entry is stale, and skipped, when either symbol has changed since it was pushed.
Decoding joins the vocabulary strings with spaces, which is what the library does for a file without a
decoder.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from punctata.llm.common import batches
from punctata.llm.units import UnitCache

_HELD: dict[str, Bpe] = {}

#: White space to Python and Arrow alone; the vocabulary's pattern takes these for marks.
_CONTROLS = "[\x1c-\x1f]"
#: Marks that the pattern keeps apart from the letters before them.
_MARKS = frozenset(".,;:!?")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 bytes are themselves, others follow from U+0100."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file; at most ``2 * most`` pieces' ids are kept as bytes."""

    def __init__(self, path: str, most: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in (ids | self.special).items()}
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(splitter["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        #: For each left id: right id -> rank. The last entry, that of a symbol merged away (-1), is empty.
        none: dict[int, int] = {}
        self.ranks: list[dict[int, int]] = [none] * (max(ids.values()) + 2)
        self.into: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if self.ranks[ids[left]] is none:
                self.ranks[ids[left]] = {}
            self.ranks[ids[left]][ids[right]] = rank
            self.into.append(ids[left + right])
        shown = byte_characters()
        self.inner = [ids[c] for c in shown]
        self.last = [ids[c + end] for c in shown]
        self.pieces = UnitCache(lambda xs: [array("I", self.merged(x)).tobytes() for x in xs], most)
        #: Each vocabulary string and the space after it, by id.
        self.spaced = pa.array([self.strings.get(i, "") + " " for i in range(max(self.strings) + 1)], pa.large_string())

    def merged(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern, or of what a special token is.

        The queue holds rank and place in one number. An entry is stale when the pair at its place has another rank.
        """
        if piece in self.special:
            return [self.special[piece]]
        raw = piece.encode()
        n = len(raw)
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        ranks, into = self.ranks, self.into
        shift = 14 if n < 1 << 14 else 40  # small numbers are compared faster
        mask = (1 << shift) - 1
        queue = []
        left, i = symbols[0], 0
        for right in symbols[1:]:
            if (m := ranks[left].get(right)) is not None:
                queue.append(m << shift | i)
            left = right
            i += 1
        if not queue:
            return symbols
        heapq.heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            top = pop(queue)
            i, m = top & mask, top >> shift
            j = after[i]
            if j >= n or ranks[symbols[i]].get(symbols[j]) != m:
                continue
            symbols[i] = new = into[m]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := ranks[new].get(symbols[k])) is not None:
                    push(queue, m << shift | i)
            if (h := before[i]) >= 0 and (m := ranks[symbols[h]].get(new)) is not None:
                push(queue, m << shift | h)
        return [s for s in symbols if s >= 0]

    def _split(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The pieces of all words, one word after the other, and how many there are up to each word's end."""
        flat: list[str] = []
        ends = [0]
        for word in words:
            if "<|" in word:
                for part in self.specials.split(word):
                    if part in self.special:
                        flat.append(part)
                    elif part:
                        flat += self.pattern.findall(self.plain(part))
            else:
                text = word.lower() if word.isascii() else self.plain(word)
                if text.isalpha():
                    flat.append(text)
                elif text[-1:] in _MARKS and text[:-1].isalpha():
                    flat += (text[:-1], text[-1])
                else:
                    flat += self.pattern.findall(text)
            ends.append(len(flat))
        return flat, ends

    @staticmethod
    def plain(text: str) -> str:
        """NFC and lower case, one character at a time."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts, one text after the other, and where each text's ids begin and end.

        A text's different words are told apart by Arrow, and split and looked up once.
        """
        texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
        odd = pa.compute.match_substring_regex(texts, _CONTROLS)
        if pa.compute.any(odd).as_py():  # none of these is in a space, so a text's words are the runs between spaces
            split = [[w for w in regex.split(r"[\s--[\x1c-\x1f]]+", x, flags=regex.V1) if w] if o else x.split() for x, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)]
            words = pa.array(split, pa.large_list(pa.large_string()))
        else:
            words = pa.compute.utf8_split_whitespace(texts)
        ends, n = words.offsets.to_numpy(), len(words.values)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        held = words.values.dictionary_encode()
        pieces, cuts = self._split(held.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(self.pieces.values(pieces), pa.large_binary())
        starts = np.frombuffer(ids.buffers()[1], np.int64)[: len(pieces) + 1] if pieces else np.zeros(1, np.int64)
        by_word = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(starts[np.array(cuts)])), ids.buffers()[2]])
        laid = by_word.take(held.indices)
        at = np.frombuffer(laid.buffers()[1], np.int64)[: n + 1]
        return np.frombuffer(laid.buffers()[2], "<u4", count=int(at[n]) // 4), at[ends] // 4

    def encode_ids(self, text: str) -> list[int]:
        return self.encode(pa.array([text]))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])

    def decode_all(self, ids: np.ndarray, at: np.ndarray) -> list[memoryview]:
        """Decoded UTF-8 of each text whose ids end at ``at``: vocabulary strings, a space between two."""
        if not len(ids):
            return [memoryview(b"")] * (len(at) - 1)
        laid = self.spaced.take(pa.array(ids.astype(np.int32)))
        cuts = np.frombuffer(laid.buffers()[1], np.int64)[at].tolist()
        data = memoryview(laid.buffers()[2])
        return [data[a : max(a, z - 1)] for a, z in zip(cuts[:-1], cuts[1:])]


def bpe(path: str) -> Bpe:
    """One per worker process and vocabulary file."""
    if path not in _HELD:
        _HELD[path] = Bpe(path)
    return _HELD[path]


def encode_decode(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids binary, decoded string) of every whole text, or digests of the two.

    A null text is empty: no ids, empty decoded text. Null doc_ids stay null, repeated rows repeat,
    other columns are not read, an empty table gives no rows. A text above a batch's bytes is a batch of its
    own and encoded whole. No shuffle. With ``keep_ids`` the ids
    (little-endian unsigned 32-bit) and the decoded text are returned, else their SHA-256 in hex.
    """

    def encoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(vocabulary)
        for b in batches(frames, most=8 << 20):
            ids, at = coder.encode(b.column("text"))
            decoded = coder.decode_all(ids, at)
            raw, cuts = memoryview(ids).cast("B") if len(ids) else memoryview(b""), (at * 4).tolist()
            own = [raw[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
            first = [bytes(x) if keep_ids else sha256(x).hexdigest() for x in own]
            second = [str(x, "utf-8") if keep_ids else sha256(x).hexdigest() for x in decoded]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.diff(at)), pa.array(first, pa.binary() if keep_ids else pa.string()), pa.array(second, pa.string())], names)

    names = ["doc_id", "n_tokens", *(("ids", "decoded") if keep_ids else ("ids_sha256", "decoded_sha256"))]
    kinds = ("long", "long", "binary" if keep_ids else "string", "string")
    return docs.select("doc_id", "text").mapInArrow(encoded, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))

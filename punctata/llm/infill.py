"""Fill-in-the-middle documents as piece tables.

A document is a list of descriptors (buffer, from, to) over two buffers that never change: its text and the
sentinels. Cutting a document splits a descriptor in two; an arrangement is an order of the descriptors of
prefix, middle and suffix with those of sentinels between them; the inverse order restores the text. Hashes
stream over what the descriptors show, and a text is put together only where it is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from punctata.llm.common import batches, free_names, utf8

TEXT, MARKS = 0, 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Piece(NamedTuple):
    buffer: int
    start: int
    end: int


class Sentinels(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Plan(NamedTuple):
    """How documents are cut and arranged: percent of documents cut, percent of these as spm, the draws' seed."""

    percent: int = 50
    spm_percent: int = 80
    seed: int = 42
    sentinels: Sentinels = Sentinels()


#: What stands where: indexes of 0 prefix, 1 middle, 2 suffix, after the sentinel of each.
_ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}


def _checked(plan: Plan) -> Plan:
    """Sentinels must be told apart wherever texts meet them: none holds another's end at its start, or another."""
    marks = plan.sentinels
    if any(not m for m in marks) or any(a != b and a in b for a in marks for b in marks) or len(set(marks)) < 3:
        raise ValueError("sentinels must be three different texts, none within another")
    if any(a[-n:] == b[:n] for a in marks for b in marks for n in range(1, min(len(a), len(b)))):
        raise ValueError("no sentinel may begin as another ends")
    return plan


def unit_ends(raw: bytes) -> np.ndarray:
    """Byte ends of the units ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: white space is ASCII, so bytes decide."""
    if not raw:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    return np.append(np.flatnonzero(space[1:] & ~space[:-1]) + 1, len(raw))


def split(pieces: list[Piece], place: int) -> list[Piece]:
    """The table with its descriptor that holds ``place`` of the text split there; ends split off an empty one."""
    out, seen, cut = [], 0, False
    for p in pieces:
        n = p.end - p.start
        if not cut and place <= seen + n:
            at = p.start + place - seen
            out += [Piece(p.buffer, p.start, at), Piece(p.buffer, at, p.end)]
            cut = True
        else:
            out.append(p)
        seen += n
    return out


def shown(pieces: list[Piece], buffers: tuple[bytes, bytes]) -> Iterator[memoryview]:
    views = tuple(map(memoryview, buffers))
    for p in pieces:
        yield views[p.buffer][p.start : p.end]


def digest(pieces: list[Piece], buffers: tuple[bytes, bytes]) -> str:
    h = sha256()
    for x in shown(pieces, buffers):
        h.update(x)
    return h.hexdigest()


def _marks(plan: Plan) -> tuple[bytes, list[Piece]]:
    """The sentinel buffer, and the descriptors of those before prefix, middle and suffix."""
    raw = [x.encode() for x in (plan.sentinels.prefix, plan.sentinels.middle, plan.sentinels.suffix)]
    ends = np.cumsum([len(x) for x in raw]).tolist()
    return b"".join(raw), [Piece(MARKS, e - len(x), e) for x, e in zip(raw, ends, strict=True)]


class Cut(NamedTuple):
    """A document's arrangement: n units, its form, the three descriptors of its text, and those of the output."""

    n: int
    form: str
    parts: list[Piece]
    pieces: list[Piece]


def arrange(raw: bytes, doc_id: int | None, plan: Plan, marks: list[Piece]) -> Cut:
    """Cuts a text after drawn units and puts its parts in order."""
    ends = unit_ends(raw)
    n = len(ends)
    whole = [Piece(TEXT, 0, len(raw))]
    draw = sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(draw[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not raw or h3 % 100 >= plan.percent or any(x.encode() in raw for x in plan.sentinels):
        return Cut(n, "plain", [], whole)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    places = [int(ends[u - 1]) if u else 0 for u in (a, b)]
    parts = split(split(whole, places[1]), places[0])
    form = "spm" if h4 % 100 < plan.spm_percent else "psm"
    return Cut(n, form, parts, [p for i in _ORDERS[form] for p in (marks[i], parts[i])])


def restored(raw: bytes, form: str, plan: Plan) -> list[Piece]:
    """Descriptors over an output that show the text it was made from, by the inverse order."""
    if form == "plain":
        return [Piece(TEXT, 0, len(raw))]
    names = [x.encode() for x in (plan.sentinels.prefix, plan.sentinels.middle, plan.sentinels.suffix)]
    order, at, starts = _ORDERS[form], 0, []
    for i in order:
        found = raw.find(names[i], at)
        if found < 0 or (not starts and found):
            raise ValueError(f"no {form} document: a sentinel is missing")
        at = found + len(names[i])
        starts.append((found, at))
    ends = [s for s, _ in starts[1:]] + [len(raw)]
    parts = [Piece(TEXT, s, e) for (_, s), e in zip(starts, ends, strict=True)]
    return [parts[order.index(i)] for i in range(3)]


def _characters(raw: bytes, p: Piece) -> int:
    x = np.frombuffer(raw, np.uint8, p.end - p.start, p.start)
    return len(x) - int(np.count_nonzero((x & 0xC0) == 0x80))


def infill_documents(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``docs`` with output, form, n, prefix_chars and middle_chars added, under free names, in this order.

    Null texts are empty and so plain; a null doc_id draws as one without digits; equal rows fare alike; very long
    texts are a batch of their own; other columns stay whatever their names; an empty table gives no rows. No shuffle.
    """
    plan = _checked(plan or Plan())
    buffer, marks = _marks(plan)
    names = free_names(docs, "output", "form", "n", "prefix_chars", "middle_chars")

    def made(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            out = []
            for raw, i in zip(utf8(b.column("text")), b.column("doc_id").to_pylist(), strict=True):
                c = arrange(raw, i, plan, marks)
                sizes = [_characters(raw, p) for p in c.parts[:2]] or [None, None]
                out.append((b"".join(shown(c.pieces, (raw, buffer))).decode(), c.form, c.n, *sizes))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], [*b.schema.names, *names])

    kinds = (T.StringType(), T.StringType(), T.LongType(), T.LongType(), T.LongType())
    return docs.mapInArrow(made, T.StructType([*docs.schema, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))]))


def restore_documents(rows: DataFrame, output: str = "output", form: str = "form", plan: Plan | None = None) -> DataFrame:
    """``rows`` with the text that ``output`` was made from, as ``restored`` under a free name.

    A null output or form restores nothing: null. An output without the sentinels of its form raises.
    """
    plan = _checked(plan or Plan())
    (name,) = free_names(rows, "restored")

    def back(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames, output):
            out = [
                None if f is None or null else b"".join(shown(restored(raw, f, plan), (raw, b""))).decode()
                for raw, f, null in zip(utf8(b.column(output)), b.column(form).to_pylist(), b.column(output).is_null().to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, name])

    return rows.mapInArrow(back, T.StructType([*rows.schema, T.StructField(name, T.StringType())]))


def infill_digests(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row of ``docs(doc_id, text)``.

    The second digest is of the text restored from the output alone. Cases as in ``infill_documents``; other
    columns are not read.
    """
    plan = _checked(plan or Plan())
    buffer, marks = _marks(plan)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def hashed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        for b in batches(frames):
            out = []
            for raw, i in zip(utf8(b.column("text")), b.column("doc_id").to_pylist(), strict=True):
                c = arrange(raw, i, plan, marks)
                sizes = [_characters(raw, p) for p in c.parts[:2]] or [None, None]
                made = b"".join(shown(c.pieces, (raw, buffer)))
                out.append((i, c.n, c.form, *sizes, digest(c.pieces, (raw, buffer)), digest(restored(made, c.form, plan), (made, b""))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(hashed, schema)

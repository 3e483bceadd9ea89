"""Token-id output: one zstandard frame for each document, one shared dictionary, offset indexes.

The store is two Parquet tables in a folder. ``dictionary`` has one row: the dictionary, its hash and
the bytes of an id. ``segments`` has rows of a few megabytes: frames one after the other in ``data``,
with the documents' ids, the offsets of their frames and their token counts beside it, and the hash of
the dictionary they need. Documents stand in ascending doc_id order over ``part`` and ``seg``; a short
document is read by its segment's row and one frame, without its neighbours being decompressed.
"""

from __future__ import annotations

import hashlib
import os
import string
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctata.llm.common import batches, new_path, running_start
from punctata.llm.units import UnitCache, is_spaced, safe_units

_HELD: dict[str, UnitCache] = {}

SEGMENT = "part int, seg int, first_id long, last_id long, dict_hash string, data binary, doc_ids array<long>, offsets array<long>, n_tokens array<long>"


def _cache(path: str) -> UnitCache:
    """One per worker process and vocabulary: ids of a unit as little-endian bytes of 16 or 32 bits."""
    if path not in _HELD:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tk = Tokenizer.from_file(path)
        tk.no_truncation()
        tk.no_padding()
        kind = _kind(tk.get_vocab_size())
        code, width = ("H", 2) if kind == "<u2" else ("I", 4)
        vocabulary = tk.get_vocab()
        spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        spaced[[i for s, i in vocabulary.items() if s.startswith("Ġ")]] = True

        def words(units: list[str], run: int = 400) -> list[bytes]:
            """Units of a space and letters, many in one string: a token that begins with the space begins a unit."""
            out = []
            joined = ["".join(units[at : at + run]) for at in range(0, len(units), run)]
            for x in tk.encode_batch_fast(joined, add_special_tokens=False):
                ids = array(code, x.ids)
                raw, at = ids.tobytes(), (np.flatnonzero(spaced[np.frombuffer(ids, kind)]) * width).tolist()
                out += [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)])]
            return out

        def ids(units: list[str]) -> list[bytes]:
            """Ids of new keys: a key stands for a space and itself, or for what follows if it begins with a space."""
            units = [u[1:] if u[:1] == " " else " " + u for u in units]
            out: list = [None] * len(units)
            plain = [i for i, u in enumerate(units) if u[:1] == " " and u[1:].isalpha()]
            rest = [i for i, u in enumerate(units) if u[:1] != " " or not u[1:].isalpha()]
            for i, v in zip(plain, words([units[i] for i in plain]), strict=True):
                out[i] = v
            for i, x in zip(rest, tk.encode_batch_fast([units[i] for i in rest], add_special_tokens=False), strict=True):
                out[i] = array(code, x.ids).tobytes()
            return out

        cache = UnitCache(ids, 400_000)
        cache.kind = kind
        _HELD[path] = cache
    return _HELD[path]


def _kind(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


#: The byte-level pattern without the space before a piece.
_PIECES = regex.compile(r"'(?:s|t|re|ve|m|ll|d)|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\n")
#: Units that the pattern cuts alike with a space before them and without: white space is single line feeds inside.
_CUT = regex.compile(r"(?!')\S+(?:\n\S+)*")


def _keys(unit: str) -> list[str]:
    """The keys of a unit's pieces, which no token crosses; other units stay whole."""
    word = unit.rstrip(string.punctuation)
    if word.isalpha():  # most often
        return [word, " " + unit[len(word) :]]
    if "<|" in unit or not _CUT.fullmatch(unit):
        return [unit]
    first, *more = _PIECES.findall(unit)
    return [first, *(" " + x for x in more)]


def encode_bytes(texts: list[str], cache: UnitCache) -> list[bytes]:
    """Each whole text's ids, from units that stand between safe boundaries of the byte-level pattern.

    A key of the cache stands for a space and itself, or for what follows if it begins with a space. Texts
    that may be cut at every space are cut, and their units told apart, by Arrow; a word and the marks after
    it are keys of their own. One gather then strings all ids of the batch together.
    """
    out: list = [b""] * len(texts)
    plain = [i for i, x in enumerate(texts) if x and is_spaced(x)]
    if plain:
        parts = pa.compute.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        ends, n = parts.offsets.to_numpy(), len(parts.values)
        firsts = pa.array([" " + texts[i].split(" ", 1)[0] for i in plain], parts.values.type)
        units = pa.concat_arrays([parts.values, firsts]).dictionary_encode()
        at = units.indices.to_numpy().copy()
        at[ends[:-1]] = at[n:]
        keys: list[str] = []
        cuts = [0]
        for u in units.dictionary.to_numpy(zero_copy_only=False).tolist():
            if u.isalpha():
                keys.append(u)
            else:
                keys += _keys(u)
            cuts.append(len(keys))
        ids = pa.array(cache.values(keys), pa.large_binary())
        starts = np.frombuffer(ids.buffers()[1], np.int64)[np.array(cuts)]
        by_unit = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(starts), ids.buffers()[2]])
        laid = by_unit.take(pa.array(at[:n]))
        bounds = np.frombuffer(laid.buffers()[1], np.int64)[: n + 1][ends]
        data = memoryview(laid.buffers()[2])
        for i, x, y in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[i] = bytes(data[x:y])
    for i in set(range(len(texts))).difference(plain):
        own = safe_units(texts[i])
        out[i] = b"".join(cache.values([" " + own[0], *("  " + x for x in own[1:])]))
    return out


def train_dictionary(docs: DataFrame, vocabulary: str, sample: int = 800, longest: int = 20_000, size: int = 65_536) -> bytes:
    """A dictionary from at most ``sample`` documents of at most ``longest`` characters, chosen by hash.

    Empty where the sample is too small to train on (fewer than 64 texts, or fewer bytes than eight dictionaries);
    frames are then made without a dictionary. A larger sample that can't be trained on raises.
    """
    known = docs.select("text", F.xxhash64("text", F.lit("dictionary")).alias("h")).where(F.length("text").between(1, longest))
    # Tasks send hashes only; the texts up to the last hash follow, of copies one.
    last = known.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = known.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first("text").alias("text")).orderBy("h").collect()
    blobs = encode_bytes([r.text for r in rows], _cache(vocabulary))
    try:
        return zstandard.train_dictionary(size, blobs, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        if len(blobs) >= 64 and sum(map(len, blobs)) >= 8 * size:
            raise
        return b""


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int | None = None, level: int = 3, segment_bytes: int = 2 << 20) -> str:
    """Encodes every whole text of ``docs(doc_id, text)`` and writes the store; returns ``path``.

    Null texts are empty. Rows are in ascending order of doc_id, null doc_ids first, then of the text's hash
    and the text; repeated rows are kept; a very long text is one frame; other columns are not read; an empty
    table gives a store without segments. ``end_id`` is appended to each document. One range shuffle of the
    texts, by doc_id and hash, so that many texts of one doc_id spread.
    """
    spark = docs.sparkSession
    words = train_dictionary(docs, vocabulary)
    mark = hashlib.sha256(words).hexdigest()

    def packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(vocabulary)
        tail = b"" if end_id is None else np.array([end_id], cache.kind).tobytes()
        width = np.dtype(cache.kind).itemsize
        shared = zstandard.ZstdCompressionDict(words) if words else None
        if shared:
            shared.precompute_compress(level=level)
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared)
        part, seg = TaskContext.get().partitionId(), 0
        data, keys, offsets, counts, at = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            known = [x for x in keys if x is not None]
            ends = [pa.array([known[0] if known else None], pa.int64()), pa.array([known[-1] if known else None], pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), *ends, pa.array([mark]), pa.array([b"".join(data)], pa.binary()), *(pa.array([x], pa.list_(pa.int64())) for x in (keys, offsets, counts))], names)

        for b in batches(frames, most=16 << 20):
            for key, ids in zip(b.column("doc_id").to_pylist(), encode_bytes([x or "" for x in b.column("text").to_pylist()], cache), strict=True):
                ids += tail
                frame = pack.compress(ids)
                data.append(frame)
                keys.append(key)
                offsets.append(at)
                counts.append(len(ids) // width)
                at += len(frame)
                if at >= segment_bytes:
                    yield row()
                    data, keys, offsets, counts, at, seg = [], [], [], [], 0, seg + 1
        if data:
            yield row()

    names = [x.split()[0] for x in SEGMENT.split(", ")]
    kind = _cache(vocabulary).kind
    spark.createDataFrame([(mark, bytearray(words), kind)], "dict_hash string, dict binary, kind string").coalesce(1).write.parquet(f"{path}/dictionary")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    # The frames are compressed already.
    ordered.mapInArrow(packed, SEGMENT).write.option("compression", "none").parquet(f"{path}/segments")
    return path


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<long>) read back from the store, or their unsigned crc32.

    ``start`` counts the ids of all documents before the row. Running sums go over the tasks' totals
    (one row a task), then over the segments of a task, then inside a segment. Rows are those that were written:
    null doc_ids and repeated rows too, empty texts with their end id alone or with no ids; a very long text is one
    frame, taken apart alone; a store without segments gives no rows.
    """
    held = spark.read.parquet(f"{path}/dictionary").first()
    words, kind, mark = bytes(held.dict), held.kind, held.dict_hash
    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")

    def unpacked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
        for b in frames:
            for r in b.to_pylist():
                if r["dict_hash"] != mark:
                    raise ValueError("these frames need another dictionary")
                data, ends = memoryview(r["data"]), [*r["offsets"][1:], len(r["data"])]
                out = []
                for a, z in zip(r["offsets"], ends, strict=True):
                    ids = np.frombuffer(unpack.decompress(data[a:z]), kind)
                    out.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.tolist())
                n = len(out)
                counts = np.array(r["n_tokens"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r["part"]] * n, pa.int32()), pa.array([r["seg"]] * n, pa.int32()), pa.array(r["doc_ids"], pa.int64()), pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(out, pa.int64() if digest else pa.list_(pa.int64()))], ["part", "seg", "doc_id", "inside", "n_tokens", "ids"])

    totals = segments.select("part", "seg", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = running_start(totals.groupBy("part").agg(F.sum("n").alias("n")), "part", "n", "part_start").select("part", "part_start")
    w = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("seg_start", F.coalesce(F.sum("n").over(w), F.lit(0).cast("long"))).join(parts, "part").select("part", "seg", (F.col("part_start") + F.col("seg_start")).alias("base"))
    rows = segments.mapInArrow(unpacked, f"part int, seg int, doc_id long, inside long, n_tokens long, ids {'long' if digest else 'array<long>'}")
    return rows.join(bases, ["part", "seg"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", F.col("ids").alias("ids_crc32" if digest else "ids"))


def read_documents(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """(doc_id, n_tokens, ids array<long>) of the documents ``ids``, a short list: only their frames are decompressed.

    Parquet skips segments by their first and last doc_id; the offset index leads to the frame inside one.
    Repeated doc_ids give all their documents, unknown ones none.
    """
    held = spark.read.parquet(f"{path}/dictionary").first()
    words, kind, mark = bytes(held.dict), held.kind, held.dict_hash
    wanted = sorted({int(x) for x in ids})
    near = reduce(or_, ((F.col("first_id") <= x) & (F.col("last_id") >= x) for x in wanted), F.lit(False))

    def taken(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
        want = set(wanted)
        for b in frames:
            for r in b.to_pylist():
                if r["dict_hash"] != mark:
                    raise ValueError("these frames need another dictionary")
                at = [i for i, x in enumerate(r["doc_ids"]) if x in want]
                if at:
                    data, ends = memoryview(r["data"]), [*r["offsets"][1:], len(r["data"])]
                    out = [np.frombuffer(unpack.decompress(data[r["offsets"][i] : ends[i]]), kind).tolist() for i in at]
                    yield pa.RecordBatch.from_arrays([pa.array([r["doc_ids"][i] for i in at], pa.int64()), pa.array([r["n_tokens"][i] for i in at], pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "n_tokens", "ids"])

    return spark.read.schema(SEGMENT).parquet(f"{path}/segments").where(near).mapInArrow(taken, "doc_id long, n_tokens long, ids array<long>")


def token_digests(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Writes the store to the shared folder and reads (doc_id, start, n_tokens, ids_crc32) back from it.

    Nulls, repeated rows, very long texts, other columns and empty tables as in ``write_tokens``.
    """
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, vocabulary, new_path(spark, "tokens"), end_id), digest=True)

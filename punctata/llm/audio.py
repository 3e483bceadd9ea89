"""Media columns: payloads kept as 8-bit PCM audio, and features of what is read back.

Samples are resampled 2:3 by a polyphase filter, cut into overlapped frames, and turned into log-mel
energies; hysteresis on frame energy gives segments. Energies are kept as fixed-shape Arrow tensors of
``PATCH`` frames by ``MELS`` bands, each with its time span, in an Arrow IPC stream in a binary column.
Every document is computed alone, from arrays whose shapes depend on its length only, so equal
payloads give equal features wherever they run.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from punctata.llm.common import batches, stored, utf8

BLOCK, RATE = 576, 8000
TAPS, FRAME, HOP, MELS, PATCH = 12, 256, 128, 16, 16
#: Payload bytes that are filtered at a time: bounds memory for long documents.
CHUNK = 512 * BLOCK

STORED = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_frames long, tensors binary, spans array<struct<start:double,end:double>>"
DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload(raw: bytes) -> bytes:
    """``raw`` and bytes 255 up to a positive multiple of 576."""
    return raw + b"\xff" * (-len(raw) % BLOCK if raw else BLOCK)


def to_wav(data: bytes) -> bytes:
    """Mono 8-bit PCM. A payload of 4 GB or more does not fit this container and raises."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(data)) + data


def from_wav(media: bytes) -> bytes:
    riff, _, wave, _, _, kind, channels, _, _, _, bits, tag, n = struct.unpack_from("<4sI4s4sIHHIIHH4sI", media)
    if (riff, wave, kind, channels, bits, tag) != (b"RIFF", b"WAVE", 1, 1, 8, b"data") or n != len(media) - 44:
        raise ValueError("no mono 8-bit PCM file")
    return media[44:]


@cache
def _filters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.arange(2 * TAPS) - (2 * TAPS - 1) / 2
    h = np.sinc(n / 3) * np.hamming(2 * TAPS)
    h *= 2 / h.sum()
    phases = np.zeros((3, 2 * (TAPS // 3 + 1)), np.float32)  # output phase p of input block m - j
    for p in range(2):
        for k in range(TAPS):
            j, inside = divmod(p - k, 3)
            phases[inside, 2 * -j + p] += h[p + 2 * k]
    hz = np.fft.rfftfreq(FRAME, 3 / (2 * RATE))
    mel = np.linspace(0, 2595 * np.log10(1 + hz[-1] / 700), MELS + 2)
    edges = 700 * (10 ** (mel / 2595) - 1)
    up = (hz[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - hz[:, None]) / (edges[2:] - edges[1:-1])
    return phases, np.hanning(FRAME).astype(np.float32), np.maximum(0, np.minimum(up, down)).astype(np.float32)


def resample(x: np.ndarray) -> np.ndarray:
    """Two samples for three; ``x`` has a multiple of three samples. Filter phases are applied to input blocks."""
    phases = _filters()[0]
    y = x.reshape(-1, 3) @ phases
    out = y[:, :2].copy()
    for j in range(1, phases.shape[1] // 2):
        out[j:] += y[:-j, 2 * j : 2 * j + 2]
    return out.ravel()


def log_mel(data: bytes) -> np.ndarray:
    """One row of log energies for each hop of the resampled payload; the last frame is padded with silence."""
    _, window, bank = _filters()
    x = np.frombuffer(data, np.uint8)
    rows = []
    for at in range(0, len(x), CHUNK):
        a, z = max(0, at - BLOCK), min(len(x), at + CHUNK + BLOCK)
        y = resample((x[a:z].astype(np.float32) - 128) / 128)[(at - a) // 3 * 2 :]
        n = (min(len(x), at + CHUNK) - at) // 3 * 2 // HOP
        y = np.concatenate([y, np.zeros(max(0, (n - 1) * HOP + FRAME - len(y)), np.float32)])
        frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[: n * HOP : HOP]
        spectrum = np.fft.rfft(frames * window, axis=1)
        rows.append(np.log10((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ bank + np.float32(1e-6)))
    return np.concatenate(rows).astype(np.float32)


def segments(level: np.ndarray, above: float = 0.1, below: float = 0.0) -> list[tuple[int, int]]:
    """Runs of frames whose level stays over median + ``below`` and reaches median + ``above``."""
    middle = np.median(level)
    low = np.concatenate([[False], level >= middle + below, [False]])
    edges = np.flatnonzero(low[1:] != low[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return []
    peaks = np.maximum.reduceat(np.append(level, -np.inf), np.column_stack([starts, ends]).ravel())[::2]
    keep = peaks >= middle + above
    return list(zip(starts[keep].tolist(), ends[keep].tolist(), strict=True))


def tensors(mels: np.ndarray) -> bytes:
    """Arrow IPC stream of (start, end, patch): patches of PATCH x MELS, the last padded with zeros."""
    n = -(-len(mels) // PATCH)
    patches = np.zeros((n * PATCH, MELS), np.float32)
    patches[: len(mels)] = mels
    step = PATCH * HOP * 3 / (2 * RATE)
    start = np.arange(n) * step
    end = np.minimum(start + step, len(mels) * HOP * 3 / (2 * RATE))
    batch = pa.record_batch([pa.array(start), pa.array(end), pa.FixedShapeTensorArray.from_numpy_ndarray(patches.reshape(n, PATCH, MELS))], ["start", "end", "patch"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every whole text as audio, written to the shared folder and read back.

    Null texts are empty and give one block of padding. Null doc_ids stay null, repeated rows repeat,
    other columns are not read, an empty table gives no rows. A very long text is one row's medium; 4 GB and
    more do not fit the container. No shuffle.
    """

    def packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames):
            raw = utf8(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in raw], pa.int64()), pa.array([to_wav(payload(x)) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return stored(docs.select("doc_id", "text").mapInArrow(packed, STORED), "media")


def audio_features(media: DataFrame) -> DataFrame:
    """(doc_id, n_frames, tensors, spans) of ``media(doc_id, media)``.

    Null doc_ids stay null, repeated rows repeat, other columns are not read, an empty table gives no rows; the
    medium of an empty text is one block of padding and has features like any other. A row is a batch of its own,
    so a very long medium is held alone. A null medium raises: ``store_media`` makes none.
    """

    def computed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                b = frame.slice(i, 1)
                mels = log_mel(from_wav(b.column("media")[0].as_py()))
                spans = [{"start": a * HOP * 3 / (2 * RATE), "end": z * HOP * 3 / (2 * RATE)} for a, z in segments(mels.mean(axis=1))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(mels)], pa.int64()), pa.array([tensors(mels)], pa.binary()), pa.array([spans], pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())])))], ["doc_id", "n_frames", "tensors", "spans"])

    return media.select("doc_id", "media").mapInArrow(computed, FEATURES)


def media_digests(media: DataFrame) -> DataFrame:
    """One digest row for each stored row: payload and stored form as read back, and the features.

    Equal media give equal rows. Nulls, repeated rows, empty and very long texts, other columns and empty tables
    as in ``audio_features``.
    """
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def computed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            out = []
            for n, held in zip(b.column("n_bytes").to_pylist(), b.column("media").to_pylist(), strict=True):
                data = from_wav(held)
                mels = log_mel(data)
                spans = segments(mels.mean(axis=1))
                mark = zlib.crc32(repr(spans).encode(), zlib.crc32(tensors(mels)))
                out.append((n, len(data), sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(held), sha256(held).hexdigest(), f"frames={len(mels)} segments={len(spans)} crc={mark:08x}"))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(computed, DIGESTS)

"""Lower-case words of a batch of texts as one Arrow array, found bytewise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: What each byte stands for in a word: A-Z become a-z; ASCII bytes that are neither letters nor digits are 0.
#: Bytes of 128 and more belong to characters beyond ASCII, which all stand in words.
_WORD = np.array([0 if b < 128 and not chr(b).isalnum() else ord(chr(b).lower()) if b < 128 else b for b in range(256)], np.uint8)


def words(raw: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the texts after lower-casing A-Z, in order, and the
    number of each text's first word, with the number of words at the end."""
    x = _WORD[np.frombuffer(b"\0" + b"\0".join(raw) + b"\0", np.uint8)]
    inside = x != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(x[inside])])
    begins = np.ones(len(raw) + 1, np.int64)
    np.cumsum(np.array([len(r) + 1 for r in raw], np.int64), out=begins[1:])
    begins[1:] += 1
    return found, np.searchsorted(starts, begins)

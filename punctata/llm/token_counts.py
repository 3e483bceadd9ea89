"""Token counts: batch encoding inside Arrow functions that return lengths only.

Batches hold about equal bytes of text. Long texts, like all others, are split at safe boundaries:
a single space whose left neighbour is neither a space nor the library's own space mark. No piece of
the vocabulary holds a space mark after another character, so no merge crosses such a cut, and the
dummy prefix that the library puts before every unit stands for the space that was cut away. Units
are encoded in one batch call per byte batch; those that a worker has met before are not encoded again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from punctata.llm.common import batches
from punctata.llm.units import UnitCache

_SAFE = re.compile(r"(?<=[^ ▁]) (?=[^ ▁])")
_HELD: dict = {}


def _cache(model: str) -> UnitCache:
    """One per worker process and sentencepiece model."""
    if model not in _HELD:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        _HELD[model] = UnitCache(lambda units: [len(x) for x in sp.encode(units, num_threads=1)])
    return _HELD[model]


def _tokenizer(model: str):
    """One per worker process and file of the tokenizers library."""
    if model not in _HELD:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _HELD[model] = Tokenizer.from_file(model)
        _HELD[model].no_truncation()
        _HELD[model].no_padding()
    return _HELD[model]


def units_of(text: str) -> list[str]:
    """Units whose token counts add up to that of ``text``."""
    if "▁" in text or "  " in text or text[:1] == " " or text[-1:] == " ":
        return _SAFE.split(text)
    return text.split(" ")


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, batch_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text of ``docs(doc_id, text)``.

    ``model``: path of a sentencepiece ``.model``, or of a ``.json`` file of the tokenizers library, whose
    texts are encoded whole, as its pieces may hold spaces in any way. A null text counts as empty: 0 bytes,
    0 tokens. A null doc_id stays null; repeated rows give repeated rows; a very long text is a batch of its
    own; other columns are not read; an empty table gives no rows. No shuffle: each scan task counts its own rows.
    """

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(frames, most=batch_bytes):
            texts = [x or "" for x in b.column("text").to_pylist()]
            if model.endswith(".json"):
                n = np.array([len(x.ids) for x in _tokenizer(model).encode_batch_fast(texts, add_special_tokens=False)], np.int64)
            else:
                units: list[str] = []
                ends = np.zeros(len(texts) + 1, np.int64)
                for i, x in enumerate(texts):
                    units += units_of(x)
                    ends[i + 1] = len(units)
                sums = np.concatenate([[0], np.cumsum(np.asarray(_cache(model).values(units), dtype=np.int64))])
                n = sums[ends[1:]] - sums[ends[:-1]]
            size = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

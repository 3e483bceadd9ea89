"""Texts of several batches' bytes go through whole."""

import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from punctata.llm import audio, bpe, mixing, sharding, token_counts
from punctata.llm.queries import vocabulary

LONG = "".join(f"word{i % 977} and {i} " for i in range(330_000))


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG) > 5 << 20
    rows = [(1, "short text", "a"), (2, LONG, "b"), (3, None, "a"), (4, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").cache()


def _of_long(rows):
    (row,) = rows.where("doc_id = 2").collect()
    assert rows.count() == 4
    return row


def test_bpe(docs):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(vocabulary("word_bpe_49k.json")).encode(LONG, add_special_tokens=False).ids
    row = _of_long(bpe.encode_decode(docs, vocabulary("word_bpe_49k.json")))
    assert row.n_tokens == len(ids) and row.ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_counts(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    row = _of_long(token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"), 4096))
    assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(LONG), len(sp.encode(LONG)), True)


def test_media(docs):
    row = _of_long(audio.media_digests(audio.store_media(docs)))
    data = LONG.encode() + b"\xff" * (-len(LONG) % 576)
    assert (row.n_bytes, row.payload_bytes, row.payload_sha256) == (len(LONG), len(data), sha256(data).hexdigest())


def test_sizes(docs):
    assert _of_long(mixing.mix(docs))["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", LONG))
    row = _of_long(sharding.shard_documents(docs))
    assert (row["size"], row.text_crc32) == (len(LONG) + 1, zlib.crc32(LONG.encode()))

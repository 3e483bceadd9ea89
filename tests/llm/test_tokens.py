import zlib
from hashlib import sha256

import numpy as np
import pytest
from data import SF, frame, texts

from punctata.llm import bpe, token_counts, token_store
from punctata.llm.common import new_path
from punctata.llm.queries import vocabulary


def _rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def _sources(spark):
    return [frame(spark, texts()), spark.read.parquet(f"{SF}/documents.parquet")]


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for docs in _sources(spark):
        want, start = [], 0
        for key, text in sorted(_rows(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            ids = [*tk.encode(text, add_special_tokens=False).ids, 0]
            want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = [tuple(r) for r in token_store.token_digests(docs, vocabulary("byte_bpe_50k.json"), 0).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_token_store_ids_and_order(spark):
    docs = frame(spark, texts())
    path = token_store.write_tokens(docs, vocabulary("byte_bpe_50k.json"), new_path(spark, "t"), segment_bytes=500)
    rows = token_store.read_tokens(spark, path).orderBy("start", "doc_id").collect()
    keys = [r.doc_id for r in rows if r.doc_id is not None]
    assert keys == sorted(keys)
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_counts(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    for docs in _sources(spark):
        want = [(k, len(t.encode()), n, n > 40) for k, t in _rows(docs) for n in (len(sp.encode(t)),)]
        got = [tuple(r) for r in token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"), 40).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_bpe(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for docs in _sources(spark):
        want = []
        for k, t in _rows(docs):
            ids = tk.encode(t, add_special_tokens=False).ids
            want.append((k, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        got = [tuple(r) for r in bpe.encode_decode(docs, vocabulary("word_bpe_49k.json")).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_bpe_cases():
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    own = bpe.Bpe(vocabulary("word_bpe_49k.json"), most=3)
    for t in texts():
        assert own.encode_ids(t or "") == tk.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("run", [lambda d: token_store.token_digests(d, vocabulary("byte_bpe_50k.json"), 0), lambda d: token_counts.count_tokens(d, vocabulary("piece_bpe_32k.model")), lambda d: bpe.encode_decode(d, vocabulary("word_bpe_49k.json"))])
def test_empty(spark, run):
    assert run(frame(spark, ["a"]).limit(0)).count() == 0


def test_json_counts(spark):
    from tokenizers import Tokenizer

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tk = Tokenizer.from_file(vocabulary(name))
        docs = frame(spark, texts())
        want = [(k, len(t.encode()), n, n > 40) for k, t in _rows(docs) for n in (len(tk.encode(t, add_special_tokens=False).ids),)]
        got = [tuple(r) for r in token_counts.count_tokens(docs, vocabulary(name), 40).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_one_document_is_read_by_its_own_frame(spark):
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(i, f"document number {i} says this and that, {'again ' * (i % 9)}") for i in range(400)] + [(None, "no id"), (5, "another five")], "doc_id long, text string")
    path = token_store.write_tokens(docs, vocabulary("byte_bpe_50k.json"), new_path(spark, "t"), end_id=0, segment_bytes=2000)
    # Every frame but that of document 77 is made unreadable.
    whole = spark.read.schema(token_store.SEGMENT).parquet(f"{path}/segments")
    at = "array_position(doc_ids, 77L)"
    z = f"if({at} = size(offsets), octet_length(data), element_at(offsets, cast({at} as int) + 1))"
    own = f"substring(data, cast(element_at(offsets, cast({at} as int)) as int) + 1, cast({z} - element_at(offsets, cast({at} as int)) as int))"
    a = f"element_at(offsets, cast({at} as int))"
    broken = F.expr(f"if(array_contains(doc_ids, 77L), concat(cast(repeat('x', cast({a} as int)) as binary), {own}, cast(repeat('x', cast(octet_length(data) - {z} as int)) as binary)), cast(repeat('x', octet_length(data)) as binary))")
    other = new_path(spark, "t")
    whole.withColumn("data", broken).write.parquet(f"{other}/segments")
    spark.read.parquet(f"{path}/dictionary").write.parquet(f"{other}/dictionary")
    row = token_store.read_documents(spark, other, [77]).collect()
    assert [(r.doc_id, r.ids) for r in row] == [(77, [*tk.encode(f"document number 77 says this and that, {'again ' * 5}", add_special_tokens=False).ids, 0])]
    assert sorted(r.doc_id for r in token_store.read_documents(spark, path, [5, 399, 1000]).collect()) == [5, 5, 399]
    assert token_store.read_documents(spark, path, [5]).where("n_tokens <> size(ids)").count() == 0

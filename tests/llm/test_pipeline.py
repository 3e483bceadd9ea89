import random

import pytest
from data import SF
from pyspark.sql import functions as F

import corpus_pipeline
from punctata.llm import bpe, mixing, quality, queries, suffixes
from punctata.llm.queries import vocabulary

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def test_stages_hand_on_documents(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == first.columns, name
        if name in ("quality", "near_dedup"):
            assert docs.exceptAll(before).count() == 0
        if name == "repeats":
            assert docs.count() == before.count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 100
    assert len(corpus_pipeline.STAGES) == 5 and set(queries.queries()) > {"pipeline"}


def _odd(spark):
    """Nulls, ties, repeated rows, a text of 5 MB, short texts, copies; 60 plain documents."""
    r = random.Random(4)
    word = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu", "na", "po") for b in ("r", "s", "nt", "ld", "m")]
    some = lambda n: " ".join(r.choice(word) for _ in range(n))
    rows = [(i, some(80), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [rows[3]] * 4 + [(7, "again another text", "en", "s0", 1), (None, None, None, None, None), (None, some(50), None, None, 0), (None, rows[5][1], "de", "s1", 2)]
    base = some(120)
    rows += [(100, base, "en", "s1", 3), (101, base.replace(" ", "  ", 1), "en", "s2", 3), (102, base + " end", "en", "s1", 3), (103, "", "en", "s0", 0), (104, "  ", None, "s0", 2), (105, None, "en", "s0", 0)]
    rows += [(200, some(900_000), "en", "s2", 9)]
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


def _set(text, width=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def _kept_by_brute_force(rows):
    """Rows that stay in the near-duplicate stage: links by fingerprints and by shingles, all pairs compared."""
    from punctata.llm.simhash import fingerprint

    texts = list({x.text for x in rows})
    sets, fps = [_set(t) for t in texts], [fingerprint((t or "").encode(), 5) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= 0.8 * max(len(sets[i]), len(sets[j])) else False
            if same or (fps[i] ^ fps[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    of = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for x in rows:
        if x.doc_id is not None:
            least[of[x.text]] = min(least.get(of[x.text], x.doc_id), x.doc_id)
    return [x for x in rows if x.doc_id is None or x.doc_id == least[of[x.text]]]


def _cut_by_brute_force(rows, length=200):
    """Rows of the repeats stage: all strings of 200 bytes of short texts are counted; the long text holds none twice."""
    count = {}
    for x in rows:
        raw = (x.text or "").encode()
        for i in range(len(raw) - length + 1 if len(raw) < 100_000 else 0):
            count[raw[i : i + length]] = count.get(raw[i : i + length], 0) + 1
    out = []
    for x in rows:
        raw = (x.text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1 if len(raw) < 100_000 else 0):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        text = None if x.text is None else bytes(b for b, g in zip(raw, gone) if not g).decode()
        out.append((x.doc_id, text, x.lang, x.source, x.n_chars if text is None else len(text)))
    return out


def test_small_pipeline_by_brute_force(spark):
    from hashlib import sha256

    import numpy as np
    from tokenizers import Tokenizer

    docs = _odd(spark)
    got = corpus_pipeline.near_dedup_stage(spark, docs, SF)
    want = _kept_by_brute_force(docs.collect())
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want))
    short = spark.createDataFrame(want, COLUMNS).where("doc_id IS NULL OR doc_id <> 200").cache()
    got = corpus_pipeline.repeats_stage(spark, short, SF)
    cut = _cut_by_brute_force(short.collect())
    assert sorted(repr(tuple(x)) for x in got.collect()) == sorted(map(repr, cut))
    docs = spark.createDataFrame(cut, COLUMNS)
    mixed = corpus_pipeline.mixing_stage(spark, docs, SF)
    taken = {}
    for x in mixing.mix(docs).collect():
        taken[x.doc_id, x.h] = taken.get((x.doc_id, x.h), 0) + x.copies
    have = {}
    for x in mixed.withColumn("h", mixing.row_hash()).collect():
        have[x.doc_id, x.h] = have.get((x.doc_id, x.h), 0) + 1
    assert have == {k: n for k, n in taken.items() if n}
    tk = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = []
    for x in mixed.collect():
        ids = tk.encode(x.text or "", add_special_tokens=False).ids
        want.append((x.doc_id, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(repr(tuple(x)) for x in corpus_pipeline.bpe_stage(spark, mixed, SF).collect()) == sorted(map(repr, want))


def test_mixing_shares_copies_among_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", i) for i in range(10)] + [(None, None, None, 5)] * 3 + [(2, "d e", "t", 1), (2, "f g h", "t", 2)], "doc_id long, text string, source string, extra int")
    taken = mixing.mix(docs).groupBy("doc_id", "size").agg(F.sum("copies").alias("n")).where("n > 0").collect()
    got = mixing.repeat_rows(docs).groupBy("doc_id", F.coalesce(F.size(F.split("text", " ")), F.lit(0)).cast("long").alias("size")).count().collect()
    assert sorted(map(repr, map(tuple, taken))) == sorted((repr((r[0], max(r[1], 0), r[2])) for r in got))
    per = mixing.repeat_rows(docs).where("doc_id = 1").groupBy("extra").count().collect()
    assert max(r[1] for r in per) - min(r[1] for r in per) <= 1


CLASH = ("_copies", "_doc", "_th", "_t2", "_spans", "doc", "th", "t2", "spans", "copies", "h", "nth", "y", "x", "Copy", "size", "fp", "total", "rows")


def test_stages_bear_clashing_columns_and_odd_rows(spark):
    docs = _odd(spark).where("doc_id IS NULL OR doc_id <> 200").withColumns({c: F.lit(1) for c in CLASH})
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0, name
        assert name == "repeats" or out.subtract(docs).count() == 0
    assert suffixes.remove_repeats(docs).count() == docs.count()
    assert bpe.encode_decode(docs, vocabulary("word_bpe_49k.json")).count() == docs.count()


@pytest.mark.parametrize("k", range(5))
def test_stages_bear_empty_tables(spark, k):
    empty = spark.createDataFrame([], COLUMNS)
    assert corpus_pipeline.STAGES[k][1](spark, empty, SF).count() == 0


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "b b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    fit, quality.fit = quality.fit, lambda x, y: seen.append(len(y)) or fit(x, y)
    try:
        quality.train(docs, labels, most=50)
    finally:
        quality.fit = fit
    assert seen == [50]

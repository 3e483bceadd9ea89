"""Fill-in-the-middle against the definition by strings, and round trips."""

from __future__ import annotations

import re
from hashlib import sha256

import pytest
from data import SF, frame, texts
from pyspark.sql import functions as F

from punctata.llm import infill
from punctata.llm.queries import documents

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MORE = ["a <P> b", "x<S>", "<M>", "<P", "a<", "<", "P> <S <M", " a b \x85", "  lead", "trail \t", "\n\n", "é" * 3 + " 日本 語", "w " * 50_000]


def brute(doc_id, text, percent=50, spm=80, seed=42, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    draw = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(draw[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in marks) or h[2] % 100 >= percent:
        return text, "plain", n, None, None
    if h[3] % 100 < spm:
        return marks[1] + s + marks[0] + p + marks[2] + m, "spm", n, len(p), len(m)
    return marks[0] + p + marks[1] + s + marks[2] + m, "psm", n, len(p), len(m)


@pytest.mark.parametrize("percent,spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_documents_and_round_trip(spark, percent, spm):
    docs = frame(spark, texts(2) + MORE).withColumn("Form", F.lit(1)).withColumn("restored", F.lit("own"))
    plan = infill.Plan(percent, spm, 42)
    made = infill.infill_documents(docs, plan)
    assert made.columns[: len(docs.columns)] == docs.columns
    output, form, n, prefix, middle = made.columns[len(docs.columns) :]
    back = infill.restore_documents(made, output, form, plan)
    forms = set()
    for r in back.collect():
        assert (r[output], r[form], r[n], r[prefix], r[middle]) == brute(r.doc_id, r.text, percent, spm)
        assert r[back.columns[-1]] == (r.text or "")
        forms.add(r[form])
    assert forms == {"plain"} | ({"spm"} if percent and spm else set()) | ({"psm"} if percent and spm < 100 else set())
    digests = sorted(map(tuple, infill.infill_digests(docs, plan).collect()), key=repr)
    want = []
    for r in docs.collect():
        out, form, n, prefix, middle = brute(r.doc_id, r.text, percent, spm)
        want.append((r.doc_id, n, form, prefix, middle, sha256(out.encode()).hexdigest(), sha256((r.text or "").encode()).hexdigest()))
    assert digests == sorted(want, key=repr)


def test_whole_table(spark):
    rows = infill.infill_digests(documents(spark, SF)).collect()
    texts_of = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    assert len(rows) == len(texts_of)
    for r in rows:
        out, form, n, prefix, middle = brute(r.doc_id, texts_of[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, prefix, middle, sha256(out.encode()).hexdigest())


def test_texts_end_where_sentinels_begin():
    plan = infill.Plan(100, 0, 1)
    buffer, marks = infill._marks(plan)
    for text in ("a<P b< c<S d", "<", "<S <P <M", "P> S> M>"):
        for i in range(40):
            for form_percent in (0, 100):
                c = infill.arrange(text.encode(), i, plan._replace(spm_percent=form_percent), marks)
                made = b"".join(infill.shown(c.pieces, (text.encode(), buffer)))
                assert b"".join(infill.shown(infill.restored(made, c.form, plan), (made, b""))) == text.encode()


def test_splitting_keeps_what_is_shown():
    raw = b"some text of a document"
    for a in range(len(raw) + 1):
        for b in range(a + 1):
            pieces = infill.split(infill.split([infill.Piece(infill.TEXT, 0, len(raw))], a), b)
            assert len(pieces) == 3 and [p.end - p.start for p in pieces] == [b, a - b, len(raw) - a]
            assert b"".join(infill.shown(pieces, (raw, b""))) == raw


def test_bad_sentinels_and_outputs_raise(spark):
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "bac"), ("<P>", "x<P>y", "<M>")):
        with pytest.raises(ValueError):
            infill.infill_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), infill.Plan(sentinels=infill.Sentinels(*bad)))
    with pytest.raises(ValueError):
        infill.restored(b"no sentinel", "psm", infill.Plan())


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert infill.infill_digests(none).count() == 0 and infill.infill_documents(none).count() == 0
    rows = spark.createDataFrame([(None, None), ("<P>x<S>y<M>z", "psm"), ("t", "plain"), ("t", None)], "output string, form string")
    assert sorted(map(repr, (r[2] for r in infill.restore_documents(rows).collect()))) == sorted(map(repr, [None, "xzy", "t", None]))

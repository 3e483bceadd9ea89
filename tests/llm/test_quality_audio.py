import io
import wave
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from data import SF, frame, texts

from punctata.llm import audio, quality


def test_trees_learn_and_flatten():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    p = model.scores(x[2000:])
    assert ((p >= 0.5) == (y[2000:] > 0)).mean() > 0.97

    def walk(row):
        total = model.base
        for i in model.roots:
            while model.feature[i] >= 0:
                i = model.left[i] if row[model.feature[i]] <= model.threshold[i] else model.right[i]
            total += model.value[i]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(p[:50], [walk(row) for row in x[2000:2050]])
    assert np.allclose(quality.fit(x[:0], y[:0]).scores(x[:3]), 0.5)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out and quality is not null").collect()
    p, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    order = p.argsort().argsort() + 1
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    right = np.mean((p >= 0.3) == (y == 1))
    print(len(y), y.mean(), auc, right)
    assert auc > 0.9 and right > 0.9


def test_score_odd_rows(spark):
    docs = frame(spark, texts())
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0


def test_media_round_trip(spark):
    for docs in (frame(spark, texts()), spark.read.parquet(f"{SF}/documents.parquet")):
        got = sorted((tuple(r) for r in audio.media_digests(audio.store_media(docs)).collect()), key=str)
        want = []
        for r in docs.collect():
            raw = (r.text or "").encode()
            data = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
            f = io.BytesIO()
            with wave.open(f, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(1)
                w.setframerate(8000)
                w.writeframes(data)
            want.append((r.doc_id, len(raw), len(data), sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(f.getvalue()), sha256(f.getvalue()).hexdigest()))
        assert [g[:7] for g in got] == sorted(want, key=str)
        by = {}
        for g in got:
            assert by.setdefault(g[3], g[7]) == g[7]
    assert audio.media_digests(audio.store_media(docs.limit(0))).count() == 0


def test_resampling_against_definition():
    r = np.random.default_rng(1)
    x = r.normal(size=576).astype(np.float32)
    n = np.arange(24) - 11.5
    h = np.sinc(n / 3) * np.hamming(24)
    h *= 2 / h.sum()
    up = np.zeros(1152)
    up[::2] = x
    want = np.convolve(up, h)[: 1152 : 3]
    assert np.allclose(audio.resample(x), want, atol=1e-5)


def test_frames_do_not_depend_on_chunks(monkeypatch):
    data = audio.payload(bytes(np.random.default_rng(2).integers(0, 256, 9 * 576, dtype=np.uint8)))
    whole = audio.log_mel(data)
    assert whole.shape == (len(data) // 3 * 2 // audio.HOP, audio.MELS)
    monkeypatch.setattr(audio, "CHUNK", 2 * audio.BLOCK)
    assert np.allclose(audio.log_mel(data), whole, atol=1e-3)


def test_tensors_and_segments(spark):
    mels = np.arange(20 * 16, dtype=np.float32).reshape(20, 16)
    table = pa.ipc.open_stream(audio.tensors(mels)).read_all()
    patches = table.column("patch").combine_chunks().to_numpy_ndarray()
    assert patches.shape == (2, 16, 16) and np.array_equal(patches.reshape(-1, 16)[:20], mels)
    assert table.column("end").to_pylist()[-1] == pytest.approx(20 * 128 * 3 / 16000)
    level = np.array([0, 0.05, 0.2, 0.05, -0.1, 0.05, 0.02, -0.3, 0.3, -1, -1])
    assert audio.segments(level) == [(1, 4), (8, 9)] or audio.segments(level) == [(0, 4), (8, 9)]
    docs = frame(spark, texts())
    rows = audio.audio_features(audio.store_media(docs)).collect()
    assert len(rows) == docs.count() and all(r.n_frames > 0 for r in rows)

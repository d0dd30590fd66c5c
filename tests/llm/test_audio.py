import cmath
import hashlib
import io
import math
import wave
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickspark.llm import audio as A
from tickspark.llm import queries as Q


def test_round_trip(spark, make_docs, as_table):
    texts = ["", None, "abc", "x" * 64, "é" * 33, "long " * 60_000, "abc"]
    d = as_table(make_docs(texts))
    got = {r.doc_id: r for r in Q.op8_audio_features(spark, d).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        pad = raw + bytes(-len(raw) % 64 if raw else 64)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(pad))
        assert r.payload_sha256 == hashlib.sha256(pad).hexdigest()
        assert r.tail_crc32 == zlib.crc32(pad[-64:])
    assert got[2].feature == got[6].feature and got[0].feature == got[1].feature != got[2].feature
    media = {r.doc_id: r.media for r in A.store_audio(make_docs(texts)).collect()}
    w = wave.open(io.BytesIO(media[4]))
    assert (w.getsampwidth(), w.getframerate(), w.readframes(w.getnframes())[:66]) == (1, A.RATE, ("é" * 33).encode())
    assert got[4].media_sha256 == hashlib.sha256(media[4]).hexdigest() and got[4].media_bytes == len(media[4])


def test_not_a_wav(spark):
    df = spark.createDataFrame([(1, bytearray(b"nope")), (2, None)], "doc_id long, media binary")
    rows = A.audio_features(df).collect()
    assert [r.payload_sha256 for r in rows] == [None, None]
    assert A.audio_features(df.limit(0)).count() == 0


def test_pieces_equal_whole(monkeypatch):
    raw = memoryview(np.random.default_rng(0).integers(0, 256, 50_000, np.uint8).tobytes())
    whole = A.log_mel(raw)
    monkeypatch.setattr(A, "_FRAMES_AT_ONCE", 7)
    parts = A.log_mel(raw)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_segments_hysteresis():
    e = np.array([-9, -9, 9, 6, 5, -9, -9, -9, -9, 9, -9.0])
    assert A.active_segments(e) == [(2, 5), (9, 10)]


def naive_features(raw):
    """Definitions, sample by sample: windowed-sinc resampling, DFT, mel triangles, hysteresis."""
    x = [(b - 128) / 128 for b in raw]
    half, wide = A.UP * A.TAPS // 2, max(A.UP, A.DOWN)
    taps = [np.sinc(t / wide) * w * A.UP / wide for t, w in zip(range(-half, half), np.hanning(2 * half), strict=True)]
    n = math.ceil(len(x) * A.UP / A.DOWN)
    y = []
    for k in range(n):
        total = 0.0
        for m in range(len(x)):
            at = k * A.DOWN - m * A.UP + half
            if 0 <= at < 2 * half:
                total += x[m] * taps[at]
        y.append(total)
    rate = A.RATE * A.UP / A.DOWN
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** ((mel(20) + (mel(rate / 2) - mel(20)) * i / (A.MELS + 1)) / 2595) - 1) for i in range(A.MELS + 2)]
    frames = max(1, math.ceil(max(0, n - A.FRAME) / A.HOP) + 1)
    out, energy = [], []
    hann = np.hanning(A.FRAME)
    for f in range(frames):
        seg = [(y[f * A.HOP + i] if f * A.HOP + i < n else 0.0) * hann[i] for i in range(A.FRAME)]
        power = [abs(sum(v * cmath.exp(-2j * math.pi * b * i / A.FFT) for i, v in enumerate(seg))) ** 2 for b in range(A.FFT // 2 + 1)]
        row = []
        for lo, mid, hi in zip(edges, edges[1:], edges[2:], strict=False):
            row.append(math.log10(sum(p * max(0.0, min((b * rate / A.FFT - lo) / (mid - lo), (hi - b * rate / A.FFT) / (hi - mid))) for b, p in enumerate(power)) + 1e-6))
        out.append(row)
        energy.append(10 * math.log10(sum(power) / len(power) + 1e-9))
    mean, on, segments = sum(energy) / len(energy), False, []
    for i, e in enumerate(energy):
        if not on and e - mean >= A.ENTER_DB:
            on = True
            segments.append([i, i + 1])
        elif on and e - mean < A.LEAVE_DB:
            on = False
        elif on:
            segments[-1][1] = i + 1
    return out, energy, [tuple(s) for s in segments]


@pytest.mark.parametrize("seed, n", [(0, 64), (1, 1472), (2, 2000)])
def test_features_against_definitions(seed, n):
    pick = np.random.default_rng(seed)
    loud = np.where(np.arange(n) // 300 % 2, 100, 3)
    raw = (128 + loud * np.sin(np.arange(n) * (0.2 + seed / 5)) + pick.normal(size=n) * 2).clip(0, 255).astype(np.uint8).tobytes()
    mel, energy, segments = naive_features(raw)
    got = A.log_mel(memoryview(raw))
    assert np.allclose(got[0], mel, atol=2e-3) and np.allclose(got[1], energy, atol=2e-2)
    assert A.active_segments(got[1]) == segments


def test_windows_are_stored_as_tensors(spark, make_docs, tmp_path):
    texts = ["short", "a long text " * 3000]
    A.audio_features(A.store_audio(make_docs(texts))).write.parquet(str(tmp_path / "features"))
    rows = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "features")).collect()}
    for i, t in enumerate(texts):
        stored = A.read_windows(bytes(rows[i].windows))
        kind = stored.schema.field("logmel").type
        assert isinstance(kind, pa.FixedShapeTensorType) and kind.shape == [A.WINDOW_FRAMES, A.MELS]
        raw = t.encode()
        mel, _ = A.log_mel(memoryview(raw + bytes(-len(raw) % 64)))
        back = stored.column("logmel").to_numpy_ndarray()
        assert len(back) == rows[i].n_windows and np.array_equal(back.reshape(-1, A.MELS)[: len(mel)], mel)
        step = A.WINDOW_FRAMES * A.HOP * 1000 * A.DOWN / A.UP / A.RATE
        assert np.allclose(stored.column("start_ms"), np.arange(len(back)) * step) and np.allclose(stored.column("end_ms"), np.arange(1, len(back) + 1) * step)
        h = hashlib.sha256(back.tobytes())
        h.update(stored.column("start_ms").to_numpy().tobytes() + stored.column("end_ms").to_numpy().tobytes())
        assert rows[i].windows_sha256 == h.hexdigest()
    lean = A.audio_features(A.store_audio(make_docs(texts)), keep_windows=False).collect()
    assert [(r.windows, r.windows_sha256) for r in sorted(lean)] == [(None, rows[i].windows_sha256) for i in range(2)]
    both = A.feature_digest(spark.read.parquet(str(tmp_path / "features"))).select("feature").collect()
    assert len({r.feature for r in both}) == 2


@pytest.mark.parametrize("channels, width, rate", [(2, 1, 16_000), (1, 2, 16_000), (1, 1, 8_000)])
def test_other_forms_are_refused(channels, width, rate):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(b"x" * 640)
    assert A.wav_samples(out.getvalue()) is None
    assert A.wav_samples(out.getvalue()[:20]) is None


def test_clashing_columns_and_repeated_rows(spark, make_docs, as_table):
    docs = make_docs(["a", "b" * 5000])
    for clash in ("media", "n_bytes", "windows", "feature", "doc"):
        docs = docs.withColumn(clash, docs.source)
    rows = Q.op8_audio_features(spark, as_table(docs.union(docs))).collect()
    assert len(rows) == 4 and len({r.feature for r in rows}) == 2
    assert Q.op8_audio_features(spark, as_table(docs.limit(0))).count() == 0

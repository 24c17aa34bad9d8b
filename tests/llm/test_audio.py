import hashlib
import io
import math
import random
import wave
import zlib

import numpy as np
import pyarrow as pa

from statuta.llm import audio as A

from .data import AWKWARD, documents, text


def test_wav_is_readable_elsewhere():
    payload = A.padded(b"abc" * 100)
    with wave.open(io.BytesIO(A.write_wav(payload))) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.getframerate(), w.readframes(w.getnframes())) == (1, 1, A.RATE, payload)
    assert bytes(A.read_wav(A.write_wav(payload))[1]) == payload


def test_padding():
    assert [len(A.padded(bytes(n))) for n in (0, 1, 63, 64, 65, 128)] == [64, 64, 64, 64, 128, 128]


def test_resampling_equals_stuffed_convolution():
    samples = np.frombuffer(A.padded(random.Random(1).randbytes(2000)), dtype=np.uint8)
    x = np.zeros(len(samples) * A.UP)
    x[:: A.UP] = (samples.astype(float) - 128) / 128
    n = np.arange(-A.TAPS * A.UP // 2, A.TAPS * A.UP // 2)
    h = np.sinc(n / A.DOWN) * np.hanning(A.TAPS * A.UP + 1)[:-1]
    full = np.convolve(x, (h / h.sum() * A.UP)[::-1])
    got = A.resample(samples, 0, 1300)
    want = [full[k * A.DOWN + A.TAPS * A.UP // 2 - 1] for k in range(1300)]
    assert np.abs(got - want).max() < 1e-5
    assert np.allclose(A.resample(samples, 501, 778), got[501:778])


def test_blocks_don_t_change_features(monkeypatch):
    samples = np.frombuffer(A.padded(text(random.Random(4), 900).encode()), dtype=np.uint8)
    tensor, spans, frames = A.features(samples)
    monkeypatch.setattr(A, "AT_ONCE", 37)
    again = A.features(samples)
    assert frames == again[2] and spans == again[1] and np.allclose(tensor, again[0], atol=1e-4)


def test_spans_follow_loudness():
    quiet, loud = np.full(12_000, 128, np.uint8), (128 + 100 * np.sin(np.arange(12_000))).astype(np.uint8)
    _, spans, _ = A.features(np.concatenate([quiet, loud, quiet]))
    assert len(spans) == 1 and abs(spans[0][0] - 1) < 0.05 and abs(spans[0][1] - 2) < 0.05


def brute_features(samples):
    """Tensor and spans by definition: stuffed convolution, a DFT by its sum, triangles on the mel scale, a state machine."""
    x = np.zeros(len(samples) * A.UP)
    x[:: A.UP] = (samples.astype(float) - 128) / 128
    n = np.arange(-A.TAPS * A.UP // 2, A.TAPS * A.UP // 2)
    h = np.sinc(n / A.DOWN) * np.hanning(A.TAPS * A.UP + 1)[:-1]
    full = np.concatenate([np.convolve(x, (h / h.sum() * A.UP)[::-1]), np.zeros(A.FRAME * A.DOWN * 2)])
    length = -(-len(samples) * A.UP // A.DOWN)
    frames = max(1, math.ceil((length - A.FRAME) / A.HOP) + 1)
    y = full[A.TAPS * A.UP // 2 - 1 :: A.DOWN][: (frames - 1) * A.HOP + A.FRAME]
    rate, mel = A.RATE * A.UP / A.DOWN, lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** (m / 2595) - 1) for m in np.linspace(mel(20), mel(rate / 2), A.MELS + 2)]
    dft = np.exp(-2j * np.pi * np.outer(np.arange(A.FRAME // 2 + 1), np.arange(A.FRAME)) / A.FRAME)
    rows = []
    for k in range(frames):
        power = np.abs(dft @ (y[k * A.HOP : k * A.HOP + A.FRAME] * np.hanning(A.FRAME))) ** 2
        out = []
        for lo, mid, hi in zip(edges, edges[1:], edges[2:]):
            f = np.arange(len(power)) * rate / A.FRAME
            up, down = (f - lo) / (mid - lo), (hi - f) / (hi - mid)
            out.append(math.log(sum(p * max(0.0, min(u, d)) for p, u, d in zip(power, up, down)) + 1e-6))
        rows.append(out)
    rows = np.array(rows)
    tensor = np.array([rows[[k for k in range(frames) if k * A.BINS // frames == b]].mean(axis=0) if any(k * A.BINS // frames == b for k in range(frames)) else np.zeros(A.MELS) for b in range(A.BINS)])
    energy = rows.mean(axis=1)
    mean, deviation, on, spans = energy.mean(), energy.std(), False, []
    for k, e in enumerate(energy):
        if not on and e >= mean + 0.5 * deviation:
            on, begin = True, k
        elif on and e < mean:
            on = False
            spans.append((begin, k))
    if on:
        spans.append((begin, frames))
    spans = spans if deviation > 1e-4 else []  # even energy has no spans
    step = A.HOP * A.DOWN / (A.RATE * A.UP)
    return tensor, [(a * step, b * step) for a, b in spans]


def test_features_equal_brute_force():
    rng = random.Random(6)
    for raw in (b"short", text(rng, 60).encode(), bytes(rng.randrange(118, 138) for _ in range(4000)) + rng.randbytes(4000) + bytes([128]) * 2000 + rng.randbytes(1500)):
        samples = np.frombuffer(A.padded(raw), dtype=np.uint8)
        tensor, spans, _ = A.features(samples)
        want, want_spans = brute_features(samples)
        assert np.abs(tensor - want).max() < 0.02 and np.allclose(np.array(spans), np.array(want_spans))


def test_query(spark):
    rows = [*AWKWARD, (7, text(random.Random(2), 500)), (8, text(random.Random(2), 500))]
    got = A.describe(documents(spark, rows).selectExpr("*", "1 as media"), media=False).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id or 0, r.n_bytes)), sorted(rows, key=lambda r: (r[0] or 0, len((r[1] or "").encode()))), strict=True):
        payload = A.padded((t or "").encode())
        media = A.write_wav(payload)
        assert tuple(r)[:7] == (i, len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())
    by = {}
    for r in got:
        assert by.setdefault(r.payload_sha256, r.feature) == r.feature


def test_tensors(spark):
    rows = A.describe(documents(spark, [(1, "abc"), (2, None)])).toArrow()
    out = A.as_tensors(rows)
    assert out["tensor"].type == pa.fixed_shape_tensor(pa.float32(), (A.BINS, A.MELS), dim_names=("time", "mel"))
    assert out["tensor"].combine_chunks().to_numpy_ndarray().shape == (2, A.BINS, A.MELS) if hasattr(out["tensor"].combine_chunks(), "to_numpy_ndarray") else True
    assert A.describe(documents(spark, [(1, "a")]).where("false")).count() == 0

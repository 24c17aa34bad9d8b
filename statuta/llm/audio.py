"""Media columns: audio features of 8-bit sound, stored as fixed-shape tensors with time spans.

A sound is a WAV file of unsigned 8-bit samples at ``RATE``. Its samples are resampled by ``UP`` / ``DOWN`` with a windowed-sinc
filter in ``UP`` phases, cut into Hann frames of ``FRAME`` samples every ``HOP``, and turned into ``MELS`` log filterbank
energies. A span begins where a frame's energy reaches mean + 0.5 deviations and ends where it falls below the mean
(hysteresis). The tensor holds the mean energies of ``BINS`` equal parts of the time. All steps work on blocks of ``AT_ONCE``
frames, so memory beside the sound itself is bounded.

Defined results: null and empty texts are one payload of 64 zero bytes; equal bytes give equal values, as every sound is
computed by itself; bins without frames hold 0; a sound of even energy, such as one of a single frame, has no span. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_buffer

RATE, UP, DOWN = 12_000, 2, 3
FRAME, HOP, MELS, BINS = 256, 128, 32, 16
TAPS, AT_ONCE, UNIT = 16, 2048, 64


def padded(raw: bytes) -> bytes:
    """raw with zero bytes up to a positive multiple of UNIT."""
    return raw + bytes(UNIT - len(raw) if len(raw) < UNIT else -len(raw) % UNIT)


def write_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file whose 8-bit samples are the payload; its length is even, so no chunk needs a pad byte."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload


def read_wav(media: bytes) -> tuple[int, memoryview]:
    """Rate and samples of an 8-bit mono WAV file."""
    view, at, rate = memoryview(media), 12, 0
    if view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    while at + 8 <= len(view):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", view, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono PCM")
        elif name == b"data":
            return rate, view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _phases() -> np.ndarray:
    """The filter's taps by phase, for a cut-off at the lower of the two Nyquist rates."""
    n = np.arange(-TAPS * UP // 2, TAPS * UP // 2) + 0.0
    taps = np.sinc(n / max(UP, DOWN)) * np.hanning(TAPS * UP + 1)[:-1]
    return (taps / taps.sum() * UP).reshape(TAPS, UP).T.astype(np.float32)


def _filterbank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    rate = RATE * UP / DOWN
    edges = 700 * (10 ** (np.linspace(mel(20), mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FRAME, 1 / rate)[:, None]
    return np.maximum(0, np.minimum((f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1]))).astype(np.float32)


_PHASES, _BANK, _HANN = _phases(), _filterbank(), np.hanning(FRAME).astype(np.float32)


def resample(samples: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Outputs begin to end (not included) of the resampled sound; samples outside it are silence."""
    lo = begin * DOWN // UP - TAPS // 2
    hi = -(-(end - 1) * DOWN // UP) + TAPS // 2 + 1
    x = np.zeros(hi - lo, dtype=np.float32)
    a, b = max(lo, 0), min(hi, len(samples))
    if b > a:
        x[a - lo : b - lo] = (samples[a:b].astype(np.float32) - 128) / 128
    y = np.empty(end - begin, dtype=np.float32)
    for k in range(min(UP, end - begin)):
        n = begin + k
        first, phase, count = -(-n * DOWN // UP) - TAPS // 2 - lo, n * DOWN % UP, len(range(k, end - begin, UP))
        out = np.zeros(count, dtype=np.float32)
        for t in range(TAPS):
            at = first + t
            out += _PHASES[(UP - phase) % UP][t] * x[at : at + (count - 1) * DOWN + 1 : DOWN]
        y[k::UP] = out
    return y


def features(samples: np.ndarray) -> tuple[np.ndarray, list[tuple[float, float]], int]:
    """The BINS x MELS tensor, the spans in seconds, and the number of frames."""
    length = -(-len(samples) * UP // DOWN)
    frames = max(1, -(-(length - FRAME) // HOP) + 1)
    energy, sums, counts = np.empty(frames, dtype=np.float32), np.zeros((BINS, MELS)), np.zeros(BINS)
    for lo in range(0, frames, AT_ONCE):
        hi = min(frames, lo + AT_ONCE)
        y = resample(samples, lo * HOP, (hi - 1) * HOP + FRAME)
        windows = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP] * _HANN
        power = np.abs(np.fft.rfft(windows, axis=1)) ** 2
        mels = np.log(power.astype(np.float32) @ _BANK + np.float32(1e-6))
        energy[lo:hi] = mels.mean(axis=1)
        bins = np.arange(lo, hi) * BINS // frames
        begins = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        sums[bins[begins]] += np.add.reduceat(mels, begins, axis=0)
        counts += np.bincount(bins, minlength=BINS)
    tensor = (sums / np.maximum(counts, 1)[:, None]).astype(np.float32)
    mean, deviation = float(energy.mean()), float(energy.std())
    state = np.where(energy >= mean + 0.5 * deviation, 1, np.where(energy < mean, -1, 0)) if deviation > 1e-4 else np.full(frames, -1)
    known = np.maximum.accumulate(np.where(state != 0, np.arange(frames), -1))
    on = np.concatenate([[False], (known >= 0) & (state[known] == 1), [False]])
    edge = np.flatnonzero(on[1:] != on[:-1])
    step = HOP * DOWN / (RATE * UP)
    return tensor, [(float(a * step), float(b * step)) for a, b in zip(edge[::2], edge[1::2], strict=True)], frames


def _feature(tensor: np.ndarray, spans: list[tuple[float, float]], frames: int) -> str:
    cells = np.round(tensor * 100).astype("<i2").tobytes()
    active = sum(b - a for a, b in spans)
    return f"logmel{BINS}x{MELS};frames={frames};spans={len(spans)};active={active:.2f}s;{hashlib.sha256(cells).hexdigest()[:16]}"


def describe(documents: DataFrame, *, media: bool = True) -> DataFrame:
    """doc_id, n_bytes, payload and media digests, feature, tensor (BINS * MELS floats), span_begins, span_ends; if media also the sound."""
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    schema += ", tensor array<float>, span_begins array<double>, span_ends array<double>" + (", media binary" if media else "")
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    more = ["tensor", "span_begins", "span_ends", *(["media"] if media else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = text_buffer(b.column(1))
            for lo in range(0, b.num_rows, 256):
                made: list[list] = [[] for _ in names[1:] + more]
                for row in range(lo, min(lo + 256, b.num_rows)):
                    sound = write_wav(padded(raw[at[row] : at[row + 1]].tobytes()))
                    _, payload = read_wav(sound)
                    tensor, spans, frames = features(np.frombuffer(payload, dtype=np.uint8))
                    values = [
                        int(at[row + 1] - at[row]), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]),
                        len(sound), hashlib.sha256(sound).hexdigest(), _feature(tensor, spans, frames),
                    ]
                    for column, value in zip(made, [*values, tensor.ravel(), [x[0] for x in spans], [x[1] for x in spans], *([sound] if media else [])], strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float32()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
                yield pa.record_batch([b.column(0).slice(lo, 256), *(pa.array(x, k) for x, k in zip(made, kinds))], names=names + more)

    return documents.select("doc_id", documents["text"].cast("string").alias("text")).mapInArrow(run, schema)


def as_tensors(rows: pa.Table) -> pa.Table:
    """The table with its tensor column as an Arrow fixed-shape tensor of BINS x MELS."""
    kind = pa.fixed_shape_tensor(pa.float32(), (BINS, MELS), dim_names=("time", "mel"))
    flat = rows["tensor"].combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    store = pa.FixedSizeListArray.from_arrays(flat.flatten(), BINS * MELS)
    return rows.set_column(rows.column_names.index("tensor"), "tensor", pa.ExtensionArray.from_storage(kind, store))

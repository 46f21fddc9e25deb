"""Media columns: 8-bit sound, its log-mel patches as fixed-shape tensors with time spans, and its loud segments."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, map_chunks

RATE, UP, DOWN, TAPS = 8000, 5, 8, 16
FRAME, HOP, MELS, PATCH = 256, 128, 32, 32
#: Loudness (dB over the mean of a text's frames) at which a segment begins and below which it ends.
BEGINS, ENDS = 1.0, -1.0
FLOOR = 1e-6


def store(payload: bytes, rate: int = RATE) -> bytes:
    """A WAVE file of 8-bit unsigned samples in one channel."""
    odd = len(payload) % 2
    return b"RIFF" + struct.pack("<I", 36 + len(payload) + odd) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload + b"\0" * odd


def load(media: bytes) -> tuple[int, bytes]:
    """Rate and samples of such a file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        kind, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (code, channels, bits) != (1, 1, 8):
                raise ValueError("not one channel of 8-bit samples")
        elif kind == b"data":
            return rate, media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no samples")


def padded(text: str) -> tuple[bytes, int]:
    """The text's bytes with zeros after them up to a positive multiple of 64, and the length before."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw)), len(raw)


@lru_cache(maxsize=8)
def phases(up: int, down: int, taps: int) -> np.ndarray:
    """A windowed-sinc low-pass at the lower of both rates, split in ``up`` phases of ``taps`` taps."""
    n = up * taps
    t = np.arange(n) - (n - 1) / 2
    edge = 1 / max(up, down)
    h = np.sinc(t * edge) * edge * np.hamming(n)
    return np.ascontiguousarray((up * h / h.sum()).reshape(taps, up).T[:, ::-1], np.float32)


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """Polyphase resampling: output n is one phase's dot product with ``taps`` neighbours; no zeros are stuffed."""
    h = phases(up, down, taps)
    n = -(-len(x) * up // down)
    x = np.concatenate([np.zeros(taps - 1, np.float32), x, np.zeros(down + 1, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(x, taps)
    out = np.empty(n, np.float32)
    for first in range(min(up, n)):
        count = -(-(n - first) // up)
        base, phase = divmod(first * down, up)
        out[first::up] = windows[base : base + (count - 1) * down + 1 : down] @ h[phase]
    return out


@lru_cache(maxsize=8)
def filterbank(rate: float, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    """Overlapping triangles, evenly spaced on the mel scale."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(0.0), mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.fft.rfftfreq(frame, 1 / rate)
    rise = (f[None] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - f[None]) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).T.astype(np.float32)


@lru_cache(maxsize=2)
def window(frame: int) -> np.ndarray:
    return np.hanning(frame + 1)[:-1].astype(np.float32)


def log_mel(x: np.ndarray, rate: float) -> np.ndarray:
    """One row for each frame; frames overlap by half, the last is filled with silence."""
    n = 1 + max(0, -(-(len(x) - FRAME) // HOP))
    x = np.concatenate([x, np.zeros(max(0, (n - 1) * HOP + FRAME - len(x)), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP][:n] * window(FRAME)
    power = np.abs(np.fft.rfft(frames, axis=1)).astype(np.float32) ** 2
    return np.log10(power @ filterbank(rate) + FLOOR)


def segments(mel: np.ndarray, begins: float = BEGINS, ends: float = ENDS) -> list[tuple[int, int]]:
    """First and last frame (exclusive) of the loud segments: hysteresis between two levels around the mean loudness."""
    loud = 10 * np.log10((10.0**mel).sum(1))
    loud = loud - loud.mean()
    state = np.where(loud >= begins, 1, np.where(loud < ends, -1, 0))
    held = np.maximum.accumulate(np.where(state != 0, np.arange(len(state)), -1))
    on = np.concatenate([[False], (held >= 0) & (state[held] == 1), [False]])
    edges = np.flatnonzero(on[1:] != on[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def patches(mel: np.ndarray) -> np.ndarray:
    """Tensors of shape (PATCH, MELS); the last is filled with silence."""
    n = -(-len(mel) // PATCH)
    out = np.full((n * PATCH, mel.shape[1]), np.log10(np.float32(FLOOR)), np.float32)
    out[: len(mel)] = mel
    return out.reshape(n, PATCH, mel.shape[1])


def features(media: bytes) -> tuple[np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """Patches, their spans in ms and the spans of loud segments of a stored file."""
    rate, samples = load(media)
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    new = rate * UP / DOWN
    mel = log_mel(resample(x), new)
    at = lambda frame: round(1000 * HOP * frame / new, 3)
    p = patches(mel)
    return p, [(at(i * PATCH), at(min(len(mel), (i + 1) * PATCH) - 1 + FRAME / HOP)) for i in range(len(p))], [(at(a), at(b - 1 + FRAME / HOP)) for a, b in segments(mel)]


def tensors(values: list, shape: tuple[int, int] = (PATCH, MELS)) -> pa.FixedShapeTensorArray:
    """Patches, as the operator returns them, in an Arrow array of fixed-shape tensors."""
    flat = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate([np.asarray(v, np.float32).ravel() for v in values]) if values else [], pa.float32()), shape[0] * shape[1])
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float32(), shape), flat)


def _rows(text: str, media: bytes, n: int) -> tuple:
    p, spans, loud = features(media)
    return media, [{"start_ms": a, "end_ms": b, "mel": t.ravel()} for (a, b), t in zip(spans, tensors(list(p)).to_numpy_ndarray())], [{"start_ms": a, "end_ms": b} for a, b in loud]


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", project: Callable | None = None, ddl: str = "media binary, patches array<struct<start_ms: double, end_ms: double, mel: array<float>>>, segments array<struct<start_ms: double, end_ms: double>>") -> DataFrame:
    """Each whole text as a sound file, with the log-mel patches and loud segments read back from it.

    ``mel`` is a patch row by row, of PATCH x MELS numbers always: the storage of the document's Arrow
    tensors, whose type Spark's columns don't have; ``tensors`` makes them of it again. ``project(text, media, n_bytes)`` may reduce a document to the columns of ``ddl`` in the
    same pass. A null or empty text is 64 zero bytes. Each text is computed alone, so equal texts have
    equal values; repeated rows are answered once each.
    """
    project = project or _rows

    def make():
        def one(batch):
            rows = []
            for t in batch.column(1).to_pylist():
                payload, n = padded(t)
                rows.append(project(t, store(payload), n))
            return [batch.column(0), *map(list, zip(*rows))]

        return one

    return map_chunks(documents(df, id_col, text_col), make, f"doc_id long, {ddl}", chunk=128)


def digest(text: str, media: bytes, n: int) -> tuple:
    """n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    _, samples = load(media)
    p, spans, loud = features(media)
    p = tensors(list(p)).to_numpy_ndarray()
    line = f"{len(spans)} patches, {len(loud)} segments, {spans[-1][1]:.0f} ms, {hashlib.sha256(np.round(p * 1000).astype('<i4').tobytes() + repr(loud).encode()).hexdigest()}"
    return n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(media), hashlib.sha256(media).hexdigest(), line

"""Media columns: texts stored as WAV samples, and fingerprints of spectral peaks.

The payload is written losslessly as 8-bit mono samples by the ``wave`` module,
read back, and cut into frames; pairs of peaks of the short-time Fourier
transform, with the time between them, are the time-coded fingerprint.  A peak is the
strongest of a band's bins that are no weaker than the bins beside them and louder than
what rounding to 8 bits makes; silence and steady levels have none.  Frames are
centred on the text's samples, with silence beyond both ends, so that two hear even the
shortest text; the padding of the payload isn't part of the sound.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column


@dataclass(frozen=True)
class Spectrum:
    """Frames of ``frame`` samples, one every ``hop``; each peak is paired with one of each of ``fan`` later frames.

    ``level`` is the least magnitude of a peak: rounding to 8 bits makes some
    sqrt(3 / 8 * frame / 12) under a Hann window.  A code has 2 bits for the time and 10 for a bin.
    """

    rate: int = 8000
    frame: int = 576
    hop: int = 144
    bands: int = 4
    fan: int = 2
    level: float = 4.5
    block: int = 4096

    def __post_init__(self):
        if not 1 <= self.fan <= 3 or not 4 <= self.frame <= 2046 or not 1 <= self.hop <= self.frame or not 1 <= self.bands <= self.frame // 4:
            raise ValueError(f"codes have no room for {self}")


MEDIA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_bytes", "payload_bytes")]
    + [T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType())]
    + [T.StructField("fingerprint", T.ArrayType(T.StructType([T.StructField("frame", T.IntegerType()), T.StructField("code", T.IntegerType())])))]
)
WITH_MEDIA = T.StructType([*MEDIA.fields, T.StructField("media", T.BinaryType())])
DIGEST = T.StructType([*MEDIA.fields[:-1], T.StructField("n_pairs", T.LongType()), T.StructField("feature", T.StringType())])


def padded(data: bytes, unit: int = 576) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of ``unit``."""
    return data + b"\xff" * (max(unit, -(-len(data) // unit) * unit) - len(data))


def to_wav(payload: bytes, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as r:
        return r.readframes(r.getnframes())


def peak_bins(samples: np.ndarray, s: Spectrum) -> np.ndarray:
    """For each frame and band the bin of its peak, 0 where it has none, in blocks of frames."""
    n = (len(samples) - s.frame) // s.hop + 1
    window = np.hanning(s.frame).astype(np.float32)
    edges = np.linspace(1, s.frame // 2 + 1, s.bands + 1).astype(int)
    out = np.empty((n, s.bands), np.int32)
    frames = np.lib.stride_tricks.sliding_window_view(samples, s.frame)[:: s.hop]
    for a in range(0, n, s.block):
        # rounding makes equal magnitudes equal whatever block a frame falls in
        part = np.round(np.abs(np.fft.rfft((frames[a : a + s.block].astype(np.float32) - 128) * window, axis=1)), 2)
        above = np.pad(part, ((0, 0), (0, 1)))[:, 1:]
        peak = np.where((part >= s.level) & (part >= above), part, 0)
        peak[:, 1:][part[:, 1:] < part[:, :-1]] = 0
        for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            best = np.argmax(peak[:, lo:hi], axis=1)  # the lowest of several
            out[a : a + s.block, b] = np.where(peak[np.arange(len(peak)), lo + best] > 0, lo + best, 0)
    return out


def fingerprint(samples: np.ndarray, s: Spectrum) -> tuple[np.ndarray, np.ndarray]:
    """Frames and codes of peak pairs: a peak's bin, the bin of one ``dt`` frames later (``dt`` bands up), and ``dt``.

    No samples, no pairs; a sound of a dozen samples may have too flat a spectrum for any.
    """
    if not len(samples):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    silence = s.frame // 2
    peaks = peak_bins(np.pad(samples, (silence, silence + max(s.frame - len(samples), 0)), constant_values=128), s)
    times, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for dt in range(1, min(s.fan, len(peaks) - 1) + 1):
        first, later = peaks[:-dt], np.roll(peaks[dt:], -dt, axis=1)
        frame, band = np.nonzero((first > 0) & (later > 0))
        codes.append((first[frame, band] << 12) | (later[frame, band] << 2) | dt)
        times.append(frame)
    t, c = np.concatenate(times).astype(np.int32), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order], c[order]


def _stored(text: str | None, s: Spectrum) -> tuple[dict, bytes, np.ndarray, np.ndarray]:
    data = (text or "").encode("utf-8", "surrogatepass")
    stored = to_wav(padded(data), s.rate)
    back = from_wav(stored)
    t, c = fingerprint(np.frombuffer(back, np.uint8)[: len(data)], s)
    row = {
        "n_bytes": len(data),
        "payload_bytes": len(back),
        "payload_sha256": hashlib.sha256(back).hexdigest(),
        "tail_crc32": zlib.crc32(back[-32:]),
        "media_bytes": len(stored),
        "media_sha256": hashlib.sha256(stored).hexdigest(),
    }
    return row, stored, t, c


def _run(docs: DataFrame, keep: tuple[str, ...], one, returns: T.StructType) -> DataFrame:
    column = arrow_column(lambda texts: [one(t) for t in texts], returns, F.col("text").cast("string")).alias("m")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("id"), column)
    return packed.select(*(F.col("id")[c].alias(c) for c in keep), "m.*")


def with_media(docs: DataFrame, spectrum: Spectrum = Spectrum(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the WAV file itself (``media``), its digests, and the fingerprint as an array of (frame, code).

    A null text counts as empty and gives one padded unit.  Long texts are transformed
    whole, block by block.  Equal texts give equal
    values; repeated rows give repeated results.  Each row is handled where it is read.
    """

    def one(text):
        row, stored, t, c = _stored(text, spectrum)
        return row | {"media": stored, "fingerprint": [{"frame": a, "code": b} for a, b in zip(t.tolist(), c.tolist(), strict=True)]}

    return _run(docs, keep, one, WITH_MEDIA)


def media_digests(docs: DataFrame, spectrum: Spectrum = Spectrum(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``with_media``, with digests in place of the file and of the fingerprint.

    ``feature`` is the number of peak pairs and the SHA-256 of the (frame, code) pairs
    as little-endian 32-bit integers.
    """

    def one(text):
        row, _, t, c = _stored(text, spectrum)
        pairs = np.stack([t, c], axis=1).astype("<i4").tobytes()
        return row | {"n_pairs": len(t), "feature": f"{len(t)}:{hashlib.sha256(pairs).hexdigest()}"}

    return _run(docs, keep, one, DIGEST)

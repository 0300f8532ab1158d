"""Media columns: WAV bytes, short-time Fourier transforms and spectral-peak pair fingerprints."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_names, slices, written

RATE = 8000
#: The payload is padded to a positive multiple of this many bytes.
PAD = 64
WINDOW, HOP = 256, 128
#: Bands of frequency bins; the strongest bin of each is a peak of its frame if it is louder than its surroundings.
BANDS = ((2, 10), (10, 26), (26, 64), (64, 128))
#: Frames on either side that a peak must exceed on average, frames in which its partners lie, frames at a time.
AROUND, AHEAD, FRAMES = 8, 3, 4096


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file whose 8-bit samples are the payload's bytes."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(rate)
        f.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as f:
        return f.readframes(f.getnframes())


def padded(payload: bytes) -> bytes:
    """The payload with zero bytes up to a positive multiple of 64 bytes."""
    return payload + bytes(max(PAD, -(-len(payload) // PAD) * PAD) - len(payload))


def _frames(samples: np.ndarray) -> np.ndarray:
    """Windows of all samples, one every ``HOP``; zeros fill up the last one, so that every sample lies in a window."""
    n = max(0, -(-(len(samples) - WINDOW) // HOP)) + 1
    padded = np.concatenate([samples, np.zeros((n - 1) * HOP + WINDOW - len(samples), samples.dtype)])
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::HOP]


def _peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames, bands): the strongest bin and its log power, for all frames; a few thousand frames at a time."""
    frames = _frames(samples)
    taper = np.hanning(WINDOW).astype(np.float32)
    bins, loud = [], []
    for i in range(0, len(frames), FRAMES):
        power = np.log1p(np.abs(np.fft.rfft(frames[i : i + FRAMES] * taper, axis=1)) ** 2)
        top = np.stack([a + power[:, a:b].argmax(axis=1) for a, b in BANDS], axis=1)
        bins.append(top)
        loud.append(np.take_along_axis(power, top, axis=1))
    return np.concatenate(bins), np.concatenate(loud)


def fingerprint(samples: bytes) -> np.ndarray:
    """Spectral-peak pairs of 8-bit samples, in time order.

    A pair joins a peak with the peaks of the next frames; its code is time << 32 | first bin << 20 | second bin << 8
    | frames between.
    """
    wave_form = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    bins, loud = _peaks(wave_form)
    n = len(bins)
    total = np.vstack([np.zeros((1, loud.shape[1])), np.cumsum(loud, axis=0, dtype=np.float64)])
    low, high = np.maximum(np.arange(n) - AROUND, 0), np.minimum(np.arange(n) + AROUND + 1, n)
    clear = loud >= (total[high] - total[low]) / (high - low)[:, None]
    out = []
    for apart in range(1, min(AHEAD, n - 1) + 1):
        for a in range(len(BANDS)):
            b = (a + apart) % len(BANDS)
            t = np.flatnonzero(clear[:-apart, a] & clear[apart:, b]).astype(np.int64)
            out.append(t << 32 | bins[t, a].astype(np.int64) << 20 | bins[t + apart, b].astype(np.int64) << 8 | apart)
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table (id, n_bytes, media binary): each whole text's UTF-8 bytes, padded, as a WAV file.

    Null texts are empty. Repeated rows are stored each; ids may repeat or be null, other columns don't matter, and an
    empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("payload"))

    def run(batches):
        for batch in slices(batches, 500):
            payloads = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(p) for p in payloads], pa.int64()), pa.array([to_wav(padded(p)) for p in payloads], pa.binary())], ["id", "n_bytes", "media"])

    return written(rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, media binary"), "media", compression="zstd")


_OWN = ["payload_bytes", "payload_sha256", "tail_crc32", "prints"]


def analyse(media: DataFrame, keep: list[str], media_col: str = "media") -> DataFrame:
    """The columns ``keep`` and what is read from each WAV file: payload_bytes, payload_sha256, tail_crc32, prints.

    ``prints`` is the array of time-coded peak pairs. Null media give nulls and no prints; a kept column with one of
    these names comes out with ``kept_`` before it; an empty table gives an empty table.
    """
    rows = media.select(*[F.col(c) for c in keep], F.col(media_col).alias("_media"))
    names = kept_names(keep, _OWN)
    types = "".join(f"`{n}` {f.dataType.simpleString()}, " for n, f in zip(names, rows.schema[: len(keep)]))

    def run(batches):
        for batch in slices(batches, 500):
            read = [None if m is None else from_wav(m) for m in batch.column(len(keep)).to_pylist()]
            prints = [[] if p is None else fingerprint(p) for p in read]
            ends = np.cumsum([0, *map(len, prints)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *prints]).astype(np.int64)
            of = lambda f, kind: pa.array([None if p is None else f(p) for p in read], kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), of(len, pa.int64()), of(lambda p: hashlib.sha256(p).hexdigest(), pa.string()), of(lambda p: zlib.crc32(p[-PAD:]), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                [*names, *_OWN],
            )

    return rows.mapInArrow(run, f"{types}payload_bytes long, payload_sha256 string, tail_crc32 long, prints array<long>")

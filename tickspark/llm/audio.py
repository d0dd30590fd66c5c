"""Media columns: documents as 8-bit audio, and log-mel features of what is stored.

``store_audio`` turns a text into a WAV file (8-bit mono samples, losslessly the UTF-8 bytes, zero
padded to a positive multiple of 64). ``audio_features`` reads stored files back and computes, by
polyphase resampling, overlapped log-mel filterbanks and hysteresis on frame energy, the windows and
the active segments. The windows of a file are stored as Arrow, one IPC stream a file in a binary
column: time spans beside a column of fixed-shape tensors (WINDOW_FRAMES x MELS floats), which
``read_windows`` gives back; ``windows_sha256`` is of what it gives back, tensors and then spans. Work is done a bounded number of samples at a time; what a
file's features take grows with the file.

Defined results: a null or empty text is the empty text (64 zero samples); a very long one is one file, with as
many windows as it needs; a null file, one that is no WAV, and one in any other form than 8-bit mono PCM
of RATE samples a second give nulls; repeated rows give equal rows; an empty table gives no rows;
other columns are ignored, whatever their names. Frames as loud as a bound enter at ENTER_DB and
stay at LEAVE_DB.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
RATE = 16_000
UP, DOWN = 3, 5  # to 9600 samples a second
TAPS = 28  # of each phase
FRAME, HOP, FFT, MELS = 240, 96, 256, 32
WINDOW_FRAMES = 32  # frames in one fixed-shape tensor
ENTER_DB, LEAVE_DB = 3.0, -3.0  # hysteresis around the mean energy of a file
DECIMALS = 3
_FRAMES_AT_ONCE = 4096

FEATURES = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, n_frames long, "
    "n_windows long, windows_sha256 string, windows binary, "
    "segments array<struct<start_ms:double,end_ms:double>>"
)


def _le32(n: Column) -> Column:
    """Four little-endian bytes of a column, as hex."""
    h = F.lpad(F.hex(n.cast("long")), 8, "0")
    return F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))


def payload_column(text: Column) -> Column:
    """UTF-8 bytes of a text with zeros up to a positive multiple of 64."""
    data = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    n = F.octet_length(data)
    short = F.when(n == 0, F.lit(BLOCK)).otherwise(F.pmod(-n, F.lit(BLOCK)))
    return F.concat(data, F.unhex(F.repeat(F.lit("00"), short)))


def store_audio(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE) -> DataFrame:
    """(id, n_bytes, media): the WAV file of each text, built by Spark's own functions."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.octet_length(F.encode(text, "UTF-8")).cast("long").alias("n_bytes"), payload_column(text).alias("p"))
    n = F.octet_length("p")
    head = F.concat(
        F.lit("52494646"), _le32(n + 36), F.lit("57415645666D7420"), F.lit(struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8).hex().upper()),
        F.lit("64617461"), _le32(n),
    )
    return rows.select(id_col, "n_bytes", F.concat(F.unhex(head), F.col("p")).alias("media"))


def wav_samples(media: bytes | None) -> memoryview | None:
    """The samples of a stored file in the form that ``store_audio`` writes; nothing for other forms."""
    if media is None or len(media) < 12 or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, known = 12, False
    while at + 8 <= len(media):
        kind, n = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if kind == b"fmt ":
            if n < 16 or at + 24 > len(media):
                return None
            form, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            known = (form, channels, rate, bits) == (1, 1, RATE, 8)
        elif kind == b"data":
            return memoryview(media)[at + 8 : at + 8 + n] if known and at + 8 + n <= len(media) else None
        at += 8 + n + n % 2
    return None


@lru_cache
def _lowpass() -> np.ndarray:
    """Windowed-sinc filter of UP * TAPS values, one row for each phase, in the order of the samples it meets."""
    half, wide = UP * TAPS // 2, max(UP, DOWN)
    t = np.arange(-half, half)
    taps = np.sinc(t / wide) * np.hanning(2 * half) * UP / wide
    return np.ascontiguousarray(taps.reshape(-1, UP).T[:, ::-1])


@lru_cache
def _mel() -> np.ndarray:
    rate = RATE * UP / DOWN
    to_mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(to_mel(20.0), to_mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * rate / FFT
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.ascontiguousarray(np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid))).T)


def resample(x: np.ndarray) -> np.ndarray:
    """Polyphase resampling by UP / DOWN: each output sample uses the taps of its own phase only."""
    taps = _lowpass()
    n = -(-len(x) * UP // DOWN)
    rounds = -(-n // UP)  # after UP outputs and DOWN inputs the phases come again
    padded = np.concatenate([np.zeros(TAPS // 2 - 1), x, np.zeros(TAPS + DOWN)])
    frames = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    out = np.empty((rounds, UP))
    for k in range(UP):
        out[:, k] = frames[k * DOWN // UP :: DOWN][:rounds] @ taps[k * DOWN % UP]
    return out.reshape(-1)[:n]


def log_mel(samples: memoryview) -> tuple[np.ndarray, np.ndarray]:
    """(frames x MELS log-mel, frame energy in dB), computed in pieces of bounded size.

    In double precision, then rounded to DECIMALS, so that equal files have equal features wherever they are computed."""
    raw = np.frombuffer(samples, np.uint8)
    n_out = -(-len(raw) * UP // DOWN)
    n_frames = max(1, -(-max(0, n_out - FRAME) // HOP) + 1)
    hann, mel = np.hanning(FRAME), _mel()
    out, energy = np.empty((n_frames, MELS), np.float32), np.empty(n_frames)
    margin = 32 * DOWN
    for f0 in range(0, n_frames, _FRAMES_AT_ONCE):
        f1 = min(n_frames, f0 + _FRAMES_AT_ONCE)
        lo, hi = f0 * HOP * DOWN // UP, ((f1 - 1) * HOP + FRAME) * DOWN // UP
        a, b = max(0, lo - margin), min(len(raw), hi + margin)
        y = resample((raw[a:b].astype(np.float64) - 128) / 128)[(lo - a) * UP // DOWN :]
        need = (f1 - f0 - 1) * HOP + FRAME
        y = np.pad(y[:need], (0, max(0, need - len(y))))
        frames = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP] * hann
        spectrum = np.fft.rfft(frames, FFT)
        power = spectrum.real**2 + spectrum.imag**2
        out[f0:f1] = np.round(np.log10(power @ mel + 1e-6), DECIMALS)
        energy[f0:f1] = np.round(10 * np.log10(power.mean(1) + 1e-9), DECIMALS)
    return out, energy


def active_segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame runs that begin at ENTER_DB over the mean and end under LEAVE_DB."""
    rel = energy - energy.mean()
    mark = np.where(rel >= ENTER_DB, 1, np.where(rel < LEAVE_DB, -1, 0))
    at = np.flatnonzero(mark)
    on = np.zeros(len(mark), bool)
    if len(at):
        last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
        on = (last >= 0) & (mark[last] > 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


#: Of the windows of a file.
WINDOWS = pa.schema([("start_ms", pa.float64()), ("end_ms", pa.float64()), ("logmel", pa.fixed_shape_tensor(pa.float32(), (WINDOW_FRAMES, MELS)))])


def write_windows(start_ms: np.ndarray, end_ms: np.ndarray, logmel: np.ndarray) -> bytes:
    """Windows (n x WINDOW_FRAMES x MELS) with their time spans as an Arrow IPC stream."""
    tensors = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(logmel, dtype=np.float32))
    batch = pa.RecordBatch.from_arrays([pa.array(start_ms), pa.array(end_ms), tensors], schema=WINDOWS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, WINDOWS) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_windows(data: bytes) -> pa.RecordBatch:
    """(start_ms, end_ms, logmel): windows as they were stored."""
    with pa.ipc.open_stream(data) as reader:
        return reader.read_next_batch()


def _digest(stored: bytes) -> str:
    """Hash of windows as they are read back: the tensors, then where they start and end."""
    batch = read_windows(stored)
    h = hashlib.sha256(batch.column("logmel").to_numpy_ndarray())
    for span in ("start_ms", "end_ms"):
        h.update(batch.column(span).to_numpy())
    return h.hexdigest()


def _features(batches: Iterator[pa.RecordBatch], id_col: str, id_type: pa.DataType, keep_windows: bool) -> Iterator[pa.RecordBatch]:
    ms = HOP * 1000.0 * DOWN / UP / RATE
    names = [id_col, "payload_bytes", "payload_sha256", "tail_crc32", "n_frames", "n_windows", "windows_sha256", "windows", "segments"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start_ms", pa.float64()), ("end_ms", pa.float64())]))]
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            rows: list[list] = []
            for media in batch.column(1):
                samples = wav_samples(media.as_py())
                if samples is None:
                    rows.append([None] * len(types))
                    continue
                mel, energy = log_mel(samples)
                n = -(-len(mel) // WINDOW_FRAMES)
                padded = np.full((n * WINDOW_FRAMES, MELS), np.float32(-6), np.float32)
                padded[: len(mel)] = mel
                start = np.arange(n) * WINDOW_FRAMES * ms
                windows = write_windows(start, start + WINDOW_FRAMES * ms, padded.reshape(n, WINDOW_FRAMES, MELS))
                segments = [{"start_ms": a * ms, "end_ms": b * ms} for a, b in active_segments(energy)]
                rows.append([len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]), len(mel), n, _digest(windows), windows if keep_windows else None, segments])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)


def audio_features(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media", keep_windows: bool = True) -> DataFrame:
    """One row per file: digests of the samples read back, stored log-mel windows with time spans and their hash, segments.

    Without ``keep_windows`` they are null: stored, read back and hashed in the task, and not sent on."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = media.schema[id_col].dataType
    arrow = to_arrow_type(kind)
    return media.select(id_col, media_col).mapInArrow(lambda b: _features(b, id_col, arrow, keep_windows), f"`{id_col}` {kind.simpleString()}, {FEATURES}")


def feature_digest(features: DataFrame) -> DataFrame:
    """Adds ``feature``: frames, windows, segments, active ms, and hashes of the stored tensors with their spans and of the segments."""
    active = F.aggregate("segments", F.lit(0.0), lambda s, x: s + x["end_ms"] - x["start_ms"])
    tensors, segments = F.substring("windows_sha256", 1, 16), F.lower(F.hex(F.xxhash64("segments")))
    parts = [F.col("n_frames").cast("string"), F.col("n_windows").cast("string"), F.size("segments").cast("string"), F.format_string("%.1f", active), tensors, segments]
    return features.withColumn("feature", F.when(F.col("windows_sha256").isNotNull(), F.concat_ws(":", *parts)))

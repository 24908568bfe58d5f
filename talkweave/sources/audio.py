"""Audio: WAV source and sink, level and cleaning maps over whole waveforms, chunk slices.

A waveform is a numpy array of samples in -1 to 1; in tables it is a binary of 32-bit floats. Python runs here because
signal processing has no column form; a file is one row and never leaves its task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from . import wav

EPS = 1e-8


def decode_wav(data: bytes, name: str = "file") -> tuple[np.ndarray, int]:
    """(channels x samples, rate) of a WAV file, in the encodings that ``wav.header`` knows."""
    h = wav.header(lambda at, n: data[at : at + n], len(data), name)
    return h.decoded(data[h.data_at : h.data_at + h.frames * h.frame_bytes]).T, h.rate


def encode_wav(x: np.ndarray, rate: int, as_float: bool = False) -> bytes:
    """One channel, 16-bit integers or 32-bit floats."""
    return wav.written_header(len(x), rate, as_float) + wav.written_body(x, as_float)


def downmix(x: np.ndarray) -> np.ndarray:
    return x if x.ndim == 1 else x.mean(axis=0)


def resample(x: np.ndarray, rate: int, target: int, width: int = 6, rolloff: float = 0.99) -> np.ndarray:
    """Windowed-sinc interpolation: one short filter per phase of the rates' ratio."""
    if rate == target or not len(x):
        return x
    g = math.gcd(rate, target)
    old, new = rate // g, target // g
    base = min(old, new) * rolloff
    reach = math.ceil(width * old / base)
    taps = np.arange(-reach, reach + old) / old
    t = np.clip((taps[None, :] - np.arange(new)[:, None] / new) * base, -width, width)
    kernel = np.sinc(t) * np.cos(t * np.pi / width / 2) ** 2 * base / old
    padded = np.pad(x, (reach, reach + old))
    frames = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape[1])[::old]
    return (frames @ kernel.T).reshape(-1)[: math.ceil(new * len(x) / old)]


def peak(x: np.ndarray) -> float:
    return float(np.max(np.abs(x), initial=0.0))


def rms(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(x)) + EPS)) if len(x) else math.sqrt(EPS)


def dbfs(level: float) -> float:
    return 20.0 * math.log10(max(level, EPS))


def normalise_peak(x: np.ndarray, to: float = 0.95) -> np.ndarray:
    return x / peak(x) * to if peak(x) > 0 else x


def highpass(x: np.ndarray, rate: int, cutoff: float, q: float = 0.707) -> np.ndarray:
    """A second-order high-pass section, as a convolution with its impulse response until that has died away."""
    if cutoff <= 0 or not len(x):
        return x
    w = 2 * math.pi * cutoff / rate
    alpha, cos = math.sin(w) / (2 * q), math.cos(w)
    b, a = np.array([(1 + cos) / 2, -1 - cos, (1 + cos) / 2]) / (1 + alpha), np.array([-2 * cos, 1 - alpha]) / (1 + alpha)
    n = min(len(x), int(math.log(1e-12) / math.log(math.sqrt(a[1]))) + 3)
    h = np.zeros(n)
    for i in range(n):
        h[i] = (b[i] if i < 3 else 0.0) - (a[0] * h[i - 1] if i > 0 else 0.0) - (a[1] * h[i - 2] if i > 1 else 0.0)
    size = 1 << (len(x) + n - 1).bit_length()
    return np.clip(np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[: len(x)], -1.0, 1.0)


def denoise(x: np.ndarray, strength: float, quantile: float, n_fft: int = 512, hop: int = 128) -> np.ndarray:
    """Takes each frequency's noise floor (a quantile over time) off its magnitudes; phases stay."""
    if strength <= 0 or len(x) <= n_fft // 2:
        return x
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    padded = np.pad(x, n_fft // 2, mode="reflect")
    spectrum = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop] * window)
    size = np.abs(spectrum)
    floor = np.quantile(size, min(max(quantile, 0.01), 0.5), axis=0, keepdims=True)
    frames = np.fft.irfft(np.maximum(size - strength * floor, 0.0) * spectrum / (size + EPS), n_fft) * window
    out, weight = np.zeros(hop * (len(frames) - 1) + n_fft), np.zeros(hop * (len(frames) - 1) + n_fft)
    for i, f in enumerate(frames):
        out[i * hop : i * hop + n_fft] += f
        weight[i * hop : i * hop + n_fft] += window**2
    out = (out / np.where(weight > 1e-11, weight, 1.0))[n_fft // 2 :][: len(x)]
    return np.pad(out, (0, len(x) - len(out)))


@dataclass(frozen=True)
class Enhancement:
    denoise_strength: float = 1.0
    noise_quantile: float = 0.15
    highpass_hz: int = 60
    target_rms_dbfs: float = -22.0
    target_peak_dbfs: float = -1.0


def enhance(x: np.ndarray, rate: int, s: Enhancement = Enhancement()) -> np.ndarray:
    """Offset, rumble and noise out; loudness to its target, peaks under theirs."""
    x = highpass(x - x.mean(), rate, s.highpass_hz) if len(x) else x
    x = denoise(x, s.denoise_strength, s.noise_quantile)
    if rms(x) > EPS:
        x = x * (10 ** (s.target_rms_dbfs / 20) / rms(x))
    most = 10 ** (s.target_peak_dbfs / 20)
    if peak(x) > most:
        x = x * (most / (peak(x) + EPS))
    return np.clip(x, -0.999, 0.999)


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """(``path``, ``content``): files as they are. A missing path fails."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


NORMALISED = "path string, wav binary, sample_rate bigint, duration_sec double, channels bigint, format string"


#: Bytes of WAV files that a batch of results holds, unless one alone has more.
BATCH = 1 << 20


def _framed(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    """Rows (whose second value is a WAV file) as batches of some bytes."""
    columns, held, size = [c.split()[0] for c in schema.split(", ")], [], 0
    for row in rows:
        if held and size + len(row[1]) > BATCH:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
        held.append(row)
        size += len(row[1])
    if held:
        yield pd.DataFrame(held, columns=columns)


def normalising(target_rate: int = 16000) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task of ``normalised``. Tasks one after the other in one Python worker hold one file, and move none through the JVM."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):
                x, rate = decode_wav(data, path)
                x = normalise_peak(resample(downmix(x), rate, target_rate))
                yield path, encode_wav(x, target_rate), target_rate, len(x) / target_rate, 1, "wav"

    return lambda batches: _framed(rows(batches), NORMALISED)


def normalised(files: DataFrame, target_rate: int = 16000) -> DataFrame:
    """One channel, the target rate, peak at 0.95, as 16-bit WAV."""
    return files.mapInPandas(normalising(target_rate), NORMALISED)


ENHANCED = "path string, wav binary, sample_rate bigint, duration_sec double, denoise_strength double, noise_quantile double, highpass_hz bigint, target_rms_dbfs double, target_peak_dbfs double, input_rms_dbfs double, output_rms_dbfs double, input_peak_dbfs double, output_peak_dbfs double, cache_hit boolean"


def enhancing(expected_rate: int = 16000, settings: Enhancement = Enhancement(), enabled: bool = True) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task of ``enhanced``, which may follow ``normalising`` in the same worker."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b["path"], b["wav"], strict=True):
                x, rate = decode_wav(data, path)
                if rate != expected_rate:
                    raise ValueError(f"{path}: {rate} Hz where {expected_rate} Hz is expected")
                x = downmix(x)
                y = enhance(x, rate, settings) if enabled else x
                yield (path, encode_wav(y, rate, True) if enabled else data, rate, len(y) / rate, settings.denoise_strength, settings.noise_quantile, settings.highpass_hz, settings.target_rms_dbfs, settings.target_peak_dbfs, dbfs(rms(x)), dbfs(rms(y)), dbfs(peak(x)), dbfs(peak(y)), not enabled)

    return lambda batches: _framed(rows(batches), ENHANCED)


def enhanced(files: DataFrame, expected_rate: int = 16000, settings: Enhancement = Enhancement(), enabled: bool = True) -> DataFrame:
    """``files`` are (``path``, ``wav``). Another rate than expected is an error; disabled, the audio passes as it is."""
    return files.select("path", "wav").mapInPandas(enhancing(expected_rate, settings, enabled), ENHANCED)


SLICED = "call_id bigint, idx bigint, chunk_path string, wav binary"


def sliced(calls: DataFrame, chunks: DataFrame) -> DataFrame:
    """The WAV of each chunk: ``calls`` are (``call_id``, ``wav``), ``chunks`` a manifest with frames."""
    from pyspark.sql import functions as F

    per_call = chunks.groupBy("call_id").agg(F.collect_list(F.struct("idx", "start_frame", "end_frame", "chunk_path")).alias("cuts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for call, data, cuts in zip(b["call_id"], b["wav"], b["cuts"], strict=True):
                x, rate = decode_wav(data)
                x = downmix(x)
                out += [(call, c["idx"], c["chunk_path"], encode_wav(x[c["start_frame"] : c["end_frame"]], rate, True)) for c in cuts]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SLICED.split(", ")])

    return calls.select("call_id", "wav").join(per_call, "call_id").mapInPandas(run, SLICED)


def diarized(files: DataFrame, diarizer) -> DataFrame:
    """Segments of each file (``call_id``, ``path``), in time order, from a ``Diarizer``; empty ones go."""
    schema = "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for call, path in zip(b["call_id"], b["path"], strict=True):
                turns = sorted(((s, e, who) for s, e, who in diarizer.diarize(path) if e > s), key=lambda t: t[:2])
                out += [(call, i, i, who, float(s), float(e)) for i, (s, e, who) in enumerate(turns)]
            yield pd.DataFrame(out, columns=["call_id", "ordinal", "idx", "speaker", "start", "end"])

    return files.select("call_id", "path").mapInPandas(run, schema)

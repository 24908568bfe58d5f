"""The WAV data source: encodings, ranges, the sink's commit and its failures."""

import math
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.plans import queries
from talkweave.sources import audio, wav

RNG = np.random.default_rng(4)
X = RNG.uniform(-1, 1, (1000, 2)) * 0.9
ENCODINGS = {"u8": (1, 8), "s16": (1, 16), "s24": (1, 24), "s32": (1, 32), "f32": (3, 32), "f64": (3, 64)}


def body_of(x, kind, bits):
    if kind == 3:
        return x.astype(f"<f{bits // 8}").tobytes()
    if bits == 8:
        return (np.round(x * 127) + 128).astype(np.uint8).tobytes()
    n = np.round(x * ((1 << (bits - 1)) - 1)).astype(np.int64)
    return n.astype("<i4").tobytes() if bits == 32 else b"".join(int(v).to_bytes(bits // 8, "little", signed=True) for v in n.ravel())


def file_of(x, kind, bits, rate=8000, extensible=False, before=b"", magic=b"RIFF", claimed=None):
    body, channels = body_of(x, kind, bits), x.shape[1]
    width = channels * bits // 8
    form = struct.pack("<HHIIHH", 0xFFFE if extensible else kind, channels, rate, rate * width, width, bits)
    if extensible:
        form += struct.pack("<HHI", 22, bits, 3) + struct.pack("<H", kind) + bytes.fromhex("000000001000800000aa00389b71")
    parts = before + b"fmt " + struct.pack("<I", len(form)) + form + b"LIST" + struct.pack("<I", 3) + b"abc\0"
    return magic + struct.pack("<I", 4) + b"WAVE" + parts + b"data" + struct.pack("<I", len(body) if claimed is None else claimed) + body


def gathered(df):
    out = {}
    for r in df.orderBy("path", "first_frame").collect():
        x = np.frombuffer(r.samples, "<f4").reshape(-1, r.channels)
        done = out.setdefault(os.path.basename(r.path), [r.sample_rate, r.frames, []])
        assert r.first_frame == sum(map(len, done[2]))
        done[2].append(x)
    return {k: (rate, n, np.concatenate(x)) for k, (rate, n, x) in out.items()}


def test_encodings_and_ranges(spark, tmp_path):
    """Six encodings, plain and extensible, and RF64, read whole and in ranges that cut frames and the header."""
    for name, (kind, bits) in ENCODINGS.items():
        (tmp_path / f"{name}.wav").write_bytes(file_of(X, kind, bits))
        (tmp_path / f"{name}-x.WAV").write_bytes(file_of(X, kind, bits, extensible=True))
    (tmp_path / "long.wav").write_bytes(file_of(X, 1, 16, magic=b"RF64", claimed=0xFFFFFFFF, before=b"ds64" + struct.pack("<IQQQI", 28, 0, X.size * 2, len(X), 0)))
    (tmp_path / "cut.wav").write_bytes(file_of(X, 1, 16)[:-1001])
    (tmp_path / "empty.wav").write_bytes(file_of(X[:0], 1, 16))
    for options in ({}, {"splitBytes": 97, "blockFrames": 7}, {"splitBytes": 1001, "blockFrames": 1 << 16}):
        found = gathered(wav.blocks(spark, str(tmp_path), **options))
        assert len(found) == 14 and "empty.wav" not in found
        for name, (rate, n, x) in found.items():
            assert rate == 8000 and n == len(x) == (749 if name == "cut.wav" else 1000)
            assert np.abs(x - X[:n]).max() < (0.02 if "u8" in name else 1e-4), name
    one = wav.blocks(spark, f"file://{tmp_path}/s16.wav", splitBytes=500)
    assert one.select(F.sum(F.length("samples"))).first()[0] == 8 * 1000
    whole, rate = audio.decode_wav((tmp_path / "f64-x.WAV").read_bytes())
    assert rate == 8000 and np.allclose(whole, X.T)


@pytest.mark.parametrize("data, says", [
    (b"no", "no WAV file"), (file_of(X, 1, 16).replace(b"data", b"dada"), "no samples"), (file_of(X, 3, 64)[:20] + struct.pack("<H", 2) + file_of(X, 3, 64)[22:], "format 2 with 64 bits"),
    (b"RIFF\0\0\0\0WAVEdata\0\0\0\0", "samples come before"), (b"RIFF\0\0\0\0WAVEfmt \x04\0\0\0abcd", "the format part is too short"),
])
def test_what_is_not_read(spark, tmp_path, data, says):
    (tmp_path / "odd.wav").write_bytes(data)
    with pytest.raises(Exception, match=f"odd.wav: {says}"):
        wav.blocks(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match=says):
        audio.decode_wav(data)


ROWS = "name string, sample_rate int, frames bigint, first_frame bigint, samples binary"


def rows_of(spark, files, size=300):
    f = lambda x: np.asarray(x, "<f4").tobytes()
    return spark.createDataFrame([(n, 8000, len(x), at, f(x[at : at + size])) for n, x in files.items() for at in range(0, max(len(x), 1), size)][::-1], ROWS)


def test_sink(spark, tmp_path):
    files = {"a.wav": X[:, 0], "b.wav": X[:500, 1], "sub/c.wav": X[:1, 0], "none.wav": X[:0, 0]}
    for encoding, within in (("pcm16", 2e-5), ("float32", 1e-7)):
        folder = tmp_path / encoding
        for _ in range(2):  # files of the same names are replaced
            wav.to_files(rows_of(spark, files), f"file://{folder}", encoding)
        for name, x in files.items():
            y, rate = audio.decode_wav((folder / name).read_bytes())
            assert rate == 8000 and y.shape == (1, len(x)) and (not len(x) or np.abs(y[0] - x).max() < within)
        assert sorted(p.name for p in folder.iterdir()) == ["a.wav", "b.wav", "none.wav", "sub"]
    wav.to_files(rows_of(spark, {}), str(tmp_path / "nothing"))
    with pytest.raises(Exception, match="neither pcm16 nor float32"):
        wav.to_files(rows_of(spark, files), str(tmp_path / "mp3"), "mp3")


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    good, folder = rows_of(spark, {f"{i}.wav": X[:, 0] for i in range(6)}), tmp_path / "out"
    for broken in (good.filter("name <> '3.wav' or first_frame <> 300"), good.withColumn("samples", F.when(F.col("name") == "3.wav", F.substring("samples", 1, 40)).otherwise(F.col("samples"))), good.filter("name <> '3.wav' or first_frame < 900")):
        with pytest.raises(Exception, match="3.wav: "):
            wav.to_files(broken, str(folder))
        assert not any(folder.rglob("*")), list(folder.rglob("*"))


def test_stages_write_files(spark, tmp_path):
    """Normalised and enhanced recordings as files whose paths the rows carry."""
    tone = 0.3 * np.sin(2 * np.pi * 440 * np.arange(8000) / 8000)
    for folder in ("x", "y"):  # equal names in two folders stay apart
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "call.wav").write_bytes(audio.encode_wav(tone * (1 if folder == "x" else 0.5), 8000))
    read = audio.read_audio(spark, f"{tmp_path}/[xy]/*.wav")
    normal = wav.saved(audio.normalised(read), str(tmp_path / "normal"))
    rows = normal.collect()
    assert len({r.output_path for r in rows}) == 2 and "wav" not in normal.columns
    for r in rows:
        x, rate = audio.decode_wav(open(r.output_path, "rb").read())
        assert rate == 16000 and math.isclose(audio.peak(x), 0.95, abs_tol=1e-3) and r.duration_sec == 1.0
    again = audio.read_audio(spark, str(tmp_path / "normal")).withColumnRenamed("content", "wav")
    clean = wav.saved(audio.enhanced(again), str(tmp_path / "clean"), "float32")
    assert all(math.isclose(audio.dbfs(audio.rms(audio.decode_wav(open(r.output_path, "rb").read())[0])), r.output_rms_dbfs, abs_tol=1e-3) for r in clean.collect()) and clean.count() == 2


def test_audio_tasks_share_a_worker(spark, sf):
    files = queries._waves(spark, sf, "path string, content binary").limit(20)
    apart = audio.enhanced(audio.normalised(files).select("path", "wav")).orderBy("path").collect()
    one = lambda b: audio.enhancing()(audio.normalising()(b))
    assert files.mapInPandas(one, audio.ENHANCED).orderBy("path").collect() == apart and len(apart) == 20
    plan = queries.audio_enhance(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1

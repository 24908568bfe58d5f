"""WAV files as a Spark data source, ``wav``: recordings read in byte ranges and written task by task.

Reading: ``spark.read.format("wav").load(folder)`` has one row per block of at most ``blockFrames`` frames: ``path``,
``sample_rate``, ``channels``, ``frames`` (of the file), ``first_frame``, ``samples`` (32-bit floats, frame by frame).
Files are split by length alone, into ranges of ``splitBytes``; a task reads a file's header and the frames that start
in its range, so neither the driver nor a task holds a recording. 8- to 32-bit integers and 32- and 64-bit floats are read,
plain, extensible or RF64; any other encoding, or a file without the parts it needs, is an error that names the file.

Writing: rows of ``name``, ``sample_rate``, ``frames`` (of the whole file), ``first_frame`` and ``samples`` (one
channel), a file's rows in one task and in order, as ``to_files`` arranges. ``encoding`` is ``pcm16`` or ``float32``. A task
writes into a folder of its own; the commit of the job moves the files to their places, and a job that fails leaves
nothing. Paths are those of the file systems that Arrow knows.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

BLOCKS = "path string, sample_rate int, channels int, frames bigint, first_frame bigint, samples binary"
#: The formats' numbers. An extensible header has the true one at the start of its sub-format.
INTEGER, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
SPLIT_BYTES, BLOCK_FRAMES = 32 << 20, 1 << 16


@dataclass(frozen=True)
class Header:
    """Where a file's samples are and how they are written."""

    kind: int
    channels: int
    rate: int
    bits: int
    data_at: int
    frames: int

    @property
    def frame_bytes(self) -> int:
        return self.channels * self.bits // 8

    def decoded(self, body: bytes) -> np.ndarray:
        """(frames x channels) in -1 to 1."""
        if self.kind == FLOAT:
            x = np.frombuffer(body, f"<f{self.bits // 8}").astype(np.float64)
        elif self.bits == 8:
            x = (np.frombuffer(body, np.uint8).astype(np.float64) - 128) / 128
        elif self.bits == 24:
            b = np.frombuffer(body, np.uint8).reshape(-1, 3).astype(np.int32)
            x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
        else:
            x = np.frombuffer(body, f"<i{self.bits // 8}").astype(np.float64) / float(1 << (self.bits - 1))
        return x.reshape(-1, self.channels)


def header(read: Callable[[int, int], bytes], size: int, name: str = "file") -> Header:
    """The header of a file of ``size`` bytes; ``read(at, n)`` gives a few of them. A data part that claims more than
    there is, as recorders that were cut off leave it, ends with the file."""
    start = read(0, 12)
    if len(start) < 12 or start[:4] not in (b"RIFF", b"RF64") or start[8:] != b"WAVE":
        raise ValueError(f"{name}: no WAV file")
    at, form, long_size = 12, None, None
    while at + 8 <= size:
        part, n = struct.unpack("<4sI", read(at, 8))
        if part == b"ds64":
            long_size = struct.unpack("<Q", read(at + 16, 8))[0]
        elif part == b"fmt ":
            body = read(at + 8, min(n, 40))
            if len(body) < 16:
                raise ValueError(f"{name}: the format part is too short")
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            form = (struct.unpack("<H", body[24:26])[0] if kind == EXTENSIBLE and len(body) >= 26 else kind, channels, rate, bits)
        elif part == b"data":
            if form is None:
                raise ValueError(f"{name}: samples come before their format")
            kind, channels, rate, bits = form
            if (kind, bits) not in {(INTEGER, 8), (INTEGER, 16), (INTEGER, 24), (INTEGER, 32), (FLOAT, 32), (FLOAT, 64)} or not channels or not rate:
                raise ValueError(f"{name}: format {kind} with {bits} bits and {channels} channels is not read")
            n = min(long_size if n == 0xFFFFFFFF and long_size is not None else n, size - at - 8)
            return Header(kind, channels, rate, bits, at + 8, n // (channels * bits // 8))
        at += 8 + n + n % 2
    raise ValueError(f"{name}: no samples")


def written_header(frames: int, rate: int, as_float: bool) -> bytes:
    """Of one channel of 16-bit integers or 32-bit floats."""
    width = 4 if as_float else 2
    if frames * width + 36 >= 1 << 32:
        raise ValueError(f"{frames} frames are too many for a WAV file")
    return b"RIFF" + struct.pack("<I", 36 + frames * width) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, FLOAT if as_float else INTEGER, 1, rate, rate * width, width, 8 * width) + b"data" + struct.pack("<I", frames * width)


def written_body(x: np.ndarray, as_float: bool) -> bytes:
    return np.asarray(x, "<f4").tobytes() if as_float else np.clip(np.round(np.asarray(x, np.float64) * 32768), -32768, 32767).astype("<i2").tobytes()


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """A local path may be bare, or a URI as Spark writes it (``file:/...``)."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split, self.block = options["path"], int(options.get("splitbytes", SPLIT_BYTES)), int(options.get("blockframes", BLOCK_FRAMES))

    def partitions(self) -> list[Range]:
        where, path = _located(self.path)
        found = where.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.is_file else [f for f in where.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.extension.lower() == "wav" and "/_" not in f.path[len(path) :]]
        return [Range(f.path, f.size, at, min(at + self.split, f.size)) for f in sorted(files, key=lambda f: f.path) for at in range(0, max(f.size, 1), self.split)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        where, _ = _located(self.path)
        with where.open_input_file(part.path) as f:
            h = header(lambda at, n: f.read_at(n, at), part.size, part.path)
            # frames that start in this range
            first = lambda at: min(h.frames, max(0, -(-(at - h.data_at) // h.frame_bytes)))
            for at in range(first(part.start), first(part.end), self.block):
                n = min(self.block, first(part.end) - at)
                samples = h.decoded(f.read_at(n * h.frame_bytes, h.data_at + at * h.frame_bytes)).astype("<f4").tobytes()
                yield pa.record_batch([pa.array([x]) for x in (part.path,)] + [pa.array([h.rate], pa.int32()), pa.array([h.channels], pa.int32()), pa.array([h.frames], pa.int64()), pa.array([at], pa.int64()), pa.array([samples], pa.binary())], names=["path", "sample_rate", "channels", "frames", "first_frame", "samples"])


@dataclass
class Moves(WriterCommitMessage):
    """Files of a task, by their places in its folder and in the end."""

    files: list[tuple[str, str]]


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, encoding = options["path"].rstrip("/"), options.get("encoding", "pcm16")
        if encoding not in ("pcm16", "float32"):
            raise ValueError(f"encoding {encoding!r} is neither pcm16 nor float32")
        self.as_float, self.job = encoding == "float32", f"_job-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Moves:
        where, base = _located(self.path)
        context = TaskContext.get()
        folder = f"{base}/{self.job}/{context.partitionId()}-{context.attemptNumber()}-{uuid.uuid4().hex}"
        moves, out, name, left, at = [], None, None, 0, 0

        def ended() -> None:
            if out is not None:
                out.close()
                if left:
                    raise ValueError(f"{name}: {left} frames are missing")

        where.create_dir(folder)
        try:
            for b in batches:
                for r in b.select(["name", "sample_rate", "frames", "first_frame", "samples"]).to_pylist():
                    if r["name"] != name:
                        ended()
                        name, left, at = r["name"], r["frames"], 0
                        moves.append((f"{folder}/{len(moves)}.wav", f"{base}/{name}"))
                        out = where.open_output_stream(moves[-1][0])
                        out.write(written_header(left, r["sample_rate"], self.as_float))
                    x = np.frombuffer(r["samples"], "<f4")
                    if r["first_frame"] != at or len(x) > left:
                        raise ValueError(f"{name}: a block starts at frame {r['first_frame']} where {at} was due, of {r['frames']}")
                    out.write(written_body(x, self.as_float))
                    at, left = at + len(x), left - len(x)
            ended()
            out = None
        finally:
            if out is not None and not out.closed:
                out.close()
        return Moves(moves)

    def commit(self, messages: list[Moves | None]) -> None:
        where, base = _located(self.path)
        moves = [m for message in messages if message for m in message.files]
        for folder in sorted({to.rsplit("/", 1)[0] for _, to in moves}):
            where.create_dir(folder)
        for held, to in moves:
            where.move(held, to)
        self._cleared(where, base)

    def abort(self, messages: list[Moves | None]) -> None:
        self._cleared(*_located(self.path))

    def _cleared(self, where: fs.FileSystem, base: str) -> None:
        if where.get_file_info(f"{base}/{self.job}").type != fs.FileType.NotFound:
            where.delete_dir(f"{base}/{self.job}")


class WavFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()})


def blocks(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """Blocks of all WAV files under ``path``, or of that file."""
    spark.dataSource.register(WavFiles)
    return spark.read.format("wav").options(**options).load(path)


def to_files(rows: DataFrame, folder: str, encoding: str = "pcm16") -> None:
    """Writes ``name``, ``sample_rate``, ``frames``, ``first_frame``, ``samples`` as files; those of the same names are replaced."""
    rows.sparkSession.dataSource.register(WavFiles)
    rows = rows.select("name", "sample_rate", "frames", "first_frame", "samples").repartition("name").sortWithinPartitions("name", "first_frame")
    rows.write.format("wav").mode("append").option("encoding", encoding).save(folder)


def saved(rows: DataFrame, folder: str, encoding: str = "pcm16") -> DataFrame:
    """Rows of ``path`` and ``wav`` (a file of one channel, as ``normalised``, ``enhanced`` and ``sliced`` make them) as
    files under ``folder``: the rows without ``wav``, with ``output_path``. Names are those of the inputs, with a digest of the whole path."""
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"(?i)\.wav$", "")
    named = rows.withColumn("__name", F.concat(stem, F.lit("-"), F.substring(F.sha2("path", 256), 1, 12), F.lit(".wav"))).persist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = header(lambda at, n: data[at : at + n], len(data), name)  # noqa: B023
                for at in range(0, max(h.frames, 1), BLOCK_FRAMES):
                    x = h.decoded(data[h.data_at + at * h.frame_bytes : h.data_at + min(at + BLOCK_FRAMES, h.frames) * h.frame_bytes]).mean(axis=1)
                    yield pa.record_batch([pa.array([name]), pa.array([h.rate], pa.int32()), pa.array([h.frames], pa.int64()), pa.array([at], pa.int64()), pa.array([x.astype("<f4").tobytes()], pa.binary())], names=["name", "sample_rate", "frames", "first_frame", "samples"])

    try:
        to_files(named.select("__name", "wav").mapInArrow(run, "name string, sample_rate int, frames bigint, first_frame bigint, samples binary"), folder, encoding)
        out = named.drop("wav").withColumn("output_path", F.concat(F.lit(folder.rstrip("/") + "/"), "__name")).drop("__name")
        kept = f"{folder.rstrip('/')}/_rows-{uuid.uuid4().hex}"
        out.write.parquet(kept)
    finally:
        named.unpersist()
    return rows.sparkSession.read.schema(out.schema).parquet(kept)


def cut(rows: DataFrame, folder: str, encoding: str = "float32") -> None:
    """Writes parts of recordings as files: rows of ``name``, ``source`` (a WAV file), ``start_frame``, ``end_frame``.

    A task reads the bytes of its parts where they are and hands them to the sink in order, so no recording is held or
    moved, and no samples are shuffled. Channels are averaged; frames beyond the end are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                where, path = _located(r["source"])
                with where.open_input_file(path) as f:
                    h = header(lambda at, n: f.read_at(n, at), f.size(), path)  # noqa: B023
                    start = min(r["start_frame"], h.frames)
                    frames = max(0, min(r["end_frame"], h.frames) - start)
                    for at in range(0, max(frames, 1), BLOCK_FRAMES):
                        body = f.read_at(min(BLOCK_FRAMES, frames - at) * h.frame_bytes, h.data_at + (start + at) * h.frame_bytes)
                        samples = h.decoded(body).mean(axis=1).astype("<f4").tobytes()
                        yield pa.record_batch([pa.array([r["name"]]), pa.array([h.rate], pa.int32()), pa.array([frames], pa.int64()), pa.array([at], pa.int64()), pa.array([samples], pa.binary())], names=["name", "sample_rate", "frames", "first_frame", "samples"])

    rows.sparkSession.dataSource.register(WavFiles)
    parts = rows.select("name", "source", "start_frame", "end_frame").repartition("name").mapInArrow(run, "name string, sample_rate int, frames bigint, first_frame bigint, samples binary")
    parts.write.format("wav").mode("append").option("encoding", encoding).save(folder)

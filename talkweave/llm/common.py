"""Shared pieces: staged tables in the cluster's shared folder, word splitting, Arrow batch helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: Words of a bit set of hashes.
WORDS = 1 << 20
#: Bytes of batches after which a task gives freed memory back, and rows of texts in a batch.
GIVEN, TEXTS = 16 << 20, 1000


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="talkweave-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only in local mode, where one machine is all there is, a session may name none; elsewhere that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")


def written(df: DataFrame, name: str, one_in: int = 1, grouped: int = 0) -> tuple[DataFrame, str]:
    """``df`` as Parquet in a new folder of the shared folder, read again, and that folder.

    ``one_in``: for tables much smaller than the texts, one file for so many of the session's shuffle partitions.
    ``grouped``: for rows of megabytes, the rows of a row group. Writer and reader hold a row group at a time, and the
    writer first looks at its bytes after a hundred rows.
    """
    if one_in > 1:
        df = df.coalesce(max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // one_in))
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.row.count.limit", grouped) if grouped else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str, one_in: int = 1) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and a lost executor costs no more than what came after."""
    return written(df, name, one_in)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``written`` made and that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXTS) -> Iterator[None]:
    """Within it, tables are written by way of batches of so many rows at most: a batch is held by the JVM and by Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released() -> None:
    """Gives memory that Arrow's and C's allocators keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task``, a function for ``mapInArrow``, with freed memory given back after each ``GIVEN`` bytes it has taken and at its end.

    Python workers outlive their tasks, so what a task's allocators keep counts against the executor during later ones.
    """

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for b in batches:
            size += b.nbytes
            yield b
            del b
            if size >= GIVEN:
                released()
                size = 0
        released()  # whoever gave the last batch held it until asked for the next

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(taken(batches))
        released()

    return run


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_hash(*values: Column) -> Column:
    """A digest of a row by some of its columns; nulls differ from empty values."""
    parts = [x for v in values for x in (F.coalesce(F.concat(F.lit("="), F.sha2(v.cast("string"), 256)), F.lit("-")), F.lit("/"))]
    return F.md5(F.concat(*parts))


def bit_set(hashes: DataFrame) -> np.ndarray:
    """The words of a bit set of 64-bit hashes (``h``); at most ``WORDS`` rows reach the driver."""
    words = hashes.groupBy(F.col("h").bitwiseAND(WORDS - 1).cast("int").alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, int(shiftrightunsigned(h, 58)))")).alias("bits")).toArrow()
    out = np.zeros(WORDS, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def in_bit_set(words: np.ndarray, hashes: pa.Array) -> pa.Array:
    """Whether each hash has its bit set: true for all those put in, and for a few others."""
    h = hashes.to_numpy().view(np.uint64)
    return pa.array((words[h & np.uint64(len(words) - 1)] >> (h >> np.uint64(58))) & np.uint64(1) == 1)


def parted(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` (no null) is among ``keys`` (that column alone), and the others.

    Only rows that a bit set of the keys' hashes does not rule out are shuffled to meet them; the others stay where they
    are, however many keys there are.
    """
    words = bit_set(keys.select(F.xxhash64(key).alias("h")))
    if not words.any():
        return rows.limit(0), rows
    words, flag = rows.sparkSession.sparkContext.broadcast(words), fresh("flag", rows.columns)
    flagged = rows.withColumn(flag, F.arrow_udf(lambda h: in_bit_set(words.value, h), "boolean")(F.xxhash64(key)))
    near, far = flagged.filter(flag).drop(flag), flagged.filter(~F.col(flag)).drop(flag)
    return near.join(keys, key, "left_semi"), far.unionByName(near.join(keys, key, "left_anti"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text: runs of characters other than ``WHITE``; none for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def utf8(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The values of an Arrow string column as UTF-8 bytes, some rows at a time; null gives the empty text."""
    for at in range(0, len(column), 256):
        yield from (x or b"" for x in column.slice(at, 256).cast(pa.binary()).to_pylist())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

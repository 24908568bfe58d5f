"""Token counts through a digest cache.

Counts are stored under two digests: of the content, normalised so that its count can't change (runs of white space
become one space, none stay at the ends), and of the tokenizer's file. Documents are joined to the stored counts by
them; only distinct misses are encoded, and appended to the cache. Copies are dropped within a task before the
shuffle, so a text that a third of all rows repeat reaches its partition once per task.

The normalisation is safe for tokenizers that drop white space before they split (``DROPS_SPACE``); for others the
content is taken as it is. Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and ties get equal counts. An
empty table gives an empty one and leaves the cache as it is. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, staged

LIMIT = 2048
#: Texts and bytes that are handed to the library at once.
AT_ONCE, BYTES_AT_ONCE = 256, 1 << 20
#: Chunks of text whose counts a task remembers.
CHUNKS = 200_000
DROPS_SPACE = ("word_bpe_49k.json",)


@cache
def encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Counts for a list of texts, as the library for this kind of file gives them; loaded once per worker."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]


def version_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest that a task sees."""
    seen: set[bytes] = set()
    for b in batches:
        new = []
        for d in b.column(0).to_pylist():
            new.append(d not in seen)
            seen.add(d)
        yield b.filter(pa.array(new, pa.bool_()))


class ByChunk:
    """Counts of texts as sums over their chunks between spaces, each distinct chunk encoded once.

    For tokenizers that drop white space before they split, no token, normal form or special token spans a space, so
    the count of a text is the sum of those of its chunks. The memory is bounded: at ``CHUNKS`` it starts anew.
    """

    def __init__(self, counts: Callable[[list[str]], list[int]]):
        self.counts, self.known = counts, {}

    def __call__(self, texts: list[str]) -> list[int]:
        split = [t.split(" ") for t in texts]
        if len(self.known) > CHUNKS:
            self.known.clear()
        known = self.known
        new = list({c for s in split for c in s if c not in known})
        known.update(zip(new, self.counts(new), strict=True))
        return [sum(map(known.__getitem__, s)) for s in split]


def _counter(path: str, by_chunk: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = ByChunk(encoder(path)) if by_chunk else encoder(path)
        for b in _first_in_task(batches):
            out, part, size = [], [], 0
            for t in b.column(1).to_pylist():
                part.append(t)
                size += len(t)
                if len(part) >= AT_ONCE or size >= BYTES_AT_ONCE:
                    out += counts(part)
                    part, size = [], 0
            if part:
                out += counts(part)
            yield pa.record_batch([b.column(0), pa.array(out, pa.int64())], names=["digest", "n_tokens"])

    return count


def normalised(text: Column, drops_space: bool) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.btrim(F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " "), F.lit(WHITE)) if drops_space else text


def counted(docs: DataFrame, cache_path: str, tokenizer: str = "word_bpe_49k.json", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_tokens``. ``cache_path`` is a folder of the shared store; it need not exist."""
    spark, path = docs.sparkSession, public_tokenizers.path(tokenizer)
    version = version_of(path)
    content = normalised(F.col(text), tokenizer in DROPS_SPACE)
    digest = F.unhex(F.sha2(content, 256))
    n_bytes = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("bigint")
    keyed = staged(docs.select(F.col(doc_id).alias("doc_id"), n_bytes.alias("n_bytes"), digest.alias("digest")), "digests")
    stored = _stored(spark, cache_path, version)
    texts = docs.select(digest.alias("digest"), content.alias("content"))
    if stored is not None:
        texts = texts.join(stored, "digest", "left_anti")
    once = "digest binary, content string"
    misses = texts.mapInArrow(_first_in_task, once).repartition("digest")
    counts = misses.mapInArrow(_counter(path, tokenizer in DROPS_SPACE), "digest binary, n_tokens bigint")
    counts.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache_path)
    known = _stored(spark, cache_path, version)
    if known is None:  # no rows at all
        known = spark.createDataFrame([], "digest binary, n_tokens bigint")
    # two runs that append at once may both store a digest: equal counts, so either will do. Staged before the join,
    # which adaptive execution can then split where one digest has many documents
    once_each = staged(known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "known-counts")
    return keyed.join(once_each, "digest").select("doc_id", "n_bytes", "n_tokens")


def _stored(spark, cache_path: str, version: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{cache_path}/version={version}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("digest binary, n_tokens bigint").parquet(f"{cache_path}/version={version}")

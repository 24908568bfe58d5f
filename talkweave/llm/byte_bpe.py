"""Byte-level BPE: texts to packed token ids with character offsets, and back.

Encoding runs the tokenizers library over Arrow batches. A text is cut at safe spaces, and each distinct part is encoded
once by a task, as long as it is remembered, so repeated words and copies cost a look-up. Ids are packed as little-endian unsigned 32-bit
integers, the form of token files for training. A token is a run of bytes and may begin or end inside a character: its
offsets are those of all characters it has a byte of, in code points, the end exclusive, so neighbours that share a
character overlap by one.

Decoding reverses the byte table and joins the bytes. Text is decoded from the joined bytes, so characters that were
split over tokens come back whole; ``parts`` gives each token the characters that end in it, so that a stream of tokens
can be shown as it comes. Bytes that form no character become U+FFFD.

Null text counts as empty: no tokens, no bytes. Repeated rows and ties are encoded one by one. An empty table gives an
empty one. Only ``doc_id`` and ``text`` are read, other columns never clash. A run without any safe space is handed to
the library whole, which takes some 70 times its bytes; other long texts take memory in proportion to their tokens.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean
from .vocabularies import cut, encoded_parts, lengths, text_slices, vocabulary

RANKS = "byte_bpe_50k.tiktoken"
#: Parts whose ids a task remembers.
PARTS = 400_000


def parts_of(text: str) -> list[str]:
    """The parts of a text that are encoded alone; they join to the text."""
    first, *rest = cut(text) or [""]
    return [first, *[" " + p for p in rest]] if text else []


class Packer:
    """Packed ids of texts. Each distinct part is encoded once, until there are ``PARTS``: then it starts anew."""

    def __init__(self, name: str):
        self.name, self.known = name, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [parts_of(t) for t in texts]
        if len(self.known) > PARTS:
            self.known.clear()
        known = self.known
        new = list({p for s in split for p in s if p not in known})
        ids, counts = encoded_parts(self.name, new)
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        known.update(zip(new, [data[s:e] for s, e in zip([0, *ends], ends, strict=False)], strict=True))
        return [b"".join(map(known.__getitem__, s)) for s in split]


def offsets(text: str, ids: bytes, name: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of the characters that each token has a byte of."""
    data = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80)  # of a byte, counted from 1
    ends = np.cumsum(lengths(name)[np.frombuffer(ids, "<u4")])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return (character[starts] - 1).astype(np.int32), character[ends - 1].astype(np.int32)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.zeros(0, np.int32)]).astype(np.int32)))


def encoded(docs: DataFrame, ranks: str = RANKS, with_offsets: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids`` (packed) and, if asked for, ``starts`` and ``ends`` of the tokens."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = Packer(ranks)
        for part, texts in text_slices(batches, 1):
            ids = packed(texts)
            columns = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            if with_offsets:
                columns += map(_lists, zip(*[offsets(t, i, ranks) for t, i in zip(texts, ids, strict=True)], strict=True))
            yield pa.record_batch(columns, names=names)

    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids binary" + ", starts array<int>, ends array<int>" * with_offsets
    names = ["doc_id", "n_tokens", "ids", "starts", "ends"][: 5 if with_offsets else 3]
    return keyed.mapInArrow(lean(run), schema)


def shown(ids: bytes, name: str) -> list[str]:
    """Per token, the characters that end in it; those that the last tokens leave open come with the last one."""
    decoder, tokens = codecs.getincrementaldecoder("utf-8")("replace"), vocabulary(name).tokens
    at = np.frombuffer(ids, "<u4").tolist()
    return [decoder.decode(tokens[i], k == len(at)) for k, i in enumerate(at, 1)]


def decoded(tokens: DataFrame, ranks: str = RANKS, with_parts: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` (packed) to ``doc_id``, ``n_tokens``, ``ids``, ``data`` (bytes), ``text`` and, if asked for, ``parts``.

    Null ids count as none. An id outside the vocabulary fails the job.
    """
    keyed = tokens.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids, token = part.column(1).to_pylist(), vocabulary(ranks).tokens.__getitem__
                data = [b"".join(map(token, np.frombuffer(i, "<u4").tolist())) for i in ids]
                columns = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), part.column(1), pa.array(data, pa.binary()), pa.array([d.decode("utf-8", "replace") for d in data], pa.string())]
                if with_parts:
                    columns.append(pa.array([shown(i, ranks) for i in ids], pa.list_(pa.string())))
                yield pa.record_batch(columns, names=names)

    schema = f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary, data binary, text string" + ", parts array<string>" * with_parts
    names = ["doc_id", "n_tokens", "ids", "data", "text", "parts"][: 6 if with_parts else 5]
    return keyed.mapInArrow(lean(run), schema)

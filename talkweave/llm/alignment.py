"""Cross-tokenizer alignment: minimal groups of tokens of two tokenizers that cover the same bytes, links between
overlapping tokens, and how often each pair of ids is linked in the corpus.

Tokens of A (byte-level, of a space and the text) and B (pieces, which add the space themselves) are the two sides of a
graph with an edge for every pair whose byte ranges overlap. Union-find over the edges gives its connected components,
which are exactly the minimal groups: a byte offset where tokens of both sides end is one that no edge crosses. An
overlap is either a token of A with the first of B that it touches or the reverse, so a text has at most one link per token.

A task works on blocks of some megabytes. Texts are cut at safe spaces (``vocabularies.cut``), where a token of
either side ends, and each distinct part of a block is tokenized, grouped and linked once; a text is a sequence of parts.
Per block, one row leaves: the sequences of parts, the distinct linked pairs and how often the block links each. Pairs
are counted over all blocks by a grouped sum, combined before the shuffle; the highest count per id of B has at most as
many rows as B has ids, a proven bound, so it is broadcast. A block then meets the counts of its distinct pairs, one
row per pair and block, in a cogroup, and sums them over its texts: rows are sorted and streamed there, and only one
block is held. Texts are never shuffled, and no pair is moved once per link. A file of blocks is written and read some
blocks at a time, however many a task has.

Null and empty texts, and those whose tokens do not join to the bytes of space and text on both sides, have no tokens:
zeros and an empty ``groups_sha256``. Repeated rows count each. An empty table gives an empty one. Only ``doc_id`` (of
any type) and ``text`` are read; other columns never clash. A very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, released, removed, written
from .vocabularies import cut, encoded_parts, lengths, text_slices, vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Rows of a block table that a row group holds.
BLOCKS_AT_ONCE = 4


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union-find over edge arrays: the least node of each node's component. Every round hooks the larger root of each
    open edge under the smallest root it meets, then shortens all paths; closed edges go."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
        still = root[u] != root[v]
        u, v = u[still], v[still]
    return root


@dataclass(frozen=True)
class Aligned:
    """Parts one after the other: tokens of both sides with byte ends and group numbers, and links as token places."""

    valid: np.ndarray
    a_ids: np.ndarray
    a_ends: np.ndarray
    a_counts: np.ndarray
    a_groups: np.ndarray
    b_ids: np.ndarray
    b_ends: np.ndarray
    b_counts: np.ndarray
    b_groups: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    def part_of_a(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.a_counts)), self.a_counts)


def align(parts: list[str], a: str = A, b: str = B) -> Aligned:
    """Tokens, groups and links of parts, each standing for a space and itself. Parts that do not come back as their own
    bytes on both sides are not valid and have no tokens."""
    left, right = vocabulary(a).tokens, vocabulary(b).tokens
    (a_ids, a_counts), b_lists = encoded_parts(a, [" " + p for p in parts]), vocabulary(b).encode(parts)
    b_ids, b_counts = np.fromiter(itertools.chain.from_iterable(b_lists), np.int64), np.fromiter(map(len, b_lists), np.int64, len(parts))
    del b_lists
    whole = lambda ids, tokens: b"".join(map(tokens.__getitem__, ids.tolist()))
    data, valid = " ".join(["", *parts]).encode(), np.ones(len(parts), bool)
    if whole(a_ids, left) != data or whole(b_ids, right) != data:
        a_each, b_each = (np.split(ids, np.cumsum(counts)[:-1]) for ids, counts in ((a_ids, a_counts), (b_ids, b_counts)))
        valid[:] = [whole(x, left) == whole(y, right) == (" " + p).encode() for p, x, y in zip(parts, a_each, b_each, strict=True)]
        a_ids, b_ids = a_ids[np.repeat(valid, a_counts)], b_ids[np.repeat(valid, b_counts)]
        a_counts, b_counts = np.where(valid, a_counts, 0), np.where(valid, b_counts, 0)
    a_size, b_size = lengths(a)[a_ids], lengths(b)[b_ids]
    a_ends, b_ends = np.cumsum(a_size), np.cumsum(b_size)
    a_starts, b_starts = a_ends - a_size, b_ends - b_size
    na, nb = len(a_ids), len(b_ids)
    first_b, first_a = np.searchsorted(b_ends, a_starts, "right"), np.searchsorted(a_ends, b_starts, "right")
    later = np.flatnonzero(b_starts > a_starts[first_a]) if nb else np.zeros(0, np.int64)
    link_a, link_b = np.concatenate([np.arange(na), first_a[later]]), np.concatenate([first_b, later])
    root = components(na + nb, link_a, na + link_b)
    number = np.cumsum(root[:na] == np.arange(na)) - 1  # the least node of a component is its first token of A
    groups = [number[root[:na]], number[root[na:]]] if na else [np.zeros(0, np.int64)] * 2
    return Aligned(valid, a_ids, a_ends, a_counts, groups[0], b_ids, b_ends, b_counts, groups[1], link_a, link_b)


@cache
def _written(name: str) -> np.ndarray:
    """Each id in decimal, before ``,``, before ``|`` and before ``;``."""
    return np.array([f"{i}{end}" for end in ",|;" for i in range(len(vocabulary(name).tokens))], object)


def listed(x: Aligned, a: str = A, b: str = B) -> list[str]:
    """Per part, its groups as ``a1,a2|b1;a3|b2,b3``."""
    if not len(x.a_ids):
        return [""] * len(x.valid)
    n = x.a_groups[-1] + 1
    of_a, of_b = np.bincount(x.a_groups, minlength=n), np.bincount(x.b_groups, minlength=n)
    a_at = np.arange(len(x.a_ids)) + (np.cumsum(of_b) - of_b)[x.a_groups]
    b_at = np.arange(len(x.b_ids)) + np.cumsum(of_a)[x.b_groups]
    last = lambda groups: np.append(groups[1:] != groups[:-1], True)
    out = np.empty(len(a_at) + len(b_at), object)
    out[a_at] = _written(a)[x.a_ids + last(x.a_groups) * len(vocabulary(a).tokens)]
    out[b_at] = _written(b)[x.b_ids + last(x.b_groups) * 2 * len(vocabulary(b).tokens)]
    text, ends = out.tolist(), np.cumsum(x.a_counts + x.b_counts).tolist()
    return ["".join(text[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def _split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of texts, each text as places among them, one after the other, and how many it has."""
    known: dict[str, int] = {}
    places = [[known.setdefault(p, len(known)) for p in cut(t)] for t in texts]
    counts = np.fromiter(map(len, places), np.int64, len(places))
    return list(known), np.fromiter((i for p in places for i in p), np.int64, int(counts.sum())), counts


def _ragged_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values`` of the given lengths."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers byte by byte (all lowest bytes first), which compresses well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.zeros(0, np.int64)]).astype(np.int64)))


#: Of a text; the counts of links come with the corpus.
PER_TEXT = ("n_a", "n_b", "n_groups", "n_links")
#: Of a block, packed: texts as sequences of parts, parts per text, links as places among the pairs, links per part.
PACKED = ("sequence", "parts", "places", "links")


def _block(texts: list[str], a: str, b: str) -> dict:
    """What a block keeps: per text its measures, digest and sequence of parts; per part its links, as places in the
    block's sorted distinct pairs; and those pairs with the number of links in the block."""
    parts, sequence, counts = _split(texts)
    x = align(parts, a, b)
    good = _ragged_sum(~x.valid[sequence], counts) == 0
    alive = np.repeat(good, counts)
    sequence, counts = sequence[alive], np.where(good, counts, 0)
    of_a = x.part_of_a()
    new_group = np.append(True, x.a_groups[1:] != x.a_groups[:-1]) if len(x.a_groups) else np.zeros(0, bool)
    link_part = of_a[x.link_a]
    order = np.argsort(link_part, kind="stable")
    keys, place = np.unique((x.a_ids[x.link_a] * len(vocabulary(b).tokens) + x.b_ids[x.link_b])[order], return_inverse=True)
    links = np.bincount(link_part, minlength=len(parts))
    measures = (x.a_counts, x.b_counts, np.bincount(of_a[new_group], minlength=len(parts)), links)
    strings = listed(x, a, b)
    ends = np.cumsum(counts).tolist()
    seq = sequence.tolist()
    texts_of = [";".join(map(strings.__getitem__, seq[s:e])) for s, e in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
    digest = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts_of]
    times = np.bincount(sequence, minlength=len(parts))[np.sort(link_part)]
    n = np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)
    return {**{c: _ragged_sum(m[sequence], counts) for c, m in zip(PER_TEXT, measures, strict=True)}, "digest": digest, "sequence": _pack(sequence), "parts": _pack(counts), "places": _pack(place), "links": _pack(links), "keys": keys, "times": n}


def blocks(docs: DataFrame, a: str = A, b: str = B, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block of texts (see the module's docstring)."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["block", "doc_ids", *PER_TEXT, "digest", *PACKED, "keys", "times"]
    types = ["bigint", f"array<{keyed.schema['doc_id'].dataType.simpleString()}>", *["array<bigint>"] * len(PER_TEXT), "array<string>", *["binary"] * len(PACKED), "array<bigint>", "array<bigint>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, (part, texts) in enumerate(text_slices(batches, 1)):
            x = _block(texts, a, b)
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(0)]))
            columns = [pa.array([TaskContext.get().partitionId() << 32 | no], pa.int64()), ids, *[_lists([x[c]]) for c in PER_TEXT], pa.array([x["digest"]], pa.list_(pa.string()))]
            columns += [pa.array([x[c]], pa.binary()) for c in PACKED]
            yield pa.record_batch([*columns, _lists([x["keys"]]), _lists([x["times"]])], names=names)

    return keyed.mapInArrow(lean(run), ", ".join(map(" ".join, zip(names, types, strict=True))))


def pair_counts(of_blocks: DataFrame, b: str = B) -> DataFrame:
    """``pair`` (id of A times the size of B's vocabulary, plus id of B) to ``n`` and whether it is its B id's highest."""
    linked = of_blocks.select(F.explode(F.arrays_zip("keys", "times")).alias("x"))
    counts = linked.groupBy(F.col("x.keys").alias("pair")).agg(F.sum("x.times").alias("n")).filter("n > 0")
    counts = written(counts.withColumn("b", F.col("pair") % len(vocabulary(b).tokens)), "pair-counts", 8)[0]
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _measured(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Per text of a block, the sums of its links' counts, from the counts of the block's distinct pairs."""
    of = lambda name: block.column(name)[0].values
    sequence, parts, places, links = (_unpack(block.column(c)[0].as_py()) for c in PACKED)
    keys, sums = of("keys").to_numpy(), []
    at = np.searchsorted(keys, counts.column("pair").to_numpy())
    for name in ("best", "n"):
        value = np.zeros(len(keys), np.int64)
        value[at] = counts.column(name).cast(pa.int64()).to_numpy()
        sums.append(_ragged_sum(_ragged_sum(value[places], links)[sequence], parts))
    out = pa.table([of("doc_ids"), *map(of, PER_TEXT), *map(pa.array, sums), of("digest")], names=["doc_id", *PER_TEXT, "n_best", "count_sum", "groups_sha256"])
    released()
    return out


def measured(docs: DataFrame, a: str = A, b: str = B, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair has its B id's
    highest count, ties included), ``count_sum`` (of its links' pairs), ``groups_sha256``."""
    spark = docs.sparkSession
    of_blocks, path = written(blocks(docs, a, b, doc_id, text), "aligned-blocks", grouped=BLOCKS_AT_ONCE)
    counts = pair_counts(of_blocks, b)
    needed = of_blocks.select(F.col("block").alias("of"), F.explode("keys").alias("pair")).join(counts, "pair")
    schema = f"doc_id {of_blocks.schema['doc_ids'].dataType.elementType.simpleString()}, " + ", ".join(f"{c} bigint" for c in (*PER_TEXT, "n_best", "count_sum")) + ", groups_sha256 string"
    out = written(of_blocks.drop("times").groupBy("block").cogroup(needed.groupBy("of")).applyInArrow(_measured, schema), "aligned")[0]
    removed(spark, path)
    return out


def aligned(docs: DataFrame, a: str = A, b: str = B, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and, for both sides, ids, byte ends within space and text, and group numbers from 0."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = [f"{side}_{x}" for side in "ab" for x in ("ids", "ends", "groups")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 1):
            rows: dict[str, list] = {n: [] for n in names}
            for t in texts:
                x = align(cut(t), a, b)
                for n in names:
                    rows[n].append(getattr(x, n) if x.valid.all() else np.zeros(0, np.int64))
            yield pa.record_batch([part.column(0), *[_lists(rows[n]) for n in names]], names=["doc_id", *names])

    return keyed.mapInArrow(lean(run), f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} array<bigint>" for n in names))

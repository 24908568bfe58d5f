"""Benchmark decontamination by a positional inverted index of the training texts.

``build_index`` cuts the corpus into segments of bounded size, as the documents come, without a shuffle, and stores
for each the postings of every term: its places in the segment, documents lying a place apart. A phrase has no such
place in it, and a stretch that reaches from one document into the next is dropped, so no match does. The index is a table in the shared folder; it doesn't depend on the test set. ``search``
takes the test set in blocks of bounded size. In each segment a window (``WINDOW`` consecutive words of an item, or
all words of a shorter one) starts from the postings of its rarest term, shifted by the term's offset, and is
intersected with the postings of its other terms, rarest first; what is left are the exact phrase matches. With
``slop``, stretches with all the window's words in order within that many extra words are found as well.

Words are runs of digits, a-z and characters beyond ASCII, after A-Z is lower-cased. Null and empty texts have no
words, items without words no windows. Repeated rows are documents of their own, as rows are told apart by their
place in the index, not by ``doc_id``, which may be null. Repeated items count once per id; words of items without an id
are hit, but such items are neither counted nor listed. Other columns of the
documents are ignored. An empty table of documents or items gives no hits.
"""

from __future__ import annotations

import uuid
from array import array
from collections import defaultdict
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, released, staged, text_batches, utf8

WINDOW = 8
#: Places between two documents of a segment, and bytes that a document's row takes beside its text.
GAP, ROW = 1, 16
#: Bytes of text in a segment (one larger text is a segment alone), and words of items in a block of the test set.
SEGMENT_BYTES, BLOCK_WORDS = 24 << 20, 200_000
#: Items with a hit that make a document contaminated.
LEAST_ITEMS = 2

#: Fixed character class: 0-9, a-z and every byte from 0x80 on are word characters, A-Z is lower-cased.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    # the only white space left is the space, as every control character has become one
    return text.translate(_TO_WORDS).split()


class _Coded:
    """The texts of a segment to be, as numbers of their terms; the texts themselves are not held."""

    def __init__(self):
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.lengths: list[int] = []
        self.codes = array("i")

    def add(self, text: bytes) -> None:
        ws = words_of(text)
        self.lengths.append(len(ws))
        self.codes.extend(map(self.terms.__getitem__, ws))


def _segment(ids: list[pa.Array], coded: _Coded, kind: pa.DataType) -> pa.RecordBatch:
    """The row of a segment; ``coded`` is used up."""
    terms, n = coded.terms, np.array(coded.lengths, np.int64)
    terms.default_factory = None  # which refers to the terms
    starts = np.concatenate(([0], np.cumsum(n + GAP)[:-1]))
    counts = np.bincount(np.frombuffer(coded.codes, np.int32), minlength=len(terms)).astype(np.int32)
    keys = np.frombuffer(coded.codes, np.int32).astype(np.int64)  # by term, then by place: sorted where they are, as there are many
    coded.codes = array("i")
    keys <<= 32
    for at, to, first in zip((ends := np.cumsum(n)) - n, ends, starts.tolist(), strict=True):
        keys[at:to] |= np.arange(first, first + to - at)
    keys.sort()
    place = keys.astype(np.int32)  # the lower half
    del keys
    place[1:] = np.diff(place)
    packed = zstandard.ZstdCompressor(level=1).compress(place)
    del place
    return pa.record_batch(
        [
            pa.array([uuid.uuid4().hex]),
            pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(ids).cast(kind)),
            pa.array([n.tolist()], pa.list_(pa.int64())),
            pa.array([starts.astype(np.int64).tobytes()]),
            pa.array([zstandard.ZstdCompressor(level=1).compress(b" ".join(terms))]),
            pa.array([counts.tobytes()]),
            pa.array([packed]),
        ],
        names=["segment", "doc_ids", "n_words", "starts", "terms", "counts", "postings"],
    )


def _indexer(segment_bytes: int):
    @lean
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        coded = _Coded()
        size, kind = 0, None
        for b in batches:
            kind = b.column(0).type
            first = 0
            for i, t in enumerate(utf8(b.column(1))):
                if coded.lengths and size + len(t) + ROW > segment_bytes:
                    yield _segment([*ids, b.column(0).take(pa.array(np.arange(first, i)))], coded, kind)
                    ids, coded, size, first = [], _Coded(), 0, i
                coded.add(t)
                size += len(t) + ROW
            ids.append(b.column(0).take(pa.array(np.arange(first, b.num_rows))))  # a slice would hold the texts as well
            del b
        if coded.lengths:
            yield _segment(ids, coded, kind)

    return index


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The staged index: one row per segment, with its documents, terms and packed postings."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"segment string, doc_ids array<{kind}>, n_words array<bigint>, starts binary, terms binary, counts binary, postings binary"
    with text_batches(docs.sparkSession):
        return staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_indexer(segment_bytes), schema), "posting-index")


class Segment:
    """One segment's postings, unpacked, and the numbers of the ``wanted`` terms among its own."""

    def __init__(self, starts: bytes, terms: bytes, counts: bytes, postings: bytes, wanted: Container[bytes] | None = None):
        unpack = zstandard.ZstdDecompressor().decompress
        self.starts = np.frombuffer(starts, np.int64)
        names = unpack(terms).split(b" ") if counts else []
        self.terms = {t: i for i, t in enumerate(names) if wanted is None or t in wanted}
        del names
        self.ends = np.cumsum(np.frombuffer(counts, np.int32), dtype=np.int64)
        self.places = np.cumsum(np.frombuffer(unpack(postings), np.int32), dtype=np.int32)

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.ends[term - 1] if term else 0 : self.ends[term]]

    def phrase(self, window: list[int]) -> np.ndarray:
        """Places where the terms follow one another."""
        lists = sorted(((self.postings(t), i) for i, t in enumerate(window)), key=lambda x: len(x[0]))
        found = lists[0][0] - lists[0][1]
        for p, i in lists[1:]:
            at = np.searchsorted(p, found + i)
            found = found[p[np.minimum(at, len(p) - 1)] == found + i]
            if not len(found):
                break
        return found

    def near(self, window: list[int], slop: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last places of stretches with the terms in order and at most ``slop`` other words."""
        lists = [self.postings(t) for t in window]
        r = min(range(len(lists)), key=lambda i: len(lists[i]))
        left, right, ok = lists[r], lists[r], np.ones(len(lists[r]), bool)
        for p in lists[r + 1 :]:
            at = np.searchsorted(p, right, "right")
            ok &= at < len(p)
            right = p[np.minimum(at, len(p) - 1)]
        for p in reversed(lists[:r]):
            at = np.searchsorted(p, left) - 1
            ok &= at >= 0
            left = p[np.maximum(at, 0)]
        # the nearest terms lie in another document only if this one has none that fit
        ok &= (right - left < len(window) + slop) & (np.searchsorted(self.starts, left, "right") == np.searchsorted(self.starts, right, "right"))
        return left[ok], right[ok]


def _windows(words: list, window: int) -> list[list]:
    return [words[i : i + window] for i in range(max(1, len(words) - window + 1))] if words else []


def _merged(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as disjoint ones in order."""
    order = np.argsort(first, kind="stable")
    first, stop = first[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], first[1:] > stop[:-1]))
    return first[new], stop[np.concatenate((new[1:], [True]))]


def _searcher(items: list[tuple[str, bytes]], window: int, slop: int | None):
    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[str, list[list[bytes]]] = {}
        wanted: dict[bytes, bytes] = {}
        for name, text in items:
            queries.setdefault(name, []).append([wanted.setdefault(t, t) for t in words_of(text)])
        for b in batches:
            for k in range(b.num_rows):
                rows = found(Segment(*(b.column(c)[k].as_py() for c in ("starts", "terms", "counts", "postings")), wanted), queries)
                released()
                if rows:
                    yield pa.record_batch([pa.array([b.column("segment")[k].as_py()] * len(rows)), *(pa.array(c) for c in zip(*rows, strict=True))], schema=SCHEMA)

    def found(s: Segment, queries: dict[str, list[list[bytes]]]) -> list[tuple]:
        rows = []
        for name, ws in queries.items():
            spans: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {True: [], False: []}
            for terms in (w for words in ws for w in _windows([s.terms.get(t, -1) for t in words], window)):
                if min(terms) < 0:
                    continue
                if len(p := s.phrase(terms)):
                    spans[True].append((p, p + len(terms)))
                if slop is not None:
                    p, q = s.near(terms, slop)
                    if len(p):
                        spans[False].append((p, q + 1))
            for exact, got in spans.items():
                if got:
                    a, z = _merged(*map(np.concatenate, zip(*got, strict=True)))
                    doc = np.searchsorted(s.starts, a, "right") - 1
                    cuts = np.nonzero(np.diff(doc))[0] + 1
                    for d, x, y in zip(doc[np.concatenate(([0], cuts))], np.split(a, cuts), np.split(z, cuts), strict=True):
                        rows.append((int(d), name, exact, (x - s.starts[d]).tolist(), (y - s.starts[d]).tolist()))
        return rows

    return search


SCHEMA = pa.schema([("segment", pa.string()), ("place", pa.int32()), ("item", pa.string()), ("exact", pa.bool_()), ("first", pa.list_(pa.int64())), ("stop", pa.list_(pa.int64()))])


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, slop: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document (``segment``, ``place``), item and kind of match, with its stretches of words.

    The items come through the driver in blocks of about ``block_words`` words, each a search of its own.
    """
    frames: list[DataFrame] = []
    block: list[tuple[str, bytes]] = []
    size = 0
    columns = "segment string, place int, item string, exact boolean, first array<bigint>, stop array<bigint>"

    def close() -> None:
        frames.append(index.select("segment", "starts", "terms", "counts", "postings").mapInArrow(_searcher(list(block), window, slop), columns))
        block.clear()

    for r in items.select(F.col(item_id).cast("string"), F.col(text).cast("string")).toLocalIterator():
        block.append((r[0], (r[1] or "").encode()))
        size += len(words_of((r[1] or "").encode())) + 1
        if size >= block_words:
            close()
            size = 0
    if block or not frames:
        close()
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _n_covered(spans) -> F.Column:
    """How many words the union of [first, stop) intervals covers."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(F.sort_array(spans), start, lambda a, s: F.struct(F.greatest(a["at"], s["stop"]).alias("at"), (a["n"] + F.greatest(F.lit(0).cast("bigint"), s["stop"] - F.greatest(a["at"], s["first"]))).alias("n")), lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", slop: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids with an exact match, sorted) and ``near_items``."""
    index = build_index(docs, doc_id)
    with text_batches(docs.sparkSession, 1):  # a segment at a time
        hits = staged(search(index, items, slop=slop), "benchmark-hits")
    spans = F.transform(F.arrays_zip("first", "stop"), lambda s: F.struct(s["first"].alias("first"), s["stop"].alias("stop")))
    of = lambda exact: F.when(F.col("exact") if exact else ~F.col("exact"), F.col("item"))
    per_doc = hits.groupBy("segment", "place").agg(
        F.flatten(F.collect_list(F.when(F.col("exact"), spans))).alias("spans"), F.sort_array(F.collect_set(of(True))).alias("items"), F.sort_array(F.collect_set(of(False))).alias("near_items")
    )
    all_docs = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d")).select("segment", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    none = F.array().cast("array<string>")
    return all_docs.join(per_doc, ["segment", "place"], "left").select(
        "doc_id", "n_words", F.coalesce(_n_covered(F.col("spans")), F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items")
    )

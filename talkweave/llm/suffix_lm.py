"""Language-model scores from a probabilistic suffix tree over bytes, beside those of smoothed unigrams.

The tree predicts the bytes of a text's words (A-Z lower-cased, one space between words, a line feed as the end) from up
to ``DEPTH`` bytes before, line feeds standing before a text. A context is a state if it occurs ``FEWEST`` times and its
next-byte distribution diverges from that of the context one byte shorter by ``DIVERGENCE`` nats of log-likelihood over
its occurrences. Both are fixed numbers, so the tree grows with the input. A byte is scored
by the longest suffix of what came before it that is a state. A state's distribution takes discounts off its counts
(modified Kneser-Ney, one set a depth) and gives them to the next shorter state's distribution over continuations
(how many different bytes came before a string), and so on to the root, which is smoothed by a uniform one. All 256
bytes after any context add up to 1, so the probabilities of all texts add up to at most 1. A text's score is the
sum of its bytes' log10 probabilities. The base is exact unigram counts, for which no probability adds up.

How it is counted: each task counts its distinct words and strings of ``DEPTH + 1`` bytes and passes them on packed, the strings in
buckets by the last ``ROOT`` bytes of the context. All longer suffixes of a context lie in its bucket, so tests and
smoothing are local to it; strings of the ``ROOT`` shortest depths, at most 2**24, are summed on the driver. The tree is broadcast
in shards of whole buckets of about ``SHARD`` strings; a task looks its distinct strings up in one shard after the other, so
its memory is bounded by a shard whatever the tree's size. Words that make up at least ``1 / HEAD`` of all tokens, at
most ``HEAD`` of them, are broadcast for the base; the rest of each document's words are joined to their counts.

Null and empty texts are an end alone. Without a text to learn from all counts are 0 and bytes are uniform. Long texts
are read in pieces of about ``CHUNK`` bytes. Repeated rows are scored one by one (rows are told apart by task and
place, not by ``doc_id``, which may be null). Other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import os
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import removed, staged, utf8, written

DEPTH, ROOT = 7, 3
FEWEST, DIVERGENCE = 4, 10.0
HEAD = 500_000
#: Strings of a shard of the tree.
SHARD = 4_000_000
#: Texts are split in chunks of about so many bytes, counted and scored in groups of so many; partial counts are passed
#: on at so many distinct words or strings.
CHUNK, GROUP, DISTINCT_WORDS, DISTINCT_STRINGS = 1 << 20, 4 << 20, 300_000, 3_000_000
#: Distinct strings that are looked up in a shard at once.
STEP = 1 << 18
#: Buckets of strings: one for each partition of the input, within these bounds.
BUCKETS = (256, 1 << 16)

END = b"\n"
_PAD = END * DEPTH
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_8, _16 = np.uint64(8), np.uint64(16)


@dataclass
class Piece:
    row: int
    before: bytes
    words: list[bytes]
    body: bytes
    last: bool


def pieces(texts: Iterable[bytes]) -> Iterator[Piece]:
    """The texts' words and normalised bytes, long texts in several pieces, each with the ``DEPTH`` bytes before it."""
    for row, t in enumerate(texts):
        before, at, begun = _PAD, 0, False
        while True:
            gap = _SPACE.search(t, at + CHUNK) if len(t) - at > CHUNK else None
            stop = gap.start() if gap else len(t)
            words, last = t[at:stop].lower().split(), not gap
            body = b" ".join(words)
            if begun and words:
                body = b" " + body
            begun = begun or bool(words)
            if last:
                body += END
            if body:
                yield Piece(row, before, words, body, last)
            if last:
                break
            before, at = (before + body)[-DEPTH:], stop


def _chunks(texts: Iterable[bytes]) -> Iterator[list[Piece]]:
    part, size = [], 0
    for p in pieces(texts):
        part.append(p)
        size += len(p.body)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def codes_of(part: list[Piece]) -> np.ndarray:
    """For each byte to predict: the bytes before, the nearest one highest, and itself as the lowest."""
    n = np.fromiter((len(p.body) for p in part), np.int64, len(part))
    buffer = b"".join(x for p in part for x in (p.before, p.body))
    wide = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))  # the byte to predict is the highest
    ends = np.cumsum(n + DEPTH) - DEPTH
    keep = np.ones(len(wide), bool)
    for k in range(DEPTH):
        keep[ends[:-1] + k] = False  # these end in what stands before the next piece
    wide = wide[keep].astype(np.uint64)
    return (wide << _8) | (wide >> np.uint64(56))


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """By the ``ROOT`` bytes before the predicted one."""
    h = (codes >> np.uint64(64 - 8 * ROOT)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Partial counts with each string once, sorted; several parts are taken out of the list, so that they can go."""
    if len(parts) == 1:
        return parts[0]
    codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.argsort(codes, kind="stable")  # the parts are sorted runs
    codes = codes[order]
    counts = counts[order]
    del order
    first = np.nonzero(np.concatenate(([True], codes[1:] != codes[:-1])))[0]
    return codes[first], np.add.reduceat(counts, first)


def _counted(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings and their counts; the strings are taken out of the list."""
    own = np.concatenate(codes)
    codes.clear()
    own.sort()
    first = np.nonzero(np.concatenate(([True], own[1:] != own[:-1])))[0]
    return own[first], np.diff(first, append=len(own))


def packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted strings and their counts: differences, byte by byte of the numbers, compressed."""
    planes = lambda x: np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes(np.diff(codes, prepend=np.uint64(0))) + planes(counts))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(x.T).view(np.uint64).reshape(-1) for x in both)
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def packed_words(words: Counter[bytes]) -> bytes:
    counts = np.fromiter(words.values(), np.uint64, len(words)).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(counts + END.join(words))


def unpacked_words(blob: bytes, n: int) -> Iterator[tuple[bytes, int]]:
    both = zstandard.ZstdDecompressor().decompress(blob)
    return zip(both[8 * n :].split(END), np.frombuffer(both[: 8 * n], np.uint64).tolist(), strict=True)


#: Packed counts of a bucket: of ``n_words`` words, or of strings where there are none.
PACKED = "bucket int, n_words int, blob binary"


def _packed_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, n, blob = zip(*rows, strict=True)
    return pa.record_batch([pa.array(bucket, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], names=["bucket", "n_words", "blob"])


def _counter(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial counts of the task's words and strings."""
        words: Counter[bytes] = Counter()
        codes: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def of_words() -> pa.RecordBatch:
            by: dict[int, Counter[bytes]] = {}
            for w, n in words.items():
                by.setdefault(zlib.crc32(w) % buckets, Counter())[w] = n
            words.clear()
            return _packed_rows([(b, len(own), packed_words(own)) for b, own in by.items()])

        def of_strings() -> pa.RecordBatch:
            codes, n = _summed(parts)
            parts.clear()
            b = _bucket(codes, buckets).astype(np.int32)
            order = np.argsort(b, kind="stable")
            b = b[order]
            codes = codes[order]
            n = n[order]
            del order
            cut = np.nonzero(np.diff(b))[0] + 1
            blobs = [packed(c, k) for c, k in zip(np.split(codes, cut), np.split(n, cut), strict=True)]
            return _packed_rows([(x, 0, blob) for x, blob in zip(b[np.concatenate(([0], cut))].tolist(), blobs, strict=True)])

        for part in _chunks(t for b in batches for t in utf8(b.column(0))):
            for p in part:
                words.update(p.words)
            words[b""] += sum(p.last for p in part)  # the end; no word is empty
            codes.append(codes_of(part))
            if sum(map(len, codes)) >= GROUP:
                parts.append(_counted(codes))
            if len(words) > DISTINCT_WORDS:
                yield of_words()
            if sum(len(c) for c, _ in parts) > DISTINCT_STRINGS:
                parts[:] = [_summed(parts)]
                if len(parts[0][0]) > DISTINCT_STRINGS // 2:
                    yield of_strings()
        if codes:
            parts.append(_counted(codes))
        if words:
            yield of_words()
        if parts:
            yield of_strings()

    return count


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, and one row with the strings of each bucket; buckets come whole and in order."""
    now, parts = None, []
    words: Counter[bytes] = Counter()

    def whole() -> Iterator[pa.RecordBatch]:
        blob = [packed(*_summed(parts))] if parts else []
        n, m = len(words), len(blob)
        yield pa.record_batch([pa.array([*words, *[None] * m], pa.binary()), pa.array([*words.values(), *[None] * m], pa.int64()), pa.array([None] * n + [now] * m, pa.int32()), pa.array([None] * n + blob, pa.binary())], names=["word", "n", "bucket", "blob"])
        parts.clear()
        words.clear()

    for b in batches:
        for bucket, n, blob in zip(b.column("bucket").to_pylist(), b.column("n_words").to_pylist(), b.column("blob"), strict=True):
            if now is not None and bucket != now:
                yield from whole()
            now = bucket
            if n:
                for w, k in unpacked_words(blob.as_py(), n):
                    words[w] += k
                continue
            parts.append(unpacked(blob.as_py()))
            if sum(len(c) for c, _ in parts[1:]) > max(DISTINCT_STRINGS, len(parts[0][0])):
                parts[:] = [_summed(parts)]
    if now is not None:
        yield from whole()


@dataclass
class Level:
    """Strings of one depth, sorted: how often they occur, after how many different bytes, and where their suffix stands."""

    strings: np.ndarray
    n: np.ndarray
    after: np.ndarray
    suffix: np.ndarray | None = None


def shorter(longer: Level) -> Level:
    """The level one byte shorter; sets the longer one's ``suffix``."""
    s = ((longer.strings >> _16) << _8) | (longer.strings & np.uint64(255))
    strings, longer.suffix = np.unique(s, return_inverse=True)
    return Level(strings, np.bincount(longer.suffix, longer.n, len(strings)), np.bincount(longer.suffix, minlength=len(strings)).astype(np.float64))


def levels(codes: np.ndarray, n: np.ndarray, deepest: int, last: int) -> dict[int, Level]:
    out = {deepest: Level(codes, n.astype(np.float64), n.astype(np.float64))}
    for d in range(deepest - 1, last - 1, -1):
        out[d] = shorter(out[d + 1])
    return out


def discounts(of: np.ndarray) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more, from how many strings have the counts 1 to 4."""
    a, b, c, d = (max(1.0, float(x)) for x in of)
    y = a / (a + 2 * b)
    return np.concatenate(([0.0], np.clip([1 - 2 * y * b / a, 2 - 3 * y * c / b, 3 - 4 * y * d / c], 0.05, [0.95, 1.9, 2.8])))


def counts_of_counts(x: np.ndarray) -> np.ndarray:
    return np.array([(x == k).sum() for k in (1, 2, 3, 4)], np.float64)


@dataclass
class States:
    """The states of one depth with what they leave to shorter ones, and their strings with probabilities: as the
    longest state (``raw``) and as a shorter one of a longer state (``cont``)."""

    states: np.ndarray
    leave_raw: np.ndarray
    leave_cont: np.ndarray
    strings: np.ndarray
    raw: np.ndarray
    cont: np.ndarray


def smoothed(level: Level, lower: np.ndarray, lower_ml: np.ndarray | None, off: tuple[np.ndarray, np.ndarray]) -> tuple[States, np.ndarray, np.ndarray]:
    """The states of a level, each string's continuation probability from here on, and its relative frequency.

    ``lower`` is the continuation probability of each string's suffix; without ``lower_ml`` the level is the root.
    """
    context = level.strings >> _8
    start = np.nonzero(np.concatenate(([True], context[1:] != context[:-1])))[0]
    owner = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(context))))
    total = np.add.reduceat(level.n, start)
    ml = level.n / total[owner]
    is_state = np.ones(len(start), bool)
    if lower_ml is not None:
        is_state = (total >= FEWEST) & (np.add.reduceat(level.n * np.log(ml / lower_ml), start) >= DIVERGENCE)
    p, leave = [], []
    for x, of in zip((level.n, level.after), off, strict=True):
        all_of, taken = np.add.reduceat(x, start), of[np.minimum(x, 3).astype(np.int64)]
        leave.append(np.add.reduceat(taken, start) / all_of)
        p.append((x - taken) / all_of[owner] + leave[-1][owner] * lower)
    kept = is_state[owner]
    f = np.float32
    found = States(context[start][is_state], leave[0][is_state].astype(f), leave[1][is_state].astype(f), level.strings[kept], p[0][kept].astype(f), p[1][kept].astype(f))
    return found, np.where(kept, p[1], lower), ml


@dataclass
class Shallow:
    """The depths up to ``ROOT - 1``, and the discounts of all."""

    of_depth: list[States]
    strings: np.ndarray
    cont: np.ndarray
    ml: np.ndarray
    off: dict[int, tuple[np.ndarray, np.ndarray]]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: strings of depth ``ROOT - 1`` with their counts, and counts of counts (``depth`` 100 more)."""
    for b in batches:
        for blob in b.column("blob"):
            of = levels(*unpacked(blob.as_py()), DEPTH, ROOT - 1)
            rows = [(np.full(len(x.strings), d), x.strings, x.n, x.after) for d, x in of.items() if d == ROOT - 1]
            rows += [(np.full(4, 100 + d), np.arange(4), counts_of_counts(x.n), counts_of_counts(x.after)) for d, x in of.items() if d >= ROOT]
            depth, code, n, after = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.record_batch([pa.array(depth.astype(np.int32)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(after.astype(np.int64))], names=["depth", "code", "n", "after"])


def shallow(merged: DataFrame) -> Shallow:
    t = merged.select("blob").mapInArrow(_sums, "depth int, code bigint, n bigint, after bigint").groupBy("depth", "code").agg(F.sum("n").alias("n"), F.sum("after").alias("after")).toArrow()
    depth, code, n, after = (t[c].to_numpy() for c in ("depth", "code", "n", "after"))
    low = depth == ROOT - 1
    order = np.argsort(code[low])
    level = Level(code[low][order].astype(np.uint64), n[low][order].astype(np.float64), after[low][order].astype(np.float64))
    of = {ROOT - 1: level}
    for d in range(ROOT - 2, -1, -1):
        of[d] = shorter(of[d + 1])
    off = {d: (discounts(counts_of_counts(x.n)), discounts(counts_of_counts(x.after))) for d, x in of.items()}
    for d in range(ROOT, DEPTH + 1):
        at = np.nonzero(depth == 100 + d)[0]
        at = at[np.argsort(code[at])]
        off[d] = (discounts(n[at]), discounts(after[at])) if len(at) else (np.zeros(4), np.zeros(4))
    states, cont, ml = [], None, None
    for d in range(ROOT):
        x = of[d]
        if not len(x.strings):
            return Shallow([], x.strings, np.zeros(0), np.zeros(0), off)
        found, cont, ml = smoothed(x, np.full(len(x.strings), 1 / 256) if d == 0 else cont[x.suffix], None if d == 0 else ml[x.suffix], off[d])
        states.append(found)
    return Shallow(states, level.strings, cont, ml, off)


def deep_states(codes: np.ndarray, n: np.ndarray, low: Shallow) -> dict[int, States]:
    """The states of a bucket from depth ``ROOT`` on."""
    of, out = levels(codes, n, DEPTH, ROOT - 1), {}
    at = np.searchsorted(low.strings, of[ROOT - 1].strings)
    cont, ml = low.cont[at], low.ml[at]
    for d in range(ROOT, DEPTH + 1):
        out[d], cont, ml = smoothed(of[d], cont[of[d].suffix], ml[of[d].suffix], low.off[d])
    return out


STATES = "bucket int, n bigint, blob binary"


def _stater(low):
    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob"), strict=True):
                of = deep_states(*unpacked(blob.as_py()), low.value).values()
                out = zstandard.ZstdCompressor(level=1).compress(pickle.dumps([astuple(s) for s in of], 5))
                yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([sum(len(s.strings) for s in of)], pa.int64()), pa.array([out], pa.binary())], names=["bucket", "n", "blob"])

    return states


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the sorted keys, and whether the key is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def log10(of_depth: list[States], codes: np.ndarray) -> np.ndarray:
    """For each string, the log10 probability of its lowest byte after the others, from its longest suffix that is a state."""
    p, weight, first = np.full(len(codes), 1 / 256), np.ones(len(codes)), np.ones(len(codes), bool)
    left = np.arange(len(codes))
    for d in range(len(of_depth) - 1, -1, -1):
        s, c = of_depth[d], codes[left]
        context = c >> np.uint64(64 - 8 * d) if d else np.zeros(len(c), np.uint64)
        at, known = _found(s.states, context)
        own, at = left[known], at[known]
        place, seen = _found(s.strings, (context[known] << _8) | (c[known] & np.uint64(255)))
        done, place = own[seen], place[seen]
        p[done] = weight[done] * np.where(first[done], s.raw[place], s.cont[place])
        rest, at = own[~seen], at[~seen]
        weight[rest] *= np.where(first[rest], s.leave_raw[at], s.leave_cont[at])
        first[rest] = False
        open_ = np.ones(len(left), bool)
        open_[np.nonzero(known)[0][seen]] = False
        left = left[open_]
    p[left] = weight[left] / 256
    return np.log10(p)


class Head(dict):
    """Counts plus one of frequent words; 0 for all others."""

    def __missing__(self, _: bytes) -> float:
        return 0.0


@dataclass
class Model:
    """The tree in shards, each a broadcast list of ``States`` by depth; which shard a bucket is in."""

    shards: list
    shard_of: np.ndarray

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Of sorted strings; one shard at a time is in memory, and ``STEP`` strings are looked up in it at once."""
        out = np.empty(len(codes))
        own = self.shard_of[_bucket(codes, len(self.shard_of))]
        for i, shard in enumerate(self.shards):
            at = np.nonzero(own == i)[0]
            if len(at):
                for k in range(0, len(at), STEP):
                    out[at[k : k + STEP]] = log10(shard.value, codes[at[k : k + STEP]])
                if len(self.shards) > 1:
                    shard.__dict__.pop("_value", None)  # read again from the executor's own copy when it is next needed
        return out


SCORED = "part bigint, place bigint, n_tokens bigint, head_known bigint, head_base double, score double, rest array<binary>, times array<bigint>"


def _scorer(head, model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums by row, in several rows of output: of words chunk by chunk, of the tree's scores group by group."""
        task, base = int.from_bytes(os.urandom(8), "little", signed=True), 0
        for b in batches:
            ids = b.column(0)
            names = [b.schema.names[0], *[c.split()[0] for c in SCORED.split(", ")]]
            group: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            size = 0

            def out(rows: np.ndarray, *columns, ids=ids, names=names, base=base) -> pa.RecordBatch:
                return pa.record_batch([ids.take(pa.array(rows)), pa.array(np.full(len(rows), task, np.int64)), pa.array(base + rows), *columns], names=names)

            def scores(group=group) -> pa.RecordBatch:
                row, n = (np.concatenate([g[i] for g in group]) for i in (0, 1))
                codes = np.concatenate([g[2] for g in group])
                group.clear()
                order = np.argsort(codes).astype(np.int32)
                codes = codes[order]
                new = np.concatenate(([True], codes[1:] != codes[:-1]))
                codes = codes[new]
                place = np.empty(len(order), np.int32)
                place[order] = np.cumsum(new, dtype=np.int32) - 1
                del order, new
                lp, ends = model.log10(codes), np.cumsum(n)
                del codes
                sums = np.empty(len(n))
                for k, (a, z) in enumerate(zip((ends - n).tolist(), ends.tolist(), strict=True)):
                    sums[k] = lp[place[a:z]].sum()
                zero, none = np.zeros(len(row), np.int64), pa.array([[]] * len(row), pa.list_(pa.binary()))
                return out(row, pa.array(zero), pa.array(zero), pa.array(zero.astype(np.float64)), pa.array(sums), none, none.cast(pa.list_(pa.int64())))

            for part in _chunks(utf8(b.column(1))):
                row = np.fromiter((p.row for p in part), np.int64, len(part))
                group.append((row, np.fromiter((len(p.body) for p in part), np.int64, len(part)), codes_of(part)))
                tokens = [w for p in part for w in (*p.words, *([b""] if p.last else []))]
                n = np.fromiter((len(p.words) + p.last for p in part), np.int64, len(part))
                counts = np.fromiter(map(head.value.__getitem__, tokens), np.float64, len(tokens))
                owner, known = np.repeat(np.arange(len(part)), n), counts > 0
                plain = np.bincount(owner[known], np.log10(counts[known]), len(part)).astype(np.float64)
                left = np.nonzero(~known)[0]
                rest = [Counter(tokens[k] for k in own.tolist()) for own in np.split(left, np.searchsorted(owner[left], np.arange(1, len(part))))]
                yield out(row, pa.array(n), pa.array(np.bincount(owner[known], minlength=len(part)).astype(np.int64)), pa.array(plain), pa.array(np.zeros(len(part))), pa.array([list(r) for r in rest], pa.list_(pa.binary())), pa.array([list(r.values()) for r in rest], pa.list_(pa.int64())))
                size += len(group[-1][2])
                if size >= GROUP:
                    yield scores()
                    size = 0
            if group:
                yield scores()
            base += b.num_rows

    return score


def tree(merged: DataFrame, buckets: int) -> Model:
    """The model from the strings of each bucket (``bucket``, ``blob``)."""
    spark = merged.sparkSession
    low = shallow(merged)
    if not low.of_depth:
        return Model([spark.sparkContext.broadcast([])], np.zeros(buckets, np.int64))
    kept, path = written(merged.mapInArrow(_stater(spark.sparkContext.broadcast(low)), STATES), "suffix-states")
    sizes = np.zeros(buckets, np.int64)
    for r in kept.select("bucket", "n").collect():  # at most BUCKETS[1] rows
        sizes[r["bucket"]] = r["n"]
    shard_of = np.unique((np.cumsum(sizes) - sizes) // SHARD, return_inverse=True)[1]
    shards = []
    for i in range(int(shard_of[-1]) + 1):
        own = np.nonzero(shard_of == i)[0]
        shards.append(spark.sparkContext.broadcast(_shard(kept.filter(F.col("bucket").between(int(own[0]), int(own[-1]))), low)))
    removed(spark, path)
    return Model(shards, shard_of)


def _shard(rows: DataFrame, low: Shallow) -> list[States]:
    unpack = zstandard.ZstdDecompressor().decompress
    of = [pickle.loads(unpack(x.as_py())) for x in rows.select("blob").toArrow()["blob"]]
    out = list(low.of_depth)
    for d in range(DEPTH + 1 - ROOT):
        found: list[np.ndarray] = []
        for keys in (0, 3):  # states, strings
            code = np.concatenate([x[d][keys] for x in of])
            order = np.argsort(code)
            found += [code[order], *(np.concatenate([x[d][keys + k] for x in of])[order] for k in (1, 2))]
        out.append(States(*found))
    return out


def counted(texts: DataFrame) -> tuple[DataFrame, int]:
    """The staged counts of all texts (``word``, ``n``, and per bucket the packed strings), and the number of buckets."""
    buckets = min(BUCKETS[1], max(BUCKETS[0], texts.rdd.getNumPartitions()))
    partial = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counter(buckets), PACKED)
    return staged(partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merged, "word binary, n bigint, bucket int, blob binary"), "suffix-counts"), buckets


def scored(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    counts, buckets = counted(docs.filter(learn_from))
    words = counts.filter("word is not null").select("word", "n")
    model = tree(counts.filter("bucket is not null").select("bucket", "blob"), buckets)
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sums["n"] or 0, sums["v"]
    least = max(1, -(-n // HEAD))  # rounded up: at most HEAD words reach it
    top = words.filter(F.col("n") >= least).toArrow()
    head = spark.sparkContext.broadcast(Head(zip(top["word"].to_pylist(), (top["n"].to_numpy() + 1.0).tolist(), strict=True)))
    rows = staged(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_scorer(head, model), f"doc_id {kind}, {SCORED}"), "scored")
    tail = rows.select("part", "place", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("part", "place", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    # words that no text to learn from has add nothing to either sum
    found = tail.join(words.filter(F.col("n") < least), "word").select(F.lit(None).cast(kind).alias("doc_id"), "part", "place", F.lit(0).cast("bigint").alias("n_tokens"), F.col("times").alias("known"), (F.col("times") * F.log10(F.col("n") + 1.0)).alias("base"), F.lit(0.0).alias("score"))
    every = rows.select("doc_id", "part", "place", "n_tokens", F.col("head_known").alias("known"), F.col("head_base").alias("base"), "score").unionByName(found)
    of = every.groupBy("part", "place").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score")])
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return of.select("doc_id", "n_tokens", F.col("known").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")

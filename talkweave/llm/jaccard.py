"""Near-duplicates by SimHash and the exact Jaccard similarity of sets of word shingles: every pair at or over ``LEAST`` is linked.

Fingerprints of the sets come first: ``simhash`` compares them, tile by tile within pigeonhole buckets, and the pairs it
links are verified on the whole sets. Sets at ``LEAST`` may differ in more bits than pigeonhole buckets can cover, so an
exact way for the rest follows, which takes up only pairs of sets that the verified links leave apart.

There, a set's shingles are put in one order that holds for all sets. Of two sets with a similarity of at least ``LEAST``,
each has one of their common shingles among its first ``n - ceil(LEAST * n) + 1`` (prefix filter), so each set meets
all its partners in the buckets of those. Shingles frequent in a sample of the documents come last in the order,
which keeps the buckets small; the sample moves work only, as any order finds the same pairs. A bucket's pairs that
sizes, places or sketches rule out are left, and all others are verified on the whole sets. Shingles that are not
frequent in the sample move packed, many to a row. Equal sets are collapsed before any of this.

A bucket over ``SMALL`` members doesn't list its pairs at first: its members stand in an order that is random and
differs from bucket to bucket, and each meets the next ``CHAIN``. Near copies share many buckets, so the links among
these hold a large group of them together by rows in proportion to its members. Then, for exactness, such buckets list
the pairs whose sets are still apart, and only those: the bucket's most frequent component is compared with the rest,
and the rest with each other. Sides over ``BUCKET`` members are dealt over hashed parts, and every pair of parts that
has to meet is a group of its own.

Words are as in ``simhash``; a text of fewer words than a shingle has one shingle of all of them. Null and blank texts
have the empty set and are copies of each other. Rows with a null id get their set's component, but are never named as
one. Repeated rows are copies. Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import bit_set, in_bit_set, lean, removed, staged, text_batches, utf8, written
from .components import connected

SHINGLE, SEED = 5, 42
#: The least similarity, as a fraction of whole numbers.
LEAST = (4, 5)
#: Members of a bucket that are compared in one group, and of a tile.
BUCKET, TILE = 2048, 512
#: Buckets up to so many members list all their pairs; in larger ones each member first meets so many others.
SMALL, CHAIN = 16, 2
#: About so many documents are sampled for frequent shingles: those in at least so many of them.
SAMPLE, FREQUENT = 8000, 4
#: Shingles that a task packs at once, and about so many are verified in one group; rows of a group, pairs and sets.
ENTRIES, TOGETHER, ROWS = 1_000_000, 2_000_000, 4096
#: Least bits of a set's sketch.
BITS = 1024


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The hashes of a UTF-8 text's distinct shingles, sorted."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(ws), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    n = max(1, len(ws) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(size, len(ws)) - 1 :].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n))


def key(found: np.ndarray) -> int:
    """One number for a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes(), SEED)


def prefix(found: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles by which a set is found, in the common order, and how many of them are not frequent."""
    n, often = len(found), np.zeros(len(found), bool)
    if not n:
        return found, 0
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
        found = np.concatenate((found[~often], found[often]))
    m = n - -(-LEAST[0] * n // LEAST[1]) + 1
    return found[:m], min(m, n - int(often.sum()))


def sketch(found: np.ndarray) -> bytes:
    """A bit for each of so many parts of the hashes: whether the set has an odd number of shingles in it. There are at
    least ``BITS`` parts, and two or more to a shingle."""
    bits = max(BITS, 1 << (2 * len(found) - 1).bit_length())
    odd = np.bincount((found >> np.uint64(7) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ: at most the number of shingles in which the sets do. The longer one is folded."""
    x, y = (np.frombuffer(s, np.uint64) for s in sorted((a, b), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


@lean
def _briefs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches folded to ``BITS`` bits."""
    for b in _in_steps(batches):
        short = [np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, BITS // 64), 0).tobytes() for x in b.column("sketch").to_pylist()]
        yield pa.record_batch([b.column("key"), pa.array(short, pa.binary())], names=["key", "brief"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def _signed(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def _lists(x: list[np.ndarray]) -> pa.Array:
    values = np.concatenate(x) if x else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(values.view(np.int64)))


def _in_steps(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


@lean
def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _in_steps(batches):
        yield pa.record_batch([pa.array(np.concatenate([shingles(t) for t in utf8(b.column(0))]).view(np.int64))], names=["h"])


_NAMES = ["doc_id", "part", "place", "key", "n", "fp", "sketch", "common", "first", "bucket", "blob"]
FOUND = "part bigint, place bigint, key bigint, n int, fp bigint, sketch binary, common array<bigint>, first int, bucket int, blob binary"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, the first one sorted, as compressed bytes, byte by byte of the numbers."""
    first = np.diff(columns[0], prepend=np.uint64(0))
    planes = [np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T) for x in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in planes))


def unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(x.T).view(np.uint64).reshape(-1) for x in planes]
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def _finder(frequent, buckets: int):
    @lean
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document, and packed ones of the shingles by which the task's distinct sets are found."""
        part, place = int.from_bytes(os.urandom(8), "little", signed=True), 0
        entries: list[tuple[np.ndarray, int, int]] = []
        seen: set[int] = set()
        size = 0

        def pack(doc_id: pa.DataType) -> pa.RecordBatch:
            n = np.fromiter((len(h) for h, _, _ in entries), np.int64, len(entries))
            h = np.concatenate([h for h, _, _ in entries])
            keys, sizes = (np.array([e[i] for e in entries], np.uint64) for i in (1, 2))
            entries.clear()
            seen.clear()
            first, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n), dtype=np.int32), n)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((h, bucket))
            edges = _edges(bucket[order])
            blobs = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):  # one bucket's columns at a time
                x = order[a:b]
                set_ = owner[x]
                blobs.append(packed(h[x], keys[set_], sizes[set_], (x - first[set_]).astype(np.uint64)))
            of = bucket[order[edges[:-1]]]
            none = [pa.nulls(len(of), t) for t in (doc_id, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32())]
            return pa.record_batch([*none, pa.array(of), pa.array(blobs, pa.binary())], names=_NAMES)

        kind = None
        for b in _in_steps(batches):
            kind = b.column(0).type
            sets = [shingles(t) for t in utf8(b.column(1))]
            keys, found = [key(s) for s in sets], [prefix(s, frequent.value) for s in sets]
            for k, s, (h, rare) in zip(keys, sets, found, strict=True):
                if rare and k not in seen:
                    seen.add(k)
                    entries.append((h[:rare].copy(), k, len(s)))  # a view would hold the whole set
                    size += rare
            m = b.num_rows
            yield pa.record_batch(
                [b.column(0), pa.array([part] * m, pa.int64()), pa.array(range(place, place + m), pa.int64()), _signed(keys), pa.array([len(s) for s in sets], pa.int32()), _signed([simhash.fingerprint_of(s) for s in sets]), pa.array([sketch(s) for s in sets], pa.binary()),
                 _lists([h[rare:] for h, rare in found]), pa.array([rare for _, rare in found], pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=_NAMES,
            )
            place += m
            if size >= ENTRIES:
                yield pack(kind)
                size = 0
        if entries:
            yield pack(kind)

    return find


@lean
def _rare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pairs of sets that meet at a shingle that is not frequent, and the members of its large buckets, with ``h``;
    buckets come whole and in order."""
    now, blobs = None, []

    def meetings() -> pa.RecordBatch:
        h, k, n, at = (np.concatenate(c) for c in zip(*(unpacked(x, 4) for x in blobs), strict=True))
        blobs.clear()
        order = np.lexsort(((k ^ h) * np.uint64(0x9E3779B97F4A7C15), h))  # one to one for a shingle: copies stay neighbours
        h, k, n, at = h[order], k[order], n[order].astype(np.int64), at[order].astype(np.int64)
        once = np.concatenate(([True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])))  # copies in several tasks
        h, k, n, at = h[once], k[once].view(np.int64), n[once], at[once]
        edges = _edges(h)
        u, v = first_pairs(k, n, at, edges)
        often = np.nonzero(np.repeat(np.diff(edges) > SMALL, np.diff(edges)))[0]
        none, m = (lambda t: pa.nulls(len(u), t)), len(often)
        columns = [
            [pa.array(u), pa.array(k[often])], [pa.array(v), pa.nulls(m, pa.int64())], [none(pa.int64()), pa.array(h[often].view(np.int64))],
            [none(pa.int32()), pa.array(n[often].astype(np.int32))], [none(pa.int32()), pa.array(at[often].astype(np.int32))],
        ]
        return pa.record_batch([pa.concat_arrays(c) for c in columns], names=["u", "v", "h", "n", "at"])

    for b in batches:
        for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob"), strict=True):
            if now is not None and bucket != now:
                yield meetings()
            now = bucket
            blobs.append(blob.as_py())
    if now is not None:
        yield meetings()


def _sets(wanted):
    """``wanted``: a bit set by row hash; a few rows more than those asked for may have their bits set."""
    @lean
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _in_steps(batches):
            own = b.column(1).filter(in_bit_set(wanted.value, b.column(0)))
            if len(own):
                found = [shingles(t) for t in utf8(own)]
                yield pa.record_batch([_signed([key(s) for s in found]), _lists(found)], names=["key", "shingles"])

    return sets


def _possible(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles with a common one at places ``at`` and ``to`` can be similar."""
    most = 1 + np.minimum(at, to) + np.minimum(n - at, m - to) - 1
    return sum(LEAST) * most >= LEAST[0] * (n + m)


def candidates(keys: np.ndarray, n: np.ndarray, at: np.ndarray, parts: np.ndarray, comps: np.ndarray, briefs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket from different components that sizes, the places of its shingle and short sketches leave possible.

    With two ``parts``, pairs within one part are left to that part's own group.
    """
    order = np.argsort(n, kind="stable")
    k, n, at, side, comp, brief = keys[order], n[order], at[order], parts[order], comps[order], briefs[order]
    two = side.min() != side.max()
    us, vs = [], []
    for a in range(0, len(k), TILE):
        x = slice(a, a + TILE)
        for b in range(a, len(k), TILE):
            y = slice(b, b + TILE)
            if LEAST[0] * n[b] > LEAST[1] * n[x][-1]:
                break  # sorted: every later tile is farther
            near = _possible(n[x, None], at[x, None], n[None, y], at[None, y]) & (comp[x, None] != comp[None, y])
            if two:
                near &= side[x, None] != side[None, y]
            i, j = np.nonzero(np.triu(near, 1) if a == b else near)
            i, j = i + a, j + b
            far = np.bitwise_count(brief[i] ^ brief[j]).sum(1, dtype=np.int64)
            keep = far * sum(LEAST) <= (LEAST[1] - LEAST[0]) * (n[i] + n[j])
            us.append(k[i[keep]])
            vs.append(k[j[keep]])
    return np.concatenate(us), np.concatenate(vs)


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where groups of equal values begin, and the end of the last."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return np.append(np.nonzero(new)[0], len(new))


def _once(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, v = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    return u[new], v[new]


def first_pairs(k: np.ndarray, n: np.ndarray, at: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct possible pairs: all of small groups; in larger ones each member with the next ``CHAIN``."""
    sizes = np.diff(edges)
    left = np.repeat(edges[1:], sizes) - np.arange(len(k))  # members from here on
    most = np.repeat(np.where(sizes <= SMALL, SMALL - 1, CHAIN), sizes)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, max(SMALL, CHAIN + 1)):
        i = np.nonzero((left > d) & (most >= d))[0]
        i = i[_possible(n[i], at[i], n[i + d], at[i + d])]
        us.append(k[i])
        vs.append(k[i + d])
    return _once(np.concatenate(us), np.concatenate(vs))


def _whole(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and where these begin and end; groups come in order, the last of a batch waits for the next."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        edges = _edges(*(t[c].to_numpy() for c in by)) if len(t) else np.zeros(1, np.int64)
        last = int(edges[-2]) if len(edges) > 1 else 0
        if last:
            yield t.slice(0, last), edges[:-1]
        rest = t.slice(last).combine_chunks()
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


@lean
def _common_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pairs of frequent shingles' buckets or parts of them."""
    for t, edges in _whole(batches, ("h", "part")):
        u, v = first_pairs(t["key"].to_numpy(), *(t[c].to_numpy().astype(np.int64) for c in ("n", "at")), edges)
        yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])


@lean
def _other_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs of different components of each group."""
    for t, edges in _whole(batches, ("h", "lo", "hi")):
        columns = [t[c].to_numpy().astype(np.int64) for c in ("key", "n", "at", "part", "comp")]
        columns.append(np.frombuffer(b"".join(t["brief"].to_pylist()), np.uint64).reshape(-1, BITS // 64))
        u, v = zip(*(candidates(*(c[a:b] for c in columns)) for a, b in zip(edges[:-1], edges[1:], strict=True)), strict=True)
        u, v = _once(np.concatenate(u), np.concatenate(v))
        yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])


@lean
def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sketches leave possible; a group's sketches come before its pairs, groups whole and in order."""
    now, known = None, {}
    for b in _in_steps(batches, 1024):
        groups = zip(*(b.column(c).to_pylist() for c in ("component", "lo", "hi")), strict=True)
        us, vs = [], []
        for group, u, v, n, s in zip(groups, *(b.column(c).to_pylist() for c in ("u", "v", "n", "sketch")), strict=True):
            if group != now:
                now, known = group, {}
            if v is None:
                known[u] = n, s
                continue
            (n, x), (m, y) = known[u], known[v]
            if apart(x, y) * sum(LEAST) <= (LEAST[1] - LEAST[0]) * (n + m):
                us.append(u)
                vs.append(v)
        yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


@lean
def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the true links of each group, whose sets come before its pairs; groups come whole and in order."""
    now, sets, root = None, {}, {}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for b in _in_steps(batches):
        groups = zip(*(b.column(c).to_pylist() for c in ("component", "lo", "hi")), strict=True)
        found = []
        for group, u, v, s in zip(groups, b.column("u").to_pylist(), b.column("v").to_pylist(), b.column("shingles"), strict=True):
            if group != now:
                now, sets, root = group, {}, {}
            if v is None:
                sets[u], root[u] = s.values.to_numpy(), u
            elif (x := top(u)) != (y := top(v)) and similar(sets[u], sets[v]):
                root[max(x, y)] = min(x, y)
                found.append((u, v))
        if found:
            u, v = zip(*found, strict=True)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _groups(pairs: DataFrame, weights: DataFrame, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Pairs with the group that compares them, which sets each group needs (``component``, ``lo``, ``hi``, ``key``), and
    the folders of these.

    Pairs that hang together are compared together, so that a set or sketch moves once however many pairs it is in; a
    component of over ``TOGETHER`` of ``weights`` (``key``, ``n``: its 64-bit numbers), or whose pairs would make groups
    of over ``ROWS`` rows, is dealt over hashed parts, and each pair of parts is a group: of p pairs in k parts, about
    2p/k² and at most twice as many sets each. A set moves at most once for each of its pairs, however many parts there
    are. Pairs within a component of ``before`` (``node``, ``component``) are left out.
    """
    degree = pairs.groupBy(F.col("u").alias("key")).agg(F.count(F.lit(1)).alias("pairs"))
    of = connected(pairs).join(weights, F.col("node") == F.col("key")).join(degree, "key", "left").select("key", "component", "n", "pairs")
    parts = F.greatest(F.sum("n") / TOGETHER, F.sqrt(F.coalesce(F.sum("pairs"), F.lit(0)) * 6 / ROWS))
    total = of.groupBy("component").agg(F.ceil(parts).cast("int").alias("of"))
    part = F.pmod(F.xxhash64("key", F.lit(11)), F.greatest(F.lit(1), F.col("of"))).cast("int")
    placed = of.join(total, "component").select("key", "component", part.alias("part"))
    if before is not None:
        placed = placed.join(before.select(F.col("node").alias("key"), F.col("component").alias("found")), "key", "left")
    found = F.col("key") if before is None else F.coalesce("found", "key")
    placed, of_placed = written(placed.withColumn("found", found), "pair-groups", 8)
    at = lambda end: placed.select(F.col("key").alias(end), *([F.col("component")] if end == "u" else []), F.col("part").alias(f"part_{end}"), F.col("found").alias(f"found_{end}"))
    grouped = pairs.join(at("u"), "u").join(at("v"), "v").filter("found_u <> found_v").select("component", F.least("part_u", "part_v").alias("lo"), F.greatest("part_u", "part_v").alias("hi"), "u", "v")
    grouped, of_grouped = written(grouped, "grouped-pairs", 8)
    return grouped, grouped.select("component", "lo", "hi", F.explode(F.array("u", "v")).alias("key")).distinct(), [of_placed, of_grouped]


def _together(grouped: DataFrame, needed: DataFrame, of: DataFrame) -> DataFrame:
    """The groups' rows as ``_near`` and ``_verified`` take them: columns of ``of`` (by ``key``) before the pairs."""
    columns = [c for c in of.columns if c != "key"]
    own = needed.join(of, "key").select("component", "lo", "hi", F.col("key").alias("u"), F.lit(None).cast("bigint").alias("v"), *columns)
    both = own.unionByName(grouped, allowMissingColumns=True)
    return both.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", F.col("v").asc_nulls_first())


def _parts(members: Column) -> Column:
    """Over how many parts so many members of a bucket are dealt."""
    return F.when(members > BUCKET, F.ceil(members * 2 / BUCKET)).otherwise(F.lit(1)).cast("int")


def _apart(often: DataFrame, comps: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of members of large buckets (``h``, ``key``, ``n``, ``at``) that are in different components."""
    own = often.join(comps.withColumnRenamed("node", "key"), "key", "left")
    own = staged(own.select("h", "key", "n", "at", F.coalesce("component", "key").alias("comp")), "large-buckets", 8)
    sizes = own.groupBy("h", "comp").count().groupBy("h").agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.max("count").alias("majors"), F.sum("count").alias("members"))
    mixed = sizes.filter("members > majors").select("h", "major", _parts(F.col("members") - F.col("majors")).alias("few"), _parts(F.col("majors")).alias("many"))
    of_major, deal = F.col("comp") == F.col("major"), F.xxhash64("key", F.lit(7))
    part = F.when(of_major, F.col("few") + F.pmod(deal, F.col("many"))).otherwise(F.pmod(deal, F.col("few"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(of_major, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1))
    mixed = staged(own.join(mixed, "h"), "mixed-buckets", 8)
    brief = mixed.select("key").distinct().join(marks.select("key", "sketch"), "key").mapInArrow(_briefs, "key bigint, brief binary")
    dealt = mixed.join(brief, "key").withColumn("part", part).withColumn("other", other)
    group = ["h", "lo", "hi"]
    keyed = dealt.select("h", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "key", "n", "at", "comp", "brief")
    return keyed.repartition(*group).sortWithinPartitions(*group).mapInArrow(_other_pairs, "u bigint, v bigint")


def _by_fingerprint(marks: DataFrame) -> DataFrame:
    """Pairs of sets whose fingerprints link: those of one fingerprint meet the least of them, and these along a forest."""
    named = staged(marks.groupBy("fp").agg(F.min("key").alias("rep")), "set-fingerprints", 8)
    same = marks.join(named, "fp").filter("key <> rep").select(F.col("rep").alias("u"), F.col("key").alias("v"))
    return _ordered(same.unionByName(simhash.links(named, named.count())))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _links(meetings: DataFrame, rows: DataFrame, distinct: DataFrame, marks: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Enough of the true links among the pairs to hold together, with the components found ``before``, what all of them do."""
    spark = rows.sparkSession
    meeting, path = written(meetings.distinct(), "meeting-pairs", 8)
    # bits in which two sketches differ are at most the shingles in which the sets do
    grouped, needed, done = _groups(meeting, marks.select("key", F.ceil(F.octet_length("sketch") / 8).alias("n")), before)
    pairs, pairs_folder = written(_together(grouped, needed, marks.select("key", "n", "sketch")).mapInArrow(_near, "u bigint, v bigint"), "candidate-pairs", 8)
    for folder in (path, *done):
        removed(spark, folder)
    if pairs.isEmpty():
        return pairs
    ids = pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct().join(distinct, "key").select(F.xxhash64("rep").alias("h"))
    taken = rows.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(_sets(spark.sparkContext.broadcast(bit_set(ids))), "key bigint, shingles array<bigint>")
    with text_batches(spark):
        sets, path = written(taken, "candidate-sets", 8)
    once = sets
    if not sets.groupBy("key").count().filter("count > 1").isEmpty():  # of null or repeated ids
        once = sets.dropDuplicates(["key"])
    grouped, needed, done = _groups(pairs, marks.select("key", "n"))
    links = staged(_together(grouped, needed, once).mapInArrow(_verified, "u bigint, v bigint"), "links", 8)
    for folder in (pairs_folder, path, *done):
        removed(spark, folder)
    return links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``key``, ``component``) for every row: the least id reachable over links, itself included."""
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    one_in = max(1, rows.count() // SAMPLE)
    often = rows.filter(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).select("text").distinct().mapInArrow(_sampled, "h bigint").groupBy("h").count().filter(F.col("count") >= FREQUENT).select("h").toArrow()
    frequent = spark.sparkContext.broadcast(np.sort(often["h"].to_numpy().view(np.uint64)))
    buckets = max(256, min(1 << 16, rows.rdd.getNumPartitions()))
    with text_batches(spark):
        every, every_folder = written(rows.mapInArrow(_finder(frequent, buckets), f"doc_id {kind}, {FOUND}"), "shingle-sets")
    found, rare = every.filter("key is not null").drop("bucket", "blob"), every.filter("bucket is not null").select("bucket", "blob")
    distinct = staged(found.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min(F.struct("part", "place")).alias("row")), "distinct-sets", 8)
    firsts = found.join(distinct.select("key", "row.part", "row.place"), ["key", "part", "place"], "left_semi")
    marks, marks_folder = written(firsts.select("key", "n", "fp", "sketch"), "sketches", 8)
    common = firsts.filter(F.size("common") > 0).select("key", "n", "first", F.posexplode("common").alias("at", "h")).withColumn("at", F.col("first") + F.col("at"))
    entries, entries_folder = written(common.join(common.groupBy("h").agg(F.count(F.lit(1)).alias("of")).filter("of > 1"), "h").select("h", "key", "n", "at", "of"), "common-shingles", 8)
    mixed = F.xxhash64("key", "h")
    dealt = entries.select("h", F.pmod(mixed, _parts(F.col("of"))).cast("int").alias("part"), F.xxhash64(mixed).alias("mixed"), "key", "n", "at")
    of_common = dealt.repartition("h", "part").sortWithinPartitions("h", "part", "mixed").mapInArrow(_common_pairs, "u bigint, v bigint")
    of_rare, rare_folder = written(rare.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_rare_pairs, "u bigint, v bigint, h bigint, n int, at int"), "rare-shingles", 8)
    keys = staged(found.select("doc_id", "key"), "row-keys", 8)
    removed(spark, every_folder)
    links = _links(_by_fingerprint(marks), rows, distinct, marks)
    meetings = of_common.unionByName(of_rare.filter("v is not null").select("u", "v"))
    links = links.unionByName(_links(meetings, rows, distinct, marks, connected(links)))
    large = entries.filter(F.col("of") > SMALL).select("h", "key", "n", "at").unionByName(of_rare.filter("v is null").select("h", F.col("u").alias("key"), "n", "at"))
    links = links.unionByName(_links(_apart(large, connected(links), marks), rows, distinct, marks))
    for folder in (marks_folder, entries_folder, rare_folder):
        removed(spark, folder)
    comps = connected(links)
    classes = distinct.select("key", "rep").join(comps, distinct["key"] == comps["node"], "left").select("key", "rep", F.coalesce("component", "key").alias("class"))
    named = classes.join(classes.groupBy("class").agg(F.min("rep").alias("component")), "class").select("key", "component")
    return keys.join(named, "key").select("doc_id", "key", "component")

"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a small Hamming distance, exactly.

Fingerprints that differ in at most ``radius`` of 64 bits agree entirely in some choice of bands (pigeonhole): cut
into ``radius + spare`` bands, they agree in at least ``spare`` of them. Each distinct fingerprint therefore meets
its partners in a bucket for each choice of ``spare`` bands. Within a bucket, numpy compares tiles of fingerprints
sorted by population count, by exclusive-or and bit counts, skipping tile pairs whose counts differ beyond the
radius. A bucket over ``BUCKET`` members is cut into tiles by population count and hash beforehand, and every pair of
tiles whose counts are within the radius is a group of its own, so no task holds more than a bounded number. A group emits a spanning forest of its links, never all pairs: that
keeps every connection. Exact copies have one fingerprint and are collapsed before any of this.

Null and blank texts have fingerprint zero, linked like any other. Rows with a null id link others as any row does and
get their component, but never name one; a component of such rows alone is null. Repeated rows and ties are copies. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, utf8
from .components import connected

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Members of a bucket (or of each half of a dealt one) that are compared in one group, and of a tile.
BUCKET, TILE = 4096, 512
#: Bits of a text's shingles that are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the shingles' hashes."""
    ws = text.lower().split()
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    joined, digest = b" ".join(ws), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(shingle, len(ws)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        votes += _votes(np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK], strict=True)), np.uint64, min(CHUNK, n - at)))
    return _majority(votes, n)


def _votes(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(votes: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of shingles given by their hashes; zero for none."""
    return _majority(sum((_votes(hashes[at : at + CHUNK]) for at in range(0, len(hashes), CHUNK)), np.zeros(64, np.int64)), len(hashes))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.fromiter(map(fingerprint, utf8(b.column(1))), np.uint64, b.num_rows)
        yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``): the fingerprint as a signed 64-bit number."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_fingerprints, f"doc_id {kind}, fp bigint")


def _bands(n: int) -> list[int]:
    """Masks of ``n`` nearly equal bands of 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]


def _spare(n_distinct: int, radius: int) -> int:
    """How many bands must agree: the fewest for which a bucket of random fingerprints stays near a tile.

    It only moves work between comparing and shuffling; the links are the same for every value.
    """
    spare = 1
    while spare < 4 and n_distinct >> (64 * spare // (radius + spare)) > TILE // 2:
        spare += 1
    return spare


def _masks(spare: int, radius: int) -> list[int]:
    return [sum(c) for c in combinations(_bands(radius + spare), spare)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, parts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fps``, as (member, root) positions.

    Pairs are compared tile by tile. With two ``parts``, pairs within one part are left to that part's own group.
    """
    order = np.argsort(np.bitwise_count(fps), kind="stable")
    f, side = fps[order], parts[order]
    pop = np.bitwise_count(f).astype(np.int64)
    two = side.min() != side.max()
    root = np.arange(len(f))
    for a in range(0, len(f), TILE):
        x, px = f[a : a + TILE], pop[a : a + TILE]
        for b in range(a, len(f), TILE):
            if pop[b] - px[-1] > radius:
                break  # sorted: every later tile is farther
            near = np.bitwise_count(x[:, None] ^ f[None, b : b + TILE]) <= radius
            if two:
                near &= side[a : a + TILE, None] != side[None, b : b + TILE]
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            while True:
                ri, rj = root[i], root[j]
                open_ = ri != rj
                if not open_.any():
                    break
                i, j, ri, rj = i[open_], j[open_], ri[open_], rj[open_]
                root[np.maximum(ri, rj)] = np.minimum(ri, rj)
                while not np.array_equal(up := root[root], root):
                    root = up
    member = np.nonzero(root != np.arange(len(f)))[0]
    return order[member], order[root[member]]


def _linker(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come whole and in order; the last of a batch waits for the next batch."""
        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            key = t.select(["mask_no", "bucket", "lo", "hi"])
            cols = [c.to_numpy() for c in key.columns]
            new = np.zeros(len(t), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            cut = np.nonzero(new)[0]
            last = int(cut[-1]) if len(cut) else 0
            if last:
                yield from groups(t.slice(0, last), cut[:-1])
            rest = t.slice(last).combine_chunks()
        if rest is not None and len(rest):
            yield from groups(rest, np.array([], int))

    def groups(t: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        fps, reps, parts = t["fp"].to_numpy().view(np.uint64), t["rep"], t["part"].to_numpy()
        edges = np.concatenate(([0], cuts, [len(t)]))
        us, vs = [], []
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                u, v = forest(fps[a:b], parts[a:b], radius)
                us.append(u + a)
                vs.append(v + a)
        if us:
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.record_batch([reps.take(pa.array(u)).combine_chunks(), reps.take(pa.array(v)).combine_chunks()], names=["u", "v"])

    return link


def links(distinct: DataFrame, n_distinct: int, radius: int = RADIUS) -> DataFrame:
    """Edges (``u``, ``v``) between the ``rep`` values of distinct fingerprints (``fp``, ``rep``) within the radius.

    The edges are a forest per bucket: their components are those of all links.
    """
    masks = _masks(_spare(n_distinct, radius), radius)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("mask_no"), F.col("fp").bitwiseAND(_signed(m)).alias("bucket")) for i, m in enumerate(masks)]))
    entries = distinct.select("fp", "rep", each.alias("b")).select("fp", "rep", "b.mask_no", "b.bucket")
    # a bucket over the limit is cut into tiles: by population count, and by hash where a count has too many members.
    # Tiles whose counts differ by more than the radius never meet; every other pair of tiles is a group
    pop = F.bit_count("fp")
    sizes = entries.groupBy("mask_no", "bucket", pop.alias("pop")).agg(F.count(F.lit(1)).alias("n"))
    tiles = F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") * 2 / BUCKET).cast("int"))))
    large = sizes.groupBy("mask_no", "bucket").agg(F.sum("n").alias("n"), tiles.alias("tiles")).filter(F.col("n") > BUCKET).drop("n")
    dealt = entries.join(large, ["mask_no", "bucket"], "left").withColumn("pop", pop)
    tile = lambda p, i: (p * F.lit(1 << 24) + i).cast("int")
    own = F.coalesce(tile(F.col("pop"), F.pmod(F.xxhash64("fp", F.lit(7)), F.try_element_at("tiles", F.col("pop")))), F.lit(0))
    met = F.flatten(F.transform(F.sequence(F.col("pop") - radius, F.col("pop") + radius), lambda p: F.transform(F.sequence(F.lit(0), F.coalesce(F.try_element_at("tiles", p), F.lit(0))), lambda i: F.when(i < F.try_element_at("tiles", p), tile(p, i)))))
    others = F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.filter(met, lambda t: t.isNotNull()))
    pairs = dealt.withColumn("part", own).withColumn("other", F.explode(others))
    keyed = pairs.select("mask_no", "bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "fp", "rep")
    kind = distinct.schema["rep"].dataType.simpleString()
    key = ["mask_no", "bucket", "lo", "hi"]
    return keyed.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(radius), f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``, ``component``) for every row: the least id reachable over links, itself included."""
    fps = staged(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints", 8)
    comps = connected(links(distinct.select("fp", F.col("fp").alias("rep")), distinct.count(), radius))
    linked = distinct.join(comps, distinct["fp"] == comps["node"]).select("fp", "least", F.col("component").alias("class"))
    named = staged(linked.join(linked.groupBy("class").agg(F.min("least").alias("name")), "class").select("fp", "name"), "named-fingerprints", 8)
    classes = distinct.join(named, "fp", "left").select("fp", F.coalesce("name", "least").alias("component"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component")


def as_hex(fp: Column) -> Column:
    """A signed 64-bit number as 16 lowercase hexadecimal digits of the unsigned one."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

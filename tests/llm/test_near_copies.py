"""The pipeline's near-duplicate stage against all pairs by exact five-word Jaccard similarity."""

import os
import random
import subprocess
import sys
from collections import Counter
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pyarrow as pa

from talkweave.llm import jaccard, simhash


def plain(rows):
    """(id, text) to the least id of each component of pairs at 0.8 or over."""
    def shingles(text):
        ws = text.lower().split()
        return {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    sets, least = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows}
    for a, x in sets:
        for b, y in sets:
            if a < b and 5 * len(x & y) >= 4 * len(x | y) and least[a] != least[b]:
                low, high = sorted((least[a], least[b]))
                least = {i: low if c == high else c for i, c in least.items()}
    return least


def edited(rng):
    """Texts and copies of them with one to twelve words changed, some below and some above 0.8."""
    rows = []
    for _ in range(12):
        ws = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((3, 30, 120)))]
        rows.append((len(rows), " ".join(ws)))
        for edits in (1, 2, 4, 6, 8, 12):
            copy = list(ws)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy)))
    return [*rows, (len(rows), ""), (len(rows) + 1, " ")]


def test_stage_drops_copies_at_four_fifths(spark, sf, monkeypatch):
    rows = edited(random.Random(3))
    expect = plain(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert kept == {i for i, c in expect.items() if i == c} and 12 < len(kept) < len(rows)
    monkeypatch.setattr(jaccard, "BUCKET", 2)  # every bucket is dealt
    monkeypatch.setattr(jaccard, "TOGETHER", 100)
    assert {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()} == expect


def test_table_equals_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expect = plain([(r.doc_id, r.text or "") for r in docs.collect()])
    assert {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()} == expect


def test_large_groups_of_near_copies(spark):
    """Groups over SMALL, so large that not all of their pairs are listed at first; some copies are only reached through others."""
    rng, rows = random.Random(5), []
    for _ in range(2):
        ws = [f"w{rng.randrange(5000)}" for _ in range(80)]
        for edits in range(120):
            copy = list(ws)
            for _ in range(1 + edits % 3):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy)))
        for _ in range(30):  # a drifting chain
            copy[rng.randrange(len(copy))] = f"y{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy)))
    expect = plain(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()} == expect
    assert max(Counter(expect.values()).values()) > 2 * jaccard.SMALL  # the fixture has a group of the size meant


def test_fingerprints_link_first(spark, monkeypatch):
    """The stage's first pairs are those that SimHash links; what they hold together isn't compared again."""
    rng, rows = random.Random(7), []
    for _ in range(6):
        ws = [f"w{rng.randrange(5000)}" for _ in range(400)]
        for edits in range(5):
            copy = list(ws)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy)))
    docs, met, links = spark.createDataFrame(rows, "doc_id bigint, text string"), [], jaccard._links

    def spied(meetings, *others):
        meetings = meetings.cache()
        met.append({(r.u, r.v) for r in meetings.collect()})
        return links(meetings, *others)

    monkeypatch.setattr(jaccard, "_links", spied)
    assert {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()} == plain(rows)
    sets = [jaccard.shingles(t.encode()) for _, t in rows]
    fps = {jaccard._signed([jaccard.key(s)])[0].as_py(): simhash.fingerprint_of(s) for s in sets}
    assert len(met) == 3 and met[0]
    near = {frozenset((a, b)) for a in fps for b in fps if a != b and (fps[a] ^ fps[b]).bit_count() <= simhash.RADIUS}
    root = {k: k for k in fps}  # the pairs met hold together what all near fingerprints do
    for pairs in (met[0], near):
        own = dict(root)
        for _ in fps:
            for u, v in map(tuple, pairs):
                own[u] = own[v] = min(own[u], own[v])
        assert pairs is not near or own == first
        first = own


def test_fingerprint_of_hashes():
    text = b"one two three four five six one two three four five"
    hashes = [jaccard.xxhash.xxh64_intdigest(b" ".join(text.split()[i : i + 5]), simhash.SEED) for i in range(7)]
    assert simhash.fingerprint_of(jaccard.np.array(hashes, jaccard.np.uint64)) == simhash.fingerprint(text, 5) and simhash.fingerprint_of(jaccard.shingles(b"")) == 0


#: A worker's own memory, in MB, after a first short task and after a longer one, as the check tool counts it.
TASKS = r"""
import re
from types import SimpleNamespace
import numpy as np
import pyarrow as pa
from talkweave.llm import jaccard

def own():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def task(n):
    rng = np.random.default_rng(1)
    for _ in jaccard._finder(SimpleNamespace(value=np.ones(1, np.uint64)), 256)(
        pa.record_batch([pa.array(range(2500)), pa.array([" ".join(map(str, rng.integers(0, 1 << 30, 300).tolist())) for _ in range(2500)])], names=["doc_id", "text"]) for _ in range(n)
    ):
        pass
    return own()

print(task(1), task(5))
"""


def test_a_task_gives_its_memory_back():
    first, then = map(float, subprocess.run([sys.executable, "-c", TASKS], env=os.environ, capture_output=True, text=True, check=True, timeout=120).stdout.split())
    assert then - first < 30


def test_packed_shingles_are_those_of_the_sets(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(rng.choice((2, 40, 400)))) for _ in range(300)]
    texts += texts[:50]
    frequent = np.unique(np.concatenate([jaccard.shingles(t.encode())[::7] for t in texts[:40]]))
    monkeypatch.setattr(jaccard, "ENTRIES", 3000)
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = Counter()
    for b in jaccard._finder(SimpleNamespace(value=frequent), 16)(iter([batch])):
        for of, blob in zip(b.column("bucket").to_pylist(), b.column("blob").to_pylist(), strict=True):
            if of is not None:
                h, *rest = (c.tolist() for c in jaccard.unpacked(blob, 4))
                assert h == sorted(h) and all(x % 16 == of for x in h)
                got.update(zip(h, *rest, strict=True))
    want = set()
    for t in texts:
        s = jaccard.shingles(t.encode())
        found, rare = jaccard.prefix(s, frequent)
        want |= {(int(h), jaccard.key(s), len(s), i) for i, h in enumerate(found[:rare])}
    assert set(got) == want


def test_a_large_component_is_dealt_by_its_pairs(spark, monkeypatch):
    """Light sets, many pairs: no group holds much more than its share, and each pair and its two sets meet in one group."""
    monkeypatch.setattr(jaccard, "ROWS", 400)
    rng = random.Random(9)
    large = {tuple(sorted(rng.sample(range(600), 2))) for _ in range(2000)}
    small = {(1000 + 2 * i, 1001 + 2 * i) for i in range(50)}
    pairs = spark.createDataFrame(sorted(large | small), "u bigint, v bigint")
    weights = spark.createDataFrame([(k, 10) for k in {x for p in large | small for x in p}], "key bigint, n int")
    grouped, needed, _ = jaccard._groups(pairs, weights)
    got, sets = grouped.collect(), {tuple(r) for r in needed.collect()}
    assert sorted((r.u, r.v) for r in got) == sorted(large | small)
    assert all((r.component, r.lo, r.hi, x) in sets for r in got for x in (r.u, r.v))
    rows = Counter((r.component, r.lo, r.hi) for r in got) + Counter(s[:3] for s in sets)
    assert max(rows.values()) < 1.5 * jaccard.ROWS and len([g for g in rows if g[0] < 1000]) > 10 and len([g for g in rows if g[0] >= 1000]) == 50

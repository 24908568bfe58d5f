"""The suffix tree against one in plain Python, as a distribution, and in shards, pieces and small chunks."""

import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkweave.llm import suffix_lm
from talkweave.llm.common import remainder


def texts():
    rng = random.Random(4)
    syllables = ["ka", "to", "ri", "men", "sul", "é"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(40)]
    return [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(40)] + [None, "", " x  Y\n", "a phrase that occurs twice in here", "a phrase that occurs twice in here"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts())), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def expect():
    rows = list(enumerate(texts()))
    p = plain.suffix_tree([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    return {i: plain.suffix_score(p, t) for i, t in rows}


@pytest.mark.parametrize("small", [{}, {"SHARD": 10}, {"CHUNK": 64, "GROUP": 200, "DISTINCT_STRINGS": 300, "DISTINCT_WORDS": 20, "BUCKETS": (7, 7)}])
def test_scores_equal_a_plain_tree(docs, expect, monkeypatch, small):
    for name, value in small.items():
        monkeypatch.setattr(suffix_lm, name, value)
    got = {r.doc_id: r.score for r in suffix_lm.scored(docs, remainder(F.col("doc_id"), 7) != 2).collect()}
    assert got == pytest.approx(expect, abs=1e-4)


def model_of(docs):
    counts, buckets = suffix_lm.counted(docs.select("text"))
    return suffix_lm.tree(counts.filter("bucket is not null").select("bucket", "blob"), buckets)


def test_is_a_distribution(docs, monkeypatch):
    monkeypatch.setattr(suffix_lm, "SHARD", 10)
    model = model_of(docs)
    assert len(model.shards) > 3
    for context in (b"\n" * 7, b"phrase ", b"qqqqqqq", b"xx kato", b" to ri "):
        codes = np.uint64(int.from_bytes(context[::-1], "big") << 8) | np.arange(256, dtype=np.uint64)
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1.0, abs=1e-5)


def test_all_texts_of_a_length_are_at_most_one():
    """Over words: every string of up to three letters out of two, each with its end."""
    p = plain.suffix_tree(["a b ab", "ab ba", "b"])
    strings = [""] + ["".join(x) for n in (1, 2, 3) for x in __import__("itertools").product("ab ", repeat=n) if "".join(x) == " ".join("".join(x).split())]
    assert sum(10 ** plain.suffix_score(p, s) for s in strings) <= 1.0


def test_a_rare_context_of_a_large_input_is_a_state(spark):
    rows = [("a" * 60,)] * 300 + [("xbcdefgh",)] * 20 + [("ybcdefgw",)] * 20
    model = model_of(spark.createDataFrame(rows, "text string"))
    states = np.concatenate([s.value[7].states for s in model.shards])
    assert int.from_bytes(b"xbcdefg"[::-1], "big") in states.tolist()


def test_the_tree_beats_the_unigrams_on_texts_held_out(spark, sf):
    """The base gives each of endlessly many unseen words a share; on a large enough input a true distribution is still better."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/documents.parquet")
    held = suffix_lm.scored(docs, remainder(F.col("doc_id"), 7) != 2).filter(remainder(F.col("doc_id"), 7) == 2)
    r = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert r.score > 0.95 * r.base


def test_codes_and_pieces():
    part = list(suffix_lm.pieces([b"AB c", b"", b" xyz\t"]))
    whole = [b"ab c\n", b"\n", b"xyz\n"]
    assert [p.body for p in part] == whole
    expect = [int.from_bytes((b"\n" * 7 + t)[k : k + 7][::-1], "big") << 8 | t[k] for t in whole for k in range(len(t))]
    code = suffix_lm.codes_of(part)
    assert code.tolist() == expect
    words = plain.Counter({b"": 3, b"ab": 2})
    assert dict(suffix_lm.unpacked_words(suffix_lm.packed_words(words), 2)) == words
    codes, n = np.array([3, 5, 2**63], np.uint64), np.array([1, 70000, 2])
    assert [x.tolist() for x in suffix_lm.unpacked(suffix_lm.packed(codes, n))] == [codes.tolist(), n.tolist()]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_lm, "CHUNK", 10)
    text = b"  one two three\n\n\n      four " + b"x" * 50 + b" five   "
    part = list(suffix_lm.pieces([text]))
    assert len(part) > 3 and b"".join(p.body for p in part) == plain.normal(text.decode()) and all(len(p.before) == 7 for p in part)
    assert [w for p in part for w in p.words] == text.split()


def test_a_worker_holds_little_beside_its_groups():
    """Peak bytes while strings are counted, and while a group of four megabytes of text is scored."""
    rng = np.random.default_rng(3)
    batch = pa.record_batch([pa.array(range(40)), pa.array([" ".join(map("".join, rng.choice(list("abcdefghij"), (12_000, 8)))) for _ in range(40)])], names=["doc_id", "text"])

    def peak(rows):
        tracemalloc.start()
        for _ in rows:
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    group = 8 * sum(len(t) + 1 for t in batch["text"].to_pylist())  # bytes of the strings' codes
    none = np.zeros(0)
    model = suffix_lm.Model([SimpleNamespace(value=[suffix_lm.States(none.astype(np.uint64), none, none, none.astype(np.uint64), none, none)] * 8)], np.zeros(256, np.int64))
    assert peak(suffix_lm._counter(256)(iter([batch.select(["text"])]))) < 7 * group
    assert peak(suffix_lm._scorer(SimpleNamespace(value=suffix_lm.Head()), model)(iter([batch]))) < 7 * group

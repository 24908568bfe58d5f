"""Byte-level BPE, cross-tokenizer alignment and the source audit against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talkweave.llm import alignment, byte_bpe, divergence
from talkweave.llm.common import text_batches
from talkweave.llm.vocabularies import cut, ranks_of, vocabulary

WORDS = "the quick  brown\nfox \t jumps 12345 don't we'll naïve Ünïcode 日本語 テキスト 😀👍🏽 — … <|endoftext|> <0x0A> </s> ▁ ﬁ é \x00  　 \r\n a'b ''' === ++x".split(" ")
TEXTS = [None, "", " ", "\n", "  two  spaces  ", "one", " lead", "trail ", "aaaa" * 500, "▁", "日本語テキスト" * 40, "😀" * 30 + " x", "x \n y", " ".join(WORDS), " ".join(WORDS)]


def texts():
    rng = random.Random(5)
    mixed = ["".join(rng.choice([w, w + " ", " " + w]) for w in rng.choices(WORDS, k=rng.randrange(40))) for _ in range(150)]
    faithful = [w for w in WORDS if w != "▁"]
    more = ["".join(rng.choice([w, w + " ", " " + w]) for w in rng.choices(faithful, k=rng.randrange(40))) for _ in range(150)]
    return TEXTS + mixed + more + [" ".join(rng.choices(faithful, k=30_000))]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids may be null or come twice; other columns bear the names that the operators use inside."""
    rows = [(None if i == 3 else 7 if i in (5, 6) else i, t, [None, "", "en"][i % 3], [None, "s1", "s2", "s3"][i % 4]) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in ("ids", "n_tokens", "block", "digest", "found", "term", "pos", "n", "item", "value", "rank", "vector", "total")}).cache()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})


def test_byte_bpe_as_the_library_does(docs, library):
    found = byte_bpe.encoded(docs)
    assert found.columns == ["doc_id", "n_tokens", "ids", "starts", "ends"] and byte_bpe.encoded(docs.filter("false")).count() == 0
    back = byte_bpe.decoded(found, with_parts=True).collect()
    rows = found.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect()) and byte_bpe.decoded(found.filter("false")).count() == 0
    for t, r, d in zip(texts(), rows, back, strict=True):
        t, ids = t or "", np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(t) and r.n_tokens == len(ids) == d.n_tokens, t
        assert bytes(d.data) == t.encode() and d.text == t and "".join(d.parts) == t and len(d.parts) == len(ids)
        size, upto = [len(c.encode()) for c in t], 0
        byte_to_char = [i for i, n in enumerate(size) for _ in range(n)]
        for i, s, e in zip(ids, r.starts, r.ends, strict=True):
            n = len(library.decode_single_token_bytes(i))
            assert (s, e) == (byte_to_char[upto], byte_to_char[upto + n - 1] + 1)
            upto += n


def test_offsets_are_those_of_the_tokenizers_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = [(i, t) for i, t in enumerate(["plain words", "😀 日本語 naïve", "don't"])]
    for (_, t), r in zip(rows, byte_bpe.encoded(spark.createDataFrame(rows, "doc_id int, text string")).collect(), strict=True):
        assert list(zip(r.starts, r.ends)) == tokenizer.encode(t, add_special_tokens=False).offsets


def test_every_code_point_splits_as_in_the_library(library):
    """All characters among letters, digits and spaces: the pattern's classes agree in both libraries."""
    at = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    probes = [f"a{chr(c)}1{chr(c)} {chr(c)}b\n{chr(c)}!{chr(c)}" for c in at]
    packed = byte_bpe.Packer(byte_bpe.RANKS)
    for s in range(0, len(probes), 4096):
        part = probes[s : s + 4096]
        assert [np.frombuffer(x, "<u4").tolist() for x in packed(part)] == [library.encode_ordinary(t) for t in part]


def test_split_characters_and_broken_bytes(spark):
    one = {t: i for i, t in enumerate(vocabulary(byte_bpe.RANKS).tokens)}
    ids = [one[bytes([b])] for b in "日é".encode()]
    broken = [one[b"a"], one[b"\xe6"], one[b"b"], one[b"\xe6"]]
    rows = [(1, np.array(ids, "<u4").tobytes()), (2, np.array(broken, "<u4").tobytes()), (3, None)]
    found = byte_bpe.decoded(spark.createDataFrame(rows, "doc_id int, ids binary"), with_parts=True).collect()
    assert (found[0].text, found[0].parts) == ("日é", ["", "", "日", "", "é"])
    assert bytes(found[1].data) == b"a\xe6b\xe6" and found[1].text == "a�b�" == "".join(found[1].parts)
    assert found[2].n_tokens == 0 and found[2].text == ""


def test_long_texts(spark):
    """Thirty megabytes of words are cut, a run of one character is not: either ends in seconds."""
    rows = [(1, "lorem ipsum dolor sit amet " * 1_100_000), (2, "a" * 1_000_000), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    began = time.time()
    found = byte_bpe.decoded(byte_bpe.encoded(df, with_offsets=False)).select("doc_id", F.sha2("data", 256).alias("h")).collect()
    assert {r.doc_id: r.h for r in found} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}
    measured = {r.doc_id: r for r in alignment.measured(df).collect()}
    assert measured[1].n_groups > 1_100_000 and measured[3].n_a == 1 and time.time() - began < 120


def plain_alignment(values):
    """Groups by common ends, links by comparing ranges, counts over all."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(alignment.A))
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B))
    a_bytes, b_bytes = vocabulary(alignment.A).tokens, vocabulary(alignment.B).tokens
    out, counts, links_of = [], Counter(), []
    for t in values:
        data = (" " + (t or "")).encode()
        a = tokenizer.encode(" " + (t or ""), add_special_tokens=False).ids
        b = model.encode(t or "")
        if not t or b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
            a, b = [], []

        def ranges(ids, tokens):
            at, r = 0, []
            for i in ids:
                r.append((at, at := at + len(tokens[i])))
            return r

        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        links, j = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        common = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = [([i for i, (s, e) in zip(a, ra) if lo <= s < hi], [i for i, (s, e) in zip(b, rb) if lo <= s < hi]) for lo, hi in zip([0, *common], common)] if len(a) < 300 else None
        if groups is None:
            groups, x, y = [], 0, 0
            for hi in common:
                g = ([], [])
                while x < len(ra) and ra[x][1] <= hi:
                    g[0].append(a[x])
                    x += 1
                while y < len(rb) and rb[y][1] <= hi:
                    g[1].append(b[y])
                    y += 1
                groups.append(g)
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        counts.update(links)
        links_of.append(links)
        out.append([len(a), len(b), len(groups), len(links), hashlib.sha256(text.encode()).hexdigest() if text else ""])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(*x[:4], sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), x[4]) for x, links in zip(out, links_of)]


def test_alignment(docs, spark, sf):
    key = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    for rows, at_once in ((docs, 10000), (documents, 10000), (docs.repartition(3), 7)):
        with text_batches(spark, at_once):  # few rows make many blocks
            found = alignment.measured(rows)
        ids, values = zip(*[(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()])
        plain = plain_alignment(values)
        assert Counter((r.doc_id, *[r[k] for k in key]) for r in found.collect()) == Counter((i, *p) for i, p in zip(ids, plain))
    assert alignment.measured(docs.filter("false")).count() == 0 and alignment.measured(docs.filter("text = ''")).first().groups_sha256 == ""


def test_aligned_tokens_cover_the_same_bytes(docs):
    a, b = vocabulary(alignment.A).tokens, vocabulary(alignment.B).tokens
    for t, r in zip(texts(), alignment.aligned(docs).collect(), strict=True):
        if not r.a_ids:
            assert not r.b_ids
            continue
        of_a, of_b = defaultdict(bytes), defaultdict(bytes)
        for i, g in zip(r.a_ids, r.a_groups):
            of_a[g] += a[i]
        for i, g in zip(r.b_ids, r.b_groups):
            of_b[g] += b[i]
        assert of_a == of_b and b"".join(of_a.values()) == (" " + t).encode() and r.a_ends[-1] == r.b_ends[-1] == len(t.encode()) + 1


def test_components_of_edge_arrays():
    rng = np.random.default_rng(3)
    for n, m in ((1, 0), (2, 1), (200, 150), (2000, 1999)):
        u, v = (np.arange(m), np.arange(m) + 1) if m == n - 1 else (rng.integers(0, n, m), rng.integers(0, n, m))
        root = list(range(n))
        for _ in range(n if m < n - 1 else 1):
            for a, b in zip(u, v):
                root[a] = root[b] = min(root[a], root[b])
        assert alignment.components(n, u, v).tolist() == root


def test_cuts_are_safe():
    for t in texts():
        assert " ".join(cut(t or "")) == (t or "")


def plain_audit(rows):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        w = term.findall((text or "").translate(low))
        groups[lang].add(source)
        n[lang, source].update(w)
        df[lang].update(set(w))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, c in df[lang].items() if c >= divergence.LEAST]
        share = lambda c, v: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * v) for t in kept}
        p = {s: share(n[lang, s], len(kept)) for s in sources}
        q = share(sum((n[lang, s] for s in sources), Counter()), len(kept))
        for s in sources:
            far = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            over = sorted((q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])[: divergence.TOP]
            out += [(lang, s, part, i.decode(), -v, k) for part, x in (("pair", far), ("term", over)) for k, (v, i) in enumerate(x, 1)]
    return sorted(out)


def test_audit(docs, spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    few = spark.createDataFrame([("abc ABC ÀÉ", "x", f"s{i % 3}") for i in range(40)] + [(f"w{'abcdefgh'[i % 8]} tie{'xy'[i % 2]}", "x", f"s{i % 5}") for i in range(400)] + [("", "empty", "a"), (None, "empty", None), ("lone", None, None)], "text string, lang string, source string")
    for rows in (few, docs, documents):
        found = divergence.audited(rows)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, found.collect())) == plain_audit([tuple(r) for r in rows.select("text", "lang", "source").collect()])
    assert divergence.audited(docs.filter("false")).count() == 0


def test_partial_counts_add_up(monkeypatch):
    """A task that hands its counts on early, and cuts its texts, gives the same sums."""
    rows = [("x", f"s{i % 3}", t or "") for i, t in enumerate(texts())]
    batch = pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows)], names=["lang", "source", "text"])

    def sums():
        n, docs, parts = Counter(), Counter(), 0
        for b in divergence._counted(iter([batch])):
            parts += 1
            for r in b.to_pylist():
                n[r["source"], r["term"]] += r["n"]
                docs[r["source"], r["term"]] += r["docs"]
        return n, docs, parts

    n, docs, one = sums()
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "AT_ONCE", 10)
    again = sums()
    assert again[:2] == (n, docs) and one == 1 and again[2] > 3


def test_shares_stay_exact_beyond_64_bits(spark):
    n = 10**15 + 7
    found = spark.range(1).select(divergence._share(F.lit(n), F.lit(3 * n + 1), F.lit(11))).first()[0]
    assert found == 1 + 10**9 * (n + 5) // (3 * n + 1 + 55)


def test_blocks_lie_few_to_a_row_group(docs, spark, monkeypatch):
    kept = []
    monkeypatch.setattr(alignment, "removed", lambda spark, path: kept.append(path))
    with text_batches(spark, 1):
        out = alignment.measured(docs.limit(30).coalesce(1))
    groups = [f.metadata.row_group(i).num_rows for f in map(pq.ParquetFile, Path(kept[0].removeprefix("file://")).glob("*.parquet")) for i in range(f.num_row_groups)]
    assert sum(groups) == out.count() == 30 and max(groups) <= alignment.BLOCKS_AT_ONCE

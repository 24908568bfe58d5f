"""Source divergence audit: how far the term shares of the sources of a language lie apart, and which terms a source overuses.

Terms are runs of letters (``[A-Za-z]`` and everything beyond ASCII), lower-cased in A-Z. A language keeps the terms of
at least ``LEAST`` of its documents. A source gives a kept term with ``n`` occurrences, of ``N`` over its kept terms, the
share ``1 + floor(SCALE * (n + PRIOR) / (N + PRIOR * V))`` for ``V`` kept terms; so does the language as a whole. The
distance of two sources is the sum of the absolute differences over all kept terms.

Tasks count terms per language and source before anything is shuffled, so a source with a third of all rows costs a few
more partial rows. A term's counts by source are a sparse vector, and terms with the same vector are one column that
counts so many times: every pair of sources is evaluated once per distinct vector. Only sources in the vector are paired
there. With the share of an absent term ``z``, the sum over all terms is that of ``|z_s - z_t|``, corrected for terms that
``s`` has and for terms that ``t`` has (by how many terms a source has so often), and for those that both have:

    |p_s - p_t|  =  [|p_s - p_t| - |p_s - z_t| - |z_s - p_t| + |z_s - z_t|]  (both)
                    + [|p_s - z_t| - |z_s - z_t|] + [|z_s - p_t| - |z_s - z_t|] + |z_s - z_t|

so sources that share few terms cost little. All arithmetic is on integers; products that may pass 64 bits are decimals.
Sizes that grow with the corpus are joined, never broadcast by hint; the tables of groups are as large as the report.

Null text, language and source count as empty strings; empty texts still make their group occur. Repeated rows count
each; ties rank by the item's UTF-8 bytes. An empty table gives an empty report. Only the three columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, written

LEAST, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Distinct terms that a task counts before it hands them on, and bytes of a text that are split at once.
HELD, AT_ONCE = 400_000, 1 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")
#: A place in a long text that no term goes on across.
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``AT_ONCE`` bytes, cut where no term is; one piece for most texts."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + AT_ONCE)
        end = gap.end() if gap else len(data)
        yield data[at:end]
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term per language and source, as far as the task has them together."""
    occurrences: dict[tuple, Counter] = {}
    documents: dict[tuple, Counter] = {}

    def handed() -> pa.RecordBatch:
        rows = [(lang, source, term, n, documents[lang, source][term]) for (lang, source), c in occurrences.items() for term, n in c.items()]
        occurrences.clear()
        documents.clear()
        lang, source, term, n, docs = zip(*rows, strict=True) if rows else [()] * 5
        return pa.record_batch([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    held = 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist(), strict=True):
                n, docs = occurrences.setdefault((lang, source), Counter()), documents.setdefault((lang, source), Counter())
                before, seen = len(n), set()
                for piece in _pieces(text.lower()):  # of bytes: A-Z alone
                    terms = _TERM.findall(piece)
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(n) - before
                if held >= HELD:
                    yield handed()
                    held = 0
    yield handed()


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))``, exactly."""
    wide = lambda c: c.cast("decimal(28,0)")
    return 1 + F.call_function("div", wide(n + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + PRIOR * terms))


def groups_of(docs: DataFrame) -> DataFrame:
    """Every occurring language and source, the source's place in its language by name (``pos``, from 0)."""
    found = docs.select("lang", "source").distinct()
    return found.withColumn("pos", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)


def vectors_of(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Each kept term with its counts by source: ``lang``, ``term``, ``vector`` (``pos``, ``n``; by place)."""
    counts = docs.select("lang", "source", "text").mapInArrow(lean(_counted), "lang string, source string, term string, n bigint, docs bigint")
    placed = counts.join(groups, ["lang", "source"]).select("lang", "term", "pos", "n", "docs").repartition("lang", "term")
    by_source = placed.groupBy("lang", "term", "pos").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("vector"))
    return by_term.filter(F.col("docs") >= LEAST).select("lang", "term", "vector")


def audited(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value``, ``rank``."""
    plain = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    docs = docs.select(plain(lang, "lang"), plain(source, "source"), plain(text, "text"))
    groups = written(groups_of(docs), "source-groups", 8)[0]
    terms = written(vectors_of(docs, groups), "term-vectors", 2)[0]
    columns = written(terms.groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("times")), "count-columns", 2)[0]

    kept = columns.groupBy("lang").agg(F.sum("times").alias("terms"))
    totals = columns.select("lang", "times", F.explode("vector").alias("x")).groupBy("lang", F.col("x.pos").alias("pos")).agg(F.sum(F.col("times") * F.col("x.n")).alias("total"))
    zero = F.lit(0).cast("bigint")
    sized = groups.join(totals, ["lang", "pos"], "left").join(kept, "lang", "left").select("lang", "source", "pos", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"))
    # a language without kept terms has no shares
    sized = written(sized.withColumn("absent", F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms")))), "source-totals", 8)[0]
    langs = sized.groupBy("lang").agg(F.first("terms").alias("terms"), F.sum("total").alias("all"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "total", "absent"))), lambda x: F.struct(x["total"].alias("total"), x["absent"].alias("absent"))).alias("sources"))
    langs = written(langs, "languages", 8)[0]
    return pairs(columns, sized, langs).unionByName(overused(terms, sized, langs))


def _with_shares(rows: DataFrame, langs: DataFrame) -> DataFrame:
    """``shares``: the vector with ``p``, the share of each source in it, and ``z``, its share of an absent term."""

    def share(x: Column) -> Column:
        s = F.get(F.col("sources"), x["pos"])
        return F.struct(x["pos"].alias("pos"), _share(x["n"], s["total"], F.col("terms")).alias("p"), s["absent"].alias("z"))

    return rows.join(langs, "lang").withColumn("shares", F.transform("vector", share))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def pairs(columns: DataFrame, sized: DataFrame, langs: DataFrame) -> DataFrame:
    """Distances of all pairs of sources of a language, from the distinct count columns and their multiplicities."""
    shares = _with_shares(columns, langs).select("lang", "times", "shares")
    gap = lambda a, b: F.abs(a - b)
    first = shares.select("lang", "times", "shares", F.posexplode("shares").alias("i", "a"))
    both = first.select("lang", "times", "a", F.explode(F.slice("shares", F.col("i") + 2, F.size("shares"))).alias("b"))
    a, b = F.col("a"), F.col("b")
    more = gap(a["p"], b["p"]) - gap(a["p"], b["z"]) - gap(a["z"], b["p"]) + gap(a["z"], b["z"])
    both = both.select("lang", a["pos"].alias("one"), b["pos"].alias("two"), (F.col("times") * more).alias("value"))
    both = both.groupBy("lang", "one", "two").agg(F.sum("value").alias("both"))
    both = both.unionByName(both.select("lang", F.col("two").alias("one"), F.col("one").alias("two"), "both"))

    alone = shares.select("lang", "times", F.explode("shares").alias("a")).groupBy("lang", a["pos"].alias("one"), a["p"].alias("p"), a["z"].alias("z")).agg(F.sum("times").alias("times"))
    other = sized.select("lang", F.col("pos").alias("two"), F.col("absent").alias("z_two"))
    alone = alone.join(other, "lang").filter("one <> two").select("lang", "one", "two", (F.col("times") * (gap(F.col("p"), F.col("z_two")) - gap(F.col("z"), F.col("z_two")))).alias("value"))
    alone = alone.groupBy("lang", "one", "two").agg(F.sum("value").alias("alone"))

    left = sized.select("lang", "source", F.col("pos").alias("one"), F.col("absent").alias("z"), "terms")
    right = sized.select("lang", F.col("source").alias("item"), F.col("pos").alias("two"), F.col("absent").alias("z_two"))
    mirrored = alone.select("lang", F.col("two").alias("one"), F.col("one").alias("two"), F.col("alone").alias("mirrored"))
    key, zero = ["lang", "one", "two"], F.lit(0).cast("bigint")
    all_pairs = left.join(right, "lang").filter("one <> two").join(both, key, "left").join(alone, key, "left").join(mirrored, key, "left")
    base = F.col("terms") * gap(F.col("z"), F.col("z_two"))
    value = sum((F.coalesce(c, zero) for c in (F.col("both"), F.col("alone"), F.col("mirrored"))), F.coalesce(base, zero))
    return _ranked(all_pairs.select("lang", "source", "item", value.alias("value")), "pair")


def overused(terms: DataFrame, sized: DataFrame, langs: DataFrame) -> DataFrame:
    """Per source, the ``TOP`` terms whose share there is furthest above the language's."""
    n = F.aggregate("vector", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    rows = _with_shares(terms, langs).withColumn("q", _share(n, F.col("all"), F.col("terms")))
    above = rows.select("lang", F.col("term").alias("item"), "q", F.explode("shares").alias("a")).filter("a.p > q")
    found = above.select("lang", F.col("a.pos").alias("pos"), "item", (F.col("a.p") - F.col("q")).alias("value"))
    # ranked by place before the names come: a partial limit per group goes ahead of the shuffle
    order = Window.partitionBy("lang", "pos").orderBy(F.desc("value"), "item")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return best.join(sized.select("lang", "source", "pos"), ["lang", "pos"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

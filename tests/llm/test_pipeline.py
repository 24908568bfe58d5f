"""The pipeline against the plain operators, and the queries against their SQL."""

import random
import tracemalloc

import corpus_pipeline
import plain
import pyarrow as pa
from pyspark.sql import functions as F
from test_entry import compare
from test_near_copies import plain as plain_copies

from talkweave.llm import common, decontaminate, oracles, queries


def test_run_equals_the_plain_stages(spark, sf):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [d for d in docs if plain.rules(d["text"])[2]]
    near = plain_copies([(d["doc_id"], d["text"]) for d in docs])
    docs = [d for d in docs if near[d["doc_id"]] == d["doc_id"]]
    hit = {i for i, _, _, found in plain.contamination([(d["doc_id"], d["text"]) for d in docs], items) if found}
    docs = [d for d in docs if d["doc_id"] not in hit]
    for d in docs:
        d["text"] = plain.redacted(d["text"], plain.spans(d["text"]))
        d["n_chars"] = len(d["text"])
    texts = {d["doc_id"]: d for d in docs}
    expect = [(i, r, k, texts[i]["text"], texts[i]["source"], texts[i]["n_chars"]) for i, r, k in plain.mixture([(d["doc_id"], d["source"], d["text"]) for d in docs])]
    got = [(r.doc_id, r.replica, r.shuffle_key, r.text, r.source, r.n_chars) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(expect) and hit


def test_stages_keep_columns_and_take_odd_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x y", None, "a", 3), (2, "", "en", "a", 0), (3, "x y", "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("component", F.lit(1))
    for df in (docs, docs.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, sf).columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, df, sf).count() >= 0
    assert sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.filter("text is not null"), sf).collect()) == [(2, ""), (3, "x y")]


LONG = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(60))


def test_rows_are_judged_apart(spark, sf):
    """One id with different texts, null ids, repeated rows with other columns, columns with clashing names."""
    rows = [(1, LONG, "b"), (7, LONG, "a"), (7, OTHER, "a"), (None, LONG + " x", "a"), (None, "alone as can be here", "a"), (None, "alone as can be here", "b"), (9, OTHER + " y", "a"), (1, LONG, "a"), (5, None, "a"), (6, " ", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string").withColumn("a.b", F.lit(1))
    got = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.row) for r in got.collect()), key=str) == sorted([(1, LONG, "a"), (7, OTHER, "a"), (None, "alone as can be here", "a"), (5, None, "a")], key=str)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(1, item, "a"), (1, "clean words only", "a"), (None, item, "a"), (None, "clean too", "b")], "doc_id bigint, text string, row string")
    assert sorted(r.text for r in corpus_pipeline.decontaminated(spark, docs, sf).collect()) == ["clean too", "clean words only"]


def test_texts_stay_where_they_are(spark, sf, monkeypatch):
    """Rows to drop are found without a shuffle of those that stay, and exactly, even if the bit set is full."""
    texts = [(i, " ".join(f"w{(i if i < 60 else i - 60) * 100 + k}" for k in range(20))) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf)
    plan = kept._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and "Join" not in plan.children().head().toString()
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    monkeypatch.setattr(common, "WORDS", 1)
    keys = docs.filter("doc_id % 3 = 0").select("doc_id")
    for part, rest in zip(common.parted(docs, "doc_id", keys), (True, False), strict=True):
        assert sorted(r.doc_id for r in part.collect()) == [i for i in range(120) if (i % 3 == 0) == rest]
    none, every = common.parted(docs, "doc_id", keys.filter("false"))
    assert (none.count(), every.count()) == (0, 120)


def test_queries_match_sql(spark, sf):
    compare(spark, sf, queries.QUERIES, oracles.ORACLES)


def test_every_query_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_index_needs_little_memory_for_a_word():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(2000)}" for _ in range(2000)) for _ in range(150)]
    batch = pa.record_batch([pa.array(range(150)), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    try:
        found = list(decontaminate._indexer(1 << 24)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 1 and sum(found[0].column("n_words")[0].as_py()) == 300_000
    assert peak < 28 * 300_000


def test_texts_come_in_small_batches(spark):
    seen = spark.createDataFrame([(i, "a b c") for i in range(5000)], "doc_id bigint, text string").coalesce(1)
    sizes = lambda batches: (pa.record_batch([pa.array([b.num_rows])], names=["n"]) for b in batches)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with common.text_batches(spark):
        rows = common.staged(seen.mapInArrow(sizes, "n bigint"), "sizes").collect()
    assert spark.conf.get(name) == before
    assert sum(r["n"] for r in rows) == 5000 and max(r["n"] for r in rows) <= common.TEXTS

"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixture of sources.

Each stage takes the rows that its predecessor kept, written as Parquet in the shared folder and read again, so a
lost executor costs part of one stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm import decontaminate, jaccard, mixing, quality_rules, secret_scan
from talkweave.llm.common import fresh, parted, removed, row_hash, staged, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the current policy."""
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of links between texts whose sets of five-word shingles have a Jaccard
    similarity of at least 0.8: the one with the least id, a null id counting as greater than all.

    Rows are known by a digest of id and text, so different texts under one id are judged apart. Of rows with equal id
    and text, which are copies, the one whose other columns sort first stays.
    """
    digest = row_hash(F.col("doc_id"), F.col("text"))
    row = fresh("row", docs.columns)
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("digest")).alias(row), "text")
    found = staged(jaccard.near_duplicates(keyed, doc_id=row), "components", 8)
    dropped = staged(found.filter("doc_id <> component").select("doc_id.digest").distinct().withColumnRenamed("digest", row), "duplicates", 8)
    repeated = staged(found.filter("doc_id = component").groupBy("doc_id.digest").count().filter("count > 1").select(F.col("digest").alias(row)), "repeated-rows", 8)
    rest = parted(docs.withColumn(row, digest), row, dropped)[1]
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if repeated.isEmpty():
        return rest.select(*columns)
    whole = F.struct(*columns)
    copies, others = parted(rest, row, repeated)
    once = copies.groupBy(row).agg(F.min_by(whole, F.to_json(whole)).alias(row + "s")).select(f"{row}s.*")
    return others.select(*columns).unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with any window of a benchmark item; a row is known by a digest of its id and text."""
    row = fresh("row", docs.columns)
    keyed = docs.withColumn(row, row_hash(F.col("doc_id"), F.col("text")))
    found = decontaminate.contamination(keyed.select(row, "text"), table(spark, sf_dir, "benchmark"), doc_id=row)
    hit = staged(found.filter("n_hit > 0").select(F.col("doc_id").alias(row)).distinct(), "contaminated", 8)
    return parted(keyed, row, hit)[1].select(*[F.col(f"`{c}`") for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; documents stay, and ``n_chars`` follows the text."""
    return secret_scan.cleaned(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources reach their target weights, in a global random order."""
    return mixing.replicated(docs)


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("secret_scan", without_secrets), ("mixing", mixed)]

#: Components of links between texts need a closure over all pairs; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table is deleted once its successor's is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            removed(spark, last)
        last = path
    return docs

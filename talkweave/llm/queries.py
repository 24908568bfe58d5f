"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import alignment, byte_bpe, decontaminate, divergence, language_id, mixing, quality_model, quality_rules, secret_scan, simhash, suffix_lm, token_counts, url_filters
from .common import remainder, shared_folder, table
from .oracles import ORACLES


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    m = F.col("ledger")
    bits = m["fail_bits"]
    return docs.select(
        "doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (bits.bitwiseAND(quality_rules.BASE) != 0).alias("base_failed"), quality_rules.kept(bits).alias("kept"), m["n_stutter"].alias("n_stutter"), bits.alias("fail_bits"),
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, remainder(F.col("doc_id"), 4) != 2)
    found = language_id.predictions(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(remainder(F.col("doc_id"), 3) != 1)
    found = quality_model.scores(docs, quality_model.fit(docs, labels))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_lm.scored(docs, remainder(F.col("doc_id"), 7) != 2)
    return found.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_counts.counted(docs, f"{shared_folder(spark)}/token-cache-{uuid.uuid4().hex}")
    return found.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicated(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in secret_scan.KINDS], F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), slop=4)
    n = F.size("items").cast("bigint")
    return found.select("doc_id", "n_words", "n_hit", n.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n >= decontaminate.LEAST_ITEMS).alias("contaminated"), F.size("near_items").cast("bigint").alias("n_near_items"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.measured(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = byte_bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), with_offsets=False)
    return byte_bpe.decoded(tokens).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES = {"op11_alignment": op11_alignment, "op12_divergence": op12_divergence, "op13_byte_bpe": op13_byte_bpe, "op1_language_id": op1_language_id, "op2_url_filters": op2_url_filters, "op3_mixing": op3_mixing, "op4_secret_scan": op4_secret_scan, "op6_quality_rules": op6_quality_rules, "op5_quality_model": op5_quality_model, "op7_suffix_lm": op7_suffix_lm, "op8_token_counts": op8_token_counts, "op9_decontaminate": op9_decontaminate, "op10_simhash": op10_simhash, "pipeline": corpus_pipeline.run}

__all__ = ["ORACLES", "QUERIES"]

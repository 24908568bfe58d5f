"""Metrics of a call and its final document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as T


def text_metrics(final: DataFrame) -> DataFrame:
    """Per call, over its enhanced texts in order: language switching and punctuation density."""
    g = final.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("position", "enhanced_text"))).alias("items"))
    texts = g.select("call_id", F.filter(F.transform("items", lambda x: x["enhanced_text"]), lambda t: T.strip(t) != "").alias("texts"))
    return texts.select("call_id", T.switching_ratio(F.col("texts")).alias("language_switching_ratio"), T.punctuation_density(F.col("texts")).alias("punctuation_density_after_enhancement"))


def call_metrics(postprocess: DataFrame, asr: DataFrame, anonymize: DataFrame, enhance: DataFrame, quality: DataFrame, final: DataFrame) -> DataFrame:
    """One row per call of ``asr``: the counts and ratios of all reports."""
    calls = lambda df, name: df.select("call_id", F.col("llm_calls_total").alias(name))
    rows = (
        asr.select("call_id", F.col("total_chunks").alias("asr_chunks_total"))
        .join(postprocess.select("call_id", F.col("input_segments").alias("total_segments_before_postprocess"), F.col("output_segments").alias("total_segments_after_postprocess")), "call_id", "left")
        .join(calls(anonymize, "__a"), "call_id", "left").join(enhance.select("call_id", F.col("llm_calls_total").alias("__e"), "semantic_drift_flags_total"), "call_id", "left")
        .join(quality.select("call_id", "low_confidence_chunk_ratio"), "call_id", "left").join(text_metrics(final), "call_id", "left").fillna(0)
    )
    return rows.withColumn("llm_calls_total", F.col("__a") + F.col("__e")).drop("__a", "__e")


def with_latencies(metrics: DataFrame, asr: DataFrame, anonymize: DataFrame, enhance: DataFrame) -> DataFrame:
    """``metrics`` with the time that models took, in milliseconds."""
    of = lambda df, name: df.select("call_id", F.col("llm_latency_total_ms").alias(name))
    rows = metrics.join(asr.select("call_id", "asr_latency_total_ms"), "call_id", "left").join(of(anonymize, "__a"), "call_id", "left").join(of(enhance, "__e"), "call_id", "left").fillna(0.0, ["asr_latency_total_ms", "__a", "__e"])
    return rows.withColumn("llm_latency_total_ms", F.col("__a") + F.col("__e")).drop("__a", "__e")


def documents(metrics: DataFrame, final: DataFrame, input_file: str = "", artifacts_dir: str = "") -> DataFrame:
    """``call_id``, where the run's input and stages are, ``metrics`` and the segments in order: what a sink writes as one
    JSON document per call."""
    fields = ["speaker", "start", "end", "raw_text", "anonymized_text", "enhanced_text", "chunk_path", "asr_status"]
    segments = final.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("position", *fields))).alias("s"))
    listed = segments.select("call_id", F.transform("s", lambda x: F.struct(*[x[c].alias(c) for c in fields])).alias("segments"))
    m = metrics.select("call_id", F.struct(*[c for c in metrics.columns if c != "call_id"]).alias("metrics"))
    none = F.array().cast(listed.schema["segments"].dataType)
    return m.join(listed, "call_id", "left").select("call_id", F.lit(input_file).alias("input_file"), F.lit(artifacts_dir).alias("artifacts_dir"), "metrics", F.coalesce("segments", none).alias("segments"))

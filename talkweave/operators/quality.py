"""Quality of chunks and segments: speech rate, confidence, language mix, overlap, effect of enhancement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as T

from .intervals import overlaps_neighbour
from .transcript import last_by


def chars_per_sec(text: Column, start: Column, end: Column) -> Column:
    """Of a stripped text."""
    return F.length(text) / F.greatest(F.lit(1e-6), end - start)


def low_confidence(status: Column, text: Column, cps: Column, least: float = 1.5, most: float = 28.0) -> Column:
    return (status != "ok") | (text == "") | (cps < float(least)) | (cps > float(most))


def flagged_segments(segments: DataFrame, least: float = 1.5, most: float = 28.0) -> DataFrame:
    """Adds ``chars_per_sec`` and ``low_confidence``."""
    rows = segments.withColumn("__t", T.strip(F.col("raw_text"))).withColumn("chars_per_sec", chars_per_sec(F.col("__t"), F.col("start"), F.col("end")))
    return rows.withColumn("low_confidence", low_confidence(F.col("asr_status"), F.col("__t"), F.col("chars_per_sec"), least, most)).drop("__t")


def chunk_rows(chunks: DataFrame, transcripts: DataFrame, final: DataFrame, least: float = 1.5, most: float = 28.0) -> DataFrame:
    """One row per chunk with its text, rates and marks. ``final`` are the segments that were left."""
    said = last_by(transcripts.select("call_id", "idx", "ordinal", "raw_text", "status"), ["call_id", "idx"], "ordinal").select("call_id", "idx", "raw_text", "status")
    left = last_by(final.filter("chunk_path <> ''").select("call_id", "chunk_path", "ordinal", F.col("raw_text").alias("final_raw"), "anonymized_text", "enhanced_text"), ["call_id", "chunk_path"], "ordinal")
    rows = chunks.withColumn("overlap_marker", overlaps_neighbour(("start", "end", "idx"))).join(said, ["call_id", "idx"], "left")
    rows = rows.withColumns({"raw_text": T.strip(F.coalesce("raw_text", F.lit(""))), "asr_status": F.coalesce("status", F.lit("missing"))})
    rows = rows.join(left.drop("ordinal").withColumn("__found", F.lit(True)), ["call_id", "chunk_path"], "left")
    source, enhanced = T.strip(F.coalesce(F.nullif("anonymized_text", F.lit("")), "final_raw", F.lit(""))), T.strip(F.coalesce("enhanced_text", F.lit("")))
    rows = rows.withColumns({"__source": source, "__enhanced": enhanced, "duration_sec": F.greatest(F.lit(0.0), F.col("end") - F.col("start"))})
    rows = rows.withColumn("chars_per_sec", F.length("raw_text") / F.greatest(F.lit(1e-6), F.col("duration_sec")))
    both = F.col("__found").isNotNull() & (F.col("__source") != "") & (F.col("__enhanced") != "")
    return rows.select(
        "call_id", F.col("idx").alias("chunk_index"), "speaker", "start", "end", "duration_sec", "chunk_path", "asr_status", "raw_text", F.length("raw_text").cast("bigint").alias("raw_text_length"), "chars_per_sec",
        T.code_switched(F.col("raw_text")).alias("code_switch_presence"), T.dominant_language(F.col("raw_text")).alias("dominant_language"),
        low_confidence(F.col("asr_status"), F.col("raw_text"), F.col("chars_per_sec"), least, most).alias("low_confidence_marker"), "overlap_marker", F.col("__found").isNull().alias("cleaned_out"),
        (both & (F.col("__source") != F.col("__enhanced"))).alias("enhancement_changed_text"), (both & T.drifted(F.col("__source"), F.col("__enhanced"))).alias("suspicious_substitution_flag"),
    )


def cleaned_out(chunks: DataFrame, final: DataFrame) -> DataFrame:
    """Chunks that no final segment came from."""
    return chunks.join(final.filter("chunk_path <> ''").select("call_id", "chunk_path"), ["call_id", "chunk_path"], "left_anti")


def summary(rows: DataFrame, least: float = 1.5, most: float = 28.0) -> DataFrame:
    """One row per call of ``chunk_rows``."""
    n = lambda c, name: F.count_if(c).alias(name)
    g = rows.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("chunks_total"), n("low_confidence_marker", "low_confidence_chunks"), n("code_switch_presence", "code_switch_chunks"), n("overlap_marker", "overlap_chunks"), n("cleaned_out", "cleaned_out_chunks"),
        n("enhancement_changed_text", "enhancement_changed_chunks"), n("suspicious_substitution_flag", "suspicious_substitution_chunks"), F.avg("chars_per_sec").alias("avg_chars_per_sec"),
    )
    share = lambda c: F.col(c) / F.greatest(F.lit(1), F.col("chunks_total"))
    return g.withColumns({"low_confidence_chunk_ratio": share("low_confidence_chunks"), "code_switch_chunk_ratio": share("code_switch_chunks"), "low_confidence_min_cps": F.lit(float(least)), "low_confidence_max_cps": F.lit(float(most))})

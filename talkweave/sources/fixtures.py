"""Timed, speaker-labelled segments derived from tables without audio: deterministic, in whole milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import normalised


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as segments with gaps, overlaps, short and slow ones, echoes, and failed texts."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("call_id"), F.col("turn").alias("ordinal"), F.coalesce("text", F.lit("")).alias("raw_text"))
    call, turn, n = F.col("call_id"), F.col("ordinal"), F.length("raw_text")
    dur = F.when((call * 5 + turn) % 29 == 0, 1000 * n).when((call * 3 + turn * 5) % 7 == 0, 100 + n % 300).otherwise(200 + 60 * F.least(n, F.lit(200)))
    rows = rows.withColumns({"dur": dur.cast("bigint"), "gap": ((call * 7 + turn * 13) % 17 - 3) * 150, "speaker": F.when((call + turn) % 4 < 2, "SPEAKER_00").otherwise("SPEAKER_01")})
    before = Window.partitionBy("call_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("st", F.greatest(F.lit(0), F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(before), F.lit(0)) + F.col("gap")))
    rows = rows.withColumn("en", F.col("st") + F.col("dur"))
    echo = rows.filter((call + turn) % 11 == 0).withColumns({"ordinal": turn + 1000000, "st": F.col("st") + 100, "en": F.col("en") + 150})
    every = rows.unionByName(echo)
    status = F.when(F.col("en") - F.col("st") < 250, "skipped_short").when((call + turn) % 23 == 0, "error").otherwise("ok")
    out = every.withColumn("asr_status", status).select(
        "call_id", "ordinal", "speaker", (F.col("st") / 1000.0).alias("start"), (F.col("en") / 1000.0).alias("end"),
        F.when(F.col("asr_status") == "error", "").otherwise(F.col("raw_text")).alias("raw_text"), "asr_status",
    )
    return normalised(out)


def event_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as dense, overlapping segments: users are calls, event types speakers."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("call_id"), F.col("event_id").alias("ordinal"), F.col("event_type").alias("speaker"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    st = F.floor((F.col("ms") - F.min("ms").over(Window.partitionBy("call_id"))) / 100000)
    rows = e.withColumn("st", st).withColumn("en", F.col("st") + 50 + (F.col("ordinal") * 37) % 2000)
    return rows.select("call_id", "ordinal", F.col("ordinal").alias("idx"), "speaker", (F.col("st") / 1000.0).alias("start"), (F.col("en") / 1000.0).alias("end"))

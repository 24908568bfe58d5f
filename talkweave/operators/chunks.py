"""Chunks of a call's audio: frame ranges, safe labels, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as T


def safe_label(speaker: Column) -> Column:
    label = F.regexp_replace(T.strip(speaker), "[^A-Za-z0-9_-]+", "_")
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("speaker"))


def chunk_path(idx: Column, speaker: Column) -> Column:
    return F.format_string("chunk_%04d_%s.wav", idx, safe_label(speaker))


def manifest(segments: DataFrame, sample_rate: int = 16000) -> DataFrame:
    """Segments (with ``idx``, ``audio_sec``) with first and last frame and file name; empty ones go."""
    frames = lambda c: (F.col(c) * sample_rate).cast("bigint")
    rows = segments.withColumns({"start_frame": F.greatest(F.lit(0).cast("bigint"), frames("start")), "end_frame": F.least(frames("audio_sec"), frames("end"))})
    return rows.filter("end_frame > start_frame").withColumn("chunk_path", chunk_path(F.col("idx"), F.col("speaker")))

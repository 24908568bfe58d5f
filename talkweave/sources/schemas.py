"""Schemas of the tables. Missing text is the empty string; ``normalised`` turns nulls into it once, at ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIARIZATION = "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double"
CHUNKS = "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double, chunk_path string"
TRANSCRIPTS = "call_id bigint, ordinal bigint, idx bigint, raw_text string, status string"
SEGMENTS = "call_id bigint, ordinal bigint, speaker string, start double, end double, raw_text string, anonymized_text string, enhanced_text string, chunk_path string, asr_status string"

#: The domains of the enumerated strings.
ASR_STATUS = ("ok", "skipped_short", "error", "missing")
LANGUAGE_LABELS = ("kk", "mixed", "ru", "lat", "other", "unknown")
MERGE_REASONS = ("same_speaker_gap", "absorbed_short", "same_speaker_overlap", "reassigned_short_overlap")


def normalised(df: DataFrame) -> DataFrame:
    """Null strings as empty ones, and ``ok`` for a missing status."""
    texts = {c: F.coalesce(F.col(c), F.lit("ok" if c in ("status", "asr_status") else "")) for c, kind in df.dtypes if kind == "string"}
    return df.withColumns(texts)

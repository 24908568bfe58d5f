"""Transcripts: joining recognised text to chunks, cleaning, de-duplicating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as T

from .intervals import in_call, midpoint_clipped


def last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def assembled(chunks: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Chunks with their text and status; the last of repeated transcripts counts, a missing one is an error."""
    right = last_by(transcripts.select("call_id", "idx", "ordinal", "raw_text", "status"), ["call_id", "idx"], "ordinal").drop("ordinal")
    return chunks.join(right, ["call_id", "idx"], "left").withColumns({"raw_text": F.coalesce("raw_text", F.lit("")), "asr_status": F.coalesce("status", F.lit("error"))}).drop("status")


def judged(segments: DataFrame, min_duration_ms: int = 350) -> DataFrame:
    """Adds ``fate``: skipped_short, short_empty, empty or kept."""
    blank = T.strip(F.col("raw_text")) == ""
    brief = F.greatest(F.lit(0.0), F.col("end") - F.col("start")) < max(0.0, min_duration_ms / 1000.0)
    return segments.withColumn("fate", F.when(F.col("asr_status") == "skipped_short", "skipped_short").when(blank & brief, "short_empty").when(blank, "empty").otherwise("kept"))


def filtered(segments: DataFrame, min_duration_ms: int = 350) -> DataFrame:
    return judged(segments, min_duration_ms).filter("fate = 'kept'").drop("fate")


def deduplicated(segments: DataFrame, duplicate_window_ms: int = 280) -> DataFrame:
    """Of repeats of one speaker's text close in time, or overlapping by four fifths, the longest stays.

    A row can only repeat the last kept row, and only within a run of one speaker and text; runs of one row pass, the
    others are folded as arrays.
    """
    near = max(0.0, duplicate_window_ms / 1000.0)
    w = in_call()
    rows = segments.withColumn("__norm", T.normalise(F.col("raw_text")))
    same = (F.lag("speaker").over(w) == F.col("speaker")) & (F.lag("__norm").over(w) == F.col("__norm"))
    rows = rows.withColumn("__new", F.when(same, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(w))
    columns = [c for c in segments.columns if c not in ("call_id", "start", "end", "ordinal")]
    item = F.struct("start", "end", "ordinal", *columns)
    runs = rows.groupBy("call_id", "__run").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def step(kept, x):
        last = F.element_at(kept, -1)
        length = lambda r: F.greatest(F.lit(0.0), r["end"] - r["start"])
        close = (F.abs(last["start"] - x["start"]) <= near) & (F.abs(last["end"] - x["end"]) <= near)
        shared = F.greatest(F.lit(0.0), F.least(last["end"], x["end"]) - F.greatest(last["start"], x["start"]))
        heavy = shared / F.greatest(F.lit(1e-6), F.least(length(last), length(x))) >= 0.8
        better = F.when(length(x) > length(last), F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(x))).otherwise(kept)
        return F.when(F.size(kept) == 0, F.array(x)).when(close | heavy, better).otherwise(F.concat(kept, F.array(x)))

    kept = F.when(F.size("items") == 1, F.col("items")).otherwise(F.aggregate("items", F.slice("items", F.lit(1), F.lit(0)), step))
    return runs.select("call_id", F.explode(kept).alias("r")).select("call_id", *[F.col(f"r.{c}").alias(c) for c in segments.columns if c != "call_id"])


def cleaned(segments: DataFrame, min_duration_ms: int = 350, duplicate_window_ms: int = 280) -> DataFrame:
    """Filtered, de-duplicated, overlaps cut, and without what collapsed."""
    return midpoint_clipped(deduplicated(filtered(segments, min_duration_ms), duplicate_window_ms)).filter(F.col("end") > F.col("start")).drop("conflict")


def report(segments: DataFrame, min_duration_ms: int = 350, duplicate_window_ms: int = 280) -> DataFrame:
    """One row per call."""
    fates = judged(segments, min_duration_ms)
    n = fates.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("input_segments"), F.count_if(F.col("fate") == "skipped_short").alias("skipped_short_removed"),
        F.count_if(F.col("fate").isin("empty", "short_empty")).alias("empty_segments_removed"), F.count_if(F.col("fate") == "short_empty").alias("short_empty_segments_removed"), F.count_if(F.col("fate") == "kept").alias("__kept"),
    )
    rest = midpoint_clipped(deduplicated(fates.filter("fate = 'kept'").drop("fate"), duplicate_window_ms))
    m = rest.groupBy("call_id").agg(F.count(F.lit(1)).alias("__once"), F.count_if("conflict").alias("overlap_conflicts_count"), F.count_if(F.col("end") <= F.col("start")).alias("collapsed_segments_removed"))
    both = n.join(m, "call_id", "left").fillna(0)
    return both.select(
        "call_id", "input_segments", (F.col("__once") - F.col("collapsed_segments_removed")).alias("output_segments"), "skipped_short_removed", "empty_segments_removed", "short_empty_segments_removed",
        (F.col("__kept") - F.col("__once")).alias("duplicate_segments_removed"), "overlap_conflicts_count", "collapsed_segments_removed",
        F.lit(min_duration_ms).cast("bigint").alias("cleanup_min_duration_ms"), F.lit(duplicate_window_ms).cast("bigint").alias("cleanup_duplicate_window_ms"),
    )


def positioned(segments: DataFrame) -> DataFrame:
    """``position``: the place in time order, from 0."""
    return segments.withColumn("position", (F.row_number().over(in_call()) - 1).cast("bigint"))

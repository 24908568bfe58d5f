"""Segments as a stream: the row-wise operators run on it as they are, rates are kept per window of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.operators import quality

ARRIVING = "call_id bigint, ordinal bigint, speaker string, start double, end double, raw_text string, asr_status string, arrived timestamp"


def read_segments(spark: SparkSession, path: str, schema: str = ARRIVING, files_at_once: int = 100) -> DataFrame:
    """A stream of JSON segment files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(path)


def flagged(segments: DataFrame, least: float = 1.5, most: float = 28.0) -> DataFrame:
    """Segments with their speech rate and confidence, without state."""
    return quality.flagged_segments(segments, least, most)


def confidence_rates(segments: DataFrame, every: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Low-confidence share per window of arrival; segments later than the watermark no longer count."""
    w = F.window("arrived", every)
    g = flagged(segments).withWatermark("arrived", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("segments"), F.count_if("low_confidence").alias("low"))
    return g.select(F.col("w.start").alias("window_start"), "segments", "low", (F.col("low") / F.col("segments")).alias("low_ratio"))

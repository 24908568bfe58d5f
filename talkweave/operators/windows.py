"""Semantic windows: greedy groups of segments within budgets of characters, time, gaps and speaker changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.functions import text as T

from .intervals import in_call


def assigned(segments: DataFrame, max_chars: int = 1000, max_duration_sec: float = 25.0, max_gap_sec: float = 1.2, max_speaker_switches: int = 6) -> DataFrame:
    """Segments with text (and ``position``), with ``window_index`` and stripped ``text``.

    A gap over its limit always splits, so calls are first cut into sessions at gaps; the budgets are then folded over
    each session as an array, and a running sum over the splits numbers the windows.
    """
    chars, seconds, gap, switches = max(80, int(max_chars)), max(5.0, float(max_duration_sec)), max(0.0, float(max_gap_sec)), max(0, int(max_speaker_switches))
    rows = segments.withColumn("text", T.strip(F.col("raw_text"))).filter("text <> ''")
    w = in_call("start", "end", "position")
    rows = rows.withColumn("__cut", F.coalesce((F.greatest(F.lit(0.0), F.col("start") - F.lag("end").over(w)) > gap).cast("int"), F.lit(1))).withColumn("__session", F.sum("__cut").over(w))
    items = rows.groupBy("call_id", "__session").agg(F.array_sort(F.collect_list(F.struct("start", "end", "position", "speaker", "text"))).alias("items"))
    zero = F.struct(F.lit(0.0).alias("first"), F.lit(0).alias("chars"), F.lit(0).alias("switches"), F.lit("").alias("speaker"), F.array().cast("array<int>").alias("new"))

    def step(a, x):
        changed = F.when(a["speaker"] != x["speaker"], 1).otherwise(0)
        n, s = a["chars"] + F.length(x["text"]), a["switches"] + changed
        split = (F.size(a["new"]) == 0) | (n > chars) | (F.greatest(F.lit(0.0), x["end"] - a["first"]) > seconds) | (s > switches)
        pick = lambda yes, no: F.when(split, yes).otherwise(no)
        return F.struct(pick(x["start"], a["first"]).alias("first"), pick(F.length(x["text"]), n).alias("chars"), pick(F.lit(0), s).alias("switches"), x["speaker"].alias("speaker"), F.concat(a["new"], F.array(pick(F.lit(1), F.lit(0)))).alias("new"))

    splits = F.aggregate("items", zero, step, lambda a: a["new"])
    each = items.withColumn("__new", splits).select("call_id", F.explode(F.arrays_zip("items", "__new")).alias("z"))
    flat = each.select("call_id", "z.items.start", "z.items.end", "z.items.position", "z.items.speaker", "z.items.text", F.col("z.__new").alias("new"))
    return flat.withColumn("window_index", (F.sum("new").over(w) - 1).cast("bigint")).drop("new")


def built(rows: DataFrame) -> DataFrame:
    """One row per window of ``assigned`` rows. Its end is the last segment's; ``speakers`` has each change once."""
    item = F.struct("start", "end", "position", "speaker", "text")
    g = rows.groupBy("call_id", "window_index").agg(F.array_sort(F.collect_list(item)).alias("items"))
    start, end = F.element_at("items", 1)["start"], F.element_at("items", -1)["end"]
    speakers = F.transform("items", lambda x: x["speaker"])
    return g.withColumn("__speakers", speakers).select(
        "call_id", "window_index", F.transform("items", lambda x: x["position"]).alias("segment_positions"), start.alias("start"), end.alias("end"), F.greatest(F.lit(0.0), end - start).alias("duration_sec"),
        F.filter("__speakers", lambda s, i: (i == 0) | (s != F.coalesce(F.get("__speakers", i - 1), F.lit("")))).alias("speakers"), F.size("items").cast("bigint").alias("segments_count"),
        F.aggregate("items", F.lit(0), lambda a, x: a + F.length(x["text"])).cast("bigint").alias("chars_count"), F.transform("items", lambda x: x["text"]).alias("texts"),
    )


def report(segments: DataFrame, windows: DataFrame, max_chars: int = 1000, max_duration_sec: float = 25.0, max_gap_sec: float = 1.2, max_speaker_switches: int = 6) -> DataFrame:
    """One row per call with segments."""
    g = windows.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("windows_total"), F.sum("segments_count").alias("segments_covered"), F.avg("segments_count").alias("avg_segments_per_window"), F.avg("chars_count").alias("avg_chars_per_window"),
        F.avg("duration_sec").alias("avg_window_duration_sec"), F.median("duration_sec").alias("median_window_duration_sec"), F.max("segments_count").alias("max_segments_per_window"),
    )
    every = segments.groupBy("call_id").agg(F.count(F.lit(1)).alias("segments_total")).join(g, "call_id", "left").fillna(0)
    return every.withColumns({"max_chars": F.lit(max(80, int(max_chars))).cast("bigint"), "max_duration_sec": F.lit(max(5.0, float(max_duration_sec))), "max_gap_sec": F.lit(max(0.0, float(max_gap_sec))), "max_speaker_switches": F.lit(max(0, int(max_speaker_switches))).cast("bigint")})


def with_segments(windows: DataFrame, segments: DataFrame) -> DataFrame:
    """Each window's segments by position, in order (``local_index``); positions without a segment go."""
    each = windows.select("call_id", "window_index", F.posexplode("segment_positions").alias("__place", "position"))
    joined = each.join(segments, ["call_id", "position"])
    place = Window.partitionBy("call_id", "window_index").orderBy("__place")
    return joined.withColumn("local_index", (F.row_number().over(place) - 1).cast("bigint")).drop("__place")

"""Text processing over semantic windows: anonymising, guarded enhancement, and their accounting."""

from __future__ import annotations

from collections.abc import Iterator
from time import perf_counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import text as T

from .model_calls import StoredModel
from .providers import TextProvider

CALLED = "call_id bigint, window_index bigint, local_index bigint, position bigint, source string, output string, failed boolean, fell_back boolean, called boolean, latency_ms double"


def called(rows: DataFrame, provider: TextProvider | StoredModel | None, task: str, strict: bool = False) -> DataFrame:
    """``rows`` (call_id, window_index, local_index, position, source) with the provider's ``output``, a call a window.

    Without a provider the sources pass. A failing call falls back to the sources, or raises if ``strict``; so does
    an answer of the wrong length; an empty answer to a text falls back alone. A ``StoredModel`` is asked by prompts,
    and its answers are kept.
    """
    if isinstance(provider, StoredModel):
        return provider.answers(rows, task, strict)
    if provider is None:
        return rows.select("call_id", "window_index", "local_index", "position", "source", F.col("source").alias("output"), F.lit(False).alias("failed"), F.lit(False).alias("fell_back"), F.lit(False).alias("called"), F.lit(0.0).alias("latency_ms"))
    gathered = rows.groupBy("call_id", "window_index").agg(F.array_sort(F.collect_list(F.struct("local_index", "position", "source"))).alias("items"))
    split = gathered.select("call_id", "window_index", F.transform("items", lambda x: x["local_index"]).alias("local"), F.transform("items", lambda x: x["position"]).alias("position"), F.transform("items", lambda x: x["source"]).alias("source"))

    def answer(texts: list[str]) -> tuple[list[str] | None, float]:
        began = perf_counter()
        try:
            got = getattr(provider, task)(texts)
        except Exception:
            if strict:
                raise
            got = None
        return (None if got is None or len(got) != len(texts) else list(got)), (perf_counter() - began) * 1000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                texts = list(r.source)
                got, ms = answer(texts)
                for i, (k, p, t) in enumerate(zip(r.local, r.position, texts, strict=True)):
                    back = got is None or not got[i].strip()
                    out.append((r.call_id, r.window_index, k, p, t, t if back else got[i], got is None, back, True, ms))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CALLED.split(", ")])

    return split.mapInPandas(run, CALLED)


def anonymized(segments: DataFrame, outputs: DataFrame | None = None) -> DataFrame:
    """Segments with ``anonymized_text``: a window's output, else the raw text; ``enhanced_text`` is empty."""
    base = segments.drop("anonymized_text", "enhanced_text")
    if outputs is not None:
        base = base.join(outputs.select("call_id", "position", "output"), ["call_id", "position"], "left")
    else:
        base = base.withColumn("output", F.lit(None).cast("string"))
    return base.withColumns({"anonymized_text": F.coalesce("output", "raw_text"), "enhanced_text": F.lit("")}).drop("output")


def _usage(outputs: DataFrame, **numbers: Column) -> DataFrame:
    """Per call, what its calls took and gave, and the sums over segments of further ``numbers``, in one pass."""
    per_window = outputs.groupBy("call_id", "window_index").agg(F.max("called").alias("called"), F.max("failed").alias("failed"), F.max("latency_ms").alias("ms"), F.sum(F.length("source")).alias("chars"), F.count(F.lit(1)).alias("n"), F.count_if("fell_back").alias("back"), *[F.sum(v).alias(k) for k, v in numbers.items()])
    c = F.col("called")
    g = per_window.groupBy("call_id").agg(
        F.count_if(c).alias("llm_calls_total"), F.sum(F.when(c, F.col("ms")).otherwise(0.0)).alias("llm_latency_total_ms"), F.sum(F.when(c, F.col("chars")).otherwise(0)).alias("__chars"), F.sum(F.when(c, F.col("n")).otherwise(0)).alias("__n"),
        F.count_if("failed").alias("windows_failed"), F.sum("back").alias("fallback_segments"), *[F.sum(k).alias(k) for k in numbers],
    )
    per = lambda x: F.when(F.col("llm_calls_total") > 0, F.col(x) / F.greatest(F.lit(1), F.col("llm_calls_total"))).otherwise(F.lit(0.0))
    return g.withColumns({"avg_chars_per_llm_call": per("__chars"), "avg_segments_per_llm_call": per("__n")}).drop("__chars", "__n")


def anonymize_report(windows: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row per call with windows. Personal data is only looked for where a provider was called.

    The outputs are read once: a window's numbers are summed over its segments, a call's over its windows.
    """
    called = F.col("called")
    if_called = lambda c: F.when(called, c)
    seen = outputs.withColumns({"__pii": if_called(T.pii_candidate(F.col("source"))), "__masks": if_called(T.placeholder_counts(F.col("output")))})
    entities = {f"__{e}": F.try_element_at("__masks", F.lit(e)) for e in sorted(T.PLACEHOLDERS)}
    usage = _usage(seen, pii_candidate_segments=F.col("__pii").cast("bigint"), masked_candidate_segments=(F.col("__pii") & (F.size("__masks") > 0)).cast("bigint"), **entities)
    rows = windows.groupBy("call_id").agg(F.count(F.lit(1)).alias("windows_total")).join(usage, "call_id", "left").fillna(0)
    counts = F.filter(F.array(*[F.struct(F.lit(e[2:]).alias("entity"), F.col(e).cast("bigint").alias("n")) for e in entities]), lambda x: x["n"] > 0)
    rows = rows.withColumn("entity_mask_counts", F.map_from_entries(counts)).drop(*entities)
    return rows.withColumn("anonymization_recall_proxy", F.col("masked_candidate_segments") / F.greatest(F.lit(1), F.col("pii_candidate_segments")))


def source_of() -> Column:
    """The anonymised text, or the raw one where that is empty."""
    return F.coalesce(F.nullif("anonymized_text", F.lit("")), "raw_text")


def enhanced_plainly(segments: DataFrame) -> DataFrame:
    """Deterministic enhancement of every segment; ``changed`` tells whether the text is another one now."""
    rows = segments.withColumn("__source", source_of())
    return rows.withColumn("enhanced_text", T.light_enhance(F.col("__source"))).withColumn("changed", F.col("enhanced_text") != F.col("__source")).drop("__source")


def guarded(source: Column, candidate: Column, low: Column) -> Column:
    """Low confidence: the plain enhancement; a candidate whose words differ: the source; else the candidate."""
    return F.when(low, T.light_enhance(source)).when(T.drifted(source, candidate), source).otherwise(candidate)


def enhanced_by(segments: DataFrame, windows: DataFrame, provider: TextProvider | StoredModel, skip_low_confidence: bool = True, strict: bool = False) -> DataFrame:
    """Enhancement by a provider, window by window, on segments with ``position`` and ``low_confidence``.

    Adds ``drifted``, ``skipped`` and ``windowed``. Segments in no window keep their source.
    """
    place = windows.select("call_id", "window_index", F.posexplode("segment_positions").alias("local_index", "position"))
    rows = segments.withColumn("__source", source_of()).join(place, ["call_id", "position"], "left").withColumn("windowed", F.col("window_index").isNotNull())
    low = F.col("low_confidence") & F.lit(bool(skip_low_confidence))
    asked = rows.filter(F.col("windowed") & ~low).select("call_id", "window_index", F.col("local_index").cast("bigint").alias("local_index"), "position", F.col("__source").alias("source"))
    got = called(asked, provider, "enhance", strict).select("call_id", "position", "output", "failed", "fell_back", "called", "latency_ms")
    out = rows.join(got, ["call_id", "position"], "left").withColumn("__out", F.coalesce("output", "__source"))
    skipped = F.col("windowed") & low
    return out.withColumns({"drifted": ~skipped & T.drifted(F.col("__source"), F.col("__out")), "skipped": skipped, "enhanced_text": F.when(~F.col("windowed"), F.col("__source")).otherwise(guarded(F.col("__source"), F.col("__out"), low))}).drop("__out")


def enhance_report(enhanced: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per call of ``enhanced_by`` rows."""
    per_window = enhanced.filter("windowed").groupBy("call_id", "window_index").agg(F.count(F.lit(1)).alias("n"), F.bool_and("skipped").alias("all_skipped"))
    only = per_window.groupBy("call_id").agg(F.sum(F.when(F.col("all_skipped"), F.col("n")).otherwise(0)).alias("deterministic_only_segments"))
    flags = enhanced.groupBy("call_id").agg(F.count_if("drifted").alias("semantic_drift_flags_total"), F.count_if("skipped").alias("low_confidence_segments_skipped"))
    usage = _usage(enhanced.filter("called").withColumn("source", F.col("__source")))
    return windows.groupBy("call_id").agg(F.count(F.lit(1)).alias("windows_total")).join(flags, "call_id").join(only, "call_id", "left").join(usage, "call_id", "left").fillna(0)


def plain_report(enhanced: DataFrame) -> DataFrame:
    """One row per call of ``enhanced_plainly`` rows; there are no calls to report."""
    zeros = {c: F.lit(0).cast("bigint") for c in ("llm_calls_total", "windows_total", "windows_failed", "fallback_segments", "semantic_drift_flags_total", "low_confidence_segments_skipped")} | {c: F.lit(0.0) for c in ("llm_latency_total_ms", "avg_chars_per_llm_call", "avg_segments_per_llm_call")}
    return enhanced.groupBy("call_id").agg(F.count(F.lit(1)).alias("deterministic_only_segments"), F.count_if("changed").alias("deterministic_changed_segments")).withColumns(zeros)

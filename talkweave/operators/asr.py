"""Speech recognition over chunks: which are long enough, batches, the model call, and its report."""

from __future__ import annotations

from collections.abc import Iterator
from time import perf_counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkweave.functions import text as T

from .providers import Recognizer


def with_eligibility(chunks: DataFrame, min_chunk_duration_sec: float = 0.25) -> DataFrame:
    """Adds ``duration_sec`` and ``eligible``: not shorter than the least duration."""
    rows = chunks.withColumn("duration_sec", F.greatest(F.lit(0.0), F.col("end") - F.col("start")))
    return rows.withColumn("eligible", F.col("duration_sec") >= max(0.0, min_chunk_duration_sec))


def batch_size_of(batch_size: int, orchestration_batch_size: int) -> int:
    return max(1, int(batch_size), int(orchestration_batch_size))


def with_batches(chunks: DataFrame, batch_size: int = 8, orchestration_batch_size: int = 64, min_chunk_duration_sec: float = 0.25) -> DataFrame:
    """Eligible chunks with ``batch_id``: so many in input order make a batch of their call."""
    w = Window.partitionBy("call_id").orderBy("ordinal")
    place = (F.row_number().over(w) - 1) / batch_size_of(batch_size, orchestration_batch_size)
    return with_eligibility(chunks, min_chunk_duration_sec).filter("eligible").withColumn("batch_id", F.floor(place).cast("bigint"))


RECOGNIZED = "call_id bigint, batch_id bigint, ordinal bigint, idx bigint, raw_text string, status string, batch_latency_ms double, provider string, model string, fallback_used boolean, fallback_reason string, error string"


def recognized(batches: DataFrame, model: Recognizer, batch_size: int = 8, pretokenize: bool = False, fallback: Recognizer | None = None) -> DataFrame:
    """One model call per batch, in the order of batches. A batch on which the model fails goes to ``fallback``; what fails
    there too, or without one, makes its own batch errors, with the reason; missing outputs make theirs."""

    def called(paths: list[str]) -> tuple[list[str], Recognizer, list[str]]:
        reasons: list[str] = []
        for m in (model, fallback):
            if m is not None:
                try:
                    return list(m.transcribe_batch(paths, max(1, int(batch_size)), pretokenize)), m, reasons
                except Exception as e:  # whatever a model raises stays with its batch
                    reasons.append(f"{type(e).__name__}: {e}")
        return [], fallback or model, reasons

    def batch(rows: pd.DataFrame) -> pd.DataFrame:
        began, n = perf_counter(), len(rows)
        texts, by, reasons = called(rows["chunk_path"].tolist())
        failed = len(reasons) == 1 + (fallback is not None)
        return pd.DataFrame({
            "call_id": rows["call_id"], "batch_id": rows["batch_id"], "ordinal": rows["ordinal"], "idx": rows["idx"], "raw_text": (texts + [""] * n)[:n],
            "status": ["error" if failed or i >= len(texts) else "ok" for i in range(n)], "batch_latency_ms": (perf_counter() - began) * 1000, "provider": by.provider_name, "model": by.model_name,
            "fallback_used": bool(reasons) and fallback is not None, "fallback_reason": reasons[0] if reasons and fallback is not None else "", "error": reasons[-1] if failed else "",
        })

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come by call and batch; the last batch of a part may go on in the next one."""
        rest: pd.DataFrame | None = None
        for p in parts:
            p = p if rest is None else pd.concat([rest, p])
            last = (p["call_id"] == p["call_id"].iloc[-1]) & (p["batch_id"] == p["batch_id"].iloc[-1])
            rest = p[last]
            for _, rows in p[~last].groupby(["call_id", "batch_id"], sort=False):
                yield batch(rows)
        if rest is not None:
            yield batch(rest)

    rows = batches.select("call_id", "batch_id", "ordinal", "idx", "chunk_path").repartition("call_id").sortWithinPartitions("call_id", "batch_id", "ordinal")
    return rows.mapInPandas(run, RECOGNIZED)


def provider_report(found: DataFrame, requested: str) -> DataFrame:
    """Per call: which recogniser was asked for, which answered last, its model, and whether and why it was a fallback."""
    last = F.max_by(F.struct("provider", "model"), "ordinal")
    g = found.groupBy("call_id").agg(last.alias("p"), F.max("fallback_used").alias("asr_fallback_used"), F.coalesce(F.min_by(F.nullif("fallback_reason", F.lit("")), F.when(F.col("fallback_reason") != "", F.col("ordinal"))), F.lit("")).alias("asr_fallback_reason"))
    return g.select("call_id", F.lit(requested).alias("asr_provider_requested"), F.col("p.provider").alias("asr_provider_effective"), F.col("p.model").alias("asr_model"), "asr_fallback_used", "asr_fallback_reason")


def transcripts(chunks: DataFrame, found: DataFrame, min_chunk_duration_sec: float = 0.25) -> DataFrame:
    """One row per chunk in input order: short ones skipped, those without an answer errors."""
    right = found.select("call_id", "idx", "raw_text", "status")
    rows = with_eligibility(chunks.select("call_id", "ordinal", "idx", "start", "end"), min_chunk_duration_sec).join(right, ["call_id", "idx"], "left")
    status = F.when(~F.col("eligible"), "skipped_short").otherwise(F.coalesce("status", F.lit("error")))
    return rows.select("call_id", "ordinal", "idx", F.coalesce("raw_text", F.lit("")).alias("raw_text"), status.alias("status"))


def report(chunks: DataFrame, texts: DataFrame, batch_size: int = 8, orchestration_batch_size: int = 64, min_chunk_duration_sec: float = 0.25) -> DataFrame:
    """One row per call, without the clock's columns: counts, coverage, characters a second, batches."""
    rows = with_eligibility(chunks.select("call_id", "idx", "start", "end"), min_chunk_duration_sec).join(texts.select("call_id", "idx", "raw_text", "status"), ["call_id", "idx"], "left")
    e, ok, size = F.col("eligible"), F.coalesce(F.col("status") == "ok", F.lit(False)), batch_size_of(batch_size, orchestration_batch_size)
    n = F.length(T.strip(F.col("raw_text")))
    g = rows.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("total_chunks"), F.count_if(e).alias("eligible_chunks"), F.count_if(e & ok).alias("processed_chunks"), F.count_if(~e).alias("skipped_short_chunks"), F.count_if(e & ~ok).alias("failed_chunks"),
        F.sum("duration_sec").alias("__all"), F.coalesce(F.sum(F.when(e, F.col("duration_sec"))), F.lit(0.0)).alias("__long"), F.coalesce(F.sum(F.when(e & ok, n)), F.lit(0)).alias("__chars"), F.count_if(e & ok & (n == 0)).alias("__empty"),
    )
    batches = F.ceil(F.col("eligible_chunks") / size).cast("bigint")
    g = g.withColumn("orchestration_batches_total", batches)
    sizes = F.when(F.col("orchestration_batches_total") > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), "orchestration_batches_total")), lambda i: F.least(F.lit(size).cast("bigint"), F.col("eligible_chunks") - (i - 1) * size))).otherwise(F.array().cast("array<bigint>"))
    any_ = F.col("eligible_chunks") > 0
    return g.select(
        "call_id", "total_chunks", "eligible_chunks", "processed_chunks", "skipped_short_chunks", "failed_chunks", F.lit(max(1, batch_size)).cast("bigint").alias("asr_batch_size"), F.lit(size).cast("bigint").alias("asr_orchestration_batch_size"),
        F.when(any_ & (F.col("__all") > 0), F.col("__long") / F.greatest(F.lit(1e-300), F.col("__all"))).otherwise(0.0).alias("asr_audio_coverage_ratio"),
        F.when(any_, F.col("__chars") / F.greatest(F.lit(1e-6), F.col("__long"))).otherwise(0.0).alias("chars_per_second_of_audio"), (F.col("__empty") / F.greatest(F.lit(1), F.col("processed_chunks"))).alias("empty_asr_output_ratio"),
        "orchestration_batches_total", sizes.alias("actual_orchestration_batch_sizes"),
    )


def nearest_rank(values: Column, ratio: float) -> Column:
    """The value at the half-even rounded place of a sorted list; 0 for an empty one."""
    n = F.size(values)
    at = F.least(F.greatest(F.bround((n - 1) * F.lit(float(ratio))).cast("int"), F.lit(0)), F.greatest(n - 1, F.lit(0)))
    return F.coalesce(F.get(F.array_sort(values), at), F.lit(0.0))


def latency_report(found: DataFrame, chunks: DataFrame, min_chunk_duration_sec: float = 0.25) -> DataFrame:
    """The clock's columns, from the batches of ``recognized``."""
    batches = found.groupBy("call_id", "batch_id").agg(F.max("batch_latency_ms").alias("ms")).groupBy("call_id").agg(F.sum("ms").alias("asr_latency_total_ms"), F.collect_list("ms").alias("__ms"))
    audio = with_eligibility(chunks, min_chunk_duration_sec).groupBy("call_id").agg(F.sum("duration_sec").alias("__all"), F.coalesce(F.sum(F.when(F.col("eligible"), F.col("duration_sec"))), F.lit(0.0)).alias("__long"))
    rows = audio.join(batches, "call_id", "left").withColumns({"asr_latency_total_ms": F.coalesce("asr_latency_total_ms", F.lit(0.0)), "__ms": F.coalesce("__ms", F.array().cast("array<double>"))})
    total = F.col("asr_latency_total_ms")
    return rows.select(
        "call_id", "asr_latency_total_ms", F.when(F.col("__all") > 0, total / (F.greatest(F.col("__all"), F.lit(1e-300)) / 60)).otherwise(0.0).alias("asr_latency_per_min_audio_ms"),
        nearest_rank(F.col("__ms"), 0.5).alias("orchestration_batch_latency_ms_p50"), nearest_rank(F.col("__ms"), 0.9).alias("orchestration_batch_latency_ms_p90"),
        F.when(total > 0, F.col("__long") / F.greatest(F.lit(1e-6), total / 1000)).otherwise(0.0).alias("asr_throughput_audio_sec_per_wall_sec"),
    )

"""The conversation pipeline in one plan: from segments to metrics and documents, with stages as tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.operators import asr, chunks, enrichment, intervals, quality, report, transcript, windows
from talkweave.operators.model_calls import StoredModel, TextModel
from talkweave.operators.providers import Recognizer, TextProvider

from .artifacts import Artifacts
from .config import Settings

STAGES = ("normalize_audio", "enhance_audio", "diarization", "postprocess_segments", "audio_chunks", "asr_transcripts", "merge_transcript", "clean_transcript", "semantic_windows", "anonymize_transcript", "enhance_transcript", "quality_report", "call_result")


@dataclass
class Result:
    metrics: DataFrame
    documents: DataFrame
    quality_rows: DataFrame
    final: DataFrame


def run(diarization: DataFrame, durations: DataFrame, recognizer: Recognizer, settings: Settings, artifacts: Artifacts | None = None, text: TextProvider | TextModel | StoredModel | None = None, fallback: Recognizer | None = None) -> Result:
    """``diarization`` has call_id, ordinal, idx, speaker, start, end; ``durations`` call_id, audio_sec.

    ``text`` is a provider of lists, a model that answers prompts (its answers are kept beside the artifacts), or none.
    Tables that several results read are persisted, or else kept as artifacts; the caller may unpersist them.
    """
    if settings.text_enhancement_mode != "deterministic" and text is None:
        raise ValueError(f"enhancement mode {settings.text_enhancement_mode!r} needs a text provider")
    if text is not None and hasattr(text, "generate"):
        if artifacts is None:
            raise ValueError("a text model needs artifacts, where its answers are kept")
        text = StoredModel(text, f"{settings.artifacts_root}/answers")
    if artifacts:
        artifacts.reads(diarization, durations)
    keep = artifacts.table if artifacts else (lambda name, make, after=(): make().persist())
    s = settings
    limits = dict(min_duration_ms=s.segment_min_duration_ms, merge_gap_ms=s.segment_merge_gap_ms, padding_ms=s.segment_padding_ms, absorb_short_gap_ms=s.segment_absorb_short_gap_ms)
    segs = intervals.with_duration(intervals.reindexed(intervals.valid(diarization)), durations)
    entries = keep("postprocess_segments", lambda: intervals.resolved_entries(segs, **limits))
    post = intervals.report(segs, entries, **limits)
    out = intervals.groups(entries).select("call_id", F.col("output_index").alias("idx"), F.col("output_index").alias("ordinal"), "speaker", "start", "end")
    cut = chunks.manifest(intervals.with_duration(out, durations), s.target_sample_rate).drop("audio_sec", "start_frame", "end_frame").persist()
    batches = asr.with_batches(cut, s.asr_batch_size, s.asr_orchestration_batch_size, s.asr_min_chunk_duration_sec)
    found = keep("asr_transcripts", lambda: asr.recognized(batches, recognizer, s.asr_batch_size, s.asr_pretokenize, fallback), ("postprocess_segments",))
    texts = asr.transcripts(cut, found, s.asr_min_chunk_duration_sec)
    asr_report = asr.report(cut, texts, s.asr_batch_size, s.asr_orchestration_batch_size, s.asr_min_chunk_duration_sec)
    clean = transcript.positioned(transcript.cleaned(transcript.assembled(cut, texts), s.cleanup_min_duration_ms, s.cleanup_duplicate_window_ms))
    clean = quality.flagged_segments(clean, s.low_confidence_min_cps, s.low_confidence_max_cps).persist()
    w = windows.built(windows.assigned(clean, s.llm_window_max_chars, s.llm_window_max_duration_sec, s.llm_window_max_gap_sec, s.llm_window_max_speaker_switches)).persist()
    inside = windows.with_segments(w, clean).withColumnRenamed("raw_text", "source")
    answers = keep("anonymize_transcript", lambda: enrichment.called(inside, text, "anonymize", s.text_strict), ("asr_transcripts",))
    named = enrichment.anonymized(clean, answers)
    if s.text_enhancement_mode == "deterministic":
        final = enrichment.enhanced_plainly(named).persist()
        enhance_report = enrichment.plain_report(final)
    else:
        final = keep("enhance_transcript", lambda: enrichment.enhanced_by(named, w, text, s.enhancement_skip_low_confidence, s.text_strict), ("anonymize_transcript",))
        enhance_report = enrichment.enhance_report(final, w)
    rows = quality.chunk_rows(cut, texts, final, s.low_confidence_min_cps, s.low_confidence_max_cps)
    anonymous = enrichment.anonymize_report(w, answers)
    metrics = report.call_metrics(post, asr_report, anonymous, enhance_report, quality.summary(rows, s.low_confidence_min_cps, s.low_confidence_max_cps), final)
    metrics = report.with_latencies(metrics, asr.latency_report(found, cut, s.asr_min_chunk_duration_sec), anonymous, enhance_report)
    metrics = metrics.join(asr.provider_report(found, s.asr_provider), "call_id", "left")
    return Result(metrics, report.documents(metrics, final, s.input_path, s.run_dir()), rows, final)


def describe() -> dict[str, str]:
    """What does each stage: the operator, or the provider that it calls."""
    return {
        "normalize_audio": "sources.audio.normalised", "enhance_audio": "sources.audio.enhanced", "diarization": "sources.audio.diarized (Diarizer)", "postprocess_segments": "operators.intervals.resolved_entries",
        "audio_chunks": "operators.chunks.manifest, sources.audio.sliced", "asr_transcripts": "operators.asr.recognized (Recognizer)", "merge_transcript": "operators.transcript.assembled", "clean_transcript": "operators.transcript.cleaned",
        "semantic_windows": "operators.windows.built", "anonymize_transcript": "operators.enrichment.called (TextProvider)", "enhance_transcript": "operators.enrichment.enhanced_by (TextProvider) or enhanced_plainly", "quality_report": "operators.quality.chunk_rows",
        "call_result": "operators.report.documents",
    }

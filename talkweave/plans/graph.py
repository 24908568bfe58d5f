"""From a folder of recordings to one document per call: thirteen stages, each a table that is kept.

A stage names the stages it reads and the settings it depends on. Its fingerprint covers these, the fingerprints of what
it reads, and for the first stage the input's files; so a change makes the stages after it anew and no others, and a
stage whose table is fresh asks for nothing before it. ``until`` ends the run at any stage.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.operators import asr, chunks, enrichment, intervals, quality, report, transcript, windows
from talkweave.operators.model_calls import StoredModel, TextModel
from talkweave.operators.providers import Diarizer, Recognizer, TextProvider
from talkweave.sources import audio, wav

from .artifacts import Artifacts
from .config import Settings


@dataclass(frozen=True)
class Stage:
    make: Callable[[Graph], DataFrame]
    after: tuple[str, ...] = ()
    settings: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()


def call_of(path: Column) -> Column:
    """The id of a recording's call: a hash of its path, so that other recordings don't change it."""
    return F.xxhash64(path).bitwiseAND((1 << 63) - 1)


class Graph:
    """Stages by name; ``stages`` replaces some of them by others that give the same columns."""

    def __init__(self, spark: SparkSession, settings: Settings, recognizer: Recognizer, diarizer: Diarizer, text: TextProvider | TextModel | None = None, fallback: Recognizer | None = None, stages: dict[str, Stage] | None = None):
        if settings.text_enhancement_mode != "deterministic" and text is None:
            raise ValueError(f"enhancement mode {settings.text_enhancement_mode!r} needs a text provider")
        unknown = set(stages or {}) - set(STAGES)
        if unknown:
            raise ValueError(f"no such stages: {', '.join(sorted(unknown))}")
        self.spark, self.settings, self.stages = spark, settings, STAGES | (stages or {})
        self.recognizer, self.diarizer, self.fallback = recognizer, diarizer, fallback
        self.text = StoredModel(text, f"{settings.artifacts_root}/answers") if hasattr(text, "generate") else text
        self.artifacts = Artifacts(spark, settings)
        self.artifacts.reads(audio.read_audio(spark, settings.input_path))
        self._tables: dict[str, DataFrame] = {}

    def fingerprint(self, name: str) -> str:
        stage = self.stages[name]
        own = {k: getattr(self.settings, k) for k in stage.settings}
        parts = [name, json.dumps(own, sort_keys=True), *(self.fingerprint(a) for a in stage.after)] + ([] if stage.after else [self.artifacts.inputs])
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()

    def folder(self, name: str) -> str:
        """Where a stage keeps files beside its table: one folder per fingerprint, so that no run reads another's."""
        return f"{self.artifacts.folder}/{name}.files/{self.fingerprint(name)[:16]}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.artifacts.kept(name, self.fingerprint(name), lambda: self._made(name))
        return self._tables[name]

    def _made(self, name: str) -> DataFrame:
        found = self.stages[name].make(self)
        missing = set(self.stages[name].columns or STAGES[name].columns) - set(found.columns)
        if missing:
            raise ValueError(f"stage {name} lacks {', '.join(sorted(missing))}")
        return found

    def run(self, until: str = "call_result") -> DataFrame:
        """The table of a stage; what it needs is made if it isn't fresh."""
        if until not in self.stages:
            raise ValueError(f"no such stage: {until}; there are {', '.join(self.stages)}")
        return self[until]


def _normalized(g: Graph) -> DataFrame:
    files = audio.normalised(audio.read_audio(g.spark, g.settings.input_path), g.settings.target_sample_rate)
    return wav.saved(files, g.folder("normalize_audio")).withColumn("call_id", call_of(F.col("path")))


def _enhanced(g: Graph) -> DataFrame:
    s, before = g.settings, g["normalize_audio"]
    name = lambda c: F.regexp_extract(c, "([^/]+)$", 1)
    files = audio.read_audio(g.spark, f"{g.folder('normalize_audio')}/*.wav").withColumnRenamed("content", "wav")
    options = audio.Enhancement(s.audio_denoise_strength, s.audio_noise_quantile, s.audio_highpass_hz, s.audio_target_rms_dbfs, s.audio_target_peak_dbfs)
    out = wav.saved(audio.enhanced(files, s.target_sample_rate, options, s.enable_audio_enhancement), g.folder("enhance_audio"), "float32")
    return out.withColumn("name", name("path")).join(before.select("call_id", name("output_path").alias("name")), "name").drop("name")


def _durations(g: Graph) -> DataFrame:
    return g["enhance_audio"].select("call_id", F.col("duration_sec").alias("audio_sec"))


def _diarized(g: Graph) -> DataFrame:
    return audio.diarized(g["enhance_audio"].select("call_id", F.col("output_path").alias("path")), g.diarizer)


def _segments(g: Graph) -> DataFrame:
    return intervals.with_duration(intervals.reindexed(intervals.valid(g["diarization"])), _durations(g))


def _limits(s: Settings) -> dict[str, int]:
    return dict(min_duration_ms=s.segment_min_duration_ms, merge_gap_ms=s.segment_merge_gap_ms, padding_ms=s.segment_padding_ms, absorb_short_gap_ms=s.segment_absorb_short_gap_ms)


def _chunks(g: Graph) -> DataFrame:
    out = intervals.groups(g["postprocess_segments"]).select("call_id", F.col("output_index").alias("idx"), F.col("output_index").alias("ordinal"), "speaker", "start", "end")
    rows = chunks.manifest(intervals.with_duration(out, _durations(g)), g.settings.target_sample_rate).drop("audio_sec")
    rows = rows.join(g["enhance_audio"].select("call_id", F.col("output_path").alias("source")), "call_id").withColumn("name", F.concat_ws("/", F.col("call_id").cast("string"), "chunk_path"))
    wav.cut(rows, g.folder("audio_chunks"))
    return rows.withColumn("chunk_path", F.concat(F.lit(g.folder("audio_chunks") + "/"), "name")).drop("name", "source")


def _recognized(g: Graph) -> DataFrame:
    s = g.settings
    batches = asr.with_batches(g["audio_chunks"], s.asr_batch_size, s.asr_orchestration_batch_size, s.asr_min_chunk_duration_sec)
    return asr.recognized(batches, g.recognizer, s.asr_batch_size, s.asr_pretokenize, g.fallback)


def _texts(g: Graph) -> DataFrame:
    return asr.transcripts(g["audio_chunks"], g["asr_transcripts"], g.settings.asr_min_chunk_duration_sec)


def _clean(g: Graph) -> DataFrame:
    s = g.settings
    rows = transcript.positioned(transcript.cleaned(g["merge_transcript"], s.cleanup_min_duration_ms, s.cleanup_duplicate_window_ms))
    return quality.flagged_segments(rows, s.low_confidence_min_cps, s.low_confidence_max_cps)


def _windows(g: Graph) -> DataFrame:
    s = g.settings
    return windows.built(windows.assigned(g["clean_transcript"], s.llm_window_max_chars, s.llm_window_max_duration_sec, s.llm_window_max_gap_sec, s.llm_window_max_speaker_switches))


def _anonymized(g: Graph) -> DataFrame:
    inside = windows.with_segments(g["semantic_windows"], g["clean_transcript"]).withColumnRenamed("raw_text", "source")
    return enrichment.called(inside, g.text, "anonymize", g.settings.text_strict)


def _final(g: Graph) -> DataFrame:
    s, named = g.settings, enrichment.anonymized(g["clean_transcript"], g["anonymize_transcript"])
    if s.text_enhancement_mode == "deterministic":
        return enrichment.enhanced_plainly(named)
    return enrichment.enhanced_by(named, g["semantic_windows"], g.text, s.enhancement_skip_low_confidence, s.text_strict)


def _quality(g: Graph) -> DataFrame:
    s = g.settings
    return quality.chunk_rows(g["audio_chunks"], _texts(g), g["enhance_transcript"], s.low_confidence_min_cps, s.low_confidence_max_cps)


def _result(g: Graph) -> DataFrame:
    s, cut, final, found = g.settings, g["audio_chunks"], g["enhance_transcript"], g["asr_transcripts"]
    w, plain = g["semantic_windows"], s.text_enhancement_mode == "deterministic"
    anonymous = enrichment.anonymize_report(w, g["anonymize_transcript"])
    enhance = enrichment.plain_report(final) if plain else enrichment.enhance_report(final, w)
    asr_report = asr.report(cut, _texts(g), s.asr_batch_size, s.asr_orchestration_batch_size, s.asr_min_chunk_duration_sec)
    post = intervals.report(_segments(g), g["postprocess_segments"], **_limits(s))
    metrics = report.call_metrics(post, asr_report, anonymous, enhance, quality.summary(g["quality_report"], s.low_confidence_min_cps, s.low_confidence_max_cps), final)
    metrics = report.with_latencies(metrics, asr.latency_report(found, cut, s.asr_min_chunk_duration_sec), anonymous, enhance)
    metrics = metrics.join(asr.provider_report(found, s.asr_provider), "call_id", "left").join(_durations(g).select("call_id", (F.col("audio_sec") / 60.0).alias("audio_minutes")), "call_id", "left")
    return report.documents(metrics, final, s.input_path, s.run_dir())


#: The names of the stages, in their order, and the columns that later stages read.
STAGES: dict[str, Stage] = {
    "normalize_audio": Stage(_normalized, (), ("target_sample_rate",), ("call_id", "path", "output_path", "sample_rate", "duration_sec", "channels", "format")),
    "enhance_audio": Stage(_enhanced, ("normalize_audio",), ("enable_audio_enhancement", "audio_denoise_strength", "audio_noise_quantile", "audio_highpass_hz", "audio_target_rms_dbfs", "audio_target_peak_dbfs"), ("call_id", "output_path", "duration_sec")),
    "diarization": Stage(_diarized, ("enhance_audio",), ("diarizer",), ("call_id", "ordinal", "idx", "speaker", "start", "end")),
    "postprocess_segments": Stage(lambda g: intervals.resolved_entries(_segments(g), **_limits(g.settings)), ("diarization",), ("segment_min_duration_ms", "segment_merge_gap_ms", "segment_padding_ms", "segment_absorb_short_gap_ms"), ("call_id", "seq", "speaker", "start", "end", "source_indices", "merge_reasons")),
    "audio_chunks": Stage(_chunks, ("enhance_audio", "postprocess_segments"), ("target_sample_rate",), ("call_id", "idx", "ordinal", "speaker", "start", "end", "chunk_path")),
    "asr_transcripts": Stage(_recognized, ("audio_chunks",), ("asr_provider", "asr_fallback_provider", "asr_model", "asr_batch_size", "asr_orchestration_batch_size", "asr_min_chunk_duration_sec", "asr_pretokenize"), ("call_id", "batch_id", "idx", "raw_text", "status")),
    "merge_transcript": Stage(lambda g: transcript.assembled(g["audio_chunks"], _texts(g)), ("audio_chunks", "asr_transcripts"), ("asr_min_chunk_duration_sec",), ("call_id", "ordinal", "speaker", "start", "end", "raw_text", "chunk_path", "asr_status")),
    "clean_transcript": Stage(_clean, ("merge_transcript",), ("cleanup_min_duration_ms", "cleanup_duplicate_window_ms", "low_confidence_min_cps", "low_confidence_max_cps"), ("call_id", "position", "speaker", "start", "end", "raw_text", "chunk_path", "asr_status", "low_confidence")),
    "semantic_windows": Stage(_windows, ("clean_transcript",), ("llm_window_max_chars", "llm_window_max_duration_sec", "llm_window_max_gap_sec", "llm_window_max_speaker_switches"), ("call_id", "window_index", "segment_positions")),
    "anonymize_transcript": Stage(_anonymized, ("clean_transcript", "semantic_windows"), ("text_provider", "text_strict"), ("call_id", "window_index", "position", "source", "output", "failed", "fell_back", "called", "latency_ms")),
    "enhance_transcript": Stage(_final, ("clean_transcript", "semantic_windows", "anonymize_transcript"), ("text_provider", "text_strict", "text_enhancement_mode", "enhancement_skip_low_confidence"), ("call_id", "position", "anonymized_text", "enhanced_text")),
    "quality_report": Stage(_quality, ("audio_chunks", "asr_transcripts", "enhance_transcript"), ("low_confidence_min_cps", "low_confidence_max_cps", "asr_min_chunk_duration_sec"), ("call_id", "chunk_index", "low_confidence_marker")),
    "call_result": Stage(_result, ("diarization", "postprocess_segments", "audio_chunks", "asr_transcripts", "semantic_windows", "anonymize_transcript", "enhance_transcript", "quality_report"), ("text_enhancement_mode", "asr_provider"), ("call_id", "metrics", "segments")),
}

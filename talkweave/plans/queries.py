"""The registered queries: each operator on segments derived from the tables, results as flat, rounded columns."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.functions import text as T
from talkweave.operators import asr, chunks, enrichment, intervals, quality, report, transcript, windows
from talkweave.operators.model_calls import StoredModel
from talkweave.sources import audio, fixtures, wav
from talkweave.sources.store import shared_folder


def r6(c: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def joined(c: str, name: str | None = None) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(name or c)


def times() -> tuple[Column, Column]:
    return r6("start", "start_sec"), r6("end", "end_sec")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Dense segments; the audio ends where the last segment starts, so that some are cut."""
    e = fixtures.event_segments(spark, sf)
    return intervals.with_duration(e, e.groupBy("call_id").agg(F.max("start").alias("audio_sec")))


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.conversation_segments(spark, sf)


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = intervals.reindexed(_segments(spark, sf))
    return rows.withColumn("chunk_path", chunks.chunk_path(F.col("idx"), F.col("speaker")))


def _transcripts(chunk: DataFrame) -> DataFrame:
    """Of the chunks' texts: some are missing, some come twice."""
    rows = chunk.select("call_id", "idx", "ordinal", "raw_text", F.col("asr_status").alias("status")).filter("idx % 13 <> 5")
    again = rows.filter("idx % 7 = 3").withColumns({"ordinal": F.col("ordinal") + 2000000, "raw_text": F.concat(F.col("raw_text"), F.lit(" again"))})
    return rows.unionByName(again)


@dataclass
class Call:
    """Tables that several parts of one query read: kept while it runs, so that their plans run once."""

    chunk: DataFrame
    said: DataFrame
    final: DataFrame

    @property
    def bare(self) -> DataFrame:
        return self.chunk.drop("raw_text", "asr_status")


def _call(spark: SparkSession, sf: str) -> Call:
    chunk = _chunks(spark, sf).persist()
    said = _transcripts(chunk)
    rows = transcript.assembled(chunk.drop("raw_text", "asr_status"), said)
    return Call(chunk, said, enrichment.enhanced_plainly(enrichment.anonymized(transcript.positioned(transcript.cleaned(rows)))).persist())


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with languages and placeholders that the tables lack, beside the conversations'."""
    given = spark.createDataFrame(list(enumerate(GIVEN)), "text_id bigint, text string")
    own = fixtures.table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn") + 1000).alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    return given.unionByName(own)


#: Inline rows: mixed scripts, ties, placeholders, personal data, payloads.
GIVEN = (
    "сәлем как дела", "мен қазір приду", "приvet мир", "да hi", "123", "", "қазir", "[ИМЯ] звонил [ИМЯ] на [EMAIL]", "[ТЕЛЕФОН] [ID] [АДРЕС] [ID]", "Hello, world!  (yes) 'no'",
    "call +7 (701) 123-45-67 now", "mail a.b@c.org please", "id 12345678 end", "  алло   милиция  да   это  ", "ok go да нет", "hello мир привет world қала",
    'x <SEG id="0">one</SEG> <seg id=1> two </seg>', '<SEG id="0">a</SEG>', "<SEG id='1'>b</SEG><SEG id='0'>c</SEG><SEG id='1'>d</SEG>",
)


def valid_segments(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.valid(_segments(spark, sf)).select("call_id", "ordinal", "speaker", *times())


def reindex_segments(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.reindexed(_events(spark, sf)).select("call_id", "ordinal", "idx", "speaker", *times())


def clip_segments(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.clipped(_events(spark, sf)).select("call_id", "ordinal", "speaker", *times())


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merged(intervals.clipped(_events(spark, sf)), 300)


def merge_same_speaker(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("call_id", "speaker", *times(), joined("source_indices"), joined("merge_reasons"), "n_merged")


def pad_segments(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.padded(_merged(spark, sf), 60).select("call_id", "speaker", *times(), joined("source_indices"))


def absorb_short(spark: SparkSession, sf: str) -> DataFrame:
    rows = intervals.absorbed(_merged(spark, sf), 450, 220).withColumns({c: F.array_sort(F.array_distinct(c)) for c in ("source_indices", "merge_reasons")})
    return rows.select("call_id", "speaker", *times(), joined("source_indices"), joined("merge_reasons"), "n_absorbed")


def resolve_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = intervals.resolved(intervals.padded(_merged(spark, sf), 60), 450)
    return intervals.valid(rows).select("call_id", "speaker", *times())


def merge_groups(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.groups(intervals.resolved_entries(_events(spark, sf))).select("call_id", "output_index", "speaker", *times(), r6("duration_sec"), joined("source_indices"), joined("merge_reasons"))


def postprocess_report(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf)
    rows = intervals.report(e, intervals.resolved_entries(e))
    return rows.withColumns({c: F.round(c, 6) for c in ("short_segment_ratio_before", "short_segment_ratio_after")})


def chunk_manifest(spark: SparkSession, sf: str) -> DataFrame:
    rows = intervals.with_duration(intervals.reindexed(_segments(spark, sf)))
    return chunks.manifest(rows).select("call_id", "idx", "start_frame", "end_frame", "chunk_path")


def asr_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    return asr.with_eligibility(_chunks(spark, sf)).select("call_id", "idx", r6("duration_sec"), F.when(F.col("eligible"), "ok").otherwise("skipped_short").alias("status"))


def asr_batches(spark: SparkSession, sf: str) -> DataFrame:
    return asr.with_batches(_chunks(spark, sf), 2, 4).groupBy("call_id", "batch_id").agg(F.count(F.lit(1)).alias("n_chunks"), r6(F.sum("duration_sec"), "audio_sec"))


def asr_report(spark: SparkSession, sf: str) -> DataFrame:
    chunk = _chunks(spark, sf)
    texts = transcript.last_by(_transcripts(chunk), ["call_id", "idx"], "ordinal")
    rows = asr.report(chunk, texts, 2, 4)
    ratios = ("asr_audio_coverage_ratio", "chars_per_second_of_audio", "empty_asr_output_ratio")
    return rows.withColumns({c: F.round(c, 6) for c in ratios}).withColumn("actual_orchestration_batch_sizes", joined("actual_orchestration_batch_sizes"))


def nearest_rank_percentile(spark: SparkSession, sf: str) -> DataFrame:
    g = _segments(spark, sf).groupBy("call_id").agg(F.collect_list(F.col("end") - F.col("start")).alias("d"))
    return g.select("call_id", r6(asr.nearest_rank(F.col("d"), 0.5), "p50"), r6(asr.nearest_rank(F.col("d"), 0.9), "p90"))


def merge_transcript(spark: SparkSession, sf: str) -> DataFrame:
    chunk = _chunks(spark, sf)
    rows = transcript.assembled(chunk.drop("raw_text", "asr_status"), _transcripts(chunk))
    return rows.select("call_id", "idx", "speaker", *times(), "raw_text", "asr_status", "chunk_path")


def _quality(c: Call) -> DataFrame:
    return quality.chunk_rows(c.bare, c.said, c.final)


def chunk_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = _quality(_call(spark, sf))
    return rows.select(*[r6(c) if c in ("start", "end", "duration_sec", "chars_per_sec") else F.col(c) for c in rows.columns]).withColumnsRenamed({"start": "start_sec", "end": "end_sec"})


def cleaned_out_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = _call(spark, sf)
    return quality.cleaned_out(c.chunk, c.final).select("call_id", "idx", "chunk_path")


def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.summary(_quality(_call(spark, sf)))
    return rows.select(*[r6(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])


def chunk_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = intervals.reindexed(_events(spark, sf))
    return rows.select("call_id", "idx", intervals.overlaps_neighbour(("start", "end", "idx")).alias("overlap_marker"))


def cleanup_filter(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.judged(_segments(spark, sf)).select("call_id", "ordinal", "fate", T.normalise(F.col("raw_text")).alias("norm_text"))


def dedup_segments(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.deduplicated(transcript.filtered(_segments(spark, sf))).select("call_id", "ordinal", "speaker", *times())


def clip_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.midpoint_clipped(_events(spark, sf)).select("call_id", "ordinal", *times(), "conflict")


def cleanup_report(spark: SparkSession, sf: str) -> DataFrame:
    return transcript.report(_segments(spark, sf))


def _windowed(spark: SparkSession, sf: str) -> DataFrame:
    return windows.assigned(transcript.positioned(_segments(spark, sf)), 400)


def semantic_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = windows.built(_windowed(spark, sf))
    return w.select("call_id", "window_index", joined("segment_positions"), *times(), r6("duration_sec"), joined("speakers"), "segments_count", "chars_count", F.array_join("texts", "|").alias("texts"))


def semantic_window_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.report(_segments(spark, sf), windows.built(_windowed(spark, sf)), 400)
    return rows.select(*[r6(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])


def window_segments(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.with_segments(windows.built(_windowed(spark, sf)), transcript.positioned(_segments(spark, sf)))
    return found.select("call_id", "window_index", "local_index", "position", "speaker", "raw_text")


def low_confidence_segments(spark: SparkSession, sf: str) -> DataFrame:
    return quality.flagged_segments(_segments(spark, sf)).select("call_id", "ordinal", r6("chars_per_sec"), "low_confidence")


def _by_call(spark: SparkSession, sf: str) -> DataFrame:
    """Texts gathered by tens, in order."""
    g = _texts(spark, sf).groupBy(F.floor(F.col("text_id") / 10).alias("group_id")).agg(F.array_sort(F.collect_list(F.struct("text_id", "text"))).alias("x"))
    return g.select("group_id", F.transform("x", lambda x: x["text"]).alias("texts"))


def language_switching_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _by_call(spark, sf).select("group_id", r6(T.switching_ratio(F.col("texts")), "ratio"))


def punctuation_density(spark: SparkSession, sf: str) -> DataFrame:
    return _by_call(spark, sf).select("group_id", r6(T.punctuation_density(F.col("texts")), "density"))


def normalize_words(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("text_id", F.array_join(T.words(F.col("text")), ",").alias("words"))


def token_language(spark: SparkSession, sf: str) -> DataFrame:
    tokens = _texts(spark, sf).select(F.explode(T.raw_words(F.col("text"))).alias("token"))
    return tokens.withColumn("label", T.token_language(F.col("token"))).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("token").alias("n_distinct"))


def code_switch(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("text_id", T.code_switched(F.col("text")).alias("switched"))


def dominant_language(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("text_id", T.dominant_language(F.col("text")).alias("language"))


def word_drift(spark: SparkSession, sf: str) -> DataFrame:
    other = F.when(F.col("text_id") % 3 == 0, F.concat(F.col("text"), F.lit(" extra"))).otherwise(F.lower("text"))
    return _texts(spark, sf).select("text_id", T.drifted(F.col("text"), other).alias("drift"))


def placeholder_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _texts(spark, sf).select("text_id", F.explode(T.placeholder_counts(F.col("text"))).alias("entity", "n"))
    return rows.select("text_id", "entity", "n")


def pii_candidates(spark: SparkSession, sf: str) -> DataFrame:
    docs = fixtures.table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("text_id", T.pii_candidate(F.col("text")).alias("candidate"))


def seg_payload(spark: SparkSession, sf: str) -> DataFrame:
    return _by_call(spark, sf).select("group_id", T.seg_payload(F.col("texts")).alias("payload"))


def seg_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("text_id", F.array_join(T.seg_parse(F.col("text"), F.lit(2)), "|").alias("texts"))


def seg_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """What a model that changes nothing would answer to the payloads of all texts, parsed."""
    rows = _by_call(spark, sf)
    return rows.select("group_id", F.array_join(T.seg_parse(T.seg_payload(F.col("texts")), F.size("texts")), "|").alias("texts"))


def anonymize_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    rows = transcript.positioned(_segments(spark, sf))
    inside = windows.with_segments(windows.built(_windowed(spark, sf)), rows).withColumnRenamed("raw_text", "source")
    out = enrichment.anonymized(rows, enrichment.called(inside, None, "anonymize"))
    return out.select("call_id", "position", "anonymized_text", "enhanced_text")


def anonymize_report(spark: SparkSession, sf: str) -> DataFrame:
    w = windows.built(_windowed(spark, sf))
    inside = windows.with_segments(w, transcript.positioned(_segments(spark, sf))).withColumnRenamed("raw_text", "source")
    rows = enrichment.anonymize_report(w, enrichment.called(inside, None, "anonymize"))
    return rows.select("call_id", "windows_total", "llm_calls_total", "windows_failed", "fallback_segments", "pii_candidate_segments", r6("anonymization_recall_proxy"))


def drift_guard(spark: SparkSession, sf: str) -> DataFrame:
    candidate = F.when(F.col("text_id") % 5 == 0, F.concat(F.col("text"), F.lit(" more"))).otherwise(F.concat(F.col("text"), F.lit(" !")))
    return _texts(spark, sf).select("text_id", enrichment.guarded(F.col("text"), candidate, F.col("text_id") % 7 == 0).alias("enhanced"))


def _plain(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.enhanced_plainly(enrichment.anonymized(transcript.positioned(_segments(spark, sf))))


def enhance_deterministic(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(spark, sf).select("call_id", "position", "enhanced_text", "changed")


def enhancement_report(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.plain_report(_plain(spark, sf)).select("call_id", "deterministic_only_segments", "deterministic_changed_segments", "llm_calls_total")


def call_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = _metrics(_call(spark, sf))
    return rows.select(*[r6(c) if kind == "double" else F.col(c) for c, kind in rows.dtypes])


def _metrics(c: Call) -> DataFrame:
    segs = intervals.with_duration(c.chunk)
    entries = intervals.resolved_entries(segs)
    texts = transcript.last_by(c.said, ["call_id", "idx"], "ordinal")
    w = windows.built(windows.assigned(c.final)).persist()
    inside = windows.with_segments(w, c.final).withColumnRenamed("raw_text", "source")
    anonymize = enrichment.anonymize_report(w, enrichment.called(inside, None, "anonymize"))
    return report.call_metrics(intervals.report(segs, entries), asr.report(c.chunk, texts), anonymize, enrichment.plain_report(c.final), quality.summary(_quality(c)), c.final)


def call_result(spark: SparkSession, sf: str) -> DataFrame:
    """The final document of each call, as JSON."""
    c = _call(spark, sf)
    docs = report.documents(_metrics(c), c.final)
    return docs.select("call_id", F.size("segments").cast("bigint").alias("n_segments"), F.to_json(F.struct("metrics", "segments")).alias("document"))


def vector_levels(spark: SparkSession, sf: str) -> DataFrame:
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = fixtures.table(spark, sf, "embeddings").select("vec_id", x.alias("x"))
    rms = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v) / F.size("x") + 1e-8)
    rows = rows.withColumns({"rms": rms, "peak": F.array_max(F.transform("x", F.abs))})
    return rows.select("vec_id", r6("rms"), r6("peak"), r6(20 * F.log10(F.greatest("rms", F.lit(1e-8))), "rms_dbfs"), r6(20 * F.log10(F.greatest("peak", F.lit(1e-8))), "peak_dbfs"))


class Named:
    """A stand-in for models: recognises a chunk by its file's name, masks nothing, ends every text with a full stop."""

    provider_name, model_name = "named", "stand-in"

    def transcribe_batch(self, paths: list[str], batch_size: int, pretokenize: bool) -> list[str]:
        return [f"heard {p}" for p in paths]

    def anonymize(self, texts: list[str]) -> list[str]:
        return texts

    def enhance(self, texts: list[str]) -> list[str]:
        return [f"{t}." for t in texts]


def asr_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    c = _chunks(spark, sf).select("call_id", "ordinal", "idx", "start", "end", "chunk_path")
    found = asr.recognized(asr.with_batches(c, 2, 4), Named(), 2)
    return asr.transcripts(c, found).select("call_id", "idx", "raw_text", "status")


def enhance_guarded(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.flagged_segments(transcript.positioned(_segments(spark, sf)))
    w = windows.built(_windowed(spark, sf))
    out = enrichment.enhanced_by(enrichment.anonymized(rows), w, Named())
    return out.select("call_id", "position", "enhanced_text", "drifted", "skipped", "windowed")


def _waves(spark: SparkSession, sf: str, schema: str, *tasks) -> DataFrame:
    """Vectors as sound: 16-bit files of 8000 Hz, each vector's samples repeated to an eighth of a second; then tasks of
    ``audio`` in the same Python worker, as one for each would hold its own batches of files and libraries."""
    from collections.abc import Iterator

    import numpy as np
    import pandas as pd

    def as_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 100):
                some = b.iloc[at : at + 100]
                yield pd.DataFrame({"path": some["vec_id"].astype(str), "content": [audio.encode_wav(np.resize(np.asarray(v, float) * 0.5, 1000), 8000) for v in some["embedding"]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = as_files(batches)
        for task in tasks:
            found = task(found)
        return found

    return fixtures.table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, schema)


def audio_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _waves(spark, sf, audio.NORMALISED, audio.normalising()).select("path", "sample_rate", r6("duration_sec"), "channels", "format")


def audio_enhance(spark: SparkSession, sf: str) -> DataFrame:
    rows = _waves(spark, sf, audio.ENHANCED, audio.normalising(), audio.enhancing())
    return rows.select("path", "sample_rate", r6("duration_sec"), *[F.round(c, 3).alias(c) for c in ("input_rms_dbfs", "output_rms_dbfs", "input_peak_dbfs", "output_peak_dbfs")])


class Masker:
    """A stand-in for a text model: masks e-mail addresses and long numbers in a payload. It answers nothing to a window
    whose first line has a length divisible by 13, and leaves lines with a hash sign blank."""

    model_name = "masker-1"

    def generate(self, prompt: str) -> str:
        lines = re.findall(r"<SEG id=\"(\d+)\">(.*?)</SEG>", prompt.split("\n\n", 1)[1], re.S)
        if len(lines[0][1].replace("&lt;", "<").replace("&amp;", "&")) % 13 == 0:
            return ""
        mask = lambda t: re.sub("[0-9]{8,}", T.PLACEHOLDERS["ID"], re.sub(T.EMAIL, T.PLACEHOLDERS["EMAIL"], t))
        return "\n".join(f'<SEG id="{i}">{"" if "#" in t else mask(t)}</SEG>' for i, t in lines)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as calls, their lines as segments, eight a window."""
    text = F.col("text")
    each = fixtures.table(spark, sf, "documents").select(F.col("doc_id").alias("call_id"), F.posexplode(F.filter(F.transform(F.split(text, "\n"), T.strip), lambda t: t != "")).alias("position", "source"))
    place = F.col("position").cast("bigint")
    return each.select("call_id", F.floor(place / 8).alias("window_index"), (place % 8).alias("local_index"), place.alias("position"), "source")


def _answered(spark: SparkSession, sf: str) -> DataFrame:
    """Asked twice with one store: the second time only what failed is called again."""
    model = StoredModel(Masker(), f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}")
    enrichment.called(_lines(spark, sf), model, "anonymize")
    return enrichment.called(_lines(spark, sf), model, "anonymize")


def model_answers(spark: SparkSession, sf: str) -> DataFrame:
    return _answered(spark, sf).select("call_id", "window_index", "position", "output", "failed", "fell_back", "reused")


def model_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf)
    model = StoredModel(Masker(), f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}")
    found = enrichment.anonymize_report(rows.select("call_id", "window_index").distinct(), enrichment.called(rows, model, "anonymize"))
    counted = [F.coalesce(F.try_element_at("entity_mask_counts", F.lit(k)), F.lit(0)).cast("bigint").alias(f"n_{k.lower()}") for k in ("EMAIL", "ID")]
    return found.select("call_id", "windows_total", "llm_calls_total", "windows_failed", "fallback_segments", "pii_candidate_segments", "masked_candidate_segments", r6("anonymization_recall_proxy"), r6("avg_chars_per_llm_call"), r6("avg_segments_per_llm_call"), *counted)


def wav_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as recordings, a hundred a file, written as 16-bit WAV and read again in ranges of bytes: levels per file."""
    from collections.abc import Iterator

    import numpy as np
    import pyarrow as pa

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            samples = [(np.asarray(v, "<f4") * np.float32(0.5)).tobytes() for v in b.column("embedding").to_pylist()]
            yield pa.record_batch([b.column("vec_id"), pa.array([len(x) // 4 for x in samples], pa.int64()), pa.array(samples, pa.binary())], names=["vec_id", "n", "samples"])

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.frombuffer(v, "<f4").astype(np.float64) for v in b.column("samples").to_pylist()]
            yield pa.record_batch([b.column("path"), b.column("sample_rate"), b.column("frames"), pa.array([len(v) for v in x], pa.int64()), pa.array([float(v @ v) for v in x]), pa.array([float(np.abs(v).max(initial=0)) for v in x])], names=["path", "sample_rate", "frames", "n", "squares", "peak"])

    files = Window.partitionBy("name")
    rows = fixtures.table(spark, sf, "embeddings").select("vec_id", "embedding").mapInArrow(packed, "vec_id bigint, n bigint, samples binary")
    rows = rows.withColumn("name", F.format_string("part-%06d.wav", F.floor(F.col("vec_id") / 100)))
    rows = rows.withColumns({"sample_rate": F.lit(8000), "frames": F.sum("n").over(files), "first_frame": F.coalesce(F.sum("n").over(files.orderBy("vec_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    folder = f"{shared_folder(spark)}/waves-{uuid.uuid4().hex}"
    wav.to_files(rows, folder)
    read = wav.blocks(spark, folder, splitBytes=20000, blockFrames=3000).mapInArrow(levels, "path string, sample_rate int, frames bigint, n bigint, squares double, peak double")
    found = read.groupBy(F.regexp_extract("path", "([^/]+)$", 1).alias("name")).agg(F.max("sample_rate").alias("sample_rate"), F.max("frames").alias("frames"), F.sum("n").alias("frames_read"), F.sum("squares").alias("squares"), F.max("peak").alias("peak"))
    return found.select("name", "sample_rate", "frames", "frames_read", r6(F.sqrt(F.col("squares") / F.col("frames")), "rms"), r6("peak"))


QUERIES = {
    f.__name__: f
    for f in (
        valid_segments, reindex_segments, clip_segments, merge_same_speaker, absorb_short, pad_segments, resolve_overlaps, merge_groups, postprocess_report, chunk_manifest, asr_eligibility, asr_batches, asr_report,
        nearest_rank_percentile, merge_transcript, chunk_quality, cleaned_out_chunks, quality_summary, chunk_overlap, cleanup_filter, dedup_segments, clip_overlaps, cleanup_report, semantic_windows, semantic_window_report,
        window_segments, low_confidence_segments, language_switching_ratio, punctuation_density, normalize_words, token_language, code_switch, dominant_language, word_drift, placeholder_counts, pii_candidates, seg_payload,
        seg_parse, seg_round_trip, anonymize_passthrough, anonymize_report, drift_guard, enhance_deterministic, enhancement_report, call_metrics, call_result, vector_levels,
        asr_transcripts, enhance_guarded, audio_normalize, audio_enhance, model_answers, model_report, wav_round_trip,
    )
}

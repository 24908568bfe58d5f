"""Providers, recognition, enrichment, the whole pipeline, artifacts, audio and the stream."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from talkweave.operators import asr, enrichment, providers, transcript, windows
from talkweave.plans.artifacts import Artifacts
from talkweave.plans.config import Settings
from talkweave.plans.pipeline import run
from talkweave.sources import audio, json_io, schemas
from talkweave.streaming import live

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module


class Fails:
    provider_name, model_name = "fails", "none"

    def transcribe_batch(self, paths, batch_size, pretokenize):
        raise RuntimeError("no model")


class Echo:
    provider_name, model_name = "echo", "one"

    def transcribe_batch(self, paths, batch_size, pretokenize):
        if any("bad" in p for p in paths):
            raise RuntimeError("bad file")
        return [f"text of {p}" for p in paths][: 1 if any("short" in p for p in paths) else None]


class Shout:
    def anonymize(self, texts):
        return [t.replace("Bob", "[ИМЯ]") for t in texts]

    def enhance(self, texts):
        return [t + " indeed" if "drift" in t else t + "." for t in texts] if "fail" not in texts[0] else None


CHUNKS = "call_id bigint, ordinal bigint, idx bigint, start double, end double, chunk_path string"


def test_fallback(spark):
    b = asr.with_batches(spark.createDataFrame([(1, i, i, float(i), i + 1.0, p) for i, p in enumerate(["a", "bad", "c"])], CHUNKS), 1, 1)
    rows = {r.idx: r for r in asr.recognized(b, Echo(), 1, fallback=providers.GivenTexts({"bad": "given"})).collect()}
    assert [(rows[i].raw_text, rows[i].status, rows[i].provider, rows[i].fallback_used) for i in range(3)] == [("text of a", "ok", "echo", False), ("given", "ok", "given", True), ("text of c", "ok", "echo", False)]
    assert "bad file" in rows[1].fallback_reason and rows[1].error == ""
    alone = asr.recognized(b, Fails(), 1)
    assert {(r.status, r.error, r.fallback_used) for r in alone.collect()} == {("error", "RuntimeError: no model", False)}
    r = asr.provider_report(asr.recognized(b, Fails(), 1, fallback=Echo()), "fails").first()
    assert (r.asr_provider_requested, r.asr_provider_effective, r.asr_model, r.asr_fallback_used, r.asr_fallback_reason) == ("fails", "echo", "one", True, "RuntimeError: no model")
    with pytest.raises(ValueError):
        providers.recognizer("unknown")
    with pytest.raises(ValueError):
        providers.other("text", "unknown")
    providers.register("echo", Echo)
    model, other = providers.chosen("echo", "given")
    assert (model.provider_name, other.provider_name) == ("echo", "given") and providers.chosen("echo")[1] is None and providers.other("diarizer", "none") is None


def test_batches_fail_alone(spark):
    rows = [(1, i, i, float(i), i + (0.1 if i == 0 else 1.0), p) for i, p in enumerate(["tiny", "a", "b", "bad", "c", "short", "d"])]
    c = spark.createDataFrame(rows, CHUNKS)
    b = asr.with_batches(c, 2, 2)
    assert {r.idx: r.batch_id for r in b.collect()} == {1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: 2}
    found = asr.recognized(b, Echo(), 2)
    t = {r.idx: (r.raw_text, r.status) for r in asr.transcripts(c, found).collect()}
    assert t == {0: ("", "skipped_short"), 1: ("text of a", "ok"), 2: ("text of b", "ok"), 3: ("", "error"), 4: ("", "error"), 5: ("text of short", "ok"), 6: ("", "error")}
    r = asr.report(c, asr.transcripts(c, found), 2, 2).first()
    assert (r.total_chunks, r.eligible_chunks, r.processed_chunks, r.failed_chunks, r.actual_orchestration_batch_sizes) == (7, 6, 3, 3, [2, 2, 2])
    assert asr.latency_report(found, c).first().asr_latency_total_ms >= 0


@pytest.mark.parametrize("values, ratio, expect", [([1.0, 2.0], 0.5, 1.0), ([], 0.5, 0.0), ([3.0, 1.0, 2.0, 4.0], 0.9, 4.0)])
def test_nearest_rank(spark, values, ratio, expect):
    assert spark.createDataFrame([(values,)], "v array<double>").select(asr.nearest_rank(F.col("v"), ratio)).first()[0] == expect


def test_enrichment(spark):
    texts = ["Bob calls 12345678", "drift here", "so it is", "fail me"]
    rows = [(1, i, "A", i * (1.0 if i < 3 else 9.0), i * (1.0 if i < 3 else 9.0) + 1.0, t, "ok", i == 2) for i, t in enumerate(texts)]
    df = transcript.positioned(spark.createDataFrame(rows, "call_id bigint, ordinal bigint, speaker string, start double, end double, raw_text string, asr_status string, low_confidence boolean"))
    w = windows.built(windows.assigned(df)).cache()
    inside = windows.with_segments(w, df).withColumnRenamed("raw_text", "source")
    out = enrichment.called(inside, Shout(), "anonymize").cache()
    named = enrichment.anonymized(df, out)
    assert named.orderBy("position").first().anonymized_text == "[ИМЯ] calls 12345678"
    r = enrichment.anonymize_report(w, out).first()
    assert (r.windows_total, r.llm_calls_total, r.pii_candidate_segments, r.masked_candidate_segments, r.entity_mask_counts) == (2, 2, 1, 1, {"NAME": 1})
    e = enrichment.enhanced_by(named, w, Shout()).cache()
    assert [x.enhanced_text for x in e.orderBy("position").collect()] == ["[ИМЯ] calls 12345678.", "drift here", "So it is", "fail me"]
    r = enrichment.enhance_report(e, w).first()
    assert (r.semantic_drift_flags_total, r.low_confidence_segments_skipped, r.windows_failed, r.fallback_segments, r.llm_calls_total) == (1, 1, 1, 1, 2)


def test_whole_pipeline_and_artifacts(spark, tmp_path):
    segs = spark.createDataFrame([(1, 0, 0, "A", 0.0, 2.0), (1, 1, 1, "B", 2.5, 4.0), (1, 2, 2, "A", 4.0, 4.1)], "call_id bigint, ordinal bigint, idx bigint, speaker string, start double, end double")
    durations = spark.createDataFrame([(1, 10.0)], "call_id bigint, audio_sec double")
    settings = Settings(input_path="/x/a b.wav", artifacts_root=str(tmp_path))
    assert settings.run_dir().startswith(f"{tmp_path}/run-") and Settings(input_path="s3://b/x").run_dir() == Settings(input_path="s3://b/x").run_dir() != settings.run_dir()
    kept = Artifacts(spark, settings)
    r = run(segs, durations, Echo(), settings, kept)
    m = r.metrics.first()
    assert (m.total_segments_before_postprocess, m.total_segments_after_postprocess, m.asr_chunks_total, m.llm_calls_total) == (3, 2, 2, 0)
    doc = json.loads(json_io.as_documents(r.documents).first().document)
    assert (doc["input_file"], doc["artifacts_dir"]) == ("/x/a b.wav", settings.run_dir())
    assert [s["enhanced_text"][:7] for s in doc["segments"]] == ["Text of"] * 2 and not any(kept.hits.values())
    again = Artifacts(spark, settings)
    run(segs, durations, Echo(), settings, again)
    assert all(again.hits.values())
    grown = Artifacts(spark, settings)
    more = segs.unionByName(spark.createDataFrame([(1, 3, 3, "B", 6.0, 9.0)], segs.schema))
    m = run(more, durations, Echo(), settings, grown).metrics.first()
    assert not any(grown.hits.values()) and (m.total_segments_before_postprocess, m.total_segments_after_postprocess, m.asr_chunks_total) == (4, 3, 3)
    assert m.asr_latency_total_ms >= 0 and m.llm_latency_total_ms == 0 and m.asr_provider_effective == "echo"
    with pytest.raises(ValueError):
        run(segs, durations, Echo(), Settings(text_enhancement_mode="llm"))
    other = Artifacts(spark, Settings(input_path="/x/a b.wav", artifacts_root=str(tmp_path), segment_padding_ms=10))
    run(segs, durations, Echo(), other.settings, other)
    assert not any(other.hits.values())


def test_json_round_trip(spark, tmp_path):
    df = schemas.normalised(spark.createDataFrame([(1, 0, 0, None, None), (1, 1, 1, "ә\n", "error")], schemas.TRANSCRIPTS))
    json_io.write_json(df, f"{tmp_path}/t")
    assert sorted(json_io.read_json(spark, f"{tmp_path}/t", schemas.TRANSCRIPTS).collect()) == sorted(df.collect())
    assert df.orderBy("idx").first()[3:] == ("", "ok")


def test_audio(spark, tmp_path):
    rate = 8000
    t = np.arange(rate) / rate
    stereo = np.stack([0.2 * np.sin(2 * np.pi * 440 * t) + 0.1, 0.2 * np.sin(2 * np.pi * 440 * t)])
    mono = audio.downmix(stereo)
    (tmp_path / "a.wav").write_bytes(audio.encode_wav(mono, rate))
    back, r = audio.decode_wav(audio.encode_wav(mono, rate, True))
    assert r == rate and np.allclose(back[0], mono, atol=1e-7)
    norm = audio.normalised(audio.read_audio(spark, f"{tmp_path}/a.wav"), 16000).cache()
    n = norm.first()
    x, r = audio.decode_wav(bytes(n.wav))
    assert (r, n.duration_sec, n.channels) == (16000, 1.0, 1) and audio.peak(x) == pytest.approx(0.95, abs=1e-3)
    assert audio.enhanced(norm).first().output_peak_dbfs <= -1.0 + 1e-3
    # a steady tone is noise to the denoiser, so the loudness is looked at without it
    e = audio.enhanced(norm, settings=audio.Enhancement(denoise_strength=0.0)).first()
    assert e.output_rms_dbfs == pytest.approx(-22.0, abs=0.1) and not e.cache_hit
    y, _ = audio.decode_wav(bytes(e.wav))
    assert abs(y.mean()) < 1e-2 and audio.peak(y) <= 0.999
    assert audio.enhanced(norm, enabled=False).first().cache_hit
    with pytest.raises(Exception, match="8000 Hz is expected"):
        audio.enhanced(norm, 8000).collect()
    cut = spark.createDataFrame([(1, 0, 100, 300, "c.wav")], "call_id bigint, idx bigint, start_frame bigint, end_frame bigint, chunk_path string")
    s = audio.sliced(norm.select(F.lit(1).cast("bigint").alias("call_id"), "wav"), cut).first()
    assert np.allclose(audio.decode_wav(bytes(s.wav))[0][0], x[0][100:300], atol=1e-6)
    low, high = np.sin(2 * np.pi * 5 * t), np.sin(2 * np.pi * 1000 * t)
    assert audio.rms(audio.highpass(low, rate, 60)[2000:]) < 0.02 and audio.rms(audio.highpass(high, rate, 60)) == pytest.approx(audio.rms(high), rel=0.02)
    assert np.allclose(audio.denoise(high * 0.5, 0.0, 0.2), high * 0.5)
    assert np.allclose(audio.denoise(high * 0.5, 1e-9, 0.2)[300:-300], (high * 0.5)[300:-300], atol=1e-5)


class Turns:
    def diarize(self, path):
        return [(2.0, 3.0, "B"), (0.0, 1.0, "A"), (1.0, 1.0, "C")]


def test_diarizer(spark):
    rows = audio.diarized(spark.createDataFrame([(7, "x")], "call_id bigint, path string"), Turns()).orderBy("idx").collect()
    assert [(r.call_id, r.idx, r.speaker) for r in rows] == [(7, 0, "A"), (7, 1, "B")]


def test_stream(spark, tmp_path):
    rows = [(1, 0, "A", 0.0, 10.0, "H", "ok", "2024-01-01 00:00:01"), (1, 1, "A", 0.0, 1.0, "Hello you", "ok", "2024-01-01 00:00:02")]
    spark.createDataFrame(rows, live.ARRIVING.replace("timestamp", "string")).write.json(f"{tmp_path}/in")
    q = live.confidence_rates(live.read_segments(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    r = spark.table("rates").first()
    assert (r.segments, r.low, r.low_ratio) == (2, 1, 0.5)


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from talkweave.__main__ import main

    providers.register("echo", Echo)
    (tmp_path / "in.json").write_text('{"call_id":1,"ordinal":0,"idx":0,"speaker":"A","start":0.0,"end":2.0}\n')
    main([f"{tmp_path}/in.json", "--artifacts-root", f"{tmp_path}/out", "--recognizer", "echo"])
    where = capsys.readouterr().out.strip()
    assert spark.read.json(where).first()["metrics"]["asr_chunks_total"] == 1


def test_every_stage_is_described():
    from talkweave.plans.pipeline import STAGES, describe

    assert tuple(describe()) == STAGES and len(set(STAGES)) == 13

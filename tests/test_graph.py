"""From WAV files to JSON documents: all stages, what a change makes anew, and replaced stages."""

import json
import os
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from talkweave.operators import providers
from talkweave.plans.config import Settings
from talkweave.plans.graph import STAGES, Graph, Stage
from talkweave.plans.pipeline import STAGES as NAMES
from talkweave.sources import audio

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module

RATE = 8000


class Loud:
    """Speaker A where a recording is loud in its first second, B afterwards; reads the file it is given."""

    def diarize(self, path):
        with open(path.removeprefix("file:"), "rb") as f:
            x, rate = audio.decode_wav(f.read())
        assert rate == 16000
        return [(0.0, 1.0, "A"), (1.05, x.shape[1] / rate, "B")]


class Pitch:
    """Hears the strongest frequency of a chunk's file."""

    provider_name, model_name = "pitch", "fft"

    def transcribe_batch(self, paths, batch_size, pretokenize):
        def heard(path):
            with open(path, "rb") as f:
                x, rate = audio.decode_wav(f.read())
            return round(float(np.argmax(np.abs(np.fft.rfft(x[0]))) * rate / x.shape[1]) / 10) * 10

        return [f"heard about {heard(p)} hertz there" for p in paths]


@pytest.fixture
def recordings(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    for name, first, second in (("one", 400, 900), ("two", 700, 1200)):
        t = np.arange(RATE) / RATE
        x = np.concatenate([0.4 * np.sin(2 * np.pi * first * t), 0.2 * np.sin(2 * np.pi * second * t)])
        (folder / f"{name}.wav").write_bytes(audio.encode_wav(x, RATE))
    return folder


def settings_of(recordings, tmp_path, **more):
    return Settings(input_path=f"{recordings}/*.wav", artifacts_root=str(tmp_path / "out"), audio_denoise_strength=0.0, **more)


def test_recordings_to_documents(spark, tmp_path, recordings):
    s = settings_of(recordings, tmp_path)
    g = Graph(spark, s, Pitch(), Loud())
    docs = {r.call_id: r for r in g.run().collect()}
    paths = {r.call_id: os.path.basename(r.path) for r in g["normalize_audio"].collect()}
    assert sorted(paths.values()) == ["one.wav", "two.wav"] and list(g.stages) == list(NAMES) and not any(g.artifacts.hits.values()) and len(g.artifacts.hits) == 13
    for call, doc in docs.items():
        told = [(x.speaker, x.raw_text, x.enhanced_text, x.asr_status) for x in doc.segments]
        low, high = (400, 900) if paths[call] == "one.wav" else (700, 1200)
        assert told == [(w, f"heard about {p} hertz there", f"Heard about {p} hertz there", "ok") for w, p in (("A", low), ("B", high))]
        m = doc.metrics
        assert (m.asr_chunks_total, m.total_segments_before_postprocess, m.total_segments_after_postprocess) == (2, 2, 2) and m.audio_minutes == pytest.approx(2 / 60) and m.asr_provider_effective == "pitch"
        for x in doc.segments:
            y, rate = audio.decode_wav(open(x.chunk_path, "rb").read())
            assert rate == 16000 and y.shape[1] == pytest.approx((x.end - x.start) * 16000, abs=1)

    # nothing is made again, and nothing before the stage that is asked for is looked at
    again = Graph(spark, s, Pitch(), Loud())
    assert again.run().count() == 2 and again.artifacts.hits == {"call_result": True}
    # a setting of the windows keeps sound and recognition, and makes what follows anew
    text = Graph(spark, replace(s, llm_window_max_chars=100), Pitch(), Loud())
    assert text.run().count() == 2
    made = {k for k, fresh in text.artifacts.hits.items() if not fresh}
    assert made == {"semantic_windows", "anonymize_transcript", "enhance_transcript", "quality_report", "call_result"} and text.artifacts.hits["asr_transcripts"]
    # another recording changes the first stage, and so all
    (recordings / "three.wav").write_bytes((recordings / "one.wav").read_bytes())
    more = Graph(spark, s, Pitch(), Loud())
    assert more.run("diarization").select("call_id").distinct().count() == 3 and set(more.artifacts.hits) == {"normalize_audio", "enhance_audio", "diarization"} and not any(more.artifacts.hits.values())


def test_replaced_stages_are_checked(spark, tmp_path, recordings):
    s = settings_of(recordings, tmp_path)
    upper = Stage(lambda g: STAGES["clean_transcript"].make(g).withColumn("raw_text", F.upper("raw_text")), ("merge_transcript",))
    found = Graph(spark, s, Pitch(), Loud(), stages={"clean_transcript": upper}).run("semantic_windows").collect()
    assert len(found) == 2 and all(t.startswith("HEARD") for r in found for t in r.texts)
    lacking = Stage(lambda g: STAGES["clean_transcript"].make(g).drop("position"), ("merge_transcript",), ("force",))
    with pytest.raises(ValueError, match="stage clean_transcript lacks position"):
        Graph(spark, s, Pitch(), Loud(), stages={"clean_transcript": lacking}).run("clean_transcript")
    with pytest.raises(ValueError, match="no such stages: wash"):
        Graph(spark, s, Pitch(), Loud(), stages={"wash": upper})
    with pytest.raises(ValueError, match="no such stage: end"):
        Graph(spark, s, Pitch(), Loud()).run("end")
    with pytest.raises(ValueError, match="needs a text provider"):
        Graph(spark, replace(s, text_enhancement_mode="llm"), Pitch(), Loud())


def test_command_line_from_recordings(spark, tmp_path, recordings, capsys):
    from talkweave.__main__ import main

    providers.register("pitch", Pitch)
    providers.register_other("diarizer", "loud", Loud)
    main([f"{recordings}/*.wav", "--artifacts-root", f"{tmp_path}/cli", "--recognizer", "pitch", "--diarizer", "loud", "--until", "audio_chunks"])
    assert spark.read.parquet(capsys.readouterr().out.strip()).count() == 4
    main([f"{recordings}/*.wav", "--artifacts-root", f"{tmp_path}/cli", "--recognizer", "pitch", "--diarizer", "loud"])
    where = capsys.readouterr().out.strip()
    docs = [json.loads(line) for f in os.listdir(where) if f.endswith(".json") for line in open(f"{where}/{f}")]
    assert len(docs) == 2 and all(len(d["segments"]) == 2 and d["metrics"]["audio_minutes"] > 0.03 for d in docs)

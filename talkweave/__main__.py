"""``python -m talkweave``: to one JSON document per call, from a folder of WAV recordings (with ``--diarizer``) or from
JSON lines of call_id, ordinal, idx, speaker, start, end. Speakers' turns and texts come from registered models.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from talkweave.operators import providers
from talkweave.plans.artifacts import Artifacts
from talkweave.plans.config import Settings
from talkweave.plans.graph import STAGES, Graph
from talkweave.plans.pipeline import run
from talkweave.sources import json_io, schemas


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="talkweave", description=__doc__)
    p.add_argument("input", help="WAV recordings or JSON lines of segments: a file, a folder or a pattern")
    p.add_argument("--artifacts-root", default="artifacts", help="where stages and results go")
    p.add_argument("--recognizer", default="given", help="a registered recogniser")
    p.add_argument("--text-provider", default="none", help="a registered text provider; with one, texts are enhanced by it")
    p.add_argument("--fallback", default="none", help="a registered recogniser for batches on which the first one fails")
    p.add_argument("--diarizer", default="none", help="a registered diarizer; with one, the input are recordings")
    p.add_argument("--until", default="call_result", choices=tuple(STAGES), help="of recordings: the stage that ends the run")
    p.add_argument("--force", action="store_true", help="make every stage anew")
    a = p.parse_args(arguments)
    settings = Settings(input_path=a.input, artifacts_root=a.artifacts_root, asr_provider=a.recognizer, asr_fallback_provider=a.fallback, diarizer=a.diarizer, text_provider=a.text_provider, text_enhancement_mode="deterministic" if a.text_provider == "none" else "llm", force=a.force)
    spark = SparkSession.builder.appName("talkweave").getOrCreate()
    model, fallback = providers.chosen(a.recognizer, settings.asr_fallback_provider)
    text = providers.other("text", a.text_provider)
    if a.diarizer != "none":
        found = Graph(spark, settings, model, providers.other("diarizer", a.diarizer), text, fallback).run(a.until)
        if a.until != "call_result":
            print(f"{settings.run_dir()}/{a.until}")
            return
        documents = found
    else:
        rows = schemas.normalised(json_io.read_json(spark, a.input, schemas.DIARIZATION))
        durations = rows.groupBy("call_id").agg(F.max("end").alias("audio_sec"))
        documents = run(rows, durations, model, settings, Artifacts(spark, settings), text, fallback).documents
    json_io.write_json(documents, f"{settings.run_dir()}/result")
    print(f"{settings.run_dir()}/result")


if __name__ == "__main__":
    main()

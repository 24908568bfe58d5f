"""Calls of a text model: prompts, stored answers, retries, failures."""

import os
import re
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from talkweave.operators import enrichment
from talkweave.operators.model_calls import PROMPTS, ModelCallError, Retry, StoredModel, requests

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module

ROWS = "call_id bigint, window_index bigint, local_index bigint, position bigint, source string"
QUICK = Retry(attempts=3, first_wait=0.01, tasks=2)


class Model:
    """Counts its calls by files in a folder. Windows with ``flaky`` fail once, those with ``broken`` always."""

    def __init__(self, folder, model_name="m1"):
        self.folder, self.model_name = str(folder), model_name

    def generate(self, prompt):
        asked, payload = prompt.split("\n\n", 1)
        segments = re.findall(r'<SEG id="(\d+)">(.*?)</SEG>', payload)
        key = re.sub(r"\W+", "_", segments[0][1])
        before = sum(f.startswith(key + "-") for f in os.listdir(self.folder))
        open(f"{self.folder}/{key}-{uuid.uuid4().hex}", "w").close()
        if "broken" in payload or ("flaky" in payload and not before):
            raise RuntimeError("overloaded")
        if "silent" in payload:
            return None
        if "short" in payload:
            segments = segments[:1]
        order = segments[::-1]  # any order will do, ids count
        return "Here you are:\n" + "\n".join(f'<seg id={i}> {"" if "blank" in t else t.replace("Bob", "[ИМЯ]")} </seg>' for i, t in order)


def rows_of(spark, *windows):
    return spark.createDataFrame([(1, w, i, 10 * w + i, t) for w, texts in enumerate(windows) for i, t in enumerate(texts)], ROWS)


def calls(folder):
    return len(os.listdir(folder))


@pytest.fixture
def setting(tmp_path):
    (tmp_path / "calls").mkdir()
    return tmp_path / "calls", f"file://{tmp_path}/store"


def test_a_second_run_calls_nothing(spark, setting):
    folder, store = setting
    model = StoredModel(Model(folder), store, QUICK)
    rows = rows_of(spark, ["Bob & <b> is here", "nothing"], ["flaky one"], ["same", "text"], ["same", "text"], ["blank", None])
    first = {(r.window_index, r.local_index): r for r in enrichment.called(rows, model, "anonymize").collect()}
    assert {k: r.output for k, r in first.items()} == {(0, 0): "[ИМЯ] & <b> is here", (0, 1): "nothing", (1, 0): "flaky one", (2, 0): "same", (2, 1): "text", (3, 0): "same", (3, 1): "text", (4, 0): "blank", (4, 1): ""}
    assert [first[k].attempts for k in ((0, 0), (1, 0))] == [1, 2] and not any(r.failed or r.reused for r in first.values())
    assert [k for k, r in first.items() if r.fell_back] == [(4, 0), (4, 1)]
    assert calls(folder) == 5  # equal windows are asked once, the flaky one twice
    again = {(r.window_index, r.local_index): r for r in enrichment.called(rows, model, "anonymize").collect()}
    assert calls(folder) == 5 and all(r.reused for r in again.values()) and {k: r.output for k, r in again.items()} == {k: r.output for k, r in first.items()}
    more = rows.unionByName(spark.createDataFrame([(2, 0, 0, 0, "new")], ROWS))
    enrichment.called(more, model, "anonymize").count()
    assert calls(folder) == 6
    enrichment.called(rows_of(spark, ["same", "text"]), model, "enhance").count()  # another prompt
    enrichment.called(rows_of(spark, ["same", "text"]), StoredModel(Model(folder, "m2"), store, QUICK), "anonymize").count()  # another model
    assert calls(folder) == 8


def test_failures_stay_with_their_window(spark, setting):
    folder, store = setting
    model = StoredModel(Model(folder), store, QUICK)
    rows = rows_of(spark, ["broken", "x"], ["short", "y"], ["silent"], ["Bob 12345678"])
    found = {(r.window_index, r.local_index): r for r in enrichment.called(rows, model, "anonymize").collect()}
    assert [r.output for _, r in sorted(found.items())] == ["broken", "x", "short", "y", "silent", "[ИМЯ] 12345678"]
    assert [r.failed for _, r in sorted(found.items())] == [True] * 5 + [False] and all(r.fell_back for k, r in found.items() if k[0] < 3)
    assert found[0, 0].error == "RuntimeError: overloaded" and found[0, 0].attempts == 3 and found[1, 0].error is None
    report = enrichment.anonymize_report(rows.select("call_id", "window_index").distinct(), enrichment.called(rows, model, "anonymize")).first()
    assert (report.windows_total, report.llm_calls_total, report.windows_failed, report.fallback_segments, report.pii_candidate_segments, report.masked_candidate_segments) == (4, 4, 3, 5, 1, 1)
    assert report.entity_mask_counts == {"NAME": 1} and report.anonymization_recall_proxy == 1.0 and report.llm_latency_total_ms > 0
    assert calls(folder) == 6 + 5  # what failed was called again, the good answer was there


def test_strict_runs_fail_but_keep_answers(spark, setting):
    folder, store = setting
    model = StoredModel(Model(folder), store, QUICK)
    rows = rows_of(spark, ["broken"], ["fine"], ["short", "y"])
    with pytest.raises(ModelCallError, match="1 of the requests to m1 failed, the first with RuntimeError: overloaded"):
        enrichment.called(rows, model, "enhance", strict=True)
    assert calls(folder) == 5
    found = {r.window_index: r for r in enrichment.called(rows.filter("window_index = 1"), model, "enhance", strict=True).collect()}
    assert found[1].reused and calls(folder) == 5
    assert not enrichment.called(rows.filter("window_index = 2"), model, "enhance", strict=True).filter("not failed").count()  # an answer that lacks a segment is no error


def test_no_rows_and_digests(spark, setting):
    folder, store = setting
    none = spark.createDataFrame([], ROWS)
    assert enrichment.called(none, StoredModel(Model(folder), store, QUICK), "enhance").count() == 0 and calls(folder) == 0
    rows = rows_of(spark, ["a"], ["a"], ["b"])
    digest = lambda name, task: {r.window_index: r.digest for r in requests(rows, name, task).collect()}
    one = digest("m", "anonymize")
    assert one[0] == one[1] != one[2] and one[0] not in digest("n", "anonymize").values() and one[0] not in digest("m", "enhance").values()
    assert requests(rows, "m", "enhance").filter(F.col("payload") == '<SEG id="0">b</SEG>').count() == 1 and all("segments" in p for p in PROMPTS.values())


def test_enhancement_by_prompts(spark, setting):
    """The guard works on answers of prompts as on those of lists."""
    folder, store = setting
    segs = spark.createDataFrame([(1, 0, 0.0, 1.0, "S", "Bob spoke", False), (1, 1, 1.0, 2.0, "S", "plain words", False), (1, 2, 2.0, 3.0, "S", "slow", True)], "call_id bigint, position bigint, start double, end double, speaker string, raw_text string, low_confidence boolean")
    windows = spark.createDataFrame([(1, 0, [0, 1, 2])], "call_id bigint, window_index bigint, segment_positions array<bigint>")
    out = {r.position: r for r in enrichment.enhanced_by(enrichment.anonymized(segs), windows, StoredModel(Model(folder), store, QUICK)).collect()}
    assert [(out[i].enhanced_text, out[i].drifted, out[i].skipped) for i in range(3)] == [("Bob spoke", True, False), ("plain words", False, False), ("Slow", False, True)]


def test_waits_grow():
    r = Retry(attempts=9, first_wait=1.0, factor=3.0, longest_wait=20.0)
    assert [r.wait(k) for k in (1, 2, 3, 4)] == [1.0, 3.0, 9.0, 20.0]


def test_reports_read_the_outputs_once(spark, setting):
    folder, store = setting
    rows = rows_of(spark, ["Bob 12345678", "plain"], ["Bob Bob"], ["broken"])
    outputs = enrichment.called(rows, StoredModel(Model(folder), store, QUICK), "anonymize")
    report = enrichment.anonymize_report(rows.select("call_id", "window_index").distinct(), outputs)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1
    r = report.first()
    assert r.entity_mask_counts == {"NAME": 3} and (r.pii_candidate_segments, r.masked_candidate_segments, r.windows_failed) == (1, 1, 1)


def test_requests_are_stored_without_payloads_and_answers_once(spark, setting, tmp_path):
    folder, store = setting
    enrichment.called(rows_of(spark, ["a", "b"], ["a", "b"], ["c"]), StoredModel(Model(folder), store, QUICK), "anonymize")
    kept = {p.name for p in (tmp_path / "store").iterdir()}
    assert kept == {"requests", "answers"} and calls(folder) == 2
    assert "payload" not in spark.read.parquet(f"{store}/requests/*").columns and spark.read.parquet(f"{store}/answers").count() == 2


def test_calls_run_in_the_tasks_asked_for(spark, setting, tmp_path):
    folder, store = setting
    rows = rows_of(spark, *[[f"text {i}"] for i in range(40)])
    enrichment.called(rows, StoredModel(Model(folder), store, QUICK), "anonymize")
    assert len(list((tmp_path / "store" / "answers").glob("part-*"))) == QUICK.tasks and calls(folder) == 40

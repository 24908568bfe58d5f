"""Calls of a text model, window by window, through a table of answers.

A request is a prompt with the window's segments as a payload of numbered elements. Its digest covers the prompt, the
model's name and the payload. Answers that could be used are kept under their digest in a table of the shared store, so
only distinct requests without one are called, and a second run, or one resumed after a failure, calls what is missing.
Requests are told apart by digests and row numbers alone; a window's
texts are shuffled once to be gathered, once to be asked, and once to meet their answers.
Calls run in as many tasks as ``Retry.tasks`` says. A call that raises is tried again after a wait that grows; the last
error stays with the request. Answers are parsed in the JVM; one that lacks a segment fails its window, whose
segments keep their sources; a blank one falls back alone.

A task that is lost repeats its own calls, as its answers were not committed yet. Two runs at once may both
store an answer: the one of the run that sorts first counts. Null sources count as empty. No rows give no rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkweave.functions import text as T

#: What a model is asked; the payload follows. Placeholders are the fixed ones that the reports count.
PROMPTS = {
    "anonymize": f"You remove personal data from the transcript of a call. Replace each name, phone number, identifier, address and e-mail address by one of {', '.join(T.PLACEHOLDERS.values())}; leave everything else, and the order of segments, as it is. Answer only with the segments, in the form in which they are given.",
    "enhance": "You make the transcript of a call readable. Only punctuation, capitals and spaces may change; no word may be added, dropped, moved or replaced. Answer only with the segments, in the form in which they are given.",
}
ANSWERS = "digest string, response string, error string, attempts int, latency_ms double"
STORED = "digest string, response string, error string, attempts int, latency_ms double, usable boolean, run string"


class TextModel(Protocol):
    """Heavy clients belong in the first call, not the constructor: the object is sent to the workers."""

    model_name: str

    def generate(self, prompt: str) -> str: ...


class ModelCallError(RuntimeError):
    """Calls failed in a strict run; what was answered is kept, so the next run calls only the others."""


@dataclass(frozen=True)
class Retry:
    """Attempts per request, waits between them in seconds, and tasks that call at once."""

    attempts: int = 3
    first_wait: float = 0.5
    factor: float = 2.0
    longest_wait: float = 30.0
    tasks: int = 8

    def wait(self, failures: int) -> float:
        return min(self.longest_wait, self.first_wait * self.factor ** (failures - 1))


def _payload() -> Column:
    return T.seg_payload(F.transform("items", lambda x: x["source"]))


def requests(rows: DataFrame, model_name: str, task: str) -> DataFrame:
    """One row per window of (call_id, window_index, local_index, position, source): ``items``, ``payload``, ``digest``."""
    source = F.coalesce("source", F.lit("")).alias("source")
    gathered = rows.select("call_id", "window_index", "local_index", "position", source).groupBy("call_id", "window_index").agg(F.array_sort(F.collect_list(F.struct("local_index", "position", "source"))).alias("items"))
    asked = gathered.withColumn("payload", _payload())
    return asked.withColumn("digest", F.sha2(F.concat_ws("\x1f", F.lit(PROMPTS[task]), F.lit(model_name), "payload"), 256))


def _calls(model: TextModel, prompt: str, retry: Retry):
    def call(payload: str) -> tuple[str | None, str | None, int, float]:
        began, error = time.perf_counter(), None
        for attempt in range(1, max(1, retry.attempts) + 1):
            try:
                return model.generate(f"{prompt}\n\n{payload}") or "", None, attempt, (time.perf_counter() - began) * 1000
            except Exception as e:  # whatever a model raises stays with its request
                error = f"{type(e).__name__}: {e}"
                if attempt < retry.attempts:
                    time.sleep(retry.wait(attempt))
        return None, error, max(1, retry.attempts), (time.perf_counter() - began) * 1000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [call(p) for p in b["payload"]]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pd.DataFrame({"digest": b["digest"], "response": columns[0], "error": columns[1], "attempts": columns[2], "latency_ms": columns[3], "n": b["n"]})

    return run


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


@dataclass(frozen=True)
class StoredModel:
    """A model with its store, a folder that driver and executors share; ``enrichment.called`` takes it as a provider."""

    model: TextModel
    store: str
    retry: Retry = field(default_factory=Retry)

    def answers(self, rows: DataFrame, task: str, strict: bool = False) -> DataFrame:
        """Per segment: ``output``, ``failed`` (its window), ``fell_back``, ``called``, ``latency_ms``, ``attempts``,
        ``reused`` (the answer was there before) and ``error``. With ``strict``, calls that raised fail the run in the end."""
        spark, run = rows.sparkSession, uuid.uuid4().hex
        path = f"{self.store}/requests/{task}-{run}"
        requests(rows, self.model.model_name, task).drop("payload").withColumn("request", F.monotonically_increasing_id()).write.parquet(path)
        asked = spark.read.parquet(path)
        before = _table(spark, f"{self.store}/answers", STORED).filter("usable").select("digest")
        wanted = asked.groupBy("digest").agg(F.min("request").alias("request")).join(before, "digest", "left_anti").select("request")
        # at least the session's partitions, else the join makes its own; a semi-join would go below them, and texts be shuffled twice
        tasks = max(1, self.retry.tasks)
        parts = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
        missing = asked.select("request", "digest", "items").repartition(parts, "request").join(wanted.repartition(parts, "request"), "request").coalesce(tasks)
        got = missing.select("digest", _payload().alias("payload"), F.size("items").alias("n")).mapInPandas(_calls(self.model, PROMPTS[task], self.retry), f"{ANSWERS}, n int")
        # a request of n elements is usable if n come back
        usable = F.col("response").isNotNull() & (F.size(T.seg_parse(F.coalesce("response", F.lit("")), F.col("n"))) > 0)
        got.select(*[c.split()[0] for c in ANSWERS.split(", ")], usable.alias("usable"), F.lit(run).alias("run")).write.mode("append").parquet(f"{self.store}/answers")
        stored = _table(spark, f"{self.store}/answers", STORED)
        if strict:
            raised = stored.filter((F.col("run") == run) & F.col("error").isNotNull())
            first = raised.agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).first()
            if first["n"]:
                raise ModelCallError(f"{first['n']} of the requests to {self.model.model_name} failed, the first with {first['error']}")
        return _applied(asked, stored, run)


def _applied(asked: DataFrame, stored: DataFrame, run: str) -> DataFrame:
    """Answers on their windows: of usable ones the first run's, else what this run got."""
    own = F.col("run") == run
    order = F.struct(~F.col("usable"), F.col("run"))
    ranked = stored.filter(F.col("usable") | own).withColumn("first", F.min(order).over(Window.partitionBy("digest")))
    of_request = ranked.filter(order == F.col("first")).select("digest", F.struct("response", "error", "attempts", "latency_ms", "usable", "run").alias("a"))
    windows = asked.join(of_request, "digest", "left").withColumn("texts", F.when(F.col("a.usable"), T.seg_parse(F.coalesce("a.response", F.lit("")), F.size("items"))).otherwise(F.array().cast("array<string>")))
    failed = F.size("texts") == 0
    each = windows.select("call_id", "window_index", "a", "texts", failed.alias("failed"), F.posexplode("items").alias("k", "item"))
    given = F.get("texts", F.col("k"))
    back = F.col("failed") | (F.coalesce(T.strip(given), F.lit("")) == "")
    out = each.withColumns({"fell_back": back, "given": given})
    return out.select(
        "call_id", "window_index", "item.local_index", "item.position", "item.source", F.when(F.col("fell_back"), F.col("item.source")).otherwise(F.col("given")).alias("output"), "failed", "fell_back",
        F.lit(True).alias("called"), F.coalesce("a.latency_ms", F.lit(0.0)).alias("latency_ms"), "a.attempts", (F.col("a.run") != run).alias("reused"), "a.error",
    )

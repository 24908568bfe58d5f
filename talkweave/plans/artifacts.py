"""Stage results kept between runs: tables under a run's folder, fresh as long as their fingerprint fits.

A stage's fingerprint covers the settings, the run's input (its files with their sizes and times, or the rows of a table
that has none) and those of the stages it reads, so a change reaches everything after it; it is written after the table,
so an interrupted stage is not taken for a finished one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings


class Artifacts:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings, self.folder = spark, settings, settings.run_dir()
        self.inputs = ""
        self.hits: dict[str, bool] = {}
        self._prints: dict[str, str] = {}

    def _path(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def reads(self, *tables: DataFrame) -> None:
        """Names the run's input; a change of it makes every stage anew."""
        found = []
        for t in tables:
            files = t.inputFiles()
            for f in sorted(files):
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
                status = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
                found.append(f"{f} {status.getLen()} {status.getModificationTime()}")
            if not files:
                r = t.select(F.xxhash64(*t.columns).cast("decimal(38,0)").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
                found.append(f"{r['n']} {r['h']}")
        self.inputs = hashlib.sha256("\n".join(found).encode()).hexdigest()

    def fingerprint(self, name: str, after: tuple[str, ...]) -> str:
        parts = [name, self.settings.fingerprint(), self.inputs, *(self._prints[a] for a in after)]
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()

    def table(self, name: str, make: Callable[[], DataFrame], after: tuple[str, ...] = ()) -> DataFrame:
        """The stored table of a stage, made anew if its settings, what it reads, or ``force`` ask for it."""
        own = self._prints[name] = self.fingerprint(name, after)
        return self.kept(name, own, make, all(self.hits[a] for a in after))

    def kept(self, name: str, fingerprint: str, make: Callable[[], DataFrame], current: bool = True) -> DataFrame:
        """The stored table if it was made under this fingerprint (and is ``current``), or else made and stored."""
        mark, fs = self._path(f"{name}.state/{fingerprint}")
        fresh = current and not self.settings.force and fs.exists(mark)
        self.hits[name] = fresh
        where = f"{self.folder}/{name}"
        if not fresh:
            fs.delete(mark.getParent(), True)
            make().write.mode("overwrite").parquet(where)
            fs.create(mark).close()
        return self.spark.read.parquet(where)

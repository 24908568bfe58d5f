"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="talkweave-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only in local mode may a session name none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")

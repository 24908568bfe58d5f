"""JSON artifacts: one UTF-8 document per row, written and read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """A document that doesn't fit the schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)


def as_documents(df: DataFrame, key: str = "call_id") -> DataFrame:
    """``key`` and the row as one JSON string."""
    return df.select(F.col(key), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("document"))

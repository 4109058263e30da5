"""Requests that arrive as files, answered by micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.requests import answer


def request_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Audio files of a folder as requests, as they arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.lit("application/octet-stream").alias("content_type"), F.lit("id").alias("language"), "content")


def start(stream: DataFrame, model: Mapping, settings: dict, out: str, checkpoint: str):
    """Answers are written as Parquet, a folder for each batch, so that a batch that runs twice replaces itself."""

    def batch(df: DataFrame, number: int) -> None:
        answer(df, model, settings).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()

"""Transcription requests as rows: checks, model, answers; and the service's status rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import inference
from ..functions.text import dotted, drop_private
from ..sources.readers import audio_info
from .rules import request_status


def limits(settings: dict) -> dict:
    """Limits of a settings mapping, with the defaults of the contract."""
    s = settings.get("service", settings) or {}
    return {
        "extensions": dotted(s.get("allowed_extensions", [".wav"])), "mimes": list(s.get("allowed_mime_prefixes", ["audio/", "application/octet-stream"])),
        "max_bytes": int(float(s.get("max_upload_mb", 25)) * 1024 * 1024), "max_seconds": float(s.get("max_audio_duration_sec", 120)),
    }


def answer(requests: DataFrame, model: Mapping, settings: dict) -> DataFrame:
    """`requests` (filename, content_type, language, content) with status, code, text, language, duration_ms, model and the
    JSON body of the response. Contents over the size limit are not decoded; only accepted rows reach the model. Recordings
    stay in memory: no temporary file is left behind, whatever fails."""
    rule = limits(settings)
    df = requests.withColumn("size", F.coalesce(F.octet_length("content"), F.lit(0)))
    df = df.withColumn("info", audio_info(F.when(F.col("size") <= rule["max_bytes"], F.col("content"))))
    status = request_status(F.col("filename"), F.col("content_type"), F.col("size"), F.col("info.duration_sec"), F.col("info.error").isNull(), **rule)
    df = df.withColumn("s", status).select("filename", "content_type", "language", "content", "s.status", "s.code")
    # what is refused goes by with nothing to hear
    heard = inference.transcribe(df.withColumn("content", F.when(F.col("status") == 200, F.col("content"))), model)
    refused, good = F.col("status") != 200, F.col("ok")
    out = heard.select(
        "filename", "content_type", F.when(refused | good, F.col("status")).otherwise(500).alias("status"),
        F.when(refused | good, F.col("code")).otherwise("transcription_failed").alias("code"), F.col("hypothesis").alias("text"),
        F.col("hyp_language").alias("language"), F.col("model_ms").alias("duration_ms"), F.col("model_id").alias("model"),
    )
    body = F.when(F.col("status") == 200, F.to_json(F.struct("text", "language", F.col("duration_ms").alias("durationMs"), "model"))).otherwise(F.to_json(F.struct(F.struct("code", F.col("code").alias("message")).alias("error"))))
    return out.withColumn("body", body)


def log_rows(requests: DataFrame) -> DataFrame:
    """What may be logged of requests: no audio."""
    return requests.select(*drop_private(requests.columns))


def health(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("ok",)], "status string")


def readiness(model: Mapping) -> tuple[bool, str | None, str | None]:
    """(ready, model, reason): whether the plan's engine loads. Each call tries again."""
    try:
        known = inference.plan(model)
        inference.opened(known)[0]()
        return True, known["model_id"], None
    except Exception as exc:
        return False, None, str(exc)


def ready(spark: SparkSession, model: Mapping) -> DataFrame:
    return spark.createDataFrame([readiness(model)], "ready boolean, model string, reason string")


def model_info(spark: SparkSession, model: Mapping) -> DataFrame:
    """What is asked for, as it stands in the settings; "auto" is settled where the model is opened."""
    fields = ("model_id", "adapter", "device", "compute_type", "default_language")
    known = inference.plan(model)
    return spark.createDataFrame([tuple(str(known[f]) for f in fields)], ", ".join(f"{f} string" for f in fields))

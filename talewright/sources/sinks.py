"""Sinks: manifests, reports, canonical audio, machine facts."""

from __future__ import annotations

import json
import os
import platform
import subprocess
from collections.abc import Iterator
from datetime import datetime, timezone
from importlib import metadata
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio as A
from ..functions.types import of
from ..storage import small, staged
from .readers import audio_info

FIELDS = ("audio", "text", "language", "speaker_id", "duration_sec", "domain", "source", "recording_profile", "noise_profile")


def manifest_json(entries: DataFrame) -> DataFrame:
    """(value): one JSON object for each entry, null fields left out, field order fixed."""
    return entries.select(F.to_json(F.struct(*(c for c in FIELDS if c in entries.columns))).alias("value"))


def write_manifest(entries: DataFrame, path: str, header: str | None = None) -> None:
    """A folder of JSONL files; the first holds the header comment."""
    lines = manifest_json(entries)
    if header:
        lines = entries.sparkSession.createDataFrame([(f"# {header}",)], "value string").unionByName(lines)
    lines.write.mode("overwrite").text(path)


def write_splits(entries: DataFrame, root: str) -> None:
    entries.select("split", F.to_json(F.struct(*(c for c in FIELDS if c in entries.columns))).alias("value")).write.mode("overwrite").partitionBy("split").text(root)


def stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d-%H%M%S")


def now_utc() -> str:
    return datetime.now(timezone.utc).isoformat()


def markdown(summary: dict) -> str:
    """The report for people: headline figures, confusions, domains."""
    figures = [
        ("Model", summary["model_id"]), ("Utterances", f"{summary['utterances']} ({summary['skipped']} skipped)"), ("Word error rate, mean", summary["wer_macro"]),
        ("Character error rate, mean", summary["cer_macro"]), ("Exact phrases", summary["phrase_accuracy_global"]),
        *((k.replace("_", " ").capitalize(), v) for k, v in summary.items() if k.endswith(("term_accuracy", "token_accuracy"))),
        ("Latency in ms", summary["latency_ms"]), ("Real-time factor, mean", summary["real_time_factor_mean"]),
    ]
    lost = [f"- {ref} -> {hyp}: {n}" for ref, row in summary["critical_term_errors"].items() for hyp, n in row.items()] or ["- none"]
    table = ["| domain | utterances | mean WER | exact phrases |", "|---|---|---|---|", *(f"| {d} | {s['utterances']} | {s['mean_wer']} | {s['phrase_accuracy']} |" for d, s in summary["per_domain"].items())]
    return "\n".join(["# Transcript benchmark", "", *(f"- {k}: {v}" for k, v in figures), "", "## Critical terms", "", *lost, "", "## Domains", "", *table, ""])


def write_report(summary: dict, records: DataFrame, errors: DataFrame | None, out_dir: str, meta: dict | None = None) -> tuple[str, str]:
    """<stamp>-baseline.json (meta, summary) and .md on the driver; records and errors as JSON folders beside them."""
    out = Path(out_dir)
    out.mkdir(parents=True, exist_ok=True)
    base = out / f"{stamp()}-baseline"
    records.write.mode("overwrite").json(f"{base}-records")
    if errors is not None:
        errors.write.mode("overwrite").json(f"{base}-errors")
    Path(f"{base}.json").write_text(json.dumps({"meta": meta or {}, "summary": summary, "records": f"{base.name}-records", "errors": f"{base.name}-errors"}, ensure_ascii=False, indent=2), encoding="utf-8")
    Path(f"{base}.md").write_text(markdown(summary), encoding="utf-8")
    return f"{base}.json", f"{base}.md"


@F.pandas_udf(of("binary"))
def canonical_wav(content: pd.Series) -> pd.Series:
    """Canonical WAV bytes; null where the input cannot be read."""

    def one(raw):
        try:
            return A.encode_wav(A.canonical(bytes(raw) if raw is not None else b""))
        except A.AudioError:
            return None

    return content.map(one)


def _put(target: str, content: bytes) -> None:
    """Write a file as a whole, under another name first; again, it is the same file."""
    system, path = fs.FileSystem.from_uri(target if "://" in target or target.startswith("file:") else Path(target).absolute().as_uri())
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(f"{path}.part") as out:
        out.write(content)
    system.move(f"{path}.part", path)


def write_files(files: DataFrame, target: str = "target", content: str = "content") -> int:
    """Write each row's bytes as a file at its `target` path, local or in a store, that executors reach; gives their number.
    Files are put in place by the tasks, with no list of them on the driver; a task that runs again puts the same ones."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, raw in zip(batch.column(0), batch.column(1)):
                _put(to.as_py(), raw.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.select(target, content).mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_canonical(files: DataFrame, target: str = "target", overwrite: bool = True) -> DataFrame:
    """Write each row's canonical WAV to its `target` path, local or in a store, that executors reach; gives (path, target, status,
    reason, info) with the written file's facts. Two inputs with one target are a failure of all but the first path.

    Targets are decided on paths alone. What is written is staged first, so that it is made once; a task that runs again
    puts the same files in place. The result is a staged table: when this returns, the files are there.
    """
    spark = files.sparkSession
    paths = files.select("path", F.col(target).alias("target"))
    firsts = paths.groupBy("target").agg(F.min("path").alias("first"))
    plan = paths.join(firsts, "target")
    if not overwrite:
        there = list_targets(spark, plan)
        plan = plan.join(there, "target", "left")
    else:
        plan = plan.withColumn("there", F.lit(False))
    plan = staged(plan, "targets")
    chosen = plan.where((F.col("path") == F.col("first")) & ~F.coalesce("there", F.lit(False)))
    made = files.select("path", "content").join(small(chosen.select("path", "target")), "path")
    made = staged(made.select("path", "target", canonical_wav("content").alias("wav"), audio_info("content")["error"].alias("fault")), "wavs")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            faults = []
            for to, wav, fault in zip(*(batch.column(c).to_pylist() for c in ("target", "wav", "fault"))):
                if wav is not None:
                    try:
                        _put(to, wav)
                    except OSError as exc:
                        fault = str(exc)
                faults.append(None if wav is not None and fault is None else fault or "cannot be decoded")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(faults, pa.string())], names=["path", "fault"])

    receipts = staged(made.mapInArrow(put, "path string, fault string"), "receipts")
    written = made.select("path", "wav").join(receipts.where("fault IS NULL"), "path").select("path", audio_info("wav").alias("info"))
    later, kept = F.col("path") != F.col("first"), F.coalesce("there", F.lit(False))
    out = plan.join(receipts, "path", "left").join(written, "path", "left")
    return staged(out.select(
        "path", F.col("target").alias(target),
        F.when(later, "failed").when(kept, "skipped_existing").when(F.col("fault").isNotNull(), "failed").otherwise("ok").alias("status"),
        F.when(later, F.concat(F.lit("same target as "), F.col("first"))).otherwise(F.col("fault")).alias("reason"), "info",
    ), "written")


def list_targets(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """(target, there): whether a file exists, asked where the tasks run."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = []
            for to in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(to if "://" in to or to.startswith("file:") else Path(to).absolute().as_uri())
                there.append(system.get_file_info(path).type != fs.FileType.NotFound)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(there, pa.bool_())], names=["target", "there"])

    return plan.select("target").distinct().mapInArrow(ask, "target string, there boolean")


def _version(module: str) -> str | None:
    try:
        return metadata.version(module)
    except metadata.PackageNotFoundError:
        return None


def _graphics() -> list[tuple[str, str | None, str | None]]:
    """(name, memory, driver) of the graphics devices that the vendor's tool lists; none without it."""
    query = ["nvidia-smi", "--query-gpu=name,memory.total,driver_version", "--format=csv,noheader"]
    try:
        done = subprocess.run(query, capture_output=True, text=True, timeout=10, check=True)
    except (OSError, subprocess.SubprocessError):
        return []
    return [tuple(([x.strip() for x in line.split(",")] + [None, None])[:3]) for line in done.stdout.splitlines() if line.strip()]


def environment(spark: SparkSession) -> DataFrame:
    """One row about the machine and its runtime."""
    from ..inference import gpus, placement

    memory = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") if hasattr(os, "sysconf") else None
    device, precision = placement({})
    versions = {m: v for m in ("pyspark", "pyarrow", "numpy", "ctranslate2", "faster-whisper", "torch") if (v := _version(m))}
    row = (platform.platform(), platform.machine(), platform.python_version(), spark.version, os.cpu_count(), memory, device, precision, gpus(), _graphics(), versions)
    return spark.createDataFrame([row], "system string, machine string, python string, spark string, cpus int, memory_bytes long, device string, compute_type string, cuda_devices int, gpus array<struct<name:string,memory:string,driver:string>>, versions map<string,string>")


def write_environment(spark: SparkSession, path: str) -> None:
    """The row as one JSON file; folders are made."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(json.dumps(environment(spark).first().asDict(recursive=True), indent=2), encoding="utf-8")

"""Sources: manifests, transcript tables, term profiles, settings, audio files."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import audio as A
from ..functions.text import dotted
from ..functions.types import array, of, struct
from ..operators.rules import missing_columns, validate
from ..storage import small, staged

AUDIO_FILES = (".wav", ".flac", ".mp3", ".m4a", ".ogg", ".opus", ".aac", ".aiff", ".webm")
INFO = struct(sample_rate="int", channels="int", frames="long", duration_sec="double", format="string", subtype="string", error="string")


class ManifestError(ValueError):
    """A manifest line breaks the contract."""


def manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no from 0, line) of a JSONL manifest, without blank lines and comments. Files are read in splits; a line's
    number is its place in its split and the lines of the file's splits before it, which are counted first."""
    at = F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.monotonically_increasing_id().alias("i"), "value")
    splits = lines.groupBy("file", "at").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = staged(splits.select("file", "at", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "splits")
    numbered = lines.join(small(splits), ["file", "at"]).select("file", (F.col("before") + F.col("i") - F.col("first")).alias("line_no"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("line"))
    return numbered.where((F.col("line") != "") & ~F.startswith("line", F.lit("#")))


def read_manifest(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Validated entries with `error` and `errors`. strict: the first bad line, by number, is raised; JSON faults name the
    line from 1, others the entry from 0."""
    out = validate(manifest_lines(spark, path))
    if strict and (bad := out.where("error IS NOT NULL").orderBy("file", "line_no").first()):
        where = f"line {bad['line_no'] + 1}" if bad["error"] == "bad_json" else f"entry[{bad['line_no']}]"
        raise ManifestError(f"{where}: {bad['error']}")
    return out


def read_transcripts(spark: SparkSession, path: str, audio_info: DataFrame | None = None) -> DataFrame:
    """Entries of a transcript CSV with a header. Defaults come before cells are trimmed; empty optional cells are null.
    Durations that are missing come from audio_info(audio, duration_sec)."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    if lost := missing_columns(raw.columns):
        raise ManifestError(f"columns missing: {', '.join(lost)}")
    cell = lambda name: F.nullif(F.col(name), F.lit("")) if name in raw.columns else F.lit(None).cast("string")
    trimmed = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    default = {"language": "id", "domain": "general", "source": "recorded"}
    out = raw.select(
        *(trimmed(F.coalesce(cell(n), F.lit(""))).alias(n) for n in ("audio", "text", "speaker_id")),
        *(trimmed(F.coalesce(cell(n), F.lit(v))).alias(n) for n, v in default.items()),
        trimmed(cell("duration_sec")).try_cast("double").alias("duration_sec"),
        *(F.nullif(trimmed(cell(n)), F.lit("")).alias(n) for n in ("recording_profile", "noise_profile")),
    )
    return out if audio_info is None else with_probed_duration(out, audio_info)


def with_probed_duration(entries: DataFrame, audio_info: DataFrame) -> DataFrame:
    probed = audio_info.select("audio", F.col("duration_sec").alias("_probed"))
    return entries.join(probed, "audio", "left").withColumn("duration_sec", F.coalesce("duration_sec", "_probed")).drop("_probed")


def load_yaml(path: str, required: bool = True) -> dict:
    """A mapping from a YAML (or JSON) file; anything else gives {}. A missing file is an error only if required."""
    file = Path(path)
    if not file.exists():
        if required:
            raise FileNotFoundError(path)
        return {}
    text = file.read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        found = json.loads(text or "{}")
    else:
        found = yaml.safe_load(text)
    return found if isinstance(found, dict) else {}


def deep_merge(base: dict, override: dict) -> dict:
    """A new mapping; values of `override` win, mappings are merged."""
    return {k: deep_merge(base[k], override[k]) if isinstance(base.get(k), dict) and isinstance(override.get(k), dict) else override.get(k, base.get(k)) for k in [*base, *(k for k in override if k not in base)]}


def profile_frames(spark: SparkSession, profile: dict) -> tuple[DataFrame, DataFrame, list[str]]:
    """terms(category, term), confusions(reference, forbidden) and the sorted critical terms of a profile mapping."""
    keys = {"entities": "entity", "financial_terms": "financial", "currencies": "currency", "amount_tokens": "amount", "date_tokens": "date"}
    terms = [(c, str(t).lower()) for k, c in keys.items() for t in profile.get(k) or []]
    pairs: dict[str, set[str]] = {}
    for item in profile.get("critical_confusions") or []:
        ref, bad = str(item.get("reference", "")).lower().strip(), {str(t).lower().strip() for t in item.get("forbidden") or []}
        if ref and bad:
            pairs.setdefault(ref, set()).update(bad)
    critical = sorted({*pairs, *(str(t).lower() for t in profile.get("critical_terms") or [])})
    return (
        spark.createDataFrame(terms, "category string, term string"),
        spark.createDataFrame([(r, f) for r, fs in sorted(pairs.items()) for f in sorted(fs)], "reference string, forbidden string"),
        critical,
    )


def load_profile(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, list[str]]:
    return profile_frames(spark, load_yaml(path))


def list_audio(spark: SparkSession, root: str, extensions: tuple[str, ...] = AUDIO_FILES) -> DataFrame:
    """(path, length) of audio files below root, sorted; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.where(F.lower(F.regexp_extract("path", r"[^./](\.[^./]+)$", 1)).isin(*dotted(list(extensions)))).select("path", "length").orderBy("path")


def read_audio(spark: SparkSession, root: str, max_bytes: int | None = None) -> DataFrame:
    """(path, length, content) of all files below root; larger ones than max_bytes are left unread.

    A small file counts as megabytes when splits are made, so that a task would read a few of them only: splits are read
    one after the other by fewer tasks, up to 32 splits by each.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "content")
    if max_bytes is not None:
        files = files.where(F.col("length") <= max_bytes)
    splits = files.rdd.getNumPartitions()
    return files.coalesce(max(min(splits, 4 * spark.sparkContext.defaultParallelism), -(-splits // 32), 1))


@F.pandas_udf(INFO)
def audio_info(content: pd.Series) -> pd.DataFrame:
    """Header facts or an error."""
    rows = []
    for raw in content:
        try:
            i = A.inspect(None if raw is None else bytes(raw))
            rows.append((i.sample_rate, i.channels, i.frames, i.duration_sec, i.format, i.subtype, None))
        except A.AudioError as exc:
            rows.append((None,) * 6 + (str(exc),))
    out = pd.DataFrame(rows, columns=["sample_rate", "channels", "frames", "duration_sec", "format", "subtype", "error"])
    return out.astype({"sample_rate": "Int32", "channels": "Int32", "frames": "Int64"})


@F.pandas_udf(struct(rate="int", samples=array("float")))
def decoded(content: pd.Series) -> pd.DataFrame:
    """Mono samples in [-1, 1] at the file's rate; null where it cannot be read."""
    rows = []
    for raw in content:
        try:
            x, rate = A.decode(bytes(raw) if raw is not None else b"")
            rows.append((rate, A.mono(x)))
        except A.AudioError:
            rows.append((None, None))
    return pd.DataFrame(rows, columns=["rate", "samples"]).astype({"rate": "Int32"})


@F.pandas_udf(array("float"))
def canonical_samples(content: pd.Series) -> pd.Series:
    def one(raw):
        try:
            return A.canonical(bytes(raw) if raw is not None else b"")
        except A.AudioError:
            return None

    return content.map(one)


@F.pandas_udf(of("binary"))
def _clip(i: pd.Series) -> pd.Series:
    return i.map(lambda k: A.encode_wav(A.tone(42 + int(k))))


def smoke_entries(spark: SparkSession, count: int = 3) -> DataFrame:
    """Synthetic clips with placeholder references, for runs that test the plumbing only."""
    domains = F.array(*(F.lit(d) for d in ("general", "cash_flow", "reporting")))
    clips = spark.range(count).select(F.col("id"), _clip("id").alias("content"))
    return clips.select(
        F.concat(F.lit("smoke_"), F.col("id").cast("string"), F.lit(".wav")).alias("audio"), F.lit("placeholder").alias("text"), F.lit("id").alias("language"),
        F.concat(F.lit("spk_smoke_"), F.col("id").cast("string")).alias("speaker_id"), audio_info("content")["duration_sec"].alias("duration_sec"),
        F.get(domains, (F.col("id") % 3).cast("int")).alias("domain"), F.lit("synthetic").alias("source"), "content",
    )

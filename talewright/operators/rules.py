"""Manifest data quality: rules on raw JSON lines, first failure and all failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extension, has_any_prefix

#: Fixed values of the manifest contract.
DOMAINS = (
    "general", "navigation", "cash_flow", "transaction", "receivable", "payable", "intercompany", "reporting",
    "project", "counterparty", "currency_fx", "amount", "date_time", "management", "assistant_query",
)
SOURCES = ("recorded", "synthetic")
LANGUAGES = ("id", "en", "mixed")
EXTENSIONS = (".wav", ".flac", ".mp3", ".m4a", ".ogg", ".opus")
REQUIRED = ("audio", "text", "language", "speaker_id", "duration_sec", "domain", "source")
OPTIONAL = ("recording_profile", "noise_profile")
SPEAKER = r"^spk_[0-9A-Za-z_-]+$"
MAX_SECONDS = 600


def _parsed(line: Column) -> Column:
    """What a line holds, parsed once: its type, and type and text of each field of the contract; a field that is missing has
    no type."""
    whole = F.try_parse_json(line)

    def field(v: Column, name: str) -> Column:
        own = F.try_variant_get(v, f"$.{name}", "variant")
        return F.struct(F.schema_of_variant(own).alias("kind"), F.try_variant_get(v, f"$.{name}", "string").alias("text"))

    facts = lambda v: F.struct(F.schema_of_variant(v).alias("kind"), *(field(v, n).alias(n) for n in (*REQUIRED, *OPTIONAL)))
    return F.element_at(F.transform(F.array(whole), facts), 1)


def failures(p: Column) -> list[tuple[str, Column]]:
    """(code, condition) of every rule on a parsed line, in the order in which the first failure counts."""
    string = lambda name: p[name]["kind"] == "STRING"
    text_like = lambda name: string(name) & p[name]["text"].rlike(r"(?U)\S")
    member = lambda name, values: string(name) & p[name]["text"].isin(*values)
    seconds = p["duration_sec"]["text"].try_cast("double")
    ext = extension(p["audio"]["text"])
    rules = [("not_an_object", F.startswith(p["kind"], F.lit("OBJECT")))]
    rules += [(f"missing_{name}", p[name]["kind"].isNotNull()) for name in REQUIRED]
    rules += [
        ("blank_audio", text_like("audio")),
        ("audio_extension", (ext == "") | ext.isin(*EXTENSIONS)),
        ("blank_text", text_like("text")),
        ("language", member("language", LANGUAGES)),
        ("speaker_id", string("speaker_id") & p["speaker_id"]["text"].rlike(SPEAKER)),
        ("duration_type", F.regexp_like(p["duration_sec"]["kind"], F.lit("^(DECIMAL.*|BIGINT|DOUBLE|FLOAT)$"))),
        ("duration_range", (seconds > 0) & (seconds <= MAX_SECONDS)),
        ("domain", member("domain", DOMAINS)),
        ("source", member("source", SOURCES)),
    ]
    return [(code, ~F.coalesce(good, F.lit(False))) for code, good in rules]


def validate(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """`lines` with the manifest fields, `error` (the first failing rule, null if valid) and `errors` (all of them).

    Lines that are not JSON have the error bad_json. Unknown keys are dropped. A NaN duration is rejected.
    """
    df = lines.withColumn("_parsed", _parsed(F.col(line_col)))
    p = F.col("_parsed")
    found = [("bad_json", p["kind"].isNull()), *failures(p)]
    codes = [F.when(bad, F.lit(code)) for code, bad in found]
    df = df.withColumn("error", F.coalesce(*codes))
    first = F.col("error").isin("bad_json", "not_an_object")
    df = df.withColumn("errors", F.when(first, F.array("error")).otherwise(F.array_compact(F.array(*codes))))
    good = F.col("error").isNull()
    fields = [F.when(good, p[n]["text"].try_cast("double") if n == "duration_sec" else p[n]["text"]).alias(n) for n in (*REQUIRED, *OPTIONAL)]
    return df.select(*lines.columns, *fields, "error", "errors")


def valid_entries(validated: DataFrame) -> DataFrame:
    return validated.where("error IS NULL").drop("error", "errors")


def rejected_entries(validated: DataFrame) -> DataFrame:
    return validated.where("error IS NOT NULL").select(*[c for c in validated.columns if c not in (*REQUIRED, *OPTIONAL)])


def missing_columns(have: list[str], need: tuple[str, ...] = ("audio", "text", "speaker_id")) -> list[str]:
    return sorted(set(need) - set(have))


def synthetic_in_test(entries: DataFrame) -> DataFrame:
    """Rows that break the policy of a test split without synthetic speech."""
    return entries.where((F.col("split") == "test") & (F.col("source") == "synthetic"))


def unknown_domains(entries: DataFrame) -> DataFrame:
    return entries.where(~F.col("domain").isin(*DOMAINS))


def request_status(filename: Column, content_type: Column, size: Column, seconds: Column, readable: Column, extensions: list[str], mimes: list[str], max_bytes: int, max_seconds: float) -> Column:
    """struct<status, code> of a transcription request; checks in order, the first that fails decides."""
    answer = lambda status, code: F.struct(F.lit(status).alias("status"), F.lit(code).alias("code"))
    ext = extension(F.coalesce(filename, F.lit("")))
    return (
        F.when(~ext.isin(*extensions), answer(415, "unsupported_format"))
        .when(~has_any_prefix(F.coalesce(content_type, F.lit("")), mimes), answer(415, "unsupported_media_type"))
        .when(size > max_bytes, answer(413, "payload_too_large"))
        .when(F.coalesce(size, F.lit(0)) == 0, answer(400, "empty_upload"))
        .when(~F.coalesce(readable, F.lit(False)), answer(400, "invalid_audio"))
        .when(seconds > max_seconds, answer(400, "audio_too_long"))
        .otherwise(answer(200, "ok"))
    )

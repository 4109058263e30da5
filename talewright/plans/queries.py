"""Queries by operator, over whole tables of the driver, and their SQL."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import inference
from ..functions import align, audio, text
from ..functions import types as _types
from ..operators import requests, rules, split, summary
from ..operators import terms as T
from ..sources import readers, sinks
from ..storage import staged, staging_path, table
from . import views
from .views import KEY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


# ---------------------------------------------------------------- shared SQL

NORMAL = r"trim(regexp_replace(regexp_replace(replace(lower(coalesce({0}, '')), '-', ''), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
TOKENS = "list_filter(string_split({0}, ' '), lambda t: t <> '')"
DOMAIN_LIST = "[" + ", ".join(f"'{d}'" for d in rules.DOMAINS) + "]"
CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in T.CATEGORIES) + "]"
DISTURBED = "flatten(list_transform({0}, lambda t, i: CASE WHEN (i - 1 + {1}) % 7 = 0 THEN []::VARCHAR[] WHEN (i - 1 + {1}) % 5 = 0 THEN [t || 'x'] WHEN (i - 1 + {1}) % 11 = 0 THEN [t, t] ELSE [t] END))"
UTT = rf"""cut AS (SELECT conv_id, turn, role, string_split_regex(text, '[.\n]+') AS parts FROM conversations),
each_part AS (SELECT conv_id, turn, role, unnest(parts) AS raw, unnest(range(len(parts))) AS pos FROM cut),
utt AS (SELECT conv_id, turn, pos, trim(raw) AS text, 'clips/' || conv_id || '_' || turn || '_' || pos || '.wav' AS audio, 'mixed' AS language, 'spk_' || conv_id AS speaker_id,
  length(trim(raw)) / 15.0::DOUBLE AS duration_sec, {DOMAIN_LIST}[(turn + conv_id) % 15 + 1] AS domain, CASE WHEN role = 'system' THEN 'synthetic' ELSE 'recorded' END AS source
  FROM each_part WHERE trim(raw) <> '')"""
PAIRS = UTT + f""", norm AS (SELECT *, {NORMAL.format('text')} AS ref_normal FROM utt), toks AS (SELECT *, {TOKENS.format('ref_normal')} AS ref_tokens FROM norm),
hyps AS (SELECT *, {DISTURBED.format('ref_tokens', 'turn + conv_id')} AS hyp_tokens FROM toks),
pairs AS (SELECT *, array_to_string(hyp_tokens, ' ') AS hyp_normal, (100 + (conv_id * 37 + turn * 11 + pos * 7) % 900)::DOUBLE AS latency_ms FROM hyps)"""
_LEV = "levenshtein(array_to_string(list_transform({0}, lambda t: chr(list_position({2}, t)::INT)), ''), array_to_string(list_transform({1}, lambda t: chr(list_position({2}, t)::INT)), ''))"
RECORDS = PAIRS + f""", known AS (SELECT *, list_distinct(ref_tokens || hyp_tokens) AS kw, string_split(replace(ref_normal, ' ', ''), '') AS rc, string_split(replace(hyp_normal, ' ', ''), '') AS hc FROM pairs),
known2 AS (SELECT *, list_distinct(rc || hc) AS kc FROM known),
scored AS (SELECT *, {_LEV.format('ref_tokens', 'hyp_tokens', 'kw')} AS word_errors, {_LEV.format('rc', 'hc', 'kc')} AS char_errors FROM known2),
records AS (SELECT conv_id, turn, pos, speaker_id, domain, duration_sec, latency_ms, word_errors::BIGINT AS word_errors, len(ref_tokens)::BIGINT AS ref_len, word_errors / greatest(len(ref_tokens), 1)::DOUBLE AS wer,
  char_errors / greatest(length(replace(ref_normal, ' ', '')), 1)::DOUBLE AS cer, ref_normal = hyp_normal AS exact_match, CASE WHEN duration_sec > 0 THEN latency_ms / 1000.0::DOUBLE / duration_sec ELSE 0.0 END AS real_time_factor FROM scored)"""
TERMS = PAIRS + f""", single AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS rank FROM (SELECT term, count(*) AS n FROM (SELECT unnest(ref_tokens) AS term FROM pairs) GROUP BY term ORDER BY n DESC, term LIMIT {views.TOP_TOKENS})),
bigrams AS (SELECT unnest([ref_tokens[i] || ' ' || ref_tokens[i + 1] for i in range(1, len(ref_tokens))]) AS term FROM pairs),
double_ AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS rank FROM (SELECT term, count(*) AS n FROM bigrams GROUP BY term ORDER BY n DESC, term LIMIT {views.TOP_BIGRAMS})),
terms AS (SELECT {CATEGORY_LIST}[rank % 5 + 1] AS category, term, string_split(term, ' ') AS w FROM (SELECT * FROM single UNION ALL SELECT * FROM double_)),
confusions AS (SELECT term AS reference, term || 'x' AS forbidden FROM single WHERE rank < {views.TOP_CONFUSIONS})"""
_OCC = "len(list_filter(range(1, len({0}) - len({1}) + 2), lambda i: {0}[i:i + len({1}) - 1] = {1}))"
COUNTS = TERMS + f""", counts AS (SELECT * FROM (SELECT conv_id, turn, pos, category, term, {_OCC.format('ref_tokens', 'w')}::BIGINT AS expected, {_OCC.format('hyp_tokens', 'w')}::BIGINT AS predicted FROM pairs, terms) WHERE expected + predicted > 0)"""


def _cell(c: str, s: str, d: str, n: str, p: str) -> str:
    return f"{{'c': ({c})::BIGINT, 's': ({s})::BIGINT, 'd': ({d})::BIGINT, 'n': ({n})::BIGINT, 'p': {p}}}"


def alignment_sql(source: str, key: str) -> str:
    """Recursive CTE `aligned` over `source` (key, ref_tokens, hyp_tokens); one step for each reference token."""
    up, left, corner = "r.cells[j + 1]", "acc[j]", "r.cells[j]"
    match = _cell(f"({corner}.c // 4) * 4 + 3", f"{corner}.s", f"{corner}.d", f"{corner}.n", f"{corner}.p")
    options = ", ".join((
        _cell(f"({up}.c // 4 + 1) * 4", f"{up}.s", f"{up}.d + 1", f"{up}.n", f"{up}.p"),
        _cell(f"({left}.c // 4 + 1) * 4 + 1", f"{left}.s", f"{left}.d", f"{left}.n + 1", f"{left}.p"),
        _cell(f"({corner}.c // 4 + 1) * 4 + 2", f"{corner}.s + 1", f"{corner}.d", f"{corner}.n", f"{corner}.p || r.ref_tokens[r.i + 1] || '>' || r.hyp_tokens[j] || ';'"),
    ))
    return f"""r(key, ref_tokens, hyp_tokens, i, cells) AS (
  SELECT {key}, ref_tokens, hyp_tokens, 0::BIGINT, [{_cell('j * 4 + 1', '0', '0', 'j', "''")} for j in range(0, len(hyp_tokens) + 1)] FROM {source}
  UNION ALL
  SELECT r.key, r.ref_tokens, r.hyp_tokens, r.i + 1,
    list_reduce(range(1, len(r.hyp_tokens) + 1), lambda acc, j: list_append(acc, CASE WHEN r.ref_tokens[r.i + 1] = r.hyp_tokens[j] THEN {match} ELSE least({options}) END), [{_cell('(r.i + 1) * 4', '0', 'r.i + 1', '0', "''")}])
  FROM r WHERE r.i < len(r.ref_tokens)
), aligned AS (SELECT key, len(ref_tokens) AS ref_len, len(hyp_tokens) AS hyp_len, cells[len(hyp_tokens) + 1] AS z FROM r WHERE i = len(ref_tokens))"""


def _round(x: Column, digits: int) -> Column:
    """round() as the SQL's engine computes it: the scaled double to a whole number, halves away from zero, and scaled back.
    Spark's own goes by the decimal form, which differs by one in the last digit where scaling meets a half."""
    scaled = x * 10.0**digits
    near = F.rint(scaled)
    out = F.when(F.abs(scaled - near) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(near) / 10.0**digits
    return F.when(F.isnan(out) | (F.abs(out) == float("inf")), x).otherwise(out)


# ---------------------------------------------------------------- text


@query("txt1_normalize", f"SELECT doc_id, {NORMAL.format('text')} AS normal FROM documents")
def txt1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize(F.col("text"), with_nfkc=False).alias("normal"))


@query("txt1_nfkc", f"SELECT page_id, {NORMAL.format('url')} AS normal FROM pages")
def txt1_nfkc(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.normalize(F.col("url")).alias("normal"))


@query("txt2_tokenize", f"SELECT doc_id, len(w)::BIGINT AS n_tokens, len(list_distinct(w))::BIGINT AS n_distinct FROM (SELECT doc_id, {TOKENS.format(NORMAL.format('text'))} AS w FROM documents)")
def txt2(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", text.tokenize(F.col("text"), with_nfkc=False).alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))


@query("txt3_characters", f"SELECT doc_id, length(replace({NORMAL.format('text')}, ' ', ''))::BIGINT AS n FROM documents")
def txt3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length(text.characters(text.normalize(F.col("text"), with_nfkc=False))).cast("long").alias("n"))


@query("txt4_extension", r"SELECT page_id, lower(regexp_extract(url, '[^./](\.[^./]+)$', 1)) AS extension FROM pages")
def txt4(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.extension(F.col("url")).alias("extension"))


@query("txt5_drop_nulls", "SELECT doc_id, CASE WHEN toxic = 1 THEN 2 ELSE 3 END::BIGINT AS n_keys FROM labels")
def txt5(spark, sf):
    row = table(spark, sf, "labels").select("doc_id", F.to_json(F.struct("doc_id", "quality", F.when(F.col("toxic") == 0, F.lit("é")).alias("note"))).alias("j"))
    return row.select("doc_id", F.size(F.json_object_keys("j")).cast("long").alias("n_keys"))


@query("txt6_target_path", r"SELECT page_id, 'out/' || regexp_replace(regexp_replace(url, '^http://', ''), '([^./])\.[^./]+$', '\1') || '.wav' AS target FROM pages")
def txt6(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.canonical_target(F.col("url"), "http://", "out").alias("target"))


@query("txt7_join_segments", r"SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split_regex(text, '[.\n]+'), lambda x: trim(x)), lambda x: x <> ''), ' ') AS joined FROM conversations")
def txt7(spark, sf):
    segments = F.transform(F.split("text", r"[.\n]+"), lambda x: F.struct(F.lit(0.0).alias("start_sec"), F.lit(1.0).alias("end_sec"), x.alias("text")))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.join_segments(segments).alias("joined"))


@query("txt8_milliseconds", "SELECT event_id, trunc(value * 1000)::BIGINT AS ms FROM events")
def txt8(spark, sf):
    return table(spark, sf, "events").select("event_id", text.milliseconds(F.col("value")).alias("ms"))


@query("txt9_allowlists", "SELECT page_id, (starts_with(lower(url), 'http://') OR starts_with(lower(url), 'https://blog')) AS allowed FROM pages")
def txt9(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.has_any_prefix(F.col("url"), ["HTTP://", "https://blog"]).alias("allowed"))


@query("txt10_timestamps", "SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS stamp FROM events")
def txt10(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd-HHmmss").alias("stamp"))


# ---------------------------------------------------------------- manifests

_BAD = """SELECT conv_id, turn, ['ok', 'blank_audio', 'blank_text', 'language', 'speaker_id', 'duration_type', 'duration_range', 'duration_type', 'domain', 'missing_source', 'bad_json', 'not_an_object'][conv_id % 12 + 1] AS error FROM conversations"""


@query("dq_manifest_rules", _BAD)
def dq(spark, sf):
    return rules.validate(views.bad_lines(spark, sf)).select("conv_id", "turn", F.coalesce("error", F.lit("ok")).alias("error"))


@query("dq_rejected", f"SELECT error, count(*) AS n FROM ({_BAD}) WHERE error <> 'ok' GROUP BY error")
def dq_rejected(spark, sf):
    return rules.rejected_entries(rules.validate(views.bad_lines(spark, sf))).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("dq13_missing_columns", "SELECT unnest(['audio', 'speaker_id']) AS missing")
def dq13(spark, sf):
    return spark.createDataFrame([(c,) for c in rules.missing_columns(table(spark, sf, "conversations").columns)], "missing string")


@query("dq14_synthetic_in_test", f"WITH {UTT} SELECT conv_id, turn, pos, speaker_id FROM utt WHERE conv_id % 10 = 9 AND source = 'synthetic'")
def dq14(spark, sf):
    u = views.utterances(spark, sf).withColumn("split", F.when(F.col("conv_id") % 10 == 9, "test").otherwise("train"))
    return rules.synthetic_in_test(u).select(*KEY, "speaker_id")


@query("dq15_unknown_domains", "SELECT doc_id, lang FROM documents WHERE lang <> 'en'")
def dq15(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("lang") == "en", "general").otherwise(F.col("lang")).alias("domain"))
    return rules.unknown_domains(d).select("doc_id", "lang")


@query("dq16_canonical_format", "SELECT p_partkey, (p_size % 2 = 0 AND p_size % 3 <> 0) AS canonical FROM part")
def dq16(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", audio.is_canonical(F.lit(16000), F.when(F.col("p_size") % 2 == 0, 1).otherwise(2), F.when(F.col("p_size") % 3 == 0, "PCM_24").otherwise("PCM_16")).alias("canonical"))


_STATUS = """SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 415 WHEN page_id % 6 = 1 THEN 415 WHEN octet_length(encode(html)) > 3000 THEN 413 WHEN page_id % 6 = 2 THEN 400 WHEN page_id % 6 = 3 THEN 400 ELSE 200 END AS status,
CASE WHEN page_id % 6 = 0 THEN 'unsupported_format' WHEN page_id % 6 = 1 THEN 'unsupported_media_type' WHEN octet_length(encode(html)) > 3000 THEN 'payload_too_large' WHEN page_id % 6 = 2 THEN 'invalid_audio' WHEN page_id % 6 = 3 THEN 'audio_too_long' ELSE 'ok' END AS code FROM pages"""


@query("dq17_request_status", _STATUS)
def dq17(spark, sf):
    k = F.col("page_id") % 6
    p = table(spark, sf, "pages").select("page_id", F.when(k == 0, "a.txt").otherwise("a.WAV").alias("name"), F.when(k == 1, "text/html").otherwise("Audio/wav").alias("type"), F.octet_length("html").alias("size"), (k != 2).alias("readable"), F.when(k == 3, 200.0).otherwise(1.0).alias("seconds"))
    answer = rules.request_status(F.col("name"), F.col("type"), F.col("size"), F.col("seconds"), F.col("readable"), [".wav"], ["audio/"], 3000, 120.0)
    return p.withColumn("a", answer).select("page_id", "a.status", "a.code")


@query("src1_manifest_round_trip", f"WITH {UTT} SELECT conv_id, turn, pos, text, speaker_id, duration_sec, domain, source FROM utt")
def src1(spark, sf):
    path = staging_path(spark, "manifest")
    sinks.write_manifest(views.utterances(spark, sf), path, "entries of all conversations")
    back = rules.valid_entries(readers.read_manifest(spark, path))
    part = F.split(F.regexp_extract("audio", r"clips/(.*)\.wav", 1), "_")
    return back.select(*(part[i].cast("long").alias(c) for i, c in enumerate(KEY)), "text", "speaker_id", "duration_sec", "domain", "source")


@query("src2_transcript_csv", f"WITH {UTT} SELECT audio, text, speaker_id, 'id' AS language, 'general' AS domain, 'recorded' AS source, duration_sec FROM utt")
def src2(spark, sf):
    path = staging_path(spark, "csv")
    views.utterances(spark, sf).select("audio", F.concat(F.lit(" "), "text").alias("text"), "speaker_id", F.lit("").alias("language")).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    info = views.utterances(spark, sf).select("audio", "duration_sec")
    return readers.read_transcripts(spark, path, info).select("audio", "text", "speaker_id", "language", "domain", "source", "duration_sec")


@query("src4_term_profile", f"WITH {TERMS} SELECT reference, count(*) AS n FROM confusions GROUP BY reference")
def src4(spark, sf):
    found = [r.asDict() for r in views.confusions(spark, sf).collect()]  # a few rows of a vocabulary
    profile = {"critical_confusions": [{"reference": r["reference"].upper(), "forbidden": [r["forbidden"], r["forbidden"].upper()]} for r in found] + [{"reference": "", "forbidden": ["x"]}, {"reference": "y", "forbidden": []}]}
    _, pairs, _ = readers.profile_frames(spark, profile)
    return pairs.groupBy("reference").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- joins and sets


@query("jn1_existing_files", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'file not found' ELSE 'ok' END AS reason FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def jn1(spark, sf):
    entries, files = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    return entries.join(files, "doc_id", "left_semi").withColumn("reason", F.lit("ok")).unionByName(entries.join(files, "doc_id", "left_anti").withColumn("reason", F.lit("file not found")))


@query("jn6_hypotheses", f"WITH {PAIRS} SELECT audio, text, hyp_normal AS hypothesis FROM pairs")
def jn6(spark, sf):
    hyps = views.pairs(spark, sf).select("audio", F.col("hyp_normal").alias("hypothesis"))
    return views.utterances(spark, sf).select("audio", "text").join(hyps, "audio")


@query("jn8_map_merge", """SELECT doc_id, list_sort(map_keys(m)) AS keys, CASE WHEN toxic = 1 THEN 'b' ELSE 'a' END AS k FROM (SELECT doc_id, toxic, MAP {'k': 'a', 'q': 'x', 't': 'y'} AS m FROM labels)""")
def jn8(spark, sf):
    base = F.create_map(F.lit("k"), F.lit("a"), F.lit("q"), F.lit("x"))
    over = F.create_map(F.lit("k"), F.when(F.col("toxic") == 1, "b"), F.lit("t"), F.lit("y"))
    merged = F.map_zip_with(base, over, lambda k, a, b: F.coalesce(b, a))
    return table(spark, sf, "labels").select("doc_id", F.array_sort(F.map_keys(merged)).alias("keys"), merged["k"].alias("k"))


_SPLIT3 = "CASE WHEN user_id % 7 = event_id % 7 THEN 'test' WHEN user_id % 2 = 0 THEN 'train' ELSE 'validation' END"


def _dealt_events(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").cast("string").alias("speaker_id"), F.when(F.col("user_id") % 7 == F.col("event_id") % 7, "test").when(F.col("user_id") % 2 == 0, "train").otherwise("validation").alias("split"))


@query("set1_leaks", f"SELECT speaker_id, splits FROM (SELECT user_id::VARCHAR AS speaker_id, list_sort(list_distinct(list({_SPLIT3}))) AS splits FROM events GROUP BY 1) WHERE len(splits) > 1")
def set1(spark, sf):
    return split.leaks(_dealt_events(spark, sf))


@query("jn7_pairwise_leaks", f"""WITH e AS (SELECT DISTINCT user_id::VARCHAR AS s, {_SPLIT3} AS p FROM events), pr AS (SELECT * FROM (VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) v(a, b))
SELECT pr.a || '/' || pr.b AS pair, list_sort(list(x.s)) AS speakers FROM pr JOIN e x ON x.p = pr.a JOIN e y ON y.p = pr.b AND y.s = x.s GROUP BY 1""")
def jn7(spark, sf):
    return split.pairwise_leaks(_dealt_events(spark, sf))


@query("set2_distinct_speakers", f"WITH {UTT} SELECT DISTINCT speaker_id FROM utt")
def set2(spark, sf):
    return views.utterances(spark, sf).select("speaker_id").distinct()


@query("set3_difference", "SELECT conv_id, list_sort(list_filter(['assistant', 'system', 'user'], lambda x: NOT list_contains(have, x))) AS missing FROM (SELECT conv_id, list(DISTINCT role) AS have FROM conversations GROUP BY conv_id)")
def set3(spark, sf):
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("have")).select("conv_id", F.array_sort(F.array_except(F.array(*map(F.lit, ("assistant", "system", "user"))), "have")).alias("missing"))


@query("set4_critical_terms", f"WITH {TERMS} SELECT list_sort(list_distinct(list(reference) || ['zzz'])) AS critical_terms FROM confusions")
def set4(spark, sf):
    return T.critical_vocabulary(views.confusions(spark, sf), ["zzz"])


@query("set5_union_of_splits", f"WITH {UTT} SELECT split, count(*) AS n FROM (SELECT 'a' AS split FROM utt UNION ALL SELECT 'b' FROM utt WHERE source = 'recorded') GROUP BY split")
def set5(spark, sf):
    u = views.utterances(spark, sf)
    return u.withColumn("split", F.lit("a")).unionByName(u.where("source = 'recorded'").withColumn("split", F.lit("b"))).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("ord1_latency_order", f"WITH {PAIRS} SELECT conv_id, turn, pos, row_number() OVER (PARTITION BY speaker_id ORDER BY latency_ms, turn, pos) AS place FROM pairs")
def ord1(spark, sf):
    return views.pairs(spark, sf).select(*KEY, F.row_number().over(Window.partitionBy("speaker_id").orderBy("latency_ms", "turn", "pos")).cast("long").alias("place"))


@query("lim1_first_entries", f"WITH {UTT} SELECT conv_id, turn, pos, text FROM utt ORDER BY conv_id, turn, pos LIMIT 100")
def lim1(spark, sf):
    return views.utterances(spark, sf).select(*KEY, "text").orderBy(*KEY).limit(100)


@query("top1_longest_by_domain", f"WITH {UTT} SELECT domain, arg_max(audio, struct_pack(d := duration_sec, a := audio)) AS audio FROM utt GROUP BY domain")
def top1(spark, sf):
    return views.utterances(spark, sf).groupBy("domain").agg(F.max_by("audio", F.struct("duration_sec", "audio")).alias("audio"))


# ---------------------------------------------------------------- alignment and terms


@query("al1_align_benchmark", f"""WITH RECURSIVE n AS (SELECT item_id, {TOKENS.format(NORMAL.format('text'))} AS ref_tokens FROM benchmark), t AS (SELECT item_id, ref_tokens, {DISTURBED.format('ref_tokens', 'item_id')} AS hyp_tokens FROM n),
{alignment_sql('t', 'item_id')} SELECT key AS item_id, z.s AS substitutions, z.d AS deletions, z.n AS insertions, ref_len::BIGINT AS ref_len, hyp_len::BIGINT AS hyp_len, z.p AS pairs FROM aligned""")
def al1(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", text.tokenize(F.col("text"), with_nfkc=False).alias("r"))
    a = b.withColumn("a", align.align("r", views.disturbed(F.col("r"), F.col("item_id"))))
    shown = F.array_join(F.transform("a.pairs", lambda p: F.concat(p["ref"], F.lit(">"), p["hyp"], F.lit(";"))), "")
    return a.select("item_id", *(F.col(f"a.{c}").cast("long").alias(c) for c in ("substitutions", "deletions", "insertions", "ref_len", "hyp_len")), shown.alias("pairs"))


@query("al1_align_utterances", f"""WITH RECURSIVE {PAIRS}, {alignment_sql('pairs', 'audio')} SELECT key AS audio, z.s AS substitutions, z.d AS deletions, z.n AS insertions FROM aligned""")
def al1_utterances(spark, sf):
    p = views.pairs(spark, sf).select("audio", align.align("ref_tokens", "hyp_tokens").alias("a"))
    return p.select("audio", *(F.col(f"a.{c}").cast("long").alias(c) for c in ("substitutions", "deletions", "insertions")))


@query("al2_word_errors", f"WITH {RECORDS} SELECT conv_id, turn, pos, word_errors, ref_len, wer FROM records")
def al2(spark, sf):
    return views.records(spark, sf).select(*KEY, "word_errors", "ref_len", "wer")


@query("al3_char_error_rate", f"WITH {RECORDS} SELECT conv_id, turn, pos, cer FROM records")
def al3(spark, sf):
    return views.records(spark, sf).select(*KEY, "cer")


@query("al4_exact_match", f"WITH {RECORDS} SELECT conv_id, turn, pos, exact_match FROM records")
def al4(spark, sf):
    return views.records(spark, sf).select(*KEY, "exact_match")


@query("tm1_occurrences", f"WITH {TERMS} SELECT term, sum({_OCC.format('ref_tokens', 'w')})::BIGINT AS n FROM pairs, terms GROUP BY term")
def tm1(spark, sf):
    return T.term_totals(views.pairs(spark, sf), views.terms(spark, sf))


@query("jn2_term_counts", f"WITH {COUNTS} SELECT conv_id, turn, pos, category, term, expected, predicted FROM counts")
def jn2(spark, sf):
    return T.term_counts(views.pairs(spark, sf), views.terms(spark, sf), KEY)


@query("tm2_term_scores", f"WITH {COUNTS} SELECT conv_id, turn, pos, category, sum(expected)::BIGINT AS expected, sum(predicted)::BIGINT AS predicted, sum(least(expected, predicted))::BIGINT AS correct, CASE WHEN sum(expected) > 0 THEN sum(least(expected, predicted))::DOUBLE / sum(expected)::DOUBLE END AS accuracy FROM counts GROUP BY ALL")
def tm2(spark, sf):
    return T.score_terms(T.term_counts(views.pairs(spark, sf), views.terms(spark, sf), KEY), KEY)


def _events(spark, sf):
    p = views.pairs(spark, sf).withColumn("alignment", align.align("ref_tokens", "hyp_tokens"))
    return T.critical_events(p, views.confusions(spark, sf), KEY)


_EVENTS = f"""WITH RECURSIVE {TERMS}, {alignment_sql('pairs', 'audio')},
subs AS (SELECT key AS audio, unnest(string_split(z.p, ';')) AS pr FROM aligned), crit AS (SELECT audio, reference AS reference_term, forbidden AS hypothesis_term FROM subs JOIN confusions ON pr = reference || '>' || forbidden),
lost AS (SELECT audio, reference AS reference_term, '' AS hypothesis_term FROM pairs, confusions WHERE len(list_filter(ref_tokens, lambda t: t = reference)) > len(list_filter(hyp_tokens, lambda t: t = reference))),
ev AS (SELECT * FROM crit UNION ALL SELECT * FROM lost)"""


@query("ce3_critical_events", f"{_EVENTS} SELECT conv_id, turn, pos, reference_term, hypothesis_term, count(*) AS n FROM ev JOIN pairs USING (audio) GROUP BY ALL")
def ce3(spark, sf):
    return _events(spark, sf).groupBy(*KEY, "reference_term", "hypothesis_term").agg(F.count(F.lit(1)).alias("n"))


@query("ag9_confusions", f"{_EVENTS} SELECT reference_term, CASE WHEN hypothesis_term = '' THEN '<deleted>' ELSE hypothesis_term END AS hypothesis_term, count(*) AS n FROM ev GROUP BY ALL")
def ag9(spark, sf):
    return summary.confusion_counts(_events(spark, sf))


# ---------------------------------------------------------------- aggregates

_R9 = lambda c: f"round({c}, 9)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(_round(F.col(c), 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query("ag1_headline", f"""WITH {RECORDS} SELECT count(*) AS utterances, round(avg(wer), 9) AS wer_macro, round(avg(cer), 9) AS cer_macro, round(avg(exact_match::INT), 9) AS phrase_accuracy_global, round(avg(latency_ms), 9) AS latency_mean,
round(quantile_cont(latency_ms, 0.5), 9) AS latency_p50, round(quantile_cont(latency_ms, 0.95), 9) AS latency_p95, round(avg(real_time_factor), 9) AS real_time_factor_mean, 0::BIGINT AS skipped FROM records""")
def ag1(spark, sf):
    return _rounded(summary.headline(views.records(spark, sf)))


@query("ag4_term_accuracy", f"WITH {COUNTS} SELECT category, sum(expected)::BIGINT AS expected, sum(least(expected, predicted))::BIGINT AS correct, round(sum(least(expected, predicted))::DOUBLE / sum(expected)::DOUBLE, 9) AS accuracy FROM counts GROUP BY category")
def ag4(spark, sf):
    return _rounded(summary.term_accuracy(tm2(spark, sf)))


@query("ag5_latency", "SELECT event_type, round(avg(value), 9) AS mean, round(quantile_cont(value, 0.5), 9) AS p50, round(quantile_cont(value, 0.95), 9) AS p95 FROM events GROUP BY event_type")
def ag5(spark, sf):
    e = table(spark, sf, "events").groupBy("event_type")
    return _rounded(e.agg(F.avg("value").alias("mean"), F.percentile("value", F.lit(0.5)).alias("p50"), F.percentile("value", F.lit(0.95)).alias("p95")))


@query("ag7_per_domain", f"WITH {RECORDS} SELECT domain, count(*) AS utterances, round(avg(wer), 9) AS mean_wer, round(avg(exact_match::INT), 9) AS phrase_accuracy FROM records GROUP BY domain")
def ag7(spark, sf):
    return _rounded(summary.per_domain(views.records(spark, sf)))


@query("ag8_per_speaker", f"WITH {RECORDS} SELECT speaker_id, count(*) AS utterances, round(avg(wer), 9) AS mean_wer FROM records GROUP BY speaker_id")
def ag8(spark, sf):
    return _rounded(summary.per_speaker(views.records(spark, sf)))


@query("ag_by_group", f"""WITH {RECORDS} SELECT CASE WHEN grouping(domain) = 1 AND grouping(speaker_id) = 1 THEN 'all' WHEN grouping(speaker_id) = 1 THEN 'domain' ELSE 'speaker' END AS level, domain, speaker_id, count(*) AS utterances,
round(avg(wer), 9) AS mean_wer, round(avg(exact_match::INT), 9) AS phrase_accuracy FROM records GROUP BY GROUPING SETS ((), (domain), (speaker_id))""")
def ag_groups(spark, sf):
    return _rounded(summary.by_group(views.records(spark, sf)))


_DEAL = f"""deal AS (SELECT *, CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM utt)"""


def _dealt(spark, sf):
    k = F.col("conv_id") % 10
    return views.utterances(spark, sf).withColumn("split", F.when(k < 8, "train").when(k == 8, "validation").otherwise("test"))


@query("ag10_split_stats", f"WITH {UTT}, {_DEAL} SELECT split, count(*) AS utterances, count(DISTINCT speaker_id) AS speakers, round(sum(duration_sec) / 3600.0, 9) AS hours, count(*) FILTER (source = 'synthetic') AS synthetic FROM deal GROUP BY split")
def ag10(spark, sf):
    return _rounded(summary.split_stats(_dealt(spark, sf)))


@query("ag11_domain_histogram", f"WITH {UTT}, {_DEAL} SELECT split, domain, count(*) AS n FROM deal GROUP BY ALL")
def ag11(spark, sf):
    return summary.domain_histogram(_dealt(spark, sf))


@query("ag12_status_totals", f"SELECT code AS status, count(*) AS n FROM ({_STATUS}) GROUP BY code")
def ag12(spark, sf):
    return summary.status_totals(dq17(spark, sf).withColumnRenamed("status", "http").withColumnRenamed("code", "status"))


@query("ag13_real_time_factor", "SELECT event_id, CASE WHEN value > 50 THEN round((value / 1000.0::DOUBLE) / (event_id % 3), 9) ELSE 0.0 END AS rtf FROM events WHERE event_id % 3 > 0 AND value > 50 UNION ALL SELECT event_id, 0.0 FROM events WHERE NOT (event_id % 3 > 0 AND value > 50)")
def ag13(spark, sf):
    e = table(spark, sf, "events")
    seconds = summary.spoken_seconds(F.lit(0), F.when(F.col("value") > 50, (F.col("event_id") % 3).cast("double")).otherwise(0.0))
    return e.select("event_id", _round(summary.real_time_factor(F.col("value"), seconds), 9).alias("rtf"))


# ---------------------------------------------------------------- splits

_SPLIT_SQL = f"""WITH RECURSIVE {UTT}, spk AS (SELECT speaker_id, count(*)::BIGINT AS n FROM utt GROUP BY 1), ord AS (SELECT speaker_id, n, row_number() OVER (ORDER BY md5('42:' || speaker_id)) AS r FROM spk), tot AS (SELECT sum(n)::DOUBLE AS t FROM spk),
f(r, speaker_id, split, a, b, c) AS (
  SELECT 0::BIGINT, ''::VARCHAR, ''::VARCHAR, 0::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT x.r, x.speaker_id, x.best, x.a + CASE WHEN x.best = 'train' THEN x.n ELSE 0 END, x.b + CASE WHEN x.best = 'validation' THEN x.n ELSE 0 END, x.c + CASE WHEN x.best = 'test' THEN x.n ELSE 0 END
  FROM (SELECT ord.r, ord.speaker_id, ord.n, f.a, f.b, f.c, CASE WHEN 0.8::DOUBLE * t - f.a >= 0.1::DOUBLE * t - f.b AND 0.8::DOUBLE * t - f.a >= 0.1::DOUBLE * t - f.c THEN 'train' WHEN 0.1::DOUBLE * t - f.b >= 0.1::DOUBLE * t - f.c THEN 'validation' ELSE 'test' END AS best
        FROM f JOIN ord ON ord.r = f.r + 1, tot) x
)"""


@query("sp1_split_by_speaker", f"{_SPLIT_SQL} SELECT utt.conv_id, utt.turn, utt.pos, utt.speaker_id, f.split FROM utt JOIN f USING (speaker_id)")
def sp1(spark, sf):
    return split.split_by_speaker(views.utterances(spark, sf)).select(*KEY, "speaker_id", "split")


@query("sp4_no_leakage", f"{_SPLIT_SQL} SELECT split, count(DISTINCT speaker_id) AS speakers, (SELECT count(*) FROM (SELECT speaker_id FROM f WHERE r > 0 GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS leaking FROM f WHERE r > 0 GROUP BY split")
def sp4(spark, sf):
    dealt = sp1(spark, sf)
    split.assert_no_leakage(dealt)
    return dealt.groupBy("split").agg(F.countDistinct("speaker_id").alias("speakers")).crossJoin(F.broadcast(split.leaks(dealt).agg(F.count(F.lit(1)).alias("leaking"))))  # one row


# ---------------------------------------------------------------- audio and inference


@query("au1_to_mono", "SELECT vec_id, list_transform(range(1, len(embedding) // 2 + 1), lambda i: round((embedding[2 * i - 1]::DOUBLE + embedding[2 * i]::DOUBLE) / 2, 12)) AS mono FROM embeddings")
def au1(spark, sf):
    e = table(spark, sf, "embeddings")
    n = F.floor(F.size("embedding") / 2).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    frames = F.when(F.col("embedding").isNotNull(), F.transform(places, lambda i: F.array(F.get("embedding", i * 2).cast("double"), F.get("embedding", i * 2 + 1).cast("double"))))
    return e.select("vec_id", F.transform(audio.to_mono(frames), lambda x: _round(x, 12)).alias("mono"))


@query("au3_peak_guard", """WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (vec_id % 4)) AS w FROM embeddings), p AS (SELECT *, list_max(list_transform(w, lambda x: abs(x))) AS top FROM w)
SELECT vec_id, list_transform(w, lambda x: round(CASE WHEN top > 0.95 THEN x * (0.95::DOUBLE / top) ELSE x END, 9) + 0.0) AS wave FROM p""")
def au3(spark, sf):
    return views.waves(spark, sf).select("vec_id", F.transform(audio.guard_peak(F.col("wave")), lambda x: _round(x, 9) + 0.0).alias("wave"))


_PCM = """w AS (SELECT vec_id, list_transform(embedding, lambda x: least(greatest(round_even(x::DOUBLE * (vec_id % 4) * 32768, 0), -32768), 32767)) AS w FROM embeddings),
mono AS (SELECT vec_id, list_transform(range(1, len(w) // 2 + 1), lambda i: (w[2 * i - 1] + w[2 * i]) / 65536) AS x FROM w),
sized AS (SELECT *, round_even(len(x) * 16000 / 44100::DOUBLE, 0)::BIGINT AS n FROM mono)"""
_RESAMPLED = _PCM + """, part AS (SELECT vec_id, n, x, i, floor(i * 44100 / 16000::DOUBLE)::BIGINT AS base, i * 44100 / 16000::DOUBLE - floor(i * 44100 / 16000::DOUBLE) AS rest FROM (SELECT vec_id, n, x, unnest(range(n)) AS i FROM sized)),
sample AS (SELECT vec_id, n, i, list_sum(list_transform(range(-88, 90), lambda o: CASE WHEN base + o < 0 OR base + o >= len(x) OR abs(o - rest) >= 89 THEN 0 ELSE
  x[base + o + 1] * (16000 / 44100::DOUBLE) * (0.5::DOUBLE + 0.5::DOUBLE * cos(pi() * (o - rest) / 89)) * CASE WHEN o - rest = 0 THEN 1 ELSE sin(pi() * (16000 / 44100::DOUBLE) * (o - rest)) / (pi() * (16000 / 44100::DOUBLE) * (o - rest)) END END)) AS y FROM part),
whole AS (SELECT vec_id, n, list(y ORDER BY i) AS y, max(abs(y)) AS top FROM sample GROUP BY ALL)"""


@query("au4_canonical_audio", f"WITH {_PCM} SELECT vec_id, 16000 AS sample_rate, 1 AS channels, n AS frames, 'PCM_16' AS subtype, NULL::VARCHAR AS error FROM sized")
def au4(spark, sf):
    """Embeddings as short WAV files, canonicalised and inspected again."""
    files = _clips(spark, sf)
    info = readers.audio_info(sinks.canonical_wav("content"))
    return files.select("vec_id", info.alias("i")).select("vec_id", "i.sample_rate", "i.channels", "i.frames", "i.subtype", "i.error")


@query("src9_smoke_clips", "SELECT 'smoke_' || i || '.wav' AS audio, 'placeholder' AS text, 'id' AS language, 'spk_smoke_' || i AS speaker_id, ['general', 'cash_flow', 'reporting'][i % 3 + 1] AS domain, 'synthetic' AS source, true AS audible FROM range(5) t(i)")
def src9(spark, sf):
    clips = readers.smoke_entries(spark, 5)
    return clips.withColumn("audible", (F.col("duration_sec") >= 1) & (F.col("duration_sec") <= 3) & (F.octet_length("content") > 32_000)).drop("content", "duration_sec")


@query("ud6_runner", """SELECT vec_id, vec_id % 5 > 1 AS ok, CASE vec_id % 5 WHEN 0 THEN 'file not found' WHEN 1 THEN 'transcription failed' END AS reason, CASE WHEN vec_id % 5 > 1 THEN 'placeholder' END AS hypothesis,
CASE WHEN vec_id % 5 > 1 THEN 'deterministic-stub' END AS model_id, vec_id % 5 > 1 AS timed FROM embeddings""")
def ud6(spark, sf):
    """All embeddings as clips through the stand-in model; some files are missing and some are no audio."""
    k = F.col("vec_id") % 5
    clips = _clips(spark, sf).withColumn("content", F.when(k == 1, F.lit(b"no audio")).when(k > 1, F.col("content"))).withColumn("language", F.lit("id"))
    done = inference.transcribe(clips, {"adapter": "deterministic", "text": "placeholder"}, warmup=1)
    return done.select("vec_id", "ok", F.substring_index("reason", ":", 1).alias("reason"), "hypothesis", "model_id", (F.coalesce("latency_ms", F.lit(-1.0)) >= 0).alias("timed"))


@query("sv4_transcription_batch", """WITH c AS (SELECT vec_id, CASE vec_id % 7 WHEN 0 THEN 415 WHEN 1 THEN 415 WHEN 2 THEN 400 WHEN 3 THEN 400 WHEN 4 THEN 413 ELSE 200 END AS status,
CASE vec_id % 7 WHEN 0 THEN 'unsupported_format' WHEN 1 THEN 'unsupported_media_type' WHEN 2 THEN 'empty_upload' WHEN 3 THEN 'invalid_audio' WHEN 4 THEN 'payload_too_large' ELSE 'ok' END AS code, len(embedding) // 2 AS n FROM embeddings)
SELECT vec_id, status, code, CASE WHEN status = 200 THEN 'placeholder' END AS text, CASE WHEN status = 200 THEN CASE WHEN vec_id % 2 = 0 THEN 'en' ELSE 'id' END END AS language, CASE WHEN status = 200 THEN floor(n / 44100::DOUBLE * 1000)::BIGINT END AS duration_ms,
CASE WHEN status = 200 THEN 'deterministic-stub' END AS model, CASE WHEN status = 200 THEN NULL ELSE code END AS error FROM c""")
def sv4(spark, sf):
    """Every embedding as a request: by its number of the wrong format, of another type, empty, broken, too large or good."""
    k = F.col("vec_id") % 7
    content = F.when(k == 2, F.lit(b"")).when(k == 3, F.lit(b"no audio")).when(k == 4, F.lit(bytes(2000))).otherwise(F.col("content"))
    asked = _clips(spark, sf).select(
        F.concat(F.col("vec_id").cast("string"), F.when(k == 0, ".txt").otherwise(".WAV")).alias("filename"), F.when(k == 1, "text/html").otherwise("audio/wav").alias("content_type"),
        F.when(F.col("vec_id") % 2 == 0, "en").otherwise("").alias("language"), content.alias("content"),
    )
    done = requests.answer(asked, {"adapter": "deterministic", "text": "placeholder"}, {"max_upload_mb": 1000 / 1024 / 1024})
    return done.select(F.substring_index("filename", ".", 1).cast("long").alias("vec_id"), "status", "code", "text", "language", "duration_ms", "model", F.get_json_object("body", "$.error.code").alias("error"))


@query("snk3_report", f"WITH {RECORDS} SELECT domain, count(*) AS utterances, round(avg(wer), 4) AS mean_wer, round(avg(exact_match::INT), 4) AS phrase_accuracy, (SELECT count(*) FROM records) AS whole FROM records GROUP BY domain")
def snk3(spark, sf):
    """The written report, read back: its table of domains and its number of utterances."""
    records = staged(views.records(spark, sf), "records")
    found = summary.summary(records, tm2(spark, sf), _events(spark, sf), model_id="disturbed")
    lines = spark.createDataFrame([(x,) for x in sinks.markdown(found).split("\n")], "line string")
    whole = lines.select(F.regexp_extract("line", r"^- Utterances: (\d+)", 1).alias("n")).where("n <> ''").select(F.col("n").cast("long").alias("whole"))
    cell = lambda i: F.trim(F.get(F.split("line", r"\|"), F.lit(i)))
    rows = lines.where(r"line RLIKE '^\\| [a-z_]+ \\| [0-9]'").select(cell(1).alias("domain"), cell(2).cast("long").alias("utterances"), _round(cell(3).cast("double"), 4).alias("mean_wer"), _round(cell(4).cast("double"), 4).alias("phrase_accuracy"))
    return rows.crossJoin(F.broadcast(whole))  # one row


# ---------------------------------------------------------------- the rest of the inventory, operator by operator


@F.pandas_udf(_types.of("binary"))
def _stereo_wav(wave: pd.Series) -> pd.Series:
    return wave.map(lambda w: audio.encode_wav(np.asarray(w, float).reshape(-1, 2), 44_100))


def _name(path: str):
    return F.regexp_extract(path, r"[^/]+/[^/]+$", 0)


def _written(spark, sf) -> tuple[DataFrame, str]:
    """Clips written as canonical files below a fresh folder, three folders of them, and that folder."""
    root = staging_path(spark, "audio")
    clips = _clips(spark, sf).withColumn("name", F.concat(F.lit("sub"), F.col("vec_id") % 3, F.lit("/clip_"), F.col("vec_id"), F.lit(".wav")))
    return sinks.write_canonical(clips.select(F.concat(F.lit("in/"), "name").alias("path"), F.concat(F.lit(root + "/"), "name").alias("target"), "content")), root


def _clips(spark, sf):
    return views.waves(spark, sf).select("vec_id", _stereo_wav("wave").alias("content"))


@query("src3_probed_duration", f"WITH {UTT} SELECT audio, CASE WHEN pos % 3 = 0 THEN duration_sec + 1 WHEN pos % 3 = 1 THEN duration_sec END AS duration_sec FROM utt")
def src3(spark, sf):
    """Some entries say how long they are, some are looked up, some are unknown."""
    u, k = views.utterances(spark, sf), F.col("pos") % 3
    entries = u.select("audio", F.when(k == 0, F.col("duration_sec") + 1).alias("duration_sec"))
    return readers.with_probed_duration(entries, u.where(k < 2).select("audio", "duration_sec")).select("audio", "duration_sec")


@query("src6_audio_header", "SELECT vec_id, 44100 AS sample_rate, 2 AS channels, (len(embedding) // 2)::BIGINT AS frames, (len(embedding) // 2) / 44100.0::DOUBLE AS duration_sec, 'WAV' AS format, 'PCM_16' AS subtype, NULL::VARCHAR AS error FROM embeddings")
def src6(spark, sf):
    return _clips(spark, sf).select("vec_id", readers.audio_info("content").alias("i")).select("vec_id", "i.*")


@query("src7_decode", f"WITH {_PCM} SELECT vec_id, 44100 AS rate, len(x)::BIGINT AS n, list_transform(x, lambda v: round(v * 65536)::BIGINT) AS samples FROM sized")
def src7(spark, sf):
    """Samples as whole numbers: two channels of sixteen bits, averaged."""
    d = _clips(spark, sf).select("vec_id", readers.decoded("content").alias("d"))
    return d.select("vec_id", "d.rate", F.size("d.samples").cast("long").alias("n"), F.transform("d.samples", lambda x: F.round(x * 65536).cast("long")).alias("samples"))


@query("src10_size_bound", "SELECT page_id, octet_length(encode(coalesce(html, ''))) + 1 AS length FROM pages WHERE octet_length(encode(coalesce(html, ''))) + 1 <= 3000")
def src10(spark, sf):
    """Pages as files, a thousand ids to a folder, of which those within the bound are read; each row is a file of its own."""
    path = staging_path(spark, "files")
    rows = table(spark, sf, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    name = F.concat(F.lit(f"{path}/"), F.coalesce(F.expr("page_id div 1000"), F.lit(0)).cast("string"), F.lit("/page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("."), F.col("row").cast("string"))
    sinks.write_files(rows.select(name.alias("target"), F.concat("html", F.lit("\n")).cast("binary").alias("content")))
    found = readers.read_audio(spark, path, 3000).where(F.col("path").rlike(r"/page_id=-?\d*\.\d+$"))
    return found.select(F.nullif(F.regexp_extract("path", r"/page_id=(-?\d*)\.\d+$", 1), F.lit("")).cast("long").alias("page_id"), F.octet_length("content").cast("long").alias("length"))


@query("src11_environment", "SELECT true AS complete, true AS versioned")
def src11(spark, sf):
    return sinks.environment(spark).select((F.col("system").isNotNull() & (F.col("cpus") > 0) & F.col("device").isin("cpu", "cuda") & F.col("gpus").isNotNull()).alias("complete"), F.col("versions")["pyspark"].isNotNull().alias("versioned"))


@query("snk1_manifest_json", f"WITH {UTT} SELECT audio, 7::BIGINT AS n_keys FROM utt")
def snk1(spark, sf):
    j = sinks.manifest_json(views.utterances(spark, sf).withColumn("noise_profile", F.lit(None).cast("string")))
    return j.select(F.get_json_object("value", "$.audio").alias("audio"), F.size(F.json_object_keys("value")).cast("long").alias("n_keys"))


@query("snk2_report_json", f"WITH {RECORDS} SELECT domain, count(*) AS utterances FROM records GROUP BY domain")
def snk2(spark, sf):
    """Records as the report writes them, read back and counted."""
    path = staging_path(spark, "records")
    views.records(spark, sf).write.json(path)
    return spark.read.schema("domain string").json(path).groupBy("domain").agg(F.count(F.lit(1)).alias("utterances"))


@query("snk4_canonical_wav", f"WITH {_PCM} SELECT 'sub' || (vec_id % 3) || '/clip_' || vec_id || '.wav' AS name, 'ok' AS status, 16000 AS sample_rate, 1 AS channels, n AS frames, 'PCM_16' AS subtype, 44 + 2 * n AS length FROM sized")
def snk4(spark, sf):
    """Clips written as canonical files, and what is then found in the folder."""
    done, root = _written(spark, sf)
    found = readers.list_audio(spark, root).select(_name("path").alias("name"), "length")
    return done.select(_name("target").alias("name"), "status", "info.sample_rate", "info.channels", "info.frames", "info.subtype").join(found, "name")


@query("snk6_log_columns", "SELECT unnest(['conv_id', 'turn', 'role']) AS name")
def snk6(spark, sf):
    c = table(spark, sf, "conversations").withColumnRenamed("text", "content")
    return spark.createDataFrame([(n,) for n in text.drop_private(c.columns)], "name string")


@query("jn3_forbidden_pairs", f"{_EVENTS} SELECT audio, reference_term, hypothesis_term FROM crit")
def jn3(spark, sf):
    p = views.pairs(spark, sf).withColumn("alignment", align.align("ref_tokens", "hyp_tokens"))
    return T.critical_substitutions(p, views.confusions(spark, sf), ["audio"])


@query("jn4_lost_terms", f"{_EVENTS} SELECT audio, reference_term FROM lost")
def jn4(spark, sf):
    critical = views.confusions(spark, sf).select(F.lit("critical").alias("category"), F.col("reference").alias("term"))
    return T.critical_deletions(T.term_counts(views.pairs(spark, sf), critical, ["audio"]), ["audio"]).select("audio", "reference_term")


QUERIES["ce1_critical_substitutions"], SQL["ce1_critical_substitutions"] = jn3, SQL["jn3_forbidden_pairs"]
QUERIES["ce2_critical_deletions"], SQL["ce2_critical_deletions"] = jn4, SQL["jn4_lost_terms"]


@query("jn5_speaker_split", f"{_SPLIT_SQL} SELECT split, count(*) AS n FROM utt JOIN f USING (speaker_id) GROUP BY split")
def jn5(spark, sf):
    return sp1(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("tm3_category_totals", f"WITH {COUNTS} SELECT category, sum(expected)::BIGINT AS expected, sum(predicted)::BIGINT AS predicted FROM counts GROUP BY category")
def tm3(spark, sf):
    return tm2(spark, sf).groupBy("category").agg(F.sum("expected").alias("expected"), F.sum("predicted").alias("predicted"))


@query("tm4_accuracy", f"WITH {COUNTS} SELECT audio, count(*) AS n_null FROM (SELECT conv_id, turn, pos, category FROM counts GROUP BY ALL HAVING sum(expected) = 0) JOIN pairs USING (conv_id, turn, pos) GROUP BY audio")
def tm4(spark, sf):
    """Categories of an utterance that only the hypothesis holds have no accuracy."""
    return tm2(spark, sf).where("accuracy IS NULL").join(views.utterances(spark, sf).select(*KEY, "audio"), KEY).groupBy("audio").agg(F.count(F.lit(1)).alias("n_null"))


@query("ag2_macro_rates", f"WITH {RECORDS} SELECT round(avg(wer), 9) AS wer_macro, round(avg(cer), 9) AS cer_macro FROM records")
def ag2(spark, sf):
    return ag1(spark, sf).select("wer_macro", "cer_macro")


@query("ag3_phrase_accuracy", f"WITH {RECORDS} SELECT round(avg(exact_match::INT), 9) AS phrase_accuracy_global FROM records")
def ag3(spark, sf):
    return ag1(spark, sf).select("phrase_accuracy_global")


@query("ag6_real_time_mean", f"WITH {RECORDS} SELECT round(avg(real_time_factor), 9) AS real_time_factor_mean FROM records")
def ag6(spark, sf):
    return ag1(spark, sf).select("real_time_factor_mean")


@query("sp2_speaker_order", f"WITH {UTT} SELECT speaker_id, row_number() OVER (ORDER BY md5('42:' || speaker_id)) AS place FROM (SELECT DISTINCT speaker_id FROM utt)")
def sp2(spark, sf):
    """The order in which speakers are dealt."""
    s = split.speaker_counts(views.utterances(spark, sf)).select("speaker_id", split.hashed_order(F.col("speaker_id"), 42).alias("key"))
    return split.placed(s, "key").select("speaker_id", "place")


@query("sp3_repair", """WITH s AS (SELECT 'spk_' || (user_id % 3) AS speaker_id, count(*) AS n FROM events GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || speaker_id)) AS r FROM s)
SELECT CASE r WHEN 1 THEN 'validation' WHEN 2 THEN 'test' ELSE 'train' END AS split, speaker_id, n FROM o""")
def sp3(spark, sf):
    """Three speakers whose shares leave two splits empty: each gets the first speaker of the fullest."""
    e = table(spark, sf, "events").select(F.concat(F.lit("spk_"), F.col("user_id") % 3).alias("speaker_id"))
    return split.split_by_speaker(e, (1.0, 0.0, 0.0)).groupBy("split", "speaker_id").agg(F.count(F.lit(1)).alias("n"))


@query("au2_resample", f"WITH {_RESAMPLED} SELECT vec_id, n, list_transform(y, lambda v: round(CASE WHEN top > 0.95 THEN v * 0.95::DOUBLE / top ELSE v END, 2) + 0.0) AS samples FROM whole")
def au2(spark, sf):
    w = _clips(spark, sf).select("vec_id", readers.canonical_samples("content").alias("w"))
    return w.select("vec_id", F.size("w").cast("long").alias("n"), F.transform("w", lambda x: _round(x.cast("double"), 2) + 0.0).alias("samples"))


@query("au5_model_waveform", f"WITH {_RESAMPLED} SELECT vec_id, round(least(top, 0.95::DOUBLE), 3) AS peak FROM whole")
def au5(spark, sf):
    w = _clips(spark, sf).select("vec_id", readers.canonical_samples("content").alias("w"))
    return w.select("vec_id", _round(F.array_max(F.transform("w", lambda x: F.abs(x.cast("double")))), 3).alias("peak"))


@query("ud2_stand_in", "SELECT vec_id, true AS ok, 'x' AS hypothesis, floor(len(embedding) // 2 / 44100::DOUBLE * 1000)::BIGINT AS model_ms, 'deterministic-stub' AS model_id FROM embeddings")
def ud2(spark, sf):
    done = inference.transcribe(_clips(spark, sf).withColumn("language", F.lit("id")), {"adapter": "deterministic", "text": "x"})
    return done.select("vec_id", "ok", "hypothesis", "model_ms", "model_id")


@query("ud7_segments", r"SELECT conv_id, turn, count(*) AS n FROM (SELECT conv_id, turn, unnest(string_split_regex(text, '[.\n]+')) AS s FROM conversations) GROUP BY ALL")
def ud7(spark, sf):
    part = lambda x: F.struct(F.lit(0.0).alias("start_sec"), F.lit(1.0).alias("end_sec"), x.alias("text"))
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.transform(F.split("text", r"[.\n]+"), part).alias("segments"))
    return inference.segments(c, ["conv_id", "turn"]).groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))


@query("sv1_health", "SELECT 'ok' AS status")
def sv1(spark, sf):
    return requests.health(spark)


@query("sv2_ready", "SELECT true AS ready, 'deterministic-stub' AS model, NULL::VARCHAR AS reason")
def sv2(spark, sf):
    return requests.ready(spark, {"adapter": "deterministic"})


@query("sv3_model_info", "SELECT 'base' AS model_id, 'deterministic' AS adapter, 'cpu' AS device, 'auto' AS compute_type, 'id' AS default_language")
def sv3(spark, sf):
    return requests.model_info(spark, {"model_id": "base", "adapter": "deterministic", "device": "cpu"})


@query("src5_settings", "SELECT n_name AS name, n_regionkey AS port, n_nationkey % 2 = 0 AS vad, 'base' AS model_id FROM nation")
def src5(spark, sf):
    """Settings files of all nations, each laid over a common one."""
    out = []
    with tempfile.TemporaryDirectory() as folder:  # the driver's own files, read by the driver
        common = Path(folder, "common.yaml")
        common.write_text(json.dumps({"model": {"model_id": "base", "vad": True}, "service": {"port": -1}}))
        for n in table(spark, sf, "nation").collect():  # a dimension of 25 rows
            own = Path(folder, f"{n['n_nationkey']}.yaml")
            own.write_text(json.dumps({"model": {"vad": n["n_nationkey"] % 2 == 0}, "service": {"port": n["n_regionkey"], "name": n["n_name"]}}))
            merged = readers.deep_merge(readers.load_yaml(str(common)), readers.load_yaml(str(own)))
            out.append((merged["service"]["name"], merged["service"]["port"], merged["model"]["vad"], merged["model"]["model_id"]))
        if readers.load_yaml(str(Path(folder, "none.yaml")), required=False):
            raise AssertionError("a missing file holds settings")
    return spark.createDataFrame(out, "name string, port long, vad boolean, model_id string")


@query("src8_recursive_listing", "SELECT 'sub' || (vec_id % 3) || '/clip_' || vec_id || '.wav' AS name, row_number() OVER (ORDER BY 'sub' || (vec_id % 3) || '/clip_' || vec_id || '.wav') AS place FROM embeddings")
def src8(spark, sf):
    """All audio files below a folder, in order; a file of another kind is not listed."""
    _, root = _written(spark, sf)
    spark.range(1).select(F.lit("x").alias("value")).write.text(f"{root}/other")
    return split.placed(readers.list_audio(spark, root).select(_name("path").alias("name")), "name")


@query("snk5_environment_file", "SELECT unnest(['system', 'machine', 'python', 'spark', 'cpus', 'memory_bytes', 'device', 'compute_type', 'cuda_devices', 'gpus', 'versions']) AS field")
def snk5(spark, sf):
    with tempfile.TemporaryDirectory() as folder:  # the driver's own file
        path = Path(folder, "sub", "environment.json")
        sinks.write_environment(spark, str(path))
        return spark.createDataFrame([(k,) for k in json.loads(path.read_text())], "field string")


@query("ud1_engines", "SELECT vec_id, text, text = 'a' AS known FROM embeddings CROSS JOIN (SELECT unnest(['a', 'b']) AS text)")
def ud1(spark, sf):
    """The protocol: whatever opens to two functions can hear; two plans of one engine over all clips."""
    clips, out = _clips(spark, sf).withColumn("language", F.lit("id")), None
    for heard in ("a", "b"):
        done = inference.transcribe(clips, {"adapter": "deterministic", "text": heard}).select("vec_id", F.col("hypothesis").alias("text"))
        out = done if out is None else out.unionByName(done)
    return out.withColumn("known", F.col("text") == "a")


@query("ud3_missing_runtime", "SELECT vec_id, false AS ok, 'transcription failed: model tiny cannot be loaded' AS reason FROM embeddings")
def ud3(spark, sf):
    """The adapter of a package that is not there: each row says why, and none is lost."""
    done = inference.transcribe(_clips(spark, sf).withColumn("language", F.lit("id")), {"adapter": "faster_whisper", "model_id": "tiny"})
    return done.select("vec_id", "ok", F.regexp_extract("reason", "^(transcription failed: model tiny cannot be loaded):", 1).alias("reason"))


@query("ud4_device_rules", """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN 'cuda' ELSE 'cpu' END WHEN 1 THEN 'cpu' ELSE 'cuda' END AS device,
CASE WHEN p_size % 5 = 0 THEN 'float32' WHEN p_size % 3 = 2 OR (p_size % 3 = 0 AND p_size % 2 = 0) THEN 'float16' ELSE 'int8' END AS compute_type FROM part""")
def ud4(spark, sf):
    """Device and precision of all combinations of what is asked for and what there is, dealt to parts by their size."""
    cases = [(size, *inference.placement({"device": ("auto", "cpu", "cuda")[size % 3], "compute_type": "auto" if size % 5 else "float32"}, lambda size=size: 1 - size % 2)) for size in range(30)]
    rules_ = spark.createDataFrame(cases, "size int, device string, compute_type string")
    return table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 30).alias("size")).join(F.broadcast(rules_), "size").drop("size")


@query("ud5_factory", "SELECT * FROM (VALUES ('deterministic', 'deterministic-stub', false), ('faster_whisper', 'small', false), ('other', NULL, true)) v(adapter, model_id, refused)")
def ud5(spark, sf):
    """What settings name is opened; a name that is not known is refused."""
    out = []
    for name in ("deterministic", "faster_whisper", "other"):
        try:
            out.append((name, inference.plan({"adapter": name})["model_id"], False))
        except ValueError:
            out.append((name, None, True))
    return spark.createDataFrame(out, "adapter string, model_id string, refused boolean")


@query("sv5_nothing_left", "SELECT status, n, 0::BIGINT AS files_left FROM (SELECT CASE vec_id % 7 WHEN 0 THEN 415 WHEN 1 THEN 415 WHEN 2 THEN 400 WHEN 3 THEN 400 WHEN 4 THEN 413 ELSE 200 END AS status, count(*) AS n FROM embeddings GROUP BY 1)")
def sv5(spark, sf):
    """Requests of every outcome leave no audio file behind in the folder for temporary files."""
    of = lambda: {p for p in Path(tempfile.gettempdir()).iterdir() if p.suffix in (".wav", ".bin", ".txt")}
    before = of()
    found = staged(sv4(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n")), "outcomes")
    return found.withColumn("files_left", F.lit(len(of() - before)).cast("long"))

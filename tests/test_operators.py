import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talewright import inference
from talewright.functions import align, audio
from talewright.operators import requests, rules, split, summary
from talewright.operators import terms as T
from talewright.plans import queries
from talewright.sources import readers, sinks

GOOD = {"audio": "a.wav", "text": "halo", "language": "id", "speaker_id": "spk_1", "duration_sec": 2, "domain": "general", "source": "recorded"}


def error(spark, **change):
    entry = {k: v for k, v in (GOOD | change).items() if v != "DROP"}
    return rules.validate(spark.createDataFrame([(json.dumps(entry),)], "line string")).first()["error"]


@pytest.mark.parametrize("change, code", [
    ({}, None), ({"text": "DROP"}, "missing_text"), ({"text": " "}, "blank_text"), ({"text": None}, "blank_text"), ({"speaker_id": "Ann"}, "speaker_id"), ({"duration_sec": 0}, "duration_range"),
    ({"duration_sec": -1}, "duration_range"), ({"duration_sec": 600.0}, None), ({"duration_sec": 600.1}, "duration_range"), ({"duration_sec": "3"}, "duration_type"), ({"duration_sec": True}, "duration_type"),
    ({"domain": "x"}, "domain"), ({"source": "x"}, "source"), ({"language": "xx"}, "language"), ({"audio": ""}, "blank_audio"), ({"audio": "a.txt"}, "audio_extension"), ({"audio": "a"}, None), ({"notes": "n"}, None),
])
def test_rules(spark, change, code):
    assert error(spark, **change) == code


@pytest.mark.parametrize("line, code", [("[1]", "not_an_object"), ("{", "bad_json"), ("null", "not_an_object"), ('"x"', "not_an_object")])
def test_rules_on_other_json(spark, line, code):
    assert rules.validate(spark.createDataFrame([(line,)], "line string")).first()["error"] == code


def test_manifest_files(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text("# head\n\n" + json.dumps(GOOD) + "\n  " + json.dumps(GOOD | {"audio": "b.wav", "noise_profile": "é"}) + "\n{bad\n", encoding="utf-8")
    rows = readers.read_manifest(spark, str(path)).orderBy("line_no").collect()
    assert [r["line_no"] for r in rows] == [2, 3, 4] and [r["error"] for r in rows] == [None, None, "bad_json"]
    with pytest.raises(readers.ManifestError, match="line 5"):
        readers.read_manifest(spark, str(path), strict=True)
    out = str(tmp_path / "out")
    sinks.write_manifest(rules.valid_entries(readers.read_manifest(spark, str(path))), out, "x")
    back = rules.valid_entries(readers.read_manifest(spark, out)).orderBy("audio").collect()
    assert [(r["audio"], r["noise_profile"]) for r in back] == [("a.wav", None), ("b.wav", "é")]


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿audio,text,speaker_id,language,duration_sec\na.wav, halo ,spk_1,,1.5\nb.wav,x,spk_2,  ,\n", encoding="utf-8")
    info = spark.createDataFrame([("b.wav", 9.0)], "audio string, duration_sec double")
    rows = {r["audio"]: r for r in readers.read_transcripts(spark, str(path), info).collect()}
    assert rows["a.wav"]["text"] == "halo" and rows["a.wav"]["language"] == "id" and rows["a.wav"]["duration_sec"] == 1.5
    assert rows["b.wav"]["language"] == "" and rows["b.wav"]["duration_sec"] == 9.0
    path.write_text("audio,text\na,b\n")
    with pytest.raises(readers.ManifestError):
        readers.read_transcripts(spark, str(path))


def pair_frame(spark, *pairs):
    df = spark.createDataFrame([(i, r.split(), h.split()) for i, (r, h) in enumerate(pairs)], "id int, ref_tokens array<string>, hyp_tokens array<string>")
    return df.withColumn("alignment", align.align("ref_tokens", "hyp_tokens"))


def test_terms(spark):
    df = pair_frame(spark, ("neraca saldo dan neraca saldo lama x", "neraca saldo"), ("a", "b"))
    terms = spark.createDataFrame([("financial", "Neraca  saldo"), ("financial", "neraca"), ("financial", "neraca"), ("date", "zz")], "category string, term string")
    got = {(r["id"], r["category"]): tuple(r)[2:5] for r in T.score_terms(T.term_counts(df, terms, ["id"]), ["id"]).collect()}
    assert got == {(0, "financial"): (6, 3, 3)}
    occ = df.select(T.occurrences(F.col("ref_tokens"), F.array(F.lit("neraca"), F.lit("saldo")))).collect()
    assert [r[0] for r in occ] == [2, 0]


def test_critical_events(spark):
    df = pair_frame(spark, ("bayar juta rupiah", "bayar miliar rupiah"), ("debit masuk", "masuk"), ("x", "x"))
    bad = spark.createDataFrame([("juta", "miliar"), ("debit", "kredit")], "reference string, forbidden string")
    got = sorted(tuple(r) for r in T.critical_events(df, bad, ["id"]).collect())
    assert got == [(0, "juta", ""), (0, "juta", "miliar"), (1, "debit", "")]
    assert [tuple(r) for r in summary.confusion_counts(T.critical_events(df, bad, ["id"])).collect()] == [("debit", "<deleted>", 1), ("juta", "<deleted>", 1), ("juta", "miliar", 1)]


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "wer double, cer double, exact_match boolean, latency_ms double, real_time_factor double, domain string, speaker_id string")
    row = summary.headline(empty).first()
    assert (row["utterances"], row["wer_macro"], row["latency_mean"], row["latency_p50"], row["latency_p95"]) == (0, None, None, 0.0, 0.0)
    assert summary.by_group(empty).where("level <> 'all'").count() == 0


def entries(spark, speakers, each):
    return spark.createDataFrame([(f"spk_{s}", i) for s in range(speakers) for i in range(each)], "speaker_id string, i int")


@pytest.mark.parametrize("order", ["md5", "shuffle"])
def test_split(spark, order):
    rows = split.split_by_speaker(entries(spark, 30, 4), order=order).collect()
    of = {}
    for r in rows:
        of.setdefault(r["speaker_id"], set()).add(r["split"])
    assert len(rows) == 120 and all(len(s) == 1 for s in of.values()) and {s for x in of.values() for s in x} == set(split.SPLITS)
    assert 0.6 <= sum(r["split"] == "train" for r in rows) / 120 <= 0.95


def test_split_repair_and_errors(spark):
    of = split.assign([("a", 100), ("b", 1), ("c", 1)], (0.8, 0.1, 0.1))
    assert set(of.values()) == set(split.SPLITS)
    assert set(split.assign([("a", 1), ("b", 1), ("c", 1)], (1.0, 0.0, 0.0)).values()) == set(split.SPLITS)
    with pytest.raises(split.SplitError):
        split.split_by_speaker(entries(spark, 2, 5))
    with pytest.raises(split.SplitError):
        split.split_by_speaker(entries(spark, 5, 5), (0.5, 0.1, 0.1))
    with pytest.raises(split.LeakageError):
        split.assert_no_leakage(spark.createDataFrame([("s", "train"), ("s", "test")], "speaker_id string, split string"))


def test_runner_and_requests(spark):
    clips = readers.smoke_entries(spark, 2)
    rows = clips.unionByName(clips.limit(1).withColumn("content", F.lit(None).cast("binary"))).unionByName(clips.limit(1).withColumn("content", F.lit(b"junk")))
    done = inference.transcribe(rows.select("audio", "language", "content"), {"adapter": "deterministic", "text": "t"}, warmup=2).collect()
    assert sorted(str(r["reason"])[:14] for r in done) == ["None", "None", "file not found", "transcription "]
    wav = audio.encode_wav(audio.tone(1))
    asked = spark.createDataFrame([("a.wav", "audio/wav", None, wav), ("a.txt", "audio/wav", "id", wav), ("a.wav", "text/x", "id", wav), ("a.wav", "audio/x", "id", b""), ("a.wav", "audio/x", "id", b"x" * 99)], "filename string, content_type string, language string, content binary")
    got = sorted((r["status"], r["code"]) for r in requests.answer(asked, {"adapter": "deterministic", "text": "t"}, {}).collect())
    assert got == [(200, "ok"), (400, "empty_upload"), (400, "invalid_audio"), (415, "unsupported_format"), (415, "unsupported_media_type")]
    assert {r["code"] for r in requests.answer(asked.limit(1), {"adapter": "deterministic", "text": "t"}, {"max_upload_mb": 0.001}).collect()} == {"payload_too_large"}
    assert {r["code"] for r in requests.answer(asked.limit(1), {"adapter": "deterministic", "text": "t"}, {"max_audio_duration_sec": 0.5}).collect()} == {"audio_too_long"}
    assert "content" not in requests.log_rows(asked).columns
    assert requests.ready(spark, {"adapter": "deterministic"}).first()["ready"] and not requests.ready(spark, {"adapter": "faster_whisper"}).first()["ready"]


def test_audio_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.wav").write_bytes(audio.encode_wav(audio.tone(1, 8000), 8000))
    (tmp_path / "in" / "sub" / "b.wav").write_bytes(b"junk")
    (tmp_path / "in" / "c.txt").write_text("x")
    from talewright import cli

    assert readers.list_audio(spark, str(tmp_path / "in")).count() == 2
    assert cli.main(["normalize", str(tmp_path / "in"), "--out-dir", str(tmp_path / "out")]) == 1
    assert audio.inspect((tmp_path / "out" / "a.wav").read_bytes()).is_canonical


def test_commands(spark, tmp_path):
    from talewright import cli

    assert cli.main(["benchmark"]) == 2
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"model": {"adapter": "deterministic", "text": "placeholder"}, "benchmark": {"output_dir": str(tmp_path / "r"), "warmup": 1}}))
    assert cli.main(["benchmark", "--smoke", "--config", str(config)]) == 0
    report = json.loads(next((tmp_path / "r").glob("*.json")).read_text())
    assert report["summary"]["utterances"] == 3 and report["summary"]["wer_macro"] == 0.0
    assert cli.main(["validate", "--datasets-dir", str(tmp_path)]) == 0
    csv = tmp_path / "t.csv"
    csv.write_text("audio,text,speaker_id,duration_sec\n" + "".join(f"a{i}.wav,halo,spk_{i % 5},1.5\n" for i in range(20)))
    (tmp_path / "d").mkdir()
    assert cli.main(["prepare", "--csv", str(csv), "--datasets-dir", str(tmp_path / "d")]) == 0
    assert cli.main(["validate", "--datasets-dir", str(tmp_path / "d")]) == 0
    assert cli.main(["hardware", "--out", str(tmp_path / "h.json")]) == 0


def test_stream(spark, tmp_path):
    from talewright.streaming.requests import request_stream, start

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.wav").write_bytes(audio.encode_wav(audio.tone(1)))
    q = start(request_stream(spark, str(tmp_path / "in")), {"adapter": "deterministic", "text": "t"}, {}, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).first()["code"] == "ok"


def test_term_totals(spark):
    """Overlaps, nulls, terms that are nowhere, listed twice or without words; each pair is not set against each term."""
    words = ["a a a b", "", None, "b a", "c"]
    pairs = spark.createDataFrame([(None if w is None else w.split(),) for w in words], "ref_tokens array<string>")
    listed = spark.createDataFrame([("x", t) for t in ("a", "A a", "a a a", "z", "b  a", "c", "c", " ")], "category string, term string")
    found = T.term_totals(pairs, listed)
    assert dict(map(tuple, found.collect())) == {"a": 4, "A a": 2, "a a a": 1, "z": 0, "b  a": 1, "c": 2, " ": 0}
    tm1 = queries.QUERIES["tm1_occurrences"](spark, "/root/testdata/sf0.001")
    assert "NestedLoopJoin" not in tm1._jdf.queryExecution().toString()


def test_alignments_are_made_once(spark):
    """Nulls, empty sides and slices of few tokens; what is read of an alignment does not make it again."""
    rows = [(i, None if i % 7 == 0 else [f"t{(i * k) % 5}" for k in range(i % 9)], None if i % 11 == 0 else [f"t{(i + k) % 4}" for k in range(i % 6)]) for i in range(300)]
    own = spark.createDataFrame(rows, "id int, ref_tokens array<string>, hyp_tokens array<string>")
    for r in own.select("id", align.align("ref_tokens", "hyp_tokens").alias("a")).collect():
        ref, hyp = rows[r["id"]][1] or [], rows[r["id"]][2] or []
        s, d, i, pairs = align.align_tokens(ref, hyp)
        assert tuple(r["a"])[:5] == (s, d, i, len(ref), len(hyp)) and [tuple(p) for p in r["a"]["pairs"]] == pairs
    a = pa.array([["a"] * 9, None, ["b"]] * 50, pa.list_(pa.string()))
    parts = list(align._slices(a, a))
    assert sum(n for _, n in parts) == len(a) and [at for at, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
    for name in ("ce1_critical_substitutions", "ag9_confusions"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, name

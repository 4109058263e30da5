"""Command line: python -m talewright.cli benchmark | prepare | validate | normalize | hardware | service."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import inference
from .functions import align, text
from .operators import rules, split, summary
from .operators import terms as T
from .sources import readers, sinks


def session() -> SparkSession:
    return SparkSession.builder.appName("talewright").getOrCreate()


def score(results, terms, confusions, extra_terms=None):
    """(records, scores, events) of transcribed rows: audio, text, hypothesis, speaker_id, domain, duration_sec, model_ms, latency_ms."""
    df = results.withColumn("ref_normal", text.normalize(F.col("text"))).withColumn("hyp_normal", text.normalize(F.col("hypothesis")))
    df = df.withColumn("ref_tokens", text.tokens_of(F.col("ref_normal"))).withColumn("hyp_tokens", text.tokens_of(F.col("hyp_normal")))
    df = df.withColumn("alignment", align.align("ref_tokens", "hyp_tokens")).withColumn("duration_sec", summary.spoken_seconds(F.col("model_ms"), F.col("duration_sec")))
    errors = F.col("alignment.substitutions") + F.col("alignment.deletions") + F.col("alignment.insertions")
    ref, hyp = text.characters(F.col("ref_normal")), text.characters(F.col("hyp_normal"))
    df = df.withColumns({
        "wer": align.rate(errors, F.col("alignment.ref_len")), "cer": align.rate(align.char_errors(ref, hyp), F.length(ref)),
        "exact_match": F.col("ref_normal") == F.col("hyp_normal"), "real_time_factor": summary.real_time_factor(F.col("latency_ms"), F.col("duration_sec")),
    })
    key = ["audio"]
    return df, T.score_terms(T.term_counts(df, terms, key), key), T.critical_events(df, confusions, key, extra_terms)


def benchmark(spark: SparkSession, a: argparse.Namespace) -> int:
    config = readers.load_yaml(a.config, required=False) if a.config else {}
    settings = config.get("benchmark", {})
    model = dict(config.get("model", {"adapter": "deterministic"}))
    if a.model_id:
        model["model_id"] = a.model_id
    if a.limit is not None and a.limit < 0:
        raise SystemExit("--limit must not be negative")
    terms, confusions, critical = readers.profile_frames(spark, readers.load_yaml(settings["terms_file"]) if settings.get("terms_file") else {})
    if a.smoke:
        entries = readers.smoke_entries(spark, a.limit or 3)
    else:
        manifest = a.manifest or settings.get("manifest")
        if not manifest or not Path(manifest).exists():
            print("BLOCKED: there is no manifest to measure; no number is made up", file=sys.stderr)
            return 2
        rows = rules.valid_entries(readers.read_manifest(spark, manifest, strict=True))
        rows = rows.orderBy("file", "line_no").limit(a.limit) if a.limit else rows
        root = settings.get("audio_root", ".")
        files = readers.read_audio(spark, root).withColumn("audio", F.regexp_replace("path", "^.*?" + str(Path(root).resolve()) + "/", ""))
        entries = rows.join(files.select("audio", "content"), "audio", "left")
    began = sinks.now_utc()
    done = inference.transcribe(entries.select("audio", "text", "language", "speaker_id", "domain", "duration_sec", "content"), model, warmup=int(settings.get("warmup", 0))).persist()
    records, scores, events = score(done.where("ok"), terms, confusions, spark.createDataFrame([(t,) for t in critical], "term string"))
    errors = done.where("NOT ok").select("audio", "reason", "speaker_id")
    found = summary.summary(records, scores, events, errors, str(inference.plan(model)["model_id"]))
    shown = records.select("speaker_id", "domain", "audio", "duration_sec", "latency_ms", "real_time_factor", F.col("text").alias("reference"), "hypothesis", "wer", "cer", "exact_match")
    paths = sinks.write_report(found, shown, errors, settings.get("output_dir", "reports"), {"started_at": began, "finished_at": sinks.now_utc(), "smoke": a.smoke})
    print("\n".join(paths))
    return 0


def prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        rows = readers.read_transcripts(spark, a.csv)
        files = readers.read_audio(spark, a.datasets_dir)
        info = files.select(F.regexp_replace("path", "^.*?" + str(Path(a.datasets_dir).resolve()) + "/", "").alias("audio"), readers.audio_info("content")["duration_sec"].alias("duration_sec"))
        checked = rules.validate(sinks.manifest_json(readers.with_probed_duration(rows, info)).withColumnRenamed("value", "line"))
        if bad := checked.where("error IS NOT NULL").first():
            raise readers.ManifestError(f"{bad['error']}: {bad['line']}")
        dealt = split.split_by_speaker(rules.valid_entries(checked).drop("line"), tuple(a.ratios), a.seed).persist()
        split.assert_no_leakage(dealt)
    except (readers.ManifestError, split.SplitError, split.LeakageError, FileNotFoundError) as exc:
        print(f"error: {exc}", file=sys.stderr)
        return 1
    for name in split.SPLITS:
        sinks.write_manifest(dealt.where(F.col("split") == name), f"{a.datasets_dir}/manifests/{name}.jsonl", name)
    summary.split_stats(dealt).show()
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    parts = []
    for name in split.SPLITS:
        path = f"{a.datasets_dir}/manifests/{name}.jsonl"
        if not Path(path).exists():
            print(f"warning: no {path}", file=sys.stderr)
            continue
        try:
            parts.append(rules.valid_entries(readers.read_manifest(spark, path, strict=True)).withColumn("split", F.lit(name)))
        except readers.ManifestError as exc:
            print(f"FAIL {name}: {exc}", file=sys.stderr)
            return 1
    if not parts:
        print("nothing to validate")
        return 0
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    summary.split_stats(rows).show()
    summary.domain_histogram(rows).show(100)
    faults = [f"{r['speaker_id']} in {r['splits']}" for r in split.leaks(rows).limit(20).collect()]
    faults += [f"synthetic rows in test: {n}" for n in [rules.synthetic_in_test(rows).count()] if n]
    print("FAIL\n" + "\n".join(faults) if faults else "PASS")
    return int(bool(faults))


def normalize(spark: SparkSession, a: argparse.Namespace) -> int:
    files = readers.list_audio(spark, a.input)
    root = str(Path(a.input).resolve()) + "/"
    target = text.canonical_target(F.regexp_replace("path", "^file:", ""), root, str(Path(a.out_dir).resolve()))
    if a.dry_run:
        files.withColumn("target", target).show(1000, False)
        return int(files.isEmpty())
    done = sinks.write_canonical(readers.read_audio(spark, a.input).join(files.select("path"), "path", "left_semi").withColumn("target", target)).persist()
    summary.status_totals(done).show()
    return summary.exit_code(done)


def hardware(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.out:
        sinks.write_environment(spark, a.out)
    else:
        print(json.dumps(sinks.environment(spark).first().asDict(recursive=True), indent=2))
    return 0


def service(spark: SparkSession, a: argparse.Namespace) -> int:
    from .service import serve

    with serve(spark, readers.load_yaml(a.config, required=False) if a.config else {}, a.port) as server:
        print(f"listening on port {server.server_port}", flush=True)
        if not a.check:
            server.serve_forever()
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="talewright")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("benchmark")
    b.add_argument("--config")
    b.add_argument("--manifest")
    b.add_argument("--model-id")
    b.add_argument("--limit", type=int)
    b.add_argument("--smoke", action="store_true")
    c = sub.add_parser("prepare")
    c.add_argument("--csv", required=True)
    c.add_argument("--datasets-dir", default="datasets")
    c.add_argument("--ratios", type=float, nargs=3, default=[0.8, 0.1, 0.1])
    c.add_argument("--seed", type=int, default=42)
    sub.add_parser("validate").add_argument("--datasets-dir", default="datasets")
    n = sub.add_parser("normalize")
    n.add_argument("input")
    n.add_argument("--out-dir", required=True)
    n.add_argument("--dry-run", action="store_true")
    sub.add_parser("hardware").add_argument("--out")
    v = sub.add_parser("service")
    v.add_argument("--config")
    v.add_argument("--port", type=int, default=8000)
    v.add_argument("--check", action="store_true", help="bind the port and leave")
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return {"benchmark": benchmark, "prepare": prepare, "validate": validate, "normalize": normalize, "hardware": hardware, "service": service}[a.command](session(), a)


if __name__ == "__main__":
    sys.exit(main())

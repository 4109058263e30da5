"""Benchmark aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .terms import CATEGORIES

DELETED = "<deleted>"


def real_time_factor(latency_ms: Column, duration: Column) -> Column:
    """Seconds spent for each second of speech; 0 for speech without length."""
    return F.when(duration > 0, latency_ms / 1000.0 / duration).otherwise(0.0)


def spoken_seconds(model_ms: Column, manifest_seconds: Column) -> Column:
    return F.when(F.coalesce(model_ms, F.lit(0)) != 0, model_ms / 1000.0).otherwise(manifest_seconds)


def _percentile(latency: Column, p: float) -> Column:
    """Linear between the two nearest ranks; 0 without values."""
    return F.coalesce(F.percentile(latency, F.lit(p)), F.lit(0.0))


def headline(records: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row: counts, mean rates, phrase accuracy, latency and real-time figures. Means of nothing are null."""
    row = records.agg(
        F.count(F.lit(1)).alias("utterances"),
        F.avg("wer").alias("wer_macro"), F.avg("cer").alias("cer_macro"),
        F.avg(F.col("exact_match").cast("double")).alias("phrase_accuracy_global"),
        F.avg("latency_ms").alias("latency_mean"), _percentile(F.col("latency_ms"), 0.5).alias("latency_p50"), _percentile(F.col("latency_ms"), 0.95).alias("latency_p95"),
        F.avg("real_time_factor").alias("real_time_factor_mean"),
    )
    if errors is None:
        return row.withColumn("skipped", F.lit(0).cast("long"))
    return row.crossJoin(errors.agg(F.count(F.lit(1)).alias("skipped")))  # one row by one row


def by_group(records: DataFrame) -> DataFrame:
    """(domain, speaker_id, utterances, mean_wer, phrase_accuracy) for all, each domain and each speaker in one scan;
    null stands for all. `level` tells them apart."""
    sets = records.groupingSets([[], ["domain"], ["speaker_id"]], "domain", "speaker_id")
    out = sets.agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("utterances"), F.avg("wer").alias("mean_wer"), F.avg(F.col("exact_match").cast("double")).alias("phrase_accuracy"))
    level = F.when(F.col("_g") == 3, "all").when(F.col("_g") == 1, "domain").otherwise("speaker")
    return out.select(level.alias("level"), "domain", "speaker_id", "utterances", "mean_wer", "phrase_accuracy")


def per_domain(records: DataFrame) -> DataFrame:
    return records.groupBy("domain").agg(F.count(F.lit(1)).alias("utterances"), F.avg("wer").alias("mean_wer"), F.avg(F.col("exact_match").cast("double")).alias("phrase_accuracy")).orderBy("domain")


def per_speaker(records: DataFrame) -> DataFrame:
    return records.groupBy("speaker_id").agg(F.count(F.lit(1)).alias("utterances"), F.avg("wer").alias("mean_wer")).orderBy("speaker_id")


def term_accuracy(scores: DataFrame) -> DataFrame:
    """(category, expected, correct, accuracy) pooled over all utterances; accuracy null without an expected term."""
    sums = scores.groupBy("category").agg(F.sum("expected").alias("expected"), F.sum("correct").alias("correct"))
    return sums.withColumn("accuracy", F.try_divide(F.col("correct").cast("double"), F.col("expected").cast("double"))).orderBy("category")


def confusion_counts(events: DataFrame) -> DataFrame:
    """(reference_term, hypothesis_term, n); a lost term stands as DELETED."""
    hyp = F.when(F.col("hypothesis_term") == "", DELETED).otherwise(F.col("hypothesis_term"))
    return events.groupBy("reference_term", hyp.alias("hypothesis_term")).agg(F.count(F.lit(1)).alias("n")).orderBy("reference_term", "hypothesis_term")


def split_stats(entries: DataFrame) -> DataFrame:
    """(split, utterances, speakers, hours, synthetic)."""
    return entries.groupBy("split").agg(
        F.count(F.lit(1)).alias("utterances"), F.countDistinct("speaker_id").alias("speakers"),
        (F.sum("duration_sec") / 3600.0).alias("hours"), F.count_if(F.col("source") == "synthetic").alias("synthetic"),
    )


def domain_histogram(entries: DataFrame) -> DataFrame:
    return entries.groupBy("split", "domain").agg(F.count(F.lit(1)).alias("n"))


def status_totals(results: DataFrame) -> DataFrame:
    """(status, n) of a file job; its exit code is 1 if anything failed or nothing was found."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def exit_code(results: DataFrame) -> int:
    found = {r["status"]: r["n"] for r in status_totals(results).collect()}  # a row for each status
    return int(not found or found.get("failed", 0) > 0)


def summary(records: DataFrame, scores: DataFrame, events: DataFrame, errors: DataFrame | None = None, model_id: str = "") -> dict:
    """The whole report summary as a dict; only aggregates reach the driver."""
    top = headline(records, errors).first().asDict()
    pooled = {r["category"]: r["accuracy"] for r in term_accuracy(scores).collect()}
    confusions: dict[str, dict[str, int]] = {}
    for r in confusion_counts(events).collect():
        confusions.setdefault(r["reference_term"], {})[r["hypothesis_term"]] = r["n"]
    groups = by_group(records).where("level != 'all'").collect()
    names = {"entity": "entity_term_accuracy", "financial": "financial_term_accuracy", "currency": "currency_term_accuracy", "amount": "amount_token_accuracy", "date": "date_token_accuracy"}
    return {
        "model_id": model_id, "utterances": top["utterances"], "skipped": top["skipped"], "wer_macro": top["wer_macro"], "cer_macro": top["cer_macro"],
        "phrase_accuracy_global": top["phrase_accuracy_global"], **{names[c]: pooled.get(c) for c in CATEGORIES}, "critical_term_errors": confusions,
        "latency_ms": {"mean": top["latency_mean"], "p50": top["latency_p50"], "p95": top["latency_p95"]}, "real_time_factor_mean": top["real_time_factor_mean"],
        "per_domain": {r["domain"]: {"utterances": r["utterances"], "mean_wer": r["mean_wer"], "phrase_accuracy": r["phrase_accuracy"]} for r in sorted((g for g in groups if g["level"] == "domain"), key=lambda g: g["domain"])},
        "per_speaker": {r["speaker_id"]: {"utterances": r["utterances"], "mean_wer": r["mean_wer"]} for r in sorted((g for g in groups if g["level"] == "speaker"), key=lambda g: g["speaker_id"])},
    }

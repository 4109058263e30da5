"""Views of the driver's tables in the shape of manifests, utterance pairs, latency facts and waveforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import align, text
from ..operators import summary
from ..operators.rules import DOMAINS
from ..operators.terms import CATEGORIES
from ..storage import staged, table

KEY = ["conv_id", "turn", "pos"]
#: Sizes of the vocabularies that stand for term lists.
TOP_TOKENS, TOP_BIGRAMS, TOP_CONFUSIONS = 40, 10, 13


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every turn as a manifest entry."""
    c = table(spark, sf_dir, "conversations")
    parts = c.select("conv_id", "turn", "role", F.posexplode(F.split("text", r"[.\n]+")).alias("pos", "text")).where(F.trim("text") != "")
    return parts.select(
        *KEY, F.trim("text").alias("text"),
        F.concat(F.lit("clips/"), F.concat_ws("_", "conv_id", "turn", "pos"), F.lit(".wav")).alias("audio"),
        F.lit("mixed").alias("language"), F.concat(F.lit("spk_"), F.col("conv_id").cast("string")).alias("speaker_id"),
        (F.length(F.trim("text")) / 15.0).alias("duration_sec"), pick(DOMAINS, (F.col("turn") + F.col("conv_id")) % 15).alias("domain"),
        F.when(F.col("role") == "system", "synthetic").otherwise("recorded").alias("source"),
    )


def disturbed(tokens: Column, offset: Column) -> Column:
    """A hypothesis: by place, tokens are dropped, changed or doubled."""

    def one(t: Column, i: Column) -> Column:
        k = i + offset
        return F.when(k % 7 == 0, F.array().cast("array<string>")).when(k % 5 == 0, F.array(F.concat(t, F.lit("x")))).when(k % 11 == 0, F.array(t, t)).otherwise(F.array(t))

    return F.flatten(F.transform(tokens, one))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances with reference and hypothesis tokens and a latency."""
    u = utterances(spark, sf_dir).withColumn("ref_normal", text.normalize(F.col("text"), with_nfkc=False))
    u = u.withColumn("ref_tokens", text.tokens_of(F.col("ref_normal"))).withColumn("hyp_tokens", disturbed(F.col("ref_tokens"), F.col("turn") + F.col("conv_id")))
    return u.withColumn("hyp_normal", F.array_join("hyp_tokens", " ")).withColumn("latency_ms", (100 + (F.col("conv_id") * 37 + F.col("turn") * 11 + F.col("pos") * 7) % 900).cast("double"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored utterances."""
    p = align.with_errors(pairs(spark, sf_dir), "ref_tokens", "hyp_tokens")
    ref, hyp = text.characters(F.col("ref_normal")), text.characters(F.col("hyp_normal"))
    return p.select(
        *KEY, "speaker_id", "domain", "duration_sec", "latency_ms", F.col("word_errors").cast("long").alias("word_errors"), F.size("ref_tokens").cast("long").alias("ref_len"),
        align.rate(F.col("word_errors"), F.size("ref_tokens")).alias("wer"), align.rate(align.char_errors(ref, hyp), F.length(ref)).alias("cer"),
        (F.col("ref_normal") == F.col("hyp_normal")).alias("exact_match"), summary.real_time_factor(F.col("latency_ms"), F.col("duration_sec")).alias("real_time_factor"),
    )


def _ranked(words: DataFrame, top: int) -> DataFrame:
    """(rank from 0, term) of the `top` most frequent terms; ties go by the term."""
    best = words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(top)
    gathered = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "term"))).alias("x"))  # `top` rows
    return gathered.select(F.posexplode("x").alias("rank", "x")).select("rank", "x.term")


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category, term): the most frequent tokens and bigrams, dealt to the categories by rank."""
    p = pairs(spark, sf_dir)
    single = _ranked(p.select(F.explode("ref_tokens").alias("term")), TOP_TOKENS)
    double = _ranked(p.select(F.explode(F.filter(F.transform("ref_tokens", lambda t, i: F.concat_ws(" ", t, F.get("ref_tokens", i + 1))), lambda g: F.contains(g, F.lit(" ")))).alias("term")), TOP_BIGRAMS)
    return staged(single.unionByName(double).select(pick(CATEGORIES, F.col("rank") % 5).alias("category"), "term"), "vocabulary")


def confusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reference, forbidden) of the most frequent tokens."""
    single = _ranked(pairs(spark, sf_dir).select(F.explode("ref_tokens").alias("term")), TOP_CONFUSIONS)
    return staged(single.select(F.col("term").alias("reference"), F.concat("term", F.lit("x")).alias("forbidden")), "confusions")


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, line): manifest lines of all turns; by conversation, one of twelve kinds of fault or none."""
    c = table(spark, sf_dir, "conversations")
    kind = F.col("conv_id") % 12
    quoted = F.to_json(F.struct(F.col("text").alias("t")))
    field = lambda k, name, good, bad: F.when(kind == k, F.lit(bad)).otherwise(F.concat(F.lit(f'"{name}":'), good))
    body = [
        field(1, "audio", F.lit('"a.wav"'), '"audio":"  "'), F.when(kind == 2, F.lit('"text":" "')).otherwise(F.concat(F.lit('"text":'), F.regexp_extract(quoted, r'(?s)^\{"t":(.*)\}$', 1))),
        field(3, "language", F.lit('"id"'), '"language":"xx"'), field(4, "speaker_id", F.concat(F.lit('"spk_'), F.col("conv_id").cast("string"), F.lit('"')), '"speaker_id":"Ann"'),
        F.when(kind == 5, F.lit('"duration_sec":true')).when(kind == 6, F.lit('"duration_sec":600.5')).when(kind == 7, F.lit('"duration_sec":"3"')).otherwise(F.lit('"duration_sec":3')),
        field(8, "domain", F.lit('"general"'), '"domain":"sports"'), F.when(kind == 9, F.lit('"other":1')).otherwise(F.lit('"source":"recorded"')),
    ]
    line = F.when(kind == 10, F.lit('{"audio":')).when(kind == 11, F.lit("[1]")).otherwise(F.concat(F.lit("{"), F.concat_ws(",", *body), F.lit("}")))
    return c.select("conv_id", "turn", line.alias("line"))


def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, wave): embeddings, some of them loud."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 4)).alias("wave"))

"""Term analytics: occurrences of terms, scores by category, confusions and lost terms.

Terms are one to a few words. Token arrays are turned into n-grams of the lengths that occur among the terms and
joined by equality. A term list is written once, so that whatever made it runs once, and broadcast if its bytes allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import small, staged

CATEGORIES = ("entity", "financial", "currency", "amount", "date")


def term_words(term: Column) -> Column:
    """Words of a term: lower case, split at white space, not normalised further."""
    return F.filter(F.split(F.lower(term), r"(?U)\s+"), lambda w: w != "")


def occurrences(tokens: Column, term: Column) -> Column:
    """How often the words of `term` (an array) stand in a row in `tokens`, overlaps counted."""
    k = F.size(term)
    starts = F.when((k > 0) & (F.size(tokens) >= k), F.sequence(F.lit(1), F.size(tokens) - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(starts, lambda i: F.slice(tokens, i, k) == term)).cast("long")


def ngrams(tokens: Column, lengths: list[int]) -> Column:
    """All runs of tokens of the given lengths, joined by spaces."""

    def of(k: int) -> Column:
        if k == 1:
            return F.coalesce(tokens, F.array().cast("array<string>"))
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - k + 1, F.lit(1)))
        return F.when(F.size(tokens) >= k, F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, k), " "))).otherwise(F.array().cast("array<string>"))

    parts = [of(k) for k in lengths]
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def term_counts(pairs: DataFrame, terms: DataFrame, key: list[str], ref: str = "ref_tokens", hyp: str = "hyp_tokens") -> DataFrame:
    """(key, category, term, expected, predicted) of the terms that a pair holds on either side.

    terms: category, term; a term that a category lists twice counts twice.
    """
    words = term_words(F.col("term"))
    listed = staged(terms.select("category", "term", F.array_join(words, " ").alias("gram"), F.size(words).alias("k")).where("k > 0"), "terms")
    lengths = sorted(r[0] for r in listed.select("k").distinct().collect())  # a few word counts
    # one row for each gram that is a term, with all that it stands for
    known = small(staged(listed.groupBy("gram").agg(F.collect_list(F.struct("category", "term")).alias("of")), "grams"))
    side = lambda c, sign: F.transform(ngrams(F.col(c), lengths), lambda g: F.struct(g.alias("gram"), F.lit(sign).alias("e")))
    grams = pairs.select(*key, F.explode(F.concat(side(ref, 1), side(hyp, 0))).alias("g")).select(*key, "g.gram", "g.e")
    counted = grams.join(known, "gram").groupBy(*key, "gram").agg(F.sum("e").cast("long").alias("expected"), F.sum(1 - F.col("e")).cast("long").alias("predicted"), F.first("of").alias("of"))
    return counted.select(*key, F.explode("of").alias("t"), "expected", "predicted").select(*key, "t.category", "t.term", "expected", "predicted")


def term_totals(pairs: DataFrame, terms: DataFrame, tokens: str = "ref_tokens") -> DataFrame:
    """(term, n): how often each term stands in all token arrays, 0 for one that is nowhere; a term listed twice counts twice."""
    words = term_words(F.col("term"))
    listed = staged(terms.select("term", F.array_join(words, " ").alias("gram"), F.size(words).alias("k")), "terms")
    lengths = sorted(r[0] for r in listed.where("k > 0").select("k").distinct().collect())  # a few word counts
    known = small(staged(listed.where("k > 0").select("gram").distinct(), "grams"))
    found = pairs.select(F.explode(ngrams(F.col(tokens), lengths)).alias("gram")).join(known, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(found, "gram", "left").groupBy("term").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))


def score_terms(counts: DataFrame, key: list[str]) -> DataFrame:
    """(key, category, expected, predicted, correct, accuracy): correct is the lesser of both counts, accuracy null
    without an expected term."""
    sums = counts.groupBy(*key, "category").agg(F.sum("expected").alias("expected"), F.sum("predicted").alias("predicted"), F.sum(F.least("expected", "predicted")).alias("correct"))
    return sums.withColumn("accuracy", F.try_divide(F.col("correct").cast("double"), F.col("expected").cast("double")))


def critical_substitutions(aligned: DataFrame, confusions: DataFrame, key: list[str]) -> DataFrame:
    """(key, reference_term, hypothesis_term) of substituted pairs that the confusion list forbids; one row each."""
    # the outer form: of the other, Spark infers a filter on the pairs, for which all alignments are made once more
    pairs = aligned.select(*key, F.explode_outer("alignment.pairs").alias("p")).select(*key, F.col("p.ref").alias("reference_term"), F.col("p.hyp").alias("hypothesis_term"))
    listed = staged(confusions.select(F.col("reference").alias("reference_term"), F.col("forbidden").alias("hypothesis_term")).distinct(), "confusions")
    return pairs.join(small(listed), ["reference_term", "hypothesis_term"]).select(*key, "reference_term", "hypothesis_term")


def critical_deletions(counts: DataFrame, key: list[str]) -> DataFrame:
    """An event with an empty hypothesis for each critical term that the reference holds more often than the hypothesis."""
    lost = counts.where("expected > predicted").select(*key, "term").distinct()
    return lost.select(*key, F.col("term").alias("reference_term"), F.lit("").alias("hypothesis_term"))


def critical_events(pairs: DataFrame, confusions: DataFrame, key: list[str], extra_terms: DataFrame | None = None) -> DataFrame:
    """Forbidden substitutions, then lost critical terms. pairs: ref_tokens, hyp_tokens, alignment."""
    confusions = staged(confusions, "confusions")
    critical = confusions.select(F.col("reference").alias("term"))
    if extra_terms is not None:
        critical = critical.unionByName(extra_terms.select(F.lower("term").alias("term")))
    critical = critical.distinct().select(F.lit("critical").alias("category"), "term")
    return critical_substitutions(pairs, confusions, key).unionByName(critical_deletions(term_counts(pairs, critical, key), key))


def critical_vocabulary(confusions: DataFrame, extra: list[str]) -> DataFrame:
    """Union of the references of the confusions and a list, sorted."""
    return confusions.agg(F.array_sort(F.array_union(F.collect_set("reference"), F.lit(extra) if extra else F.array().cast("array<string>"))).alias("critical_terms"))

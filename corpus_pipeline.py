"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents, with their
values, whatever the columns are called. Every stage works on all rows that it is given: null and empty texts, null and
repeated ids, repeated rows and empty tables are no errors, and each docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talewright.llm import bpe, decontaminate, minhash, secrets, toxicity
from talewright.llm.common import drop_staged, staged, staging_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier rejects go. Null, empty and letterless texts have no evidence and stay; equal
    rows fare alike. The classifier is fitted on labelled rows of `docs`; without labels of both classes nothing goes."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id: five-word shingles, similarity 0.8 or more.
    Null and empty texts and rows without an id are like nothing and stay; rows that share the kept id all stay."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item, or a shorter item, go. Null and empty texts hold none and
    stay; an empty benchmark removes nothing."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced and n_chars is brought in line; every document stays. Null texts stay null."""
    return secrets.redact_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to. Null texts count as empty."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]

#: The stages fit classifiers, hash and merge; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table over all documents; each stage's table is written, and the one before it deleted. What is
    returned is read from the shared folder and the caller's to remove."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = staging_path(spark, name)
        docs = staged(stage(spark, docs, sf_dir), name, path)
        if last:
            drop_staged(spark, last)
        last = path
    return docs

"""Tables of a folder, staged tables in the cluster's shared folder, and broadcasts of checked size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a staged side is broadcast.
SMALL = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only in local mode, as in tests, a temporary one takes its place."""
    there = spark.conf.get("spark.checkpoint.dir", "")
    if there:
        return there
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: staged tables need a folder that all machines share")
    return f"file://{tempfile.gettempdir()}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared(spark)}/talewright-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written once in the shared folder and read back, for what is read more than once or is small."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """A staged table with a broadcast hint if its rows, as JSON, take at most `limit` bytes."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 16), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df

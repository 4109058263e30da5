"""What the operators share: table access, the shared folder, digests and size-checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a staged side may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 8 << 20
#: Parts into which the rows of one key are dealt where a hot key meets a side that is too large to broadcast.
SALTS = 16


_KEPT: dict = {}


def give_back() -> None:
    """Give a worker's free memory back to the machine, where its libraries can: workers wait for the next stage beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def kept_by_worker(key, make):
    """What a Python worker keeps from task to task: make(), for one key at a time. Workers are used again by later stages,
    and what an earlier operator remembered would only take their memory."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where it is unset, a temporary one in local mode, as in tests; on
    a cluster, whose machines do not see each other's folders, that is an error."""
    there = spark.conf.get("spark.checkpoint.dir", "") or getattr(spark, "_talewright_shared", None)
    if not there:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: staged tables need a folder that all machines share")
        there = f"file://{tempfile.mkdtemp(prefix='talewright-')}"
        spark._talewright_shared = there
    return there


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/talewright-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = path or staging_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a table that staged() wrote and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Workspace:
    """The staged tables of one call below one folder; all but the result go when it is finished."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.root = f"{shared_dir(spark)}/talewright-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh_path(self, name: str) -> str:
        return self.path(f"{name}-{uuid.uuid4().hex}")

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        return staged(df, name, self.path(name))

    def saved(self, df: DataFrame, key: str, parts: int) -> DataFrame:
        """df as a catalog table in `parts` buckets of `key`: joins on it move none of its rows."""
        name = f"talewright_{self.name}_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.repartition(parts, key).write.bucketBy(parts, key).option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def finished(self, result: DataFrame) -> DataFrame:
        """The result as a staged table, the only one that stays; it is the caller's to remove."""
        out = staged(result, "result")
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_staged(self.spark, self.root)
        return out


def row_bytes(df: DataFrame) -> int:
    """Bytes of all rows of a staged table, as JSON, which is no less than what a hash table keeps of their values."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 16), F.lit(0))).first()[0]


def maybe_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast only when the rows of `df`, which is staged, take at most `limit` bytes (BROADCAST_BYTES); otherwise
    leave the join to a shuffle."""
    return F.broadcast(df) if row_bytes(df) <= (BROADCAST_BYTES if limit is None else limit) else df


def join_hot(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "left") -> DataFrame:
    """left.join(right, key) where many rows of `left` may share a key and `right`, which is staged, has one row for each: a
    broadcast if its bytes allow, else a shuffle in which a key's rows are dealt by the hash of `by` and its one row is
    repeated SALTS times."""
    if row_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), key, how)
    salt = fresh("salt", [*left.columns, *right.columns])
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return dealt.join(right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, salt], how).drop(salt)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not among `taken`, whatever its case."""
    have = {t.lower() for t in taken}
    while name.lower() in have:
        name += "_"
    return name


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python workers and back in Arrow batches of `rows` rows, unless the session asks for a number of its own:
    batches of Spark's default of 10,000 whole texts stand four times over beside an executor's heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, str(rows))


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

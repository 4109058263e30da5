"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256, record headers are stored exactly as written in a second table, and
the original records come back through joins on the digest. Payloads lie in buckets of their digest, so that a join
with them moves headers only.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, Workspace, shuffle_partitions, table, text_or_empty

#: Payloads shorter than this are never replaced by a revisit.
MIN_REVISIT_BYTES = 100
#: Fixed value: the profile of a revisit record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of the records that the query writes, so that equal tables give equal archives.
QUERY_DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
PAYLOADS = "digest STRING, payload BINARY"


def _salted(df: DataFrame, by: str) -> DataFrame:
    """Rows of one digest are dealt by a salt, so that a page that makes up a third of the table is not joined in one task."""
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def _all_salts(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _record_id(page: Column, digest: Column) -> Column:
    """A UUID in URN form from what a record is about."""
    key = F.sha2(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("")), digest), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(key, a, n) for a, n in cuts)), F.lit(">"))


def _header_text(date: str) -> Column:
    """The header block of one record, from its first line to the blank line."""
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit(CRLF))).otherwise("")
    one_line = F.regexp_replace(F.col("url"), r"[\r\n]+", " ")
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", one_line),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))),
        field("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), _record_id(F.col("refers_to"), F.col("digest")))),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        field("X-Payload-Length", F.col("n").cast("string")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(F.col("record_type") == "revisit", F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> None:
    """Write `pages` as tables below `path`: payloads(digest, payload), headers(digest, header) and layout(buckets).

    Null html is an empty payload, a null url leaves its header line out, a null id is kept and never becomes a response
    that others refer to. Of equal payloads of MIN_REVISIT_BYTES and more the smallest id is the response; if several
    rows repeat that id, all of them are responses. An empty table gives an empty archive; other columns, whatever their
    names, are not read. `date` (UTC, now if not given) is the WARC-Date of all records.
    """
    spark = pages.sparkSession
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    base = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), F.encode(text_or_empty(pages[html_col]), "UTF-8").alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload").cast("long"))
    firsts = base.where(F.col("n") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    known = _salted(base.drop("payload"), "page_id").join(_all_salts(firsts), ["digest", "salt"], "left")
    again = F.col("first_id").isNotNull() & ((F.col("page_id") > F.col("first_id")) | F.col("page_id").isNull())
    records = known.select("digest", "page_id", "url", "n", F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"))
    records.select("digest", F.encode(_header_text(date), "UTF-8").alias("header")).write.mode("overwrite").parquet(f"{path}/headers")
    # copies are dropped before and after the one shuffle of payloads, which deals them to their buckets as well
    buckets = shuffle_partitions(spark)
    name = f"talewright_payloads_{uuid.uuid4().hex}"
    base.select("digest", "payload").dropDuplicates(["digest"]).write.bucketBy(buckets, "digest").option("path", f"{path}/payloads").option("compression", "zstd").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")


def _proven(payloads: DataFrame) -> DataFrame:
    true = F.sha2("payload", 256)
    proven = F.when(true == F.col("digest"), true).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
    return payloads.select("digest", "payload", proven.alias("verified"), F.octet_length("payload").cast("long").alias("n_bytes"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest, payload, verified (the digest again, from the bytes), n_bytes of the store; a payload whose bytes do not have its
    digest stops the read. An empty archive gives no rows."""
    return _proven(spark.read.schema(PAYLOADS).parquet(f"{path}/payloads"))


def _bucketed(spark: SparkSession, path: str, work: Workspace) -> DataFrame:
    """The payloads with their buckets known to the planner."""
    name = f"talewright_payloads_{uuid.uuid4().hex}"
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    spark.sql(f"CREATE TABLE {name} ({PAYLOADS}) USING parquet CLUSTERED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/payloads'")
    work.tables.append(name)
    return _proven(spark.table(name))


def read_headers(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The header table with the fields that its text holds; ids that were null are null."""
    text = F.decode("header", "UTF-8")
    part = lambda rx: F.nullif(F.regexp_extract(text, rx, 1), F.lit(""))
    return spark.read.parquet(f"{path}/headers").select(
        "digest", "header",
        part(r"(?m)^X-Page-ID: ([^\r]*)").cast(id_type).alias("page_id"),
        part(r"(?m)^WARC-Type: (\w+)").alias("record_type"),
        part(r"(?m)^X-Refers-To-Page-ID: ([^\r]*)").cast(id_type).alias("refers_to"),
        part(r"(?m)^WARC-Payload-Digest: sha256:(\w+)").alias("header_digest"),
        part(r"(?m)^X-Payload-Length: (\d+)").cast("long").alias("header_bytes"),
    )


def reconstruct(spark: SparkSession, path: str, work: Workspace | None = None, id_type: str = "long") -> DataFrame:
    """Original records: page_id, record_type, refers_to, header_digest, verified, n_bytes (of the full payload, also of a revisit)
    and record, the whole record's bytes, where a revisit has an empty block. A record for each header, repeated ones
    too; a header without its payload, or whose digest or length is another, stops the read.

    Responses of MIN_REVISIT_BYTES and more have payloads of their own and meet them in their buckets (if `work` is given,
    in which the buckets' table is kept until it is finished). All others are joined with narrow rows, dealt by a salt.
    """
    headers = read_headers(spark, path, id_type)
    payloads = _bucketed(spark, path, work) if work else read_payloads(spark, path)
    whole = (F.col("record_type") == "response") & (F.col("header_bytes") >= MIN_REVISIT_BYTES)
    long = headers.where(whole).join(payloads, "digest", "left")
    brief = payloads.select("digest", F.when(F.col("n_bytes") < MIN_REVISIT_BYTES, F.col("payload")).alias("payload"), "verified", "n_bytes")
    rest = _salted(headers.where(~whole), "page_id").join(_all_salts(brief), ["digest", "salt"], "left").drop("salt")
    found = long.unionByName(rest)
    fits = (F.col("verified") == F.col("header_digest")) & (F.col("n_bytes") == F.col("header_bytes"))
    verified = F.when(F.coalesce(fits, F.lit(False)), F.col("verified")).otherwise(F.raise_error(F.concat(F.lit("no payload "), F.col("digest"))))
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("header"), block, F.encode(F.lit(CRLF + CRLF), "UTF-8"))
    return found.select("page_id", "record_type", "refers_to", "header_digest", verified.alias("verified"), "n_bytes", record.alias("record"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page, all of it read back from rebuilt records; record_sha256 is the whole record's. The cases of
    write_archive() hold."""
    work = Workspace(spark, "warc")
    path = work.path("archive")
    write_archive(table(spark, sf_dir, "pages"), path, date=QUERY_DATE)
    back = reconstruct(spark, path, work)
    return work.finished(back.select("page_id", F.col("n_bytes").alias("payload_bytes"), F.col("verified").alias("payload_digest"), "record_type", "refers_to", F.sha2("record", 256).alias("record_sha256")))


OP9_SQL = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, url, payload, octet_length(encode(payload))::BIGINT AS n, sha256(encode(payload)) AS dg FROM p
), f AS (
  SELECT dg, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY dg
), r AS (
  SELECT d.*, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first_id THEN first_id END AS refers_to,
         sha256(page_id || '/' || d.dg) AS own, sha256(first_id || '/' || d.dg) AS other
  FROM d LEFT JOIN f ON d.dg = f.dg
), h AS (
  SELECT *, concat('WARC/1.1\r\nWARC-Type: ', record_type, '\r\nWARC-Record-ID: <urn:uuid:', own[1:8], '-', own[9:12], '-', own[13:16], '-', own[17:20], '-', own[21:32], '>\r\nWARC-Date: {QUERY_DATE}\r\n',
    CASE WHEN url IS NOT NULL THEN concat('WARC-Target-URI: ', regexp_replace(url, '[\r\n]+', ' ', 'g'), '\r\n') ELSE '' END, 'WARC-Payload-Digest: sha256:', dg, '\r\n',
    CASE WHEN record_type = 'revisit' THEN concat('WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:uuid:', other[1:8], '-', other[9:12], '-', other[13:16], '-', other[17:20], '-', other[21:32], '>\r\n') ELSE '' END,
    'X-Page-ID: ', page_id, '\r\n', CASE WHEN record_type = 'revisit' THEN concat('X-Refers-To-Page-ID: ', refers_to, '\r\n') ELSE '' END, 'X-Payload-Length: ', n,
    '\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ', CASE WHEN record_type = 'revisit' THEN 0 ELSE n END, '\r\n\r\n') AS header
  FROM r
)
SELECT page_id, n AS payload_bytes, dg AS payload_digest, record_type, refers_to,
       sha256(concat(header, CASE WHEN record_type = 'revisit' THEN '' ELSE payload END, '\r\n\r\n')) AS record_sha256
FROM h
"""

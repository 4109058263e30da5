"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window's tokens are its shingles of two words, ordered by how rare they are in the documents. Exact containment needs
every token, so the necessary prefix is the rarest one alone. Places of that token in a text are joined, the window
must fit into the text around the place (length and positional bounds), and its words are compared. Tokens are joined
as 64-bit hashes; a collision costs a comparison and changes no result. A window of one word has no shingle and is
joined on the word itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, Workspace, fresh, join_hot, maybe_broadcast, row_bytes, table, text_or_empty

WINDOW = 10
#: Separators of the words, after A-Z are lower-cased.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _SEPARATORS, -1), "")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, win, words): every distinct window of every item; an item of fewer words is one window."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(text_or_empty(benchmark[text_col])).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return each.select("item", F.sha2(F.array_join("words", " "), 256).alias("win"), "words").distinct()


def _shingle(word: Column, following: Column) -> Column:
    return F.xxhash64(word, F.coalesce(following, F.lit("")))


def _hits(base: DataFrame, distinct: DataFrame, work: Workspace, window: int, limit: int) -> DataFrame:
    """(digest, start, end, win): every place of every window in the texts of base(id, text)."""
    words = base.select(F.sha2("text", 256).alias("digest"), words_of(F.col("text")).alias("w"))
    placed = words.select("digest", "w", F.posexplode("w").alias("place", "word")).withColumn("key", _shingle(F.col("word"), F.get("w", F.col("place") + 1)))
    tokens = distinct.where(F.size("words") > 1).select("win", "words", F.posexplode(F.slice("words", F.lit(1), F.size("words") - 1)).alias("at", "word"))
    tokens = work.staged(tokens.select("win", "words", "at", _shingle(F.col("word"), F.get("words", F.col("at") + 1)).alias("key")), "tokens")
    vocabulary = work.staged(tokens.select("key").distinct(), "vocabulary")
    seen = work.staged(placed.select("key").join(maybe_broadcast(vocabulary, limit), "key").groupBy("key").agg(F.count(F.lit(1)).alias("seen")), "seen")
    # a window with a shingle that no document has is in none
    rarest = tokens.join(seen, "key", "left").groupBy("win").agg(F.min_by(F.struct("key", "at", "words", "seen"), F.struct(F.coalesce("seen", F.lit(0)), "key", "at")).alias("t"))
    prefixes = work.staged(rarest.select("win", "t.*").where("seen IS NOT NULL").drop("seen"), "prefixes")
    start = F.col("place") - F.col("at")
    fits = (start >= 0) & (start + F.size("words") <= F.col("n"))
    same = lambda near, first: F.slice(near, F.when(fits, start - first + 1).otherwise(1), F.size("words")) == F.col("words")
    if row_bytes(prefixes) <= limit:  # matches alone are built as rows
        found = placed.withColumn("n", F.size("w")).join(F.broadcast(prefixes), "key").where(fits & same(F.col("w"), F.lit(0)))
    else:  # a word's row carries the words that a window around it can reach, not the text
        low = F.greatest(F.col("place") - (window - 1), F.lit(0))
        near = placed.select("digest", "key", "place", F.size("w").alias("n"), low.alias("low"), F.slice("w", low + 1, 2 * window - 1).alias("near"))
        found = near.join(prefixes, "key").where(fits & same(F.col("near"), F.col("low")))
    hits = found.select("digest", start.alias("start"), (start + F.size("words")).alias("end"), "win")
    singles = work.staged(distinct.where(F.size("words") == 1).select("win", F.col("words")[0].alias("word")), "singles")
    if not singles.isEmpty():
        alone = placed.select("digest", "place", "word").join(maybe_broadcast(singles, limit), "word")
        hits = hits.unionByName(alone.select("digest", F.col("place").alias("start"), (F.col("place") + 1).alias("end"), "win"))
    return hits.distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, with_spans: bool = False, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(texts, leaks): texts has id, digest, n_words for every row of `docs`; leaks, a staged table, has a row per contaminated
    distinct text: digest, n_hit, items (sorted strings) and, if asked for, spans (start, end of each occurrence, in
    words). Sides of over `limit` bytes are shuffled.

    A text's result depends on its words alone, so repeated rows or ids do no harm. Null and empty texts have no words
    and no hits; empty items give no window; an empty table of either kind gives no leak. Other columns, whatever their
    names, are not read. Very long texts are searched whole.
    """
    work = Workspace(docs.sparkSession, "leaks")
    base = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    texts = base.select(F.col("id").alias(id_col), F.sha2("text", 256).alias("digest"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    windows = work.staged(item_windows(benchmark, item_col, item_text_col, window), "windows")
    distinct = windows.select("win", "words").dropDuplicates(["win"])
    hits = work.staged(_hits(base, distinct, work, window, limit), "hits")
    # words that are hit are counted one by one, so that a text with very many hits is dealt over all tasks
    covered = hits.select("digest", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("place")).distinct()
    leaks = covered.groupBy("digest").agg(F.count(F.lit(1)).alias("n_hit"))
    items = hits.select("digest", "win").distinct().join(windows.select("win", "item"), "win").groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    leaks = leaks.join(items, "digest")
    if with_spans:
        spans = hits.select("digest", "start", "end").distinct().groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
        leaks = leaks.join(spans, "digest")
    return texts, work.finished(leaks)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, from find_leaks(), whose cases hold."""
    texts, leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    out = join_hot(texts, leaks, "digest", "doc_id")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without a benchmark window, all their columns kept with their values, whatever their names.

    Rows with null or empty texts stay, as do rows with null ids and repeated rows that are clean; an empty benchmark
    removes nothing.
    """
    _, leaks = find_leaks(docs, benchmark, id_col, text_col)
    digest = fresh("digest", docs.columns)
    marked = docs.withColumn(digest, F.sha2(text_or_empty(docs[text_col]), 256))
    return join_hot(marked, leaks.select(F.col("digest").alias(digest)), digest, id_col, "left_anti").drop(digest)


OP4_SQL = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, w[i:i + 9] AS words
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), lens AS (
  SELECT DISTINCT len(words) AS n FROM win
), c AS (
  SELECT r, i, n, w[i:i + n - 1] AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), h AS (
  SELECT c.r, c.i, c.n, win.item FROM c JOIN win ON c.words = win.words
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r
), its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

"""Repeated passages by per-shard suffix arrays.

A string of WINDOW bytes is judged where its anchor is: the leftmost least K-gram hash inside it, which equal strings
share. The strings of one anchor make one short segment of text. Segments whose anchor hash occurs once in the corpus
hold no repeat. Equal segments, by a 128-bit BLAKE2 digest of their bytes, are one class with a count; a class that
counts two or more repeats as it stands. Different segments of one anchor hash meet in a shard, whose suffix array
(Larsson-Sadakane refinement) and common prefixes (Kasai) show which of their strings repeat. An anchor hash with more
segments than a shard takes is dealt over several, whose sorted suffixes are merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, shuffle_partitions, table, text_or_empty

#: Bytes of a string that counts as repeated, and bytes of an anchor.
WINDOW, K = 200, 32
#: Segments of a shard, and keys of a merge.
SHARD, MERGE = 4096, 20_000
#: Bytes of text that are hashed at once.
AT_ONCE = 1 << 20
_POSITION_BITS = 24
_PIECE = (1 << _POSITION_BITS) - 2 * WINDOW
_U = np.uint64
#: What tells a class of equal segments: anchor hash and both halves of the digest.
_CLASS = ["fp", "sh", "sk"]
_RANDOM = np.random.default_rng(77)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_POWER = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(29))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from each place, by doubling; K must be a power of two."""
    out, width, power = _BYTE[raw], 1, int(_POWER)
    while width < K:
        out = out[:-width] * _U(power) + out[width:]
        width, power = 2 * width, power * power % (1 << 64)
    return _mix(out)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of `width` values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def segments(raw: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first string, number of strings) of each run of strings that share an anchor."""
    if len(raw) < window:
        none = np.empty(0, np.int64)
        return none, none, none
    hashes = gram_hashes(raw)
    places = np.arange(len(hashes), dtype=np.uint64)
    low = _U((1 << _POSITION_BITS) - 1)
    least = sliding_least((hashes & ~low) | places, window - K + 1)
    anchor = (least & low).astype(np.int64)
    begin = np.flatnonzero(np.diff(anchor, prepend=-1))
    return hashes[anchor[begin]].view(np.int64), begin, np.diff(np.append(begin, len(anchor)))


def text_segments(raw: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """segments() of a text of any length; pieces overlap so that each string is in one of them."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) <= _PIECE:
        return segments(data, window)
    found = []
    for at in range(0, len(data) - window + 1, _PIECE - window + 1):
        fp, begin, count = segments(data[at : at + _PIECE], window)
        found.append((fp, begin + at, count))
    return tuple(np.concatenate(x) for x in zip(*found))


def many_segments(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, anchor hash, first string, number) for texts, short ones hashed together."""
    group: list[int] = []
    size = 0

    def together() -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in group])
        fp, begin, count = segments(raw, window)
        # runs are cut where a string would cross the end of its text
        until = begin + count
        owner = np.searchsorted(ends, begin, side="right")
        crossing = np.flatnonzero(until > ends[np.minimum(owner, len(ends) - 1)] - window + 1)
        parts = [np.delete(np.stack([owner, fp, begin, until]), crossing, axis=1)]
        extra = []
        for i in crossing:
            b, e, o = int(begin[i]), int(until[i]), int(owner[i])
            while b < e and o < len(ends):
                stop = min(e, int(ends[o]) - window + 1)
                if b < stop:
                    extra.append((o, int(fp[i]), b, stop))
                b = max(b, int(ends[o]))
                o += 1
        parts.append(np.array(extra, np.int64).reshape(-1, 4).T)
        o, f, b, e = np.concatenate(parts, axis=1)
        start = np.concatenate([[0], ends])[o]
        return np.array(group)[o], f, b - start, e - b

    for i, raw in enumerate(texts):
        if len(raw) < window:
            continue
        if len(raw) > AT_ONCE:
            fp, begin, count = text_segments(raw, window)
            yield np.full(len(fp), i), fp, begin, count
            continue
        group.append(i)
        size += len(raw)
        if size > AT_ONCE:
            yield together()
            group, size = [], 0
    if group:
        yield together()


# ---------------------------------------------------------------- one shard


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of symbols 0 (an end) to 256.

    Larsson-Sadakane: suffixes are grouped by their first seven symbols; then the groups that are not yet single are
    refined by the rank of the suffix h symbols on, with h doubling.
    """
    n = len(symbols)
    wide = np.concatenate([symbols.astype(np.uint64), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = key << _U(9) | wide[i : n + i]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if n else np.zeros(0, bool)
    first = np.flatnonzero(new)
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0
    rank[order] = np.repeat(first + 1, np.diff(np.append(first, n)))  # ranks from 1, shared by a group
    h = 7
    size = np.diff(np.append(first, n))
    at = np.flatnonzero(np.repeat(size > 1, size))  # places of the suffix array in groups of several
    while len(at):
        suffix = order[at]
        group = rank[suffix]
        on = rank[np.minimum(suffix + h, n)]
        turn = np.argsort(group * (n + 1) + on)  # one number for both: a group has at most n ranks to compare
        suffix, group, on = suffix[turn], group[turn], on[turn]
        order[at] = suffix
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (on[1:] != on[:-1])])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        rank[suffix] = np.repeat(at[first] + 1, size)
        at = at[np.repeat(size > 1, size)]
        h *= 2
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Kasai's common prefix of each suffix with the one before it in the suffix array, at most `most`; 0 where not asked for.

    Suffixes starts[k] to starts[k] + counts[k] - 1 are asked for. All runs are walked in step: the prefix of the next
    suffix is shorter by one at most. A symbol 0 never counts as common.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([symbols, np.zeros(most + 8, symbols.dtype)])
    out = np.zeros(n, np.int64)
    live = np.argsort(-counts, kind="stable")
    starts, counts = starts[live], counts[live]
    have = np.zeros(len(starts), np.int64)
    for step in range(int(counts[0]) if len(counts) else 0):
        m = int(np.searchsorted(-counts, -step, side="left"))  # runs longer than step
        i = starts[:m] + step
        j = before[i]
        length = np.where(j < 0, 0, np.maximum(have[:m] - 1, 0))
        todo = np.flatnonzero((j >= 0) & (length < most))
        while len(todo):
            a, b = padded[i[todo] + length[todo]], padded[j[todo] + length[todo]]
            todo = todo[(a == b) & (a != 0)]
            length[todo] += 1
            todo = todo[length[todo] < most]
        have[:m] = length
        out[i] = length
    return out


def repeated_in_shard(texts: list[bytes], counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start of each segment in the shard, whether the string at a place repeats, suffix array, common prefixes)."""
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    raw = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8).astype(np.uint16) + np.uint16(1)
    raw[starts + lengths] = 0
    order = suffix_array(raw)
    common = common_prefixes(raw, order, starts, counts, window)
    long = common[order] >= window
    hit = np.zeros(len(raw), bool)
    hit[order[long]] = True
    hit[order[:-1][long[1:]]] = True
    return starts, hit, order, common


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


# ---------------------------------------------------------------- the corpus


def _pack(begin: np.ndarray, heavy: np.ndarray, count: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return begin << 25 | heavy << 24 | count << 16 | tag


def _weights(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, heavy = [t.encode() for t in batch.column(0).to_pylist()], batch.column(1).to_numpy(zero_copy_only=False)
            for owner, fp, _, _ in many_segments(texts, window):
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(heavy[owner])], names=["fp", "w"])

    return run


def _described(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, heavy = [t.encode() for t in batch.column(0).to_pylist()], batch.column(1).to_numpy(zero_copy_only=False)
            t0, t1 = batch.column(2).to_numpy(), batch.column(3).to_numpy() & 0xFFFF
            for owner, fp, begin, count in many_segments(texts, window):
                raw = b"".join(hashlib.blake2b(texts[o][b : b + c + window - 1], digest_size=16).digest() for o, b, c in zip(owner.tolist(), begin.tolist(), count.tolist()))
                halves = np.frombuffer(raw, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(t0[owner]), pa.array(_pack(begin, heavy[owner] - 1, count, t1[owner]))], names=[*_CLASS, "t0", "at"])

    return run


def _fetch(window: int):
    """Bytes of segments, from texts joined with what is asked of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, t1, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                for a in asked:
                    if a["at"] & 0xFFFF == t1 & 0xFFFF:
                        begin, count = a["at"] >> 25, a["at"] >> 16 & 0xFF
                        rows.append((a["fp"], a["sh"], a["sk"], a["shard"], a["sub"], count, raw[begin : begin + count + window - 1]))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=[*_CLASS, "shard", "sub", "n", "seg"])

    return run


_FOUND = "kind int, fp long, sh long, sk long, sub int, key binary, place int, stop int"


def _search_shard(window: int):
    """Per shard: kind 0 rows are runs (place to stop) of strings that repeat in it; kind 1 rows are, for anchor hashes
    that are dealt over several shards, its distinct strings (key) in the order of the suffix array."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        texts, counts = group["seg"].to_list(), group["n"].to_numpy(np.int64)
        starts, hit, order, common = repeated_in_shard(texts, counts, window)
        classes, subs = list(zip(*(group[c].to_list() for c in _CLASS))), group["sub"].to_numpy()
        rows = [(0, *c, u, None, x, y) for c, u, at, n in zip(classes, subs, starts, counts) for x, y in _runs(hit[at : at + n])]
        if (subs >= 0).any():
            owner = np.full(len(hit), -1)  # the segment whose string starts at a place, if its anchor hash is dealt
            for i in np.flatnonzero(subs >= 0):
                owner[starts[i] : starts[i] + counts[i]] = i
            lead = order[(common[order] < window) & (owner[order] >= 0)]  # the first of each run of equal strings
            for at, i in zip(lead.tolist(), owner[lead].tolist()):
                p = at - int(starts[i])
                rows.append((1, *classes[i], subs[i], texts[i][p : p + window], p, p))
        return pd.DataFrame(rows, columns=["kind", *_CLASS, "sub", "key", "place", "stop"])

    return run


def _merge_shards(window: int):
    """Strings that are in more than one shard of an anchor hash: each shard's suffixes are a sorted run, which is looked up in
    those merged so far by binary search."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # all keys have `window` bytes, so that comparing them as fixed strings is exact
        keys, sub = np.array(group["key"].to_list(), f"S{window}"), group["sub"].to_numpy()
        hit = np.zeros(len(keys), bool)
        merged, owner = keys[:0], np.empty(0, np.int64)
        for s in np.unique(sub):
            own = np.flatnonzero(sub == s)
            own = own[np.argsort(keys[own], kind="stable")]
            mine = keys[own]
            at = np.searchsorted(merged, mine)
            same = np.zeros(len(mine), bool)
            inside = at < len(merged)
            same[inside] = merged[at[inside]] == mine[inside]
            hit[own[same]] = True
            hit[owner[at[same]]] = True
            merged, owner = np.insert(merged, at[~same], mine[~same]), np.insert(owner, at[~same], own[~same])
        return group.loc[hit, [*_CLASS, "place", "stop"]].drop_duplicates()

    return run


def _apply(window: int):
    """Removed bytes of texts, from the strings that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, t0, t1, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                gone: list[list[int]] = []
                for begin, last, tag in sorted((r["begin"], r["last"], r["tag"]) for r in runs):
                    if tag != t1 & 0xFFFF:
                        continue
                    if gone and begin <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], last + window)
                    else:
                        gone.append([begin, last + window])
                kept, at = [], 0
                for b, e in gone:
                    kept.append(raw[at:b])
                    at = e
                kept.append(raw[at:])
                rest = b"".join(kept)
                rows.append((t0, t1, len(raw) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), [x for pair in gone for x in pair]))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())))], names=["t0", "t1", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of each removed run).

    A byte is removed if a string of `window` bytes that covers it starts at another place too, in the same text or any
    other. Null texts count as empty; texts under `window` bytes keep everything. Repeated rows count as copies, so
    that each is removed whole, whatever their ids, which may be null. Other columns, whatever their names, are not
    read; an empty table gives no rows; very long texts are hashed in overlapping pieces. The result is a staged table;
    what else is written goes with the call. window may be 2 * K to 255 + K, for a segment has at most 255 strings.
    """
    if not 2 * K <= window <= 255 + K - 1:
        raise ValueError("window out of reach")
    parts = shuffle_partitions(docs.sparkSession)
    work = Workspace(docs.sparkSession, "texts")
    digest = F.sha2("text", 256)
    half = lambda i: F.conv(F.substring(digest, 1 + 16 * i, 15), 16, 10).cast("long")
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(docs[text_col]).alias("text"))
    keyed = base.select("id", "text", half(0).alias("t0"), half(1).alias("t1"), F.octet_length("text").cast("long").alias("n"))
    copies = keyed.where(F.col("n") >= window).groupBy("t0", "t1").agg(F.count(F.lit(1)).alias("m"), F.first("text").alias("text"))
    # equal texts once, in buckets of their digest: later joins with them move no text
    texts = work.saved(copies.select("t0", "t1", F.least("m", F.lit(2)).alias("heavy"), "text"), "t0", parts)
    columns = texts.select("text", "heavy", "t0", "t1")
    # counts are written before they are joined, so that the join sees plain exchanges, of which AQE splits hot ones
    often = work.staged(columns.select("text", "heavy").mapInArrow(_weights(window), "fp long, w long").groupBy("fp").agg(F.sum("w").alias("c")).where("c > 1").select("fp"), "often")
    described = columns.mapInArrow(_described(window), "fp long, sh long, sk long, t0 long, at long")
    places = work.staged(described.join(often, "fp", "left_semi"), "places")
    alike = work.staged(places.groupBy(*_CLASS).agg(F.sum(F.lit(1) + F.shiftright("at", 24).bitwiseAND(1)).alias("c"), F.min(F.struct("t0", "at")).alias("rep")), "alike")
    variants = work.staged(alike.groupBy("fp").agg(F.count(F.lit(1)).alias("v")).where("v > 1"), "variants")
    total = variants.agg(F.coalesce(F.sum("v"), F.lit(0))).first()[0]
    shards = max(1, -(-total // (SHARD // 2)))
    sub = F.when(F.col("v") > SHARD, F.pmod(F.xxhash64("sh"), F.ceil(F.col("v") / SHARD)).cast("int")).otherwise(-1)
    asked = alike.join(variants, "fp").withColumn("sub", sub).withColumn("shard", F.when(F.col("sub") < 0, F.pmod(F.xxhash64("fp"), F.lit(shards))).otherwise(-1 - F.pmod(F.xxhash64("fp", "sub"), F.lit(1 << 40))))
    by_text = asked.groupBy(F.col("rep.t0").alias("t0")).agg(F.collect_list(F.struct(*_CLASS, "shard", "sub", F.col("rep.at").alias("at"))).alias("asked"))
    fetched = texts.join(by_text, "t0").select("text", "t1", "asked").mapInArrow(_fetch(window), "fp long, sh long, sk long, shard long, sub int, n int, seg binary")
    found = work.staged(fetched.groupBy("shard").applyInPandas(_search_shard(window), _FOUND), "found")
    keys = found.where("kind = 1")
    merges = max(1, -(-keys.count() // MERGE))
    merged = keys.withColumn("part", F.pmod(F.xxhash64("fp", "key"), F.lit(merges))).groupBy("fp", "part").applyInPandas(_merge_shards(window), "fp long, sh long, sk long, place int, stop int")
    whole = alike.where("c > 1").select(*_CLASS, F.lit(0).alias("place"), (F.shiftright("rep.at", 16).bitwiseAND(0xFF) - 1).cast("int").alias("stop"))
    runs = found.where("kind = 0").select(*_CLASS, "place", "stop").unionByName(merged).unionByName(whole)
    begin = F.shiftright("at", 25)
    hits = places.where(F.shiftright("at", 24).bitwiseAND(1) == 0).join(runs, _CLASS)
    per_text = hits.groupBy("t0").agg(F.collect_list(F.struct((begin + F.col("place")).alias("begin"), (begin + F.col("stop")).alias("last"), F.col("at").bitwiseAND(0xFFFF).alias("tag"))).alias("runs"))
    removed = texts.where("heavy = 1").join(per_text, "t0").select("text", "t0", "t1", "runs").mapInArrow(_apply(window), "t0 long, t1 long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
    copied = texts.where("heavy = 2").select("t0", "t1", F.lit(True).alias("copied"))
    marks = removed.withColumn("copied", F.lit(False)).unionByName(copied, allowMissingColumns=True)
    out = keyed.select("id", "t0", "t1", "n", digest.alias("sha")).join(marks, ["t0", "t1"], "left")
    gone = F.coalesce("copied", F.lit(False))
    out = out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(gone, F.array(F.lit(0).cast("long"), F.col("n"))).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans"),
    )
    return work.finished(out)


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, from repeated_spans(), whose cases hold."""
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


#: Every string of 200 bytes as 400 hexadecimal digits; for small tables.
OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400),
k AS (SELECT w.r, w.i, md5_number(h[2 * i + 1:2 * i + 400]) AS key FROM w JOIN d USING (r)),
often AS (SELECT key FROM k GROUP BY key HAVING count(*) > 1),
hit AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS new FROM k SEMI JOIN often USING (key)),
run AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM hit),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY r, g),
gap AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM span),
cut AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(h[2 * before + 1:2 * a], '' ORDER BY a) AS head, max(b) AS till FROM gap JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN cut.r IS NULL THEN h ELSE head || h[2 * till + 1:] END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

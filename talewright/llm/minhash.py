"""MinHash near-duplicate classes with odd sketches.

Texts with the same shingle set are one class. Bands of minima put classes into buckets; each class of a bucket is
held against the bucket's smallest. The minima are also folded into a parity bitmap (odd sketch), whose XOR with
another's counts the minima that differ; pairs whose count is out of reach for the threshold go, the rest are held
against each other on their full sets. Buckets whose classes are then still in several components are settled, those
with the same smallest class at once: members of different components are held against each other, sketches first, so
that no link is lost because a bucket's smallest class was not like the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, give_back, join_hot, kept_by_worker, maybe_broadcast, modest_batches, shuffle_partitions, staged, table, text_or_empty
from .components import components

#: Bands of minima: a pair at similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 40 = 1e-7.
BANDS, ROWS = 40, 5
#: Bits of an odd sketch, and differing bits up to which a pair is verified. At similarity 0.8 the count is 69 with
#: a deviation of 10, so that a true pair is lost here with probability below 1e-10.
SKETCH_BITS, SKETCH_LIMIT = 512, 140
#: Members of a tile, and members that are verified against one representative at a time.
TILE, MEMBERS = 256, 512
#: Comparisons of sketches that a task makes, about, and those it holds at once.
COMPARED, PAIRS = 100_000_000, 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RANDOM = np.random.default_rng(20240607)
_FACTORS = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; of a text with fewer words, its one sequence."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    known = kept_by_worker("word hashes", _WordHashes)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    total = np.full(len(words) - k + 1, 0x9E3779B97F4A7C15 * k % (1 << 64), np.uint64)
    for i in range(k):
        total = _mix(total * _PLACES[0] + hashes[i : len(words) - k + 1 + i])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of BANDS * ROWS hash functions over a set that is not empty."""
    out = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(out, (shingles[at : at + 512][None, :] * _FACTORS[:, None]).min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, each taken together with the function that gave it, as 64-bit words."""
    bits = _mix(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in samples.reshape(BANDS, ROWS).T:
        key = _mix(key * _PLACES[1] + column)
    return key.view(np.int64)


_SIGNED = "id {kind}, cls binary, n long, bands array<long>, odd array<long>"


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """A row per row of docs(id, text): class digest (null for an empty set), set size, band keys, odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, sizes, bands, odd = [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), width)
                sizes.append(len(found))
                if len(found):
                    samples = minima(found)
                    cls.append(xxhash.xxh3_128_digest(found.tobytes()))
                    bands.append(band_keys(samples))
                    odd.append(odd_sketch(samples))
                else:
                    cls.append(None)
                    bands.append(None)
                    odd.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))], names=["id", "cls", "n", "bands", "odd"])
        give_back()

    return docs.mapInArrow(run, _SIGNED.format(kind=docs.schema["id"].dataType.simpleString()))


def _with_sets(wanted: DataFrame, docs: DataFrame, reps: DataFrame, width: int, work: Workspace, name: str) -> DataFrame:
    """`wanted` (c, ...) with the full set of class c as `s`, made again from the text of the class's smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            found = [shingle_set(text.as_py(), width) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], names=["c", "cls", "s"])
        give_back()

    needed = work.staged(wanted.select("c").distinct(), name)
    texts = docs.join(maybe_broadcast(needed.withColumnRenamed("c", "id")), "id").dropDuplicates(["id", "text"])
    sets = texts.mapInArrow(run, f"c {docs.schema['id'].dataType.simpleString()}, cls binary, s binary")
    sets = sets.join(reps.select("c", "cls").join(needed, "c"), ["c", "cls"], "left_semi").select("c", "s")
    return wanted.join(sets, "c")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify_stars(pairs: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int, work: Workspace) -> DataFrame:
    """The pairs (c, rep) whose full sets are alike. A representative's set goes once to each group of its members."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("c"), F.greatest(F.lit(1), F.ceil(F.col("m") / MEMBERS))))
    wanted = dealt.select("c", "rep", "part").unionByName(dealt.select(F.col("rep").alias("c"), "rep", "part").distinct())

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rep = group["rep"].iloc[0]
        sets = {c: np.frombuffer(s, np.uint64) for c, s in zip(group["c"], group["s"])}
        linked = [c for c, s in sets.items() if c != rep and rep in sets and _similar(s, sets[rep], percent)]
        return pd.DataFrame({"u": pd.Series(linked, dtype=group["c"].dtype), "v": pd.Series([rep] * len(linked), dtype=group["c"].dtype)})

    kind = docs.schema["id"].dataType.simpleString()
    return _with_sets(wanted, docs, reps, width, work, "starred").groupBy("rep", "part").applyInPandas(run, f"u {kind}, v {kind}")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which every sketch of a differs from every one of b."""
    a, b = a.view(np.uint64), b.view(np.uint64)  # of signed numbers numpy counts the bits of the absolute value
    out = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None, :])
    return out


def _open_pairs(x: pd.DataFrame, y: pd.DataFrame, percent: int) -> np.ndarray:
    """Whether each member of x may be alike to each of y: other component, sizes in reach, sketches in reach."""
    n, m = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None, :]
    apart = x["root"].to_numpy()[:, None] != y["root"].to_numpy()[None, :]
    near = apart & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    if not near.any():
        return near
    return near & (_differing(np.stack(x["odd"].to_list()), np.stack(y["odd"].to_list())) <= SKETCH_LIMIT)


def _open_stars(members: DataFrame, work: Workspace) -> DataFrame:
    """Members (key, c, root, first) of the stars of buckets (key, rep, c, root) with more than one component; the new key is the
    star's. Buckets with the same smallest class are settled as one, so that near texts, which share many of a text's bands,
    stand there once and not once for each band."""
    members = work.staged(members, "rooted")
    several = members.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("key")
    stars = members.join(several, "key", "left_semi").select("rep", "c", "root").distinct()
    return work.staged(stars.select(F.xxhash64("rep").alias("key"), "c", "root", (F.col("c") == F.col("rep")).alias("first")), "members")


def _tiles(members: DataFrame, work: Workspace) -> tuple[DataFrame, int]:
    """Members (key, c, root) of stars with more than one component, dealt into tiles of about TILE members by a hash, a row
    for each pair of tiles (ta <= tb) that a member is in; and about how many comparisons that makes.

    A bucket of up to TILE members is one tile. In a larger one the largest component has tiles of its own, which are
    paired with the others' only: where few members stand apart, the rows grow with the bucket, not with its square.
    Of buckets with the same members one is kept.
    """
    mark = lambda seed: F.bit_xor(F.xxhash64("c", F.lit(seed)))
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), mark(1).alias("m1"), mark(2).alias("m2"))
    buckets = parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("size"), F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2")).where("size > most")
    buckets = buckets.groupBy("size", "m1", "m2").agg(F.min_by(F.struct("key", "main", "most"), "key").alias("b")).select("b.*", "size")
    whole = F.col("size") <= TILE
    tiles = lambda n: F.ceil(n / TILE).cast("int")
    buckets = work.staged(buckets.select("key", "main", F.when(whole, 1).otherwise(tiles(F.col("size") - F.col("most"))).alias("rest"), F.when(whole, 0).otherwise(tiles(F.col("most"))).alias("own"), (F.col("size") * (F.col("size") - F.col("most"))).alias("compared")), "buckets")
    main = (F.col("root") == F.col("main")) & (F.col("own") > 0)
    place = lambda n: F.pmod(F.xxhash64("c"), n).cast("int")
    dealt = members.join(maybe_broadcast(buckets.drop("compared")), "key").withColumn("t", F.when(main, F.col("rest") + place(F.col("own"))).otherwise(place(F.col("rest"))))
    others = F.sequence(F.lit(0), F.when(main, F.col("rest")).otherwise(F.col("rest") + F.col("own")) - 1)
    out = dealt.withColumn("o", F.explode(others)).withColumn("ta", F.least("t", "o")).withColumn("tb", F.greatest("t", "o")).drop("main", "rest", "own", "o")
    return out, buckets.agg(F.coalesce(F.sum(F.col("compared").cast("double")), F.lit(0.0))).first()[0]


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that do not cut a group, with where each group begins, and the end."""
    held: list[pa.RecordBatch] = []

    def begins(of: pa.Table) -> np.ndarray:
        new = np.zeros(len(of), bool)
        new[:1] = True
        for k in keys:
            values = of[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            of = pa.Table.from_batches(held)
            at = begins(of)
            if len(at) > 1:
                yield of.slice(0, int(at[-1])), at
                held = of.slice(int(at[-1])).to_batches()
    if held and sum(map(len, held)):
        of = pa.Table.from_batches(held)
        at = begins(of)
        yield of, np.append(at, len(of))


def _near_rows(of: pa.Table, at: np.ndarray, percent: int) -> np.ndarray:
    """Rows whose class may be alike to another's of its group: other component, other side, sizes and sketches in reach. Pairs
    with a bucket's smallest class have been decided."""
    root, n, t, first = (of[c].to_numpy() for c in ("root", "n", "t", "first"))
    odd = of["odd"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(of), -1)
    across = of["ta"].to_numpy() != of["tb"].to_numpy()
    until = np.repeat(at[1:], np.diff(at))
    count = np.where(first, 0, until - 1 - np.arange(len(of)))
    hit = np.zeros(len(of), bool)
    total = np.concatenate([[0], np.cumsum(count)])
    row = 0
    while row < len(of):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS, side="right")) - 1)
        each = count[row:stop]
        i = np.repeat(np.arange(row, stop), each)
        j = np.arange(len(i)) - np.repeat(total[row:stop] - total[row], each) + i + 1
        open_ = (root[i] != root[j]) & ~first[j] & (~across[i] | (t[i] != t[j])) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j = i[open_], j[open_]
        near = np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64) <= SKETCH_LIMIT
        hit[i[near]] = hit[j[near]] = True
        row = stop
    return hit


def _verify_rest(members: DataFrame, sketch: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int, work: Workspace) -> DataFrame:
    """Links between components within the same bucket; members has key, c, root, first (whether c is the bucket's smallest)."""
    kind = docs.schema["id"].dataType.simpleString()
    keys = ["key", "ta", "tb"]
    columns = ["c", *keys, "t", "root", "n", "odd"]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, at in _whole_groups(batches, keys):
            hit = _near_rows(of, at, percent)
            some = of.select(columns).filter(pa.array(hit))
            # what is near in a tile is marked, so that what another bucket shows as well is verified once
            marks = []
            for a, b in zip(at, at[1:]):
                if k := int(hit[a:b].sum()):
                    own = of.slice(a, b - a).filter(pa.array(hit[a:b]))
                    side = [f"{c}:{int(t == ta)}" for c, t, ta in zip(*(own[x].to_pylist() for x in ("c", "t", "ta")))]
                    marks += [xxhash.xxh3_128_digest("\n".join(sorted(side)).encode())] * k
            yield from some.append_column("mark", pa.array(marks, pa.binary())).to_batches()
        give_back()

    def link(group: pd.DataFrame) -> pd.DataFrame:
        ta, tb = group["ta"].iloc[0], group["tb"].iloc[0]
        x, y = group[group["t"] == ta], group[group["t"] == tb]
        xs, ys = ([np.frombuffer(s, np.uint64) for s in side["s"]] for side in (x, y))
        i, j = np.nonzero(_open_pairs(x, y, percent))
        count = _differing(np.stack(x["odd"].to_list()), np.stack(y["odd"].to_list()))[i, j] if len(i) else np.empty(0)
        root: dict = {}

        def top(r):
            while root.get(r, r) != r:
                r = root[r]
            return r

        links = []
        xr, yr, xc, yc = (s[k].to_numpy() for k in ("root", "c") for s in (x, y))
        for k in np.argsort(count, kind="stable"):
            a, b = top(xr[i[k]]), top(yr[j[k]])
            if a != b and _similar(xs[i[k]], ys[j[k]], percent):
                root[max(a, b)] = min(a, b)
                links.append((xc[i[k]], yc[j[k]]))
        return pd.DataFrame({"u": pd.Series([p[0] for p in links], dtype=group["c"].dtype), "v": pd.Series([p[1] for p in links], dtype=group["c"].dtype)})

    dealt, compared = _tiles(members, work)
    # dealt by comparisons, which AQE does not see
    parts = max(shuffle_partitions(docs.sparkSession), int(compared / COMPARED) + 1)
    tiles = dealt.join(sketch, "c").select(*columns, "first").repartition(parts, *keys).sortWithinPartitions(*keys)
    near = work.staged(tiles.mapInArrow(reach, f"c {kind}, key long, ta int, tb int, t int, root {kind}, n long, odd array<long>, mark binary"), "near")
    if near.isEmpty():
        return docs.sparkSession.createDataFrame([], f"u {kind}, v {kind}")
    once = near.groupBy("mark").agg(F.min(F.struct(*keys)).alias("k")).select("mark", "k.*")
    near = work.staged(near.join(once, ["mark", *keys], "left_semi").drop("mark"), "once")
    return _with_sets(near, docs, reps, width, work, "apart").groupBy(*keys).applyInPandas(link, f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id (smallest id reachable over links), kept.

    Two texts are linked if 100 * intersection >= percent * union of their sets of `width`-word shingles. Null texts
    and texts without words have no shingles and no links. Rows that share an id are one document with several
    texts; of them and of equal texts nothing is lost. Rows without an id are linked with nothing: component_id is
    null, kept true. Other columns, whatever their names, are not read. Ids may be of any type that can be ordered.
    """
    modest_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "near")
    base = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    signed = work.staged(signatures(base, width), "signed")
    known = signed.where("cls IS NOT NULL AND id IS NOT NULL")
    reps = work.staged(known.groupBy("cls").agg(F.min("id").alias("c"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd")), "reps")
    keyed = reps.select("c", F.explode("bands").alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("c").alias("rep"), F.max("c").alias("last")).where("rep != last").select("key", "rep")
    inside = work.staged(keyed.join(firsts, "key"), "inside")
    sketch = reps.select("c", "odd", "n")
    stars = inside.where("c != rep").select("c", "rep").distinct()
    both = stars.join(sketch, "c").join(sketch.select(F.col("c").alias("rep"), F.col("odd").alias("odd2"), F.col("n").alias("n2")), "rep")
    differing = F.aggregate(F.zip_with("odd", "odd2", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    close = work.staged(both.where((differing <= SKETCH_LIMIT) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))).select("c", "rep"), "close")
    close = join_hot(close, work.staged(close.groupBy("rep").agg(F.count(F.lit(1)).alias("m")), "sizes"), "rep", "c")
    links = work.staged(_verify_stars(close, base, reps, width, percent, work), "links")
    first = work.staged(components(links, work).select(F.col("node").alias("c"), "root"), "first")
    members = _open_stars(inside.join(maybe_broadcast(first), "c", "left").select("key", "rep", "c", F.coalesce("root", "c").alias("root")), work)
    more = work.staged(_verify_rest(members, sketch, base, reps, width, percent, work), "more")
    # rows that share an id tie their classes together
    tied = known.select("cls", F.col("id").alias("v")).join(reps.select("cls", F.col("c").alias("u")), "cls").where("u != v").select("u", "v").distinct()
    whole = components(links.unionByName(more).unionByName(tied), work).select(F.col("node").alias("id"), "root")
    out = signed.select("id", "n").join(whole, "id", "left")
    component = F.coalesce("root", "id")
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
    return work.finished(out)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose id is its component's smallest, all their columns kept with their values, whatever their names.

    Rows without an id, and rows with null or empty texts that no other row of their id ties to a group, stay; rows that
    share the kept id all stay; an empty table stays empty.
    """
    gone = staged(near_duplicates(docs, id_col, text_col, width, percent).where("NOT kept").select(id_col).distinct(), "gone")
    return docs.join(maybe_broadcast(gone), id_col, "left_anti").select(*docs.columns)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document: shingles of four words, similarity 0.8; the cases of near_duplicates() hold."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN w = [''] THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS g
  FROM d
), e AS (
  SELECT doc_id, unnest(g) AS t FROM s
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM pair JOIN s p ON p.doc_id = x JOIN s q ON q.doc_id = y WHERE 100 * n >= 80 * (len(p.g) + len(q.g) - n)
), reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), least_of AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(m, s.doc_id) AS kept
FROM s LEFT JOIN least_of ON x = s.doc_id
"""

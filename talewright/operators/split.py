"""Train, validation and test splits that share no speaker."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import small, staged

SPLITS = ("train", "validation", "test")
#: Speakers that are dealt in one order; more are dealt by ranges of their hash, each by the same shares.
IN_ORDER = 1_000_000
#: Speakers up to which order="shuffle" is offered, whose generator needs the list of them.
MAX_SHUFFLED = 100_000


class SplitError(ValueError):
    """The rows cannot be split as asked."""


class LeakageError(ValueError):
    """A speaker is in more than one split."""


def speaker_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("speaker_id").agg(F.count(F.lit(1)).alias("n"))


def hashed_order(speaker: Column, seed: int) -> Column:
    """Key by which speakers are put in a fixed random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), speaker))


class _Dealer:
    """Deals speakers one by one: each goes to the split furthest below its share, the first of equals."""

    def __init__(self, total: int, ratios: tuple[float, float, float]):
        self.goal = [r * total for r in ratios]
        self.size = [0, 0, 0]

    def deal(self, n: int) -> str:
        below = [g - s for g, s in zip(self.goal, self.size)]
        best = below.index(max(below))
        self.size[best] += n
        return SPLITS[best]


def assign(counts: list[tuple[str, int]], ratios: tuple[float, float, float]) -> dict[str, str]:
    """Split of each speaker of a short list, taken in the order given, and repaired as repaired() does."""
    dealer = _Dealer(sum(n for _, n in counts), ratios)
    of = {speaker: dealer.deal(n) for speaker, n in counts}
    sizes = dict(zip(SPLITS, dealer.size))
    numbers = dict(counts)
    for empty in (s for s in SPLITS if not sizes[s]):
        donor = _donor(sizes, empty)
        moved = next(sp for sp, _ in counts if of[sp] == donor)
        of[moved] = empty
        sizes[donor] -= numbers[moved]
        sizes[empty] += numbers[moved]
    _check(sizes)
    return of


def _donor(sizes: dict[str, int], empty: str) -> str:
    """The fullest split but `empty`, the first of equals."""
    best = max((s for s in SPLITS if s != empty), key=lambda s: sizes[s])
    if not sizes[best]:
        raise SplitError("too few speakers for splits that are not empty")
    return best


def _check(sizes: dict[str, int]) -> None:
    if not all(sizes.values()):
        raise SplitError("a split ended up empty; change the ratios or add speakers")


def dealt_speakers(counts: DataFrame, ratios: tuple[float, float, float], in_order: int = IN_ORDER) -> DataFrame:
    """(speaker_id, n, key, split) of a staged table (speaker_id, n, key): speakers are dealt in the order of their keys. Sorted
    rows run through executors in batches and only three sizes are kept, so no list of speakers is held anywhere; above
    `in_order` speakers, ranges of their hash are dealt side by side."""
    ranges = max(1, -(-counts.count() // in_order))
    parted = counts.withColumn("part", F.pmod(F.xxhash64("speaker_id"), F.lit(ranges)).cast("int"))
    totals = small(staged(parted.groupBy("part").agg(F.sum("n").alias("total")), "totals"))
    ordered = parted.join(totals, "part").select("speaker_id", "n", "key", "part", "total").repartition(ranges, "part").sortWithinPartitions("part", "key", "speaker_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, dealer = None, None
        for batch in batches:
            splits = []
            for n, own, total in zip(*(batch.column(c).to_pylist() for c in ("n", "part", "total"))):
                if own != part:
                    part, dealer = own, _Dealer(total, ratios)
                splits.append(dealer.deal(n))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("speaker_id", "n", "key")), pa.array(splits, pa.string())], names=["speaker_id", "n", "key", "split"])

    return ordered.mapInArrow(run, f"speaker_id string, n long, key {counts.schema['key'].dataType.simpleString()}, split string")


def repaired(dealt: DataFrame) -> DataFrame:
    """A staged table (speaker_id, n, key, split) in which an empty split has got the first speaker of the fullest other one."""
    sizes = dict.fromkeys(SPLITS, 0) | {r["split"]: r["n"] for r in dealt.groupBy("split").agg(F.sum("n").alias("n")).collect()}
    for empty in (s for s in SPLITS if not sizes[s]):
        donor = _donor(sizes, empty)
        moved = dealt.where(F.col("split") == donor).orderBy("key", "speaker_id").first()
        dealt = dealt.withColumn("split", F.when(F.col("speaker_id") == moved["speaker_id"], empty).otherwise(F.col("split")))
        sizes[donor] -= moved["n"]
        sizes[empty] += moved["n"]
    _check(sizes)
    return dealt


def split_by_speaker(entries: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, order: str = "md5") -> DataFrame:
    """`entries` with a `split` column. Speakers, not utterances, are dealt by their counts in a fixed order: "md5" of seed and
    id, or "shuffle" by Python's generator over the sorted ids, for up to MAX_SHUFFLED speakers.

    Fewer than three speakers, ratios that do not sum to 1, or an empty split are errors.
    """
    if abs(sum(ratios) - 1.0) > 1e-6:
        raise SplitError(f"ratios must sum to 1, got {ratios}")
    if order not in ("md5", "shuffle"):
        raise SplitError(f"no such order: {order}")
    counts = speaker_counts(entries)
    if order == "shuffle":
        known = counts.orderBy("speaker_id").limit(MAX_SHUFFLED + 1).collect()
        if len(known) > MAX_SHUFFLED:
            raise SplitError(f"order=shuffle takes up to {MAX_SHUFFLED} speakers; use md5")
        rows = [tuple(r) for r in known]
        random.Random(seed).shuffle(rows)
        counts = entries.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rows)], "speaker_id string, n long, key long")
    else:
        counts = counts.select("speaker_id", "n", hashed_order(F.col("speaker_id"), seed).alias("key"))
    counts = staged(counts, "speakers")
    if (have := counts.limit(3).count()) < 3:
        raise SplitError(f"three splits need three speakers, got {have}")
    dealt = repaired(staged(dealt_speakers(counts, ratios), "dealt"))
    return entries.join(small(dealt.select("speaker_id", "split")), "speaker_id")


def placed(df: DataFrame, key: str, place: str = "place") -> DataFrame:
    """A staged table with each row's place (from 1) in the order of `key`, without a single task that sees all rows: rows are
    sorted by ranges, and a range's places begin behind those of the ranges before it."""
    ranged = staged(df.orderBy(key).withColumn("_i", F.monotonically_increasing_id()), "ranged")
    part, within = F.shiftright("_i", 33), F.col("_i").bitwiseAND((1 << 33) - 1)
    sizes = staged(ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    # one row for each range, as many as there are shuffle partitions
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy(F.col("a._part").alias("_part")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return ranged.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(place, (F.col("_before") + within + 1).cast("long")).drop("_part", "_before", "_i")


def leaks(entries: DataFrame) -> DataFrame:
    """(speaker_id, splits) of speakers that are in more than one split."""
    return entries.groupBy("speaker_id").agg(F.array_sort(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)


def pairwise_leaks(entries: DataFrame) -> DataFrame:
    """(pair, speakers): sorted speakers that two splits share, for each pair that shares any."""
    of = {s: entries.where(F.col("split") == s).select("speaker_id").distinct() for s in SPLITS}
    out = None
    for a, b in ((0, 1), (0, 2), (1, 2)):
        both = of[SPLITS[a]].intersect(of[SPLITS[b]]).agg(F.array_sort(F.collect_list("speaker_id")).alias("speakers")).where(F.size("speakers") > 0).select(F.lit(f"{SPLITS[a]}/{SPLITS[b]}").alias("pair"), "speakers")
        out = both if out is None else out.unionByName(both)
    return out


def assert_no_leakage(entries: DataFrame) -> None:
    found = leaks(entries).orderBy("speaker_id").limit(20).collect()
    if found:
        raise LeakageError("; ".join(f"{r['speaker_id']} in {', '.join(r['splits'])}" for r in found))

"""Edit distances and alignments of token arrays.

Totals are native: the distinct tokens of a pair become single characters and the built-in distance counts them.
Alignments with their operations run in an Arrow UDF, which takes pairs of like size together, diagonal by diagonal.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .types import array, of, struct

#: Cells of the tables of pairs that are aligned together, and such pairs at most.
CELLS, TOGETHER = 1 << 22, 4096
#: Tokens of pairs that are Python's own at once.
AT_ONCE = 1 << 17
#: Distinct tokens of a pair up to which the native distance is used.
ALPHABET = 2048
ALIGNMENT = struct(substitutions="int", deletions="int", insertions="int", ref_len="int", hyp_len="int", pairs=array(struct(ref="string", hyp="string")))


def _letters() -> Column:
    return F.array(*(F.lit(chr(0x4E00 + i)) for i in range(ALPHABET)))


def _as_text(tokens: Column, known: Column, letters: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.get(letters, F.array_position(known, t).cast("int") - 1)), "")


def word_errors(ref: Column, hyp: Column) -> Column:
    """Substitutions, deletions and insertions together; null for pairs of more than ALPHABET distinct tokens."""
    letters = _letters()
    # bound as a lambda's variable: else the distinct tokens are gathered again for each token
    found = F.transform(F.array(F.array_distinct(F.concat(ref, hyp))), lambda known: F.when(F.size(known) <= ALPHABET, F.levenshtein(_as_text(ref, known, letters), _as_text(hyp, known, letters))))
    return F.get(found, F.lit(0))


def char_errors(ref: Column, hyp: Column) -> Column:
    """Edit distance in code points."""
    return F.levenshtein(ref, hyp)


def rate(errors: Column, length: Column) -> Column:
    """Errors over length, over 1 where that is 0."""
    return errors / F.greatest(length, F.lit(1))


def _diagonals(ref: np.ndarray, hyp: np.ndarray) -> list[np.ndarray]:
    """Operation of every cell for rows of token numbers, by diagonal i + j, two bits each: 0 deletion, 1 insertion,
    2 substitution, 3 match.

    Equal tokens are matched; among equally cheap operations a deletion goes before an insertion and that before a
    substitution. Each cell is one number, cost * 4 + operation, so that the least number decides both.
    """
    rows, n = ref.shape
    m = hyp.shape[1]
    back = hyp[:, ::-1]
    out = []
    before, last = np.zeros((rows, n + 1), np.int32), np.zeros((rows, n + 1), np.int32)
    for d in range(n + m + 1):
        low, high = max(0, d - m), min(n, d)
        now = np.empty((rows, n + 1), np.int32)
        if low == 0:
            now[:, 0] = 4 * d + 1
        if high == d:
            now[:, d] = 4 * d
        a, b = max(low, 1), min(high, d - 1) + 1  # cells with a reference and a hypothesis token
        if a < b:
            corner = before[:, a - 1 : b - 1] | 3
            best = np.minimum(np.minimum((last[:, a - 1 : b - 1] | 3) + 1, (last[:, a:b] | 3) + 2), corner + 3)
            now[:, a:b] = np.where(ref[:, a - 1 : b - 1] == back[:, m - d + a : m - d + b], corner, best)
        own = np.zeros((rows, -(-(high - low + 1) // 4) * 4), np.uint8)
        own[:, : high - low + 1] = now[:, low : high + 1] & 3
        out.append(own[:, ::4] | own[:, 1::4] << 2 | own[:, 2::4] << 4 | own[:, 3::4] << 6)
        before, last = last, now
    return out


def _trace(ref: np.ndarray, hyp: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(counts of the four operations of each row, (row, i, j) of the substitutions from the end to the begin)."""
    found, width = _diagonals(ref, hyp), hyp.shape[1]
    i, j = n.copy(), m.copy()
    counts, changed = np.zeros((len(n), 4), np.int64), []
    for d in range(len(found) - 1, 0, -1):
        row = np.flatnonzero(i + j == d)
        if not len(row):
            continue
        at = i[row] - max(0, d - width)
        operation = found[d][row, at >> 2] >> (2 * (at & 3)).astype(np.uint8) & 3
        np.add.at(counts, (row, operation), 1)
        if len(own := row[operation == 2]):
            changed.append(np.stack([own, i[own] - 1, j[own] - 1]))
        i[row] -= operation != 1
        j[row] -= operation != 0
        found[d] = found[0]  # nothing reads it again
    return counts, changed


def align_pairs(refs: list[list[str]], hyps: list[list[str]]) -> list[tuple[int, int, int, list[tuple[str, str]]]]:
    """(substitutions, deletions, insertions, substituted pairs) of a least-cost alignment of each pair. Memory for a pair is
    a quarter of a byte for each cell of its table."""
    number: dict[str, int] = {}
    coded = [[np.fromiter((number.setdefault(t, len(number)) for t in s), np.int32, len(s)) for s in side] for side in (refs, hyps)]
    sizes = np.array([[len(r), len(h)] for r, h in zip(refs, hyps)]).reshape(-1, 2)
    out: list = [None] * len(refs)
    order = np.lexsort((sizes[:, 1], sizes[:, 0]))
    at = 0
    while at < len(order):
        stop, most = at + 1, sizes[order[at]].copy()
        while stop < len(order) and stop - at < TOGETHER:
            grown = np.maximum(most, sizes[order[stop]])
            if (stop + 1 - at) * int((grown + 1).prod()) > CELLS:
                break
            most, stop = grown, stop + 1
        own = order[at:stop]
        tables = []
        for side, length in zip(coded, most.tolist()):
            table = np.full((len(own), length), -1 - len(tables), np.int32)  # what fills up is equal to nothing
            for k, i in enumerate(own):
                table[k, : len(side[i])] = side[i]
            tables.append(table)
        counts, changed = _trace(*tables, sizes[own, 0], sizes[own, 1])
        pairs: list[list[tuple[str, str]]] = [[] for _ in own]
        for step in reversed(changed):
            for k, i, j in zip(*step.tolist()):
                pairs[k].append((refs[own[k]][i], hyps[own[k]][j]))
        for k, i in enumerate(own.tolist()):
            out[i] = (int(counts[k, 2]), int(counts[k, 0]), int(counts[k, 1]), pairs[k])
        at = stop
    return out


def align_tokens(ref: list[str], hyp: list[str]) -> tuple[int, int, int, list[tuple[str, str]]]:
    """align_pairs() of one pair."""
    return align_pairs([ref], [hyp])[0]


def _lists(tokens: pd.Series) -> list[list[str]]:
    return [list(t) if t is not None else [] for t in tokens]


def _give_back() -> None:
    """Return what a batch took, or a worker that lives on keeps the most that it ever had."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not everywhere
        ctypes.CDLL(None).malloc_trim(0)


def _slices(ref: pa.Array, hyp: pa.Array) -> Iterator[tuple[int, int]]:
    """(begin, number) of rows that hold about AT_ONCE tokens together."""
    tokens = np.zeros(len(ref) + 1, np.int64)
    for side in (ref, hyp):
        tokens[1:] += np.cumsum(pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ref):
        stop = max(at + 1, int(np.searchsorted(tokens, tokens[at] + AT_ONCE, "right")) - 1)
        yield at, stop - at
        at = stop


def _aligned(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    refs, hyps = ([t or [] for t in side.to_pylist()] for side in (ref, hyp))
    found = align_pairs(refs, hyps)
    changed = [p for f in found for p in f[3]]
    text = lambda k: pa.array([p[k] for p in changed], pa.string())
    pairs = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(f[3]) for f in found)]), pa.int32()), pa.StructArray.from_arrays([text(0), text(1)], ["ref", "hyp"]))
    counts = [pa.array(c, pa.int32()) for c in ([f[0] for f in found], [f[1] for f in found], [f[2] for f in found], [len(r) for r in refs], [len(h) for h in hyps])]
    return pa.StructArray.from_arrays([*counts, pairs], ["substitutions", "deletions", "insertions", "ref_len", "hyp_len", "pairs"])


@F.arrow_udf(ALIGNMENT)
def align(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    """The alignment of each pair; a null side counts as empty. Some tokens at a time become Python's, whatever a batch holds."""
    out = [_aligned(ref.slice(at, n), hyp.slice(at, n)) for at, n in _slices(ref, hyp)] or [_aligned(ref, hyp)]
    _give_back()
    return pa.concat_arrays(out)


@F.pandas_udf(of("int"))
def _wide_errors(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Errors of the pairs that are not null."""
    there = [i for i, (r, h) in enumerate(zip(ref, hyp)) if r is not None and h is not None]
    found = align_pairs(_lists(ref.iloc[there]), _lists(hyp.iloc[there]))
    out = pd.Series([None] * len(ref), dtype="Int32")
    out.iloc[there] = [s + d + i for s, d, i, _ in found]
    return out


def with_errors(df: DataFrame, ref: str, hyp: str, out: str = "word_errors") -> DataFrame:
    """df with the word errors of two token columns, natively where it can be, else from alignments, in one pass. Every row
    stays; a null side gives null."""
    wide = F.size(F.array_distinct(F.concat(ref, hyp))) > ALPHABET
    return df.withColumn(out, F.coalesce(word_errors(F.col(ref), F.col(hyp)), _wide_errors(F.when(wide, F.col(ref)), F.when(wide, F.col(hyp)))))

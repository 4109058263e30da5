"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts the gap-weighted three-letter subsequences within a short span that they share, so that
a word keeps most of its likeness when characters are put between its letters. A sentence is as toxic as its most toxic
word, its witness, and the kernel of two sentences is that of their witnesses. The machine is trained on sentences: all
of a clean text's are negative, of a toxic text those are positive that the round before found toxic, the most toxic
one at least (multiple-instance training). Landmark kernels and weights fold into one table over subsequences, which
makes scoring a word a sum of look-ups.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, kept_by_worker, modest_batches, table, text_or_empty

#: Labelled rows of each class that a fit takes at most, lowest hash of the id first, and characters of all of them at which
#: it takes no more.
MAX_TRAIN, MAX_CHARS = 2000, 64 << 20
LANDMARKS = 256
#: Letters that a subsequence may span, and what each letter beyond three costs.
SPAN, DECAY = 6, 0.6
#: 0: ASCII that is no letter, which widens gaps and makes no feature; 1-26: a-z; 27-62: other characters; 63: a word's start.
_LETTERS, _OTHERS = 64, 36
_CODES = _LETTERS**3
_PATTERNS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
#: z-value of a word's share among toxic texts from which it is a landmark and shows the first round its sentences.
EVIDENCE = 5.0
#: Decisions below this are all alike.
DOUBT = -0.75
#: Clean words among which landmarks are taken: those most like the toxic landmarks.
NEAR = 4000
#: Rounds of training; the decision from which a further sentence of a toxic text is positive; clean sentences of a round: a
#: hashed sample, and those that the round before found most toxic.
ROUNDS, MARGIN, SAMPLED, HARDEST = 3, 0.5, 3000, 1500
#: Words that a worker remembers before it starts anew, and texts' characters that it takes at once.
MEMO, AT_ONCE = 100_000, 1 << 20
#: Words whose subsequences are held at once.
WORDS_AT_ONCE = 8192
_THREE = re.compile(r"[^\x00-\x60\x7b-\x7f].*[^\x00-\x60\x7b-\x7f].*[^\x00-\x60\x7b-\x7f]")
_SENTENCE = re.compile(r"[.!?]+(?:\s+|$)|\n+")
_SPELLED = re.compile(r"(?<!\S)\S(?:[^\S\n]\S){2,}(?!\S)")
_MIX = [int(x) for x in np.random.default_rng(5).integers(1 << 8, 1 << 28, 24)]
_TO_LETTER = np.zeros(128, np.int64)
_TO_LETTER[97:123] = np.arange(1, 27)
_TO_LETTER[1] = 63


def words_of(text: str) -> set[str]:
    """Distinct lower-case words; letters that stand alone in a row also make one word."""
    text = text.lower()
    words = set(text.replace("\x01", " ").split())
    for run in _SPELLED.findall(text):
        words.add("".join(run.split()))
    return words


def sentences_of(text: str) -> list[list[str]]:
    """Distinct words of each sentence or line that has any."""
    return [sorted(w) for w in map(words_of, _SENTENCE.split(text)) if w]


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(index of the word, code of the subsequence, weight) of all subsequences of letters, pattern by pattern."""
    raw = np.frombuffer(("\x01" + "\x01".join(words)).encode("utf-32-le", "surrogatepass"), np.uint32) if words else np.array([], np.uint32)
    letters = np.where(raw < 128, _TO_LETTER[np.minimum(raw, 127)], 27 + raw % _OTHERS).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = letters * _LETTERS**2
    second = letters * _LETTERS
    for a, b in _PATTERNS:
        n = len(letters) - b
        if n <= 0:
            continue
        good = (owner[:n] == owner[b:]) & (letters[:n] > 0) & (letters[a : a + n] > 0) & (letters[b:] > 0)
        at = np.flatnonzero(good)
        yield owner[at], first[at] + second[at + a] + letters[at + b], DECAY ** (b - 2)


def self_kernel(words: list[str]) -> np.ndarray:
    """Square root of each word's kernel with itself, 1 where it has no subsequence."""
    found = list(subsequences(words))
    if not found:
        return np.ones(len(words))
    key = np.concatenate([o * _CODES + c for o, c, _ in found])
    weight = np.concatenate([np.full(len(o), w) for o, _, w in found])
    keys, inverse = np.unique(key, return_inverse=True)
    total = np.bincount(inverse, weight, len(keys))
    norm = np.sqrt(np.bincount(keys // _CODES, total**2, len(words)))
    return np.where(norm > 0, norm, 1.0)


@dataclass(frozen=True)
class Landmarks:
    """Normalised subsequence features of some words; only codes that any of them has take a column."""

    words: list[str]
    column: np.ndarray  # of each code; the last column is empty
    values: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> Landmarks:
        found = list(subsequences(words))
        codes = np.unique(np.concatenate([c for _, c, _ in found])) if found else np.empty(0, np.int64)
        column = np.full(_CODES, len(codes), np.int32)
        column[codes] = np.arange(len(codes))
        values = np.zeros((len(words), len(codes) + 1), np.float32)
        for o, c, w in found:
            np.add.at(values, (o, column[c]), w)
        return cls(words, column, values / self_kernel(words)[:, None].astype(np.float32))

    def table(self, weights: np.ndarray) -> np.ndarray:
        """Weighted sum of the landmarks' features, as a table over all codes."""
        return (weights @ self.values)[self.column].astype(float)


def kernel(words: list[str], landmarks: Landmarks) -> np.ndarray:
    """Normalised kernel of words with landmarks."""
    out = np.zeros((len(words), len(landmarks.words)), np.float32)
    by_code = np.ascontiguousarray(landmarks.values.T)
    for at in range(0, len(words), 500):
        part = words[at : at + 500]
        for o, c, w in subsequences(part):
            if len(o):
                starts = np.flatnonzero(np.diff(o, prepend=-1))
                out[at + o[starts]] += np.float32(w) * np.add.reduceat(by_code[landmarks.column[c]], starts)
        out[at : at + 500] /= self_kernel(part)[:, None]
    return out.astype(float)


def _portions(words: list[str]) -> Iterator[list[str]]:
    return (words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE))


def weights_of(words: list[str], beta: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Decisions on words, without the bias; `norms` from self_kernel()."""
    dots = []
    for part in _portions(words):
        dot = np.zeros(len(part))
        for o, c, w in subsequences(part):
            dot += w * np.bincount(o, beta[c], len(part))
        dots.append(dot)
    return np.concatenate(dots) / norms if dots else np.empty(0)


def folded(words: list[str], beta: np.ndarray, bias: float) -> np.ndarray:
    """Decisions on words as sentences of their own; -1 for all below DOUBT. The exact self-kernel is taken only where its lower
    bound leaves more than that."""
    found = []
    for part in _portions(words):
        dot, least = np.zeros(len(part)), np.zeros(len(part))
        for o, c, w in subsequences(part):
            dot += w * np.bincount(o, beta[c], len(part))
            least += w * w * np.bincount(o, minlength=len(part))
        out = np.full(len(part), -1.0)
        if len(near := np.flatnonzero((dot > 0) & (dot / np.sqrt(np.maximum(least, 1e-12)) + bias > DOUBT))):
            exact = dot[near] / self_kernel([part[i] for i in near]) + bias
            out[near] = np.where(exact > DOUBT, exact, -1.0)
        found.append(out)
    return np.concatenate(found) if found else np.empty(0)


@dataclass(frozen=True)
class Model:
    """Table of subsequence weights, bias, and the logistic weights of a text's evidence."""

    beta: np.ndarray
    bias: float
    link: tuple[float, ...]

    def decisions(self, words: list[str]) -> np.ndarray:
        return folded(words, self.beta, self.bias)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(np.hstack([evidence, np.ones((len(evidence), 1))]) @ np.array(self.link), -30, 30)))


def evidence(decisions: list[float]) -> tuple[float, float, float]:
    """Of a text's distinct words: the highest decision, the sum of those above 0, and how many words there are."""
    return max(decisions, default=-1.0), math.log1p(sum(d for d in decisions if d > 0)), math.log1p(len(decisions))


NOTHING = Model(np.zeros(_CODES), -1.0, (0.0, 0.0, 0.0, -30.0))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Linear support vector machine, squared hinge, by gradient descent with momentum."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / weight.sum()
    step = 1.0 / (1.0 / cost + 2 * np.linalg.norm((x1 * weight[:, None]).T @ x1, 2))
    w = v = np.zeros(x1.shape[1])
    for k in range(rounds):
        z = w + k / (k + 3) * (w - v)
        slack = np.maximum(0, 1 - y * (x1 @ z))
        v, w = w, z - step * (np.append(z[:-1], 0) / (cost * 100) - 2 * x1.T @ (weight * y * slack))
    return w[:-1], float(w[-1])


def _unlike(bags: list[list[str]]) -> list[int]:
    """Places of the bags of words without near copies of earlier ones, which would count one author's words many times over."""
    seen: set[tuple[int, ...]] = set()
    kept: list[int] = []
    for i, words in enumerate(bags):
        raw = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
        bands = set()
        for b in range(12 if len(raw) >= 20 else 0):
            mixed = raw * np.uint64(2 * _MIX[b] + 1) + np.uint64(_MIX[b + 12]) & np.uint64(0xFFFFFFFF)
            bands.add((b, *map(int, np.sort(mixed)[:5])))
        if not bands & seen:
            kept.append(i)
        seen |= bands
    return kept


class _Sentences:
    """Sentences of some texts as lists of word numbers, one behind another."""

    def __init__(self, texts: list[list[list[str]]], number: dict[str, int]):
        self.sizes = np.array([len(s) for t in texts for s in t])
        self.flat = np.fromiter((number[w] for t in texts for s in t for w in s), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])

    def witnesses(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(decision, word) of each sentence: its most toxic word, of equals the one with the lowest number."""
        own = weights[self.flat]
        score = np.maximum.reduceat(own, self.starts)
        word = np.where(own == np.repeat(score, self.sizes), self.flat, len(weights))
        return score, np.minimum.reduceat(word, self.starts)

    def positive(self, score: np.ndarray, least: float) -> np.ndarray:
        """The sentence of each text with the highest decision, and all others above `least`."""
        order = np.lexsort((-np.arange(len(score)), score, self.text))
        return np.union1d(order[np.flatnonzero(np.diff(self.text[order], append=-1))], np.flatnonzero(score > least))


def train(texts: list[list[list[str]]], toxic: list[int], share: float | None = None, landmarks: int = LANDMARKS) -> Model:
    """Fit on labelled texts, given as sentences of distinct words; `share` of the texts are toxic where they come from. Near
    copies of earlier texts are left out. Two thirds of the texts train the machine, the rest the weight of a text's
    evidence. Without both classes the model scores everything 0."""
    bags = [sorted(set().union(*t)) for t in texts]
    kept = _unlike(bags)
    learn, rest = [i for k, i in enumerate(kept) if k % 3], kept[::3]
    if len({toxic[i] for i in rest}) < 2:
        learn = rest = kept
    of = {y: [i for i in learn if toxic[i] == y and texts[i]] for y in (0, 1)}
    if not of[0] or not of[1]:
        return NOTHING
    df = {y: Counter(w for i in of[y] for w in bags[i]) for y in (0, 1)}
    n1, n0 = len(of[1]), len(of[0])

    def contrast(w: str) -> float:
        p, q, both = df[1][w] / n1, df[0][w] / n0, (df[1][w] + df[0][w] + 1) / (n1 + n0)
        return (p - q) / (both * (1 - min(both, 0.99)) * (1 / n1 + 1 / n0)) ** 0.5

    z = {w: contrast(w) for w in df[1] if _THREE.search(w)}
    ranked = sorted(z, key=lambda w: (-z[w], w))
    least = EVIDENCE if n1 >= 100 else 0.7 * EVIDENCE
    top = [w for w in ranked if z[w] > least] or ranked[:1]
    pool = sorted(w for w in df[0] if z.get(w, 0) <= least and _THREE.search(w))
    if not top or not pool:
        return NOTHING
    # landmarks: the words of most contrast, and clean words that are most like them
    toxic_marks = Landmarks.of(top[: landmarks // 2])
    near = [pool[i] for i in np.argsort(-folded(pool, toxic_marks.table(np.ones(len(toxic_marks.words))), 0.0), kind="stable")[:NEAR]]
    marks = Landmarks.of(toxic_marks.words + near[:: max(1, len(near) // (landmarks // 2))][: landmarks // 2])
    value, vector = np.linalg.eigh(kernel(marks.words, marks))
    whiten = vector[:, value > 1e-4] / np.sqrt(value[value > 1e-4])
    words = sorted({*df[0], *df[1]})
    number = {w: i for i, w in enumerate(words)}
    norms = np.concatenate([self_kernel(part) for part in _portions(words)])
    toxic_ones, clean_ones = (_Sentences([texts[i] for i in of[y]], number) for y in (1, 0))
    sampled = np.argsort(np.arange(len(clean_ones.starts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")[:SAMPLED]
    weights, bias = np.zeros(len(words)), -least
    weights[[number[w] for w in top]] = [z[w] for w in top]
    for _ in range(ROUNDS):
        score, witness = toxic_ones.witnesses(weights)
        positive = witness[toxic_ones.positive(score, MARGIN - bias)]
        score, witness = clean_ones.witnesses(weights)
        negative = witness[np.union1d(sampled, np.argsort(-score, kind="stable")[:HARDEST])]
        # sentences with one witness are one row, whose weight grows with the square root of their number
        rows, count, y = [], [], []
        for own, label in ((positive, 1.0), (negative, -1.0)):
            known, n = np.unique(own, return_counts=True)
            rows.append(known)
            count.append(np.sqrt(n) / np.sqrt(n).sum())
            y.append(np.full(len(known), label))
        x = kernel([words[i] for i in np.concatenate(rows)], marks) @ whiten
        theta, bias = _svm(x, np.concatenate(y), np.concatenate(count))
        beta = marks.table(whiten @ theta)
        weights = weights_of(words, beta, norms)
    known = sorted(set().union(*(bags[i] for i in rest)))
    decision = dict(zip(known, folded(known, beta, bias).tolist()))
    found = np.array([evidence([decision[w] for w in bags[i]]) for i in rest])
    y = np.array([toxic[i] for i in rest], float)
    share = y.mean() if share is None else share
    return Model(beta, bias, _logistic(found, y, np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression with a slight ridge, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-1] * (x.shape[1] - 1) + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ w)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return tuple(map(float, w))


def held_out(id_col) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Train on at most `max_train` rows of each class, none of them held out, lowest hash of the id first, until they have
    MAX_CHARS characters.

    Labels without a value, of unknown documents or with null ids are left out, an id that is labelled or stored twice
    counts once, null texts count as empty, near copies of texts taken earlier are left out, and each round of
    training sees SAMPLED + HARDEST clean sentences (found among all of the sample). Without rows of both classes, as
    with empty tables, the model scores everything 0. Other columns, whatever their names, are not read.
    """
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_y")).where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id")).dropDuplicates(["_id"])
    share = known.agg(F.avg("_y")).first()[0]
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_train)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = chosen.collect()  # at most 2 * max_train ids and labels
    if not rows:
        return train([], [])
    ids = docs.sparkSession.createDataFrame(rows, chosen.schema)
    sample = docs.select(F.col(id_col).alias("_id"), text_or_empty(docs[text_col]).alias("_text")).join(F.broadcast(ids), "_id")
    found: list[tuple] = []
    same: dict[str, str] = {}
    size = 0
    for r in sample.select("_y", "_id", "_text").dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").toLocalIterator():
        if size >= MAX_CHARS:
            break
        size += len(r["_text"])
        # each word is held once
        found.append((r["_id"], r["_y"], [[same.setdefault(w, w) for w in s] for s in sentences_of(r["_text"])]))
    del same
    found.sort(key=lambda x: x[0])
    texts, toxic = [x[2] for x in found], [x[1] for x in found]
    del found
    return train(texts, toxic, share)


class Scorer:
    """Probabilities of texts, a few millions of characters at a time; remembers the decisions of words."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def _evidence(self, group: list[set[str]]) -> list[tuple[float, float, float]]:
        words = set().union(*group)
        fresh = list(words.difference(self.memo))
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
            fresh = list(words)
        self.memo.update(zip(fresh, self.model.decisions(fresh).tolist()))
        return [evidence([*map(self.memo.__getitem__, own)]) for own in group]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        found: list[tuple[float, float, float]] = []
        group: list[set[str]] = []
        size = 0
        for text in texts:
            text = text.as_py() or ""
            group.append(words_of(text))
            size += len(text)
            if size >= AT_ONCE:
                found += self._evidence(group)
                group, size = [], 0
        found += self._evidence(group) if group else []
        return self.model.probability(np.array(found, float).reshape(-1, 3))


def _scorer_of(model: Model) -> Scorer:
    return kept_by_worker(("toxicity", zlib.crc32(model.beta.tobytes()), model.bias, model.link), lambda: Scorer(model))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, score (0 to 1), predicted (1 from 0.5).

    Only the text is an input. Null, empty and letterless texts get the score of a text without evidence. Repeated
    rows and null or repeated ids give a row each; other columns, whatever their names, are not read. Texts are read
    whole; no shuffle.
    """
    modest_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a table of _CODES numbers
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(sent.value)
        for batch in batches:
            p = scorer(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], names=["id", "score", "predicted"])
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not predicted toxic, all columns kept; the cases of score() hold."""
    modest_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(sent.value)
        for batch in batches:
            yield batch.filter(pa.array(scorer(batch.column(at)) < 0.5, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document; the cases of fit() and score() hold."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")

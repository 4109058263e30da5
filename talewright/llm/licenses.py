"""License scan by template markup.

Templates of whole licences and notices carry optional regions (`[[ ... ]]`) and replaceable ones (`<name:n>`, one to n
words). They compile to token automata; a text is accepted where its words run through an automaton to the end, so
the mandatory wording has to match exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .license_texts import TEMPLATES

#: Phrase and label of the base search.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Byte classes of the contract's words: A-Z lower-cased, ASCII that is neither letter nor digit is a separator.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def tokens_of(template: str) -> Iterator[str | int | bytes]:
    """Marks of a template: "[[", "]]", the most words of a replaceable region, or a word."""
    for part in re.split(r"(\[\[|\]\]|<\w+:\d+>)", template):
        if part in ("[[", "]]"):
            yield part
        elif re.fullmatch(r"<\w+:\d+>", part):
            yield int(part[1:-1].split(":")[1])
        else:
            yield from words_of(part)


@dataclass(frozen=True)
class Automaton:
    """Position automaton. `steps[s]` lists (word or None for any word, next state); `skips[s]` are empty moves."""

    label: str
    steps: tuple[tuple[tuple[bytes | None, int], ...], ...]
    closure: tuple[frozenset[int], ...]
    final: int
    first: frozenset[bytes] | None  # words that a run begins with; None: any
    mandatory: frozenset[bytes]

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words that starts at `at`, or -1."""
        now, end = self.closure[0], -1
        while now:
            if self.final in now:
                end = at
            if at >= len(words):
                break
            word = words[at]
            now = frozenset().union(*(self.closure[t] for s in now for w, t in self.steps[s] if w is None or w == word))
            at += 1
        return end


def compile_template(label: str, template: str) -> Automaton:
    """Build the automaton; a region may hold others. A template must not be accepted without a literal word."""
    steps: list[list[tuple[bytes | None, int]]] = [[]]
    skips: list[set[int]] = [set()]
    opened: list[int] = []
    mandatory: set[bytes] = set()

    def state() -> int:
        steps.append([])
        skips.append(set())
        return len(steps) - 1

    here = 0
    for token in tokens_of(template):
        if token == "[[":
            opened.append(here)
        elif token == "]]":
            skips[opened.pop()].add(here)
        elif isinstance(token, int):
            before = None
            for _ in range(token):
                there = state()
                steps[here].append((None, there))
                if before is not None:
                    skips[before].add(there)
                here = before = there
        else:
            there = state()
            steps[here].append((token, there))
            here = there
            if not opened:
                mandatory.add(token)
    if opened or not mandatory:
        raise ValueError(f"template {label}: unclosed region or no mandatory word")

    def reach(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in skips[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return frozenset(seen)

    closure = tuple(reach(s) for s in range(len(steps)))
    begins = {w for s in closure[0] for w, _ in steps[s]}
    first = None if None in begins else frozenset(begins)
    return Automaton(label, tuple(map(tuple, steps)), closure, here, first, frozenset(mandatory))


def base_places(words: list[bytes], phrases) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand consecutively."""
    found = []
    for parts, label in phrases:
        at = -1
        try:
            while True:
                at = words.index(parts[0], at + 1)
                if words[at : at + len(parts)] == parts:
                    found.append((at, label))
        except ValueError:
            pass
    return found


def template_places(words: list[bytes], automata) -> list[tuple[int, int, str]]:
    """(start, end, label) of the longest accepted runs, leftmost first and without overlap for each template."""
    found, have = [], set(words)
    for a in automata:
        if not a.mandatory <= have:
            continue
        at = 0
        while at < len(words):
            if (a.first is None or words[at] in a.first) and (end := a.longest(words, at)) > at:
                found.append((at, end, a.label))
                at = end
            else:
                at += 1
    return found


_OUT = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.string())])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Null and empty texts have no words: counts 0, places null, labels '', score 0. Repeated rows and repeated or
    null ids give a row each; other columns of `docs`, whatever their names, are not read. Texts are read whole, a
    batch of rows at a time. score: 0 without a label, 0.5 with base labels only, otherwise 1 less half the share
    of base places that no template covers. spans: start:end:label of accepted runs, in words.
    """
    parts = [([w.encode() for w in p.split()], label) for p, label in phrases]
    automata = [compile_template(*t) for t in templates]
    hints = {p[0] for p, _ in parts} | {min(a.mandatory, key=lambda w: (-len(w), w)) for a in automata}
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                if hints.isdisjoint(words):
                    rows.append((len(words), 0, None, None, "", "", 0.0, ""))
                    continue
                base, runs = base_places(words, parts), sorted(template_places(words, automata))
                labels = {label for _, label in base}
                score = 0.0
                if runs:
                    bare = sum(not any(s <= at < e for s, e, _ in runs) for at, _ in base)
                    score = 1.0 - 0.5 * bare / max(len(base), 1)
                elif base:
                    score = 0.5
                rows.append((len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted(labels)), ",".join(sorted(labels | {r[2] for r in runs})), score, ",".join(f"{s}:{e}:{k}" for s, e, k in runs)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(_OUT), _OUT.types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *_OUT.names])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string")
    return out.withColumnRenamed("id", id_col)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, from scan_licenses(), whose cases hold."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def pattern_of(template: str) -> str:
    """The template as a regular expression over words in angle brackets."""
    out = []
    for token in tokens_of(template):
        out.append("(?:" if token == "[[" else ")?" if token == "]]" else f"(?:<[^>]*>){{1,{token}}}" if isinstance(token, int) else f"<{token.decode()}>")
    return "".join(out)


_PHRASE_LIST = ", ".join(f"{{'p': {p.split()!r}, 'k': '{k}'}}" for p, k in PHRASES)
_TEMPLATE_LIST = ", ".join(f"{{'k': '{k}', 'rx': '{pattern_of(t)}', 'must': {sorted(w.decode() for w in compile_template(k, t).mandatory)!r}}}" for k, t in TEMPLATES)
_COUNTED = "length({0}) - length(replace({0}, '<', ''))"
OP1_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), phrases AS (SELECT unnest([{_PHRASE_LIST}], recursive := true)), templates AS (SELECT unnest([{_TEMPLATE_LIST}], recursive := true)
), base AS (
  SELECT r, k, unnest(list_filter(range(len(w) - len(p) + 1), lambda i: w[i + 1:i + len(p)] = p)) AS pos FROM d, phrases WHERE list_has_all(w, p)
), cut AS (
  SELECT r, k, regexp_extract_all(s, rx) AS m, string_split_regex(s, rx) AS b
  FROM (SELECT r, k, rx, '<' || array_to_string(w, '><') || '>' AS s FROM d, templates WHERE list_has_all(w, must))
), each AS (
  SELECT r, k, unnest(range(1, len(m) + 1)) AS i, unnest(list_transform(m, lambda x: {_COUNTED.format('x')})) AS n, unnest(list_transform(b[1:len(m)], lambda x: {_COUNTED.format('x')})) AS gap FROM cut WHERE len(m) > 0
), runs AS (
  SELECT r, k, sum(n + gap) OVER (PARTITION BY r, k ORDER BY i)::BIGINT AS e, n FROM each
), spans AS (
  SELECT r, k, e - n AS s, e FROM runs
), covered AS (
  SELECT base.r, base.k, base.pos, bool_or(coalesce(spans.s <= base.pos AND base.pos < spans.e, false)) AS inside FROM base LEFT JOIN spans ON spans.r = base.r GROUP BY ALL
), b AS (
  SELECT r, count(*) AS n_base, min(pos)::BIGINT AS first_word, max(pos)::BIGINT AS last_word, string_agg(DISTINCT k, ',' ORDER BY k) AS base_labels, list(DISTINCT k) AS ks, count(*) FILTER (NOT inside) AS bare FROM covered GROUP BY r
), t AS (
  SELECT r, list(DISTINCT k) AS ks, string_agg(s || ':' || e || ':' || k, ',' ORDER BY s, e, k) AS spans FROM spans GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(b.ks, []) || coalesce(t.ks, []))), ',') AS labels,
       CASE WHEN t.r IS NOT NULL THEN 1.0 - 0.5 * coalesce(bare, 0) / greatest(coalesce(n_base, 0), 1) WHEN b.r IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE AS score, coalesce(t.spans, '') AS spans
FROM d LEFT JOIN b USING (r) LEFT JOIN t USING (r)
"""

"""Scalar text functions: normal form, tokens, paths. All native but for NFKC."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import of


@F.pandas_udf(of("string"))
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def normalize(text: Column, with_nfkc: bool = True) -> Column:
    """Form in which transcripts are compared: NFKC, lower case, hyphens deleted, all but letters, digits and the
    underscore to spaces, single spaces, trimmed. Null gives ''. with_nfkc=False stays in the JVM, for text that is NFKC already."""
    text = F.coalesce(text, F.lit(""))
    lower = F.replace(F.lower(nfkc(text) if with_nfkc else text), F.lit("-"), F.lit(""))
    return F.trim(F.regexp_replace(F.regexp_replace(lower, r"(?U)[^\p{L}\p{N}_\s]", " "), r"(?U)\s+", " "))


def tokens_of(normal: Column) -> Column:
    """Tokens of a normalised text; none of ''."""
    return F.filter(F.split(normal, " "), lambda t: t != "")


def tokenize(text: Column, with_nfkc: bool = True) -> Column:
    return tokens_of(normalize(text, with_nfkc))


def characters(normal: Column) -> Column:
    """The text that character errors are counted on."""
    return F.replace(normal, F.lit(" "), F.lit(""))


def extension(path: Column) -> Column:
    """Lower-case extension with its dot, '' without one; a leading dot of a name begins none."""
    return F.lower(F.regexp_extract(path, r"[^./](\.[^./]+)$", 1))


def canonical_target(path: Column, root: Column | str, out_dir: str) -> Column:
    """<out_dir>/<path relative to root, extension replaced by .wav>."""
    root = F.lit(root) if isinstance(root, str) else root
    relative = F.when(F.startswith(path, root), F.substring(path, F.length(root) + 1, F.length(path))).otherwise(path)
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), F.regexp_replace(F.regexp_replace(relative, "^/+", ""), r"(?<=[^./])\.[^./]+$", ""), F.lit(".wav"))


def join_segments(segments: Column) -> Column:
    """Texts of array<struct<..., text>>, trimmed, empty ones left out, joined by spaces."""
    return F.array_join(F.filter(F.transform(segments, lambda s: F.trim(s["text"])), lambda t: t != ""), " ")


def milliseconds(seconds: Column) -> Column:
    """Whole milliseconds, cut off."""
    return (seconds * 1000).cast("long")


def dotted(extensions: list[str]) -> list[str]:
    return sorted({e.lower() if e.startswith(".") else "." + e.lower() for e in extensions})


def has_any_prefix(value: Column, prefixes: list[str]) -> Column:
    found = F.lit(False)
    for p in prefixes:
        found = found | F.startswith(F.lower(value), F.lit(p.lower()))
    return found


def drop_private(columns: list[str], private: tuple[str, ...] = ("audio", "file", "content", "data")) -> list[str]:
    """Column names that may be logged."""
    return [c for c in columns if c not in private]

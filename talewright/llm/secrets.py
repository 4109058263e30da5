"""Secret scan: three fixed patterns and a randomness test battery, all in DataFrame functions.

A candidate is a long run of key characters. Its encoding is inferred, and its symbols are held against a uniform
independent source: chi-squared over the alphabet, a runs test about the alphabet's middle and a lag-1 serial
correlation. Each is an equivalence test: the null hypothesis is that the string departs from that source at least as
far as structured ones do, so a small p-value says that it is random. The largest of the three goes through
Benjamini-Hochberg over the candidates of a text, weighted by length; what the procedure rejects is a secret, so its
rate bounds the share of structured strings among the secrets of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table, text_or_empty

#: Kinds in their order, pattern, group that is measured, least length of that group.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: What a text must hold for a kind to be searched at all; it follows from the pattern and the length.
HINTS = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}
#: A candidate of the battery: 20 or more key characters, a capital letter or a digit among them.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[a-z+/_-]*[A-Z0-9])[A-Za-z0-9+/_-]{20,}"
#: Share of structured strings among what is reported (the false-discovery rate).
FDR = 0.05
#: Encodings in the order in which they are tried: name, pattern, alphabet, size, and the least excess of the symbols' squared
#: shares over the uniform source's (times the size, less 1) that a structured string has: decimal numbers in hex,
#: dictionary words in the others. Decimal numbers alone are never secrets.
ENCODINGS = (
    ("hex", "^[0-9a-fA-F]+$", "0123456789abcdef", 16, 0.6),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32, 1.0),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", "abcdefghijklmnopqrstuvwxyz0123456789", 36, 1.0),
    ("base64", None, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 64, 1.4),
)
#: Least departure of structured strings in share of changes about the alphabet's middle (0.5 at random) and in
#: serial correlation (0 at random).
CHANGES, CORRELATION = 0.12, 0.7
SPAN = "array<struct<start:long,ord:int,end:long,kind:string>>"
#: Values that a running total takes at once, and code points of a piece of text.
BLOCK, PIECE = 256, 1024


def _normal_cdf(z: Column) -> Column:
    """Logistic form of the normal distribution function, within 2e-4."""
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine) -> Column:
    """combine() of each value and all before it, for an array of longs that are not negative. Blocks are folded one by one,
    so that no long array is copied for each of its elements."""
    state = F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<long>").alias("out"))
    outer = F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<array<long>>").alias("out"))
    grown = lambda s, v: F.struct(v.alias("last"), F.concat(s["out"], F.array(v)).alias("out"))

    def folded(v: Column) -> Column:
        def block(acc: Column, i: Column) -> Column:
            begun = F.struct(acc["last"].alias("last"), state["out"].alias("out"))
            inner = F.aggregate(F.slice(v, i * BLOCK + 1, BLOCK), begun, lambda s, x: _let(combine(s["last"], x), lambda y: grown(s, y)))
            return _let(inner, lambda r: F.struct(r["last"].alias("last"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.when(F.size(v) == 0, F.array().cast("array<long>")).otherwise(F.flatten(F.aggregate(blocks, outer, block, lambda acc: acc["out"])))

    return _let(values, folded)


def _matches(text: Column, kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    """array<struct<span, token>> of all leftmost non-overlapping matches whose measured group is long enough; spans are in code
    points. The parts between the matches give the places: match i ends after i + 1 parts and as many matches."""
    found, measured, between = (F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.split(text, pattern, -1))
    long = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("long")

    def placed(rows: Column) -> Column:
        ends = _running(F.transform(rows, lambda x: long(x["b"]) + long(x["m"])), lambda a, x: a + x)
        kept = F.filter(F.arrays_zip(rows.alias("r"), ends.alias("e")), lambda x: x["r"]["m"].isNotNull() & (F.length(x["r"]["g"]) >= least))
        span = lambda x: F.struct((x["e"] - long(x["r"]["m"])).alias("start"), F.lit(order).alias("ord"), x["e"].alias("end"), F.lit(kind).alias("kind"))
        return F.transform(kept, lambda x: F.struct(span(x).alias("span"), x["r"]["m"].alias("token")))

    return _let(F.arrays_zip(found.alias("m"), measured.alias("g"), between.alias("b")), placed)


def _cdf(z: Column) -> Column:
    return _let(z, _normal_cdf)


def _pairs(values: Column) -> Column:
    """Neighbours a, b."""
    return F.arrays_zip(F.slice(values, F.lit(1), F.size(values) - 1).alias("a"), F.slice(values, F.lit(2), F.size(values) - 1).alias("b"))


def _chi_p(ranks: Column, k: int, excess: float) -> Column:
    """Probability of a chi-squared statistic as small as this one from a source that exceeds the uniform one over k symbols by
    `excess` (Patnaik's approximation of the non-central distribution, Wilson and Hilferty's of the central one)."""
    n, df = F.size(ranks).cast("double"), float(k - 1)
    squares = _sum(F.transform(F.array_distinct(ranks), lambda r: F.pow(F.size(F.filter(ranks, lambda x: x == r)).cast("double"), F.lit(2.0))))
    far = n * excess
    f = (df + far) * (df + far) / (df + 2 * far)
    z = (F.cbrt(F.greatest(squares * k / n - n, F.lit(0.0)) / (df + far)) - (1 - 2 / (9 * f))) / F.sqrt(2 / (9 * f))
    return _cdf(z)


def _runs_p(ranks: Column, k: int) -> Column:
    """Probability of as many, or as few, changes between the alphabet's halves from a source whose share of changes is
    CHANGES, or 1 - CHANGES; the larger of the two."""
    high = F.transform(ranks, lambda r: r >= k / 2)
    m = F.size(ranks).cast("double") - 1
    spread = F.sqrt(m * CHANGES * (1 - CHANGES))
    changes = F.size(F.filter(_pairs(high), lambda x: x["a"] != x["b"])).cast("double")
    return _let(changes, lambda c: F.greatest(1 - _cdf((c - 0.5 - m * CHANGES) / spread), _cdf((c + 0.5 - m * (1 - CHANGES)) / spread)))


def _serial_p(ranks: Column) -> Column:
    """Probability of a lag-1 serial correlation as near to 0 from a source at CORRELATION (Fisher's transformation)."""
    n = F.size(ranks).cast("double")

    def of(centred: Column) -> Column:
        lagged = _sum(F.transform(_pairs(centred), lambda x: x["a"] * x["b"]))
        variance = _sum(F.transform(centred, lambda x: x * x))
        r = F.least(F.abs(lagged / F.greatest(variance, F.lit(1e-9)) + 1 / n), F.lit(0.999))
        return _let(variance, lambda v: F.when(v <= 0, F.lit(1.0)).otherwise(1 - _cdf((F.atanh(F.lit(CORRELATION)) - F.atanh(r)) * F.sqrt(n - 3))))

    return _let(_sum(ranks) / n, lambda mean: _let(F.transform(ranks, lambda r: r - mean), of))


def battery(token: Column) -> Column:
    """struct<encoding, n, chi_p, runs_p, serial_p, p> of one candidate; p, the largest, is small for random strings only."""
    def measure(name: str, alphabet: str, k: int, excess: float) -> Column:
        symbols = F.split(F.lower(token) if name in ("hex", "base36") else token, "")

        def tests(ranks: Column) -> Column:
            three = F.struct(_chi_p(ranks, k, excess).alias("chi_p"), _runs_p(ranks, k).alias("runs_p"), _serial_p(ranks).alias("serial_p"))
            worst = lambda t: F.when(token.rlike("^[0-9]+$"), F.lit(1.0)).otherwise(F.greatest(t["chi_p"], t["runs_p"], t["serial_p"]))
            return _let(three, lambda t: F.struct(F.lit(name).alias("encoding"), F.size(ranks).cast("double").alias("n"), t["chi_p"].alias("chi_p"), t["runs_p"].alias("runs_p"), t["serial_p"].alias("serial_p"), worst(t).alias("p")))

        # - and _ stand for + and / in the other base64
        return _let(F.transform(symbols, lambda c: (F.instr(F.lit(alphabet), F.translate(c, "-_", "+/")) - 1).cast("double")), tests)

    out = None
    for name, pattern, *rest in ENCODINGS:
        of = measure(name, *rest)
        out = F.when(token.rlike(pattern), of) if out is None else out.when(token.rlike(pattern), of) if pattern else out.otherwise(of)
    return out


def _random_spans(text: Column, order: int) -> Column:
    """Spans of the candidates of a text that the length-weighted step-up procedure finds random."""

    def controlled(tested: Column) -> Column:
        m = F.size(tested)

        def weighed(total: Column) -> Column:
            # longer strings, whose tests have more power, get a weight above 1; weights average 1
            return F.array_sort(F.transform(tested, lambda x: F.struct((x["t"]["p"] * total / (m * x["t"]["n"])).alias("q"), x["span"].alias("span"))))

        def found(ordered: Column) -> Column:
            hits = F.filter(ordered, lambda x, i: x["q"] <= F.lit(FDR) * (i + 1) / m)
            last = F.coalesce(F.array_max(F.transform(hits, lambda x: x["q"])), F.lit(-1.0))
            return F.array_sort(F.transform(_let(last, lambda q: F.filter(ordered, lambda x: x["q"] <= q)), lambda x: x["span"]))

        return _let(_let(_sum(F.transform(tested, lambda x: x["t"]["n"])), weighed), found)

    matches = _matches(text, "random", CANDIDATE, 0, 20, order)
    return _let(F.transform(matches, lambda s: F.struct(s["span"].alias("span"), battery(s["token"]).alias("t"))), controlled)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, in order of their start and then of KINDS; `text` has no nulls."""
    none = F.array().cast(SPAN)
    found = (F.when(text.rlike(HINTS[kind]), F.transform(_matches(text, kind, pattern, group, least, i), lambda x: x["span"])).otherwise(none) for i, (kind, pattern, group, least) in enumerate(KINDS))
    return F.array_sort(F.concat(*found))


def random_spans(text: Column) -> Column:
    """Spans of the kind `random`; `text` has no nulls."""
    return F.when(text.rlike(CANDIDATE), _random_spans(text, len(KINDS))).otherwise(F.array().cast(SPAN))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, base_spans, random_spans (arrays of start, ord, end, kind; start order).

    Null texts count as empty and have no spans; an empty table gives none. Repeated rows and null or repeated ids give a
    row each; other columns, whatever their names, are not read. No shuffle: each text is searched whole where it is
    read, in time that grows with its length.
    """
    df = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text_col]).alias("text"))
    return df.select(F.col("id").alias(id_col), base_spans(F.col("text")).alias("base_spans"), random_spans(F.col("text")).alias("random_spans"))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with the secrets of its texts replaced; `length_col`, if there, is brought in line.

    A null text stays null, a text without secrets and its length stay as they are, repeated rows and null ids stay. All
    other columns keep their values, whatever their names: what is computed goes under a name that is free.
    """
    spans, clean = fresh("spans", docs.columns), fresh("clean", docs.columns)
    df = docs.withColumn(spans, F.array_sort(F.concat(base_spans(text_or_empty(docs[text_col])), random_spans(text_or_empty(docs[text_col])))))
    hit = F.size(df[spans]) > 0
    df = df.withColumn(clean, F.when(hit, redact(df[text_col], df[spans])))
    out = {c: df[c] for c in docs.columns}
    out[text_col] = F.coalesce(df[clean], df[text_col])
    if length_col in out:
        out[length_col] = F.coalesce(F.length(df[clean]).cast(docs.schema[length_col].dataType), df[length_col])
    return df.select(*(v.alias(k) for k, v in out.items()))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with every span replaced by `mark`; spans that overlap or touch become one. Spans must be in start order.

    The text is cut into pieces of PIECE code points, so that a part is found without counting from the text's start.
    """

    def between(pieces: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.floor((F.greatest(b, a + 1) - 1) / PIECE).cast("int") - first + 1), "")
        return F.when(b > a, F.substring(some, (a - first * PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def cut(merged: Column) -> Column:
        def of(pieces: Column) -> Column:
            before = lambda j: F.coalesce(F.get(merged, j - 1)["end"], F.lit(0).cast("long"))
            parts = F.transform(merged, lambda m, j: F.concat(between(pieces, before(j), m["start"]), F.lit(mark)))
            return F.concat(F.array_join(parts, ""), between(pieces, before(F.size(merged)), F.length(text).cast("long")))

        return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), of)

    def merged(own: Column) -> Column:
        def groups(tops: Column) -> Column:
            first = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | (F.get(own, i)["start"] > F.get(tops, i - 1)))
            group = lambda f: F.transform(f, lambda i, j: F.struct(F.get(own, i)["start"].alias("start"), F.get(tops, F.coalesce(F.get(f, j + 1), F.size(own)) - 1).alias("end")))
            return _let(first, group)

        return _let(_running(F.transform(own, lambda s: s["end"]), lambda a, x: F.greatest(a, x)), groups)

    return F.when(F.size(spans) == 0, text).otherwise(_let(spans, lambda own: _let(merged(own), cut)))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, from find_secrets(), whose cases hold; n_random counts the battery's spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base_spans", "random_spans"))).alias("spans"),
        F.size("random_spans").cast("long").alias("n_random"),
    )


def _sql_matches(kind: str, order: int, pattern: str, group: int, least: int, more: str = "true") -> str:
    """DuckDB rows (r, ord, kind, token, s, e) of one kind; `pattern` without look-around."""
    rx = "'" + pattern.replace("'", "''") + "'"
    lists = f"SELECT r, regexp_extract_all(t, {rx}, 0) AS m, regexp_extract_all(t, {rx}, {group}) AS g, string_split_regex(t, {rx}) AS b FROM d"
    each = f"SELECT r, unnest(m) AS m, unnest(g) AS g, unnest(b[1:len(m)]) AS b, unnest(range(1, len(m) + 1)) AS i FROM ({lists}) WHERE len(m) > 0"
    ended = f"SELECT *, (sum(length(b) + length(m)) OVER (PARTITION BY r ORDER BY i))::BIGINT AS e FROM ({each})"
    return f"SELECT r, {order} AS ord, '{kind}' AS kind, m AS token, e - length(m) AS s, e FROM ({ended}) WHERE length(g) >= {least} AND {more}"


def _sql_cdf(z: str) -> str:
    return f"1.0::DOUBLE / (1.0::DOUBLE + exp(-(1.5976::DOUBLE * ({z}) + 0.07056::DOUBLE * pow(({z}), 3))))"


def _either(word: str) -> str:
    """The word in either case of its ASCII letters, for an engine whose folding goes beyond them."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_WHICH = " ".join(f"WHEN regexp_matches(token, '{e[1]}') THEN {i}" if e[1] else f"ELSE {i}" for i, e in enumerate(ENCODINGS))
_FACTS = ", ".join(f"{{'k': {k}::DOUBLE, 'x': {x}::DOUBLE, 'a': '{a}', 'lower': {name in ('hex', 'base36')}}}" for name, _, a, k, x in ENCODINGS)
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_sql_matches('assign', 0, _ASSIGN, 2, 12)} UNION ALL {_sql_matches('access', 1, 'AKIA[A-Z0-9]+', 0, 18)} UNION ALL {_sql_matches('hex', 2, '[0-9a-f]+', 0, 16)}),
cand AS ({_sql_matches('random', 3, '[A-Za-z0-9+/_-]{20,}', 0, 20, "regexp_matches(m, '[A-Z0-9]')")}),
enc AS (SELECT *, [{_FACTS}][(CASE {_WHICH} END) + 1] AS f FROM cand),
sym AS (SELECT *, list_transform(string_split(CASE WHEN f.lower THEN lower(token) ELSE token END, ''), lambda c: (strpos(f.a, translate(c, '-_', '+/')) - 1)::DOUBLE) AS x, length(token)::DOUBLE AS n FROM enc),
stat AS (SELECT *, list_sum(list_transform(list_distinct(x), lambda v: pow(len(list_filter(x, lambda y: y = v)), 2)))::DOUBLE AS squares, list_sum(x) / n AS mean,
  len(list_filter(range(1, len(x)), lambda i: (x[i] >= f.k / 2) <> (x[i + 1] >= f.k / 2)))::DOUBLE AS changes, n * f.x AS far, f.k - 1 AS df FROM sym),
more AS (SELECT *, (df + far) * (df + far) / (df + 2 * far) AS ff, list_sum(list_transform(range(1, len(x)), lambda i: (x[i] - mean) * (x[i + 1] - mean))) AS lagged, list_sum(list_transform(x, lambda v: (v - mean) * (v - mean))) AS variance, n - 1 AS m FROM stat),
zs AS (SELECT *, (cbrt(greatest(squares * f.k / n - n, 0) / (df + far)) - (1 - 2 / (9 * ff))) / sqrt(2 / (9 * ff)) AS z1, (changes - 0.5::DOUBLE - m * {CHANGES}::DOUBLE) / sqrt(m * {CHANGES}::DOUBLE * (1 - {CHANGES}::DOUBLE)) AS z2,
  (changes + 0.5::DOUBLE - m * (1 - {CHANGES}::DOUBLE)) / sqrt(m * {CHANGES}::DOUBLE * (1 - {CHANGES}::DOUBLE)) AS z3, (atanh({CORRELATION}::DOUBLE) - atanh(least(abs(lagged / greatest(variance, 1e-9) + 1 / n), 0.999::DOUBLE))) * sqrt(n - 3) AS z4 FROM more),
ps AS (SELECT *, CASE WHEN regexp_matches(token, '^[0-9]+$') THEN 1.0 ELSE greatest({_sql_cdf('z1')}, greatest(1 - {_sql_cdf('z2')}, {_sql_cdf('z3')}), CASE WHEN variance <= 0 THEN 1.0 ELSE 1 - {_sql_cdf('z4')} END) END AS p FROM zs),
qs AS (SELECT *, p * (sum(n) OVER (PARTITION BY r)) / ((count(*) OVER (PARTITION BY r)) * n) AS q, count(*) OVER (PARTITION BY r) AS c FROM ps),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY q, s) AS place FROM qs),
kept AS (SELECT *, max(CASE WHEN q <= {FDR}::DOUBLE * place / c THEN q END) OVER (PARTITION BY r) AS last FROM ranked),
rnd AS (SELECT r, ord, kind, s, e FROM kept WHERE q <= last),
b AS (SELECT r, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex, string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, ord) AS base FROM base GROUP BY r),
a AS (SELECT r, string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, ord) AS spans, count(*) FILTER (ord = 3) AS n_random FROM (SELECT r, ord, kind, s, e FROM base UNION ALL SELECT * FROM rnd) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_random, 0) AS n_random
FROM d LEFT JOIN b USING (r) LEFT JOIN a USING (r)
"""

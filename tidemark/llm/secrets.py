"""Secrets in texts: plain patterns, and strings that a battery of randomness tests tells from ordinary ones.

Candidates are maximal runs of 20 or more characters of the base64 alphabets. Each one's encoding is inferred from its
characters; strings of one class of characters (only digits, only lower or only upper letters) have none. The null
hypothesis is an ordinary string. Three tests each turn down one kind of it:

- uniformity: the chi-squared statistic against equal shares of the encoding's characters, when two drawn characters
  are equal as often as letters of a language, or twice as often as at random if that is more (a normal approximation of
  the noncentral distribution);
- runs: the number of changes between letters' cases, digits and signs, when they are as frequent as in joined words;
- serial correlation: the lag-one correlation of the characters' places in the alphabet, when it is 0.6 either way.

A candidate's p-value is the largest of the three, so all kinds are turned down at once. Power grows with the length, so
false discoveries are controlled within length bands (each twice as long as the one before) by Benjamini and Hochberg's rule
over all candidates of the corpus. p-values are rounded up to a tenth of a decade, so that a band's ranks are counts of a
bounded table. All steps are DataFrame functions; a text's matches are placed by the lengths of the pieces between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import own_columns, staged, text_or_empty

KINDS = ("assign", "access", "hex", "random")
RANDOM = KINDS.index("random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
VALUE = 6
SHORTEST = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{SHORTEST},}}"
#: Share of false discoveries allowed among the reported candidates of a length band.
FALSE_SHARE = 0.1
#: How often two letters of a language are equal, at least.
EQUAL_LETTERS = 0.05
#: The lag-one correlation that is turned down.
SERIAL = 0.6
#: Steps per decade of the rounded p-values, and the least of them.
STEPS, LEAST = 10, -400
#: Matches whose places are added up together.
BLOCK = 256

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Pattern, alphabet, and how often neighbours in joined words and numbers are of different classes; the first that fits is inferred.
ENCODINGS = (
    ("[0-9]+|[a-z]+|[A-Z]+|[+/]+", None, 0.0),
    ("[0-9a-f]+", _DIGITS + _LOWER[:6], 0.12),
    ("[0-9A-F]+", _DIGITS + _UPPER[:6], 0.12),
    ("[A-Z2-7]+", _UPPER + _DIGITS[2:8], 0.12),
    ("[0-9a-z]+", _DIGITS + _LOWER, 0.12),
    ("[0-9A-Z]+", _DIGITS + _UPPER, 0.12),
    ("[0-9A-Za-z]+", _UPPER + _LOWER + _DIGITS, 0.3),
    (".*", _UPPER + _LOWER + _DIGITS + "+/", 0.4),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(lengths: Column) -> Column:
    """For each length, the sum of those before it; in blocks, as an array that grows is copied at each step."""

    def sums(items: Column, size: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("seen"))
        return F.aggregate(items, start, lambda a, x: F.struct((a["total"] + size(x)).alias("total"), F.concat(a["seen"], F.array(a["total"])).alias("seen")))

    def joined(blocks: Column) -> Column:
        bases = sums(blocks, lambda b: b["total"])["seen"]
        return F.flatten(F.zip_with(blocks, bases, lambda block, base: F.transform(block["seen"], lambda s: s + base)))

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.lit(BLOCK)).cast("int"))
    return _let(F.transform(blocks, lambda b: sums(F.slice(lengths, b * BLOCK + 1, BLOCK), lambda x: x)), joined)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches that do not overlap: start, end (code points) and the text of a group."""

    def placed(parts: Column) -> Column:
        # the piece after the last match is not before one
        pieces = F.zip_with(F.slice(parts["gaps"], 1, F.size(parts["found"])), parts["found"], lambda g, m: F.struct(g.alias("gap"), F.length(m).alias("n")))
        return F.zip_with(_let(pieces, starts), parts["values"] if group else parts["found"], lambda at, v: F.struct(at["start"].alias("start"), at["end"].alias("end"), v.alias("value")))

    def starts(pieces: Column) -> Column:
        before = _let(F.transform(pieces, lambda p: p["gap"] + p["n"]), _before)
        return F.zip_with(before, pieces, lambda b, p: F.struct((b + p["gap"]).alias("start"), (b + p["gap"] + p["n"]).alias("end")))

    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.transform(F.split(text, pattern, -1), F.length).alias("gaps")]
    if group:
        parts.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"))
    spans = _let(F.struct(*parts), placed)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (Abramowitz and Stegun 26.2.17)."""
    weights = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = F.lit(0.0)
    for w in reversed(weights):
        series = (series + F.lit(w)) * t
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _battery(token: Column, alphabet: str, rate: float) -> Column:
    """The largest of the three p-values."""
    k, n = len(alphabet), F.length(token).cast("double")
    letters = F.array(*[F.lit(c) for c in alphabet])
    squares = F.aggregate(letters, F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    statistic = F.lit(float(k)) / n * squares - n
    beyond = (n - 1) * (k * max(EQUAL_LETTERS, 2 / k) - 1)
    uniform = _let((k - 1 + beyond - statistic) / F.sqrt(2.0 * (k - 1) + 4 * beyond), _upper_tail)
    changes = F.regexp_count(token, F.lit("[a-z]+|[A-Z]+|[0-9]+|[+/]+")) - 1
    runs = _let((changes - 0.5 - (n - 1) * rate) / F.sqrt((n - 1) * (rate * (1 - rate))), _upper_tail)

    def sums(x: Column) -> Column:
        # circular: the last character comes before the first
        turned = F.concat(F.slice(x, 2, F.size(x)), F.slice(x, 1, 1))
        pairs = F.zip_with(x, turned, lambda u, v: F.struct(u.alias("u"), v.alias("v")))
        start = F.struct(*[F.lit(0.0).alias(name) for name in ("total", "square", "product")])
        return F.aggregate(pairs, start, lambda s, p: F.struct(
            (s["total"] + p["u"]).alias("total"), (s["square"] + p["u"] * p["u"]).alias("square"), (s["product"] + p["u"] * p["v"]).alias("product")))

    def correlation(s: Column) -> Column:
        spread = n * s["square"] - s["total"] * s["total"]
        return F.when(spread > 0, F.least(F.abs((n * s["product"] - s["total"] * s["total"]) / spread), F.lit(0.999999))).otherwise(F.lit(0.999999))

    def serial(x: Column) -> Column:
        return _let((math.atanh(SERIAL) - F.atanh(_let(sums(x), correlation))) * F.sqrt(n - 3), _upper_tail)

    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
    return F.greatest(uniform, runs, _let(places, serial))


def _step(token: Column) -> Column:
    """The candidate's p-value, rounded up to whole steps of a decade; null if no encoding is inferred."""
    p = None
    for pattern, alphabet, rate in ENCODINGS:
        value = _battery(token, alphabet, rate) if alphabet else F.lit(None).cast("double")
        fits = token.rlike(f"^(?:{pattern})$")
        p = F.when(fits, value) if p is None else p.when(fits, value)
    # greatest() passes over nulls
    return _let(F.ceil(F.log10(p) * STEPS), lambda step: F.when(step.isNotNull(), F.greatest(step, F.lit(LEAST)))).cast("int")


def _band(length: Column) -> Column:
    return F.floor(F.log2(length / F.lit(float(SHORTEST))) + F.lit(1e-9)).cast("int")


def _candidates(text: Column) -> Column:
    """start, end, length band and rounded p-value of the candidates with an encoding."""

    def tested(m: Column) -> Column:
        token = F.translate(m["value"], "-_", "+/")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), _band(m["end"] - m["start"]).alias("band"), _let(token, _step).alias("step"))

    return F.filter(F.transform(_matches(text, CANDIDATE), tested), lambda c: c["step"].isNotNull())


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def discovery_limits(candidates: DataFrame) -> dict[int, int]:
    """For each length band of `candidates` (band, step), the largest step that Benjamini and Hochberg's rule accepts."""
    counts = candidates.groupBy("band", "step").count()
    # at most as many rows in a band as there are steps
    band = Window.partitionBy("band")
    ranked = counts.select("band", "step", F.sum("count").over(band.orderBy("step")).alias("rank"), F.sum("count").over(band).alias("m"))
    passed = ranked.where(F.pow(F.lit(10.0), F.col("step") / F.lit(float(STEPS))) * F.col("m") <= FALSE_SHARE * F.col("rank"))
    return {r.band: r.step for r in passed.groupBy("band").agg(F.max("step").alias("step")).collect()}


def secret_spans(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Null texts are empty; an empty text has no span. A null or repeated doc_id is kept, one result for each row; equal
    texts have equal spans. An empty table gives no rows. Spans are `kind:start:end` in code points, end exclusive, by
    start, then kind. A `random` span may lie in one of the plain kinds, which it confirms.
    """
    text = text_or_empty()
    assigned = F.filter(_matches(text, ASSIGN, 1), lambda m: F.length(m["value"]) >= VALUE)
    found = own_columns(df, "doc_id", "text").select(
        F.col("doc_id"), _spans(assigned, "assign").alias("assign"), _spans(_matches(text, ACCESS), "access").alias("access"),
        _spans(_matches(text, HEX), "hex").alias("hex"), _candidates(text).alias("candidates"))
    found = staged(found, "secrets")
    limits = discovery_limits(found.select(F.explode("candidates").alias("c")).select("c.band", "c.step"))
    chosen = F.filter("candidates", lambda c: _accepted(c, limits))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    every = F.array_sort(F.concat("assign", "access", "hex", _spans(chosen, "random")))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:RANDOM]], F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(every).alias("spans"), F.size(chosen).cast("long").alias("n_random"))


def _accepted(candidate: Column, limits: dict[int, int]) -> Column:
    out = F.lit(False)
    for band, step in sorted(limits.items()):
        out = out | (candidate["band"] == band) & (candidate["step"] <= step)
    return out

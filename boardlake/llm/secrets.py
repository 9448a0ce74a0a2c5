"""Secret scans: patterns for known shapes, and a randomness test battery for the rest.

Runs of ``LEAST`` or more key-like characters are candidates; they end at ``=``, so a value is judged without the name it
is given to. If one is joined by ``/``, ``_`` or ``-``, its parts of that length are tried beside the whole, and what is left
without the words at its ends; so a value joined to a name is judged alone too, and the longest that counts is the
secret. Each is read in the smallest encoding whose alphabet has all its characters. Three tests ask whether it looks uniformly random there: chi-squared over the alphabet,
runs above and below its middle, and lag-one serial correlation. A token that one of them rejects is no random
secret. For the others the evidence against ordinary text is a likelihood ratio: uniform in the encoding against
letters by their frequencies in runs of one class. Its inverse bounds a p-value (Markov), and a step-up over all
tries of the text, weighted by their lengths, controls the share of false discoveries.

Everything is column expressions over one row; nothing is shuffled and no Python runs on executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds, with the least length of what they must hold.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters and more: a shorter run has no longer one inside
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]

LEAST = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST
PART = r"[A-Za-z0-9+]{%d,}={0,2}" % LEAST
# Words and what joins them at the start of a candidate, and at the end of one that is read backwards. Possessive: linear, without a stack.
LEAD = r"^(?:(?:[A-Z]++[a-z]*+|[a-z]++)?+[0-9]{0,2}+[/_-]++)++"
TRAIL = r"^={0,2}+(?:[0-9]{0,2}+(?:[a-z]++[A-Z]?+|[A-Z]++)?+[/_-]++)++"
BATTERY_LEVEL = 0.01
DISCOVERY_RATE = 0.01

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Alphabets from small to large; the pattern tells which tokens an encoding may have written.
ENCODINGS = [
    ("decimal", DIGITS, r"^[0-9]+$"),
    ("hex", DIGITS + "abcdef", r"^[0-9a-f]+$"),
    ("upper hex", DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    ("lower", LOWER, r"^[a-z]+$"),
    ("upper", UPPER, r"^[A-Z]+$"),
    ("base32", UPPER + "234567", r"^[A-Z2-7]+$"),
    ("lower base36", DIGITS + LOWER, r"^[a-z0-9]+$"),
    ("base62", DIGITS + UPPER + LOWER, r"^[A-Za-z0-9]+$"),
    ("base64", UPPER + LOWER + DIGITS + "+/", r"^[A-Za-z0-9+/]+$"),
]
# Letter frequencies of English text in per cent, a to z.
LETTERS = [8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.07]
STAY = 0.95  # chance in text that a character has the class of the one before


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a one-element transform binds it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_ends(lengths: Column, block: int = 256) -> Column:
    """Running sums of an array, in n * block steps however long it is."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def sums(values: Column) -> Column:
        count = F.ceil(F.size(values) / block).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: total(F.slice(values, b * block + 1, block)))
        before = let(blocks, lambda own: F.transform(own, lambda _, b: total(F.slice(own, F.lit(1), b))))

        def end(i: Column, bases: Column) -> Column:
            b = F.floor(i / block).cast("int")
            return F.element_at(bases, b + 1) + total(F.slice(values, b * block + 1, i - b * block + 1))

        return let(before, lambda bases: F.transform(values, lambda _, i: end(i, bases)))

    return let(lengths, sums)


def _matches(text: Column, pattern: str) -> Column:
    """``start``, ``end`` (code points) and ``match`` of all leftmost matches, in order.

    The pattern is tied to the end of the last match and led by the gap, so gaps and matches tile the text.
    """
    tiled = F.lit(rf"(?s)\G(.*?)({pattern})")
    whole, own = F.regexp_extract_all(text, tiled, F.lit(0)), F.regexp_extract_all(text, tiled, F.lit(2))
    ends = running_ends(F.transform(whole, lambda m: F.length(m).cast("bigint")))
    placed = let(own, lambda found: F.transform(ends, lambda e, i: F.struct((e - F.length(F.element_at(found, i + 1))).alias("start"), e.alias("end"), F.element_at(found, i + 1).alias("match"))))
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,match:string>>"))


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m.start.alias("start"), F.lit(kind).alias("kind"), m.end.alias("end")))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal Z, from the usual five-term rational approximation."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    terms = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * terms
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _encoding_fields(token: Column) -> Column:
    """``alphabet`` and ``halves`` (the lower half as 0, the upper as 1) of the smallest fitting encoding."""
    found = None
    for _, alphabet, pattern in ENCODINGS:
        m = len(alphabet) // 2
        fields = F.struct(F.lit(alphabet).alias("alphabet"), F.translate(token, alphabet, "0" * m + "1" * m).alias("halves"))
        found = F.when(F.regexp_like(token, F.lit(pattern)), fields) if found is None else found.when(F.regexp_like(token, F.lit(pattern)), fields)
    return found.otherwise(F.struct(F.lit(ENCODINGS[-1][1]).alias("alphabet"), F.lit("").alias("halves")))


def _changes(text: Column) -> Column:
    """Places where a character differs from the one before."""
    return F.length(F.regexp_replace(text, r"(.)\1+", "$1")) - 1


def _text_log() -> Column:
    """Map from a character to its log frequency among those of its class in text."""
    share = dict(zip(LOWER + UPPER, LETTERS * 2)) | dict.fromkeys(DIGITS, 10.0) | dict.fromkeys("+/", 50.0)
    return F.map_from_arrays(F.array(*map(F.lit, share)), F.array(*[F.lit(math.log(f / 100)) for f in share.values()]))


def battery(token: Column) -> Column:
    """Struct of ``p_random`` (of the three tests, Bonferroni) and ``p_text`` (bound from the likelihood ratio) of a token."""
    clean = F.regexp_replace(F.translate(token, "-_", "+/"), "=", "")

    def scores(t: Column, e: Column) -> Column:
        n, m = F.length(t).cast("double"), F.length(e.alphabet).cast("double")
        counts = F.transform(F.array_distinct(F.split(t, "")), lambda c: F.struct(c.alias("c"), (n - F.length(F.replace(t, c, F.lit("")))).alias("n")))
        sums = F.aggregate(
            counts, F.struct(F.lit(0.0).alias("squares"), F.lit(0.0).alias("log")),
            lambda s, c: F.struct((s.squares + c.n * c.n).alias("squares"), (s.log + c.n * F.coalesce(F.element_at(_text_log(), c.c), F.lit(0.0))).alias("log")),
        )
        values = F.transform(F.split(t, ""), lambda c: F.instr(e.alphabet, c) - 1 - (m - 1) / 2)
        product = let(values, lambda v: F.aggregate(F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
        classes = F.translate(t, LOWER + UPPER + DIGITS + "+/", "l" * 26 + "u" * 26 + "d" * 10 + "ss")

        def judged(sums: Column, changes: Column) -> Column:
            chi = (m / n * sums.squares - n - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)
            runs = (_changes(e.halves) - (n - 1) / 2) / F.sqrt((n - 1) / 4)
            serial = product / ((m * m - 1) / 12) / F.sqrt(n - 1)
            least = F.least(_upper_tail(chi), 2 * _upper_tail(F.abs(runs)), 2 * _upper_tail(F.abs(serial)))
            text = sums.log + changes * math.log((1 - STAY) / 3) + (n - 1 - changes) * math.log(STAY) + math.log(1 / 4)
            return F.struct(F.least(F.lit(1.0), 3 * least).alias("p_random"), F.exp(F.least(F.lit(0.0), text + n * F.log(m))).alias("p_text"))

        return let(sums, lambda s: let(_changes(classes).cast("double"), lambda c: judged(s, c)))

    return let(clean, lambda t: let(_encoding_fields(t), lambda e: F.when(F.length(t) >= 2, scores(t, e)).otherwise(F.struct(F.lit(0.0).alias("p_random"), F.lit(1.0).alias("p_text")))))


def _tries(m: Column) -> Column:
    """A candidate and what is tried beside it: it without the words at its ends, then its long parts."""

    def placed(start: Column, length: Column) -> Column:
        return F.struct((m.start + start).alias("start"), (m.start + start + length).alias("end"), F.substr(m.match, (start + 1).cast("int"), length.cast("int")).alias("match"))

    def inner(cut: Column) -> Column:
        length = F.length(m.match) - cut.lead - cut.trail
        return F.when((length >= LEAST) & (cut.lead + cut.trail > 0), F.array(placed(cut.lead.cast("bigint"), length.cast("bigint")))).otherwise(none)

    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    cut = F.struct(F.length(F.regexp_extract(m.match, LEAD, 0)).alias("lead"), F.length(F.regexp_extract(F.reverse(m.match), TRAIL, 0)).alias("trail"))
    parts = F.transform(_matches(m.match, PART), lambda p: F.struct((m.start + p.start).alias("start"), (m.start + p.end).alias("end"), p.match.alias("match")))
    return F.when(F.regexp_like(m.match, F.lit("[/_-]")), F.array_distinct(F.concat(F.array(m), let(cut, inner), parts))).otherwise(F.array(m))


def _random_spans(text: Column) -> Column:
    """Spans of the candidates, or of what they hold, that pass the battery and the weighted step-up over all tries of the text."""

    def judged(found: Column) -> Column:
        tried = F.flatten(found)
        mean = F.aggregate(tried, F.lit(0.0), lambda s, m: s + (m.end - m.start)) / F.size(tried)

        def weighted(m: Column, mean: Column) -> Column:
            def q(b: Column) -> Column:
                return F.when(b.p_random >= BATTERY_LEVEL, F.least(F.lit(1.0), b.p_text * mean / (m.end - m.start))).otherwise(F.lit(1.0))

            return F.struct(m.start.alias("start"), m.end.alias("end"), let(battery(m.match), q).alias("p"))

        def outermost(passed: Column) -> Column:
            # The whole comes first, then what is left without words, then parts: those inside the first are no secrets of their own.
            first = F.get(passed, F.lit(0))
            return F.filter(passed, lambda r: (r.end <= first.start) | (r.start >= first.end) | ((r.start == first.start) & (r.end == first.end)))

        def accepted(rows: Column) -> Column:
            ordered = F.array_sort(F.transform(F.flatten(rows), lambda r: r.p))
            passed = let(ordered, lambda ps: F.filter(F.transform(ps, lambda p, i: F.when(p <= DISCOVERY_RATE * (i + 1) / F.size(ps), p)), lambda p: p.isNotNull()))
            return let(F.coalesce(F.array_max(passed), F.lit(-1.0)), lambda level: F.flatten(F.transform(rows, lambda own: let(F.filter(own, lambda r: r.p <= level), outermost))))

        return let(mean, lambda mean: let(F.transform(found, lambda own: F.transform(own, lambda m: weighted(m, mean))), accepted))

    found = F.transform(_matches(text, TOKEN), _tries)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,p:double>>")
    return let(found, lambda f: F.when(F.size(f) > 0, judged(f)).otherwise(empty))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")


def with_spans(frame: DataFrame, text: Column, base: str, spans: str) -> DataFrame:
    """Add two arrays of ``start``, ``kind`` (place in KINDS) and ``end``, sorted: the base spans, and all spans."""
    assign = F.filter(_matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m.match, ASSIGN, 1)) >= ASSIGN_LEAST)
    known = F.concat(_spans(assign, 0), _spans(_matches(text, ACCESS), 1), _spans(_matches(text, HEX), 2))
    return frame.withColumn(base, F.array_sort(known)).withColumn(spans, F.array_sort(F.concat(F.col(base), _spans(_random_spans(text), 3))))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and ``n_random`` per row of ``docs``.

    Null texts are empty and have no spans. Repeated rows and null ids are rows like any other; an empty table
    gives none. Other columns are not read. Offsets count code points, ends are exclusive.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = with_spans(picked, F.col("text"), "base", "all").select("id", "base", "all")

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda s: s.kind == kind)).cast("bigint")

    return found.select(
        F.col("id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), count(3).alias("n_random"),
    )


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every run of overlapping or touching ``spans`` replaced by ``mask``."""

    def union(runs: Column, s: Column) -> Column:
        last = F.element_at(runs, -1)
        grown = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(last.start.alias("start"), F.greatest(last.end, s.end).alias("end"))))
        return F.when((F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1)).end >= s.start), grown).otherwise(F.concat(runs, F.array(F.struct(s.start.alias("start"), s.end.alias("end")))))

    runs = F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), union)

    def cut(runs: Column) -> Column:
        def piece(r: Column, i: Column) -> Column:
            begin = F.coalesce(F.get(runs, i - 1).end, F.lit(0))
            return F.concat(F.substr(text, (begin + 1).cast("int"), (r.start - begin).cast("int")), F.lit(mask))

        end = F.element_at(runs, -1).end
        return F.concat(F.array_join(F.transform(runs, piece), ""), F.substr(text, (end + 1).cast("int")))

    return F.when(F.size(spans) > 0, let(runs, cut)).otherwise(text)

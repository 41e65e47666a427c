"""String and regex functions, each ``Column -> Column`` on JVM expressions.

Python's ``\\s``, ``\\w``, ``\\b`` are Unicode: patterns that must follow that carry ``(?U)``. Where no
built-in has the semantics (HTML entities, accent folding, sequence similarity) the function is an
Arrow UDF and says so.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types

_DASHES = "[\\u2010-\\u2015\\u2212]"
NUMBER = r"\d+(?:[.]\d+)?"
HEDGES = ("may", "might", "could", "suggest", "suggested", "possibly", "appears?", "seems?", r"hypothesiz\w*", "proposed", "preliminary", "limited", "unclear", "potential")
HEDGE = rf"(?iU)\b(?:{'|'.join(HEDGES)})\b"
_HEADS = "background design materials? methods? objective participants purpose setting".split()
METHODS_HEAD = rf"(?iU)^(?:{'|'.join(_HEADS)})\b"
_RESULT_STEMS = ("results?", "found", "showed", r"demonstrat\w*", r"conclud\w*", "significant", "increased", "decreased")
RESULTS = rf"(?iU)\b(?:{'|'.join(_RESULT_STEMS)})\b"
YEAR = r"\b(?:19\d\d|20\d\d)\b"
ET_AL = r"(?i)\bet\s+al\b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas, where Spark shares nothing."""
    return F.get(F.transform(F.array(value), use), 0)


def required(pattern: str) -> str:
    """The longest ASCII text that every match of a pattern holds, in lower case; empty if none is known."""
    runs = [""]
    for op, value in re._parser.parse(pattern):
        if op is re._constants.LITERAL and value < 128:
            runs[-1] += chr(value)
        else:
            runs.append("")
    return max(runs, key=len).lower()


def like_any(c: Column | str, words: Sequence[str], pattern: str) -> Column:
    """``regexp_like`` for a pattern of alternatives, run only on texts that hold what one of them requires.

    Letters beyond ASCII may fold to ASCII ones, so texts with any go to the pattern.
    """
    text = col(c)
    near = let(F.lower(text), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(required(w))) for w in words]))
    return (near | (F.octet_length(text) > F.length(text))) & F.regexp_like(text, F.lit(pattern))


def arrow(kind: str):
    """An Arrow UDF that maps one value at a time and keeps nulls; needs no session to be defined."""

    def wrap(f):
        @F.arrow_udf(_TYPES[kind])
        def run(a: pa.Array) -> pa.Array:
            return pa.array([None if x is None else f(x) for x in a.to_pylist()], _ARROW[kind])

        return run

    return wrap


_TYPES = {"string": types.StringType(), "double": types.DoubleType()}
_ARROW = {"string": pa.string(), "double": pa.float64()}


def normalize_ws(c: Column | str) -> Column:
    """Runs of white space become one space; ends trimmed."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def dedupe_key(c: Column | str) -> Column:
    """Case- and space-folded text, the key of exact-text comparison."""
    return F.lower(normalize_ws(c))


unescape_html = arrow("string")(html.unescape)


def fold_dashes(c: Column | str) -> Column:
    """Typographic dashes and minus become ``-``; soft hyphens go."""
    return F.regexp_replace(F.regexp_replace(col(c), "\\u00ad", ""), _DASHES, "-")


def normalize_quote(c: Column | str, entities: bool = True) -> Column:
    """Text as quotes are compared: entities decoded, dashes folded, spaces normalised."""
    return normalize_ws(fold_dashes(unescape_html(col(c)) if entities else col(c)))


def collapse_letter_spaces(c: Column | str) -> Column:
    """Join ASCII letters that one space parts."""
    return F.regexp_replace(col(c), "(?<=[A-Za-z])[ ](?=[A-Za-z])", "")


def quote_in_excerpt(quote: Column | str, excerpt: Column | str) -> Column:
    """Whether a quote is a substring of the excerpt, after normalisation or letter joining."""
    q, e = normalize_quote(quote), normalize_quote(excerpt)
    qq = normalize_quote(unescape_html(col(quote)))
    return F.contains(e, q) | F.contains(collapse_letter_spaces(e), collapse_letter_spaces(q)) | F.contains(e, qq) | F.contains(collapse_letter_spaces(e), collapse_letter_spaces(qq))


def quote_in_excerpt_simple(quote: Column | str, excerpt: Column | str) -> Column:
    return F.contains(col(excerpt), col(quote)) | F.contains(normalize_ws(excerpt), normalize_ws(quote))


def escape_xml(c: Column | str) -> Column:
    out = col(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def sentences(c: Column | str, least: int = 40, space: str = r"(?U)\s+") -> Column:
    """Trimmed sentences of at least ``least`` characters."""
    parts = F.split(F.trim(col(c)), r"(?<=[.!?])" + space)
    if space.startswith("(?U)"):
        parts = F.split(F.regexp_replace(col(c), r"(?U)^\s+|\s+$", ""), r"(?U)(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) >= least)


def overlap_tokens(c: Column | str) -> Column:
    """Distinct lower-case tokens of three characters or more; ``, . ;`` count as space."""
    words = F.split(F.translate(F.lower(col(c)), ",.;", "   "), r"(?U)\s+")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))


def overlap_score(passage: Column, chunk: Column) -> Column:
    """Share of the passage's tokens that the chunk has; 0 without tokens."""
    return F.when(F.size(passage) == 0, 0.0).otherwise(F.size(F.array_intersect(passage, chunk)) / F.size(passage))


def normalize_page(c: Column | str) -> Column:
    """Page text: NULs, soft hyphens, hyphenated line ends, line breaks, dashes, spaces."""
    out = F.translate(col(c), "\u0000", " ")
    for pattern, new in ((r"(?U)­\s*", ""), (r"(?U)-\s*\n\s*", ""), (r"(?U)\s*\n\s*", " "), (_DASHES, "-")):
        out = F.regexp_replace(out, pattern, new)
    return normalize_ws(out)


def strip_hedges(c: Column | str) -> Column:
    out = F.trim(F.regexp_replace(F.regexp_replace(col(c), HEDGE, ""), r"(?U)\s{2,}", " "))
    return F.regexp_replace(out, r"(?U)\s+([,.])", "$1")


def has_hedge(c: Column | str) -> Column:
    return like_any(c, HEDGES, HEDGE)


def has_result(c: Column | str) -> Column:
    return like_any(c, _RESULT_STEMS, RESULTS)


def numbers(c: Column | str) -> Column:
    """All number tokens in order."""
    return F.regexp_extract_all(col(c), F.lit(f"({NUMBER})"), 1)


def numbers_aligned(claim: Column | str, source: Column | str) -> Column:
    """Every number of the claim is one of the source; false without numbers."""
    return let(numbers(claim), lambda n: (F.size(n) > 0) & (F.size(F.array_except(n, numbers(source))) == 0))


def long_words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit("([a-z]{5,})"), 1)


def meaning_aligned(claim: Column | str, source: Column | str) -> Column:
    """Two content words at least, and a third of them, are the source's."""
    enough = lambda words: (F.size(words) >= 2) & (F.size(F.array_intersect(words, long_words(source))) >= F.greatest(F.lit(2), F.floor(F.size(words) / 3)))
    return let(F.array_distinct(long_words(claim)), enough)


def aligned(claim: Column | str, source: Column | str) -> Column:
    among = lambda n: F.size(F.array_except(n, numbers(source))) == 0
    return let(numbers(claim), lambda n: F.when(F.size(n) > 0, among(n)).otherwise(meaning_aligned(claim, source)))


def claim_absent(claim: Column | str, text: Column | str) -> Column:
    """Too few of the claim's long words (repeats count) occur in the text."""
    # both are bound once: inside the filter the text would be folded anew for every word
    return let(F.struct(long_words(claim).alias("words"), F.lower(col(text)).alias("hay")), lambda x: words_absent(x["words"], x["hay"]))


def words_absent(words: Column, hay: Column) -> Column:
    """``claim_absent`` by the claim's long words and the text in lower case."""
    hits = F.size(F.filter(words, lambda w: F.contains(hay, w)))
    return (F.size(words) < 3) | (hits < F.greatest(F.lit(2), F.floor(F.size(words) / 2)))


_PARTS = rf"(?s)^(.*?)({NUMBER})(.*)$"


def flip_number(c: Column | str, last_start: int | None = None) -> Column:
    """The text with its first number raised (x1.4 + 1, small ones + 0.15); null if none is in reach.

    Exact integer and decimal spelling is kept as Python writes it: whole results without a point.
    """
    text = col(c)
    head, num, tail = (F.regexp_extract(text, _PARTS, i) for i in (1, 2, 3))
    n = num.try_cast("double")
    whole = F.floor(n * 1.4 + 1).cast("long").cast("string")
    small = F.round(n + 0.15, 2).cast("string")
    new = F.when(n >= 1, whole).otherwise(small)
    new = F.when(new == num, (n + 1).cast("string")).otherwise(new)
    reach = F.lit(True) if last_start is None else F.length(head) <= last_start
    return F.when(F.regexp_like(text, F.lit(r"\d")) & reach, F.concat(head, new, tail))


def mutate_number(c: Column | str, factor: int = 10) -> Column:
    """The passage with its first percentage, sample size or year (in this order) made wrong."""
    text = col(c)
    edge = "[-./0-9A-Za-z]"
    pct = rf"(?s)^(.*?)(?<!{edge})({NUMBER})(\s*%)(?!{edge})(.*)$"
    head, num, sign, tail = (F.regexp_extract(text, pct, i) for i in (1, 2, 3, 4))
    v = num.try_cast("double")
    new = F.when(v < 50, F.least(v * factor, F.lit(99.0))).otherwise(F.greatest(v / factor, F.lit(0.1)))
    percent = F.when(F.regexp_like(text, F.lit(pct)), F.concat(head, plain(new), sign, tail))
    size = r"(?s)^(.*?\b(?:[NnK]\s*=\s*|n\s+))(\d+)(?!\d)(.*)$"
    head, num, tail = (F.regexp_extract(text, size, i) for i in (1, 2, 3))
    v = num.try_cast("long")
    sample = F.when(F.regexp_like(text, F.lit(size)), F.concat(head, F.greatest(v * factor, v + 50).cast("string"), tail))
    when = rf"(?s)^(.*?)({YEAR})(.*)$"
    head, num, tail = (F.regexp_extract(text, when, i) for i in (1, 2, 3))
    v = num.try_cast("int")
    year = F.when(F.regexp_like(text, F.lit(when)), F.concat(head, F.when(v < 2010, v + 20).otherwise(v - 20).cast("string"), tail))
    return F.coalesce(percent, sample, year)


def plain(v: Column) -> Column:
    """A number without a needless ``.0``."""
    return F.when(v == F.floor(v), F.floor(v).cast("long").cast("string")).otherwise(F.round(v, 4).cast("string"))


SWAPS: tuple[tuple[str, str], ...] = tuple(
    pair
    for a, b in (("increased", "decreased"), ("higher", "lower"), ("improved", "worsened"), ("significant", "nonsignificant"), ("can be neglected", "cannot be neglected"))
    for pair in ((a, b), (b, a))
) + (
    ("is important", "is unimportant"),
    ("was observed", "was not observed"),
    ("showed that", "failed to show that"),
    ("highly consistent", "highly inconsistent"),
    ("agreement with experiment", "disagreement with experiment"),
)


def flip_polarity(c: Column | str, swaps: Sequence[tuple[str, str]] = SWAPS, ascii_words: bool = False) -> Column:
    """The text with the first swap that applies made once; null if none does.

    ``ascii_words``: only ASCII letters, digits and ``_`` are parts of words, as in RE2.
    """
    text = col(c)
    start, end = ("(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])") if ascii_words else (r"\b", r"\b")
    return F.coalesce(*[F.when(F.regexp_like(text, F.lit(f"(?i){start}{a}{end}")), F.regexp_replace(text, f"(?is)^(.*?){start}{a}{end}", f"$1{b}")) for a, b in swaps])


def normalize_doi(c: Column | str) -> Column:
    """Lower-case DOI without resolver prefixes, each stripped once in turn; null if empty."""
    out = F.lower(F.trim(col(c)))
    for prefix in (r"^https://doi\.org/", r"^http://doi\.org/", "^doi:"):
        out = F.regexp_replace(out, prefix, "")
    return F.nullif(F.trim(out), F.lit(""))


def doi_file_name(c: Column | str) -> Column:
    return F.left(F.regexp_replace(col(c), "[^A-Za-z0-9._-]+", "_"), F.lit(120))


@arrow("string")
def fold_accents(s: str) -> str:
    s = "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch)).lower()
    return " ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in s).split())


@F.arrow_udf(types.DoubleType())
def title_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Containment: 0.75 or the ratio of lengths; else the matching-blocks ratio."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        if not x or not y:
            out.append(0.0)
        elif x in y or y in x:
            out.append(max(0.75, min(len(x), len(y)) / max(len(x), len(y))))
        else:
            out.append(difflib.SequenceMatcher(None, x, y).ratio())
    return pa.array(out, pa.float64())


def page_hint(c: Column | str) -> Column:
    n = F.regexp_extract(col(c), r"(?i)\bpp?\.?\s*(\d+)", 1).try_cast("int")
    return F.when(n > 0, n)


def strip_tags(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), "<[^>]+>", ""))


def links(c: Column | str, pattern: str = "href=[\"']([^\"']+)[\"']", most: int | None = None) -> Column:
    """Distinct link targets in order of appearance."""
    out = F.array_distinct(F.regexp_extract_all(col(c), F.lit(pattern), 1))
    return out if most is None else F.slice(out, 1, most)


def pdf_links(c: Column | str, most: int = 12) -> Column:
    """Targets that end in or pass through a PDF, explicit files first; the first twelve."""
    files = links(c, "(?i)href=[\"']([^\"']+\\.pdf[^\"']*)[\"']")
    paths = links(c, "(?i)href=[\"']([^\"']*(?:/pdf/|/pdf\\b|pdf=render|download=true)[^\"']*)[\"']")
    return F.slice(F.array_distinct(F.concat(files, paths)), 1, most)


def excerpt_preview(excerpt: Column | str, anchor: Column | str, width: int = 180) -> Column:
    """A window around the anchor with dots where it was cut; the beginning without an anchor."""
    text = col(excerpt)
    head = F.when(F.length(text) <= width, text).otherwise(F.concat(F.left(text, F.lit(width)), F.lit("...")))

    def around(at: Column) -> Column:
        start, end = F.greatest(at - 50, F.lit(1)), F.least(F.length(text), at - 1 + width)
        near = F.concat(F.when(start > 1, "...").otherwise(""), F.substring(text, start, end - start + 1), F.when(end < F.length(text), "...").otherwise(""))
        return F.when(F.coalesce(text, F.lit("")) == "", "").when(at > 0, near).otherwise(head)

    # the anchor may be costly, and its place is used many times: each is found once
    needle = F.trim(F.left(F.coalesce(col(anchor), F.lit("")), F.lit(80)))
    return let(let(needle, lambda n: F.when(n != "", F.instr(text, n)).otherwise(0)), around)


def short_claim(c: Column | str, most: int = 80) -> Column:
    s = normalize_ws(c)
    at = F.regexp_instr(s, F.lit(NUMBER))
    start = F.greatest(at - 30, F.lit(1))
    return F.when(F.length(s) <= most, s).when(at > 0, F.trim(F.substring(s, start, F.lit(most)))).otherwise(F.trim(F.left(s, F.lit(most))))


def clip_at_word(c: Column | str, most: int = 240) -> Column:
    """At most so many characters, cut at a space, with an ellipsis where cut."""
    text = F.trim(col(c))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.regexp_replace(F.left(text, F.lit(most)), r"\s+\S*$", "")), F.lit("…")))


def count(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))


def letter_share(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), r"[^\p{L}]", "")) / F.greatest(F.length(col(c)), F.lit(1))

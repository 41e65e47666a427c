"""Model-written JSON: strict parsing, textual repair, claim cleaning, expectation checks."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmill.functions.text import arrow, col, quote_in_excerpt

VERDICTS = tuple("contradicted insufficient_evidence not_in_source supported weak".split())
CLAIM = "struct<claim:string,verdict:string,sourceQuotes:array<string>,rationale:array<string>,hasNumericClaim:boolean>"
EXPECT = "struct<must_parse_json:boolean,min_claims:int,any_claim_verdict:array<string>,forbidden_claim_verdict:array<string>,all_claim_verdicts_in:array<string>,quotes_must_be_substrings:boolean>"


def strip_channel(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?iU)^\s*(?:<channel\|?>\s*)?", "")


def strip_fences(c: Column | str) -> Column:
    return F.replace(F.regexp_replace(col(c), r"(?iU)```(?:json)?\s*", ""), F.lit("```"), F.lit(""))


def outer_object(c: Column | str) -> Column:
    """From the first ``{`` to the last ``}``; the text itself if there is no such range."""
    return F.regexp_replace(col(c), r"(?s)^[^{]*(\{.*\})[^}]*$", "$1")


def bare_object(c: Column | str) -> Column:
    """What strict parsing looks at."""
    return outer_object(F.trim(strip_fences(strip_channel(F.coalesce(col(c), F.lit(""))))))


def repair(c: Column | str) -> Column:
    """The repair chain in its order; trailing commas go in one pass, which equals the fixpoint."""
    out = bare_object(c)
    for pattern, new in (
        (r'(?U)("\w[\w-]*")\s*[?]\s*:', "$1:"),  # "key"?: of a type signature
        (r'"\]\}{2}\],\s*"overallVerdict"', '"]}], "overallVerdict"'),  # root closed too early
        (r'"\}\],\s*"overallVerdict"', '"]}], "overallVerdict"'),  # list left open
        (r"(?U),(?:\s*,)*\s*([\]}])", "$1"),
    ):
        out = F.regexp_replace(out, pattern, new)
    return F.trim(out)


@arrow("string")
def first_object(text: str) -> str | None:
    """The first JSON object in the text, whatever follows it; null if there is none."""
    at = text.find("{")
    try:
        return None if at < 0 else json.dumps(json.JSONDecoder().raw_decode(text, at)[0], ensure_ascii=False)
    except json.JSONDecodeError:
        return None


def variant(c: Column) -> Column:
    """Parsed value if the text is one JSON object with a claims list; else null.

    Spark's parser ignores what follows a value; inside brackets, that is an error.
    """
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")
    v = F.when(F.size(one) == 1, F.get(one, 0))
    ok = F.startswith(F.schema_of_variant(v), F.lit("OBJECT")) & F.try_variant_get(v, "$.claims", "array<variant>").isNotNull()
    return F.when(ok, v)


def parse_strict(c: Column | str) -> Column:
    return variant(bare_object(c))


def parse_repaired(c: Column | str) -> Column:
    fixed = repair(c)
    return F.coalesce(parse_strict(c), variant(fixed), variant(first_object(fixed)))


def clean_claims(v: Column) -> Column:
    """Claims that are objects with a non-blank text and a known verdict."""
    items = F.try_variant_get(v, "$.claims", "array<variant>")
    text = lambda x: F.try_variant_get(x, "$.claim", "string")
    is_text = lambda x: F.schema_of_variant(F.try_variant_get(x, "$.claim", "variant")) == "STRING"
    good = F.filter(items, lambda x: F.coalesce(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")) & is_text(x) & (F.trim(text(x)) != "") & F.try_variant_get(x, "$.verdict", "string").isin(*VERDICTS), F.lit(False)))
    return F.transform(good, lambda x: F.from_json(F.to_json(x), CLAIM))


def parse_status(raw: Column | str, allow_repair: bool = True) -> Column:
    """``ok``, ``ok_repaired`` or ``parse_fail:...``; without repair only strict JSON is ok."""
    strict, any_ = parse_strict(raw), parse_repaired(raw)
    bad = F.concat(F.lit("parse_fail:"), F.when(F.contains(F.coalesce(col(raw), F.lit("")), F.lit("{")), "Invalid JSON").otherwise("No JSON object"))
    return F.when(strict.isNotNull(), "ok").when(F.lit(allow_repair) & any_.isNotNull(), "ok_repaired").otherwise(bad)


def names(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def failures(parsed: Column, claims: Column, expect: Column, excerpt: Column) -> Column:
    """Names of the expectations that a row does not meet, in the order they are checked."""
    verdicts = F.transform(claims, lambda x: x["verdict"])
    want, ban, allow = expect["any_claim_verdict"], expect["forbidden_claim_verdict"], expect["all_claim_verdicts_in"]
    supported = F.filter(claims, lambda x: x["verdict"] == "supported")
    quotes = F.flatten(F.transform(supported, lambda x: F.coalesce(x["sourceQuotes"], F.array().cast("array<string>"))))
    wrong = F.filter(quotes, lambda q: q.isNotNull() & ~_inside(q, excerpt))
    rules = F.array(
        F.when(F.size(claims) < expect["min_claims"], F.concat(F.lit("min_claims:"), F.size(claims).cast("string"), F.lit("<"), expect["min_claims"].cast("string"))),
        F.when((F.size(want) > 0) & ~F.coalesce(F.arrays_overlap(verdicts, want), F.lit(False)), F.concat(F.lit("any_claim_verdict missing "), names(want))),
        F.when(F.coalesce(F.arrays_overlap(verdicts, ban), F.lit(False)), F.concat(F.lit("forbidden verdict present: "), names(ban))),
        F.when((F.size(allow) > 0) & F.exists(verdicts, lambda v: ~F.array_contains(allow, v)), F.concat(F.lit("verdict not in "), names(allow))),
    )
    bad_quotes = F.when(F.coalesce(expect["quotes_must_be_substrings"], F.lit(False)), F.transform(wrong, lambda q: F.concat(F.lit("invalid quote substring: '"), F.left(q, F.lit(40)), F.lit("'")))).otherwise(F.array().cast("array<string>"))
    checked = F.concat(F.array_compact(rules), bad_quotes)
    unparsed = F.when(F.coalesce(expect["must_parse_json"], F.lit(False)), F.array(F.lit("must_parse_json"))).otherwise(F.array().cast("array<string>"))
    return F.when(parsed, checked).otherwise(unparsed)


def _inside(q: Column, excerpt: Column) -> Column:
    """``quote_in_excerpt`` without UDFs, as it runs inside a lambda: common entities by replacement."""
    from grainmill.functions.text import collapse_letter_spaces, let, normalize_quote

    def plain(c: Column) -> Column:
        for raw, new in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            c = F.replace(c, F.lit(raw), F.lit(new))
        return normalize_quote(c, entities=False)

    inside = lambda x: F.contains(x["a"], x["b"]) | F.contains(collapse_letter_spaces(x["a"]), collapse_letter_spaces(x["b"])) | F.contains(x["a"], plain(x["b"]))
    return let(F.struct(plain(excerpt).alias("a"), plain(q).alias("b")), inside)


def failure_mode(parsed: Column, fails: Column, missing: Column) -> Column:
    """One word for why a row fails; the first failure decides."""
    first = F.get(fails, 0)
    return (
        F.when(missing, "missing_prediction")
        .when(~parsed, "parse_json")
        .when(F.size(fails) == 0, "pass")
        .when(first == "must_parse_json", "parse_json")
        .when(F.startswith(first, F.lit("min_claims")), "min_claims")
        .when(F.startswith(first, F.lit("any_claim_verdict")), "wrong_verdict")
        .when(F.startswith(first, F.lit("forbidden")), "forbidden_verdict")
        .when(F.contains(first, F.lit("invalid quote")), "quote_invalid")
        .otherwise("wrong_verdict")
    )


def invert_index(c: Column | str) -> Column:
    """``word -> [positions]`` back to text; null if empty."""
    pairs = F.flatten(F.transform(F.map_entries(col(c)), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.when(F.size(pairs) > 0, F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " "))


@arrow("string")
def spaced_json(text: str) -> str:
    """Compact JSON re-spelt with ``", "`` and ``": "`` and unescaped characters."""
    return json.dumps(json.loads(text), ensure_ascii=False)


def get(c: Column | str, path: str, kind: str = "string", default: object = None) -> Column:
    """A nested value of a JSON text, or the default where any step is missing."""
    out = F.try_variant_get(F.try_parse_json(col(c)), path, kind)
    return out if default is None else F.coalesce(out, F.lit(default))


__all__ = [n for n in dir() if not n.startswith("_")] + ["quote_in_excerpt"]

"""Validation as data: a rule is a code, a predicate and a message; a row's errors are an array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.functions.jsonx import VERDICTS

OVERALL = tuple("insufficient_evidence support unrelated weak".split())
TASKS = tuple("doc_extract issue_explain l3_grounding source_pdf_extract table_figure_grounding webpage_classify webpage_metadata".split())
Rule = tuple[Column, Column | str]


def errors(rules: Sequence[Rule]) -> Column:
    """Messages of the rules that fire, in order."""
    return F.array_compact(F.array(*[F.when(hit, message if isinstance(message, Column) else F.lit(message)) for hit, message in rules]))


def staged(*stages: tuple[Column | None, Sequence[Rule]]) -> Column:
    """Rule groups in order; a group's guard, where false, ends validation with what was found."""
    out = F.array().cast("array<string>")
    for guard, rules in reversed(stages):
        here = F.concat(errors(rules), out)
        out = here if guard is None else F.when(guard, here).otherwise(F.array().cast("array<string>"))
    return out


def has_key(raw: str, key: str) -> Column:
    """Whether a JSON text's object has the key at all, null or not."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))


def grounding_errors(raw: str = "raw") -> Column:
    """Errors of one raw JSON line, by its task."""
    v = F.try_parse_json(F.col(raw))
    text = lambda p: F.try_variant_get(v, p, "string")
    task = text("$.task")
    missing = lambda *ks: [(~has_key(raw, k), f"missing {k}") for k in ks]
    claims = F.try_variant_get(v, "$.output.claims", "array<variant>")
    output = F.try_variant_get(v, "$.output", "variant")
    is_object = F.coalesce(F.startswith(F.schema_of_variant(output), F.lit("OBJECT")), F.lit(False))
    verdict = lambda c: F.try_variant_get(c, "$.verdict", "string")
    quotes = lambda c: F.try_variant_get(c, "$.sourceQuotes", "array<string>")
    valid = lambda c: F.coalesce(verdict(c).isin(*VERDICTS), F.lit(False))
    excerpt = text("$.source_excerpt")
    some = lambda f: F.coalesce(F.exists(claims, f), F.lit(False))
    from grainmill.functions.jsonx import _inside

    grounding = [
        (some(lambda c: ~valid(c)), "invalid verdict"),
        (some(lambda c: valid(c) & (F.coalesce(F.trim(F.try_variant_get(c, "$.claim", "string")), F.lit("")) == "")), "blank claim"),
        (some(lambda c: (verdict(c) == "supported") & (F.coalesce(F.size(quotes(c)), F.lit(0)) <= 0)), "supported claim requires sourceQuotes"),
        (some(lambda c: (verdict(c) == "supported") & F.coalesce(F.exists(quotes(c), lambda q: ~_inside(q, excerpt)), F.lit(False))), "quote not in excerpt"),
    ]
    doc = F.coalesce(text("$.meta.doc_id"), F.lit("")) != ""
    body = [(doc & text(f"$.meta.{k}").isNull(), f"meta.{k} required") for k in ("excerpt_mode", "language")] + [(doc & (text("$.meta.language") == "ar") & (F.coalesce(text("$.meta.arabic_slice"), F.lit("")) != "unvalidated_pilot"), "arabic_slice required")]
    expect_ok = text("$.expect").isNull() | F.startswith(F.schema_of_variant(F.try_variant_get(v, "$.expect", "variant")), F.lit("OBJECT"))
    both = has_key(raw, "output") | has_key(raw, "expect")
    l3 = staged(
        (None, [*missing("passage", "source_excerpt", "meta"), (~both, "neither output nor expect")]),
        (both, [(text("$.output").isNotNull() & ~is_object, "output is no object")]),
        (is_object, [(claims.isNull(), "claims is no list")]),
        (claims.isNotNull(), [(text("$.output.overallVerdict").isNotNull() & ~text("$.output.overallVerdict").isin(*OVERALL), "invalid overallVerdict"), *grounding, *body, (~expect_ok, "expect is no object")]),
    )
    other = {
        "webpage_metadata": errors([*missing("url", "page_signals", "output"), (text("$.output.suggested_type").isNull(), "output.suggested_type required")]),
        "webpage_classify": errors([(text("$.output.recommended_csl_type").isNull(), "output.recommended_csl_type required")]),
        "issue_explain": errors([*missing("issue_code", "issue_context", "output"), (text("$.output.explanation").isNull(), "output.explanation required")]),
    }
    by_task = F.when(task == "l3_grounding", l3)
    for name, e in other.items():
        by_task = by_task.when(task == name, e)
    known = F.coalesce(task.isin(*TASKS), F.lit(False))
    head = errors([(v.isNull(), "invalid JSON"), (v.isNotNull() & (F.coalesce(text("$.id"), F.lit("")) == ""), "missing id"), (v.isNotNull() & ~known, "unknown task")])
    return F.concat(head, F.when(known, F.coalesce(by_task, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")))


def pilot_errors() -> Column:
    """Rules of body-holdout pilot rows: doc_id, excerpt_mode, language, expect columns."""
    return errors([
        *[(F.coalesce(F.col(c), F.lit("")) == "", f"missing meta.{c}") for c in ("doc_id", "excerpt_mode", "language")],
        (F.coalesce(F.col("excerpt_mode"), F.lit("")) != "paragraph", "excerpt_mode must be paragraph"),
        (F.col("expect").isNull(), "missing expect"),
    ])


def label_audit(row_id: Column, excerpt: Column, passage: Column, claims: Column, visible: int = 200) -> Column:
    """Structural problems of a labelled row's claims, ``code@claim number``.

    ``claims`` is an array of ``jsonx.CLAIM`` structs.
    """
    sup = lambda c: c["verdict"] == "supported"
    q0 = lambda c: F.get(c["sourceQuotes"], 0)
    head = lambda x: F.left(x, F.lit(visible))
    none = lambda c: F.coalesce(F.size(c["sourceQuotes"]), F.lit(0)) <= 0
    from grainmill.functions.jsonx import _inside

    def per_claim(c: Column, i: Column) -> Column:
        code = lambda hit, name: F.when(F.coalesce(hit, F.lit(False)), F.concat(F.lit(f"{name}@"), i.cast("string")))
        con, weak, nis = (c["verdict"] == v for v in ("contradicted", "weak", "not_in_source"))
        return F.array_compact(F.array(
            code(F.coalesce(F.trim(c["claim"]), F.lit("")) == "", "blank_claim"),
            code((sup(c) | con | weak) & none(c), "quotes_missing"),
            code(sup(c) & ~none(c) & ~_inside(q0(c), excerpt), "quote_not_in_excerpt"),
            code(sup(c) & ~none(c) & (head(c["claim"]) != head(q0(c))) & ~F.contains(q0(c), c["claim"]) & ~T.numbers_aligned(c["claim"], q0(c)) & ~T.meaning_aligned(c["claim"], q0(c)), "claim_not_aligned"),
            code(con & ~none(c) & (head(c["claim"]) == head(q0(c))), "contradiction_invisible"),
            code(weak & ~none(c) & (head(c["claim"]) == head(q0(c))), "hedge_removal_invisible"),
            code(weak & ~none(c) & ~T.has_hedge(q0(c)), "quote_without_hedge"),
            code(weak & ~none(c) & T.numbers_aligned(c["claim"], q0(c)), "numbers_align"),
            code(nis & F.exists(c["sourceQuotes"], lambda q: F.contains(excerpt, q)), "quote_present"),
        ))

    rows = F.flatten(F.transform(claims, per_claim))
    whole = errors([(F.coalesce(F.size(claims), F.lit(0)) <= 0, "no_claims"), (F.contains(row_id, F.lit("-multi")) & (F.size(claims) < 2), "multi_needs_two")])
    return F.concat(whole, F.coalesce(rows, F.array().cast("array<string>")))


def claim_keys_ordered(claim_json: Column | str) -> Column:
    """Whether a claim's JSON keys stand in the fixed order."""
    return F.json_object_keys(T.col(claim_json)) == F.array(*[F.lit(k) for k in "claim verdict sourceQuotes rationale hasNumericClaim".split()])


def split_dropped(rows: DataFrame, dropped: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """One relation as kept and dropped (with the list's reason); together they are the input."""
    return rows.join(dropped.select(key), key, "left_anti"), rows.join(dropped, key)


def unseen(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that an earlier run has not finished."""
    return rows.join(done.select(key).distinct(), key, "left_anti")

"""Queries of parsing, scoring, rates, gates and validation over model outputs spelt from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.functions import jsonx
from grainmill.operators import evaluate, gates, generate, rules, sets
from grainmill.plans.catalog_rows import PICKS, _PAPERS, _SAID, lit, neutral, papers
from grainmill.plans.inputs import EVALS, OUTPUTS, PAPERS
from grainmill.plans.registry import add, duck, table, view

VERDICTS = "('contradicted', 'insufficient_evidence', 'not_in_source', 'supported', 'weak')"
# text forms in SQL: bare object, repaired text; strictness is DuckDB's parser without trailing commas
_BARE = r"regexp_replace(trim(replace(regexp_replace(regexp_replace(raw_output, '(?i)^\s*(?:<channel\|?>\s*)?', ''), '(?i)```(?:json)?\s*', '', 'g'), '```', '')), '(?s)^[^{]*([{].*[}])[^}]*$', '\1')"
_FIXED = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(bare, '("\w[\w-]*")\s*[?]\s*:', '\1:', 'g'), '"\][}]{2}\],\s*"overallVerdict"', '"]}], "overallVerdict"', 'g'), '"[}]\],\s*"overallVerdict"', '"]}], "overallVerdict"', 'g'), ',(?:\s*,)*\s*([\]}])', '\1', 'g'))"""
_COMMA = r",\s*[\]}]"


def _good(c: str) -> str:
    return f"(CASE WHEN json_valid({c}) AND NOT regexp_matches({c}, '{_COMMA}') THEN coalesce(json_type({c}) = 'OBJECT' AND json_type({c}, '$.claims') = 'ARRAY', false) ELSE false END)"


_CLAIMS = """list_filter(CAST(json_extract(v, '$.claims[*]') AS JSON[]), lambda x: coalesce(json_type(x) = 'OBJECT' AND json_type(x, '$.claim') = 'VARCHAR' AND trim(json_extract_string(x, '$.claim')) <> '' AND json_extract_string(x, '$.verdict') IN """ + VERDICTS + ", false))"
_PARSED = f"""e AS ({duck(EVALS)}), o AS (SELECT *, {_BARE} AS bare FROM ({duck(OUTPUTS)})), f AS (SELECT *, {_FIXED} AS fixed FROM o),
 p AS (SELECT *, {_good('bare')} AS strict, {_good('bare')} OR {_good('fixed')} AS parsed, CASE WHEN {_good('bare')} THEN bare WHEN {_good('fixed')} THEN fixed END AS v FROM f),
 c AS (SELECT *, {_CLAIMS} AS claims FROM p)"""
_LIST = "'[''' || replace({0}, ',', ''', ''') || ''']'"
_VERDICT = "list_transform(claims, lambda x: json_extract_string(x, '$.verdict'))"
_QUOTES = "flatten(list_transform(list_filter(claims, lambda x: json_extract_string(x, '$.verdict') = 'supported'), lambda x: CAST(json_extract_string(x, '$.sourceQuotes[*]') AS VARCHAR[])))"
_FAILS = f"""CASE WHEN missing THEN [] WHEN NOT parsed THEN ['must_parse_json'] ELSE list_concat(list_filter([
 CASE WHEN len(claims) < min_claims THEN 'min_claims:' || len(claims) || '<' || min_claims END,
 CASE WHEN want IS NOT NULL AND NOT list_has_any({_VERDICT}, string_split(want, ',')) THEN 'any_claim_verdict missing ' || {_LIST.format('want')} END,
 CASE WHEN ban IS NOT NULL AND list_has_any({_VERDICT}, string_split(ban, ',')) THEN 'forbidden verdict present: ' || {_LIST.format('ban')} END,
 CASE WHEN allow IS NOT NULL AND len(list_filter({_VERDICT}, lambda x: NOT list_contains(string_split(allow, ','), x))) > 0 THEN 'verdict not in ' || {_LIST.format('allow')} END], lambda x: x IS NOT NULL),
 CASE WHEN quotes THEN list_transform(list_filter({_QUOTES}, lambda q: NOT contains(source_excerpt, q)), lambda q: 'invalid quote substring: ''' || left(q, 40) || '''') ELSE [] END) END"""
_CATEGORY = "coalesce(category, CASE WHEN starts_with(id, 'h-') THEN CASE " + " ".join(f"WHEN n BETWEEN {a} AND {b} THEN '{k}'" for k, spans in evaluate._RANGES.items() for a, b in spans) + " END END)"
_SCORED = f"""WITH {_PARSED}, j AS (SELECT e.*, c.raw_output, coalesce(c.parsed, false) AS parsed, coalesce(c.strict, false) AS strict, c.claims, c.id IS NULL AS missing, TRY_CAST(substr(e.id, 3, 3) AS INT) AS n FROM e LEFT JOIN c USING (id)),
 g AS (SELECT *, {_FAILS} AS fails FROM j), scored AS (SELECT *, NOT missing AND len(fails) = 0 AS passed, {_CATEGORY} AS cat, coalesce(list_contains(string_split(ban, ','), 'supported'), false) AS trap,
 coalesce(list_contains({_VERDICT}, 'supported'), false) AS said, CASE WHEN missing THEN 'missing_prediction' WHEN NOT parsed THEN 'parse_json' WHEN len(fails) = 0 THEN 'pass' WHEN starts_with(fails[1], 'min_claims') THEN 'min_claims'
 WHEN starts_with(fails[1], 'any_claim_verdict') THEN 'wrong_verdict' WHEN starts_with(fails[1], 'forbidden') THEN 'forbidden_verdict' WHEN contains(fails[1], 'invalid quote') THEN 'quote_invalid' ELSE 'wrong_verdict' END AS mode FROM g)"""


def evals(spark, d):
    e = view(spark, d, EVALS)
    many = lambda c: F.split(c, ",")
    expect = F.struct(F.lit(True).alias("must_parse_json"), F.col("min_claims").cast("int").alias("min_claims"), many("want").alias("any_claim_verdict"), many("ban").alias("forbidden_claim_verdict"), many("allow").alias("all_claim_verdicts_in"), F.col("quotes").alias("quotes_must_be_substrings"))
    return e.select("id", "row_ord", "source_excerpt", F.col("category").alias("eval_category"), expect.alias("expect"))


def outputs(spark, d):
    return view(spark, d, OUTPUTS)


def scored(spark, d):
    return evaluate.score(evals(spark, d), outputs(spark, d))


# JF1-JF5: parsing
def _parse(spark, d):
    o = outputs(spark, d)
    return o.select("id", jsonx.parse_strict("raw_output").isNotNull().alias("strict"), jsonx.parse_repaired("raw_output").isNotNull().alias("parsed"))


add("json_strict_and_repaired", _parse, f"WITH {_PARSED} SELECT id, strict, parsed FROM p")
add("json_bare_object", lambda s, d: outputs(s, d).select("id", jsonx.bare_object("raw_output").alias("bare")), f"WITH {_PARSED} SELECT id, bare FROM o")
add("json_repaired_text", lambda s, d: outputs(s, d).select("id", jsonx.repair("raw_output").alias("fixed")), f"WITH {_PARSED} SELECT id, fixed FROM f")
add(
    "json_parse_status",
    lambda s, d: outputs(s, d).select("id", jsonx.parse_status("raw_output").alias("status"), jsonx.parse_status("raw_output", False).alias("strict_status")),
    f"WITH {_PARSED}, t AS (SELECT *, 'parse_fail:' || CASE WHEN contains(raw_output, '{{') THEN 'Invalid JSON' ELSE 'No JSON object' END AS bad FROM p) SELECT id, CASE WHEN strict THEN 'ok' WHEN parsed THEN 'ok_repaired' ELSE bad END AS status, CASE WHEN strict THEN 'ok' ELSE bad END AS strict_status FROM t",
)


def _claims(spark, d):
    o = outputs(spark, d).select("id", F.posexplode(jsonx.clean_claims(jsonx.parse_repaired("raw_output"))).alias("pos", "c"))
    return o.select("id", F.col("pos").cast("long").alias("pos"), F.col("c.claim").alias("claim"), F.col("c.verdict").alias("verdict"), F.get("c.sourceQuotes", 0).alias("quote"))


add("json_clean_claims", _claims, f"WITH {_PARSED} SELECT id, CAST(i - 1 AS BIGINT) AS pos, json_extract_string(x, '$.claim') AS claim, json_extract_string(x, '$.verdict') AS verdict, json_extract_string(x, '$.sourceQuotes[0]') AS quote FROM (SELECT id, unnest(claims) AS x, generate_subscripts(claims, 1) AS i FROM c)")


def _first_object(spark, d):
    """The first object of a text that goes on after it."""
    e = table(spark, d, "events")
    return e.select("event_id", jsonx.first_object(F.concat(F.lit("see "), F.col("props"), F.lit(" and {more"))).alias("first"), jsonx.first_object(F.col("event_type")).isNull().alias("none"))


add("json_first_object", _first_object, "SELECT event_id, props AS first, true AS none FROM events")


def _serialised(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return e.select("event_id", jsonx.spaced_json(F.to_json(F.struct("event_id", "user_id", "event_type"))).alias("line"))


add("json_spaced", _serialised, """SELECT event_id, '{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "event_type": "' || event_type || '"}' AS line FROM events""")


def _inverted(spark, d):
    """Benchmark texts through an inverted index and back."""
    w = table(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", r"[ \n]+")).alias("p", "w"))
    index = w.groupBy("item_id", "w").agg(F.array_sort(F.collect_list("p")).alias("ps")).groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("m"))
    return index.select("item_id", F.md5(jsonx.invert_index("m")).alias("text_md5"))


add("inverted_index", _inverted, r"SELECT item_id, md5(regexp_replace(text, '[ \n]+', ' ', 'g')) AS text_md5 FROM benchmark")

# JF6, SF26, SF27, JN2
add(
    "score_rows",
    lambda s, d: scored(s, d).select("id", "missing", "parsed", "parsed_strict", "repaired_used", "checks_passed", F.array_join("failures", "; ").alias("failures"), "failure_mode", "category", "quote_row", "trap_row", "says_supported"),
    f"{_SCORED} SELECT id, missing, parsed, strict AS parsed_strict, parsed AND NOT strict AS repaired_used, passed AS checks_passed, array_to_string(fails, '; ') AS failures, mode AS failure_mode, cat AS category, quotes AS quote_row, trap AS trap_row, said AS says_supported FROM scored",
)
add("failure_modes", lambda s, d: scored(s, d).groupBy("failure_mode").agg(F.count(F.lit(1)).alias("n")), f"{_SCORED} SELECT mode AS failure_mode, count(*) AS n FROM scored GROUP BY mode")


def _rates_sql(where: str = "NOT missing") -> str:
    n = "count(*) FILTER (WHERE NOT missing)"
    over = lambda hit, base, empty: f"CASE WHEN {base} > 0 THEN round(count(*) FILTER (WHERE NOT missing AND {hit}) / {base}, 4) ELSE {empty} END"
    q, t = "count(*) FILTER (WHERE NOT missing AND quotes)", "count(*) FILTER (WHERE NOT missing AND trap)"
    return f"""count(*) AS total, {n} AS scored, {over('strict', n, '0')} AS json_parse_rate_strict, {over('parsed', n, '0')} AS json_parse_rate_with_repair, count(*) FILTER (WHERE NOT missing AND parsed AND NOT strict) AS repaired,
 {over('passed', n, '0')} AS expect_checks_pass_rate, {over('quotes AND passed', q, 'NULL')} AS quote_validity_rate, {over('trap AND said', t, 'NULL')} AS false_supported_rate"""


add("eval_summary", lambda s, d: evaluate.summary(scored(s, d)), f"{_SCORED} SELECT {_rates_sql()} FROM scored")
add("eval_summary_by_category", lambda s, d: evaluate.summary(scored(s, d), "category").withColumn("category", F.coalesce("category", F.lit("(none or all)"))), f"{_SCORED} SELECT coalesce(cat, '(none or all)') AS category, {_rates_sql()} FROM scored GROUP BY GROUPING SETS ((cat), ())")
add("category_pass_rates", lambda s, d: evaluate.category_rates(scored(s, d)), f"{_SCORED} SELECT cat AS category, count(*) FILTER (WHERE passed) AS passed, count(*) AS total, round(avg(passed::INT), 4) AS rate FROM scored WHERE cat IS NOT NULL AND NOT missing GROUP BY cat")
add("failing_rows", lambda s, d: evaluate.failing_rows(scored(s, d)).select("id"), f"{_SCORED} SELECT id FROM scored WHERE NOT passed")
add("failing_ids", lambda s, d: evaluate.failing_ids(scored(s, d), most=None).select(F.array_join("failing", ",").alias("failing")), f"{_SCORED} SELECT string_agg(id, ',' ORDER BY id COLLATE \"C\") AS failing FROM scored WHERE NOT passed")
add("ids_without_prediction", lambda s, d: evaluate.missing_ids(evals(s, d), outputs(s, d)), f"{_SCORED} SELECT id FROM scored WHERE missing")


def _batch(spark, d):
    o = outputs(spark, d).select("seconds", jsonx.parse_status("raw_output").alias("status"))
    return evaluate.batch_summary(o).select("rows", "ok", "repaired", "seconds", "mean_seconds")


add("batch_summary", _batch, f"WITH {_PARSED} SELECT count(*) AS rows, count(*) FILTER (WHERE parsed) AS ok, count(*) FILTER (WHERE parsed AND NOT strict) AS repaired, round(sum(seconds), 1) AS seconds, round(avg(seconds), 2) AS mean_seconds FROM p")


# AG3, AG4, AG17, AG18, PR21: slices and seeds
def _slices(spark, d):
    e, o = evals(spark, d), outputs(spark, d)
    return sets.score_slices({"holdout": (e.where("id like 'h-%'"), o), "legacy": (e.where("id like 'x-%' and row_ord % 2 = 0"), o), "more": (e.where("id like 'x-%' and row_ord % 2 = 1"), o)})


_SLICE = "CASE WHEN id LIKE 'h-%' THEN 'holdout' WHEN row_ord % 2 = 0 THEN 'legacy' ELSE 'more' END"
_REPORTS = f"{_SCORED}, reports AS (SELECT {_SLICE} AS slice, {_rates_sql()} FROM scored GROUP BY 1)"
_METRICS = f"""{_REPORTS}, metrics AS (SELECT 'combined_expect' AS metric, round(sum(expect_checks_pass_rate * scored) / sum(scored), 4) AS value FROM reports UNION ALL SELECT 'json_parse', round(sum(json_parse_rate_with_repair * scored) / sum(scored), 4) FROM reports
 UNION ALL SELECT 'quote_validity', quote_validity_rate FROM reports WHERE slice = 'holdout' UNION ALL SELECT 'false_supported', false_supported_rate FROM reports WHERE slice = 'holdout'
 UNION ALL SELECT 'supported_h', CAST(count(*) FILTER (WHERE passed AND n BETWEEN 1 AND 10) AS DOUBLE) FROM scored WHERE id LIKE 'h-%' UNION ALL SELECT 'core_legacy', CAST(count(*) FILTER (WHERE passed) AS DOUBLE) FROM scored WHERE {_SLICE} = 'legacy')"""
add("slice_reports", lambda s, d: _slices(s, d)[0], f"{_REPORTS} SELECT * FROM reports")
add("slice_gate_metrics", lambda s, d: _slices(s, d)[1], f"{_METRICS} SELECT metric, value FROM metrics")
add("slice_metric_rows", lambda s, d: gates.slice_metrics(_slices(s, d)[0]), f"{_REPORTS} SELECT slice, unnest(['expect_checks_pass_rate', 'quote_validity_rate', 'false_supported_rate']) AS metric, unnest([expect_checks_pass_rate, quote_validity_rate, false_supported_rate]) AS value FROM reports")
add("gate_pass_counts", lambda s, d: gates.gate_counts(scored(s, d)), f"{_SCORED} SELECT CAST(count(*) FILTER (WHERE passed AND id LIKE 'h-%' AND n BETWEEN 1 AND 10) AS DOUBLE) AS supported_h, CAST(count(*) FILTER (WHERE passed) AS DOUBLE) AS core_legacy FROM scored")


def _seeds(spark, d):
    """Category rates as if each were a seed: booleans and numbers in text count, words do not."""
    r = evaluate.category_rates(scored(spark, d)).select("rate", (F.col("rate") > 0.3).alias("good"), F.when(F.col("total") % 2 == 0, F.col("total").cast("string")).otherwise("n/a").alias("total_text"))
    return evaluate.mean_over_seeds(r, ["rate", "good", "total_text"])


add("mean_over_seeds", _seeds, f"{_SCORED}, r AS (SELECT count(*) AS total, round(avg(passed::INT), 4) AS rate FROM scored WHERE cat IS NOT NULL AND NOT missing GROUP BY cat) SELECT round(avg(rate), 4) AS rate, round(avg((rate > 0.3)::INT), 4) AS good, round(avg(CASE WHEN total % 2 = 0 THEN total END), 4) AS total_text FROM r")


# GT1-GT8, AG15
def _gate_sql(rules_: tuple) -> str:
    values = ", ".join(f"('{g}', '{m}', '{op}', {float(t)}::DOUBLE)" for g, m, op, t in rules_)
    return f"r(gate, metric, op, threshold) AS (VALUES {values}), gated AS (SELECT gate, metric, value, op, threshold, coalesce(CASE WHEN op = '>=' THEN value >= threshold ELSE value <= threshold END, false) AS passed FROM r LEFT JOIN metrics USING (metric))"


for _name, _rules in (("tier2", gates.QUALITY), ("default", gates.DEFAULT), ("baseline", gates.BASELINE)):
    add(f"gates_{_name}", lambda s, d, r=_rules: gates.gates(_slices(s, d)[1], r), f"{_METRICS}, {_gate_sql(_rules)} SELECT * FROM gated")
add("gates_verdict", lambda s, d: gates.verdict(gates.gates(_slices(s, d)[1], gates.DEFAULT)), f"{_METRICS}, {_gate_sql(gates.DEFAULT)} SELECT bool_and(passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed FROM gated")


def _body_gates(spark, d):
    s = _slices(spark, d)
    rows = s[0].where("slice = 'holdout'").select(F.lit("rows").alias("metric"), F.col("scored").cast("double").alias("value"))
    return gates.gates(s[1].unionByName(rows), gates.body(False))


_BODY = _METRICS.rstrip().removesuffix(")") + " UNION ALL SELECT 'rows', CAST(scored AS DOUBLE) FROM reports WHERE slice = 'holdout')"
add("gates_body", _body_gates, f"{_BODY}, {_gate_sql(gates.body(False))} SELECT * FROM gated")


def _ab(spark, d):
    """The even half of the rows against the odd half, with a few hard rows that must all pass."""
    s = scored(spark, d).join(evals(spark, d).select("id", "row_ord"), "id")
    one = lambda w: evaluate.summary(s.where(w)).select(F.col("expect_checks_pass_rate").alias("combined_expect"), F.col("json_parse_rate_strict").alias("multi_claim"), F.col("quote_validity_rate").alias("quote_validity"))
    return gates.ab_decision(one("row_ord % 2 = 1"), one("row_ord % 2 = 0"), s.where("id in ('h-001', 'h-014', 'h-027')").select("checks_passed"))


add(
    "ab_decision",
    _ab,
    f"""{_SCORED}, base AS (SELECT {_rates_sql()} FROM scored WHERE row_ord % 2 = 1), cand AS (SELECT {_rates_sql()} FROM scored WHERE row_ord % 2 = 0), h AS (SELECT coalesce(bool_and(passed), true) AS ok FROM scored WHERE id IN ('h-001', 'h-014', 'h-027'))
 SELECT round(cand.expect_checks_pass_rate - base.expect_checks_pass_rate, 4) AS delta, cand.json_parse_rate_strict AS multi_claim, h.ok AS hard_ok,
 CASE WHEN cand.expect_checks_pass_rate - base.expect_checks_pass_rate >= 0.03 AND cand.json_parse_rate_strict >= 0.8 AND coalesce(cand.quote_validity_rate, 0) >= coalesce(base.quote_validity_rate, 0) AND h.ok THEN 'adopt' ELSE 'defer' END AS decision FROM base, cand, h""",
)


def _probe(spark, d):
    """Every category as a probe of its own."""
    s = evaluate.summary(scored(spark, d).where("category is not null"), "category").where("category is not null")
    m = s.select("category", (F.col("json_parse_rate_with_repair") + 0.4).alias("parse_strict_rate"), (F.col("expect_checks_pass_rate") + 0.4).alias("combined_expect_rate"), F.col("quote_validity_rate"), F.col("false_supported_rate"))
    return gates.probe_verdict(m).select("category", "verdict")


add(
    "probe_verdicts",
    _probe,
    f"{_SCORED}, r AS (SELECT cat AS category, {_rates_sql()} FROM scored WHERE cat IS NOT NULL GROUP BY cat), m AS (SELECT category, json_parse_rate_with_repair + 0.4 AS p, expect_checks_pass_rate + 0.4 AS e, coalesce(quote_validity_rate, 0) AS q FROM r) SELECT category, CASE WHEN p < 0.9 OR e < 0.6 THEN 'WAIT' WHEN p >= 0.95 AND e >= 0.75 AND q >= 0.9 THEN 'GO (later)' WHEN p >= 0.85 AND e >= 0.7 THEN 'AMBIGUOUS' ELSE 'WEAK' END AS verdict FROM m",
)
_SMOKE = ["h-001", "h-010", "h-014", "h-053"]
add("smoke_gate", lambda s, d: gates.smoke(scored(s, d), _SMOKE), f"{_SCORED} SELECT count(*) AS rows, count(*) = 4 AND coalesce(bool_and(passed), false) AS passed FROM scored WHERE id IN ('h-001', 'h-010', 'h-014', 'h-053')")


def _matrix(spark, d):
    """Failure modes by version: strict scoring and scoring with repair."""
    e, o = evals(spark, d), outputs(spark, d)
    v = evaluate.score(e, o).select("id", F.lit("v1.10").alias("version"), "failure_mode").unionByName(evaluate.score(e.where("row_ord % 3 > 0"), o, False).select("id", F.lit("v1.4a").alias("version"), "failure_mode"))
    return evaluate.version_matrix(v.unionByName(v.withColumn("version", F.lit("v9"))), ["v1.4a", "v1.10"]).select("id", F.col("`v1.4a`").alias("strict"), F.col("`v1.10`").alias("repaired"))


add("version_matrix", _matrix, f"{_SCORED} SELECT id, CASE WHEN row_ord % 3 = 0 THEN '—' WHEN missing THEN 'missing_prediction' WHEN NOT strict THEN 'parse_json' ELSE mode END AS strict, mode AS repaired FROM scored")


def _natural(spark, d):
    v = table(spark, d, "part").select("p_partkey", F.concat(F.lit("v1."), (F.col("p_partkey") % 120).cast("string"), F.when(F.col("p_size") % 2 == 0, "a").otherwise("")).alias("v"))
    return v.select("p_partkey", evaluate.natural_version(F.col("v")).alias("sort_key"))


add("natural_versions", _natural, "SELECT p_partkey, '0000000v.00000001.' || lpad(CAST(p_partkey % 120 AS VARCHAR), 8, '0') || CASE WHEN p_size % 2 = 0 THEN '.0000000a' ELSE '' END AS sort_key FROM part")

# FL5-FL7: validation
_RAW = """SELECT p_partkey AS line, CASE p_partkey % 15 WHEN 0 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "the cat", "meta": {{}}, "output": {{"claims": [{{"claim": "c", "verdict": "supported", "sourceQuotes": ["the  cat"]}}]}}}}'
 WHEN 1 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{}}, "output": {{"claims": [{{"claim": "c", "verdict": "supported", "sourceQuotes": []}}, {{"claim": " ", "verdict": "weak"}}, {{"claim": "c", "verdict": "nope"}}]}}}}'
 WHEN 2 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p"}}' WHEN 3 THEN '{{"id": "", "task": "nope"}}' WHEN 4 THEN '{{"id": "a", "task": "webpage_classify", "output": {{}}}}' WHEN 5 THEN '{{"id": "a", "task": "doc_extract"}}' WHEN 6 THEN 'not json'
 WHEN 7 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{"doc_id": "d", "language": "ar", "excerpt_mode": "paragraph"}}, "output": {{"claims": []}}}}'
 WHEN 8 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{"doc_id": "d"}}, "output": {{"claims": [], "overallVerdict": "best"}}, "expect": 3}}'
 WHEN 9 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{}}, "output": {{"claims": 4}}}}' WHEN 10 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{}}, "output": 5}}'
 WHEN 11 THEN '{{"id": "a", "task": "webpage_metadata", "url": "u", "output": {{"suggested_type": "article"}}}}' WHEN 12 THEN '{{"id": "a", "task": "issue_explain", "issue_code": "i", "issue_context": "c", "output": {{}}}}'
 WHEN 13 THEN '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x ' || p_name || '", "meta": {{}}, "output": {{"claims": [{{"claim": "c", "verdict": "supported", "sourceQuotes": ["' || p_name || '", "no such"]}}]}}}}'
 ELSE '{{"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {{}}, "expect": {{"min_claims": 1}}}}' END AS raw FROM {part}"""
_WANT = {0: "", 1: "invalid verdict; blank claim; supported claim requires sourceQuotes", 2: "missing source_excerpt; missing meta; neither output nor expect", 3: "missing id; unknown task", 4: "output.recommended_csl_type required", 5: "", 6: "invalid JSON",
         7: "arabic_slice required", 8: "invalid overallVerdict; meta.excerpt_mode required; meta.language required; expect is no object", 9: "claims is no list", 10: "output is no object", 11: "missing page_signals", 12: "output.explanation required", 13: "quote not in excerpt", 14: ""}
add(
    "record_validation",
    lambda s, d: view(s, d, _RAW).select("line", F.array_join(rules.grounding_errors("raw"), "; ").alias("errors")),
    "SELECT p_partkey AS line, CASE p_partkey % 15 " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in _WANT.items()) + " END AS errors FROM part",
)


def _pilot(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("doc_id"), F.when(F.col("p_partkey") % 3 == 0, "paragraph").when(F.col("p_partkey") % 3 == 1, "page").alias("excerpt_mode"), F.when(F.col("p_size") % 4 == 0, "ar").when(F.col("p_size") % 4 == 1, "").otherwise("en").alias("language"), F.when(F.col("p_size") % 6 > 0, "{}").alias("expect"))


_PILOT = """pilot AS (SELECT p_partkey AS line, CASE p_size % 4 WHEN 0 THEN 'ar' WHEN 1 THEN '' ELSE 'en' END AS language, array_to_string(list_filter([CASE WHEN p_partkey % 5 = 0 THEN 'missing meta.doc_id' END, CASE WHEN p_partkey % 3 = 2 THEN 'missing meta.excerpt_mode' END,
 CASE WHEN p_size % 4 = 1 THEN 'missing meta.language' END, CASE WHEN p_partkey % 3 <> 0 THEN 'excerpt_mode must be paragraph' END, CASE WHEN p_size % 6 = 0 THEN 'missing expect' END], lambda x: x IS NOT NULL), '; ') AS errors FROM part)"""
add("pilot_validation", lambda s, d: _pilot(s, d).select("line", F.array_join(rules.pilot_errors(), "; ").alias("errors")), f"WITH {_PILOT} SELECT line, errors FROM pilot")
add(
    "pilot_coverage",
    lambda s, d: sets.pilot_coverage(_pilot(s, d), 30).select(F.coalesce("language", F.lit("(all)")).alias("language"), "rows", "valid", F.coalesce(F.col("enough").cast("string"), F.lit("")).alias("enough")),
    f"WITH {_PILOT} SELECT coalesce(language, '(all)') AS language, count(*) AS rows, count(*) FILTER (WHERE errors = '') AS valid, coalesce(CAST(CASE WHEN language IS NULL THEN count(*) FILTER (WHERE errors = '') >= 30 END AS VARCHAR), '') AS enough FROM pilot GROUP BY GROUPING SETS ((language), ())",
)


def _audit(spark, d):
    """Labels spelt from papers' sentences: verdicts that do not go with their claim and quote."""
    g = generate.Generator()
    p = g.picked(papers(spark, d)).where("s_numeric is not null")
    c = F.col
    k = F.pmod(c("row_ord"), F.lit(8))
    claim = lambda text, verdict, quote: F.array(F.struct(text.alias("claim"), F.lit(verdict).alias("verdict"), (F.array(quote) if quote is not None else F.array().cast("array<string>")).alias("sourceQuotes"), F.array().cast("array<string>").alias("rationale"), F.lit(False).alias("hasNumericClaim")).cast(f"{jsonx.CLAIM}"))
    claims = (
        F.when(k == 0, claim(c("s_numeric"), "supported", c("s_numeric"))).when(k == 1, claim(F.lit("Wholly other words stand here 7"), "supported", c("s_numeric"))).when(k == 2, claim(c("s_numeric"), "contradicted", c("s_numeric")))
        .when(k == 3, claim(c("s_numeric"), "weak", c("s_numeric"))).when(k == 4, claim(F.lit(" "), "supported", None)).when(k == 5, claim(F.lit("Nothing of it"), "not_in_source", c("s_numeric")))
        .when(k == 6, claim(c("s_numeric"), "supported", F.lit("no such quote here")))
    )
    row_id = F.concat(F.when(c("row_ord") % 3 == 0, "l3-multi-").otherwise("l3-"), c("corpus_id"))
    return p.select("corpus_id", F.array_join(rules.label_audit(row_id, c("abstract"), c("abstract"), F.coalesce(claims, F.array().cast(f"array<{jsonx.CLAIM}>"))), "; ").alias("problems"))


_HEDGED = r"'(?i)\b(?:may|might|could|suggest|suggested|possibly|appears?|seems?|hypothesiz\w*|proposed|preliminary|limited|unclear|potential)\b'"
add(
    "label_audit",
    _audit,
    f"""WITH {_PAPERS}, n AS (SELECT *, {PICKS['numeric']} AS s FROM papers), k AS (SELECT *, row_ord % 8 AS k FROM n WHERE s IS NOT NULL) SELECT corpus_id, array_to_string(list_concat(CASE WHEN k = 7 THEN ['no_claims'] ELSE [] END, CASE WHEN row_ord % 3 = 0 THEN ['multi_needs_two'] ELSE [] END,
 CASE k WHEN 1 THEN CASE WHEN list_contains(regexp_extract_all(s, '[0-9]+(?:[.][0-9]+)?'), '7') THEN [] ELSE ['claim_not_aligned@0'] END WHEN 2 THEN ['contradiction_invisible@0'] WHEN 3 THEN list_concat(['hedge_removal_invisible@0'], CASE WHEN regexp_matches(s, {_HEDGED}) THEN [] ELSE ['quote_without_hedge@0'] END, ['numbers_align@0']) WHEN 4 THEN ['blank_claim@0', 'quotes_missing@0'] WHEN 5 THEN ['quote_present@0']
 WHEN 6 THEN ['quote_not_in_excerpt@0', 'claim_not_aligned@0'] ELSE [] END), '; ') AS problems FROM k""",
)


def _keys(spark, d):
    o = outputs(spark, d).select("id", jsonx.first_object("raw_output").alias("o"))
    return o.where("o is not null").select("id", rules.claim_keys_ordered("o").alias("ordered"), rules.claim_keys_ordered(F.lit('{"claim":1,"verdict":2,"sourceQuotes":3,"rationale":4,"hasNumericClaim":5}')).alias("fixed"))


add("claim_key_order", _keys, f"WITH {_PARSED} SELECT id, false AS ordered, true AS fixed FROM o WHERE regexp_matches(raw_output, '[{{]') AND row_ord % 13 NOT IN (2, 7, 8)")


# PR15, PR17, JN7
def _boost(spark, d):
    """Papers with a human label: inner join, verdict by synonym, claim from the passage's head."""
    lab = table(spark, d, "labels").groupBy(F.col("doc_id").alias("row_ord")).agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    rows = papers(spark, d).join(lab, "row_ord").select(F.col("corpus_id").alias("id"), F.col("abstract").alias("passage"), F.col("abstract").alias("source_excerpt"), F.when(F.col("t") == 1, " Contradict").when(F.col("q") == 1, "support").otherwise("weak").alias("label"))
    b = generate.boost_rows(rows.where("passage is not null"))
    c = F.get("claims", 0)
    return b.select("id", c["claim"].alias("claim"), c["verdict"].alias("verdict"), c["hasNumericClaim"].alias("numeric"))


add(
    "boost_rows",
    _boost,
    f"SELECT corpus_id AS id, left(abstract, 240) AS claim, CASE WHEN t = 1 THEN 'contradicted' WHEN q = 1 THEN 'supported' ELSE 'weak' END AS verdict, regexp_matches(left(abstract, 240), '[0-9]') AS numeric FROM ({duck(PAPERS)}) JOIN (SELECT doc_id AS row_ord, max(quality) AS q, max(toxic) AS t FROM labels GROUP BY 1) USING (row_ord) WHERE abstract IS NOT NULL",
)


def _sheet(spark, d):
    return generate.review_sheet(generate.Generator().rows(papers(spark, d), kinds=["con"])).drop("id")


_AT = "(instr(whole, left(s_numeric, 80)))"
add(
    "review_sheet",
    _sheet,
    f"""WITH {_SAID} SELECT 'contradicted' AS verdict, left(wrong, 200) AS claim, s_numeric AS quote, left(passage, 320) AS passage, CASE WHEN greatest({_AT} - 50, 1) > 1 THEN '...' ELSE '' END || substr(whole, greatest({_AT} - 50, 1), least(length(whole), {_AT} - 1 + 180) - greatest({_AT} - 50, 1) + 1) ||
 CASE WHEN least(length(whole), {_AT} - 1 + 180) < length(whole) THEN '...' ELSE '' END AS preview FROM (SELECT *, {neutral('wrong', 'con')} AS passage FROM said WHERE contains(abstract, s_numeric) AND wrong IS NOT NULL AND NOT contains(abstract, wrong) AND left(wrong, 200) <> left(s_numeric, 200))""",
)
add(
    "verdict_synonyms",
    lambda s, d: outputs(s, d).select("id", generate.mapped(F.get(F.split("name", " "), 0), {"red": "supported", "old": "weak"}).alias("verdict")),
    f"SELECT id, CASE split_part(name, ' ', 1) WHEN 'red' THEN 'supported' WHEN 'old' THEN 'weak' ELSE split_part(name, ' ', 1) END AS verdict FROM ({duck(OUTPUTS)})",
)

"""Queries of the row generator: sentence pickers, paraphrases, every row kind, numbering, histograms.

Each calls ``operators.generate`` on the whole paper relation; the SQL says the same from the
relation's text alone.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import corpus, generate, sets, windows
from grainmill.plans.inputs import PAPERS
from grainmill.plans.registry import add, duck, view

GEN = generate.Generator()
POOLS = GEN.pools
_HEDGE = r"(?i)\b(?:" + "|".join(T.HEDGES) + r")\b"
_HEAD, _RESULT = T.METHODS_HEAD.replace("(?iU)", "(?i)"), T.RESULTS.replace("(?iU)", "(?i)")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fill(template: str, value: str) -> str:
    """A template as SQL: ``%s`` is the value, ``%%`` a percent sign."""
    parts = [lit(x.replace("%%", "%")) for x in template.split("%s")]
    return "(" + f" || {value} || ".join(parts) + ")"


def like(s: str, pattern: str) -> str:
    return f"regexp_matches({s}, {lit(pattern)})"


def sents(c: str, least: int = 40) -> str:
    return rf"list_filter(list_transform(string_split(regexp_replace(trim({c}, E' \t\n\r'), '([.!?])[ \t\n\r\f\v]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: length(s) >= {least})"


def squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[ \t\n\r\f\v]+', ' ', 'g'))"


def draw(purpose: str) -> str:
    return f"'42|{purpose}|' || corpus_id"


def share(purpose: str, n: str) -> str:
    return f"CAST(CAST('0x' || left(md5({draw(purpose)}), 8) AS BIGINT) % {n} AS INT)"


def pick(options: str, purpose: str) -> str:
    return f"(CASE WHEN len({options}) > 0 THEN ({options})[1 + {share(purpose, f'len({options})')}] END)"


def shuffled(options: str, purpose: str) -> str:
    return f"list_transform(list_sort(list_transform({options}, lambda o: {{'h': md5({draw(purpose)} || '|' || o), 'o': o}})), lambda x: x.o)"


def absent(claim: str, text: str) -> str:
    w = f"regexp_extract_all(lower({claim}), '[a-z]{{5,}}')"
    return f"(len({w}) < 3 OR len(list_filter({w}, lambda w: contains(lower({text}), w))) < greatest(2, len({w}) // 2))"


def absent_claim(text: str, purpose: str) -> str:
    order = shuffled("[" + ", ".join(map(lit, POOLS.absent)) + "]", purpose)
    return f"coalesce(list_filter({order}, lambda c: {absent('c', text)})[1], ({order})[1])"


def numbers(c: str) -> str:
    return rf"regexp_extract_all({c}, '\d+(?:[.]\d+)?')"


def numbers_aligned(claim: str, source: str) -> str:
    return f"(len({numbers(claim)}) > 0 AND len(list_filter({numbers(claim)}, lambda n: NOT list_contains({numbers(source)}, n))) = 0)"


def meaning_aligned(claim: str, source: str) -> str:
    a, b = (f"list_distinct(regexp_extract_all(lower({x}), '[a-z]{{5,}}'))" for x in (claim, source))
    return f"(len({a}) >= 2 AND len(list_filter({a}, lambda w: list_contains({b}, w))) >= greatest(2, len({a}) // 3))"


def aligned(claim: str, source: str) -> str:
    return f"(CASE WHEN len({numbers(claim)}) > 0 THEN {numbers_aligned(claim, source)} ELSE {meaning_aligned(claim, source)} END)"


def paraphrase(s: str) -> str:
    out = []
    for p, templates in POOLS.numeric:
        n = f"replace(regexp_extract({s}, {lit('(?i)' + p)}, 1), ',', '')"
        out.append(f"WHEN {like(s, '(?i)' + p)} THEN {pick('[' + ', '.join(fill(t, n) for t in templates) + ']', 'template')}")
    for p, new in POOLS.rewrites:
        said = squeeze(f"regexp_replace({s}, {lit('(?i)' + p)}, {lit(new.replace('%s', chr(92) + '1'))})")
        out.append(f"WHEN {like(s, '(?i)' + p)} AND length({said}) BETWEEN 20 AND 200 AND lower({said}) <> lower({s}) THEN {said}")
    return f"(CASE WHEN length(trim({s})) < 30 THEN NULL {' '.join(out)} END)"


def semantic_paraphrase(s: str) -> str:
    known = " ".join(f"WHEN {like(s, '(?i)' + p)} THEN {lit(t)}" for p, t in POOLS.semantic)
    return f"(CASE WHEN {like(s, '[0-9]')} THEN NULL {known} ELSE {paraphrase(s)} END)"


def surname(n: str) -> str:
    return f"(CASE WHEN contains({n}, ',') THEN trim(split_part({n}, ',', 1)) ELSE string_split(trim({n}), ' ')[-1] END)"


FIRST = f"coalesce(nullif({surname('authors[1]')}, ''), 'Unknown')"
CITE = f"('(' || CASE WHEN len(authors) > 2 THEN {FIRST} || ' et al.' WHEN len(authors) = 2 THEN {FIRST} || ' & ' || {surname('authors[2]')} ELSE {FIRST} END || ', ' || coalesce(CAST(nullif(year, 0) AS VARCHAR), 'n.d.') || ')')"


def bare(core: str) -> str:
    return f"regexp_replace(trim({core}), '[.!?]$', '')"


def direct(core: str) -> str:
    return f"({bare(core)} || ' ' || cite || '.')"


def neutral(core: str, purpose: str) -> str:
    opener = pick("[" + ", ".join(map(lit, POOLS.openers)) + "]", f"opener-{purpose}")
    body = bare(core)
    return f"({opener} || CASE WHEN {opener} <> '' AND NOT {like(body, _HEAD)} THEN lower(left({body}, 1)) || substr({body}, 2) ELSE {body} END || ' ' || cite || '.')"


def short(s: str, most: int) -> str:
    q = squeeze(s)
    at = rf"length(regexp_extract({q}, '^(.*?)\d', 1))"
    return f"(CASE WHEN length({q}) <= {most} THEN {q} WHEN {like(q, '[0-9]')} THEN trim(substr({q}, greatest(0, {at} - 30) + 1, {most})) ELSE trim(left({q}, {most})) END)"


def flip(s: str) -> str:
    parts = lit(r"(?s)^(.*?)([0-9]+(?:[.][0-9]+)?)(.*)$")
    head, num, tail = (f"regexp_extract({s}, {parts}, {i})" for i in (1, 2, 3))
    n = f"TRY_CAST({num} AS DOUBLE)"
    return f"(CASE WHEN {like(s, '[0-9]')} AND length({head}) < 200 THEN {head} || CASE WHEN {n} >= 1 THEN CAST(CAST(floor({n} * 1.4 + 1) AS BIGINT) AS VARCHAR) ELSE CAST(round({n} + 0.15, 2) AS VARCHAR) END || {tail} END)"


def unhedged(s: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(regexp_replace({s}, {lit(_HEDGE)}, '', 'g'), '[ \t\n\r\f\v]{{2,}}', ' ', 'g')), '[ \t\n\r\f\v]+([,.])', '\1', 'g')"


def only(test: str) -> str:
    return f"list_filter(sents, lambda s: {test})"


_SCORE = f"(CASE WHEN {like('s', '[0-9]')} THEN 2 ELSE 0 END + CASE WHEN {like('s', _RESULT)} THEN 2 ELSE 0 END - CASE WHEN {like('s', _HEAD)} THEN 1 ELSE 0 END)"
_METHODS = f"array_to_string({only(like('s', _HEAD) + ' OR ' + like('s', '(?i)' + generate.METHODS_VERB))}[1:3], ' ')"
_TWO_FIRST = "array_to_string(sents[1:2], ' ')"
_NUMERIC = only(like("s", "[0-9]"))
PICKS = {
    "claim": f"coalesce(list_sort(list_transform(sents, lambda s: {{'k': -{_SCORE}, 'h': md5({draw('claim')} || '|' || s), 's': s}}))[1].s, CASE WHEN length(abstract) >= 40 THEN trim(left(abstract, 200)) END)",
    "hedged": pick(only(like("s", _HEDGE)), "hedged"),
    "numeric": f"coalesce({pick(only(like('left(s, 200)', '[0-9]')), 'numeric')}, {pick(_NUMERIC, 'numeric')})",
    "methods": f"(CASE WHEN length({_METHODS}) >= 80 THEN {_METHODS} END)",
    "thin": f"coalesce(CASE WHEN length({_METHODS}) >= 80 THEN {_METHODS} END, CASE WHEN len(sents) >= 2 AND length({_TWO_FIRST}) >= 80 THEN {_TWO_FIRST} END)",
    "results": pick(only(f"{like('s', _RESULT)} AND NOT {like('s', _HEAD)}"), "results"),
    "two": f"(CASE WHEN len({_NUMERIC}) >= 2 THEN {shuffled(_NUMERIC, 'two')}[1:2] END)",
    "semantic": pick(only(f"NOT {like('s', '[0-9]')} AND {like('s', _RESULT)}"), "semantic"),
    "polarity": pick(only(like("s", "(?i)" + generate.POLARITY)), "polarity"),
    "partial": pick(only(like("s", "(?i)" + generate.PARTIAL)), "partial"),
}
_PAPERS = f"papers AS (SELECT *, {CITE} AS cite, {sents('abstract')} AS sents, {squeeze('abstract')} AS whole FROM ({duck(PAPERS)}) WHERE length(abstract) >= 120)"
_PICKED = f"{_PAPERS}, picked AS (SELECT *, " + ", ".join(f"{v} AS s_{k}" for k, v in PICKS.items()) + " FROM papers)"
_SAID = f"{_PICKED}, said AS (SELECT *, coalesce(s_results, s_claim) AS s_partly, {paraphrase('s_claim')} AS p_claim, {paraphrase('s_numeric')} AS p_numeric, {semantic_paraphrase('s_semantic')} AS p_semantic, {semantic_paraphrase('coalesce(s_results, s_claim)')} AS p_partly, {flip('s_numeric')} AS wrong, {unhedged('s_hedged')} AS bold, {absent_claim('abstract', 'absent')} AS nis, {absent_claim('s_thin', 'absent-thin')} AS away FROM picked)"


def papers(spark, d):
    return view(spark, d, PAPERS)


# SF13: pickers, SF12: paraphrases
for _k, _v in PICKS.items():
    _flat = "array_to_string(s, '|')" if _k == "two" else "s"

    def _run(spark, d, k=_k):
        p = papers(spark, d).where(F.length("abstract") >= 120).withColumn("sents", T.sentences("abstract", 40))
        pickers = {"claim": GEN.claim_sentence, "hedged": GEN.hedged, "numeric": GEN.numeric, "methods": GEN.methods_slice, "thin": GEN.thin_slice, "results": GEN.results_sentence, "two": GEN.two_numeric, "semantic": GEN.semantic_sentence, "polarity": GEN.polarity_sentence, "partial": GEN.partial_response}
        s = pickers[k]()
        return p.select("corpus_id", (F.array_join(s, "|") if k == "two" else s).alias("s"))

    add(f"pick_{_k}", _run, f"WITH {_PAPERS} SELECT corpus_id, {_flat} AS s FROM (SELECT corpus_id, {_v} AS s FROM papers)")

add(
    "pick_absent",
    lambda spark, d: papers(spark, d).where(F.length("abstract") >= 120).select("corpus_id", GEN.absent_claim().alias("s")),
    f"WITH {_PAPERS} SELECT corpus_id, {absent_claim('abstract', 'absent')} AS s FROM papers",
)
add(
    "pick_claim_short",
    lambda spark, d: papers(spark, d).where(F.length("abstract") < 120).withColumn("sents", T.sentences("abstract", 100)).select("corpus_id", GEN.claim_sentence().alias("s")),
    f"WITH p AS (SELECT *, {sents('abstract', 100)} AS sents FROM ({duck(PAPERS)}) WHERE length(abstract) < 120) SELECT corpus_id, {PICKS['claim']} AS s FROM p",
)
_EACH = f"WITH {_PAPERS}, each AS (SELECT corpus_id, unnest(sents) AS s FROM papers)"


def _each(spark, d):
    return papers(spark, d).where(F.length("abstract") >= 120).select("corpus_id", F.explode(T.sentences("abstract", 40)).alias("s"))


add("paraphrases", lambda spark, d: _each(spark, d).select("corpus_id", "s", GEN.paraphrase(F.col("s")).alias("said")), f"{_EACH} SELECT corpus_id, s, {paraphrase('s')} AS said FROM each")
add("semantic_paraphrases", lambda spark, d: _each(spark, d).select("corpus_id", "s", GEN.semantic_paraphrase(F.col("s")).alias("said")), f"{_EACH} SELECT corpus_id, s, {semantic_paraphrase('s')} AS said FROM each")


# PR5, PR6
def passage_styles(spark, d):
    """A paper's citation, and its first words as direct and as neutral passage."""
    p = papers(spark, d)
    head = F.left("abstract", F.lit(50))
    return p.select("corpus_id", GEN.cite().alias("cite"), GEN.direct(head).alias("direct"), GEN.neutral(head, "sup").alias("neutral"))


add("passage_styles", passage_styles, f"SELECT corpus_id, cite, {direct('left(abstract, 50)')} AS direct, {neutral('left(abstract, 50)', 'sup')} AS neutral FROM (SELECT *, {CITE} AS cite FROM ({duck(PAPERS)}))")

# PR8: row kinds. (order, kind, guard, passage, excerpt, mode, overall, claims); a claim: text, verdict, quote, why, numeric
_QUOTE = "(CASE WHEN length({0}) <= 200 THEN {0} ELSE {1} END)"
_A, _B = "s_two[1]", "s_two[2]"
_C0 = fill(POOLS.multi[0], f"{numbers(_A)}[1]")
_C1 = f"(CASE WHEN contains({_B}, '%') THEN {fill(POOLS.multi[1], numbers(_B) + '[1]')} ELSE left({short(_B, 60)}, 60) END)"
_X, _Y = (f"trim(regexp_extract(s_polarity, {lit('(?i)' + generate.ASSOCIATION)}, {i}))" for i in (1, 2))
_DENIED = f"(CASE WHEN {_X} <> '' AND {_Y} <> '' THEN 'There was no association between ' || {_X} || ' and ' || {_Y} ELSE 'There was no association between the exposure and the outcome' END)"
_OVER = pick("[" + ", ".join(map(lit, POOLS.overclaims)) + "]", "over")
_SCOPE = [pick("[" + ", ".join(lit(x[i]) for x in POOLS.scope) + "]", "scope") for i in range(3)]
_TOLD = f"coalesce(p_partly, {short('s_partly', 90)})"
_ABSENT_WHY = "'The excerpt does not speak of this'"


def _num(c: str) -> str:
    return like(c, "[0-9]")


def _inside(s: str) -> str:
    return f"contains(abstract, {s})"


def _supported(s: str, said: str, tag: str, at: int, more: str = "true") -> list[tuple]:
    fits = f"{_inside(s)} AND {aligned(said, s)} AND {more}"
    claim = [(said, "supported", s, lit(POOLS.supported), _num(said))]
    return [
        (at, "supp", f"{fits} AND {squeeze(said)} <> {squeeze(s)}", neutral(said, f"supp{tag}"), "whole", "full", "support", claim),
        (at + 1, "sentence", fits, direct(said), s, "sentence", "support", claim),
        (at + 2, "chunk", fits, neutral(said, f"chunk{tag}"), "whole", "chunked", "support", claim),
    ]


_KINDS: list[tuple] = [
    (1, "sup", _inside("s_claim"), neutral("s_claim", "sup"), "whole", "full", "support", [("s_claim", "supported", "s_claim", None, _num("s_claim"))]),
    *_supported("s_claim", "p_claim", "", 2),
    (5, "con", f"{_inside('s_numeric')} AND wrong IS NOT NULL AND NOT {_inside('wrong')} AND left(wrong, 200) <> left(s_numeric, 200)", neutral("wrong", "con"), "whole", "full", "weak", [("wrong", "contradicted", "s_numeric", "'The number differs from the source'", "true")]),
    *_supported("s_numeric", "p_numeric", "-number", 6, "s_numeric IS DISTINCT FROM s_claim"),
    (9, "weak", f"{_inside('s_hedged')} AND length(bold) >= 30 AND left(bold, 200) <> left(s_hedged, 200) AND NOT {numbers_aligned('bold', 's_hedged')}", neutral("bold", "weak"), "whole", "full", "weak", [("bold", "weak", "s_hedged", "'The source hedges what the passage asserts'", _num("bold"))]),
    (10, "nis", "true", neutral("nis", "nis"), "whole", "full", "unrelated", [("nis", "not_in_source", None, _ABSENT_WHY, _num("nis"))]),
    (11, "nisthin", f"s_thin IS NOT NULL AND {absent('away', 's_thin')}", direct("away"), "s_thin", "sentence", "unrelated", [("away", "not_in_source", None, _ABSENT_WHY, _num("away"))]),
    (12, "semantic", f"{_inside('s_semantic')} AND {meaning_aligned('p_semantic', 's_semantic')}", direct("p_semantic"), "s_semantic", "sentence", "support", [("p_semantic", "supported", "s_semantic", lit(POOLS.meant), "false")]),
    (13, "pol", f"{_inside('s_polarity')} AND {like('s_polarity', '(?i)associat(?:ion|ed)')}", direct(_DENIED), "s_polarity", "sentence", "weak", [(_DENIED, "contradicted", "s_polarity", "'The source reports an association'", _num(_DENIED))]),
    (14, "over", _inside("s_partial"), direct(_OVER), "s_partial", "sentence", "weak", [(_OVER, "contradicted", "s_partial", "'The source reports a limited effect'", _num(_OVER))]),
    (15, "multi", "s_two IS NOT NULL", direct(f"({_C0} || ' with ' || {_C1})"), f"left({_A} || ' ' || {_B}, 1800)", "sentence", "support",
     [(_C0, "supported", _QUOTE.format(_A, short(_A, 60)), None, "true"), (_C1, "supported", _QUOTE.format(_B, short(_B, 60)), None, "true")]),
    (16, "multip", _inside("s_partly"), direct(f"(regexp_replace({_TOLD}, '[.]+$', '') || ', and ' || {_SCOPE[1]})"), f"s_partly || ' ' || {_SCOPE[0]}", "sentence", "weak",
     [(_TOLD, "supported", "s_partly", lit(POOLS.meant), _num(_TOLD)), (_SCOPE[1], "not_in_source", None, _SCOPE[2], _num(_SCOPE[1]))]),
    (17, "ins", f"{share('coin', '10000')} < {int(GEN.coin * 10_000)} AND s_methods IS NOT NULL AND s_results IS NOT NULL AND NOT contains(s_methods, s_results)", neutral("s_results", "ins"), "s_methods", "sentence", "insufficient_evidence",
     [("s_results", "insufficient_evidence", None, "'The excerpt has methods only'", _num("s_results"))]),
]


def _claim_sql(i: int, c: tuple | None) -> str:
    text, verdict, quote, why, numeric = c or (None,) * 5
    cell = lambda v, name: f"{v if v is not None else 'NULL::VARCHAR'} AS {name}{i}"
    return ", ".join([cell(f"left({text}, 200)" if text else None, "claim"), cell(lit(verdict) if verdict else None, "verdict"), cell(quote, "quote"), cell(why, "why"), f"CAST({numeric or "NULL"} AS VARCHAR) AS numeric{i}"])


def _select(row: tuple) -> str:
    at, kind, guard, passage, excerpt, mode, overall, claims = row
    two = [*claims, None][:2]
    return f"SELECT corpus_id, {at} AS ord, {lit(kind)} AS kind, {passage} AS passage, {excerpt} AS source_excerpt, coalesce(article_url, doi) AS url, {lit(mode)} AS mode, {lit(overall)} AS overall, {_claim_sql(0, two[0])}, {_claim_sql(1, two[1])} FROM said WHERE {guard}"


def _flat(rows):
    def claim(i):
        c = F.get("claims", i)
        return [c["claim"].alias(f"claim{i}"), c["verdict"].alias(f"verdict{i}"), F.get(c["sourceQuotes"], 0).alias(f"quote{i}"), F.get(c["rationale"], 0).alias(f"why{i}"), c["hasNumericClaim"].cast("string").alias(f"numeric{i}")]

    return rows.select("corpus_id", "kind", "passage", "source_excerpt", F.col("meta.url").alias("url"), F.col("meta.excerpt_mode").alias("mode"), F.col("overallVerdict").alias("overall"), *claim(0), *claim(1))


_COLS = "corpus_id, kind, passage, source_excerpt, url, mode, overall, " + ", ".join(f"{c}{i}" for i in (0, 1) for c in ("claim", "verdict", "quote", "why", "numeric"))
for _kind in dict.fromkeys(r[1] for r in _KINDS):
    add(
        f"rows_{_kind}",
        lambda spark, d, k=_kind: _flat(GEN.rows(papers(spark, d), kinds=[k])),
        f"WITH {_SAID} SELECT {_COLS} FROM (" + " UNION ALL ".join(_select(r) for r in _KINDS if r[1] == _kind) + ")",
    )

# PR9 and the histograms over all rows
_GUARDS = " UNION ALL ".join(f"SELECT corpus_id, {r[0]} AS ord, {lit(r[1])} AS kind, {lit(r[7][0][1])} AS v0, {lit(r[7][1][1]) if len(r[7]) > 1 else 'NULL'} AS v1 FROM said WHERE {r[2]}" for r in _KINDS)
_NUMBERED = f"WITH {_SAID}, made AS ({_GUARDS}), numbered AS (SELECT *, row_number() OVER (PARTITION BY corpus_id ORDER BY ord) - 1 AS idx FROM made)"
_IDS = "'l3-' || corpus_id || '-' || kind || '-' || idx"


def made(spark, d):
    return GEN.rows(papers(spark, d))


add("generator_ids", lambda spark, d: made(spark, d).select("id", F.col("idx").cast("long").alias("idx")), f"{_NUMBERED} SELECT {_IDS} AS id, CAST(idx AS BIGINT) AS idx FROM numbered")
add("verdict_histogram", lambda spark, d: generate.verdict_histogram(made(spark, d)), f"{_NUMBERED} SELECT verdict, count(*) AS n FROM (SELECT v0 AS verdict FROM made UNION ALL SELECT v1 FROM made WHERE v1 IS NOT NULL) GROUP BY verdict")
add("first_verdicts", lambda spark, d: generate.first_verdicts(made(spark, d)), f"{_NUMBERED} SELECT v0 AS verdict, count(*) AS n FROM made GROUP BY v0")


# SA2, SA5, WN5 / SA3 on generated rows
def review_fraction(spark, d):
    """A seventh or so of the generated rows for review."""
    return sets.fraction(made(spark, d).select("id"), 0.15, 42)


add("review_fraction", review_fraction, f"{_NUMBERED} SELECT id FROM (SELECT {_IDS} AS id, row_number() OVER (ORDER BY md5('42-review|' || {_IDS}), {_IDS}) AS r, count(*) OVER () AS n FROM numbered) WHERE r <= greatest(1, CAST(floor(n * 0.15) AS BIGINT))")

_TARGET, _FLOOR = 300, 60
_SHARES = {"supported": 0.40, "weak": 0.12, "not_in_source": 0.20, "contradicted": 0.16, "insufficient_evidence": 0.08}


def quota_fill(spark, d):
    """A balanced sample of the generated rows: priority kinds, verdict quotas, rows of two claims, fill."""
    rows = made(spark, d).select("id", "kind", F.get("claims", 0)["verdict"].alias("verdict"), F.size("claims").alias("n_claims"))
    out = windows.quotas(rows, "verdict", _TARGET, _SHARES, F.col("kind").isin("pol", "over"), F.col("n_claims") >= 2, 42, "id", _FLOOR)
    return out.select("id", F.col("stage").cast("long").alias("stage"))


_NEED = "CASE verdict " + " ".join(f"WHEN {lit(v)} THEN greatest(1, {max(1, int(_TARGET * x))} - coalesce((SELECT n FROM got WHERE got.verdict = q.verdict), 0))" for v, x in _SHARES.items()) + " ELSE 0 END"
add(
    "quota_fill",
    quota_fill,
    f"""{_NUMBERED}, pool AS (SELECT {_IDS} AS id, v0 AS verdict, kind IN ('pol', 'over') AS pri, v1 IS NOT NULL AS multi, md5('42|' || {_IDS}) AS d FROM numbered), got AS (SELECT verdict, count(*) AS n FROM pool WHERE pri GROUP BY 1),
 q AS (SELECT *, row_number() OVER (PARTITION BY verdict ORDER BY d, id) AS r FROM pool WHERE NOT pri), s1 AS (SELECT * FROM q WHERE r <= {_NEED}), l2 AS (SELECT * FROM q WHERE id NOT IN (SELECT id FROM s1) AND multi),
 s2 AS (SELECT *, row_number() OVER (ORDER BY d, id) AS k FROM l2 QUALIFY k <= greatest(0, {_FLOOR} - (SELECT count(*) FROM s1 WHERE multi) - (SELECT count(*) FROM pool WHERE pri AND multi))),
 p AS (SELECT id, d, 0 AS stage FROM pool WHERE pri UNION ALL SELECT id, d, 1 FROM s1 UNION ALL SELECT id, d, 2 FROM s2),
 s3 AS (SELECT id, d, 3 AS stage FROM q WHERE id NOT IN (SELECT id FROM p) ORDER BY d, id LIMIT CASE WHEN (SELECT count(*) FROM p) < {_TARGET} THEN {_TARGET} - (SELECT count(*) FROM p) ELSE 0 END)
 SELECT id, CAST(stage AS BIGINT) AS stage FROM (SELECT *, row_number() OVER (ORDER BY stage, d, id) AS k FROM (SELECT * FROM p UNION ALL SELECT * FROM s3)) WHERE k <= greatest({_TARGET}, (SELECT count(*) FROM pool WHERE pri))""",
)


def holdout_papers(spark, d):
    """Fifty papers held out where there are enough of them."""
    held, rest = sets.holdout(papers(spark, d).where(F.length("abstract") >= 120).select("corpus_id"), 30, 50, 42)
    return held.withColumn("part", F.lit("held")).unionByName(rest.withColumn("part", F.lit("rest"))).select("corpus_id", "part")


add(
    "holdout_papers",
    holdout_papers,
    f"WITH {_PAPERS} SELECT corpus_id, CASE WHEN n > 80 AND r <= 50 THEN 'held' ELSE 'rest' END AS part FROM (SELECT corpus_id, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42-holdout|' || corpus_id), corpus_id) AS r FROM papers)",
)


def stratified_papers(spark, d):
    """An equal share of papers of every year bin, topped up."""
    rows = papers(spark, d).select("corpus_id", generate.year_bin(F.col("year")).alias("bin"))
    return windows.stratified(rows, "bin", 100, 42, "corpus_id").select("corpus_id", "bin")


_BIN = "CASE WHEN year BETWEEN 2000 AND 2009 THEN '2000-2009' WHEN year BETWEEN 2010 AND 2019 THEN '2010-2019' WHEN year BETWEEN 2020 AND 2026 THEN '2020-2026' ELSE 'other' END"
add(
    "stratified_papers",
    stratified_papers,
    f"""WITH b AS (SELECT corpus_id, {_BIN} AS bin FROM ({duck(PAPERS)})), r AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('42|' || corpus_id), corpus_id) AS r FROM b), per AS (SELECT greatest(1, 100 // count(DISTINCT bin)) AS p FROM b),
 base AS (SELECT corpus_id, bin FROM r WHERE r <= (SELECT p FROM per)), more AS (SELECT corpus_id, bin FROM r WHERE r > (SELECT p FROM per) ORDER BY md5('42-top-up|' || corpus_id), corpus_id LIMIT (SELECT greatest(0, 100 - count(*)) FROM base))
 SELECT corpus_id, bin FROM (SELECT * FROM base UNION ALL SELECT * FROM more) ORDER BY md5('42|' || corpus_id), corpus_id LIMIT 100""",
)


def year_histogram(spark, d):
    return corpus.year_histogram(papers(spark, d)).select(F.col("year").cast("long").alias("year"), "n")


add("year_histogram", year_histogram, f"SELECT CAST(year AS BIGINT) AS year, count(*) AS n FROM ({duck(PAPERS)}) WHERE year IS NOT NULL GROUP BY year")

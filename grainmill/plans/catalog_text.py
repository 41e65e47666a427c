"""Queries of the string functions, alignment tests, body-text rules and corpus records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import body, corpus, generate, joins, rules, sets, windows
from grainmill.plans.catalog_rows import POOLS, absent, aligned, lit, meaning_aligned, numbers_aligned, papers, sents, short, squeeze, surname, unhedged
from grainmill.plans.inputs import PAPERS
from grainmill.plans.registry import add, duck, table, view

_WS = r"[ \t\n\r\f\v]+"
_P = f"({duck(PAPERS)})"


def docs(spark, d):
    return table(spark, d, "documents")


def text_query(name: str, column, sql: str, more: str = "") -> None:
    """A function of every document's whole text, compared by digest."""
    add(name, lambda s, d: docs(s, d).select("doc_id", F.md5(column("text")).alias("md5")), f"SELECT doc_id, md5({sql}) AS md5 FROM documents{more}")


# SF1-SF8
text_query("normalize_ws", T.normalize_ws, squeeze("text"))
text_query("dedupe_keys", T.dedupe_key, f"lower({squeeze('text')})")
_MARKED = "replace(replace(replace(text, ' of ', ' &amp; '), ' le ', ' – '), ' the ', ' so­ft ')"
text_query("quote_normalised", lambda c: T.normalize_quote(F.replace(F.replace(F.replace(c, F.lit(" of "), F.lit(" &amp; ")), F.lit(" le "), F.lit(" – ")), F.lit(" the "), F.lit(" so­ft "))), squeeze(f"replace(replace(replace({_MARKED}, '&amp;', '&'), '­', ''), '–', '-')"))
text_query("letter_spaces_collapsed", T.collapse_letter_spaces, r"regexp_replace(regexp_replace(text, '([A-Za-z])[ ]([A-Za-z])', '\1\2', 'g'), '([A-Za-z])[ ]([A-Za-z])', '\1\2', 'g')")
text_query("xml_escaped", T.escape_xml, "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')")
text_query("page_normalised", lambda c: T.normalize_page(F.regexp_replace(c, "(e)\n", "$1-\n")), squeeze(r"regexp_replace(regexp_replace(regexp_replace(text, '(e)\n', '\1-' || chr(10), 'g'), '-\s*\n\s*', '', 'g'), '\s*\n\s*', ' ', 'g')"))
text_query("accents_folded", T.fold_accents, "trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))")
text_query("doi_file_names", T.doi_file_name, "left(regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g'), 120)")


def _sentences(spark, d):
    """Every sentence of forty characters or more, in order."""
    s = docs(spark, d).select("doc_id", F.posexplode(T.sentences("text", 40)).alias("i", "s"))
    return s.select("doc_id", F.col("i").cast("long").alias("i"), F.md5("s").alias("md5"))


add("sentences", _sentences, f"SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS i, md5(unnest(s)) AS md5 FROM (SELECT doc_id, {sents('text')} AS s FROM documents)")
_TOKENS = rf"list_distinct(list_filter(regexp_split_to_array(lower(replace(replace(replace({{0}}, ',', ' '), '.', ' '), ';', ' ')), '{_WS}'), lambda w: length(w) >= 3))"
add(
    "overlap_tokens",
    lambda s, d: docs(s, d).select("doc_id", F.md5(F.array_join(F.array_sort(T.overlap_tokens("text")), " ")).alias("md5")),
    f"SELECT doc_id, md5(array_to_string(list_sort({_TOKENS.format('text')}), ' ')) AS md5 FROM documents",
)


def _overlap(spark, d):
    """Share of each benchmark item's tokens that the first document has."""
    one = docs(spark, d).agg(F.min_by("text", "doc_id").alias("t"))
    return table(spark, d, "benchmark").crossJoin(one).select("item_id", F.round(T.overlap_score(T.overlap_tokens("text"), T.overlap_tokens("t")), 6).alias("score"), F.size(F.array_intersect(T.overlap_tokens("text"), T.overlap_tokens("t"))).cast("long").alias("shared"))


add("overlap_scores", _overlap, f"WITH o AS (SELECT min_by(text, doc_id) AS t FROM documents), x AS (SELECT item_id, {_TOKENS.format('text')} AS a, {_TOKENS.format('t')} AS b FROM benchmark, o) SELECT item_id, round(len(list_intersect(a, b)) / len(a), 6) AS score, CAST(len(list_intersect(a, b)) AS BIGINT) AS shared FROM x")
add("hedges_stripped", lambda s, d: papers(s, d).select("corpus_id", T.strip_hedges("abstract").alias("bold"), T.has_hedge("abstract").alias("hedged")), f"SELECT corpus_id, {unhedged('abstract')} AS bold, regexp_matches(abstract, {lit('(?i)' + chr(92) + 'b(?:' + '|'.join(T.HEDGES) + ')' + chr(92) + 'b')}) AS hedged FROM {_P}")
_PCT = r"(?s)^(.*?)((?:^|[^-./0-9A-Za-z]))(\d+(?:[.]\d+)?)(\s*%)(.*)$"


def _mutated(spark, d):
    """A number of each abstract made wrong: percentages only count where nothing is glued to them."""
    return papers(spark, d).select("corpus_id", T.mutate_number(F.concat(F.lit("In "), F.col("year").cast("string"), F.lit(" n = "), F.length("abstract").cast("string"), F.when(F.col("row_ord") % 2 == 0, F.concat(F.lit(" and "), (F.col("row_ord") % 90).cast("string"), F.lit("% more"))).otherwise(""))).alias("wrong"))


add(
    "numbers_mutated",
    _mutated,
    f"""SELECT corpus_id, 'In ' || year || ' n = ' || CASE WHEN row_ord % 2 = 0 THEN length(abstract) || ' and ' || CASE WHEN p < 50 THEN CAST(CAST(least(p * 10, 99) AS BIGINT) AS VARCHAR) WHEN p % 10 = 0 THEN CAST(p // 10 AS VARCHAR) ELSE CAST(round(greatest(p / 10, 0.1), 4) AS VARCHAR) END || '% more'
 ELSE CAST(greatest(length(abstract) * 10, length(abstract) + 50) AS VARCHAR) END AS wrong FROM (SELECT *, row_ord % 90 AS p FROM {_P})""",
)
add("short_claims", lambda s, d: papers(s, d).select("corpus_id", T.short_claim("abstract").alias("c80"), T.short_claim("abstract", 60).alias("c60")), f"SELECT corpus_id, {short('abstract', 80)} AS c80, {short('abstract', 60)} AS c60 FROM {_P}")


def _preview(spark, d):
    """A window of each document around its last sentence, or around words that it lacks."""
    s = T.sentences("text", 40)
    anchor = F.when(F.col("doc_id") % 4 == 0, "no such words").otherwise(F.try_element_at(s, F.lit(-1)))
    return docs(spark, d).select("doc_id", F.md5(T.excerpt_preview("text", anchor)).alias("md5"))


add(
    "excerpt_previews",
    _preview,
    f"""WITH a AS (SELECT doc_id, text, trim(left(coalesce(CASE WHEN doc_id % 4 = 0 THEN 'no such words' ELSE {sents('text')}[-1] END, ''), 80)) AS n FROM documents), b AS (SELECT *, CASE WHEN n <> '' THEN instr(text, n) ELSE 0 END AS i FROM a), c AS (SELECT *, greatest(i - 50, 1) AS s, least(length(text), i - 1 + 180) AS e FROM b)
 SELECT doc_id, md5(CASE WHEN text = '' THEN '' WHEN i > 0 THEN CASE WHEN s > 1 THEN '...' ELSE '' END || substr(text, s, e - s + 1) || CASE WHEN e < length(text) THEN '...' ELSE '' END WHEN length(text) <= 180 THEN text ELSE left(text, 180) || '...' END) AS md5 FROM c""",
)
_HINT = "CASE p_partkey % 5 WHEN 0 THEN 'see p. ' || p_size WHEN 1 THEN 'PP ' || p_size || '-9' WHEN 2 THEN 'p.0' WHEN 3 THEN 'page ' || p_size ELSE p_name END"
add(
    "page_hints",
    lambda s, d: view(s, d, f"SELECT p_partkey, {_HINT.replace('p_size', 'CAST(p_size AS STRING)')} AS h FROM {{part}}").select("p_partkey", F.coalesce(T.page_hint("h").cast("long"), F.lit(-1)).alias("hint")),
    "SELECT p_partkey, CASE WHEN p_partkey % 5 < 2 AND p_size > 0 THEN CAST(p_size AS BIGINT) ELSE -1 END AS hint FROM part",
)
add("tags_stripped", lambda s, d: table(s, d, "pages").select("page_id", F.md5(T.strip_tags("html")).alias("md5")), "SELECT page_id, md5(trim(regexp_replace(html, '<[^>]+>', '', 'g'))) AS md5 FROM pages")


def _pdf_links(spark, d):
    """Links of pages whose menus name PDFs: every third menu link made one."""
    h = F.regexp_replace(F.regexp_replace("html", 'href="/([a-g][^"]*)"', "href='/x/$1.PDF?a=1'"), 'href="/([h-m][^"]*)"', "href='/pdf/$1'")
    return table(spark, d, "pages").select("page_id", F.array_join(T.pdf_links(h), " ").alias("links"))


add(
    "pdf_links",
    _pdf_links,
    r"""WITH h AS (SELECT page_id, regexp_replace(regexp_replace(html, 'href="/([a-g][^"]*)"', 'href=''/x/\1.PDF?a=1''', 'g'), 'href="/([h-m][^"]*)"', 'href=''/pdf/\1''', 'g') AS h FROM pages),
 l AS (SELECT page_id, list_concat(regexp_extract_all(h, '(?i)href=["'']([^"'']+[.]pdf[^"'']*)["'']', 1), regexp_extract_all(h, '(?i)href=["'']([^"'']*(?:/pdf/|/pdf\b|pdf=render|download=true)[^"'']*)["'']', 1)) AS l FROM h)
 SELECT page_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(l), lambda x: {'i': list_position(l, x), 'x': x})), lambda y: y.x)[1:12], ' ') AS links FROM l""",
)

# SF17: DOI spellings of customers
_DOI = "CASE c_custkey % 6 WHEN 0 THEN ' https://doi.org/10.5/Q' || c_custkey WHEN 1 THEN 'DOI:10.1/x' || c_custkey WHEN 2 THEN 'http://doi.org/doi: 10.2/Y ' WHEN 3 THEN '' WHEN 4 THEN 'https://doi.org/http://doi.org/10.9/z' ELSE NULL END"
add(
    "doi_normal_forms",
    lambda s, d: view(s, d, f"SELECT c_custkey, {_DOI.replace('|| c_custkey', '|| CAST(c_custkey AS STRING)')} AS doi FROM {{customer}}").select("c_custkey", T.normalize_doi("doi").alias("doi")),
    "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '10.5/q' || c_custkey WHEN 1 THEN '10.1/x' || c_custkey WHEN 2 THEN '10.2/y' WHEN 4 THEN '10.9/z' END AS doi FROM customer",
)

# FL3, FL4, FL8-FL10: quotes and alignment
_QUOTES = "CASE row_ord % 6 WHEN 0 THEN left(abstract, 30) WHEN 1 THEN replace(left(abstract, 30), ' ', '  ') WHEN 2 THEN replace(left(abstract, 40), ' ', '') WHEN 3 THEN 'not there at all' WHEN 4 THEN '' ELSE upper(left(abstract, 20)) END"
_SIMPLE = f"(contains(abstract, q) OR contains({squeeze('abstract')}, {squeeze('q')}))"
_JOIN = r"regexp_replace(regexp_replace({0}, '([A-Za-z])[ ]([A-Za-z])', '\1\2', 'g'), '([A-Za-z])[ ]([A-Za-z])', '\1\2', 'g')"
add(
    "quotes_in_excerpts",
    lambda s, d: papers(s, d).where("abstract is not null").withColumn("q", F.expr(_QUOTES)).select("corpus_id", T.quote_in_excerpt("q", "abstract").alias("full"), T.quote_in_excerpt_simple("q", "abstract").alias("simple")),
    f"SELECT corpus_id, {_SIMPLE} OR contains({_JOIN.format(squeeze('abstract'))}, {_JOIN.format(squeeze('q'))}) AS full, {_SIMPLE} AS simple FROM (SELECT *, {_QUOTES} AS q FROM {_P} WHERE abstract IS NOT NULL)",
)


def _alignment(spark, d):
    """Every paper's claim against the abstract: its own head, and words of others."""
    claim = F.when(F.col("row_ord") % 2 == 0, F.left("abstract", F.lit(90))).otherwise(F.lit(POOLS.absent[0]))
    p = papers(spark, d).where("abstract is not null").withColumn("c", claim)
    return p.select("corpus_id", T.numbers_aligned("c", "abstract").alias("numbers"), T.meaning_aligned("c", "abstract").alias("meaning"), T.aligned("c", "abstract").alias("either"), T.claim_absent("c", "abstract").alias("absent"))


add(
    "alignment_tests",
    _alignment,
    f"WITH p AS (SELECT *, CASE WHEN row_ord % 2 = 0 THEN left(abstract, 90) ELSE {lit(POOLS.absent[0])} END AS c FROM {_P} WHERE abstract IS NOT NULL) SELECT corpus_id, {numbers_aligned('c', 'abstract')} AS numbers, {meaning_aligned('c', 'abstract')} AS meaning, {aligned('c', 'abstract')} AS either, {absent('c', 'abstract')} AS absent FROM p",
)


# WN3: excerpts packed by overlap, over documents
def _chunks(spark, d):
    """Each document cut to 1800 characters around the words of its last sentence."""
    s = T.sentences("text", 40)
    return docs(spark, d).select("doc_id", F.md5(windows.chunk_excerpt(F.coalesce(F.get(s, F.size(s) - 1), F.lit("")), "text", 1800)).alias("md5"))


_PARTS = rf"list_filter(list_transform(string_split(regexp_replace(clean, '([.!?])[ ]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: length(s) > 20)"
add(
    "packed_excerpts",
    _chunks,
    f"""WITH a AS (SELECT doc_id, {squeeze('text')} AS clean, {_TOKENS.format("coalesce(" + sents('text') + "[-1], '')")} AS t FROM documents), b AS (SELECT *, CASE WHEN len({_PARTS}) > 0 THEN {_PARTS} ELSE [left(clean, 2000)] END AS parts FROM a),
 c AS (SELECT doc_id, clean, t, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM b WHERE length(clean) > 1800), d AS (SELECT *, CASE WHEN len(t) = 0 THEN 0.0 ELSE len(list_intersect(t, {_TOKENS.format('s')})) / len(t) END AS score FROM c),
 e AS (SELECT *, sum(length(s) + 2) OVER (PARTITION BY doc_id ORDER BY score DESC, i ROWS UNBOUNDED PRECEDING) - 2 AS used FROM d), f AS (SELECT doc_id, string_agg(s, chr(10) || chr(10) ORDER BY score DESC, i) AS packed FROM e WHERE used <= 1800 GROUP BY doc_id)
 SELECT a.doc_id, md5(CASE WHEN length(clean) <= 1800 THEN clean ELSE coalesce(packed, left(clean, 1800)) END) AS md5 FROM a LEFT JOIN f USING (doc_id)""",
)

# FL11-FL13, SO5-SO8, PR19: body text
_COUNT = "len(regexp_extract_all({0}, '{1}'))"
_YEAR, _ETAL, _CID, _TOC = r"\b(?:19\d\d|20\d\d)\b", r"(?i)\bet\s+al\b", r"/C\d{2,}|/G[A-Fa-f\d]{2,}", r"\.{4,}"


def _n(c: str, p: str) -> str:
    return _COUNT.format(c, p)


def _noise(c: str) -> str:
    return rf"""(CASE WHEN regexp_matches({c}, '(?i)^\s*review +\d+\b') THEN 5000 ELSE 0 END + CASE WHEN regexp_matches({c}, '(?i)\b(?:bibliography|references|acknowledge?ments?)\b') THEN 2500 ELSE 0 END + {_n(c, _CID)} * 180 + {_n(c, _TOC)} * 250 + CASE WHEN {_n(c, _YEAR)} >= 6 THEN {_n(c, _YEAR)} * 220 ELSE 0 END
 + CASE WHEN {_n(c, _ETAL)} >= 2 THEN {_n(c, _ETAL)} * 450 ELSE 0 END + CASE WHEN {_n(c, '[(]')} >= 10 THEN {_n(c, '[(]')} * 35 ELSE 0 END + CASE WHEN {_n(c, ',')} / greatest(len(list_filter(regexp_split_to_array({c}, '[ \t\n\r\f\v]+'), lambda w: w <> '')), 1) > 0.08 THEN 1500 ELSE 0 END + CASE WHEN {_n(c, ';')} >= 4 AND {_n(c, _YEAR)} >= 3 THEN 900 ELSE 0 END)"""


def _letters(c: str) -> str:
    return rf"length(regexp_replace({c}, '[^\p{{L}}]', '', 'g'))"


def _acceptable(c: str, least: int) -> str:
    return rf"""NOT (length(trim({c})) < {least} OR {_noise(c)} >= 2000 OR regexp_matches({c}, '(?i)^\s*review +\d+\b') OR {_n(c, _YEAR)} >= 8 OR {_n(c, _ETAL)} >= 4 OR {_n(c, _CID)} >= 6 OR {_n(c, '/C')} >= 8 OR {_n(c, '/G')} >= 8 OR {_n(c, _TOC)} >= 6 OR ({_letters(c)} / greatest(length({c}), 1) < 0.40 AND {_n(c, _CID)} >= 2)
 OR regexp_matches(lower(trim(left({c}, 120))), '^(?:references|bibliography|acknowledg)'))"""


#: documents with what makes pages no body text strewn in
_DIRTY = "CASE doc_id % 9 WHEN 0 THEN text WHEN 1 THEN 'References ' || text WHEN 2 THEN repeat('Lee et al 2001, Kim et al (2004); ', 5) || text WHEN 3 THEN repeat('/C12 /G3F ', 8) || text WHEN 4 THEN repeat('Intro ........ 3 ', 9) || text WHEN 5 THEN ' Review 12 ' || text WHEN 6 THEN 'Vol. 3 2001 results 42 ' || text WHEN 7 THEN repeat('(a) ', 12) || text ELSE left(text, 300) END"


def dirty(spark, d):
    return docs(spark, d).withColumn("text", F.expr(_DIRTY))


_D = f"(SELECT doc_id, {_DIRTY} AS text FROM documents)"
add("body_noise", lambda s, d: dirty(s, d).select("doc_id", body.noise("text").alias("noise")), f"SELECT doc_id, CAST({_noise('text')} AS DOUBLE) AS noise FROM {_D}")
add("body_acceptable", lambda s, d: dirty(s, d).select("doc_id", body.acceptable("text").alias("ok")), f"SELECT doc_id, {_acceptable('text', 500)} AS ok FROM {_D}")
_RES, _MET = T.RESULTS.replace("(?iU)", "(?i)"), body.METHODS
add(
    "page_quality",
    lambda s, d: dirty(s, d).select("doc_id", body.page_quality("text").alias("quality")),
    rf"SELECT doc_id, CAST(CASE WHEN {_acceptable('text', 500)} AND {_letters('text')} >= 250 THEN length(text) - {_noise('text')} + least({_n('text', '[0-9]')}, 60) * 2 + CASE WHEN regexp_matches(text, {lit(_RES)}) THEN 120 ELSE 0 END + CASE WHEN regexp_matches(text, {lit(_MET)}) THEN 40 ELSE 0 END ELSE -1 END AS DOUBLE) AS quality FROM {_D}",
)


def _masthead(c: str) -> str:
    return rf"((regexp_matches({c}, '(?i)\bVol\.?\s*\d') AND regexp_matches({c}, '{_YEAR}')) OR (regexp_matches({c}, '\b(?:REPORTS?|CONTENTS)\b') AND regexp_matches({c}, '(?i)\b(?:ASHP|Am J|JAMA|N Engl)\b')) OR regexp_matches({c}, '(?i)^\s*(?:PAGE|pp?\.)\s*\d'))"


add("mastheads", lambda s, d: dirty(s, d).select("doc_id", body.masthead("text").alias("masthead"), body.broken("text").alias("broken")), f"SELECT doc_id, {_masthead('text')} AS masthead, {_masthead('left(text, 160)')} OR regexp_matches(left(text, 300), '/[CG]') OR contains(text, '­') AS broken FROM {_D}")


def _score(s: str, junk: int = 20, test: str | None = None) -> str:
    return rf"(CASE WHEN regexp_matches({s}, {lit(_RES)}) THEN 4 ELSE 0 END + CASE WHEN regexp_matches({s}, '[0-9]') THEN 3 ELSE 0 END - CASE WHEN regexp_matches({s}, {lit(_MET)}) THEN 1 ELSE 0 END - CASE WHEN regexp_matches({s}, '{_ETAL}') THEN 6 ELSE 0 END - CASE WHEN {_n(s, _YEAR)} >= 2 THEN 4 ELSE 0 END + least(length({s}), 220) // 40 - CASE WHEN {test or _masthead(s)} THEN {junk} ELSE 0 END)"


add("best_passages", lambda s, d: papers(s, d).select("corpus_id", body.best_passage("abstract", 60).alias("s")), f"SELECT corpus_id, list_sort(list_transform({sents('abstract', 60)}, lambda s: {{'k': -{_score('s')}, 's': s}}))[1].s AS s FROM {_P}")
_CAND = rf"list_filter(list_transform({sents('abstract', 60)}, lambda s: trim(regexp_replace(s, '(?i)^\s*(?:METHODS?|RESULTS?)\s+', ''))), lambda s: length(s) >= 60 AND NOT ({_masthead('s')} OR {_letters('s')} / greatest(length(s), 1) < 0.55 OR regexp_matches(s, '^[0-9](?:[^0-9]|$)') OR regexp_matches(s, '^[0-9][0-9]{{1,2}}(?:[^0-9]|$)')) AND {_score('s')} >= 2)"
add(
    "candidate_sentences",
    lambda s, d: papers(s, d).select("corpus_id", F.array_join(body.candidate_sentences("abstract"), "|").alias("s")),
    f"WITH c AS (SELECT corpus_id, list_transform(list_sort(list_transform({_CAND}, lambda s: {{'k': -{_score('s')}, 's': s}})), lambda x: x.s) AS s FROM {_P}) SELECT corpus_id, array_to_string(list_filter(s, lambda x, i: list_position(list_transform(s, lambda y: lower(left(y, 80))), lower(left(x, 80))) = i), '|') AS s FROM c",
)


def _pairs(spark, d):
    """Two claims of a paper, and their passage."""
    p = papers(spark, d).select("corpus_id", T.sentences("abstract", 40).alias("s")).where(F.size("s") >= 2)  # a pair of two sentences is never null
    p = p.withColumn("pair", body.best_pair(F.col("s")))
    return p.select("corpus_id", F.array_join("pair", "|").alias("pair"), body.two_claim_passage(F.col("pair")).alias("passage"))


_PAIR = f"coalesce(list_filter(flatten(list_transform(s, lambda a, i: list_transform(s[i + 1:], lambda b: [a, b]))), lambda p: NOT contains(p[1], p[2]) AND NOT contains(p[2], p[1]) AND regexp_matches(p[1] || ' ' || p[2], {lit(_RES)}))[1], s[1:2])"
_CLIP = r"(CASE WHEN length(trim({0})) <= 240 THEN trim({0}) ELSE rtrim(regexp_replace(left(trim({0}), 240), '\s+\S*$', '')) || '…' END)"
_BOTH = f"({_CLIP.format('pair[1]')} || ' ' || {_CLIP.format('pair[2]')})"
add("two_claim_passages", _pairs, f"WITH c AS (SELECT corpus_id, {sents('abstract', 40)} AS s FROM {_P}), p AS (SELECT corpus_id, {_PAIR} AS pair FROM c WHERE len(s) >= 2) SELECT corpus_id, array_to_string(pair, '|') AS pair, CASE WHEN length({_BOTH}) <= 520 AND {_acceptable(_BOTH, 120)} THEN {_BOTH} END AS passage FROM p")
add("clipped_at_word", lambda s, d: docs(s, d).select("doc_id", F.md5(T.clip_at_word(F.regexp_replace("text", "\n", " "))).alias("md5")), f"SELECT doc_id, md5({_CLIP.format('t')}) AS md5 FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents)")

# WN4: pages of each source as a document's pages (no SQL: the growth depends on every step; tests compare with a plain loop)
def page_windows(spark, d):
    """The page window of every document, its whole text taken as pages of 500 characters."""
    pages = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length("text") - 1, F.lit(0)) / 500)), lambda i: F.substr(F.col("text"), (i * 500 + 1).cast("int"), F.lit(500)))
    rows = docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.filter(pages, lambda p: p != "").alias("pages"), F.when(F.col("doc_id") % 3 == 0, 2).alias("hint"))
    w = body.windows(rows, 1200)
    return w.select(F.col("id").cast("long").alias("doc_id"), "first", "last", F.md5("excerpt").alias("excerpt_md5"))


add("page_windows", page_windows)


# PR11: freezing, contrastive rows
def _frozen(spark, d):
    p = papers(spark, d).select("corpus_id", F.struct("doi", F.lit("draft").alias("draft_status"), F.col("year").alias("year")).alias("meta"))
    m = body.freeze(p, "scale-v1", F.lit("2024-01-31"))
    return m.select("corpus_id", *[F.col(f"meta.{k}").cast("string").alias(k) for k in ("doi", "draft_status", "year", "scale_source", "frozen_date")])


add("frozen_meta", _frozen, f"SELECT corpus_id, doi, 'frozen' AS draft_status, CAST(year AS VARCHAR) AS year, 'scale-v1' AS scale_source, '2024-01-31' AS frozen_date FROM {_P}")


def _contrastive(spark, d):
    """A contradicting passage of each paper: a number, else a polarity, else the partner's."""
    rows = papers(spark, d).where("abstract is not null").select(F.col("corpus_id").alias("id"), "row_ord", F.coalesce(F.get(T.sentences("abstract", 40), F.size(T.sentences("abstract", 40)) - 1), F.lit("")).alias("passage"), F.col("abstract").alias("source_excerpt"))
    c = body.contrastive(rows.withColumn("passage", F.regexp_replace("passage", "[0-9]+", "some")))
    return c.select("parent_id", "passage", "contrastive_kind")


_FLIPPED = "CASE " + " ".join(rf"WHEN regexp_matches(passage, '(?i)\b{a}\b') THEN regexp_replace(passage, '(?i)\b{a}\b', '{b}')" for a, b in T.SWAPS) + " END"
add(
    "contrastive_rows",
    _contrastive,
    f"""WITH p AS (SELECT corpus_id, row_ord, regexp_replace(coalesce({sents('abstract')}[-1], ''), '[0-9]+', 'some', 'g') AS passage FROM {_P} WHERE abstract IS NOT NULL), n AS (SELECT *, row_number() OVER (ORDER BY row_ord) AS i, count(*) OVER () AS n, {_FLIPPED} AS flipped FROM p)
 SELECT a.corpus_id AS parent_id, coalesce(a.flipped, b.passage) AS passage, CASE WHEN a.flipped IS NOT NULL THEN 'polarity_flip' ELSE 'cross_doc' END AS contrastive_kind FROM n a JOIN n b ON b.i = (a.i - 1 + greatest(1, a.n // 2)) % a.n + 1""",
)


# FL14, FL15, FL19
def _split(spark, d):
    p = papers(spark, d).select(F.col("corpus_id").alias("id"))
    drop = table(spark, d, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("reason"))
    kept, dropped = rules.split_dropped(p, drop)
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(dropped)


add("drop_list_split", _split, f"SELECT corpus_id AS id, s_name AS reason FROM {_P} LEFT JOIN supplier ON corpus_id = 'c' || s_suppkey")
add(
    "unseen_rows",
    lambda s, d: rules.unseen(papers(s, d).select("row_ord"), table(s, d, "labels").select(F.col("doc_id").alias("row_ord")), "row_ord"),
    f"SELECT row_ord FROM {_P} WHERE row_ord NOT IN (SELECT doc_id FROM labels)",
)
add(
    "boost_replaces_base",
    lambda s, d: joins.without(papers(s, d).select(F.col("corpus_id").alias("id")), table(s, d, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("id")), ["c1", "c29"]),
    f"SELECT corpus_id AS id FROM {_P} WHERE NOT regexp_matches(corpus_id, '^(?:c1|c29)') AND corpus_id NOT IN (SELECT 'c' || s_suppkey FROM supplier)",
)

# PR1-PR4, AG16, SO1, AG5, AG6: records
_RAWS = """SELECT p_partkey AS row_ord, CASE p_partkey % 3 WHEN 0 THEN 'openalex' WHEN 1 THEN 'semantic' ELSE 'export' END AS source_export, CASE WHEN p_partkey % 5 = 0 THEN ' WOS:' || CAST(p_partkey % 700 AS STRING) || ' ' WHEN p_partkey % 5 = 1 THEN '' END AS uid,
 CASE WHEN p_partkey % 4 > 0 THEN 'https://doi.org/10.3/X' || CAST(p_partkey % 600 AS STRING) END AS doi, CASE WHEN p_partkey % 6 = 0 THEN ' ' ELSE p_name END AS title, CASE p_partkey % 4 WHEN 0 THEN '20' || lpad(CAST(p_size AS STRING), 2, '0') WHEN 1 THEN 'n.d.' WHEN 2 THEN '' END AS year,
 CASE p_partkey % 6 WHEN 0 THEN '["Ann Lee", "", {{"name": "Bo Kim"}}, {{"display_name": "Cy Doe"}}]' WHEN 1 THEN '"Lee, Ann"' WHEN 2 THEN 'Plain Name' WHEN 3 THEN '[]' WHEN 4 THEN '["de la Cruz, Eva", "Bo Kim"]' END AS authors,
 CASE WHEN p_partkey % 7 < 5 THEN repeat(p_name || ' ', CAST(p_size % 20 AS INT)) ELSE '' END AS abstract, CASE WHEN p_partkey % 2 = 0 THEN 'http://full/' || p_name ELSE ' ' END AS fulltext_url, CASE WHEN p_partkey % 9 = 0 THEN 'http://art/' || p_name END AS article_url FROM {part}"""
_REC = f"""raw AS ({duck(_RAWS)}), rec AS (SELECT row_ord, source_export, nullif(trim(uid), '') AS u, nullif(lower(replace(doi, 'https://doi.org/', '')), '') AS doi, CASE WHEN trim(title) <> '' THEN title END AS title, CASE WHEN regexp_matches(year, '^[0-9]+$') THEN CAST(year AS BIGINT) END AS year,
 CASE row_ord % 6 WHEN 0 THEN ['Ann Lee', 'Bo Kim', 'Cy Doe'] WHEN 1 THEN ['Lee, Ann'] WHEN 2 THEN ['Plain Name'] WHEN 4 THEN ['de la Cruz, Eva', 'Bo Kim'] ELSE [] END AS authors, nullif(trim(abstract), '') AS abstract, CASE WHEN trim(fulltext_url) <> '' THEN fulltext_url END AS fulltext_url, article_url AS art FROM raw),
 kept AS (SELECT *, coalesce(lower(replace(u, ':', '_')), source_export || '_' || left(sha256(doi), 12), source_export || '_' || left(sha256('None'), 12)) AS corpus_id, CASE WHEN abstract IS NULL THEN 'none' ELSE 'export' END AS abstract_source, coalesce(art, 'https://doi.org/' || doi) AS article_url FROM rec WHERE doi IS NOT NULL OR abstract IS NOT NULL OR u IS NOT NULL)"""


def records(spark, d):
    return corpus.records(view(spark, d, _RAWS))


def _records(spark, d):
    return records(spark, d).select("row_ord", "corpus_id", "doi", "title", F.col("year").cast("string").alias("year"), F.array_join("authors", ";").alias("authors"), corpus.first_surname(F.col("authors")).alias("surname"), "abstract", "abstract_source", "fulltext_url", "article_url")


add("corpus_records", _records, f"WITH {_REC} SELECT row_ord, corpus_id, doi, title, CAST(year AS VARCHAR) AS year, array_to_string(authors, ';') AS authors, coalesce(nullif({surname('authors[1]')}, ''), 'Unknown') AS surname, abstract, abstract_source, fulltext_url, article_url FROM kept")
_MERGED = f"""{_REC}, best AS (SELECT *, row_number() OVER (PARTITION BY coalesce(doi, corpus_id) ORDER BY coalesce(length(abstract), 0) DESC, (source_export = 'openalex')::INT DESC, CASE WHEN source_export = 'openalex' THEN -row_ord ELSE row_ord END) AS r FROM kept)"""
add(
    "merged_records",
    lambda s, d: corpus.merged(records(s, d)).select("row_ord", "corpus_id", "doi", F.row_number().over(Window.partitionBy("year").orderBy("corpus_id", "row_ord")).cast("long").alias("place")),
    f"WITH {_MERGED} SELECT row_ord, corpus_id, doi, row_number() OVER (PARTITION BY year ORDER BY corpus_id COLLATE \"C\", row_ord) AS place FROM best WHERE r = 1",
)
add("enrichment_statistics", lambda s, d: corpus.enrichment_statistics(records(s, d).withColumn("abstract_source", F.when(F.col("row_ord") % 5 == 0, "crossref").otherwise(F.col("abstract_source")))), f"WITH {_REC} SELECT count(*) AS total, count(abstract) AS with_abstract, round(count(abstract) / count(*), 4) AS coverage, count(*) FILTER (WHERE row_ord % 5 = 0) AS looked_up FROM kept")
add("source_counts", lambda s, d: corpus.counts(records(s, d), ["source_export", "abstract_source"]), f"WITH {_REC} SELECT source_export, abstract_source, count(*) AS n FROM kept GROUP BY ALL")
add("distinct_dois", lambda s, d: corpus.distinct_values(records(s, d), "doi"), f"WITH {_REC} SELECT count(DISTINCT doi) + max((doi IS NULL)::BIGINT) AS n FROM kept")


# JN1, JN5, JN17
def _doi_join(spark, d):
    """Papers' abstracts by DOI, the last record of each."""
    oa = view(spark, d, _RAWS).select("row_ord", "doi")
    c = records(spark, d).select("doi", "abstract", "row_ord")
    return joins.doi_join(oa, c).select("row_ord", "doi", "corpus_abstract")


add("doi_join", _doi_join, f"WITH {_REC}, last AS (SELECT doi, max_by(row_ord, row_ord) AS ro FROM kept WHERE doi IS NOT NULL GROUP BY doi) SELECT r.row_ord, k.doi, k.abstract AS corpus_abstract FROM rec r JOIN last USING (doi) JOIN kept k ON k.row_ord = last.ro")
add(
    "new_candidates",
    lambda s, d: joins.new_candidates(records(s, d).select("doi", "row_ord"), table(s, d, "labels").select(F.concat(F.lit("10.3/x"), F.col("doc_id").cast("string")).alias("doi")), "doi", "row_ord", 40),
    f"WITH {_REC} SELECT doi, min(row_ord) AS row_ord FROM kept WHERE doi IS NOT NULL AND doi NOT IN (SELECT '10.3/x' || doc_id FROM labels) GROUP BY doi ORDER BY row_ord LIMIT 40",
)


def _enriched(spark, d):
    """Records' abstracts filled from a cache and two sources."""
    r = records(spark, d).where("doi is not null").select("row_ord", "doi", "abstract", "abstract_source")
    src = lambda m, t: table(spark, d, "part").select(F.concat(F.lit("10.3/x"), (F.col("p_partkey") % 600).cast("string")).alias("doi"), F.concat(F.lit(t), (F.col("p_partkey") % 600).cast("string")).alias("abstract")).where(F.col("p_partkey") % m == 1)
    return joins.cached_abstracts(r, src(3, "cache "), [("crossref", src(2, "crossref ")), ("semantic", src(5, " "))]).select("row_ord", "abstract", "abstract_source")


add(
    "cached_abstracts",
    _enriched,
    f"""WITH {_REC}, s AS (SELECT DISTINCT '10.3/x' || (p_partkey % 600) AS doi, p_partkey % 600 AS m, p_partkey AS k FROM part), c AS (SELECT DISTINCT doi, 'cache ' || m AS a FROM s WHERE k % 3 = 1), x AS (SELECT DISTINCT doi, 'crossref ' || m AS a FROM s WHERE k % 2 = 1), y AS (SELECT DISTINCT doi, CAST(m AS VARCHAR) AS a FROM s WHERE k % 5 = 1)
 SELECT row_ord, coalesce(abstract, c.a, x.a, y.a) AS abstract, CASE WHEN abstract IS NOT NULL THEN abstract_source WHEN c.a IS NOT NULL THEN 'cache' WHEN x.a IS NOT NULL THEN 'crossref' WHEN y.a IS NOT NULL THEN 'semantic' ELSE 'none' END AS abstract_source FROM kept LEFT JOIN c USING (doi) LEFT JOIN x USING (doi) LEFT JOIN y USING (doi) WHERE doi IS NOT NULL""",
)


# ST1-ST3, ST9, SO9, SO10, AG7, UD3, UD5
def _ordered(spark, d):
    b, s = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"), table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("extra"))
    return sets.union_in_order(b, s).select("id", F.md5("text").alias("text_md5"), "extra", F.col("file_ord").cast("long").alias("file_ord"))


add("union_in_order", _ordered, "SELECT item_id AS id, md5(text) AS text_md5, NULL AS extra, 0::BIGINT AS file_ord FROM benchmark UNION ALL SELECT s_suppkey, NULL, s_name, 1 FROM supplier")
add(
    "union_first_wins",
    lambda s, d: sets.union_first(table(s, d, "labels").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("row_ord"), F.lit("labels").alias("src")), docs(s, d).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("row_ord"), F.col("lang").alias("src"))).select("id", "src"),
    "SELECT doc_id AS id, 'labels' AS src FROM labels UNION SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
add(
    "union_unique",
    lambda s, d: sets.union_unique(table(s, d, "nation").select(F.col("n_name").alias("id")), table(s, d, "supplier").select(F.col("s_name").alias("id"))).select("id", F.col("file_ord").cast("long").alias("file_ord")),
    "SELECT n_name AS id, 0::BIGINT AS file_ord FROM nation UNION ALL SELECT s_name, 1 FROM supplier",
)


def _tokens(spark, d):
    from grainmill.streaming.incremental import token_counts

    return token_counts(docs(spark, d).select(F.col("doc_id").alias("id"), "text"), "text")


_TOK = r"CAST(len(regexp_extract_all(text, '[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_\s]')) AS BIGINT)"
add("token_counts", lambda s, d: _tokens(s, d).select("id", "tokens"), f"SELECT doc_id AS id, {_TOK} AS tokens FROM documents")
add("length_audit", lambda s, d: sets.length_audit(_tokens(s, d), "tokens", 1000).select("rows", "longest", "p95", "overflow"), f"WITH t AS (SELECT {_TOK} AS t FROM documents) SELECT count(*) AS rows, max(t) AS longest, list_sort(list(t))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95, count(*) FILTER (WHERE t > 1000) AS overflow FROM t")
add("overflowing_rows", lambda s, d: sets.overflowing(_tokens(s, d), "tokens", 1000), f"SELECT doc_id AS id, {_TOK} AS tokens FROM documents WHERE {_TOK} > 1000")


def _length_gate(spark, d):
    from grainmill.operators import gates

    return gates.within_length(_tokens(spark, d), "tokens", 1000)


add("length_gate", _length_gate, f"SELECT count(*) FILTER (WHERE {_TOK} > 1000) AS overflow, count(*) FILTER (WHERE {_TOK} > 1000) = 0 AS passed FROM documents")


def _safe(spark, d):
    """Generated contradictions capped to 300 characters: those whose quotes survive and that are short."""
    r = generate.Generator().rows(papers(spark, d), kinds=["sup"]).select("id", "passage", "source_excerpt", "claims")
    return sets.sequence_safe(r, F.size(F.split("source_excerpt", " ")), 45, 300).select("id", F.col("tokens").cast("long").alias("tokens"), F.md5("source_excerpt").alias("excerpt_md5"))


add("sequence_safe", _safe)


# JN3
_AZ = "abcdefghijklmnopqrstuvwxyz"
_UP = f"translate(text, '{_AZ}', '{_AZ.upper()}')"


def _overlaps(spark, d):
    """Conversation turns against the documents and benchmark: as passage or as excerpt."""
    ev = docs(spark, d).select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("id"), "text").unionByName(table(spark, d, "benchmark").select(F.concat(F.lit("b"), F.lpad(F.col("item_id").cast("string"), 7, "0")).alias("id"), "text"))
    ev = ev.select("id", F.col("text").alias("passage"), F.lower(F.substr("text", F.lit(1), F.lit(60))).alias("source_excerpt"))
    tr = docs(spark, d).select(F.col("doc_id").alias("id"), F.translate("text", _AZ, _AZ.upper()).alias("passage"), F.concat(F.lit("  "), F.left("text", F.lit(60))).alias("source_excerpt"))
    return joins.contamination_exact(tr, ev)


_LK = "lower(" + squeeze("{0}") + ")"
add(
    "contamination_both_columns",
    _overlaps,
    f"""WITH ev AS (SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS id, text FROM documents UNION ALL SELECT 'b' || lpad(CAST(item_id AS VARCHAR), 7, '0'), text FROM benchmark), p AS (SELECT {_LK.format('text')} AS k, max(id) AS m FROM ev GROUP BY 1 HAVING k <> ''), e AS (SELECT {_LK.format('lower(left(text, 60))')} AS k, max(id) AS m FROM ev GROUP BY 1 HAVING k <> '')
 SELECT doc_id AS id, p.m AS passage_match, e.m AS excerpt_match FROM documents LEFT JOIN p ON p.k = {_LK.format(_UP)} LEFT JOIN e ON e.k = {_LK.format('left(text, 60)')} WHERE p.m IS NOT NULL OR e.m IS NOT NULL""",
)


def _no_hits(spark, d):
    from grainmill.operators import gates

    return gates.no_contamination(_overlaps(spark, d))


add("contamination_gate", _no_hits, "SELECT count(*) AS hits, count(*) = 0 AS passed FROM documents WHERE text <> ''")

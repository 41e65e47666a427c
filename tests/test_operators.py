"""Relational operators: joins, windows, samples, scoring, gates, body and open-access rules."""

from __future__ import annotations

import difflib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from grainmill.functions import jsonx
from grainmill.operators import body, corpus, evaluate, gates, generate, joins, oa, rules, windows
from grainmill.sources import readers, sinks
from grainmill.streaming import incremental


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# corpus
def test_records(spark):
    raw = spark.createDataFrame(
        [
            ("openalex", "W:1", "https://doi.org/10.1/A", "T", "2001", '[{"display_name": "Ann B"}, " C, D ", {"x": 1}]', " text ", "", None),
            ("export", None, None, "T", "x", None, "", None, None),
            ("export", None, "10.2/b", " ", "1999", "Solo", None, "f", None),
        ],
        "source_export string, uid string, doi string, title string, year string, authors string, abstract string, fulltext_url string, article_url string",
    )
    got = {r.doi: r for r in corpus.records(raw).collect()}
    a, b = got["10.1/a"], got["10.2/b"]
    assert len(got) == 2 and a.corpus_id == "w_1" and a.authors == ["Ann B", "C, D"] and a.year == 2001 and a.article_url == "https://doi.org/10.1/a" and a.abstract_source == "export"
    assert b.corpus_id.startswith("export_") and b.authors == ["Solo"] and b.title is None and b.abstract_source == "none"
    cites = corpus.records(raw).select("doi", corpus.citation(F.col("authors"), F.col("year")).alias("c")).collect()
    assert {r.doi: r.c for r in cites} == {"10.1/a": "(B & C, 2001)", "10.2/b": "(Solo, 1999)"}


def fold(records):
    best = None
    for n, pref, i in records:
        if best is None or n > best[0] or (n == best[0] and pref):
            best = (n, pref, i)
    return best[2]


def test_best_of_equals_the_fold(spark):
    import random

    rng = random.Random(2)
    groups = {g: [(rng.randrange(3), rng.random() < 0.5, i) for i in range(rng.randrange(1, 7))] for g in range(150)}
    df = spark.createDataFrame([(g, n, p, i) for g, x in groups.items() for n, p, i in x], "g int, n int, p boolean, i int")
    got = {r.g: r.i for r in corpus.best_of(df, "g", F.col("n"), F.col("p"), "i").collect()}
    assert got == {g: fold(x) for g, x in groups.items()}


def test_rank_value_and_statistics(spark):
    df = spark.createDataFrame([("a" * n, None, "u") for n in (5, 7, 200, 300)] + [("", "d", None)], "abstract string, doi string, fulltext_url string")
    assert corpus.statistics(df).first().asDict() == {"total_records": 5, "with_abstract": 4, "with_doi": 1, "with_fulltext_url": 4, "abstract_ge_120_chars": 2, "median_abstract_chars": 200}


# joins
def test_contamination_exact(spark):
    s = "id string, passage string, source_excerpt string"
    train = spark.createDataFrame([("t1", "A  b", "zz"), ("t2", "none", " X y "), ("t3", "no", "no")], s)
    evals = spark.createDataFrame([("e1", "a B", "q"), ("e2", "r", "x Y")], s)
    assert [tuple(r) for r in joins.contamination_exact(train, evals).orderBy("id").collect()] == [("t1", "e1", None), ("t2", None, "e2")]


def test_containment_with_short_items(spark):
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "xtwo three fourx"), (3, "hi"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three four"), (2, "hi"), (3, ""), (4, None), (5, "wo three fou")], "item_id long, text string")
    assert rows(joins.containment(docs, items)) == [(1, 1), (1, 5), (2, 1), (2, 5), (3, 2)]


def test_updates_and_fallbacks(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(joins.update_from(base, spark.createDataFrame([(2, "z")], "id int, v string"), "id", ["v"])) == [(1, "a", False), (2, "z", True)]
    r = spark.createDataFrame([(3, "10.1/a"), (4, "10.9/z"), (5, None)], "line int, doi string")
    f = spark.createDataFrame([("a.pdf", 9, "10.1/a"), ("b.pdf", 2, None), ("c.pdf", 2, None)], "name string, file_line int, file_doi string")
    assert rows(joins.fallback_join(r, f, 2).select("line", "name", "matched_by").na.fill("-")) == [(3, "a.pdf", "doi"), (4, "c.pdf", "line"), (5, "-", "-")]


def test_pdf_of_another_doi_is_not_taken(spark):
    r = spark.createDataFrame([(1, "10.1/a", None), (2, "10.2/b", "x.pdf")], "line int, doi string, pdf_path string")
    f = spark.createDataFrame([("001_10.9_z.pdf",), ("077_10.1_a.pdf",), ("x.pdf",)], "name string")
    assert rows(joins.resolve_pdf(r, f), "line", "resolved") == [(1, "077_10.1_a.pdf"), (2, "x.pdf")]


def test_titles_and_assignment(spark):
    r = spark.createDataFrame([(1, "Deep learning for plants"), (2, "Soil carbon in forests"), (3, "Quite different words")], "line int, title string")
    f = spark.createDataFrame([("Deep Learning for Plants.pdf",), ("soil carbon forests.pdf",), ("Deep learning of plants x.pdf",)], "name string")
    best = joins.greedy_assignment(joins.fuzzy_titles(r, f))
    assert rows(best, "line", "name") == [(1, "Deep Learning for Plants.pdf"), (2, "soil carbon forests.pdf")]


def test_fuzzy_titles_equal_all_pairs(spark):
    rng = random.Random(4)
    words = "snow albedo feedback arctic sea ice model ozone CO2 nox soil".split()
    titles = ["snow albedo feedback", "sea ice", "Nox", "", *[" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(25)]]
    names = ["SnowAlbedoFeedback2019.pdf", "seaice-model.pdf", "a_nox_b.pdf", *["".join(c for c in " ".join(rng.choices(words, k=rng.randrange(1, 6))) if rng.random() > 0.15).replace(" ", rng.choice(["", "-", " "])) + f"{k}.pdf" for k in range(25)]]
    got = joins.fuzzy_titles(spark.createDataFrame(list(enumerate(titles)), "line int, title string"), spark.createDataFrame([(n,) for n in names], "name string"))
    fold = lambda t: " ".join(re.sub("[^a-z0-9]", " ", t.lower()).split())
    want = set()
    for k, t in enumerate(titles):
        for n in names:
            x, y = fold(t), fold(n[:-4])
            if x and y:
                score = max(0.75, min(len(x), len(y)) / max(len(x), len(y))) if x in y or y in x else difflib.SequenceMatcher(None, x, y).ratio()
                if score >= 0.55:
                    want.add((k, n))
    assert {(r.line, r.name) for r in got.collect()} == want and (0, "SnowAlbedoFeedback2019.pdf") in want


def test_partners_and_reconcile(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(5)], "row_ord int, id string")
    assert rows(joins.partners(df), "id", "partner_id") == [("r0", "r2"), ("r1", "r3"), ("r2", "r4"), ("r3", "r0"), ("r4", "r1")]
    s = "name string, size int, sha256 string"
    got = joins.reconcile(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 1, "q")], s), spark.createDataFrame([("a", 1, "x"), ("b", 3, "y"), ("d", 1, "z")], s))
    assert rows(got, "name", "state") == [("a", "same"), ("b", "size_differs"), ("c", "missing_remote"), ("d", "extra_remote")]


def test_cached_abstracts(spark):
    c = spark.createDataFrame([("1", None, "none"), ("2", "own", "export"), ("3", None, "none"), ("4", None, "none")], "doi string, abstract string, abstract_source string")
    cache = spark.createDataFrame([("1", "cached")], "doi string, abstract string")
    api = spark.createDataFrame([("1", "api"), ("3", "api3")], "doi string, abstract string")
    assert rows(joins.cached_abstracts(c, cache, [("openalex", api)]).na.fill("-"), "doi", "abstract", "abstract_source") == [("1", "cached", "cache"), ("2", "own", "export"), ("3", "api3", "openalex"), ("4", "-", "none")]


# windows and samples
def test_packing_and_chunks(spark):
    df = spark.createDataFrame([(["a" * 10, "b" * 10, "c" * 30, "d"],)], "s array<string>")
    assert df.select(windows.pack_sentences("s", 22)).first()[0] == ["a" * 10, "b" * 10]
    long = " ".join(f"Sentence number {i} speaks of topic{i} at length." for i in range(80))
    got = spark.createDataFrame([("topic7 topic9", long)], "p string, s string").select(windows.chunk_excerpt("p", "s", 300)).first()[0]
    assert len(got) <= 300 and "topic7 " in got and "topic9 " in got


def test_trim_and_split(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b") for i in range(10)], "i int, b string")
    assert rows(windows.trim_largest(df, "b", "i", 7), "i") == [(0,), (1,), (2,), (6,), (7,), (8,), (9,)]
    assert windows.trim_largest(df, "b", "i", 1).count() == 4  # one bucket only: the cap is exceeded
    s = windows.split(spark.range(200).withColumnRenamed("id", "id"), 46, 0.05)
    assert s.where("split = 'eval'").count() == 10 and s.count() == 200
    assert windows.smallest_draws(spark.range(50), 1, "id", 7).count() == 7
    assert windows.stratified(df.withColumnRenamed("i", "id"), "b", 6).count() == 6


def test_quotas_keep_priority_rows(spark):
    data = [(f"l3-x-sentence-{i}", "supported", 1) for i in range(5)] + [(f"s{i}", "supported", 1) for i in range(200)] + [(f"n{i}", "not_in_source", 1) for i in range(50)]
    df = spark.createDataFrame(data, "id string, verdict string, n int")
    got = windows.quotas(df, "verdict", 30, {"supported": 0.4, "not_in_source": 0.2}, F.contains("id", F.lit("-sentence-")), F.col("n") > 1)
    ids = [r.id for r in got.collect()]
    assert sum("-sentence-" in i for i in ids) == 5 and len(ids) == len(set(ids)) == 30


# scoring
def expect(least=None, want=None, ban=None, allow=None, quotes=False):
    return dict(must_parse_json=True, min_claims=least, any_claim_verdict=want, forbidden_claim_verdict=ban, all_claim_verdicts_in=allow, quotes_must_be_substrings=quotes)


def claim(verdict="supported", quotes=("the cat",), text="c"):
    return dict(claim=text, verdict=verdict, sourceQuotes=list(quotes))


def answer(*claims):
    return dict(claims=list(claims))


EVALS = [
    ("h-001", "the cat sat here", expect(1, ["supported"], quotes=True)),
    ("h-011", "x", expect(1, ["contradicted"], ["supported"])),
    ("h-020", "x", expect(2, allow=["weak"])),
    ("h-040", "x", expect()),
    ("z", "x", expect()),
]
PREDICTIONS = [
    ("h-001", json.dumps(answer(claim(quotes=["cat  sat"])))),
    ("h-011", json.dumps(answer(claim(quotes=[])))),
    ("h-020", '{"claims": [{"claim": "c", "verdict": "weak"}, {"claim": " ", "verdict": "weak"},]}'),
    ("h-040", "garbage"),
]


@pytest.fixture(scope="module")
def scored(spark):
    e = spark.createDataFrame(EVALS, f"id string, source_excerpt string, expect {jsonx.EXPECT}")
    return evaluate.score(e, spark.createDataFrame(PREDICTIONS, "id string, raw_output string"))


def test_score(scored):
    got = {r.id: r for r in scored.collect()}
    assert [got[i].failure_mode for i in ("h-001", "h-011", "h-020", "h-040", "z")] == ["pass", "wrong_verdict", "min_claims", "parse_json", "missing_prediction"]
    missing, banned = got["h-011"].failures
    assert missing.endswith("missing ['contradicted']") and banned.endswith("present: ['supported']")
    assert got["h-020"].failures == ["min_claims:1<2"] and got["h-020"].repaired_used  # the blank claim went before counting
    assert got["h-040"].failures == ["must_parse_json"]
    assert [got[i].category for i in ("h-001", "h-011", "h-020", "h-040", "z")] == ["supported", "contradicted", "not_in_source", "multi_claim", None]


def test_summary(scored):
    s = evaluate.summary(scored).first()
    assert (s.total, s.scored, s.json_parse_rate_strict, s.json_parse_rate_with_repair, s.expect_checks_pass_rate, s.quote_validity_rate, s.false_supported_rate) == (5, 4, 0.5, 0.75, 0.25, 1.0, 1.0)
    assert evaluate.summary(scored.limit(0)).first().quote_validity_rate is None
    assert rows(evaluate.category_rates(scored), "category", "rate")[0] == ("contradicted", 0.0)
    assert evaluate.failing_ids(scored).first().failing == ["h-011", "h-020", "h-040", "z"]
    assert evaluate.summary(scored, "category").count() == 6


def test_merge_and_means(spark):
    s = spark.createDataFrame([("a", 10, 0.5, None), ("b", 30, 0.9, 1.0)], "slice string, scored int, expect_checks_pass_rate double, quote_validity_rate double")
    m = evaluate.merge_slices(s).first()
    assert (m.scored, m.expect_checks_pass_rate, m.quote_validity_rate) == (40, 0.8, 1.0)
    assert evaluate.mean_over_seeds(spark.createDataFrame([(0.5, True, "x"), (0.7, False, "3")], "a double, b boolean, c string"), ["a", "b", "c"]).first() == (0.6, 0.5, 3.0)
    v = spark.createDataFrame([("h-1", "v1.1", "pass"), ("a", "v1.2", "weak"), ("h-1", "v9", "no")], "id string, version string, failure_mode string")
    assert [tuple(r) for r in evaluate.version_matrix(v, ["v1.1", "v1.2"]).collect()] == [("h-1", "pass", "—"), ("a", "—", "weak")]
    names = spark.createDataFrame([("v1.10",), ("v1.4a",), ("v1.2",)], "v string").orderBy(evaluate.natural_version(F.col("v")))
    assert [r.v for r in names.collect()] == ["v1.2", "v1.4a", "v1.10"]


def test_gates(spark):
    m = spark.createDataFrame([("combined_expect", 0.8812), ("json_parse", 0.99), ("supported_h", 8.0), ("core_legacy", 5.0), ("quote_validity", 0.8947), ("false_supported", 0.0657)], "metric string, value double")
    assert gates.verdict(gates.gates(m, gates.DEFAULT)).first().passed is True
    assert gates.verdict(gates.gates(m, gates.QUALITY)).first().passed is False
    assert gates.verdict(gates.gates(m, gates.BASELINE)).first().passed is True
    assert gates.verdict(gates.gates(m.where("metric <> 'json_parse'"), gates.DEFAULT)).first().failed == 1
    one = lambda e, q, c: spark.createDataFrame([(e, c, q)], "combined_expect double, multi_claim double, quote_validity double")
    hard = spark.createDataFrame([(True,)], "checks_passed boolean")
    assert gates.ab_decision(one(0.88, 0.9, 0.5), one(0.95, 0.95, 0.85), hard).first().decision == "adopt"
    assert gates.ab_decision(one(0.8812, 0.8947, 0.59), one(0.9391, 0.9474, 0.6154), hard).first().decision == "defer"
    p = spark.createDataFrame([(0.8, 0.9, 0.9, 0.0), (0.96, 0.76, 0.91, 0.9), (0.91, 0.71, 0.5, 0.0), (0.91, 0.65, 0.5, 0.0)], "parse_strict_rate double, combined_expect_rate double, quote_validity_rate double, false_supported_rate double")
    assert [r.verdict for r in gates.probe_verdict(p).collect()] == ["WAIT", "GO (later)", "AMBIGUOUS", "WEAK"]


# rules
@pytest.mark.parametrize(
    ("record", "want"),
    [
        ({"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "the cat", "meta": {}, "output": answer(claim())}, []),
        ({"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {}, "output": answer(claim(quotes=[]))}, ["supported claim requires sourceQuotes"]),
        ({"id": "a", "task": "l3_grounding", "passage": "p"}, ["missing source_excerpt", "missing meta", "neither output nor expect"]),
        ({"id": "a", "task": "l3_grounding", "passage": "p", "source_excerpt": "x", "meta": {"doc_id": "d", "language": "ar", "excerpt_mode": "paragraph"}, "output": {"claims": []}}, ["arabic_slice required"]),
        ({"id": "", "task": "nope"}, ["missing id", "unknown task"]),
        ({"id": "a", "task": "webpage_classify", "output": {}}, ["output.recommended_csl_type required"]),
        ({"id": "a", "task": "doc_extract"}, []),
    ],
)
def test_validation(spark, record, want):
    df = spark.createDataFrame([(json.dumps(record),)], "raw string")
    assert df.select(rules.grounding_errors().alias("e")).first().e == want


def test_label_audit(spark):
    df = spark.createDataFrame([("l3-x-multi-1", "It may rise by 5 units", [("It rose by 9", "contradicted", [], [], True), ("Made up words entirely", "supported", ["It may rise by 5 units"], [], False)])], f"id string, ex string, claims array<{jsonx.CLAIM}>")
    got = df.select(rules.label_audit(F.col("id"), F.col("ex"), F.lit("p"), F.col("claims")).alias("e")).first().e
    assert got == ["quotes_missing@0", "claim_not_aligned@1"]
    keys = spark.createDataFrame([('{"claim":"a","verdict":"weak","sourceQuotes":[],"rationale":[],"hasNumericClaim":false}',), ('{"verdict":"weak","claim":"a"}',)], "c string")
    assert [r[0] for r in keys.select(rules.claim_keys_ordered("c")).collect()] == [True, False]


# generator
def test_generator_rows(spark):
    text = (
        "METHODS: We enrolled adults at two centres and followed the protocol for one year in all. Sensitivity was 91% in the enrolled adults of the trial at the centre. "
        "The exposure was associated with improved outcomes and this result was significant overall. The drug may possibly reduce the burden of disease in most older patients. "
        "RESULTS: The measure increased by 12% in 40 participants of the second group. There was a significant association between dose and response, as we found."
    )
    papers = spark.createDataFrame([("p1", text, ["Ann Bee", "Cy Dee", "E F"], 2020, "http://u", "10.1/a"), ("p2", "too short", [], None, None, None)], "corpus_id string, abstract string, authors array<string>, year int, article_url string, doi string")
    got = generate.Generator(seed=3).rows(papers).collect()
    kinds = {r.kind for r in got}
    assert {"sup", "con", "nis", "over", "multi", "multip", "pol"} <= kinds and all(r.corpus_id == "p1" for r in got)
    assert [r.idx for r in sorted(got, key=lambda r: r.idx)] == list(range(len(got)))
    for r in got:
        for c in r.claims:
            if c.verdict == "supported":
                assert c.sourceQuotes and all(q in text for q in c.sourceQuotes)
        assert r.id == f"l3-p1-{r.kind}-{r.idx}" and len(r.source_excerpt) <= 1800
    assert next(r for r in got if r.kind == "multi").claims[0].verdict == "supported"
    assert "no association" in next(r for r in got if r.kind == "pol").passage
    assert {r.verdict for r in generate.verdict_histogram(generate.Generator(seed=3).rows(papers)).collect()} >= {"supported", "not_in_source"}
    assert [tuple(r) for r in generate.Generator(seed=3).rows(papers).orderBy("id").collect()] == [tuple(r) for r in generate.Generator(seed=3).rows(papers).orderBy("id").collect()]


def test_prompts(spark):
    m = spark.createDataFrame([([("system", "S"), ("user", "a"), ("assistant", " "), ("user", "b")],)], "m array<struct<role:string,content:string>>")
    assert m.select(generate.fold_system(F.col("m"))).first()[0][0].content == "S\n\na\n\nb"
    assert [x.content for x in m.select(generate.suffix_last_user(F.col("m"), " /x")).first()[0]] == ["S", "a", " ", "b /x"]
    assert spark.range(1).select(generate.year_bin(F.lit(2015)), generate.mapped(F.lit("support"), generate.VERDICT_SYNONYMS)).first() == ("2010-2019", "supported")


# body
def test_body_rules(spark):
    ok = "Plain body text about results and methods of a study with some words. " * 10
    bad = ["Smith et al 2001, Lee et al 2002, Kim et al 2003, Roe et al 2004. " * 9, "/C12 /G3F " * 40 + ok, "Intro ........ 3\n" * 40, "References\n" + ok, "short"]
    df = spark.createDataFrame([(t,) for t in [ok, *bad]], "t string")
    assert [r[0] for r in df.select(body.acceptable("t")).collect()] == [True] + [False] * 5
    pages = spark.createDataFrame([("d", [ok, ok[:420], "x"], 2), ("e", ["x"], None)], "id string, pages array<string>, hint int")
    got = {r.id: r for r in body.windows(pages, 800).collect()}
    assert (got["d"].first, got["d"].last) == (1, 2) and got["e"].excerpt is None
    assert spark.createDataFrame([("Nothing of note was said in this long sentence of words. We found 12 significant effects in the treated group of this trial.",)], "t string").select(body.best_passage("t", 40)).first()[0].startswith("We found 12")


def test_contrastive_order(spark):
    df = spark.createDataFrame([(0, "a", "rose by 12% today", "x"), (1, "b", "it was higher there", "y"), (2, "c", "plain words", "z")], "row_ord int, id string, passage string, source_excerpt string")
    assert rows(body.contrastive(df), "parent_id", "contrastive_kind", "passage") == [("a", "numeric_overclaim", "rose by 99% today"), ("b", "polarity_flip", "it was lower there"), ("c", "cross_doc", "rose by 12% today")]
    kept, dropped = rules.split_dropped(df, spark.createDataFrame([("b", "bad")], "id string, reason string"))
    assert kept.count() == 2 and rows(dropped, "id", "reason") == [("b", "bad")]
    frozen = body.freeze(spark.createDataFrame([("a", ("l", "draft"))], "id string, meta struct<label:string,draft_status:string>"), "v1").first()
    assert frozen.meta.draft_status == "frozen" and frozen.meta.label == "l" and len(frozen.meta.frozen_date) == 10
    pair = spark.createDataFrame([(["A first sentence without it.", "The results show a second thing.", "third"],)], "s array<string>").select(body.best_pair(F.col("s"))).first()[0]
    assert pair == ["A first sentence without it.", "The results show a second thing."]


# open access
def test_ranking(spark):
    s = "doi string, pos int, url string, url_for_pdf string, landing string, host_type string"
    locs = spark.createDataFrame(
        [("10.1/a", 0, "https://repo.x/1", None, None, "repository"), ("10.1/a", 1, "https://pub.x/10.1/a", "https://pub.x/10.1/a.pdf", None, "publisher"), ("10.1/a", 2, "https://europepmc.org/pmc/articles/PMC12", None, None, "repository"), ("10.1/a", 3, None, "https://pub.x/10.1/a.pdf", None, "repository"), ("10.2/b", 0, "https://pub.x/q", None, None, "publisher")],
        s,
    )
    got = rows(oa.rank_locations(locs), "doi", "rank", "score", "rejected")
    assert got == [("10.1/a", 1, 170, 1), ("10.1/a", 2, 110, 1), ("10.2/b", 1, 35, 0)]
    over = spark.createDataFrame([("10.2/B", "https://o.x/f", None, "why")], "doi string, url string, host_type string, reason string")
    ranked = oa.rank_locations(locs, over)
    assert rows(ranked.where("doi = '10.2/b'"), "url", "score") == [("https://o.x/f", 10000)]
    probes = spark.createDataFrame([("https://europepmc.org/pmc/articles/PMC12", True)], "url string, ok boolean")
    assert rows(oa.select_verified(ranked, probes), "doi", "url")[0] == ("10.1/a", "https://europepmc.org/pmc/articles/PMC12")


def test_url_flags_and_probe(spark):
    df = spark.createDataFrame([(1, "10.1/a", "t", "https://hdl.handle.net/1", "repository", None), (2, "10.1/a", "t", "https://hdl.handle.net/1", "repository", "operator_override"), (3, "10.1/a", "t", "https://doi.org/10.1/a", "publisher", None), (4, None, "t", "u", None, None), (5, "10.1/a", "t", "https://x.y/10.1%2Fa", "publisher", None)], "line int, doi string, title string, url string, host_type string, url_selection string")
    assert rows(oa.audit(df), "line", "reasons") == [(1, ["high_risk_host:hdl.handle.net", "untrusted_repo_no_doi"]), (3, ["doi_resolver_only"]), (4, ["missing_doi_or_url"])]
    web = {"http://a/": (200, b'<a href="x.pdf">'), "http://a/x.pdf": (200, b"%PDF-1.4"), "http://b/": (403, b"login")}
    got = oa.probe(spark.createDataFrame([("1", "http://a/"), ("2", "http://b/")], "id string, url string"), lambda u: web.get(u, (404, b"")))
    assert rows(got, "id", "url", "ok") == [("1", "http://a/x.pdf", True), ("2", "http://b/", False)]
    urls = spark.createDataFrame([("https://www.nature.com/articles/x",), ("https://link.springer.com/article/10.1/z?q=1",)], "u string").select(oa.candidate_urls(F.col("u"))).collect()
    assert urls[0][0][1] == "https://www.nature.com/articles/x.pdf" and urls[1][0][1] == "https://link.springer.com/content/pdf/10.1/z.pdf"


# sources, sinks, streams
def test_readers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "x", "doi": "10.1/A", "v": 1}\n\n{"id": "y", "doi": "doi:10.1/a", "v": 2}\n{"id": "x", "doi": "10.2/b", "v": 3}\n')
    assert readers.json_lines(spark, str(p), "id string, v int").count() == 3
    assert readers.json_lines(spark, str(tmp_path / "none.jsonl"), "id string").count() == 0
    assert rows(readers.json_lines_numbered(spark, str(p)), "line_no") == [(1,), (3,), (4,)]
    assert rows(readers.json_lines_by_id(spark, str(p), "id string, v int"), "id", "v", "row_ord") == [("x", 3, 1), ("y", 2, 3)]
    assert rows(readers.manifest(spark, str(p)), "doi", "line_no") == [("10.1/a", 3), ("10.2/b", 4)]
    (tmp_path / "no.jsonl").write_text('{"v": 1}\n')
    with pytest.raises(Exception, match="missing id"):
        readers.json_lines_by_id(spark, str(tmp_path / "no.jsonl"), "id string, v int").collect()
    arr = tmp_path / "openalex_x.json"
    arr.write_text('﻿[{"id": "q"}, 3, "s"]', encoding="utf-8")
    assert rows(readers.json_array(spark, str(arr), "id string"), "id") == [("q",)]
    assert readers.exports(spark, str(tmp_path / "openalex*.json"), "id string").select("source_export").distinct().first()[0] == "openalex"
    ov = tmp_path / "ov.json"
    ov.write_text('{"_comment": "x", "10.1/A": {"url": " u ", "is_oa": true}, "10.2/b": {"url": ""}, "10.3/c": 4}')
    assert rows(readers.overrides(spark, str(ov)), "doi", "url", "is_oa") == [("10.1/a", "u", True)]
    rep = tmp_path / "rep.json"
    rep.write_text('{"holdout": {"per_row": [{"id": "h-1", "checks_passed": true}]}, "expect_checks_pass_rate": 0.5}')
    assert rows(readers.report_rows(spark, str(rep)), "id", "checks_passed") == [("h-1", True)]
    assert rows(readers.report_metrics(spark, str(rep), ["expect_checks_pass_rate"])) == [("expect_checks_pass_rate", 0.5)]
    pdf = tmp_path / "012_10.1_a.pdf"
    pdf.write_bytes(b"%PDF-1.4 one")
    assert rows(readers.listing(spark, str(tmp_path)), "name", "file_line", "file_doi") == [("012_10.1_a.pdf", 12, "10.1/a")]
    assert readers.fingerprints(spark, str(tmp_path)).first().is_pdf is True
    assert readers.pdf_pages(spark, str(tmp_path), lambda b, first: [str(len(b))] * 30).first().pages == ["12"] * 24


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", None, "é"), ("2", "x", 'q"')], "doi string, a string, b string")
    sinks.json_lines(df, f"{tmp_path}/j", nulls=True)
    assert spark.read.text(f"{tmp_path}/j").where("value like '%null%'").count() == 1
    sinks.json_text(df, f"{tmp_path}/t")
    assert spark.read.text(f"{tmp_path}/t").orderBy("value").first().value == '{"doi": "1", "a": null, "b": "é"}'
    sinks.csv(df, f"{tmp_path}/c", bom=True)
    back = readers.csv(spark, f"{tmp_path}/c")
    assert back.count() == 2 and back.where("b = 'q\"'").count() == 1
    new = spark.createDataFrame([("2", "n1", "b", 1), ("2", "n2", "b", 2), ("3", "n", "b", 1)], "doi string, a string, b string, seq int")
    assert rows(sinks.upsert(df, new, "doi", "seq").na.fill("-"), "doi", "a") == [("1", "-"), ("2", "n2"), ("3", "n")]
    assert rows(sinks.replace_range(spark.range(5).toDF("n"), spark.range(9, 10).toDF("n"), "n", 1, 3)) == [(0,), (4,), (9,)]
    assert rows(sinks.update_rows(df.select("doi", "b"), spark.createDataFrame([("2", "z")], "doi string, b string"), "doi")) == [("1", "é"), ("2", "z")]
    assert sinks.markdown(df.select("doi", "a").orderBy("doi")).splitlines()[2] == "| 1 | — |"
    sinks.fan_out(df, F.col("doi"), f"{tmp_path}/f")
    assert spark.read.text(f"{tmp_path}/f/txt").count() == 2
    with pytest.raises(ValueError, match="exceed"):
        sinks.chat(spark.createDataFrame([("a", 9)], "id string, tokens int"), f"{tmp_path}/x", 5)


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "doi string, status string, seq long"
    (src / "1.json").write_text('{"doi": "a", "status": "pdf_filed", "seq": 1}\n{"doi": "b", "status": "new", "seq": 1}\n')
    run = lambda: incremental.upsert_stream(incremental.source(spark, str(src), schema), f"{tmp_path}/t", f"{tmp_path}/cp").awaitTermination()
    run()
    (src / "2.json").write_text('{"doi": "a", "status": "failed", "seq": 2}\n{"doi": "b", "status": "done", "seq": 2}\n{"doi": "c", "status": "new", "seq": 2}\n')
    run()
    assert rows(incremental.read_state(spark, f"{tmp_path}/t"), "doi", "status") == [("a", "pdf_filed"), ("b", "done"), ("c", "new")]
    done = spark.createDataFrame([("a",)], "doi string")
    incremental.enrich_stream(incremental.unseen_stream(incremental.source(spark, str(src), schema), done), lambda b: b.withColumn("x", F.lit(1)), f"{tmp_path}/s", f"{tmp_path}/cp2").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/s"), "doi", "x") == [("b", 1), ("b", 1), ("c", 1)]
    calls = incremental.with_retries(spark.createDataFrame([("1", "p"), ("2", "q")], "id string, prompt string"), lambda p, n: (p == "p" or n == 1, f"{p}{n}"), 3, 2)
    assert rows(calls, "id", "ok", "output", "attempts") == [("1", True, "p0", 1), ("2", True, "q1", 2)]
    assert incremental.token_counts(spark.createDataFrame([("a b, c",)], "t string"), "t").first().tokens == 4

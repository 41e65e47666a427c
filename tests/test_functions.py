"""Scalar functions against exact expectations."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from grainmill.functions import jsonx
from grainmill.functions import text as T


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string' if not isinstance(v, int) else 'int'}" for k, v in values.items()))
    return df.select(col.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("https://doi.org/10.55/QRS", "10.55/qrs"), ("DOI:10.1/x", "10.1/x"), ("", None), ("  http://doi.org/doi:10.5/Y ", "10.5/y")])
def test_doi(spark, raw, want):
    assert one(spark, T.normalize_doi("s"), s=raw) == want


@pytest.mark.parametrize(("s", "want"), [("a rate of 12% here", "a rate of 99% here"), ("a rate of 80% here", "a rate of 8% here"), ("in n=40 people", "in n=400 people"), ("since 2001 it", "since 2021 it"), ("since 2015 it", "since 1995 it"), ("the PBE 27 setup", None), ("no digits", None)])
def test_mutate_number(spark, s, want):
    assert one(spark, T.mutate_number("s"), s=s) == want


@pytest.mark.parametrize(("s", "want"), [("It increased, then Increased again", "It decreased, then Increased again"), ("A significant effect", "A nonsignificant effect"), ("nothing to swap", None), ("It was observed twice", "It was not observed twice")])
def test_flip_polarity(spark, s, want):
    assert one(spark, T.flip_polarity("s"), s=s) == want


@pytest.mark.parametrize(("s", "want"), [("rose by 10 percent", "rose by 15 percent"), ("p of 0.05 only", "p of 0.2 only"), ("none", None)])
def test_flip_number(spark, s, want):
    assert one(spark, T.flip_number("s"), s=s) == want
    assert one(spark, T.flip_number("s", 3), s=s) is None


def test_alignment(spark):
    yes = one(spark, T.numbers_aligned("c", "s"), c="sensitivity was 95%", s="It was 95% (95% CI 92-97)")
    no = one(spark, T.numbers_aligned("c", "s"), c="the rate halved", s="It fell by 12%")
    assert yes is True and no is False
    assert one(spark, T.meaning_aligned("c", "s"), c="Compliance with protocol was high", s="protocol compliance stayed high throughout") is True
    assert one(spark, T.claim_absent("c", "s"), c="lunar cycles predicted returns weekly", s="something else entirely") is True


def test_quotes(spark):
    ok = lambda q, e: one(spark, T.quote_in_excerpt("q", "e"), q=q, e=e)
    assert ok("a &lt; b", "we saw that a < b here") and ok("r esults were", "the results were good") and ok("x–y", "an x-y pair") and ok("", "any")
    assert not ok("not there", "something else")
    assert one(spark, T.quote_in_excerpt_simple("q", "e"), q="a  b", e="x a b y")


def test_page_text(spark):
    assert one(spark, T.normalize_page("s"), s="Treat-\nment  results\nfollow") == "Treatment results follow"
    assert one(spark, T.normalize_page("s"), s="ne­ glected–x") == "neglected-x"


def test_small_text_functions(spark):
    assert one(spark, T.collapse_letter_spaces("s"), s="n e g 1 2") == "neg 1 2"
    assert one(spark, T.escape_xml("s"), s="a<b>&c") == "a&lt;b&gt;&amp;c"
    assert one(spark, T.strip_hedges("s"), s="It may possibly work , well") == "It work, well"
    assert one(spark, T.sentences("s", 5), s="One two. Three four! No? Yes indeed.") == ["One two.", "Three four!", "Yes indeed."]
    assert one(spark, T.doi_file_name("s"), s="10.1/a b") == "10.1_a_b"
    assert one(spark, T.page_hint("s"), s="see p. 12") == 12 and one(spark, T.page_hint("s"), s="p. 0") is None
    assert one(spark, T.strip_tags("s"), s="<p>a <i>b</i></p>") == "a b"
    assert one(spark, T.pdf_links("s"), s='<a href="/a.pdf">x</a><a href="/pdf/b">y</a><a href="/a.pdf">z</a>') == ["/a.pdf", "/pdf/b"]
    assert one(spark, T.fold_accents("s"), s="Éà-b  C") == "ea b c"
    assert one(spark, T.title_similarity("a", "b"), a="abc def", b="abc") == 0.75
    assert one(spark, T.short_claim("s"), s="x" * 100 + " 42 " + "y" * 50).startswith("x" * 20)
    assert one(spark, T.excerpt_preview("s", "a"), s="z" * 100 + "needle" + "y" * 400, a="needle").startswith("...")
    assert one(spark, T.clip_at_word("s"), s="ab " * 100).endswith("ab…")
    assert one(spark, T.overlap_tokens("s"), s="The cat, the CAT; a dog.") == ["the", "cat", "dog"]


@pytest.mark.parametrize(
    ("raw", "status"),
    [
        ('{"claims": []}', "ok"), ('```json\n{"claims": []}\n```', "ok"), ('<channel|> {"claims": []}', "ok"), ('{"claims": [],}', "ok_repaired"), ('{"claims"?: []}', "ok_repaired"),
        ('{"claims": [{"claim": "a", "rationale": ["t"}], "overallVerdict": "weak"}', "ok_repaired"), ('{"claims": []} then } junk', "ok_repaired"), ("none", "parse_fail:No JSON object"), ('{"claims": 3}', "parse_fail:Invalid JSON"), ("", "parse_fail:No JSON object"),
    ],
)
def test_parse_status(spark, raw, status):
    assert one(spark, jsonx.parse_status("s"), s=raw) == status


def test_repair_keeps_valid_json(spark):
    good = '{"claims": [{"claim": "a, b", "verdict": "weak", "rationale": ["r"]}], "overallVerdict": "weak"}'
    assert one(spark, jsonx.repair("s"), s=good) == good


def test_claims_are_cleaned(spark):
    raw = '{"claims": [3, {"claim": " ", "verdict": "weak"}, {"claim": "x", "verdict": "maybe"}, {"claim": 7, "verdict": "weak"}, {"claim": "ok", "verdict": "weak", "extra": 1}]}'
    got = one(spark, jsonx.clean_claims(jsonx.parse_strict("s")), s=raw)
    assert [(c.claim, c.verdict) for c in got] == [("ok", "weak")]


def test_inverted_index_and_json(spark):
    df = spark.createDataFrame([({"Hello": [0], "world": [1, 3], "big": [2]},), ({},), (None,)], "m map<string,array<int>>")
    assert [r.x for r in df.select(jsonx.invert_index("m").alias("x")).collect()] == ["Hello world big world", None, None]
    assert one(spark, jsonx.spaced_json("s"), s='{"a":1,"b":["é"]}') == '{"a": 1, "b": ["é"]}'
    assert one(spark, jsonx.get("s", "$.a.b", "int", 5), s='{"a": {}}') == 5
    assert one(spark, jsonx.first_object("s"), s='x {"a": 1} {"b"') == '{"a": 1}'
    assert F is not None

"""Unions, samples, audits and composed steps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from grainmill.functions import jsonx
from grainmill.operators import gates, oa, sets
from tests.test_operators import EVALS, PREDICTIONS, rows


def test_unions(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, row_ord int")
    b = spark.createDataFrame([("x", 1, "n"), ("z", 2, "n"), (None, 3, "n")], "id string, row_ord int, extra string")
    assert rows(sets.union_first(a, b), "id", "file_ord") == [("x", 0), ("y", 0), ("z", 1)]
    with pytest.raises(ValueError, match="repeated id"):
        sets.union_unique(a, b.where("id is not null"))
    assert sets.union_unique(a, b.where("id = 'z'")).count() == 3
    with pytest.raises(Exception, match="row without id"):
        sets.with_ids(b).collect()


def test_samples(spark):
    pool = spark.range(200).selectExpr("cast(id as string) corpus_id")
    held, rest = sets.holdout(pool, 100)
    assert held.count() == 50 and rest.count() == 150 and held.join(rest, "corpus_id").count() == 0
    assert sets.holdout(pool, 160)[0].count() == 0
    assert sets.fraction(pool, 0.15, key="corpus_id").count() == 30


def test_files(spark):
    f = spark.createDataFrame([("a.gguf",), ("b.gguf",)], "name string")
    assert sets.single_file(f, "b.gguf").first().name == "b.gguf" and sets.single_file(f.limit(1), "q").count() == 1
    with pytest.raises(Exception, match="ambiguous"):
        sets.single_file(f, "q").collect()


def test_length_audit(spark):
    r = spark.range(100).selectExpr("id", "id * 30 as tokens")
    got = sets.length_audit(r).first()
    assert (got.rows, got.longest, got.p95, got.overflow) == (100, 2970, 2850, 31) and sets.overflowing(r).count() == 31


def test_pilot_coverage(spark):
    r = spark.createDataFrame([("d", "paragraph", "en", "{}"), (None, "paragraph", "ar", "{}")], "doc_id string, excerpt_mode string, language string, expect string")
    assert rows(sets.pilot_coverage(r, 1).na.fill("all", ["language"]), "language", "valid") == [("all", 1), ("ar", 0), ("en", 1)]


def test_sequence_safe(spark):
    claims = [("c", "supported", ["the quoted sentence stands here in full."], [], False)]
    long = "the quoted sentence stands here in full. " + "filler words that go on and on without end. " * 100
    df = spark.createDataFrame([("a", "quoted sentence stands", long, claims), ("b", "filler words without", long.replace("the quoted sentence stands here in full. ", ""), claims)], f"id string, passage string, source_excerpt string, claims array<{jsonx.CLAIM}>")
    assert rows(sets.sequence_safe(df, F.size(F.split("source_excerpt", " "))), "id") == [("a",)]


def test_score_slices(spark):
    e = spark.createDataFrame(EVALS, f"id string, source_excerpt string, expect {jsonx.EXPECT}")
    p = spark.createDataFrame(PREDICTIONS, "id string, raw_output string")
    reports, metrics = sets.score_slices({"holdout": (e, p), "legacy": (e.limit(1), p)})
    m = {r[0]: r[1] for r in metrics.collect()}
    assert reports.count() == 2 and m["supported_h"] == 1.0 and m["core_legacy"] == 1.0 and m["quote_validity"] == 1.0 and m["combined_expect"] == 0.4
    assert gates.gates(metrics).count() == 6


def test_extract_rows(spark):
    s = spark.createDataFrame([("10.1/a", "http://u", "publisher", "scored_oa_location", 110, True)], "doi string, url string, host_type string, selection string, score int, ok boolean")
    r = oa.extract_rows(s).first()
    assert r.id.startswith("oa-") and len(r.id) == 19 and r.meta.label == "publisher_pdf" and r.output.fetch_status == "pdf_verified"

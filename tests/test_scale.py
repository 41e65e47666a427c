"""Work is dealt over the tasks, done once, and equal to the plain forms it stands for."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import evaluate, generate, sets
from grainmill.plans import registry
from grainmill.plans.catalog import ORACLE_SQL, QUERIES
from grainmill.sources import readers, sinks


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Ten thousand parts in one row group, as one task reads them."""
    d = str(tmp_path_factory.mktemp("sf"))
    spark.range(10_000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("red "), (F.col("id") % 50).cast("string")).alias("p_name"), (F.col("id") % 50 + 1).cast("int").alias("p_size")).coalesce(1).write.parquet(f"{d}/part.parquet")
    return d


def test_a_view_deals_its_rows_over_the_tasks(spark, parts):
    rows = registry.view(spark, parts, "SELECT p_partkey FROM {part}")
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 1_200
    assert rows.distinct().count() == 10_000


def test_filters_stay_above_the_dealing(spark, parts):
    rows = registry.view(spark, parts, "SELECT p_partkey, md5(p_name || p_partkey) AS h FROM {part}").where("h < '8'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Repartition") and "Filter" not in plan[plan.index("Repartition") :]


def test_required_text():
    assert T.required(r"followed for (?:a )?mean of (\d+) months") == "followed for "
    assert T.required(r"(\d+)\s*% \(95% CI") == "% (95% ci" and T.required(r"hypothesiz\w*") == "hypothesiz" and T.required(r"\d+") == ""


def test_alternatives_by_their_literals(spark):
    texts = ["It may be.", "Maybe not", "it APPEARS so", "ſuggest this", "Résults", "we found it", "unfounded", "", None, "Kelvin could"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(T.has_hedge("t"), F.regexp_like("t", F.lit(T.HEDGE)), T.has_result("t"), F.regexp_like("t", F.lit(T.RESULTS))).collect()
    assert any(r[1] for r in got) and any(r[3] for r in got) and all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_absent_claim_is_the_first_drawn_that_the_text_lacks(spark):
    g = generate.Generator()
    texts = ["", None, " ".join(g.pools.absent).upper(), g.pools.absent[0], " ".join(g.pools.absent[2:])]
    df = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts * 20)], "corpus_id string, abstract string")
    for i, t, got in df.select("corpus_id", "abstract", g.absent_claim()).collect():
        order = sorted(g.pools.absent, key=lambda c: hashlib.md5(f"42|absent|{i}|{c}".encode()).hexdigest())
        words = lambda c: re.findall("[a-z]{5,}", c.lower())
        free = [c for c in order if len(words(c)) < 3 or sum(w in (t or "").lower() for w in words(c)) < max(2, len(words(c)) // 2)]
        assert got == (free or order)[0]


def test_a_share_is_drawn_from_rows_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(200).selectExpr("cast(id as string) id").mapInPandas(count, "id string")
    assert sets.fraction(rows, 0.15).count() == 30 and seen.value == 200


def test_failing_rows_are_scored_once_and_joined_in_order(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    scored = spark.range(5_000).selectExpr("concat('h-', id) id", "id % 5 = 0 checks_passed").repartition(7).mapInPandas(count, "id string, checks_passed boolean")
    want = sorted(f"h-{i}" for i in range(5_000) if i % 5)
    assert evaluate.failing_ids(scored, most=None).first().failing == want and seen.value == 5_000
    assert [r.id for r in evaluate.failing_rows(scored).collect()] == want
    assert evaluate.failing_ids(scored.where("checks_passed"), most=3).first().failing == []
    with pytest.raises(Exception, match="more than 3 failing rows"):
        evaluate.failing_ids(scored, most=3).collect()


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """1,500 texts of 300 characters in two languages, words next to letters beyond ASCII."""
    d = str(tmp_path_factory.mktemp("docs"))
    words = ["the end and", "éque là and", "thé anda orque", "que él", "nothing"]
    rows = [(i, (words[i % 5] + " ").ljust(300 + i % 7, "x"), "en" if i % 2 else "fr", "s", 300) for i in range(1_500)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet/*.parquet'")
    return d, con


@pytest.mark.parametrize("name", ["number_survivors", "number_survivors_whole", "polarity_flip"])
def test_beyond_a_thousand_rows_and_english(spark, documents, name):
    d, con = documents
    a = sorted(map(tuple, QUERIES[name](spark, d).collect()), key=repr)
    assert a == sorted(con.execute(ORACLE_SQL[name]).fetchall(), key=repr) and len(a) == 1_500
    assert len({r[1] for r in a}) == 1_500 or name != "number_survivors_whole"


def test_line_numbers_of_a_file_in_many_splits(spark, tmp_path):
    lines = spark.range(3_000).repartition(5).orderBy("id").selectExpr("if(id % 10 = 9, if(id % 20 = 9, '', '  '), concat('{\"n\": ', id, '}', if(id % 7 = 0, '\r', ''))) value")
    at = f"{tmp_path}/log.jsonl"
    sinks.joined_file(lines, at)
    (tmp_path / "other.jsonl").write_text("a\n\nb")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.json_lines_numbered(spark, at)
        assert got.rdd.getNumPartitions() > 5
        assert sorted(map(tuple, got.collect())) == [(i + 1, f'{{"n": {i}}}') for i in range(3_000) if i % 10 != 9]
        both = readers.json_lines_numbered(spark, f"{tmp_path}/*.jsonl")
        assert both.count() == 2_702 and sorted(map(tuple, both.where("length(raw) = 1").collect())) == [(1, "a"), (3, "b")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "empty.jsonl").write_text("")
    assert readers.json_lines_numbered(spark, f"{tmp_path}/empty.jsonl").count() == 0

"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import difflib
import hashlib
import math
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from grainmill.functions.text import SWAPS
from grainmill.operators import body, generate, joins, windows
from grainmill.plans import catalog_rows
from grainmill.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list:
    def cell(v):
        v = v.item() if hasattr(v, "item") else v
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(v, 9) if isinstance(v, float) else v

    return sorted(repr(tuple(cell(v) for v in r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_oracle(spark, duck, sf, name):
    a, b = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert canonical(a) == canonical(b)


def test_repair_query(spark, sf):
    assert [r.status for r in QUERIES["json_repair"](spark, sf).orderBy("id").collect()] == ["ok", "ok_repaired", "ok_repaired", "ok_repaired", "parse_fail:No JSON object", "parse_fail:Invalid JSON"]


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "item_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flip_number_covers_whole_texts(spark, duck, sf):
    docs = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    got = {r.doc_id: r.flipped_md5 for r in QUERIES["flip_number"](spark, sf).collect()}
    assert got.keys() == docs.keys() and any(got.values())
    for i, t in docs.items():
        m = re.search(r"[0-9]+(?:\.[0-9]+)?", t or "")
        n = m and float(m[0])
        want = m and t[: m.start()] + (str(math.floor(n * 1.4 + 1)) if n >= 1 else str(round(n + 0.15, 2))) + t[m.end() :]
        assert got[i] == (want and hashlib.md5(want.encode()).hexdigest())


def test_polarity_flip_covers_all_languages(spark, duck, sf):
    docs = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    got = {r.doc_id: r.flipped_md5 for r in QUERIES["polarity_flip_all"](spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        flips = (re.sub(rf"(?i)\b{a}\b", b, t or "", count=1) for a, b in (*SWAPS, ("the", "no"), ("and", "or"), ("que", "qui")) if re.search(rf"(?i)\b{a}\b", t or ""))
        assert got[i] == next((hashlib.md5(f.encode()).hexdigest() for f in flips), None)


def test_page_windows_equal_a_plain_loop(spark, duck, sf):
    quality = {r.doc_id: list(r.q) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.expr("filter(transform(sequence(0, cast(floor(greatest(length(text) - 1, 0) / 500) as int)), i -> substr(text, i * 500 + 1, 500)), p -> p <> '')").alias("pages")).select("doc_id", F.transform("pages", lambda p: body.page_quality(p)).alias("q")).collect()}
    got = {r.doc_id: r for r in QUERIES["page_windows"](spark, sf).collect()}
    for i, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        pages = [text[k : k + 500] for k in range(0, len(text), 500)]
        score = [q + (1e9 if i % 3 == 0 and k == 1 else 0) for k, q in enumerate(quality[i])]
        best = max(range(len(pages)), key=lambda k: (score[k], k), default=None)
        if best is None or score[best] < 0:
            assert got[i].first is None
            continue
        lo = hi = best
        while sum(map(len, pages[lo : hi + 1])) < 1200 and hi - lo + 1 < len(pages):
            left, right = (len(pages[lo - 1]) if lo else -1), (len(pages[hi + 1]) if hi + 1 < len(pages) else -1)
            lo, hi = (lo - 1, hi) if left > right else (lo, hi + 1)
        assert (got[i].first, got[i].last, got[i].excerpt_md5) == (lo + 1, hi + 1, hashlib.md5(" ".join(pages[lo : hi + 1]).encode()).hexdigest())


def test_titles_equal_all_pairs_and_their_greedy_assignment(spark, duck, sf):
    names = sorted(r[0] for r in duck.execute("SELECT DISTINCT p_name FROM part").fetchall())
    score = lambda x, y: max(0.75, min(len(x), len(y)) / max(len(x), len(y))) if x in y or y in x else difflib.SequenceMatcher(None, x, y).ratio()
    files = [n.title().replace(" ", "") + "Study.pdf" for n in names]
    want = {(k + 1, f): math.floor(s * 1000 + 0.5) / 1000 for k, n in enumerate(names) for f in files if (s := score(f"the {n} study", f[:-4].lower())) >= 0.7995}
    want = {k: s for k, s in want.items() if s >= 0.8}
    assert {(r.line, r.name): r.score for r in QUERIES["title_matches"](spark, sf).collect()} == want
    taken = {}
    for (line, name), _ in sorted(want.items(), key=lambda x: (x[1], x[0]), reverse=True):
        if line not in taken and name not in taken.values():
            taken[line] = name
    assert {r.line: r.name for r in QUERIES["title_assignment"](spark, sf).collect()} == taken


def test_sequence_safe_equals_a_plain_filter(spark, sf):
    rows = {r.id: r for r in generate.Generator().rows(catalog_rows.papers(spark, sf), kinds=["sup"]).collect()}
    got = {r.id: r for r in QUERIES["sequence_safe"](spark, sf).collect()}
    assert 0 < len(got) < len(rows)
    for i, r in rows.items():
        text = " ".join(r.source_excerpt.split())
        if len(text) > 300:
            tokens = lambda t: {w for w in t.lower().replace(",", " ").replace(".", " ").replace(";", " ").split() if len(w) >= 3}
            parts = [p.strip() for p in re.split(r"(?<=[.!?])\s+", text) if len(p.strip()) > 20]
            mine, out = tokens(r.passage), ""
            for p in sorted(parts, key=lambda p: -len(mine & tokens(p)) / len(mine)):
                if len(out) + (2 if out else 0) + len(p) > 300:
                    break
                out += ("\n\n" if out else "") + p
            text = out or text[:300]
        fits = all(q in text for c in r.claims for q in c.sourceQuotes) and len(text.split(" ")) <= 45
        assert (i in got) == fits
        assert not fits or got[i].excerpt_md5 == hashlib.md5(text.encode()).hexdigest()


def test_containment_by_keys_equals_containment_by_automaton(spark, duck, sf, monkeypatch):
    want = set(duck.execute("SELECT d.doc_id, b.item_id FROM documents d JOIN (SELECT item_id, text FROM benchmark UNION ALL SELECT 1000 + doc_id, substr(text, 7, 9) FROM documents UNION ALL SELECT 5000 + doc_id, substr(text, 20, 80) FROM documents) b ON contains(d.text, b.text) WHERE b.text <> ''").fetchall())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").unionByName(docs.select((F.col("doc_id") + 1000).alias("item_id"), F.expr("substr(text, 7, 9)").alias("text"))).unionByName(docs.select((F.col("doc_id") + 5000).alias("item_id"), F.expr("substr(text, 20, 80)").alias("text")))
    assert {tuple(r) for r in joins.containment(docs, items).collect()} == want
    monkeypatch.setattr(joins, "AUTOMATON", 1500)
    assert {tuple(r) for r in joins.containment(docs, items).collect()} == want


def test_numbering_over_many_buckets(spark):
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), (F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = [(r.k, r.n) for r in windows.numbered(rows, "k", name="n").orderBy("k").collect()]
        assert [n for _, n in got] == list(range(1, 3001)) and got == sorted(got)
        seen: dict = {}
        for r in windows.numbered(rows, "k", ["g"], "n").orderBy("k").collect():
            seen[r.g] = seen.get(r.g, 0) + 1
            assert r.n == seen[r.g]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert windows.numbered(rows.limit(0), "k").count() == 0
    one = rows.where("k < 3").withColumn("k", F.lit(None).cast("long"))
    assert sorted(r.number for r in windows.numbered(one, "k").collect()) == list(range(1, one.count() + 1))

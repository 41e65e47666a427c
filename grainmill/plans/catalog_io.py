"""Queries of sources, sinks, streams and of the joins and rules over files and open-access locations.

What is read back was written by this library's own sinks to the session's shared scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import generate, joins, oa, sets
from grainmill.plans.catalog_rows import lit, papers
from grainmill.plans.inputs import FILES, LOCATIONS, PAPERS
from grainmill.plans.registry import add, duck, table, view
from grainmill.session import scratch_dir
from grainmill.sources import readers, sinks
from grainmill.streaming import incremental


def folder(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def docs(spark, d):
    return table(spark, d, "documents")


# IO1, IO14, JF8: JSON lines
def _lines(spark, d):
    at = folder(spark, "lines")
    sinks.json_lines(docs(spark, d).select("doc_id", "text", "lang"), at, nulls=True)
    return readers.json_lines(spark, at, "doc_id long, text string, lang string").select("doc_id", F.md5("text").alias("text_md5"), "lang")


add("json_lines_back", _lines, "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")


def _spaced(spark, d):
    at = folder(spark, "spaced")
    sinks.json_text(table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.lit("é")).alias("x")), at)
    return spark.read.text(at).select(F.col("value").alias("line"))


add("json_text_back", _spaced, """SELECT '{"c_custkey": ' || c_custkey || ', "c_name": "' || c_name || '", "x": ' || CASE WHEN c_custkey % 2 = 0 THEN '"é"' ELSE 'null' END || '}' AS line FROM customer""")


def _log(spark, d) -> str:
    """One log file of users' events in order, every tenth line blank."""
    e = table(spark, d, "events").select("event_id", "user_id")
    line = F.when(F.col("event_id") % 10 == 9, "").otherwise(F.format_string('{"id": "u%d", "event": %d, "doi": "https://doi.org/10.5/U%d"}', "user_id", "event_id", F.col("user_id") % 40))
    at = folder(spark, "log")
    sinks.joined_file(e.orderBy("event_id").select(line.alias("value")), f"{at}/log.jsonl")
    return f"{at}/log.jsonl"


_LINES = "SELECT event_id + 1 AS line_no, event_id, user_id FROM events WHERE event_id % 10 <> 9"
add("json_lines_numbered", lambda s, d: readers.json_lines_numbered(s, _log(s, d)).select(F.col("line_no").cast("long").alias("line_no"), F.get_json_object("raw", "$.event").cast("long").alias("event_id")), f"SELECT line_no, event_id FROM ({_LINES})")
add(
    "json_lines_by_id",
    lambda s, d: readers.json_lines_by_id(s, _log(s, d), "id string, event long").select("id", "event", F.col("row_ord").cast("long").alias("row_ord")),
    f"SELECT 'u' || user_id AS id, max(event_id) AS event, min(line_no) AS row_ord FROM ({_LINES}) GROUP BY user_id",
)
add("manifest_by_doi", lambda s, d: readers.manifest(s, _log(s, d)).select("doi", F.col("line_no").cast("long").alias("line_no")), f"SELECT '10.5/u' || (user_id % 40) AS doi, max(line_no) AS line_no FROM ({_LINES}) GROUP BY 1")


# IO4, IO5: arrays and tagged exports
def _array(spark, d):
    rows = table(spark, d, "customer").select(F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("o"), F.col("c_custkey").alias("k"))
    # a file of one array is a file of one task: customers stand for an export of a few thousand records
    body = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "o"))), lambda x: x["o"]), ", ").alias("b")).select(F.concat(F.lit("﻿[3, "), F.col("b"), F.lit(', "s"]')).alias("value"))
    at = f"{folder(spark, 'array')}/openalex_2024.json"
    sinks.one_file(body, at)
    return at


add("json_array_scan", lambda s, d: readers.json_array(s, _array(s, d), "id long, name string").select("id", "name", F.col("row_ord").cast("long").alias("row_ord")), "SELECT c_custkey AS id, c_name AS name, row_number() OVER (ORDER BY c_custkey) AS row_ord FROM customer")


def _exports(spark, d):
    at = folder(spark, "exports")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    for k, name in enumerate(("OpenAlex_a", "semantic_b", "other_c")):
        sinks.one_file(c.where(F.col("id") % 3 == k).select(F.to_json(F.struct("id")).alias("value")).coalesce(1), f"{at}/{name}.jsonl")
    return spark.read.schema("id long").json(f"{at}/*.jsonl").withColumn("file", F.col("_metadata.file_name")).withColumn("source_export", readers.source_tag(F.col("file")))


add("exports_tagged", lambda s, d: _exports(s, d).select("id", "source_export"), "SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'openalex' WHEN 1 THEN 'semantic' ELSE 'export' END AS source_export FROM customer")


# IO6, IO19: CSV
def _csv(bom: bool):
    def run(spark, d):
        at = folder(spark, "csv")
        rows = docs(spark, d).where("text <> ''").select(F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit('"q", '), F.col("text")).alias("text"))
        sinks.csv(rows if not bom else rows.where("doc_id % 7 = 0"), at, bom)
        return readers.csv(spark, at).select("doc_id", F.md5("text").alias("text_md5"))

    return run


add("csv_back", _csv(False), "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5('\"q\", ' || text) AS text_md5 FROM documents WHERE text <> ''")


def _sheet(spark, d):
    """A review sheet with a byte-order mark: customers by segment."""
    at = folder(spark, "sheet")
    sinks.csv(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.col("c_mktsegment"), F.lit(', "x"\nline')).alias("note")), at, bom=True)
    return readers.csv(spark, at).select("key", "note")


add("csv_sheet_back", _sheet, "SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment || ', \"x\"' || chr(10) || 'line' AS note FROM customer")


# IO7, IO8
def _report(spark, d):
    at = folder(spark, "report")
    lab = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    row = F.struct(F.concat(F.lit("h-"), F.col("doc_id").cast("string")).alias("id"), (F.col("q") == 1).alias("checks_passed"), F.when(F.col("q") == 1, "pass").otherwise("weak").alias("failure_mode"), F.lit("legacy").alias("category"))
    report = lab.agg(F.sort_array(F.collect_list(row)).alias("per_row"), F.round(F.avg("q"), 4).alias("rate"))
    sinks.one_file(report.select(F.to_json(F.struct(F.struct("per_row").alias("holdout"), F.struct(F.col("rate").alias("expect_checks_pass_rate")).alias("aggregate"))).alias("value")), f"{at}/report.json")
    return f"{at}/report.json"


add("report_rows", lambda s, d: readers.report_rows(s, _report(s, d)), "SELECT 'h-' || doc_id AS id, max(quality) = 1 AS checks_passed, CASE WHEN max(quality) = 1 THEN 'pass' ELSE 'weak' END AS failure_mode, 'legacy' AS category FROM labels GROUP BY doc_id")
add("report_metrics", lambda s, d: readers.report_metrics(s, _report(s, d), ["expect_checks_pass_rate", "quote_validity_rate"]), "SELECT 'expect_checks_pass_rate' AS metric, round(avg(q), 4) AS value FROM (SELECT max(quality) AS q FROM labels GROUP BY doc_id) UNION ALL SELECT 'quote_validity_rate', NULL")


def _overrides(spark, d):
    at = folder(spark, "overrides")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    value = F.when(F.col("k") % 4 == 0, F.lit('{"url": " "}')).when(F.col("k") % 4 == 1, F.lit("3")).otherwise(F.format_string('{"url": " http://o/%d ", "reason": "r", "is_oa": %s}', "k", F.when(F.col("k") % 2 == 0, "true").otherwise("false")))
    entry = F.concat(F.lit('"'), F.when(F.col("k") % 10 == 7, "_").otherwise("DOI:"), F.lit("10.4/Q"), F.col("k").cast("string"), F.lit('": '), value)
    sinks.one_file(c.agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(entry)), ", "), F.lit("}")).alias("value")), f"{at}/o.json")
    return readers.overrides(spark, f"{at}/o.json").select("doi", "url", "reason", "is_oa")


add("overrides_scan", _overrides, "SELECT '10.4/q' || c_custkey AS doi, 'http://o/' || c_custkey AS url, 'r' AS reason, c_custkey % 2 = 0 AS is_oa FROM customer WHERE c_custkey % 4 > 1 AND c_custkey % 10 <> 7")


# IO10, IO11, PR20: files
def _pdfs(spark, d) -> str:
    at = folder(spark, "pdfs")
    for r in table(spark, d, "region").select("r_regionkey", "r_name").collect():  # five files of five regions
        text = "%PDF-1.4\f" if r[0] % 2 == 0 else ""
        sinks.one_file(spark.createDataFrame([(text + "\f".join(f"{r[1]} page {i}" for i in range(30)),)], "value string"), f"{at}/{r[0]:03d}_10.5_{r[1]}.pdf")
    return at


def _pages(spark, d):
    def extract(content, first):
        return content.decode().strip().removeprefix("%PDF-1.4\f").split("\f")[first:]

    p = readers.pdf_pages(spark, _pdfs(spark, d), extract, {"001_10.5_AMERICA.pdf": 5})
    return p.select("name", F.size("pages").cast("long").alias("n"), F.get("pages", 0).alias("first"))


_PDF = "lpad(CAST(r_regionkey AS VARCHAR), 3, '0') || '_10.5_' || r_name || '.pdf'"
add("pdf_pages_scan", _pages, f"SELECT {_PDF} AS name, CASE WHEN r_name = 'AMERICA' AND r_regionkey = 1 THEN 4 ELSE 24 END::BIGINT AS n, r_name || ' page ' || CASE WHEN r_name = 'AMERICA' AND r_regionkey = 1 THEN 4 ELSE 0 END AS first FROM region")
add("pdf_listing", lambda s, d: readers.listing(s, _pdfs(s, d)).select("name", F.col("file_line").cast("long").alias("line"), "file_doi"), f"SELECT {_PDF} AS name, CAST(r_regionkey AS BIGINT) AS line, '10.5/' || r_name AS file_doi FROM region")
_BODY = "CASE WHEN r_regionkey % 2 = 0 THEN '%PDF-1.4' || chr(12) ELSE '' END || array_to_string(list_transform(range(30), lambda i: r_name || ' page ' || i), chr(12)) || chr(10)"
add("pdf_fingerprints", lambda s, d: readers.fingerprints(s, _pdfs(s, d)).select("name", "size", "sha256", "is_pdf"), f"SELECT {_PDF} AS name, CAST(strlen({_BODY}) AS BIGINT) AS size, sha256({_BODY}) AS sha256, r_regionkey % 2 = 0 AS is_pdf FROM region")


# IO12, IO13
def _looked_up(spark, d):
    """Customers' segments through a client that knows every third name only."""

    def client(name):
        n = int(name.split("#")[1])
        return {"upper": name.upper(), "n": str(n)} if n % 3 == 0 else None

    return readers.lookups(table(spark, d, "customer"), "c_name", client, ["upper", "n"])


add("rest_lookups", _looked_up, "SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) END AS upper, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) END AS n FROM customer")


def _misses(spark, d):
    p = papers(spark, d).select("doi")
    cache = papers(spark, d).where("row_ord % 3 > 0").select(readers.cache_key(F.col("doi")).alias("key16"), F.when(F.col("row_ord") % 3 == 1, '{"a": 1}').otherwise("{broken").alias("body"))
    return readers.cache_misses(p, cache).select("doi", readers.cache_key(F.col("doi")).alias("key16"))


add("cache_misses", _misses, f"SELECT doi, left(sha256(doi), 16) AS key16 FROM ({duck(PAPERS)}) WHERE row_ord % 3 <> 1")


# IO16-IO18, IO20-IO22
def _upserted(spark, d):
    e = table(spark, d, "events").select(F.col("user_id"), "event_id", "event_type")
    return sinks.upsert(joins.last_per_key(e.where("event_id % 2 = 0"), "user_id", "event_id"), e.where("event_id % 2 = 1 and user_id % 3 = 0"), "user_id", "event_id")


add("upsert_by_key", _upserted, "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM (SELECT *, CASE WHEN user_id % 3 = 0 AND max((event_id % 2)::INT) OVER (PARTITION BY user_id) = 1 THEN event_id % 2 = 1 ELSE event_id % 2 = 0 END AS use FROM events) WHERE use GROUP BY user_id")


def _replaced(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("line"), "c_name")
    return sinks.replace_range(c, c.where("line between 40 and 60").withColumn("c_name", F.upper("c_name")), "line", 30, 60)


add("range_replaced", _replaced, "SELECT c_custkey AS line, CASE WHEN c_custkey BETWEEN 40 AND 60 THEN upper(c_name) ELSE c_name END AS c_name FROM customer WHERE c_custkey NOT BETWEEN 30 AND 39")
add(
    "line_range",
    lambda s, d: table(s, d, "customer").where(F.col("c_custkey").between(10, 40)).select(F.col("c_custkey").alias("line"), "c_name"),
    "SELECT c_custkey AS line, c_name FROM customer WHERE c_custkey BETWEEN 10 AND 40",
)


def _updated(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("seg"))
    return sinks.update_rows(c, c.where("c_custkey % 4 = 0").select("c_custkey", F.when(F.col("c_custkey") % 8 == 0, "new").alias("seg")), "c_custkey")


add("rows_updated", _updated, "SELECT c_custkey, c_name, CASE WHEN c_custkey % 8 = 0 THEN 'new' WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer")


def _markdown(spark, d):
    """A rendered table of nations, a row a line, shares as percentages."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name", sinks.percent(F.when(F.col("n_nationkey") % 5 > 0, F.col("n_nationkey") / 16)).alias("share")).orderBy("n_nationkey")
    return spark.createDataFrame(list(enumerate(sinks.markdown(n).splitlines())), "i long, line string")


add(
    "markdown_lines",
    _markdown,
    "SELECT 0::BIGINT AS i, '| n_nationkey | n_name | share |' AS line UNION ALL SELECT 1, '|---|---|---|' UNION ALL SELECT n_nationkey + 2, '| ' || n_nationkey || ' | ' || n_name || ' | ' || CASE WHEN n_nationkey % 5 > 0 THEN printf('%.2f%%', n_nationkey / 16 * 100) ELSE 'n/a' END || ' |' FROM nation",
)


def _fanned(spark, d):
    """What the four formats of a fan-out hold."""
    at = folder(spark, "fan")
    sinks.fan_out(papers(spark, d).select("doi", "corpus_id"), F.col("doi"), at)
    j = spark.read.schema("doi string, corpus_id string").json(f"{at}/jsonl").select(F.lit("jsonl").alias("fmt"), "doi", F.col("corpus_id").alias("more"))
    t = spark.read.text(f"{at}/txt").select(F.lit("txt").alias("fmt"), F.col("value").alias("doi"), F.lit(None).cast("string").alias("more"))
    c = readers.csv(spark, f"{at}/csv").select(F.lit("csv").alias("fmt"), "doi", F.col("corpus_id").alias("more"))
    s = spark.read.schema("doi string, status string").json(f"{at}/stubs").select(F.lit("stubs").alias("fmt"), "doi", F.col("status").alias("more"))
    return j.unionByName(t).unionByName(c).unionByName(s)


add("fan_out_back", _fanned, f"SELECT unnest(['jsonl', 'txt', 'csv', 'stubs']) AS fmt, doi, unnest([corpus_id, NULL, corpus_id, 'pending']) AS more FROM ({duck(PAPERS)})")


def _chat(spark, d):
    at = folder(spark, "chat")
    m = generate.chat_messages(F.lit("S & s"), F.coalesce("abstract", F.lit("")), F.lit("<x>"), F.lit("a"), F.col("article_url"))
    m = generate.suffix_last_user(m, " /short")
    sinks.chat(papers(spark, d).select(F.col("corpus_id").alias("id"), m.alias("messages"), F.lit(5).alias("tokens")), at, 10)
    back = readers.json_lines(spark, at, "id string, messages array<struct<role:string,content:string>>")
    return back.select("id", F.get("messages", 0)["content"].alias("system"), F.get("messages", 1)["content"].alias("user"))


add(
    "chat_back",
    _chat,
    f"SELECT corpus_id AS id, 'S & s' AS system, '<manuscript_passage>' || chr(10) || coalesce(abstract, '') || chr(10) || '</manuscript_passage>' || chr(10) || chr(10) || '<source_excerpt label=\"a\"' || CASE WHEN article_url IS NOT NULL THEN ' url=\"' || article_url || '\"' ELSE '' END || '>' || chr(10) || '&lt;x&gt;' || chr(10) || '</source_excerpt> /short' AS user FROM ({duck(PAPERS)})",
)


# IO15, SM1-SM6: streams over files written here
def _events(spark, d) -> tuple[str, str]:
    """Four files of events as a stream's source; the status is terminal at every seventh event."""
    at = folder(spark, "events")
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("doi"), F.when(F.col("event_id") % 7 == 0, incremental.TERMINAL).otherwise(F.col("event_type")).alias("status"), F.col("event_id").alias("seq"))
    for k in range(4):
        e.where(F.floor(F.col("seq") / 10) % 4 == k).coalesce(1).write.mode("append").json(f"{at}/in")
    return at, "doi string, status string, seq long"


_STREAM = f"SELECT 'u' || user_id AS doi, CASE WHEN event_id % 7 = 0 THEN {lit(incremental.TERMINAL)} ELSE event_type END AS status, event_id AS seq FROM events"


def _state(spark, d):
    """The newest status of each user, terminal ones kept, after a stream of four batches."""
    at, schema = _events(spark, d)
    incremental.upsert_stream(incremental.source(spark, f"{at}/in", schema), f"{at}/t", f"{at}/cp", buckets=8).awaitTermination()
    return incremental.read_state(spark, f"{at}/t").select("doi", "status", "seq")


add("stream_upserts", _state, f"SELECT doi, arg_max(status, (status = {lit(incremental.TERMINAL)})::BIGINT * 1000000000 + seq) AS status, arg_max(seq, (status = {lit(incremental.TERMINAL)})::BIGINT * 1000000000 + seq) AS seq FROM ({_STREAM}) GROUP BY doi")


def _enriched(spark, d):
    """Events of unfinished users, enriched batch by batch, with the checkpoint taken up again once."""
    at, schema = _events(spark, d)
    done = table(spark, d, "region").select(F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("doi"))
    for _ in range(2):
        s = incremental.unseen_stream(incremental.source(spark, f"{at}/in", schema), done)
        incremental.enrich_stream(s, lambda b: b.withColumn("up", F.upper("status")), f"{at}/out", f"{at}/cp").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("doi", "seq", "up")


add("stream_enriched", _enriched, f"SELECT doi, seq, upper(status) AS up FROM ({_STREAM}) WHERE doi NOT IN (SELECT 'u' || r_regionkey FROM region)")


def _appended(spark, d):
    at = folder(spark, "append")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    sinks.append(c.where("c_custkey < 50"), at)
    sinks.append(c.where("c_custkey >= 50"), at)
    return readers.json_lines(spark, at, "c_custkey long, c_name string")


add("append_log_back", _appended, "SELECT c_custkey, c_name FROM customer")


def _called(spark, d):
    """A model that fails at first for every third prompt, always for every seventh, and raises for every fifth."""

    def call(prompt, n):
        k = int(prompt)
        if k % 5 == 0 and n == 0:
            raise ValueError("down")
        return k % 7 > 0 and (k % 3 > 0 or n > 0), f"{prompt}/{n}"

    p = table(spark, d, "customer").select(F.col("c_name").alias("id"), F.col("c_custkey").cast("string").alias("prompt"))
    return incremental.with_retries(p, call, 3, 4, threads=4).select("id", "ok", "output", "attempts")


add("calls_with_retries", _called, "WITH c AS (SELECT c_name AS id, c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 3 WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 2 ELSE 1 END AS attempts FROM customer) SELECT id, k % 7 > 0 AS ok, k || '/' || (attempts - 1) AS output, CAST(attempts AS BIGINT) AS attempts FROM c")


# JN9-JN10, JN16, SO12
def _resolved(spark, d):
    """Each paper's file: its stated path, its own name, or another of the same DOI."""
    files = view(spark, d, FILES)
    rows = papers(spark, d).select(F.col("row_ord").alias("line"), "doi", F.when(F.col("row_ord") % 10 == 3, "000_10.5_0.pdf").when(F.col("row_ord") % 10 == 4, "none.pdf").alias("pdf_path"))
    return joins.resolve_pdf(rows, files).select("line", "resolved")


add(
    "pdfs_resolved",
    _resolved,
    f"""WITH f AS (SELECT DISTINCT name FROM ({duck(FILES)})), s AS (SELECT regexp_extract(name, '^[^_]*_(.+)[.]pdf$', 1) AS s, min(name) AS n FROM f GROUP BY 1), p AS (SELECT row_ord AS line, replace(doi, '/', '_') AS s, CASE row_ord % 10 WHEN 3 THEN '000_10.5_0.pdf' WHEN 4 THEN 'none.pdf' END AS path FROM ({duck(PAPERS)}))
 SELECT line, coalesce((SELECT name FROM f WHERE name = path), (SELECT name FROM f WHERE name = lpad(CAST(line AS VARCHAR), CAST(greatest(3, length(CAST(line AS VARCHAR))) AS INT), '0') || '_' || p.s || '.pdf'), s.n) AS resolved FROM p LEFT JOIN s USING (s)""",
)


def _reconciled(spark, d):
    f = view(spark, d, FILES).groupBy("name").agg(F.max("size").alias("size"), F.max("sha256").alias("sha256"))
    remote = f.where("size % 5 > 0").select(F.when(F.col("size") % 11 == 0, F.concat(F.lit("x"), F.col("name"))).otherwise(F.col("name")).alias("name"), F.when(F.col("size") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(F.col("size") % 3 == 0, F.lit("?")).otherwise(F.col("sha256")).alias("sha256"))
    return joins.reconcile(f, remote).select("name", F.col("local_size").cast("string").alias("local_size"), F.col("remote_size").cast("string").alias("remote_size"), "state")


add(
    "files_reconciled",
    _reconciled,
    f"""WITH f AS (SELECT name, max(size) AS size, max(sha256) AS sha FROM ({duck(FILES)}) GROUP BY 1), r AS (SELECT CASE WHEN size % 11 = 0 THEN 'x' || name ELSE name END AS name, CASE WHEN size % 7 = 0 THEN size + 1 ELSE size END AS size, CASE WHEN size % 3 = 0 THEN '?' ELSE sha END AS sha FROM f WHERE size % 5 > 0)
 SELECT name, CAST(f.size AS VARCHAR) AS local_size, CAST(r.size AS VARCHAR) AS remote_size, CASE WHEN r.name IS NULL THEN 'missing_remote' WHEN f.name IS NULL THEN 'extra_remote' WHEN f.size <> r.size THEN 'size_differs' WHEN f.sha <> r.sha THEN 'checksum_differs' ELSE 'same' END AS state FROM f FULL JOIN r USING (name)""".replace("CASE WHEN r.name IS NULL", "CASE WHEN r.size IS NULL").replace("WHEN f.name IS NULL", "WHEN f.size IS NULL"),
)
add(
    "single_file",
    lambda s, d: sets.single_file(view(s, d, FILES).select("name").distinct(), "007_10.5_7b.pdf").unionByName(sets.single_file(s.createDataFrame([("a.gguf",), ("b.txt",)], "name string"), "none")),
    f"SELECT DISTINCT name FROM ({duck(FILES)}) WHERE name = '007_10.5_7b.pdf' UNION ALL SELECT 'a.gguf'",
)


# JN11: names of parts against titles spelt from them, and the assignment (no SQL has the similarity; the tests compare with all pairs)
def _titles(spark, d):
    p = table(spark, d, "part").select("p_name").distinct()
    rows = p.select(F.row_number().over(Window.orderBy("p_name")).alias("line"), F.concat_ws(" ", F.lit("The"), F.col("p_name"), F.lit("study")).alias("title"))
    files = p.select(F.concat(F.translate(F.initcap("p_name"), " ", ""), F.lit("Study.pdf")).alias("name"))
    return joins.fuzzy_titles(rows, files, 0.8)


def title_matches(spark, d):
    """Titles against file names by similarity: every pair at 0.8 or more."""
    return _titles(spark, d)


def title_assignment(spark, d):
    """The one-to-one assignment of titles to files, best first."""
    return joins.greedy_assignment(_titles(spark, d))


add("title_matches", title_matches)
add("title_assignment", title_assignment)

# FL16-FL18, SF24, SF25, JN14, SO3, SO11, ST6, ST8, WN2, PR16, PR18: open access
_TRUST = " OR ".join(f"contains(lower({{0}}), '{m}')" for m in oa.TRUSTED)
_UN = "replace(lower({0}), '%2f', '/')"
_NORM = "regexp_replace(regexp_replace(lower(trim({0})), '^https://doi[.]org/', ''), '^doi:', '')"
#: the spellings that occur in the relation: plain, slash escaped, parentheses escaped, letters and digits only
_EMBEDS = f"(contains({_UN}, d) OR contains({_UN}, replace(d, '/', '%2f')) OR contains({_UN}, regexp_replace(d, '[^a-z0-9_]+', '', 'g')) OR contains({_UN}, replace(replace(d, '(', '%28'), ')', '%29')))"


def _trust(u: str) -> str:
    return "(" + _TRUST.format(u) + ")"


_PICKED = "coalesce(nullif(trim(url_for_pdf), ''), nullif(trim(url), ''), nullif(trim(landing), ''))"
_SCORE = f"""CASE WHEN coalesce(u, '') <> '' AND NOT (h = 'repository' AND NOT {_EMBEDS.format('u')} AND NOT {_trust('u')}) THEN CASE WHEN {_EMBEDS.format('u')} THEN 100 ELSE 0 END + CASE WHEN regexp_matches(lower(u), '(?i)pmc/articles/(?:pmc)?([0-9]+)|pmc([0-9]+)') THEN 95 WHEN h = 'repository' THEN 75 WHEN h = 'publisher' THEN 35 ELSE 0 END
 + CASE WHEN coalesce(url_for_pdf, '') <> '' THEN 25 ELSE 0 END + CASE WHEN {_trust('u')} THEN 15 ELSE 0 END + CASE WHEN lower(u) LIKE '%.pdf' OR contains(lower(u), '/pdf') THEN 10 ELSE 0 END END"""
_LOC = f"""loc AS (SELECT *, {_NORM.format('doi')} AS d, {_PICKED} AS u, lower(coalesce(host_type, '')) AS h FROM ({duck(LOCATIONS)})), sc AS (SELECT *, {_SCORE} AS score FROM loc), rj AS (SELECT *, CAST(sum((score IS NULL)::INT) OVER (PARTITION BY d ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rejected FROM sc),
 fs AS (SELECT *, row_number() OVER (PARTITION BY d, u ORDER BY pos) AS k FROM rj WHERE score IS NOT NULL), rk AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY score DESC, pos) AS rank FROM fs WHERE k = 1)"""


def locations(spark, d):
    return view(spark, d, LOCATIONS)


add(
    "location_scores",
    lambda s, d: locations(s, d).select("pos", F.coalesce(oa.location_score(F.expr(_PICKED), F.col("host_type"), F.col("url_for_pdf"), T.normalize_doi("doi")), F.lit(-1)).cast("long").alias("score"), oa.embeds_doi(F.expr(_PICKED), T.normalize_doi("doi")).alias("embeds"), oa.has_marker(F.expr(_PICKED)).alias("trusted")),
    f"WITH {_LOC} SELECT pos, coalesce(score, -1)::BIGINT AS score, coalesce({_EMBEDS.format('u')}, false) AS embeds, coalesce({_trust('u')}, false) AS trusted FROM sc",
)
add(
    "locations_ranked",
    lambda s, d: oa.rank_locations(locations(s, d)).select("doi", "pos", "url", F.col("score").cast("long").alias("score"), F.col("rejected").cast("long").alias("rejected"), F.col("rank").cast("long").alias("rank")),
    f"WITH {_LOC} SELECT d AS doi, pos, u AS url, score::BIGINT AS score, rejected, rank FROM rk",
)


def _over(spark, d):
    o = table(spark, d, "supplier").select(F.format_string("https://doi.org/10.7/AB(%d)", F.col("s_suppkey") * 4).alias("doi"), F.concat(F.lit("https://own.example.org/"), F.col("s_suppkey").cast("string")).alias("url"), F.lit(None).cast("string").alias("host_type"))
    return oa.rank_locations(locations(spark, d), o)


_OV = f"{_LOC}, ov AS (SELECT '10.7/ab(' || s_suppkey * 4 || ')' AS d, 'https://own.example.org/' || s_suppkey AS url FROM supplier WHERE s_suppkey * 4 < 30), al AS (SELECT d, url, 10000 AS score, 1 AS rank, 'operator_override' AS selection, 'override' AS host FROM ov UNION ALL SELECT d, u, score, rank, 'scored_oa_location', host_type FROM rk WHERE d NOT IN (SELECT d FROM ov))"
add(
    "locations_overridden",
    lambda s, d: _over(s, d).select("doi", "url", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"), "selection"),
    f"WITH {_OV} SELECT d AS doi, url, score::BIGINT AS score, rank::BIGINT AS rank, selection FROM al",
)


def _verified(spark, d):
    ranked = _over(spark, d)
    return oa.select_verified(ranked, ranked.select("url", F.contains("url", F.lit("pdf")).alias("ok")).distinct())


_SEL = f"{_OV}, sel AS (SELECT *, contains(url, 'pdf') AS ok, row_number() OVER (PARTITION BY d ORDER BY contains(url, 'pdf') DESC, rank) AS r FROM al)"
add("locations_verified", lambda s, d: _verified(s, d).select("doi", "url", F.col("score").cast("long").alias("score"), "ok"), f"WITH {_SEL} SELECT d AS doi, url, score::BIGINT AS score, ok FROM sel WHERE r = 1")
add(
    "extract_rows",
    lambda s, d: oa.extract_rows(_verified(s, d)).select("id", "doi", F.col("meta.label").alias("label"), F.col("meta.access_tier").alias("tier"), F.col("output.fetch_status").alias("status")),
    f"WITH {_SEL}, t AS (SELECT *, CASE WHEN selection = 'operator_override' THEN 'operator' WHEN lower(host) = 'publisher' THEN 'publisher_oa' WHEN lower(host) = 'repository' THEN 'repository_oa' ELSE 'unknown' END AS tier FROM sel WHERE r = 1) SELECT 'oa-' || left(sha256(url), 16) AS id, d AS doi, CASE tier WHEN 'operator' THEN 'operator_choice' WHEN 'publisher_oa' THEN 'publisher_pdf' WHEN 'repository_oa' THEN 'repository_copy' ELSE 'unverified' END AS label, tier, CASE WHEN ok THEN 'pdf_verified' ELSE 'pending' END AS status FROM t",
)
_RISKS = ", ".join(f"CASE WHEN contains(lower(v), '{m}') THEN 'high_risk_host:{m.rstrip('/')}' END" for m in oa.RISKY)
_FLAGS = f"""fl AS (SELECT *, trim(coalesce(url, '')) AS v FROM loc), fk AS (SELECT *, list_filter([{_RISKS}], lambda x: x IS NOT NULL) AS risks, NOT {_EMBEDS.format('v')} AND NOT {_trust('v')} AS loose FROM fl), fr AS (SELECT *, CASE WHEN selection = 'operator_override' THEN [] WHEN v = '' THEN ['missing_doi_or_url'] ELSE list_concat(risks, list_filter([CASE WHEN loose AND h = 'repository' THEN 'untrusted_repo_no_doi' END,
 CASE WHEN loose AND h <> 'publisher' AND len(risks) = 0 THEN 'no_doi_untrusted' END, CASE WHEN regexp_matches(lower(v), '^https?://doi[.]org/') THEN 'doi_resolver_only' END], lambda x: x IS NOT NULL)) END AS reasons FROM fk)"""
add(
    "url_audit",
    lambda s, d: oa.audit(locations(s, d).withColumnRenamed("selection", "url_selection")).select("line", "doi", "title", "url", F.array_join("reasons", ",").alias("reasons"), "identity_url"),
    f"WITH {_LOC}, {_FLAGS} SELECT line, d AS doi, title, url, array_to_string(reasons, ',') AS reasons, 'https://doi.org/' || d AS identity_url FROM fr WHERE len(reasons) > 0",
)
_URLS = "SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || CAST(c_custkey AS STRING) || '/' WHEN 1 THEN 'https://figshare.com/articles/' || CAST(c_custkey AS STRING) || '//' WHEN 2 THEN 'https://www.nature.com/articles/s' || CAST(c_custkey AS STRING) WHEN 3 THEN 'https://link.springer.com/article/10.1/' || CAST(c_custkey AS STRING) || '?q=1#x' WHEN 4 THEN '' ELSE 'https://other.org/' || CAST(c_custkey AS STRING) END AS u FROM {customer}"
add(
    "candidate_urls",
    lambda s, d: view(s, d, _URLS).select("k", F.array_join(oa.candidate_urls(F.col("u")), " ").alias("urls")),
    f"""SELECT k, CASE k % 6 WHEN 0 THEN u || ' https://europepmc.org/backend/ptpmcrender.fcgi?accid=PMC' || k || '&blobtype=pdf https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || k || '/pdf/ https://www.ncbi.nlm.nih.gov/pmc/articles/' || k || '/pdf/' WHEN 1 THEN u || ' https://figshare.com/articles/' || k || '/download' WHEN 2 THEN u || ' ' || u || '.pdf'
 WHEN 3 THEN u || ' https://link.springer.com/content/pdf/10.1/' || k || '.pdf' ELSE u END AS urls FROM ({duck(_URLS)})""",
)


def _walls(spark, d):
    p = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, 403).otherwise(200).alias("status"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("please SIGN IN "), F.col("html"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("%PDF-1.7 "), F.col("html"))).otherwise(F.col("html")).alias("body"))
    return p.select("page_id", oa.auth_wall(F.col("status"), F.col("body")).alias("wall"), oa.is_pdf(F.col("body").cast("binary")).alias("pdf"))


_WALL = " OR ".join(f"contains(b, '{w}')" for w in oa.WALLS)
add("auth_walls", _walls, f"SELECT page_id, page_id % 5 = 0 OR page_id % 3 = 0 OR {_WALL} AS wall, page_id % 3 = 1 AS pdf FROM (SELECT page_id, lower(left(CASE WHEN page_id % 3 = 1 THEN '%PDF-1.7 ' || html ELSE html END, 2000)) AS b FROM pages)")


def _probed(spark, d):
    """Landing pages of a made-up web: every fourth is a PDF, every third links to one, the rest do not."""

    def client(url):
        if url.endswith(".pdf"):
            return 200, b"%PDF-1.4"
        k = int(url.rstrip("/").rsplit("/", 1)[1])
        return (200, b"%PDF-1.5") if k % 4 == 0 else (200, f'<a href="{k}.pdf">x</a>'.encode()) if k % 3 == 0 else (403, b"log in")

    p = table(spark, d, "customer").select(F.col("c_name").alias("id"), F.concat(F.lit("http://w/"), F.col("c_custkey").cast("string")).alias("url"))
    return oa.probe(p, client).select("id", "url", "ok", "followed")


add("pdf_probe", _probed, "SELECT c_name AS id, 'http://w/' || c_custkey || CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 = 0 THEN '.pdf' ELSE '' END AS url, c_custkey % 4 = 0 OR c_custkey % 3 = 0 AS ok, CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS followed FROM customer")

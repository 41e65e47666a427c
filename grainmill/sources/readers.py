"""Sources: JSON lines, JSON arrays, CSV, reports, keyed maps, manifests, PDFs, API tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.functions.text import normalize_doi
from grainmill.operators.joins import last_per_key


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    matches = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return matches is not None and len(matches) > 0


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of a JSON-lines file; blank lines are skipped, bad JSON raises, a missing file is empty."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.json(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def json_lines_numbered(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, raw)``: lines with their 1-based number; blank lines count and are left out.

    A file is read in splits, as many tasks as it has. A line's number is the lines of the splits
    before its own, counted first, and its place in its split: ids rise by one there.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("raw"), at.alias("at"), F.monotonically_increasing_id().alias("id"))
    offsets, file, before = [], None, 0
    for r in lines.groupBy("at").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("at").collect():  # a row a split
        file, before = r["at"]["file"], before if file == r["at"]["file"] else 0
        offsets += [F.lit(f"{file}|{r['at']['start']}"), F.lit(before - r["first"])]
        before += r["n"]
    offset = F.try_element_at(F.create_map(*offsets), F.concat_ws("|", "at.file", "at.start")) if offsets else F.lit(0)
    return lines.select((offset + F.col("id") + 1).alias("line_no"), "raw").where(F.trim("raw") != "").select("line_no", F.regexp_replace("raw", "\r$", "").alias("raw"))


def json_lines_by_id(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Keyed records: a repeated id's last line wins and keeps the first's place; no id raises."""
    rows = json_lines_numbered(spark, path).withColumn("r", F.from_json("raw", schema)).select("line_no", "raw", "r.*")
    checked = rows.withColumn("id", F.when(F.coalesce("id", F.lit("")) == "", F.raise_error(F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": missing id")))).otherwise(F.col("id")))
    first = checked.groupBy("id").agg(F.min("line_no").alias("row_ord"))
    return last_per_key(checked, "id", "line_no").join(first, "id")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of a JSON array file with or without a byte-order mark; other elements are dropped."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("t"))
    v = F.try_parse_json("t")
    items = text.select(F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.raise_error(F.lit("expected a JSON array"))).alias("a"))
    rows = items.select(F.posexplode("a").alias("row_ord", "x")).where(F.startswith(F.schema_of_variant("x"), F.lit("OBJECT")))
    return rows.select("row_ord", F.from_json(F.to_json("x"), schema).alias("r")).select("row_ord", "r.*")


def source_tag(name: Column) -> Column:
    low = F.lower(name)
    return F.when(F.contains(low, F.lit("openalex")), "openalex").when(F.contains(low, F.lit("semantic")), "semantic").otherwise("export")


def exports(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Raw exports of a glob with ``source_export`` from the file name."""
    df = spark.read.schema(schema).option("multiLine", True).json(glob)
    return df.withColumn("file", F.col("_metadata.file_name")).withColumn("source_export", source_tag(F.col("file")))


def csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, all strings, quotes doubled, line breaks allowed in cells."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def report_rows(spark: SparkSession, path: str) -> DataFrame:
    """``per_row`` of an evaluation report, at its top or under ``holdout``."""
    text = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    rows = F.coalesce(F.try_variant_get(v, "$.per_row", "array<variant>"), F.try_variant_get(v, "$.holdout.per_row", "array<variant>"))
    return text.select(F.explode(rows).alias("x")).select(F.try_variant_get("x", "$.id", "string").alias("id"), F.try_variant_get("x", "$.checks_passed", "boolean").alias("checks_passed"), F.try_variant_get("x", "$.failure_mode", "string").alias("failure_mode"), F.try_variant_get("x", "$.category", "string").alias("category"))


def report_metrics(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """``(metric, value)`` of a report's header, missing ones null."""
    v = F.try_parse_json("value")
    one = spark.read.text(path, wholetext=True).select(*[F.coalesce(F.try_variant_get(v, f"$.{n}", "double"), F.try_variant_get(v, f"$.aggregate.{n}", "double")).alias(n) for n in names])
    return one.unpivot([], names, "metric", "value")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """URL overrides by normalised DOI; keys with a leading ``_``, non-objects and empty URLs go."""
    v = F.try_parse_json("value")
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.try_variant_get(v, "$", "map<string,variant>")).alias("key", "x"))
    rows = rows.where(~F.startswith("key", F.lit("_")) & F.startswith(F.schema_of_variant("x"), F.lit("OBJECT")))
    out = rows.select(normalize_doi("key").alias("doi"), *[F.trim(F.try_variant_get("x", f"$.{k}", "string")).alias(k) for k in ("url", "host_type", "reason")], F.try_variant_get("x", "$.is_oa", "boolean").alias("is_oa"))
    return out.where("url is not null and url <> '' and doi is not null")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest's rows, the last line of each normalised DOI."""
    rows = json_lines_numbered(spark, path).select("line_no", "raw", normalize_doi(F.get_json_object("raw", "$.doi")).alias("doi"))
    return last_per_key(rows, "doi", "line_no")


def listing(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """Files of a folder as a relation; contents are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    line, doi = F.regexp_extract(name, r"^(\d+)_", 1).try_cast("int"), F.nullif(F.regexp_extract(name, r"^\d+_(10\..+)\.pdf$", 1), F.lit(""))
    return df.select(F.col("path"), name.alias("name"), F.col("length").alias("size"), line.alias("file_line"), F.regexp_replace(doi, "_", "/").alias("file_doi"))


def fingerprints(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """``(path, name, size, sha256, is_pdf)`` of files."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.coalesce(F.substring("content", 1, 5) == F.lit(b"%PDF-"), F.lit(False)).alias("is_pdf"))


def pdf_pages(spark: SparkSession, folder: str, extract: Callable[[bytes, int], list[str]], hints: dict[str, int] | None = None, most: int = 24, window: int = 4) -> DataFrame:
    """``(name, pages)``: the first pages of each file, or a few from its hint on.

    ``extract(content, first_page)`` is the caller's PDF reader; none is bundled.
    """
    held = hints or {}

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            pages = []
            for name, content in zip(b["name"], b["content"]):
                first = max(0, held.get(name, 1) - 1)
                pages.append(list(extract(content, first))[: window if name in held else most])
            yield pd.DataFrame({"name": b["name"], "pages": pages})

    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInPandas(run, "name string, pages array<string>")


def lookups(rows: DataFrame, key: str, client: Callable[[str], dict | None], fields: list[str]) -> DataFrame:
    """API look-ups through a caller's client, one call per row where the partition is.

    The client handles pacing and retries and gives None for "not found" (fields are null).
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            got = [client(k) or {} for k in b[key]]
            yield pd.DataFrame({key: b[key], **{f: [g.get(f) for g in got] for f in fields}})

    return rows.select(key).mapInPandas(run, f"{key} string, " + ", ".join(f"{f} string" for f in fields))


def cache_key(doi: Column) -> Column:
    return F.left(F.sha2(doi, 256), F.lit(16))


def cache_misses(rows: DataFrame, cache: DataFrame, key: str = "doi") -> DataFrame:
    """Rows that the response cache (``key16, body``) lacks; an unreadable body is a miss."""
    good = cache.where(F.try_parse_json("body").isNotNull()).select(F.col("key16").alias("__k"))
    return rows.withColumn("__key", cache_key(F.col(key))).join(good, F.col("__key") == F.col("__k"), "left_anti").drop("__key")

"""Sinks: JSON lines, chat files, CSV, keyed and range-replaced tables, rendered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.jsonx import spaced_json
from grainmill.operators.joins import last_per_key


def json_lines(df: DataFrame, path: str, nulls: bool = False) -> None:
    """One object a line, UTF-8, replacing what was there; ``nulls`` writes null keys too."""
    df.write.mode("overwrite").option("ignoreNullFields", not nulls).json(path)


def json_text(df: DataFrame, path: str) -> None:
    """JSON lines with the separators of a plain serialiser (``", "`` and ``": "``)."""
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    df.select(spaced_json(row).alias("value")).write.mode("overwrite").text(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of both, those of ``new`` instead of ``old`` ones with their key, sorted by key.

    Repeated keys of ``new`` are resolved by ``order``, the last wins.
    """
    latest = new if order is None else last_per_key(new, key, order)
    return old.join(latest.select(key), key, "left_anti").unionByName(latest, allowMissingColumns=True).orderBy(key)


def replace_range(old: DataFrame, new: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Old rows outside a range of line numbers, and the new rows."""
    return old.where(~F.col(column).between(first, last)).unionByName(new, allowMissingColumns=True)


def update_rows(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows with the changed columns of their key, nulls too; to be written to a new path and swapped."""
    cols = [c for c in changes.columns if c != key]
    renamed = changes.select(F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in cols])
    out = old.join(renamed, key, "left")
    return out.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in old.columns])


def joined_file(lines: DataFrame, path: str) -> None:
    """A sorted relation of text lines as one file: the sorted parts' bytes, one after the other."""
    spark = lines.sparkSession
    lines.write.mode("overwrite").text(f"{path}.tmp")
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.fs.Path(path).getFileSystem(conf)
    parts = sorted((f.getPath() for f in fs.listStatus(hadoop.fs.Path(f"{path}.tmp")) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    out = fs.create(hadoop.fs.Path(path), True)
    try:
        for part in parts:
            source = fs.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()
    fs.delete(hadoop.fs.Path(f"{path}.tmp"), True)


def one_file(lines: DataFrame, path: str) -> None:
    """A relation of text lines (one partition, in order) as one file of that very name.

    For what is a single document by nature: a JSON array, a report, a sheet for people.
    """
    spark = lines.sparkSession
    lines.coalesce(1).write.mode("overwrite").text(f"{path}.tmp")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(fs_path(f"{path}.tmp")) if f.getPath().getName().startswith("part-"))
    fs.delete(fs_path(path), False)
    fs.rename(part, fs_path(path))
    fs.delete(fs_path(f"{path}.tmp"), True)


def csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with header; with a byte-order mark it is one file, for people's spreadsheets."""
    if not bom:
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    body = df.select(F.concat_ws(",", *[quoted(F.col(f"`{c}`")) for c in df.columns]).alias("value"))
    head = df.sparkSession.createDataFrame([("﻿" + ",".join(f'"{c}"' for c in df.columns),)], "value string")
    head.unionByName(body).coalesce(1).write.mode("overwrite").text(path)


def chat(rows: DataFrame, path: str, limit: int | None = None, tokens: str = "tokens") -> None:
    """``{id, messages}`` lines; more than ``limit`` tokens in any row is an error before writing."""
    if limit is not None and not rows.where(F.col(tokens) > limit).isEmpty():
        raise ValueError(f"rows exceed {limit} tokens")
    json_lines(rows.select("id", "messages"), path)


def fan_out(df: DataFrame, doi: Column, folder: str) -> None:
    """One relation as JSON lines, a plain list, CSV and stub lines."""
    df = df.persist()
    try:
        json_lines(df, f"{folder}/jsonl")
        df.select(doi.alias("value")).write.mode("overwrite").text(f"{folder}/txt")
        csv(df, f"{folder}/csv")
        json_lines(df.select(doi.alias("doi"), F.lit("pending").alias("status")), f"{folder}/stubs")
    finally:
        df.unpersist()


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small table (a matrix of versions, a list of metrics) as Markdown; larger ones are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a rendered report")
    cell = lambda v: "—" if v is None else str(v)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]) + "\n"


def percent(c: Column) -> Column:
    return F.when(c.isNull(), "n/a").otherwise(F.format_string("%.2f%%", c * 100))

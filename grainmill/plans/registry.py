"""Where queries register: a callable ``(spark, folder) -> DataFrame`` and, if SQL can say it, the DuckDB text that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("customer", "documents", "benchmark", "conversations", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"two queries named {name}")
    QUERIES[name] = run
    if sql is not None:
        ORACLE_SQL[name] = sql


def query(sql: str | None = None):
    def wrap(f):
        add(f.__name__, f, sql)
        return f

    return wrap


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """A table's rows dealt over the cluster: four tasks a core, or more of 25,000 rows.

    A task reads whole row groups, of up to a million rows here: what is derived from a row would be
    computed by one or two tasks, however many cores there are. Spark moves filters below a
    repartition, with all that they need; the first column, which views use, depends on the
    partition in name only and holds them back.
    """
    n = rows.count()
    parts = min(-(-n // 1000), max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // 25_000)))
    key = rows.columns[0]
    return rows.repartition(parts).withColumn(key, F.when(F.spark_partition_id() >= 0, F.col(key))) if parts > 1 else rows


def view(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """An input relation written in SQL that both engines read; ``{name}`` stands for a table."""
    return spark.sql(sql, **{t: spread(table(spark, d, t)) for t in TABLES if "{" + t + "}" in sql})


def duck(sql: str) -> str:
    """The same text for DuckDB."""
    return sql.format(**{t: t for t in TABLES})

"""Shared plumbing of the training-data operators: tables, scratch space, code shipping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill import session
from grainmill.session import materialize, scratch_dir

__all__ = ["batches", "gathered", "materialize", "read_table", "scratch_dir", "ship", "text_or_empty"]

BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's reader touches the path, so any Hadoop URI works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Texts have no length bound, so Arrow batches of them should have few rows: where the session
    still has Spark's default of 10,000 rows a batch, it gets ``BATCH_ROWS``.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    session.ship(spark)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def batches(it: Iterator[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose buffers stay near ``limit`` bytes (one row at least)."""
    for b in it:
        n = b.num_rows
        if not n:
            continue
        step = max(1, int(n * limit / max(b.nbytes, 1)))
        for i in range(0, n, step):
            yield b.slice(i, step)


def gathered(it: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in as few batches as stay near ``limit`` bytes (one row at least)."""
    held, size = [], 0
    for b in batches(it, limit):
        if held and size + b.nbytes > limit:
            full, held, size = pa.concat_batches(held), [], 0
            yield full
            del full
            pa.default_memory_pool().release_unused()
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.concat_batches(held)

"""Incremental state on Structured Streaming: enrichment, keyed upserts, terminal states, retries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from grainmill.session import exists, remove

TERMINAL = "pdf_filed"


def source(spark: SparkSession, folder: str, schema: str, files: int = 1) -> DataFrame:
    """JSON files of a folder as a stream, a few per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)


def merge_state(state: DataFrame, batch: DataFrame, key: str = "doi", order: str = "seq") -> DataFrame:
    """The newest row of each key, but a terminal row is never replaced by one that is not."""
    rows = state.unionByName(batch, allowMissingColumns=True).where(F.col(key).isNotNull())
    row = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key).agg(F.max_by(row, F.struct(F.col("status") == TERMINAL, F.col(order))).alias("r")).select("r.*")


BUCKETS = 64


def _commits(spark: SparkSession, table: str, before: int | None = None) -> dict[int, int]:
    """Bucket to the newest committed epoch (below ``before``)."""
    if not exists(spark, f"{table}/_epochs"):
        return {}
    rows = spark.read.schema("epoch long, bucket int").json(f"{table}/_epochs")
    rows = rows if before is None else rows.where(F.col("epoch") < before)
    return {r[0]: r[1] for r in rows.groupBy("bucket").agg(F.max("epoch")).collect()}  # one row a bucket


def _path(table: str, epoch: int, bucket: int) -> str:
    return f"{table}/v{epoch}/bucket={bucket}"


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, key: str = "doi", order: str = "seq", buckets: int = BUCKETS) -> StreamingQuery:
    """Keep a table of one row per key up to date with a stream, a batch at a time.

    The table is cut into buckets by the key's hash and a batch rewrites those that it has keys of, as
    new files beside the old ones; a commit record then makes them the current ones, and what they
    replaced is removed with the next batch. A batch that runs again after a failure starts from the
    commits before it, so it ends in the same state.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, epoch: int) -> None:
        at = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        batch = batch.where(F.col(key).isNotNull()).withColumn("bucket", at).persist()
        try:
            touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # at most as many as buckets
            now = _commits(spark, table, epoch)
            old = [_path(table, now[b], b) for b in touched if b in now]
            state = spark.read.schema(batch.drop("bucket").schema).parquet(*old) if old else batch.drop("bucket").limit(0)
            merged = merge_state(state, batch.drop("bucket"), key, order).withColumn("bucket", at)
            merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/v{epoch}")
        finally:
            batch.unpersist()
        spark.createDataFrame([(epoch, b) for b in touched], "epoch long, bucket int").coalesce(1).write.mode("append").json(f"{table}/_epochs")
        for b in touched:  # files that the batch before replaced; readers have had a batch's time
            if b in (before := _commits(spark, table, now.get(b, 0))):
                remove(spark, _path(table, before[b], b))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_state(spark: SparkSession, table: str) -> DataFrame | None:
    """The table's committed state; None before the first batch."""
    now = _commits(spark, table)
    return spark.read.parquet(*[_path(table, e, b) for b, e in now.items()]) if now else None


def unseen_stream(stream: DataFrame, done: DataFrame, key: str = "doi") -> DataFrame:
    """Stream rows whose key an earlier run has not finished (stream-static anti-join)."""
    return stream.join(done.select(key).distinct(), key, "left_anti")


def enrich_stream(stream: DataFrame, enrich: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Resumable enrichment: each micro-batch is enriched and written under its epoch.

    The checkpoint says what is done; a batch that runs again replaces its own files, so nothing is
    there twice. The sink reads as one table with the column ``epoch``.
    """
    return stream.writeStream.foreachBatch(lambda batch, epoch: enrich(batch).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_retries(rows: DataFrame, call: Callable[[str, int], tuple[bool, str]], attempts: int = 2, parallel: int | None = None, threads: int = 1) -> DataFrame:
    """``(id, ok, output, attempts)``: call a model per row, again on failure, at most so often.

    ``call(prompt, attempt)`` is the caller's client; what it raises is a failed attempt, its text the
    output. ``parallel`` spreads rows over that many tasks, ``threads`` runs that many calls at once in each.
    """

    def one(prompt: str) -> tuple[bool, str, int]:
        ok, text, n = False, "", 0
        while not ok and n < attempts:
            try:
                ok, text = call(prompt, n)
            except Exception as e:  # noqa: BLE001  any failure of the client counts as one
                ok, text = False, f"{type(e).__name__}: {e}"
            n += 1
        return ok, text, n

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for b in it:
                out = [(i, *r) for i, r in zip(b["id"], pool.map(one, b["prompt"]))]
                yield pd.DataFrame(out, columns=["id", "ok", "output", "attempts"])

    spread = rows.select("id", "prompt") if parallel is None else rows.select("id", "prompt").repartition(parallel)
    return spread.mapInPandas(run, "id string, ok boolean, output string, attempts long")


def token_counts(rows: DataFrame, column: str, count: Callable[[str], int] | None = None) -> DataFrame:
    """``tokens``: by the caller's tokenizer, else words and marks counted on the JVM."""
    if count is None:
        return rows.withColumn("tokens", F.regexp_count(column, F.lit(r"(?U)\w+|[^\w\s]")).cast("long"))

    @F.pandas_udf("long")
    def tokens(s: pd.Series) -> pd.Series:
        return s.map(lambda t: 0 if t is None else count(t))

    return rows.withColumn("tokens", tokens(column))

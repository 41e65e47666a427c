"""A training-data pipeline over ``documents``: four operators, each stage on what the last one kept.

Stage results are written as Parquet and reread, so a lost executor repeats a part of one stage.
The stages before the last return the columns of ``documents``; the last returns the packing plan of
every surviving document (see ``grainmill.llm.packing``). No stage has an SQL form (a trained model,
fingerprints, decoding, a tokenizer), so ``ORACLE_SQL`` is None and the tests compare ``run`` with a
brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grainmill.llm import packing, quality, secrets, simhash
from grainmill.llm.common import read_table, scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below its threshold."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of every SimHash component."""
    return simhash.keep_first(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret, also those behind encodings, by a mark."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document's tokens in sequences of at most 4096."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs

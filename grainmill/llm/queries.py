"""The queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm import embeddings, html, licenses, packing, pieces, quality, secrets, simhash, tokenio, topk
from grainmill.llm.common import read_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with those behind encodings."""
    return secrets.secret_spans(read_table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keeper of every embedding at cosine 0.9."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from positive-unlabelled learning."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in every document."""
    return licenses.license_spans(read_table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash class of every document: fingerprint and smallest reachable doc_id."""
    out = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest 64-bit codes of every fiftieth embedding, among all."""
    return topk.nearest_codes(read_table(spark, sf_dir, "embeddings"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in sequences of at most 4096 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through token-id files and back."""
    return tokenio.token_round_trip(read_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the piece transducer and back."""
    return pieces.encode_decode(read_table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract_text(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_id_output": op8_token_id_output,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_html_extraction": op10_html_extraction,
}

ORACLE_SQL: dict[str, str] = {}

"""Ship gates and decisions: metrics joined to a small relation of rules, one row per gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (gate, metric, operator, threshold)
QUALITY = (
    ("combined_expect_pass", "combined_expect", ">=", 0.90),
    ("json_parse_with_repair", "json_parse", ">=", 0.98),
    ("supported_h001_h010", "supported_h", ">=", 8.0),
    ("core_legacy_5", "core_legacy", ">=", 5.0),
    ("quote_validity_holdout", "quote_validity", ">=", 0.98),
    ("false_supported_holdout", "false_supported", "<=", 0.05),
)
DEFAULT = tuple((g, m, op, {"combined_expect": 0.88, "quote_validity": 0.88, "false_supported": 0.07}.get(m, t)) for g, m, op, t in QUALITY)
BASELINE = (("beats_expect", "combined_expect", ">=", 0.8812), ("beats_quote", "quote_validity", ">=", 0.8947), ("beats_false_supported", "false_supported", "<=", 0.0657))
EXPECT_BUFFER = 0.92


def body(pilot: bool = True) -> tuple:
    return (("body_holdout_min_rows", "rows", ">=", 5.0 if pilot else 30.0), ("body_expect_pass", "combined_expect", ">=", 0.90), *QUALITY[4:])


def gates(metrics: DataFrame, rules=QUALITY) -> DataFrame:
    """``(gate, value, op, threshold, passed)``: metrics are ``(metric, value)`` rows.

    A metric that is null or absent fails its gate. The rules are a literal table of a few rows.
    """
    spark = metrics.sparkSession
    table = F.broadcast(spark.createDataFrame(list(rules), "gate string, metric string, op string, threshold double"))
    rows = table.join(metrics, "metric", "left")
    ok = F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return rows.select("gate", "metric", F.col("value").cast("double").alias("value"), "op", "threshold", F.coalesce(ok, F.lit(False)).alias("passed"))


def verdict(gated: DataFrame) -> DataFrame:
    """Whether all gates passed."""
    return gated.agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def gate_counts(scored: DataFrame) -> DataFrame:
    """Passing rows among h-001..h-010, and passing rows at all."""
    n = F.regexp_extract("id", r"^h-(\d{3})$", 1).try_cast("int")
    return scored.agg(F.count_if(F.col("checks_passed") & n.between(1, 10)).cast("double").alias("supported_h"), F.count_if("checks_passed").cast("double").alias("core_legacy"))


def slice_metrics(reports: DataFrame) -> DataFrame:
    """``(slice, metric, value)`` of the three slice rates."""
    return reports.unpivot(["slice"], ["expect_checks_pass_rate", "quote_validity_rate", "false_supported_rate"], "metric", "value")


def ab_decision(baseline: DataFrame, candidate: DataFrame, hard: DataFrame, gain: float = 0.03, multi: float = 0.80) -> DataFrame:
    """Adopt a candidate over a baseline: gain, multi-claim floor, no worse quotes, all hard rows.

    ``baseline`` and ``candidate`` are one row each (combined_expect, multi_claim, quote_validity),
    ``hard`` has a boolean ``checks_passed`` per hard row. The unrounded gain decides.
    """
    b = baseline.select(F.col("combined_expect").alias("b_expect"), F.coalesce("quote_validity", F.lit(0.0)).alias("b_quote"), F.lit(1).alias("k"))
    c = candidate.select(F.col("combined_expect").alias("c_expect"), F.col("multi_claim"), F.coalesce("quote_validity", F.lit(0.0)).alias("c_quote"), F.lit(1).alias("k"))
    h = hard.agg(F.coalesce(F.bool_and("checks_passed"), F.lit(True)).alias("hard_ok")).withColumn("k", F.lit(1))
    rows = b.join(c, "k").join(h, "k").withColumn("delta", F.col("c_expect") - F.col("b_expect"))
    ok = (F.col("delta") >= gain) & F.coalesce(F.col("multi_claim") >= multi, F.lit(False)) & (F.col("c_quote") >= F.col("b_quote")) & F.col("hard_ok")
    return rows.select(F.round("delta", 4).alias("delta"), "multi_claim", "hard_ok", F.when(ok, "adopt").otherwise("defer").alias("decision"))


def probe_verdict(metrics: DataFrame) -> DataFrame:
    """WAIT, GO (later), AMBIGUOUS or WEAK of a zero-shot probe, by thresholds in this order.

    ``false_supported_rate`` is reported and takes no part in the decision.
    """
    p, e, q = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("parse_strict_rate", "combined_expect_rate", "quote_validity_rate"))
    v = F.when((p < 0.90) | (e < 0.60), "WAIT").when((p >= 0.95) & (e >= 0.75) & (q >= 0.90), "GO (later)").when((p >= 0.85) & (e >= 0.70), "AMBIGUOUS").otherwise("WEAK")
    return metrics.select("*", v.alias("verdict"))


def no_contamination(hits: DataFrame) -> DataFrame:
    """The hard gate on train/eval overlap: one row, passed if there is no hit."""
    return hits.agg(F.count(F.lit(1)).alias("hits"), (F.count(F.lit(1)) == 0).alias("passed"))


def within_length(rows: DataFrame, tokens: str, limit: int) -> DataFrame:
    return rows.agg(F.count_if(F.col(tokens) > limit).alias("overflow"), (F.count_if(F.col(tokens) > limit) == 0).alias("passed"))


def smoke(scored: DataFrame, ids: list[str]) -> DataFrame:
    """All of a few fixed rows must be there and pass."""
    hit = scored.where(F.col("id").isin(ids))
    return hit.agg(F.count(F.lit(1)).alias("rows"), ((F.count(F.lit(1)) == len(ids)) & F.coalesce(F.bool_and("checks_passed"), F.lit(False))).alias("passed"))

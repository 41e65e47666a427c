"""Scoring of model outputs: evaluation rows against predictions, rates, slices, seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import jsonx
from grainmill.session import materialize

_RANGES = {
    "supported": ((1, 10), (46, 53)),
    "contradicted": ((11, 19), (54, 59)),
    "not_in_source": ((20, 28), (60, 65)),
    "weak": ((29, 34), (66, 75)),
    "insufficient_evidence": ((35, 39), (76, 83)),
    "multi_claim": ((40, 45), (84, 90)),
}


def rate(hits: Column, n: Column, empty: float | None = 0.0) -> Column:
    """``hits / n`` to four places; a set value (0 or null) for nothing."""
    return F.when(n > 0, F.round(hits / n, 4)).otherwise(F.lit(empty).cast("double"))


def category(row_id: Column, override: Column | None = None) -> Column:
    """Evaluation category: the row's own, else by the number in ``h-NNN``."""
    n = F.when(F.startswith(row_id, F.lit("h-")), F.substring_index(F.substr(row_id, F.lit(3)), "-", 1).try_cast("int"))
    by_id = F.coalesce(*[F.when(reduce(lambda a, b: a | b, [n.between(x, y) for x, y in spans]), name) for name, spans in _RANGES.items()])
    return by_id if override is None else F.coalesce(F.nullif(override, F.lit("")), by_id)


def score(evals: DataFrame, predictions: DataFrame, allow_repair: bool = True) -> DataFrame:
    """One row per evaluation row; those without a prediction are flagged, not failed.

    ``evals``: id, source_excerpt, expect (``jsonx.EXPECT``), optional eval_category.
    ``predictions``: id, raw_output. Predictions are keyed; the caller resolves repeated ids.
    """
    p = predictions.select("id", F.coalesce("raw_output", F.lit("")).alias("raw_output"), F.lit(True).alias("__has"))
    rows = evals.join(p, "id", "left").withColumn("strict", jsonx.parse_strict("raw_output"))
    fixed = jsonx.parse_repaired("raw_output") if allow_repair else F.col("strict")
    rows = rows.withColumn("parsed_value", F.coalesce("strict", fixed)).withColumn("claims", jsonx.clean_claims(F.col("parsed_value")))
    parsed = F.col("parsed_value").isNotNull()
    rows = rows.withColumn("missing", F.col("__has").isNull()).withColumn("parsed", parsed).withColumn("parsed_strict", F.col("strict").isNotNull())
    rows = rows.withColumn("failures", F.when(F.col("missing"), F.array().cast("array<string>")).otherwise(jsonx.failures(F.col("parsed"), F.coalesce("claims", F.array().cast(f"array<{jsonx.CLAIM}>")), F.col("expect"), F.coalesce("source_excerpt", F.lit("")))))
    rows = rows.withColumn("checks_passed", ~F.col("missing") & (F.size("failures") == 0))
    rows = rows.withColumn("failure_mode", jsonx.failure_mode(F.col("parsed"), F.col("failures"), F.col("missing")))
    own = F.col("eval_category") if "eval_category" in evals.columns else None
    return rows.select(
        "id", "missing", "parsed", "parsed_strict", (F.col("parsed") & ~F.col("parsed_strict")).alias("repaired_used"), "checks_passed", "failures", "failure_mode",
        category(F.col("id"), own).alias("category"), F.coalesce(F.col("expect")["quotes_must_be_substrings"], F.lit(False)).alias("quote_row"),
        F.coalesce(F.array_contains(F.col("expect")["forbidden_claim_verdict"], "supported"), F.lit(False)).alias("trap_row"),
        F.coalesce(F.exists("claims", lambda c: c["verdict"] == "supported"), F.lit(False)).alias("says_supported"),
    )


def summary(scored: DataFrame, by: str | None = None) -> DataFrame:
    """Counts and rates over scored rows; missing predictions are in no denominator.

    Quote validity counts a row only if all of its checks pass. ``by`` adds grouping sets: one row
    per group and one (null group) for all.
    """
    here = ~F.col("missing")
    n, quotes, traps = F.count_if(here), F.count_if(here & F.col("quote_row")), F.count_if(here & F.col("trap_row"))
    aggs = [
        F.count(F.lit(1)).alias("total"),
        n.alias("scored"),
        rate(F.count_if(here & F.col("parsed_strict")), n).alias("json_parse_rate_strict"),
        rate(F.count_if(here & F.col("parsed")), n).alias("json_parse_rate_with_repair"),
        F.count_if(here & F.col("repaired_used")).alias("repaired"),
        rate(F.count_if(here & F.col("checks_passed")), n).alias("expect_checks_pass_rate"),
        rate(F.count_if(here & F.col("quote_row") & F.col("checks_passed")), quotes, None).alias("quote_validity_rate"),
        rate(F.count_if(here & F.col("trap_row") & F.col("says_supported")), traps, None).alias("false_supported_rate"),
    ]
    return scored.agg(*aggs) if by is None else scored.rollup(by).agg(*aggs)


def category_rates(scored: DataFrame) -> DataFrame:
    rows = scored.where("category is not null and not missing")
    return rows.groupBy("category").agg(F.count_if("checks_passed").alias("passed"), F.count(F.lit(1)).alias("total"), F.round(F.avg(F.col("checks_passed").cast("double")), 4).alias("rate"))


def merge_slices(slices: DataFrame, n: str = "scored") -> DataFrame:
    """Weighted mean of slice rates, which were rounded before (their rounding is kept)."""
    rates = [c for c in slices.columns if c.endswith("_rate") or c.startswith("json_parse_rate")]
    w = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.col(n)))
    return slices.agg(F.sum(n).alias(n), *[rate(F.sum(F.col(c) * F.col(n)), w(c), None).alias(c) for c in rates])


def mean_over_seeds(seeds: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of each metric over seeds; booleans count as 0/1, what is no number is skipped."""
    return seeds.agg(*[F.round(F.avg(F.col(m).cast("string").try_cast("double") if dict(seeds.dtypes)[m] == "string" else F.col(m).cast("int" if dict(seeds.dtypes)[m] == "boolean" else "double")), 4).alias(m) for m in metrics])


def failing_rows(scored: DataFrame, order: str = "id") -> DataFrame:
    """Ids of the rows that fail, a row each, in order.

    The flags are kept: a filter on them would be pushed below the scoring, which it repeats once
    for every use of a parsed value, and a sort reads its input twice.
    """
    flags = materialize(scored.select(*dict.fromkeys(["id", order]), "checks_passed"), "flags")
    return flags.where(~F.col("checks_passed")).drop("checks_passed").orderBy(order)


def failing_ids(scored: DataFrame, order: str = "id", most: int | None = 10_000) -> DataFrame:
    """The failing ids of a report as one array; more than ``most`` are an error (see ``failing_rows``).

    The sorted parts become arrays of their own first; the one task of the result only joins them.
    """
    rows = failing_rows(scored, order)
    if most is not None:
        rows = rows.limit(most + 1)
    rows = rows.select(F.spark_partition_id().alias("part"), F.struct(F.col(order).alias("o"), F.col("id").alias("id")).alias("x"))
    parts = rows.groupBy("part").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["id"]).alias("ids"))
    one = parts.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "ids"))), lambda x: x["ids"])).alias("ids"))
    if most is None:
        return one.select(F.col("ids").alias("failing"))
    return one.select(F.when(F.size("ids") > most, F.raise_error(F.lit(f"more than {most} failing rows"))).otherwise(F.col("ids")).alias("failing"))


def missing_ids(evals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Evaluation ids without a prediction."""
    return evals.select("id").join(predictions.select("id"), "id", "left_anti")


def batch_summary(predictions: DataFrame) -> DataFrame:
    """Counts by status and time of a batch of model runs."""
    ok = F.col("status").isin("ok", "ok_repaired")
    return predictions.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "ok_repaired").alias("repaired"),
        F.round(F.sum("seconds"), 1).alias("seconds"), F.round(F.avg("seconds"), 2).alias("mean_seconds"),
    )


def version_matrix(reports: DataFrame, versions: list[str]) -> DataFrame:
    """``id`` by version, the cell a failure mode, ``—`` where a version lacks the row.

    The versions are a stated list; reports of others are left out. Ids starting ``h-`` come first.
    """
    wide = reports.where(F.col("version").isin(versions)).groupBy("id").pivot("version", versions).agg(F.first("failure_mode"))
    cells = [F.coalesce(F.col(f"`{v}`"), F.lit("—")).alias(v) for v in versions]
    return wide.select("id", *cells).orderBy(~F.startswith("id", F.lit("h-")), "id")


def natural_version(c: Column) -> Column:
    """Sort key that puts v1.4a before v1.10."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\d+|[A-Za-z]+)"), 1), lambda p: F.lpad(p, 8, "0")), ".")

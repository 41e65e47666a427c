"""Unions with key rules, small samples, audits and preparation steps that combine operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.text import let
from grainmill.operators import evaluate, gates, rules
from grainmill.operators.corpus import rank_value
from grainmill.operators.joins import first_per_key
from grainmill.operators.windows import chunk_excerpt, smallest_draws
from grainmill.session import materialize


def union_in_order(*frames: DataFrame) -> DataFrame:
    """All rows, with ``file_ord`` as the place of their frame; columns are matched by name."""
    tagged = [f.withColumn("file_ord", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    """The rows; one without an id is an error."""
    return rows.withColumn(key, F.when(F.coalesce(F.col(key).cast("string"), F.lit("")) == "", F.raise_error(F.lit(f"row without {key}"))).otherwise(F.col(key)))


def repeated(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def union_unique(*frames: DataFrame, key: str = "id") -> DataFrame:
    """The union of frames that share no key; a repeated key is an error, raised before any output."""
    out = union_in_order(*[with_ids(f, key) for f in frames])
    twice = repeated(out, key).limit(5).collect()
    if twice:
        raise ValueError(f"repeated {key}: {[r[0] for r in twice]}")
    return out


def union_first(*frames: DataFrame, key: str = "id", order: str = "row_ord") -> DataFrame:
    """The union, of each key the first frame's first row; rows without a key are left out."""
    out = union_in_order(*frames).where(F.col(key).isNotNull()).withColumn("__o", F.struct("file_ord", order))
    return first_per_key(out, key, "__o").drop("__o")


def holdout(pool: DataFrame, target: int, size: int = 50, seed: int = 42, key: str = "corpus_id") -> tuple[DataFrame, DataFrame]:
    """A random holdout if the pool exceeds holdout and target together; else none. ``(held, rest)``."""
    if pool.count() <= size + target:
        return pool.limit(0), pool
    held = smallest_draws(pool, f"{seed}-holdout", key, size)
    return held, pool.join(held.select(key), key, "left_anti")


def fraction(rows: DataFrame, share: float = 0.15, seed: int = 42, key: str = "id") -> DataFrame:
    """A share of the rows for review, one at least, without replacement.

    Count, draw and pick are passes of their own: the rows are kept, not computed for each.
    """
    rows = materialize(rows, "reviewed")
    n = rows.count()
    return smallest_draws(rows, f"{seed}-review", key, max(1, int(n * share))) if n else rows


def single_file(files: DataFrame, exact: str, suffix: str = ".gguf") -> DataFrame:
    """The file of an exact name, else the only one with the suffix; several are an error."""
    hits = files.where(F.col("name") == exact)
    only = files.where(F.endswith("name", F.lit(suffix))).agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
    fallback = only.select(F.when(F.col("n") > 1, F.raise_error(F.lit("ambiguous files"))).when(F.col("n") == 1, F.col("name")).alias("name")).where("name is not null")
    return hits.select("name") if not hits.isEmpty() else fallback


def length_audit(rows: DataFrame, tokens: str = "tokens", limit: int = 2048) -> DataFrame:
    """Rows, longest, 95th percentile by rank (``sorted[int(0.95 n)]``) and overflow count."""
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(tokens).alias("longest"), F.count_if(F.col(tokens) > limit).alias("overflow"), F.lit(1).alias("k"))
    p95 = rank_value(rows.select(F.lit(1).alias("k"), tokens), tokens, ["k"], lambda t: F.floor(t * 0.95)).withColumnRenamed("value", "p95")
    return n.join(p95, "k", "left").drop("k")


def overflowing(rows: DataFrame, tokens: str = "tokens", limit: int = 2048, key: str = "id") -> DataFrame:
    return rows.where(F.col(tokens) > limit).select(key, tokens)


def pilot_coverage(rows: DataFrame, least: int = 5) -> DataFrame:
    """Valid pilot rows by language, and whether there are enough in all. Null language: all."""
    checked = rows.withColumn("valid", F.size(rules.pilot_errors()) == 0)
    out = checked.rollup("language").agg(F.count(F.lit(1)).alias("rows"), F.count_if("valid").alias("valid"))
    return out.withColumn("enough", F.when(F.col("language").isNull(), F.col("valid") >= least))


def sequence_safe(rows: DataFrame, tokens: Column, limit: int = 2048, budget: int = 1800) -> DataFrame:
    """Training rows fit for a sequence limit: excerpt capped around the passage, then those kept
    whose quotes survived the cap and whose tokens fit. ``rows``: id, passage, source_excerpt, claims."""
    from grainmill.functions.jsonx import _inside

    capped = rows.withColumn("source_excerpt", chunk_excerpt("passage", "source_excerpt", budget))
    # the filter moves below the cap, so it names the capped excerpt once
    quoted = let(F.col("source_excerpt"), lambda e: F.forall("claims", lambda c: (c["verdict"] != "supported") | F.coalesce(F.forall(c["sourceQuotes"], lambda q: _inside(q, e)), F.lit(True))))
    return capped.where(quoted).withColumn("tokens", tokens).where(F.col("tokens") <= limit)


def score_slices(slices: dict[str, tuple[DataFrame, DataFrame]], allow_repair: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(reports, metrics)`` of one seed: each slice scored, the slices merged, gate metrics derived.

    ``slices``: name to (evaluation rows, predictions); ``holdout`` and ``legacy`` feed the gates.
    """
    scored = {n: evaluate.score(e, p, allow_repair) for n, (e, p) in slices.items()}
    reports = reduce(lambda a, b: a.unionByName(b), [evaluate.summary(s).withColumn("slice", F.lit(n)) for n, s in scored.items()])
    merged = evaluate.merge_slices(reports)
    parts = [merged.select(F.lit("combined_expect").alias("metric"), F.col("expect_checks_pass_rate").alias("value")), merged.select(F.lit("json_parse"), F.col("json_parse_rate_with_repair"))]
    if "holdout" in scored:
        h = reports.where("slice = 'holdout'")
        parts += [h.select(F.lit("quote_validity"), "quote_validity_rate"), h.select(F.lit("false_supported"), "false_supported_rate"), gates.gate_counts(scored["holdout"]).select(F.lit("supported_h"), "supported_h")]
    if "legacy" in scored:
        parts.append(gates.gate_counts(scored["legacy"]).select(F.lit("core_legacy"), "core_legacy"))
    return reports, reduce(lambda a, b: a.union(b), parts)

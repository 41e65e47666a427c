"""Ordered and sampling operators: numbering, running counts, packing, trimming, quotas.

The reference's order is a list position and its randomness a shared generator; here order is an
explicit column and randomness ``md5(seed|id)``, which any engine reproduces.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.session import materialize


def draw(seed: int | str, key: str = "id") -> Column:
    """The seeded place of a row in a random order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def _bucket(rows: DataFrame, order: str) -> Column:
    """The place of a row's order value among sampled quantiles: buckets of about equal size.

    A pure function of the value (its bounds are literals), so every pass over the rows agrees. Two
    steps find it: first the stretch of bounds, then the place in it.
    """
    parts = min(4096, max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    n = rows.count()
    sample = rows.select(order).where(F.col(order).isNotNull())
    if n > 100 * parts:
        sample = sample.sample(min(1.0, 120 * parts / n), 42)
    values = sorted(r[0] for r in sample.limit(200 * parts).collect())  # a bounded sample
    bounds = sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []
    if not bounds:
        return F.lit(0)
    below = lambda some: F.size(F.filter(some, lambda b: b < F.col(order)))
    step = 64
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if len(runs) == 1:
        return below(F.array(*[F.lit(b) for b in bounds]))
    run = below(F.array(*[F.lit(r[-1]) for r in runs]))
    inside = below(F.get(F.array(*[F.array(*[F.lit(b) for b in r]) for r in runs]), run))
    return run * step + F.greatest(inside, F.lit(0))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in keys])


def running_total(rows: DataFrame, value: Column, within: Sequence[str], order: str, name: str) -> DataFrame:
    """``name``: the sum of a value over the rows of the group up to and including this one.

    Rows are dealt into buckets by their order value; a group's total before each bucket comes from
    one aggregate, and only a bucket is summed row by row. No task sees a whole group.
    """
    tagged = rows.withColumn("__b", _bucket(rows, order)).withColumn("__v", value.cast("long"))
    keys = [*within, "__b"]
    sums = tagged.groupBy(*keys).agg(F.sum("__v").alias("__s"))
    before = Window.partitionBy(*within).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # as many rows a group as buckets
    if within:
        base = sums.select(*[F.col(k).alias(f"__g_{k}") for k in keys], F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
        tagged = tagged.join(base, _same(tagged, base, keys, "__g_"), "left")
    else:
        held, at = {r["__b"]: r["__s"] or 0 for r in sums.collect()}, 0  # one row a bucket
        starts = []
        for b in range(max(held, default=-1) + 1):
            starts.append(at)
            at += held.get(b, 0)
        tagged = tagged.withColumn("__base", F.get(F.array(*[F.lit(x).cast("long") for x in starts]), F.col("__b")) if starts else F.lit(0).cast("long"))
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return tagged.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("__base") + F.sum("__v").over(inside)).alias(name))


def numbered(rows: DataFrame, order: str, within: Sequence[str] = (), name: str = "number") -> DataFrame:
    """Rows with their 1-based place in order, in all or within a group, of any size."""
    return running_total(rows, F.lit(1), within, order, name)


def number_survivors(rows: DataFrame, order: str, prefix: str, within: str | None = None) -> DataFrame:
    """``new_id`` = prefix and the row's number among the rows that are left, from 001."""
    out = numbered(rows, order, [] if within is None else [within], "__number")
    return out.withColumn("new_id", F.format_string(f"{prefix}%03d", "__number")).drop("__number")


def running_count(rows: DataFrame, flag: Column, key: str, order: str, name: str = "so_far") -> DataFrame:
    """How many flagged rows of the key there were up to and including this one."""
    return running_total(rows, F.coalesce(flag, F.lit(False)).cast("long"), [key], order, name)


def pack_sentences(c: Column | str, budget: int = 1800) -> Column:
    """Leading texts of an array whose join by a blank line fits the budget; stops at the first that does not."""
    start = F.struct(F.lit(0).alias("used"), F.lit(True).alias("open"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, s: Column) -> Column:
        size = acc["used"] + F.length(s) + F.when(F.size(acc["kept"]) > 0, 2).otherwise(0)
        fits = acc["open"] & (size <= budget)
        return F.struct(F.when(fits, size).otherwise(acc["used"]).cast("int").alias("used"), fits.alias("open"), F.when(fits, F.concat(acc["kept"], F.array(s))).otherwise(acc["kept"]).alias("kept"))

    return F.aggregate(T.col(c), start, step)["kept"]


def excerpt_parts(clean: Column) -> Column:
    """The sentences of a cleaned source that may go into an excerpt; its head if it has none."""
    parts = F.filter(F.split(clean, r"(?U)(?<=[.!?])\s+"), lambda s: F.length(F.trim(s)) > 20)
    return T.let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.left(clean, F.lit(2000)))))


def packed_excerpt(passage: Column | str, clean: Column, parts: Column, budget: int = 1800) -> Column:
    """A cleaned source if it fits; else its parts by token overlap with the passage, packed."""
    # the passage's tokens are bound once, not found anew for every sentence
    ranked = T.let(T.overlap_tokens(passage), lambda t: F.array_sort(F.transform(parts, lambda s, i: F.struct((-T.overlap_score(t, T.overlap_tokens(s))).alias("k"), i.alias("i"), F.trim(s).alias("s")))))
    packed = F.array_join(pack_sentences(F.transform(ranked, lambda r: r["s"]), budget), "\n\n")
    return F.when(F.length(clean) <= budget, clean).otherwise(F.coalesce(T.let(packed, lambda p: F.when(p != "", p)), F.left(clean, F.lit(budget))))


def chunk_excerpt(passage: Column | str, source: Column | str, budget: int = 1800) -> Column:
    """The source if it fits; else its sentences by token overlap with the passage, packed."""
    return T.let(T.normalize_ws(source), lambda clean: packed_excerpt(passage, clean, excerpt_parts(clean), budget))


def trim_largest(rows: DataFrame, bucket: str, order: str, cap: int) -> DataFrame:
    """Rows over the cap are dropped from the end of the largest bucket, and of no other.

    Ties for the largest go to the bucket seen first. The cap can so be exceeded still.
    """
    sizes = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    total = sizes.agg(F.sum("n").alias("total"), F.max_by(bucket, F.struct("n", -F.col("first"))).alias("b"), F.max("n").alias("most")).first()
    extra = min(max((total.total or 0) - cap, 0), total.most or 0)
    if not extra:
        return rows
    keep = total.most - extra
    inside = rows.where(F.col(bucket).eqNullSafe(F.lit(total.b)))
    return rows.where(~F.col(bucket).eqNullSafe(F.lit(total.b))).unionByName(smallest(inside, order, keep))


def smallest(rows: DataFrame, order: str, k: int) -> DataFrame:
    """The k rows of the smallest order value; k may be as large as the table."""
    return numbered(rows, order, name="__number").where(F.col("__number") <= k).drop("__number")


def drawn_first(rows: DataFrame, group: Sequence[str], k: Column, seed: int | str, key: str) -> DataFrame:
    """Of each group the first ``k`` rows drawn; ``k`` is a Column over the group's columns.

    Draws are uniform, so 65536 prefix counts a group tell where its k-th lies: all rows below that
    prefix are in, and only the prefix's own rows are ranked. No task sees a whole group.
    """
    drawn = rows.withColumn("__draw", draw(seed, key)).withColumn("__bin", F.left("__draw", F.lit(4)))
    upto = F.sum("__n").over(Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
    hist = drawn.groupBy(*group, "__bin").agg(F.count(F.lit(1)).alias("__n")).withColumn("__upto", upto).withColumn("__k", k.cast("long"))
    edge = hist.where("__upto > __k").groupBy(*group).agg(F.min(F.struct(F.col("__bin").alias("bin"), (F.col("__k") - F.col("__upto") + F.col("__n")).alias("left"))).alias("__edge"))
    edge = edge.select(*[F.col(g).alias(f"__g_{g}") for g in group], "__edge")
    both = drawn.join(edge, _same(drawn, edge, group, "__g_"), "left").drop(*[f"__g_{g}" for g in group])
    inside = both.where(F.col("__edge").isNull() | (F.col("__bin") < F.col("__edge.bin"))).select(*rows.columns)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("__draw", key))
    last = both.where(F.col("__bin") == F.col("__edge.bin")).withColumn("__r", rank).where(F.col("__r") <= F.col("__edge.left")).select(*rows.columns)
    return inside.unionByName(last)


def smallest_draws(rows: DataFrame, seed: int | str, key: str, k: int) -> DataFrame:
    """The k rows drawn first. Draws are uniform, so 65536 prefix counts tell where the k-th lies;
    all rows below that prefix are in, and only the prefix's own rows are ranked."""
    drawn = rows.withColumn("__draw", draw(seed, key)).withColumn("__bin", F.left("__draw", F.lit(4)))
    counts = {r["__bin"]: r["n"] for r in drawn.groupBy("__bin").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= 65536 rows
    below, edge = 0, None
    for b in sorted(counts):
        if below + counts[b] > k:
            edge = b
            break
        below += counts[b]
    if edge is None:
        return rows
    inside = drawn.where(F.col("__bin") < edge)
    last = drawn.where(F.col("__bin") == edge).orderBy("__draw", key).limit(k - below)
    return inside.unionByName(last).drop("__draw", "__bin")


def split(rows: DataFrame, seed: int = 46, share: float = 0.05, key: str = "id") -> DataFrame:
    """``split`` = eval for a share of the rows, one at least, else train."""
    n = rows.count()
    chosen = smallest_draws(rows.select(key), seed, key, max(1, int(n * share)) if n else 0).withColumn("__eval", F.lit(True))
    return rows.join(chosen, key, "left").withColumn("split", F.when(F.col("__eval"), "eval").otherwise("train")).drop("__eval")


def stratified(rows: DataFrame, stratum: str, target: int, seed: int = 42, key: str = "id") -> DataFrame:
    """An equal share of every stratum, topped up to the target in drawing order."""
    strata = rows.select(stratum).distinct().count()
    base = materialize(drawn_first(rows, [stratum], F.lit(max(1, target // max(1, strata))), seed, key), "strata")
    n = base.count()
    if n < target:
        return base.unionByName(smallest_draws(rows.join(base.select(key), key, "left_anti"), f"{seed}-top-up", key, target - n).select(*base.columns))
    return smallest_draws(base, seed, key, target)


def per_stratum(rows: DataFrame, stratum: str, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Exactly the first n drawn rows of each stratum."""
    return drawn_first(rows, [stratum], F.lit(n), seed, key)


def quotas(rows: DataFrame, verdict: str, target: int, shares: dict[str, float], priority: Column, multi: Column, seed: int = 42, key: str = "id", multi_floor: int = 100) -> DataFrame:
    """Quota-balanced sample in stages: priority rows, verdict quotas, multi-claim floor, fill.

    A verdict whose quota the priority rows have filled still gets one row. Every stage draws from
    what the stages before left. The result has at most ``target`` rows besides the priority rows
    that exceed it; what exceeds it goes from the end of the last stage.
    """
    pool = materialize(rows.withColumn("__p", F.coalesce(priority, F.lit(False))).withColumn("__m", F.coalesce(multi, F.lit(False))), "quota-pool")
    got = {r[0]: (r[1], r[2]) for r in pool.where("__p").groupBy(verdict).agg(F.count(F.lit(1)), F.count_if("__m")).collect()}  # one row per verdict
    n_first, n_multi = (sum(x[i] for x in got.values()) for i in (0, 1))
    need = F.lit(0)
    for v, share in shares.items():
        need = F.when(F.col(verdict) == v, max(1, max(1, int(target * share)) - got.get(v, (0, 0))[0])).otherwise(need)
    rest = pool.where("not __p")
    picked = materialize(pool.where("__p").withColumn("stage", F.lit(0)).unionByName(drawn_first(rest, [verdict], need, seed, key).withColumn("stage", F.lit(1))), "quota-picked")
    n_picked, n_both = picked.agg(F.count(F.lit(1)), F.count_if("__m")).first()
    left = rest.join(picked.select(key), key, "left_anti").select(*rest.columns)
    more = materialize(smallest_draws(left.where("__m"), seed, key, max(0, multi_floor - n_both)).withColumn("stage", F.lit(2)), "quota-more")
    out, n = picked.unionByName(more), n_picked + more.count()
    if n < target:
        out = out.unionByName(smallest_draws(left.join(more.select(key), key, "left_anti").select(*rest.columns), seed, key, target - n).withColumn("stage", F.lit(3)))
        n = target
    most = max(target, n_first)
    if n > most:  # the last stage that still fits in part is cut in drawing order
        sizes = {0: n_first, 1: n_picked - n_first, 2: n - n_picked}
        kept, parts = 0, []
        for stage, size in sizes.items():
            take = min(size, most - kept)
            part = out.where(F.col("stage") == stage)
            parts.append(part if take == size else smallest_draws(part, seed, key, take))
            kept += take
        out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.drop("__p", "__m")


def top_per_group(rows: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group (planned as a group limit before the shuffle)."""
    groups = [group] if isinstance(group, str) else list(group)
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("__r") <= n).drop("__r")


def seeded_pick(options: Column, seed: Column) -> Column:
    """One element of an array by the first 32 bits of the seed's md5; null if it is empty."""
    at = F.conv(F.left(F.md5(seed), F.lit(8)), 16, 10).cast("long")
    return F.when(F.size(options) > 0, F.get(options, F.pmod(at, F.size(options)).cast("int")))

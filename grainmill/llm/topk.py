"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A 64-bit code is indexed by segments of about log2(n) bits each, n being the number of codes, so a
bucket of the index holds a code or so whatever the table's size. If the segments of two codes
differ in more than ``r_1, r_2, ...`` bits, the codes differ in at least ``sum (r_i + 1)``; so once all
segment values within those radii of a query have been probed, every code closer than that was met.
Radii grow one segment at a time: in the round of radius r a query probes as many more segments as
its k-th verified Hamming distance asks for, and stops as soon as that distance is below the bound:
the answer is exact. Every round is an equi-join of the open queries' probes with the segment
index, on JVM expressions; a code is taken from the first probe that meets it and from no other.
Buckets of more than ``CELL`` codes are cut and their probes go to every piece.

Equal codes are kept once in the index, with the ``k + 1`` smallest ids that carry them: more can
never be among the k nearest of a query that is one of them. For the same reason the ``k + 1`` codes
first by distance and smallest id hold all neighbours. These are ordered by distance, then id.

Defined results: a row without a usable vector or id has no code and is neither query nor answer; a
query never answers itself; repeated rows of one id answer once; a table with fewer than ``k``
other rows gives what there is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, ship
from grainmill.llm.embeddings import usable

BITS, K, EVERY, CELL = 64, 10, 50, 4096
_KEY = 40  # bits of a segment's value in its key


def binary_codes(embeddings: DataFrame, seed: int = 42) -> DataFrame:
    """``(vec_id, code)``: the signs of 64 seeded random projections of each usable vector."""
    ship(embeddings.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not b.num_rows:
                continue
            code = np.zeros(b.num_rows, np.int64)
            lists = b.column(1)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)[:-1]])
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                planes = np.random.default_rng([seed, int(d)]).standard_normal((int(d), BITS))
                bits = flat[start[rows][:, None] + np.arange(d)] @ planes > 0
                code[rows] = np.packbits(bits, axis=1, bitorder="little").view("<i8")[:, 0]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(code)], ["vec_id", "code"])

    good = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(usable() & F.col("vec_id").isNotNull())
    return good.mapInArrow(run, "vec_id long, code long")


def layout(n: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of the segments for n codes: widths near log2(n), 8 to 32 bits."""
    want = max(8.0, math.log2(max(n, 2)))
    m = min((2, 3, 4, 5, 6, 8), key=lambda m: abs(BITS / m - want))
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _value(code: str, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))


def _probes(queries: DataFrame, segments: list[tuple[int, int]], r: int) -> DataFrame:
    """All values at ``r`` bits from those of a query's first ``need`` segments: ``(..., s, key)``."""
    own = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(w).alias("w"), _value("q", f, w).alias("v")) for s, (f, w) in enumerate(segments)])
    out = queries.withColumn("g", F.explode(F.slice(own, F.lit(1), F.col("need")))).select("query_id", "q", F.col("g.s").alias("s"), F.col("g.w").alias("w"), F.col("g.v").alias("v"), F.lit(-1).alias("last"))
    for i in range(r):  # bits to flip, in ascending order
        out = out.withColumn("p", F.explode(F.sequence(F.col("last") + 1, F.col("w") - (r - i))))
        out = out.select("query_id", "q", "s", "w", F.col("v").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p"))).alias("v"), F.col("p").alias("last"))
    return out.select("query_id", "q", "s", (F.col("s").cast("long") * (1 << _KEY) + F.col("v")).alias("key"))


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, cell: int = CELL) -> DataFrame:
    """``(query_id, rank, vec_id, distance)``: the k nearest codes of every query.

    ``codes`` and ``queries`` are ``(vec_id, code)``. The index is small against the vectors it
    stands for: a code, its segment keys, at most k + 1 ids.
    """
    smallest = Window.partitionBy("code").orderBy("vec_id")
    ids = codes.distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    index = materialize(ids.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "codes")
    n, n_ids = index.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    segments = layout(n)
    m = len(segments)
    keys = F.array(*[F.lit(s << _KEY) + _value("code", f, w) for s, (f, w) in enumerate(segments)])
    keyed = index.select("code", "ids", F.explode(keys).alias("key"))
    # buckets above the bound: fewer than codes * segments / cell
    crowded = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell).select("key", F.ceil(F.col("n") / F.lit(cell)).cast("int").alias("parts")), "crowded")
    keyed = keyed.join(crowded, "key", "left").select("code", "ids", "key", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("code"), F.col("parts"))).otherwise(0).cast("int").alias("part"))
    keyed = materialize(keyed, "code-index")
    asked = materialize(queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).distinct(), "queries")
    open_, best, done, r = asked.withColumn("need", F.lit(m)), None, [], 0
    order = Window.partitionBy("query_id").orderBy("distance", F.get("ids", 0), "code")
    while True:
        probes = _probes(open_, segments, r).join(crowded, "key", "left")
        probes = probes.select("query_id", "q", "s", "key", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        met = probes.join(keyed.hint("merge"), ["key", "part"])  # Spark takes exploded probes for as small as their queries
        apart = F.col("q").bitwiseXOR(F.col("code"))
        met = met.withColumn("x", apart)
        first = reduce(lambda a, b: a & b, [F.bit_count(_value("x", f, w)) >= r + (F.col("s") > s).cast("int") for s, (f, w) in enumerate(segments)])
        new = met.where(first).select("query_id", "q", F.bit_count("x").cast("int").alias("distance"), "code", "ids")
        merged = new if best is None else new.unionByName(best.select(*new.columns))
        ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
        others = F.size("ids") - F.array_contains("ids", F.col("query_id")).cast("int")
        ranked = ranked.withColumn("others", F.sum(others).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        best = materialize(ranked, "nearest")
        state = best.groupBy("query_id").agg(F.min(F.when(F.col("others") >= k, F.col("distance"))).alias("kth"), F.max("others").alias("found"))
        # probed are r bits in the first ``need`` segments and r - 1 in the others
        proved = F.coalesce(F.col("kth") < m * r + F.col("need"), F.lit(False)) | (F.coalesce("found", F.lit(0)) >= min(n_ids - 1, 1 << 30)) | F.lit(r >= max(w for _, w in segments))
        left = open_.join(state, "query_id", "left").select("query_id", "q", proved.alias("proved"), F.least(F.lit(m), F.greatest(F.lit(1), F.coalesce(F.col("kth") + 1 - m * (r + 1), F.lit(m)))).cast("int").alias("next"))
        left = materialize(left, "open")
        done.append(best.join(left.where("proved").select("query_id"), "query_id", "left_semi"))
        open_ = left.where("not proved").select("query_id", "q", F.col("next").alias("need"))
        if open_.isEmpty():
            break
        best, r = best.join(open_.select("query_id"), "query_id", "left_semi"), r + 1
    out = reduce(lambda a, b: a.unionByName(b), done).select("query_id", "distance", F.explode("ids").alias("vec_id")).where("query_id <> vec_id")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "distance")


def nearest_codes(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``, among all rows."""
    codes = materialize(binary_codes(embeddings), "bits")
    return top_k(codes, codes.where(F.col("vec_id") % every == 0), k)

"""Connected components over a link table, without a driver-side or single-task union-find.

Alternating large-star / small-star contraction (Kiveris et al., "Connected Components in
MapReduce and Beyond"). Every round is a map-side combined minimum plus an equi-join; links are
first contracted inside each partition, so the table that travels is a forest, not the raw pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes, given links ``a[i] - b[i]``."""
    label = np.arange(n, dtype=np.int64)
    if not len(a):
        return label
    while True:
        before = label.copy()
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            return label


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, smallest node) that join what the given links join."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = min_labels(len(ids), at[: len(a)], at[len(a) :])
    own = label != np.arange(len(ids))
    return ids[own], ids[label[own]]


def _contract(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in it:
        held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        size += batch.num_rows
        if size > max(1 << 20, 2 * len(a)):
            a, b = forest(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]))
            held, size = [], 0
    a, b = forest(np.concatenate([a, *(x for x, _ in held)]), np.concatenate([b, *(y for _, y in held)]))
    for i in range(0, len(a), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(a[i : i + (1 << 16)]), pa.array(b[i : i + (1 << 16)])], ["hi", "lo"])


HUBS = 128


def _with_min(rows: DataFrame, low: DataFrame, key: str, n: int) -> DataFrame:
    """``rows`` with the minimum ``m`` of their key; ``low``: key, m, n (rows of the key).

    Keys of more than one in ``HUBS`` of the ``n`` rows are ``HUBS`` at most: they are broadcast under that
    bound, so no task gathers a hub's links. The others are joined by key.
    """
    low = materialize(low, "minima")
    hubs = F.broadcast(low.where(F.col("n") > n // HUBS).select(key, "m"))
    rest = rows.join(F.broadcast(low.where(F.col("n") > n // HUBS).select(key)), key, "left_anti")
    return rows.join(hubs, key).unionByName(rest.join(low.where(F.col("n") <= n // HUBS).select(key, "m"), key))


def _large_star(e: DataFrame, n: int) -> DataFrame:
    sym = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    low = sym.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_min(sym.where("v > u"), low, "u", 2 * n).where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(e: DataFrame, n: int) -> DataFrame:
    low = e.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = _with_min(e, low, "hi", n).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link; component is the smallest node reachable.

    ``links`` holds integer ids in columns ``a`` and ``b``; null ids, self-links and repeats are
    ignored, the direction is too. An empty table gives an empty result.
    """
    e = links.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = materialize(e.mapInArrow(_contract, "hi long, lo long"), "links")
    state = _state(e)
    while state[0]:
        grown = materialize(_large_star(e, state[0]), "large-stars")
        e = materialize(_small_star(grown, grown.count()), "stars")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())

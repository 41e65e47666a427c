"""SimHash near-duplicates, linked by BK-trees.

The method's trees are sharded by the pigeonhole rule: of ``b`` segments of a 64-bit fingerprint a
difference of at most ``radius`` bits leaves ``b - radius`` whole, so a shard holds the distinct
fingerprints of one choice of so many segments and their values, and a fingerprint queries only its
own shards, one per choice. Their keys are 16 bits wide (4 choices) for up to 4 million fingerprints,
24 or more (10 choices) up to some billions, 30 or more (20 choices) beyond (``blocks``), so that
shards stay small as the table grows. Each shard is a BK-tree (children keyed by the integer Hamming distance to
the parent) and a query follows only the edges within the radius of its own distance.

The trees are not sent to every executor: they hold the fingerprints of the whole corpus, so a
broadcast has no size bound. The queries travel to their tree's task instead. A shard above
``SHARD`` fingerprints is cut into pieces and every pair of pieces becomes a cell of its own, so no
task's tree or query set grows with the hottest shard. The crowded shards, at most one in ``SHARD``
of the table's keys, are counted first and joined.

Defined results: null text counts as empty; no words gives fingerprint zero, linked like any
other; repeated rows each get their row; a null ``doc_id`` gets its fingerprint, is no link's end
and has a null component; an empty table gives an empty result. Only ``doc_id`` and ``text`` are
read, so extra columns of any name do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, materialize, ship, text_or_empty
from grainmill.llm.components import connected_components, forest

SEED, WORDS, RADIUS, SHARD = 42, 3, 3, 4096
#: Queries searched at once; bounds the frontier to this many times the tree's size.
_AT_ONCE = 256


def fingerprint(text: str, words: int = WORDS) -> int:
    """64-bit SimHash of the text's word shingles; bit i is set if it is in over half the hashes."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    h = _hashes(w, words)
    return int(_vote(np.array(h, np.uint64)))


def _hashes(w: list[bytes], words: int) -> list[int]:
    if len(w) < words:
        return [xxhash.xxh64_intdigest(b" ".join(w), SEED)]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return [digest(join(s), SEED) for s in zip(*(w[i:] for i in range(words)))]


def _vote(h: np.ndarray) -> np.uint64:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0]


def _fingerprints(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        out = np.zeros(b.num_rows, np.int64)
        for i, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
            w = t.lower().split()
            if w:
                out[i] = _vote(np.array(_hashes(w, WORDS), np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["doc_id", "fp"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``: one row per document, the fingerprint as a signed 64-bit integer."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long")


class Forest:
    """BK-trees over fingerprints, one tree per group, built and searched a level at a time."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.fp = fp.astype(np.uint64)
        n = len(fp)
        self.parent, self.edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        groups, key = np.unique(group, return_inverse=True)
        self.groups, self.roots = groups, np.zeros(len(groups), np.int64)
        alive, from_root = np.arange(n), True
        while len(alive):
            order = np.argsort(key, kind="stable")
            alive, key = alive[order], key[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            node = alive[first][np.cumsum(first) - 1]
            if from_root:
                self.roots[key[first]] = alive[first]
            else:
                self.parent[alive[first]], self.edge[alive[first]] = key[first] // 65, key[first] % 65
            rest = ~first
            alive, node = alive[rest], node[rest]
            key = node * 65 + np.bitwise_count(self.fp[alive] ^ self.fp[node]).astype(np.int64)
            from_root = False
        child = np.flatnonzero(self.parent >= 0)
        keys = self.parent[child] * 65 + self.edge[child]
        order = np.argsort(keys)
        self.child, self.keys = child[order], keys[order]

    def search(self, group: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query index, tree index) within the radius, each query in its own group's tree."""
        fp = fp.astype(np.uint64)
        at = np.searchsorted(self.groups, group)
        known = (at < len(self.groups)) & (self.groups[np.minimum(at, max(len(self.groups) - 1, 0))] == group) if len(self.groups) else np.zeros(len(group), bool)
        todo = np.flatnonzero(known)
        for i in range(0, len(todo), _AT_ONCE):
            q = todo[i : i + _AT_ONCE]
            node = self.roots[at[q]]
            while len(q):
                d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
                hit = d <= radius
                if hit.any():
                    yield q[hit], node[hit]
                lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
                n = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right") - lo
                has = n > 0
                q, lo, n = q[has], lo[has], n[has]
                node = self.child[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(n) else n
                q = np.repeat(q, n)


def cell_links(cell: np.ndarray, tree: np.ndarray, asks: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of each cell: some are its tree, some (or the same) its queries."""
    f = Forest(cell[tree], fp[tree])
    t_fp, t_node = fp[tree], node[tree]
    cell, fp, node = cell[asks], fp[asks], node[asks]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = 0
    for q, t in f.search(cell, fp, radius):
        own = fp[q] != t_fp[t]
        a.append(node[q[own]])
        b.append(t_node[t[own]])
        held += int(own.sum())
        if held > 1 << 20:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0
    return forest(np.concatenate(a), np.concatenate(b))


def _cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (shard, first and second piece); whole cells are searched, a few thousand rows at a time."""
    held: list[list[np.ndarray]] = []

    def flush(cols: list[np.ndarray]) -> pa.RecordBatch:
        shard, home, other, part, fp, node = cols
        a, b = cell_links(np.cumsum(_new(cols)), part == home, part == other, fp, node, RADIUS)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    size = 0
    for batch in it:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        held.append(cols)
        size += batch.num_rows
        if size >= 4 * SHARD:
            cols = [np.concatenate(x) for x in zip(*held)]
            cut = int(np.flatnonzero(_new(cols))[-1])
            if cut:
                yield flush([x[:cut] for x in cols])
                cols = [x[cut:] for x in cols]
            held, size = [cols], len(cols[0])
    if held and size:
        yield flush([np.concatenate(x) for x in zip(*held)])


def _new(cols: list[np.ndarray]) -> np.ndarray:
    """Where a cell begins."""
    out = np.ones(len(cols[0]), bool)
    out[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    return out


def blocks(n: int) -> int:
    """Segments of a fingerprint for a table of n: four, five or six."""
    return 4 if n <= 1 << 22 else 5 if n <= 1 << 32 else 6


def _shards(n_blocks: int, radius: int) -> Column:
    """A fingerprint's shard keys: every choice of ``n_blocks - radius`` segments, with their values."""
    widths = [64 // n_blocks + (i < 64 % n_blocks) for i in range(n_blocks)]
    value = [F.shiftrightunsigned("fp", sum(widths[:i])).bitwiseAND(F.lit((1 << w) - 1)) for i, w in enumerate(widths)]
    keys = []
    for k, chosen in enumerate(combinations(range(n_blocks), n_blocks - radius)):
        key = F.lit(k).cast("long")
        for i in chosen:
            key = key * (1 << widths[i]) + value[i]
        keys.append(key)
    return F.explode(F.array(*keys))


def fingerprint_links(fps: DataFrame, shard: int = SHARD, radius: int = RADIUS, n_blocks: int | None = None) -> DataFrame:
    """Star links ``(a, b)`` that join all ``(fp, node)`` whose fingerprints differ in <= 3 bits.

    ``fps`` has one row per distinct fingerprint.
    """
    if radius != RADIUS:
        raise ValueError("the shards are laid out for a radius of 3")
    rows = fps.select("fp", "node", _shards(n_blocks or blocks(fps.count()), radius).alias("shard"))
    crowded = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard).select("shard", F.ceil(F.col("n") / F.lit(shard)).cast("int").alias("parts"))
    cut = rows.join(materialize(crowded, "crowded-shards"), "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = cut.select("shard", F.least("part", "piece").alias("home"), F.greatest("part", "piece").alias("other"), "part", "fp", "node")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "shard", "home", "other").sortWithinPartitions("shard", "home", "other").mapInArrow(_cells, "a long, b long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every document row."""
    docs_fp = materialize(with_fingerprints(docs), "simhash")
    # one row per distinct fingerprint; partial minima leave the scan, so a hot text is one row a task
    distinct = materialize(docs_fp.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct-fp")
    comp = connected_components(fingerprint_links(distinct))
    moved = comp.where("node <> component")
    label = materialize(distinct.join(moved, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")), "fp-component")
    out = docs_fp.join(label, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each component the row of its smallest doc_id.

    Rows without a doc_id have no component and stay. Columns are those of the input.
    """
    gone = simhash_components(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")

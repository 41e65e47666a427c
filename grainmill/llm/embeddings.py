"""Near-duplicate embeddings by spherical-cap filters with structured product codes.

A filter is a unit direction and holds the vectors whose projection on it exceeds a height: a
spherical cap. The directions form a random product code: the rotated space is split into a few
blocks, each with a small codebook, and every combination of codewords is a direction. A vector is
list-decoded to all its filters by extending codeword prefixes only while the remaining blocks can
still reach the height, so the cost follows the number of filters found, not the number there are.
Vectors that share a filter are compared; every link that is reported was verified in double
precision. Height and number of filters follow the number of vectors n: a filter expects ``BUCKET``
random vectors and a vector expects ``FILTERS`` filters, at which two vectors of cosine 0.9 share
none with a chance below one in a hundred, and closer ones practically never.

Exact copies are grouped first and stand as one weighted vector. A filter of more than ``CELL``
vectors is cut into pieces and every pair of pieces is a cell, compared by one matrix product, so no
task's work grows with the hottest filter. A pair that shares several filters counts in the
smallest only (a vector goes to a filter with those before it). Cells hand on link counts per vector and a spanning forest of their links, never the
pairs themselves.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link
with nothing, nor do rows without a ``vec_id`` (their component is null); vectors link only with
those of their own dimension; repeated rows count as further vectors, also different vectors of one
``vec_id``, each of which gets its own counts; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, ship
from grainmill.llm.components import connected_components, forest

COSINE, TABLES, FILTERS, FLOOR, BUCKET, CELL, BOOK = 0.9, 2, 8.0, 8, 16.0, 1024, 256
_SHIFT = 1 << 20


class CapCode:
    """The filters of one dimension: ``TABLES`` independent product codes."""

    def __init__(self, dim: int, n: int, seed: int = 42):
        q = min(BUCKET / max(n, 2), 0.02)
        filters = FILTERS / q
        self.dim = dim
        self.parts = min(dim, max(1, math.ceil(math.log(filters) / math.log(BOOK))))
        self.book = math.ceil(filters ** (1 / self.parts))
        self.height = NormalDist().inv_cdf(1 - q) / math.sqrt(dim)
        self.cuts = np.array_split(np.arange(dim), self.parts)
        self.tables = []
        for k in range(TABLES):
            rng = np.random.default_rng([seed, dim, k])
            turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            words = [rng.standard_normal((self.book, len(c))) for c in self.cuts]
            self.tables.append((turn, [w / np.linalg.norm(w, axis=1, keepdims=True) * math.sqrt(len(c) / dim) for w, c in zip(words, self.cuts)]))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, filter)`` of every cap that holds a row, ``FLOOR`` at least in each table."""
        rows, codes = [], []
        for k, (turn, words) in enumerate(self.tables):
            x = unit @ turn
            scores = [x[:, c] @ w.T for c, w in zip(self.cuts, words)]
            todo, height = np.arange(len(x)), self.height
            while len(todo):
                row, code = self._above([s[todo] for s in scores], height)
                n = np.bincount(row, minlength=len(todo))
                enough = (n >= FLOOR) | (height < -1.5) | (n == self.book**self.parts)
                ok = enough[row]
                rows.append(todo[row[ok]])
                codes.append(code[ok] + k * self.book**self.parts)
                todo, height = todo[~enough], height - 0.1 / math.sqrt(self.dim)
        return np.concatenate(rows), np.concatenate(codes)

    def _above(self, scores: list[np.ndarray], height: float) -> tuple[np.ndarray, np.ndarray]:
        n = len(scores[0])
        reach = np.zeros((n, self.parts + 1))
        for k in range(self.parts - 1, -1, -1):
            reach[:, k] = reach[:, k + 1] + scores[k].max(axis=1)
        row, code, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        for k, s in enumerate(scores):
            t = total[:, None] + s[row]
            at, word = np.nonzero(t >= (height - reach[row, k + 1])[:, None])
            row, code, total = row[at], code[at] * self.book + word, t[at, word]
        return row, code


_CODES: dict[tuple[int, int], CapCode] = {}


def _code(dim: int, n: int) -> CapCode:
    if (dim, n) not in _CODES:
        _CODES.clear()
        _CODES[dim, n] = CapCode(dim, n)
    return _CODES[dim, n]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of tiny and huge values finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(b: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` of each dimension in the batch."""
    col = b.column(b.schema.get_field_index(name))
    size = col.value_lengths().to_numpy(zero_copy_only=False)
    flat, start = col.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)[:-1]])
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, flat[start[rows][:, None] + np.arange(d)]


def _filters(n: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(0, batch.num_rows, 2048):
                b = batch.slice(i, 2048)
                for rows, x in _vectors(b, "embedding"):
                    dim = x.shape[1]
                    at, code = _code(dim, n).decode(_unit(x))
                    code = code * _SHIFT + dim
                    order = np.lexsort((code, at))
                    at, code = at[order], code[order]
                    ends = np.searchsorted(at, np.arange(len(rows) + 1)).astype(np.int32)
                    sub = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([sub.column(0), sub.column(1), sub.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array(code))], ["node", "weight", "embedding", "filters"])

    return run


def _compare(cell: tuple, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one cell: ``(node, links found)`` and a forest of the links."""
    f, first, second = cell
    part = b.column(b.schema.get_field_index("part")).to_numpy(zero_copy_only=False)
    node = b.column(b.schema.get_field_index("node")).to_numpy(zero_copy_only=False)
    weight = b.column(b.schema.get_field_index("weight")).to_numpy(zero_copy_only=False)
    _, x = next(_vectors(b, "embedding"))
    unit = _unit(x)
    lists = b.column(b.schema.get_field_index("filters"))
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    owner, filt = np.repeat(np.arange(len(node)), size), lists.flatten().to_numpy(zero_copy_only=False)
    lower = filt < f
    names, col = np.unique(filt[lower], return_inverse=True)
    shared = np.bincount(col, minlength=len(names)) > 1
    place = np.cumsum(shared) - 1
    mark = np.zeros((len(node), int(shared.sum())), np.float32)
    some = shared[col]
    mark[owner[lower][some], place[col[some]]] = 1
    i, j = np.flatnonzero(part == first), np.flatnonzero(part == second)
    found = np.zeros(len(node), np.int64)
    a, c = [], []
    for k in range(0, len(i), 512):
        rows = i[k : k + 512]
        near = unit[rows] @ unit[j].T >= COSINE
        if mark.shape[1] and near.any():
            near &= mark[rows] @ mark[j].T < 0.5
        near &= (node[rows][:, None] < node[j]) if first == second else (node[rows][:, None] != node[j])
        p, q = np.nonzero(near)
        np.add.at(found, rows[p], weight[j[q]])
        np.add.at(found, j[q], weight[rows[p]])
        x1, y1 = forest(node[rows[p]], node[j[q]])
        a.append(x1)
        c.append(y1)
    hit = found > 0
    return node[hit], found[hit], *forest(np.concatenate(a or [np.zeros(0, np.int64)]), np.concatenate(c or [np.zeros(0, np.int64)]))


def _cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell; each cell, at most two pieces, is gathered and compared."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None

    def flush() -> Iterator[pa.RecordBatch]:
        b = pa.Table.from_batches(held).combine_chunks().to_batches()
        node, found, hi, lo = _compare(now, b[0])
        if len(node):
            kind = np.concatenate([np.zeros(len(node), np.int32), np.ones(len(hi), np.int32)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([node, hi])), pa.array(np.concatenate([found, lo]))], ["kind", "a", "b"])

    for batch in it:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)])
        cuts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if e == s:
                continue
            key = tuple(keys[:, s].tolist())
            if key != now:
                if held and sum(x.num_rows for x in held) > 1:
                    yield from flush()
                held, now = [], key
            held.append(batch.slice(s, e - s))
    if held and sum(x.num_rows for x in held) > 1:
        yield from flush()


def usable(col: str = "embedding"):
    """Whether a vector has a direction: present, finite throughout and not zero."""
    c = F.col(col)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    spark = embeddings.sparkSession
    ship(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(embeddings.dtypes)["embedding"]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    good = rows.where(usable() & F.col("vec_id").isNotNull())
    groups = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    # the table is written with its node numbers: different vectors of one vec_id stay apart
    nodes = materialize(groups.select(F.monotonically_increasing_id().alias("node"), "least", "weight", F.xxhash64("embedding").alias("hash"), "embedding"), "vectors")
    n, n_rows = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    coded = materialize(nodes.select("node", "weight", "embedding").mapInArrow(_filters(n), f"node long, weight long, embedding {kind}, filters array<long>"), "caps")
    spread = coded.select("node", F.explode("filters").alias("filter"))
    # filters of one vector need no comparison; of the others, how many pieces: one unless it is crowded
    sizes = materialize(spread.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("filter", F.ceil(F.col("n") / F.lit(CELL)).cast("int").alias("parts")), "cap-sizes")
    # a row carries the filters before its own only: those in which a pair would count first
    dealt = coded.select("node", "weight", "embedding", F.posexplode("filters").alias("at", "filter"), "filters").select("node", "weight", "embedding", "filter", F.slice("filters", F.lit(1), F.col("at")).alias("filters")).join(sizes, "filter")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("filter", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "node", "weight", "embedding", "filters")
    dealt = dealt.repartition(n_parts, "filter", "first", "second").sortWithinPartitions("filter", "first", "second")
    found = materialize(dealt.mapInArrow(_cells, "kind int, a long, b long"), "cap-links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    comp = connected_components(found.where("kind = 1").select("a", "b"))
    named = nodes.select("node", "least", "weight", "hash").join(counts, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.select("node", "least", "weight", "hash", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component").where("n_links > 0")
    label = materialize(named, "labels")
    smallest = label.groupBy("component").agg(F.min("least").alias("component_id"))
    label = materialize(label.join(smallest, "component").select("node", "weight", "hash", "n_links", "component_id"), "labelled")
    return _on_rows(rows, nodes, label, n_rows)


def _on_rows(rows: DataFrame, nodes: DataFrame, label: DataFrame, n_rows: int) -> DataFrame:
    """Every row's result: labels joined by the vector's hash.

    Vectors whose hash another one shares are told apart by the whole vector. Groups of more than a
    thousandth of the rows, a thousand at most, are broadcast under that bound: no task gathers one.
    """
    shared = nodes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    apart = nodes.join(shared, "hash", "left_semi").select("node", "embedding").join(label, "node").select(F.col("embedding").alias("__e"), "hash", "n_links", "component_id")
    alone = label.join(shared, "hash", "left_anti")
    keep = ("hash", "n_links", "component_id")
    hot = alone.where(F.col("weight") > n_rows // 1000)
    keyed = rows.where(usable() & F.col("vec_id").isNotNull()).withColumn("hash", F.xxhash64("embedding"))
    none = rows.where(~(usable() & F.col("vec_id").isNotNull()))
    rest = keyed.join(F.broadcast(hot.select("hash")), "hash", "left_anti")
    twins = rest.join(shared, "hash", "left_semi")
    cold = rest.select("vec_id", "hash").join(shared, "hash", "left_anti").join(alone.where(F.col("weight") <= n_rows // 1000).select(*keep), "hash", "left")
    parts = [
        keyed.join(F.broadcast(hot.select(*keep)), "hash").select("vec_id", "n_links", "component_id"),
        cold.select("vec_id", "n_links", "component_id"),
        twins.join(apart.withColumnRenamed("hash", "__h"), (F.col("hash") == F.col("__h")) & (F.col("embedding") == F.col("__e")), "left").select("vec_id", "n_links", "component_id"),
        none.select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))

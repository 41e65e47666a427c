"""Best-fit sequence packing with a linear grouping scheme.

Every document is tokenised, ended with an id and, only if it is longer than the capacity, cut into
pieces of the capacity. What the packing needs to know of a corpus is the histogram of piece
lengths: at most ``CAPACITY`` counts, whatever the corpus holds. On that histogram the driver plans

1. linear grouping: lengths above a third (and, as a second plan, an eighth) of the capacity are sorted and dealt into ``GROUPS`` groups of
   (nearly) equal cardinality, each rounded up to its largest length;
2. configurations: the few rounded sizes form a cutting-stock problem, solved by column generation
   (simplex over patterns, knapsack pricing), its solution rounded down;
3. substitution: actual lengths take the places of the rounded ones, longest first, so places
   leave real gaps;
4. best fit: what rounding left over and all small pieces go, longest first, each into the fullest
   sequence that still holds it.

The plan with the fewer sequences is taken. It is run-length coded: "ranks a..b of length L, m per sequence, from sequence s, at offset
o". Its size depends on the number of distinct lengths, not on the number of documents, so it is
broadcast under that bound. A piece finds its place by its rank among the pieces of its length;
ranks are counted in hashed chunks (rank in the chunk plus what earlier chunks hold), so no task
sees all pieces of a popular length.

Defined results: null text counts as empty and is one piece, the end id alone; repeated rows are
packed once each; a null ``doc_id`` is packed too; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.common import gathered, materialize, ship, text_or_empty
from grainmill.llm.tokens import BATCH, default_tokenizer, encoder

CAPACITY, END, LARGE, GROUPS, CHUNK = 4096, 1, (3, 8), 32, 8192

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document; ``with_ids`` adds the ids themselves."""
    ship(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    schema = _PIECES + (", ids array<int>" if with_ids else "")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        tail = np.array([end], "<u4").tobytes()
        for b in gathered(it, BATCH):
            rows, ids = [], []
            for doc, data in zip(b.column(0).to_pylist(), enc.encode(b.column(1).cast(pa.binary()).to_pylist())):
                wide = np.frombuffer(data, "<u2").astype("<u4").tobytes() + tail
                for k, at in enumerate(range(0, len(wide), 4 * capacity)):
                    part = wide[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(cut, schema)


def _best_pattern(sizes: list[int], values: np.ndarray, most: list[int], capacity: int) -> tuple[float, list[int]]:
    """Bounded knapsack: the pattern of largest value that fits."""
    best = np.zeros(capacity + 1)
    took = []
    for size, value, limit in zip(sizes, values, most):
        n = np.zeros(capacity + 1, np.int16)
        if value > 1e-12:
            new = best.copy()
            for k in range(1, min(limit, capacity // size) + 1):
                cand = best[: capacity + 1 - k * size] + k * value
                better = cand > new[k * size :] + 1e-12
                new[k * size :][better] = cand[better]
                n[k * size :][better] = k
            best = new
        took.append(n)
    at, pattern = int(np.argmax(best)), [0] * len(sizes)
    top = float(best[at])
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = int(took[i][at])
        at -= pattern[i] * sizes[i]
    return top, pattern


def configurations(sizes: list[int], counts: list[int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """``(times, pattern)`` of the fractional cutting-stock optimum, rounded down."""
    g = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    demand, most = np.array(counts, float), [min(c, capacity // s) for s, c in zip(sizes, counts)]
    for _ in range(40 * g):
        duals = np.linalg.solve(basis.T, np.ones(g))
        value, pattern = _best_pattern(sizes, duals, most, capacity)
        if value <= 1 + 1e-7:
            break
        x, u = np.linalg.solve(basis, demand), np.linalg.solve(basis, np.array(pattern, float))
        ratio = np.where(u > 1e-9, np.maximum(x, 0) / np.where(u > 1e-9, u, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    x = np.linalg.solve(basis, demand)
    return [(int(n + 1e-6), [int(v) for v in basis[:, i]]) for i, n in enumerate(x) if n + 1e-6 >= 1]


class Plan:
    """Places for a histogram of lengths; ``intervals[L]`` is ``[(rank, sequence, per, offset)]``."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: int = 3):
        self.capacity, self.sequences = capacity, 0
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.intervals: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in self.left}
        self.open: dict[int, list[tuple[int, int]]] = {}  # gap: [(first sequence, how many)]
        self.gaps: list[int] = []
        if self.left.get(capacity):
            self._take(capacity, self.left[capacity], self._sequences(self.left[capacity]), 1, 0)
        self._grouped(sorted((n for n in self.left if capacity / large < n < capacity), reverse=True), groups)
        for n in sorted(self.left, reverse=True):
            self._fit(n)

    def _sequences(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _take(self, length: int, n: int, sequence: int, per: int, offset: int) -> None:
        self.intervals[length].append((self.used[length], sequence, per, offset))
        self.used[length] += n
        self.left[length] -= n

    def _leave(self, gap: int, sequence: int, n: int) -> None:
        if n and gap:
            if gap not in self.open:
                self.open[gap] = []
            if not self.open[gap]:
                insort(self.gaps, gap)
            self.open[gap].append((sequence, n))

    def _grouped(self, lengths: list[int], groups: int) -> None:
        total = sum(self.left[n] for n in lengths)
        if not total:
            return
        dealt: dict[int, list[int]] = {}
        at = 0
        for n in lengths:
            dealt.setdefault(min(groups - 1, (at + self.left[n] // 2) * groups // total), []).append(n)
            at += self.left[n]
        members = list(dealt.values())
        plan = configurations([m[0] for m in members], [sum(self.left[n] for n in m) for m in members], self.capacity)
        for times, pattern in sorted(plan, reverse=True):
            slots = [self._supply(members[g], times * k, times) for g, k in enumerate(pattern) if k]
            runs = [r for s in slots for r in s]
            first = self._sequences(times)
            cuts = sorted({0, times, *(x for r in runs for _, a, b in r for x in (a, b))})
            for a, b in zip(cuts, cuts[1:]):
                offset = 0
                for r in runs:
                    for length, x, y in r:
                        if x <= a and b <= y:
                            self._take(length, b - a, first + a, 1, offset)
                            offset += length
                self._leave(self.capacity - offset, first + a, b - a)

    def _supply(self, lengths: list[int], wanted: int, times: int) -> list[list[tuple[int, int, int]]]:
        """The group's next items, longest first, as runs ``(length, from, to)`` over each place."""
        items, at = [], 0
        for n in lengths:
            take = min(self.left[n], wanted - at)
            if take > 0:
                items.append((n, at, at + take))
                at += take
        places = [[(n, max(a, k) - k, min(b, k + times) - k) for n, a, b in items if a < k + times and b > k] for k in range(0, wanted, times)]
        return places

    def _fit(self, length: int) -> None:
        while self.left[length]:
            i = bisect_left(self.gaps, length)
            if i == len(self.gaps):
                per = self.capacity // length
                n = -(-self.left[length] // per)
                self._leave(self.capacity, self._sequences(n), n)
                continue
            gap = self.gaps[i]
            sequence, n = self.open[gap].pop()
            if not self.open[gap]:
                del self.gaps[i]
            per = gap // length
            full = min(n, self.left[length] // per)
            if full:
                self._take(length, full * per, sequence, per, self.capacity - gap)
                self._leave(gap - per * length, sequence, full)
                sequence, n = sequence + full, n - full
            rest = min(self.left[length], per)
            if n and rest < per and rest:
                self._take(length, rest, sequence, rest, self.capacity - gap)
                self._leave(gap - rest * length, sequence, 1)
                sequence, n = sequence + 1, n - 1
            self._leave(gap, sequence, n)

    def table(self) -> tuple[np.ndarray, ...]:
        """Sorted by (length, rank): key, rank, sequence, per sequence, offset."""
        rows = sorted((n, *x) for n, xs in self.intervals.items() for x in xs)
        cols = np.array(rows, np.int64).reshape(-1, 5).T
        return (cols[0] << 44) + cols[1], cols[1], cols[2], cols[3], cols[4]


def place(pieces: DataFrame, capacity: int = CAPACITY, chunk: int = CHUNK) -> DataFrame:
    """``pieces`` (materialised, with ``doc_id, piece, length, ids_crc32``) and their places."""
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    plan = min((Plan(histogram, capacity, large=x) for x in LARGE), key=lambda p: p.sequences)
    shared = spark.sparkContext.broadcast(plan.table())  # run-length coded: bounded by the distinct lengths
    chunks = max(1, sum(histogram.values()) // chunk)
    rows = pieces.withColumn("__chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("__chunk", "length").agg(F.count(F.lit(1)).alias("n")).select("__chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__chunk", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("__rank", F.row_number().over(inside) - 1).join(base, ["__chunk", "length"]).withColumn("__rank", F.col("__rank") + F.col("__base"))
    ranked = ranked.select(*pieces.columns, F.col("__rank").cast("long").alias("__rank"))

    def look_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, per, offset = shared.value
        for b in it:
            if b.num_rows:
                length = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
                rank = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
                i = np.searchsorted(key, (length << 44) + rank, side="right") - 1
                k = rank - first[i]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence[i] + k // per[i]), pa.array(offset[i] + k % per[i] * length)], [*b.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(look_up, schema)


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 4096 ids."""
    return place(materialize(token_pieces(docs, tokenizer), "pieces"))


def packed_ids(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, each at most the capacity long."""
    placed = place(materialize(token_pieces(docs, tokenizer, with_ids=True), "pieces"))
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))

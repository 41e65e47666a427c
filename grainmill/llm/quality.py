"""Quality classifier learned from positives and unlabelled text (non-negative PU risk).

Trusted positives are the training rows with ``quality = 1``; every training document, whatever
its label, is the unlabelled sample; labels of 0 are never used. With prior ``pi``, margin ``g`` and
logistic loss ``l`` the risk is

    R(g) = pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

which a linear margin over dense text statistics minimises by Newton steps on the whole table:
each step is one distributed sum of a gradient and a Hessian of fixed size, so nothing is sampled
and only that many numbers reach the driver. Where the second part of the risk has gone negative
its gradient is dropped, as the clip asks. The prior is estimated from the data: a first fit with a
neutral prior orders the documents, and ``U(A) / P(A)`` is smallest for the ranges ``A`` of that
order that hold positives only, where it equals the prior.

The score is the modelled posterior of label 1, in 0..1. Labels, lang, source and doc_id are no
inputs of it. Defined results: null text counts as empty and an empty text gets a score too; a
null ``doc_id`` is scored and not learned from; a document with several label rows is a positive
if one of them is 1; without any positive every score is 1, so nothing is rejected; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, materialize, ship, text_or_empty

THRESHOLD, STEPS, RIDGE, BINS = 0.7, 12, 1e-3, 400

_CLASS = np.full(256, 1)
for _c in range(256):
    ch = chr(_c)
    if _c >= 128 or "a" <= ch <= "z":
        _CLASS[_c] = 0
    elif "A" <= ch <= "Z":
        _CLASS[_c] = 2
    elif ch.isdigit():
        _CLASS[_c] = 3
    elif ch == "\n":
        _CLASS[_c] = 4
    elif ch in " \t\r\x0b\x0c":
        _CLASS[_c] = 5
    elif ch in ".,;:'\"()-?":
        _CLASS[_c] = 6
    elif ch == "!":
        _CLASS[_c] = 7
_MARKS = re.compile(rb"[^\w\s\x80-\xff.,;:'\"()?-]{2,}")
_ENDS = (b".", b"!", b"?")


def features(text: bytes) -> list[float]:
    """Dense statistics of a whole text: character classes, words, lines, repetition."""
    n = len(text)
    count = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=8)
    letters = count[0] + count[2]
    words = text.split()
    w = len(words)
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    seen = Counter(words)
    top = seen.most_common(1)[0][1] if w else 0
    dup_chars = sum(map(len, lines)) - sum(map(len, set(lines)))
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    pipes, marks = text.count(b"|"), len(_MARKS.findall(text))
    share = count / max(n, 1)
    upper = count[2] / max(letters, 1)
    per_word = 1 / max(w, 1)
    ended = sum(x.endswith(_ENDS) for x in lines) / max(len(lines), 1)
    short = sum(len(x) <= 3 for x in words) * per_word
    f = [
        1.0, np.log1p(n) / 10, np.log1p(w) / 10, (np.log1p(w) / 10) ** 2,
        share[1], share[3], share[6], share[7], share[4],
        np.sqrt(share[1]), np.sqrt(share[3]), np.sqrt(share[7]), upper, np.sqrt(upper),
        n * per_word / 10 if w else 0.0, len(seen) * per_word, np.log1p(len(seen)) / np.log1p(max(w, 1)), top * per_word, np.sqrt(top * per_word),
        adjacent * per_word, np.sqrt(adjacent * per_word), dup_chars / max(n, 1), np.sqrt(dup_chars / max(n, 1)),
        min(pipes * per_word, 1.0), min(np.sqrt(pipes * per_word), 1.0), min(marks * per_word, 1.0), min(np.sqrt(marks * per_word), 1.0),
        ended, short, letters / max(n, 1), float(w < 3), float(w < 10), float(w == 0),
        min(1.0, 20 * upper), min(1.0, 20 * marks * per_word), min(1.0, 20 * pipes * per_word), min(1.0, 20 * share[1]), min(1.0, 20 * adjacent * per_word),
    ]
    return f


DIMS = len(features(b""))


def _featurise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        x = [features(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])


def _matrix(b: pa.RecordBatch, name: str = "x") -> np.ndarray:
    col = b.column(b.schema.get_field_index(name))
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIMS)


def _sums(data: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``partial(x, positive)`` vectors over all rows; only the total reaches the driver."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in it:
            if b.num_rows:
                part = partial(_matrix(b), b.column(b.schema.get_field_index("positive")).to_numpy(zero_copy_only=False).astype(bool))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["k", "v"])

    rows = data.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()  # as many rows as the vector is long
    out = np.zeros(max((r.k for r in rows), default=-1) + 1)
    for r in rows:
        out[r.k] = r.v
    return out


def _newton(data: DataFrame, prior: float, n_p: float, n_u: float) -> np.ndarray:
    """Minimise the non-negative risk over all rows of ``(x, positive)``."""
    theta = np.zeros(DIMS)
    best, best_risk = theta, np.inf
    for _ in range(STEPS):

        def partial(x: np.ndarray, p: np.ndarray, theta=theta) -> np.ndarray:
            g = np.clip(x @ theta, -40, 40)
            s = 1 / (1 + np.exp(-g))
            loss_neg = np.logaddexp(0, g)
            xp, sp = x[p], s[p]
            hess_u = (x * (s * (1 - s))[:, None]).T @ x
            hess_p = (xp * (sp * (1 - sp))[:, None]).T @ xp
            return np.concatenate([[loss_neg.sum(), loss_neg[p].sum(), (loss_neg[p] - g[p]).sum()], x.T @ s, xp.T @ sp, xp.sum(0), hess_u.ravel(), hess_p.ravel()])

        v = _sums(data, partial)
        u_neg, p_neg, p_pos = v[0] / n_u, v[1] / n_p, v[2] / n_p
        grad_u, grad_p, mean_p = v[3 : 3 + DIMS] / n_u, v[3 + DIMS : 3 + 2 * DIMS] / n_p, v[3 + 2 * DIMS : 3 + 3 * DIMS] / n_p
        hess_u, hess_p = (h.reshape(DIMS, DIMS) for h in np.split(v[3 + 3 * DIMS :], 2))
        negative = u_neg - prior * p_neg
        ridge = RIDGE * np.eye(DIMS)
        risk = prior * p_pos + max(0.0, negative) + RIDGE * theta @ theta / 2
        if risk < best_risk:
            best, best_risk, last = theta, risk, np.inf if best_risk == np.inf else best_risk
            if last - risk < 1e-6:
                break
        if negative >= 0:  # pi E_P[l(g) - l(-g)] is linear: -pi E_P[g]
            grad, hess = grad_u - prior * mean_p, hess_u / n_u
        else:
            grad, hess = prior * (grad_p - mean_p), prior * hess_p / n_p
        step = np.linalg.solve(hess + ridge + 1e-9 * np.eye(DIMS), grad + RIDGE * theta)
        theta = theta - step * min(1.0, 8 / max(np.abs(step).max(), 1e-9) * 1.0)
    return best


def _estimate_prior(data: DataFrame, theta: np.ndarray, n_p: float, n_u: float) -> float:
    """``min U(A)/P(A)`` over upper ranges A of the first score that hold a tenth of the positives."""

    def partial(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        s = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        at = np.minimum((s * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[p], minlength=BINS)]).astype(float)

    u, p = np.split(_sums(data, partial), 2)
    u, p = np.cumsum(u[::-1]) / n_u, np.cumsum(p[::-1]) / n_p
    wide = p >= 0.1
    # one standard error of P(A) on top, so that chance does not lower the minimum
    ratio = u[wide] / p[wide] * (1 + np.sqrt((1 - p[wide]) / (p[wide] * n_p)))
    return float(np.clip(ratio.min(), 0.05, 0.99))


def fit(data: DataFrame) -> tuple[np.ndarray, float] | None:
    """``(theta, prior)`` from rows of ``(x array<float>, positive boolean)``; None without positives."""
    n_p, n_u = data.agg(F.sum(F.col("positive").cast("double")), F.count(F.lit(1)).cast("double")).first()
    if not n_p:
        return None
    first = _newton(data, 0.5, n_p, n_u)
    prior = _estimate_prior(data, first, n_p, n_u)
    return _newton(data, prior, n_p, n_u), prior


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def _learn(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """``(doc_id, x)`` of every document and the margin's weights; None without positives."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_featurise, "doc_id long, x array<float>")
    x = materialize(rows, "features")
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).where(~_held_out()).distinct().withColumn("positive", F.lit(True))
    train = materialize(x.where("doc_id is not null").where(~_held_out()).join(good, "doc_id", "left").select("x", F.coalesce("positive", F.lit(False)).alias("positive")), "train")
    model = fit(train)
    return x, None if model is None else model[0]


def _scores(x: np.ndarray, theta: np.ndarray | None) -> np.ndarray:
    return np.ones(len(x)) if theta is None else 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    x, theta = _learn(docs, labels)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(_matrix(b), theta))], ["doc_id", "score"])

    out = x.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns.

    Features are taken a second time where the texts lie: that costs a pass over the texts and
    spares shuffling them to join the scores on.
    """
    _, theta = _learn(docs, labels)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        x = [features(t) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(_scores(np.array(x, np.float32).astype(np.float64).reshape(-1, DIMS), theta))

    return docs.where(score(text_or_empty()) >= THRESHOLD)

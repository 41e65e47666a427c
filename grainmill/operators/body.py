"""Body-text suites: noise rules, passage choice, page windows, contrastive and two-claim rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import text as T

REVIEW_HEADER = r"(?i)^\s*review +\d+\b"
REFERENCES = r"(?i)\b(?:bibliography|references|acknowledge?ments?)\b"
CID = r"/C\d{2,}|/G[A-Fa-f\d]{2,}"
TOC_DOTS = r"\.{4,}"
METHODS = r"(?i)\b(?:{})\b".format("|".join("background design methods? objective participants? purpose setting".split()))


def noise(c: Column | str, header: str = REVIEW_HEADER, references: str = REFERENCES, cid: str = CID, toc: str = TOC_DOTS) -> Column:
    """Weighted penalty of what makes a page no body text."""
    text = T.col(c)
    n = {k: T.count(text, p) for k, p in (("cid", cid), ("toc", toc), ("year", T.YEAR), ("etal", T.ET_AL), ("paren", r"\("), ("comma", ","), ("semi", ";"))}
    words = F.greatest(F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")), F.lit(1))
    weigh = lambda hit, value: F.when(hit, value).otherwise(0)
    return (
        weigh(F.regexp_like(text, F.lit(header)), 5000) + weigh(F.regexp_like(text, F.lit(references)), 2500)
        + n["cid"] * 180 + n["toc"] * 250 + weigh(n["year"] >= 6, n["year"] * 220) + weigh(n["etal"] >= 2, n["etal"] * 450)
        + weigh(n["paren"] >= 10, n["paren"] * 35) + weigh(n["comma"] / words > 0.08, 1500) + weigh((n["semi"] >= 4) & (n["year"] >= 3), 900)
    ).cast("double")


def acceptable(c: Column | str, least: int = 500, most_noise: float = 2000.0, header: str = REVIEW_HEADER, cid: str = CID, toc: str = TOC_DOTS) -> Column:
    """Whether a text may stand as body text: none of the reject rules fires."""
    text = T.col(c)
    cids = T.count(text, cid)
    bad = (
        (F.length(F.trim(text)) < least) | (noise(text, header=header, cid=cid, toc=toc) >= most_noise) | F.regexp_like(text, F.lit(header)) | (T.count(text, T.YEAR) >= 8) | (T.count(text, T.ET_AL) >= 4)
        | (cids >= 6) | (T.count(text, "/C") >= 8) | (T.count(text, "/G") >= 8) | (T.count(text, toc) >= 6) | ((T.letter_share(text) < 0.40) & (cids >= 2))
        | F.regexp_like(F.lower(F.trim(F.left(text, F.lit(120)))), F.lit("^(?:references|bibliography|acknowledg)"))
    )
    return ~bad


def masthead(c: Column | str) -> Column:
    text = T.col(c)
    like = lambda p: F.regexp_like(text, F.lit(p))
    return (like(r"(?i)\bVol\.?\s*\d") & like(T.YEAR)) | (like(r"\b(?:REPORTS?|CONTENTS)\b") & like(r"(?i)\b(?:ASHP|Am J|JAMA|N Engl)\b")) | like(r"(?i)^\s*(?:PAGE|pp?\.)\s*\d")


def page_quality(c: Column | str, least: int = 500) -> Column:
    text = T.col(c)
    letters, digits = F.length(F.regexp_replace(text, r"[^\p{L}]", "")), T.count(text, r"\d")
    score = F.length(text) - noise(text) + F.least(digits, F.lit(60)) * 2 + F.when(F.regexp_like(text, F.lit(T.RESULTS)), 120).otherwise(0) + F.when(F.regexp_like(text, F.lit(METHODS)), 40).otherwise(0)
    return F.when(acceptable(text, least) & (letters >= 250), score.cast("double")).otherwise(-1.0)


def passage_score(s: Column, junk: Column | None = None) -> Column:
    """Score of a sentence as a passage."""
    points = lambda p, v: F.when(F.regexp_like(s, F.lit(p)), v).otherwise(0)
    base = points(T.RESULTS, 4) + points(r"\d", 3) - points(METHODS, 1) - points(T.ET_AL, 6) - F.when(T.count(s, T.YEAR) >= 2, 4).otherwise(0) + F.floor(F.least(F.length(s), F.lit(220)) / 40)
    return (base - F.when(junk if junk is not None else masthead(s), 20 if junk is None else 40).otherwise(0)).cast("int")


def best_passage(c: Column | str, least: int = 60) -> Column:
    """The sentence of the best score; of equals the smallest text. Null if there is none."""
    ranked = F.transform(T.sentences(c, least), lambda s: F.struct((-passage_score(s)).alias("k"), s.alias("s")))
    return F.get(F.array_sort(ranked), 0)["s"]


def candidate_sentences(c: Column | str, least: int = 60, floor: int = 2) -> Column:
    """Sentences worth a claim, best first, one per beginning of 80 characters."""
    clean = F.transform(T.sentences(c, least), lambda s: F.trim(F.regexp_replace(s, r"(?i)^\s*(?:METHODS?|RESULTS?)\s+", "")))
    junk = lambda s: masthead(s) | (T.letter_share(s) < 0.55) | F.regexp_like(s, F.lit(r"^\d(?!\d{3}\b)"))
    kept = F.filter(clean, lambda s: (F.length(s) >= least) & ~junk(s) & (passage_score(s) >= floor))
    ranked = F.array_sort(F.transform(kept, lambda s: F.struct((-passage_score(s)).alias("k"), s.alias("s"))))
    seen = F.aggregate(
        F.transform(ranked, lambda r: r["s"]),
        F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(F.array_contains(acc["keys"], F.lower(F.left(s, F.lit(80)))), acc).otherwise(F.struct(F.concat(acc["keys"], F.array(F.lower(F.left(s, F.lit(80))))).alias("keys"), F.concat(acc["out"], F.array(s)).alias("out"))),
    )
    return seen["out"]


def best_pair(sentences: Column) -> Column:
    """The first pair, neither inside the other, one with a results word; else the first two."""
    n = F.size(sentences)
    pairs = F.flatten(F.transform(sentences, lambda a, i: F.transform(F.slice(sentences, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda b: F.array(a, b))))
    good = F.filter(pairs, lambda p: ~F.contains(p[0], p[1]) & ~F.contains(p[1], p[0]) & T.has_result(F.concat(p[0], F.lit(" "), p[1])))
    return F.when(n >= 2, F.coalesce(F.get(good, 0), F.slice(sentences, 1, 2)))


def two_claim_passage(pair: Column) -> Column:
    """Both sentences, clipped; null if too long together or no body text."""
    joined = F.concat_ws(" ", T.clip_at_word(pair[0]), T.clip_at_word(pair[1]))
    return T.let(joined, lambda text: F.when((F.length(text) <= 520) & acceptable(text, 120), text))


def contrastive(rows: DataFrame, order: str = "row_ord") -> DataFrame:
    """A contradicting row of each frozen row: a wrong number, else a flipped polarity, else a
    partner's passage. ``rows``: id, passage, source_excerpt, row_ord."""
    from grainmill.operators.joins import partners

    p = partners(rows.select("id", "passage", "source_excerpt", order), order)
    number, polarity = T.mutate_number("passage"), T.flip_polarity("passage")
    kind = F.when(number.isNotNull(), "numeric_overclaim").when(polarity.isNotNull(), "polarity_flip").otherwise("cross_doc")
    return p.select(F.col("id").alias("parent_id"), order, F.coalesce(number, polarity, F.col("partner_passage")).alias("passage"), "source_excerpt", kind.alias("contrastive_kind"))


def windows(pages: DataFrame, least: int = 700) -> DataFrame:
    """``(id, first, last, excerpt)``: the page window grown from the best anchor page.

    ``pages``: id, pages array<string>, hint. A window takes in the longer neighbour, the right one
    on a tie, until it has ``least`` characters. The growth depends on the data at every step, so
    it runs per document in Python, in Arrow batches.
    """

    def grow(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            out = []
            for i, texts, score in zip(batch["id"], batch["pages"], batch["quality"]):
                order = sorted(range(len(texts)), key=lambda k: (-score[k], -k))
                if not order or score[order[0]] < 0:
                    out.append((i, None, None, None))
                    continue
                lo = hi = order[0]
                while sum(len(t) for t in texts[lo : hi + 1]) < least and (lo > 0 or hi + 1 < len(texts)):
                    left = len(texts[lo - 1]) if lo > 0 else -1
                    right = len(texts[hi + 1]) if hi + 1 < len(texts) else -1
                    lo, hi = (lo - 1, hi) if left > right else (lo, hi + 1)
                out.append((i, lo + 1, hi + 1, " ".join(texts[lo : hi + 1])))
            yield pd.DataFrame(out, columns=["id", "first", "last", "excerpt"]).astype({"first": "Int64", "last": "Int64"})

    hinted = F.transform("pages", lambda p, i: page_quality(p) + F.when(F.col("hint") == i + 1, 1e9).otherwise(0.0))
    rows = pages.select("id", "pages", hinted.alias("quality"))
    return rows.mapInPandas(grow, "id string, first long, last long, excerpt string")


def broken(passage: Column | str) -> Column:
    """Extracts that no holdout should keep: mastheads, glyph codes, soft hyphens."""
    text = T.col(passage)
    return masthead(F.left(text, F.lit(160))) | (T.count(F.left(text, F.lit(300)), "/[CG]") > 0) | F.contains(text, F.lit("­"))


def freeze(rows: DataFrame, label: str, day: Column | None = None) -> DataFrame:
    """Mark rows as frozen: status, source and date in ``meta`` are set, the rest of it kept."""
    when = day if day is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    return rows.withColumn("meta", F.col("meta").withField("draft_status", F.lit("frozen")).withField("scale_source", F.lit(label)).withField("frozen_date", when))


def claim_floor(rows: DataFrame, claims: str = "min_claims") -> DataFrame:
    """Sum of expected claims, one at least per row."""
    return rows.agg(F.sum(F.coalesce(F.nullif(F.col(claims), F.lit(0)), F.lit(1))).alias("min_claim_floor"))

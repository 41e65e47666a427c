"""Labelled claim-grounding rows from abstracts: sentence pickers, paraphrase, row builders.

A builder is a Column that is a row struct or null. A paper's builders form one array; its nulls
are dropped and the position of what is left is the row's number, so a number depends on earlier
successes as it does in a sequential generator. Randomness is a hash of (seed, corpus_id, purpose).
Pools of phrases are configuration: the defaults are this library's own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import corpus as C
from grainmill.operators.windows import excerpt_parts, packed_excerpt, seeded_pick

CLAIM = "array<struct<claim:string,verdict:string,sourceQuotes:array<string>,rationale:array<string>,hasNumericClaim:boolean>>"
VISIBLE, EXCERPT = 200, 1800
N = T.NUMBER
#: kinds that a balanced sample takes first
PRIORITY = ("sentence", "semantic", "supp", "chunk", "pol", "over")
ASSOCIATION = r"association (?:was observed )?between (.+?) and (.+?)[.,]"
POLARITY = r"significant association|statistically significant|was associated with|significantly (?:increased|decreased|reduced)"
PARTIAL = r"\d+\s+of\s+\d+|partial response|\d+\s+participants|showed (?:a )?response"
METHODS_VERB = "^We (?:surveyed|conducted|enrolled|randomized)"


@dataclass(frozen=True)
class Pools:
    """Phrases and templates of a generator run; ``%s`` stands for what a pattern's group holds."""

    openers: tuple[str, ...] = ("", "The study notes that ", "It was reported that ", "According to the authors, ", "Earlier work shows that ")
    absent: tuple[str, ...] = (
        "screening uptake doubled in every rural district within one year",
        "the device lowered annual maintenance spending across all sites",
        "monthly rainfall totals predicted admission numbers precisely",
        "complete remission followed the procedure in all enrolled volunteers",
        "solar output explained most of the variance in hospital staffing",
        "the vaccine prevented every known variant for a decade",
    )
    overclaims: tuple[str, ...] = ("the treatment works for every patient without exception", "the approach removes all risk permanently", "no adverse effect occurs in any population", "the result settles the question for all settings")
    #: (sentence that ends the excerpt, what the passage claims, why the excerpt does not say so)
    scope: tuple[tuple[str, str, str], ...] = (
        ("Costs were not looked at here.", "costs were the same in all centres", "Costs are not described in the excerpt"),
        ("Children were not enrolled.", "children and adults benefited alike", "Results for children are not described in the excerpt"),
        ("No subgroup was planned.", "every subgroup gained equally", "Subgroups are not described in the excerpt"),
    )
    #: (pattern with one number group, templates of which one is drawn)
    numeric: tuple[tuple[str, tuple[str, ...]], ...] = (
        (rf"sensitivity was ({N})\s*%", ("The test was %s%% sensitive", "Sensitivity of the test came to %s%%")),
        (rf"followed for (?:a )?mean of ({N}) months", ("Follow-up lasted %s months on average",)),
        (rf"(?:reached|achieved) an AUC of ({N})", ("The AUC came to %s",)),
        (rf"({N})\s*% of (?:patients|participants)", ("About %s%% of the patients had the outcome",)),
        (r"enrolled (\d[\d,]*) (?:adults|patients|participants)", ("The cohort had %s members",)),
        (rf"efficacy (?:was |of )?({N})\s*%", ("Efficacy stood at %s%%",)),
        (rf"efficacy against .+ was ({N})\s*%", ("Against the main endpoint efficacy came to %s%%",)),
        (rf"({N})\s*% \(95% CI", ("The primary analysis gave %s%%",)),
        (rf"increased by ({N})\s*%", ("The measure went up by %s%% from its start",)),
    )
    #: (pattern, what takes the place of the matched part of the sentence)
    rewrites: tuple[tuple[str, str], ...] = (
        (r"was associated with improved (.+?)[.,]", "went along with better %s"),
        (r"decreased significantly in the (.+?) (?:arm|group)", "fell clearly in the %s group"),
        (r"did not differ between (.+?) groups", "were alike in all groups"),
        (r"protocol compliance was high", "Compliance with the protocol stood high"),
        (r"were significantly elevated", "were clearly elevated"),
    )
    #: (pattern, the whole paraphrase of a sentence without numbers)
    semantic: tuple[tuple[str, str], ...] = (
        (r"protocol compliance was high", "High compliance with the protocol was seen"),
        (r"compliance was high", "High compliance was seen"),
        (r"adherence to (?:the )?protocol was high", "High adherence to the protocol was seen"),
        (r"were similar between groups", "The groups were similar, no difference between groups"),
        (r"did not differ between", "Rates did not differ, alike in treated and control groups"),
        (r"were significantly elevated", "Markers were significantly elevated"),
        (r"was associated with improved", "Improved recovery was associated with treatment"),
    )
    #: claims of a sample size and of a power
    multi: tuple[str, str] = ("The sample had n=%s", "The power was %s%%")
    supported: str = "Numbers and facts agree; the passage paraphrases the source"
    meant: str = "The meaning agrees; the passage paraphrases the source"


class Build(NamedTuple):
    """A row kind's parts: guard, passage, excerpt, claims, overall verdict, excerpt mode."""

    kind: str
    when: Column
    passage: Column
    excerpt: Column
    claims: Column
    overall: str
    mode: str = "full"


@dataclass(frozen=True)
class Generator:
    """Builds rows of papers: corpus_id, abstract, authors, year, article_url, doi."""

    seed: int = 42
    pools: Pools = field(default_factory=Pools)
    coin: float = 0.45

    def _draw(self, purpose: str) -> Column:
        return F.concat(F.lit(f"{self.seed}|{purpose}|"), F.col("corpus_id"))

    def _order(self, purpose: str, text: Column) -> Column:
        return F.md5(F.concat(self._draw(purpose), F.lit("|"), text))

    def _pick(self, options: Column, purpose: str) -> Column:
        return seeded_pick(options, self._draw(purpose))

    # sentence pickers
    def claim_sentence(self) -> Column:
        like = lambda s, p: F.when(F.regexp_like(s, F.lit(p)), 1).otherwise(0)
        score = lambda s: like(s, r"\d") * 2 + F.when(T.has_result(s), 2).otherwise(0) - like(s, T.METHODS_HEAD)
        ranked = F.array_sort(F.transform(F.col("sents"), lambda s: F.struct((-score(s)).alias("k"), self._order("claim", s).alias("h"), s.alias("s"))))
        fallback = F.when(F.length("abstract") >= 40, F.trim(F.left("abstract", F.lit(200))))
        return F.coalesce(F.get(ranked, 0)["s"], fallback)

    def hedged(self) -> Column:
        return self._pick(F.filter("sents", T.has_hedge), "hedged")

    def numeric(self) -> Column:
        near = F.filter("sents", lambda s: F.regexp_like(F.left(s, F.lit(VISIBLE)), F.lit(r"\d")))
        return F.coalesce(self._pick(near, "numeric"), self._pick(F.filter("sents", lambda s: F.regexp_like(s, F.lit(r"\d"))), "numeric"))

    def semantic_sentence(self) -> Column:
        return self._pick(F.filter("sents", lambda s: ~F.regexp_like(s, F.lit(r"\d")) & T.has_result(s)), "semantic")

    def polarity_sentence(self) -> Column:
        return self._pick(F.filter("sents", lambda s: F.regexp_like(s, F.lit(f"(?i){POLARITY}"))), "polarity")

    def partial_response(self) -> Column:
        return self._pick(F.filter("sents", lambda s: F.regexp_like(s, F.lit(f"(?i){PARTIAL}"))), "partial")

    def results_sentence(self) -> Column:
        return self._pick(F.filter("sents", lambda s: T.has_result(s) & ~F.regexp_like(s, F.lit(T.METHODS_HEAD))), "results")

    def two_numeric(self) -> Column:
        have = F.filter("sents", lambda s: F.regexp_like(s, F.lit(r"\d")))
        order = F.array_sort(F.transform(have, lambda s: F.struct(self._order("two", s).alias("h"), s.alias("s"))))
        return F.when(F.size(have) >= 2, F.transform(F.slice(order, 1, 2), lambda x: x["s"]))

    def methods_slice(self) -> Column:
        head = F.filter("sents", lambda s: F.regexp_like(s, F.lit(T.METHODS_HEAD)) | F.regexp_like(s, F.lit(f"(?i){METHODS_VERB}")))
        joined = F.array_join(F.slice(head, 1, 3), " ")
        return F.when(F.length(joined) >= 80, joined)

    def thin_slice(self) -> Column:
        """The methods, else the first two sentences."""
        two = F.array_join(F.slice("sents", 1, 2), " ")
        return F.coalesce(self.methods_slice(), F.when((F.size("sents") >= 2) & (F.length(two) >= 80), two))

    def absent_claim(self, text: Column | str = "abstract", purpose: str = "absent") -> Column:
        """The first claim in drawing order that the text does not hold; the first of all if it holds each."""
        pool = [F.struct(self._order(purpose, F.lit(c)).alias("h"), F.lit(c).alias("c"), F.array(*[F.lit(w) for w in re.findall("[a-z]{5,}", c.lower())]).cast("array<string>").alias("words")) for c in self.pools.absent]
        drawn = F.struct(F.array_sort(F.array(*pool)).alias("claims"), F.lower(T.col(text)).alias("hay"))
        nth = lambda x, i: F.get(x["claims"], i)
        # one after the other: as a rule the first is absent already
        first = lambda x: F.coalesce(*[F.when(T.words_absent(nth(x, i)["words"], x["hay"]), nth(x, i)["c"]) for i in range(len(pool))], nth(x, 0)["c"])
        return T.let(drawn, first)

    # text forms
    @staticmethod
    def _fits(s: Column, low: Column, pattern: str) -> Column:
        """Whether a pattern matches; it runs only on texts that hold its literal part."""
        need, hit = T.required(pattern), F.regexp_like(s, F.lit(f"(?i){pattern}"))
        return F.contains(low, F.lit(need)) & hit if need else hit

    def paraphrase(self, s: Column, low: Column | None = None) -> Column:
        """The template of the first number pattern that fits, else the sentence with a part said
        another way; null if nothing fits or the result is too short, too long or no different.

        ``low`` is the sentence in lower case, where a column has it.
        """
        low, number = F.lower(s) if low is None else low, []
        for p, templates in self.pools.numeric:
            n = F.replace(F.regexp_extract(s, f"(?i){p}", 1), F.lit(","), F.lit(""))
            number.append(F.when(self._fits(s, low, p), self._pick(F.array(*[F.format_string(t, n) for t in templates]), "template")))
        said = []
        for p, new in self.pools.rewrites:
            whole, last = f"(?i)^((?s:.*?)){p}((?s:.*))$", re.compile(p).groups + 2
            group = F.regexp_extract(s, whole, 2) if last == 3 else F.lit("")
            out = T.normalize_ws(F.concat(F.regexp_extract(s, whole, 1), F.format_string(new, group) if "%s" in new else F.lit(new), F.regexp_extract(s, whole, last)))
            said.append(F.when(self._fits(s, low, p) & F.length(out).between(20, VISIBLE) & (F.lower(out) != F.lower(s)), out))
        return F.when(F.length(F.trim(s)) >= 30, F.coalesce(*number, *said))

    def semantic_paraphrase(self, s: Column, low: Column | None = None) -> Column:
        """A sentence without numbers said another way, by its templates first."""
        known = [F.when(self._fits(s, F.lower(s) if low is None else low, p), t) for p, t in self.pools.semantic]
        return F.when(~F.regexp_like(s, F.lit(r"\d")), F.coalesce(*known, self.paraphrase(s, low)))

    def cite(self) -> Column:
        return C.citation(F.col("authors"), F.col("year"))

    def direct(self, core: Column, cite: Column | None = None) -> Column:
        return F.concat(F.regexp_replace(F.trim(core), "[.!?]$", ""), F.lit(" "), self.cite() if cite is None else cite, F.lit("."))

    def neutral(self, core: Column, purpose: str, cite: Column | None = None) -> Column:
        opener = self._pick(F.array(*[F.lit(o) for o in self.pools.openers]), f"opener-{purpose}")
        body = F.regexp_replace(F.trim(core), "[.!?]$", "")
        low = F.when((opener != "") & ~F.regexp_like(body, F.lit(T.METHODS_HEAD)), F.concat(F.lower(F.left(body, F.lit(1))), F.substring(body, 2, 1_000_000))).otherwise(body)
        return F.concat(opener, low, F.lit(" "), self.cite() if cite is None else cite, F.lit("."))

    # rows
    @staticmethod
    def claim(text: Column, verdict: str, quotes: Column | None, why: str | Column | None = None, numeric: Column | None = None) -> Column:
        """A claim in the fixed key order; ``supported`` without a quote is an error."""
        q = quotes if quotes is not None else F.array().cast("array<string>")
        if verdict == "supported" and quotes is None:
            raise ValueError("a supported claim needs a quote")
        reason = F.array().cast("array<string>") if why is None else F.array(why if isinstance(why, Column) else F.lit(why))
        return F.struct(F.left(text, F.lit(VISIBLE)).alias("claim"), F.lit(verdict).alias("verdict"), q.alias("sourceQuotes"), reason.alias("rationale"), F.coalesce(numeric if numeric is not None else F.regexp_like(text, F.lit(r"\d")), F.lit(False)).alias("hasNumericClaim"))

    def row(self, i: int, kind: str, overall: str, mode: str) -> Column:
        """Row ``i`` if its guard holds and every supported claim's quotes are in its excerpt; else null."""
        excerpt, claims = F.col(f"e_{i}"), F.col(f"c_{i}")
        meta = F.struct(F.lit("abstract").alias("label"), F.coalesce("article_url", "doi").alias("url"), F.lit(mode).alias("excerpt_mode"))
        valid = F.forall(claims, lambda c: (c["verdict"] != "supported") | F.forall(c["sourceQuotes"], lambda q: T.quote_in_excerpt_simple(q, excerpt)))
        return F.when(F.coalesce(F.col(f"g_{i}") & valid, F.lit(False)), F.struct(F.lit(kind).alias("kind"), F.col(f"t_{i}").alias("passage"), excerpt.alias("source_excerpt"), meta.alias("meta"), claims.alias("claims"), F.lit(overall).alias("overallVerdict")))

    def _said(self, core: Column) -> Column:
        return self.direct(core, F.col("cite"))

    def _told(self, core: Column, purpose: str) -> Column:
        return self.neutral(core, purpose, F.col("cite"))

    def _cap(self, passage: Column) -> Column:
        return packed_excerpt(passage, F.col("clean"), F.col("parts"), EXCERPT)

    def _supported(self, s: Column, para: Column, fits: Column, tag: str, more: Column | None = None) -> list[Build]:
        """Paraphrased rows of a sentence: whole excerpt, the sentence itself, packed excerpt."""
        why, say, tell = self.pools.supported, self._said, self._told
        if more is not None:
            fits = fits & more
        claims = F.array(self.claim(para, "supported", F.array(s), why))
        chunk = self._cap(para)
        whole = F.when(T.quote_in_excerpt_simple(s, chunk), chunk).when(F.length(s) + F.length(chunk) + 2 <= EXCERPT, F.concat(s, F.lit("\n\n"), chunk))
        return [
            Build("supp", fits & (T.normalize_ws(para) != T.normalize_ws(s)), tell(para, f"supp{tag}"), chunk, claims, "support"),
            Build("sentence", fits, say(para), s, claims, "support", "sentence"),
            Build("chunk", fits & whole.isNotNull(), tell(para, f"chunk{tag}"), whole, claims, "support", "chunked"),
        ]

    def builders(self) -> list[Build]:
        """The rows that a paper may have, in the order in which numbers are given, over ``picked`` columns."""
        a, arr, none, say, tell, cap = F.col("abstract"), F.array, F.lit(True), self._said, self._told, self._cap
        s, h, n, m, thin, r = (F.col(f"s_{k}") for k in ("claim", "hedged", "numeric", "methods", "thin", "results"))
        two, sem, pol, part = (F.col(f"s_{k}") for k in ("two", "semantic", "polarity", "partial"))
        inside = lambda x: F.contains(a, x)
        out = [Build("sup", inside(s), tell(s, "sup"), cap(s), arr(self.claim(s, "supported", arr(s))), "support")]
        out += self._supported(s, F.col("p_claim"), F.col("fit_claim"), "")
        wrong, bold, nis, away = (F.col(f"x_{k}") for k in ("wrong", "bold", "nis", "away"))
        out.append(Build("con", inside(n) & wrong.isNotNull() & ~inside(wrong) & (F.left(wrong, F.lit(VISIBLE)) != F.left(n, F.lit(VISIBLE))), tell(wrong, "con"), cap(wrong), arr(self.claim(wrong, "contradicted", arr(n), "The number differs from the source", none)), "weak"))
        out += self._supported(n, F.col("p_numeric"), F.col("fit_numeric"), "-number", ~n.eqNullSafe(s))
        out.append(Build("weak", inside(h) & (F.length(bold) >= 30) & (F.left(bold, F.lit(VISIBLE)) != F.left(h, F.lit(VISIBLE))) & ~T.numbers_aligned(bold, h), tell(bold, "weak"), cap(bold), arr(self.claim(bold, "weak", arr(h), "The source hedges what the passage asserts")), "weak"))
        out.append(Build("nis", none, tell(nis, "nis"), cap(tell(nis, "nis")), arr(self.claim(nis, "not_in_source", None, "The excerpt does not speak of this")), "unrelated"))
        out.append(Build("nisthin", thin.isNotNull() & T.claim_absent(away, thin), say(away), thin, arr(self.claim(away, "not_in_source", None, "The excerpt does not speak of this")), "unrelated", "sentence"))
        said = F.col("p_semantic")
        out.append(Build("semantic", inside(sem) & T.meaning_aligned(said, sem), say(said), sem, arr(self.claim(said, "supported", arr(sem), self.pools.meant, F.lit(False))), "support", "sentence"))
        x, y = (F.trim(F.regexp_extract(pol, f"(?i){ASSOCIATION}", i)) for i in (1, 2))
        denied = F.when((x != "") & (y != ""), F.concat(F.lit("There was no association between "), x, F.lit(" and "), y)).otherwise("There was no association between the exposure and the outcome")
        out.append(Build("pol", inside(pol) & F.regexp_like(pol, F.lit("(?i)associat(?:ion|ed)")), say(denied), pol, arr(self.claim(denied, "contradicted", arr(pol), "The source reports an association")), "weak", "sentence"))
        over = self._pick(arr(*[F.lit(o) for o in self.pools.overclaims]), "over")
        out.append(Build("over", inside(part), say(over), part, arr(self.claim(over, "contradicted", arr(part), "The source reports a limited effect")), "weak", "sentence"))
        first, second = F.get(two, 0), F.get(two, 1)
        size, power = F.get(T.numbers(first), 0), F.get(T.numbers(second), 0)
        c0 = F.format_string(self.pools.multi[0], size)
        c1 = F.when(F.contains(second, F.lit("%")), F.format_string(self.pools.multi[1], power)).otherwise(F.left(T.short_claim(second, 60), F.lit(60)))
        quote = lambda q: arr(F.when(F.length(q) <= 200, q).otherwise(T.short_claim(q, 60)))
        pair = F.left(F.concat(first, F.lit(" "), second), F.lit(EXCERPT))
        out.append(Build("multi", two.isNotNull(), say(F.concat(c0, F.lit(" with "), c1)), pair, arr(self.claim(c0, "supported", quote(first), None, none), self.claim(c1, "supported", quote(second), None, none)), "support", "sentence"))
        base, limit = F.col("s_partly"), self._pick(arr(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("ends", "says", "why"), x)]) for x in self.pools.scope]), "scope")
        told = F.coalesce(F.col("p_partly"), T.short_claim(base, 90))
        out.append(Build("multip", inside(base), say(F.concat(F.regexp_replace(told, r"\.+$", ""), F.lit(", and "), limit["says"])), F.concat(base, F.lit(" "), limit["ends"]), arr(self.claim(told, "supported", arr(base), self.pools.meant), self.claim(limit["says"], "not_in_source", None, limit["why"])), "weak", "sentence"))
        lucky = self._share("coin") < int(self.coin * 10_000)
        out.append(Build("ins", lucky & m.isNotNull() & r.isNotNull() & ~F.contains(m, r), tell(r, "ins"), m, arr(self.claim(r, "insufficient_evidence", None, "The excerpt has methods only")), "insufficient_evidence", "sentence"))
        return out

    def _share(self, purpose: str) -> Column:
        """A seeded number from 0 to 9999."""
        return F.pmod(F.conv(F.left(F.md5(self._draw(purpose)), F.lit(8)), 16, 10).cast("long"), F.lit(10_000))

    def picked(self, papers: DataFrame, least: int = 120) -> DataFrame:
        """Papers whose abstract is long enough, with sentences, picks (``s_``) and paraphrases (``p_``)."""
        p = papers.where(F.length("abstract") >= least).withColumn("sents", T.sentences("abstract", 40))
        picks = {
            "claim": self.claim_sentence(), "hedged": self.hedged(), "numeric": self.numeric(), "methods": self.methods_slice(), "thin": self.thin_slice(), "results": self.results_sentence(),
            "two": self.two_numeric(), "semantic": self.semantic_sentence(), "polarity": self.polarity_sentence(), "partial": self.partial_response(),
        }
        p = p.withColumns({f"s_{k}": v for k, v in picks.items()} | {"cite": self.cite(), "clean": T.normalize_ws("abstract")})
        p = p.withColumns({"s_partly": F.coalesce("s_results", "s_claim"), "parts": excerpt_parts(F.col("clean"))})
        p = p.withColumns({f"l_{k}": F.lower(f"s_{k}") for k in ("claim", "numeric", "semantic", "partly")})
        said = {f"p_{k}": say(F.col(f"s_{k}"), F.col(f"l_{k}")) for k, say in (("claim", self.paraphrase), ("numeric", self.paraphrase), ("semantic", self.semantic_paraphrase), ("partly", self.semantic_paraphrase))}
        p = p.withColumns(said | {"x_wrong": T.flip_number("s_numeric", VISIBLE - 1), "x_bold": T.strip_hedges("s_hedged"), "x_nis": self.absent_claim(), "x_away": self.absent_claim("s_thin", "absent-thin")})
        return p.withColumns({f"fit_{k}": F.contains("abstract", F.col(f"s_{k}")) & T.aligned(f"p_{k}", f"s_{k}") for k in ("claim", "numeric")})

    def rows(self, papers: DataFrame, least: int = 120, kinds: Sequence[str] | None = None) -> DataFrame:
        """All rows of all papers whose abstract is long enough, numbered within the paper.

        ``kinds`` builds some kinds only, and numbers those.
        """
        p, built = self.picked(papers, least), [b for b in self.builders() if kinds is None or b.kind in kinds]
        # guards, texts and excerpts are columns of their own: each is used more than once
        p = p.withColumns({f"{c}_{i}": v for i, b in enumerate(built) for c, v in (("g", F.coalesce(b.when, F.lit(False))), ("t", b.passage), ("e", b.excerpt), ("c", b.claims.cast(CLAIM)))})
        made = p.select("corpus_id", F.posexplode(F.array_compact(F.array(*[self.row(i, b.kind, b.overall, b.mode) for i, b in enumerate(built)]))).alias("idx", "r"))
        row_id = F.concat(F.lit("l3-"), F.col("corpus_id"), F.lit("-"), F.col("r.kind"), F.lit("-"), F.col("idx").cast("string"))
        return made.select(row_id.alias("id"), F.lit("l3_grounding").alias("task"), F.lit(1).alias("version"), "corpus_id", "idx", "r.*")


def verdict_histogram(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("claims").alias("c")).groupBy(F.col("c.verdict").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def first_verdicts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce(F.get("claims", 0)["verdict"], F.lit("?")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def year_bin(year: Column) -> Column:
    return F.when(year.between(2000, 2009), "2000-2009").when(year.between(2010, 2019), "2010-2019").when(year.between(2020, 2026), "2020-2026").otherwise("other")


def chat_messages(system: Column, passage: Column, excerpt: Column, label: Column, url: Column) -> Column:
    """System and user messages of a grounding prompt; texts are XML-escaped into blocks."""
    attr = F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit(' url="'), T.escape_xml(url), F.lit('"'))).otherwise("")
    block = lambda tag, attrs, body: F.concat(F.lit(f"<{tag}"), attrs, F.lit(">\n"), T.escape_xml(body), F.lit(f"\n</{tag}>"))
    user = F.concat(block("manuscript_passage", F.lit(""), passage), F.lit("\n\n"), block("source_excerpt", F.concat(F.lit(' label="'), T.escape_xml(F.coalesce(label, F.lit("source"))), F.lit('"'), attr), excerpt))
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def fold_system(messages: Column) -> Column:
    """One user message: system texts, then the others, blank ones dropped, a blank line between."""
    of = lambda cond: F.transform(F.filter(messages, lambda m: cond(m) & (F.trim(m["content"]) != "")), lambda m: m["content"])
    text = F.array_join(F.concat(of(lambda m: m["role"] == "system"), of(lambda m: m["role"] != "system")), "\n\n")
    return F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))


def suffix_last_user(messages: Column, suffix: Column | str) -> Column:
    """A suffix on the last user message only."""
    last = F.size(messages) - F.array_position(F.reverse(F.transform(messages, lambda m: m["role"])), "user").cast("int")
    extra = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.transform(messages, lambda m, i: F.struct(m["role"].alias("role"), F.when(i == last, F.concat(m["content"], extra)).otherwise(m["content"]).alias("content")))


VERDICT_SYNONYMS = {"support": "supported", "supports": "supported", "partial": "weak", "unrelated": "not_in_source", "contradict": "contradicted", "refuted": "contradicted", "unclear": "insufficient_evidence"}


def mapped(c: Column, table: dict[str, str]) -> Column:
    """A value through a map; itself where the map lacks it."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def boost_rows(labelled: DataFrame) -> DataFrame:
    """Rows of human labels: the claim is the passage's head, the verdict the label's."""
    verdict = mapped(F.lower(F.trim("label")), VERDICT_SYNONYMS)
    claim = F.struct(F.left("passage", F.lit(240)).alias("claim"), verdict.alias("verdict"), F.array().cast("array<string>").alias("sourceQuotes"), F.array().cast("array<string>").alias("rationale"), F.regexp_like(F.left("passage", F.lit(240)), F.lit(r"\d")).alias("hasNumericClaim"))
    return labelled.select("id", "passage", "source_excerpt", F.array(claim).alias("claims"))


def review_sheet(rows: DataFrame) -> DataFrame:
    c = F.get("claims", 0)
    quote = F.get(c["sourceQuotes"], 0)
    return rows.select("id", c["verdict"].alias("verdict"), c["claim"].alias("claim"), quote.alias("quote"), F.left("passage", F.lit(320)).alias("passage"), T.excerpt_preview("source_excerpt", quote).alias("preview"))


def review_priority(flags: Column, actual: Column) -> Column:
    """0 (parse errors) to 5 (the rest): the order in which people look at rows."""
    has = lambda f: F.contains(F.coalesce(flags, F.lit("")), F.lit(f))
    a = F.trim(F.coalesce(actual, F.lit("")))
    return F.when(has("parse_error") | (a == "PARSE_ERROR"), 0).when(has("echo_false_positive") & (a == "support"), 1).when(has("echo_false_positive"), 2).when(a == "support", 3).when(has("truncated_passage"), 4).otherwise(5)

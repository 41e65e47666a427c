"""Open-access locations: URL rules, ranking, audits, probing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions import text as T

TRUSTED = tuple("arxiv.org biomedcentral.com biorxiv.org bmj.com cran.r-project.org deepblue.lib.umich.edu europepmc.org figshare.com frontiersin.org mdpi.com medrxiv.org ncbi.nlm.nih.gov/pmc plos.org pubmed.ncbi.nlm.nih.gov pure.eur.nl scielo.br zenodo.org".split())
RISKY = tuple("dspace. durham-repository. hal.science hdl.handle.net ine.es/ infoscience. repositorio. worktribe.com zotero.org".split())
PMC = r"(?i)pmc/articles/(?:pmc)?(\d+)|pmc(\d+)"
WALLS = ("access denied", "institutional access", "log in", "login", "purchase", "sign in", "subscribe")
_NCBI, _EUROPE = "https://www.ncbi.nlm.nih.gov", "https://europepmc.org"


def unquote(c: Column) -> Column:
    """Percent-decoded; ``+`` stays, bad escapes leave the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def doi_spellings(doi: Column) -> Column:
    d = F.lower(doi)
    quoted = d
    for raw, code in (("(", "%28"), (")", "%29"), ("<", "%3c"), (">", "%3e"), (":", "%3a"), (";", "%3b")):
        quoted = F.replace(quoted, F.lit(raw), F.lit(code))
    return F.filter(F.array_distinct(F.array(d, F.replace(d, F.lit("/"), F.lit("%2f")), unquote(d), F.regexp_replace(d, r"(?U)[^\w]+", ""), quoted)), lambda v: v != "")


def embeds_doi(url: Column, doi: Column) -> Column:
    hay = F.lower(unquote(url))
    return F.coalesce(F.exists(doi_spellings(doi), lambda v: F.contains(hay, v)), F.lit(False))


def has_marker(url: Column, markers: tuple[str, ...] = TRUSTED) -> Column:
    low = F.lower(url)
    return F.coalesce(F.exists(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(low, m)), F.lit(False))


def location_score(url: Column, host: Column, pdf_url: Column, doi: Column) -> Column:
    """Points of a location; null rejects a repository copy that cannot be told to be the paper."""
    low, embeds, trusted, h = F.lower(url), embeds_doi(url, doi), has_marker(url), F.lower(F.coalesce(host, F.lit("")))
    add = lambda hit, v: F.when(hit, v).otherwise(0)
    kind = F.when(F.regexp_like(low, F.lit(PMC)), 95).when(h == "repository", 75).when(h == "publisher", 35).otherwise(0)
    score = add(embeds, 100) + kind + add(F.coalesce(pdf_url, F.lit("")) != "", 25) + add(trusted, 15) + add(F.endswith(low, F.lit(".pdf")) | F.contains(low, F.lit("/pdf")), 10)
    return F.when((F.coalesce(url, F.lit("")) != "") & ~((h == "repository") & ~embeds & ~trusted), score)


def rank_locations(locations: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Candidates of each DOI, best first. ``locations``: doi, pos, url, url_for_pdf, landing, host_type.

    The first-seen of equal URLs stays, even if a later one scores more. ``rejected`` is the number
    rejected when a candidate was met. An override of a DOI replaces all of its candidates.
    """
    url = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("url_for_pdf", "url", "landing")])
    rows = locations.withColumn("doi", T.normalize_doi("doi")).where("doi is not null").withColumn("picked", url)
    rows = rows.withColumn("score", location_score(F.col("picked"), F.col("host_type"), F.col("url_for_pdf"), F.col("doi")))
    w = Window.partitionBy("doi").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("rejected", F.sum(F.col("score").isNull().cast("int")).over(w)).where("score is not null")
    first = F.row_number().over(Window.partitionBy("doi", "picked").orderBy("pos"))
    rows = rows.withColumn("__n", first).where("__n = 1").select("doi", "pos", F.col("picked").alias("url"), "host_type", "score", "rejected", F.lit("scored_oa_location").alias("selection"))
    if overrides is not None:
        o = overrides.select(T.normalize_doi("doi").alias("doi"), F.lit(0).alias("pos"), "url", F.coalesce("host_type", F.lit("override")).alias("host_type"), F.lit(10000).alias("score"), F.lit(0).cast("long").alias("rejected"), F.lit("operator_override").alias("selection"))
        rows = rows.join(o.select("doi"), "doi", "left_anti").unionByName(o.join(locations.select(T.normalize_doi("doi").alias("doi")).distinct(), "doi", "left_semi"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("doi").orderBy(F.desc("score"), "pos")))


def select_verified(ranked: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """One URL per DOI: the first verified in rank order, else the first. ``probes``: url, ok."""
    rows = ranked.withColumn("ok", F.lit(False)) if probes is None else ranked.join(probes.select("url", "ok"), "url", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    row = F.struct("url", "score", "host_type", "selection", "ok", "rank")
    return rows.groupBy("doi").agg(F.max_by(row, F.struct(F.col("ok"), -F.col("rank"))).alias("r")).select("doi", "r.*")


def url_flags(url: Column, doi: Column, host: Column, selection: Column) -> Column:
    """Why an open-access URL deserves a look; none for an operator's own choice."""
    u, d, h = F.trim(F.coalesce(url, F.lit(""))), T.normalize_doi(doi), F.lower(F.coalesce(host, F.lit("")))
    low, embeds, trusted = F.lower(u), embeds_doi(u, d), has_marker(u)
    risky = F.transform(F.filter(F.array(*[F.lit(m) for m in RISKY]), lambda m: F.contains(low, m)), lambda m: F.concat(F.lit("high_risk_host:"), F.rtrim(m, F.lit("/"))))
    loose = ~embeds & ~trusted
    more = F.array_compact(F.array(
        F.when(loose & (h == "repository"), "untrusted_repo_no_doi"),
        F.when(loose & (h != "publisher") & (F.size(risky) == 0), "no_doi_untrusted"),
        F.when(F.regexp_like(low, F.lit("^https?://doi\\.org/")), "doi_resolver_only"),
    ))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(selection, F.lit("")) == "operator_override", none).when(d.isNull() | (u == ""), F.array(F.lit("missing_doi_or_url"))).otherwise(F.concat(risky, more))


def audit(rows: DataFrame) -> DataFrame:
    """Flagged rows only. ``rows``: line, doi, title, url, host_type, url_selection."""
    out = rows.withColumn("reasons", url_flags(F.col("url"), F.col("doi"), F.col("host_type"), F.col("url_selection"))).where(F.size("reasons") > 0)
    return out.select("line", T.normalize_doi("doi").alias("doi"), "title", "url", "reasons", F.concat(F.lit("https://doi.org/"), T.normalize_doi("doi")).alias("identity_url"))


def candidate_urls(url: Column) -> Column:
    """A landing page's likely PDF addresses, the page itself first."""
    low, trimmed = F.lower(url), F.regexp_replace(url, "/+$", "")
    pmc = F.nullif(F.concat(F.regexp_extract(low, PMC, 1), F.regexp_extract(low, PMC, 2)), F.lit(""))
    return F.array_distinct(F.array_compact(F.array(
        F.nullif(url, F.lit("")),
        F.concat(F.lit(_EUROPE), F.lit("/backend/ptpmcrender.fcgi?accid=PMC"), pmc, F.lit("&blobtype=pdf")),
        F.concat(F.lit(_NCBI), F.lit("/pmc/articles/PMC"), pmc, F.lit("/pdf/")),
        F.concat(F.lit(_NCBI), F.lit("/pmc/articles/"), pmc, F.lit("/pdf/")),
        F.when(F.contains(low, F.lit("figshare.com")) & ~F.contains(low, F.lit("/download")), F.concat(trimmed, F.lit("/download"))),
        F.when(F.contains(low, F.lit("nature.com/articles/")) & ~F.endswith(low, F.lit(".pdf")), F.concat(trimmed, F.lit(".pdf"))),
        F.when(F.contains(low, F.lit("link.springer.com/article/")), F.concat(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/article/", "/content/pdf/"), F.lit(".pdf"))),
    )))


def auth_wall(status: Column, body: Column) -> Column:
    """Whether a response is a login or payment page."""
    low = F.lower(F.left(body.cast("string"), F.lit(2000)))
    return F.coalesce(status.isin(401, 402, 403), F.lit(False)) | F.coalesce(F.exists(F.array(*[F.lit(w) for w in WALLS]), lambda w: F.contains(low, w)), F.lit(False))


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


def access_tier(selection: Column, host: Column) -> Column:
    h = F.lower(F.coalesce(host, F.lit("")))
    return F.when(selection == "operator_override", "operator").when(h == "publisher", "publisher_oa").when(h == "repository", "repository_oa").otherwise("unknown")


def probe(rows: DataFrame, client: Callable[[str], tuple[int, bytes]], most: int = 8) -> DataFrame:
    """``(id, url, status, ok, followed)``: fetch each URL and, from pages, PDF links, breadth first.

    ``client`` is the caller's HTTP function, run where the partition is; tests pass a table look-up.
    """
    import re

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            out = []
            for i, url in zip(batch["id"], batch["url"]):
                queue, seen, n, result = [url], set(), 0, (None, False)
                while queue and n <= most:
                    at = queue.pop(0)
                    if not at or at in seen:
                        continue
                    seen.add(at)
                    status, body = client(at)
                    n += 1
                    if body[:5] == b"%PDF-":
                        url, result = at, (status, True)
                        break
                    result = (status, False) if result[0] is None else result
                    queue += [urljoin(at, h) for h in re.findall(r"""href=["']([^"']+\.pdf[^"']*)["']""", body.decode("utf-8", "ignore"), re.I)][:12]
                out.append((i, url, result[0], result[1], max(0, n - 1)))
            yield pd.DataFrame(out, columns=["id", "url", "status", "ok", "followed"]).astype({"status": "Int64"})

    return rows.select("id", "url").mapInPandas(run, "id string, url string, status long, ok boolean, followed long")


TIER_LABELS = {"publisher_oa": "publisher_pdf", "repository_oa": "repository_copy", "operator": "operator_choice", "unknown": "unverified"}


def extract_rows(selected: DataFrame) -> DataFrame:
    """Extraction records of selected locations: a hashed id, a label by access tier, a status.

    ``selected``: doi, url, host_type, selection, score, ok.
    """
    from grainmill.operators.generate import mapped

    tier = access_tier(F.col("selection"), F.col("host_type"))
    meta = F.struct(mapped(tier, TIER_LABELS).alias("label"), tier.alias("access_tier"), F.col("host_type"), F.col("selection").alias("url_selection"), F.col("score").alias("url_selection_score"))
    return selected.select(F.concat(F.lit("oa-"), F.left(F.sha2("url", 256), F.lit(16))).alias("id"), F.lit("source_pdf_extract").alias("task"), "url", "doi", meta.alias("meta"), F.struct(F.when(F.col("ok"), "pdf_verified").otherwise("pending").alias("fetch_status")).alias("output"))

"""Joins of the grounding pipeline, as functions over DataFrames.

Build sides follow an explicit rule for repeated keys. No join is hinted: Spark broadcasts a side
whose size it knows to be small and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators.windows import numbered
from grainmill.session import materialize, ship

_SPACE = "[ \\t\\n\\r\\f\\x0B]+"


def last_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key, the last in order (map-side combined maximum, no sort)."""
    keys = [key] if isinstance(key, str) else key
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.max_by(row, order).alias("__row"))
    return best.select("__row.*")


def first_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, order).alias("__row")).select("__row.*")


def doi_join(oa: DataFrame, corpus: DataFrame, order: str = "row_ord") -> DataFrame:
    """Open-access rows with their corpus record; repeated DOIs of the corpus: the last wins."""
    build = last_per_key(corpus.withColumn("doi", T.normalize_doi("doi")), "doi", order)
    return oa.withColumn("doi", T.normalize_doi("doi")).join(build.select("doi", *[F.col(c).alias(f"corpus_{c}") for c in corpus.columns if c != "doi"]), "doi")


def contamination_exact(train: DataFrame, evals: DataFrame) -> DataFrame:
    """Train rows whose passage or excerpt equals one of the evaluation set, space- and case-folded.

    Two equi-joins, never one OR-join. ``train``/``evals``: id, passage, source_excerpt.
    """
    p = evals.select(F.col("id").alias("passage_match"), T.dedupe_key("passage").alias("pk")).where("pk <> ''").groupBy("pk").agg(F.max("passage_match").alias("passage_match"))
    e = evals.select(F.col("id").alias("excerpt_match"), T.dedupe_key("source_excerpt").alias("ek")).where("ek <> ''").groupBy("ek").agg(F.max("excerpt_match").alias("excerpt_match"))
    rows = train.select("id", T.dedupe_key("passage").alias("pk"), T.dedupe_key("source_excerpt").alias("ek"))
    out = rows.join(p, "pk", "left").join(e, "ek", "left").where("passage_match is not null or excerpt_match is not null")
    return out.select("id", "passage_match", "excerpt_match")


AUTOMATON = 4 << 20  # characters of the items that one automaton may hold, about 200 MB of memory
KEY_WORDS = 4


def _find_items(shared: Broadcast, doc: str, item: str):
    """One pass over each text with an automaton of all items."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        texts, ids = shared.value
        automaton = ahocorasick.Automaton()
        for i, t in enumerate(texts):
            automaton.add_word(t, i)
        automaton.make_automaton()
        for b in it:
            rows, hits = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                if t:
                    for i in {i for _, i in automaton.iter(t)}:
                        rows += [k] * len(ids[i])
                        hits += ids[i]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(hits, pa.int64())], [doc, item])

    return run


def containment(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``(doc, item)`` where a document's text contains an item's text, as a plain substring.

    Items whose texts add up to ``AUTOMATON`` characters at most (the size is checked first) are sent
    to the tasks as one automaton and found in a single scan: the documents are not shuffled. More
    items go by keys: a contained item brings all of its words but the outer two along whole, so its
    longest run of ``KEY_WORDS`` inner words joins with the documents' runs, and candidates are
    verified. Items too short for a run are found by automata, one scan for as many as one holds.
    """
    spark = docs.sparkSession
    ship(spark)
    some = items.where(F.col(text).isNotNull() & (F.col(text) != "") & F.col(item).isNotNull()).select(F.col(item).cast("long").alias(item), text)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc).cast("long").alias(doc), text)

    def scan(part: DataFrame) -> DataFrame:
        held: dict[str, list[int]] = {}
        for r in part.collect():  # its size is checked
            held.setdefault(r[1], []).append(r[0])
        shared = spark.sparkContext.broadcast((list(held), list(held.values())))
        return rows.mapInArrow(_find_items(shared, doc, item), f"{doc} long, {item} long")

    size = F.coalesce(F.sum(F.length(text)), F.lit(0))
    if some.agg(size).first()[0] <= AUTOMATON:
        return scan(some)
    words = F.split(F.col(text), _SPACE)
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - KEY_WORDS + 1), lambda i: F.xxhash64(F.array_join(F.slice(w, i, KEY_WORDS), " ")))
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    long_, short = F.size(words) >= KEY_WORDS + 2, F.size(words) < KEY_WORDS + 2
    spread = rows.where(F.size(words) >= KEY_WORDS).select(doc, F.explode(F.array_distinct(runs(words))).alias("key"))
    # of an item's runs the one that the fewest items have, so that phrases in common are no hot keys
    keys = some.where(long_).select(item, F.explode(F.array_distinct(runs(inner))).alias("key"))
    rare = keys.join(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").groupBy(item).agg(F.min_by("key", F.struct("n", "key")).alias("key"))
    pairs = spread.join(rare, "key").select(doc, item).distinct()
    verified = rows.select(doc, F.col(text).alias("__doc")).join(pairs, doc).join(some.select(item, F.col(text).alias("__item")), item).where(F.contains("__doc", "__item")).select(doc, item)
    blocks = int(some.where(short).agg(size).first()[0]) // (AUTOMATON // 2) + 1
    for k in range(blocks):
        verified = verified.unionByName(scan(some.where(short & (F.pmod(F.xxhash64(item), F.lit(blocks)) == k))))
    return verified


def without(base: DataFrame, boost: DataFrame, prefixes: list[str], key: str = "id") -> DataFrame:
    """Base rows that a boost set does not replace: by id, or by the prefix of their id."""
    kept = base if not prefixes else base.where(~F.coalesce(F.regexp_like(key, F.lit("^(?:" + "|".join(prefixes) + ")")), F.lit(False)))
    return kept.join(boost.select(key), key, "left_anti")


def new_candidates(corpus: DataFrame, seen: DataFrame, key: str = "doi", order: str = "row_ord", limit: int | None = 100) -> DataFrame:
    """Rows whose key was not seen, the first of each key, in order."""
    fresh = first_per_key(corpus.where(F.col(key).isNotNull()).join(seen.select(key).distinct(), key, "left_anti"), key, order).orderBy(order)
    return fresh if limit is None else fresh.limit(limit)


def update_from(target: DataFrame, labels: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """Overwrite columns where a label exists; ``updated`` tells which rows.

    Of repeated labels the last by ``order`` counts, without one the greatest.
    """
    latest = last_per_key(labels, key, order) if order else labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*columns)).alias("__row")).select(key, "__row.*")
    build = latest.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    rows = target.join(build, F.col(key) == F.col("__k"), "left")
    kept = [F.when(F.col("__k").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    return rows.select(*kept, F.col("__k").isNotNull().alias("updated"))


def fallback_join(rows: DataFrame, files: DataFrame, offset: int = 0) -> DataFrame:
    """A file by DOI, else by line number less an offset; the last name wins.

    ``rows``: line, doi. ``files``: name, file_line, file_doi.
    """
    by_doi = files.where("file_doi is not null").groupBy("file_doi").agg(F.max("name").alias("doi_file"))
    by_line = files.where("file_line is not null").groupBy("file_line").agg(F.max("name").alias("line_file"))
    out = rows.join(by_doi, rows.doi == by_doi.file_doi, "left").join(by_line, rows.line - offset == by_line.file_line, "left")
    return out.select(*[rows[c] for c in rows.columns], F.coalesce("doi_file", "line_file").alias("name"), F.when(F.col("doi_file").isNotNull(), "doi").when(F.col("line_file").isNotNull(), "line").alias("matched_by"))


def resolve_pdf(rows: DataFrame, files: DataFrame) -> DataFrame:
    """A row's PDF: its stated path, else ``<line>_<doi>.pdf``, else the smallest ``*_<doi>.pdf``.

    Never a file of another DOI, whatever its line prefix. ``rows``: line, doi, pdf_path.
    """
    safe = T.doi_file_name("doi")
    rows = rows.withColumn("__exact", F.concat(F.format_string("%03d", "line"), F.lit("_"), safe, F.lit(".pdf"))).withColumn("__safe", safe)
    f = files.select("name").distinct()
    by_doi = f.withColumn("__s", F.regexp_extract("name", r"^[^_]*_(.+)\.pdf$", 1)).where("__s <> ''").groupBy("__s").agg(F.min("name").alias("__any"))
    out = rows.join(f.select(F.col("name").alias("__p")), F.col("pdf_path") == F.col("__p"), "left").join(f.select(F.col("name").alias("__e")), F.col("__exact") == F.col("__e"), "left").join(by_doi, F.col("__safe") == F.col("__s"), "left")
    return out.withColumn("resolved", F.coalesce("__p", "__e", "__any")).drop("__exact", "__safe", "__p", "__e", "__any", "__s")


def fuzzy_titles(rows: DataFrame, files: DataFrame, least: float = 0.55) -> DataFrame:
    """Candidate ``(line, name, score)`` by title similarity, over all pairs as the reference does.

    A nested loop, but only pairs that can reach ``least`` are scored: a title inside the other, or
    enough letters in common (their multiset bounds the matching blocks, so no match is lost).
    """
    chars = "abcdefghijklmnopqrstuvwxyz0123456789 "
    counts = lambda c: F.array(*[F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in chars])
    a = rows.select("line", T.fold_accents("title").alias("a")).withColumn("ca", counts(F.col("a")))
    b = files.select("name", T.fold_accents(F.regexp_replace("name", r"\.pdf$", "")).alias("b")).withColumn("cb", counts(F.col("b")))
    common = F.aggregate(F.zip_with("ca", "cb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    total = F.length("a") + F.length("b")
    near = (2 * F.least(F.length("a"), F.length("b")) >= (least - 0.001) * total) & (2 * common >= (least - 0.001) * total)
    pairs = a.join(b, F.contains("a", "b") | F.contains("b", "a") | near).select("line", "name", "a", "b").distinct()
    return pairs.select("line", "name", F.round(T.title_similarity("a", "b"), 3).alias("score")).where(F.col("score") >= least)


def greedy_assignment(candidates: DataFrame) -> DataFrame:
    """One-to-one assignment, best score first, ties by line then name, both descending.

    Serial by nature within a connected group of candidates; mutual best pairs are taken round by
    round, which gives the same result and keeps every round a pair of aggregates and joins.
    """
    left, taken = materialize(candidates.select("line", "name", "score").distinct(), "candidates"), None
    rank = F.struct("score", "line", "name")
    while True:
        best_l = left.groupBy("line").agg(F.max(rank).alias("r")).select("r.*")
        best_n = left.groupBy("name").agg(F.max(rank).alias("r")).select("r.*")
        found = materialize(best_l.join(best_n, ["line", "name", "score"]).select("line", "name", "score"), "mutual")
        if found.isEmpty():
            break
        taken = found if taken is None else taken.unionByName(found)
        left = materialize(left.join(found.select("line"), "line", "left_anti").join(found.select("name"), "name", "left_anti").select("line", "name", "score"), "candidates")
    return left if taken is None else taken


def partners(rows: DataFrame, order: str = "row_ord") -> DataFrame:
    """Each row's partner: half the table further on, round the corner."""
    n = rows.count()
    at = numbered(rows, order, name="__i")
    other = at.select(F.col("__i").alias("__j"), *[F.col(c).alias(f"partner_{c}") for c in rows.columns])
    ahead = F.pmod(F.col("__i") - 1 + max(1, n // 2), F.lit(max(n, 1))) + 1
    return at.withColumn("__j", ahead).join(other, "__j").select(*rows.columns, *[f"partner_{c}" for c in rows.columns])


def reconcile(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local against remote files by name: size, checksum, missing and extra files."""
    a = local.select("name", F.col("size").alias("local_size"), F.col("sha256").alias("local_sha"))
    b = remote.select("name", F.col("size").alias("remote_size"), F.col("sha256").alias("remote_sha"))
    state = F.when(F.col("remote_size").isNull(), "missing_remote").when(F.col("local_size").isNull(), "extra_remote").when(F.col("local_size") != F.col("remote_size"), "size_differs").when(F.col("local_sha") != F.col("remote_sha"), "checksum_differs").otherwise("same")
    return a.join(b, "name", "full_outer").select("name", "local_size", "remote_size", state.alias("state"))


def cached_abstracts(corpus: DataFrame, cache: DataFrame, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Fill abstracts: the cache first, then sources in order, the first that has one.

    ``cache``/each source: doi, abstract; of repeated ones the greatest. ``abstract_source`` names where it came from.
    """
    out = corpus.withColumn("__key", F.left(F.sha2("doi", 256), F.lit(16)))
    c = cache.groupBy(F.left(F.sha2("doi", 256), F.lit(16)).alias("__key")).agg(F.max("abstract").alias("__cache"))
    out = out.join(c, "__key", "left")
    names: list[tuple[str, Column]] = [("cache", F.col("__cache"))]
    for name, df in sources:
        out = out.join(df.groupBy("doi").agg(F.max(F.nullif(F.trim("abstract"), F.lit(""))).alias(f"__{name}")), "doi", "left")
        names.append((name, F.col(f"__{name}")))
    own = F.col("abstract")
    label = F.coalesce(F.when(own.isNotNull(), F.col("abstract_source")), *[F.when(c.isNotNull(), n) for n, c in names], F.lit("none"))
    return out.withColumn("abstract_source", label).withColumn("abstract", F.coalesce(own, *[c for _, c in names])).drop("__key", "__cache", *[f"__{n}" for n, _ in sources])

"""Paper corpus: raw export rows to records, best record per key, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions import text as T


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(T.col(c)), F.lit(""))


def authors(c: Column | str) -> Column:
    """Author names of a JSON text: a string, or a list of strings and named objects; blanks go."""
    v = F.try_parse_json(T.col(c))
    name = lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.try_variant_get(x, "$.display_name", "string"), F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    many = F.transform(F.try_variant_get(v, "$", "array<variant>"), name)
    one = F.when(F.schema_of_variant(v) == "STRING", F.array(F.try_variant_get(v, "$", "string")))
    plain = F.when(v.isNull() & T.col(c).isNotNull(), F.array(T.col(c)))
    names = F.coalesce(many, one, plain, F.array().cast("array<string>"))
    return F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n != "")


def surname(name: Column) -> Column:
    return F.when(F.contains(name, F.lit(",")), F.trim(F.substring_index(name, ",", 1))).otherwise(F.element_at(F.split(F.trim(name), r"(?U)\s+"), -1))


def first_surname(names: Column) -> Column:
    return F.coalesce(F.nullif(surname(F.get(names, 0)), F.lit("")), F.lit("Unknown"))


def corpus_id(uid: Column, doi: Column, source: Column) -> Column:
    short = lambda c: F.concat(source, F.lit("_"), F.left(F.sha2(c, 256), F.lit(12)))
    return F.coalesce(F.lower(F.replace(uid, F.lit(":"), F.lit("_"))), short(doi), short(F.lit("None")))


def citation(names: Column, year: Column) -> Column:
    """``(A et al., y)``, ``(A & B, y)`` or ``(A, y)``; no year or zero is ``n.d.``."""
    y = F.coalesce(F.nullif(year, F.lit(0)).cast("string"), F.lit("n.d."))
    who = F.when(F.size(names) > 2, F.concat(first_surname(names), F.lit(" et al."))).when(F.size(names) == 2, F.concat(first_surname(names), F.lit(" & "), surname(F.get(names, 1)))).otherwise(first_surname(names))
    return F.concat(F.lit("("), who, F.lit(", "), y, F.lit(")"))


def records(raw: DataFrame) -> DataFrame:
    """Corpus records of raw export rows; those without DOI, abstract and uid are dropped.

    ``raw``: source_export and the strings uid, doi, title, year, authors (JSON), abstract,
    fulltext_url, article_url.
    """
    doi, uid, abstract = T.normalize_doi("doi"), F.trim("uid"), blank_to_null("abstract")
    rows = raw.select(
        "source_export", uid.alias("uid"), doi.alias("doi"), F.when(F.trim("title") != "", F.col("title")).alias("title"),
        F.when(F.regexp_like("year", F.lit(r"^\d+$")), F.col("year").try_cast("int")).alias("year"), authors("authors").alias("authors"), abstract.alias("abstract"),
        F.when(F.trim("fulltext_url") != "", F.col("fulltext_url")).alias("fulltext_url"), F.when(F.trim("article_url") != "", F.col("article_url")).alias("__article"),
        *[c for c in raw.columns if c == "row_ord"],
    )
    rows = rows.where("doi is not null or abstract is not null or (uid is not null and uid <> '')")
    return rows.select(
        corpus_id(F.nullif("uid", F.lit("")), F.col("doi"), F.col("source_export")).alias("corpus_id"), *[c for c in rows.columns if c != "__article"],
        F.when(F.col("abstract").isNotNull(), "export").otherwise("none").alias("abstract_source"), F.coalesce("__article", F.concat(F.lit("https://doi.org/"), F.col("doi"))).alias("article_url"), F.lit("abstract").alias("meta_label"),
    )


def best_of(rows: DataFrame, key: str, size: Column, preferred: Column, order: str) -> DataFrame:
    """One row per key: the longest; of equals the last preferred one, else the first seen.

    This is the closed form of a left-to-right fold in which a row replaces the best so far if it
    is longer, or as long and of the preferred source.
    """
    rank = F.struct(F.coalesce(size, F.lit(0)).alias("n"), preferred.cast("int").alias("p"), F.when(preferred, F.col(order)).otherwise(-F.col(order)).alias("o"))
    row = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(row, rank).alias("__row")).select("__row.*")


def merged(rows: DataFrame, order: str = "row_ord") -> DataFrame:
    keyed = rows.withColumn("__k", F.coalesce("doi", "corpus_id"))
    best = best_of(keyed, "__k", F.length("abstract"), F.col("source_export") == "openalex", order)
    return best.drop("__k").orderBy(F.coalesce("year", F.lit(0)), "corpus_id")


def rank_value(rows: DataFrame, value: str, by: list[str], place) -> DataFrame:
    """The value at a zero-based place of each group's sorted values, for groups of any size.

    Counts of distinct values are summed in order, so a group is never gathered: its histogram is.
    """
    hist = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(value)
    cum = hist.withColumn("upto", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    at = place(F.col("total"))
    return cum.where((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at)).select(*by, F.col(value).alias("value"))


def statistics(rows: DataFrame, abstract: str = "abstract", doi: str = "doi", fulltext: str = "fulltext_url") -> DataFrame:
    """Corpus totals, one row."""
    has = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    n = rows.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(has(abstract)).alias("with_abstract"), F.count_if(has(doi)).alias("with_doi"), F.count_if(has(fulltext)).alias("with_fulltext_url"),
        F.count_if(F.length(abstract) >= 120).alias("abstract_ge_120_chars"),
    )
    sized = rows.where(has(abstract)).select(F.lit(1).alias("k"), F.length(abstract).alias("chars"))
    median = rank_value(sized, "chars", ["k"], lambda t: F.floor(t / 2)).select(F.col("value").cast("long").alias("median_abstract_chars"), "k")
    return n.withColumn("k", F.lit(1)).join(median, "k", "left").drop("k").na.fill(0, ["median_abstract_chars"])


def year_histogram(rows: DataFrame) -> DataFrame:
    return rows.where("year is not null").groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of each combination of values, null being one."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    """How many values a column has; null counts as one."""
    return rows.agg((F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("long")), F.lit(0))).alias("n"))


def enrichment_statistics(rows: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    has = F.count_if(F.col("abstract").isNotNull())
    return rows.agg(n.alias("total"), has.alias("with_abstract"), F.when(n > 0, F.round(has / n, 4)).alias("coverage"), F.count_if(~F.col("abstract_source").isin("export", "none")).alias("looked_up"))

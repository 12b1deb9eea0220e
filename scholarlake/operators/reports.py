"""Statistics, ranked reports, checks and search documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n, df in tables.items()])


def coverage(df: DataFrame, synced: Column) -> DataFrame:
    """total, synced, pending and percent (0 of an empty table)."""
    counted = df.agg(F.count("*").alias("total"), F.count_if(synced).alias("synced"))
    return counted.select("total", "synced", (F.col("total") - F.col("synced")).alias("pending"), F.round(F.coalesce(F.try_divide(F.col("synced") * 100.0, F.col("total")), F.lit(0.0)), 2).alias("percent"))


def works_per_author(authors: DataFrame, links: DataFrame) -> DataFrame:
    n = links.groupBy("author_id").agg(F.count("article_id").alias("local_works"))
    return authors.join(n, "author_id", "left").withColumn("local_works", F.coalesce("local_works", F.lit(0)))


def joined_names(links: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """Distinct names of each key, sorted and joined by a comma."""
    return links.where(F.col(name).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(name)), ", ").alias(alias))


def article_report(articles: DataFrame, key: str, names: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """articles with each list of names, '' where there is none; links are aggregated before they are joined, so lists do not multiply."""
    for alias, (links, name) in names.items():
        articles = articles.join(joined_names(links, key, name, alias), key, "left").withColumn(alias, F.coalesce(alias, F.lit("")))
    return articles


def in_report_order(df: DataFrame, year: str = "publication_year", title: str = "title", then: tuple[str, ...] = ()) -> DataFrame:
    """Latest year first, unknown years before all, then by title, then by the columns `then`."""
    return df.orderBy(F.desc_nulls_first(year), F.asc_nulls_last(title), *then)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def by_decimal_text(column: str) -> Column:
    """Order by the number in a decimal-comma text, largest first, bad ones last."""
    return S.norm_decimal(column).desc_nulls_last()


def all_by_decimal_text(df: DataFrame, column: str, *then: Column) -> DataFrame:
    """All rows with the number in a decimal-comma text, sorted by it over all partitions, bad ones last."""
    return df.withColumn("number", S.norm_decimal(column)).orderBy(F.desc_nulls_last("number"), *then)


def priority_order(references: Column, count: Column, key: Column) -> list[Column]:
    """Articles with references first, those with more before, then by id."""
    return [F.when(references, 0).otherwise(1), count.desc_nulls_last(), key]


def min_max_next(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_id"), F.max(key).alias("max_id"), (F.coalesce(F.max(key), F.lit(0)) + 1).alias("next_id"))


def vector_dimensions(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("dim")).agg(F.count("*").alias("n"))


def require_one_dimension(df: DataFrame, dim: int, column: str = "embedding") -> None:
    others = [r["dim"] for r in vector_dimensions(df, column).where(F.col("dim") != dim).limit(5).collect()]
    if others:
        raise ValueError(f"stored vectors have {others} dimensions, not {dim}")


def outcome_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    return df.groupBy(outcome).agg(F.count("*").alias("n"))


def missing_in(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_anti").agg(F.count("*").alias("missing"))


def copy_status(source: dict[str, DataFrame], target: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Tables with their counts, missing rows by key and a status; gaps count, unlike in a comparison of totals."""
    parts = []
    for name, df in source.items():
        on = keys[name]
        there = target[name].select(*on)
        row = df.agg(F.count("*").alias("source_rows")).join(there.agg(F.count("*").alias("target_rows"))).join(missing_in(df, there, on))
        parts.append(row.select(F.lit(name).alias("table_name"), "source_rows", "target_rows", "missing"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("status", F.when(F.col("missing") == 0, "up-to-date").when(F.col("target_rows") == 0, "needs copy").otherwise(F.concat(F.lit("missing "), F.col("missing").cast("string"))))


def selection_checks(selected: DataFrame, bookmarks: DataFrame, target: int) -> DataFrame:
    """check_name, ok, observed: exact count, no duplicates, no bookmark lost."""
    n = selected.agg(F.count("*").alias("n"), F.count_distinct("article_id").alias("d"))
    lost = bookmarks.select("article_id").distinct().join(selected.select("article_id"), "article_id", "left_anti").agg(F.count("*").alias("lost"))
    row = n.join(lost)
    check = lambda name, ok, seen: row.select(F.lit(name).alias("check_name"), ok.alias("ok"), seen.alias("observed"))
    return check("exact_count", F.col("n") == target, F.col("n")).unionByName(check("no_duplicates", F.col("n") == F.col("d"), F.col("n") - F.col("d"))).unionByName(check("bookmarks_kept", F.col("lost") == 0, F.col("lost")))


def require(checks: DataFrame) -> None:
    bad = [r["check_name"] for r in checks.where("not ok").select("check_name").limit(20).collect()]
    if bad:
        raise ValueError(f"checks failed: {', '.join(bad)}")


def outcome_class(response: DataFrame) -> DataFrame:
    """Outcome of each article of a backfill (article_id, http_status, n_authors, n_unresolved, incomplete)."""
    s = F.col("http_status")
    return response.withColumn(
        "outcome",
        F.when(s.isNull() | (s == 429) | (s >= 500), "RETRYABLE")
        .when(s.isin(404, 410), "UNAVAILABLE_FROM_SOURCE")
        .when(s >= 400, "FAILED")
        .when(F.col("n_authors") == 0, "ARTICLE_HAS_NO_AUTHORS")
        .when((F.col("n_unresolved") > 0) | (F.col("incomplete") > 0), "AUTHOR_UNRESOLVED")
        .otherwise("SUCCESS"),
    )


def incomplete_links(articles: DataFrame, links: DataFrame, affiliations: DataFrame) -> DataFrame:
    """article_id, n_authors, incomplete_count: linked authors without an affiliation in exactly the article's year."""
    linked = links.select("article_id", "author_id").distinct().join(articles.select("article_id", F.col("publication_year").alias("year")), "article_id")
    known = affiliations.select("author_id", "year").distinct().withColumn("_there", F.lit(True))
    counted = linked.join(known, ["author_id", "year"], "left")
    return counted.groupBy("article_id").agg(F.count("*").alias("n_authors"), F.count_if(F.col("_there").isNull()).alias("incomplete_count"))


#: Search documents: entity, id column, columns with '' and columns with 0 for NULL, columns as they are.
SEARCH_ENTITIES = {
    "article": ("article_id", ["abstract", "semantic_tldr", "doi"], ["publication_year", "citation_count", "influential_citation_count"], ["title"]),
    "author": ("author_id", ["orcid", "openalex_id"], [], ["display_name", "works_count", "cited_by_count", "h_index", "i10_index"]),
    "topic": ("topic_id", [], [], ["display_name"]),
    "institution": ("institution_id", ["country_code", "type"], [], ["display_name"]),
    "journal": ("journal_id", ["issn", "publisher_id"], [], ["display_name"]),
    "keyword": ("keyword_id", [], [], ["display_name"]),
}


def search_documents(df: DataFrame, entity: str) -> DataFrame:
    """Search documents of an entity; soft-deleted rows are left out, NULL marks count as live."""
    key, texts, numbers, plain = SEARCH_ENTITIES[entity]
    if "is_deleted" in df.columns:
        df = df.where(~F.coalesce("is_deleted", F.lit(False)))
    return document(df, key, entity, texts, numbers, plain)


def document(df: DataFrame, key: str, entity: str, texts: list[str] = (), numbers: list[str] = (), plain: list[str] = ()) -> DataFrame:
    text_id = F.col(key).cast("string")
    return df.select(text_id.alias("id"), text_id.alias("entity_id"), F.lit(entity).alias("entity_type"), *plain, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts), *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers))

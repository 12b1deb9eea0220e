"""Which rows an enrichment run takes, how its answers meet them, and how it marks and queues them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators import selection

# How source ids of matched journals begin.
MATCHED_PREFIXES = ("https://openalex.org/", "S")


def live(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rows that are not deleted; a NULL mark is live unless `strict`."""
    return df.where(~F.col("is_deleted") if strict else ~F.coalesce("is_deleted", F.lit(False)))


def _has_prefix(c: str) -> Column:
    return F.col(c).startswith(MATCHED_PREFIXES[0]) | F.col(c).startswith(MATCHED_PREFIXES[1])


def unmatched_journals(journals: DataFrame) -> DataFrame:
    """Live journals whose source id is not yet that of a matched source; a NULL source id is in neither set."""
    return live(journals).where(~_has_prefix("source_id"))


def matched_journals(journals: DataFrame) -> DataFrame:
    return live(journals).where(_has_prefix("source_id"))


def references_missing(articles: DataFrame, min_year: int | None = None) -> DataFrame:
    """Live articles with a DOI, of min_year or later, that lack references or their count."""
    lacking = ~S.has_elements("references") | F.coalesce(F.col("reference_count") == 0, F.lit(True))
    recent = F.lit(True) if min_year is None else F.col("publication_year") >= min_year
    return live(articles).where(~S.is_blank("doi") & recent & lacking)


def enrichment_candidates(articles: DataFrame, only_missing: bool = False, article_id: int | None = None) -> DataFrame:
    """Live articles with a title; only those without paper id or references, or only one article, if asked."""
    out = live(articles).where("title is not null")
    if article_id is not None:
        out = out.where(F.col("article_id") == article_id)
    return out.where("semantic_scholar_id is null or references is null") if only_missing else out


def pending_authors(authors: DataFrame, links: DataFrame) -> DataFrame:
    """Authors never scanned or without h-index that have an outer id, with the number of their works here."""
    waiting = authors.where("(created_at is null or h_index is null) and (orcid is not null or openalex_id is not null)")
    n = links.groupBy("author_id").agg(F.count("article_id").alias("local_works"))
    return waiting.join(n, "author_id", "left").withColumn("local_works", F.coalesce("local_works", F.lit(0)))


def most_works_first() -> list[Column]:
    return [F.desc("local_works"), F.asc("author_id")]


def author_summaries(details: DataFrame) -> DataFrame:
    """Flat columns of landed author details: ids, counts, indices and the first last-known institution."""
    first = F.get("last_known_institutions", F.lit(0))
    return details.select(
        F.col("id").alias("openalex_id"),
        "orcid",
        "display_name",
        "works_count",
        "cited_by_count",
        F.col("summary_stats.h_index").alias("h_index"),
        F.col("summary_stats.i10_index").alias("i10_index"),
        first["id"].alias("institution_id"),
        first["display_name"].alias("institution_name"),
    )


def match_authors(authors: DataFrame, summaries: DataFrame) -> DataFrame:
    """authors (author_id, openalex_id, orcid) with the summary found and `found`: by outer id where there is one, else by ORCID.

    Of several summaries of one key the smallest counts.
    """
    values = [c for c in summaries.columns if c not in ("openalex_id", "orcid")]
    packed = F.struct(*values)
    by_id = summaries.where("openalex_id is not null").groupBy(S.id_tail("openalex_id").alias("_id")).agg(F.min(packed).alias("_by_id"))
    bare = lambda c: F.trim(F.replace(F.col(c), F.lit("https://orcid.org/"), F.lit("")))
    by_orcid = summaries.where("orcid is not null").groupBy(bare("orcid").alias("_orcid")).agg(F.min(packed).alias("_by_orcid"))
    keyed = authors.select("author_id", S.id_tail("openalex_id").alias("_id"), F.when(F.col("openalex_id").isNull(), bare("orcid")).alias("_orcid"))
    out = keyed.join(by_id, "_id", "left").join(by_orcid, "_orcid", "left").withColumn("_v", F.coalesce("_by_id", "_by_orcid"))
    return out.select("author_id", *(F.col(f"_v.{c}").alias(c) for c in values), F.col("_v").isNotNull().alias("found"))


def mark_scanned(authors: DataFrame, matched: DataFrame, now: Column) -> DataFrame:
    """Authors with created_at set for those that a run looked for and did not find, so that the next run skips them, and status."""
    seen = matched.select("author_id", "found")
    out = authors.join(seen, "author_id", "left")
    status = F.when(F.col("found").isNull(), "NOT_TRIED").when(F.col("found"), "SYNCED").otherwise("NOT_FOUND")
    return out.withColumn("created_at", F.when(~F.col("found"), now).otherwise(F.col("created_at"))).withColumn("status", status).select(*authors.columns, "status")


def counting_skipped(rows: DataFrame, keep: Column, name: str = "skipped") -> tuple[DataFrame, Observation]:
    """Rows that `keep` holds for, and an observation of `total` and `skipped` that is filled once they are computed."""
    seen = Observation(name)
    good = F.coalesce(keep, F.lit(False))
    return rows.observe(seen, F.count("*").alias("total"), F.count_if(~good).alias("skipped")).where(good), seen


def with_references(articles: DataFrame, ids: DataFrame) -> DataFrame:
    """selected, with_references: how many of the selected articles there are and how many have references."""
    has = S.has_elements("references") | F.coalesce(F.col("reference_count") > 0, F.lit(False))
    return articles.join(ids.select("article_id").distinct(), "article_id", "left_semi").agg(F.count("*").alias("selected"), F.count_if(has).alias("with_references"))


def retry_queue(outcomes: DataFrame, key: str, *latest: Column, outcome: str = "outcome") -> DataFrame:
    """One row for each id whose latest outcome is RETRYABLE."""
    return selection.first_by_priority(outcomes, key, *latest).where(F.col(outcome) == "RETRYABLE")

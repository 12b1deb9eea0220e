"""Walks over landed pages: bounded expansion of a frontier, and journal archives down to articles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.functions import html
from scholarlake.sources.scratch import stored


def expand(pages: DataFrame, seeds: DataFrame, follow: Callable[[DataFrame, int], DataFrame], depth: int) -> DataFrame:
    """origin, depth, parent, place, link, label: the links of the pages within `depth` links of the seeds (origin, url).

    `follow(pages, depth)` gives the links (url, place, link, label) of landed pages (url, html) that are to be followed. A page is
    read once for an origin however many links and cycles lead to it, and all links of what is read are kept. Links to pages
    that have not landed are kept and lead nowhere. Each level is written once.
    """
    frontier = stored(seeds.select("origin", "url").where("url is not null").distinct())
    visited, levels = frontier, []
    for d in range(1, depth + 1):
        landed = pages.join(frontier.select("url").distinct(), "url", "left_semi")
        links = follow(landed, d).select("url", "place", "link", "label")
        edges = stored(frontier.join(links, "url").select("origin", F.lit(d).alias("depth"), F.col("url").alias("parent"), "place", "link", "label"))
        levels.append(edges)
        frontier = stored(edges.select("origin", F.col("link").alias("url")).distinct().join(visited, ["origin", "url"], "left_anti"))
        visited = visited.unionByName(frontier)
    return reduce(DataFrame.unionByName, levels)


def archive_url(base: str = "base_url", archive: str = "archive_url") -> F.Column:
    """A journal's archive: the given one, else issue/archive below its base."""
    return F.coalesce(F.nullif(F.col(archive), F.lit("")), F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/issue/archive")))


def year_of(text: F.Column) -> F.Column:
    """The first year from 1900 to 2099 in a text, one that stands in brackets before all others: a volume's number may look like a year."""
    year = lambda pattern: F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1).try_cast("int")
    return F.coalesce(year(r"\(((?:19|20)\d{2})\)"), year(r"\b((?:19|20)\d{2})\b"))


def _journal_links(pages: DataFrame, depth: int) -> DataFrame:
    links = html.page_links(pages.withColumn("page_id", F.col("url"))).withColumnRenamed("page_id", "url")
    return html.issue_links(links) if depth == 1 else html.article_links(links, "url").withColumnRenamed("title", "label")


def crawl_journals(pages: DataFrame, seeds: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles and warnings of journals (code, base_url, archive_url, language), from landed pages (url, html).

    An archive leads to issues, an issue to articles; an article is listed once for each issue that links to it. What an article's
    own page lacks comes from the links: its title from the article's, volume, issue and year from the issue's. `limit` keeps a
    journal's first articles, in the order of its issues and their links. Journals without issues are warned of.
    """
    one = pages.groupBy("url").agg(F.min("html").alias("html"))
    starts = seeds.select(F.col("code").alias("origin"), archive_url().alias("url"), "language")
    edges = expand(one, starts, _journal_links, 2)
    issues = edges.where("depth = 1").select("origin", F.col("link").alias("issue_url"), F.col("label").alias("issue_label"), F.col("place").alias("issue_place"))
    listed = edges.where("depth = 2").select("origin", F.col("parent").alias("issue_url"), F.col("link").alias("source_url"), F.col("label").alias("link_title"), "place")
    articles = listed.join(issues, ["origin", "issue_url"])
    if limit:
        first = Window.partitionBy("origin").orderBy("issue_place", "place")
        articles = articles.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= limit)
    details = html.article_details(one.join(articles.select(F.col("source_url").alias("url")).distinct(), "url", "left_semi").withColumnRenamed("url", "page_id")).withColumnRenamed("page_id", "source_url")
    none = F.array().cast("array<string>")
    out = articles.join(details, "source_url", "left").join(starts.select("origin", "language"), "origin")
    rows = out.select(
        F.col("origin").alias("source_journal_code"),
        "source_url",
        F.coalesce(F.nullif("title", F.lit("")), "link_title").alias("title"),
        F.coalesce("authors", none).alias("authors"),
        "abstract",
        F.coalesce("keywords", none).alias("keywords"),
        "doi",
        F.nullif("pdf_url", F.lit("")).alias("pdf_url"),
        F.coalesce("publication_year", year_of(F.col("issue_label"))).alias("publication_year"),
        F.col("issue_label").alias("volume"),
        F.col("issue_label").alias("issue"),
        "language",
        "issue_url",
        "issue_place",
        "place",
    )
    warnings = starts.join(issues.select("origin").distinct(), "origin", "left_anti").select(F.col("origin").alias("source_journal_code"), F.concat(F.lit("no issue in the archive: "), "url").alias("warning"))
    return rows, warnings

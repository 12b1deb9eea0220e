"""Text, links and meta tags of HTML pages."""

from __future__ import annotations

import html
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
META = r"(?is)<meta\s[^>]*\b(?:name|property)\s*=\s*[\"']([^\"']+)[\"'][^>]*?\bcontent\s*=\s*[\"']([^\"']*)[\"']"


#: What html.unescape looks at: a reference, and a lone & with what follows it up to 32 characters.
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.pandas_udf(ArrayType(StringType()))
def _characters(entities: pd.Series) -> pd.Series:
    return entities.map(lambda found: [html.unescape(x) for x in found], na_action="ignore")


def html_unescape(c: Column) -> Column:
    """html.unescape of a text; Python sees its entities alone, however long the text is."""
    between = F.split(c, ENTITY, -1)
    put = F.concat(_characters(F.regexp_extract_all(c, F.lit(f"({ENTITY})"), F.lit(1))), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, put, lambda text, char: F.concat(text, char)), "")


@F.pandas_udf(StringType())
def url_join(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else urljoin(b or "", html.unescape(x)) for b, x in zip(base, link)])


def clean_text(c: Column) -> Column:
    """Tags become blanks, entities characters, runs of blanks one blank."""
    return F.trim(F.regexp_replace(html_unescape(F.regexp_replace(c, r"(?s)<[^>]+>", " ")), r"[\s ]+", " "))


def page_text(pages: DataFrame, page_id: str = "page_id", body: str = "html") -> DataFrame:
    return pages.select(page_id, clean_text(F.coalesce(body, F.lit(""))).alias("text"))


def page_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """page_id, place, link, label: a page's links, the first of equal addresses."""
    found = pages.select(page_id, url, F.posexplode(F.arrays_zip(F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(1)).alias("h"), F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(2)).alias("l"))).alias("place", "a"))
    links = found.select(page_id, "place", url_join(F.col(url), F.col("a.h")).alias("link"), clean_text(F.col("a.l")).alias("label")).where("link <> ''")
    first = Window.partitionBy(page_id, "link").orderBy("place")
    return links.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def issue_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("link").contains("/issue/view/") & (F.col("label") != "") & (F.lower("label") != "pdf"))


def article_links(links: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Article links with pdf_link: that of a PDF link whose article was not yet emitted. An article's own link emits it at once, so it has none."""
    articles = links.where(F.col("link").contains("/article/view/") & (F.lower("label") != "pdf"))
    return articles.select(page_id, "place", "link", F.col("label").alias("title"), F.lit(None).cast("string").alias("pdf_link"))


def meta_tags(pages: DataFrame, page_id: str = "page_id", body: str = "html") -> DataFrame:
    """page_id and meta: {lower-case name: values in order}."""
    found = pages.select(page_id, F.posexplode_outer(F.arrays_zip(F.regexp_extract_all(body, F.lit(META), F.lit(1)).alias("k"), F.regexp_extract_all(body, F.lit(META), F.lit(2)).alias("v"))).alias("place", "m"))
    rows = found.select(page_id, "place", F.lower(F.trim("m.k")).alias("k"), clean_text(F.col("m.v")).alias("v"))
    keyed = rows.groupBy(page_id, "k").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("v"))
    return keyed.groupBy(page_id).agg(F.map_from_entries(F.filter(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "v"))), lambda x: x.isNotNull())).alias("meta"))


def article_details(pages: DataFrame, page_id: str = "page_id", body: str = "html") -> DataFrame:
    """Title, authors, abstract, keywords, doi, pdf_url and year from a page's meta tags."""
    get = lambda k: F.try_element_at(F.col("meta"), F.lit(k))
    first = lambda *keys: F.coalesce(*(F.get(get(k), F.lit(0)) for k in keys))
    none = F.array().cast("array<string>")
    raw = F.flatten(F.array(*(F.coalesce(get(k), none) for k in ("citation_keywords", "dc.subject", "keywords"))))
    words = F.filter(F.transform(F.flatten(F.transform(raw, lambda v: F.split(v, "[;,]"))), lambda x: F.trim(x)), lambda x: x != "")
    return meta_tags(pages, page_id, body).select(
        page_id,
        first("citation_title", "dc.title", "og:title").alias("title"),
        F.coalesce(get("citation_author"), get("dc.creator"), none).alias("authors"),
        first("citation_abstract", "dc.description", "description").alias("abstract"),
        F.array_distinct(words).alias("keywords"),
        F.trim(F.regexp_replace(first("citation_doi", "dc.identifier"), "(?i)^doi:", "")).alias("doi"),
        first("citation_pdf_url").alias("pdf_url"),
        F.regexp_extract(F.coalesce(first("citation_publication_date", "dc.date"), F.lit("")), r"\b(?:19|20)\d{2}\b", 0).try_cast("int").alias("publication_year"),
    )

"""Sources: ranking files, landed JSON, keyset and configured table scans."""

from __future__ import annotations

import re
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Columns of the ranking file and their names here.
RANKING_COLUMNS = {
    "Rank": "rank_txt",
    "Sourceid": "source_id",
    "Title": "title",
    "Type": "type",
    "Issn": "issn",
    "Publisher": "publisher",
    "Open Access": "open_access",
    "Open Access Diamond": "open_access_diamond",
    "SJR": "sjr",
    "H index": "h_index",
    "Total Docs. (3years)": "total_docs_3years",
    "Total Refs.": "total_refs",
    "Total Cites (3years)": "total_cites_3years",
    "Citable Docs. (3years)": "citable_docs_3years",
    "Cites / Doc. (2years)": "cites_doc_2years",
    "Ref. / Doc.": "ref_doc",
    "Country": "country",
    "Region": "region",
    "Coverage": "coverage",
    "Categories": "categories",
    "Areas": "areas",
}
YEAR_COLUMN, YEAR_NAME = re.compile(r"Total Docs\. \(\d{4}\)"), "total_docs_current_year"

# Nested schemas of landed API pages.
TOPIC = "struct<display_name:string,score:double,field:struct<display_name:string>,subfield:struct<display_name:string>>"
WORK = (
    "struct<id:string,title:string,doi:string,publication_year:int,cited_by_count:bigint,referenced_works:array<string>,referenced_works_count:bigint,"
    f"abstract_inverted_index:map<string,array<int>>,biblio:struct<volume:string,issue:string>,primary_topic:{TOPIC},topics:array<{TOPIC}>,"
    "authorships:array<struct<author:struct<id:string,orcid:string,display_name:string>>>,keywords:array<struct<display_name:string,score:double>>>"
)
WORKS_PAGE = f"results array<{WORK}>, meta struct<next_cursor:string>"
SOURCE = "struct<id:string,issn:array<string>,issn_l:string,publisher:string,works_count:bigint,cited_by_count:bigint>"
SOURCES_PAGE = f"results array<{SOURCE}>"
AUTHOR = (
    "struct<id:string,orcid:string,display_name:string,works_count:bigint,cited_by_count:bigint,"
    "summary_stats:struct<h_index:bigint,i10_index:bigint>,last_known_institutions:array<struct<id:string,display_name:string>>>"
)
AUTHORS_PAGE = f"results array<{AUTHOR}>"
COUNTRIES = "name struct<common:string,official:string>, cca2 string, cca3 string"


def _encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every file is valid UTF-8, else Latin-1; decided by the executors."""
    bad = spark.read.format("binaryFile").load(path).where(~F.is_valid_utf8(F.col("content").cast("string")))
    return "ISO-8859-1" if bad.limit(1).count() else "UTF-8"


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    """All-string rows of a ;-separated ranking file. Over-long lines are dropped, short ones padded with ''."""
    encoding = _encoding(spark, path)
    head = spark.read.csv(path, sep=";", header=True, encoding=encoding, escape='"').columns
    schema = StructType([StructField(c, StringType()) for c in head] + [StructField("_bad", StringType())])
    # a pruned parser would not see that a line is over-long
    reader = spark.read.option("columnPruning", False)
    rows = reader.csv(path, sep=";", header=True, schema=schema, encoding=encoding, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", nullValue="\x00", emptyValue="", enforceSchema=True, escape='"')
    # a malformed line with more separators outside quotes than the header has is over-long
    fields = F.size(F.split(F.regexp_replace(F.col("_bad"), '"[^"]*"', ""), ";"))
    kept = rows.where(F.col("_bad").isNull() | (fields <= len(head)))
    return kept.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in head))


def map_ranking_columns(raw: DataFrame) -> DataFrame:
    """Rows with this engine's column names; any year's document count is total_docs_current_year; absent columns are ''."""
    names = {c: YEAR_NAME if YEAR_COLUMN.match(c.strip()) else RANKING_COLUMNS.get(c.strip()) for c in raw.columns}
    known = {v: k for k, v in names.items() if v}
    wanted = [*RANKING_COLUMNS.values(), YEAR_NAME]
    return raw.select(*(F.col(f"`{known[w]}`").alias(w) if w in known else F.lit("").alias(w) for w in wanted))


def has_source_and_title() -> Column:
    return (F.trim("source_id") != "") & (F.trim("title") != "")


def require_source_and_title(rows: DataFrame) -> DataFrame:
    return rows.where(has_source_and_title())


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """name (lower case), codes of a nested country dictionary: common and official names."""
    rows = spark.read.schema(COUNTRIES).json(path, multiLine=True)
    named = rows.select(F.explode(F.array("name.common", "name.official")).alias("name"), F.array("cca2", "cca3").alias("codes")).where("name is not null")
    return named.groupBy(F.lower("name").alias("name")).agg(F.min("codes").alias("codes"))


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """Works of landed result pages with the file they came from and the page's next_cursor; works without title are left out."""
    return works_of(spark.read.schema(WORKS_PAGE).json(path, multiLine=True).withColumns({"source_file": F.col("_metadata.file_path"), "next_cursor": F.col("meta.next_cursor")}))


def works_of(pages: DataFrame) -> DataFrame:
    """Works of pages (results), with the pages' other columns but for their envelope."""
    own = [c for c in pages.columns if c not in ("results", "meta")]
    # outer: before a plain explode Spark filters on the array's size, which parses a page's text once more for each filter
    return pages.select(*own, F.explode_outer("results").alias("w")).select("w.*", *own).where("title is not null")


def read_page(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of landed `results` pages."""
    return spark.read.schema(schema).json(path, multiLine=True).select(F.inline("results"))


def aligned(df: DataFrame, requested: str, answers: str) -> DataFrame:
    """Requested ids with the answer at their place; NULL where nothing was found."""
    pairs = df.select(F.posexplode(F.arrays_zip(F.col(requested).alias("id"), F.col(answers).alias("answer"))).alias("pos", "p"))
    return pairs.select("p.id", "p.answer", F.col("p.answer").isNotNull().alias("found"))


def after_key(df: DataFrame, keys: list[str], cursor: tuple | None, page: int | None = None) -> DataFrame:
    """Rows with keys behind the cursor in key order; at most `page`."""
    if cursor is not None:
        df = df.where(F.struct(*keys) > F.struct(*(F.lit(v).alias(k) for k, v in zip(keys, cursor))))
    return df.orderBy(*keys).limit(page) if page else df


def resume_after(df: DataFrame, key: str, last: int | None) -> DataFrame:
    """Rows whose numeric id is behind the last one delivered."""
    return df if last is None else df.where(F.col(key).cast("long") > last)


def resume_offset(df: DataFrame, offset: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).offset(offset)


def configured_scan(tables: dict[str, DataFrame], config: list[dict]) -> list[tuple[str, DataFrame]]:
    """(name, rows) of a list of {table, columns, where, order_by, limit}, in order; unknown columns are left out, limit 0 is all."""
    out = []
    by_name = {n.lower(): (n, df) for n, df in tables.items()}
    for c in config:
        name, df = by_name[c["table"].lower()]
        columns = c.get("columns") or df.columns
        if unknown := [x for x in columns if x not in df.columns]:
            warnings.warn(f"{name} has no columns {', '.join(unknown)}", stacklevel=2)
        valid = [x for x in columns if x in df.columns] or df.columns
        if c.get("where"):
            df = df.where(c["where"])
        if c.get("order_by"):
            df = df.orderBy(*(F.expr(x.split()[0]).desc_nulls_first() if x.lower().endswith(" desc") else F.expr(x.split()[0]).asc_nulls_last() for x in c["order_by"].split(",") for x in [x.strip()]))
        df = df.select(*valid)
        out.append((name, df.limit(c["limit"]) if c.get("limit") else df))
    return out


def subset_scan(tables: dict[str, DataFrame], names: list[str] | str, limit: int = 0) -> list[tuple[str, DataFrame]]:
    """Named tables, or ALL, in any case, each with at most `limit` rows."""
    wanted = [n for n in tables] if names == "ALL" or names == ["ALL"] else names
    return configured_scan(tables, [{"table": n, "limit": limit} for n in wanted])


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds of JSON files, each of which holds one seed or a list of them."""
    return spark.read.json(path, multiLine=True)


def read_issn_candidates(spark: SparkSession, path: str, column: str = "issn") -> DataFrame:
    return spark.read.csv(path, header=True).withColumn(column, F.filter(F.split(column, r"\s*;\s*"), lambda x: x != ""))


def follow_links(pages: DataFrame, links: DataFrame, url: str = "url") -> DataFrame:
    """Landed pages that links lead to."""
    return pages.join(links.select(F.col("link").alias(url)).distinct(), url, "left_semi")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

"""Sinks: reports, nested JSON, snapshots, search and graph tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.operators.selection import set_checksum


def write_report(df: DataFrame, path: str) -> None:
    """CSV with header, UTF-8 with a byte order mark before the first name."""
    first, *rest = df.columns
    df.withColumnRenamed(first, "﻿" + first).write.csv(path, header=True)


def nested_articles(journals: DataFrame, articles: DataFrame, warnings: DataFrame) -> DataFrame:
    """One record for each journal with its articles and warnings."""
    a = articles.groupBy("journal_id").agg(F.sort_array(F.collect_list(F.struct(*[c for c in articles.columns if c != "journal_id"]))).alias("articles"))
    w = warnings.groupBy("journal_id").agg(F.sort_array(F.collect_set("warning")).alias("warnings"))
    empty = lambda c, df: F.coalesce(c, F.array().cast(df.schema[c].dataType))
    return journals.join(a, "journal_id", "left").join(w, "journal_id", "left").withColumns({"articles": empty("articles", a), "warnings": empty("warnings", w)})


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_snapshot(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Each table as Parquet under `path`, which must not exist, and table_name, n, checksum of each."""
    parts = []
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        stored = df.sparkSession.read.parquet(f"{path}/{name}")
        parts.append(set_checksum(stored).select(F.lit(name).alias("table_name"), "n", "checksum"))
    meta = reduce(DataFrame.unionByName, parts)
    meta.write.mode("errorifexists").parquet(f"{path}/_metadata_tables")
    return meta.sparkSession.read.parquet(f"{path}/_metadata_tables")


def verify_snapshot(spark, path: str) -> DataFrame:
    """Metadata rows of a snapshot with ok: counts and checksums still hold."""
    meta = spark.read.parquet(f"{path}/_metadata_tables")
    names = [r["table_name"] for r in meta.select("table_name").collect()]  # one row for each table
    now = reduce(DataFrame.unionByName, [set_checksum(spark.read.parquet(f"{path}/{n}")).select(F.lit(n).alias("table_name"), F.col("n").alias("_n"), F.col("checksum").alias("_c")) for n in names])
    return meta.join(now, "table_name").select("table_name", "n", "checksum", ((F.col("n") == F.col("_n")) & F.col("checksum").eqNullSafe(F.col("_c"))).alias("ok"))


def manifest_exports(items: DataFrame, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Article and its link tables restricted to the active manifest's items."""
    kept = items.select("article_id").distinct()
    return {n: tables[n].join(kept, "article_id", "left_semi") for n in ("Article", "Author_Article", "Keyword_Article", "Sub_Topic") if n in tables}


def write_tables(tables: list[tuple[str, DataFrame]], path: str) -> None:
    """Tables in their order."""
    for name, df in tables:
        df.write.mode("errorifexists").parquet(f"{path}/{name}")


def write_manifest(items: DataFrame, path: str) -> None:
    items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("manifest_name").parquet(path)

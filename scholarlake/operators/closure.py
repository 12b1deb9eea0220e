"""Dependency closure of a set of articles, and pruning to it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """Kept keys of `parent` are those that kept rows of `via` refer to."""

    parent: str
    key: str
    via: str
    kept_by: str
    on: str


#: Kept sets in dependency order, for the schema's table and key names.
EDGES = (
    Edge("Author", "author_id", "Author_Article", "Article", "article_id"),
    Edge("Keyword", "keyword_id", "Keyword_Article", "Article", "article_id"),
    Edge("Issue", "issue_id", "Article", "Article", "article_id"),
    Edge("Volume", "volume_id", "Issue", "Issue", "issue_id"),
    Edge("Journal", "journal_id", "Volume", "Volume", "volume_id"),
    Edge("Institution", "institution_id", "Institution_Author", "Author", "author_id"),
)

# The stages of a prune, children first.
PRUNE_STAGES = (
    "Journal_Ranking_Subject_Category",
    "Journal_Ranking",
    "Journal_Subject_Category",
    "Sub_Topic",
    "Keyword_Article",
    "Author_Article",
    "Institution_Author",
    "Article",
    "Author",
    "Institution",
    "Keyword",
    "Issue",
    "Volume",
    "Journal",
)

#: By which kept sets a table's rows stay: (column, kept set) pairs, all of which must hold.
KEPT_BY = {
    "Journal_Ranking": (("journal_id", "Journal"),),
    "Journal_Subject_Category": (("journal_id", "Journal"),),
    "Sub_Topic": (("article_id", "Article"),),
    "Keyword_Article": (("article_id", "Article"),),
    "Author_Article": (("article_id", "Article"),),
    "Institution_Author": (("author_id", "Author"),),
    "Article": (("article_id", "Article"),),
    "Author": (("author_id", "Author"),),
    "Institution": (("institution_id", "Institution"),),
    "Keyword": (("keyword_id", "Keyword"),),
    "Issue": (("issue_id", "Issue"),),
    "Volume": (("volume_id", "Volume"),),
    "Journal": (("journal_id", "Journal"),),
    "Journal_Ranking_Subject_Category": (("journal_ranking_id", "Journal_Ranking"),),
}


def kept_through(link: DataFrame, on: str, kept: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys that rows of `link` with a kept `on` refer to."""
    return link.join(kept.select(on), on, "left_semi").where(F.col(key).isNotNull()).select(key).distinct()


def keep_sets(tables: dict[str, DataFrame], articles: DataFrame, protected: dict[str, DataFrame] | None = None, edges: tuple[Edge, ...] = EDGES) -> dict[str, DataFrame]:
    """Kept keys of each table from kept `articles`, together with protected keys."""
    kept = {"Article": articles.select("article_id").distinct()}
    for e in edges:
        if e.via in tables and e.kept_by in kept:
            found = kept_through(tables[e.via], e.on, kept[e.kept_by], e.key)
            if protected and e.parent in protected:
                found = found.union(protected[e.parent].select(e.key)).distinct()
            kept[e.parent] = found
    if "Journal_Ranking" in tables and "Journal" in kept:
        kept["Journal_Ranking"] = tables["Journal_Ranking"].join(kept["Journal"], "journal_id", "left_semi").select("journal_ranking_id")
    return kept


def prune(tables: dict[str, DataFrame], kept: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables without rows outside the closure; tables without a rule stay as they are."""
    out = {}
    for name, df in tables.items():
        for column, by in KEPT_BY.get(name, ()):
            if by in kept:
                df = df.join(kept[by].select(F.col(kept[by].columns[0]).alias(column)), column, "left_semi")
        out[name] = df
    return out


def keep_report(tables: dict[str, DataFrame], pruned: dict[str, DataFrame], total_row: bool = True) -> DataFrame:
    """table_name, total, keep, remove of each pruned table, and their sums as ALL."""
    parts = [tables[n].agg(F.count("*").alias("total")).join(pruned[n].agg(F.count("*").alias("keep"))).select(F.lit(n).alias("table_name"), "total", "keep", (F.col("total") - F.col("keep")).alias("remove")) for n in tables if n in pruned]
    rows = reduce(DataFrame.unionByName, parts)
    if not total_row:
        return rows
    # table names are never null, so the rollup's null is the sum of all
    return rows.rollup("table_name").agg(*(F.sum(c).alias(c) for c in ("total", "keep", "remove"))).withColumn("table_name", F.coalesce("table_name", F.lit("ALL")))


def protected_missing(kept: dict[str, DataFrame], protected: dict[str, DataFrame]) -> DataFrame:
    """Protected keys outside the closure, counted for each table; all must be 0."""
    parts = [protected[n].select(kept[n].columns[0]).distinct().join(kept[n], kept[n].columns[0], "left_anti").agg(F.lit(n).alias("table_name"), F.count("*").alias("missing")) for n in protected if n in kept]
    return reduce(DataFrame.unionByName, parts)


def verify_prune(tables: dict[str, DataFrame], kept: dict[str, DataFrame], items: DataFrame) -> DataFrame:
    """Checks after a prune: no row outside the closure, no article of the manifest missing."""
    again = keep_report(tables, prune(tables, kept), False).select(F.concat(F.lit("closed:"), "table_name").alias("check_name"), (F.col("remove") == 0).alias("ok"), F.col("remove").alias("observed"))
    missing = items.select("article_id").distinct().join(tables["Article"].select("article_id"), "article_id", "left_anti").agg(F.count("*").alias("observed"))
    return again.unionByName(missing.select(F.lit("manifest_complete").alias("check_name"), (F.col("observed") == 0).alias("ok"), "observed"))


def record_stage(checkpoints: DataFrame, run: str, checksum: str, stage: str, removed: DataFrame) -> DataFrame:
    """Checkpoints (run, stage, checksum, status, removed) after a stage of a run is done; `removed` has one row and the column `removed`."""
    done = removed.select(F.lit(run).alias("run"), F.lit(stage).alias("stage"), F.lit(checksum).alias("checksum"), F.lit("done").alias("status"), F.col("removed").cast("long").alias("removed"))
    return checkpoints.where((F.col("run") != run) | (F.col("stage") != stage)).unionByName(done)


def next_stages(checkpoints: DataFrame, run: str, checksum: str, stages: tuple[str, ...] = PRUNE_STAGES) -> list[str]:
    """Stages of a run that are still to do; an error if the manifest changed since the run began."""
    rows = checkpoints.where(F.col("run") == run).select("stage", "checksum", "status").limit(2 * len(stages)).collect()
    if any(r["checksum"] != checksum for r in rows):
        raise ValueError("the manifest's checksum differs from the run's")
    done = {r["stage"] for r in rows if r["status"] == "done"}
    return [s for s in stages if s not in done]

"""Deterministic, field-balanced selection of articles, and its manifest."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S

KEPT = ("article_id", "subject_area_id", "primary_topic", "quality_score", "citation_count", "reference_count", "publication_year")


def best_first() -> list[Column]:
    """What orders articles of equal standing; ends in the id, so that every ranking is total."""
    return [F.desc("quality_score"), F.desc("citation_count"), F.desc("reference_count"), F.desc_nulls_last("publication_year"), F.asc("article_id")]


def article_features(articles: DataFrame, topics: DataFrame) -> DataFrame:
    """Counts, quality score and eligibility of articles, with their topic's area."""
    areas = topics.select(F.col("topic_id").alias("primary_topic"), "subject_area_id")
    return articles.join(areas, "primary_topic", "left").select(
        "article_id",
        "primary_topic",
        "subject_area_id",
        F.coalesce("citation_count", F.lit(0)).alias("citation_count"),
        F.coalesce("reference_count", F.lit(0)).alias("reference_count"),
        "publication_year",
        S.quality_score(F.col("abstract"), F.col("doi"), F.col("references"), F.col("semantic_tldr")).alias("quality_score"),
        S.eligible(F.col("title"), F.col("abstract"), F.col("is_deleted")).alias("eligible"),
    )


def balanced_selection(features: DataFrame, bookmarks: DataFrame, target: int) -> DataFrame:
    """The `target` best articles: bookmarked ones, then one of each topic, then areas in turn over their topics.

    Only the best `target` articles of an area by its turn can be selected, so an area's ranking stops
    there (Spark limits the window's groups), and the last ranking sees `target` rows, not the table.
    """
    by_topic = Window.partitionBy("primary_topic").orderBy(*best_first())
    # a topic's ranking stops at the target too, as later ones come after `target` better articles of that topic
    ranked = features.where("eligible").withColumn("topic_rank", F.row_number().over(by_topic)).where(F.col("topic_rank") <= target)
    by_area = Window.partitionBy(F.coalesce("subject_area_id", F.lit(-1))).orderBy("topic_rank", *best_first())
    turns = ranked.withColumn("area_round_rank", F.row_number().over(by_area).cast("long"))
    pick = lambda df, priority, turn, reason: df.select(*KEPT, F.lit(priority).alias("priority"), turn.alias("area_round_rank"), F.lit(reason).alias("selection_reason"))
    marked = pick(features.join(bookmarks.select("article_id").distinct(), "article_id", "left_semi"), 0, F.lit(0).cast("long"), "bookmarked")
    # from `ranked`: their order needs no turn, and the turns' window keeps its limit
    heads = pick(ranked.where("topic_rank = 1"), 1, F.lit(0).cast("long"), "topic_representative")
    rest = pick(turns.where("topic_rank > 1").where(F.col("area_round_rank") <= target), 2, F.col("area_round_rank"), "subject_area_balanced")
    others = heads.unionByName(rest).join(bookmarks.select("article_id").distinct(), "article_id", "left_anti")
    order = [
        F.col("priority"),
        F.when(F.col("priority") == 2, F.col("area_round_rank")).otherwise(0),
        F.when(F.col("priority") == 1, F.coalesce("subject_area_id", F.lit(-1))).otherwise(0),
        F.when(F.col("priority") == 1, F.coalesce("primary_topic", F.lit(-1))).otherwise(0),
        *best_first(),
    ]
    best = marked.unionByName(others).orderBy(*order).limit(target)
    return best.withColumn("selected_rank", F.row_number().over(Window.orderBy(*order))).select("article_id", "selected_rank", "selection_reason", *KEPT[1:])


def selection_report(selected: DataFrame) -> DataFrame:
    """Counts of a selection and of its areas, in one row."""
    count = lambda reason: F.count_if(F.col("selection_reason") == reason)
    whole = selected.agg(
        F.count("*").alias("selected"),
        F.count_distinct("article_id").alias("articles"),
        count("bookmarked").alias("bookmarked"),
        count("topic_representative").alias("topic_representatives"),
        count("subject_area_balanced").alias("area_balanced"),
        F.count_if(F.col("quality_score") == 4).alias("full_quality"),
        F.round(F.avg("quality_score"), 2).alias("avg_quality"),
        F.min("publication_year").alias("first_year"),
        F.max("publication_year").alias("last_year"),
    )
    areas = selected.where("subject_area_id is not null").groupBy("subject_area_id").agg(F.count("*").alias("n"))
    spread = areas.agg(F.min("n").alias("area_min"), F.max("n").alias("area_max"), F.round(F.avg("n"), 2).alias("area_avg"))
    return whole.join(spread)  # one row each


def selection_checksum(selected: DataFrame) -> DataFrame:
    """md5 of the ids in rank order (their number is bounded by the target), and an order-free checksum."""
    ranked = F.array_sort(F.collect_list(F.struct("selected_rank", "article_id")))
    return selected.agg(F.md5(F.array_join(F.transform(ranked, lambda x: x["article_id"].cast("string")), ",").cast("binary")).alias("checksum"), F.count("*").alias("n"))


def set_checksum(df: DataFrame) -> DataFrame:
    """Order-free checksum of any number of rows."""
    return df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("checksum"))


def stratified_sample(df: DataFrame, stratum: Column, order: list[Column], per_stratum: int) -> DataFrame:
    """The first `per_stratum` rows of each stratum."""
    return df.withColumn("stratum_rank", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("stratum_rank") <= per_stratum)


def first_by_priority(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key: the first by `order`."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


MANIFEST_NAME = re.compile(r"[a-z0-9][a-z0-9_-]{2,63}")


def validate_manifest_name(name: str) -> str:
    if not MANIFEST_NAME.fullmatch(name):
        raise ValueError("a manifest name has 3 to 64 of a-z, 0-9, _ and -, and starts with a letter or digit")
    return name


def activate_manifest(manifests: DataFrame, items: DataFrame, name: str, selected: DataFrame, target: int, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Manifests and items after `selected` is stored as `name` and made the only active one."""
    validate_manifest_name(name)
    if not replace and manifests.where(F.col("manifest_name") == name).limit(1).count():
        raise ValueError(f"manifest {name} exists; replace it explicitly")
    head = selection_checksum(selected).select(F.lit(name).alias("manifest_name"), F.lit(target).cast("long").alias("target_count"), F.col("n").alias("selected_count"), "checksum", F.lit(True).alias("is_active"))
    others = manifests.where(F.col("manifest_name") != name).withColumn("is_active", F.lit(False))
    mine = selected.select(F.lit(name).alias("manifest_name"), "article_id", F.col("selected_rank").alias("rank"), F.col("selection_reason").alias("reason"))
    return others.unionByName(head), items.where(F.col("manifest_name") != name).unionByName(mine)


def active_items(manifests: DataFrame, items: DataFrame) -> DataFrame:
    return items.join(manifests.where("is_active").select("manifest_name"), "manifest_name", "left_semi")


def refuse_while_active(manifests: DataFrame) -> None:
    """Generic copies are refused while a manifest is active."""
    names = [r["manifest_name"] for r in manifests.where("is_active").select("manifest_name").limit(1).collect()]
    if names:
        raise ValueError(f"manifest {names[0]} is active; copy its subset instead")

"""Numbers and digests that depend on the order of all rows, without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.sources.scratch import stored

#: monotonically_increasing_id() holds the partition above these bits and the row's place in it below.
PLACE_BITS = 33


def dense_numbers(df: DataFrame, order: list[Column | str], name: str = "number", first: Column | int = 1, ranges: list[Column | str] | None = None) -> DataFrame:
    """df with consecutive numbers from `first` in the order of `order`, which should be total.

    Rows are sorted into ranges, which are written once; a range's rows are numbered by their place in it, behind the counts of
    the ranges before it. What is ranked in one task is a row for each range. `ranges` are shorter keys that rise with the order, to cut
    the ranges by: their sample passes through the driver.
    """
    ranged = stored(df.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", PLACE_BITS)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    place = F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    numbered = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, (F.col("_before") + place + F.lit(first)).cast("long")).drop("_part", "_place", "_before")


def digest_leaves(df: DataFrame, order: list[str], block: int = 1024) -> DataFrame:
    """leaf, n, first, last, digest: each `block` rows in order, with their first and last keys and the md5 of their texts.

    `order` is the row's key; a row's text is its values in JSON, in the order of the columns.
    """
    numbered = dense_numbers(df, order, "_number", 0)
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    keyed = numbered.select(F.floor(F.col("_number") / block).alias("leaf"), "_number", F.struct(*order).alias("key"), F.md5(text.cast("binary")).alias("h"))
    rows = F.array_sort(F.collect_list(F.struct("_number", "h")))  # at most `block`
    joined = F.array_join(F.transform(rows, lambda r: r["h"]), "")
    return keyed.groupBy("leaf").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"), F.md5(joined.cast("binary")).alias("digest"))


def tree_digest(leaves: DataFrame, fan: int = 1024) -> str:
    """The root over leaves: md5 of the digests of `fan` neighbours, level by level. Equal for equal rows in equal order, however partitioned."""
    level = leaves.select(F.col("leaf").alias("node"), "digest")
    while True:
        parts = F.array_sort(F.collect_list(F.struct("node", "digest")))  # at most `fan`
        level = stored(level.groupBy(F.floor(F.col("node") / fan).alias("up")).agg(F.md5(F.array_join(F.transform(parts, lambda r: r["digest"]), "").cast("binary")).alias("digest")).withColumnRenamed("up", "node"))
        top = level.limit(2).collect()
        if len(top) < 2:
            return top[0]["digest"] if top else ""


def differing_leaves(one: DataFrame, other: DataFrame) -> DataFrame:
    """leaf, first, last of what differs between two tables' leaves, keys from the first table that has the leaf.

    Leaves count rows, so from the first row that one table lacks on, all differ: the least leaf holds the first difference.
    """
    named = lambda df, p: df.select("leaf", *(F.col(c).alias(f"{p}{c}") for c in ("first", "last", "digest")))
    both = named(one, "a_").join(named(other, "b_"), "leaf", "full")
    return both.where(~F.col("a_digest").eqNullSafe(F.col("b_digest"))).select("leaf", F.coalesce("a_first", "b_first").alias("first"), F.coalesce("a_last", "b_last").alias("last"))

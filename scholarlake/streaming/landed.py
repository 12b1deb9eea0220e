"""Stream of landed works pages into table snapshots or versioned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scholarlake.functions import scalars as S
from scholarlake.sources.readers import WORKS_PAGE, works_of
from scholarlake.sources.versioned import VersionedTables


def works_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 100, multi_line: bool = True) -> DataFrame:
    """Works of pages as they land, one a file or, without `multi_line`, one a line; the checkpoint remembers which files were read.

    A batch is so many files or, with None, all that have landed since the last one.
    """
    reader = spark.readStream.schema(WORKS_PAGE).option("multiLine", multi_line)
    return works_of((reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).json(path))


def articles_of(works: DataFrame, *keep: str) -> DataFrame:
    """Article rows of works, with the columns `keep` of the works."""
    return works.select(
        *keep,
        F.substring("title", 1, 255).alias("title"),
        S.abstract_from_index("abstract_inverted_index").alias("abstract"),
        S.normalize_doi("doi").alias("doi"),
        F.col("publication_year"),
        F.col("primary_topic.display_name").alias("topic"),
        S.score_or_zero(F.col("primary_topic.score")).alias("topic_score"),
        F.col("cited_by_count").alias("citation_count"),
        F.coalesce(F.col("referenced_works_count"), F.greatest(F.size("referenced_works"), F.lit(0)).cast("long")).alias("reference_count"),
        F.col("referenced_works").alias("references"),
        S.volume_number("biblio.volume").alias("volume"),
        F.substring("biblio.issue", 1, 50).alias("issue"),
    )


def authors_of(works: DataFrame) -> DataFrame:
    """Distinct authors of works, without those that have no name."""
    a = works.select(F.explode("authorships.author").alias("a")).select(S.id_tail("a.id").alias("openalex_id"), S.orcid_url("a.orcid").alias("orcid"), F.col("a.display_name").alias("display_name"))
    return a.where("display_name is not null").distinct()


def run_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Apply a table function to every batch of what has landed, then stop. `apply` must give the same result if a batch id is repeated."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshot_writer(path: str, transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch function that writes batch N to <path>/batch=N, replacing what a failed try left."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return apply


def merge_writer(store: VersionedTables, writer: str, merge: Callable[[DataFrame, dict[str, DataFrame]], dict[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
    """A batch function that merges batch N into the newest version and commits the tables that the merge returns as the next.

    A batch that comes again after its commit changes nothing; one that broke before it is merged anew into the same version.
    A merge that reads its batch more than once should store what it takes of it, as pipelines.sync_works does.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        done = store.writer(writer)
        if done is not None and done["sequence"] >= batch_id:
            return
        tables = store.read()
        merged = merge(batch, tables)
        store.commit({n: df for n, df in merged.items() if df is not tables.get(n)}, writer, batch_id)

    return apply

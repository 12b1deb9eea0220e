"""Tables written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; below one of our own only under a local master without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base}/tables-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The table as written and read back: lineage ends there and survives lost executors."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

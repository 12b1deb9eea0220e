"""Operator 8: stable shards by jump consistent hashing.

A row's shard depends on its key and the number of shards alone: no ring, no table. With one shard
more, a row stays or moves to the new shard. Slots are gapless from 0 in each shard: rows are numbered
inside bounded buckets of a shard and buckets are offset by their counts, so no task orders a shard.

Law held: `key`. Text sizes and checksums are computed in the scan; only small rows are shuffled.

Defined results: null text has size 1 and the checksum of the empty text; a null doc_id is keyed like
its own constant; repeated rows share a shard and get different slots; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, shuffles

BUCKET_ROWS = 50_000
#: Stands for a null key.
NULL_KEY = -0x61C8864680B583EB


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; expected steps grow with the logarithm of `shards`."""
    key = mix(keys.astype(np.int64).view(np.uint64).copy())
    at = np.full(len(key), -1, np.int64)
    nxt = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        at[live] = nxt[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        nxt[live] = ((at[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        live = live[nxt[live] < shards]
    return at


def assign_shards(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each document; see the module text."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([NULL_KEY if k is None else k for k in b.column("doc_id").to_pylist()], np.int64) if b.column("doc_id").null_count else b.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(jump(keys, shards).astype(np.int32)), pa.array(jump(keys, shards + 1).astype(np.int32))], names=[*b.schema.names, "shard", "grown_shard"])

    dealt = rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, shard int, grown_shard int")
    buckets = max(1, documents.count() // (BUCKET_ROWS * shards), shuffles(documents.sparkSession) // shards)
    # an even hash of all that a row has, so that one repeated doc_id does not fill a bucket unless its rows are equal
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        dealt.withColumn("nth", nth)
        .join(F.broadcast(offsets) if buckets * shards <= 100_000 else offsets, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("nth") - 1).alias("slot"), "grown_shard")
    )

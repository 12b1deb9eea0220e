"""Shared helpers of the training-data operators: tables, shared scratch, byte buffers.

Texts reach numpy as one byte buffer per bounded chunk of documents, so no
operator pays Python calls per byte or per word.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one numpy pass takes at once.
CHUNK_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_POWERS: tuple[np.ndarray, np.ndarray] | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read only through Spark so that any Hadoop store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only where unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_scholarlake_scratch", None) or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark._scholarlake_scratch = base
    return f"{base}/scholarlake-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def widened(df: DataFrame, **kinds: str) -> StructType:
    """df's schema with more columns at its end (df.schema itself must not change)."""
    out = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, on: list[str], shares: int) -> DataFrame:
    """(key, _parts) of the keys with more than one of `shares` equal shares of all rows, which are fewer than `shares`.

    The most frequent key is always there, hot or not, so that joins to this table have one plan at every size.
    """
    total, top = counts.agg(F.sum("k"), F.max_by(F.struct(*on), "k")).first()
    if top is None:
        return counts.select(*on, F.lit(1).alias("_parts")).limit(0)
    is_top = reduce(and_, (F.col(c).eqNullSafe(F.lit(top[c])) for c in on))
    return counts.where((F.col("k") * shares > total) | is_top).select(*on, F.ceil(F.col("k") * shares / total).cast("int").alias("_parts"))


def dealt_join(rows: DataFrame, other: DataFrame, on: list[str], spread: list[str], counts: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """rows joined to other, with the rows of hot keys dealt to several parts by a hash of their `spread` columns.

    A hot key has a part for each of 4 * shuffle partitions equal shares that its rows fill; `other` is copied once a part.
    The hot keys are fewer than the shares, which bounds the broadcast without a sort of all keys. `counts` holds
    each key's number of rows `k`; without it stored `rows` are counted.
    """
    counts = rows.groupBy(*on).agg(F.count("*").alias("k")) if counts is None else counts
    hot = F.broadcast(hot_keys(counts, on, 4 * shuffles(rows.sparkSession)))
    left = rows.join(hot, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    right = other.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [*on, "_part"], how).drop("_part")


#: Type of row_key().
ROW = "struct<a:long,b:long>"


def row_key() -> F.Column:
    """Internal 128-bit key of a document row: its doc_id (or a hash, where there is none) and a hash of its text.

    Equal rows share it; rows that only share a doc_id do not.
    """
    text, none = F.coalesce("text", F.lit("")), F.col("doc_id").isNull()
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), text)).alias("a"), F.xxhash64(text, F.col("text").isNull(), none).alias("b"))


def text_chunks(texts: pa.Array, tail: bytes = b"", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of rows of at most `limit` bytes or one row.

    Nulls are empty texts. `tail` follows each text in the buffer (offsets include it).
    """
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if tail:
        texts = pc.binary_join_element_wise(texts, pa.scalar(tail, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def cut_ranges(buf: np.ndarray, ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about `limit` bytes that end behind bytes where `ends` (by byte value) holds; longer where there is none."""
    at = 0
    while at < len(buf):
        stop = min(len(buf), at + limit)
        while stop < len(buf):
            low = max(at, stop - limit)
            found = np.flatnonzero(ends[buf[low:stop]])
            if len(found):
                stop = low + int(found[-1]) + 1
                break
            stop = min(len(buf), stop + limit)
        yield at, stop
        at = stop


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M^i and M^-i modulo 2^64 for i < n."""
    global _POWERS
    if _POWERS is None or len(_POWERS[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        up, down = np.full(n, _MULT, np.uint64), np.full(n, _INV, np.uint64)
        up[0] = down[0] = 1
        _POWERS = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, in place on uint64."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """C with C[j] - C[i] = sum of data[t] * M^t over i <= t < j, modulo 2^64."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def word_spans(buf: np.ndarray, is_word: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the maximal runs of word bytes.

    The buffer is cut at bytes outside words into pieces of about CHUNK_BYTES, so that memory per
    byte stays bounded for a text of any length.
    """
    starts, ends, hashes, at = [], [], [], 0
    while at < len(buf):
        stop = min(len(buf), at + CHUNK_BYTES)
        if stop < len(buf):
            gaps = np.flatnonzero(~is_word[buf[at:stop]])
            while not len(gaps) and stop < len(buf):
                stop = min(len(buf), stop + CHUNK_BYTES)
                gaps = np.flatnonzero(~is_word[buf[at:stop]])
            stop = at + int(gaps[-1]) + 1 if len(gaps) and stop < len(buf) else stop
        part = buf[at:stop]
        edge = np.diff(is_word[part].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = prefix_sums(lower[part])
        h = (sums[e] - sums[s]) * powers(len(part) + 1)[1][s]
        h += (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(mix(h))
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def ascii_lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated start, start+1, ... of every (start, length)."""
    total = int(lengths.sum())
    out = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(starts) else np.zeros(0, np.int64)
    return out + np.arange(total)

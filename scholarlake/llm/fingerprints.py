"""Operator 13: document fingerprints by quartile bucket digests.

Every three neighbouring bytes of a text are hashed to one of 256 buckets. A digest holds a checksum byte, the text's length
on a logarithmic scale, and for each bucket by how many of the three quartiles of all bucket counts its count is exceeded. Two
digests are compared by a bounded difference: steps between bucket codes (a step over all quartiles counts six) against
the steps that unrelated digests of the same codes would have, and length steps.

`fingerprint_successors` compares each text with the next document's, and with itself after its last half gave way to the next
document's beginning. Texts move once, to the ranges of doc_id that Spark sorts; each range's first and last rows meet afterwards.

Defined results: null text is empty; an empty text has no triplets, and texts of one or two bytes are padded to
three; null doc_ids come first; rows of one doc_id are ordered by a hash of their texts, and repeated rows follow one another; a
single row follows itself; an empty table gives no rows; other columns are ignored. Very long texts are counted
in pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, shuffles, stored

BUCKETS = 256
#: Difference of two bucket codes, by the steps between them.
STEP_COST = np.array([0, 1, 2, 6])
#: Length steps to a doubling, and the number of them that costs the most that a length can cost.
DOUBLING, MOST_LENGTH = 8, 64
LENGTH_SHARE = 0.5

ROWS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """How many triplets of each text fall in each bucket."""
    out = np.zeros((len(texts), BUCKETS), np.int64)
    pieces: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        if not pieces:
            return
        lengths = np.array([len(p) for p in pieces])
        b = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint32)
        bucket = ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(24)
        inside = np.ones(len(b), bool)
        ends = np.cumsum(lengths)
        inside[ends - 1] = inside[ends - 2] = False  # triplets that would reach into the next piece
        key = np.repeat(np.arange(len(pieces)) * BUCKETS, lengths)[:-2] + bucket
        np.add.at(out, owners, np.bincount(key[inside[:-2]], minlength=len(pieces) * BUCKETS).reshape(-1, BUCKETS))
        pieces.clear()
        owners.clear()

    size = 0
    for i, t in enumerate(texts):
        t = t.ljust(3, b"\0") if t else t
        for at in range(0, max(0, len(t) - 2), CHUNK_BYTES):
            pieces.append(t[at : at + CHUNK_BYTES + 2])
            owners.append(i)
            size += len(pieces[-1])
            if size >= CHUNK_BYTES:
                flush()
                size = 0
    flush()
    return out


class Digests:
    """Digests of some texts as arrays: checksums, lengths, bucket codes."""

    def __init__(self, checks: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
        self.checks, self.lengths, self.codes = checks, lengths, codes

    @classmethod
    def of(cls, texts: list[bytes]) -> Digests:
        counts = bucket_counts(texts)
        at = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
        quartiles = np.partition(counts, at, axis=1)[:, at]
        codes = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2, dtype=np.uint8)
        lengths = np.minimum(255, DOUBLING * np.log2(1 + np.array([len(t) for t in texts], float))).astype(np.uint8)
        return cls(np.array([zlib.crc32(t) & 255 for t in texts], np.uint8), lengths, codes)

    @classmethod
    def read(cls, fingerprints: list[str]) -> Digests:
        raw = np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(len(fingerprints), 2 + BUCKETS // 4)
        codes = (raw[:, 2:, None] >> np.arange(0, 8, 2, dtype=np.uint8)) & 3
        return cls(raw[:, 0], raw[:, 1], codes.reshape(len(fingerprints), BUCKETS))

    def texts(self) -> list[str]:
        packed = (self.codes.reshape(len(self.codes), -1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)
        return [r.tobytes().hex() for r in np.column_stack([self.checks, self.lengths, packed])]

    def __getitem__(self, rows: slice) -> Digests:
        return Digests(self.checks[rows], self.lengths[rows], self.codes[rows])

    def __add__(self, other: Digests) -> Digests:
        return Digests(np.concatenate([self.checks, other.checks]), np.concatenate([self.lengths, other.lengths]), np.concatenate([self.codes, other.codes]))


def likeness(a: Digests, b: Digests) -> np.ndarray:
    """1 for equal digests, 0 for those that differ as much as unrelated ones or more; row by row."""
    steps = STEP_COST[np.abs(a.codes.astype(np.int8) - b.codes.astype(np.int8))].sum(axis=1)
    shares = [np.stack([(d.codes == c).mean(axis=1) for c in range(4)], axis=1) for d in (a, b)]
    unrelated = BUCKETS * np.einsum("iu,iv,uv->i", *shares, STEP_COST[np.abs(np.subtract.outer(np.arange(4), np.arange(4)))])
    body = np.minimum(1, steps / np.maximum(unrelated, 1))
    length = np.minimum(1, np.abs(a.lengths.astype(int) - b.lengths.astype(int)) / MOST_LENGTH)
    # texts of equal codes and lengths that are not one text differ in the checksum, most of them
    check = (a.checks != b.checks) / (2 * BUCKETS)
    return np.maximum(0, 1 - np.minimum(1, body + LENGTH_SHARE * length + check))


def edited(text: str, following: str) -> str:
    """The text whose last half gave way to the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list[int | None], texts: list[str], following: list[str], own: Digests, after: Digests) -> list:
    changed = [edited(t, f).encode() for t, f in zip(texts, following)]
    of_changed = Digests.of(changed)
    return [ids, [len(t) for t in texts], [hashlib.sha256(c).hexdigest() for c in changed], own.texts(), of_changed.texts(), likeness(own, of_changed), likeness(own, after)]


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
FINISHED, FIRST, LAST = 0, 1, 2


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of runs of rows of at most CHUNK_BYTES or one row."""
    for batch in batches:
        lengths = np.frombuffer(batch.column("size").cast(pa.int64()).to_numpy(zero_copy_only=False), np.int64)
        ends, lo = np.cumsum(lengths), 0
        while lo < len(ends):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
            yield batch.column("doc_id")[lo:hi].to_pylist(), batch.column("text")[lo:hi].to_pylist()
            lo = hi


def fingerprint_successors(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; see the module text."""
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    # the last key keeps repeated rows from filling one range
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).alias("size"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("u"))
    order = ["doc_id", "h", "u"]
    ranged = rows.repartitionByRange(shuffles(spark), *order).sortWithinPartitions(*order).select("doc_id", "text", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_FIELDS, ("part", pa.int32()), ("kind", pa.int32()), ("text", pa.string())])
        part = TaskContext.get().partitionId()
        edge = lambda kind, i, t: _batch([[i], *([None] for _ in range(6)), [part], [kind], [t]], schema)
        ids: list = []
        texts: list[str] = []
        waiting: Digests | None = None  # of the last row so far, whose successor has not come
        for more_ids, more in _bounded(batches):
            digests = Digests.of([t.encode() for t in more])
            if waiting is None:
                yield edge(FIRST, more_ids[0], more[0])
            else:
                digests = waiting + digests
            ids, texts = ids + more_ids, texts + more
            if n := len(ids) - 1:
                yield _batch([*_compared(ids[:n], texts[:n], texts[1:], digests[:n], digests[1:]), [part] * n, [FINISHED] * n, [None] * n], schema)
            ids, texts, waiting = ids[n:], texts[n:], digests[n:]
        if ids:
            yield edge(LAST, ids[0], texts[0])

    def join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(_FIELDS)
        for batch in batches:
            for i, t, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
                yield _batch(_compared([i], [t], [following], Digests.of([t.encode()]), Digests.of([following.encode()])), schema)

    out = stored(ranged.mapInArrow(run, f"{ROWS}, part int, kind int, text string"))
    first = out.where(F.col("kind") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # one row for each range; the first range comes after the last
    parts = first.select(F.col("next_part").alias("part"))
    turn = Window.orderBy("part")
    successors = parts.select("part", F.coalesce(F.lead("part").over(turn), F.min("part").over(Window.partitionBy())).alias("next_part"))
    last = out.where(F.col("kind") == LAST).select("doc_id", "text", "part").join(successors, "part").join(first, "next_part")
    return out.where(F.col("kind") == FINISHED).select(*(n for n, _ in _FIELDS)).unionByName(last.select("doc_id", "text", "following").mapInArrow(join_ranges, ROWS))

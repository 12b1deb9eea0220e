"""Operator 7: reversible line dedup with sharded cuckoo filters over exact reference counts.

State is one exact table (shard, shards, k1, k2, refs, last): how many documents hold a line key, and the largest doc_id
that does. Adding and deleting documents add and subtract, so every step can be undone; where the last holder is deleted, the
one before it is looked up in the table of holders (k1, k2, doc_id), for those keys alone. Documents that are judged by a stored
state so lose what they would lose in one batch with all that it counts. The keys that reach `min_docs` are also in one
cuckoo filter per shard; keys that reach it later are inserted, and keys that fall below it are deleted.

Line keys are dealt to their shard, where they stream past the shard's filter and then its exact table:
(shard, salt) parts get the shard's state first, then keys, so that a task holds one shard's frequent keys
and never its postings. The salt follows the row, so that a line of very many documents is several tasks'
work. Nothing is broadcast, at any size.

A key is the line without blanks ([\\x20\\x09-\\x0D]) at both ends and with A-Z lower-cased. Keys of at
least `min_chars` code points in at least `min_docs` documents (different doc_ids) lose all lines but those of
the largest doc_id that holds them.

Defined results: null and empty texts are one empty line; rows of one doc_id are one document, and all rows
of the largest doc_id keep their lines; rows without doc_id do not count and lose nothing; an empty table gives
no rows; extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, free_name, mix, row_key, shuffles, stored, widened

BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
#: Parts that a shard's postings are dealt to.
SALTS = 8


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """Key of every line; None where it is too short to count."""
    out = []
    for line in text.split(b"\n"):
        k = line.strip(BLANKS).lower()
        out.append(k if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "replace")) >= min_chars) else None)
    return out


class CuckooFilter:
    """Four 16-bit fingerprints a bucket; keys are pairs of 64-bit hashes."""

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / (self.SLOTS * 0.8)))))
        self.cells = np.zeros((self.buckets, self.SLOTS), np.uint16)

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fp = (k2.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        i = (mix(k1.view(np.uint64).copy()) & np.uint64(self.buckets - 1)).astype(np.int64)
        return fp, i, self.other(i, fp)

    def other(self, i: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return i ^ (mix(fp.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if some key found no place; the caller rebuilds larger."""
        fp, i, j = self.places(k1, k2)
        for turn in range(2):  # whole arrays first: as many as fit beside each other
            at = (i, j)[turn]
            by = np.argsort(at, kind="stable")
            at, fp, i, j = at[by], fp[by], i[by], j[by]
            nth = np.arange(len(at)) - np.searchsorted(at, at, "left")
            free = self.cells[at] == 0
            slot = np.cumsum(free, 1)
            fits = nth < slot[:, -1]
            where = np.argmax(free & (slot == (nth + 1)[:, None]), 1)
            self.cells[at[fits], where[fits]] = fp[fits]
            fp, i, j = fp[~fits], i[~fits], j[~fits]
        rng = np.random.default_rng(0)
        for f, at in zip(fp, i):  # the few left over displace others
            for _ in range(self.KICKS):
                if len(free := np.flatnonzero(self.cells[at] == 0)):
                    self.cells[at, free[0]] = f
                    break
                s = rng.integers(self.SLOTS)
                f, self.cells[at, s] = self.cells[at, s], f
                at = self.other(np.array([at]), np.array([f]))[0]
            else:
                return False
        return True

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, i, j = self.places(k1, k2)
        return ((self.cells[i] == fp[:, None]) | (self.cells[j] == fp[:, None])).any(1)

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Take out keys that were inserted."""
        for f, i, j in zip(*self.places(k1, k2)):
            for at in (i, j):
                if len(s := np.flatnonzero(self.cells[at] == f)):
                    self.cells[at, s[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        out = cls(1)
        out.cells = np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy()
        out.buckets = len(out.cells)
        return out

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        capacity = len(k1)
        while not (out := cls(capacity)).insert(k1, k2):
            capacity *= 2
        return out


def _postings(docs: DataFrame, min_chars: int) -> DataFrame:
    """(row, doc_id, k1, k2): the different countable keys of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            keys, counts = [], np.zeros(len(batch), np.int64)
            for n, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                own = {digest(k) for k in line_keys(text or b"", min_chars) if k is not None}
                counts[n] = len(own)
                keys += own
            k = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(batch)), counts))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(at), batch.column("doc_id").take(at), pa.array(k[:, 0]), pa.array(k[:, 1])], names=["row", "doc_id", "k1", "k2"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, f"row {ROW}, doc_id long, k1 long, k2 long")


def _keyed(documents: DataFrame) -> DataFrame:
    """row, doc_id, text of the rows that count."""
    return documents.where("doc_id is not null").select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _counted(documents: DataFrame, postings: DataFrame) -> DataFrame:
    """(k1, k2, refs, last): in how many doc_ids a key is, and the largest of them."""
    twice = stored(documents.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("count > 1").select("doc_id"))
    if twice.limit(1).count():  # keys of doc_ids with several rows count once
        again = postings.join(twice, "doc_id", "left_semi").select("doc_id", "k1", "k2").distinct()
        postings = postings.join(twice, "doc_id", "left_anti").select("doc_id", "k1", "k2").unionByName(again)
    return postings.groupBy("k1", "k2").agg(F.count("*").alias("refs"), F.max("doc_id").alias("last"))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumns({"shard": F.pmod("k1", F.lit(shards)).cast("int"), "shards": F.lit(shards)})


def count_lines(documents: DataFrame, min_chars: int = MIN_CHARS, shards: int | None = None) -> DataFrame:
    """The reference-count table (shard, shards, k1, k2, refs, last) of `documents`."""
    n = shards or shuffles(documents.sparkSession)
    return _sharded(_counted(documents, stored(_postings(_keyed(documents), min_chars))), n).select("shard", "shards", "k1", "k2", "refs", "last")


def line_holders(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id): which documents hold which line keys; what a deletion needs beside the counts."""
    return _postings(_keyed(documents), min_chars).select("k1", "k2", "doc_id").distinct()


def shard_count(refs: DataFrame) -> int:
    """The number of shards that a reference-count table was made with; that of the session's shuffles for an empty one."""
    some = refs.select("shards").first()
    return some["shards"] if some else shuffles(refs.sparkSession)


def update_counts(refs: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None, holders: DataFrame | None = None, min_chars: int = MIN_CHARS) -> DataFrame:
    """The table after documents (whose doc_ids are new, or were added before) are added and deleted; deleting what was added gives the old table.

    `holders`: line_holders of the documents that `refs` counts (others may be there too if they are added or removed now); without it, a
    deletion of a key's largest doc_id is refused if the key stays.
    """
    n = shard_count(refs)
    total = refs.withColumn("gone", F.lit(None).cast("long"))
    for docs, sign in ((added, 1), (removed, -1)):
        if docs is not None:
            now = count_lines(docs, min_chars, n)
            is_new = F.lit(sign > 0)
            total = total.unionByName(now.select("shard", "shards", "k1", "k2", (F.col("refs") * sign).alias("refs"), F.when(is_new, F.col("last")).alias("last"), F.when(~is_new, F.col("last")).alias("gone")))
    keys = ["shard", "shards", "k1", "k2"]
    summed = total.groupBy(*keys).agg(F.sum("refs").alias("refs"), F.max("last").alias("last"), F.max("gone").alias("gone")).where("refs > 0")
    if removed is None:
        return summed.drop("gone")
    summed = stored(summed)
    is_lost = F.coalesce(F.col("gone") >= F.col("last"), F.lit(False))
    lost = summed.where(is_lost).drop("last", "gone")
    if holders is None:
        if lost.limit(1).count():
            raise ValueError("the largest doc_id of a line is deleted: give the holders")
        return summed.drop("gone")
    there = holders if added is None else holders.unionByName(line_holders(added, min_chars))
    left = there.join(removed.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_anti")
    found = left.join(lost.select("k1", "k2"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.max("doc_id").alias("last"))
    return summed.where(~is_lost).drop("gone").unionByName(lost.join(found, ["k1", "k2"]))


def build_filters(frequent: DataFrame) -> DataFrame:
    """(shard, filter): one cuckoo filter for each shard of (shard, k1, k2)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "filter": [CuckooFilter.of(pdf["k1"].to_numpy(), pdf["k2"].to_numpy()).to_bytes()]})

    return frequent.select("shard", "k1", "k2").groupBy("shard").applyInPandas(run, "shard int, filter binary")


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The filters after the counts went from `before` to `after`: keys that reached min_docs are inserted, those that fell below it deleted.

    A shard that has no filter yet, or whose filter is full, gets a new one from its exact keys.
    """
    is_frequent = lambda df, name: df.where(F.col("refs") >= min_docs).select("shard", "k1", "k2", F.lit(True).alias(name))
    changes = is_frequent(before, "was").join(is_frequent(after, "now"), ["shard", "k1", "k2"], "full").where("was is null or now is null")
    changes = stored(changes.groupBy("shard").agg(F.collect_list(F.struct("k1", "k2", F.col("now").isNotNull().alias("now"))).alias("changes")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, changed in zip(batch.column("filter").to_pylist(), batch.column("changes").to_pylist()):
                changed = changed or []
                keys = lambda now: [np.array([x[k] for x in changed if x["now"] is now], np.int64) for k in ("k1", "k2")]  # noqa: E731,B023
                if raw is not None and changed:
                    f = CuckooFilter.from_bytes(raw)
                    f.delete(*keys(False))
                    raw = f.to_bytes() if f.insert(*keys(True)) else None
                out.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(out, pa.binary())], names=["shard", "filter"])

    next_ = stored(filters.join(changes, "shard", "full").select("shard", "filter", "changes").mapInArrow(run, "shard int, filter binary"))
    full = next_.where("filter is null").select("shard")
    return next_.where("filter is not null").unionByName(build_filters(is_frequent(after, "now").join(full, "shard", "left_semi")))


def _shard_states(frequent: DataFrame, filters: DataFrame) -> DataFrame:
    """(shard, filter, exact): each shard's filter beside its exact table of frequent keys (k1, k2, last), packed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.sort_values(["k1", "k2"])[["k1", "k2", "last"]].to_numpy(np.int64)
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "exact": [np.ascontiguousarray(table).tobytes()]})

    exact = frequent.select("shard", "k1", "k2", "last").groupBy("shard").applyInPandas(run, "shard int, exact binary")
    return filters.join(exact, "shard")


def _lost_lines(postings: DataFrame, states: DataFrame, shards: int) -> DataFrame:
    """(row, k1, k2) of lines that go: of frequent keys, in another document than the last."""
    none = lambda kind: F.lit(None).cast(kind)
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    first = states.select("shard", parts, "filter", "exact", none(ROW).alias("row"), none("long").alias("doc_id"), none("long").alias("k1"), none("long").alias("k2"))
    keys = postings.select(F.pmod("k1", F.lit(shards)).cast("int").alias("shard"), F.pmod(F.col("row.b"), F.lit(SALTS)).cast("int").alias("salt"), none("binary").alias("filter"), none("binary").alias("exact"), "row", "doc_id", "k1", "k2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, table, own = None, None, None
        for batch in batches:
            is_state = batch.column("filter").is_valid().to_numpy(zero_copy_only=False)
            shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(is_state | np.concatenate([[True], (shard[1:] != shard[:-1])]))
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(batch)]):
                if is_state[lo]:
                    filter_, own = CuckooFilter.from_bytes(batch.column("filter")[lo].as_py()), shard[lo]
                    table = np.frombuffer(batch.column("exact")[lo].as_py(), np.int64).reshape(-1, 3)
                    lo += 1
                if lo >= hi or own != shard[lo]:
                    continue  # a shard without frequent keys
                part = batch.slice(lo, hi - lo)
                part = part.take(pa.array(np.flatnonzero(filter_.contains(part.column("k1").to_numpy(), part.column("k2").to_numpy()))))
                k1, k2, doc = (part.column(c).to_numpy() for c in ("k1", "k2", "doc_id"))
                at, end = np.searchsorted(table[:, 0], k1, "left"), np.searchsorted(table[:, 0], k1, "right")
                goes = np.zeros(len(k1), bool)
                while (live := np.flatnonzero(at < end)).size:  # more than one turn only where two keys share k1
                    goes[live] |= (table[at[live], 1] == k2[live]) & (doc[live] < table[at[live], 2])
                    at += 1
                yield part.select(["row", "k1", "k2"]).take(pa.array(np.flatnonzero(goes)))

    dealt = first.unionByName(keys).repartition(shuffles(postings.sparkSession), "shard", "salt")
    return dealt.sortWithinPartitions("shard", "salt", F.col("filter").isNull()).mapInArrow(run, f"row {ROW}, k1 long, k2 long")


def drop_repeated_lines(documents: DataFrame, refs: DataFrame | None = None, filters: DataFrame | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, counts: tuple[str, str] = ("_n_lines", "_n_dropped")) -> DataFrame:
    """documents with `text` replaced by what stays, plus the columns `counts` (lines before, dropped lines); their names must be free.

    refs, filters: the reference counts to judge by, and their filters; those of `documents` by default.
    """
    spark = documents.sparkSession
    postings = stored(_postings(_keyed(documents), min_chars))
    found = _counted(documents, postings)
    shards = shuffles(spark) if refs is None else shard_count(refs)
    if refs is not None:
        found = found.select("k1", "k2", F.col("last").alias("own")).join(refs.select("k1", "k2", "refs", "last"), ["k1", "k2"]).withColumn("last", F.greatest("own", "last"))
    frequent = stored(_sharded(found.where(F.col("refs") >= min_docs), shards))
    states = stored(_shard_states(frequent, build_filters(frequent) if filters is None else filters))
    row, gone = free_name(documents, "_row"), free_name(documents, "_keys")
    drops = _lost_lines(postings, states, shards).groupBy(F.col("row").alias(row)).agg(F.collect_set(F.struct("k1", "k2")).alias(gone))
    wide = documents.withColumn(row, row_key()).join(drops, row, "left").drop(row)
    schema = widened(documents, **dict.fromkeys(counts, "long"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            lost = batch.column(gone)
            for i, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                text = text or b""
                n_lines.append(text.count(b"\n") + 1)
                drop = {np.array([x["k1"], x["k2"]], np.int64).tobytes() for x in lost[i].as_py() or ()}
                if drop:
                    kept = [line for line, k in zip(text.split(b"\n"), line_keys(text, min_chars)) if k is None or digest(k) not in drop]
                    n_dropped.append(n_lines[-1] - len(kept))
                    text = b"\n".join(kept)
                else:
                    n_dropped.append(0)
                texts.append(text)
            cols = [batch.column(f.name) if f.name != "text" else pa.array(texts, pa.binary()).cast(pa.string()) for f in schema.fields[:-2]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=schema.names)

    return wide.mapInArrow(rewrite, schema)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
with l as (
  select doc_id, r, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, r, ls[i] as line, i from (select doc_id, r, ls, unnest(range(1, len(ls) + 1)) as i from (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as ls from documents)))
), f as (select k, max(doc_id) as last from l where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
m as (select l.doc_id, r, i, line, f.k is not null and coalesce(l.doc_id <> f.last, false) as gone from l left join f using (k))
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by r, doc_id
"""

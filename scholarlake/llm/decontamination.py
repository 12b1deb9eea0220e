"""Operator 3: benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of every benchmark item (an item of fewer words,
but not none, is one pattern). Patterns of one length form one Wu-Manber table: blocks of two words,
a shift table over block hashes that says how far the search may skip, and buckets keyed by the hash
of a pattern's last block. Where the shift is zero the bucket's patterns are confirmed word by word.
Many search positions advance at once in numpy; no Python runs per word.

Tasks build the tables, each of at most BLOCK_ITEMS items and BLOCK_CHARS characters (or one longer item), and write them
to the shared folder. A shift table has 16 to 32 slots for each of its patterns, so that its skips do not shrink as patterns
grow. The driver hands on PASS_BLOCKS of them as broadcasts for one pass over the documents, so that what is broadcast
is bounded for a benchmark of any size.

Defined results: null or empty text has no words; an item without words occurs nowhere; items of one
item_id are one item; an item without item_id marks words like any other, all such items count as one in the
number of items, and lists of items hold NULL for them (their digest leaves it out); an empty benchmark or
documents table gives clean rows or none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, ascii_lower, free_name, mix, ranges, row_key, stored, text_chunks, word_spans

WINDOW = 10
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8 << 20
#: Blocks that one pass over the documents searches; their summed tables are what is broadcast at once.
PASS_BLOCKS = 2
#: log2 of the least number of slots for each pattern of a shift table.
SPARE_BITS = 4
#: Words that one search position covers.
STRIDE = 256

LOWER = ascii_lower()
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x41:0x5B] = WORD[0x80:] = True


def _block_hashes(words: np.ndarray, block: int) -> np.ndarray:
    """Hash of every block of consecutive words."""
    return mix(words.copy() if block == 1 else words[:-1] * np.uint64(3) + words[1:])


def _distinct(hashes: np.ndarray, raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of runs of equal strings in it) of the byte strings raw[at : at + size], which have these hashes."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    alike = np.flatnonzero((hashes[order][1:] == hashes[order][:-1]) & (size[order][1:] == size[order][:-1])) + 1
    for lo in range(0, len(alike), 1 << 16):
        now, last, n = order[alike[lo : lo + (1 << 16)]], order[alike[lo : lo + (1 << 16)] - 1], size[order[alike[lo : lo + (1 << 16)]]]
        differ = raw[ranges(at[now], n)] != raw[ranges(at[last], n)]
        new[alike[lo : lo + (1 << 16)]] = np.add.reduceat(differ, np.cumsum(n) - n) > 0
    return order, np.flatnonzero(new)


class ShiftTable:
    """Wu-Manber tables of the patterns of one length: runs of `length` words of the block's words that start at `starts`."""

    def __init__(self, length: int, words: np.ndarray, starts: np.ndarray):
        self.length, self.block, self.known, self.starts = length, min(2, length), words, starts
        self.bits = max(10, int(len(starts)).bit_length() + SPARE_BITS)
        hashes = _block_hashes(words, self.block)
        places = length - self.block + 1
        self.shift = np.full(1 << self.bits, places, np.int8 if places < 128 else np.int32)
        for at in range(places):  # later blocks have smaller shifts
            self.shift[self.slot(hashes[starts + at])] = places - 1 - at
        keys = self.bucket(hashes[starts + places - 1], hashes[starts])
        self.by_bucket = np.argsort(keys, kind="stable")
        self.buckets = keys[self.by_bucket]

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def bucket(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Key of a bucket: the hash of the last block, then of the first, so that a frequent ending is not one bucket."""
        return (last & np.uint64(0xFFFFFFFF00000000)) | (first >> np.uint64(32))

    def find(self, words: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start word, pattern) of all occurrences; doc_end: for each word the end of its document."""
        n, none = len(words), np.zeros(0, np.int64)
        if n < self.length:
            return none, none
        hashes = _block_hashes(words, self.block)
        slots = self.slot(hashes)
        # a position is the last block of a candidate; each of many cursors owns STRIDE positions
        first = self.length - self.block
        at = np.arange(first, len(slots), STRIDE)
        stop = np.minimum(at + STRIDE, len(slots))
        ends = []
        while len(at):
            skip = self.shift[slots[at]]
            ends.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        end = np.concatenate(ends)
        start = end - first
        ok = start + self.length <= doc_end[start]
        start, key = start[ok], self.bucket(hashes[end[ok]], hashes[start[ok]])
        lo, hi = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
        start, pattern = np.repeat(start, hi - lo), self.by_bucket[ranges(lo, hi - lo)]
        same = np.ones(len(start), bool)
        for i in range(self.length):
            same &= words[start + i] == self.known[self.starts[pattern] + i]
        return start[same], pattern[same]


class Searcher:
    """Shift tables of all pattern lengths of a block of items, with the items of each pattern."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        self.ids = [item for item, _ in items]
        texts = [(text or "").encode() + b" " for _, text in items]
        buf, offs = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        s, e, words = word_spans(buf, WORD, LOWER)
        # the words with one blank behind each
        self.place = np.concatenate([[0], np.cumsum(e - s + 1)]).astype(np.int64)
        self.raw = LOWER[buf[ranges(s, e - s + 1)]]
        self.raw[self.place[1:] - 1] = 0x20
        cut = np.searchsorted(s, offs)
        n_words = np.diff(cut)
        lengths = np.minimum(n_words, window)
        #: (table, first owner of each pattern and the end, numbers of the owning items)
        self.tables: list[tuple[ShiftTable, np.ndarray, np.ndarray]] = []
        for length in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == length)
            count = n_words[own] - length + 1
            start, item = ranges(cut[own], count), np.repeat(own, count)
            h = np.zeros(len(start), np.uint64)
            for i in range(length):
                h = h * np.uint64(0xD6E8FEB86659FD93) + words[start + i]
            order, first = _distinct(h, self.raw, self.place[start], self.place[start + length] - self.place[start])
            self.tables.append((ShiftTable(length, words, start[order[first]]), np.append(first, len(order)), item[order]))

    def occurs(self, raw: bytes, table: ShiftTable, pattern: int) -> bool:
        at = table.starts[pattern]
        return raw == self.raw[self.place[at] : self.place[at + table.length] - 1].tobytes()

    def scan(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, set[int]]]]:
        """Number of words of each document, and (document, hit word numbers, items) where any occurs.

        Texts in `buf` each end with a blank.
        """
        s, e, words = word_spans(buf, WORD, LOWER)
        cut = np.searchsorted(s, offs)
        doc = np.searchsorted(offs, s, "right") - 1
        doc_end = cut[doc + 1]
        found: dict[int, tuple[list[np.ndarray], set[int]]] = {}
        for table, bounds, owners in self.tables:
            for start, pattern in zip(*(x.tolist() for x in table.find(words, doc_end))):
                text = LOWER[buf[s[start] : e[start + table.length - 1]]]
                # the last confirmation is on the bytes: separators become one blank
                if not self.occurs(b" ".join(bytes(text[a - s[start] : b - s[start]]) for a, b in zip(s[start : start + table.length], e[start : start + table.length])), table, pattern):
                    continue
                spans, items = found.setdefault(int(doc[start]), ([], set()))
                spans.append(np.arange(start, start + table.length) - cut[doc[start]])
                items.update(self.ids[i] for i in owners[bounds[pattern] : bounds[pattern + 1]].tolist())
        return np.diff(cut), [(d, np.unique(np.concatenate(spans)), items) for d, (spans, items) in sorted(found.items())]


def searchers(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """searcher: pickled Searchers of bounded blocks of the items, built by tasks and stored."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda held: pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Searcher(held, window))], pa.binary())], names=["searcher"])
        held, size = [], 0
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                if held and (len(held) >= BLOCK_ITEMS or size + len(text) > BLOCK_CHARS):
                    yield pack(held)
                    held, size = [], 0
                held.append((item, text))
                size += len(text)
        if held:
            yield pack(held)

    return stored(items.repartition(blocks).mapInArrow(build, "searcher binary"))


_HITS = f"doc_id long, row {ROW}, n_words long, hits array<int>, items array<long>"


def _n_words(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(word_spans(buf, WORD, LOWER)[0], offs))


def _hits(docs: DataFrame, pickled: list[bytes]) -> DataFrame:
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(bytes(s)) for s in pickled]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: list[Searcher] = [pickle.loads(s.value) for s in shared]
        for batch in batches:
            n_words, hits, items = [], [[]] * len(batch), [[]] * len(batch)
            for lo, _, buf, offs in text_chunks(batch.column("text"), b" "):
                found: dict[int, tuple[list[np.ndarray], set]] = {}
                for s in search:
                    n, some = s.scan(buf, offs)
                    for d, h, i in some:
                        spans, own = found.setdefault(d, ([], set()))
                        spans.append(h)
                        own.update(i)
                n_words.append(n if search else _n_words(buf, offs))
                for d, (h, i) in found.items():
                    hits[lo + d], items[lo + d] = np.unique(np.concatenate(h)).tolist(), sorted(i, key=lambda x: (x is not None, x or 0))
            n_words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(n_words), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))], names=["doc_id", "row", "n_words", "hits", "items"])

    return docs.mapInArrow(run, _HITS)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, n_words, hits (numbers of hit words) and items (item_ids that occur) of each document."""
    docs = documents.select("doc_id", row_key().alias("row"), "text")
    found, waiting = [], []
    for (block,) in searchers(benchmark, window).toLocalIterator():  # one at a time
        waiting.append(block)
        if len(waiting) == PASS_BLOCKS:
            found.append(_hits(docs, waiting))
            waiting = []
    if waiting or not found:
        found.append(_hits(docs, waiting))
    if len(found) == 1:
        return found[0]
    # several passes: their few hits meet by row; every row stays, from the first pass
    more = found[1]
    for x in found[2:]:
        more = more.unionByName(x)
    more = more.where(F.size("hits") > 0).groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("h"), F.flatten(F.collect_list("items")).alias("i"))
    none = lambda c: F.coalesce(c, F.expr("array()"))
    return found[0].join(more, "row", "left").select("doc_id", "row", "n_words", F.array_sort(F.array_union("hits", none(F.col("h")))).alias("hits"), F.array_sort(F.array_union("items", none(F.col("i")))).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.array_sort(F.transform(F.filter("items", lambda x: x.isNotNull()), lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """documents without those that hold any window of the benchmark."""
    row = free_name(documents, "_row")
    bad = contamination(documents, benchmark, window).where(F.size("hits") > 0).select(F.col("row").alias(row)).distinct()
    return documents.withColumn(row, row_key()).join(bad, row, "left_anti").drop(row)


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int | None, str | None]], window: int = WINDOW) -> list[tuple]:
    """The digest rows by comparing every place with every window; for tests."""
    import re

    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc, text in docs:
        w, hit, ids = split(text), set(), set()
        for item, t in items:
            v = split(t)
            for i in range(max(1, len(v) - window + 1) if v else 0):
                p = v[i : i + window]
                for at in range(len(w) - len(p) + 1):
                    if w[at : at + len(p)] == p:
                        hit.update(range(at, at + len(p)))
                        ids.add(item)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(str(x) for x in ids if x is not None)).encode()).hexdigest(), bool(hit)))
    return out


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), p as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[i : i + 9], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)
), o as (
  select doc_id, item_id, i, k from (
    select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') as s
    from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from p) ks where len(w) >= k)
  ) join p using (k, s)
), h as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + k)) as j from o) group by doc_id),
n as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as varchar) as id from o) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join n using (doc_id)
"""

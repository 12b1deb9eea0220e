"""Operator 1: removal of long repeated substrings through run-length (r-index) matching statistics.

A 200-byte string that starts at two places must be judged once for the whole corpus, but one index
over the corpus would be one task. So the corpus is dealt out by content first:

1. Every window (a start of a 200-byte string) takes the smallest mixed hash of the 32-byte grams
   inside it as its anchor. Equal windows have equal anchors. Neighbouring windows with one anchor
   form a segment: (anchor, content hash, place, number of windows).
2. Anchors seen once are dropped by a partially aggregated count. Segments whose whole content is
   repeated are covered as they are. Rows of hot anchors and contents are dealt to several parts (common.dealt_join).
3. What is left - segments that share an anchor but not their content, i.e. the edges of repeats - is
   grouped by anchor, one copy of each content. Each bounded bucket gets a run-compressed BWT whose run
   ends are sampled with their positions and longest common extensions; matching statistics are
   streamed from the samples in text order (a position that is no run end has its predecessor's value
   less one), and windows with a value of `length` or more are marked.
4. An anchor with more than HOT_CONTENTS different contents is too large for one bucket; its windows
   are counted one by one with a partially aggregated group by, which no hot key can skew.

Defined results: null text is empty; texts under `length` bytes lose nothing; empty table gives no rows;
repeated rows are copies of each other and lose everything coverable; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, dealt_join, mix, powers, prefix_sums, row_key, shuffles, signed, stored, text_chunks

GRAM = 32
#: Low bits of a packed anchor that hold its place in the buffer.
_PLACE = np.uint64((1 << 22) - 1)
#: Bytes in one run-length index.
INDEX_BYTES = 1 << 20
#: Different contents of one anchor that still go to one index.
HOT_CONTENTS = 4096

_ROW = pa.struct([("a", pa.int64()), ("b", pa.int64())])
_SEGMENTS = f"row {ROW}, h long, c long, p0 long, nw int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _segments(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, number of windows and anchor of every segment of one buffer."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none.view(np.uint64)
    sums, inv = prefix_sums(buf), powers(len(buf) + 1)[1]
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inv[: len(buf) - GRAM + 1])
    # the place in the low bits makes the leftmost of equal grams the anchor, also in periodic text
    low = sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    first, last = offs[:-1], offs[1:] - length  # windows of a document: first..last
    full = np.flatnonzero(last >= first)
    cut = np.ones(len(low) + 1, bool)
    cut[1:-1] = low[1:] != low[:-1]
    cut[first[full]] = True
    cut[last[full] + 1] = True
    p = np.flatnonzero(cut)
    p, end = p[:-1], p[1:]
    doc = np.searchsorted(offs, p, "right") - 1
    ok = p <= last[doc]
    p, end, doc = p[ok], end[ok], doc[ok]
    return doc, p, end - p, grams[(low[p] & _PLACE).astype(np.int64)]


def segments(docs: DataFrame, length: int) -> DataFrame:
    """All segments of `docs` (row, text)."""
    piece = 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows = batch.column("row")
            for lo, _hi, buf, offs in text_chunks(batch.column("text")):
                # a very long text goes in pieces that share length-1 bytes: each window is in one piece
                for at in range(0, max(1, len(buf) - length + 1), piece) if len(offs) == 2 else (0,):
                    part = buf[at : at + piece + length - 1] if len(offs) == 2 else buf
                    doc, p, nw, h = _segments(part, offs if len(offs) > 2 else np.array([0, len(part)]), length)
                    raw = part.tobytes()
                    c = np.fromiter((digest(raw[a:b]) for a, b in zip(p.tolist(), (p + nw + length - 1).tolist())), np.uint64, len(p))
                    yield pa.RecordBatch.from_arrays(
                        [rows.take(pa.array(lo + doc)), pa.array(signed(h)), pa.array(signed(c)), pa.array(p - offs[doc] + at), pa.array(nw.astype(np.int32))],
                        names=["row", "h", "c", "p0", "nw"],
                    )

    return docs.mapInArrow(run, _SEGMENTS)


class RunLengthIndex:
    """Run-compressed BWT of a set of byte strings, with sampled run ends."""

    def __init__(self, strings: list[bytes]):
        self.starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int64)
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        n = len(raw)
        self.n = n
        char = raw.astype(np.int64) + 1
        ends = self.starts[1:] - 1
        char[ends] = 0
        # order by the first 7 characters; a string's end differs from every other one and sorts by place
        key = np.zeros(n, np.int64)
        padded = np.concatenate([char, np.zeros(7, np.int64)])
        alive = np.ones(n, bool)
        for i in range(7):
            ch = padded[i : i + n]
            key = (key << 9) | np.where(alive, ch, 0)
            alive &= ch > 0
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.ones(n, bool)
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~alive[order[1:]] | ~alive[order[:-1]]
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.levels = [(7, rank)]
        width = 7
        open_ = self._open(order, new)
        while len(open_):
            nxt = np.minimum(order[open_] + width, n - 1)
            pair = rank[order[open_]].astype(np.int64) << 32 | rank[nxt]
            by = np.argsort(pair, kind="stable")
            order[open_] = order[open_][by]
            pair = pair[by]
            fresh = np.ones(len(open_), bool)
            fresh[1:] = pair[1:] != pair[:-1]
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))
            rank = rank.copy()
            rank[order[open_]] = open_[head]
            width *= 2
            self.levels.append((width, rank))
            new[open_[fresh]] = True
            open_ = self._open(order, new)
        self.order = order
        # the run-compressed BWT: row k starts a run if its symbol differs from the row above
        bwt = char[order - 1]
        bwt[order == 0] = 0
        head = np.ones(n, bool)
        head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)  # string ends are all different symbols
        self.run_heads = np.flatnonzero(head)
        self.run_symbols = bwt[self.run_heads]
        tail = np.ones(n, bool)
        tail[:-1] = head[1:]
        self._sample(np.flatnonzero(head | tail), raw)

    @staticmethod
    def _open(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Rows whose rank is still shared."""
        alone = new & np.concatenate([new[1:], [True]])
        return np.flatnonzero(~alone)

    def _extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        total, a, b, top = np.zeros(len(a), np.int64), a.copy(), b.copy(), self.n - 1
        for width, rank in reversed(self.levels):
            same = (rank[a] == rank[b]) & (a != b)
            step = np.where(same, width, 0)
            total += step
            a, b = np.minimum(a + step, top), np.minimum(b + step, top)
        going = np.ones(len(a), bool)
        for _ in range(6):
            going &= (self._char[a] == self._char[b]) & (self._char[a] > 0)
            total += going
            a, b = np.minimum(a + going, top), np.minimum(b + going, top)
        return total

    def _sample(self, rows: np.ndarray, raw: np.ndarray) -> None:
        """Longest extension shared with any other suffix, for the suffixes at run ends."""
        self._char = raw.astype(np.int16) + 1
        self._char[self.starts[1:] - 1] = 0
        need = np.zeros(self.n + 1, bool)  # need[k]: rows k-1 and k are compared
        need[rows] = True
        need[rows + 1] = True
        need[0] = need[self.n] = False
        k = np.flatnonzero(need)
        lcp = np.zeros(self.n + 1, np.int64)
        lcp[k] = self._extension(self.order[k - 1], self.order[k])
        at = self.order[rows]
        by = np.argsort(at)
        self.sample_at, self.sample_value = at[by], np.maximum(lcp[rows], lcp[rows + 1])[by]

    def matching_statistics(self) -> np.ndarray:
        """For each position the longest match that also starts elsewhere, streamed from the samples."""
        gap = np.diff(np.append(self.sample_at, self.n))
        out = np.repeat(self.sample_value + self.sample_at, gap) - np.arange(self.sample_at[0], self.n)
        return np.concatenate([np.zeros(self.sample_at[0], np.int64), out])


def marked_runs(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the runs (first, last) of window starts that also start elsewhere in the set."""
    index = RunLengthIndex(strings)
    hit = index.matching_statistics() >= length
    edge = np.diff(hit.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    of = np.searchsorted(index.starts, first, "right") - 1
    runs = np.stack([first - index.starts[of], last - index.starts[of]], 1)
    cut = np.searchsorted(of, np.arange(len(strings) + 1))
    return [runs[cut[i] : cut[i + 1]] for i in range(len(strings))]


def _edge_runs(snippets: DataFrame, length: int) -> DataFrame:
    """Marks through run-length indexes; snippets (h, n, row, p0, snippet) in anchor order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def mark(rows: list[tuple]) -> pa.RecordBatch:
            out = [(r[2], r[3] + int(a), r[3] + int(b)) for r, runs in zip(rows, marked_runs([r[4] for r in rows], length)) if r[1] == 1 for a, b in runs]
            cols = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (_ROW, pa.int64(), pa.int64()))], names=["row", "q0", "q1"])

        for batch in batches:
            for r in zip(*(batch.column(x).to_pylist() for x in ("h", "n", "row", "p0", "snippet"))):
                if size >= INDEX_BYTES and r[0] != held[-1][0]:
                    yield mark(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4]) + 1
        if held:
            yield mark(held)

    return snippets.repartition(shuffles(snippets.sparkSession), "h").sortWithinPartitions("h").mapInArrow(run, f"row {ROW}, q0 long, q1 long")


def _window_hashes(buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every window of `length` bytes: a rolling hash of its bytes and one of its mixed grams."""
    n = len(buf) - length + 1
    inv = powers(len(buf) + 1)[1]
    sums = prefix_sums(buf)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inv[: len(buf) - GRAM + 1])
    of_bytes = mix((sums[length:] - sums[:-length]) * inv[:n])
    wide, span = prefix_sums(grams), length - GRAM + 1
    return of_bytes, mix((wide[span:] - wide[:-span]) * inv[:n])


def _hot_runs(snippets: DataFrame, length: int) -> DataFrame:
    """The same marks for anchors with very many contents: windows are counted one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, row, p0, s in zip(*(batch.column(x).to_pylist() for x in ("n", "row", "p0", "snippet"))):
                w1, w2 = _window_hashes(np.frombuffer(s, np.uint8), length)
                k = len(w1)
                yield pa.RecordBatch.from_arrays([pa.array(signed(w1)), pa.array(signed(w2)), pa.array(np.full(k, n)), pa.array([row] * k, _ROW), pa.array(np.arange(p0, p0 + k))], names=["w1", "w2", "n", "row", "p"])

    windows = snippets.mapInArrow(run, f"w1 long, w2 long, n long, row {ROW}, p long")
    twice = stored(windows.groupBy("w1", "w2").agg(F.count("*").alias("k")).where("k > 1"))
    return dealt_join(windows.where("n = 1"), twice.drop("k"), ["w1", "w2"], ["row", "p"], twice).select("row", F.col("p").alias("q0"), F.col("p").alias("q1"))


def covered_windows(docs: DataFrame, length: int = 200) -> DataFrame:
    """(row, q0, q1): runs of window starts of `docs` (row, text) that also start elsewhere."""
    segs = stored(segments(docs, length))
    again = stored(segs.groupBy("h").agg(F.count("*").alias("k"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("k > 1").select("h", "k", (F.col("c0") != F.col("c1")).alias("mixed")))
    shared = stored(dealt_join(segs, again.drop("k"), ["h"], ["row", "p0"], again.select("h", "k")))
    run_of = ("row", F.col("p0").alias("q0"), (F.col("p0") + F.col("nw") - 1).alias("q1"))
    mixed = shared.where("mixed").drop("mixed")
    contents = stored(mixed.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("row", "p0", "nw")).alias("at")))
    repeated = contents.where("n > 1")
    # an anchor of one content needs no count of its contents
    whole = shared.where("not mixed").select(*run_of).unionByName(dealt_join(mixed, repeated.select("h", "c"), ["h", "c"], ["row", "p0"], repeated.select("h", "c", F.col("n").alias("k"))).select(*run_of))

    hot = stored(contents.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > HOT_CONTENTS))
    dealt = dealt_join(contents, hot.select("h", F.lit(True).alias("hot")), ["h"], ["c"], hot, "left")
    edges = dealt.groupBy(F.col("at.row").alias("row")).agg(F.collect_list(F.struct("h", "n", "at.p0", "at.nw", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text, cuts in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("cuts").to_pylist()):
                out += [(x["h"], x["n"], row, x["p0"], x["hot"], text[x["p0"] : x["p0"] + x["nw"] + length - 1]) for x in cuts]
                if len(out) >= 4096:
                    yield _snippet_batch(out)
                    out = []
            yield _snippet_batch(out)

    # copies of a row share its key and give their contents twice; those have n > 1 and are covered anyway
    snippets = stored(docs.join(edges, "row").mapInArrow(cut, f"h long, n long, row {ROW}, p0 long, hot boolean, snippet binary"))
    return whole.unionByName(_edge_runs(snippets.where("not hot"), length)).unionByName(_hot_runs(snippets.where("hot"), length))


def _snippet_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), _ROW, pa.int64(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=["h", "n", "row", "p0", "hot", "snippet"])


def merged(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs [start, end) of window runs."""
    out: list[list[int]] = []
    for r in sorted((x["q0"], x["q1"] + length) for x in runs):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [tuple(x) for x in out]


def dedup_substrings(documents: DataFrame, length: int = 200) -> DataFrame:
    """documents' doc_id with `spans` (array of removed [start, end) byte runs) and `kept` (bytes left).

    See the module text for the method and the defined results.
    """
    docs = documents.select("doc_id", row_key().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    # copies of a row share its key and bring the same runs, which are gathered once
    runs = covered_windows(docs.select("row", "text"), length).groupBy("row").agg(F.collect_set(F.struct("q0", "q1")).alias("runs"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            spans = [merged(x or [], length) for x in batch.column("runs").to_pylist()]
            kept = []
            for text, cuts in zip(texts, spans):
                at, parts = 0, []
                for a, b in cuts:
                    parts.append(text[at:a])
                    at = b
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return docs.join(runs, "row", "left").select("doc_id", "text", "runs").mapInArrow(remove, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of dedup_substrings."""
    return result.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: list[bytes], length: int = 200) -> list[tuple[int, int, str]]:
    """(n_removed, n_spans, sha256) of each text, by counting every window; for tests."""
    from collections import Counter

    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, np.int8)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out

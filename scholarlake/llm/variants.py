"""Operator 12: spelling variants by composing the vocabulary's acceptor with a one-edit transducer and itself.

Words are counted in blocks of text inside the tasks, then by Spark. Two words that one edit separates share at least half of the longer
one's other characters, as a beginning or as an end: the vocabulary is partitioned by the state that the acceptor reaches after
that beginning, and, for edits inside the beginning, by the state that the reversed acceptor reaches after that end. In each
partition the minimal acceptor of what is left of the words is composed with the transducer and itself, and the pairs that
the composition accepts are enumerated: equal transitions up to the first difference, one edit, then strings that both states
accept, which is all a state accepts where minimisation has made the two states one. A pair with a common beginning long
enough for the first kind of partition is left out of the second, so each pair is met once, and only each word's number of near
words and its best one leave the task.

A partition with more than GROUP_WORDS words, or words with long rests, is partitioned again by half of the rest, until none
is left; what one character separates is bounded by the alphabet. Words that change their form double the count at
each step, so roots are found by a few rounds of pointer doubling.

Defined results: null text has no words, a null doc_id is the empty string in the hash; repeated rows count each time; ties for the best near word
go to the smallest word in code-point order; an empty table gives no rows; other columns are ignored. Very long texts are taken
in blocks that no word crosses, and words of any length are compared whole.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut_ranges, dealt_join, shuffles, stored, text_chunks

#: Bytes of text whose words are counted together in a task.
COMBINE_BYTES = 4 << 20
#: Words of a partition that are composed together, and code points of their rests.
GROUP_WORDS, REST = 4096, 64
#: Words longer than this many bytes are hashed one by one.
LONG_WORD = 64

_LOWER = ascii_lower()
_ASCII = np.array([chr(i).isalpha() if i < 128 else False for i in range(256)])
#: Bytes after which no word goes on: all but letters, the lead byte of U+00C0 to U+00FF and continuation bytes.
_GAPS = ~_ASCII & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)) & (np.arange(256) != 0xC3)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def _crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Checksum of each range of bytes behind a prefix of checksum `before`."""
    state = ~before.astype(np.uint32)
    order = np.argsort(-lengths, kind="stable")
    live = order[int(np.searchsorted(-lengths[order], -LONG_WORD, "left")) :]
    for i in range(LONG_WORD):
        live = live[: int(np.searchsorted(-lengths[live], -i, "left"))]
        if not len(live):
            break
        state[live] = _CRC[(state[live] ^ data[starts[live] + i]) & 255] ^ (state[live] >> np.uint32(8))
    out = ~state
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]].tobytes(), int(before[i]))
    return out


def word_counts(documents: DataFrame, shortest: int, least: int, every: int) -> DataFrame:
    """word, n: runs of letters, lower-cased A-Z, of at least `shortest` code points and `least` occurrences.

    Where `every` divides the checksum of <doc_id>:<run>, the run first loses the code point that the checksum names.
    """

    def count(buf: np.ndarray, offs: np.ndarray, before: np.ndarray) -> pa.RecordBatch | None:
        lead = buf == 0xC3
        letter = _ASCII[buf] | lead
        letter[1:] |= lead[:-1]
        edge = np.diff(letter.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts = np.flatnonzero(edge == 1)
        if not len(starts):
            return None
        lengths = np.flatnonzero(edge == -1) - starts
        pairs = np.flatnonzero(lead)
        points = lengths - (np.searchsorted(pairs, starts + lengths) - np.searchsorted(pairs, starts))
        keep = points >= shortest  # a run can only become shorter
        starts, lengths, points = starts[keep], lengths[keep], points[keep]
        data = _LOWER[buf]
        h = _crc32(data, starts, lengths, before[np.searchsorted(offs, starts, "right") - 1])
        changed = h % np.uint32(every) == 0
        cut = []
        for i in np.flatnonzero(changed & (points > shortest)):
            w = data[starts[i] : starts[i] + lengths[i]].tobytes().decode()
            at = int(h[i]) % len(w)
            cut.append(w[:at] + w[at + 1 :])
        same = np.zeros(len(buf) + 1, np.int8)
        np.add.at(same, starts[~changed], 1)
        np.add.at(same, (starts + lengths)[~changed], -1)
        offsets = np.concatenate([[0], np.cumsum(lengths[~changed])]).astype(np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(same[:-1], dtype=np.int8).astype(bool)])])
        found = pc.value_counts(pa.chunked_array([whole, pa.array([w.encode() for w in cut], pa.large_binary())]))
        return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()], np.uint32)
            for lo, hi, buf, offs in text_chunks(batch.column("text"), b"\n", COMBINE_BYTES):
                for start, stop in cut_ranges(buf, _GAPS, COMBINE_BYTES):
                    if (out := count(buf[start:stop], offs - start, before[lo:hi])) is not None:
                        yield out

    counted = documents.select(F.col("doc_id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Acceptor:
    """The minimal acceptor of some words; states are numbers, equal states are one."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.edges: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}
        self._strings: dict[int, list[str]] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        self._near: dict[int, list[tuple[str, str]]] = {}
        words = sorted(words)
        self.start = self._state(words, 0, len(words), 0)

    def _state(self, words: list[str], lo: int, hi: int, at: int) -> int:
        final = lo < hi and len(words[lo]) == at
        edges, lo = {}, lo + final
        while lo < hi:
            c, end = words[lo][at], lo + 1
            while end < hi and words[end][at] == c:
                end += 1
            edges[c] = self._state(words, lo, end, at + 1)
            lo = end
        key = (final, *edges.items())
        if key not in self._known:
            self._known[key] = len(self.final)
            self.final.append(final)
            self.edges.append(edges)
        return self._known[key]

    def common(self, p: int, q: int) -> list[str]:
        """The strings that both states accept."""
        p, q = min(p, q), max(p, q)
        if (p, q) not in self._common:
            out = [""] if self.final[p] and self.final[q] else []
            for c, t in self.edges[p].items():
                if c in self.edges[q]:
                    out += [c + s for s in self.common(t, self.edges[q][c])]
            self._common[p, q] = out
        return self._common[p, q]

    def near(self, q: int) -> list[tuple[str, str]]:
        """Pairs of accepted strings that one edit separates, each once; the first is shorter, or smaller at the difference."""
        if q not in self._near:
            out = []
            edges = sorted(self.edges[q].items())
            for i, (c, t) in enumerate(edges):
                out += [(c + x, c + y) for x, y in self.near(t)]
                for d, u in edges[i + 1 :]:
                    out += [(c + s, d + s) for s in self.common(t, u)]
                # c is inserted; where the rest starts with c too, the same pair comes from a later place
                out += [(s, c + s) for s in self.common(q, t) if not s.startswith(c)]
            self._near[q] = out
        return self._near[q]


def _partitions(words: DataFrame) -> DataFrame:
    """word, n, m, a, b, until: partitions of words that share their first a and last b code points, for pairs whose longer word has m.

    Pairs count where their common beginning is shorter than `until`.
    """
    m = words.select("word", "n", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("m"))
    return _halved(m.select("*", F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("m").alias("until")))


def _halved(rows: DataFrame) -> DataFrame:
    """The same partitions with half of the rest shared at the beginning, or else at the end."""
    half = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b"), F.col("until"))
    last = F.struct(F.col("a"), (F.col("b") + half).alias("b"), F.least("until", F.col("a") + half).alias("until"))
    out = rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("p")).select("word", "n", "m", "p.*").where("a < until")
    return out.withColumn("g", F.xxhash64("m", "a", "b", "until", F.substring("word", F.lit(1), F.col("a")), F.right("word", F.col("b"))))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: for words that have near ones, their number and the one of largest n."""
    rows, ready = stored(_partitions(words)), None
    while True:
        counts = rows.groupBy("g").agg(F.count("*").alias("k"))
        big = stored(counts.where(F.col("k") > GROUP_WORDS))
        rest = F.col("m") - F.col("a") - F.col("b")
        if not big.limit(1).count() and not rows.where(rest > REST).limit(1).count():
            break
        marked = stored(dealt_join(rows, big.withColumnRenamed("k", "_k"), ["g"], ["word"], counts, "left"))
        more = ((F.col("_k").isNotNull()) & (rest > 1)) | (rest > REST)
        done = marked.where(~more).drop("_k")
        ready = done if ready is None else ready.unionByName(done)
        rows = stored(_halved(marked.where(more).drop("_k", "g")))
    rows = rows if ready is None else ready.unionByName(rows)

    def compose(group: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
        by_rest: dict[tuple, dict[str, tuple[str, int]]] = {}
        for w, n, m, a, b, until in group:  # partitions of one hash are told apart
            by_rest.setdefault((m, a, b, until, w[:a], w[len(w) - b :]), {})[w[a : len(w) - b]] = (w, n)
        for (m, a, b, until, *_), rests in by_rest.items():
            found: dict[str, tuple[int, int, str]] = {}
            acceptor = Acceptor(list(rests))
            for x, y in acceptor.near(acceptor.start):
                (v, k), (w, n) = rests[x], rests[y]
                if len(w) == m and (until >= m or len(os.path.commonprefix([v, w])) < until):
                    for one, other, count in ((v, w, n), (w, v, k)):
                        near, best, form = found.get(one, (0, 0, ""))
                        best, form = (count, other) if (-count, other) < (-best, form) else (best, form)
                        found[one] = near + 1, best, form
            for w, (near, best, form) in found.items():
                yield w, near, best, form

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, out = [], None, []
        for batch in batches:
            for g, *row in zip(*(batch.column(c).to_pylist() for c in ("g", "word", "n", "m", "a", "b", "until"))):
                if g != last:
                    out += compose(group) if len(group) > 1 else ()
                    group, last = [], g
                    if len(out) > 20_000:
                        yield _rows(out)
                        out = []
                group.append(tuple(row))
        out += compose(group) if len(group) > 1 else ()
        yield _rows(out)

    met = rows.repartition(shuffles(words.sparkSession), "g").sortWithinPartitions("g").mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w"))).alias("b")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.w").alias("best"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])


def with_roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form: where each chain of forms ends, by pointer doubling; counts double at each form, so rounds are few."""
    links = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = stored(links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        links = jumped.select("word", "root")
        if not jumped.where("_moved").limit(1).count():
            return links


def spelling_variants(documents: DataFrame, shortest: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word; see the module text."""
    words = stored(word_counts(documents, shortest, least, every))
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= 2 * F.col("n")
    forms = stored(near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")))
    return forms.join(with_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

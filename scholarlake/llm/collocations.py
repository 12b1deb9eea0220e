"""Operator 11: collocations by top-order marginalisation.

Each place of a piece of text gives one window: the word there and, in lead columns, those after it, padded with nulls at the
piece's end. These longest windows alone are counted, first in blocks of text inside the tasks, then by Spark; a ROLLUP of the
counted windows sums the shorter prefixes, so that words and shorter phrases need no pass and no explosion of their own. A
phrase is scored at its weakest cut, the square of its count over the product of its parts' counts, in exact decimals. Phrases that
a longer one mostly accounts for are dropped; the best of each language remain.

What counting costs is the shuffle of the windows, mostly words spelled three times. A bounded look at some documents gives two
things, neither of which changes any result: frequent words, which stand as codes of three bytes that no word can be, and the pairs
of words that begin so many windows that their windows are dealt to parts. Others meet by their first two words, so that rare
pairs are known before the second shuffle and go on as single words.

Joins with a frequent word's phrases deal the rows of hot keys to parts too (common.dealt_join); a language's ranking takes the
best of each of BUCKETS buckets first, so that it never meets in one task what every partition holds.

Defined results: null text is empty, a null lang is `und`; pieces without words and empty tables give no rows; repeated rows count
each time; ties are broken by count and phrase, which is total in a language; other columns are ignored. A very long text
is taken in blocks that end where a piece ends.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut_ranges, dealt_join, hot_keys, shuffles, stored, text_chunks

#: Bytes of text whose windows are counted together in a task.
COMBINE_BYTES = 8 << 20
#: Bounds of the look at some documents: rows, characters of each, words of the code book.
LOOK_ROWS, LOOK_CHARS, CODED_WORDS = 2_000, 20_000, 50_000
BUCKETS = 32

PIECE_ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
_ENDS = np.isin(np.arange(256), np.frombuffer(PIECE_ENDS, np.uint8))
_WORD = ~(_ENDS | np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8)))
_LOWER = ascii_lower()


def _code(i: int) -> bytes:
    """Three bytes that start with one that no word holds."""
    return bytes([(PIECE_ENDS + BLANKS)[i // 127**2], 1 + i // 127 % 127, 1 + i % 127])


def _words(buf: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where the words of a buffer start, and the lower-cased words."""
    word = _WORD[buf]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(edge == -1) - starts)]).astype(np.int64)
    return starts, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[buf[word]])])


def sampled(documents: DataFrame) -> DataFrame:
    """lang and text of about LOOK_ROWS rows from everywhere, no more than twice as many, long texts as far as LOOK_CHARS."""
    n = documents.count()
    some = documents.sample(min(1.0, LOOK_ROWS / n), seed=11) if n else documents
    return some.select("lang", F.substring("text", 1, LOOK_CHARS).alias("text")).limit(2 * LOOK_ROWS)


def code_book(sample: DataFrame) -> list[bytes]:
    """Frequent words of the sample, at most CODED_WORDS."""
    found: Counter[bytes] = Counter()
    for r in sample.select("text").toLocalIterator():
        found.update(_words(np.frombuffer((r["text"] or "").encode(), np.uint8))[1].to_pylist())
    return [w for w, n in found.most_common(CODED_WORDS) if n > 1]


def counted_windows(documents: DataFrame, words: int, book: list[bytes]) -> DataFrame:
    """lang, w1 .. w<words>, f: each word with those after it in its piece, null where the piece has ended, counted in blocks of text.

    Words of the code book stand as their codes.
    """
    names = [f"w{i + 1}" for i in range(words)]
    schema = pa.schema([("lang", pa.string()), *((n, pa.string()) for n in names), ("f", pa.int64())])

    def count(buf: np.ndarray, offs: np.ndarray, lang_ids: np.ndarray, langs: pa.Array, known: pa.Array, codes: pa.Array) -> Iterator[pa.RecordBatch]:
        starts, found = _words(buf)
        if not len(starts):
            return
        found = found.dictionary_encode()
        ids, base = found.indices.to_numpy().astype(np.int64), len(found.dictionary) + 1
        piece = np.searchsorted(np.flatnonzero(_ENDS[buf]), starts)
        lang = lang_ids[np.searchsorted(offs, starts, "right") - 1].astype(np.int64)
        # lead columns; 0 is padding
        columns = [ids + 1]
        for i in range(1, words):
            lead = np.zeros(len(ids), np.int64)
            lead[:-i] = np.where(piece[:-i] == piece[i:], ids[i:] + 1, 0)
            columns.append(lead)
        key = lang
        for c in columns:
            if int(key.max()) >= (1 << 62) // base:
                key = np.unique(key, return_inverse=True)[1]
            key = key * base + c
        _, first, f = np.unique(key, return_index=True, return_counts=True)
        coded = pc.index_in(found.dictionary, known)
        spelled = pc.if_else(pc.is_valid(coded), codes.take(coded), found.dictionary)
        spelled = spelled.cast(options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))
        for lo in range(0, len(first), 1 << 16):
            rows = first[lo : lo + (1 << 16)]
            taken = [spelled.take(pa.array(c[rows] - 1, mask=c[rows] == 0)) for c in columns]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[rows])), *taken, pa.array(f[lo : lo + (1 << 16)])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codes = pa.array(book, pa.large_binary()), pa.array([_code(i) for i in range(len(book))], pa.large_binary())
        for batch in batches:
            langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
            lang_ids = langs.indices.to_numpy()
            for lo, hi, buf, offs in text_chunks(batch.column("text"), b"\n", COMBINE_BYTES):
                for start, stop in cut_ranges(buf, _ENDS, COMBINE_BYTES):
                    yield from count(buf[start:stop], offs - start, lang_ids[lo:hi], langs.dictionary.cast(pa.string()), known, codes)

    kinds = "".join(f"{n} string, " for n in names)
    return documents.select("lang", "text").mapInArrow(run, f"lang string, {kinds}f long")


def phrase_counts(documents: DataFrame, words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n): words of each language; (lang, phrase, size, f): phrases of 1 to `words` words with f >= least occurrences."""
    names = [f"w{i + 1}" for i in range(words)]
    sample = stored(sampled(documents))
    book = code_book(sample)
    # windows meet by their first two words, so that a pair is summed once; those of hot pairs are dealt to parts by the words after them
    pair = ["lang", *names[:2]]
    seen = stored(counted_windows(sample, 2, book).groupBy(*pair).agg(F.sum("f").alias("k")))
    hot = F.broadcast(hot_keys(seen, pair, 4 * shuffles(documents.sparkSession)))
    part = F.coalesce(F.pmod(F.xxhash64(*(names[2:] or pair)), F.col("_parts")) + 1, F.lit(0)).cast("int")
    dealt = counted_windows(documents, words, book).join(hot, pair, "left").withColumn("part", part).drop("_parts").repartition(*pair, "part")
    # both sums need every column of the windows, so that they read one shuffle
    last = names[-1]
    longest = dealt.groupBy("part", "lang", *names).agg(F.sum("f").alias("f"), F.count(last).alias("_n")).where((F.col("f") >= least) & (F.col("_n") > 0))
    prefixes = dealt.groupBy("part", "lang", *names[:-1]).agg(F.sum("f").alias("f"), F.count(last).alias("_n")).where("_n >= 0")
    if words > 2:
        # a rare prefix that is summed here needs no row of its own: it goes on as a shorter one
        rare = (F.col("f") < least) & (F.col("part") == 0)
        prefixes = prefixes.withColumn(names[-2], F.when(~rare, F.col(names[-2])))
    levels = prefixes.rollup("lang", *names[:-1]).agg(F.sum("f").alias("f"), F.grouping_id().alias("_g"))
    size = (F.lit(words - 1) - F.bit_count("_g")).cast("int")
    # a null that is not rolled up is padding, or a rare prefix's last word
    padded = reduce(or_, (F.col(w).isNull() & (size > i) for i, w in enumerate(names[:-1])))
    shorter = levels.where(F.col("lang").isNotNull() & ~padded & ((size == 0) | (F.col("f") >= least)))
    kept = shorter.select("lang", size.alias("size"), *names[:-1], F.lit(None).cast("string").alias(last), "f").unionByName(longest.select("lang", F.lit(words).alias("size"), *names, "f"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = {_code(i).decode(): w.decode(errors="replace") for i, w in enumerate(book)}
        for b in batches:
            rows = zip(*(b.column(n).to_pylist() for n in names))
            phrases = [" ".join(plain.get(w, w) for w in r if w is not None) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(phrases, pa.string()), b.column("size"), b.column("f")], names=["lang", "phrase", "size", "f"])

    phrases = stored(kept.mapInArrow(spell, "lang string, phrase string, size int, f long"))
    return phrases.where("size = 0").select("lang", F.col("f").alias("n")), phrases.where("size > 0")


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a a / (left right)) in decimals, as the products may pass 64 bits."""
    d = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (d(a, 15) * d(a, 15)), d(left, 18) * d(right, 18))


def scored_phrases(phrases: DataFrame) -> DataFrame:
    """lang, phrase, size, a, score, k, l, r: each phrase of two words or more at its weakest cut."""
    part = lambda a, n: F.array_join(F.slice("ws", a, n), " ")
    cuts = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("ws"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = stored(cuts.select("lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    known = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    with_left = stored(dealt_join(cuts, known("first", "l"), ["lang", "first"], ["phrase", "k"]))
    with_both = dealt_join(with_left, known("rest", "r"), ["lang", "rest"], ["phrase", "k"])
    cut = F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r")
    return with_both.groupBy("lang", "phrase", "size", "a").agg(F.min(cut).alias("cut")).select("lang", "phrase", "size", "a", "cut.*")


def collocations(documents: DataFrame, words: int = 3, least: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` best phrases of 2 to `words` words of each language.

    A phrase inside a longer one with at least `covered` per cent of its occurrences is dropped.
    """
    sizes, phrases = phrase_counts(documents, words, least)
    best = scored_phrases(phrases)
    longer = phrases.where("size > 2").withColumn("ws", F.split("phrase", " "))
    inner = longer.select("lang", "f", "size", "ws", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = inner.select("lang", "f", "ws", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at")).select("lang", F.array_join(F.slice("ws", F.col("at"), F.col("m")), " ").alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = best.join(most, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * covered, F.lit(True)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)).alias("bucket")
    heads = kept.select("*", bucket).withColumn("_n", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("_n") <= top)
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# The same rule without rollups: every phrase's occurrences are listed and counted.
ORACLE = r"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
ws as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from ws where len(w) > 0),
f as (
  select lang, size, phrase, count(*) as f from (
    select lang, 1 as size, w[i] as phrase from places
    union all select lang, 2, w[i] || ' ' || w[i + 1] from places where i + 1 <= len(w)
    union all select lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from places where i + 2 <= len(w)
  ) group by all
), n as (select lang, cast(sum(f) as bigint) as n from f where size = 1 group by lang),
c as (select lang, phrase, size, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= 10),
cuts as (select lang, phrase, size, a, 1 as k, w[1] as x, array_to_string(w[2:], ' ') as y from c union all select lang, phrase, size, a, 2, w[1] || ' ' || w[2], w[3] from c where size = 3),
s as (
  select cuts.*, x.f as l, y.f as r, cast((cast(1000000 as hugeint) * a * a) // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x join f y on y.lang = cuts.lang and y.phrase = cuts.y
), b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (select lang, phrase, max(a) as most from (select lang, w[1] || ' ' || w[2] as phrase, a from c where size = 3 union all select lang, w[2] || ' ' || w[3], a from c where size = 3) group by lang, phrase),
kept as (select b.* from b left join inside i on i.lang = b.lang and i.phrase = b.phrase where i.most is null or 100 * i.most < 50 * b.a)
select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept join n on n.lang = kept.lang
qualify row_number() over (partition by kept.lang order by score desc, a desc, phrase) <= 2000
"""

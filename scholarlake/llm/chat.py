"""Operator 4: collapse of cumulative conversation snapshots, then rendering.

A log that stores a conversation after every turn holds all its prefixes. Every turn gets its place in
its conversation and a 128-bit prefix hash, the running exclusive-or of place-keyed turn hashes.
A conversation whose full hash is a proper prefix hash of another, or equals that of one with a smaller
conv_id, goes by an anti join; the maximal ones are rendered.

Places come from a sort of all turns into ranges, prefix hashes from blocks of BLOCK_TURNS places and then from the
blocks of a conversation, and the joins deal a hot conversation's turns to parts, so that a conversation with a third of
all rows is not one sort and not one task. Rendered text comes whole, a row for each conversation (`whole_conversations`, the query), which
joins texts of BLOCK_TURNS places and so holds one conversation's text in one group; or by `part` (BLOCK_TURNS turn numbers; -1 for turns without
one) and `piece` (BLOCK_TURNS places), so that no group is collected without bound, whatever the turn numbers are (`render_conversations`).
Texts are sorted once and next move when they are rendered; prefix hashes come from hashes of turns.

Defined results: turns are ordered by (turn, role, text), nulls first; exact repeats of a turn row count
once; null role and text render as empty; rows without conv_id are ignored; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlake.operators.numbering import dense_numbers

from .common import dealt_join, stored

BLOCK_TURNS = 512
#: Characters of a text that the ranges of the sort are cut by.
RANGE_CHARS = 32
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, h1, h2 (hashes of role and text), at (from 0, in the order of all turns) of the distinct turns, stored."""
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").where("conv_id is not null").distinct()
    # nulls are told from empty strings
    filled = lambda c: F.concat(F.col(c).isNull().cast("string"), F.coalesce(c, F.lit("")))
    turns = turns.withColumns({"h1": F.xxhash64(filled("role"), filled("text")), "h2": F.xxhash64(filled("text"), filled("role"), F.lit(1))})
    return dense_numbers(turns, ["conv_id", "turn", "role", "text"], "at", 0, ["conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS)])


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """conv_id, first (its first `at`), n (its turns), place (from 1), p1, p2 of every turn."""
    counts = stored(numbered.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("k")))
    placed = dealt_join(numbered.select("conv_id", "at", "h1", "h2"), counts.withColumnRenamed("k", "n"), ["conv_id"], ["at"], counts.select("conv_id", "k"))
    placed = placed.withColumn("place", F.col("at") - F.col("first") + 1).withColumn("piece", F.floor((F.col("place") - 1) / BLOCK_TURNS))
    placed = placed.select("conv_id", "first", "n", "piece", "place", F.xxhash64("place", "h1", "h2").alias("t1"), F.xxhash64("h2", "h1", "place").alias("t2"))
    inside = Window.partitionBy("conv_id", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = stored(placed.select("conv_id", "first", "n", "piece", "place", *(F.bit_xor(t).over(inside).alias(s) for t, s in (("t1", "s1"), ("t2", "s2")))))
    # a piece's last running hash is the whole piece's
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ends = running.where((F.col("place") % BLOCK_TURNS == 0) | (F.col("place") == F.col("n")))
    sums = ends.select("conv_id", "piece", *(F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))))
    # most conversations have one piece, which nothing precedes
    later = sums.where("piece > 0")
    base = lambda b: F.coalesce(b, F.lit(0))
    return running.join(later, ["conv_id", "piece"], "left").select("conv_id", "first", "n", "place", F.col("s1").bitwiseXOR(base("b1")).alias("p1"), F.col("s2").bitwiseXOR(base("b2")).alias("p2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, first, n_turns, n_copies of conversations that are no proper prefix and no later copy of another."""
    distinct = turns.where("place = n").groupBy("place", "p1", "p2").agg(F.min(F.struct("conv_id", "first")).alias("c"), F.count("*").alias("n_copies"))
    # proper prefixes: every place but a conversation's last
    inner = turns.where("place < n").select("place", "p1", "p2").distinct()
    return distinct.join(inner, ["place", "p1", "p2"], "left_anti").select("c.conv_id", "c.first", F.col("place").alias("n_turns"), "n_copies")


def kept_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, at, piece, n_turns, n_copies, shown (the turn as chat text) of the maximal conversations' turns."""
    numbered = numbered_turns(conversations)
    kept = stored(maximal_conversations(stored(prefix_hashes(numbered))))
    rows = dealt_join(numbered.select("conv_id", "turn", "role", "text", "at"), kept, ["conv_id"], ["at"], kept.select("conv_id", F.col("n_turns").alias("k")))
    shown = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    return rows.select("conv_id", "turn", "at", F.floor((F.col("at") - F.col("first")) / BLOCK_TURNS).alias("piece"), "n_turns", "n_copies", shown.alias("shown"))


def _joined(order: str, text: str) -> Column:
    """A group's texts in order, as one."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")


def render_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, part, piece, n_turns, n_copies, rendered: the maximal conversations as chat text, in the order of piece, then part."""
    part = F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS)
    return kept_turns(conversations).groupBy("conv_id", part.alias("part"), "piece", "n_turns", "n_copies").agg(_joined("at", "shown").alias("rendered"))


def whole_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, part (0), n_turns, n_copies, rendered: each maximal conversation's whole chat text."""
    pieces = kept_turns(conversations).groupBy("conv_id", "piece", "n_turns", "n_copies").agg(_joined("at", "shown").alias("shown"))
    whole = pieces.groupBy("conv_id", "n_turns", "n_copies").agg(_joined("piece", "shown").alias("rendered"))
    return whole.select("conv_id", F.lit(0).cast("long").alias("part"), "n_turns", "n_copies", "rendered")


ORACLE = """
with t as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
c as (select conv_id, list({'r': role, 't': text} order by turn nulls first, role nulls first, text nulls first) as l,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by turn nulls first, role nulls first, text nulls first) as rendered
  from t group by conv_id),
d as (select l, min(conv_id) as conv_id, count(*) as n_copies, any_value(rendered) as rendered from c group by l),
p as (select distinct l[1:n] as l from (select l, unnest(range(1, len(l))) as n from d))
select conv_id, cast(0 as bigint) as part, cast(len(d.l) as bigint) as n_turns, n_copies, rendered from d anti join p on d.l = p.l
"""

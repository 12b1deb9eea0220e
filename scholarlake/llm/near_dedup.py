"""Operator 6: near-duplicate groups by SetSketch registers.

1. A document's set of word shingles (64-bit hashes) gives its size, a 128-bit set signature and
   REGISTERS registers. A register is the truncated logarithm, to the base BASE, of the smallest of
   exponentially distributed points that the set's elements put on it; points come in ascending order
   from each element, so most elements stop after one. Registers of a union are the maxima of
   registers, and equal registers are about as likely as the Jaccard similarity.
2. Equal sets are one class. Classes meet in bands of four registers; in a band's bucket each class is
   compared with the bucket's smallest. The joint maximum-likelihood estimate from the registers,
   with the exact sizes, drops pairs far below the threshold; the others are confirmed on full sets.
3. Links give components. Buckets that still hold several components get their pairs between components
   tried in bounded cells, each pair in its first shared band: by the registers, then on the upper
   halves of all hashes. A cell gives links, not candidates; they are confirmed on full sets. So a bucket of copies costs one comparison a member, and no link between bucket mates is lost.

A pair at the threshold misses all bands with a probability below 1e-10 (0.85) or 1e-7 (0.8).

Defined results: null text, or text without words, is an empty set, linked with nothing; a text of fewer
words than a shingle is one shingle; repeated rows are equal sets; rows without doc_id link with
nothing and have no component; an empty table gives no rows; extra columns stay in `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, ascii_lower, dealt_join, free_name, mix, row_key, shuffles, stored, text_chunks, word_spans

REGISTERS, BAND, BASE, SCALE, LIMIT = 128, 4, 1.02, 20.0, 65_534
#: Five standard errors of the estimate near 0.85.
MARGIN = 0.16
BLOCK_ROWS = 1024
LOWER = ascii_lower()
WORD = np.ones(256, bool)
WORD[[0x20, 9, 10, 11, 12, 13]] = False
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end row, sorted distinct shingle hashes of each) in bounded chunks."""
    for lo, hi, buf, offs in text_chunks(texts, b" "):
        s, _, h = word_spans(buf, WORD, LOWER)
        cut = np.searchsorted(s, offs)
        acc = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for j in range(words):
            acc = acc * _GOLD + h[j : len(h) - words + 1 + j]
        acc = mix(acc)
        sets = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if b - a >= words:
                x = np.sort(acc[a : b - words + 1])
                sets.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
            elif b > a:
                sets.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes())], np.uint64))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield lo, hi, sets


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (uint16) of each set; zeros for an empty one."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    todo = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    reach = np.log(REGISTERS) + 6
    while len(todo):
        n = np.array([len(sets[i]) for i in todo])
        low = np.full(len(todo) * REGISTERS, np.inf)
        element, of = np.concatenate([sets[i] for i in todo]), np.repeat(np.arange(len(todo)), n)
        bound = reach / n
        x, turn = np.zeros(len(element)), 0
        while len(element):
            take = 1 if len(element) > 4096 else 32
            k = np.arange(turn, turn + take, dtype=np.uint64)
            u = mix(element[:, None] + (k + np.uint64(1)) * _GOLD)
            points = x[:, None] + np.cumsum(-np.log(((u >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53), 1) / REGISTERS
            place = (mix(u ^ _GOLD) & np.uint64(REGISTERS - 1)).astype(np.int64) + of[:, None] * REGISTERS
            inside = points <= bound[of][:, None]
            np.minimum.at(low, place[inside], points[inside])
            x, turn = points[:, -1], turn + take
            more = inside[:, -1]
            element, of, x = element[more], of[more], x[more]
        low = low.reshape(-1, REGISTERS)
        full = np.isfinite(low).all(1)
        value = np.floor(1 - np.log(low[full] / SCALE) / np.log(BASE))
        out[todo[full]] = np.clip(value, 0, LIMIT).astype(np.uint16)
        todo, reach = todo[~full], reach * 2
    return out


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _log_base(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


_GRID = np.linspace(0, 1, 101)


def joint_estimate(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity, given in how many registers a is above and below b, and both sizes."""
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    j = _GRID[None] * np.minimum(u, v) / np.maximum(u, v)
    p_above, p_below = _log_base(u - v * j), _log_base(v - u * j)
    same = np.clip(1 - p_above - p_below, 1e-12, 1)
    above, below = above[:, None], below[:, None]
    like = above * np.log(np.maximum(p_above, 1e-12)) + below * np.log(np.maximum(p_below, 1e-12)) + (REGISTERS - above - below) * np.log(same)
    return j[np.arange(len(j)), like.argmax(1)]


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in shingle_sets(batch.column("text"), words):
                sign = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(sign[:, 0]), pa.array(sign[:, 1]), pa.array([r.tobytes() for r in registers(sets)], pa.binary())],
                    names=["row", "doc_id", "n", "g1", "g2", "sketch"],
                )

    return docs.mapInArrow(run, f"row {ROW}, doc_id long, n long, g1 long, g2 long, sketch binary")


def _keys_of(four: np.ndarray) -> np.ndarray:
    """Bucket key of every band: its four registers, read as one number, and its place."""
    return mix(mix(four.copy()) + np.arange(1, four.shape[1] + 1, dtype=np.uint64) * _GOLD)


def _band_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): one row for each band of each class."""
    bands = REGISTERS // BAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                key = _keys_of(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(-1, bands))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), bands))], names=["key", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "key long, node long")


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose registers allow the threshold."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                s = [np.frombuffer(b"".join(batch.column(f"s_{x}").to_pylist()), np.uint16).reshape(-1, REGISTERS) for x in "ab"]
                n = [batch.column(f"n_{x}").to_numpy().astype(float) for x in "ab"]
                est = joint_estimate((s[0] > s[1]).sum(1), (s[0] < s[1]).sum(1), *n)
                ok = (est >= threshold - MARGIN) & (np.minimum(*n) >= threshold * np.maximum(*n) - 1e-9)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    # b first: it may be the smallest of a very large bucket
    return dealt_join(pairs, side("b"), ["b"], ["a"]).join(side("a"), "a").mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int, repeats: bool) -> DataFrame:
    """(node, hashes) of the nodes, from the text of one row of each class; `repeats`: rows may be there twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in shingle_sets(batch.column("text"), words):
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "hashes"])

    rows = classes.join(nodes, "node").select("row", "node")
    texts = docs.join(rows, "row")
    # by row: different texts under one doc_id share a node, and all their sets count
    texts = texts.dropDuplicates(["row"]) if repeats else texts
    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on full sets."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("h_a").to_pylist(), batch.column("h_b").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                z = np.sort(np.concatenate([x, y]))
                both = int((z[1:] == z[:-1]).sum())
                ok.append(100 * both >= percent * (len(z) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # b first, while the rows are narrow: it may have very many partners
    return dealt_join(pairs, side("b"), ["b"], ["a"]).join(side("a"), "a").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for all nodes of links (a, b).

    Each turn takes the smallest label of the neighbours and then the label's own label, so paths shorten by doubling.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    degrees = stored(both.groupBy("b").agg(F.count("*").alias("k")))
    while True:
        near = dealt_join(both, labels.withColumnRenamed("node", "b"), ["b"], ["a"], degrees).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        low = stored(labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c")))
        up = labels.select(F.col("node").alias("c"), F.col("component").alias("cc"))
        new = stored(dealt_join(low, up, ["c"], ["node"]).select("node", "old", F.least("c", "cc").alias("component")))
        if not new.where("old <> component").limit(1).count():
            return new.select("node", "component")
        labels = new.select("node", "component")


def _group_pairs(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one cell: inside its block, or between its two blocks."""
    if i == j:
        return np.triu_indices(len(own), 1)
    x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
    return np.repeat(x, len(y)), np.tile(y, len(x))


def _each_cell(rows: DataFrame, handle, schema: str) -> DataFrame:
    """Stream a table through `handle`, which gets runs of whole (key, i, j) cells in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            t = pa.Table.from_batches([*held, batch])
            if not len(t):
                continue
            same = np.ones(len(t), bool)  # the last cell may go on in the next batch
            for c in ("key", "i", "j"):
                same &= t.column(c).to_numpy() == t.column(c)[-1].as_py()
            cut = int(np.argmax(same))
            if cut:
                yield handle(t.slice(0, cut))
            held = t.slice(cut).combine_chunks().to_batches()
        if held:
            yield handle(pa.Table.from_batches(held))

    return rows.repartition(shuffles(rows.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, schema)


def _likely_in_cells(t: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of different components that the registers allow, each in the first band that both share."""
    col = {c: t.column(c).to_numpy() for c in ("key", "i", "j", "own", "component", "n")}
    s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    four = s.view(np.uint64)
    cell = np.flatnonzero(np.concatenate([[True], (np.diff(col["key"]) != 0) | (np.diff(col["i"]) != 0) | (np.diff(col["j"]) != 0), [True]]))
    least = (threshold - MARGIN) * REGISTERS
    for lo, hi in zip(cell[:-1].tolist(), cell[1:].tolist()):
        band = int(np.argmax(_keys_of(four[lo : lo + 1])[0] == col["key"][lo : lo + 1].view(np.uint64)))
        x, y = _group_pairs(col["own"][lo:hi], col["i"][lo], col["j"][lo])
        x, y = x + lo, y + lo
        small, large = np.minimum(col["n"][x], col["n"][y]), np.maximum(col["n"][x], col["n"][y])
        ok = (col["component"][x] != col["component"][y]) & (small >= threshold * large - 1e-9)
        x, y = x[ok], y[ok]
        for at in range(0, len(x), 8192):
            a, b = x[at : at + 8192], y[at : at + 8192]
            ok = (four[a] == four[b]).argmax(1) == band
            a, b = a[ok], b[ok]
            ok = (s[a] == s[b]).sum(1) >= least  # equal registers alone come close to the similarity
            a, b = a[ok], b[ok]
            if len(a):
                est = joint_estimate((s[a] > s[b]).sum(1), (s[a] < s[b]).sum(1), col["n"][a].astype(float), col["n"][b].astype(float))
                ok = est >= threshold - MARGIN
                yield a[ok], b[ok]


def _short_hashes(sets: DataFrame) -> DataFrame:
    """(node, short): the sets with the upper half of each hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [(np.frombuffer(h, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for h in batch.column("hashes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(short, pa.binary())], names=["node", "short"])

    return sets.mapInArrow(run, "node long, short binary")


def _cells(members: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, dealt to bounded cells; members (key, node, b).

    Pairs with the bucket's smallest node b have been tried before, so b itself stays out.
    """
    own = members.where("node <> b").select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    buckets = stored(own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("k")))
    mixed = buckets.where("lo < hi").select("key", F.ceil(F.col("k") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = dealt_join(own, mixed, ["key"], ["node"], buckets.select("key", "k")).join(nodes.select("node", "n", "sketch"), "node")
    # block i meets block j in cell (i, j); a row goes to every cell of its block
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "n", "sketch")


_CELL = "key long, i int, j int, own int, node long, component long, n long, sketch binary"


def _with_partners(cells: DataFrame, threshold: float) -> DataFrame:
    """Rows of cells that have at least one likely partner there: never more rows than came."""

    def handle(t: pa.Table) -> pa.RecordBatch:
        seen = np.zeros(len(t), bool)
        for a, b in _likely_in_cells(t, threshold):
            seen[a] = seen[b] = True
        kept = t.filter(pa.array(seen)).combine_chunks()
        return pa.RecordBatch.from_arrays([kept.column(c).combine_chunks() if kept.num_rows else pa.array([], t.schema.field(c).type) for c in t.schema.names], names=t.schema.names)

    return _each_cell(cells, handle, _CELL)


def _links_in_cells(cells: DataFrame, short: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Pairs (a, b) of cells that reach the threshold on short hashes, but for two elements of slack: all links and hardly more."""

    def handle(t: pa.Table) -> pa.RecordBatch:
        node, sets = t.column("node").to_numpy(), [np.frombuffer(x, np.uint32) for x in t.column("short").to_pylist()]
        size = np.array([len(x) for x in sets])
        out = [np.zeros((0, 2), np.int64)]
        for a, b in _likely_in_cells(t, threshold):
            by = np.argsort(a, kind="stable")
            a, b = a[by], b[by]
            for lo, hi in zip(*(x.tolist() for x in (np.flatnonzero(np.diff(a, prepend=-1)), np.flatnonzero(np.diff(a, append=-1)) + 1))):
                one, others = sets[a[lo]], b[lo:hi]
                cat = np.concatenate([sets[k] for k in others])
                hit = one[np.minimum(np.searchsorted(one, cat), len(one) - 1)] == cat
                both = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(size[others])[:-1]]))
                ok = 100 * (both + 2) >= percent * (size[a[lo]] + size[others] - both - 2)
                if ok.any():
                    pair = np.stack([np.full(int(ok.sum()), node[a[lo]]), node[others[ok]]], 1)
                    out.append(np.stack([pair.max(1), pair.min(1)], 1))
        found = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return _each_cell(cells.join(short, "node"), handle, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles, component_id, kept of each document; see the module text."""
    docs = documents.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    threshold = percent / 100
    sketched = stored(_sketches(docs, words))
    repeats = bool(sketched.groupBy("row").count().where("count > 1").limit(1).count())
    usable = sketched.where("n > 0 and doc_id is not null")
    classes = stored(usable.groupBy("g1", "g2").agg(F.min(F.struct("doc_id", "row")).alias("at"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("k")).select("g1", "g2", "k", F.col("at.doc_id").alias("node"), F.col("at.row").alias("row"), "n", "sketch"))
    nodes = classes.select("node", "n", "sketch")
    keys = _band_keys(nodes)
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("k"), F.min("node").alias("b")).where("k > 1"))
    members = stored(dealt_join(keys, shared.select("key", "b"), ["key"], ["node"], shared.select("key", "k")))
    likely = stored(_likely(stored(members.where("node <> b").select(F.col("node").alias("a"), "b").distinct()), nodes, threshold))
    sets = stored(_full_sets(docs, classes, likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), words, repeats))
    links = stored(_confirm(likely, sets, percent))
    labels = components(links)
    # one turn is enough: afterwards every pair of bucket mates has been tried or lies in one component
    cells = stored(_with_partners(_cells(members, nodes, labels), threshold))
    if cells.limit(1).count():
        missing = stored(cells.select("node").distinct().join(sets.select("node"), "node", "left_anti"))
        if missing.limit(1).count():
            sets = sets.unionByName(stored(_full_sets(docs, classes, missing, words, repeats)))
        found = stored(_links_in_cells(cells, _short_hashes(sets), threshold, percent))
        labels = components(links.unionByName(stored(_confirm(found, sets, percent))))
    groups = classes.select("g1", "g2", "node").join(labels, "node", "left").select("g1", "g2", F.coalesce("component", "node").alias("c"))
    found = dealt_join(usable, groups, ["g1", "g2"], ["row"], classes.select("g1", "g2", "k"))
    # rows that link with nothing share a signature (empty sets) or have no doc_id; they need no join
    alone = sketched.where("n = 0 or doc_id is null").withColumn("c", F.col("doc_id"))
    out = found.select("doc_id", "row", "n", "c").unionByName(alone.select("doc_id", "row", "n", "c"))
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("c"), F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """documents with one doc_id of each near-duplicate group: the smallest."""
    row = free_name(documents, "_row")
    gone = near_duplicates(documents, words, percent).where("not kept").select(F.col("row").alias(row)).distinct()
    return documents.withColumn(row, row_key()).join(gone, row, "left_anti").drop(row)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def brute_force(docs: list[tuple[int, str | None]], words: int, percent: int) -> list[tuple]:
    """Digest rows by comparing all pairs; for tests."""
    import re

    sets = {}
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [(d, len(sets[d]), top(d), top(d) == d) for d in ids]


ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d
), n as (select doc_id, count(*) as n from s group by doc_id),
i as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
r as (select doc_id as a, doc_id as c from n union select l.b, r.c from r join l on l.a = r.a)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(m.c, d.doc_id) as component_id, coalesce(m.c, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join (select a as doc_id, min(c) as c from r group by 1) m using (doc_id)
"""

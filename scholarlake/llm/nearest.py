"""Operator 10: exact nearest neighbours by inner product as a block matrix join.

Query rows are packed into blocks, and blocks into batches of at most BATCH_BYTES. Each batch is broadcast,
and every task streams its own candidates past it where they lie: no candidate is shuffled, however many
batches there are. int8 codes of a query block and a candidate block give products with a bound on their
quantisation error. A query's k-th best lower bound so far excludes candidates whose upper bound is below it;
the rest is recomputed in double precision from the original vectors and merged into the query's heap.

A task gives at most k rows a query. So that their number does not grow with the tasks, a first turn over one
candidate in FLOOR_EVERY gives each query of a batch a floor - its k-th best there - and tasks give only
what reaches it: about k * FLOOR_EVERY rows a query over all tasks. The tasks' heaps are merged by query.
Nothing is approximate in the result.

Defined results: null, zero, non-finite or null-holding vectors take no part; vectors meet only those of
their own length; rows that repeat a vec_id count once, with the smallest vector; a query never finds its
own row; ties go to the smaller vec_id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, stored

QUERY_EVERY = 20
K = 20
#: Rows in a block of queries, rows and bytes in a block of candidates.
QUERY_ROWS, BLOCK_ROWS, BLOCK_BYTES = 256, 2048, 8 << 20
#: Bytes of query vectors in one broadcast.
BATCH_BYTES = 16 << 20
FLOOR_EVERY = 64
#: Products of codes are whole numbers below 127^2 * TILE < 2^24, exact in float32.
TILE = 1024
_FOUND = "query_id long, vec_id long, score double"


def usable(embeddings: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null").where(finite & some)
    twice = stored(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"))
    if not twice.limit(1).count():
        return rows
    once = rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.join(twice, "vec_id", "left_anti").unionByName(once)


class Codes:
    """int8 codes of rows: value = scale * code, off by at most scale / 2 a component."""

    def __init__(self, rows: np.ndarray):
        self.scale = np.abs(rows).max(1) / 127
        self.scale[self.scale == 0] = np.finfo(float).tiny
        self.code = np.clip(np.rint(rows / self.scale[:, None]), -127, 127).astype(np.int8)
        self.rest = np.linalg.norm(rows - self.code * self.scale[:, None], axis=1)
        self.norm = np.linalg.norm(rows, axis=1)


def tile_bounds(q: Codes, c: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Estimated products of int8 codes and the bound of their error."""
    total = np.zeros((len(q.code), len(c.code)))
    for d in range(0, q.code.shape[1], TILE):
        total += q.code[:, d : d + TILE].astype(np.float32) @ c.code[:, d : d + TILE].astype(np.float32).T
    # x.y - x'.y' = x.(y - y') + (x - x').y', by Cauchy-Schwarz; the last term covers rounding
    code_norm = c.norm + c.rest
    return total * (q.scale[:, None] * c.scale), q.norm[:, None] * c.rest + q.rest[:, None] * code_norm + 1e-9 * q.norm[:, None] * code_norm


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in component order."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * c[:, d]
    return out


class Heaps:
    """The k best candidates so far of each query of a block, from its floor on."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.rows, self.k, self.floor, self.codes = ids, rows, k, floor, Codes(rows)
        self.score, self.found = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)

    def take(self, ids: np.ndarray, rows: np.ndarray, codes: Codes) -> None:
        """Merge one block of candidates in."""
        est, err = tile_bounds(self.codes, codes)
        same = self.ids[:, None] == ids
        low = np.where(same | np.isnan(est - err), -np.inf, est - err)
        floor = np.maximum(self.score[:, -1], self.floor)
        if low.shape[1] >= self.k:
            floor = np.maximum(floor, np.partition(low, -self.k, axis=1)[:, -self.k])
        # written so that products beyond the range of doubles stay in
        qi, ci = np.nonzero(~(est + err < floor[:, None]) & ~same)
        score = products(self.rows[qi], rows[ci])
        reach = ~(score < self.floor[qi])
        qi, ci, score = qi[reach], ci[reach], score[reach]
        if not len(qi):
            return
        own = np.unique(qi)
        # what was best so far and the survivors, by score and smaller id
        qi = np.concatenate([np.repeat(own, self.k), qi])
        score, cand = np.concatenate([self.score[own].ravel(), score]), np.concatenate([self.found[own].ravel(), ids[ci]])
        by = np.lexsort((cand, -score, qi))
        qi, score, cand = qi[by], score[by], cand[by]
        top = np.arange(len(qi)) - np.searchsorted(qi, qi, "left") < self.k
        self.score[own], self.found[own] = score[top].reshape(-1, self.k), cand[top].reshape(-1, self.k)

    def best(self) -> pa.RecordBatch:
        there = self.found < np.iinfo(np.int64).max
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, there.sum(1))), pa.array(self.found[there]), pa.array(self.score[there])], names=["query_id", "vec_id", "score"])


def _blocks(batch: pa.RecordBatch, rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, vectors) in blocks of one dimension, of at most `rows` rows and BLOCK_BYTES."""
    ids, lists = batch.column("vec_id").to_numpy(), batch.column("embedding")
    offs, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
    dims = np.diff(offs)
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        per = max(1, min(rows, BLOCK_BYTES // (8 * dim)))
        for lo in range(0, len(own), per):
            part = own[lo : lo + per]
            yield dim, ids[part], values[offs[part][:, None] + np.arange(dim)].astype(np.float64)


def _query_blocks(queries: DataFrame) -> DataFrame:
    """Packed query blocks (dim, ids, data), made where the rows lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, rows in _blocks(batch, QUERY_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())], names=["dim", "ids", "data"])

    return queries.mapInArrow(run, "dim int, ids binary, data binary")


def _batches(blocks: DataFrame) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Query blocks in lists of at most BATCH_BYTES (or one block); the driver holds one list at a time."""
    held, size = [], 0
    for r in blocks.toLocalIterator():
        if held and size + len(r["data"]) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append((r["dim"], bytes(r["ids"]), bytes(r["data"])))
        size += len(r["data"])
    if held:
        yield held


def _search(candidates: DataFrame, batch: list[tuple[int, bytes, bytes]], k: int, floors: dict[int, float]) -> DataFrame:
    """query_id, vec_id, score: each task's k best candidates of each query of a batch that reach its floor."""
    shared = candidates.sparkSession.sparkContext.broadcast(pickle.dumps((batch, floors)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, known = pickle.loads(shared.value)
        heaps: dict[int, list[Heaps]] = {}
        for dim, ids, data in blocks:
            ids = np.frombuffer(ids, np.int64)
            heaps.setdefault(dim, []).append(Heaps(ids, np.frombuffer(data).reshape(-1, dim), k, np.array([known.get(i, -np.inf) for i in ids.tolist()])))
        for batch in batches:
            for dim, ids, rows in _blocks(batch, BLOCK_ROWS):
                codes = Codes(rows) if dim in heaps else None
                for h in heaps.get(dim, ()):
                    h.take(ids, rows, codes)
        for own in heaps.values():
            yield from (h.best() for h in own)

    return candidates.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each row whose id query_every divides."""
    spark, rows = embeddings.sparkSession, usable(embeddings)
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(FLOOR_EVERY)) == 0)
    path = scratch(spark)
    spark.createDataFrame([], _FOUND).write.parquet(f"{path}/batch=-1")
    blocks = stored(_query_blocks(rows.where(F.pmod("vec_id", F.lit(query_every)) == 0)))
    for i, batch in enumerate(_batches(blocks)):
        # one number a query of the batch
        floors = {r["query_id"]: r["score"] for r in _ranked(_search(some, batch, k, {}), k).where(F.col("rank") == k).select("query_id", "score").collect()}
        _search(rows, batch, k, floors).write.parquet(f"{path}/batch={i}")
    found = spark.read.schema(_FOUND).parquet(path).select("query_id", "vec_id", "score")
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: dict[int, list], k: int = K, query_every: int = QUERY_EVERY) -> list[tuple]:
    ids = sorted(rows)
    out = []
    for q in (x for x in ids if x % query_every == 0):
        near = sorted(((-float(products(np.array([rows[q]], float), np.array([rows[c]], float))[0]), c) for c in ids if c != q and len(rows[c]) == len(rows[q])))[:k]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(near, 1)]
    return out


ORACLE = """
with v as (
  select vec_id, min(cast(embedding as double[])) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
  group by vec_id
),
p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score from v q join v c on c.vec_id <> q.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 20
"""

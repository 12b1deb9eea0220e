"""Operator 9: quality classifier, a byte-level convolutional network in numpy.

Learned byte vectors feed learned filters of WIDTH bytes every STEP bytes. Half-chunks of HALF bytes
are max-pooled, two neighbouring halves make one chunk (chunks overlap by half and cover the whole
text), and the mean and the maximum over all chunks go through one logistic unit. A text of any length
is read in bounded pieces. The score depends on the bytes of the text alone.

Training takes a bounded sample: at most MAX_SAMPLE labelled rows that have a document, the smallest by a hash of
doc_id. Texts of more than MAX_TRAIN_BYTES bytes give four stretches of a quarter of that each, spread over the
text. Rows whose crc32(doc_id as text) mod 5 is 0 are never used.

Defined results: null and empty texts get the score of an empty text; without usable labels every score
is 0.5, with one class it is near that class; labels of one document that disagree are each used;
null labels and labels without document are ignored; repeated rows get equal scores; an empty table gives no rows; extra columns of
the documents are kept by `keep_good`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_chunks, widened

MAX_SAMPLE, MAX_TRAIN_BYTES = 3000, 1 << 15
THRESHOLD = 0.3
DIM, FILTERS, WIDTH, STEP, HALF = 8, 16, 8, 4, 256
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.01, 7
_SLICE = 1024  # half-chunks in one product


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def layout(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts set out at multiples of HALF bytes with at least WIDTH zero bytes behind each, and their bounds in half-chunks."""
    halves = (np.diff(offs) + WIDTH + HALF - 1) // HALF
    at = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(at[-1]) * HALF + WIDTH, np.uint8)
    for a, b, to in zip(offs[:-1].tolist(), offs[1:].tolist(), (at[:-1] * HALF).tolist()):
        out[to : to + b - a] = buf[a:b]
    return out, at


class ByteConvNet:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "bytes": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }
        self.trained = False

    def halves(self, data: np.ndarray, at: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Max over each half-chunk of every filter's response (0 at least); where it was, if asked."""
        n, per = int(at[-1]), HALF // STEP
        last = np.zeros(n, bool)
        last[at[1:] - 1] = True
        out, where = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64) if places else None
        for lo in range(0, n, _SLICE):
            hi = min(n, lo + _SLICE)
            x = self.p["bytes"][data[lo * HALF : hi * HALF + WIDTH]]
            # windows of WIDTH bytes every STEP bytes, as rows
            view = np.lib.stride_tricks.as_strided(x, ((hi - lo) * per, WIDTH * DIM), (x.strides[0] * STEP, x.strides[1]))
            r = (np.ascontiguousarray(view) @ self.p["filters"] + self.p["shift"]).reshape(hi - lo, per, FILTERS)
            np.maximum(r, 0, out=r)
            r[last[lo:hi], -1] = 0  # this window alone reaches into the next text; it holds padding only
            out[lo:hi] = r.max(1)
            if places:
                where[lo:hi] = r.argmax(1)
        return out, where

    @staticmethod
    def chunks(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second half of each chunk, and each text's bounds in chunks. A text of one half is one chunk."""
        n = np.diff(at)
        per = np.maximum(n - 1, 1)
        bound = np.concatenate([[0], np.cumsum(per)])
        first = np.repeat(at[:-1] - bound[:-1], per) + np.arange(bound[-1])
        second = np.minimum(first + 1, np.repeat(at[1:] - 1, per))
        return first, second, bound

    def features(self, halves: np.ndarray, at: np.ndarray) -> np.ndarray:
        a, b, bound = self.chunks(at)
        c = np.maximum(halves[a], halves[b])
        return np.concatenate([np.add.reduceat(c, bound[:-1]) / np.diff(bound)[:, None], np.maximum.reduceat(c, bound[:-1])], 1)

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = (features.astype(np.float64) * self.p["out"].astype(np.float64)).sum(1) + float(self.p["bias"][0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(offs) - 1, 0.5)
        data, at = layout(buf, offs)
        return self.probability(self.features(self.halves(data, at)[0], at))

    def fit(self, texts: list[bytes], labels: np.ndarray) -> ByteConvNet:
        """Adam on the logistic loss; gradients pass through the maxima to the windows that gave them."""
        rng, m, v, t = np.random.default_rng(SEED), {}, {}, 0
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.p["bias"][:] = np.log(share / (1 - share))
        per = HALF // STEP
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for lo in range(0, len(texts), BATCH):
                own = order[lo : lo + BATCH]
                offs = np.cumsum([0, *(len(texts[i]) for i in own)])
                data, at = layout(np.frombuffer(b"".join(texts[i] for i in own), np.uint8), offs)
                h, where = self.halves(data, at, True)
                a, b, bound = self.chunks(at)
                n = np.diff(bound)
                c = np.maximum(h[a], h[b])
                top = np.maximum.reduceat(c, bound[:-1])
                f = np.concatenate([np.add.reduceat(c, bound[:-1]) / n[:, None], top], 1)
                g = ((self.probability(f) - labels[own]) / len(own)).astype(np.float32)
                grad = {"out": f.T @ g, "bias": np.array([g.sum()], np.float32)}
                df = g[:, None] * self.p["out"]
                text = np.repeat(np.arange(len(own)), n)
                is_top = c == top[text]
                dc = (df[:, :FILTERS] / n[:, None])[text] + is_top * (df[:, FILTERS:] / np.add.reduceat(is_top, bound[:-1], dtype=np.float32))[text]
                dh = np.zeros_like(h)
                left = h[a] >= h[b]
                np.add.at(dh, a, dc * left)
                np.add.at(dh, b, dc * ~left)
                dh *= h > 0
                hi, fi = np.nonzero(dh)
                d = dh[hi, fi]
                start = hi * HALF + where[hi, fi] * STEP
                seen = data[start[:, None] + np.arange(WIDTH)]
                x = self.p["bytes"][seen].reshape(len(start), -1)
                pick = np.zeros((len(start), FILTERS), np.float32)
                pick[np.arange(len(start)), fi] = d
                grad["filters"], grad["shift"] = x.T @ pick, pick.sum(0)
                back = (d[:, None] * self.p["filters"].T[fi]).reshape(-1, DIM)
                grad["bytes"] = np.zeros((256, DIM), np.float32)
                np.add.at(grad["bytes"], seen.ravel(), back)
                t += 1
                for k, x in grad.items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * x
                    v[k] = 0.999 * v.get(k, 0) + 0.001 * x * x
                    self.p[k] -= (RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        self.trained = True
        return self


def windows_of(text: bytes, limit: int) -> list[bytes]:
    """A text of at most `limit` bytes whole; of a longer one four stretches spread evenly, its beginning and end among them."""
    if len(text) <= limit:
        return [text]
    size = limit // 4
    return [text[at : at + size] for at in np.linspace(0, len(text) - size, 4).astype(int).tolist()]


def train(documents: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, max_bytes: int = MAX_TRAIN_BYTES) -> ByteConvNet:
    """Fit on the bounded sample that the module text describes."""
    marks = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    # ids of documents with labels first, at most max_sample small rows: a bounded broadcast
    picked = documents.select("doc_id").join(marks, "doc_id").orderBy(*order).limit(max_sample).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [windows_of(t or b"", max_bytes) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(parts, pa.list_(pa.binary()))], names=["doc_id", "quality", "parts"])

    sampled = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text")
    rows = sampled.mapInArrow(run, "doc_id long, quality int, parts array<binary>").orderBy(*order, "parts").limit(max_sample).collect()
    net = ByteConvNet()
    texts = [(bytes(p), r["quality"]) for r in rows for p in r["parts"]]
    return net.fit([t for t, _ in texts], np.array([q for _, q in texts], np.float64)) if texts else net


def score(documents: DataFrame, net: ByteConvNet, column: str = "_score") -> DataFrame:
    """documents with the net's probability of label 1."""
    shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps(net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            out = [np.zeros(0)]
            out += [model.score(buf, offs) for _, _, buf, offs in text_chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, column])

    return documents.mapInArrow(run, widened(documents, **{column: "double"}))


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """documents that the classifier does not reject."""
    column = free_name(documents, "_score")
    return score(documents, train(documents, labels), column).where(F.col(column) >= threshold).drop(column)

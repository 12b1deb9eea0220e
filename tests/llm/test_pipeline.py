"""The corpus pipeline against the stages' brute-force versions, one after the other."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scholarlake.llm import decontamination, line_dedup, near_dedup, pieces, quality
from scholarlake.llm.queries import tokenizer_path

from .fixtures import awkward_texts, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    texts = awkward_texts(4)
    junk = [prose(rng, 60).upper().replace(" ", "!! ") for _ in range(60)]
    good = [prose(rng, 80) for _ in range(60)]
    item = prose(rng, 15)
    leaked = [f"{prose(rng, 40)} {item} {prose(rng, 40)}"]
    rows = [(i, t, "en", None, len(t) if t is not None else None) for i, t in enumerate([*texts, *good, *leaked, *junk])]
    labels = [(len(texts) + i, 1, 0) for i in range(len(good))] + [(len(rows) - 1 - i, 0, 0) for i in range(len(junk))]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, [r[:2] for r in rows]


def _deduped_lines(rows):
    key = lambda line: line.encode().strip(line_dedup.BLANKS).lower().decode()
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    gone = lambda d, k: len(k) >= 40 and len(holders[k]) >= 5 and max(holders[k]) != d
    return [(d, "\n".join(x for x in (t or "").split("\n") if not gone(d, key(x)))) for d, t in rows]


def test_run_equals_the_stages_by_hand(spark, folder):
    path, rows = folder
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert 0 < len(good) < len(rows)
    want = _deduped_lines([r for r in rows if r[0] in good])
    kept = {r[0] for r in near_dedup.brute_force(want, 5, 80) if r[3]}
    want = [r for r in want if r[0] in kept]
    clean = {r[0] for r in decontamination.brute_force(want, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]) if not r[-1]}
    assert len(clean) == len(want) - 1
    want = dict(r for r in want if r[0] in clean)
    out = corpus_pipeline.run(spark, path)
    assert {r["doc_id"]: r["text"] for r in pieces.decode_documents(out, tokenizer_path("piece_bpe_32k.model")).collect()} == want
    assert out.where("not lossless").count() == 0


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).schema.simpleString() == docs.schema.simpleString()
    lines = corpus_pipeline.dedup_lines(spark, docs, path)
    assert lines.where(F.col("n_chars") != F.length("text")).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0

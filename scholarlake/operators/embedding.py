"""Embeddings of article texts through a user's function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scholarlake.functions import scalars as S
from scholarlake.operators.candidates import counting_skipped


def pending(articles: DataFrame) -> DataFrame:
    """article_id and text of live articles without embedding; blank texts are left out."""
    return pending_counted(articles)[0]


def pending_counted(articles: DataFrame) -> tuple[DataFrame, Observation]:
    """pending, and an observation of how many there were and how many blank texts were skipped."""
    live = articles.where(F.col("embedding").isNull() & ~F.coalesce("is_deleted", F.lit(False)))
    return counting_skipped(live.select("article_id", S.article_text("title", "abstract").alias("text")), F.col("text") != "")


def embed(texts: DataFrame, make_model: Callable[[], Callable[[list[str]], list]], dim: int, batch: int = 16, normalize: bool = False) -> DataFrame:
    """article_id and embedding. make_model is called once for each partition and gives a function of texts.

    A vector of another length is an error.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for pdf in parts:
            vectors = []
            for lo in range(0, len(pdf), batch):
                for v in model(pdf["text"].iloc[lo : lo + batch].tolist()):
                    v = np.asarray(v, np.float32)
                    if v.shape != (dim,):
                        raise ValueError(f"the model gave {v.shape} for {dim} dimensions")
                    n = np.linalg.norm(v)
                    vectors.append((v / n if normalize and n else v).tolist())
            yield pd.DataFrame({"article_id": pdf["article_id"], "embedding": vectors})

    return texts.select("article_id", "text").mapInPandas(run, "article_id long, embedding array<float>")


def store_embeddings(articles: DataFrame, vectors: DataFrame) -> DataFrame:
    new = vectors.select("article_id", F.col("embedding").alias("_new"))
    return articles.join(new, "article_id", "left").withColumn("embedding", F.coalesce("_new", "embedding")).drop("_new")

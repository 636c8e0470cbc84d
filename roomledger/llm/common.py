"""Helpers that several of the text operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.sources.scratch import scratch_path

# Labelled rows that the toxicity grammar is fitted on, at most. Taken by the hash of their id.
LABEL_SAMPLE = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder.

    Cuts the lineage: the loss of an executor after the write costs nothing. The folder is
    that of ``spark.checkpoint.dir``, or the warehouse where that is unset; what is left in it
    (``roomledger-*``) can be deleted once the results are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(id_col: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else; a null text is empty."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def labelled_sample(
    labels: DataFrame, target: str, held_out: Column, limit: int | None = LABEL_SAMPLE
) -> DataFrame:
    """(doc_id, label) of the labelled documents that are not held out, ``limit`` at most if given.

    One row per document; of contradicting labels the larger counts. The documents with the
    smallest hashes of their ids are taken, so the sample does not depend on the row order.
    """
    known = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max(F.col(target).cast("double")).alias("label"))
    )
    return known if limit is None else known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit_logistic(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    penalty: float,
    prior: np.ndarray | None = None,
    steps: int = 60,
) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a Gaussian prior on the weights."""
    prior = np.zeros(x.shape[1]) if prior is None else prior
    w = prior.copy()

    def loss(v):
        z = x @ v
        return np.sum(weight * (np.logaddexp(0, z) - y * z)) + penalty / 2 * np.sum((v - prior) ** 2)

    value = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * (w - prior)
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(curvature + penalty * np.eye(len(w)), gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > value:
            size /= 2
        new = w - size * step
        if loss(new) > value - 1e-9:
            break
        w, value = new, loss(new)
    return w

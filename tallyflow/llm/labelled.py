"""Joining documents with their labels for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, small_side


def fold(doc_id, folds: int):
    """Column: crc32 of the doc_id as text, modulo ``folds``; -1 for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, held_out_fold: int, folds: int) -> DataFrame:
    """(doc_id, text, label) of the labelled documents outside the held-out fold. Conflicting or repeated labels of an id count as their maximum, null ones not at all."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(f"label is not null and doc_id is not null").where(fold(F.col("doc_id"), folds) != held_out_fold)
    known = cut(known.groupBy("doc_id").agg(F.max("label").alias("label")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(small_side(known), "doc_id")


def bounded(rows: DataFrame, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` of the training rows, the first in the order of a hash of their id; of either label a tenth of ``limit`` at least, if there are so many. Equal rows count once."""
    texts = cut(rows.select("doc_id", (F.col("label") > 0).alias("high"), F.xxhash64("text").alias("h")).distinct())
    n = {r["high"]: r["n"] for r in texts.groupBy("high").agg(F.count("*").alias("n")).collect()}
    keep = None
    for high, x in sorted(n.items()):
        most = max(round(limit * x / sum(n.values())), min(x, limit // 10))
        part = texts.where(F.col("high") == high).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "h").limit(most)
        keep = part if keep is None else keep.union(part)
    if keep is None:
        return rows
    keep = cut(keep.select("doc_id", "h"))
    return rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(keep), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"]).drop("h")


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (margin, label), by damped Newton steps with smoothed targets."""
    high, low = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (high + 1) / (high + 2), 1 / (low + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b

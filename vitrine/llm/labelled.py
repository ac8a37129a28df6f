"""Bounded labelled samples for classifiers, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.rows import crc_column
from vitrine.workspace import stage


def sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, fold: tuple[int, int], text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """(text, label, weight): at most `per_class` training documents of each class, those with the smallest hash of their id.

    `fold` = (parts, held): documents whose crc32(id as text) mod parts is `held` are never taken. Rows without an id, with a null
    label or another label than 0 and 1 are left out; of several labels of one document the larger counts. `weight` is
    the number of labelled training documents that a sampled one stands for. The ids, bounded by `per_class`, are staged, and
    only the texts of these are gathered.
    """
    parts, held = fold
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .withColumn("crc", crc_column("id"))
        .where(F.col("crc") % parts != held)
        .groupBy("id", "crc").agg(F.max("label").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    taken = None
    for value in (0, 1):
        weight = F.lit(max(1.0, sizes.get(value, 0) / per_class))
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class).withColumn("weight", weight)
        taken = part if taken is None else taken.unionByName(part)
    ids = stage(taken.select("id", "label", "weight"), "sample")
    source = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return source.join(F.broadcast(ids), "id").select("text", "label", "weight")  # 2 * per_class ids at most


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression (the last one is the constant), by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))

"""Small helpers for fitting on bounded samples: which rows, and a logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts longer than this are scored whole like all others, but not taken into a sample to learn from.
MAX_SAMPLE_BYTES = 1 << 16


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, per_class: int, id_col: str, text_col: str):
    """((text bytes, label) of a bounded sample, share of label 1 among all learnable rows).

    At most ``per_class`` rows of each label come to the driver, those with the smallest hash of the id; only their ids
    meet the documents, so no text is shuffled for them.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.where(learnable & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = None
    for k in (0, 1):
        some = marked.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    ids = ids.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in ids.collect()], "doc_id long, label int")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    # At most 2 * per_class ids: a broadcast of known size.
    rows = texts.where(F.octet_length("text") <= MAX_SAMPLE_BYTES).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sorted(rows.collect(), key=lambda r: r["doc_id"])
    return [(bytes(r["text"]), r["label"]) for r in rows], counts.get(1, 0) / max(1, sum(counts.values()))


class Logistic:
    """Logistic regression by Newton steps; rows are weighed so that label 1 has the share ``prior``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, prior: float, penalty: float = 1e-2):
        share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
        weight = weight / weight.mean()
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        a = self._with_one(x)
        self.w = np.zeros(a.shape[1])
        for _ in range(30):
            p = self._squash(a @ self.w)
            slope = a.T @ (weight * (p - y)) / len(y) + penalty * self.w
            bend = (a * (weight * p * (1 - p))[:, None]).T @ a / len(y) + penalty * np.eye(len(self.w))
            self.w = self.w - np.linalg.solve(bend, slope)

    def _with_one(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -20, 20), np.ones((len(x), 1))])

    @staticmethod
    def _squash(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._squash(self._with_one(x) @ self.w)


def log_loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

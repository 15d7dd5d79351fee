"""Bounded samples of labelled documents, and the small models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .inputs import fold, texts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, text, label) of at most `per_class` training documents of each class, picked by hash of the id; and, for
    each class, how many training labels one that is picked stands for.

    Labels of other values and null ids are left out; a document labelled more than once has its smallest label, and one
    that occurs more than once its smallest text.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    stands_for = np.array([max(1.0, total.get(k, 0) / per_class) for k in (0, 1)])
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * per_class rows
    sample = texts(docs).join(ids, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    return sample, stands_for


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, balanced: bool = False, rows: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression, by Newton steps; `x` is (rows, features), and each row counts
    as `rows` of its kind (1 by default)."""
    n, k = x.shape
    rows = np.ones(n) if rows is None else rows
    centre = np.average(x, axis=0, weights=rows)
    scale = np.maximum(np.sqrt(np.average((x - centre) ** 2, axis=0, weights=rows)), 1e-9)
    mean = np.average(y, weights=rows)
    z = np.column_stack([(x - centre) / scale, np.ones(n)])
    share = rows * np.where(y == 1, 0.5 / max(mean, 1e-9), 0.5 / max(1 - mean, 1e-9)) if balanced else rows
    w, penalty = np.zeros(k + 1), np.append(np.full(k, ridge), 1e-6)
    for _ in range(50):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (share * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    slope = w[:k] / scale
    return slope, float(w[k] - slope @ centre)


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear support vector machine with squared hinge loss and balanced classes."""
    n, k = x.shape
    z, sign = np.column_stack([x, np.ones(n)]), np.where(y == 1, 1.0, -1.0)
    weight = cost * np.where(y == 1, n / (2 * max((y == 1).sum(), 1)), n / (2 * max((y != 1).sum(), 1)))
    w, ridge = np.zeros(k + 1), np.append(np.ones(k), 1e-6)
    for _ in range(60):
        inside = sign * (z @ w) < 1
        a = z[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ z[inside] + np.diag(ridge), a.T @ sign[inside])
        if np.abs(new - w).max() < 1e-8:
            break
        w = w + 0.7 * (new - w) if _ > 20 else new
    return w[:k], float(w[k])

"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(parts: int, key: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string")) % parts


def sample(
    docs: DataFrame, labels: DataFrame, column: str, usable: Column, per_class: int,
    classes: tuple | None = (0, 1), most_bytes: int | None = None, seed: int | None = None,
) -> list[tuple[str, object]]:
    """(text, label) of at most ``per_class`` usable labelled documents per class, of every
    class there is if ``classes`` is None.

    Which ones is decided by a hash of the id, so it does not depend on file order; samples of
    different ``seed`` are independent. With ``most_bytes`` a class takes whole texts in that
    order while their sum stays within it; longer ones are passed over. A document labelled twice takes the larger label, an id that
    repeats its largest text.
    """
    marked = (
        labels.filter(usable & F.col(column).isNotNull())
        .groupBy("doc_id").agg(F.max(column).alias("_label"))
    )
    if most_bytes is None:
        marked = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    else:
        sizes = docs.groupBy("doc_id").agg(
            F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("_bytes"))
        marked = marked.join(sizes, "doc_id").filter(F.col("_bytes") <= most_bytes)
    drawn = F.xxhash64("doc_id") if seed is None else F.xxhash64("doc_id", F.lit(seed))
    order = [drawn, F.col("doc_id")]
    chosen = None
    if classes is None:  # one plan for any number of them; each task passes on per_class rows
        place = F.row_number().over(Window.partitionBy("_label").orderBy(*order))
        chosen = marked.withColumn("_place", place).filter(F.col("_place") <= per_class)
        chosen = chosen.select("doc_id", "_label")
    for label in classes or ():
        part = marked.filter(F.col("_label") == label).orderBy(*order).limit(per_class)
        if most_bytes is not None:  # over per_class rows at most
            until = F.sum("_bytes").over(Window.partitionBy("_label").orderBy(*order))
            part = part.withColumn("_until", until).filter(F.col("_until") <= most_bytes)
            part = part.select("doc_id", "_label")
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "_label").agg(F.max(F.coalesce("text", F.lit(""))).alias("_text"))
        .orderBy(*order)
        .select("_text", "_label").collect()
    )
    return [(row[0], row[1]) for row in rows]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(values: np.ndarray, truth: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over ``values``, both classes weighing the same.

    Without both classes the curve is flat at a half.
    """
    if not 0 < truth.sum() < len(truth):
        return 0.0, 0.0
    weight = np.where(truth == 1, 0.5 / truth.mean(), 0.5 / (1 - truth.mean())) / len(truth)
    center, scale = values.mean(), values.std() or 1.0
    x = np.stack([(values - center) / scale, np.ones(len(values))], axis=1)
    theta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ theta)
        ridge = np.diag([1e-3, 0.0])
        slope = x.T @ (weight * (p - truth)) + ridge @ theta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        theta -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return theta[0] / scale, theta[1] - theta[0] * center / scale

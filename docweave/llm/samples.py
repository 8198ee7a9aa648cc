"""Bounded samples of labelled rows, and a logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_ids(rows: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` ids of each label value, those whose hash is least.

    Counting first keeps what is ordered near ``most`` rows a label at any size of the table.
    """
    rows = rows.withColumn("__order", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)))
    counts = rows.groupBy(label).agg(F.count("*").alias("__rows"))
    enough = F.least(F.lit(1.0), (F.lit(1.25 * most) + 100) / F.col("__rows")) * (1 << 30)
    few = rows.join(F.broadcast(counts), label).where(F.col("__order") <= enough)  # counts: a row for each label value
    order = Window.partitionBy(label).orderBy("__order", "doc_id")
    return few.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most).drop("__order", "__n", "__rows")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, longest: int, train=None) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(text, label) of ``most`` labelled documents for each label, all where there are fewer.

    Drawn from the ids that have a text of at most ``longest`` characters, which bounds what the
    driver holds; of several such texts of one id the least counts.  With them the number of all
    labelled ids of each label, whatever the sample.  Label rows that contradict each other for
    one id count once, by their greatest value, so as label 1; null labels don't count.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    if train is not None:
        known = known.where(train)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {0: 0, 1: 0} | {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    short = docs.select("doc_id", "text").where(F.length("text") <= longest)
    ids = sample_ids(known.join(short.select("doc_id"), "doc_id", "left_semi"), "y", most)
    # at most 2 * most ids, so they may be broadcast
    rows = short.join(F.broadcast(ids), "doc_id").withColumn("__n", F.xxhash64("doc_id", F.lit(11)))
    best = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.min("text").alias("text"), F.first("__n").alias("n"))
    return [(r[0], r[1]) for r in best.orderBy("n", "doc_id").select("text", "y").collect()], counts


def share_of(counts: dict[int, int]) -> float:
    """Label 1's share of all labelled ids, smoothed; a half where there are none."""
    return (counts[1] + 1) / (counts[0] + counts[1] + 2)


def logistic_fit(x: np.ndarray, y: np.ndarray, shares: dict[int, int]) -> tuple[float, float]:
    """Slope and shift of P(1 | x), each class weighted to its share of ``shares``; a Newton iteration with a small ridge."""
    # weights are one on average, so that the ridge counts alike at any number of labels
    scale = len(y) / max(1, shares[0] + shares[1])
    weight = scale * np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum()))
    scale = max(float(np.std(x)), 1e-9)
    z = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + 1e-2 * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])

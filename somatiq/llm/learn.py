"""What the two classifiers share: a bounded sample of labels, and areas under curves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_sample(labels: DataFrame, column: str, usable: Column, most: int) -> DataFrame:
    """At most ``most`` labelled documents (label_id, label), those with the smallest hashed ids.

    Null ids and labels are left out; a document that is labelled twice has the greater label.
    The bound makes the result safe to broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(column).cast("int").alias("label")).where("label_id is not null and label is not null")
    return known.where(usable).groupBy("label_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("label_id"), "label_id").limit(most)


def auc(label: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve, ties at half."""
    order = np.argsort(score, kind="stable")
    _, first, counts = np.unique(score[order], return_index=True, return_counts=True)
    rank = np.repeat(first + (counts + 1) / 2, counts)
    pos = label[order] == 1
    n, m = pos.sum(), (~pos).sum()
    return float((rank[pos].sum() - n * (n + 1) / 2) / (n * m)) if n and m else float("nan")

"""Connected components of link tables, by minimum labels and contraction.

Each round every node takes the smallest label among its own and its neighbours', then labels are
shortened by following them once, and links are rewritten to labels; links inside a component
vanish. Stars and cliques take one or two rounds, a chain a logarithmic number. Hot nodes cost no
gathered groups: labels are aggregated with map-side combine, and the joins may be split by Spark.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, durable


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node in links(a, b); ids are longs.

    Labels settle in a logarithmic number of rounds; more than ``rounds`` of them raise, and no
    link is ever left out.
    """
    links = durable(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc-links")
    label: DataFrame | None = None
    for _ in range(rounds):
        if links.isEmpty():
            break
        both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("to")))
        # Written before it meets itself, so that the join shuffles both sides and may split a hot label.
        least = durable(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")), "cc-least")
        # Follow the labels twice: a -> b -> c becomes a -> c.
        step = least
        for _ in range(2):
            far = step.select(F.col("node").alias("via"), F.col("to").alias("far"))
            step = step.join(far, F.col("to") == F.col("via"), "left").select("node", F.coalesce("far", "to").alias("to"))
        step = durable(step, "cc-step")
        hop = step.select(F.col("node").alias("via"), F.col("to").alias("far"))
        before = links, label
        if label is None:
            label = step.select("node", F.col("to").alias("component"))
        else:
            label = label.join(hop, F.col("component") == F.col("via"), "left").select("node", F.coalesce("far", "component").alias("component"))
        label = durable(label, "cc-label")
        left = links.join(hop, F.col("a") == F.col("via")).select(F.col("far").alias("a"), "b")
        links = durable(left.join(hop, F.col("b") == F.col("via")).select("a", F.col("far").alias("b")).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-links")
        discard(least, step, *before)
    else:
        raise RuntimeError("components did not settle")
    return label if label is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest connected vertex of each vertex."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new

"""Recordings of any length in blocks of rows that carry what their neighbours reach into them.

A recording is no longer the smallest unit of work: rows get their place in the recording from
counts of short stretches of time (a row for each stretch is all that is summed per recording), and
a block is a range of places. Rows near an edge are copied to the neighbour whose operator reaches
them (a halo), and interpolation gets the nearest known samples on either side, however far away
they are, from a summary of each block. Results are those over the whole recording.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import micros
from .byfile import by_file

#: Seconds of the stretches in which rows are counted.
STRETCH = 600.0
#: Rows of a block where the caller names none.
ROWS = 1 << 20


def with_positions(signals: DataFrame, stretch_seconds: float = STRETCH) -> DataFrame:
    """Adds position (from 0, by time) and total (rows of the recording), ordering no more than a stretch at once."""
    at = signals.withColumn("__s", F.floor(micros("ts") / F.lit(int(stretch_seconds * 1e6))).cast("long"))
    counts = at.groupBy("file_id", "__s").agg(F.count(F.lit(1)).alias("__c"))
    file = Window.partitionBy("file_id")
    before = F.coalesce(F.sum("__c").over(file.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    told = counts.select(F.col("file_id").alias("__f"), F.col("__s").alias("__t"), before.alias("__before"), F.sum("__c").over(file).alias("total"))
    joined = at.join(told, F.col("file_id").eqNullSafe(F.col("__f")) & (F.col("__s") == F.col("__t")))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("file_id", "__s").orderBy("ts")) - 1
    return joined.withColumn("position", place.cast("long")).drop("__s", "__c", "__f", "__t", "__before")


def in_blocks(placed: DataFrame, rows: int, before: int = 0, after: int = 0) -> DataFrame:
    """Adds block and core: a copy of each row for its own block (core) and for those that reach it.

    A block has ``rows`` places of its own, ``before`` more ahead of them and ``after`` more behind.
    """
    first = F.greatest(F.floor((F.col("position") - after) / rows), F.lit(0)).cast("long")
    last = F.least(F.floor((F.col("position") + before) / rows), F.floor((F.col("total") - 1) / rows)).cast("long")
    spread = placed.withColumn("block", F.explode(F.sequence(first, last)))
    return spread.withColumn("core", F.floor(F.col("position") / rows) == F.col("block"))


_SIDES = [f"{side}_{what}{k}" for side in ("before", "after") for what in "px" for k in (1, 2)]


def with_neighbours(blocked: DataFrame, column: str) -> DataFrame:
    """Adds to each row the places and values of the two nearest known samples before and after its block.

    ``blocked`` has no halo. The nearest is number 1; what does not exist is NULL.
    """

    def ends(c: dict[str, np.ndarray]) -> dict:
        known = np.flatnonzero(~np.isnan(c["x"]))
        told = {"n": len(known)}
        for name, at in (("after", known[:2]), ("before", known[::-1][:2])):
            for k in (1, 2):
                told |= {f"{name}_p{k}": float(c["position"][at[k - 1]]) if len(at) >= k else None, f"{name}_x{k}": float(c["x"][at[k - 1]]) if len(at) >= k else None}
        return told

    def carry(c: dict[str, np.ndarray]) -> dict:
        n = len(c["block"])
        out = {name: np.full(n, np.nan) for name in _SIDES}
        for side, order in (("before", range(n)), ("after", range(n - 1, -1, -1))):
            near: list[tuple[float, float]] = []
            for i in order:
                for k, (p, x) in enumerate(near, 1):
                    out[f"{side}_p{k}"][i], out[f"{side}_x{k}"][i] = p, x
                own = [(c[f"{side}_p{k}"][i], c[f"{side}_x{k}"][i]) for k in (1, 2)]
                near = ([o for o in own if not np.isnan(o[0])] + near)[:2]
        return {"block": c["block"]} | out

    kind = blocked.schema["file_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} double" for c in _SIDES)
    told = blocked.select("file_id", "block", "position", F.col(column).cast("double").alias("x"))
    summary = by_file(told, ends, f"file_id {kind}, block long, n long, {numbers}", "position", ("file_id", "block"))
    carried = by_file(summary, carry, f"file_id {kind}, block long, {numbers}", "block")
    carried = carried.select(F.col("file_id").alias("__f"), F.col("block").alias("__b"), *_SIDES)
    return blocked.join(carried, F.col("file_id").eqNullSafe(F.col("__f")) & (F.col("block") == F.col("__b"))).drop("__f", "__b")


def known_points(c: dict[str, np.ndarray], column: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the known samples of a block with its neighbours', in order."""
    own = ~np.isnan(c[column])
    sides = {s: [(c[f"{s}_p{k}"][0], c[f"{s}_x{k}"][0]) for k in (1, 2) if not np.isnan(c[f"{s}_p{k}"][0])] for s in ("before", "after")}
    points = [*sides["before"][::-1], *zip(c["position"][own].astype(float), c[column][own], strict=True), *sides["after"]]
    return np.array([p for p, _ in points]), np.array([x for _, x in points])

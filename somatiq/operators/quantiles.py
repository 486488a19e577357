"""Exact quantiles of groups of any size, without a buffer of all values of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups up to this size are sorted by value as they are; larger ones are narrowed first, to about six parts in so many.
ACCURACY = 10_000


def exact_quantiles(rows: DataFrame, keys: list[str], column: str, shares: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """keys, n long, quantiles array<double> (one for each share): interpolated as Spark's ``percentile`` does.

    Missing and NaN values do not count; groups without values give no row; null keys are a group.
    Bounds around each quantile come from mergeable digests of bounded size, then rows below and
    up to them are counted, and only the values between them are counted one by one and ranked. A
    bound that does not hold the quantile is replaced by the whole range, so results are exact
    whatever the digest says. Every step combines in the map tasks: a group with most of the rows
    is spread over all of them.
    """
    if not keys:
        raise ValueError("name the columns that tell groups apart")
    if not shares or not all(0 <= p <= 1 for p in shares):
        raise ValueError("shares lie between 0 and 1")
    k = [f"__k{i}" for i in range(len(keys))]
    x = rows.select(*[F.col(c).alias(a) for c, a in zip(keys, k, strict=True)], (F.col(column).cast("double") + F.lit(0.0)).alias("__x")).where("__x is not null and not isnan(__x)")
    which = range(len(shares))
    bounds = _bounds(x, k, shares, accuracy)
    joined = _with_group(x, bounds, k)
    counted = joined.groupBy(*k).agg(
        F.first("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"),
        F.array(*[F.count_if(F.col("__x") < F.col("lo")[j]) for j in which]).alias("below"), F.array(*[F.count_if(F.col("__x") <= F.col("hi")[j]) for j in which]).alias("upto"),
    )
    place = [(F.col("n") - 1) * F.lit(float(p)) for p in shares]
    # A bound holds if no more rows than the lower rank are below it, and the upper rank is not above it.
    holds = [(F.col("n") > accuracy) & (F.col("below")[j] <= F.floor(place[j])) & (F.col("upto")[j] > F.ceil(place[j])) for j in which]
    infinite = F.lit(float("inf"))
    narrowed = counted.select(
        *k, "n", F.array(*[F.when(holds[j], F.col("lo")[j]).otherwise(-infinite) for j in which]).alias("lo"), F.array(*[F.when(holds[j], F.col("hi")[j]).otherwise(infinite) for j in which]).alias("hi"),
        F.array(*[F.when(holds[j], F.col("below")[j]).otherwise(F.lit(0)) for j in which]).alias("below"),
    )
    within = F.array_compact(F.array(*[F.when(F.col("__x").between(F.col("lo")[j], F.col("hi")[j]), F.lit(j)) for j in which]))
    near = _with_group(x, narrowed, k).withColumn("__j", F.explode(within))
    values = near.groupBy(*k, "__j", "__x").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first(F.col("below")[F.col("__j")]).alias("b"))
    ranked = values.withColumn("upto", F.col("b") + F.sum("c").over(Window.partitionBy(*k, "__j").orderBy("__x")))
    at = F.array(*map(F.lit, map(float, shares)))[F.col("__j")] * (F.col("n") - 1)
    found = ranked.groupBy(*k, "__j", "n").agg(F.min(F.when(F.col("upto") > F.floor(at), F.col("__x"))).alias("a"), F.min(F.when(F.col("upto") > F.ceil(at), F.col("__x"))).alias("z"))
    value = F.when(F.col("a") == F.col("z"), F.col("a")).otherwise((F.ceil(at) - at) * F.col("a") + (at - F.floor(at)) * F.col("z"))
    told = found.groupBy(*k, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("__j", value.alias("v")))), lambda e: e["v"]).alias("quantiles"))
    return told.select(*[F.col(a).alias(c) for a, c in zip(k, keys, strict=True)], "n", "quantiles")


def _bounds(x: DataFrame, k: list[str], shares: list[float], accuracy: int) -> DataFrame:
    """keys, n, lo, hi: digests' quantiles two errors below and above each share."""
    away = 2.0 / accuracy
    digest = lambda move: F.percentile_approx("__x", [min(1.0, max(0.0, p + move)) for p in shares], accuracy)
    return x.groupBy(*k).agg(F.count(F.lit(1)).alias("n"), digest(-away).alias("lo"), digest(away).alias("hi"))


def _with_group(x: DataFrame, groups: DataFrame, k: list[str]) -> DataFrame:
    """Rows with what is known of their group; null keys meet."""
    same: list[Column] = [F.col(c).eqNullSafe(F.col(f"{c}__g")) for c in k]
    return x.join(groups.withColumnsRenamed({c: f"{c}__g" for c in k}), same).drop(*[f"{c}__g" for c in k])

"""Selected quantiles are those of Spark's ``percentile``, on small and large groups, ties and missing values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from somatiq.operators import quantiles, signal
from somatiq.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.05, 0.25, 0.5, 0.731, 0.95, 1.0]


def told(rows, accuracy):
    return {r.g: (r.n, list(r.quantiles)) for r in exact_quantiles(rows, ["g"], "x", SHARES, accuracy).collect()}


def plain(rows):
    kept = rows.where("x is not null and not isnan(x)")
    return {r.g: (r.n, r.q) for r in kept.groupBy("g").agg(F.count("x").alias("n"), F.percentile("x", F.array(*map(F.lit, SHARES))).alias("q")).collect()}


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group; ties, a constant group, one of two values, nulls, NaN, extremes, a null key."""
    n = F.col("id")
    g = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("g"), n % 7)).when(n % 11 == 0, None).otherwise("tied")
    x = F.when(g == "tied", n % 5).when(g == "g3", 7).when(n % 101 == 0, None).when(n % 103 == 0, float("nan")).when(n % 997 == 1, 1e300).otherwise(F.randn(4) * F.pow(F.lit(10.0), n % 9))
    made = spark.range(0, 30_000, 1, 6).select(g.alias("g"), x.cast("double").alias("x"), F.lit(1).alias("n"), F.lit("extra").alias("lo"))
    few = spark.createDataFrame([("one", 3.5, 1, ""), ("two", 1.0, 1, ""), ("two", 2.0, 1, ""), ("none", None, 1, ""), ("zeros", -0.0, 1, ""), ("zeros", 0.0, 1, "")], "g string, x double, n int, lo string")
    return made.unionByName(few)


@pytest.mark.parametrize("accuracy", [100, 1000, 10_000])
def test_same_as_percentile(rows, accuracy):
    got, want = told(rows, accuracy), plain(rows)
    assert got.keys() == want.keys() and None in got and "none" not in got
    for g, (n, q) in want.items():
        assert got[g][0] == n and got[g][1] == pytest.approx(q, rel=1e-12, abs=1e-300)


def test_wrong_bounds_are_replaced(rows, monkeypatch):
    far = lambda x, k, shares, accuracy: x.groupBy(*k).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.lit(1e9)] * len(shares)).alias("lo"), F.array(*[F.lit(1e9)] * len(shares)).alias("hi"))
    monkeypatch.setattr(quantiles, "_bounds", far)
    got, want = told(rows, 10), plain(rows)
    assert got.keys() == want.keys()
    for g, (n, q) in want.items():
        assert got[g][0] == n and got[g][1] == pytest.approx(q, rel=1e-12, abs=1e-300)


def test_only_values_near_the_quantiles_are_counted_one_by_one(spark):
    """Bounds of a large group hold a small part of it."""
    x = spark.range(0, 200_000, 1, 4).select(F.lit(1).alias("k"), F.randn(3).alias("__x"))
    lo, hi = x.transform(lambda d: quantiles._bounds(d, ["k"], [0.5], 1000)).select(F.col("lo")[0], F.col("hi")[0]).first()
    assert 0 < x.where(F.col("__x").between(lo, hi)).count() < 200_000 * 8 / 1000


def test_empty_table_and_wrong_calls(spark, rows):
    assert exact_quantiles(rows.where("false"), ["g"], "x", [0.5]).count() == 0
    for keys, shares in (([], [0.5]), (["g"], []), (["g"], [1.5])):
        with pytest.raises(ValueError):
            exact_quantiles(rows, keys, "x", shares)


@pytest.mark.parametrize("method", ["robust", "range90"])
def test_scaling_by_selection(spark, method):
    s = spark.range(5_000).select((F.col("id") % 3).alias("file_id"), F.col("id").alias("ts"), F.when(F.col("id") % 50 == 0, None).otherwise(F.randn(2) * (1 + F.col("id") % 3)).alias("y"))
    want = s.withColumn("want", signal.scaled("y", method)).select("file_id", "ts", "want")
    got = signal.scale_selected(s, "y", method).join(want, ["file_id", "ts"]).toPandas()
    assert len(got) == 5_000 and np.allclose(got.y_scaled, got.want, equal_nan=True)
    with pytest.raises(ValueError, match="no quantiles"):
        signal.scale_selected(s, "y", "minmax")

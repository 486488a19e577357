"""Sequences meet samples in time buckets measured from their lengths, with the rows of the plain join."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from somatiq.operators import hrv
from somatiq.operators.intervals import BUCKETS, _in_buckets, slice_join

from .oracle import assert_same

T0 = dt.datetime(2021, 3, 1)
SEQUENCES = "file_id long, id string, begin timestamp_ntz, end timestamp_ntz"
SAMPLES = "file_id long, ts timestamp_ntz, nn double"


def at(us):
    return T0 + dt.timedelta(microseconds=int(us))


def both(spark, q, s, how):
    told = [slice_join(q, s, how, buckets=b).withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("begin", "end", "ts")}).toPandas() for b in ("file", "measured")]
    assert_same(*told)
    return told[1]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_edges_ties_and_odd_rows(spark, how):
    q = [(1, "point", at(5), at(5)), (1, "short", at(3), at(9)), (1, "short", at(3), at(9)), (1, "long", at(0), at(10**9)), (1, "reversed", at(9), at(3)), (1, "open", at(3), None), (1, "headless", None, at(3)),
         (1, None, at(5), at(6)), (2, "empty", at(0), at(100)), (None, "no file", at(0), at(9)), (1, "old", dt.datetime(1960, 1, 1), dt.datetime(1960, 1, 2))]
    s = [(1, at(5), 1.0), (1, at(5), 1.0), (1, at(9), None), (1, at(10), 2.0), (1, at(10**9), 3.0), (1, None, 4.0), (3, at(5), 5.0), (None, at(5), 6.0), (1, dt.datetime(1960, 1, 1, 12), 7.0)]
    got = both(spark, spark.createDataFrame(q, SEQUENCES), spark.createDataFrame(s, SAMPLES), how)
    assert (got.reference == "point").sum() == 2 and (got.reference == "short").sum() == 6 and (got.reference == "long").sum() == 5 and (got.reference == "old").sum() == 1
    assert (got.reference == "reversed").sum() == (how == "left")


def test_empty_tables(spark):
    q, s = spark.createDataFrame([(1, "a", at(0), at(9))], SEQUENCES), spark.createDataFrame([(1, at(5), 1.0)], SAMPLES)
    assert both(spark, q.where("false"), s, "left").empty and both(spark, q, s.where("false"), "inner").empty
    assert len(both(spark, q, s.where("false"), "left")) == 1


def test_unknown_way_raises(spark):
    q, s = spark.createDataFrame([], SEQUENCES), spark.createDataFrame([], SAMPLES)
    with pytest.raises(ValueError, match="no such way"):
        slice_join(q, s, buckets="nearest")


def test_long_recording_with_many_sequences(spark):
    """One file: pairs that are compared follow the result, and no bucket holds much of the recording."""
    n, k = 100_000, 3_000
    rng = np.random.default_rng(5)
    begin = rng.integers(0, n * 1000, k)
    end = begin + np.round(10 ** rng.uniform(3, 5.5, k)).astype(int)
    q = spark.createDataFrame(pd.DataFrame({"file_id": 1, "id": [f"s{i}" for i in range(k)], "b": begin, "e": end})).select("file_id", "id", *[F.timestamp_micros(c).cast("timestamp_ntz").alias(d) for c, d in (("b", "begin"), ("e", "end"))])
    s = spark.range(n).select(F.lit(1).cast("long").alias("file_id"), F.timestamp_micros(F.col("id") * 1000).cast("timestamp_ntz").alias("ts"))
    got = slice_join(q, s, "inner", buckets="measured").groupBy("reference").count().toPandas().set_index("reference")["count"]
    stamps = np.arange(n) * 1000
    want = np.searchsorted(stamps, end, "right") - np.searchsorted(stamps, begin)
    assert [got.get(f"s{i}", 0) for i in range(k)] == want.tolist()


def test_sequences_go_to_few_buckets(spark):
    """Rows that are shuffled for a sequence, of whatever length and place: five at most."""
    lengths = [n + d for k in range(22) for n in (4**k, 2 * 4**k) for d in (-1, 0, 1)]
    q = spark.createDataFrame([(1, f"s{i}", at(b), at(b + n)) for i, n in enumerate(lengths) for b in (0, 12_345_678_901)], SEQUENCES)
    met = _in_buckets(q.select("file_id", F.col("id").alias("reference"), "begin", "end"))[1]
    rows = met.groupBy("reference", "begin").count().toPandas()["count"]
    assert len(rows) == 2 * len(lengths) and rows.max() <= 5


def test_plan_joins_on_bucket_and_level(spark):
    q, s = spark.createDataFrame([(1, "a", at(0), at(9))], SEQUENCES), spark.createDataFrame([(1, at(5), 1.0)], SAMPLES)
    plan = slice_join(q, s, "inner", buckets="measured")._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "__b" in join and "__level" in join and "Cartesian" not in plan


def test_setting_of_the_session_reaches_features(spark):
    q = spark.createDataFrame([(1, "a", at(0), at(4_000_000)), (1, "b", at(9_000_000), at(9_500_000))], SEQUENCES)
    nn = spark.createDataFrame([(1, at(i * 700_000), 700.0 + 13 * (i % 5)) for i in range(12)], SAMPLES).withColumn("bad", F.lit(False))
    plain = hrv.time_features(nn, q).toPandas()
    spark.conf.set(BUCKETS, "measured")
    try:
        bucketed = hrv.time_features(nn, q)
        assert "shiftright" in bucketed._jdf.queryExecution().optimizedPlan().toString()
        assert_same(plain, bucketed.toPandas())
    finally:
        spark.conf.unset(BUCKETS)

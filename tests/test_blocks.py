"""Recordings in blocks give what whole recordings give."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from somatiq.operators import blocks, signal

T0 = datetime.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def recordings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("long", 400), ("short", 7), ("one", 1), ("blank", 40), (None, 50), ("two", 60)):
        x = rng.normal(size=n).cumsum()
        x[rng.random(n) < 0.2] = np.nan
        if name == "long":
            x[100:190] = np.nan  # a gap over several blocks
            x[:5], x[-30:] = np.nan, np.nan
        if name == "blank":
            x[:] = np.nan
        if name == "two":
            x[:] = np.nan
            x[[7, 41]] = 1.0, 2.0
        # Uneven steps, and one long pause.
        t = np.cumsum(rng.integers(1, 3, n)) + (np.arange(n) > n // 2) * 5000
        rows += [(name, T0 + datetime.timedelta(seconds=int(s)), None if np.isnan(v) else float(v)) for s, v in zip(t, x, strict=True)]
    rng.shuffle(rows)
    return spark.createDataFrame([tuple(r) for r in rows], "file_id string, ts timestamp_ntz, x double")


def told(df, column):
    return {(r.file_id, r.ts): r[column] for r in df.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, abs=1e-9)), k


@pytest.mark.parametrize("rows", [5, 16, 97, 10_000])
def test_blocks_are_whole_recordings(recordings, rows):
    how = {"fir": lambda b: signal.fir_filter(recordings, "x", 1.0, 10, [0.2], out="y", block_rows=b), "gaps": lambda b: signal.fill_gaps(recordings, "x", "y", b)}
    how |= {"sum": lambda b: signal.slope_sum(recordings, "x", 4, "y", b), "linear": lambda b: signal.resample(recordings, "x", 0.7, "linear", "y", b), "hold": lambda b: signal.resample(recordings, "x", 0.7, "zero", "y", b)}
    for f in how.values():
        assert_same(told(f(rows), "y"), told(f(None), "y"))


def test_positions_and_halos(recordings):
    placed = blocks.with_positions(recordings, 30)
    for name in ("long", None):
        got = [r.position for r in placed.where(F.col("file_id").eqNullSafe(F.lit(name))).orderBy("ts").collect()]
        assert got == list(range(len(got)))
    halo = blocks.in_blocks(placed.where("file_id = 'long'"), 50, 3, 2).groupBy("block").agg(F.min("position").alias("a"), F.max("position").alias("b"), F.count_if("core").alias("n")).orderBy("block").collect()
    assert [(r.a, r.b, r.n) for r in halo] == [(max(0, 50 * k - 3), min(399, 50 * k + 51), 50) for k in range(8)]


def test_no_task_orders_more_than_a_block(recordings):
    """Each group that a kernel or window of the filter gets is a block with its halo, or a row for each block."""
    halo = blocks.in_blocks(blocks.with_positions(recordings), 50, 11, 11)
    assert halo.groupBy("file_id", "block").count().agg(F.max("count")).first()[0] <= 50 + 22

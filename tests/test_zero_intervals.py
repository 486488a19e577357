"""Interval queries on tables with intervals of zero and changes right at the bounds, against their SQL."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

from somatiq.plans.inputs import r6, rounded

from .oracle import assert_same, connect

NAMES = ["nn_intervals_reject", "nn_rejection_summary", "nn_interpolation", "hrv_geometric_features", "hrv_time_features", "features_long", "features_wide"]


@pytest.fixture(scope="module")
def zeros(tmp_path_factory):
    """Events of 12 users: each 9th value zero, two zeros in a row now and then, and ratios of 3/4, 5/4, 1/4 and 7/4."""
    folder = tmp_path_factory.mktemp("zeros")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 4099) SECOND AS ts, i % 12 AS user_id, ['view', 'click', 'error', 'purchase', 'signup'][i // 12 % 5 + 1] AS event_type,
        CASE WHEN i // 12 % 9 = 4 OR i // 12 % 45 = 5 THEN 0.0 ELSE round((4 + i % 12 * 13 + i // 48) * [4, 3, 4, 5, 4, 1, 4, 7][i // 12 % 8 + 1] * 0.16, 2) END::DOUBLE AS value, '{{"k": ' || i % 97 || '}}' AS props FROM range(1200) r(i)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_zero_intervals(spark, zeros, name):
    assert_same(queries()[name](spark, zeros).toPandas(), connect(zeros).sql(oracle_sql()[name]).df())


def test_rounding_as_sql_does(spark):
    """Decimals halfway between two results are doubles beside the middle: both engines take the same side."""
    ties = "SELECT i AS id, (2 * i + 1) / 2e6 AS x, (i - 5000) / 7 AS y FROM (SELECT unnest(range(0, 40000000, 3989)) AS i)"
    want = duckdb.sql(f"SELECT id, round(x, 6) AS x, round(-x, 6) AS n, round(y, 4) AS y FROM ({ties})").df()
    got = r6(spark.createDataFrame(duckdb.sql(f"SELECT id, x, -x AS n, y FROM ({ties})").df()), "x", "n").withColumn("y", rounded("y", 4))
    assert_same(got.toPandas(), want)

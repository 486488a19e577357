"""Interval queries on changes whose logarithms differ from a bound in their last digit only, against their SQL."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

from .oracle import assert_same, connect

NAMES = ["nn_intervals_reject", "nn_rejection_summary", "hrv_geometric_features", "hrv_time_features", "features_long", "features_wide", "nn_interpolation"]
#: Changes of 1/4, 7/4, 3/4 and 5/4 that Java's logarithm decides otherwise than SQL's.
PAIRS = [(339.48, 84.87), (383.88, 95.97), (54.84, 95.97), (127.96, 95.97), (169.56, 127.17), (339.48, 254.61), (452.64, 339.48), (339.48, 424.35)]


@pytest.fixture(scope="module")
def bounds(tmp_path_factory):
    """Events of one user for each pair: the pair and two values near its second."""
    folder = tmp_path_factory.mktemp("bounds")
    rows = [(u, i, v) for u, (a, b) in enumerate(PAIRS) for i, v in enumerate((a, b, round(b * 1.1, 2), round(b * 0.9, 2)))]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"""COPY (SELECT (4 * u + i)::BIGINT AS event_id, TIMESTAMP '2024-01-01 01:00:00' + INTERVAL (i * 7200) SECOND AS ts, u::BIGINT AS user_id, ['view', 'click', 'error', 'purchase'][i + 1] AS event_type, v::DOUBLE AS value, '{{"k": 1}}' AS props
        FROM (VALUES {", ".join(map(str, rows))}) AS r(u, i, v)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_changes_at_bounds(spark, bounds, name):
    assert_same(queries()[name](spark, bounds).toPandas(), connect(bounds).sql(oracle_sql()[name]).df())

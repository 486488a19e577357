"""Interpolation of intervals of which some are unknown, against its SQL."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

from .oracle import assert_same, connect

#: Values of a user each, an hour and a half apart: unknown ones (None) first, last, next to each other, and between runs of one, two and more.
VALUES = [
    [None, 50, 55, 48, 60, None],
    [50, 55, None, 48, 60, 52, 57, None, None, 61, None, 44, 47, 43],
    [50, 55, 53, None, 48, 60],
    [None, None, 50],
    [50, None],
    [50, 60],
    [None, None],
    [50, 55, 52, 58, 51],
]


@pytest.fixture(scope="module")
def unknown(tmp_path_factory):
    folder = tmp_path_factory.mktemp("unknown")
    rows = [(u, i, v) for u, values in enumerate(VALUES) for i, v in enumerate(values)]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"""COPY (SELECT (100 * u + i)::BIGINT AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 5400) SECOND AS ts, u::BIGINT AS user_id, 'view' AS event_type, v::DOUBLE AS value, '{{"k": 1}}' AS props
        FROM (VALUES {", ".join(f"({u}, {i}, {'NULL' if v is None else v})" for u, i, v in rows)}) AS r(u, i, v)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


def test_unknown_intervals(spark, unknown):
    assert_same(queries()["nn_interpolation"](spark, unknown).toPandas(), connect(unknown).sql(oracle_sql()["nn_interpolation"]).df())

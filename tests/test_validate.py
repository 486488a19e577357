import datetime
import itertools

import pytest

from somatiq import model
from somatiq.operators import validate

T0 = datetime.datetime(2020, 1, 1)
ROWS = [("protocol", 0, 90), ("baseline_1", 10, 20), ("annotation_1", 11, None), ("task_1", 20, 30), ("artifact_1", 21, None), ("artifact_2", 25, None), ("task_2", 30, 30), ("baseline_2", 60, 90), ("order_test_1", 90, 91), ("order_test_2", 90, None)]


def at(s):
    return None if s is None else T0 + datetime.timedelta(seconds=s)


def events(spark, rows, data='{"a": 1}'):
    return spark.createDataFrame([("f", i, i, at(b), at(e), data, n) for n, (i, b, e) in enumerate(rows)], "file_id string, id string, name string, begin timestamp_ntz, end timestamp_ntz, data string, row int")


def faults(df, **kw):
    return {r["check"]: r["violations"] for r in validate.event_violations(df, **kw).collect() if r["violations"]}


def test_valid_events(spark):
    assert faults(events(spark, ROWS), row="row") == {}


def test_row_order(spark):
    bad = 0
    for p in itertools.islice(itertools.permutations(ROWS[:4]), 1, 6):
        bad += "ROW_ORDER" in faults(events(spark, p), row="row")
    assert bad == 5


@pytest.mark.parametrize("column", ["id", "name", "begin", "end", "data"])
def test_missing_column(spark, column):
    with pytest.raises(validate.SpecificationError, match="MISSING_COLUMN"):
        validate.event_violations(events(spark, ROWS).drop(column))


def test_contents(spark):
    assert faults(events(spark, ROWS, data="[1]")) == {"INCORRECT_CONTENTS": 10}
    assert faults(events(spark, [("a", 5, 4)])) == {"BEGIN_END_ORDER": 1}
    assert faults(events(spark, [("a", 1, 2), ("a", 3, 4)])) == {"REPEATED_ID": 1}
    with pytest.raises(validate.SpecificationError, match="INCORRECT_COLUMN_TYPE"):
        validate.event_violations(events(spark, ROWS).withColumn("id", validate.F.lit(1)))
    with pytest.raises(ValueError):
        validate.event_violations(events(spark, ROWS), version="2")


def signals(spark, jitter=0, column="PPG"):
    rows = [("f", T0 + datetime.timedelta(microseconds=round(k * 1e6 / 512) + (jitter * 7919 * k % 1_000_000 if jitter else 0)), float(k)) for k in range(512)]
    return spark.createDataFrame(rows, f"file_id string, ts timestamp_ntz, `{column}` double")


def test_signals(spark):
    one = lambda df: validate.signal_violations(df).first()["violations"]
    assert one(signals(spark)) == 0
    assert one(signals(spark, 1)) == 1
    assert one(signals(spark, column="Fp1")) == 0
    with pytest.raises(validate.SpecificationError, match="UNKNOWN_COLUMN_NAME"):
        one(signals(spark, column="what"))


def test_infer_groups_and_empty_tables(spark):
    feats = spark.createDataFrame([("f", "a", "r", 1.0)], model.FEATURES)
    got = validate.infer_groups({"/x/signals": signals(spark), "/x/events": events(spark, ROWS), "/x/features": feats, "/x/signals/annotations": feats})
    assert got == {"signals": ["/x/signals"], "events": ["/x/events"], "features": ["/x/features"]}
    for schema in (model.EVENTS, model.FEATURES, model.NN):
        assert model.empty(spark, schema).count() == 0
    assert faults(model.empty(spark, model.EVENTS)) == {}


def test_nan_becomes_null(spark):
    df = model.nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 3.0)], "a int, x double"))
    assert [r.x for r in df.orderBy("a").collect()] == [None, 3.0]


def test_electrode_names_are_those_of_the_system():
    names = model.eeg_channels()
    assert len(names) == 343
    assert {"Cz", "FT7h", "TPP8h", "AFp3", "POO10h", "OI1h", "Iz", "FFC1"} <= names
    assert not names & {"N9h", "TPP1h", "FFC9", "I10h", "FT1", "T1", "Fp3"}

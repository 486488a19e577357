"""Runs over inputs that change: only what changed is computed, and failures are tried again."""

import datetime
import threading
import time

import pytest
from pyspark.sql import functions as F

from somatiq.operators import signal
from somatiq.plans import changes, pipeline
from somatiq.plans.pipeline import Operator, run_all
from somatiq.sources.readers import read_key

T0 = datetime.datetime(2020, 1, 1)
SCHEMA = "file_id string, ts timestamp_ntz, x double"


def rows(spark, ids, value=1.0, n=3):
    return spark.createDataFrame([(i, T0 + datetime.timedelta(seconds=k), value + k) for i in ids for k in range(n)], SCHEMA)


def told(spark, root, key="out/x"):
    return {r.file_id: r.y for r in read_key(spark, root, key).groupBy("file_id").agg(F.sum("y").alias("y")).collect()}


def doubling(seen):
    def transform(x):
        seen.append(sorted(r.file_id or "" for r in x.select("file_id").distinct().collect()))
        return x.withColumn("y", F.col("x") * 2)

    return Operator("double", "out/x", transform, {"x": "raw/x"})


def test_only_what_changed_is_computed(spark, tmp_path):
    root, seen = str(tmp_path), []
    op = doubling(seen)
    rows(spark, ["001", "b", "c"]).write.parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SUCCESS", None) and op.run(spark, root) == ("SKIPPED", None)
    assert told(spark, root) == {"001": 12, "b": 12, "c": 12}
    # Appended: a new recording, and more of an old one.
    rows(spark, ["d"]).unionByName(rows(spark, ["c"], 10.0, 1)).write.mode("append").parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SUCCESS", None)
    assert seen == [["001", "b", "c"], ["c", "d"]]
    assert told(spark, root) == {"001": 12, "b": 12, "c": 32, "d": 12}
    # The same rows in other files and another order have not changed.
    kept = read_key(spark, root, "raw/x").orderBy(F.desc("ts")).collect()
    spark.createDataFrame(kept, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SKIPPED", None)
    # One recording goes, one is written anew.
    spark.createDataFrame([r for r in kept if r.file_id != "b"] + [("001", None, None)], SCHEMA).write.mode("overwrite").parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SUCCESS", None)
    assert seen[2:] == [["001"]] and told(spark, root) == {"001": 12, "c": 32, "d": 12}
    assert read_key(spark, root, "out/x").schema["file_id"].dataType.simpleString() == "string"
    # Other parameters, or force, compute everything.
    assert op.run(spark, root, forced=True)[0] == "SUCCESS" and seen[3:] == [["001", "c", "d"]]
    op.version = "2.0"
    assert op.run(spark, root)[0] == "SUCCESS" and seen[4:] == [["001", "c", "d"]]
    assert [p.name for p in (tmp_path / "state" / "double").iterdir() if p.is_dir()] == [op._last(spark, root).run]


def test_old_results_count_no_more(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path), []
    op = doubling(seen)
    rows(spark, ["a"]).write.parquet(f"{root}/raw/x")
    assert op.run(spark, root)[0] == "SUCCESS"
    monkeypatch.setattr(pipeline, "CACHE_DAYS", -1)
    assert op.run(spark, root)[0] == "SUCCESS" and seen == [["a"], ["a"]]


def test_a_failed_recording_is_tried_again(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, "abcdefgh").unionByName(rows(spark, ["bad"], -5.0)).write.parquet(f"{root}/raw/x")
    ran = spark.sparkContext.accumulator(0)

    def kernel(v):
        ran.add(1)
        if v[0] < 0:
            raise ValueError("negative")
        return v * 2

    op = Operator("double", "out/x", lambda x: signal.per_file(x, "x", kernel, "y"), {"x": "raw/x"})
    assert op.run(spark, root) == ("PARTIAL", "1 recordings failed")
    assert ran.value == 9 and len(told(spark, root)) == 8
    # Unchanged, it fails again, alone; mended, it gives its rows.
    assert op.run(spark, root) == ("FAILED", "1 recordings failed and no other gave a result: ValueError: negative")
    assert ran.value == 10 and len(told(spark, root)) == 8
    rows(spark, "abcdefgh").unionByName(rows(spark, ["bad"], 5.0)).write.mode("overwrite").parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SUCCESS", None)
    assert ran.value == 11 and told(spark, root)["bad"] == 36
    assert op.run(spark, root) == ("SKIPPED", None)


def test_a_fault_of_everything_ends_soon(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, [f"f{i}" for i in range(200)]).write.parquet(f"{root}/raw/x")

    def broken(v):
        raise ValueError("no good")

    op = Operator("kernel", "out/x", lambda x: signal.per_file(x, "x", broken, "y"), {"x": "raw/x"})
    status, problem = op.run(spark, root)
    assert status == "FAILED" and problem.startswith("200 recordings failed")
    stores = []

    def fails(x):
        stores.append(1)
        return x.withColumn("y", F.raise_error("not possible").cast("double"))

    status, problem = Operator("column", "out/y", fails, {"x": "raw/x"}).run(spark, root)
    assert status == "FAILED" and "not possible" in problem and len(stores) <= pipeline.MOST_TRIES + 1
    assert read_key(spark, root, "out/y") is None
    assert [r.status for r in spark.read.parquet(f"{root}/log").collect()] == ["FAILED", "FAILED"]


def test_failures_outside_kernels_are_sought(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, [f"f{i}" for i in range(40)]).write.parquet(f"{root}/raw/x")
    bad = F.col("file_id").isin("f3", "f31")
    op = Operator("column", "out/x", lambda x: x.withColumn("y", F.when(bad, F.raise_error("odd").cast("double")).otherwise(F.col("x"))), {"x": "raw/x"})
    assert op.run(spark, root) == ("PARTIAL", "2 recordings failed")
    assert set(told(spark, root)) == {f"f{i}" for i in range(40)} - {"f3", "f31"}
    assert {r.file_id for r in spark.read.parquet(f"{root}/log").where("file_id is not null").collect()} == {"f3", "f31"}


def test_empty_results_and_whole_tables(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, ["a"]).write.parquet(f"{root}/raw/x")
    op = Operator("none", "out/x", lambda x: x.where("x > 100").withColumn("y", F.col("x")), {"x": "raw/x"})
    assert op.run(spark, root) == ("SUCCESS", None) and read_key(spark, root, "out/x").count() == 0
    rows(spark, ["b"], 200.0).write.mode("append").parquet(f"{root}/raw/x")
    assert op.run(spark, root) == ("SUCCESS", None) and told(spark, root) == {"b": 603}
    whole = Operator("whole", "out/n", lambda x: x.agg(F.count(F.lit(1)).alias("n")), {"x": "raw/x"}, by_file=False)
    assert whole.run(spark, root)[0] == "SUCCESS" and whole.run(spark, root)[0] == "SKIPPED"
    rows(spark, ["c"]).write.mode("append").parquet(f"{root}/raw/x")
    assert whole.run(spark, root)[0] == "SUCCESS" and read_key(spark, root, "out/n").first().n == 9


def test_change_sets(spark):
    before = spark.createDataFrame([("a", "1", "FAILED"), ("b", "1", "SUCCESS"), ("c", "1", "SUCCESS"), ("d", "1", "SUCCESS"), (None, "1", "SUCCESS")], "file_id string, version string, status string")
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1"), ("e", "1"), (None, "1")], "file_id string, version string")
    got = {r.file_id: r.change for r in changes.change_set(before, now, F.col("status") == "FAILED").collect()}
    assert got == {"a": "failed", "b": "changed", "c": "same", "d": "removed", "e": "new", None: "same"}


def test_snapshots_scan_new_files_only(spark, tmp_path):
    path = str(tmp_path / "x y")
    rows(spark, ["a", None]).coalesce(1).write.parquet(path)
    first = changes.snapshot(spark, {"x": path}).collect()
    rows(spark, ["b"]).coalesce(1).write.mode("append").parquet(path)
    before = spark.createDataFrame([r.asDict() | {"n": 77} for r in first], changes.SNAPSHOT)
    again = changes.snapshot(spark, {"x": path}, before).collect()
    assert sorted((str(r.file_id), r.n) for r in again) == [("None", 77), ("a", 77), ("b", 3)]  # old rows are taken over
    assert len({r.path for r in again}) == 2


def test_ready_operators_run_at_the_same_time(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, ["a"]).write.parquet(f"{root}/raw/x")
    both = threading.Barrier(2, timeout=60)

    def meets(x):
        both.wait()
        return x

    def last(a, b):
        return a.unionByName(b)

    ops = [Operator("end", "e", last, {"a": "a", "b": "b"}), Operator("one", "a", meets, {"x": "raw/x"}), Operator("two", "b", meets, {"x": "raw/x"})]
    report = run_all(spark, root, ops)
    assert [r[:2] for r in report] == [("one", "SUCCESS"), ("two", "SUCCESS"), ("end", "SUCCESS")]
    assert spark.read.parquet(f"{root}/e").count() == 6 and spark.read.parquet(f"{root}/log").count() == 3


def test_a_failure_stops_what_runs(spark, tmp_path):
    root = str(tmp_path)
    rows(spark, ["a"]).coalesce(1).write.parquet(f"{root}/raw/x")

    def slow(x):
        def wait(batches):
            for _ in range(900):
                time.sleep(0.1)
            yield from batches

        return x.mapInArrow(wait, SCHEMA)

    def fails(x):
        raise ValueError("stop")

    ops = [Operator("slow", "a", slow, {"x": "raw/x"}, by_file=False), Operator("fails", "b", fails, {"x": "raw/x"}), Operator("after", "c", lambda a: a, {"a": "a"})]
    began = time.time()
    report = run_all(spark, root, ops, stop=True)
    assert time.time() - began < 80 and [r[:2] for r in report] == [("slow", "FAILED"), ("fails", "FAILED")]


@pytest.mark.parametrize("salt", [0, 1])
def test_row_hashes_mind_nulls(spark, salt):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(changes.row_hash(df, salt).alias("h")).distinct().count() == 4

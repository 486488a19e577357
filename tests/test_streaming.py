import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from somatiq.operators import signal
from somatiq.streaming import peaks
from somatiq.streaming.windows import pair_markers_stream, windowed_features

T0 = datetime.datetime(2020, 1, 1)


def source(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    spark.createDataFrame([(f, T0 + datetime.timedelta(seconds=s), label, v) for f, s, label, v in rows], "file_id string, ts timestamp, label string, value double").coalesce(1).write.parquet(path)
    return spark.readStream.schema("file_id string, ts timestamp, label string, value double").parquet(path)


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.sql(f"select * from {name}").collect()


def test_pairs_in_a_stream(spark, tmp_path):
    rows = [("f", 0, "b", 0.0), ("f", 5, "b", 0.0), ("f", 9, "e", 0.0), ("f", 10, "e", 0.0), ("g", 1, "e", 0.0), ("g", 2, "b", 0.0), ("g", 3, "e", 0.0), ("z", 5000, "b", 0.0)]
    got = drain(pair_markers_stream(source(spark, tmp_path, rows), "b", "e"), "pairs")
    assert {(r.file_id, (r.begin - T0).seconds, (r.end - T0).seconds) for r in got} == {("f", 5, 9), ("g", 2, 3)}


def test_late_markers_take_their_place(spark, tmp_path):
    """The end comes two batches before the begin that it belongs to."""
    path = str(tmp_path / "in")
    table = lambda rows: spark.createDataFrame([(f, T0 + datetime.timedelta(seconds=s), label) for f, s, label in rows], "file_id string, ts timestamp, label string").coalesce(1)
    batches = [[("f", 0, "b"), ("f", 100, "e")], [("f", 20, "x")], [("f", 90, "b")], [("z", 5000, "b")], [("z", 5001, "b")]]
    for rows in batches:
        table(rows).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are read in the order of their times
    stream = spark.readStream.schema("file_id string, ts timestamp, label string").option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(pair_markers_stream(stream, "b", "e"), "late_pairs")
    assert {(r.file_id, (r.begin - T0).seconds, (r.end - T0).seconds) for r in got} == {("f", 90, 100)}


def test_windows_in_a_stream(spark, tmp_path):
    rows = [("f", s, "x", float(s)) for s in (0, 60, 400, 700)]
    got = drain(windowed_features(source(spark, tmp_path, rows), "value"), "windows", "complete")
    assert {((r.begin - T0).seconds, r.n, r.mean) for r in got} == {(0, 2, 30.0), (300, 1, 400.0), (600, 1, 700.0)}


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_of_peaks_equals_batch(spark, tmp_path, seed):
    """Shuffled arrival within the watermark, files one after the other, and a restart from the checkpoint in between."""
    rng = random.Random(seed)
    rows = [(f, T0 + datetime.timedelta(seconds=7 * i + (f == "g") * 3), rng.choice([1.0, 2.0, 3.0, 5.0]) + rng.random()) for f in "fg" for i in range(120)]
    rows.sort(key=lambda r: (r[1] + datetime.timedelta(seconds=rng.uniform(0, 100))))
    schema = "file_id string, ts timestamp, value double"
    folder, state, out = (str(tmp_path / c) for c in ("in", "state", "out"))
    peaks.use_state_store(spark)

    def run(name, part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(f"{folder}/{name}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/*")
        found = peaks.adaptive_peaks_stream(stream, 0.7, 60.0, 5, late="2 minutes", expire="100 days")
        query = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert query.awaitTermination(180)

    for k in range(3):
        run(f"part{k}", rows[80 * k : 80 * k + 80])
    # A marker far ahead lets the watermark pass everything else.
    run("end", [("z", T0 + datetime.timedelta(days=2), 1.0)])
    run("later", [("z", T0 + datetime.timedelta(days=2, seconds=1), 1.0)])
    got = sorted((r.file_id, r.ts, round(r.value, 9), round(r.threshold, 9)) for r in spark.read.parquet(out).where("file_id <> 'z'").collect())
    batch = signal.adaptive_peaks(spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")), "value", 0.7, 60.0, 5)
    want = sorted((r.file_id, r.ts, round(r.value, 9), round(r.threshold, 9)) for r in batch.collect())
    assert len(want) > 40 and got == want

import datetime
import json

import pytest
from pyspark.sql import functions as F

from somatiq import cli
from somatiq.operators import metadata, nn, population, signal, summarize
from somatiq.operators.behavior import GAME, PUSH, WAVE
from somatiq.plans.flows import FLOWS, OPERATORS
from somatiq.plans.pipeline import Operator, in_order, run_all
from somatiq.sources import readers, sinks

T0 = datetime.datetime(2020, 1, 1)


def at(s):
    return T0 + datetime.timedelta(seconds=s)


def test_eighteen_flows():
    assert len(FLOWS) == 18


def test_events_to_behaviour(spark, tmp_path):
    push = lambda b, x, a: json.dumps({"button": b, "x": x, "y": 2.0, "z": 5.0, "result": {"action": a}})
    rows = [("f", at(0), f"{GAME}_begins", None), ("f", at(1), f"{WAVE}_begins", None), ("f", at(2), PUSH, push("trigger", -1.0, "action_succeed")), ("f", at(3), PUSH, push("pad", 1.0, "no_target")), ("f", at(4), PUSH, push("pad", 1.0, "action_failed")), ("f", at(5), f"{WAVE}_ends", json.dumps({"report": {"difficulty": 8}})), ("f", at(9), f"{GAME}_ends", None)]
    root = str(tmp_path)
    spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, label string, data string").write.parquet(f"{root}/raw/events")
    assert OPERATORS["standardize_events"].run(spark, root) == ("SUCCESS", None)
    assert OPERATORS["standardize_events"].run(spark, root)[0] == "SKIPPED"
    assert OPERATORS["standardize_events"].run(spark, root, forced=True)[0] == "SUCCESS"
    assert OPERATORS["features_behavior"].run(spark, root)[0] == "SUCCESS"
    got = {r["id"]: r["value"] for r in spark.read.parquet(f"{root}/features/behavior").collect()}
    assert len(got) == 13
    assert (got["performance"], got["global_accuracy"], got["global_inaccuracy"], got["spatial_inaccuracy"], got["switch_actions"], got["pad_actions"]) == (8, 1, 1, 1, 1, 1)
    assert got["participant_motion_tau"] == pytest.approx(0.5)
    assert OPERATORS["features_cardiac"].run(spark, root) == ("GRACEFUL_FAIL", "missing input standard/signals")
    FLOWS["summarize_behavior"](spark, root)
    assert spark.read.option("header", True).csv(f"{root}/population/behavior").count() == 13
    assert spark.read.parquet(f"{root}/log").count() == 4


def test_signal_flows_run(spark, tmp_path):
    root = str(tmp_path)
    beat = lambda c, k: F.sin(c * k)
    n = F.col("id").cast("double") / 512
    sig = spark.range(512 * 90).select(F.lit("f").alias("file_id"), F.timestamp_micros((F.lit(1_577_836_800_000_000) + F.col("id") * 15625 / 8).cast("long")).cast("timestamp_ntz").alias("ts"), beat(n, 6.3).alias("G"), (beat(n, 0.3) + 5).alias("F"), beat(n, 1.5).alias("H"))
    sig.write.parquet(f"{root}/raw/signals")
    events = [("f", at(1), "session_sequence_begins", None), ("f", at(85), "session_sequence_ends", None)]
    spark.createDataFrame(events, "file_id string, ts timestamp_ntz, label string, data string").write.parquet(f"{root}/raw/events")
    from somatiq.plans import flows

    OPERATORS["standardize_events"].run(spark, root)
    std = flows.standardize_signals(spark.read.parquet(f"{root}/raw/signals"), 512)
    std.write.parquet(f"{root}/standard/signals")
    got = spark.read.parquet(f"{root}/standard/signals")
    table = spark.read.parquet(f"{root}/standard/events")
    assert abs(got.count() - 512 * 90) <= 1
    cardiac = {r["id"]: r["value"] for r in flows.cardiac(got, table, 512).collect()}
    assert cardiac["meanNN"] == pytest.approx(997, abs=20)
    assert len(cardiac) == 15
    assert len({r["id"] for r in flows.breathing(got, table, 512).collect()}) == 9
    assert len({r["id"] for r in flows.galvanic(got, table, 512, 8).collect()}) == 11


def test_command_line(capsys):
    assert cli.main(["version"]) == 0
    assert cli.main(["flows", "list"]) == 0
    assert "standardize_vr" in capsys.readouterr().out
    assert cli.main(["flows", "info", "features_cardiac"]) == 0


def test_urls_and_keys():
    assert readers.parse_url("file:///a/b")["path"] == "/a/b"
    with pytest.raises(ValueError):
        readers.parse_url("ftp://x")
    assert readers.key_parts("/nexus/signal/gsr/clean") == {"source": "nexus", "type": "signal", "modality": "gsr", "name": "clean"}


def test_sources_and_sinks(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("f", 1.0), ("g", 2.0)], "file_id string, x double")
    sinks.store_key(df, root, "a/b", annotations=df.select("file_id", F.lit("").alias("x")))
    assert readers.read_key(spark, root, "a/b").count() == 2
    assert readers.key_exists(spark, root, "a/b/annotations") and not readers.key_exists(spark, root, "a/c")
    assert readers.list_files(spark, root, "*.parquet", 1).count() == 1
    with pytest.raises(ValueError):
        readers.query_catalog(spark, " ")
    df.createOrReplaceTempView("files")
    assert [r.file_id for r in readers.query_catalog(spark, "select * from files", limit=1).collect()] == ["f"]
    pages = tmp_path / "page.json"
    pages.write_text(json.dumps({"items": [{"token": "a", "answers": [1]}, {"token": "a", "answers": [1]}, {"token": "b", "answers": None}]}))
    assert readers.read_responses(spark, str(pages)).count() == 1
    assert readers.read_document(spark, str(pages))["items"][0]["token"] == "a"
    sinks.write_responses(df, f"{root}/json")
    assert spark.read.json(f"{root}/json").columns == ["file_id", "x"]
    with pytest.raises(ValueError):
        population.union_all([None])
    groups = spark.createDataFrame([("p", "k", "f", "SUCCESS"), ("p", "k", "g", "SUCCESS")], "parent_id string, key string, file_id string, status string")
    with pytest.raises(ValueError):
        population.merge_groups(groups)


def test_retrieve_checks_content(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / "b.txt").write_text("stale")
    md5 = "5d41402abc4b2a76b9719d911017c592"
    catalog = spark.createDataFrame([(1, "a.txt", md5), (2, "b.txt", md5), (3, "c.txt", md5)], "file_id int, filename string, checksum string")
    assert {r.file_id: r.fresh for r in readers.retrieve(spark, str(tmp_path), catalog).collect()} == {1: True, 2: False, 3: False}


def test_metadata_helpers():
    assert metadata.is_subset({"a": {"b": 1}}, {"a": {"b": 1, "c": 2}}) and not metadata.is_subset({"a": 1}, {"a": 2})
    assert json.loads(metadata.put_path('{"a": {"b": 1}}', ["a", "c"], 2)) == {"a": {"b": 1, "c": 2}}
    assert metadata.fingerprint_inputs({"a": 1}) != metadata.fingerprint_inputs({"a": 2})


def test_rejection_bounds(spark):
    rows = [("f", at(i), float(v)) for i, v in enumerate([600, 700, 800, 1000, 1250, 1300, 900, 599])]
    got = nn.reject_artifacts(spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, nn double"), 25, 600, 1300).orderBy("ts").collect()
    assert [r.bad for r in got] == [False, False, False, False, False, False, True, True]
    with pytest.raises(ValueError):
        nn.reject_artifacts(spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, nn double"), 100)


def test_summarize_rejects_unknown(spark):
    s = spark.createDataFrame([("f", at(0), 1.0)], "file_id string, ts timestamp_ntz, x double")
    q = spark.createDataFrame([("f", "s_0", at(0), at(1))], "file_id string, id string, begin timestamp_ntz, end timestamp_ntz")
    for d in (summarize.FeatureDefinition("numpy.sum", ["y"]), summarize.FeatureDefinition("what", ["x"]), summarize.FeatureDefinition(custom="what", columns=["x"])):
        with pytest.raises(ValueError):
            summarize.summarize(s, q, {"f": d})


def test_reducers_of_users(spark):
    import numpy as np

    rows = [("f", at(k), float(v) if v is not None else None, k == 3) for k, v in enumerate([3, 1, None, 9, 5, 2])]
    s = spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, x double, bad boolean")
    q = spark.createDataFrame([("f", "a_0", at(0), at(5)), ("f", "b_0", at(2), at(2)), ("g", "a_0", at(0), at(1))], "file_id string, id string, begin timestamp_ntz, end timestamp_ntz")
    summarize.register_reducer("last_minus_first", lambda v: v[-1] - v[0])
    with pytest.raises(ValueError):
        summarize.register_reducer("numpy.sum", np.sum)
    d = {
        "range": summarize.FeatureDefinition("numpy.ptp", ["x"]),
        "goodrange": summarize.FeatureDefinition("numpy.ptp", ["x"], drop_bad_samples=True, empty_policy="none there"),
        "step": summarize.FeatureDefinition("last_minus_first", ["x"], divide_by_duration=True, empty_policy=-1.0),
        "sum": summarize.FeatureDefinition("numpy.sum", ["x"]),
    }
    got = {(r.file_id, r.reference, r["id"]): (r.value, r.status) for r in summarize.summarize(s, q, d).collect()}
    assert {k[2]: v for k, v in got.items() if k[:2] == ("f", "a_0")} == {"x_range": (8, "ok"), "x_goodrange": (4, "ok"), "x_step": (-0.2, "ok"), "x_sum": (20, "ok")}
    assert got["g", "a_0", "x_goodrange"] == (None, "none there") and got["g", "a_0", "x_step"] == (-1, "ok") and ("g", "a_0", "x_range") not in got
    with pytest.raises(ValueError):
        summarize.summarize(s, q, {"f": summarize.FeatureDefinition("numpy.no_such_function", ["x"])})


def test_peaks_of_plateaus(spark):
    values = [0.0, 1.0, 3.0, 3.0, 1.0, 0.0, 2.0, 0.0, None, 5.0, 5.0, 5.0, 0.0]
    rows = [("f", at(i), v) for i, v in enumerate(values)] + [("g", at(i), float(i)) for i in range(5)]
    s = spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, x double")
    assert {(r.position, r.plateau_size) for r in signal.local_maxima(s, "x").collect()} == {(3, 2), (7, 1), (10, 3)}
    assert {(r.position, tuple(r.window)) for r in signal.peak_windows(s, "x", 4).collect()} == {(3, (0, 1, 3, 3)), (7, (1, 0, 2, 0)), (11, (0, 5, 5, 5))}
    told = {r.peak_sample: r for r in signal.peak_properties(s, "x").collect()}
    assert {k: (r.prominence, r.plateau_size, r.left_base) for k, r in told.items()} == {2: (3, 2, 0), 6: (2, 1, 5), 10: (5, 3, 8)}
    # Nearer than 180 * 60 / 2160 = 5 samples to a higher one: the peak between goes.
    close = signal.slope_sum_peaks(s, "x", 2160.0).orderBy("ts").collect()
    assert [(r.ts, r.value, r.start) for r in close] == [(at(2), 3, at(0)), (at(9), 5, at(0))]


def test_adaptive_threshold_matches_a_plain_fold(spark):
    import random
    import statistics

    rng = random.Random(5)
    values = [rng.choice([1, 2, 3, 5, 8]) + rng.random() for _ in range(200)]
    got = signal.adaptive_peaks(spark.createDataFrame([("f", at(i), v) for i, v in enumerate(values)], "file_id string, ts timestamp_ntz, x double"), "x", 0.7, 10.0, 5)
    threshold = 0.7 * max(values[:11])
    kept = [(i, threshold) for i, v in enumerate(values[:11]) if v > threshold]
    for i in range(10, 200):
        if values[i] > threshold:
            kept = [k for k in kept if k[0] != i] + [(i, None)]
            threshold = 0.7 * statistics.median([values[k] for k, _ in kept][-5:])
            kept[-1] = (i, threshold)
    assert [(r.ts, pytest.approx(r.threshold)) for r in got.orderBy("ts").collect()] == [(at(i), t) for i, t in kept]


def test_one_bad_file_does_not_stop_the_rest(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"f{i}", at(k), float(i * 10 + k)) for i in range(12) for k in range(3)]
    spark.createDataFrame(rows, "file_id string, ts timestamp_ntz, x double").write.parquet(f"{root}/raw/x")

    def kernel(values):
        if values[0] in (30.0, 70.0):
            raise ValueError(f"cannot read {values[0]}")
        return values * 2

    op = Operator("double", "out/x", lambda x: signal.per_file(x, "x", kernel, "y"), {"x": "raw/x"})
    assert op.run(spark, root) == ("PARTIAL", "2 recordings failed")
    got = {r.file_id: r.n for r in spark.read.parquet(f"{root}/out/x").groupBy("file_id").agg(F.count("y").alias("n")).collect()}
    assert got == {f"f{i}": 3 for i in range(12) if i not in (3, 7)}
    log = {r.file_id: (r.status, r.problem) for r in spark.read.parquet(f"{root}/log").where("file_id is not null").collect()}
    assert log == {"f3": ("FAILED", "ValueError: cannot read 30.0"), "f7": ("FAILED", "ValueError: cannot read 70.0")}

    def refuse(x):
        raise ValueError("no good at all")

    assert Operator("refuse", "out/y", refuse, {"x": "raw/x"}, by_file=False).run(spark, root) == ("FAILED", "no good at all")


def test_operators_run_after_their_inputs(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("f", 1)], "file_id string, x int").write.parquet(f"{root}/raw/x")
    last = Operator("last", "c", lambda b: b.withColumn("z", F.col("y") + 1), {"b": "b"})
    middle = Operator("middle", "b", lambda x: x.withColumn("y", F.col("x") + 1), {"x": "raw/x"})
    assert [r[:2] for r in run_all(spark, root, [last, middle])] == [("middle", "SUCCESS"), ("last", "SUCCESS")]
    assert spark.read.parquet(f"{root}/c").first().z == 3
    with pytest.raises(ValueError):
        in_order([Operator("a", "k", None, {"x": "l"}), Operator("b", "l", None, {"x": "k"})])


def test_paged_responses(spark, tmp_path):
    newest = [{"token": f"t{i:03}", "answers": [i] if i % 5 else None} for i in range(250, 0, -1)]
    asked = []

    def fetch(size, before):
        asked.append((size, before))
        start = 0 if before is None else next(i for i, r in enumerate(newest) if r["token"] == before) + 1
        return {"items": newest[start : start + size]}

    path = str(tmp_path / "pages")
    assert readers.store_responses(spark, fetch, path, 5) == 3
    assert asked == [(100, None), (100, "t151"), (100, "t051")]
    assert readers.read_responses(spark, path).count() == 200


def test_merge_datasets(spark, tmp_path):
    a, b, target = (str(tmp_path / c) for c in "abt")
    df = spark.createDataFrame([("f", 1)], "file_id string, x int")
    df.write.parquet(f"{a}/one/x")
    df.write.parquet(f"{b}/two/x")
    df.where("false").write.parquet(f"{b}/one/x")
    assert sinks.merge_datasets(spark, [(a, "one/x"), (b, "two/x"), (b, "one/x"), (b, "none")], target) == ["one/x", "two/x"]
    assert spark.read.parquet(f"{target}/two/x").count() == 1
    with pytest.raises(ValueError):
        sinks.merge_datasets(spark, [(a, "one/x"), (target, "one/x")], f"{target}2")

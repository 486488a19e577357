import pytest

from somatiq.operators import forms

MAP = {"Jamais": 0, "1 à 2 fois": 1, "Tous les jours": 5}
RANGES = [("nested1", 0.0, 5.0), ("nested2", 0.0, 5.0), ("scale1", 1.0, 11.0), ("scale2", 0.0, 4.0), ("scale3", 1.0, 5.0)]
ANSWERS = [("r", "nested1", "1 à 2 fois"), ("r", "nested2", "Tous les jours"), ("r", "scale1", "2"), ("r", "scale2", "0"), ("r", "scale3", "5")]


def config(op, reverse):
    q = lambda ref, m=None: {"field_ref": ref, "reverse": reverse, **({"value_map": m} if m else {})}
    return {"domains": [{"name": "d", "operation": op, "dimensions": [{"name": "one", "operator": op, "questions": [q("nested1", MAP), q("nested2", MAP)]}, {"name": "two", "operator": op, "questions": [q("scale1"), q("scale2"), q("scale3")]}]}]}


@pytest.mark.parametrize(("op", "reverse", "one", "two", "d"), [("sum", False, 6, 7, 13), ("sum", True, 4, 15, 19), ("mean", False, 3, 7 / 3, (3 + 7 / 3) / 2), ("mean", True, 2, 5, 3.5)])
def test_scores(spark, op, reverse, one, two, d):
    table = spark.createDataFrame(forms.config_rows(config(op, reverse)), forms.CONFIG_SCHEMA)
    ranges = spark.createDataFrame(RANGES, "ref string, low double, high double")
    scores = forms.question_scores(spark.createDataFrame(ANSWERS, "response_id string, ref string, answer string"), table, ranges)
    got = {r["id"]: r["value"] for r in forms.form_features(scores).collect()}
    assert got == pytest.approx({"one": one, "two": two, "d": d})


@pytest.mark.parametrize(("op", "one", "two", "d"), [("sum", (0, 10), (2, 20), (2, 30)), ("mean", (0, 5), (2 / 3, 20 / 3), ((2 / 3) / 2, (5 + 20 / 3) / 2))])
def test_ranges(spark, op, one, two, d):
    table = spark.createDataFrame(forms.config_rows(config(op, False)), forms.CONFIG_SCHEMA)
    got = {r["dimension"] or "d": (r["low"], r["high"]) for r in forms.score_ranges(table, spark.createDataFrame(RANGES, "ref string, low double, high double")).collect()}
    for name, want in (("one", one), ("two", two), ("d", d)):
        assert got[name] == pytest.approx(want)


def test_missing_answers_have_a_status(spark):
    table = spark.createDataFrame(forms.config_rows(config("sum", False)), forms.CONFIG_SCHEMA)
    answers = spark.createDataFrame([("r", "nested1", "never heard of")], "response_id string, ref string, answer string")
    got = forms.question_scores(answers, table, spark.createDataFrame(RANGES, "ref string, low double, high double")).collect()
    assert [r["status"] for r in got] == ["missing"]


def test_config_errors_and_refs():
    assert forms.resolve_refs({"a": {"b": 1}, "c": {"$ref": "#/a/b"}})["c"] == 1
    with pytest.raises(forms.FormError):
        forms.resolve_refs({"c": {"$ref": "#/x"}})
    bad = config("sum", False)
    bad["domains"][0]["operation"] = "max"
    with pytest.raises(forms.FormError):
        forms.config_rows(bad)
    twice = config("sum", False)
    twice["domains"][0]["dimensions"][1]["name"] = "one"
    with pytest.raises(forms.FormError):
        forms.config_rows(twice)


def test_flatten_fields():
    form = {"fields": [{"ref": "g", "type": "group", "properties": {"fields": [{"ref": "a", "type": "text"}, {"ref": "h", "type": "group", "properties": {"fields": [{"ref": "b", "type": "text"}]}}]}}, {"ref": "c", "type": "text"}]}
    assert [f["ref"] for f in forms.flatten_fields(form)] == ["g", "c", "a", "h", "b"]


def test_tables_of_nested_forms(spark):
    import json
    import random

    rng = random.Random(4)

    def fields(depth):
        return [{"ref": f"r{rng.random()}", "type": "group", "properties": {"fields": fields(depth - 1)}} if depth and rng.random() < 0.5 else {"ref": f"r{rng.random()}", "type": "text"} for _ in range(rng.randint(0, 12))]

    documents = {i: {"fields": fields(4)} for i in range(12)} | {98: {}, 99: {"fields": [{"ref": "g", "type": "group"}]}}
    rows = [(i, json.dumps(d)) for i, d in documents.items()] + [(100, None), (101, "no json")]
    got = {}
    for r in forms.flatten_forms(spark.createDataFrame(rows, "form_id int, document string")).orderBy("form_id", "place").collect():
        assert r.place == len(got.setdefault(r.form_id, []))
        got[r.form_id].append(json.loads(r.field))
    assert max(len(v) for v in got.values()) > 30
    assert got == {i: flat for i, d in documents.items() if (flat := forms.flatten_fields(d))}


def test_question_range(spark):
    rows = spark.createDataFrame([("opinion_scale", True, 11, None), ("opinion_scale", False, 5, None), ("multiple_choice", None, None, {"a": 0.0, "b": 5.0}), ("text", None, None, None)], "t string, o boolean, s int, m map<string,double>")
    low, high = forms.question_range(rows.t, rows.o, rows.s, rows.m)
    assert [tuple(r) for r in rows.select(low, high).collect()] == [(1.0, 11.0), (0.0, 4.0), (0.0, 5.0), (None, None)]


def test_yaml_config_and_user_hash(spark, tmp_path):
    path = tmp_path / "form.yaml"
    path.write_text("definitions: {maps: {m: {a: 1, b: 2}}}\ndomains:\n- name: d\n  operation: mean\n  dimensions:\n  - name: one\n    questions:\n    - field_ref: x\n      value_map: {$ref: '#/definitions/maps/m'}\n    - field_ref: y\n      reverse: true\n")
    assert forms.load_config(str(path)) == [("d", "mean", "one", "sum", "x", False, {"a": 1.0, "b": 2.0}), ("d", "mean", "one", "sum", "y", True, None)]
    df = spark.createDataFrame([(1, '{"id": "u"}')], "r int, hidden string")
    assert forms.user_hash(df).first().user_hash == "u"

"""Questionnaires: form fields, answers, hierarchical scores."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONFIG_SCHEMA = "domain string, domain_op string, dimension string, dimension_op string, ref string, reverse boolean, value_map map<string,double>"


class FormError(ValueError):
    """A scoring configuration or an answer that cannot be used."""


def resolve_refs(node: Any, root: Any = None) -> Any:
    """A document whose ``{"$ref": "#/a/b"}`` parts are replaced by what they point at."""
    root = node if root is None else root
    if isinstance(node, dict):
        if isinstance(node.get("$ref"), str):
            target = root
            for part in node["$ref"].lstrip("#/").split("/"):
                if not isinstance(target, dict) or part not in target:
                    raise FormError(f"unresolved reference {node['$ref']}")
                target = target[part]
            return resolve_refs(target, root)
        return {k: resolve_refs(v, root) for k, v in node.items()}
    return [resolve_refs(v, root) for v in node] if isinstance(node, list) else node


def config_rows(config: dict) -> list[tuple]:
    """A scoring tree as rows of CONFIG_SCHEMA; checks operators and repeated names.

    ``operation`` (sum, the default, or mean) and ``field_ref`` may also be called ``operator`` and ``ref``.
    """
    op = lambda node: node.get("operation", node.get("operator", "sum"))
    tree, rows, names = resolve_refs(config), [], []
    for domain in tree.get("domains", []):
        names.append(domain["name"])
        for dim in domain.get("dimensions", []):
            names.append(dim["name"])
            for node in (domain, dim):
                if op(node) not in ("sum", "mean"):
                    raise FormError(f"unknown operation {op(node)}")
            for q in dim.get("questions", []):
                mapping = q.get("value_map")
                rows.append((domain["name"], op(domain), dim["name"], op(dim), q.get("field_ref", q.get("ref")), bool(q.get("reverse", False)), {str(k): float(v) for k, v in mapping.items()} if mapping else None))
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise FormError(f"repeated names: {sorted(repeated)}")
    return rows


def load_config(path: str) -> list[tuple]:
    import yaml

    with open(path, encoding="utf-8") as f:
        return config_rows(yaml.safe_load(f))


def flatten_fields(form: dict) -> list[dict]:
    """All fields of a form, breadth first; groups come themselves and then their members."""
    out, queue = [], list(form.get("fields", []))
    while queue:
        field = queue.pop(0)
        out.append(field)
        if field.get("type") == "group":
            queue.extend(field.get("properties", {}).get("fields", []))
    return out


def flatten_forms(forms: DataFrame, document: str = "document", by: str = "form_id") -> DataFrame:
    """by, place, depth, path, ref, type, field of all fields of a table of forms (JSON texts), breadth first in each form.

    Fields of groups inside groups, at any depth: each level explodes the groups of the one above
    it, for all forms at once, until none has groups. ``path`` has the place in each group on the
    way down; ``place`` counts from 0 as :func:`flatten_fields` does. A form without fields, and
    one that is NULL or no JSON, gives no rows.
    """
    inside = lambda raw, at: F.posexplode(F.from_json(F.get_json_object(raw, at), "array<string>")).alias("__at", "field")
    level = forms.select(by, inside(F.col(document), "$.fields")).select(by, F.array("__at").alias("path"), "field")
    levels = []
    while True:
        told = level.select(by, "path", F.get_json_object("field", "$.ref").alias("ref"), F.get_json_object("field", "$.type").alias("type"), "field")
        levels.append(told)
        groups = told.where((F.col("type") == "group") & F.get_json_object("field", "$.properties.fields[0]").isNotNull())
        if groups.isEmpty():
            break
        level = groups.select(by, F.col("path").alias("__up"), inside(F.col("field"), "$.properties.fields")).select(by, F.concat("__up", F.array("__at")).alias("path"), "field")
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    every = every.withColumn("depth", F.size("path"))
    place = F.row_number().over(Window.partitionBy(by).orderBy("depth", "path")) - 1
    return every.select(by, place.alias("place"), "depth", "path", "ref", "type", "field")


def observed_ranges(answers: DataFrame, config: DataFrame) -> DataFrame:
    """ref, low, high: the least and greatest score that answers (response_id, ref, answer) have before reversal.

    For questions whose form tells no range: mapped answers by the question's map, others as numbers.
    """
    plain = F.when(F.col("value_map").isNotNull(), F.col("value_map")[F.col("answer")]).otherwise(F.col("answer").try_cast("double"))
    maps = config.groupBy("ref").agg(F.first("value_map", ignorenulls=True).alias("value_map"))
    return answers.join(maps, "ref").groupBy("ref").agg(F.min(plain).alias("low"), F.max(plain).alias("high"))


def question_range(field_type: Column, start_at_one: Column, steps: Column, value_map: Column) -> tuple[Column, Column]:
    """(least, greatest) value of a question: of its map, or of an opinion scale; NULL for other types."""
    values = F.map_values(value_map)
    one = F.coalesce(start_at_one, F.lit(False)).cast("int")
    scale = field_type == "opinion_scale"
    return F.when(value_map.isNotNull(), F.array_min(values)).when(scale, one.cast("double")), F.when(value_map.isNotNull(), F.array_max(values)).when(scale, (steps - (1 - one)).cast("double"))


def parse_answer(kind: Column, raw: Column) -> dict[str, Column]:
    """Typed columns of an answer given as text: number, flag, label, moment, and whether the type is known."""
    return {
        "number": F.when(kind == "number", raw.try_cast("double")),
        "flag": F.when(kind == "boolean", raw.try_cast("boolean")),
        "label": F.when(kind.isin("choice", "text", "phone_number", "email"), raw),
        "labels": F.when(kind == "choices", F.split(raw, r"\|")),
        "moment": F.when(kind == "date", F.try_to_timestamp(raw)),
        "known": kind.isin("number", "boolean", "choice", "choices", "text", "phone_number", "email", "date"),
    }


def last_answers(answers: DataFrame, order: str) -> DataFrame:
    """The last answer of each (response, ref)."""
    others = [c for c in answers.columns if c not in ("response_id", "ref")]
    return answers.groupBy("response_id", "ref").agg(F.max_by(F.struct(*others), order).alias("__a")).select("response_id", "ref", *[F.col(f"__a.{c}").alias(c) for c in others])


def question_scores(answers: DataFrame, config: DataFrame, ranges: DataFrame) -> DataFrame:
    """response_id, config columns, score, status: mapped, then reversed inside the question's range.

    answers: response_id, ref, answer (text); ranges: ref, low, high. An answer that the map lacks,
    and a question without an answer, has status ``missing`` and no score.
    """
    told = answers.join(config, "ref").join(ranges, "ref", "left")
    plain = F.when(F.col("value_map").isNotNull(), F.col("value_map")[F.col("answer")]).otherwise(F.col("answer").try_cast("double"))
    scored = told.withColumn("plain", plain).withColumn("score", F.when(F.col("reverse"), F.col("low") + F.col("high") - F.col("plain")).otherwise(F.col("plain")))
    return scored.withColumn("status", F.when(F.col("score").isNull(), F.lit("missing")).otherwise(F.lit("ok")))


def _rolled(op: str, value: str) -> Column:
    return F.when(F.first(op) == "sum", F.sum(value)).otherwise(F.avg(value))


def dimension_scores(scores: DataFrame, by: str = "response_id", value: str = "score") -> DataFrame:
    return scores.groupBy(by, "domain", "domain_op", "dimension").agg(_rolled("dimension_op", value).alias("value"))


def domain_scores(dimensions: DataFrame, by: str = "response_id") -> DataFrame:
    return dimensions.groupBy(by, "domain").agg(_rolled("domain_op", "value").alias("value"))


def form_features(scores: DataFrame) -> DataFrame:
    """response_id, id, level, reference, value: every domain and dimension."""
    dims = dimension_scores(scores)
    doms = domain_scores(dims)
    return doms.select("response_id", F.col("domain").alias("id"), F.lit("Domain").alias("level"), F.lit("subject").alias("reference"), "value").unionByName(dims.select("response_id", F.col("dimension").alias("id"), F.lit("Dimension").alias("level"), F.lit("subject").alias("reference"), "value"))


def score_ranges(config: DataFrame, ranges: DataFrame) -> DataFrame:
    """domain, dimension (NULL: the domain itself), low, high: the same roll-up over the questions' ranges."""
    q = config.join(ranges, "ref")
    dims = q.groupBy("domain", "domain_op", "dimension").agg(_rolled("dimension_op", "low").alias("low"), _rolled("dimension_op", "high").alias("high"))
    doms = dims.groupBy("domain").agg(_rolled("domain_op", "low").alias("low"), _rolled("domain_op", "high").alias("high"))
    return dims.select("domain", "dimension", "low", "high").unionByName(doms.select("domain", F.lit(None).cast("string").alias("dimension"), "low", "high"))


def user_hash(responses: DataFrame, hidden: str = "hidden") -> DataFrame:
    """Adds the user's hash from the hidden fields (a struct with ``id``, or its JSON)."""
    kind = responses.schema[hidden].dataType.simpleString()
    return responses.withColumn("user_hash", F.get_json_object(hidden, "$.id") if kind == "string" else F.col(f"{hidden}.id"))


def unique_responses(responses: DataFrame, order: str = "submitted_at") -> DataFrame:
    """First response of each token, those without answers left out."""
    return responses.where("answers is not null").groupBy("token").agg(F.min_by(F.struct(*[c for c in responses.columns if c != "token"]), order).alias("__r")).select("token", "__r.*")

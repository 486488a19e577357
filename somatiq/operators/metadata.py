"""The file catalog: selection, status, propagation, journal, incremental runs."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import json_field, version_key

SUCCESS, PARTIAL, FAILED, GRACEFUL, SKIPPED = "SUCCESS", "PARTIAL", "FAILED", "GRACEFUL_FAIL", "SKIPPED"


def select_files(catalog: DataFrame, predicate: Column | str, seed: int | None = None, limit: int | None = None, order: str | tuple[str, ...] = "file_id") -> DataFrame:
    """Files that satisfy a predicate, in order or shuffled by a seed, the first ``limit`` of them."""
    by = (order,) if isinstance(order, str) else order
    out = catalog.where(predicate)
    out = out.orderBy(F.xxhash64(*by, F.lit(seed)), *by) if seed is not None else out.orderBy(*by)
    return out.limit(limit) if limit is not None else out


def pending(flow: str, version: str) -> Column:
    """Not yet processed by a flow, or by an older version of it (numbers compared as numbers)."""
    done = json_field(F.col("journal"), f"flows.{flow}.version")
    return done.isNull() | (version_key(done) < version_key(F.lit(version)))


def find_latest(files: DataFrame, by: list[str], when: str, deleted: Column) -> DataFrame:
    """The most recent file of each name and path that is not deleted."""
    others = [c for c in files.columns if c not in by]
    return files.where(~deleted).groupBy(*by).agg(F.max_by(F.struct(*others), F.struct(when, *[c for c in others if c != when])).alias("__f")).select(*by, *[F.col(f"__f.{c}").alias(c) for c in others])


def is_subset(needle: Any, hay: Any) -> bool:
    """Whether all of a nested dict is in another one."""
    return isinstance(hay, dict) and all(k in hay and is_subset(v, hay[k]) for k, v in needle.items()) if isinstance(needle, dict) else needle == hay


def deep_merge(base: dict, more: dict) -> dict:
    """A nested dict with the leaves of another one put over it."""
    out = dict(base)
    for k, v in more.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def put_path(document: str | None, path: list[str], value: Any) -> str:
    """A JSON text with a value set at a nested key."""
    nested: Any = value
    for key in reversed(path):
        nested = {key: nested}
    return json.dumps(deep_merge(json.loads(document) if document else {}, nested), sort_keys=True)


def mark_flow(runs: DataFrame, flow: str, version: str, status: Column | None = None) -> DataFrame:
    """file_id, flow, version, status: an entry for each file, with status NULL when the flow begins."""
    return runs.select("file_id", F.lit(flow).alias("flow"), F.lit(version).alias("version"), (F.lit(None).cast("string") if status is None else status).alias("status"))


def upsert(table: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a table with those of the same keys replaced."""
    return table.join(updates.select(*keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def propagate(children: DataFrame, parents: DataFrame, families: list[str], parent_key: str = "parent_id") -> DataFrame:
    """Children with the given families of their parents, but their own ids."""
    told = parents.select(F.col("file_id").alias("__p"), *[F.col(f).alias(f"__{f}") for f in families])
    joined = children.join(told, F.col(parent_key) == F.col("__p"), "left")
    return joined.withColumns({f: F.coalesce(F.col(f"__{f}"), F.col(f)) if f in children.columns else F.col(f"__{f}") for f in families}).drop("__p", *[f"__{f}" for f in families])


def journal(files: DataFrame, task: str, task_version: str, status: Column, problem: Column, parents: Column) -> DataFrame:
    """file_id, created_by, task, task_version, status, problem_type, problem_title, parents."""
    return files.select("file_id", F.lit("somatiq").alias("created_by"), F.lit(task).alias("task"), F.lit(task_version).alias("task_version"), status.alias("status"), F.when(status != SUCCESS, F.lit("error")).alias("problem_type"), problem.alias("problem_title"), parents.alias("parents"))


def status_report(runs: DataFrame, status: str = "status", title: str = "title") -> DataFrame:
    """outcome (``status: title``), n, place: most common first. One row an outcome, ranked in one task: titles are kinds of problems."""
    outcome = F.concat_ws(": ", status, title)
    counted = runs.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "outcome")))


def fingerprint_inputs(inputs: dict[str, Any]) -> str:
    """A key for results of the same inputs and parameters."""
    import hashlib

    return hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()

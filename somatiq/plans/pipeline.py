"""Operators over keyed datasets that compute what has changed, keep what has not, and log what failed.

A run compares the inputs with those of the last run, recording by recording (:mod:`.changes`). Only
recordings that are new, changed, failed or too old are computed; their results are staged, and then
replace the old ones in the folders that hold them. Nothing of the output is touched before that.

A recording that a kernel cannot read is left out and noted in the same pass. Where the failure is
not a kernel's, recordings are halved by hashed ids until those that fail alone are known; a fault
that hits everything ends that after a few tries. Each failed recording has a row in the run log and
is tried again by the next run.
"""

from __future__ import annotations

import datetime
import re
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.byfile import collected_problems
from ..operators.metadata import FAILED, GRACEFUL, PARTIAL, SKIPPED, SUCCESS, fingerprint_inputs
from ..operators.validate import SpecificationError
from ..sources.readers import PART_COLUMN, key_exists, key_path, read_key
from ..sources.sinks import append_catalog, delete_path, move_path
from . import changes

LOG_SCHEMA = "operator string, version string, fingerprint string, status string, problem string, at timestamp, file_id string, run string"
FILES_SCHEMA = "file_id string, version string, status string, problem string, at timestamp"
#: How long an earlier result of the same inputs counts.
CACHE_DAYS = 7
#: Folders that a dataset's recordings are dealt to: a changed recording rewrites one of them.
PARTS = 32
#: Failing recordings that are sought by halving, and failing parts without a good one, before a run is given up.
MOST_SOUGHT, MOST_TRIES = 16, 12
#: Into so many parts the recordings are cut at most when failures are sought.
MOST_PARTS = 1 << 40
#: Appends to the log from several operators at once go one after the other.
_LOGGING = threading.Lock()


def _reason(e: Exception) -> str:
    """The last line of what an exception says: of a worker's, the error itself."""
    lines = [line.strip() for line in str(e).strip().splitlines() if line.strip()]
    own = [line for line in lines if re.match(r"[A-Za-z_.]*(Error|Exception)\b.*:", line)]
    return (own or lines or [type(e).__name__])[-1][:500]


class SoftFailure(Exception):
    """An input that an operator cannot use; its result is an empty table, not an error."""


def _part() -> Column:
    return F.pmod(F.xxhash64(F.col("file_id").cast("string")), F.lit(PARTS)).cast("int")


def _among(table: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose file_id is (left_semi) or is not (left_anti) among the ids; null is an id."""
    told = ids.select(F.col("file_id").alias("__id"))
    return table.join(told, F.col("file_id").cast("string").eqNullSafe(F.col("__id")), how)


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


@dataclass
class Operator:
    """A transformation of keyed datasets: inputs are read by key, the result is stored under a key."""

    name: str
    output_key: str
    transform: Callable[..., DataFrame]
    inputs: dict[str, str] = field(default_factory=dict)
    version: str = "1.0"
    validate: Callable[[DataFrame], None] | None = None
    #: Whether a recording's result depends on that recording alone.
    by_file: bool = True

    def fingerprint(self, parameters: dict) -> str:
        return fingerprint_inputs({"operator": self.name, "version": self.version, "inputs": self.inputs, "parameters": parameters})

    def resolve(self, spark: SparkSession, root: str) -> dict[str, DataFrame]:
        found = {p: read_key(spark, root, key) for p, key in self.inputs.items()}
        missing = [self.inputs[p] for p, df in found.items() if df is None]
        if missing:
            raise SoftFailure(f"missing input {', '.join(missing)}")
        return {p: df for p, df in found.items() if df is not None}

    def run(self, spark: SparkSession, root: str, forced: bool = False, **parameters) -> tuple[str, str | None]:
        """(status, problem) of a run; the run log under /log has a row for it, and one for each failed recording."""
        mark, this = self.fingerprint(parameters), uuid.uuid4().hex
        last = self._last(spark, root)
        bad: dict[str, str] = {}
        kept = False
        try:
            tables = self.resolve(spark, root)
            status, bad = self._update(spark, tables, root, parameters, this, None if forced or last is None or last.fingerprint != mark else last.run)
            if status == SKIPPED:
                return SKIPPED, None
            problem = f"{len(bad)} recordings failed" if bad else None
            kept = True
        except SoftFailure as e:
            status, problem = GRACEFUL, str(e)
        except (SpecificationError, ValueError, PySparkException, Py4JJavaError) as e:  # the last: cancelled
            status, problem = FAILED, _reason(e)
        now = datetime.datetime.now(datetime.timezone.utc)
        rows = [(self.name, self.version, mark, status, problem, now, None, this if kept else None)]
        rows += [(self.name, self.version, mark, FAILED, reason, now, file, None) for file, reason in sorted(bad.items())]
        with _LOGGING:
            append_catalog(spark.createDataFrame(rows, LOG_SCHEMA), key_path(root, "log"))
        if kept and last is not None and last.run != this:
            delete_path(spark, self._state(root, last.run))
        if not kept:
            delete_path(spark, self._state(root, this))
        return status, problem

    def _state(self, root: str, run: str, table: str = "") -> str:
        """Where the snapshot of a run's inputs and the table of its recordings lie."""
        return f"{root.rstrip('/')}/state/{self.name}/{run}/{table}".rstrip("/")

    def _last(self, spark: SparkSession, root: str) -> Row | None:
        """The last run of this operator, with whatever parameters, that left a result."""
        try:
            log = spark.read.schema(LOG_SCHEMA).parquet(key_path(root, "log"))
        except PySparkException:
            return None
        return log.where((F.col("operator") == self.name) & F.col("run").isNotNull()).orderBy(F.desc("at")).first()

    def _update(self, spark: SparkSession, tables: dict[str, DataFrame], root: str, parameters: dict, this: str, last: str | None) -> tuple[str, dict[str, str]]:
        """Bring the output up to date: (status, failed recordings with reasons)."""
        if not key_exists(spark, root, self.output_key):
            last = None
        paths = {p: key_path(root, key) for p, key in self.inputs.items()}
        earlier = spark.read.schema(changes.SNAPSHOT).parquet(self._state(root, last, "inputs")) if last else None
        changes.snapshot(spark, paths, earlier).write.parquet(self._state(root, this, "inputs"))
        versions = changes.file_versions(spark.read.schema(changes.SNAPSHOT).parquet(self._state(root, this, "inputs")))
        before = spark.read.schema(FILES_SCHEMA).parquet(self._state(root, last, "files")) if last else spark.createDataFrame([], FILES_SCHEMA)
        too_old = F.col("at") <= F.current_timestamp() - F.expr(f"interval {CACHE_DAYS} days")
        changes.change_set(before, versions, F.col("status") == FAILED, too_old).write.parquet(self._state(root, this, "changes"))
        found = spark.read.parquet(self._state(root, this, "changes"))
        counts = {r.change: r.n for r in found.groupBy("change").agg(F.count(F.lit(1)).alias("n")).collect()}
        if last and set(counts) <= {changes.SAME}:
            delete_path(spark, self._state(root, this))
            return SKIPPED, {}
        by_file = self.by_file and all("file_id" in t.columns for t in tables.values())
        partly = by_file and changes.SAME in counts
        todo = found.where(~F.col("change").isin(changes.SAME, changes.REMOVED))
        gone = found.where(F.col("change") != changes.SAME)
        staged = self._state(root, this, "staged")
        schema, bad = self._stage(spark, {p: _among(t, todo, "left_semi") for p, t in tables.items()} if partly else tables, staged, parameters, by_file)
        self._replace(spark, root, staged, schema, gone if partly else None)
        reasons = spark.createDataFrame(list(bad.items()), "__bad string, problem string")
        done = found.where(F.col("change") != changes.REMOVED).join(before.select(F.col("file_id").alias("__id"), F.col("at").alias("__at")), F.col("file_id").eqNullSafe(F.col("__id")), "left")
        done = done.join(F.broadcast(reasons) if len(bad) <= MOST_SOUGHT else reasons, F.col("file_id") == F.col("__bad"), "left")
        done = done.select("file_id", "version", F.when(F.col("__bad").isNotNull(), FAILED).otherwise(SUCCESS).alias("status"), "problem", F.when(F.col("change") == changes.SAME, F.col("__at")).otherwise(F.current_timestamp()).alias("at"))
        done.write.parquet(self._state(root, this, "files"))
        for table in ("changes", "staged"):
            delete_path(spark, self._state(root, this, table))
        return (PARTIAL if bad else SUCCESS), bad

    def _stage(self, spark: SparkSession, tables: dict[str, DataFrame], path: str, parameters: dict, by_file: bool) -> tuple[StructType, dict[str, str]]:
        """Write what good recordings give to ``path``: (its schema, the other recordings with their reasons)."""
        with collected_problems(spark) as problems:
            try:
                schema = self._store(tables, path, parameters, "overwrite")
                bad = problems()
            except (PySparkException, ValueError) as e:
                if not by_file:
                    raise
                delete_path(spark, path)
                schema, bad = self._isolate(spark, tables, path, parameters, e)
                bad = problems() | bad
        if bad and not by_file:
            raise ValueError(next(iter(bad.values())))
        if bad and _stored(spark, path, schema).isEmpty():
            raise ValueError(f"{len(bad)} recordings failed and no other gave a result: {next(iter(bad.values()))}")
        return schema, bad

    def _store(self, tables: dict[str, DataFrame], path: str, parameters: dict, mode: str) -> StructType:
        out = self.transform(**tables, **parameters)
        if self.validate is not None:
            self.validate(out)
        if "file_id" in out.columns and self.by_file:
            # Large folders may be written by several tasks, small ones by one.
            out = out.withColumn(PART_COLUMN, _part())
            out.hint("rebalance", PART_COLUMN).write.mode(mode).partitionBy(PART_COLUMN).parquet(path)
        else:
            out.write.mode(mode).parquet(path)
        return out.schema

    def _isolate(self, spark: SparkSession, tables: dict[str, DataFrame], path: str, parameters: dict, first: Exception) -> tuple[StructType, dict[str, str]]:
        """Stage the good recordings of a run that failed as a whole, part by part; the bad ones with their reasons.

        Raises if only all together fail, or if the first parts fail one and all.
        """
        files = None
        for t in tables.values():
            own = t.select(F.col("file_id").cast("string").alias("file_id"))
            files = own if files is None else files.union(own)
        bad: dict[str, str] = {}
        schema, tries, error = None, 0, first
        parts = [(2, 1), (2, 0)]  # recordings whose hashed id leaves the second number modulo the first
        while parts:
            modulus, rest = parts.pop()
            here = F.pmod(F.xxhash64(F.col("file_id").cast("string")), F.lit(modulus)) == rest
            try:
                schema = self._store({p: t.where(here) for p, t in tables.items()}, path, parameters, "append")
                continue
            except (PySparkException, ValueError) as e:
                error, tries = e, tries + 1
            if len(bad) >= MOST_SOUGHT or (tries >= MOST_TRIES and schema is None):
                raise ValueError(f"too many recordings fail: {_reason(error)}")
            names = [r.file_id for r in files.where(here).distinct().limit(2).collect()]
            if len(names) == 1 or modulus >= MOST_PARTS:
                bad |= {str(n): _reason(error) for n in names}
            else:
                parts += [(2 * modulus, rest), (2 * modulus, rest + modulus)]
        if not bad or schema is None:
            raise first
        return schema, bad

    def _replace(self, spark: SparkSession, root: str, staged: str, schema: StructType, gone: DataFrame | None) -> None:
        """Put staged results in place of those of the recordings in ``gone`` (None: of all)."""
        target = key_path(root, self.output_key)
        fresh = _stored(spark, staged, schema)
        if PART_COLUMN in fresh.columns and fresh.isEmpty():
            # Folders without files tell no schema, so an empty result is written as one.
            delete_path(spark, staged)
            spark.createDataFrame([], schema).drop(PART_COLUMN).write.parquet(staged)
        old = spark.read.parquet(target) if gone is not None else None
        if old is None or PART_COLUMN not in old.columns:
            delete_path(spark, target)
            move_path(spark, staged, target)
            return
        touched = [r[0] for r in gone.select(_part()).distinct().collect()]  # PARTS at most
        rest = _among(old.where(F.col(PART_COLUMN).isin(touched)), gone, "left_anti")
        whole = rest.unionByName(fresh, allowMissingColumns=True)
        whole.hint("rebalance", PART_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART_COLUMN).parquet(target)
        # A folder all of whose recordings are gone is not written, so it is deleted.
        full = {r[0] for r in fresh.select(PART_COLUMN).distinct().collect()}
        for part in set(touched) - full:
            if _among(spark.read.parquet(target).where(F.col(PART_COLUMN) == part), gone, "left_anti").isEmpty():
                delete_path(spark, f"{target}/{PART_COLUMN}={part}")


def in_order(operators: list[Operator]) -> list[Operator]:
    """Each operator after those whose results it reads, else as given; a circle raises."""
    makers = {op.output_key.strip("/"): op for op in operators}
    done: list[Operator] = []
    state: dict[str, int] = {}

    def visit(op: Operator) -> None:
        if state.get(op.name) == 2:
            return
        if state.get(op.name) == 1:
            raise ValueError(f"{op.name} needs its own result")
        state[op.name] = 1
        for key in op.inputs.values():
            if key.strip("/") in makers:
                visit(makers[key.strip("/")])
        state[op.name] = 2
        done.append(op)

    for op in operators:
        visit(op)
    return done


def run_all(spark: SparkSession, root: str, operators: list[Operator], forced: bool = False, stop: bool = False, at_once: int = 4) -> list[tuple[str, str, str | None]]:
    """(operator, status, problem) of each operator, in the order of their inputs.

    Up to ``at_once`` operators whose inputs are ready run at the same time, each with its jobs under
    a tag. A failure does not stop the others unless asked; then running jobs are cancelled and what
    has not begun is not reported.
    """
    ordered = in_order(operators)
    makers = {op.output_key.strip("/"): op.name for op in ordered}
    needs = {op.name: {makers[k.strip("/")] for k in op.inputs.values() if k.strip("/") in makers} for op in ordered}
    tag = f"somatiq-{uuid.uuid4().hex}"
    context = spark.sparkContext
    done: dict[str, tuple[str, str | None]] = {}

    def work(op: Operator) -> tuple[str, str | None]:
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)  # cancelled tasks leave their slots at once
        try:
            return op.run(spark, root, forced)
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        waiting, running = list(ordered), {}
        stopped = False
        while running or (waiting and not stopped):
            for op in [op for op in waiting if needs[op.name] <= set(done)] if not stopped else []:
                if len(running) < max(1, at_once):
                    waiting.remove(op)
                    running[pool.submit(inheritable_thread_target(spark)(work), op)] = op
            ended: set[Future] = wait(running, timeout=1 if stopped else None, return_when=FIRST_COMPLETED).done
            if stopped:  # again, as an operator may have begun another job since
                context.cancelJobsWithTag(tag)
            for future in ended:
                op = running.pop(future)
                done[op.name] = future.result()
                if stop and done[op.name][0] == FAILED and not stopped:
                    stopped = True
                    context.cancelJobsWithTag(tag)
    return [(op.name, *done[op.name]) for op in ordered if op.name in done]

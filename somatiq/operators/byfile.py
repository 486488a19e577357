"""Kernels over whole recordings: enough tasks, and one recording in memory at a time.

Recordings are dealt by hash into an explicit number of partitions, which adaptive execution does
not coalesce (a recording is little data and much work), sorted inside, and handed to the kernel one
by one. A kernel that raises fails its task, unless the caller collects problems: then the recording
gives no rows and its reason is noted, so one pass over the data finds all bad recordings.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import AccumulatorParam
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Reasons that are kept for the caller; more failing recordings are only counted.
MOST_REASONS = 1000
#: The collector of the calling thread.
_here = threading.local()


class _Reasons(AccumulatorParam):
    """A bounded table of reasons by recording, and whether there were more."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, value1: dict, value2: dict) -> dict:  # noqa: N802 (Spark's name)
        for key, reason in value2.items():
            if len(value1) <= MOST_REASONS or key in value1:
                value1[key] = reason
        return value1


@contextlib.contextmanager
def collected_problems(spark: SparkSession) -> Iterator[Callable[[], dict[str, str]]]:
    """While it lasts, recordings whose kernels raise are left out; yields a function that tells them with their reasons.

    Reasons of actions that have ended are told; a task that ran twice tells the same again.
    """
    found = spark.sparkContext.accumulator({}, _Reasons())
    outer = getattr(_here, "collector", None)
    _here.collector = found
    try:
        yield lambda: dict(found.value)
    finally:
        _here.collector = outer


def _starts(columns: list[pa.Array]) -> np.ndarray:
    """Where rows differ from the one before in some column (nulls agree), without the first row."""
    change = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns:
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        change |= codes[1:] != codes[:-1]
    return np.flatnonzero(change) + 1


def groups_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``by`` (nulls agree), from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = [batch.column(c) for c in by]
        if held and tuple(k[0].as_py() for k in keys) != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *_starts(keys).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < n:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(k[n - 1].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of at least ``rows`` rows (the last may have fewer) that split no run of rows that agree in ``by``, each with the places where its runs start."""
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _starts([table.column(c).combine_chunks() for c in by])
        return table, np.concatenate([[0], starts])

    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= rows:
            keys = [batch.column(c) for c in by]
            first = all(k.slice(0, 1) == held[-1].column(c).slice(held[-1].num_rows - 1, 1) for k, c in zip(keys, by, strict=True))
            cuts = [*([] if first else [0]), *_starts(keys).tolist()[:1]]
            if cuts:
                held.append(batch.slice(0, cuts[0]))
                yield whole()
                batch = batch.slice(cuts[0])  # noqa: PLW2901
                held, size = [], 0
        held.append(batch)
        size += batch.num_rows
    if held:
        yield whole()


def arrays_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[list[pa.Array], dict[str, np.ndarray]]]:
    """(keys, each one row; the other columns as arrays, missing numbers NaN) of each such run, without an object per run and column."""
    names: list[str] = []
    held: list[dict[str, np.ndarray]] = []
    last: list[pa.Array] = []

    def whole() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in names}

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = [batch.column(c) for c in by]
        names = [c for c in batch.schema.names if c not in by]
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held and any(k.slice(0, 1) != x for k, x in zip(keys, last, strict=True)):
            yield last, whole()
            held = []
        cuts = [0, *_starts(keys).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append({c: v[a:b] for c, v in columns.items()})
            last = [k.slice(a, 1) for k in keys]
            if b < n:
                yield last, whole()
                held = []
    if held:
        yield last, whole()


def tasks_for(table: DataFrame) -> int:
    """As many partitions as the session deals a shuffle to."""
    conf = table.sparkSession.conf
    return int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))


#: A kernel: the columns of a recording (without its keys, sorted by time) to the columns of its result, arrays or single values.
Kernel = Callable[[dict[str, np.ndarray]], dict]


def by_file(table: DataFrame, run: Kernel, schema: str, order: str = "ts", keys: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """Keys, and what ``run`` gives for each recording, as ``schema`` says; NaN and missing columns are NULL.

    ``run`` gets the other columns in the order of ``order``; a table that is dealt by the keys
    already is not dealt again.
    """
    problems = getattr(_here, "collector", None)
    target = table.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target)
    by = list(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[pa.Array], int, dict]] = []
        rows = 0

        def told() -> Iterator[pa.RecordBatch]:
            sizes = np.array([n for _, n, _ in held])
            where = pa.array(np.repeat(np.arange(len(held)), sizes))
            columns = []
            for field in arrow:
                if field.name in by:
                    columns.append(pa.concat_arrays([k[by.index(field.name)] for k, _, _ in held]).cast(field.type).take(where))
                elif all(field.name not in got for _, _, got in held):
                    columns.append(pa.nulls(rows, field.type))
                else:
                    parts = [np.broadcast_to(np.asarray(got[field.name] if got[field.name] is not None else np.nan), n) for _, n, got in held]
                    columns.append(pa.array(np.concatenate(parts), from_pandas=True).cast(field.type, safe=False))
            yield from pa.Table.from_arrays(columns, schema=arrow).combine_chunks().to_batches(max_chunksize=1 << 16)

        for key, columns in arrays_of(batches, by):
            try:
                got = run(columns)
                n = max((len(v) if np.ndim(v) else 1 for v in got.values()), default=0)
            except Exception as e:
                if problems is None:
                    raise
                problems.add({str(key[0][0].as_py()): f"{type(e).__name__}: {e}"[:500]})
                continue
            if n and all(len(v) for v in got.values() if np.ndim(v)):
                held.append((key, n, got))
                rows += n
            if rows >= 1 << 16:
                yield from told()
                held, rows = [], 0
        if held:
            yield from told()

    dealt = table.repartition(tasks_for(table), *(F.col(k) for k in by)).sortWithinPartitions(*by, order)
    return dealt.mapInArrow(work, target)

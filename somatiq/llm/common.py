"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    A session on one machine (local mode: tests, notebooks) may leave it unset and gets a folder of
    its own; on a cluster that is an error, since a local folder is another one on each machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="checkpoints-")
    atexit.register(shutil.rmtree, path, True)
    return path


def durable(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike an executor-local copy, the files outlive any executor, and the reread table has a
    known size, so that joins with it are planned from figures and not from guesses. The files
    are deleted when the application ends (results are lazy and read them) or by :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.durable_path = path
    store, target = _stored(spark, path)
    store.deleteOnExit(target)
    return out


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which is deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    store, target = _stored(spark, path)
    store.mkdirs(target)
    store.deleteOnExit(target)
    return path


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that :func:`durable` wrote, once what was made of them is written itself."""
    for df in tables:
        if df is not None:
            store, target = _stored(df.sparkSession, df.durable_path)
            store.delete(target, True)


def _stored(spark: SparkSession, path: str) -> tuple:
    """The file system of a path (any that Spark knows), and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def with_row_numbers(docs: DataFrame, name: str = "__row") -> DataFrame:
    """Adds a number to each row that every scan of the table gives alike.

    A stored table's rows have their file's rank and their place in it, which no other split of
    the work changes; any other table is written with numbers.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
        placed.schema  # noqa: B018 (resolves the columns)
    except AnalysisException:
        return durable(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    files = placed.select("__file").distinct().withColumn("__rank", F.row_number().over(Window.orderBy("__file")) - 1)
    # A row a file: so few that one task may rank them.
    return placed.join(durable(files, "files"), "__file").select(*docs.columns, (F.col("__rank").cast("long") * (1 << 40) + F.col("__place")).alias(name))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns of these names, in any case of letters."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def crc32_mod(col: Column, n: int) -> Column:
    """crc32 of the decimal text of an id, modulo n (null id: of the empty text)."""
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)).cast("int")


def crc32_of(text: bytes) -> int:
    return zlib.crc32(text)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of an Arrow batch: whole texts are long, and a batch stands in memory on both sides.
BATCH_ROWS = 500


def small_batches(df: DataFrame) -> DataFrame:
    """The table, with the session set to send at most BATCH_ROWS rows to Python in one batch.

    Spark plans a lazy result after the call returns, so this has to be a session setting. It only
    ever lowers the number of rows, which changes no result.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1_000_000, most_rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole rows of about ``most_bytes`` of text (one row may be longer).

    Yields (rows, bytes, offsets); null texts count as empty.
    """
    texts = batch.column(column).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] is not None and offsets[-1] > 0 else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        to = min(to, at + most_rows)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    del texts, data
    give_back()


@functools.cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # not this C library
        return lambda _: 0


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, and share a machine."""
    pa.default_memory_pool().release_unused()
    _trim()(0)

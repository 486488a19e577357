"""Sources: files by pattern, keyed datasets, JSON documents, catalogs, URLs."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import parse_qs, unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Column that deals a dataset's recordings to folders, so that a few of them can be replaced.
PART_COLUMN = "file_part"


def list_files(spark: SparkSession, base: str, pattern: str = "*", limit: int | None = None) -> DataFrame:
    """path, length, modified of files under a folder, ordered by path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(base).select("path", "length", F.col("modificationTime").alias("modified")).orderBy("path")
    return found.limit(limit) if limit is not None else found


def retrieve(spark: SparkSession, base: str, catalog: DataFrame, pattern: str = "*") -> DataFrame:
    """file_id, path, fresh: local copies of catalog files (file_id, filename, checksum), and whether they are the catalog's.

    Content is hashed where it is read; only names and digests are joined.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(base)
    local = found.select("path", F.substring_index("path", "/", -1).alias("__name"), F.md5("content").alias("__md5"))
    return catalog.join(local, F.col("filename") == F.col("__name"), "left").select("file_id", "path", F.coalesce(F.col("__md5") == F.col("checksum"), F.lit(False)).alias("fresh"))


def key_parts(key: str) -> dict[str, str | None]:
    """source, type, modality and name of a key /source/type[/modality]/name."""
    parts = [p for p in key.split("/") if p]
    if not 3 <= len(parts) <= 4:
        raise ValueError(f"not a key: {key}")
    return {"source": parts[0], "type": parts[1], "modality": parts[2] if len(parts) == 4 else None, "name": parts[-1]}


def key_path(root: str, key: str) -> str:
    """Where a key's dataset lies; annotations lie beside the dataset they belong to, not inside it."""
    key = key.strip("/")
    return f"{root.rstrip('/')}/" + (key[: -len("/annotations")] + ".annotations" if key.endswith("/annotations") else key)


def read_key(spark: SparkSession, root: str, key: str) -> DataFrame | None:
    """The dataset of a key, or None if there is none."""
    try:
        return spark.read.parquet(key_path(root, key)).drop(PART_COLUMN)
    except AnalysisException:
        return None


def key_exists(spark: SparkSession, root: str, key: str) -> bool:
    return read_key(spark, root, key) is not None


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_document(spark: SparkSession, path: str) -> dict:
    """One JSON document, through Spark's readers."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def store_responses(spark: SparkSession, fetch: Callable[[int, str | None], dict], path: str, page_size: int = 1000) -> int:
    """Walk a paged source backwards and store each page under ``path``; the number of pages.

    fetch(page_size, before) gives a page whose ``items`` are older than the token ``before``
    (None: the newest). The cursor makes this one request after the other; the driver holds one
    page at a time, and everything else is done on the stored pages.
    """
    page_size = min(max(page_size, 100), 1000)
    before, pages = None, 0
    while items := (page := fetch(page_size, before)).get("items") or []:
        spark.createDataFrame([(json.dumps(page),)], "value string").coalesce(1).write.mode("append").text(path)
        pages += 1
        last, before = before, items[-1].get("token")
        if before is None or before == last or len(items) < page_size:
            break
    return pages


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages of questionnaire responses: those with answers, each token once."""
    pages = spark.read.option("multiLine", True).json(path)
    rows = pages.select(F.explode("items").alias("i")).select("i.*") if "items" in pages.columns else pages
    return rows.where("answers is not null").dropDuplicates(["token"])


def parse_url(url: str) -> dict[str, str]:
    """Where data lies: ``file://folder`` or ``catalog://?query=...``; other schemes raise."""
    parts = urlparse(url)
    if parts.scheme == "file":
        return {"scheme": "file", "path": unquote(parts.netloc + parts.path)}
    if parts.scheme == "catalog":
        return {"scheme": "catalog", "host": parts.netloc, **{k: v[-1] for k, v in parse_qs(parts.query).items()}}
    raise ValueError(f"unknown scheme in {url!r}")


def query_catalog(spark: SparkSession, sql: str, seed: int | None = None, limit: int | None = None, id_column: str = "file_id") -> DataFrame:
    """Rows of a catalog query; a seed shuffles before the limit; an empty query raises."""
    if not sql or not sql.strip():
        raise ValueError("empty query")
    rows = spark.sql(sql)
    rows = rows.orderBy(F.xxhash64(F.col(id_column), F.lit(seed))) if seed is not None else rows.orderBy(id_column)
    return rows.limit(limit) if limit is not None else rows


def open_dataset(spark: SparkSession, source: str, **options) -> DataFrame:
    """The one table of inputs, from local files or from the catalog."""
    if source == "local":
        return list_files(spark, options["base"], options.get("pattern", "*"), options.get("limit"))
    if source == "catalog":
        return query_catalog(spark, options["sql"], options.get("seed"), options.get("limit"))
    raise ValueError(f"unknown source {source!r}")

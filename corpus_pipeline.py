"""From raw documents to packed sequences: five stages, each one operator over all it is given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somatiq.llm import jaccard, mixing, packing, quality, toxicity
from somatiq.llm.common import crc32_mod, durable, read, with_row_numbers
from somatiq.llm.queries import CUT, QUALITY_FOLDS, QUALITY_HELD, TOXIC_FOLDS, TOXIC_HELD, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut."""
    model = toxicity.train_toxicity(docs, read(spark, sf_dir, "labels"), crc32_mod(F.col("label_id"), TOXIC_FOLDS) != TOXIC_HELD)
    return toxicity.score_toxicity(docs, model, name="__score").where(F.col("__score") < CUT).select(docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    model = quality.train_quality(docs, read(spark, sf_dir, "labels"), crc32_mod(F.col("label_id"), QUALITY_FOLDS) != QUALITY_HELD)
    return quality.score_quality(docs, model, name="__score").where(F.col("__score") >= CUT).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each near-duplicate group; ids may repeat or be null (null is the greatest)."""
    rows = with_row_numbers(docs)
    told = jaccard.jaccard_components(rows, percent=80, k=5, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")).alias("first")
    chosen = told.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(first).select("first.__row")
    # Joined alike at every size: what is sent to all tasks must not grow with the documents.
    return rows.join(durable(chosen, "pipeline-chosen").hint("merge"), "__row", "left_semi").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: taken words over its size, rounded (0, 1 or 2 rows)."""
    rows = with_row_numbers(docs)
    mixed = mixing.mix_sources(rows, weights=(3, 1, 2), share=1.5, most=2.0, keep=("__row",))
    times = mixed.select("__row", F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int").alias("__times")).where("__times > 0")
    joined = rows.join(durable(times, "pipeline-times").hint("merge"), "__row")
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return packing.pack_documents(docs, tokenizer_path(), window=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("jaccard_join", one_of_each),
    ("mixing", mix),
    ("packing", pack),
]
#: The stages learn models; tests hold them against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

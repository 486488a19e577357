"""Survey reports inside sessions, and their grouped averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the layout of a survey report's data.
REPORT = "struct<survey_index:int,report:array<struct<item_time:double,item_index:int,item_key:string,item_text:string,answer_default:double,answer_ticks:array<struct<time:double,value:double>>,answer_final:double,answer_time:double,answer_completion:boolean>>>"
#: References that each group of survey features averages.
META_GROUPS = {
    "stress_gestion": ["space-stress-0-0", "space-stress-1-0", "space-stress-0-2", "space-stress-1-2", "space-stress-0-4", "space-stress-1-4", "cardiac-coherence-1-4"],
    "concentration": ["space-stress-0-5", "space-stress-1-5", "cardiac-coherence-1-2", "physio-sonification-0-1"],
    "self_efficacity": ["space-stress-0-2", "space-stress-1-2", "space-stress-0-6", "space-stress-1-6"],
    "reactivity": ["cardiac-coherence-1-4"],
    "interoception": ["physio-sonification-0-0", "physio-sonification-0-2", "physio-sonification-0-3"],
}


def report_features(events: DataFrame) -> DataFrame:
    """file_id, id (answerFinal, answerDuration), reference module-survey-item, value, from standard events."""
    told = events.where(F.col("id").contains("survey_reports")).select("file_id", F.split("id", "_")[1].alias("module"), F.from_json("data", REPORT).alias("d"))
    items = told.select("file_id", "module", F.col("d.survey_index").alias("survey"), F.explode("d.report").alias("item"))
    reference = F.concat_ws("-", "module", F.col("survey") - 1, "item.item_index")
    flat = items.select("file_id", reference.alias("reference"), F.col("item.answer_final").alias("answerFinal"), F.col("item.answer_time").alias("answerDuration"))
    return flat.unpivot(["file_id", "reference"], ["answerFinal", "answerDuration"], "id", "value")


def meta_features(features: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """file_id, id, reference vr-meta-<group>, value: means over the references of each group."""
    spark = features.sparkSession
    table = spark.createDataFrame([(f"vr-meta-{g}", r) for g, refs in (META_GROUPS if groups is None else groups).items() for r in refs], "meta string, ref string")
    return features.join(F.broadcast(table), F.col("reference") == F.col("ref")).groupBy("file_id", "id", F.col("meta").alias("reference")).agg(F.avg("value").alias("value"))

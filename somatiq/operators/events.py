"""Event standardisation and sequence extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import number_occurrences, pair_markers

#: The sequences that a session may have.
KNOWN_SEQUENCES = (
    "session_sequence_0", "intro_sequence_0", "intro_calibration_0", "intro_disclaimer_0", "intro_omi-logo_0", "lobby_sequence_0", "lobby_sequence_1", "lobby_sequence_2",
    "baseline_sequence_0", "baseline_sequence_1", "baseline_sequence_2", "baseline_sequence_3", "baseline_eyes-opened_0", "baseline_eyes-opened_1",
    "baseline_eyes-opened_2", "baseline_eyes-opened_3", "baseline_eyes-closed_0", "common_respiration-calibration_data-accumulation_0", "physio-sonification_sequence_0",
    "physio-sonification_playground_0", "physio-sonification_survey_0", "physio-sonification_cardiac-feedback_0", "physio-sonification_coherence-feedback_0",
    "physio-sonification_respiration-feedback_0", "cardiac-coherence_sequence_0", "cardiac-coherence_survey_0", "cardiac-coherence_survey_1", "cardiac-coherence_score_0",
    "cardiac-coherence_coherence-feedback_0", "cardiac-coherence_data-accumulation_0", "space-stress_sequence_0", "space-stress_intro_0", "space-stress_outro_0",
    "space-stress_survey_0", "space-stress_survey_1", "space-stress_graph_0", "space-stress_graph_1", "space-stress_game_0", "space-stress_game_1",
    "space-stress_game-tutorial_0", "space-stress_game_enemy-wave_0", "space-stress_game_enemy-wave_1", "space-stress_game_enemy-wave_2",
    "space-stress_game_enemy-wave_3", "space-stress_game_enemy-wave_4", "space-stress_game_enemy-wave_5", "space-stress_breath-tutorial_0",
)
#: Fixed value: sequences that electrodermal features leave out.
NOT_FOR_GSR = ".*(intro|outro|lobby).*"


def known_sequence_ids() -> list[str]:
    return list(KNOWN_SEQUENCES)


def marker_name(label: str = "label") -> Column:
    """The name that a ``*_begins`` or ``*_ends`` label marks."""
    return F.regexp_replace(F.col(label), "_(begins|ends)$", "")


def extract_sequences(events: DataFrame, known: list[str] | None = None, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """file_id, name, id, begin, end of complete ``*_begins`` / ``*_ends`` pairs, known ids only if given."""
    got = pair_markers(events, F.col("label").endswith("_begins"), F.col("label").endswith("_ends"), marker_name(), order)
    return got.where(F.col("id").isin(known)) if known is not None else got


def standardize(events: DataFrame, sequences: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Point events (id label_k, open end) and sequences as one standard event table."""
    points = number_occurrences(events, "label", order).select("file_id", "id", F.col("label").alias("name"), F.col("ts").alias("begin"), F.lit(None).cast("timestamp_ntz").alias("end"), "data")
    segments = sequences.select("file_id", "id", "name", "begin", "end", F.lit(None).cast("string").alias("data"))
    return points.unionByName(segments)


def session_sequences(samples: DataFrame) -> DataFrame:
    """One segment per file and one per file and day, from first to last sample."""
    whole = samples.groupBy("file_id").agg(F.min("ts").alias("begin"), F.max("ts").alias("end")).select("file_id", F.lit("session").alias("name"), F.lit("session_0").alias("id"), "begin", "end")
    day = F.unix_date(F.col("ts").cast("date"))
    days = samples.groupBy("file_id", day.alias("d")).agg(F.min("ts").alias("begin"), F.max("ts").alias("end")).select("file_id", F.lit("day").alias("name"), F.concat_ws("_", F.lit("day"), "d").alias("id"), "begin", "end")
    return whole.unionByName(days)


def verify_order(events: DataFrame) -> DataFrame:
    """file_id, monotonic: whether rows in their stored order (column row) have ascending times."""
    w = Window.partitionBy("file_id").orderBy("row")
    return events.select("file_id", (F.lag("ts").over(w) <= F.col("ts")).alias("ok")).groupBy("file_id").agg(F.every(F.coalesce("ok", F.lit(True))).alias("monotonic"))

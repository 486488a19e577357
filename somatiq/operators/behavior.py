"""Game behaviour: actions, spawns, trajectories, transition matrices, wave features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import grid_bin, json_field
from ..functions.timing import seconds_between

#: Labels of the game's events.
PUSH, ENEMY, BREACH = "unity_space-stress_game_participant_pushes_button", "unity_space-stress_game_enemy_spawns", "unity_space-stress_game_breach_spawns"
GAME, WAVE = "space-stress_sequence", "space-stress_game_enemy-wave"
#: States of an action.
ACTION_STATES = ("trigger_succeed", "trigger_failed", "pad_succeed", "pad_failed")
#: Reason of a failure by button and result.
FAILURES = {("pad", "wrong_button"): "finger_confusion", ("trigger", "wrong_button"): "finger_confusion", ("pad", "no_target"): "bad_precision", ("trigger", "no_target"): "bad_precision", ("pad", "too_early"): "bad_planification", ("trigger", "too_early"): "bad_planification", ("pad", "too_late"): "bad_planification", ("trigger", "too_late"): "bad_planification"}


def trajectory_length(points: DataFrame, by: tuple[str, ...] = ("file_id",), order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Adds the distance to the previous point of the same group in the x-y plane."""
    w = Window.partitionBy(*by).orderBy(*order)
    dx, dy = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    return points.withColumn("trajectory_length", F.sqrt(dx * dx + dy * dy))


def participant_actions(events: DataFrame, sequences: DataFrame) -> DataFrame:
    """file_id, ts, button, x, y, z, action_succeed, failure_reason, trajectory_length inside the game's first sequence.

    Pad pushes without any effect (result exactly action_failed) are left out.
    """
    game = sequences.where((F.col("name") == GAME) & F.col("id").endswith("_0")).select(F.col("file_id").alias("__f"), "begin", "end")
    d = F.col("data")
    pushes = events.where(F.col("label") == PUSH).select("file_id", "ts", json_field(d, "button").alias("button"), *[json_field(d, c).cast("double").alias(c) for c in "xyz"], json_field(d, "result.action").alias("action"))
    inside = pushes.join(game, (F.col("file_id") == F.col("__f")) & F.col("ts").between(F.col("begin"), F.col("end"))).drop("__f", "begin", "end")
    kept = inside.where(~((F.col("button") == "pad") & (F.col("action") == "action_failed")))
    reason = F.create_map(*[x for (b, a), r in FAILURES.items() for x in (F.lit(f"{b}:{a}"), F.lit(r))])[F.concat_ws(":", "button", "action")]
    return trajectory_length(kept.withColumns({"action_succeed": F.col("action").contains("succeed"), "failure_reason": reason}).drop("action"))


def spawn_stimulations(events: DataFrame, sequences: DataFrame) -> DataFrame:
    """file_id, ts, type, id, x, y, z, trajectory_length of enemies and breaches inside the game's first sequence."""
    game = sequences.where((F.col("name") == GAME) & F.col("id").endswith("_0")).select(F.col("file_id").alias("__f"), "begin", "end")
    d = F.col("data")
    spawns = events.where(F.col("label").isin(ENEMY, BREACH)).select("file_id", "ts", F.when(F.col("label") == ENEMY, F.lit("enemy")).otherwise(F.lit("breach")).alias("type"), json_field(d, "id").try_cast("int").alias("id"), *[json_field(d, c).cast("double").alias(c) for c in "xyz"])
    inside = spawns.join(game, (F.col("file_id") == F.col("__f")) & F.col("ts").between(F.col("begin"), F.col("end"))).drop("__f", "begin", "end")
    return trajectory_length(inside)


def transition_counts(states: DataFrame, by: tuple[str, ...] = ("file_id",), order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """by, state, prev_state, n: how often each state follows each other one."""
    w = Window.partitionBy(*by).orderBy(*order)
    return states.withColumn("prev_state", F.lag("state").over(w)).where("prev_state is not null").groupBy(*by, "state", "prev_state").agg(F.count(F.lit(1)).alias("n"))


def transition_probabilities(counts: DataFrame, by: tuple[str, ...] = ("file_id",), normalize: str = "index") -> DataFrame:
    """Adds p: n over the total of the state (index), of the previous state (columns), or of all."""
    keys = {"index": [*by, "state"], "columns": [*by, "prev_state"], "all": list(by)}
    return counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(*keys[normalize])))


def complete_matrix(probabilities: DataFrame, states: list[str], by: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """All pairs of the given states for each group, absent ones with p 0 (the domain is a fixed short list)."""
    spark = probabilities.sparkSession
    domain = spark.createDataFrame([(a, b) for a in states for b in states], "state string, prev_state string")
    groups = probabilities.select(*by).distinct()
    return groups.join(F.broadcast(domain)).join(probabilities.select(*by, "state", "prev_state", "p"), [*by, "state", "prev_state"], "left").withColumn("p", F.coalesce("p", F.lit(0.0)))


def transition_trace(probabilities: DataFrame, n_states: int, by: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """by, trace: the diagonal of the matrix scaled so that all its entries sum to the number of states."""
    same = F.sum(F.when(F.col("state") == F.col("prev_state"), F.col("p")).otherwise(0.0))
    return probabilities.groupBy(*by).agg((F.try_divide(same, F.sum("p")) * n_states).alias("trace"))


def switches(counts: DataFrame, by: tuple[str, ...] = ("file_id",)) -> DataFrame:
    return counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col("state") != F.col("prev_state"), F.col("n"))), F.lit(0)).alias("switch_actions"))


def space_states(points: DataFrame, x_lim: tuple[float, float] = (-3, 3), columns: int = 3, y_lim: tuple[float, float] = (1, 4), rows: int = 2) -> DataFrame:
    """Adds the grid cell ``(i, j)`` as state; points outside the limits are left out."""
    inside = F.col("x").between(*x_lim) & F.col("y").between(*y_lim)
    return points.where(inside).withColumn("state", F.format_string("(%d, %d)", grid_bin(F.col("x"), *x_lim, columns), grid_bin(F.col("y"), *y_lim, rows)))


def action_states(actions: DataFrame) -> DataFrame:
    known = actions.where("button is not null and action_succeed is not null")
    return known.withColumn("state", F.concat_ws("_", "button", F.when(F.col("action_succeed"), "succeed").otherwise("failed")))


def _game_events(events: DataFrame, sequences: DataFrame, waves: DataFrame) -> DataFrame:
    """Pushes and spawns inside the game's first sequence, and ends, each with its wave: one pass over the events.

    kind (push, spawn, end), the fields of participant_actions, difficulty, trajectory_length.
    """
    d = F.col("data")
    kind = F.when(F.col("label") == PUSH, "push").when(F.col("label").isin(ENEMY, BREACH), "spawn").when(F.col("label").contains("ends"), "end")
    game = sequences.where((F.col("name") == GAME) & F.col("id").endswith("_0")).select(F.col("file_id").alias("__f"), F.col("begin").alias("opens"), F.col("end").alias("closes"))
    # One exchange by file, before anything is parsed, serves all windows that follow.
    some = events.select("file_id", "ts", "data", kind.alias("kind")).where("kind is not null").repartition("file_id")
    told = some.select("file_id", "ts", "kind", json_field(d, "button").alias("button"), *[json_field(d, c).cast("double").alias(c) for c in "xy"], json_field(d, "result.action").alias("action"), json_field(d, "report.difficulty").cast("double").alias("difficulty"))
    placed = told.join(game, F.col("file_id") == F.col("__f"), "left").where((F.col("kind") == "end") | F.col("ts").between(F.col("opens"), F.col("closes"))).drop("__f", "opens", "closes")
    kept = placed.where(~F.coalesce((F.col("kind") == "push") & (F.col("button") == "pad") & (F.col("action") == "action_failed"), F.lit(False)))
    reason = F.create_map(*[x for (b, a), r in FAILURES.items() for x in (F.lit(f"{b}:{a}"), F.lit(r))])[F.concat_ws(":", "button", "action")]
    moved = trajectory_length(kept.withColumns({"action_succeed": F.col("action").contains("succeed"), "failure_reason": reason}), ("file_id", "kind"))
    return moved.withColumnRenamed("file_id", "__f").join(waves, (F.col("file_id") == F.col("__f")) & F.col("ts").between(F.col("begin"), F.col("end"))).drop("__f", "begin", "end")


def _trace(states: list[str], n_states: int, state: str, prev: str) -> Column:
    """The diagonal of the row-normalised transition matrix, scaled so that all entries sum to the number of states."""
    rows = [F.count_if((F.col(state) == s) & F.col(prev).isNotNull()) for s in states]
    stays = [F.count_if((F.col(state) == s) & (F.col(prev) == s)) for s in states]
    total = lambda columns: reduce(lambda a, b: a + b, columns)
    diagonal = total([F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)) for a, b in zip(stays, rows, strict=True)])
    return F.try_divide(diagonal, total([(r > 0).cast("double") for r in rows])) * n_states


def wave_features(events: DataFrame, sequences: DataFrame, wave: str = WAVE) -> DataFrame:
    """file_id, reference, id, value: thirteen features of each wave, long.

    The events meet the game and the waves once; each action then looks back, in one window, to the
    last one with a button, a known result, or a place on the grid (whose upper bounds are cells of
    their own), and one aggregate tells all.
    """
    waves = sequences.where(F.col("name") == wave).select("file_id", F.col("id").alias("reference"), "begin", "end")
    by = ["file_id", "reference"]
    found = _game_events(events, sequences, waves)
    x_lim, columns, y_lim, rows = (-3, 3), 3, (1, 4), 2
    push = F.col("kind") == "push"
    known = push & F.col("button").isNotNull() & F.col("action_succeed").isNotNull()
    inside = push & F.col("x").between(*x_lim) & F.col("y").between(*y_lim)
    noted = found.withColumns({
        "state": F.when(known, F.concat_ws("_", "button", F.when(F.col("action_succeed"), "succeed").otherwise("failed"))),
        "cell": F.when(inside, F.format_string("(%d, %d)", grid_bin(F.col("x"), *x_lim, columns), grid_bin(F.col("y"), *y_lim, rows))),
        "pressed": F.when(push, F.col("button")),
    })
    before = Window.partitionBy(*by).orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    looked = noted.withColumns({f"prev_{c}": F.last(c, ignorenulls=True).over(before) for c in ("state", "cell", "pressed")})
    one = lambda cond: F.count_if(push & cond).cast("double")
    counts = looked.groupBy(*by).agg(
        one(F.col("action_succeed")).alias("global_accuracy"), one(~F.col("action_succeed")).alias("global_inaccuracy"), one(F.col("failure_reason") == "bad_precision").alias("spatial_inaccuracy"), one(F.col("failure_reason") == "bad_planification").alias("temporal_inaccuracy"),
        one(F.col("failure_reason") == "finger_confusion").alias("coordination_inaccuracy"), one(F.col("button") == "pad").alias("pad_actions"), one(F.col("button") == "trigger").alias("trigger_actions"),
        F.count_if(F.col("pressed") != F.col("prev_pressed")).cast("double").alias("switch_actions"),
        F.sum(F.when(push, F.col("trajectory_length"))).alias("moved"), F.sum(F.when(F.col("kind") == "spawn", F.col("trajectory_length"))).alias("spawned"),
        F.min_by("difficulty", F.when(F.col("kind") == "end", F.col("ts"))).alias("performance"),
        _trace(list(ACTION_STATES), len(ACTION_STATES), "state", "prev_state").alias("actions_transition_trace"),
        _trace([f"({i}, {j})" for i in range(1, columns + 2) for j in range(1, rows + 2)], columns * rows, "cell", "prev_cell").alias("space_transition_trace"),
    )
    duration = seconds_between("begin", "end")
    zero = ("global_accuracy", "global_inaccuracy", "spatial_inaccuracy", "temporal_inaccuracy", "coordination_inaccuracy", "pad_actions", "trigger_actions", "switch_actions")
    told = waves.join(counts, by, "left").select(
        *by, "performance", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in zero],
        F.try_divide(F.coalesce("moved", F.lit(0.0)), duration).alias("participant_motion_tau"), F.try_divide(F.coalesce("spawned", F.lit(0.0)), duration).alias("information_motion_tau"), "actions_transition_trace", "space_transition_trace",
    )
    return told.unpivot(by, [c for c in told.columns if c not in by], "id", "value")

"""Queries over events, sequences, game behaviour and surveys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import behavior, eda, events, survey, validate
from ..operators.intervals import filter_sequences, number_occurrences, standard_order
from .catalogue import query
from .inputs import GAME_SQL, SEQ, SIG, game_events, game_sequences, r6, rounded, samples, sequences, us, visits

_POINTS = "points AS (SELECT file_id, label || '_' || (row_number() OVER (PARTITION BY file_id, label ORDER BY ts, event_id) - 1) AS id, label AS name, ts AS b, CAST(NULL AS TIMESTAMP) AS e, data FROM sig)"


@query(f"WITH {SIG}, {SEQ}, {_POINTS}, u AS (SELECT * FROM points UNION ALL SELECT file_id, id, name, b, e, NULL FROM seq) SELECT file_id, id, name, epoch_us(b) AS \"begin\", epoch_us(e) AS \"end\", data FROM u")
def events_standardize(spark: SparkSession, sf: str) -> DataFrame:
    got = events.standardize(samples(spark, sf), sequences(spark, sf), ("ts", "event_id"))
    return standard_order(got).select("file_id", "id", "name", us("begin"), us("end"), "data")


@query(f"WITH {SIG} SELECT file_id, event_id, label || '_' || (row_number() OVER (PARTITION BY file_id, label ORDER BY ts, event_id) - 1) AS id FROM sig")
def occurrence_ids(spark: SparkSession, sf: str) -> DataFrame:
    return number_occurrences(samples(spark, sf), "label", ("ts", "event_id")).select("file_id", "event_id", "id")


@query(f'WITH {SIG}, {SEQ} SELECT file_id, name, id, epoch_us(b) AS "begin", epoch_us(e) AS "end" FROM visits')
def sequences_extract(spark: SparkSession, sf: str) -> DataFrame:
    return visits(spark, sf).select("file_id", "name", "id", us("begin"), us("end"))


@query(f"""WITH {SIG}, m0 AS (SELECT file_id, ts, event_id, CASE label WHEN 'view' THEN 'baseline_sequence_begins' WHEN 'purchase' THEN 'baseline_sequence_ends' END AS label FROM sig),
    m AS (SELECT *, lead(label) OVER w AS nl, lead(ts) OVER w AS nt FROM m0 WHERE label IS NOT NULL WINDOW w AS (PARTITION BY file_id ORDER BY ts, event_id)),
    p AS (SELECT file_id, 'baseline_sequence' AS name, 'baseline_sequence_' || (row_number() OVER (PARTITION BY file_id ORDER BY ts) - 1) AS id, ts, nt FROM m WHERE label LIKE '%begins' AND nl LIKE '%ends')
    SELECT file_id, name, id, epoch_us(ts) AS "begin", epoch_us(nt) AS "end" FROM p WHERE id IN ('baseline_sequence_0', 'baseline_sequence_1', 'baseline_sequence_2', 'baseline_sequence_3')""")
def sequences_known(spark: SparkSession, sf: str) -> DataFrame:
    """Only occurrences that a session may have survive."""
    marked = samples(spark, sf).withColumn("label", F.when(F.col("label") == "view", "baseline_sequence_begins").when(F.col("label") == "purchase", "baseline_sequence_ends").otherwise(F.col("label")))
    got = events.extract_sequences(marked, events.known_sequence_ids(), ("ts", "event_id"))
    return got.select("file_id", "name", "id", us("begin"), us("end"))


@query(f"""WITH {SIG}, {SEQ} SELECT file_id, id, epoch_us(b) AS "begin", epoch_us(e) AS "end" FROM seq WHERE e IS NOT NULL AND NOT regexp_matches(id, '.*(day).*') AND id IN ('visit_0', 'visit_1', 'session_0')""")
def sequences_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_sequences(sequences(spark, sf), ["visit_0", "visit_1", "session_0"], ".*(day).*").select("file_id", "id", us("begin"), us("end"))


_G = f"WITH {GAME_SQL}"


@query(f"{_G} SELECT file_id, epoch_us(ts) AS ts, button, x, y, z, action_succeed, failure_reason, round(trajectory_length, 6) AS trajectory_length FROM actions")
def participant_actions(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.participant_actions(game_events(spark, sf), game_sequences(spark, sf)), "trajectory_length").withColumn("ts", us("ts"))


@query(f"{_G} SELECT file_id, epoch_us(ts) AS ts, type, id, x, y, z, round(trajectory_length, 6) AS trajectory_length FROM spawns")
def spawn_stimulations(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.spawn_stimulations(game_events(spark, sf), game_sequences(spark, sf)), "trajectory_length").withColumn("ts", us("ts"))


@query(f"{_G} SELECT file_id, round(sum(trajectory_length) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0), 9) AS tau FROM actions GROUP BY file_id")
def motion_tau(spark: SparkSession, sf: str) -> DataFrame:
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    a = behavior.participant_actions(game_events(spark, sf), game_sequences(spark, sf))
    return a.groupBy("file_id").agg(rounded(F.try_divide(F.sum("trajectory_length"), (F.max(t) - F.min(t)) / 1e6), 9).alias("tau"))


_TRANS = f"WITH {SIG}, t AS (SELECT file_id, label AS state, lag(label) OVER (PARTITION BY file_id ORDER BY ts, event_id) AS prev_state FROM sig), c AS (SELECT file_id, state, prev_state, count(*) AS n FROM t WHERE prev_state IS NOT NULL GROUP BY ALL)"


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.transition_counts(samples(spark, sf).withColumnRenamed("label", "state"), ("file_id",), ("ts", "event_id"))


@query(f"{_TRANS} SELECT file_id, state, prev_state, n FROM c")
def transition_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf)


@query(f"{_TRANS} SELECT file_id, state, prev_state, n, round(n / sum(n) OVER (PARTITION BY file_id, state), 6) AS p FROM c")
def transition_probs(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.transition_probabilities(_counts(spark, sf)), "p")


@query(f"{_TRANS} SELECT file_id, state, prev_state, n, round(n / sum(n) OVER (PARTITION BY file_id, prev_state), 6) AS p FROM c")
def transition_probs_columns(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.transition_probabilities(_counts(spark, sf), normalize="columns"), "p")


@query(f"{_TRANS}, q AS (SELECT *, n / sum(n) OVER (PARTITION BY file_id, state) AS p FROM c) SELECT file_id, round(sum(CASE WHEN state = prev_state THEN p ELSE 0 END) / sum(p) * 5, 6) AS trace FROM q GROUP BY file_id")
def transition_trace(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.transition_trace(behavior.transition_probabilities(_counts(spark, sf)), 5), "trace")


@query(f"{_TRANS} SELECT file_id, coalesce(sum(n) FILTER (state <> prev_state), 0)::BIGINT AS switch_actions FROM c GROUP BY file_id")
def switch_actions(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.switches(_counts(spark, sf))


_ACT = f"""{_G}, st AS (SELECT file_id, button || '_' || CASE WHEN action_succeed THEN 'succeed' ELSE 'failed' END AS state, ts FROM actions), t AS (SELECT file_id, state, lag(state) OVER (PARTITION BY file_id ORDER BY ts) AS prev_state FROM st),
    c AS (SELECT file_id, state, prev_state, count(*) AS n FROM t WHERE prev_state IS NOT NULL GROUP BY ALL), q AS (SELECT *, n / sum(n) OVER (PARTITION BY file_id, state) AS p FROM c)"""


@query(f"""{_ACT}, d AS (SELECT unnest(['trigger_succeed', 'trigger_failed', 'pad_succeed', 'pad_failed']) AS s)
    SELECT f.file_id, a.s AS state, b.s AS prev_state, round(coalesce(q.p, 0), 6) AS p FROM (SELECT DISTINCT file_id FROM q) f CROSS JOIN d a CROSS JOIN d b LEFT JOIN q ON q.file_id = f.file_id AND q.state = a.s AND q.prev_state = b.s""")
def action_transition_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of the four action states."""
    states = behavior.action_states(behavior.participant_actions(game_events(spark, sf), game_sequences(spark, sf)))
    return r6(behavior.complete_matrix(behavior.transition_probabilities(behavior.transition_counts(states)), list(behavior.ACTION_STATES)), "p")


@query(f"""{_G}, g AS (SELECT file_id, ts, '(' || CASE WHEN x >= 3 THEN 4 ELSE CAST(floor((x + 3) / 2) AS INT) + 1 END || ', ' || CASE WHEN y >= 4 THEN 3 ELSE CAST(floor((y - 1) / 1.5) AS INT) + 1 END || ')' AS state FROM actions WHERE x BETWEEN -3 AND 3 AND y BETWEEN 1 AND 4),
    t AS (SELECT file_id, state, lag(state) OVER (PARTITION BY file_id ORDER BY ts) AS prev_state FROM g), c AS (SELECT file_id, state, prev_state, count(*) AS n FROM t WHERE prev_state IS NOT NULL GROUP BY ALL)
    SELECT file_id, state, prev_state, n, round(n / sum(n) OVER (PARTITION BY file_id, state), 6) AS p FROM c""")
def space_grid_transitions(spark: SparkSession, sf: str) -> DataFrame:
    cells = behavior.space_states(behavior.participant_actions(game_events(spark, sf), game_sequences(spark, sf)))
    return r6(behavior.transition_probabilities(behavior.transition_counts(cells)), "p")


_IN = "JOIN waves w ON w.file_id = a.file_id AND a.ts BETWEEN w.b AND w.e"


def _trace(states: str, n: int, name: str) -> str:
    return f"""t_{name} AS (SELECT file_id, reference, state, lag(state) OVER (PARTITION BY file_id, reference ORDER BY ts) AS prev_state FROM ({states})),
    c_{name} AS (SELECT file_id, reference, state, prev_state, count(*) AS n FROM t_{name} WHERE prev_state IS NOT NULL GROUP BY ALL), q_{name} AS (SELECT *, n / sum(n) OVER (PARTITION BY file_id, reference, state) AS p FROM c_{name}),
    {name} AS (SELECT file_id, reference, sum(CASE WHEN state = prev_state THEN p ELSE 0 END) / sum(p) * {n} AS trace, sum(n) FILTER (state <> prev_state) AS switched FROM q_{name} GROUP BY ALL)"""


_WAVE_IDS = ("performance", "global_accuracy", "global_inaccuracy", "spatial_inaccuracy", "temporal_inaccuracy", "coordination_inaccuracy", "pad_actions", "trigger_actions", "switch_actions", "participant_motion_tau", "information_motion_tau", "actions_transition_trace", "space_transition_trace")


@query(f"""{_G}, inside AS (SELECT w.reference, w.b, w.e, a.* FROM actions a {_IN}),
    {_trace("SELECT file_id, reference, ts, button AS state FROM inside", 2, "buttons")},
    {_trace("SELECT file_id, reference, ts, button || '_' || CASE WHEN action_succeed THEN 'succeed' ELSE 'failed' END AS state FROM inside", 4, "acts")},
    {_trace("SELECT file_id, reference, ts, CASE WHEN x >= 3 THEN 4 ELSE CAST(floor((x + 3) / 2) AS INT) + 1 END || ',' || CASE WHEN y >= 4 THEN 3 ELSE CAST(floor((y - 1) / 1.5) AS INT) + 1 END AS state FROM inside", 6, "cells")},
    k AS (SELECT file_id, reference, count(*) FILTER (action_succeed) AS ga, count(*) FILTER (NOT action_succeed) AS gi, count(*) FILTER (failure_reason = 'bad_precision') AS si, count(*) FILTER (failure_reason = 'bad_planification') AS ti, count(*) FILTER (failure_reason = 'finger_confusion') AS ci, count(*) FILTER (button = 'pad') AS pa, count(*) FILTER (button = 'trigger') AS ta, sum(trajectory_length) AS moved FROM inside GROUP BY ALL),
    sp AS (SELECT w.file_id, w.reference, sum(trajectory_length) AS spawned FROM spawns a {_IN} GROUP BY ALL),
    ends AS (SELECT w.file_id, w.reference, arg_min(value, a.ts) AS performance FROM sig0 a {_IN} WHERE a.label = 'view' GROUP BY ALL),
    f AS (SELECT w.file_id, w.reference, performance, coalesce(ga, 0)::DOUBLE AS global_accuracy, coalesce(gi, 0)::DOUBLE AS global_inaccuracy, coalesce(si, 0)::DOUBLE AS spatial_inaccuracy, coalesce(ti, 0)::DOUBLE AS temporal_inaccuracy, coalesce(ci, 0)::DOUBLE AS coordination_inaccuracy, coalesce(pa, 0)::DOUBLE AS pad_actions, coalesce(ta, 0)::DOUBLE AS trigger_actions,
      coalesce(buttons.switched, 0)::DOUBLE AS switch_actions, coalesce(moved, 0) / nullif((epoch_us(e) - epoch_us(b)) / 1e6, 0) AS participant_motion_tau, coalesce(spawned, 0) / nullif((epoch_us(e) - epoch_us(b)) / 1e6, 0) AS information_motion_tau, acts.trace AS actions_transition_trace, cells.trace AS space_transition_trace
      FROM waves w LEFT JOIN k USING (file_id, reference) LEFT JOIN buttons USING (file_id, reference) LEFT JOIN acts USING (file_id, reference) LEFT JOIN cells USING (file_id, reference) LEFT JOIN sp USING (file_id, reference) LEFT JOIN ends USING (file_id, reference))
    """ + " UNION ALL ".join(f"SELECT file_id, reference, '{c}' AS id, round({c}, 6) AS value FROM f" for c in _WAVE_IDS))
def behavior_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(behavior.wave_features(game_events(spark, sf), game_sequences(spark, sf)), "value")


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase as a survey report of two items."""
    k = F.get_json_object("data", "$.k").cast("int")
    module = F.element_at(F.array(*map(F.lit, ("space-stress", "cardiac-coherence", "physio-sonification"))), k % 3 + 1)
    item = lambda i: F.struct(F.lit(1.0).alias("item_time"), (k % 5 + i).alias("item_index"), F.lit("key").alias("item_key"), F.lit("text").alias("item_text"), F.lit(0.0).alias("answer_default"), F.array(F.struct(F.lit(0.5).alias("time"), F.lit(1.0).alias("value"))).alias("answer_ticks"), (F.col("value") + i).alias("answer_final"), (F.col("value") / 10).alias("answer_time"), F.lit(True).alias("answer_completion"))
    data = F.to_json(F.struct((k % 2 + 1).alias("survey_index"), F.array(item(0), item(1)).alias("report")))
    return samples(spark, sf).where("label = 'purchase'").select("file_id", F.concat_ws("_", F.lit("owner"), module, F.lit("survey_reports"), "event_id").alias("id"), data.alias("data"))


_REP = f"""WITH {SIG}, p AS (SELECT file_id, value, CAST(json_extract_string(data, '$.k') AS INT) AS k FROM sig WHERE label = 'purchase'),
    i AS (SELECT file_id, ['space-stress', 'cardiac-coherence', 'physio-sonification'][k % 3 + 1] || '-' || (k % 2) || '-' || (k % 5 + n) AS reference, value + n AS answer_final, value / 10 AS answer_time FROM p, unnest([0, 1]) AS u(n)),
    r AS (SELECT file_id, reference, 'answerFinal' AS id, answer_final AS value FROM i UNION ALL SELECT file_id, reference, 'answerDuration', answer_time FROM i)"""


@query(f"{_REP} SELECT file_id, reference, id, round(value, 6) AS value FROM r")
def survey_reports(spark: SparkSession, sf: str) -> DataFrame:
    return r6(survey.report_features(_reports(spark, sf)), "value")


_GROUPS = ", ".join(f"('vr-meta-{g}', '{r}')" for g, refs in survey.META_GROUPS.items() for r in refs)


@query(f"{_REP}, g(meta, ref) AS (VALUES {_GROUPS}) SELECT file_id, id, meta AS reference, round(avg(value) + 1e-9, 5) AS value FROM r JOIN g ON r.reference = g.ref GROUP BY file_id, id, meta")
def survey_meta(spark: SparkSession, sf: str) -> DataFrame:
    return survey.meta_features(survey.report_features(_reports(spark, sf))).withColumn("value", rounded(F.col("value") + 1e-9, 5))


@query("""WITH e AS (SELECT user_id AS file_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) SELECT file_id, bool_and(coalesce(before <= ts, TRUE)) AS monotonic FROM e GROUP BY file_id""")
def verify_monotonic(spark: SparkSession, sf: str) -> DataFrame:
    return events.verify_order(samples(spark, sf).withColumnRenamed("event_id", "row"))


def _standard(spark: SparkSession, sf: str) -> DataFrame:
    """Events with planted faults: ends before begins, ids that repeat, data that is no object."""
    s = samples(spark, sf)
    end = F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.make_dt_interval(secs=F.lit(1))).when(F.col("event_id") % 2 == 0, F.col("ts") + F.make_dt_interval(secs=F.lit(5)))
    return s.select("file_id", F.concat_ws("_", "label", F.col("event_id") % 50).alias("id"), F.col("label").alias("name"), F.col("ts").alias("begin"), end.alias("end"), F.when(F.col("event_id") % 11 == 0, F.lit("[1]")).otherwise(F.col("data")).alias("data"), F.col("event_id").alias("row"))


@query(f"""WITH {SIG}, s AS (SELECT file_id, label || '_' || (event_id % 50) AS id, event_id, ts FROM sig), o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY event_id) AS a, row_number() OVER (PARTITION BY file_id ORDER BY ts, CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 1 SECOND WHEN event_id % 2 = 0 THEN ts + INTERVAL 5 SECOND END NULLS LAST, id) AS b FROM s)
    SELECT 'INCORRECT_CONTENTS' AS "check", count(*) FILTER (event_id % 11 = 0) AS violations FROM s UNION ALL SELECT 'BEGIN_END_ORDER', count(*) FILTER (event_id % 7 = 0) FROM s UNION ALL SELECT 'ROW_ORDER', count(*) FILTER (a <> b) FROM o
    UNION ALL SELECT 'REPEATED_ID', sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM s GROUP BY file_id, id)""")
def validate_events(spark: SparkSession, sf: str) -> DataFrame:
    return validate.event_violations(_standard(spark, sf), row="row")


@query("SELECT 'INCORRECT_CONTENTS' AS \"check\", count(*) FILTER (event_id % 13 = 0) AS violations FROM events")
def validate_features(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    return validate.feature_violations(s.select("file_id", F.col("label").alias("id"), F.when(F.col("event_id") % 13 != 0, F.col("label")).alias("reference"), "value"))


@query(f"""WITH {SIG}, d AS (SELECT file_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY file_id ORDER BY ts) AS d FROM sig), m AS (SELECT file_id, quantile_cont(d, 0.5) AS m, max(d) AS hi, min(d) AS lo FROM d GROUP BY file_id)
    SELECT 'BAD_SAMPLING' AS "check", count(*) FILTER (hi - m > m + 1 OR m - lo > m + 1 OR lo <= 0) AS violations FROM m""")
def validate_signals(spark: SparkSession, sf: str) -> DataFrame:
    return validate.signal_violations(samples(spark, sf).select("file_id", "ts", F.col("value").alias("PPG")))


@query("""SELECT 'BAD_ANNOTATION_INDEX' AS "check", count(*) FILTER (event_type = 'click' AND event_id % 9 = 0) AS violations FROM events UNION ALL SELECT 'BAD_ANNOTATION_CONTENTS', count(*) FILTER (event_type = 'click' AND event_id % 9 <> 0 AND event_id % 4 = 0 AND event_id % 3 = 0) FROM events""")
def validate_annotations(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    signals = s.select("file_id", "ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("PPG"))
    moved = F.when(F.col("event_id") % 9 == 0, F.col("ts") + F.make_dt_interval(days=F.lit(400))).otherwise(F.col("ts"))
    notes = s.where("label = 'click'").select("file_id", moved.alias("ts"), F.when(F.col("event_id") % 3 == 0, "").otherwise("unknown").alias("PPG"))
    return validate.annotation_violations(signals, notes)


@query(f"""WITH {SIG} SELECT s.file_id, epoch_us(s.ts) AS ts, s.value, n.note IS NOT NULL AS annotated, CASE WHEN n.note IS NULL THEN '' ELSE n.note END AS note FROM sig s LEFT JOIN (SELECT file_id, ts, 'electrode pop' AS note FROM sig WHERE label = 'error') n USING (file_id, ts)""")
def annotations_join(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    notes = s.where("label = 'error'").select("file_id", "ts", F.lit("electrode pop").alias("note"))
    return eda.with_annotations(s.select("file_id", "ts", "value"), notes).select("file_id", us("ts"), "value", "annotated", "note")

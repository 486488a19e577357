"""The driver's tables as tables of the data model, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import json_field
from ..functions.timing import from_micros, micros
from ..operators.behavior import BREACH, ENEMY, GAME, PUSH, WAVE
from ..operators.events import session_sequences
from ..operators.intervals import pair_markers
from ..operators.nn import reject_artifacts


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """file_id, ts, value, event_id, label, data."""
    return table(spark, sf, "events").select(F.col("user_id").alias("file_id"), "ts", "value", "event_id", F.col("event_type").alias("label"), F.col("props").alias("data"))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    return pair_markers(s, F.col("label") == "view", F.col("label") == "purchase", F.lit("visit"), ("ts", "event_id"))


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Visits, one session per file, one segment per file and day."""
    return visits(spark, sf).select("file_id", "name", "id", "begin", "end").unionByName(session_sequences(samples(spark, sf)))


def nn(spark: SparkSession, sf: str) -> DataFrame:
    """Values as intervals, with a loose rejection rule that leaves enough good ones."""
    return reject_artifacts(samples(spark, sf).select("file_id", "ts", F.col("value").alias("nn")), 75, 20, 450)


#: Users whose events make one recording of beats, so that it fills the longest epochs.
USERS_PER_RECORDING = 16
_EPOCH_US = 1_577_836_800_000_000


def beats(spark: SparkSession, sf: str) -> DataFrame:
    """file_id, ts, nn: the events of several users in order as heart beats of 800 to 1000 ms, one after the other."""
    e = table(spark, sf, "events").select(F.floor(F.col("user_id") / USERS_PER_RECORDING).cast("long").alias("file_id"), F.col("ts").alias("at"), "event_id", F.round(800 + F.col("value") % 200, 3).alias("nn"))
    w = Window.partitionBy("file_id").orderBy("at", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return e.select("file_id", from_micros(F.lit(_EPOCH_US) + F.sum(F.round(F.col("nn") * 1000).cast("long")).over(w)).alias("ts"), "nn")


def beat_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """A session over each recording of beats, and its first half."""
    span = beats(spark, sf).groupBy("file_id").agg(F.min("ts").alias("begin"), F.max("ts").alias("end"))
    half = from_micros(F.floor((micros("begin") + micros("end")) / 2).cast("long"))
    whole = span.select("file_id", F.lit("session").alias("name"), F.lit("session_0").alias("id"), "begin", "end")
    return whole.unionByName(span.select("file_id", F.lit("half").alias("name"), F.lit("half_0").alias("id"), "begin", half.alias("end")))


def game_events(spark: SparkSession, sf: str) -> DataFrame:
    """file_id, ts, label, data of a game made from the events: pushes, spawns, wave ends."""
    s = samples(spark, sf).withColumn("k", json_field(F.col("data"), "k").cast("int"))
    action = F.element_at(F.array(*map(F.lit, ("succeed_hit", "action_failed", "no_target", "too_early", "too_late", "wrong_button"))), F.col("k") % 6 + 1)
    x, y = (F.col("k") % 7 - 3).cast("double"), (1 + F.col("k") % 4).cast("double")
    push = F.to_json(F.struct(F.when(F.col("k") % 2 == 0, "trigger").otherwise("pad").alias("button"), x.alias("x"), y.alias("y"), F.lit(5.0).alias("z"), F.struct(action.alias("action")).alias("result")))
    spawn = F.to_json(F.struct(F.col("k").alias("id"), x.alias("x"), y.alias("y"), F.lit(5.0).alias("z")))
    ended = F.to_json(F.struct(F.struct(F.col("value").alias("difficulty")).alias("report")))
    label = F.when(F.col("label").isin("click", "error"), PUSH).when(F.col("label") == "signup", ENEMY).when(F.col("label") == "purchase", BREACH).otherwise(f"unity_{WAVE}_ends")
    data = F.when(F.col("label").isin("click", "error"), push).when(F.col("label").isin("signup", "purchase"), spawn).otherwise(ended)
    return s.select("file_id", "ts", label.alias("label"), data.alias("data"))


def game_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """The session as the game, each day as a wave."""
    s = session_sequences(samples(spark, sf))
    is_day = F.col("name") == "day"
    return s.select("file_id", F.when(is_day, WAVE).otherwise(GAME).alias("name"), F.when(is_day, F.concat_ws("_", F.lit(WAVE), F.substring_index("id", "_", -1))).otherwise(f"{GAME}_0").alias("id"), "begin", "end")


def us(c: str) -> Column:
    return micros(c).alias(c)


def rounded(c: Column | str, digits: int) -> Column:
    """Doubles rounded as SQL engines do, in floating point: Spark's own ``round`` goes by the shortest decimal, which may be a tie where the double is none."""
    scale = F.lit(10.0**digits)
    return F.round((F.col(c) if isinstance(c, str) else c) * scale) / scale + F.lit(0.0)


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles rounded to six digits, so that the last bits of two engines don't differ."""
    return df.withColumns({c: rounded(c, 6) for c in columns})


SIG = "sig AS (SELECT user_id AS file_id, ts, value, event_id, event_type AS label, props AS data FROM events)"
VISITS = """marks AS (SELECT file_id, ts, label, lead(label) OVER w AS nl, lead(ts) OVER w AS nt FROM sig WHERE label IN ('view', 'purchase') WINDOW w AS (PARTITION BY file_id ORDER BY ts, event_id)),
visits AS (SELECT file_id, 'visit' AS name, 'visit_' || (row_number() OVER (PARTITION BY file_id ORDER BY ts) - 1) AS id, ts AS b, nt AS e FROM marks WHERE label = 'view' AND nl = 'purchase')"""
SESSIONS = """sessions AS (SELECT file_id, 'session' AS name, 'session_0' AS id, min(ts) AS b, max(ts) AS e FROM sig GROUP BY file_id
UNION ALL SELECT file_id, 'day', 'day_' || (epoch_us(date_trunc('day', ts)) // 86400000000), min(ts), max(ts) FROM sig GROUP BY file_id, date_trunc('day', ts))"""
SEQ = f"{VISITS}, {SESSIONS}, seq AS (SELECT * FROM visits UNION ALL SELECT * FROM sessions)"


def nn_sql(percent: float = 75, low: float = 20, high: float = 450) -> str:
    a, b = 1 - percent / 100, 1 + percent / 100
    return f"""raw AS (SELECT file_id, ts, value AS nn, ln(value) - ln(lag(value) OVER (PARTITION BY file_id ORDER BY ts)) AS jump FROM sig),
nn AS (SELECT file_id, ts, nn, CASE WHEN jump < ln({a}) OR jump > ln({b}) THEN 'Rejected: relative change > {percent:g}%' WHEN nn < {low} OR nn > {high} THEN 'Rejected: outside {low:g} - {high:g} ms' ELSE 'OK' END AS details FROM raw)"""


BEATS = f"""b0 AS (SELECT user_id // {USERS_PER_RECORDING} AS file_id, ts, event_id, round(800 + value % 200, 3) AS nn FROM events),
beats AS (SELECT file_id, {_EPOCH_US} + sum(CAST(round(nn * 1000) AS BIGINT)) OVER (PARTITION BY file_id ORDER BY ts, event_id) AS t, nn FROM b0),
bseq AS (SELECT file_id, 'session_0' AS id, min(t) AS b, max(t) AS e FROM beats GROUP BY file_id UNION ALL SELECT file_id, 'half_0', min(t), CAST((min(t) + max(t)) // 2 AS BIGINT) FROM beats GROUP BY file_id)"""


GAME_SQL = f"""sig0 AS (SELECT user_id AS file_id, ts, value, event_type AS label, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
pushes AS (SELECT file_id, ts, CASE WHEN k % 2 = 0 THEN 'trigger' ELSE 'pad' END AS button, (k % 7 - 3)::DOUBLE AS x, (1 + k % 4)::DOUBLE AS y, 5.0::DOUBLE AS z, ['succeed_hit', 'action_failed', 'no_target', 'too_early', 'too_late', 'wrong_button'][k % 6 + 1] AS action FROM sig0 WHERE label IN ('click', 'error')),
actions0 AS (SELECT file_id, ts, button, x, y, z, contains(action, 'succeed') AS action_succeed,
  CASE action WHEN 'wrong_button' THEN 'finger_confusion' WHEN 'no_target' THEN 'bad_precision' WHEN 'too_early' THEN 'bad_planification' WHEN 'too_late' THEN 'bad_planification' END AS failure_reason
  FROM pushes WHERE NOT (button = 'pad' AND action = 'action_failed')),
actions AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS trajectory_length FROM actions0 WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
spawns0 AS (SELECT file_id, ts, CASE WHEN label = 'signup' THEN 'enemy' ELSE 'breach' END AS type, k AS id, (k % 7 - 3)::DOUBLE AS x, (1 + k % 4)::DOUBLE AS y, 5.0::DOUBLE AS z FROM sig0 WHERE label IN ('signup', 'purchase')),
spawns AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS trajectory_length FROM spawns0 WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
waves AS (SELECT file_id, '{WAVE}_' || (epoch_us(date_trunc('day', ts)) // 86400000000) AS reference, min(ts) AS b, max(ts) AS e FROM sig0 GROUP BY file_id, date_trunc('day', ts))"""

"""Queries over questionnaires, catalogs and population tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import truthy, version_key
from ..operators import forms, metadata, population
from . import changes
from .catalogue import query
from .inputs import r6, table

#: A scoring tree over three questions that each order answers.
CONFIG = {
    "urgency_map": {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1},
    "domains": [
        {"name": "pressure", "operator": "sum", "dimensions": [{"name": "urgency", "operator": "sum", "questions": [{"ref": "priority", "value_map": {"$ref": "#/urgency_map"}}, {"ref": "status", "value_map": {"O": 0, "F": 1, "P": 2}, "reverse": True}]}, {"name": "effort", "operator": "mean", "questions": [{"ref": "scale", "reverse": True}]}]},
        {"name": "standing", "operator": "mean", "dimensions": [{"name": "plain", "operator": "mean", "questions": [{"ref": "priority", "value_map": {"$ref": "#/urgency_map"}}, {"ref": "scale"}]}]},
    ],
}
_RANGES = [("priority", 1.0, 5.0), ("status", 0.0, 2.0), ("scale", 1.0, 11.0)]


def _config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(forms.config_rows(CONFIG), forms.CONFIG_SCHEMA)


def _ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_RANGES, "ref string, low double, high double")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """The last answers of each customer."""
    o = table(spark, sf, "orders")
    refs = F.array(F.struct(F.lit("priority").alias("ref"), F.col("o_orderpriority").alias("answer")), F.struct(F.lit("status").alias("ref"), F.col("o_orderstatus").alias("answer")), F.struct(F.lit("scale").alias("ref"), (F.col("o_orderkey") % 11 + 1).cast("string").alias("answer")))
    rows = o.select(F.col("o_custkey").alias("response_id"), "o_orderkey", F.explode(refs).alias("r")).select("response_id", "o_orderkey", "r.ref", "r.answer")
    return forms.last_answers(rows, "o_orderkey").select("response_id", "ref", "answer")


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return forms.question_scores(_answers(spark, sf), _config(spark), _ranges(spark))


_PRIORITY = "CASE p WHEN '1-URGENT' THEN 5.0 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END"
_SC = f"""WITH last AS (SELECT o_custkey AS response_id, arg_max(o_orderpriority, o_orderkey) AS p, arg_max(o_orderstatus, o_orderkey) AS s, max(o_orderkey) % 11 + 1 AS k FROM orders GROUP BY o_custkey),
    v AS (SELECT response_id, {_PRIORITY} AS priority, 2.0 - CASE s WHEN 'O' THEN 0.0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END AS status, 12.0 - k AS back, k::DOUBLE AS scale FROM last),
    q AS (SELECT response_id, 'pressure' AS domain, 'urgency' AS dimension, 'priority' AS ref, priority AS score FROM v UNION ALL SELECT response_id, 'pressure', 'urgency', 'status', status FROM v UNION ALL SELECT response_id, 'pressure', 'effort', 'scale', back FROM v UNION ALL SELECT response_id, 'standing', 'plain', 'priority', priority FROM v UNION ALL SELECT response_id, 'standing', 'plain', 'scale', scale FROM v),
    d AS (SELECT response_id, domain, dimension, CASE WHEN dimension = 'urgency' THEN sum(score) ELSE avg(score) END AS value FROM q GROUP BY response_id, domain, dimension),
    m AS (SELECT response_id, domain, CASE WHEN domain = 'pressure' THEN sum(value) ELSE avg(value) END AS value FROM d GROUP BY response_id, domain)"""


@query(f"{_SC} SELECT response_id, domain, dimension, ref, score::DOUBLE AS score, CASE WHEN score IS NULL THEN 'missing' ELSE 'ok' END AS status FROM q")
def question_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf).select("response_id", "domain", "dimension", "ref", "score", "status")


@query(f"{_SC} SELECT response_id, domain, dimension, round(value, 6) AS value FROM d")
def dimension_scores(spark: SparkSession, sf: str) -> DataFrame:
    return r6(forms.dimension_scores(_scores(spark, sf)).select("response_id", "domain", "dimension", "value"), "value")


@query(f"{_SC} SELECT response_id, domain, round(value, 6) AS value FROM m")
def domain_scores(spark: SparkSession, sf: str) -> DataFrame:
    return r6(forms.domain_scores(forms.dimension_scores(_scores(spark, sf))), "value")


@query(f"{_SC} SELECT response_id, domain AS id, 'Domain' AS level, 'subject' AS reference, round(value, 6) AS value FROM m UNION ALL SELECT response_id, dimension, 'Dimension', 'subject', round(value, 6) FROM d")
def form_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(forms.form_features(_scores(spark, sf)), "value")


@query(f"""{_SC}, r AS (SELECT 'priority' AS ref, min(priority) AS low, max(priority) AS high FROM v UNION ALL SELECT 'status', min(2 - status), max(2 - status) FROM v UNION ALL SELECT 'scale', min(scale), max(scale) FROM v),
    c(domain, dimension, ref) AS (VALUES ('pressure', 'urgency', 'priority'), ('pressure', 'urgency', 'status'), ('pressure', 'effort', 'scale'), ('standing', 'plain', 'priority'), ('standing', 'plain', 'scale')),
    x AS (SELECT domain, dimension, CASE WHEN dimension = 'urgency' THEN sum(low) ELSE avg(low) END AS low, CASE WHEN dimension = 'urgency' THEN sum(high) ELSE avg(high) END AS high FROM c JOIN r USING (ref) GROUP BY domain, dimension)
    SELECT domain, dimension, low::DOUBLE AS low, high::DOUBLE AS high FROM x
    UNION ALL SELECT domain, NULL, CASE WHEN domain = 'pressure' THEN sum(low) ELSE avg(low) END, CASE WHEN domain = 'pressure' THEN sum(high) ELSE avg(high) END FROM x GROUP BY domain""")
def score_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The ranges that the answers of all customers show, rolled up the scoring tree."""
    config = _config(spark)
    return forms.score_ranges(config, forms.observed_ranges(_answers(spark, sf), config))


_KINDS = ("number", "boolean", "choice", "choices", "text", "date", "file")


@query("""WITH a AS (SELECT o_orderkey, ['number', 'boolean', 'choice', 'choices', 'text', 'date', 'file'][o_orderkey % 7 + 1] AS kind, CASE o_orderkey % 7 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'no idea' END WHEN 3 THEN 'a|b' ELSE o_orderstatus END AS raw FROM orders)
    SELECT o_orderkey, kind, CASE WHEN kind = 'number' THEN TRY_CAST(raw AS DOUBLE) END AS number, CASE WHEN kind = 'boolean' THEN CAST(TRY_CAST(raw AS BOOLEAN) AS INT) END AS flag, CASE WHEN kind IN ('choice', 'text') THEN raw END AS label, CASE WHEN kind = 'choices' THEN len(string_split(raw, '|')) END AS n_labels, kind <> 'file' AS known FROM a""")
def answers_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey") % 7
    raw = F.when(k == 0, F.col("o_orderkey").cast("string")).when(k == 1, F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("no idea")).when(k == 3, "a|b").otherwise(F.col("o_orderstatus"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.element_at(F.array(*map(F.lit, _KINDS)), (k + 1).cast("int")).alias("kind"), raw.alias("raw"))
    parsed = forms.parse_answer(F.col("kind"), F.col("raw"))
    return rows.select("o_orderkey", "kind", parsed["number"].alias("number"), parsed["flag"].cast("int").alias("flag"), parsed["label"].alias("label"), F.when(parsed["labels"].isNotNull(), F.size(parsed["labels"]).cast("long")).alias("n_labels"), parsed["known"].alias("known"))


@query("""WITH t AS (SELECT conv_id AS form_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS k FROM conversations),
    d AS (SELECT form_id, 't' || turn AS ref, CASE WHEN role = 'user' THEN 'group' ELSE 'text' END AS type, k, 1 + count(*) FILTER (role = 'user') OVER (PARTITION BY form_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS depth FROM t)
    SELECT form_id, row_number() OVER (PARTITION BY form_id ORDER BY depth, k) - 1 AS place, depth, ref, type FROM d""")
def form_fields_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation as a form: each user's turn is a group that holds all turns after it."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("turn", "role")))).alias("turns"))
    head = lambda x, kind: F.concat(F.lit('{"ref": "t'), x["turn"].cast("string"), F.lit(f'", "type": "{kind}"'))
    nested = F.aggregate("turns", F.lit(""), lambda acc, x: F.when(x["role"] == "user", F.concat(head(x, "group"), F.lit(', "properties": {"fields": ['), acc, F.lit("]}}"))).otherwise(F.concat(head(x, "text"), F.when(acc == "", "}").otherwise(F.concat(F.lit("}, "), acc)))))
    packed = turns.select(F.col("conv_id").alias("form_id"), F.concat(F.lit('{"fields": ['), nested, F.lit("]}")).alias("document"))
    flat = forms.flatten_forms(packed)
    return flat.select("form_id", F.col("place").cast("long").alias("place"), F.col("depth").cast("long").alias("depth"), "ref", "type")


@query("SELECT 'c' || conv_id AS token, min(turn) AS submitted_at, arg_min(length(text), turn) AS answers FROM conversations WHERE role <> 'system' GROUP BY conv_id")
def responses_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(F.concat(F.lit("c"), "conv_id").alias("token"), F.col("turn").alias("submitted_at"), F.when(F.col("role") != "system", F.length("text").cast("long")).alias("answers"))
    return forms.unique_responses(rows).select("token", "submitted_at", "answers")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as files with JSON metadata."""
    p = F.col("page_id")
    version = F.element_at(F.array(*map(F.lit, ("0.4.0", "0.10.0", "0.3.9", "0.4"))), (p % 4 + 1).cast("int"))
    flow = F.when(p % 3 != 0, F.struct(F.struct(version.alias("version"), F.lit("SUCCESS").alias("status")).alias("gsr")))
    return table(spark, sf, "pages").select(
        p.alias("file_id"), F.concat_ws(".", F.concat(F.lit("vr_"), p % 40), F.lit("hdf5")).alias("filename"), F.concat(F.lit("site"), p % 5).alias("path"), p.alias("date"),
        F.to_json(F.struct(F.when(p % 17 == 0, "DELETED").otherwise("READY").alias("state"))).alias("base"), F.to_json(F.struct(flow.alias("flows"))).alias("journal"),
        F.to_json(F.struct(F.array(F.lit("/unity/events"), F.when(p % 2 == 0, "/nexus/gsr").otherwise("/nexus/ppg")).alias("signals"))).alias("standard"), F.to_json(F.struct(F.when(p % 6 == 0, "yes").otherwise("no").alias("legacy"))).alias("protocol"),
    )


@query("SELECT page_id AS file_id, 'vr_' || (page_id % 40) || '.hdf5' AS filename FROM pages WHERE page_id % 2 = 0 AND page_id % 17 <> 0 AND page_id % 6 <> 0 AND ('vr_' || (page_id % 40) || '.hdf5') LIKE 'vr_1%'")
def catalog_select(spark: SparkSession, sf: str) -> DataFrame:
    """Path, membership, boolean and pattern predicates on JSON metadata."""
    has = F.array_contains(F.from_json(F.get_json_object("standard", "$.signals"), "array<string>"), "/nexus/gsr")
    cond = has & (F.get_json_object("base", "$.state") != "DELETED") & ~truthy(F.get_json_object("protocol", "$.legacy")) & F.col("filename").like("vr\\_1%")
    return metadata.select_files(_catalog(spark, sf), cond).select("file_id", "filename")


@query("SELECT page_id AS file_id FROM pages WHERE page_id % 3 = 0 OR page_id % 4 IN (0, 2, 3)")
def catalog_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Files that a flow of version 0.5.0 has not seen, or only an older one; 0.10.0 is not older."""
    return _catalog(spark, sf).where(metadata.pending("gsr", "0.5.0")).select("file_id")


@query("SELECT 'vr_' || (page_id % 40) || '.hdf5' AS filename, 'site' || (page_id % 5) AS path, max(page_id) AS file_id FROM pages WHERE page_id % 17 <> 0 GROUP BY ALL")
def catalog_latest(spark: SparkSession, sf: str) -> DataFrame:
    c = _catalog(spark, sf)
    return metadata.find_latest(c.select("filename", "path", "file_id", "date", "base"), ["filename", "path"], "date", F.get_json_object("base", "$.state") == "DELETED").select("filename", "path", "file_id")


@query("SELECT v, CAST(string_split(v, '.')[1] AS INT) AS major, CAST(string_split(v, '.')[2] AS INT) AS minor FROM (SELECT DISTINCT ['0.4.0', '0.10.0', '0.3.9', '0.4'][page_id % 4 + 1] AS v FROM pages)")
def version_numbers(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "pages").select(F.element_at(F.array(*map(F.lit, ("0.4.0", "0.10.0", "0.3.9", "0.4"))), (F.col("page_id") % 4 + 1).cast("int")).alias("v")).distinct()
    return v.select("v", version_key(F.col("v"))[0].alias("major"), version_key(F.col("v"))[1].alias("minor"))


@query("WITH c AS (SELECT o_orderstatus || ': ' || o_orderpriority AS outcome, count(*) AS n FROM orders GROUP BY ALL) SELECT outcome, n, row_number() OVER (ORDER BY n DESC, outcome) AS place FROM c")
def status_report(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.status_report(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority").select("outcome", "n", F.col("place").cast("long").alias("place"))


@query("SELECT c_custkey AS file_id, c_acctbal AS balance, NULL::DOUBLE AS total FROM customer UNION ALL SELECT o_custkey, NULL, o_totalprice FROM orders")
def population_union(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("file_id"), F.col("c_acctbal").alias("balance"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("file_id"), F.col("o_totalprice").alias("total"))
    return population.union_all([a, None, b])


@query("WITH o AS (SELECT o_custkey AS file_id, count(*) AS orders FROM orders GROUP BY 1), c AS (SELECT c_custkey AS file_id, c_acctbal AS balance FROM customer) SELECT file_id, balance, orders FROM c FULL OUTER JOIN o USING (file_id)")
def population_outer_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("file_id"), F.col("c_acctbal").alias("balance"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("file_id")).agg(F.count(F.lit(1)).alias("orders"))
    return population.outer_join_all([c, o], ["file_id"]).select("file_id", "balance", "orders")


@query("SELECT l_partkey AS \"key\", count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1")
def merge_groups_check(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file_id"), F.col("l_partkey").alias("key"), F.when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"))
    return population.duplicate_groups(g)


@query("SELECT doc_id AS file_id, doc_id % 100 AS parent_id, CASE WHEN doc_id % 100 IN (SELECT page_id FROM pages) THEN 'user_' || (doc_id % 100) ELSE lang END AS owner FROM documents")
def metadata_propagate(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "pages").select(F.col("page_id").alias("file_id"), F.concat(F.lit("user_"), "page_id").alias("owner"))
    children = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), (F.col("doc_id") % 100).alias("parent_id"), F.col("lang").alias("owner"))
    return metadata.propagate(children, parents, ["owner"]).select("file_id", "parent_id", "owner")


@query("SELECT doc_id AS file_id, 'somatiq' AS created_by, 'clean' AS task, '1.0' AS task_version, CASE WHEN n_chars > 2000 THEN 'SUCCESS' ELSE 'FAILED' END AS status, CASE WHEN n_chars > 2000 THEN NULL ELSE 'error' END AS problem_type, CASE WHEN n_chars > 2000 THEN NULL ELSE 'too short' END AS problem_title, source AS parents FROM documents")
def run_journal(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").withColumnRenamed("doc_id", "file_id")
    ok = F.col("n_chars") > 2000
    return metadata.journal(d, "clean", "1.0", F.when(ok, metadata.SUCCESS).otherwise(metadata.FAILED), F.when(~ok, F.lit("too short")), F.col("source"))


@query("SELECT doc_id AS file_id, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE 'old' END AS status FROM documents")
def flow_upsert(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), F.lit("old").alias("status"))
    return metadata.upsert(d, d.where("file_id % 2 = 0").withColumn("status", F.lit("new")), ["file_id"]).select("file_id", "status")


@query("SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 50")
def dataset_limit_order(spark: SparkSession, sf: str) -> DataFrame:
    """The first files by path: the limit is the feature."""
    return metadata.select_files(table(spark, sf, "pages").select("page_id", "url"), F.lit(True), limit=50, order=("url", "page_id"))


_RUN_STATES = """WITH e AS (SELECT user_id, event_id, value, epoch_us(ts) AS t FROM events),
    b AS (SELECT user_id AS file_id, list_sort(list((event_id, value, t))) AS v FROM e WHERE user_id % 7 <> 0 AND NOT (user_id % 3 = 0 AND event_id % 20 = 0) GROUP BY user_id),
    n AS (SELECT user_id AS file_id, list_sort(list((event_id, value, t))) AS v FROM e WHERE user_id % 5 <> 0 GROUP BY user_id)"""


@query(f"{_RUN_STATES} SELECT coalesce(b.file_id, n.file_id) AS file_id, CASE WHEN b.file_id IS NULL THEN 'new' WHEN n.file_id IS NULL THEN 'removed' WHEN b.v <> n.v THEN 'changed' WHEN b.file_id % 11 = 0 THEN 'failed' ELSE 'same' END AS change FROM b FULL OUTER JOIN n USING (file_id)")
def run_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What a run has to compute: the recordings as they were once (some not there yet, some shorter, some failed) against those of now."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("file_id"), "event_id", "value", "ts")
    before = changes.content_versions(e.where("file_id % 7 <> 0 and not (file_id % 3 = 0 and event_id % 20 = 0)"))
    now = changes.content_versions(e.where("file_id % 5 <> 0").orderBy(F.desc("ts")))
    return changes.change_set(before, now, failed=F.col("file_id") % 11 == 0).select("file_id", "change")

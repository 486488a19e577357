"""URL filter lists: host-suffix and path-prefix expressions, short hash prefixes, full digests.

Each distinct URL is expanded into the expressions that a rule about it could have: every suffix
of its host at a label boundary, times every prefix of its path whose length occurs among the
rules. Expressions meet rules on the first 32 bits of a SHA-256 digest; the full digest confirms a
match; the longest rule wins (equal lengths: the greater rule string, block before allow).

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the
default verdict; repeated rows and URLs, and null ids, give a row each; URLs of any length count
whole; rules without a host or action are passed over; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a digest in hexadecimal digits that the join uses.
SHORT = 8
#: Most rules of a list that are sent to every task; longer ones, and tables, are joined by size.
MOST_BROADCAST = 50_000


def _lower(text: Column) -> Column:
    """A-Z lower-cased, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """From the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages; rules: (host, path, allow or block)."""
    spark = pages.sparkSession
    few = not isinstance(rules, DataFrame) and len(rules) <= MOST_BROADCAST
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "host string, path string, action string")
    rules = rules.where(F.col("host").isNotNull() & F.col("action").isNotNull()).select(
        _lower(F.col("host")).alias("rule_host"), F.coalesce(F.regexp_replace("path", "^(?!/)(?=.)", "/"), F.lit("")).alias("rule_path"), "action"
    )
    #: Lengths of rule paths: at most as many as the longest path has characters.
    lengths = [r.n for r in rules.select(F.length("rule_path").alias("n")).distinct().collect()]
    marked = rules.select(
        F.concat("rule_host", "rule_path").alias("rule"), "action", F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256).alias("rule_digest")
    ).withColumn("short", F.substring("rule_digest", 1, SHORT))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    if not lengths:
        return rows.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = rows.select("url").where("url is not null").distinct().select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).where("host <> ''")
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]), lambda p: p.isNotNull())
    expressions = urls.select("url", F.explode(_host_suffixes(F.col("host"))).alias("suffix"), prefixes.alias("prefixes")).select("url", "suffix", F.explode("prefixes").alias("prefix"))
    digested = expressions.select("url", F.sha2(F.concat_ws("\n", "suffix", "prefix"), 256).alias("digest")).withColumn("short", F.substring("digest", 1, SHORT))
    hits = digested.join(F.broadcast(marked) if few else marked, "short").where(F.col("digest") == F.col("rule_digest"))
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best")).select(F.col("url").alias("hit_url"), "best")
    return rows.join(best, F.col("url") == F.col("hit_url"), "left").select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )

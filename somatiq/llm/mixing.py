"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are dealt in blocks of equal size. The blocks of the whole mix are apportioned among the
sources, and each source's among its shards, by highest quotients (by way of groups of shards where
a source has very many). The documents of a shard stand in seeded order on a line of words, which
is cut into the shard's blocks; the shard selects as many blocks as its quota says, one after the
other from a seeded first one, round and round. So shares are exact to a block, documents are
taken whole but at the two ends, and a second lap repeats documents.

Edge cases: a null text has size 0 and is never taken; a null source is a source of its own, last
in order; a document of any length is one place on its line; repeated and null doc_ids are rows of
their own, told apart by their texts, and equal rows are interchangeable; an empty table gives an
empty result; extra columns are ignored unless kept by name.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable

#: Most sources whose table is sent to every task.
MOST_BROADCAST = 50_000
#: Most children among which one task apportions a quota.
FAN_OUT = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportion(weights: list[float], seats: int) -> list[int]:
    """Seats by highest quotients weight / (2 k + 1); equal quotients go to the earlier party.

    All seats whose quotient is certainly above the last are dealt at once from the divisor; the
    few that remain go one by one, so the cost does not grow with the number of seats.
    """
    total = math.fsum(weights)
    if seats <= 0 or total <= 0:
        return [0] * len(weights)
    divisor = total / seats
    won = [max(0, math.floor(w / divisor + 0.5) - 1) if w > 0 else 0 for w in weights]
    heap = [(-w / (2 * k + 1), i) for i, (w, k) in enumerate(zip(weights, won, strict=True)) if w > 0]
    heapq.heapify(heap)
    left = seats - sum(won)
    while left > 0:
        _, i = heapq.heappop(heap)
        won[i] += 1
        left -= 1
        heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


def capped_targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Split share * sum(sizes) by weight; a target stops at most * size, its excess reshared."""
    goal, caps = share * sum(sizes), [most * s for s in sizes]
    targets, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        rest = goal - math.fsum(caps[i] for i in range(len(sizes)) if i not in free)
        by = math.fsum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / by > caps[i]}
        for i in free:
            targets[i] = caps[i] if i in over else rest * weights[i] / by
        if not over:
            break
        free -= over
    return targets


def _apportion_level(children: DataFrame, parents: DataFrame, by: list[str]) -> DataFrame:
    """children (with by, size, cap) and their quota, from parents (by, quota, whole).

    Seats by highest quotients, in closed form from the divisor: between floor(x + 1/2) - 1 and
    floor(x + 1/2) + 2 for an ideal share of x; the open ones go by rank. No child exceeds its cap,
    and what that leaves goes to the next quotients.
    """
    ideal = F.col("quota") * F.col("size") / F.greatest(F.col("whole"), F.lit(1))
    base = F.least(F.greatest(F.floor(ideal + 0.5) - 1, F.lit(0)), F.col("cap")).cast("long")
    told = children.join(parents, by).withColumn("won", base)
    of_parent = Window.partitionBy(*by)
    own = [c for c in children.columns if c not in by]
    seats = (
        told.withColumn("open", F.col("quota") - F.sum("won").over(of_parent))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .withColumn("free", (F.col("size") > 0) & (F.col("won") + F.col("step") < F.col("cap")))
        .withColumn("place", F.row_number().over(of_parent.orderBy(F.desc("free"), F.desc(F.col("size") / (2 * (F.col("won") + F.col("step")) + 1)), "child", "step")))
    )
    more = F.sum((F.col("free") & (F.col("place") <= F.col("open"))).cast("long"))
    return seats.groupBy(*by, *own, "won").agg(more.alias("more")).select(*by, *own, (F.col("won") + F.col("more")).alias("quota"))


def _shard_quotas(shards: DataFrame, sources: DataFrame, most_shards: int) -> DataFrame:
    """source_no, shard, size, cap, quota: down from the sources by levels of FAN_OUT children."""
    levels = max(1, math.ceil(math.log(max(most_shards, 2)) / math.log(FAN_OUT) - 1e-9))
    parents = sources.select("source_no", F.lit(0).cast("long").alias("parent"), "quota", F.col("source_size").alias("whole"))
    for level in range(levels - 1, -1, -1):
        group = lambda n: F.floor(F.col("shard") / F.lit(FAN_OUT**n)).cast("long")
        up = F.lit(0).cast("long") if level == levels - 1 else group(level + 1)
        children = shards.groupBy("source_no", up.alias("parent"), group(level).alias("child")).agg(F.sum("size").alias("size"), F.sum("cap").alias("cap"))
        dealt = _apportion_level(children, parents, ["source_no", "parent"])
        parents = dealt.select("source_no", F.col("child").alias("parent"), "quota", F.col("size").alias("whole"))
    return dealt.select("source_no", F.col("child").alias("shard"), "size", "cap", "quota")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 16, docs_per_shard: int = 256, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (and the columns to keep) for each row of docs.

    The driver sees one row per source (sources are a dimension of the corpus, about a hundred
    bytes each, not documents); every statistic covers all rows. Where ``most`` is no whole number a
    source still reaches ``most`` times its size, and a document is taken ``ceil(most)`` times at most.
    """
    spark = docs.sparkSession
    extra = [F.col(c).alias(f"__keep_{c}") for c in keep]
    text = F.col(text_col).cast("string")
    sized = durable(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("mark"), *extra), "mix-sizes")
    by_source = sorted(((r.source, r.size, r.n) for r in sized.groupBy("source").agg(F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("n")).collect()), key=lambda r: (r[0] is None, [ord(c) for c in r[0] or ""]))
    targets = capped_targets([r[1] for r in by_source], [weights[i % len(weights)] for i in range(len(by_source))], share, most)
    quotas = apportion(targets, round(math.fsum(targets) / block))
    counts = [max(1, -(-n // docs_per_shard)) for _, _, n in by_source]
    table = spark.createDataFrame(
        [(i, s is None, s or "", z, t, q, c) for i, ((s, z, _), t, q, c) in enumerate(zip(by_source, targets, quotas, counts, strict=True))],
        T.StructType([T.StructField("source_no", T.IntegerType()), T.StructField("no_source", T.BooleanType()), T.StructField("source_key", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("quota", T.LongType()), T.StructField("shards", T.LongType())]),
    )
    few = len(by_source) <= MOST_BROADCAST
    # A few sources: their rows go to the documents; with very many, a join of the two deals them out.
    sources = F.broadcast(table.drop("quota")) if few else table.drop("quota")
    keyed = sized.withColumns({"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit("")), "draw": F.xxhash64(F.lit(seed), "doc_id", "mark", "size")})
    dealt = keyed.join(sources, ["no_source", "source_key"]).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.col("shards")))
    kept = [f"__keep_{c}" for c in keep]
    shown = ["doc_id", "source", "size", "source_size", "target", "taken", *[F.col(f"__keep_{c}").alias(c) for c in keep]]
    # Documents without words stay out of the shards: nothing of them can be taken.
    some = dealt.where("size > 0")
    shards = some.groupBy("source_no", "shard").agg(F.sum("size").alias("size")).withColumn("cap", F.floor(F.ceil(F.col("size") / block) * F.lit(float(most))).cast("long"))
    shards = durable(shards, "mix-shards")
    quota = _shard_quotas(shards, table, max(counts, default=1)).select(F.col("source_no").alias("of_source"), F.col("shard").alias("of_shard"), F.ceil(F.col("size") / block).cast("long").alias("blocks"), F.col("quota").alias("run"))
    line = Window.partitionBy("source_no", "shard").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = some.select("doc_id", "source", "size", "source_size", "target", "source_no", "shard", "draw", *kept).withColumn("begin", F.sum("size").over(line) - F.col("size"))
    placed = placed.join(durable(quota, "mix-quotas"), (F.col("source_no") == F.col("of_source")) & (F.col("shard") == F.col("of_shard")))
    # Blocks first .. first + run - 1, counted on beyond the last block for further laps.
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), F.col("blocks"))
    taken = F.lit(0).cast("long")
    for lap in range(math.ceil(most) + 1):
        at = F.col("begin") + lap * block * F.col("blocks")
        taken = taken + F.greatest(F.lit(0).cast("long"), F.least(at + F.col("size"), block * (F.col("first") + F.col("run"))) - F.greatest(at, block * F.col("first")))
    mixed = placed.withColumn("first", first).withColumn("taken", taken.cast("long")).select(*shown)
    return mixed.unionByName(dealt.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*shown))

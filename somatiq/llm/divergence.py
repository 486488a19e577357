"""How far the sources of a language stand apart, term by term, by joint count histograms.

A term's share in a source is a function of its count there, so the distance of two sources does not
depend on which terms have which counts, only on how many terms have each pair of counts. For each
pair of sources of a language the distinct (count, count) combinations are tallied over all kept
terms, and the distance function is evaluated once per combination and multiplied.

Only terms that occur in both sources are ever met: map tasks list their combinations on small
integer codes and hand on the distinct ones with multiplicities. Cells with a zero are implied: of
the terms with a count in one source (a histogram of that source) those met in both are taken away,
and terms in neither are what remains of the kept terms. Work and rows grow with the combinations,
not with terms times pairs; the pairs themselves are the result, so every pair of sources of a
language is a row, and the number of sources bounds the cells of a term.

Edge cases: null text, lang and source are empty texts (and empty languages and sources groups like
others); texts of any length are counted whole; repeated rows count again; a group without terms
takes part with zero counts; a language without kept terms gives pairs of value 0 and no terms; equal
values are ranked by the item's UTF-8 bytes; an empty table gives an empty result; other columns are
ignored, whatever their names. Shares are exact: the product is a decimal of 38 digits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, give_back, small_batches

#: Bytes of UTF-8 that belong to terms, A-Z lower-cased; all others part them.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))
#: Terms that a map task counts before it hands them on.
MOST_COUNTED = 400_000
#: Cells of terms, and pairs of cells, that are tallied at once.
_CELLS, _PAIRS = 1 << 18, 1 << 22
SCALE = 1_000_000_000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, within) in groups.items():
                terms = list(times)
                for i in range(0, len(terms), 1 << 16):
                    part = terms[i : i + (1 << 16)]
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * len(part), pa.string()),
                            "source": pa.array([source] * len(part), pa.string()),
                            "term": pa.array(part, pa.binary()).cast(pa.string()),
                            "n": pa.array([times[t] for t in part], pa.int64()),
                            "docs": pa.array([within[t] for t in part], pa.int64()),
                        }
                    )
            groups.clear()

        held = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
                terms = text.translate(_TERMS).split()
                times, within = groups.setdefault((lang, source), (Counter(), Counter()))
                held -= len(times)
                times.update(terms)
                within.update(set(terms))
                held += len(times)
                if held > MOST_COUNTED:
                    yield from told()
                    held = 0
        yield from told()
        give_back()

    rows = small_batches(docs.select("lang", "source", "text")).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def joint_counts(term: np.ndarray, source: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(source a, count of a, source b, count of b, terms) of terms that two sources share, a < b.

    Cells are (term, source, count), at most one for each term and source. Parts of the pairs are
    tallied one after the other, so a combination may come more than once.
    """
    order = np.lexsort((source, term))
    term, source, n = term[order], source[order], n[order]
    # A code for each distinct (source, count).
    counts, rank = np.unique(n, return_inverse=True)
    codes, code = np.unique(source.astype(np.int64) * len(counts) + rank, return_inverse=True)
    ends = np.searchsorted(term, term, side="right")
    partners = ends - np.arange(len(term)) - 1
    upto = np.cumsum(partners)
    out, at = [], 0
    while at < len(term):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _PAIRS, side="right")))
        left = np.repeat(np.arange(at, to), partners[at:to])
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(partners[at:to]) - partners[at:to], partners[at:to])
        out.append(np.unique(code[left] << 32 | code[right], return_counts=True))
        at = to
    both = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
    times = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
    a, b = codes[both >> 32], codes[both & 0xFFFFFFFF]
    w = max(len(counts), 1)
    return a // w, counts[a % w] if len(counts) else a, b // w, counts[b % w] if len(counts) else b, times


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joint counts of rows (group: the language's number, cells: source number and count)."""
    held: list[pa.RecordBatch] = []
    cells = 0

    def told() -> Iterator[pa.RecordBatch]:
        lists = pa.chunked_array([b.column("cells") for b in held]).combine_chunks()
        flat = lists.flatten()
        term = pc.list_parent_indices(lists).to_numpy()
        a, n, b, m, times = joint_counts(term, flat.field("source").to_numpy(), flat.field("n").to_numpy())
        for i in range(0, len(a), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.record_batch({"a": a[part], "n": n[part], "b": b[part], "m": m[part], "times": times[part]})

    for batch in batches:
        held.append(batch)
        cells += len(batch.column("cells").flatten())
        if cells > _CELLS:
            yield from told()
            held, cells = [], 0
    if held:
        yield from told()
    give_back()


def share(n: Column, total: Column, kept: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale * (n + 5) / (total + 5 * kept)), exactly."""
    above = F.lit(scale).cast("decimal(12,0)") * (n.cast("decimal(20,0)") + F.lit(5).cast("decimal(1,0)")).cast("decimal(20,0)")
    below = (total + 5 * kept).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above.cast("decimal(38,0)"), below)


def source_divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and terms that stand out.

    Kept terms are those in at least ``least_docs`` documents of the language. A group is a source of
    a language; ``top`` terms of each are listed, and all its pairs.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    group_no = F.row_number().over(Window.orderBy("lang", "source")).cast("long")
    # A row for each source of a language: a dimension, so few that one task may number them.
    groups = durable(docs.select("lang", "source").distinct().select("lang", "source", group_no.alias("g")), "divergence-groups")
    counts = term_counts(docs).join(groups, ["lang", "source"])
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct(F.col("g").alias("source"), "n")).alias("cells"))
    terms = durable(terms.where(F.col("docs") >= least_docs).select("lang", "term", "all", "cells"), "divergence-terms")
    cells = terms.select("lang", "term", "all", F.inline("cells").alias("g", "n"))

    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("whole"))
    sums = cells.groupBy("g").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = durable(groups.join(langs, "lang", "left").join(sums, "g", "left").select("g", "lang", "source", zero("kept"), zero("whole"), zero("total"), zero("own")), "divergence-sums")

    # All cells of each pair's histogram: those met in both sources, and those implied by a zero.
    side = lambda x: groups.select(F.col("lang").alias("lang"), F.col("g").alias(x), F.col("total").alias(f"total_{x}"), F.col("own").alias(f"own_{x}"))
    pairs = groups.select("lang", F.col("g").alias("a"), "kept", F.col("total").alias("total_a"), F.col("own").alias("own_a")).join(side("b"), "lang").where("a < b").drop("lang")
    met = terms.select("cells").mapInArrow(_tally, "a long, n long, b long, m long, times long")
    none = F.lit(0).cast("long")
    cell = lambda n, m, times: F.struct(n.alias("n"), m.alias("m"), times.alias("times"))
    n, m, times = F.col("n"), F.col("m"), F.col("times")
    # A term met in both is no longer one of the terms of either alone, nor of neither.
    met = met.select("a", "b", F.inline(F.array(cell(n, m, times), cell(n, none, -times), cell(none, m, -times), cell(none, none, times))).alias("n", "m", "times"))
    alone = cells.groupBy("g", "n").agg(F.count("*").alias("times"))
    first = pairs.select("a", "b").join(alone.withColumnRenamed("g", "a"), "a").select("a", "b", "n", none.alias("m"), "times")
    second = pairs.select("a", "b").join(alone.withColumnRenamed("g", "b"), "b").select("a", "b", none.alias("n"), F.col("n").alias("m"), "times")
    neither = pairs.select("a", "b", none.alias("n"), none.alias("m"), (F.col("kept") - F.col("own_a") - F.col("own_b")).alias("times"))
    histogram = met.unionByName(first).unionByName(second).unionByName(neither).groupBy("a", "b", "n", "m").agg(F.sum("times").alias("times")).where("times <> 0")
    # The function once per combination, times the number of terms.
    apart = F.abs(share(F.col("n"), F.col("total_a"), F.col("kept")) - share(F.col("m"), F.col("total_b"), F.col("kept")))
    distance = histogram.join(pairs, ["a", "b"]).groupBy("a", "b").agg(F.sum(apart * F.col("times")).alias("value"))
    distance = pairs.select("a", "b").join(distance, ["a", "b"], "left").select("a", "b", F.coalesce("value", F.lit(0)).alias("value"))
    named = groups.select("g", "lang", "source")
    both = distance.select(F.inline(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("other"), "value"), F.struct(F.col("b").alias("g"), F.col("a").alias("other"), "value"))))
    both = both.join(named, "g").join(named.select(F.col("g").alias("other"), F.col("source").alias("item")), "other")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    more = cells.join(groups.drop("lang"), "g")
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("all"), F.col("whole"), F.col("kept"))
    more = more.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    more = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return both.unionByName(more.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

"""Toxicity: a factorization machine over hashed terms.

A document is the set of its words and word beginnings, hashed into a fixed number of buckets. A
bounded sample of labelled documents tells how surely each bucket says something about the label;
that evidence is the bucket's value, and every bucket with significant evidence counts, however
many these are. The machine learns a weight and a short vector for each, so that pairs of terms
(an insult with a group's name) count beyond what each says by itself.

Edge cases: a null text is empty, and texts without known terms get the base score; a text of any
length counts whole, as one set; without labels, or with one class only, every score is the share
of ones (one half without labels); repeated rows and ids, also null ones, are rows of their own,
each learned from if its id is labelled; an empty table gives an empty result; extra columns stay,
and one named like the score is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, durable, small_batches, text_slices, without
from .learn import label_sample
from .textkern import word_hashes

BUCKET_BITS = 18
MOST_LABELLED = 16_000
#: A term that fewer labelled documents hold says nothing yet.
LEAST_DOCS = 3
#: Chi-square that a term needs (one in twenty reaches it by chance); how many terms there are is not bounded.
SIGNIFICANT = 3.84
#: The chi-square at which a term's evidence is a quarter.
HALF_EVIDENCE = 30.0
#: Weight of a toxic document in the loss: they are few, and a missed one costs more.
TOXIC_WEIGHT = 3.0


def hashed_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each word and of its first four and five bytes.

    Word beginnings stand for inflected and derived forms. Punctuation is ignored.
    """
    bare = data.copy()
    # Stops, commas and the like part words from the hash as white space does.
    bare[np.isin(data, np.frombuffer(b".,;:!?\"()[]{}<>*#$%&|", np.uint8))] = 32
    h, doc, four, five = word_hashes(bare, offsets, (4, 5))
    h, doc = np.concatenate([h, four, five]), np.concatenate([doc, doc, doc])
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), doc


@dataclass
class Machine:
    """w0 + sum x_i w_i + sum <x_i v_i, x_j v_j> over the distinct buckets of a document.

    The evidence x is already multiplied into w and v; a row for each bucket, all zeros for those
    that no sampled document (or fewer than LEAST_DOCS) holds.
    """

    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, term: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        out = self.w0 + np.bincount(doc, self.w[term], n)
        for k in range(self.v.shape[1]):
            col = self.v[term, k]
            out += 0.5 * (np.bincount(doc, col, n) ** 2 - np.bincount(doc, col**2, n))
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        bucket, doc = hashed_terms(data, offsets)
        told = self.w[bucket] != 0
        pairs = np.unique(doc[told] << BUCKET_BITS | bucket[told])
        return 1 / (1 + np.exp(-np.clip(self.margin(pairs & ((1 << BUCKET_BITS) - 1), pairs >> BUCKET_BITS, n), -700, 700)))


def evidence(df: np.ndarray, hit: np.ndarray, docs: int, toxic: int) -> np.ndarray:
    """How surely each bucket tells something about the label: 0, or a value up to 1.

    df, hit: labelled documents, and toxic ones, that hold the bucket.
    """
    share = toxic / max(docs, 1)
    expect = df * share
    chi = (hit - expect) ** 2 / np.maximum(expect * (1 - share), 1e-9)
    return np.where((df >= LEAST_DOCS) & (chi > SIGNIFICANT), (chi / (chi + HALF_EVIDENCE)) ** 2, 0.0)


def fit_machine(terms: list[np.ndarray], y: np.ndarray, worth: np.ndarray | None = None, factors: int = 6, epochs: int = 10, batch: int = 256, rate: float = 0.05, decay: float = 2e-4, calm: float = 3e-4, seed: int = 5) -> Machine:
    """terms: the distinct buckets of each document; y: its label; worth: the buckets' evidence. Logistic loss, Adam.

    calm is Adam's epsilon: gradients far below it, those of buckets with little evidence, take
    steps in proportion to them and not of the full rate.
    """
    share = float(y.mean()) if len(y) else 0.5
    w0 = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    w, v = np.zeros(1 << BUCKET_BITS), np.zeros((1 << BUCKET_BITS, factors))
    if not len(y) or share in (0.0, 1.0):
        return Machine(w0, w, v)
    flat, doc = np.concatenate(terms).astype(np.int64), np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    if worth is None:
        worth = evidence(np.bincount(flat, minlength=1 << BUCKET_BITS).astype(float), np.bincount(flat, y[doc], minlength=1 << BUCKET_BITS), len(y), int(y.sum()))
    keep = worth[flat] > 0
    chosen, flat = np.unique(flat[keep], return_inverse=True)
    doc, n = doc[keep], len(chosen)
    begin = np.searchsorted(doc, np.arange(len(y) + 1))
    x = worth[chosen].astype(np.float32)
    rng = np.random.default_rng(seed)
    theta = np.zeros((n, factors + 1), np.float32)
    theta[:, 1:] = rng.normal(0, 0.05, (n, factors))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    b1, b2 = 0.0, 0.0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at : at + batch]
            counts = begin[rows + 1] - begin[rows]
            local = np.repeat(np.arange(len(rows)), counts)
            where = np.arange(len(local)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin[rows], counts)
            t = flat[where]
            own = theta[t] * x[t, None]
            sums = np.stack([np.bincount(local, own[:, k], len(rows)) for k in range(factors + 1)], 1)
            squares = np.stack([np.bincount(local, own[:, k] ** 2, len(rows)) for k in range(1, factors + 1)], 1)
            z = w0 + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * np.where(y[rows] == 1, TOXIC_WEIGHT, 1.0) / len(rows)
            g_t = g[local]
            grad = np.empty((n, factors + 1), np.float32)
            grad[:, 0] = np.bincount(t, g_t, n) * x
            for k in range(1, factors + 1):
                grad[:, k] = np.bincount(t, g_t * (sums[local, k] - own[:, k]), n) * x
            grad += decay * theta
            step += 1
            pace = rate * (1 - epoch / epochs)
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            theta -= pace / (1 - 0.9**step) * first / (np.sqrt(second / (1 - 0.999**step)) + calm)
            g0 = g.sum()
            b1 += 0.1 * (g0 - b1)
            b2 += 0.001 * (g0**2 - b2)
            w0 -= pace * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.999**step)) + 1e-8)
    w[chosen], v[chosen] = theta[:, 0] * x, theta[:, 1:] * x[:, None]
    return Machine(w0, w, v)


def train_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, column: str = "toxic", most: int = MOST_LABELLED) -> Machine:
    """A machine from at most ``most`` of the labelled documents that ``usable`` (over label_id) admits.

    Two passes over these documents: the first counts documents by bucket and label, which is one
    row a bucket at most; the second brings to the driver only the buckets that tell something.
    """
    sample = F.broadcast(label_sample(labels, column, usable, most))
    chosen = small_batches(docs).select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text")).join(sample, "label_id").select("label_id", "label", "text")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                bucket, doc = hashed_terms(data, offsets)
                pairs = np.unique(doc << BUCKET_BITS | bucket)
                cut = np.searchsorted(pairs >> BUCKET_BITS, np.arange(rows.num_rows + 1)).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(cut), pa.array((pairs & ((1 << BUCKET_BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), own], names=["label_id", "label", "terms"])

    told = durable(chosen.mapInArrow(buckets, "label_id long, label int, terms array<int>"), "fm-terms")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, hit = np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(np.array(lists.offsets))
            flat, toxic = np.array(lists.flatten()), np.repeat(np.array(batch.column(0)), sizes) > 0
            df += np.bincount(flat, minlength=len(df))
            hit += np.bincount(flat[toxic], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some]), pa.array(hit[some])], names=["bucket", "df", "hit"])

    counted = told.select("label", "terms").mapInArrow(count, "bucket int, df long, hit long").groupBy("bucket").agg(F.sum("df").alias("df"), F.sum("hit").alias("hit")).toArrow()
    totals = told.agg(F.count(F.lit(1)), F.sum("label")).first()
    df, hit = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    at = np.array(counted.column("bucket"), np.int64)
    df[at], hit[at] = np.array(counted.column("df"), float), np.array(counted.column("hit"), float)
    worth = evidence(df, hit, totals[0], totals[1] or 0)
    telling = docs.sparkSession.sparkContext.broadcast(worth > 0)

    def keep_telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, offsets = np.array(lists.flatten()), np.array(lists.offsets)
            keep = telling.value[flat] if len(flat) else np.zeros(0, bool)
            cut = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(cut), pa.array(flat[keep]))], names=["label_id", "label", "terms"])

    got = told.mapInArrow(keep_telling, "label_id long, label int, terms array<int>").toArrow().combine_chunks()
    discard(told)
    y, ids = np.array(got.column("label"), float), np.array(got.column("label_id"), np.int64)
    # Rows of one id follow each other by their terms, so that reruns learn alike.
    lists = got.column("terms").to_numpy(zero_copy_only=False) if got.num_rows else []
    order = sorted(range(len(ids)), key=lambda i: (ids[i], len(lists[i]), lists[i].tobytes()))
    return fit_machine([np.asarray(lists[i], np.int64) for i in order], y[order], worth)


def score_toxicity(docs: DataFrame, model: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of docs and the score of each row's whole text; a column of that name is replaced."""
    docs = without(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(data, offsets))], names=[*fields, name])

    return small_batches(docs).mapInArrow(run, schema)

"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on quantile histograms (logistic loss) from a bounded sample of
labelled documents, and flattened into arrays (feature, threshold, leaf value) that numpy
traverses for all documents of a batch at once.

Edge cases: a null text is empty, and empty texts get a score like any other; a text of any length
counts whole; without labels, or with one class only, every score is the share of ones (one half
without labels); repeated rows and ids, also null ones, are rows of their own, each learned from if
its id is labelled; an empty table gives an empty result; extra columns stay, and one named like
the score is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_slices, without
from .learn import label_sample
from .textkern import mix64, shingle_hashes, word_hashes, word_starts

#: Most labelled documents that the trees are grown from.
MOST_LABELLED = 24_000
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (32, 9, 11, 12, 13), "newline": (10,), "stop": (46, 44, 59, 58, 63), "bang": (33,), "bar": (124,),
    "sign": (35, 36, 37, 38, 42, 43, 61, 94, 95, 126, 64), "bracket": (40, 41, 91, 93, 123, 125, 60, 62), "slash": (47, 92), "quote": (34, 39, 96), "wide": range(128, 256), "control": (*range(9), *range(14, 32), 127),
}
FEATURES = (
    "log_bytes", "log_words", *(f"share_{c}" for c in _CLASSES), "word_mean", "word_sd", "word_longest", "distinct_words", "repeat_next", "repeat_second", "distinct_fours", "top_word",
    "capital_start", "all_caps", "line_mean", "distinct_lines", "sign_words", "stop_per_word", "bang_per_word", "bar_per_word",
)
_CLASS_OF = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_CLASSES[_c])] = _i + 1


def _distinct_share(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct values over values of each document (1 without any)."""
    total = np.bincount(doc, minlength=n)
    key = np.sort(mix64(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(12) | (doc.astype(np.uint64) << np.uint64(52)))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[first] >> np.uint64(52)).astype(np.int64), minlength=n)
    return np.where(total > 0, distinct / np.maximum(total, 1), 1.0)


def _top_share(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Share of the most frequent word of each document."""
    key = np.sort((h >> np.uint64(12)) | (doc.astype(np.uint64) << np.uint64(52)))
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[starts, len(key)])
    most = np.zeros(n)
    np.maximum.at(most, (key[starts] >> np.uint64(52)).astype(np.int64), runs)
    return most / np.maximum(np.bincount(doc, minlength=n), 1)


def document_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    kinds = np.bincount(owner * 16 + _CLASS_OF[data], minlength=n * 16).reshape(n, 16)
    share = kinds[:, 1 : 1 + len(_CLASSES)] / np.maximum(size, 1)[:, None]
    h, doc = word_hashes(data, offsets)
    inside, starts, _ = word_starts(data, offsets)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    length = np.add.reduceat(inside.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    mean = np.bincount(doc, length, n) / some
    sd = np.sqrt(np.maximum(np.bincount(doc, length.astype(float) ** 2, n) / some - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    near = lambda k: np.bincount(doc[k:][(h[k:] == h[:-k]) & (doc[k:] == doc[:-k])], minlength=n) / some
    fours, fdoc = shingle_hashes(h, doc, n, 4)
    first = data[starts] if len(starts) else np.zeros(0, np.uint8)
    caps = (_CLASS_OF[data] == 1).astype(np.int64)
    signs = np.isin(_CLASS_OF[data], (8, 9)).astype(np.int64)
    per_word = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0, np.int64)
    # Lines: their hashes, from the words in them.
    line = np.cumsum(data == 10)
    if len(starts):
        at = line[starts] + doc  # a new document is a new line
        begins = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
        order = (np.arange(len(h)) - np.repeat(begins, np.diff(np.r_[begins, len(h)]))).astype(np.uint64)
        lines = mix64(np.add.reduceat(h * (order * np.uint64(2) + np.uint64(1)), begins))
        line_doc = doc[begins]
    else:
        lines, line_doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    columns = [
        np.log1p(size), np.log1p(words), *share.T, mean, sd, longest, _distinct_share(h, doc, n), near(1), near(2), _distinct_share(fours, fdoc, n), _top_share(h, doc, n),
        np.bincount(doc, (_CLASS_OF[first] == 1), n) / some, np.bincount(doc, per_word(caps) >= np.maximum(length, 2), n) / some, words / np.maximum(np.bincount(line_doc, minlength=n), 1), _distinct_share(lines, line_doc, n),
        np.bincount(doc, per_word(signs) > 0, n) / some, kinds[:, 6] / some, kinds[:, 7] / some, kinds[:, 8] / some,
    ]
    return np.stack(columns, 1)


@dataclass
class Trees:
    """Complete binary trees of one depth: inner nodes in level order, then leaves."""

    base: float
    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(self.leaf.shape[1]).bit_length() - 1 if len(self.leaf) else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - len(f)]
        return 1 / (1 + np.exp(-total))


def grow_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 48, ridge: float = 1.0, least: float = 4.0) -> Trees:
    """Newton boosting of the logistic loss on quantile histograms."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not len(y) or share in (0.0, 1.0):
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    margin = np.full(len(y), base)
    feats, cuts, outs = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        f_tree, t_tree = np.zeros(inner, np.int64), np.full(inner, np.inf)
        b_tree = np.full(inner, bins)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            local = at - first
            best = np.full(n, 1e-9)
            for j in range(x.shape[1]):
                cell = local * bins + binned[:, j]
                gs, hs = (np.bincount(cell, w, n * bins).reshape(n, bins).cumsum(1) for w in (g, h))
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                gain[(hs < least) | (ha - hs < least)] = 0
                gain = gain[:, : len(edges[j])]
                if not gain.size:
                    continue
                k = gain.argmax(1)
                better = gain[np.arange(n), k] > best
                best[better] = gain[np.arange(n), k][better]
                node = first + np.flatnonzero(better)
                f_tree[node], b_tree[node], t_tree[node] = j, k[better], edges[j][k[better]]
            at = 2 * at + 1 + (binned[np.arange(len(y)), f_tree[at]] > b_tree[at])
        at -= inner
        value = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        margin += value[at]
        feats.append(f_tree)
        cuts.append(t_tree)
        outs.append(value)
    return Trees(base, np.array(feats), np.array(cuts), np.array(outs))


def _statistics_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for rows, data, offsets in text_slices(batch, column):
            yield rows, document_statistics(data, offsets)


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column, column: str = "quality", most: int = MOST_LABELLED) -> Trees:
    """Trees from the labelled documents that ``usable`` (over label_id) admits."""
    sample = F.broadcast(label_sample(labels, column, usable, most))
    chosen = small_batches(docs).select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text")).join(sample, "label_id").select("label_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _statistics_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["label_id", "label", "x"])

    got = chosen.mapInArrow(run, "label_id long, label int, x array<double>").toArrow()
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES)) if got.num_rows else np.zeros((0, len(FEATURES)))
    # Rows of one id follow each other by their statistics, so that reruns learn alike.
    order = np.lexsort((*x.T, np.array(got.column("label_id"))))
    return grow_trees(x[order], np.array(got.column("label"), float)[order])


def score_quality(docs: DataFrame, model: Trees, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of docs and the score of each row's whole text; a column of that name is replaced."""
    docs = without(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _statistics_batches(batches, text_col):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(x))], names=[*fields, name])

    return small_batches(docs).mapInArrow(run, schema)

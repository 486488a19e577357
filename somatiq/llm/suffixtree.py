"""Language-model scores from a probabilistic suffix tree.

Symbols are the UTF-8 bytes of lower-cased words, a blank after each word and one end mark; a text
without words is its end mark. Over all training documents, runs of depth + 1 symbols are counted.
Every context of up to ``depth`` symbols that occurs ``least`` times is a candidate, so their number
grows with the corpus. A context is retained if its next-symbol distribution diverges from that of
its suffix by more than a penalty for each next symbol, as are the suffixes of retained contexts.
Distributions are smoothed by back-off to the suffix, down to all 256 bytes, and sum to one.

Contexts that agree in their last three symbols are learned in one task, from their suffixes'
distributions and the aggregated counts; the tree is written as a table of log probabilities by
context and symbol. For scoring it is dealt into parts of bounded size by these three symbols: each
part passes over the documents and scores the places whose last symbols are its own, from the
longest retained suffix there. One part is enough for some gigabytes of text.

Beside the model's score there is a unigram base: its word counts are corpus statistics too. Words
above a share of all tokens, hence boundedly many, are broadcast; all others meet their counts in
a shuffle join on 64-bit hashes.

Edge cases: a null text is empty; a text of any length counts whole; without training documents the
tree is the uniform distribution and every token unknown; repeated and null ids are rows of their
own; an empty table gives an empty result; extra columns are ignored (but may tell the training
rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, small_batches, text_slices, with_row_numbers, without
from .embeddings import whole_groups
from .textkern import _LOWER, _SPACE, mix64, word_hashes

#: The end mark, the blank, and what lies before a text's beginning: no word holds these bytes.
END, BLANK, NOTHING = 10, 32, 9
DEPTH = 6
#: Occurrences that a context needs before it is tested.
LEAST = 24
#: Contexts of so many symbols are learned by the driver (at most 256 ** 3 counts, in practice some ten thousand).
SHORT = 2
#: Most entries of a part of the tree: about 100 MB in each worker.
MOST_ENTRIES = 4_000_000
#: Divergence (in nats over all occurrences) that a context needs, per next symbol and log count: half, as in BIC.
PENALTY = 0.5
#: Weight of the suffix's distribution, per next symbol.
BACK_OFF = 4.0
#: Least share of all tokens of a common word: at most 1 / share words.
COMMON_SHARE = 5e-6


def symbol_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, one after the other; offsets): each word and a BLANK, then END."""
    n = len(offsets) - 1
    grown = np.insert(_LOWER[data], np.repeat(offsets[1:], 2), np.tile(np.array([BLANK, END], np.uint8), n))
    marks = offsets[1:] + 2 * np.arange(n) + 1
    space = _SPACE[grown]
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[marks] = True
    grown[space] = BLANK
    grown[marks] = END
    upto = np.cumsum(keep)
    return grown[keep], np.concatenate([[0], upto[marks]])


def run_codes(symbols: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """For each place the symbol (lowest byte) and the depth symbols before it, nearest first.

    Before a text stands one END, and NOTHING beyond it.
    """
    n = len(symbols)
    back = np.arange(n, dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))  # symbols before, in the text
    padded = np.concatenate([np.full(1, END, np.uint8), symbols])
    code = symbols.astype(np.uint64)
    for i in range(1, depth + 1):
        earlier = np.full(n, NOTHING, np.uint64)
        if n >= i:
            earlier[i - 1 :] = padded[: n - i + 1]
        earlier[back < i - 1] = NOTHING
        code |= earlier << np.uint64(8 * i)
    return code


class _Counts:
    """Sums of counts by 64-bit key, merged now and then."""

    def __init__(self) -> None:
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        u, c = np.unique(keys, return_counts=True)
        self.keys.append(u)
        self.counts.append(c)
        self.held += len(u)
        if self.held > 3_000_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.keys, self.counts = [keys[first]], [np.add.reduceat(counts, first)]
        self.held = len(first)
        return self.keys[0], self.counts[0]


def corpus_counts(train: DataFrame, depth: int = DEPTH) -> DataFrame:
    """kind (0 word, 1 run of symbols, 2 documents), key, n over all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs, docs = _Counts(), _Counts(), 0
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                words.add(word_hashes(data, offsets)[0])
                runs.add(run_codes(*symbol_stream(data, offsets), depth))
                docs += rows.num_rows
        for kind, (keys, counts) in enumerate((words.merge(), runs.merge(), (np.zeros(1, np.uint64), np.array([docs])))):
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part.view(np.int64)), pa.array(counts[at : at + 100_000])], names=["kind", "key", "n"])

    return train.mapInArrow(run, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _mask(symbols: int) -> np.uint64:
    return np.uint64((1 << 8 * symbols) - 1)


def pair_key(run: np.ndarray, length: int) -> np.ndarray:
    """A run (context of this length, then a symbol) as the key of an entry."""
    return (run & _mask(length + 1)) | np.uint64((length + 1) << 56)


def context_key(run: np.ndarray, length: int) -> np.ndarray:
    """The context of a run as the key of an entry."""
    return ((run >> np.uint64(8)) & _mask(length)) | np.uint64((0x80 | (length + 1)) << 56)


class Entries:
    """Log probabilities by key: open addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.float32)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.keys[at[left]] == 0
            self.keys[at[left[free]]] = keys[left[free]]
            mine = self.keys[at[left]] == keys[left]
            self.values[at[left[mine]]] = values[left[mine]]
            left = left[~mine]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the keys that are there, their values)."""
        at = self._place(keys)
        got = self.keys[at]
        hit = got == keys
        found, slots = [np.flatnonzero(hit)], [at[hit]]
        left = np.flatnonzero(~hit & (got != 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            got, want = self.keys[at[left]], keys[left]
            hit = got == want
            found.append(left[hit])
            slots.append(at[left[hit]])
            left = left[~hit & (got != 0)]
        return np.concatenate(found), self.values[np.concatenate(slots)]


@dataclass
class Level:
    """Contexts of one length: runs (sorted) with their smoothed probabilities, and what tests say of their contexts."""

    run: np.ndarray
    p: np.ndarray
    context: np.ndarray  # sorted
    of_run: np.ndarray
    weight: np.ndarray  # share that goes to the suffix's distribution
    kept: np.ndarray

    def entries(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        keep = self.kept[self.of_run]
        keys = np.concatenate([pair_key(self.run[keep], length), context_key(self.context[self.kept] << np.uint64(8), length)])
        return keys, np.log10(np.concatenate([self.p[keep], self.weight[self.kept]])).astype(np.float32)

    def keep_suffixes_of(self, contexts: np.ndarray) -> None:
        at = np.searchsorted(self.context, contexts)
        inside = at < len(self.context)
        at, contexts = at[inside], contexts[inside]
        self.kept[at[self.context[at] == contexts]] = True


def learn_level(code: np.ndarray, count: np.ndarray, length: int, below_run: np.ndarray, below_p: np.ndarray, least: int) -> Level:
    """code, count: runs of at least length + 1 symbols; below: runs of the level before and their probabilities."""
    known = ((code >> np.uint64(8 * length)) & np.uint64(255)) != NOTHING if length else np.ones(len(code), bool)
    run, inverse = np.unique(code[known] & _mask(length + 1), return_inverse=True)
    n = np.bincount(inverse, count[known], len(run))
    context, of_run = np.unique(run >> np.uint64(8), return_inverse=True)
    total, kinds = np.bincount(of_run, n, len(context)), np.bincount(of_run, minlength=len(context))
    shorter = run & _mask(length) if length else run
    below = below_p[np.searchsorted(below_run, shorter)] if len(run) else np.zeros(0)
    weight = BACK_OFF * kinds
    p = (n + weight[of_run] * below) / (total + weight)[of_run]
    gain = np.bincount(of_run, n * np.log(n / total[of_run] / np.maximum(below, 1e-300)), len(context))
    return Level(run, p, context, of_run, weight / np.maximum(total + weight, 1), (total >= least) & (gain > PENALTY * kinds * np.log(np.maximum(total, 1))))


def learn_root(symbol: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Probabilities of all 256 symbols without a context."""
    n = np.bincount(symbol.astype(np.int64), count, 256)
    kinds = max(1, int((n > 0).sum()))
    return (n + kinds / 256) / (n.sum() + kinds)


@dataclass
class SuffixTree:
    """What every part shares, and where its own groups of contexts begin."""

    root: np.ndarray  # log10 probability of each symbol
    short: Entries
    long: Entries
    depth: int
    part: int = 0
    parts: int = 1

    def places(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol of the stream at the places of this part, 0 at others."""
        code = run_codes(symbols, offsets, self.depth)
        out = np.zeros(len(code))
        left = np.arange(len(code)) if self.parts == 1 else np.flatnonzero(spread(code) % self.parts == self.part)
        code = code[left]
        for length in range(self.depth, 0, -1):
            table = self.short if length <= SHORT else self.long
            at, value = table.find(pair_key(code, length))
            out[left[at]] += value
            rest = np.ones(len(left), bool)
            rest[at] = False
            left, code = left[rest], code[rest]
            # The context is known but not this symbol after it: on to its suffix.
            at, value = table.find(context_key(code, length))
            out[left[at]] += value
        out[left] += self.root[symbols[left]]
        return out

    def score(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text of the stream (its share at the places of this part)."""
        return np.add.reduceat(self.places(symbols, offsets), offsets[:-1]) if len(symbols) else np.zeros(0)


def spread(run: np.ndarray) -> np.ndarray:
    """A number that the last SHORT + 1 symbols of a run's context decide; parts are dealt by it."""
    return (mix64((run >> np.uint64(8)) & _mask(SHORT + 1)) >> np.uint64(33)).astype(np.int64)


def learn_long(batches: Iterator[pa.RecordBatch], below: tuple[np.ndarray, np.ndarray], depth: int, least: int) -> Iterator[pa.RecordBatch]:
    """spread, group, key, value of the retained contexts of more than SHORT symbols, from sorted (group, key, n)."""
    for rows, _, _ in whole_groups(batches, ["group"], 200_000):
        code, n = np.array(rows.column("key"), np.int64).view(np.uint64), np.array(rows.column("n"), float)
        levels, last = [], below
        for length in range(SHORT + 1, depth + 1):
            level = learn_level(code, n, length, *last, least)
            levels.append(level)
            last = level.run, level.p
        for length in range(depth, SHORT + 1, -1):
            level = levels[length - SHORT - 1]
            levels[length - SHORT - 2].keep_suffixes_of(level.context[level.kept] & _mask(length - 1))
        for length, level in zip(range(SHORT + 1, depth + 1), levels, strict=True):
            key, value = level.entries(length)
            plain = np.where(key >> np.uint64(63) == 1, key << np.uint64(8), key)  # as a run
            group = (plain >> np.uint64(8)) & _mask(SHORT + 1)
            for at in range(0, len(key), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(spread(plain[part])), pa.array(group[part].astype(np.int64)), pa.array(key[part].view(np.int64)), pa.array(value[part])], names=["spread", "group", "key", "value"])


def fit_tree(counts: DataFrame, depth: int = DEPTH, least: int = LEAST) -> tuple[np.ndarray, Entries, DataFrame]:
    """(log probabilities of the root, entries of short contexts, table of all other entries)."""
    spark = counts.sparkSession
    runs = counts.where("kind = 1").select("key", "n")
    first = runs.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (SHORT + 1)) - 1)).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    code, n = np.array(first.column("key"), np.int64).view(np.uint64), np.array(first.column("n"), float)
    root = learn_root(code & np.uint64(255), n)
    levels, last = [], (np.arange(256, dtype=np.uint64), root)
    for length in range(1, SHORT + 1):
        level = learn_level(code, n, length, *last, least)
        levels.append(level)
        last = level.run, level.p
    held = spark.sparkContext.broadcast(last)
    grouped = runs.select(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (SHORT + 1)) - 1)).alias("group"), "key", "n")
    grouped = grouped.repartition("group").sortWithinPartitions("group")
    long = durable(grouped.mapInArrow(lambda b: learn_long(b, held.value, depth, least), "spread long, group long, key long, value float"), "pst-tree")
    needed = np.array(long.select("group").distinct().toArrow().column("group"), np.int64).view(np.uint64)
    for length in range(SHORT, 0, -1):
        level = levels[length - 1]
        level.keep_suffixes_of(np.unique(needed & _mask(length)))
        needed = level.context[level.kept]
    told = [level.entries(length) for length, level in enumerate(levels, 1)]
    return np.log10(root), Entries(*(np.concatenate(x) for x in zip(*told, strict=True))), long


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    train: a boolean expression over docs that says which rows are learned from.
    """
    spark = docs.sparkSession
    docs = small_batches(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), train.alias("train"))
    counts = durable(corpus_counts(rows.where("train").select("text"), depth), "pst-counts")
    root, short, long = fit_tree(counts, depth)
    parts = max(1, -(-long.count() // MOST_ENTRIES))

    def tree(part: int) -> SuffixTree:
        own = (long if parts == 1 else long.where(F.col("spread") % parts == part)).select("key", "value").toArrow()
        return SuffixTree(root, short, Entries(np.array(own.column("key"), np.int64).view(np.uint64), np.array(own.column("value"), np.float32)), depth, part, parts)

    words = counts.where("kind = 0")
    told = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    ends = counts.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    tokens, distinct = (told[0] or 0) + ends, told[1] + (ends > 0)
    whole = float(np.log10(tokens + 0.1 * (distinct + 1)))
    most = max(2.0, COMMON_SHARE * tokens)
    common = words.where(F.col("n") >= most).select("key", "n").toArrow()
    keys = np.array(common.column("key"), np.int64).view(np.uint64)
    order = np.argsort(keys)
    held = spark.sparkContext.broadcast((keys[order], np.log10(np.array(common.column("n"), float)[order] + 0.1), tree(0)))
    end_score = float(np.log10(ends + 0.1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs, model = held.value
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                n = part.num_rows
                h, doc = word_hashes(data, offsets)
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                score = model.score(*symbol_stream(data, offsets))
                n_tokens = np.bincount(doc, minlength=n) + 1
                n_known = np.bincount(doc[hit], minlength=n) + (ends > 0)
                # Rarer words count as unknown until the join says otherwise.
                base = np.bincount(doc[hit], logs[at[hit]], n) - (np.bincount(doc[~hit], minlength=n)) + end_score - n_tokens * whole
                rid = np.array(part.column(2))
                rare, owner = h[~hit], doc[~hit]
                if len(rare):
                    order = np.lexsort((rare, owner))
                    rare, owner = rare[order], owner[order]
                    first = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])])
                    times = np.diff(np.r_[first, len(rare)])
                    rare, owner = rare[first], owner[first]
                else:
                    times = np.zeros(0, np.int64)
                keys_out = np.concatenate([(rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), rare.view(np.int64)])
                told = pa.StructArray.from_arrays(
                    [pa.concat_arrays([c.cast(t), pa.nulls(len(rare), t)]) for c, t in ((part.column(0), pa.int64()), (pa.array(n_tokens), pa.int64()), (pa.array(n_known), pa.int64()), (pa.array(base), pa.float64()), (pa.array(score), pa.float64()))],
                    names=["doc_id", "n_tokens", "n_known", "base", "score"], mask=pa.array(np.r_[np.zeros(n, bool), np.ones(len(rare), bool)]),
                )
                yield pa.RecordBatch.from_arrays([pa.array(keys_out), pa.array(np.concatenate([rid, rid[owner]])), pa.array(np.concatenate([np.zeros(n, np.int32), times.astype(np.int32)])), told], names=["key", "rid", "times", "told"])

    # One scan may number rows as it meets them; several must agree on the numbers, however each is split.
    held_rows = without(docs, "__rid").transform(lambda d: with_row_numbers(d, "__rid") if parts > 1 else d.withColumn("__rid", F.monotonically_increasing_id()))
    numbered = held_rows.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col("__rid").alias("rid"))
    told = "struct<doc_id: long, n_tokens: long, n_known: long, base: double, score: double>"
    stream = numbered.mapInArrow(run, f"key long, rid long, times int, told {told}")
    # Further parts of a large tree add what they have to say of a text.
    for part in range(1, parts):
        stream = stream.unionByName(_part_scores(numbered, spark.sparkContext.broadcast(tree(part))).select("rid", F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("n_tokens", "long"), ("n_known", "long"), ("base", "double"))], "score").alias("told")), allowMissingColumns=True)
    met = stream.join(words.where(F.col("n") < most).select("key", "n"), "key", "left")
    gained = F.col("times") > 0
    per_doc = met.groupBy("rid").agg(
        F.max(F.when(F.col("told.n_tokens").isNotNull(), F.col("told"))).alias("told"),
        F.sum("told.score").alias("score"),
        F.coalesce(F.sum(F.when(gained & F.col("n").isNotNull(), F.col("times") * (F.log10(F.col("n") + F.lit(0.1)) + 1))), F.lit(0.0)).alias("more"),
        F.coalesce(F.sum(F.when(gained & F.col("n").isNotNull(), F.col("times"))), F.lit(0)).alias("met"),
    )
    return per_doc.select("told.doc_id", "told.n_tokens", (F.col("told.n_known") + F.col("met")).cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), (F.col("told.base") + F.col("more")).alias("base_score"), "score")


def _part_scores(numbered: DataFrame, held: Broadcast) -> DataFrame:
    """rid, score: what a further part of the tree adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(held.value.score(*symbol_stream(data, offsets)))], names=["rid", "score"])

    return numbered.select("text", "rid").mapInArrow(run, "rid long, score double")

"""Spelling variants of the words of a corpus, by rolling-hash deletion keys.

Words are counted in the map tasks. Two words are near if one inserted, deleted or replaced code
point turns one into the other. With prefix sums of a polynomial hash, the hash of a word without
its j-th code point is the sum of a prefix and a shifted suffix, so numpy makes all deletion keys of
a batch of words at once:

* a word and one deletion of another have the same hash: one was made by an insertion;
* two deletions at the same place of words of one length have the same hash: a replacement.

Keys (of 64 bits, with the word's number instead of its text) are dealt by value and sorted in their
task. Keys in company that can mean a link fetch the words, and only equal strings count, so a
collision of hashes changes nothing. No pair is ever listed: a group of equal deletions gives each
member its number of partners and the best other member, and both are summed per word. Groups are
small by nature: of one string there are as many replacements as letters, and as many insertions as
letters times places.

Edge cases: a null text has no words; a null doc_id is written as the empty text before the colon;
a run of any length is one word of its own, and sends its text only where it has company; repeated
rows count again; equal counts go to the smaller word; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, durable, give_back, small_batches
from .textkern import mix64

#: Bytes of Latin-1 that are letters here, A-Z lower-cased; all others part the runs.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: Words that a map task counts before it hands them on.
MOST_COUNTED = 400_000
#: Deletion keys that one task sorts.
KEYS_A_TASK = 2_000_000
#: Code points of words whose keys are made at once.
_SLICE = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Kinds of keys: a deletion with its place, a deletion, a whole word.
REPLACED, SHORTENED, WHOLE = 0, 1, 2


def runs_of(text: str) -> list[bytes]:
    """The letter runs of a text in Latin-1, in which a byte is a code point, with A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _checksum(run: bytes, start: int) -> int:
    return zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)


def count_text(counts: Counter, doc_id: str, text: str, every: int) -> None:
    """Add the runs of one text; those whose checksum with the id ``every`` divides lose a code point."""
    runs = runs_of(text)
    own = Counter(runs)
    start = zlib.crc32(f"{doc_id}:".encode())
    counts.update(runs)
    for run, times in own.items():
        h = _checksum(run, start)
        if not h % every:
            at = h % len(run)
            counts[run] -= times
            counts[run[:at] + run[at + 1 :]] += times


def word_counts(docs: DataFrame, every: int = 97, shortest: int = 5) -> DataFrame:
    """word, n: the words of at least ``shortest`` code points with their occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def told() -> pa.RecordBatch:
            kept = [w for w, n in counts.items() if n and len(w) >= shortest]
            out = pa.record_batch({"word": pa.array([w.decode("latin-1") for w in kept], pa.string()), "n": pa.array([counts[w] for w in kept], pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    count_text(counts, doc_id, text, every)
                if len(counts) > MOST_COUNTED:
                    yield told()
        if counts:
            yield told()
        give_back()

    rows = small_batches(docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def deletion_keys(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, word, place, kind) of all deletions of the words and of the words themselves.

    ``letters`` holds the words' bytes one after the other. Equal deletions of a word (of letters in
    a row) have one key of the kind SHORTENED, so that a longer word is met once.
    """
    lengths = np.diff(offsets)
    n = len(letters)
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]))
    back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE, np.uint64)]))
    values = mix64(letters.astype(np.uint64) + _U(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(values * powers[:n])])
    word = np.repeat(np.arange(len(lengths)), lengths)
    first, last = offsets[:-1][word], offsets[1:][word]
    at = np.arange(n)
    # Prefix before the place, and the suffix after it moved one place to the left.
    prefix, suffix = sums[at] - sums[first], (sums[last] - sums[at + 1]) * _U(_INVERSE)
    short = (prefix + suffix) * back[first]
    place = at - first
    whole = (sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]]
    replaced = mix64(mix64(short ^ _U(0xA24BAED4963EE407)) + place.astype(np.uint64) * _U(_BASE) + lengths[word].astype(np.uint64))
    once = np.ones(n, bool)
    once[1:] = (letters[1:] != letters[:-1]) | (place[1:] == 0)
    kinds = np.concatenate([np.full(n, REPLACED, np.int8), np.full(int(once.sum()), SHORTENED, np.int8), np.full(len(lengths), WHOLE, np.int8)])
    return (
        np.concatenate([replaced, mix64(short[once] + (lengths[word[once]] - 1).astype(np.uint64)), mix64(whole + lengths.astype(np.uint64))]),
        np.concatenate([word, word[once], np.arange(len(lengths))]),
        np.concatenate([place, place[once], np.full(len(lengths), -1)]),
        kinds,
    )


def _make_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        ids = batch.column("id").to_numpy()
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        at = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, side="right")) - 1)
            key, word, place, kind = deletion_keys(np.frombuffer(b"".join(words[at:to]), np.uint8), offsets[at : to + 1] - offsets[at])
            for i in range(0, len(key), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.record_batch({"key": key[part].view(np.int64), "id": ids[at:to][word[part]], "place": place[part].astype(np.int32), "kind": kind[part]})
            at = to
    give_back()


def linked(key: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The keys, in order of their values, that can mean a link.

    Replacements need a second one; deletions a whole word, and the word a deletion.
    """
    order = np.lexsort((kind, key))
    k, s = key[order], kind[order]
    # Deletions and whole words share their runs, replacements have runs of their own.
    starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | ((s[1:] == REPLACED) != (s[:-1] == REPLACED))])) if len(k) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(k)))
    run = np.repeat(np.arange(len(starts)), sizes)
    low, high = s[starts], s[np.append(starts[1:], len(k)) - 1] if len(k) else s
    good = (sizes > 1) & ((low == REPLACED) | ((low == SHORTENED) & (high == WHOLE)))
    return order[good[run]] if len(k) else order


def _sort_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None:
        return
    key, kind = table["key"].to_numpy(), table["kind"].to_numpy()
    kept = table.take(pa.array(linked(key, kind)))
    del table, key, kind
    yield from kept.combine_chunks().to_batches(max_chunksize=1 << 16)
    give_back()


def spelling_variants(docs: DataFrame, every: int = 97, shortest: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with at least ``least`` occurrences.

    A word's form is its near word of largest n, if that is at least ``ratio`` times the word's own;
    its root is where the forms end.
    """
    words = durable(word_counts(docs, every, shortest).where(F.col("n") >= least).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    tasks = max(1, -(-2 * total // KEYS_A_TASK))
    keys = words.select("id", "word").mapInArrow(_make_keys, "key long, id long, place int, kind byte")
    company = keys.repartition(tasks, "key").mapInArrow(_sort_keys, "key long, id long, place int, kind byte")
    # What is left of the word, and, of replacements, where: equal strings only.
    rest = F.when(F.col("place") < 0, F.col("word")).otherwise(F.concat(F.expr("left(word, place)"), F.expr("substring(word, place + 2)")))
    spot = F.when(F.col("kind") == REPLACED, F.col("place")).otherwise(-1)
    members = company.join(words, "id").select("id", "word", "n", "kind", spot.alias("spot"), rest.alias("rest"))
    group = Window.partitionBy("rest", "spot")
    ranked = group.orderBy(F.desc("n"), "word")
    near = members.select(
        "id",
        "word",
        "kind",
        F.count("*").over(group).alias("size"),
        F.sum((F.col("kind") == WHOLE).cast("int")).over(group).alias("wholes"),
        # The whole word's partners are the deletions, theirs is the whole word; among replacements it is the best other.
        F.min(F.when(F.col("kind") == WHOLE, F.struct((-F.col("n")).alias("less"), "word"))).over(group).alias("whole"),
        F.min(F.when(F.col("kind") == SHORTENED, F.struct((-F.col("n")).alias("less"), "word"))).over(group).alias("longer"),
        F.row_number().over(ranked).alias("rank"),
        F.first(F.struct((-F.col("n")).alias("less"), "word")).over(ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first"),
        F.lead(F.struct((-F.col("n")).alias("less"), "word")).over(ranked).alias("next"),
    )
    near = near.select(
        "id",
        F.when(F.col("kind") == REPLACED, F.col("size") - 1).when(F.col("kind") == WHOLE, F.col("size") - F.col("wholes")).otherwise(F.col("wholes")).alias("partners"),
        F.when(F.col("kind") == REPLACED, F.when(F.col("rank") == 1, F.col("next")).otherwise(F.col("first"))).when(F.col("kind") == WHOLE, F.col("longer")).otherwise(F.col("whole")).alias("best"),
    )
    near = near.groupBy("id").agg(F.sum("partners").alias("n_near"), F.min("best").alias("best"))
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    formed = words.join(near, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("best"))
    formed = durable(formed.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    roots = _ends(formed.where("form is not null").select("word", F.col("form").alias("root")))
    discard(words)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _ends(links: DataFrame) -> DataFrame:
    """word, root: where the chain from each word ends.

    Each link at least doubles n (a ratio of 2), so chains have at most the logarithm of the largest
    count as their length, and following two links at once takes the logarithm of that as rounds.
    """
    now = durable(links, "chains")
    while True:
        far = now.select(F.col("word").alias("via"), F.col("root").alias("far"))
        step = durable(now.join(far, now.root == far.via, "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "chains")
        discard(now)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")
        now.durable_path = step.durable_path

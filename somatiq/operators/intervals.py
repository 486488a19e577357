"""Begin/end pairing, occurrence numbers, and joins of samples to time segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import micros


def number_occurrences(events: DataFrame, label: str = "label", order: tuple[str, ...] = ("ts",), out: str = "id") -> DataFrame:
    """Adds ``label_k``, k counting the label's events in the file from 0."""
    w = Window.partitionBy("file_id", label).orderBy(*order)
    return events.withColumn(out, F.concat_ws("_", label, F.row_number().over(w) - 1))


def pair_markers(events: DataFrame, begins: Column, ends: Column, name: Column, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """file_id, name, id, begin, end: a begin pairs with the next end of its name unless another begin precedes that.

    Incomplete pairs are dropped; ids count the complete ones. One window, no join.
    """
    w = Window.partitionBy("file_id", "name").orderBy(*order)
    marks = events.select("file_id", "ts", *[c for c in order if c != "ts"], name.alias("name"), begins.alias("is_begin"), ends.alias("is_end")).where("is_begin or is_end")
    seen = marks.withColumns({"next_end": F.lead("is_end").over(w), "end": F.lead("ts").over(w)})
    pairs = seen.where("is_begin and next_end")
    k = Window.partitionBy("file_id", "name").orderBy("ts")
    return pairs.select("file_id", "name", F.concat_ws("_", "name", F.row_number().over(k) - 1).alias("id"), F.col("ts").alias("begin"), "end")


#: Session setting: how sequences meet samples where a call does not say (``file`` or ``measured``).
BUCKETS = "somatiq.intervals.buckets"
#: A sequence of a level touches SHARE to 4 * SHARE + 1 of its buckets, so a bucket is at most a SHARE-th of it.
#: Each of them is a row that is shuffled: most sequences hold few samples, so more buckets cost more than the pairs that they save.
SHARE = 1


def slice_join(sequences: DataFrame, samples: DataFrame, how: str = "left", bucket_seconds: float | None = None, buckets: str | None = None) -> DataFrame:
    """Samples of each sequence, both ends inclusive; ``left`` keeps sequences without samples.

    sequences: file_id, id, begin, end; samples: file_id, ts and more. Sequences may overlap; those
    with an open or a reversed end hold no samples. ``buckets`` says how the two meet, with the same
    rows (the session's ``somatiq.intervals.buckets`` where it is None):

    ``file``      an equi-join on the file with the range as residual: one shuffle, for recordings
                  with some dozens of sequences.
    ``measured``  time buckets measured from the sequences' own lengths, for recordings with very
                  many samples or sequences. Lengths fall into levels of a factor of four; a sequence
                  goes to the one to five buckets of its level that it touches, a sample to its bucket
                  in each level in use. A sample meets only sequences that hold it or end within
                  their length from it, so work follows the result and not samples times
                  sequences. Buckets of the longest sequences hold up to a whole recording;
                  adaptive execution deals such a one to several tasks.

    ``bucket_seconds`` sets one fixed length of buckets instead.
    """
    q = sequences.select("file_id", F.col("id").alias("reference"), "begin", "end")
    s = samples.withColumnRenamed("file_id", "__file")
    inside = F.col("ts").between(F.col("begin"), F.col("end"))
    same_file = F.col("file_id") == F.col("__file")
    buckets = buckets or sequences.sparkSession.conf.get(BUCKETS, "file")
    if buckets not in ("file", "measured"):
        raise ValueError(f"no such way to meet: {buckets}")
    if bucket_seconds is None and buckets == "file":
        return q.join(s, same_file & inside, how).drop("__file")
    if bucket_seconds is not None:
        step = int(bucket_seconds * 1e6)
        bucket = lambda c: F.floor(micros(c) / F.lit(step)).cast("long")
        spread = q.where("begin <= end").withColumn("__b", F.explode(F.sequence(bucket("begin"), bucket("end"))))
        met = spread.join(s.withColumn("__c", bucket("ts")), same_file & (F.col("__b") == F.col("__c")) & inside)
    else:
        met = _measured_join(q.where("begin <= end"), s, same_file & inside)
    met = met.drop("__file", "__b", "__c", "__level", "__on")
    if how == "inner":
        return met
    lost = q.join(met.select(F.col("file_id").alias("__f"), F.col("reference").alias("__r")).distinct(), (F.col("file_id") == F.col("__f")) & F.col("reference").eqNullSafe(F.col("__r")), "left_anti")
    return met.unionByName(lost, allowMissingColumns=True)


def _in_buckets(q: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences with their level, and each in the buckets of its level that it touches."""
    # Buckets of level k are 4 ** k microseconds long; shifts keep the arithmetic whole.
    length = F.greatest(micros("end") - micros("begin"), F.lit(SHARE)).cast("double")
    levelled = q.withColumn("__level", F.greatest(F.floor(F.log2(length / SHARE) / 2), F.lit(0)).cast("int"))
    return levelled, levelled.withColumn("__b", F.explode(F.sequence(_bucket("begin", F.col("__level")), _bucket("end", F.col("__level")))))


def _bucket(c: str, level: Column) -> Column:
    return F.call_function("shiftright", micros(c), 2 * level)


def _measured_join(q: DataFrame, s: DataFrame, matches: Column) -> DataFrame:
    """Each sequence in the buckets of its level, each sample in one bucket of every level in use."""
    levelled, spread = _in_buckets(q)
    # At most 30 levels: a list of one row, which Spark works out as part of the query.
    levels = levelled.select("__level").distinct().agg(F.collect_list("__level").alias("levels")).scalar()
    placed = s.withColumn("__on", F.explode(levels)).withColumn("__c", _bucket("ts", F.col("__on")))
    return spread.join(placed, matches & (F.col("__level") == F.col("__on")) & (F.col("__b") == F.col("__c")))


def filter_sequences(sequences: DataFrame, selection: list[str] | None = None, exclude: str | None = None, names_contain: str | None = None) -> DataFrame:
    """Complete sequences by membership of their id, by substring, and against a blacklist pattern."""
    out = sequences.where(F.col("end").isNotNull())
    if selection is not None:
        out = out.where(F.col("id").isin(selection))
    if names_contain is not None:
        out = out.where(F.col("id").contains(names_contain))
    return out.where(~F.col("id").rlike(exclude)) if exclude else out


def standard_order(events: DataFrame) -> DataFrame:
    """begin, end (open ones last), id."""
    return events.orderBy("file_id", "begin", F.asc_nulls_last("end"), "id")

"""N-gram Jaccard join by token-group matrices.

A document is the set of its word shingles, as 52-bit tokens. Equal sets are one vertex from the
start, told apart by their sizes and two independent hashes (96 bits). Two sets with Jaccard
similarity t or more share a token among the first of each in any common order of tokens (prefix
filter); the order puts heavy tokens (passages that many documents repeat) last. The prefixes are a
little longer than that needs, so that linked sets share several of these tokens, and a set that
shares too few with all others is out.

Sets that have a prefix token and a size class in common form a family, named by its smallest
member, so that families of one cluster of copies mostly coincide. Within a family the sets are
partitioned into groups of similar ones by their smallest token, which is a min-hash: two sets of
similarity s share it with chance s. The token-group matrix holds each group's token union; a
query's overlap with the union bounds its overlap with every member, and a query opens only the
groups that qualify for it. Links leave a task as a forest, so no pairs of a clique are listed. A
large family is cut into blocks: each meets the first one, then only sets outside the family's
largest component so far meet the other blocks, each pair of blocks in a task of its own.

Hot tokens cost no gathered group: the rows of heavy ones are salted, then pre-aggregated and met
by joins that Spark may split. Any other has at most a millionth of all tokens (and two more in
each map task), less than an average partition has of a table with fewer than a million of these.

Edge cases: a null text, or one without words, has an empty set that links with nothing; fewer
words than a shingle make one shingle of them all; texts of any length count whole; equal texts
share a component; repeated ids are rows of their own; a row without an id belongs to the component
of equal texts, and a set that only such rows have links with no other, since nothing names it
(give rows numbers where ids may be null); an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, durable, give_back, small_batches, text_slices
from .components import connected_components, forest
from .embeddings import groups_of
from .textkern import TOKEN_BITS, distinct_sets, mix64, shingle_hashes, word_hashes

#: A token is heavy if this many documents have it, and more if that makes more than MOST_HEAVY.
LEAST_HEAVY, MOST_HEAVY = 64, 1_000_000
#: Tokens count as heavy by their first bits (any rule that all tasks share makes a valid order).
HEAD_BITS = 32
#: Documents of a map task that must share a token before the task reports it as a heavy one.
LOCAL_HEAVY = 3
#: Prefix tokens beyond those that the filter needs, as a share of the set.
EXTRA = 0.05
#: Most sets of a block, and most of their tokens.
BLOCK, BLOCK_TOKENS = 1024, 600_000
#: Bytes of a token that travel to the comparison of two sets.
SENT_BYTES = 6
_U = np.uint64
_HEAVY_BIT = np.uint64(1 << TOKEN_BITS)


def token_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, tokens, offsets) for runs of documents; the text is the last column."""
    for batch in batches:
        for rows, data, offsets in text_slices(batch, "text"):
            h, doc = word_hashes(data, offsets)
            h, doc = shingle_hashes(h, doc, rows.num_rows, k)
            yield rows, *distinct_sets(h, doc, rows.num_rows)


def set_ids(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64 bits, further 32 bits) of each set, by independent hashes (0 for an empty one)."""
    size = np.diff(offsets)
    some = size > 0
    out = np.zeros((2, len(size)), np.uint64)
    for row, salt in zip(out, (1, 0x5851F42D4C957F2D), strict=True):
        if some.any():
            row[some] = mix64(np.add.reduceat(mix64(tokens + np.uint64(salt)), offsets[:-1][some]) + size[some].astype(np.uint64))
    return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def first_ones(sid: np.ndarray, check: np.ndarray, seen: set[tuple[int, int]]) -> np.ndarray:
    """Which sets come for the first time; ``seen`` learns them."""
    fresh = np.zeros(len(sid), bool)
    for i, one in enumerate(zip(sid.tolist(), check.tolist(), strict=True)):
        if one not in seen:
            seen.add(one)
            fresh[i] = True
    return fresh


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of n that any linked set shares EXTRA * n of, at least."""
    need = -(-percent * n // 100)
    return np.minimum(n, n - need + 1 + np.floor(EXTRA * n).astype(np.int64))


def jaccard_components(docs: DataFrame, percent: int = 85, k: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        total = 0
        for part, tokens, offsets in token_sets(batches, k):
            size, (ids, check) = np.diff(offsets), set_ids(tokens, offsets)
            fresh = first_ones(ids, check, seen)
            pool.append((tokens[np.repeat(fresh, size)] >> _U(TOKEN_BITS - HEAD_BITS)).astype(np.uint32))
            total += len(pool[-1])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size.astype(np.int64)), pa.array(ids), pa.array(check), pa.array(np.zeros(len(ids), bool))], names=["id", "n", "sid", "check", "heavy"])
        if total:
            every = np.concatenate(pool)
            pool.clear()
            every.sort()
            # The first of LOCAL_HEAVY equal heads in a row, where the run begins.
            much = every[LOCAL_HEAVY - 1 :] == every[: 1 - LOCAL_HEAVY]
            much[1:] &= every[1 : len(much)] != every[: len(much) - 1]
            head = every[: len(much)][much]
            count = np.searchsorted(every, head, side="right") - np.searchsorted(every, head)
            yield pa.RecordBatch.from_arrays([pa.array(head.astype(np.int64)), pa.array(count), pa.array(np.full(len(head), total)), pa.array(np.zeros(len(head), np.int32)), pa.array(np.ones(len(head), bool))], names=["id", "n", "sid", "check", "heavy"])
            del every, much
        give_back()

    surveyed = durable(rows.mapInArrow(survey, "id long, n long, sid long, check int, heavy boolean"), "jac-survey")
    members = surveyed.where("not heavy").select(F.col("id").alias("doc_id"), "n", "sid", "check")
    # Heavy tokens: at most as many as all set sizes together allow.
    whole = members.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_HEAVY, -(-whole // MOST_HEAVY))
    got = surveyed.where("heavy").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("id").toArrow()
    heavy = spark.sparkContext.broadcast(np.sort(np.array(got.column("id"), np.int64).astype(np.uint64)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = heavy.value
        seen: set[tuple[int, int]] = set()
        for _, tokens, offsets in token_sets(batches, k):
            size, (ids, check) = np.diff(offsets), set_ids(tokens, offsets)
            if not len(tokens):
                continue
            fresh = (size > 0) & first_ones(ids, check, seen)
            own = np.repeat(np.arange(len(size)), size)
            head = tokens >> _U(TOKEN_BITS - HEAD_BITS)
            at = np.minimum(np.searchsorted(hot, head), max(len(hot) - 1, 0))
            is_hot = hot[at] == head if len(hot) else np.zeros(len(tokens), bool)
            # Tokens ascend within a set; heavy ones go last and keep their order.
            order = np.lexsort((is_hot, own)) if is_hot.any() else np.arange(len(tokens))
            place = np.arange(len(tokens)) - np.repeat(offsets[:-1], size)
            keep = (place < np.repeat(prefix_length(size, percent), size)) & np.repeat(fresh, size)
            picked = order[keep]
            key = tokens[picked] | np.where(is_hot[picked], _HEAVY_BIT, np.uint64(0))
            o = own[picked]
            for a in range(0, len(key), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[part].view(np.int64)), pa.array(ids[o[part]]), pa.array(check[o[part]]), pa.array(size[o[part]].astype(np.int32))], names=["key", "sid", "check", "n"])

    keyed = rows.mapInArrow(prefixes, "key long, sid long, check int, n int")
    is_heavy = F.col("key") >= F.lit(1 << TOKEN_BITS)
    # A light token counts for a set only if another set of a size that could link has it. A heavy
    # one has company for certain; a salt spreads its rows.
    reach = math.ceil(math.log(100 / percent) * 1e9) + 2
    salted = keyed.withColumn("salt", F.when(is_heavy, F.pmod(F.col("sid"), F.lit(1024)).cast("int")).otherwise(0))
    near = Window.partitionBy("key", "salt").orderBy((F.log(F.col("n").cast("double")) * 1e9).cast("long")).rangeBetween(-reach, reach)
    shared = salted.withColumns({"lo": F.min("sid").over(near), "hi": F.max("sid").over(near)}).where(is_heavy | (F.col("lo") != F.col("hi"))).select("key", "sid", "check", "n")
    # Linked sets share EXTRA of the smaller one's size, which is percent of the larger's at least.
    # One exchange by set serves to drop rows of equal sets and to count.
    need = F.floor(F.lit(EXTRA) * F.ceil(F.col("n") * percent / 100)) + 1
    once = shared.repartition("sid").groupBy("sid", "check", "n", "key").agg(F.lit(1).alias("one"))
    kept = once.withColumn("has", F.count("key").over(Window.partitionBy("sid", "check", "n"))).withColumn("need", need).where("has >= need")
    # Sizes of linked sets differ by one class at most; each set is in its class and the next.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    classed = durable(kept.select("key", "sid", "check", "n", "need", F.explode(F.array(F.struct(size_class.alias("class"), F.lit(1).alias("own")), F.struct((size_class + 1).alias("class"), F.lit(0).alias("own")))).alias("at")).select("key", "sid", "check", "n", "need", "at.*"), "jac-classed")
    # Without a set of the class itself a family would repeat what the class below does.
    leaders = classed.groupBy("key", "class").agg(F.min("sid").alias("leader"), F.max("sid").alias("hi"), F.max("own").alias("own")).where("leader <> hi and own = 1").select("key", "class", "leader")
    # All tokens that two linked sets share lie in one class: there, too, a set needs enough of them.
    placed = classed.join(leaders, ["key", "class"]).groupBy("sid", "check", "n", "class", "need", "leader").agg(F.count(F.lit(1)).alias("tokens"))
    placed = placed.withColumn("has", F.sum("tokens").over(Window.partitionBy("sid", "check", "n", "class"))).where("has >= need")
    families = durable(placed.select("leader", "class", "sid", "check", "n"), "jac-families")
    # Sets are numbered as they are written: from here on a number stands for a set.
    owners = durable(members.where("n > 0").groupBy("sid", "check", "n").agg(F.min("doc_id").alias("owner")).withColumn("set", F.monotonically_increasing_id()), "jac-sets")
    named = durable(families.join(owners, ["sid", "check", "n"]).select("leader", "class", "set"), "jac-named")
    per_block = F.greatest(F.lit(16.0), F.least(F.lit(float(BLOCK)), BLOCK_TOKENS / F.pow(F.lit(100.0 / percent), F.col("class") + 1)))
    blocks_of = lambda sets: F.ceil(sets / per_block).cast("int")
    sizes = durable(named.groupBy("leader", "class").agg(F.count(F.lit(1)).alias("sets")).withColumn("blocks", blocks_of(F.col("sets"))).drop("sets"), "jac-sizes")
    dealt = named.join(sizes, ["leader", "class"]).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, offsets in token_sets(batches, k):
            sid, check, number, lists = (part.column(c) for c in ("sid", "check", "set", "places"))
            own_sid, own_check = set_ids(tokens, offsets)
            # A repeated id may stand for another text.
            same, sid = (own_sid == np.array(sid)) & (own_check == np.array(check)), np.array(number)
            flat, cut = lists.flatten(), np.array(lists.offsets) - lists.offsets[0].as_py()
            packed = np.ascontiguousarray((tokens >> _U(TOKEN_BITS - 8 * SENT_BYTES)).view(np.uint8).reshape(-1, 8)[:, :SENT_BYTES])
            blobs = [packed[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            own = np.repeat(np.arange(len(sid)), np.diff(cut))
            pick = np.flatnonzero(same[own])
            fields = [flat.field(f).take(pa.array(pick)) for f in range(5)]
            for a in range(0, len(pick), 500):
                part_own = own[pick[a : a + 500]]
                yield pa.RecordBatch.from_arrays([*(f.slice(a, 500) for f in fields), pa.array(sid[part_own]), pa.array([blobs[i] for i in part_own.tolist()], pa.binary())], names=["leader", "class", "one", "two", "block", "set", "tokens"])

    def open_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["leader", "class", "one", "two"]):
            if group.num_rows < 2:
                continue
            # A set may be there twice, as a query and as one of the others.
            sid, first, at = np.unique(np.array(group.column("set")), return_index=True, return_inverse=True)
            block = np.array(group.column("block"))
            sets = [unpack(b) for b in group.column("tokens").take(pa.array(first)).to_pylist()]
            queries, others = (np.unique(at[block == group.column(c)[0].as_py()]) for c in ("one", "two"))
            if not len(queries) or not len(others):
                continue
            a, b = linked_pairs(sets, queries, others, percent)
            if len(a):
                root = forest(len(sid), a, b)
                child = np.flatnonzero(root != np.arange(len(sid)))
                yield pa.RecordBatch.from_arrays([pa.array(sid[child]), pa.array(sid[root[child]])], names=["a", "b"])

    def compare(places: DataFrame) -> DataFrame:
        """Links between the sets that a task (leader, class, one, two) holds as block one and as block two."""
        lists = places.groupBy("set").agg(F.collect_list(F.struct("leader", "class", "one", "two", "block")).alias("places"))
        wanted = durable(owners.join(lists, "set").select("owner", "sid", "check", "set", "places"), "jac-wanted")
        texts = rows.join(wanted.hint("merge"), F.col("doc_id") == F.col("owner")).select("sid", "check", "set", "places", "text")
        tasks = texts.mapInArrow(spread, "leader long, class int, one int, two int, block int, set long, tokens binary")
        tasks = tasks.repartition("leader", "class", "one", "two").sortWithinPartitions("leader", "class", "one", "two", "set")
        found = durable(tasks.mapInArrow(open_groups, "a long, b long"), "jac-links")
        discard(wanted)
        return found

    # First every block meets block 0 of its family.
    other = F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0))))
    links = compare(dealt.withColumn("other", other).select("set", "leader", "class", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block"))
    component = connected_components(links).withColumnRenamed("node", "set")
    later = _later_places(dealt.where("blocks > 1"), component, blocks_of)
    if later is not None:
        links = links.unionByName(compare(later))
        component = connected_components(links).withColumnRenamed("node", "set")
    rooted = durable(owners.join(component, "set", "left").select("sid", "check", "n", F.coalesce("component", "set").alias("root")), "jac-roots")
    told = durable(members.join(rooted, ["sid", "check", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), "root"), "jac-told")
    # Written, so that the join below shuffles both sides itself and may split a hot component.
    smallest = durable(told.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), "jac-smallest")
    discard(surveyed, classed, families, owners, named, sizes, rooted)
    return told.join(smallest, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _later_places(large: DataFrame, component: DataFrame, blocks_of: Callable[[Column], Column]) -> DataFrame | None:
    """What is still to be compared in families of several blocks, once all have met block 0; None if nothing is.

    Sets of a family's largest component so far need no comparison with each other. The rest,
    dealt into blocks of their own (numbered below 0), meet all blocks but block 0. In a cluster of
    copies few sets are left, so the work grows with the cluster and not with its square.
    """
    if large.isEmpty():
        return None
    family = ["leader", "class"]
    placed = large.join(component, "set", "left").select("set", *family, "block", "blocks", F.coalesce("component", "set").alias("part"))
    counted = placed.groupBy(*family, "part").agg(F.count(F.lit(1)).alias("sets"))
    main = counted.groupBy(*family).agg(F.max_by("part", F.struct("sets", "part")).alias("main"))
    # Block 0 has met everything.
    open_ones = durable(placed.where("block > 0").join(main, family).withColumn("rest", F.col("part") != F.col("main")), "jac-open")
    rests = durable(open_ones.where("rest").groupBy(*family).agg(blocks_of(F.count(F.lit(1))).alias("rest_blocks")), "jac-rests")
    if rests.isEmpty():
        return None
    told = open_ones.join(rests, family)
    own = -1 - F.pmod(F.xxhash64("set", F.lit(1)), F.col("rest_blocks")).cast("int")
    queries = told.where("rest").withColumn("one", own).withColumn("two", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1))).select("set", *family, "one", "two", F.col("one").alias("block"))
    others = told.withColumn("one", F.explode(F.sequence(-F.col("rest_blocks"), F.lit(-1)))).select("set", *family, "one", F.col("block").alias("two"), "block")
    return queries.unionByName(others)


def unpack(blob: bytes) -> np.ndarray:
    """Tokens from their SENT_BYTES highest bytes each."""
    out = np.zeros((len(blob) // SENT_BYTES, 8), np.uint8)
    out[:, :SENT_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, SENT_BYTES)
    return out.reshape(-1).view(np.uint64)


def linked_pairs(sets: list[np.ndarray], queries: np.ndarray, others: np.ndarray, percent: int, columns: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, other) with 100 * intersection >= percent * union, by a token-group matrix of bits."""
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    value, holder = flat[order], np.repeat(np.arange(len(sets)), n)[order]
    start = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    df = np.diff(np.r_[start, len(value)])
    # A column for each token that two sets hold.
    several = np.repeat(df > 1, df)
    column, holder = np.repeat(np.cumsum(df > 1) - 1, df)[several], holder[several]
    bits = []
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(column, [c, c + columns]))
        plain = np.zeros((len(sets), min(columns, -(-(int(column[-1]) + 1 - c) // 64) * 64)), bool)
        plain[holder[part], column[part] - c] = True
        bits.append(np.packbits(plain, axis=1).view(np.uint64))
    none = np.zeros(0, np.int64)
    if not bits:
        return none, none
    bits = np.concatenate(bits, axis=1)
    # Groups: sets with the same smallest token; the matrix holds their unions.
    smallest = np.array([s[0] for s in sets])[others]
    order = np.argsort(smallest, kind="stable")
    others, smallest = others[order], smallest[order]
    begin = np.flatnonzero(np.r_[True, smallest[1:] != smallest[:-1]])
    end = np.append(begin[1:], len(others))
    union = np.bitwise_or.reduceat(bits[others], begin, axis=0)
    found_q, found_x = [none], [none]
    for q in queries.tolist():
        # |q and x| <= |q and union|, and a link needs percent of |q| at least.
        overlap = np.bitwise_count(union & bits[q]).sum(1, dtype=np.int64)
        opened = np.flatnonzero(100 * overlap >= percent * n[q])
        if not len(opened):
            continue
        x = np.concatenate([others[begin[g] : end[g]] for g in opened.tolist()])
        x = x[(x != q) & (100 * np.minimum(n[x], n[q]) >= percent * np.maximum(n[x], n[q]))]
        shared = np.bitwise_count(bits[x] & bits[q]).sum(1, dtype=np.int64)
        x = x[100 * shared >= percent * (n[q] + n[x] - shared)]
        found_q.append(np.full(len(x), q))
        found_x.append(x)
    return np.concatenate(found_q), np.concatenate(found_x)

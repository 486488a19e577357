"""Near-duplicate embeddings: iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned on a bounded sample so that the signs of the rotated
coordinates make balanced codes of little quantisation error. Codes are cut into substrings, each
the key of a table; vectors that share a substring and whose whole codes differ in no more bits
than a radius are candidates, and their cosine is computed from the original vectors in double
precision. The width of a substring grows with the logarithm of the number of vectors, so that
buckets stay small; the number of tables follows from the wanted recall at the threshold, over
several rotations if one has too few bits. A bounded set of queries meets all vectors by brute
force, and rotations are added until the tables and the radius find the wanted share of these true
pairs.

Only codes travel to the buckets. A pair is a candidate in the first table it shares and in no
other, and a vector follows to a bucket only where it has a candidate. There each task gives every
member's number of links and one link to the smallest member it is connected with: a forest leaves
the task, and no pairs. Identical vectors are one vertex with a multiplicity; a large bucket is cut
into blocks, and each pair of blocks is a task of its own.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, as do rows without an id (which are kept, with a null component); vectors of different
lengths never link; rows that repeat an id are vectors of their own, each with its own links, and
share no more than the name; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable
from .components import connected_components, forest
from .textkern import mix64

#: Most vectors that rotations are learned from.
SAMPLE = 12_000
#: Of these, the first that are compared with all vectors, to measure recall.
QUERIES = 1000
#: Of a query's true pairs, so many drawn evenly come to the driver.
PER_QUERY = 8
#: Fewest true pairs that tell whether codes about the mean will do.
FEW = 200
#: Rows of a block: two blocks meet in a task.
BLOCK = 512


@dataclass
class Tables:
    """Rotations with means, the bits of each table, and the most bits in which candidates' codes differ."""

    mean: np.ndarray
    axes: list[np.ndarray]
    bits: int
    radius: int = 1 << 30

    @property
    def per_rotation(self) -> int:
        return max(1, self.axes[0].shape[1] // self.bits) if self.axes else 0

    def signs(self, x: np.ndarray) -> np.ndarray:
        """(vectors, tables, bits) signs of the rotated coordinates."""
        used = self.per_rotation * self.bits
        out = np.zeros((len(x), len(self.axes), used), bool)
        for i, a in enumerate(self.axes):
            code = (((x - self.mean) @ a) > 0)[:, :used]
            out[:, i, : code.shape[1]] = code
        return out.reshape(len(x), -1, self.bits)

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """(vectors, tables) substrings as whole numbers."""
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))

    def codes(self, signs: np.ndarray) -> np.ndarray:
        """(vectors, words) whole codes in 64-bit words."""
        flat = signs.reshape(len(signs), -1)
        packed = np.packbits(flat, axis=1)
        return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)

    def masks(self) -> np.ndarray:
        """(tables, words) the bits of each table within a code."""
        n = len(self.axes) * self.per_rotation
        return self.codes(np.repeat(np.eye(n, dtype=bool)[:, :, None], self.bits, 2))


def learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """Principal axes times the rotation that brings the data nearest to the corners of a cube."""
    _, vectors = np.linalg.eigh(x.T @ x)
    axes = vectors[:, ::-1]
    v = x @ axes
    turn = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
    for _ in range(rounds):
        u, _, wt = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (u @ wt).T
    return axes @ turn


def plan_tables(n: int, dims: int, threshold: float, recall: float) -> tuple[int, int, int]:
    """(bits of a substring, tables, rotations): by the chance that a sign differs at the threshold."""
    bits = int(min(max(round(math.log2(max(n, 2))) - 5, 6), 24, dims))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))
    return bits, tables, math.ceil(tables / max(1, dims // bits))


@dataclass
class Pairs:
    """True pairs x, y of a bounded set of queries; links: all that the query of the pair has."""

    x: np.ndarray
    y: np.ndarray
    query: np.ndarray
    links: np.ndarray

    def recall(self, tables: Tables) -> float:
        """Share of the pairs that are candidates: of all links, or with queries of equal weight if that is less."""
        a, b = tables.signs(self.x), tables.signs(self.y)
        hit = (tables.keys(a) == tables.keys(b)).any(1) & ((a != b).sum((1, 2)) <= tables.radius)
        share = 1 / np.bincount(self.query)[self.query]
        return float(min(np.average(hit, weights=share), np.average(hit, weights=share * self.links)))


def true_pairs(vertices: DataFrame, ids: np.ndarray, queries: np.ndarray, threshold: float) -> Pairs:
    """Pairs of the queries (unit vectors) with all vectors, by brute force; at most PER_QUERY of each query."""
    held = vertices.sparkSession.sparkContext.broadcast((ids, queries.astype(np.float32)))
    names = ["query", "draw", "seen", "v"]

    def lowest(query: np.ndarray, draw: np.ndarray) -> np.ndarray:
        order = np.lexsort((draw, query))
        first = np.searchsorted(query[order], query[order])
        return order[np.arange(len(order)) - first < PER_QUERY]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = held.value
        seen = np.zeros(len(q), np.int64)
        query, draw, v = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, q.shape[1]))
        for batch in batches:
            if not batch.num_rows:
                continue
            vertex = np.array(batch.column(0))
            x = _unit(np.array(batch.column(1).flatten()).reshape(len(vertex), -1))
            for at in range(0, len(x), 1024):
                part = slice(at, at + 1024)
                i, j = np.nonzero(x[part].astype(np.float32) @ q.T >= threshold)
                i += at
                other = vertex[i] != own[j]
                i, j = i[other], j[other]
                if not len(i):
                    continue
                seen += np.bincount(j, minlength=len(q))
                fresh = mix64(vertex[i].astype(np.uint64) ^ mix64(j.astype(np.uint64)))
                few = lowest(j, fresh)  # before vectors are copied: a chunk may be one large group
                query, draw, v = np.r_[query, j[few]], np.r_[draw, fresh[few]], np.concatenate([v, x[i[few]]])
                order = lowest(query, draw)
                query, draw, v = query[order], draw[order], v[order]
        if len(query):
            told = np.where(np.r_[True, query[1:] != query[:-1]], seen[query], 0)
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array((draw >> np.uint64(1)).astype(np.int64)), pa.array(told), pa.array(list(v), pa.list_(pa.float64()))], names=names)

    found = vertices.select("vertex", "v").mapInArrow(search, "query long, draw long, seen long, v array<double>")
    of_query = Window.partitionBy("query")
    drawn = found.withColumns({"links": F.sum("seen").over(of_query), "place": F.row_number().over(of_query.orderBy("draw"))}).where(F.col("place") <= PER_QUERY)
    got = drawn.select("query", "links", "v").toArrow().combine_chunks()
    query = np.array(got.column("query"), np.int64)
    y = np.array(got.column("v").combine_chunks().flatten()).reshape(-1, queries.shape[1]) if len(query) else np.zeros((0, queries.shape[1]))
    return Pairs(queries[query], y, query, np.array(got.column("links"), np.int64))


def made_pairs(sample: np.ndarray, threshold: float, rng: np.random.Generator) -> Pairs:
    """Pairs just at the threshold, from vectors of the sample turned towards others of it."""
    x = sample[rng.permutation(len(sample))[:2500]]
    z = sample[rng.integers(0, len(sample), len(x))]
    side = z - (x * z).sum(1, keepdims=True) * x
    some = np.linalg.norm(side, axis=1) > 1e-6
    x, side = x[some], side[some]
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * (_unit(side) if len(side) else side)
    return Pairs(x, y, np.arange(len(x)), np.ones(len(x), np.int64))


def fit_radius(tables: Tables, shown: list[Pairs], miss: float) -> None:
    """The radius that all but a share ``miss`` of each set of pairs keep within."""
    far = [(tables.signs(p.x) != tables.signs(p.y)).sum((1, 2)) for p in shown]
    tables.radius = max((int(np.quantile(d, 1 - miss, method="higher")) for d in far), default=1 << 30)


def learn_tables(sample: np.ndarray, n: int, threshold: float, recall: float = 0.98, seed: int = 11, pairs: Pairs | None = None) -> Tables:
    """Tables about the sample's mean, which balances the codes, or about the origin.

    What is left about the mean may be noise, as when all vectors lie in one narrow cone. So codes
    about the mean need FEW true pairs that show the wanted recall with at most twice the tables
    that the threshold's angle asks for. About the origin that angle bounds how often a sign
    differs: rotations are added until the recall is reached, on pairs made at the threshold, too,
    where few true ones are known. The radius leaves out a quarter of the share that may be missed
    of the true pairs, and of pairs made at the threshold.
    """
    dims = sample.shape[1]
    bits, _, rotations = plan_tables(n, dims, threshold, recall)
    told = pairs is not None and len(pairs.x) >= FEW
    made = [p for p in (made_pairs(sample, threshold, np.random.default_rng(seed + 1)),) if len(p.x)]
    known = [pairs] if pairs is not None and len(pairs.x) else []
    miss = (1 - recall) / 4
    if told:
        rng = np.random.default_rng(seed)
        mean = sample.mean(0)
        tables = Tables(mean, [learn_rotation(sample - mean, rng) for _ in range(rotations)], bits)
        fit_radius(tables, known + made, miss)
        while pairs.recall(tables) < recall and len(tables.axes) < 2 * rotations:
            tables.axes.append(learn_rotation(sample - mean, rng))
            fit_radius(tables, known + made, miss)
        if pairs.recall(tables) >= recall:
            return tables
    rng = np.random.default_rng(seed)
    tables = Tables(np.zeros(dims), [learn_rotation(sample, rng) for _ in range(rotations)], bits)
    fit_radius(tables, known + made, miss)
    # Any turn will do here: the chance that a pair meets is the same for each of them. Recall counts links, the
    # radius pairs; where that keeps them apart for long, the radius takes in all known pairs.
    most = 8 * rotations + 32
    while any(p.recall(tables) < recall for p in (known if told else known + made)):
        if len(tables.axes) >= most:
            reached = min(p.recall(tables) for p in (known if told else known + made))
            raise RuntimeError(f"{most} rotations of {bits} bits a table reach a recall of {reached:.3f}, not {recall}")
        tables.axes.append(learn_rotation(sample, rng, rounds=0))
        fit_radius(tables, known + made, miss if len(tables.axes) < most // 2 else 0.0)
    return tables


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _mark(vector: str) -> list[Column]:
    """Two hashes of a vector: of n different ones some pair agrees in both with a chance of n ** 2 / 2 ** 129."""
    return [F.xxhash64(vector).alias("mark"), F.xxhash64(F.lit("second half"), vector).alias("mark2")]


def embedding_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    # One vertex for each distinct vector, told apart by 128 bits; ids may repeat, so vertices are numbered as they
    # are written. Vectors are shuffled once, here, and rows meet their vertices by these bits.
    marked = rows.where(usable).select("vec_id", "v", *_mark("v"))
    distinct = marked.groupBy("mark", "mark2").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v"))
    vertices = durable(distinct.withColumn("vertex", F.monotonically_increasing_id()), "itq-vertices")
    sizes = vertices.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()
    parts = []
    for dims, n in sorted((r.dims, r.n) for r in sizes):
        of_dims = vertices.where(F.size("v") == dims)
        drawn = of_dims.orderBy(F.xxhash64("v"), "least_id").limit(sample).select("vertex", "v").toArrow()
        known = _unit(np.array(drawn.column("v").combine_chunks().flatten()).reshape(-1, dims))
        pairs = true_pairs(of_dims, np.array(drawn.column("vertex"), np.int64)[:QUERIES], known[:QUERIES], threshold)
        parts.append(_links_of(of_dims, learn_tables(known, n, threshold, recall, pairs=pairs), threshold))
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = durable(found, "itq-found")
    counts = found.groupBy("vertex").agg(F.sum("gained").alias("gained"))
    component = connected_components(found.where("least < vertex").select(F.col("vertex").alias("a"), F.col("least").alias("b")))
    placed = vertices.join(counts, "vertex", "left").join(component.withColumnRenamed("node", "vertex"), "vertex", "left").select("mark", "mark2", "least_id", (F.coalesce("gained", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "vertex").alias("component"))
    placed = durable(placed, "itq-placed")
    # Written, so that the join shuffles both sides itself and may split a hot component.
    smallest = durable(placed.groupBy("component").agg(F.min("least_id").alias("component_id")), "itq-smallest")
    told = placed.join(smallest, "component").select("mark", "mark2", "links", "component_id")
    whole = marked.drop("v").join(told, ["mark", "mark2"]).select("vec_id", F.col("links").cast("long").alias("n_links"), "component_id")
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


_TASK = ["bucket_table", "bucket", "one", "two"]


def _links_of(vertices: DataFrame, tables: Tables, threshold: float) -> DataFrame:
    """vertex, gained, least: a row per vertex and task that linked it."""
    held = vertices.sparkSession.sparkContext.broadcast(tables)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = t.signs(_unit(np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)))
            keys, blobs = t.keys(signs), pa.array([c.tobytes() for c in t.codes(signs)], pa.binary())
            for at in range(keys.shape[1]):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys[:, at]), pa.array(np.full(batch.num_rows, at, np.int32)), blobs], names=["vertex", "bucket", "bucket_table", "code"])

    coded = vertices.select("vertex", "v").mapInArrow(code, "vertex long, bucket long, bucket_table int, code binary")
    light = vertices.select("vertex", "v").mapInArrow(lambda b: (r.select(["bucket", "bucket_table"]) for r in code(b)), "bucket long, bucket_table int")
    sizes = light.groupBy("bucket_table", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
    large = F.col("blocks") > 1
    dealt = coded.join(sizes.select("bucket_table", "bucket", "blocks"), ["bucket_table", "bucket"]).withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.when(large, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))))
    dealt = dealt.select("vertex", "code", "bucket_table", "bucket", F.least("block", "other").cast("int").alias("one"), F.greatest("block", "other").cast("int").alias("two"), "block")

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The members of each task that have a candidate there."""
        t = held.value
        masks = t.masks()
        for rows, begin, size in whole_groups(batches, _TASK):
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
            a, b = _candidates(rows, begin, size, codes, masks, t.radius)
            hit = np.zeros(rows.num_rows, bool)
            hit[a] = hit[b] = True
            if hit.any():
                yield rows.drop_columns("code").filter(pa.array(hit)).combine_chunks().to_batches()[0]

    tasks = dealt.repartition(*_TASK).sortWithinPartitions(*_TASK)
    flagged = durable(tasks.mapInArrow(flag, "vertex long, bucket_table int, bucket long, one int, two int, block int"), "itq-candidates")
    near = flagged.join(vertices.select("vertex", "copies", "v"), "vertex").repartition(*_TASK).sortWithinPartitions(*_TASK)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = held.value
        masks = t.masks()
        for rows, begin, size in whole_groups(batches, _TASK):
            x = _unit(np.array(rows.column("v").combine_chunks().flatten()).reshape(rows.num_rows, -1))
            a, b = _candidates(rows, begin, size, t.codes(t.signs(x)), masks, t.radius)
            link = np.zeros(len(a), bool)
            for at in range(0, len(a), 20_000):
                part = slice(at, at + 20_000)
                link[part] = np.einsum("ij,ij->i", x[a[part]], x[b[part]]) >= threshold
            a, b = a[link], b[link]
            if not len(a):
                continue
            ids, local = np.unique(np.array(rows.column("vertex")), return_inverse=True)
            mult = np.array(rows.column("copies"))
            gained = np.bincount(local[a], mult[b], len(ids)) + np.bincount(local[b], mult[a], len(ids))
            least = ids[forest(len(ids), local[a], local[b])]
            hit = gained > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(gained[hit].astype(np.int64)), pa.array(least[hit])], names=["vertex", "gained", "least"])

    return near.mapInArrow(rerank, "vertex long, gained long, least long")


def _candidates(rows: pa.Table, begin: np.ndarray, size: np.ndarray, codes: np.ndarray, masks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one task each, whose first common table is the task's and whose codes lie within the radius."""
    block, one, two = (np.array(rows.column(c)) for c in ("block", "one", "two"))
    table = np.array(rows.column("bucket_table"))
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in pairs_within(begin, size):
        # Blocks meet each other in a task of two, and themselves in a task of their own.
        mine = (np.minimum(block[a], block[b]) == one[a]) & (np.maximum(block[a], block[b]) == two[a])
        a, b = a[mine], b[mine]
        differ = codes[a] ^ codes[b]
        near = np.bitwise_count(differ).sum(1) <= radius
        a, b, differ = a[near], b[near], differ[near]
        first = np.ones(len(a), bool)
        for t in range(int(table[a].max()) if len(a) else 0):
            first &= ((differ & masks[t]) != 0).any(1) | (table[a] <= t)
        out_a.append(a[first])
        out_b.append(b[first])
    return np.concatenate(out_a), np.concatenate(out_b)


def pairs_within(begin: np.ndarray, size: np.ndarray, most: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions a < b of all pairs within runs of rows, in chunks of about ``most`` pairs (or one run)."""
    count = size * (size - 1) // 2
    upto = np.cumsum(count)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        n = np.repeat(size[at:to], size[at:to])
        first = np.repeat(begin[at:to], size[at:to])
        place = np.arange(len(n)) - np.repeat(np.cumsum(size[at:to]) - size[at:to], size[at:to])
        others = n - 1 - place
        a = np.repeat(first + place, others)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(others) - others, others)
        yield a, b
        at = to


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], rows: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(rows, begin and size of each group in them): whole groups of sorted rows, about so many rows at once (or one group)."""

    def starts(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[:1] = True
        for c in by:
            column = np.array(table.column(c))
            change[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        begin = starts(table)
        if len(begin) > 1:
            yield table.slice(0, int(begin[-1])), begin[:-1], np.diff(begin)
            held = table.slice(int(begin[-1])).to_batches()
    table = pa.Table.from_batches(held) if held else None
    if table is not None and table.num_rows:
        begin = starts(table)
        yield table, begin, np.diff(np.append(begin, table.num_rows))


def groups_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``by``, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.array(batch.column(batch.schema.get_field_index(c))) for c in by]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)

"""Token ids in compressed files: canonical length-limited Huffman codes, blocks, bit-offset checkpoints.

Ids are counted over the whole corpus (one row per id of the vocabulary, so the counts have a known
bound), the best code lengths up to a limit are found by package-merge, and codes are canonical: the
lengths alone define them. Documents are dealt by ranges of their ids and sorted, and each task
writes its documents as independent blocks of whole documents.

The format is a folder that any file system of Spark can hold:

* ``code``: symbol, length: one row per id that occurs;
* ``blocks``: part (of the order), block, start (ids before it in its part), n_ids, n_bits, bits (codes
  from the highest bit on), marks (bit offsets of every 256th id, 64-bit little-endian), doc_ids,
  doc_lengths (ids of each document), crc32 (of all ids as little-endian 32-bit integers).

A block is decoded by one table of all bit strings as long as the longest code: all checkpoints of a
block go on at the same time, one id each per step. A stretch of ids is read from the blocks that hold
it, from the checkpoint before its first id.

Edge cases: a null text is empty, and every document has its end id; a long document is a block of
its own; null doc_ids come first; documents that share an id stand in the order of a digest of
their ids, and equal ones are interchangeable; an empty table gives files without rows and an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, durable, give_back, small_batches
from .packing import load_encoder

#: Bits of the longest code, where the vocabulary allows it (the table of this many bits takes 1 MB).
LONGEST = 18
#: Ids of a block, of a checkpoint, and of a part, about.
BLOCK, MARK, PART = 1 << 16, 256, 1 << 23
BLOCKS = "part int, block long, start long, n_ids long, n_bits long, bits binary, marks binary, doc_ids array<long>, doc_lengths array<long>, crc32 long"


def id_width(tokenizer: str, end: int) -> int:
    """Bytes that hold every id of a vocabulary and the end id: 2 or 4."""
    return 2 if max(len(load_encoder(tokenizer)[1]), end) < 1 << 16 else 4


def tokenize(docs: DataFrame, tokenizer: str, end: int, width: int = 4) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned integers of ``width`` bytes, with the end id)."""
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer)[0]
        for batch in batches:
            ids = encode([t or "" for t in batch.column("text").to_pylist()])
            packed = pa.array([np.asarray([*i, end], kind).tobytes() for i in ids], pa.binary())
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "ids": packed})
        give_back()

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, ids binary")


def id_counts(tokens: DataFrame, width: int = 4) -> DataFrame:
    """id, n: occurrences of each id."""
    kind = np.dtype(f"<u{width}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            here = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind))
            if len(here) > len(total):
                total = np.concatenate([total, np.zeros(len(here) - len(total), np.int64)])
            total[: len(here)] += here
        found = np.flatnonzero(total)
        yield pa.record_batch({"id": found, "n": total[found]})

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits per symbol of the best prefix code without codes above ``longest`` bits, by package-merge.

    ``counts`` are positive. The limit is raised where so many symbols need it.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    longest = max(longest, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64 if counts.sum() > 1 << 62 else np.int64)
    single = []  # of each level, which entries are symbols
    level = leaves
    for _ in range(longest - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        single.append(rank < n)
        level = both[rank]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for own in reversed(single):
        symbols = int(own[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[:take] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of symbols with lengths: shorter codes first, then smaller symbols."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = np.asarray(symbols, np.int64)[order], np.asarray(lengths, np.int64)[order]
        self.width = int(self.lengths.max(initial=1))
        # Each code is the sum of the widths of all codes before it, in units of the longest.
        spans = 1 << (self.width - self.lengths)
        self.firsts = np.cumsum(spans) - spans
        self.spans = spans

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """(code, length) by symbol."""
        size = int(self.symbols.max(initial=-1)) + 1
        code, length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code[self.symbols] = self.firsts >> (self.width - self.lengths)
        length[self.symbols] = self.lengths
        return code, length

    def table(self) -> np.ndarray:
        """By the next ``width`` bits: symbol * 64 + length (symbols are below 2 ** 26)."""
        out = np.zeros(1 << self.width, np.uint32)
        used = int(self.spans.sum())
        out[:used] = np.repeat(self.symbols << 6 | self.lengths, self.spans).astype(np.uint32)
        return out


def pack_bits(code: np.ndarray, length: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(codes one after the other from the highest bit on, bit offset of each and of the end)."""
    at = np.concatenate([[0], np.cumsum(length)])
    if len(code) == 0:
        return b"", at
    word, room = at[:-1] >> 6, 64 - (at[:-1] & 63) - length
    high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
    words = np.zeros((int(at[-1]) >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    # The bits of a word are apart, so their sum is their union.
    words[word[first]] = np.add.reduceat(high, first)
    over = np.flatnonzero(room < 0)
    words[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (int(at[-1]) + 7) // 8], at


def unpack(bits: bytes, marks: np.ndarray, count: int, table: np.ndarray, width: int) -> np.ndarray:
    """``count`` ids from the bits: all checkpoints at the same time, MARK steps each."""
    if count == 0:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(bits + bytes(MARK * width // 8 + 8), np.uint8).astype(np.uint32)
    data = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    # Where the last checkpoint has fewer ids, its steps run on into the zeros behind the bits.
    at = marks.astype(np.uint32) if len(bits) < 1 << 28 else marks.astype(np.int64)
    out = np.empty((min(MARK, count), len(at)), np.uint32)
    drop, mask = at.dtype.type(32 - width), at.dtype.type((1 << width) - 1)
    for row in out:
        found = table[data[at >> 3] >> drop - (at & 7) & mask]
        np.right_shift(found, 6, out=row)
        at += found & 63
    return out.T.reshape(-1)[:count]


def _blocks(code: Code, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of, length_of = code.encoder()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        names: list = []
        size = 0

        def told() -> pa.RecordBatch:
            every = np.frombuffer(b"".join(ids), kind)
            bits, at = pack_bits(bits_of[every], length_of[every])
            row = {"part": part, "block": block, "start": start, "n_ids": len(every), "n_bits": int(at[-1]), "bits": bits, "marks": at[:-1:MARK].astype("<u8").tobytes()}
            row |= {"doc_ids": list(names), "doc_lengths": [len(i) // width for i in ids], "crc32": zlib.crc32(every.astype("<u4").tobytes())}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), *((c, pa.int64()) for c in ("block", "start", "n_ids", "n_bits")), ("bits", pa.binary()), ("marks", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())), ("crc32", pa.int64())]))

        for batch in batches:
            for name, own in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if ids and size + len(own) // width > BLOCK:
                    yield told()
                    block, start, size = block + 1, start + size, 0
                    ids.clear()
                    names.clear()
                ids.append(own)
                names.append(name)
                size += len(own) // width
        if ids:
            yield told()
        give_back()

    return run


def write_token_files(tokens: DataFrame, path: str, longest: int = LONGEST, width: int = 4) -> None:
    """Write documents (doc_id, ids of ``width`` bytes each) in ascending order of their ids to a folder of the format above.

    ``tokens`` is scanned several times, so it should be a stored table.
    """
    spark = tokens.sparkSession
    counts = sorted((r.id, r.n) for r in id_counts(tokens, width).collect())  # a row per id of the vocabulary at most
    symbols, n = np.array([i for i, _ in counts], np.int64), np.array([x for _, x in counts], np.int64)
    lengths = code_lengths(n, longest)
    spark.createDataFrame([(int(s), int(x)) for s, x in zip(symbols, lengths, strict=True)], "symbol long, length int").coalesce(1).write.parquet(f"{path}/code")
    parts = max(1, -(-int(n.sum()) // PART))
    dealt = tokens.select("doc_id", "ids", F.xxhash64("ids").alias("digest"), F.monotonically_increasing_id().alias("row"))
    # Ranges of all columns that order the rows: documents that share an id may stand in several parts.
    order = [F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("row")]
    dealt = small_batches(dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids"))
    dealt.mapInArrow(_blocks(Code(symbols, lengths), width), BLOCKS).write.parquet(f"{path}/blocks")


def _read_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.parquet(f"{path}/code").collect()  # a row per id of the vocabulary at most
    return Code(np.array([r.symbol for r in rows], np.int64), np.array([r.length for r in rows], np.int64))


def placed_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with ``first``: the ids of all blocks before them."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # A row per part of some millions of ids: a sum over these few is one small task.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return blocks.join(parts, "part").withColumn("first", F.col("before") + F.col("start")).drop("before")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary) of every document.

    A block whose ids do not have its checksum raises.
    """
    code = _read_code(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = code.table()
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["bits"], np.frombuffer(row["marks"], "<u8"), row["n_ids"], table, code.width)
                raw = memoryview(ids.tobytes())
                if zlib.crc32(raw) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                ends = np.cumsum(np.array(row["doc_lengths"], np.int64))
                starts = ends - np.array(row["doc_lengths"], np.int64)
                for i in range(0, len(ends), 1024):
                    own = [bytes(raw[4 * a : 4 * b]) for a, b in zip(starts[i : i + 1024], ends[i : i + 1024], strict=True)]
                    yield pa.record_batch({"doc_id": pa.array(row["doc_ids"][i : i + 1024], pa.int64()), "start": row["first"] + starts[i : i + 1024], "ids": pa.array(own, pa.binary())})
        give_back()

    blocks = placed_blocks(spark, path).select("part", "block", "first", "n_ids", "bits", "marks", "doc_ids", "doc_lengths", "crc32")
    return small_batches(blocks).mapInArrow(run, "doc_id long, start long, ids binary")


def read_stretch(spark: SparkSession, path: str, first: int, count: int) -> np.ndarray:
    """``count`` ids from place ``first`` of the whole corpus on: only the blocks that hold them are read.

    Each is decoded from the checkpoint before the first wanted id on, up to the last.
    """
    code = _read_code(spark, path)
    last = first + count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = code.table()
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(first - row["first"], 0), min(last - row["first"], row["n_ids"])
                mark = a // MARK
                marks = np.frombuffer(row["marks"], "<u8")[mark : -(-b // MARK)]
                begin = int(marks[0]) >> 3 if len(marks) else 0
                ids = unpack(row["bits"][begin:], marks - np.uint64(8 * begin), b - mark * MARK, table, code.width)
                yield pa.record_batch({"first": pa.array([row["first"] + a]), "ids": pa.array([ids[a - mark * MARK :].tobytes()], pa.binary())})

    held = placed_blocks(spark, path).where((F.col("first") < last) & (F.col("first") + F.col("n_ids") > first))
    found = held.select("first", "n_ids", "bits", "marks").mapInArrow(run, "first long, ids binary").orderBy("first").collect()  # the stretch that was asked for
    return np.frombuffer(b"".join(r.ids for r in found), np.uint32)


def stored_tokens(docs: DataFrame, tokenizer: str, end: int, path: str) -> DataFrame:
    """Tokenise documents, write them to files at ``path``, and read these: doc_id, start, ids."""
    width = id_width(tokenizer, end)
    tokens = durable(tokenize(docs, tokenizer, end, width), "tokens")
    write_token_files(tokens, path, width=width)
    discard(tokens)
    return read_token_files(docs.sparkSession, path)

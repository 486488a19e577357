import heapq
import itertools
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from somatiq.llm import tokenfiles
from somatiq.llm.common import durable, shared_folder
from somatiq.llm.queries import op13_token_files, tokenizer_path

from .helpers import corpus, table


def huffman_cost(counts):
    heap = list(map(int, counts))
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def best_cost(counts, longest):
    """Of all lengths that fit, longer for rarer symbols."""
    counts = sorted(counts, reverse=True)
    fits = (x for x in itertools.combinations_with_replacement(range(1, longest + 1), len(counts)) if sum(2.0**-n for n in x) <= 1)
    return min(sum(c * n for c, n in zip(counts, x, strict=True)) for x in fits)


def test_code_lengths_are_the_best(spark):
    rng = np.random.default_rng(4)
    for n in (2, 3, 5, 64, 700):
        counts = rng.zipf(1.4, n).clip(1, 10**12)
        assert (tokenfiles.code_lengths(counts, 62) * counts).sum() == huffman_cost(counts)
    for n, longest in ((4, 2), (5, 3), (6, 3), (7, 4), (8, 4)):
        counts = rng.zipf(1.2, n).clip(1, 10**6)
        lengths = tokenfiles.code_lengths(counts, longest)
        assert lengths.max() <= longest and (lengths * counts).sum() == best_cost(counts.tolist(), longest)
    assert tokenfiles.code_lengths(np.ones(9, np.int64), 1).max() == 4  # the limit gives way
    assert tokenfiles.code_lengths(np.array([5]), 9).tolist() == [1]


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000])
def test_bits_come_back(n):
    rng = np.random.default_rng(n)
    symbols = np.sort(rng.choice(60_000, 3000, replace=False))
    code = tokenfiles.Code(symbols, tokenfiles.code_lengths(rng.zipf(1.2, 3000).clip(1, 10**9)))
    codes, lengths = code.encoder()
    ids = rng.choice(symbols, n).astype(np.uint32)
    bits, at = tokenfiles.pack_bits(codes[ids], lengths[ids])
    assert "".join(f"{int(codes[i]):0{lengths[i]}b}" for i in ids) == "".join(f"{b:08b}" for b in bits)[: at[-1]]
    assert (tokenfiles.unpack(bits, at[: -1 : tokenfiles.MARK], n, code.table(), code.width) == ids).all()
    # Canonical: codes of one length follow each other, and no code begins another.
    texts = sorted(f"{int(codes[s]):0{lengths[s]}b}" for s in symbols)
    assert not any(b.startswith(a) for a, b in itertools.pairwise(texts))


def plain(rows):
    t, at, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for doc_id, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_matches_a_plain_version(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op13_token_files(spark, sf).orderBy("start").collect()]
    assert got == plain(rows)


def test_files_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "PART", 5000)
    rows = [*corpus(60), (None, "no id", None, None, 0), (None, None, None, None, 0), (7, "again", "en", "s", 0), (7, "again", "en", "s", 0), (7, "other </s> <|endoftext|>", "en", "s", 0), (-3, "x" * 300_000, "en", "s", 0)]
    docs = table(spark, rows).withColumns({c: F.lit(9) for c in ("ids", "start", "part", "block", "row", "digest")})
    path = shared_folder(spark, "test-files")
    tokens = durable(tokenfiles.tokenize(docs, tokenizer_path(), 2), "test-tokens")
    tokenfiles.write_token_files(tokens, path)
    assert spark.read.parquet(f"{path}/blocks").agg(F.countDistinct("part")).first()[0] > 2
    got = tokenfiles.read_token_files(spark, path).orderBy("start").collect()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    assert sorted((repr(r.doc_id), len(r.ids) // 4, zlib.crc32(r.ids)) for r in got) == sorted((repr(a), n, c) for a, _, n, c in plain(rows))
    assert [r.start for r in got] == np.cumsum([0] + [len(r.ids) // 4 for r in got])[:-1].tolist()
    every = np.frombuffer(b"".join(r.ids for r in got), np.uint32)
    for first, count in ((0, 10), (255, 3), (4000, 3000), (len(every) - 5, 100), (len(every), 5), (17, 0)):
        assert (tokenfiles.read_stretch(spark, path, first, count) == every[first : first + count]).all()


def test_small_blocks(spark, monkeypatch):
    tokens = spark.createDataFrame([(i, np.full(i % 5, i % 3, "<u4").tobytes()) for i in range(300)], "doc_id long, ids binary")
    path = shared_folder(spark, "test-small")
    tokenfiles.write_token_files(tokens, path, longest=1)
    got = tokenfiles.read_token_files(spark, path).orderBy("doc_id").collect()
    assert [(r.doc_id, r.ids) for r in got] == [(r.doc_id, r.ids) for r in tokens.orderBy("doc_id").collect()]


def test_empty_tables_and_damaged_blocks(spark):
    empty = table(spark, []).where("false")
    path = shared_folder(spark, "test-empty")
    assert tokenfiles.stored_tokens(empty, tokenizer_path(), 2, path).count() == 0
    path = shared_folder(spark, "test-damage")
    tokenfiles.write_token_files(durable(tokenfiles.tokenize(table(spark, corpus(5)), tokenizer_path(), 2), "test-tokens"), path)
    spark.read.parquet(f"{path}/blocks").withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{path}/other/blocks")
    spark.read.parquet(f"{path}/code").write.parquet(f"{path}/other/code")
    with pytest.raises(PySparkException, match="damaged"):
        tokenfiles.read_token_files(spark, f"{path}/other").count()

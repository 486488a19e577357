import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from somatiq.llm import quality, toxicity
from somatiq.llm.common import crc32_mod
from somatiq.llm.queries import ORACLES, QUERIES, tokenizer_path

from ..oracle import assert_same, connect
from .helpers import roots, table, words
from .test_operators import plain_mix, shingles


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", ["op6_quality", "op9_toxicity"])
def test_classifier_queries(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.held_out.any()


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.durable(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        kept[name] = [r.doc_id for r in docs.collect()]
    assert len(kept["toxicity"]) == len(set(kept["toxicity"])) and set(kept["toxicity"]) <= ids
    assert set(kept["quality"]) <= set(kept["toxicity"]) and set(kept["jaccard_join"]) <= set(kept["quality"])
    assert len(kept["jaccard_join"]) == len(set(kept["jaccard_join"]))
    assert set(kept["mixing"]) <= set(kept["jaccard_join"]) and max(map(kept["mixing"].count, set(kept["mixing"]))) == 2
    sizes = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    mixed = sum(sizes[i] for i in kept["mixing"])
    whole = {r.doc_id: len(words(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert mixed == pytest.approx(1.5 * sum(whole[i] for i in kept["jaccard_join"]), rel=0.2)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sum(r.length for r in packed if r.start == 0) > 0 and len({r.doc_id for r in packed}) == len(set(kept["mixing"]))


def plain_toxicity(model, text):
    raw = (text or "").encode()
    terms = sorted(set(toxicity.hashed_terms(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist()))
    terms = [t for t in terms if model.w[t]]
    total = model.w0 + sum(model.w[t] for t in terms) + sum(float(model.v[a] @ model.v[b]) for a, b in itertools.combinations(terms, 2))
    return 1 / (1 + math.exp(-total))


def plain_quality(model, text):
    raw = (text or "").encode()
    x = quality.document_statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
    total = model.base
    for f, t, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
        at = 0
        while at < len(f):
            at = 2 * at + (2 if x[f[at]] > t[at] else 1)
        total += leaf[at - len(f)]
    return 1 / (1 + math.exp(-total))


def test_each_stage_matches_a_plain_version(spark, sf):
    """Over all documents of the smallest table, each stage on what the one before it kept."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    told = lambda df: Counter((r.doc_id, r.text, r.source) for r in df.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        if name == "toxicity":
            model = toxicity.train_toxicity(docs, labels, crc32_mod(F.col("label_id"), 4) != 2)
            want = Counter(r for r in rows if plain_toxicity(model, r[1]) < 0.3)
        elif name == "quality":
            model = quality.train_quality(docs, labels, crc32_mod(F.col("label_id"), 5) != 0)
            want = Counter(r for r in rows if plain_quality(model, r[1]) >= 0.3)
        elif name == "jaccard_join":
            sets = [shingles(r[1], 5) for r in rows]
            pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
            first = {}
            for r, root in zip(rows, roots(len(rows), pairs), strict=True):
                first[root] = min(first.get(root, r), r, key=lambda r: r[0])
            want = Counter(first.values())
        else:
            want = Counter()
            for r, taken in zip(rows, plain_mix(rows), strict=True):
                want[r] += math.floor(taken / max(len(words(r[1])), 1) + 0.5)
            want = +want
        docs = corpus_pipeline.durable(stage(spark, docs, sf), f"plain-{name}")
        assert told(docs) == want and 0 < want.total(), name
    t = Tokenizer.from_file(tokenizer_path())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    want = Counter()
    for (doc_id, text, _), n in told(docs).items():
        want[doc_id] += n * (len(t.encode(text or "", add_special_tokens=False).ids) + 1)
    assert got == want


def test_stages_take_awkward_rows(spark, sf):
    """Nulls in every column, repeated rows, columns with clashing names, and empty tables."""
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "some words here and there " * 30, "en", None, 5), (2, "some words here and there " * 30, "en", None, 5), (None, "x" * 300_000, "en", "s", 1)]
    docs = table(spark, rows).withColumns({"score": F.lit(0.5), "label": F.lit("l"), "taken": F.lit(1), "set": F.lit(2), "sid": F.lit(3)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("false"), sf).count() == 0
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and kept.count() <= 2 * len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).where("start = 0").count() == len(rows)
    # One of each repeated text stays, and rows without words all do.
    one = sorted(map(repr, ((r.doc_id, (r.text or "")[:4]) for r in corpus_pipeline.one_of_each(spark, docs, sf).collect())))
    assert one == sorted(map(repr, [(None, ""), (1, ""), (1, ""), (2, "some"), (None, "xxxx")]))


def unlike(name, n=100):
    return [f"{name}{i}" for i in range(n)]


def test_pipeline_takes_five_words_and_four_fifths(spark, sf):
    # Five-word shingles: 96 of 118 shared (0.81); 96 of 126 (0.76) is too little.
    texts = [unlike("a"), unlike("a") + unlike("b", 22), unlike("c"), unlike("c") + unlike("d", 30)]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, table(spark, rows), sf).collect()) == [0, 2, 3]


def test_pipeline_keeps_one_row_of_each_group(spark, sf):
    a, b, c, d = (" ".join(unlike(x)) for x in "abcd")
    rows = [(2, a), (1, b), (1, a), (4, b), (None, c), (None, c), (None, d), (5, d), (3, None), (3, ""), (None, None), (6, a)]
    got = corpus_pipeline.one_of_each(spark, table(spark, [(i, t, "en", "s", 0) for i, t in rows]), sf)
    want = [(1, a), (1, b), (None, c), (5, d), (3, None), (3, ""), (None, None)]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, want))

import hashlib
import itertools
import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from somatiq.llm import chat, components, embeddings, fingerprints, jaccard, mixing, packing, quality, suffixtree, textkern, toxicity, urlfilter
from somatiq.llm.common import crc32_mod, discard, durable, shared_dir, with_row_numbers
from somatiq.llm.learn import auc
from somatiq.llm.queries import URL_RULES, tokenizer_path

from .helpers import DOCS, corpus, fold, roots, sentence, table, words


def shingles(text, k=4):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_word_and_shingle_kernels():
    texts = [r[1] or "" for r in corpus()]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    h, doc = textkern.word_hashes(data, offsets)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(h.tolist(), flat, strict=True)))
    tokens, cut = textkern.distinct_sets(*textkern.shingle_hashes(h, doc, len(texts), 4), len(texts))
    assert np.diff(cut).tolist() == [len(shingles(t)) for t in texts]
    assert len(tokens) == cut[-1]


def brute_jaccard(rows):
    sets = [shingles(r[1]) for r in rows]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    return sets, [rows[r][0] for r in roots(len(rows), pairs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_matches_brute_force(spark, seed):
    rows = corpus(140, seed)
    sets, want = brute_jaccard(rows)
    got = {r.doc_id: r for r in jaccard.jaccard_components(table(spark, rows).withColumn("sid", F.lit(1)).withColumn("key", F.lit(1))).collect()}
    assert [got[r[0]].n_shingles for r in rows] == [len(s) for s in sets]
    assert [got[r[0]].component_id for r in rows] == want


@pytest.mark.parametrize("most_edits", [3, 9])
def test_jaccard_heavy_group(spark, monkeypatch, most_edits):
    """A large family of near copies, cut into blocks, with heavy tokens; with more edits it falls into parts."""
    import random

    rng = random.Random(3)
    base = sentence(rng, 80).split(" ")
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, most_edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    later, real = [], jaccard._later_places
    monkeypatch.setattr(jaccard, "_later_places", lambda *a: later.append(real(*a)) or later[-1])
    _, want = brute_jaccard(rows)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert [got[r[0]] for r in rows] == want
    assert later[0] is not None or most_edits == 3


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_linked_pairs_match_brute_force(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(120):
        base = sets[int(rng.integers(len(sets)))] if sets and rng.random() < 0.7 else rng.integers(0, 1 << 48, int(rng.integers(1, 200))).astype(np.uint64)
        kept = base[rng.random(len(base)) < 0.95]
        sets.append(np.unique(np.r_[kept, rng.integers(0, 1 << 48, int(rng.integers(1, 9))).astype(np.uint64)]))
    queries, others = np.arange(0, 80), np.arange(40, 120)
    plain = [set(s.tolist()) for s in sets]
    want = {(q, x) for q in queries for x in others if q != x and 100 * len(plain[q] & plain[x]) >= percent * len(plain[q] | plain[x])}
    for columns in (64, 8192):
        a, b = jaccard.linked_pairs(sets, queries, others, percent, columns)
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = roots(500, pairs)
    for a, b in pairs:
        if a != b:
            assert got[a] == root[a] and got[b] == root[b]
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 32))
    for i in range(40):
        x[200 + i] = x[i % 10] + rng.normal(scale=0.05, size=32)
    x[290:] = x[5]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000, None, 0), (1001, [0.0] * 32, 0), (1002, [float("nan")] + [1.0] * 31, 0), (1003, [None] + [1.0] * 31, 0), (1004, [], 0), (1005, [1.0, 2.0], 0), (1006, [2.0, 4.0], 0)]
    got = {r.vec_id: r for r in embeddings.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(300))
    assert found >= 0.9 * near.sum() and all(got[i].n_links <= near[i].sum() for i in range(300))
    root = roots(300, zip(*np.nonzero(near), strict=True))
    assert np.mean([got[i].component_id == root[i] for i in range(300)]) > 0.97
    assert [got[i].n_links for i in range(1000, 1005)] == [0] * 5
    assert got[1006].component_id == 1005 and got[1005].n_links == 1
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embedding_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 20)
    rng = np.random.default_rng(1)
    x = rng.normal(size=16) + rng.normal(scale=0.02, size=(90, 16))
    got = embeddings.embedding_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(89, 0)}


@pytest.mark.parametrize("block", [512, 2])
def test_embedding_chains_within_a_bucket(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "learn_tables", lambda *_, **__: embeddings.Tables(np.zeros(2), [np.eye(2)], 2))
    # Neighbours 20 degrees apart link, others do not; all lie in one bucket of the one table.
    ids, angles = [1, 4, 2, 5, 3, 12, 11], np.radians([3, 23, 43, 63, 83, 183, 203])
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in zip(ids, angles, strict=True)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 4: (2, 1), 2: (2, 1), 5: (2, 1), 3: (1, 1), 12: (1, 11), 11: (1, 11)}


def test_candidates_meet_once_and_within_the_radius():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 12))
    x[30:] = x[:30] + rng.normal(scale=0.3, size=(30, 12))
    tables = embeddings.Tables(np.zeros(12), [embeddings.learn_rotation(x, rng) for _ in range(2)], 3, radius=6)
    signs = tables.signs(x)
    keys, codes, masks = tables.keys(signs), tables.codes(signs), tables.masks()
    assert keys.shape == (60, 8) and codes.shape[1] * 64 >= 24
    met = Counter()
    for t in range(8):
        for key in np.unique(keys[:, t]):
            rows = np.flatnonzero(keys[:, t] == key)
            block = rows % 2
            for one, two in ((0, 0), (0, 1), (1, 1)):
                own = rows[(block == one) | (block == two)]
                if len(own):
                    told = pa.table({"block": own % 2, "one": np.full(len(own), one), "two": np.full(len(own), two), "bucket_table": np.full(len(own), t)})
                    a, b = embeddings._candidates(told, np.array([0]), np.array([len(own)]), codes[own], masks, tables.radius)
                    met.update((int(own[i]), int(own[j])) for i, j in zip(a, b, strict=True))
    far = (signs[:, None] != signs[None]).sum((2, 3))
    want = {(i, j) for i, j in itertools.combinations(range(60), 2) if (keys[i] == keys[j]).any() and far[i, j] <= 6}
    assert set(met) == want and set(met.values()) == {1} and len(want) > 20


def test_embeddings_with_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01]), (3, [0.0, 1.0, 0.01]), (None, [1.0, 0.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"vertex": F.lit(1), "copies": F.lit(1)})
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embeddings.embedding_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False), (-1, 0, None, True)], key=str)


def cone(n, pairs, energy=0.7, dims=64, seed=6):
    """Unit vectors whose mean carries this share of the energy; the last ones pair with the first at a cosine of 0.91."""
    rng = np.random.default_rng(seed)
    rest = rng.normal(size=(n, dims - 1))
    rest /= np.linalg.norm(rest, axis=1, keepdims=True)
    side = rng.normal(size=(pairs, dims - 1))
    side -= (side * rest[:pairs]).sum(1, keepdims=True) * rest[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = (0.91 - energy) / (1 - energy)
    rest[n - pairs :] = c * rest[:pairs] + np.sqrt(1 - c * c) * side
    x = np.concatenate([np.full((n, 1), np.sqrt(energy)), np.sqrt(1 - energy) * rest], 1)
    return x @ np.linalg.qr(rng.normal(size=(dims, dims)))[0]


@pytest.mark.parametrize("sample", [100, 12_000])
def test_embedding_recall_where_pairs_are_rare(spark, sample):
    x = cone(3000, 300)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = embeddings.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=sample).collect()
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum() >= 600 and near.sum() * 0.96 <= sum(r.n_links for r in got) <= near.sum()


def test_tables_grow_until_the_measured_recall_is_reached():
    x = cone(8000, 1000)
    pairs = embeddings.Pairs(x[:500], x[-1000:-500], np.arange(500), np.ones(500, np.int64))
    tables = embeddings.learn_tables(x[1000:-1000], 1_000_000, 0.9, pairs=pairs)
    other = tables.keys(tables.signs(x[500:1000])) == tables.keys(tables.signs(x[-500:]))
    assert pairs.recall(tables) >= 0.98 and other.any(1).mean() >= 0.95


def test_true_pairs_match_brute_force(spark):
    x = cone(600, 150)
    x[20:40] = x[0] + np.random.default_rng(2).normal(scale=0.01, size=(20, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vertices = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vertex long, v array<double>").repartition(3)
    got = embeddings.true_pairs(vertices, np.arange(100), x[:100], 0.9)
    near = x[:100] @ x.T >= 0.9
    near[np.arange(100), np.arange(100)] = False
    links = near.sum(1)
    assert np.bincount(got.query, minlength=100).tolist() == np.minimum(links, embeddings.PER_QUERY).tolist()
    assert (got.links == links[got.query]).all() and ((got.x * got.y).sum(1) >= 0.9 - 1e-6).all()


def test_packing_round_trip(spark):
    rows = corpus(90)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    rows.append((900, "Unusual \u2003 spaces\x1c <|endoftext|> \u4e2d\u6587 don't!!  x" * 3, "en", "s", 0))
    want = {r[0]: [*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    got = packing.pack_documents(table(spark, rows), tokenizer_path(), window=256, segment=5000).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for d, parts in by_doc.items():
        parts.sort(key=lambda r: r.start)
        ids = [int(v) for p in parts for v in np.frombuffer(p.ids, "<u4")]
        assert ids == want[d] and all(p.doc_tokens == len(ids) for p in parts)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
    lengths = [sum(p.length for p in parts) for parts in by_seq.values()]
    assert sum(256 - n for n in lengths if n & (n - 1)) < 0.12 * sum(lengths)


def test_cuts_are_optimal():
    rng = np.random.default_rng(0)
    pos = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 40))])
    pen = rng.integers(0, 5, 41)
    pen[[0, -1]] = 0

    def cost(cuts):
        total = 0.0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n = pos[b] - pos[a]
            total += min(16 - n, (16 - n) / 4 if n & (n - 1) == 0 else math.inf) + pen[b]
        return total

    best = [0.0] + [math.inf] * 40
    for j in range(1, 41):
        best[j] = min(best[i] + cost([i, j]) for i in range(j) if pos[j] - pos[i] <= 16)
    assert cost(packing.choose_cuts(pos, pen, 16)) == pytest.approx(best[40])


def test_apportion_is_sainte_lague():
    weights, seats = [340.0, 280.0, 160.0, 60.0, 0.0], 23
    won = [0] * 5
    for _ in range(seats):
        won[max(range(5), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))] += 1
    assert mixing.apportion(weights, seats) == won
    assert mixing.apportion([0.0], 5) == [0] and mixing.apportion([], 0) == []


def test_targets_reshare_the_excess():
    got = mixing.capped_targets([100, 1000, 100], [3, 1, 2], 1.5, 2.0)
    assert got == pytest.approx([200, 1400, 200])
    assert mixing.capped_targets([0, 0], [3, 1], 1.5, 2.0) == [0, 0]


def test_mixing(spark):
    rows = corpus(400, 5)
    docs = table(spark, rows).withColumns({"target": F.lit(1), "shard": F.lit(1)})
    got = {r.doc_id: r for r in mixing.mix_sources(docs, docs_per_shard=32).collect()}
    assert got == {r.doc_id: r for r in mixing.mix_sources(docs, docs_per_shard=32).collect()}
    assert [got[r[0]].size for r in rows] == [len(words(r[1])) for r in rows]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.capped_targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2.0), strict=True))
    taken = Counter()
    for r in rows:
        g = got[r[0]]
        assert 0 <= g.taken <= 2 * g.size and g.target == pytest.approx(target[r[3]]) and g.source_size == sizes[r[3]]
        taken[r[3]] += g.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 16 * (2 + len(rows) / 32)


def spark_xxhash(*values):
    """Spark's xxhash64 of ints (as 32 bits where marked by a tuple), longs and texts; nulls leave the hash as it is."""
    import struct

    import xxhash

    h = 42
    for v in values:
        if v is not None:
            raw = struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v) if isinstance(v, int) else v.encode()
            h = xxhash.xxh64_intdigest(raw, seed=h)
    return h - (1 << 64) if h >= 1 << 63 else h


def plain_mix(rows, per_shard=256, block=16, seed=17, most=2, share=1.5):
    """taken of each row (doc_id, text, source), seat by seat and word by word."""
    size = [len(words(r[1])) for r in rows]
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    whole = [sum(z for z, r in zip(size, rows, strict=True) if r[2] == s) for s in sources]
    targets = mixing.capped_targets(whole, [(3, 1, 2)[i % 3] for i in range(len(sources))], share, float(most))

    def seats(weights, n, caps):
        won = [0] * len(weights)
        for _ in range(n):
            open_ones = [i for i in range(len(weights)) if weights[i] > 0 and won[i] < caps[i]]
            if not open_ones:
                break
            won[max(open_ones, key=lambda i: (weights[i] / (2 * won[i] + 1), -i))] += 1
        return won

    quotas = seats(targets, round(sum(targets) / block), [math.inf] * len(targets))
    draw = [spark_xxhash((seed,), r[0], spark_xxhash(r[1]), z) for r, z in zip(rows, size, strict=True)]
    taken = [0] * len(rows)
    for no, source in enumerate(sources):
        own = [i for i, r in enumerate(rows) if r[2] == source and size[i]]
        n = max(1, -(-len(own) // per_shard))
        shard = {i: spark_xxhash((seed + 1,), draw[i]) % n for i in own}
        used = sorted(set(shard.values()))
        sizes = [sum(size[i] for i in own if shard[i] == s) for s in used]
        runs = seats(sizes, quotas[no], [math.floor(-(-z // block) * most) for z in sizes])
        for s, z, run in zip(used, sizes, runs, strict=True):
            blocks = -(-z // block)
            first = spark_xxhash((seed + 2,), (no,), s) % blocks
            line = [i for i in sorted((i for i in own if shard[i] == s), key=lambda i: (draw[i], rows[i][0] is not None, rows[i][0] or 0)) for _ in range(size[i])]
            for b in range(first, first + run):
                for i in line[block * (b % blocks) : block * (b % blocks + 1)]:
                    taken[i] += 1
    return taken


def test_mixing_with_a_broken_limit_reaches_its_targets(spark):
    rows = corpus(260, 8)
    got = mixing.mix_sources(table(spark, rows), docs_per_shard=64, share=1.4, most=1.5).collect()
    taken = plain_mix([(r[0], r[1], r[3]) for r in rows], 64, most=1.5, share=1.4)
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r[0], t) for r, t in zip(rows, taken, strict=True))
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        shards = max(1, -(-sum(r.size > 0 for r in own) // 64))
        assert abs(sum(r.taken for r in own) - own[0].target) <= 16 * (shards + 2)
    assert max(r.taken / r.size for r in got if r.size) == 2


@pytest.mark.parametrize("fan_out", [1024, 3])
def test_mixing_matches_plain_version(spark, monkeypatch, fan_out):
    monkeypatch.setattr(mixing, "FAN_OUT", fan_out)
    rows = corpus(260, 8)
    rows += [(None, rows[7][1], "en", "s1", 0), (None, "a b c d e f", "en", "s1", 0), (5, "other words of a repeated id " * 9, "en", "s2", 0), (5, rows[5][1], "en", rows[5][3], 0)]
    got = Counter((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix_sources(table(spark, rows), docs_per_shard=16).collect())
    taken = plain_mix([(r[0], r[1], r[3]) for r in rows], 16)
    want = Counter((r[0], r[3], len(words(r[1])), t) for r, t in zip(rows, taken, strict=True))
    if fan_out == 1024:
        assert got == want
    else:  # groups of shards round once more
        assert sum(abs(a[3] * n) for a, n in (got - want).items()) < 0.25 * sum(taken)
        for s in {r[3] for r in rows}:
            assert abs(sum(k[3] * n for k, n in got.items() if k[1] == s) - sum(k[3] * n for k, n in want.items() if k[1] == s)) <= 16 * 12


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/7?x#y", "http://example.com/en/6", "http://a.b.example.net/de/81", "http://example.net/de/7/8", "x://org/es/", "http://borg/es/1", "http://com#frag/en/", "http://com/en/://z", "http://..com//en/", "HTTP://net/DE/", "http://net:80/de/", "http://q?://com/en/"] * 2
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r.page_id: r for r in urlfilter.filter_urls(pages, URL_RULES).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, tail = rest[:n].translate({a: a + 32 for a in range(65, 91)}), rest[n:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        fit = [(len(h + p), h + p, a) for h, p, a in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = (max(fit)[1], max(fit)[2]) if fit else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert urlfilter.filter_urls(pages, []).where("verdict <> 'allow'").count() == 0


def test_url_rules_from_a_table_and_ties(spark):
    rules = [("Example.COM", "/a", "allow"), ("example.com", "/a", "block"), ("b.example.com", None, "allow"), (None, "/", "block"), ("x.org", "y", "block"), ("É.org", "/", "block")]
    pages = spark.createDataFrame([(1, "http://example.com/abc"), (2, "http://b.example.com/abc"), (3, "http://x.org/yes"), (None, "http://b.example.com/"), (5, "http://é.org/"), (6, "http://É.org/" + "z" * 100_000), (6, "http://x.org/yes")], "page_id long, url string").withColumns({"host": F.lit("h"), "rule": F.lit(1), "short": F.lit(2)})
    table = spark.createDataFrame(rules, "host string, path string, action string")
    for given in (table, rules):
        got = Counter((r.page_id, r.rule, r.verdict) for r in urlfilter.filter_urls(pages, given).collect())
        # Equal lengths: the greater rule, and block before allow.
        assert got == Counter([(1, "example.com/a", "block"), (2, "example.com/a", "block"), (3, "x.org/y", "block"), (None, "b.example.com", "allow"), (5, None, "allow"), (6, "É.org/", "block"), (6, "x.org/y", "block")])


def plain_form(text):
    norm = lambda t: unicodedata.normalize("NFKC", t)
    return re.sub(" +", " ", re.sub("[\t\n\x0b\x0c\r\x1c-\x1f\x85\u1680\u2028\u2029]", " ", norm(norm(text or "").casefold()))).strip(" ")


def test_canonical_form_of_all_planes(spark):
    import random

    rng = random.Random(3)
    assigned = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    marks = [c for c in assigned if unicodedata.combining(chr(c))]
    rows = [("".join(chr(rng.choice(assigned)) for _ in range(rng.randint(0, 8))),) for _ in range(20_000)]
    rows += [("".join(chr(rng.choice(assigned)) + "".join(chr(rng.choice(marks)) for _ in range(rng.randint(1, 4))) for _ in range(3)),) for _ in range(5000)]
    rows += [(unicodedata.normalize("NFD", r[0]),) for r in rows[:2000]]
    for r in spark.createDataFrame(rows, "t string").select("t", fingerprints.canonical(F.col("t")).alias("c")).collect():
        assert r.c == plain_form(r.t), ascii(r.t)


def test_colliding_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "digest128", lambda canon: F.concat(F.lit("0" * 31), F.pmod(F.length(canon), F.lit(2))))
    rows = [(5, "abc"), (1, "xyz"), (2, "ABC"), (3, "q r s"), (4, None), (7, "XYZ "), (None, "abc"), (None, "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.fingerprint, r.group_id, r.copies, r.variant) for r in fingerprints.exact_groups(docs).collect())
    one, zero = "0" * 31 + "1", "0" * 32
    want = [(1, one, 1, 2, 0), (7, one, 1, 2, 0), (2, one + "-1", 2, 3, 1), (5, one + "-1", 2, 3, 1), (None, one + "-1", 2, 3, 1), (3, one + "-2", 3, 1, 2), (None, one + "-3", None, 1, 3), (4, zero, 4, 1, 0)]
    assert got == sorted((str(w[0]), *w[1:]) for w in want)
    likeness = {r.doc_id: r for r in fingerprints.edited_likeness(docs.where("doc_id is not null")).collect()}
    assert likeness[1].fingerprint != likeness[2].fingerprint and likeness[2].fingerprint == likeness[5].fingerprint
    assert likeness[2].near_next == 0 and likeness[5].near_next == 0 and likeness[1].near_edited == 0


def test_fingerprints_of_null_and_repeated_ids(spark):
    rows = [(None, "b"), (None, "a"), (1, "x"), (1, "X"), (0, ""), (None, "A")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit(1), "canon": F.lit("z"), "at": F.lit(2)})
    got = fingerprints.edited_likeness(docs).collect()
    assert len(got) == 6 and sum(r.near_next for r in got) == 2 and {r.copies for r in got if r.doc_id == 1} == {2}


def test_fingerprints(spark):
    rows = [r for r in corpus(150) if r[0] % 13 != 7]
    rows = [(r[0] * 700, *r[1:]) for r in rows]
    got = {r.doc_id: r for r in fingerprints.edited_likeness(table(spark, rows)).collect()}
    texts = [r[1] or "" for r in rows]
    for i, r in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(rows)]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        g = got[r[0]]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.near_next == (g.fingerprint == got[rows[(i + 1) % len(rows)][0]].fingerprint) == (plain_form(t) == plain_form(nxt))
        assert g.near_edited == (g.fingerprint == g.edited_fingerprint) == (plain_form(t) == plain_form(edited))
        alike = [r[0] for r, u in zip(rows, texts, strict=True) if plain_form(u) == plain_form(t)]
        assert (g.group_id, g.copies) == (min(alike), len(alike))
        if edited == t:
            assert g.near_edited == 1
    prints = {}
    for i, r in enumerate(rows):
        assert prints.setdefault(texts[i], got[r[0]].fingerprint) == got[r[0]].fingerprint
    one = fingerprints.edited_likeness(table(spark, [(7, "abc", "en", "s", 3)])).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_canonical_form(spark):
    same = [("ABC\tDÉ", "abc dé"), ("Ａbc  d", "abc d"), ("ﬁne", "fine"), ("e\u0301te\u0301", "été"), ("x\u00a0 y ", "x y"), ("", " \n"), ("\u1e9b", "\u1e61")]
    df = spark.createDataFrame(same, "a string, b string").select(fingerprints.canonical(F.col("a")).alias("a"), fingerprints.canonical(F.col("b")).alias("b"))
    for r in df.collect():
        assert r.a == r.b
    import xxhash

    digest = spark.createDataFrame([("hello",)], "t string").select(fingerprints.fingerprint(F.col("t"))).first()[0]
    assert digest[:16] == f"{xxhash.xxh64_intdigest(b'hello', seed=42):016x}"


def test_exact_groups(spark):
    rows = [(1, "A b"), (2, "a  b"), (3, None), (4, ""), (5, "other"), (6, "a b")]
    got = {r.doc_id: (r.group_id, r.copies, r.variant) for r in fingerprints.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 3, 0), 2: (1, 3, 0), 6: (1, 3, 0), 3: (3, 2, 0), 4: (3, 2, 0), 5: (5, 1, 0)}


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>user\n", "\\", "a\\<|im_start|>b", "[INST] x [/INST]</s>", None, "", "<\\|im_end|>", "é\n\n"]
    rows = [(c, t, ["system", "user", "assistant"][(c + t) % 3], nasty[(c * 3 + t) % len(nasty)]) for c in range(6) for t in range(c + 1)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: chat.parse_formatted(r.formatted) for r in formatted.collect()}
    for c in range(6):
        assert got[c] == [(r[2], r[3] or "") for r in rows if r[0] == c]
    for r in chat.read_back(formatted).collect():
        loss = "".join(x[3] or "" for x in rows if x[0] == r.conv_id and x[2] == "assistant")
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_roles_ids_and_repeated_rows(spark):
    rows = [(1, 0, "a\nb", "c"), (1, 1, "x\\", "<|im_end|>\n"), (1, 2, "\n\\\n<|im_start|>", ""), (2, 0, None, "t"), (2, 0, None, "t"), (2, 1, "assistant", None), (None, 0, "user", "n"), (None, 1, "assistant", "m")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"branch": F.lit(1), "depth": F.lit("z"), "score": F.lit(2)})
    got = {r.conv_id: chat.parse_formatted(r.formatted) for r in chat.format_conversations(table).collect()}
    assert got == {1: [r[2:] for r in rows[:3]], 2: [("user", "t"), ("user", "t"), ("assistant", "")], None: [("user", "n"), ("assistant", "m")]}


def test_reply_branches(spark):
    """Two roots, an orphan, a deep chain: the best branch wins, ties by depth."""
    nodes = [("a", None, 1.0), ("b", "a", 1.0), ("c", "a", 5.0), ("d", "b", 3.0), ("e", "d", 4.0), ("z", "gone", 2.0)] + [(f"n{i}", f"n{i - 1}" if i else None, 0.0) for i in range(70)]
    got = chat.reply_branches(spark.createDataFrame(nodes, "node_id string, parent_id string, score double")).collect()
    by = {}
    for r in got:
        by.setdefault(r.root_id, {})[r.node_id] = r.depth
    assert by["a"] == {"a": 0, "b": 1, "d": 2, "e": 3}
    assert by["z"] == {"z": 0}
    assert by["n0"] == {f"n{i}": i for i in range(70)}
    loop = [("x", "y", 1.0), ("y", "x", 1.0), ("w", "x", 1.0), ("q", None, 0.0), ("v", "q", 0.0)]
    got = chat.reply_branches(spark.createDataFrame(loop, "node_id string, parent_id string, score double")).collect()
    assert {(r.node_id, r.root_id, r.depth) for r in got} == {("x", "x", 0), ("y", "y", 0), ("w", "w", 0), ("q", "q", 0), ("v", "q", 1)}
    two = chat.reply_branches(spark.createDataFrame(nodes[:5], "node_id string, parent_id string, score double"), per_root=2)
    assert {(r.node_id, r.branch) for r in two.collect()} == {("a", 1), ("b", 1), ("d", 1), ("e", 1), ("a", 2), ("c", 2)}


def labelled(kind, n=600):
    import random

    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, rng.randint(5, 60))
        bad = i % 4 == 0
        if bad and kind == "quality":
            text = text.upper().replace(" ", "!! ") if i % 8 else " ".join([text.split(" ")[0]] * 40)
        if bad and kind == "toxic":
            w = text.split(" ")
            w.insert(rng.randrange(len(w)), rng.choice(["idiotic", "idiots", "scum"]))
            text = " ".join(w)
        rows.append((i, None if i % 97 == 5 else text, "en", "s", 0))
        labels.append((i, int(bad == (kind == "toxic")), None if kind == "toxic" and i % 50 == 1 else int(bad)))
    return rows, labels


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifiers(spark, kind):
    rows, labels = labelled(kind)
    docs = table(spark, rows)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    train, score = (quality.train_quality, quality.score_quality) if kind == "quality" else (toxicity.train_toxicity, toxicity.score_toxicity)
    model = train(docs, told, crc32_mod(F.col("label_id"), 4) != 0)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    held = [(y if kind == "quality" else z, got[i]) for i, y, z in labels if fold(i, 4) == 0 and (y if kind == "quality" else z) is not None]
    assert auc(np.array([a for a, _ in held]), np.array([b for _, b in held])) > 0.9
    none = train(docs, told.where("false"), F.lit(True))
    assert {r.score for r in score(docs, none).collect()} == {0.5}
    assert score(docs.where("false"), model).count() == 0


def test_machine_learns_pairs():
    """A label that only a pair of terms tells."""
    rng = np.random.default_rng(0)
    terms, y = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        terms.append(np.array([t for t, on in ((11, a), (22, b), (int(rng.integers(100, 120)), 1)) if on]))
        y.append(int(a and b))
    m = toxicity.fit_machine(terms, np.array(y, float), epochs=30)
    at = lambda ts: 1 / (1 + np.exp(-m.margin(np.array(ts), np.zeros(len(ts), int), 1)[0]))
    assert at([11, 22]) > 0.8 and at([11]) < 0.3 and at([22]) < 0.3


def test_machine_sums_all_pairs():
    rng = np.random.default_rng(1)
    n = 1 << toxicity.BUCKET_BITS
    w, v = np.zeros(n), np.zeros((n, 3))
    some = rng.choice(n, 50, replace=False)
    w[some], v[some] = rng.normal(size=50), rng.normal(size=(50, 3))
    m = toxicity.Machine(-0.4, w, v)
    docs = [rng.choice(some, k, replace=False) for k in (0, 1, 2, 7, 30)]
    got = m.margin(np.concatenate(docs).astype(int), np.repeat(np.arange(5), [len(d) for d in docs]), 5)
    want = [-0.4 + sum(w[i] for i in d) + sum(float(v[i] @ v[j]) for i, j in itertools.combinations(d, 2)) for d in docs]
    assert got == pytest.approx(want)


def test_classifiers_replace_a_score_column_and_keep_repeated_rows(spark):
    rows, labels = labelled("toxic", 200)
    docs = table(spark, [*rows, rows[0], (None, rows[0][1], "en", "s", 0)]).withColumns({"Score": F.lit("x"), "label": F.lit(1)})
    told = spark.createDataFrame([*labels, labels[0], (None, 1, 1)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("y"))
    for module in (toxicity, quality):
        train, score = (module.train_toxicity, module.score_toxicity) if module is toxicity else (module.train_quality, module.score_quality)
        got = score(docs, train(docs, told, F.lit(True))).collect()
        assert len(got) == 202 and len({r.score for r in got if r.doc_id in (0, None)}) == 1
        assert got[0].asDict().keys() == {*DOCS.replace(",", "").split()[::2], "label", "score"}


def test_statistics_of_a_plain_text():
    texts = [b"Alpha beta beta\nalpha beta beta\n", b"", b"ONE!! two|", b"x"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = dict(zip(quality.FEATURES, quality.document_statistics(data, offsets).T, strict=True))
    assert got["log_words"] == pytest.approx(np.log1p([6, 0, 2, 1])) and got["word_longest"].tolist() == [5, 0, 5, 1]
    assert got["distinct_words"].tolist() == [2 / 6, 1, 1, 1] and got["repeat_next"].tolist() == [2 / 6, 0, 0, 0]
    assert got["distinct_lines"].tolist() == [0.5, 1, 1, 1] and got["top_word"].tolist() == [4 / 6, 0, 0.5, 1]
    assert got["all_caps"].tolist() == [0, 0, 0, 0] and got["share_upper"] == pytest.approx([1 / 32, 0, 0.3, 0])


def test_trees_match_plain_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.grow_trees(x, y, trees=20)
    want = []
    for row in x:
        total = m.base
        for f, t, leaf in zip(m.feature, m.threshold, m.leaf, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += leaf[at - len(f)]
        want.append(1 / (1 + math.exp(-total)))
    assert m.score(x) == pytest.approx(want)
    assert auc(y, m.score(x)) > 0.99


def test_suffix_tree_scores(spark):
    rows = corpus(400, 9)
    docs = table(spark, rows)
    got = {r.doc_id: r for r in suffixtree.score_texts(docs, crc32_mod(F.col("doc_id"), 10) != 0).collect()}
    count = Counter()
    for r in rows:
        if fold(r[0], 10):
            count.update(words(r[1]))
            count[None] += 1
    n, v = sum(count.values()), len(count)
    for r in rows:
        w = [*words(r[1]), None]
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        g = got[r[0]]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
        assert g.base_score == pytest.approx(base) and g.score < 0
    held = [got[r[0]] for r in rows if not fold(r[0], 10)]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)
    nothing = suffixtree.score_texts(docs, F.lit(False)).collect()
    assert len(nothing) == len(rows) and all(g.n_known == 0 for g in nothing)


def plain_tree(texts, depth, least):
    """Smoothed distributions of all retained contexts, longest suffix first, by plain counting."""
    streams = [bytes(b for w in words(t) for b in [*w.encode(), 32]) + b"\n" for t in texts]
    count = {}
    for s in streams:
        for i, symbol in enumerate(s):
            before = (b"\n" + s[:i])[-depth:]
            for k in range(len(before) + 1):
                count.setdefault(before[len(before) - k :], Counter())[symbol] += 1
    uniform = [1 / 256] * 256
    dist, kept = {}, {b""}
    for context in sorted(count, key=len):
        seen = count[context]
        n, w = sum(seen.values()), len(seen) * (suffixtree.BACK_OFF if context else 1)
        below = dist[context[1:]] if context else uniform
        dist[context] = [(seen[b] + w * below[b]) / (n + w) for b in range(256)]
        gain = sum(c * math.log(c / n / below[b]) for b, c in seen.items())
        if context and n >= least and gain > suffixtree.PENALTY * len(seen) * math.log(n):
            kept |= {context[i:] for i in range(len(context))}
    return {c: dist.get(c, uniform) for c in kept}


def plain_score(tree, text, depth):
    s = bytes(b for w in words(text) for b in [*w.encode(), 32]) + b"\n"
    total = 0.0
    for i, symbol in enumerate(s):
        before = (b"\n" + s[:i])[-depth:]
        longest = next(before[k:] for k in range(len(before) + 1) if before[k:] in tree)
        total += math.log10(tree[longest][symbol])
    return total


@pytest.mark.parametrize(("least", "most"), [(24, 4_000_000), (3, 300)])
def test_suffix_tree_matches_plain_counting(spark, monkeypatch, least, most):
    """Longest retained suffixes, also where the tree is dealt into several parts."""
    monkeypatch.setattr(suffixtree, "MOST_ENTRIES", most)
    original = suffixtree.fit_tree
    monkeypatch.setattr(suffixtree, "fit_tree", lambda counts, depth: original(counts, depth, least))
    rows = [*corpus(60, 4), (900, "\x00nul \x00\x00 nul", "en", "s", 0), (None, "unseen \U0001f600 words", "en", "s", 0), (900, "again", "en", "s", 0)]
    train = [r for r in rows if fold(r[0], 10)]
    tree = plain_tree([r[1] for r in train], 4, least)
    assert len(tree) > 40 and max(map(len, tree)) == 4
    assert [sum(d) for d in tree.values()] == pytest.approx([1.0] * len(tree))
    docs = table(spark, rows).withColumns({"rid": F.lit("x"), "key": F.lit(1), "told": F.lit(2)})
    got = suffixtree.score_texts(docs, crc32_mod(F.col("doc_id"), 10) != 0, depth=4).collect()
    want = sorted((str(r[0]), plain_score(tree, r[1], 4)) for r in rows)
    have = sorted((str(r.doc_id), r.score) for r in got)
    assert [w[0] for w in want] == [h[0] for h in have]
    assert [h[1] for h in have] == pytest.approx([w[1] for w in want], rel=1e-5)


def test_parts_of_a_suffix_tree_agree_on_rows(spark, monkeypatch, tmp_path):
    """Further parts add to the same texts, of stored tables and of those that are stored nowhere."""
    original = suffixtree.fit_tree
    monkeypatch.setattr(suffixtree, "fit_tree", lambda counts, depth: original(counts, depth, 3))
    table(spark, corpus(60, 4)).repartition(5).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    want = {r.doc_id: r.score for r in suffixtree.score_texts(stored, crc32_mod(F.col("doc_id"), 10) != 0, depth=4).collect()}
    monkeypatch.setattr(suffixtree, "MOST_ENTRIES", 100)
    passes = []
    part_scores = suffixtree._part_scores
    monkeypatch.setattr(suffixtree, "_part_scores", lambda numbered, held: passes.append(1) or part_scores(numbered.repartition(2 + len(passes)), held))
    for docs in (stored, stored.orderBy(F.rand())):
        got = {r.doc_id: r.score for r in suffixtree.score_texts(docs, crc32_mod(F.col("doc_id"), 10) != 0, depth=4).collect()}
        assert got == pytest.approx(want, rel=1e-5)
    assert len(passes) > 2


def test_row_numbers_are_the_same_in_every_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("id % 7 AS doc_id", "cast(id as string) AS text").repartition(5).write.parquet(path)
    numbered = with_row_numbers(spark.read.parquet(path))
    first = {r.text: r["__row"] for r in numbered.collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        again = {r.text: r["__row"] for r in with_row_numbers(spark.read.parquet(path)).select("__row", "text").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert first == again and len(set(first.values())) == 500 and numbered.columns == ["doc_id", "text", "__row"]
    assert with_row_numbers(spark.range(9).toDF("doc_id")).select("__row").distinct().count() == 9


def test_durable_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError):
        shared_dir(Session)
    table = durable(spark.range(3), "gone")
    discard(table)
    with pytest.raises(Exception):
        table.count()


def test_one_split_is_the_best_of_all():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 9, (200, 3)).astype(float), (rng.random(200) < 0.4).astype(float)
    y[x[:, 1] > 5] = 1
    m = quality.grow_trees(x, y, trees=1, depth=1, ridge=1.0, least=1.0)
    p = y.mean()
    g, h = p - y, np.full(200, p * (1 - p))
    gain = {}
    for j in range(3):
        for cut in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= cut
            gain[j, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
    best = max(gain, key=gain.get)
    assert (m.feature[0][0], m.threshold[0][0]) == best
    left = x[:, best[0]] <= best[1]
    assert m.leaf[0] == pytest.approx([-0.15 * g[s].sum() / (h[s].sum() + 1) for s in (left, ~left)])


def test_empty_and_repeated_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    twice = table(spark, [(1, "a b c d e", "en", "s", 9)] * 2 + [(None, "x y", "en", None, 3)])
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.jaccard_components(twice).count() == 3
    assert mixing.mix_sources(empty).count() == 0 and mixing.mix_sources(twice).count() == 3
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0 and packing.pack_documents(twice, tokenizer_path()).count() == 3
    assert fingerprints.edited_likeness(empty).count() == 0 and fingerprints.edited_likeness(twice).count() == 3
    assert suffixtree.score_texts(empty, F.lit(True)).count() == 0 and suffixtree.score_texts(twice, F.lit(True)).count() == 3
    assert embeddings.embedding_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert urlfilter.filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

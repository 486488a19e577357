import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from somatiq.llm import spelling

from .helpers import table

LETTERS = {*map(chr, range(65, 91)), *map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))}
LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, every=97, shortest=5, least=3, ratio=2):
    counts = Counter()
    for doc_id, text, *_ in rows:
        run = ""
        for c in (text or "").translate(LOWER) + " ":
            if c in LETTERS:
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    out = {}
    for w, n in words.items():
        near = sorted((-words[x], x) for x in words if one_edit(w, x))
        best = near[0] if near and -near[0][0] >= ratio * n else None
        out[w] = [best and best[1], n, len(near), best and -best[0]]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def told(df):
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in df.collect()}


def letters(rng, n, alphabet="abé"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_variants_match_a_plain_version(spark):
    rng = random.Random(5)
    stems = [letters(rng, rng.randint(5, 8)) for _ in range(60)] + ["aaaaaa", "aaaaa", "aaaab", "Éclair", "éclair", "eclair", "écläir"]
    rows = []
    for i in range(80):
        words = [rng.choice(stems[: 1 + i % len(stems)]) for _ in range(60)]
        rows.append((i if i % 9 else None, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "×oder÷ a1b c-d " + "日本語straße", "en", "s", 0))
    rows += [(7, None, "en", "s", 0), (8, "", None, None, 0), (9, "Word " * 5, "en", "s", 0), (9, "Word " * 5, "en", "s", 0)]
    rows.append(rows[3])
    for every in (97, 3):
        assert told(spelling.spelling_variants(table(spark, rows), every=every)) == plain(rows, every)


def test_ties_chains_and_clashing_names(spark):
    text = " ".join(["horses"] * 40 + ["horsen"] * 12 + ["horxen"] * 4 + ["mouse"] * 9 + ["mouses"] * 9 + ["house"] * 9 + ["xhouse"] * 3)
    docs = table(spark, [(1, text, "en", "s", 0)]).withColumns({c: F.lit(7) for c in ("word", "n", "id", "key", "form", "root")})
    got = told(spelling.spelling_variants(docs, every=1_000_003))
    assert got == plain([(1, text)], every=1_000_003)
    assert got["horxen"] == ("horsen", 4, 1, 12, "horses") and got["mouses"][:3] == (None, 9, 1)
    assert got["xhouse"][:2] == ("house", 3) and got["house"][2] == 2
    assert spelling.spelling_variants(docs.where("false")).count() == 0


def test_very_long_words(spark):
    long = "ab" * 60_000
    text = " ".join([long] * 6 + [long[:70_000] + "x" + long[70_001:]] * 3 + [long[:-1]] * 3)
    got = told(spelling.spelling_variants(table(spark, [(1, text, "en", "s", 0)]), every=1 << 31))
    assert {(len(w), v[1], v[2], v[3]) for w, v in got.items()} == {(120_000, 6, 2, None), (120_000, 3, 1, 6), (119_999, 3, 1, 6)}


def test_keys_of_deletions():
    words = [b"abca", b"aabb", b"bca", b"a" * 9]
    offsets = np.cumsum([0] + [len(w) for w in words])
    key, word, place, kind = spelling.deletion_keys(np.frombuffer(b"".join(words), np.uint8), offsets)
    texts = [words[w] if p < 0 else words[w][:p] + words[w][p + 1 :] for w, p in zip(word, place, strict=True)]
    for i, j in itertools.combinations(range(len(key)), 2):
        same = texts[i] == texts[j] and ((kind[i] == kind[j] == 0) and place[i] == place[j] if 0 in (kind[i], kind[j]) else True)
        assert (key[i] == key[j]) == same
    # Each distinct deletion once.
    assert sorted(t for t, k, w in zip(texts, kind, word, strict=True) if k == spelling.SHORTENED and w == 1) == [b"aab", b"abb"]


def test_colliding_keys_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(letters(rng, 5, "abcd") for _ in range(200)), "en", "s", 0) for i in range(6)]
    make = spelling._make_keys
    few = lambda batches: (b.set_column(0, "key", pa.array(b.column("key").to_numpy() % 8)) for b in make(batches))
    monkeypatch.setattr(spelling, "_make_keys", few)
    assert told(spelling.spelling_variants(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("most", [1, 50])
def test_counts_are_handed_on_in_parts(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "MOST_COUNTED", most)
    rows = [(i, "alpha beta gamma delta alphas alphas betas gammas", "en", "s", 0) for i in range(20)]
    assert told(spelling.spelling_variants(table(spark, rows))) == plain(rows)

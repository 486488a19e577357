import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from somatiq.llm import divergence

from .helpers import table

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least=30, top=50):
    docs = [((r[2] or ""), (r[3] or ""), TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    found, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        found[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {lang: [t for t, n in found[lang].items() if n >= least] for lang, _, _ in docs}
    share = lambda n, total, v: 1 + 10**9 * (n + 5) // (total + 5 * v)
    p, whole = {}, {}
    for (lang, source), c in counts.items():
        total = sum(c[t] for t in kept[lang])
        p[lang, source] = {t: share(c[t], total, len(kept[lang])) for t in kept[lang]}
    for lang, terms in kept.items():
        all_of = {t: sum(c[t] for (other, _), c in counts.items() if other == lang) for t in terms}
        whole[lang] = {t: share(all_of[t], sum(all_of.values()), len(terms)) for t in terms}
    out = set()
    for lang, source in counts:
        parts = {
            "pair": [(s, sum(abs(p[lang, source][t] - p[lang, s][t]) for t in kept[lang])) for other, s in counts if other == lang and s != source],
            "term": [(t, p[lang, source][t] - whole[lang][t]) for t in kept[lang] if counts[lang, source][t] and p[lang, source][t] > whole[lang][t]],
        }
        for part, items in parts.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(items[: top if part == "term" else None])}
    return out


def told(df):
    rows = df.collect()
    out = {(r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


def sample(n=160, seed=3):
    rng = random.Random(seed)
    terms = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Été", "ÉTÉ", "日本", "😀", "ﬀ", "a`b"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", None, ""])
        source = rng.choice(["a", "a", "a", "b", "é", "￿", "😀", None, ""])
        words = [terms[min(int(rng.expovariate(0.06)), len(terms) - 1)] for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice([i, 1, None]), rng.choice([" ", "\x00", "-9_", "\x7f"]).join(w.upper() if rng.random() < 0.2 else w for w in words), lang, source, 0))
    return rows + [(1, None, "en", "only null", 0), (2, "", "xx", "a", 0), (3, "zz " * 3000, "xx", "b", 0), (4, "word", "yy", "alone", 0), rows[0], rows[0]]


def test_divergence_matches_a_plain_version(spark):
    rows = sample()
    for least, top in ((30, 50), (2, 3), (10_000, 50)):
        assert told(divergence.source_divergence(table(spark, rows), least, top)) == plain(rows, least, top)


def test_extra_columns_and_empty_tables(spark):
    docs = table(spark, sample(40)).withColumns({c: F.lit(1) for c in ("term", "n", "g", "a", "b", "item", "value", "rank", "part")})
    assert told(divergence.source_divergence(docs, 3)) == plain(sample(40), 3)
    assert divergence.source_divergence(docs.where("false")).count() == 0


def test_joint_counts_in_parts(monkeypatch):
    rng = np.random.default_rng(2)
    term, source = np.divmod(rng.choice(30 * 12, 200, replace=False), 12)
    n = rng.integers(1, 4, 200) * 5_000_000_000
    want = Counter()
    cells = defaultdict(dict)
    for t, s, c in zip(term, source, n, strict=True):
        cells[t][s] = c
    for own in cells.values():
        want.update((a, own[a], b, own[b]) for a in own for b in own if a < b)
    for most in (1 << 22, 7, 1):
        monkeypatch.setattr(divergence, "_PAIRS", most)
        got = Counter()
        for a, x, b, y, times in zip(*divergence.joint_counts(term, source, n), strict=True):
            got[a, x, b, y] += times
        assert got == want


def test_tallies_and_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_CELLS", 3)
    monkeypatch.setattr(divergence, "MOST_COUNTED", 5)
    rows = sample(60, 9)
    assert told(divergence.source_divergence(table(spark, rows), 4)) == plain(rows, 4)


def test_shares_are_exact(spark):
    n, total = 7 * 10**15 + 3, 9 * 10**16 + 1
    row = spark.createDataFrame([(n, total, 12)], "n long, total long, kept long").select(divergence.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 60)

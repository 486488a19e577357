"""Small tables with every awkward case, and brute-force versions."""

import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["tion", "er", "an", "the", "in", "ou", "st", "é", "re", "ha", "nd"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sentence(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


def corpus(n=120, seed=1):
    """Documents with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    out = []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 6)))
        if i % 5 == 1:
            text = f"{passage}\n{text}"
        if i % 7 == 3 and out:
            text = rng.choice(out)[1]
        if i % 7 == 5 and out:
            w = (rng.choice(out)[1] or "").split(" ")
            w[rng.randrange(len(w))] = "edit"
            text = " ".join(w)
        if i % 29 == 4:
            text = None
        if i % 31 == 6:
            text = rng.choice(["", "  \n", "one", "two words", "Ａ ﬁne  Éclair"])
        if i == 50:
            text = sentence(rng, 6000)
        out.append((i, text))
    return [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or "")) for i, t in out]


def table(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, DOCS)


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]

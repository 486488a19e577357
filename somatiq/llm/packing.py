"""Order-preserving packing of token streams into windows by dynamic programming.

Documents follow each other as they are stored. Windows may be cut at document ends (free), at
sentence ends (a small penalty) and, so that no stretch lacks a cut, inside long sentences (a
larger one). Cuts minimise padding plus penalties: with g(i) = cost(i) + position(i), the best
previous cut of each cut is the minimum of g over a sliding range, which a monotone queue keeps.
Each input partition is packed by itself in pieces of bounded memory: no shuffle, no global order.

Edge cases: a null text is empty, and an empty document still has its end id; a document longer
than a window is cut; repeated ids are documents of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Fixed value: how the byte-level vocabulary splits texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters alone split alike in both tokenizer libraries.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧]*")
#: Penalties in tokens of padding.
SENTENCE_CUT, HARD_CUT, HARD_EVERY = 4, 64, 256
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _byte_names() -> dict[str, int]:
    """The printable names that byte-level vocabularies give to bytes: by rule, not by table."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def load_encoder(path: str) -> tuple[Callable[[list[str]], list], np.ndarray]:
    """(encode texts to id lists, whether an id ends a sentence) of a byte-level tokenizer file."""
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    names = _byte_names()
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    special = {t["content"] for t in told["added_tokens"]}
    ranks = {bytes(names[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
    quick = tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    ends = np.zeros(exact.get_vocab_size() + 1, bool)
    for token, i in ranks.items():
        ends[i] = token[-1:] in (b".", b"!", b"?", b"\n")

    def encode(texts: list[str]) -> list:
        # The two libraries give equal ids for plain texts; all others go to the exact one.
        return [quick.encode_ordinary(t) if _PLAIN.fullmatch(t) and not any(s in t for s in special) else exact.encode(t, add_special_tokens=False).ids for t in texts]

    return encode, ends


def choose_cuts(positions: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Indices of the cuts, first and last included, that minimise padding plus penalties.

    positions ascend from 0 by steps of at most window. A window whose length is a power of two
    needs no padding; a quarter of what it lacks keeps such windows few.
    """
    pos, pen = positions.tolist(), penalties.tolist()
    at = {p: i for i, p in enumerate(pos)}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    cost, back = [0] * len(pos), [0] * len(pos)
    queue: deque[int] = deque([0])
    value = [0] * len(pos)  # cost + position
    for j in range(1, len(pos)):
        p = pos[j]
        while pos[queue[0]] < p - window:
            queue.popleft()
        best, own = value[queue[0]] + window - p, queue[0]
        if best > 0:
            for k in powers:
                i = at.get(p - k)
                if i is not None and cost[i] + (window - k) / 4 < best:
                    best, own = cost[i] + (window - k) / 4, i
        cost[j] = best + pen[j]
        back[j] = own
        value[j] = cost[j] + p
        while queue and value[queue[-1]] >= value[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [len(pos) - 1], len(pos) - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


def candidate_cuts(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties): 0, document ends, sentence ends, and hard cuts inside long gaps."""
    known = np.unique(np.concatenate([[0, total], doc_ends, sentence_ends]))
    gaps = np.diff(known)
    long = np.flatnonzero(gaps > HARD_EVERY)
    hard = [known[i] + np.arange(HARD_EVERY, gaps[i], HARD_EVERY) for i in long]
    pos = np.unique(np.concatenate([known, *hard])) if hard else known
    pen = np.full(len(pos), HARD_CUT)
    pen[np.searchsorted(pos, sentence_ends)] = SENTENCE_CUT
    pen[np.searchsorted(pos, doc_ends)] = 0
    pen[[0, -1]] = 0
    return pos, pen


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, segment: int = 400_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (uint32, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = load_encoder(tokenizer_path)
        serial = TaskContext.get().partitionId() << 33
        # The buffer: pieces of documents that still lack a window, and their ids.
        held: list[tuple[int | None, int, int]] = []  # doc_id, start of the piece, tokens of the document
        parts: list[np.ndarray] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, parts, size, serial
            if not size:
                return
            ids = np.concatenate(parts)
            lengths = np.array([len(p) for p in parts])
            doc_ends = np.cumsum(lengths)
            open_end = not last
            pos, pen = candidate_cuts(doc_ends, np.flatnonzero(ends[ids]) + 1, len(ids))
            cuts = pos[choose_cuts(pos, pen, window)]
            if open_end and len(cuts) > 3:  # the tail is cut anew with what follows
                cuts = cuts[:-2]
            upto = int(cuts[-1])
            begins = doc_ends - lengths
            edges = np.unique(np.concatenate([cuts, doc_ends[doc_ends < upto], begins[begins < upto]]))
            left, right = edges[:-1], edges[1:]
            owner = np.searchsorted(doc_ends, left, side="right")
            seq = np.searchsorted(cuts, left, side="right") - 1
            raw = ids.tobytes()
            rows = [pa.array([held[o][0] for o in owner.tolist()], pa.int64()), pa.array(left - begins[owner] + np.array([h[1] for h in held])[owner]), pa.array(right - left), pa.array(np.array([h[2] for h in held])[owner]), pa.array(serial + seq), pa.array(left - cuts[seq]), pa.array([raw[4 * a : 4 * b] for a, b in zip(left.tolist(), right.tolist(), strict=True)], pa.binary())]
            serial += len(cuts) - 1
            for at in range(0, len(left), 5000):
                yield pa.RecordBatch.from_arrays([r.slice(at, 5000) for r in rows], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            keep = int(np.searchsorted(doc_ends, upto, side="right"))
            if keep < len(held):
                skip = upto - int(begins[keep])
                doc, start, tokens = held[keep]
                held, parts = [(doc, start + max(0, skip), tokens), *held[keep + 1 :]], [parts[keep][max(0, skip) :], *parts[keep + 1 :]]
            else:
                held, parts = [], []
            size = len(ids) - upto

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                texts = [t or "" for t in piece.column(1).to_pylist()]
                for doc, ids in zip(piece.column(0).to_pylist(), encode(texts), strict=True):
                    own = np.empty(len(ids) + 1, np.uint32)
                    own[:-1] = ids
                    own[-1] = end_id
                    held.append((doc, 0, len(own)))
                    parts.append(own)
                    size += len(own)
                if size >= segment:
                    yield from flush(False)
        yield from flush(True)

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)

"""Vectorised text kernels: words, word hashes and shingle hashes of many documents at once.

A word is a maximal run of characters other than space and the five ASCII controls 0x09-0x0D;
A-Z are lower-cased. All kernels work on the UTF-8 bytes of whole texts.
"""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD6E8FEB86659FD93)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is-word-byte mask, first byte of each word, document of each word)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    return inside, starts, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(64-bit hash, document) of each word of each text, in order.

    For each number of bytes in ``heads`` there follows an array with the hash of so many first
    bytes of each word (salted with the number).
    """
    inside, starts, doc = word_starts(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0, np.int64), *(none for _ in heads)
    first = np.zeros(len(data), np.int32)
    first[starts] = 1
    place = np.arange(len(data), dtype=np.int64) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    place[~inside] = 0
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    parts = (_LOWER[data].astype(np.uint64) + _U(1)) * powers[place]
    parts[~inside] = 0
    h = mix64(np.add.reduceat(parts, starts))
    out = []
    for k in heads:
        out.append(mix64(np.add.reduceat(np.where(place < k, parts, _U(0)), starts) ^ (_U(k * int(_STEP) & (1 << 64) - 1))))
    return h, doc, *out


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each run of k words within a document.

    A document with 1 to k-1 words gives one shingle, of its whole sequence; one without words none.
    """
    counts = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((counts > 0) & (counts < k))
    h, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= k:
        m = len(words) - k + 1
        h = words[:m].copy()
        for i in range(1, k):
            h = mix64(h * _STEP + words[i : m + i])
        whole = doc[:m] == doc[k - 1 :]
        h, d = h[whole], doc[:m][whole]
    if len(short):
        begin = np.searchsorted(doc, short)
        extra = words[begin].copy()
        for i in range(1, k - 1):
            more = counts[short] > i
            extra[more] = mix64(extra[more] * _STEP + words[begin[more] + i])
        extra = mix64(extra ^ _U(0x5851F42D4C957F2D) * counts[short].astype(np.uint64))
        h, d = np.concatenate([h, extra]), np.concatenate([d, short])
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    return h, d


#: Bits that number the documents of a slice while their hashes are sorted; the rest are a token.
_DOC_BITS = 12
TOKEN_BITS = 64 - _DOC_BITS


def distinct_sets(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct tokens in ascending order: (tokens of 52 bits, offsets).

    Document number and token share one 64-bit key, so that one plain sort does; a slice has
    4096 documents at most.
    """
    if n_docs > 1 << _DOC_BITS:
        raise ValueError("too many documents in a slice")
    key = (doc.astype(np.uint64) << _U(TOKEN_BITS)) | (h >> _U(_DOC_BITS))
    key.sort()
    if len(key):
        keep = np.ones(len(key), bool)
        keep[1:] = key[1:] != key[:-1]
        key = key[keep]
    own = (key >> _U(TOKEN_BITS)).astype(np.int64)
    offsets = np.searchsorted(own, np.arange(n_docs + 1))
    return key & _U((1 << TOKEN_BITS) - 1), offsets

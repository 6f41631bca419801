"""Vectorised word and n-gram hashing over whole batches of texts.

A batch of texts is laid out as one byte array; words are maximal runs of
bytes that are neither ASCII punctuation, control nor blank; every word gets a
64-bit polynomial hash from two prefix sums, so no Python code runs per word.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C55  # odd, so invertible modulo 2**64
_PINV = pow(_P, -1, 1 << 64)
_BYTES = np.arange(256)
_IS_WORD = (
    (_BYTES >= 128)
    | ((_BYTES >= 48) & (_BYTES <= 57))
    | ((_BYTES >= 65) & (_BYTES <= 90))
    | ((_BYTES >= 97) & (_BYTES <= 122))
)
#: The same words as a regular expression, for SQL and brute-force versions.
WORD_RE = r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        step = np.uint64(pow(base, filled, 1 << 64))
        out[filled : filled + take] = out[:take] * step
        filled += take
    return out


#: Bytes that are hashed together; a longer word is a piece of its own.
_PIECE = 1 << 19
_POWER_CACHE: list[np.ndarray] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _PIECE + 1:
        return _powers(_P, n), _powers(_PINV, n)
    if not _POWER_CACHE:
        _POWER_CACHE.extend((_powers(_P, _PIECE + 1), _powers(_PINV, _PIECE + 1)))
    return _POWER_CACHE[0][:n], _POWER_CACHE[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer (bijective on 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words of a byte array."""
    inside = _IS_WORD[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, in pieces of bounded memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = int(np.searchsorted(ends, base + _PIECE, side="right"))
        hi = max(hi, lo + 1)
        piece = buf[base : int(ends[hi - 1])]
        power, inverse = _power_table(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
        a, b = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        lo = hi
    return out


def batch_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, offsets): the words of text i are hashes[offsets[i]:offsets[i+1]].

    Texts are lower-cased; a null counts as an empty text.
    """
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    starts, ends = word_spans(buf)
    return hash_spans(buf, starts, ends), np.searchsorted(starts, bounds)


_DOCS = 2048  # texts that are sorted together; their number takes the upper 11 bits of a key
GRAM_BITS = 53


def batch_ngrams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 53-bit n-gram hashes of each text, offsets).

    A text of fewer than n words, but of one at least, has one n-gram: all its words.
    """
    parts, sizes = [], []
    for lo in range(0, len(texts), _DOCS):
        words, offsets = batch_words(texts[lo : lo + _DOCS])
        counts = np.diff(offsets)
        grams = window_hashes(words, n)
        doc = np.repeat(np.arange(len(counts)), counts)
        keep = np.arange(len(words)) - offsets[doc] <= counts[doc] - n
        for i in np.flatnonzero((counts < n) & (counts > 0)):
            grams[offsets[i]] = window_hashes(np.append(words[offsets[i] : offsets[i + 1]], np.uint64(counts[i])), int(counts[i]) + 1)[0]
            keep[offsets[i]] = True
        keys = (doc[keep].astype(np.uint64) << np.uint64(GRAM_BITS)) | (grams[keep] >> np.uint64(64 - GRAM_BITS))
        keys.sort()
        if len(keys):
            keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
        parts.append(keys & np.uint64((1 << GRAM_BITS) - 1))
        sizes.append(np.bincount((keys >> np.uint64(GRAM_BITS)).astype(np.int64), minlength=len(counts)))
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; 0 where fewer are left."""
    out = np.zeros(len(words), dtype=np.uint64)
    m = len(words) - n + 1
    if m > 0:
        acc = np.zeros(m, dtype=np.uint64)
        for k in range(n):
            acc = acc * np.uint64(_P) + words[k : k + m]
        out[:m] = mix64(acc)
    return out

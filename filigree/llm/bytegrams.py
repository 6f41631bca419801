"""Hashed byte n-grams of whole batches of texts, and sums of weights over them."""

from __future__ import annotations

import numpy as np


def gram_index(texts: list[str | None], n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, offsets by text).

    A text is padded with one blank on the left and n - 1 on the right, so any
    text has an n-gram at each of its bytes and one more; a null is an empty text.
    """
    pad = b" " * (n - 1)
    raw = [b" " + (t or "").encode("utf-8", "replace") + pad for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    code = np.zeros(max(0, len(buf) - n + 1), dtype=np.uint32)
    for k in range(n):
        code *= np.uint32(0x01000193)
        code ^= buf[k : k + len(code)]
    code *= np.uint32(0x9E3779B1)
    code >>= np.uint32(32 - bits)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    keep = np.ones(len(code), dtype=bool)
    for k in range(1, n):
        last = ends - k
        keep[last[last < len(code)]] = False
    return code[keep], np.concatenate(([0], np.cumsum(sizes - n + 1))) if len(starts) else np.zeros(1, dtype=np.int64)


def mean_weights(index: np.ndarray, offsets: np.ndarray, weights: np.ndarray, shrink: float = 0.0) -> np.ndarray:
    """Mean of the weights (one value or one row a bucket) over each text's n-grams and shrink more of weight zero."""
    size = np.maximum(np.diff(offsets) + shrink, 1)
    columns = weights.reshape(len(weights), -1)
    out = np.zeros((len(offsets) - 1, columns.shape[1]))
    for k in range(columns.shape[1]):
        picked = np.ascontiguousarray(columns[:, k])[index]
        if len(picked):
            out[:, k] = np.add.reduceat(np.append(picked, 0).astype(np.float64), offsets[:-1])
    out[np.diff(offsets) == 0] = 0
    return (out / size[:, None]).reshape(len(offsets) - 1, *weights.shape[1:])


def histograms(texts: list[str | None], n: int, bits: int, shrink: float = 0.0) -> np.ndarray:
    """Share of each bucket among a text's n-grams and shrink more that have none, one row a text."""
    out = np.zeros((len(texts), 1 << bits), dtype=np.float32)
    for i, text in enumerate(texts):
        index, _ = gram_index([text], n, bits)
        out[i] = np.bincount(index, minlength=1 << bits) / max(1, len(index) + shrink)
    return out

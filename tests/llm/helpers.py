"""Brute-force helpers for the training-data tests."""

import re

from filigree.llm.hashing import WORD_RE

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
_WORD = re.compile(WORD_RE)


def documents(spark, rows):
    """Documents of (doc_id, text) or of whole rows."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "web-1", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text, lower=True):
    return _WORD.findall((text or "").lower() if lower else (text or ""))


def gram_set(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

"""Quality classifier by weak labels.

Overlapping heuristic labellers vote good (1), bad (-1) or abstain (0) on each
document.  Expectation-maximisation over the counts of vote patterns of all
documents estimates how each labeller votes on good and on bad documents, and
so the posterior of each pattern.  A linear scorer over hashed byte trigrams
and repeated words is trained on the posteriors, and its score decides.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm import bytegrams
from filigree.llm.common import stored, text_slices, without

BITS = 12
#: A short text's trigrams count for less: this many are added that say nothing.
SHRINK = 200.0
_STOP = [" the ", " of ", " and ", " to ", " in ", " is ", " de ", " la ", " le ", " et ", " les ", " que ", " der ", " die ", " und ", " das ", " ist ", " el ", " los ", " en ", " y ", " un "]
_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_PLAIN = set(b" \t\r\n.,;:!?'\"()-0123456789")
_SYMBOL = np.array([b < 128 and not (_UPPER[b] or _LOWER[b] or b in _PLAIN) for b in range(256)])


def _votes(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return good.astype(np.int8) - (bad & ~good).astype(np.int8)


def labeller_votes(texts: list[str | None]) -> np.ndarray:
    """Votes of the ten labellers, one row a text; all abstain on a null or empty text.

    They look at symbols, capitals, bars, exclamation marks, repeated lines,
    full stops, word length, function words, repeated words and variety of words.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    size = np.fromiter(map(len, raw), dtype=np.float64, count=len(raw))
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    buf = np.frombuffer(b"".join(raw) + b" ", dtype=np.uint8)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.add.reduceat(flags[buf].astype(np.int32), np.minimum(offsets[:-1], len(buf) - 1)) if len(raw) else np.zeros(0)
        return np.where(size > 0, sums, 0)

    symbol, upper, lower = count(_SYMBOL), count(_UPPER), count(_LOWER)
    bar, shout, stop = count(_BYTE == 124), count(_BYTE == 33), count(_BYTE == 46)
    words = np.maximum(1, count((_BYTE == 32) | (_BYTE == 10)) + 1)
    letters = np.maximum(1, upper + lower)
    lines = [r.split(b"\n") for r in raw]
    line_count = np.array([len(x) for x in lines], dtype=np.float64)
    distinct = np.array([len(set(x)) for x in lines], dtype=np.float64)
    function = np.array([sum(map(t.count, _STOP)) if t else 0 for t in (x and x.lower() for x in texts)], dtype=np.float64)
    some, several, many, size = size > 0, words >= 5, words >= 20, np.maximum(size, 1)
    repeats, variety = repeated_share(texts), distinct_share(texts)
    return np.stack(
        [
            _votes(some & (symbol / size < 0.02), symbol / size > 0.06),
            _votes(several & (upper / letters < 0.2), several & (upper / letters > 0.6)),
            _votes(several & (bar == 0), several & (bar / words > 0.15)),
            _votes(several & (shout / words < 0.05), several & (shout / words > 0.3)),
            _votes((line_count >= 4) & (distinct / line_count > 0.9), (line_count >= 4) & (distinct / line_count < 0.5)),
            _votes(many & (stop / words > 0.02), (words >= 60) & (stop == 0)),
            _votes(several & (size / words < 10) & (size / words > 3), several & ((size / words > 14) | (size / words < 2.5))),
            _votes(many & (function / words > 0.05), many & (function / words < 0.005)),
            _votes(several & (repeats < 0.05), several & (repeats > 0.3)),
            _votes(many & (variety > 0.35), many & (variety < 0.2)),
        ],
        axis=1,
    )


def distinct_share(texts: list[str | None]) -> np.ndarray:
    """Distinct words of a text by its words."""
    words = [t.split() if t else [] for t in texts]
    return np.array([len(set(w)) / max(1, len(w)) for w in words], dtype=np.float64)


def repeated_share(texts: list[str | None]) -> np.ndarray:
    """Share of a text's words that equal the word before."""
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        words = text.split() if text else []
        if len(words) > 1:
            out[i] = sum(map(operator.eq, words, itertools.islice(words, 1, None))) / (len(words) - 1)
    return out


def pattern_codes(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) + 1) @ (3 ** np.arange(votes.shape[1]))


def fit_accuracies(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, p[labeller, class, vote bad or good], posterior of good by pattern) by expectation-maximisation.

    patterns: votes, one row each; counts: documents with it.  An abstention is
    no evidence.  At first a document with a bad vote counts as mostly bad,
    since each kind of junk shows itself to few labellers.
    """
    weight = counts.astype(float)
    good = np.where((patterns < 0).any(axis=1), 0.02, 0.98)
    share, table = 0.5, np.zeros((patterns.shape[1], 2, 2))
    onehot = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)
    for _ in range(steps):
        share = float(np.clip((weight * good).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        for k, belief in enumerate((1 - good, good)):
            mass = np.einsum("p,pjv->jv", weight * belief, onehot) + 1.0
            table[:, k] = mass / mass.sum(axis=1, keepdims=True)
        logs = np.einsum("pjv,jkv->pk", onehot, np.log(table)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        moved = np.abs(new - good).max() if len(new) else 0.0
        good = new
        if moved < 1e-9:
            break
    return share, table, good


def train_scorer(texts: list[str | None], target: np.ndarray, epochs: int = 60, seed: int = 3) -> np.ndarray:
    """Weights over the hashed trigram shares, the share of repeated words and the bias, by minibatch stochastic gradients."""
    x = np.hstack((bytegrams.histograms(texts, 3, BITS, SHRINK), repeated_share(texts).astype(np.float32)[:, None]))
    scale = 1 / np.maximum(x.std(axis=0), 1e-4) if len(x) else np.ones((1 << BITS) + 1)
    x *= scale
    w, b = np.zeros((1 << BITS) + 1), 0.0
    first, second, rng, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), np.random.default_rng(seed), 0
    for _ in range(epochs if len(x) else 0):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            p = 1 / (1 + np.exp(-np.clip(x[rows] @ w + b, -30, 30)))
            slope = np.append((p - target[rows]) @ x[rows] / len(rows) + 1e-4 * w, (p - target[rows]).mean())
            t += 1
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            step = 0.002 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return np.append(w * scale, b)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = 4000) -> tuple[np.ndarray, DataFrame]:
    """(scorer weights, vote pattern and weak posterior of every document).

    Accuracies come from the votes on all documents.  The scorer is trained on
    at most train_rows documents, half of them with a posterior below one half
    where there are so many, those of the smallest hashed ids.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                codes = pattern_codes(labeller_votes(batch.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes, pa.int64())], names=["doc_id", "pattern"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("pattern", T.LongType())])
    votes = stored(slim.where("text <> ''").mapInArrow(run, schema), "quality-votes")
    found = votes.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3**10 rows
    codes = np.array([r["pattern"] for r in found], dtype=np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(10)) % 3 - 1
    _, _, posterior = fit_accuracies(patterns, np.array([r["count"] for r in found], dtype=np.int64))
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior)], "pattern long, posterior double")
    judged = votes.join(F.broadcast(table), "pattern")  # at most 3**10 rows
    chosen = None
    for side in (F.col("posterior") < 0.5, F.col("posterior") >= 0.5):
        part = judged.where(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows // 2).select("doc_id", "posterior")
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = slim.where("text <> ''").join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * train_rows).collect()  # at most train_rows ids
    weights = train_scorer([r["text"] for r in rows], np.array([r["posterior"] for r in rows], dtype=float))
    return weights, judged


def score_texts(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    index, offsets = bytegrams.gram_index(texts, 3, BITS)
    margin = bytegrams.mean_weights(index, offsets, weights[:-2].astype(np.float32), SHRINK) + weights[-2] * repeated_share(texts) + weights[-1]
    score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    return np.where([bool(t) for t in texts], score, 0.0)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "quality_score", threshold: float | None = None) -> DataFrame:
    """docs with column out in [0, 1], which replaces one of that name; null and empty texts score 0.

    With a threshold only the rows that reach it stay.
    """
    docs = without(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                values = score_texts(batch.column(text).to_pylist(), weights)
                batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, out])
                yield batch if threshold is None else batch.filter(pa.array(values >= threshold))

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, quality_score and keep of every document.

    Null and empty texts are rejected, an empty table gives an empty one,
    repeated rows give repeated rows; rows without id are classified too.
    """
    weights, _ = fit(docs, doc_id, text)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score(slim, weights).drop("text").withColumn("keep", F.col("quality_score") >= threshold)


def kept(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, that the classifier keeps."""
    weights, _ = fit(docs, doc_id, text)
    held = "__quality_score"
    return score(docs, weights, text, held, threshold).drop(held)

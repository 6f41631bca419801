"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the byte 3- and 4-grams of a text; each kind hashes to its own
buckets of one embedding table, a text is the mean of its embeddings, and a
softmax layer gives the languages.  Both are trained by minibatch stochastic
gradients in numpy on a bounded sample of labelled rows.  A held-out part sets
the temperature and the confidence below which a text is rejected ("und").
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filigree.llm import bytegrams
from filigree.llm.common import stored, text_slices, without

BITS = 12
GRAMS = (3, 4)
SHRINK = 10.0
UNKNOWN = "und"


@dataclass
class Model:
    """scores: one row a bucket and kind, the embedding times the softmax layer."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


def _features(texts: list[str | None]) -> np.ndarray:
    lower = [t.lower() if t else t for t in texts]
    return np.hstack([bytegrams.histograms(lower, n, BITS, SHRINK) for n in GRAMS]) / len(GRAMS)


def train(texts: list[str | None], labels: list[str], dims: int = 16, epochs: int = 40, seed: int = 5, held_out: float = 0.25, rejected: float = 0.001) -> Model:
    """The model of labelled texts.

    Every 1/held_out-th text calibrates: the temperature is the one of least
    log loss, and the confidence bound rejects at most the share rejected of
    those that are identified rightly, unless the floor, 1.5 times about an
    even share, is higher.  Without texts the model rejects all.
    """
    languages = sorted(set(labels))
    size = len(GRAMS) << BITS
    if not languages:
        return Model([UNKNOWN], np.zeros((size, 1)), np.zeros(1), 1.0, 2.0)
    x = _features(texts)
    y = np.array([languages.index(v) for v in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    cut = max(1, int(len(order) * held_out)) if len(order) > 3 else 0
    held, fitted = order[:cut], order[cut:]
    table, layer, bias = rng.normal(0, 0.1, (size, dims)), rng.normal(0, 0.1, (dims, len(languages))), np.zeros(len(languages))
    onehot = np.eye(len(languages))[y]
    rate = 4.0
    for epoch in range(epochs):
        for at in range(0, len(fitted), 32):
            rows = rng.choice(fitted, min(32, len(fitted)), replace=False)
            hidden = x[rows] @ table
            p = _softmax(hidden @ layer + bias)
            slope = (p - onehot[rows]) / len(rows)
            back = slope @ layer.T
            layer -= 0.5 * rate * hidden.T @ slope
            bias -= 0.05 * rate * slope.sum(axis=0)
            table -= 20 * rate * (x[rows].T @ back)
        rate *= 0.93
    scores = table @ layer
    margins = x[held] @ scores + bias if cut else np.zeros((0, len(languages)))
    grid = np.geomspace(0.2, 5, 25)
    losses = [-np.log(_softmax(margins / t)[np.arange(cut), y[held]] + 1e-12).mean() if cut else 0.0 for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    p = _softmax(margins / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[held]]) if cut else np.zeros(0)
    floor = 1.5 / (len(languages) + 0.5)
    least = max(floor, float(right[int(len(right) * rejected)])) if len(right) else floor
    return Model(languages, scores, bias, temperature, least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True) if len(x) else x


def identify(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """(language, confidence) of each text; a null or blank text, or one without a letter, is unknown with confidence 0."""
    lower = [t.lower() if t else t for t in texts]
    margin = np.zeros((len(texts), len(model.languages))) + model.bias
    for k, n in enumerate(GRAMS):
        index, offsets = bytegrams.gram_index(lower, n, BITS)
        margin += bytegrams.mean_weights(index, offsets, model.scores[k << BITS : (k + 1) << BITS].astype(np.float32), SHRINK) / len(GRAMS)
    p = _softmax(margin / model.temperature)
    best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=int)
    sure = p.max(axis=1) if len(p) else np.zeros(0)
    worded = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
    found = [model.languages[b] if w and s >= model.least else UNKNOWN for b, s, w in zip(best, sure, worded)]
    return found, np.where(worded, sure, 0.0)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", rows_per_language: int = 500) -> Model:
    """The model of at most rows_per_language labelled rows a language, those of the smallest hashed ids; null labels and empty texts don't count."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"), F.col(text).alias("text")).where("label is not null and text <> ''")
    ranked = Window.partitionBy("label", "part").orderBy("h", "doc_id")
    keyed = slim.select("doc_id", "label", F.xxhash64("doc_id").alias("h")).withColumn("part", F.pmod("h", F.lit(64)))
    nearest = keyed.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= rows_per_language)
    ids = nearest.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))).where(F.col("n") <= rows_per_language).select("doc_id", "label")
    ids = stored(ids.distinct(), "language-sample")
    few = ids.count() <= 200_000
    rows = slim.join(F.broadcast(ids) if few else ids, ["doc_id", "label"]).orderBy(F.xxhash64("doc_id"), "doc_id", "label").collect()  # bounded by rows_per_language
    return train([r["text"] for r in rows], [r["label"] for r in rows])


def tag(docs: DataFrame, model: Model, text: str = "text", out: str = "language", sure: str = "confidence") -> DataFrame:
    """docs with columns out and sure, which replace columns of these names; null and wordless texts are unknown with confidence 0.

    Texts are read whole, however long.  Repeated rows give repeated rows, an
    empty table an empty one.
    """
    docs = without(docs, out, sure)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType()), T.StructField(sure, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                found, confidence = identify(batch.column(text).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(confidence, pa.float64())], names=[*batch.schema.names, out, sure])

    return docs.mapInArrow(run, schema)

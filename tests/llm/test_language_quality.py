import random

import numpy as np
import plain
import pytest

from pyspark.sql import functions as F

from filigree.llm import language, quality
from helpers import DOCS, documents

STEMS = {"en": "the of and thing water house reading", "fr": "le les des chose eau maison lisant", "de": "der die und sache wasser haus lesend"}


def sentence(lang, rng, size):
    return " ".join(rng.choice(STEMS[lang].split()) + rng.choice(["", "s", "e"]) for _ in range(size)) + "."


def labelled(seed, count):
    rng = random.Random(seed)
    return [(i, sentence(lang, rng, rng.randrange(5, 40)), lang, "web-1", 0) for i in range(count) for lang in [rng.choice(sorted(STEMS))]]


def test_language_held_out_accuracy(spark):
    model = language.fit(spark.createDataFrame(labelled(1, 600), DOCS))
    held = labelled(2, 300)
    out = language.tag(spark.createDataFrame(held, DOCS), model).collect()
    assert sum(r["language"] == r["lang"] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["confidence"] <= 1 for r in out)


def test_language_odd_rows(spark):
    model = language.fit(spark.createDataFrame(labelled(1, 300), DOCS))
    rows = [(1, None), (None, ""), (2, "  \n"), (3, "12345 !!"), (4, "the house and water " * 40_000), (4, "the house and water " * 40_000)]
    out = language.tag(documents(spark, rows).selectExpr("*", "'x' as LANGUAGE", "'y' as confidence"), model)
    assert out.columns[-2:] == ["language", "confidence"]
    got = out.collect()
    assert len(got) == 6
    assert all((r["language"], r["confidence"]) == ("und", 0.0) for r in got if r["doc_id"] != 4)
    assert all(r["language"] == "en" for r in got if r["doc_id"] == 4)


@pytest.mark.parametrize("left_out", sorted(STEMS))
def test_language_not_trained_is_unknown(left_out):
    rows = [r for r in labelled(1, 600) if r[2] != left_out]
    model = language.train([r[1] for r in rows], [r[2] for r in rows])
    held = labelled(2, 300)
    found, _ = language.identify([r[1] for r in held], model)
    unseen = [f for f, r in zip(found, held) if r[2] == left_out]
    assert unseen.count(language.UNKNOWN) >= 0.9 * len(unseen)
    assert sum(f == r[2] for f, r in zip(found, held)) >= 0.97 * (len(held) - len(unseen))


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None, None, 3)], DOCS)
    out = language.tag(docs, language.fit(docs)).collect()
    assert out[0]["language"] == "und"
    none = documents(spark, [])
    assert language.tag(none, language.fit(none)).collect() == []


def test_sampling_bound(spark):
    docs = spark.createDataFrame(labelled(3, 200), DOCS)
    assert language.fit(docs, rows_per_language=5).languages == sorted(STEMS)


def mixed_quality(seed, count):
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(count):
        good = rng.random() < 0.8
        if good:
            text = "\n".join(sentence("en", rng, rng.randrange(8, 25)).capitalize() for _ in range(rng.randrange(3, 9)))
        else:
            text = rng.choice(["BUY NOW!!! ", "### @@ $$ %% ^^ ", "home | login | about | "]) * rng.randrange(8, 40)
        rows.append((i, text))
        truth[i] = good
    return rows, truth


def test_quality_finds_junk(spark):
    rows, truth = mixed_quality(5, 500)
    out = quality.classify(documents(spark, rows)).collect()
    assert len(out) == 500
    assert sum(r["keep"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    accuracy = np.array([0.9, 0.8, 0.75, 0.85, 0.95])
    votes = np.where(rng.random((len(good), 5)) < accuracy, 1, -1) * np.where(good, 1, -1)[:, None]
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, table, posterior = quality.fit_accuracies(patterns, counts)
    assert abs(share - 0.7) < 0.03
    assert np.abs(table[:, 1, 1] - accuracy).max() < 0.05
    assert ((posterior >= 0) & (posterior <= 1)).all()


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "only one text here.")]])
def test_quality_small_tables(spark, rows):
    out = quality.classify(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    assert all(not r["keep"] and r["quality_score"] == 0 for r in out if r["doc_id"] == 2 or rows[0][1] is None)


def test_quality_odd_rows(spark):
    rows, _ = mixed_quality(6, 200)
    rows += [(None, "a good sentence is here and the other is there."), (3, None), (3, ""), (1000, "word " * 200_000), (1000, "word " * 200_000)]
    docs = documents(spark, rows).selectExpr("*", "1 as quality_score", "2 as keep", "3 as posterior", "4 as pattern")
    assert quality.classify(docs).count() == len(rows)
    kept = quality.kept(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    scored = quality.score(docs, quality.fit(docs)[0])
    assert scored.columns.count("quality_score") == 1


def test_votes_equal_the_plain_ones():
    texts = [t for _, t in mixed_quality(8, 200)[0]] + ["a b", "x", "\n\n", "The the THE the of a.", "é | ü\n" * 9, "word " * 70]
    assert quality.labeller_votes(texts).tolist() == [plain.votes(t) for t in texts]


def test_quality_equals_the_plain_version(spark):
    rows, _ = mixed_quality(7, 110)
    rows += [(1000, None), (1001, ""), (1002, rows[0][1])]
    want = dict(zip([i for i, _ in rows], plain.quality_scores([t for _, t in rows])))
    got = {r["doc_id"]: (r["quality_score"], r["keep"]) for r in quality.classify(documents(spark, rows)).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i][0] - want[i]) for i in want) < 0.01
    assert all(got[i][1] == (want[i] >= 0.3) for i in want if abs(want[i] - 0.3) > 0.01)
    judged = {r["doc_id"]: r["posterior"] for r in quality.fit(documents(spark, rows))[1].collect()}
    known = [(i, t) for i, t in rows if t]
    assert max(abs(judged[i] - p) for (i, _), p in zip(known, plain.posteriors([plain.votes(t) for _, t in known]))) < 1e-6


def test_language_equals_the_plain_version(spark):
    rows = labelled(9, 90)
    model = language.fit(spark.createDataFrame(rows, DOCS))
    ordered = spark.createDataFrame(rows, DOCS).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    identify = plain.language_model([r["text"] for r in ordered], [r["lang"] for r in ordered])
    texts = [(i, t) for i, t, *_ in labelled(10, 60)] + [(1000, None), (1001, "12 !"), (1002, "zzzz qqqq xxxx")]
    for r in language.tag(documents(spark, texts), model).collect():
        found, sure = identify(r["text"])
        assert abs(r["confidence"] - sure) < 1e-3
        assert r["language"] == found or abs(sure - model.least) < 1e-3

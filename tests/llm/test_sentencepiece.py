import os
import random
import time

import pytest
import sentencepiece

from filigree.llm import sentencepiece_codec as codec
from helpers import documents

pytestmark = pytest.mark.skipif(not os.path.exists(codec.DEFAULT_MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=codec.DEFAULT_MODEL)


TEXTS = ["", " ", "   ", "Hello world", " leading", "trailing ", "two  blanks", "tab\tand\nnewline", "naïve ñandú 中文 🎉🎊", "a" * 700, "▁ mark", "\x00 nul", "ab́c", "<s> </s> <unk>", "1234567890" * 20]


def test_ids_equal_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in codec.encode(documents(spark, rows)).collect()}
    for i, t in rows:
        assert got[i]["ids"] == library.encode(t), t
        assert got[i]["n_ids"] == len(library.encode(t))
        assert got[i]["round_trip"] == ("▁" not in t), t


def test_random_texts_equal_the_library(library):
    rng = random.Random(4)
    alphabet = "abcdefghijklmnop     .,é中\n▁🎉"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    ids, offsets = codec.vocabulary(codec.DEFAULT_MODEL).encode_batch(texts, check=True)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == library.encode(texts)


def test_long_words_equal_the_library(library, monkeypatch):
    rng = random.Random(6)
    v = codec.vocabulary(codec.DEFAULT_MODEL)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["".join(rng.choice(a) for _ in range(n)) for a in (base64, "ab", "中文字符 ", "é🎉x", "=") for n in (300, 3000)]
    words += ["a" * 1001, "internationalization" * 40, "🎊" * 400]
    for long in (codec.LONG, 0, 10**9):  # by heaps where long, all by heaps, none
        monkeypatch.setattr(codec, "LONG", long)
        ids, offsets = codec.MergeVocabulary(codec.DEFAULT_MODEL).encode_batch(words, check=True)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == library.encode(words)
    monkeypatch.undo()
    text = "".join(rng.choice(base64) for _ in range(1_000_000))
    began = time.process_time()
    ids, _ = v.encode_batch([text], check=True)
    assert time.process_time() - began < 60
    assert ids.tolist() == library.encode(text)


def test_a_vocabulary_that_does_not_split_at_blanks_is_refused():
    def message(*fields):
        return b"".join(bytes([n << 3 | 2, len(v)]) + v if isinstance(v, bytes) else bytes([n << 3, v]) for n, v in fields)

    good = {1: message((1, b"a")), 2: message((3, 2)), 3: message((1, b"identity"), (4, 0))}
    codec._verify(message(*good.items()))
    suffix = message((3, 2)) + bytes([24 << 3 & 127 | 128, 24 << 3 >> 7, 1])
    for part, value in ((1, message((1, b"a b"), (3, 4))), (2, message((3, 1))), (2, suffix), (3, message((4, 1))), (3, message((2, b"x"), (4, 0))), (3, message((3, 0), (4, 0)))):
        with pytest.raises(ValueError):
            codec._verify(message(*(good | {part: value}).items()))


def test_long_text_round_trip(spark):
    text = "the quick brown fox " * 60_000
    row = codec.encode(documents(spark, [(1, text)])).collect()[0]
    assert row["round_trip"] and row["n_ids"] > 100_000


def test_nulls_repeats_and_decode(spark):
    docs = documents(spark, [(1, None), (None, "x y"), (2, "x y"), (2, "x y"), (3, "")])
    out = codec.encode(docs)
    rows = out.collect()
    assert len(rows) == 5
    null = next(r for r in rows if r["text"] is None)
    assert (null["ids"], null["n_ids"], null["round_trip"]) == (None, 0, None)
    assert next(r for r in rows if r["text"] == "")["ids"] == []
    for r in codec.decode(out).collect():
        assert r["decoded"] == r["text"]


def test_empty_table_and_clashing_names(spark):
    docs = documents(spark, [])
    assert codec.encode(docs).collect() == []
    clash = documents(spark, [(1, "a b")]).selectExpr("*", "'old' as ids", "1.5 as N_IDS")
    out = codec.encode(clash)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_ids", "round_trip"]
    row = out.collect()[0]
    assert row["n_ids"] == len(row["ids"]) == 2
    assert codec.decode(out.selectExpr("*", "1 as decoded")).collect()[0]["decoded"] == "a b"

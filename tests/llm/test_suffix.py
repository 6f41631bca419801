import random

import numpy as np

from filigree.llm import suffix_dedup as s
from helpers import documents, words


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for size, kinds in ((1, 1), (2, 1), (30, 2), (200, 3), (500, 40)):
        v = np.append(rng.integers(1, kinds + 1, size), 0)
        order = s.suffix_array(v)
        plain = v.tolist()
        assert order.tolist() == sorted(range(len(v)), key=lambda i: plain[i:])
        lcp = s.common_prefixes(v, order)
        for k in range(1, len(v)):
            a, b = plain[order[k - 1] :], plain[order[k] :]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute(rows, length):
    seen, out = set(), {}
    for i, text in sorted((i, t) for i, t in rows if i is not None and t):
        w = words(text, lower=False)
        marks = set()
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            if key in seen:
                marks.update(range(p, p + length))
            seen.add(key)
        if marks:
            ordered = sorted(marks)
            starts = [p for p in ordered if p - 1 not in marks]
            out[i] = (starts, [p + 1 for p in ordered if p + 1 not in marks], len(marks))
    return out


def found(df):
    return {r["doc_id"]: (r["starts"], r["ends"], r["removed_words"]) for r in df.collect()}


def passages(seed, count=60):
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(4, 15))) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(12))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared))
        if rng.random() < 0.3:
            parts.append(rng.choice(shared))
        rows.append((i, ". ".join(parts)))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    for seed, shard in ((1, 12_000_000), (2, 400), (3, 60)):
        monkeypatch.setattr(s, "_SHARD", shard)
        rows = passages(seed)
        assert found(s.repeats(documents(spark, rows).repartition(5), 5)) == brute(rows, 5)


def test_cut_leaves_the_first_occurrence(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"Start. {passage}. End one."), (2, f"Other, {passage}! Tail."), (3, passage), (4, None), (5, ""), (None, passage), (6, "short")]
    out = {r["doc_id"]: r for r in s.without_repeats(documents(spark, rows)).collect()}
    assert out[1]["text"] == rows[0][1]
    assert out[2]["text"] == "Other, Tail." and out[2]["n_chars"] == len("Other, Tail.")
    assert 3 not in out
    assert out[4]["text"] is None and out[5]["text"] == "" and out[None]["text"] == passage and out[6]["text"] == "short"


def test_repeated_rows_and_rows_of_one_id(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, passage), (1, passage), (2, passage + " more"), (2, "few words"), (2, "")]
    out = sorted((r["doc_id"], r["text"]) for r in s.without_repeats(documents(spark, rows)).collect())
    assert out == [(1, passage), (1, passage), (2, ""), (2, "few words"), (2, "more")]


def test_repeat_within_a_document_and_overlap(spark):
    text = " ".join(["x"] * 200)
    assert found(s.repeats(documents(spark, [(9, text)]))) == {9: ([1], [200], 199)}


def test_empty_table_and_extra_columns(spark):
    assert s.repeats(documents(spark, [])).collect() == []
    docs = documents(spark, [(1, "a b"), (2, "a b")]).selectExpr("*", "1 as starts", "2 as ends", "3 as zone")
    out = s.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 2


def test_very_long_texts(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    long = " ".join(word() for _ in range(450_000))  # more than a shard holds
    rows = [(1, f"{long} {passage}"), (2, f"{passage} {word()}"), (3, " ".join(word() for _ in range(300_000)) + f" {passage} {word()}")]
    got = {r["doc_id"]: (r["starts"], r["ends"]) for r in s.repeats(documents(spark, rows)).collect()}
    assert got == {2: ([0], [60]), 3: ([300_000], [300_060])}

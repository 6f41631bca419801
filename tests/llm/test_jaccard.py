import itertools
import random

from filigree.llm import jaccard_join as j
from helpers import documents, gram_set


def brute(rows, n, threshold):
    """(doc_id, class_id, n_links) of linked documents, sorted."""
    docs = sorted({(i, gram_set(t, n)) for i, t in rows if i is not None and t and gram_set(t, n)}, key=lambda d: d[0])
    links, parent = [0] * len(docs), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, (_, s)), (b, (_, t)) in itertools.combinations(enumerate(docs), 2):
        if len(s & t) >= threshold * len(s | t) - 1e-9:
            links[a] += 1
            links[b] += 1
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return sorted((docs[k][0], docs[root(k)][0], links[k]) for k in range(len(docs)) if links[k])


def found(spark, rows, n, threshold):
    return sorted(tuple(r) for r in j.document_links(documents(spark, rows), n, threshold).collect())


def near_rows(seed, count=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [rng.choice(vocabulary) for _ in range(30)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, 50))] for _ in range(25)]
    rows = []
    for i in range(count):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if i % 4 == 0:
            w += shared
        rows.append((i, " ".join(w)))
    return rows


def test_equals_brute_force(spark):
    for seed, n, threshold in ((1, 3, 0.5), (2, 2, 0.7), (3, 1, 0.8)):
        rows = near_rows(seed)
        assert found(spark, rows, n, threshold) == brute(rows, n, threshold)


def test_hot_ngrams_and_cut_groups(spark, monkeypatch):
    monkeypatch.setattr(j, "HOT_POSTINGS", 3)
    monkeypatch.setattr(j, "_OPEN", 50)
    monkeypatch.setattr(j, "_RANGE", 100)
    monkeypatch.setattr(j, "HOT_SHARE", 0.02)
    monkeypatch.setattr(j, "BROADCAST_ROWS", 1)
    rows = near_rows(4)
    rows += [(1000 + i, rows[3][1]) for i in range(40)]
    assert found(spark, rows, 3, 0.5) == brute(rows, 3, 0.5)


def test_nulls_empties_ties_and_repeated_rows(spark):
    rows = [(1, None), (None, "a b c d"), (2, ""), (3, "..."), (4, "a b c d"), (5, "A, b. c d!"), (5, "A, b. c d!"), (6, "one"), (7, "one"), (8, "one two"), (9, "x " * 3000), (10, "x " * 3001)]
    assert found(spark, rows, 3, 0.5) == brute(rows, 3, 0.5)
    kept = {r["doc_id"] for r in j.unique(documents(spark, rows)).collect()}
    assert kept == {1, None, 2, 3, 4, 6, 8, 9}


def test_an_id_of_several_texts(spark):
    rows = [(1, "a b c d"), (1, "p q r s"), (2, "a b c d"), (3, "p q r s"), (3, "p q r s"), (4, "x y z")]
    assert found(spark, rows, 3, 0.5) == brute(rows, 3, 0.5) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_very_long_text(spark):
    rng = random.Random(9)
    text = [rng.choice("abcdefgh") * rng.randrange(1, 6) for _ in range(150_000)]
    rows = [(1, " ".join(text)), (2, " ".join(text[:140_000])), (3, " ".join(text[:20]))]
    assert found(spark, rows, 3, 0.5) == brute(rows, 3, 0.5)


def test_string_ids(spark):
    docs = documents(spark, [(1, "a b c d"), (2, "a b c d"), (3, "x")]).selectExpr("concat('k', doc_id) as doc_id", "text")
    assert sorted(tuple(r) for r in j.document_links(docs).collect()) == [("k1", "k1", 1), ("k2", "k1", 1)]


def test_empty_table_and_extra_columns(spark):
    assert j.document_links(documents(spark, [])).collect() == []
    docs = documents(spark, [(1, "a b c d"), (2, "a b c d")]).selectExpr("*", "1 as sig", "2 as size", "3 as q", "4 as __gone2", "5 as class_id", "6 as n_links")
    assert [r["doc_id"] for r in j.unique(docs).collect()] == [1]
    assert j.unique(docs).columns == docs.columns
    assert sorted(tuple(r) for r in j.document_links(docs).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_unique_keeps_the_smallest_id_of_each_class(spark):
    rows = near_rows(7)
    gone = {i for i, c, _ in brute(rows, 3, 0.5) if i != c}
    assert gone
    assert {r["doc_id"] for r in j.unique(documents(spark, rows)).collect()} == {i for i, _ in rows} - gone


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    rows = j.components(edges).collect()
    assert {(r["node"], r["root"]) for r in rows} == {(i, 0) for i in range(1, 201)}

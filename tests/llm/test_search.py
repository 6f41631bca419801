import math
import random

import numpy as np
import pytest

from filigree.llm import exact_search, permutation_index


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, k, every=1):
    clean = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = tuple(float(np.float32(x)) for x in v)
            clean[i] = min(clean.get(i, v), v)
    out = {}
    for i, v in clean.items():
        if i % every:
            continue
        near = sorted((math.dist(v, w), j) for j, w in clean.items() if j != i and len(w) == len(v))
        out[i] = [j for _, j in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["vec_id"], r["rank"])):
        out.setdefault(r["vec_id"], []).append(r["neighbor_id"])
    return out


def clusters(seed, count, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (8, dims))
    return [(i, (centres[i % 8] + rng.normal(0, 1, dims)).astype(np.float32).tolist()) for i in range(count)]


@pytest.mark.parametrize("every", [1, 50])
def test_exact_equals_brute_force(spark, monkeypatch, every):
    monkeypatch.setattr(exact_search, "QUERY_BYTES", 12 * 8 * 100)
    rows = clusters(1, 300)
    assert found(exact_search.top_k(table(spark, rows), 7, every=every)) == brute(rows, 7, every)


def test_footrule():
    rng = np.random.default_rng(8)
    x, pivots = rng.normal(size=(40, 6)), rng.normal(size=(15, 6))
    for prefix in (4, 15):
        order = permutations_by_sorting(x, pivots, prefix)
        assert permutation_index.permutations(x, pivots, prefix).tolist() == order
        files = permutation_index.inverted(np.array(order), 15)
        place = [{p: i for i, p in enumerate(o)} for o in order]
        for q in range(40):
            want = [sum(abs(i - place[v].get(p, prefix)) for i, p in enumerate(order[q])) for v in range(40)]
            assert permutation_index.footrule(np.array(order[q]), files, 40).tolist() == want


def permutations_by_sorting(x, pivots, prefix):
    return [sorted(range(len(pivots)), key=lambda p: (math.dist(v, pivots[p]), p))[:prefix] for v in x]


def test_index_in_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "SHARD_BYTES", 12 * 8 * 90)
    monkeypatch.setattr(exact_search, "QUERY_BYTES", 12 * 8 * 100)
    rows = clusters(1, 400)
    got = found(permutation_index.search(table(spark, rows), 7, every=1))
    assert got == brute(rows, 7)  # of so few vectors all are reranked
    some = found(permutation_index.search(table(spark, rows), 7, every=10, share=0.3, least=10))
    want = brute(rows, 7, 10)
    assert some.keys() == want.keys() and all(len(v) == 7 for v in some.values())
    assert sum(len(set(want[i]) & set(some[i])) for i in want) >= 0.8 * sum(map(len, want.values()))


def test_lower_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(20, 13)), rng.normal(size=(30, 13))
    true = exact_search.squared(x, y)
    for s in exact_search.SEGMENTS:
        assert (exact_search.squared(exact_search.statistics(x, s), exact_search.statistics(y, s)) <= true + 1e-9).all()


ODD = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (5, None), (6, []), (7, [float("nan"), 1.0]), (8, [None, 1.0]), (None, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [1.0, 2.0, 4.0]), (11, [5.0])]


@pytest.mark.parametrize("search", [exact_search.top_k, permutation_index.search])
def test_nulls_ties_dimensions_and_repeats(spark, search):
    got = found(search(table(spark, ODD).selectExpr("*", "1 as id", "2 as d", "3 as v"), 3, every=1))
    assert got == {i: v for i, v in brute(ODD, 3).items() if v}


@pytest.mark.parametrize("search", [exact_search.top_k, permutation_index.search])
def test_empty_table(spark, search):
    assert search(table(spark, [])).collect() == []


def test_recall_of_the_permutation_index(spark):
    rng = random.Random(3)
    plain = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(5000)]
    for rows in (clusters(2, 5000, 24), plain):
        want = brute(rows, 10, 50)
        got = found(permutation_index.search(table(spark, rows)))
        assert sum(len(set(want[i]) & set(got.get(i, []))) for i in want) >= 0.9 * sum(map(len, want.values()))


def test_rare_dimensions_have_pivots(spark):
    rows = clusters(6, 1500) + [(5000 + i, v[:5]) for i, v in clusters(7, 12)]
    got = found(permutation_index.search(table(spark, rows), 5, every=1))
    want = brute(rows, 5)
    assert {i: got.get(i) for i in want if i >= 5000} == {i: want[i] for i in want if i >= 5000}

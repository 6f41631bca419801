import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filigree.llm import mixing as m
from helpers import DOCS


def water(budget, children):
    """Shares by raising a level until the budget is spent; exact up to whole tokens."""
    open_, out = {c[0]: c for c in children if c[1] > 0}, {c[0]: 0.0 for c in children}
    left = budget
    while open_ and left > 1e-9:
        weight = sum(c[1] for c in open_.values())
        level = min([left / weight, *((c[2] - out[n]) / c[1] for n, c in open_.items())])
        for n, c in open_.items():
            out[n] += level * c[1]
        left -= level * weight
        open_ = {n: c for n, c in open_.items() if out[n] < c[2] - 1e-9}
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 1000), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 300)), max_size=6))
def test_split_equals_water_filling(budget, kids):
    children = [(str(i), w, c) for i, (w, c) in enumerate(kids)]
    got, want = m.split_budget(budget, children), water(budget, children)
    for name, _, capacity in children:
        assert got[name] <= capacity and abs(got[name] - want[name]) <= 1.01


def test_shortage_goes_to_siblings_before_ancestors():
    tokens = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000}
    out = m.tree_budgets(tokens, {}, 1000, 1)
    assert out == {("a", "x"): 10, ("a", "y"): 490, ("b", "x"): 500}
    out = m.tree_budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 1000}, {}, 500, 1)
    assert out == {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 470}


def brute(rows, weights, share, max_epochs, seed):
    n = lambda t: len(re.findall(r"[^ \t\n\r]+", t or ""))
    leaves = defaultdict(list)
    for r in rows:
        if n(r[1]):
            number = re.search(r"([0-9]+)$", r[3] or "")
            leaves[f"dom{int(number[1]) % 4}" if number else "other", r[2] or "", r[3] or ""].append((r[0], n(r[1])))
    totals = {k: sum(x for _, x in v) for k, v in leaves.items()}
    budgets = m.tree_budgets(totals, weights, sum(totals.values()) * share[0] // share[1], max_epochs)
    out = defaultdict(int)
    for leaf, docs in leaves.items():
        left = budgets[leaf]
        for epoch in range(1, max_epochs + 1):
            ordered = sorted((hashlib.md5(f"{seed}:{epoch}:{'' if i is None else i}".encode()).hexdigest(), i, x) for i, x in docs)
            for key in dict.fromkeys(k for k, _, _ in ordered):
                same = [(i, x) for k, i, x in ordered if k == key]
                size = sum(x for _, x in same)
                if size > left:
                    left = -1
                    break
                left -= size
                for i, _ in same:
                    out[i] += 1
            if left < 0:
                break
    return dict(out)


ROWS = [(i, "tok " * (1 + i * 7 % 23), ["en", "fr", None][i % 3], ["web-1", "web-2", "news", None, "books-7"][i % 5], 1) for i in range(120)]


@pytest.mark.parametrize("share", [(3, 4), (1, 10), (7, 4), (5, 1), (0, 1)])
def test_equals_brute_force(spark, share):
    rows = ROWS + [(500, None, "en", "web-1", 0), (501, "", "en", "web-1", 0), (502, " \n", "en", "web-1", 0), (7, ROWS[7][1], ROWS[7][2], ROWS[7][3], 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as epoch", "2 as edge", "3 as domain", "4 as times")
    out = m.mix(docs, m.document_tree(), m.WEIGHTS, share)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += 1
    assert dict(got) == brute(rows, m.WEIGHTS, share, 2, 17)


def test_empty_table_null_ids_and_long_text(spark):
    docs = spark.createDataFrame([], DOCS)
    assert m.mix(docs, m.document_tree(), m.WEIGHTS).collect() == []
    assert m.mixed_documents(docs).collect() == []
    rows = [(None, "a b", "en", "web-1", 1), (None, "a b", "en", "web-1", 1), (1, "w " * 300_000, "en", "web-1", 1)]
    out = m.mix(spark.createDataFrame(rows, DOCS), m.document_tree(), m.WEIGHTS, (1, 1)).collect()
    assert len(out) == 3

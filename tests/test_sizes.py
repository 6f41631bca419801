"""What shows only in larger tables than the smallest ones, or in odd ones."""

import datetime
import random

import duckdb

import pytest

from filigree import data, queries
from filigree.operators import country, derived, submission
from filigree.sources import instance
from test_queries import SF, norm


def same_as_sql(spark, name, folder):
    con = duckdb.connect()
    for f in folder.iterdir():
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}{'/*.parquet' if f.is_dir() else ''}')")
    df = queries.QUERIES[name](spark, str(folder))
    cursor = con.execute(queries.ORACLES[name])
    place = {c[0]: i for i, c in enumerate(cursor.description)}
    want = sorted((tuple(norm(r[place[c]]) for c in df.columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr) == want
    return want


def test_upsert_of_orders_that_share_an_accession_number(spark, tmp_path):
    day = datetime.datetime(1995, 3, 4)
    rows = [(k, c, "O", 1.5, day, "1-URGENT") for k, c in ((4, 7), (1_000_004, 7), (2_000_004, 7), (5, 8), (1_000_005, 8), (6, 9))]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    assert len(same_as_sql(spark, "upsert_merge", tmp_path)) > 3


@pytest.mark.parametrize("name", ["instance_parse", "voting_rights", "relative_votes", "table_grid", "text_to_country_top1"])
def test_costly_rows_of_a_small_file_are_spread(spark, name):
    assert "REPARTITION_BY_NUM" in queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_small_instances_read_together_give_what_each_gives_alone():
    good = b"<x xmlns:g='g'><g:A contextRef='c'>1</g:A></x>"
    raws = [good, None, b"", good, b"<x>", b"</x>", good, b"<x></x><y></y>", b"</r><r>", b"<mark></mark>", b"<?xml version='1.0'?>" + good, b"<x>&nbsp;</x>", b"<x/>&#32;<!-- --><y></y>", good] * 7
    got = [[dict(zip(instance.FACTS, r)) for r in rows] for rows in instance.parse_instances(raws)]
    assert len(got) == len(raws)
    for raw, rows in zip(raws, got):
        alone = instance.parse_instance(raw)
        assert [r["error"] for r in rows] == [r["error"] for r in alone] and [r["value"] for r in rows] == [r.get("value") for r in alone]
    assert [r["value"] for r in got[3]] == ["1"]


def test_votes_read_each_text_once_and_meet_once(spark):
    texts = spark.createDataFrame([(1, 0, "Nothing."), (1, 1, "Class A common stock has two votes per share. Each share of Class B common stock has one-half of the votes of a share of Class A common stock. Class A common stock has three votes per share."), (1, 2, "Class C common stock has nine votes per share."), (2, 0, "Each share of Class B common stock has one-half of the votes of a share of Class A common stock.")], "cik int, source_rank int, text string")
    found = derived.voting_rights(texts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Initial Plan")[-1]
    assert first.count("ArrowEvalPython") == 1 and first.count("Exchange hashpartitioning") == 1
    assert sorted((r["cik"], r["class_label"], r["votes_per_share"], r["confidence"]) for r in found.collect()) == [(1, "Class A", 2.0, "review"), (1, "Class B", 1.0, "high")]


def test_plain_markup_needs_no_library_parser_and_gives_the_same(monkeypatch):
    plain = "<h2>Net sales</h2><table><tr><th>a<th COLSPAN='2'>b</th><tr><td rowspan=2> 1 > 0\n</td><td>2</td><td> </td></tr><TR><td>3</TABLE> after"
    odd = [plain.replace("2</td>", x) for x in ("2&amp;</td>", "2<br/></td>", "2<!-- <td> --></td>", "<script><td></script>", "2</td x>", "2 < 3</td>")]
    fast = [submission.parse_tables(plain)]
    assert submission._tokens(plain) and not any(map(submission._tokens, odd))
    monkeypatch.setattr(submission, "_tokens", lambda markup: None)
    assert fast == [submission.parse_tables(plain)] and fast[0][0][3][1:] == [["1 > 0", "2", None], ["1 > 0", "3", None]]


def test_countries_of_random_word_lists_by_plain_search(spark):
    names, aliases = data.place_names(), {data.plain(t): c for t, c in data.pairs("alias")}
    rnd = random.Random(5)
    words = sorted({w for n, _, _ in names for w in n.split()})
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 4)) + rnd.choices(["x", rnd.choice(names)[0], "", "New", "of"], k=rnd.randint(0, 4))) for _ in range(1500)]
    texts += [n for n, _, _ in names] + [f"{a[0]} {b[0]}" for a, b in zip(names, names[1:])] + ["", "  ", "guineax", "a-guinea.bissau"]
    got = country.text_to_country(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", "c")
    # the list of names is searched in the pattern, not name by name
    assert "filter(" not in got._jdf.queryExecution().executedPlan().toString()
    want = {}
    for i, t in enumerate(texts):
        p = data.plain(t)
        want[i] = aliases.get(p) or next((c for n, c, _ in names if f" {n} " in f" {p} "), None)
    assert {r["i"]: r["c"] for r in got.collect()} == want

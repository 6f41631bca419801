import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filigree import data
from filigree.functions import ratio, text as tx
from filigree.sources import landing


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    assert values(spark, tx.clean_text, ["a  b​", " ", None, "x\n\ty"]) == ["a b", None, None, "x y"]


def test_to_float(spark):
    got = values(spark, tx.to_float, ["1,000", " 2.5 ", "1d", "inf", "nan", "1_0", "", None, "-3e2", "."])
    assert got == [1000.0, 2.5, None, None, None, None, None, None, -300.0, None]


def test_security_type_and_label(spark):
    titles = ["Common Stock", "4% Notes due 2030", "Warrants", "Depositary Shares", "Rights", "Note shares", None]
    assert values(spark, lambda c: tx.security_type(F.lit(None), c), titles) == ["equity", "debt", "warrant", "equity", "other", "debt", "other"]
    assert values(spark, tx.class_label, ["Common Stock", "Ordinary Shares", "Capital Stock", "Preferred", "Units", None]) == ["CommonStock", "OrdinaryShares", "CapitalStock", "PreferredStock", None, None]
    assert values(spark, tx.member_label, ["us-gaap:CommonClassAMember", "x", None]) == ["CommonClassA", "x", None]


def test_markup(spark):
    page = '<p>Net <ix:nonFraction name="a">5</ix:nonFraction> <!-- c --></p><ix:header>gone</ix:header><script>x()</script>  <div>B&amp;C<br>next</div>'
    assert values(spark, tx.html_clean, [page]) == ["<p>Net 5 </p> <div>B&amp;C<br>next</div>"]
    assert values(spark, lambda c: tx.html_text(tx.html_clean(c)), [page, "", None]) == ["Net 5\nB&C\nnext", "", None]
    assert values(spark, lambda c: tx.html_clean(c, True), ['<p style="x">a</p><style>b</style>']) == ["<p>a</p>"]


def test_sentences(spark):
    assert values(spark, tx.sentences, ["One. Two! three? \"Four\"\n five; (six)", "", None]) == [["One.", "Two! three?", '"Four"', "five;", "(six)"], [], None]


def test_places(spark):
    got = values(spark, tx.places, ["sold in the United States and China", "assets support these processes", None])
    assert got == [["the United States", "China"], ["ROC"], []]
    assert values(spark, lambda c: tx.places(c, word_boundary=True), ["assets support these processes", "in the U.K."]) == [[], ["U.K."]]


def test_categories(spark):
    got = values(spark, tx.matched_categories, ["Net sales by product line", "nothing"])
    assert got[0]["revenue"] == ["net sales", "sales by"] and got[0]["product"] == ["by product", "product line", "product"] and got[1] == {}


def test_names(spark):
    df = spark.createDataFrame([("Germany", "Federal Republic of Germany"), ("Virginia", "West Virginia"), ("Virgin Islands, British", "British Virgin Islands"), (None, "x"), ("Delaware", "Nevada")], "a string, b string")
    a, b = tx.normal_name(F.col("a")), tx.normal_name(F.col("b"))
    assert [tuple(r) for r in df.select(tx.same_name(a, b), tx.same_name(a, b, True)).collect()] == [(True, True), (True, False), (True, True), (False, False), (False, False)]


def test_segment_is_sorted(spark):
    df = spark.sql("select map('b:Y', 'n', 'a:X', 'm') as v union all select map()")
    assert sorted(r[0] for r in df.select(tx.segment_string(F.col("v"))).collect()) == ["", "a:X=m; b:Y=n"]


def test_quarters(spark):
    df = spark.createDataFrame([(datetime.date(2024, 12, 31), datetime.date(2025, 4, 1))], "a date, b date")
    row = df.select(landing.quarter_label(F.col("a")), landing.quarters(F.col("a"), F.col("b")), landing.index_url(F.col("b"))).collect()[0]
    assert row[0] == "2024-QTR4" and row[1] == [datetime.date(2024, 10, 1), datetime.date(2025, 1, 1), datetime.date(2025, 4, 1)]
    assert row[2].endswith("/daily-index/2025/QTR2/master.20250401.idx")


def test_slug(spark):
    df = spark.sql("select 'A/B c' as a, '' as b, cast(null as string) as c")
    assert df.select(tx.slug(F.col("a"), F.col("b")), tx.slug(F.col("b"), F.col("c"))).collect()[0][:] == ("A_B_c", "filing")


def test_dimension_tables():
    assert len(data.codes()) == 309 and len(data.industries()) == 173 and len(data.sic_ranges()) == 78
    assert [len({r[i] for r in data.industries()}) for i in (0, 2, 4, 6)] == [11, 20, 45, 173]
    assert len(data.pairs("collision")) == 23 and len(data.pairs("alias")) == 17


QUANTITIES = [("2", 2), ("0.5", 0.5), ("two (2)", 2), ("one-half", 0.5), ("one half of one", 0.5), ("ten", 10), ("1/2", 0.5), ("twenty-five (25)", 25), ("three-quarters", 0.75), ("two hundred", 102), ("2,5", 25), ("one (3)", 3), ("the right to receive two", 2), ("many", None), ("", None), (None, None)]


@pytest.mark.parametrize("phrase,want", QUANTITIES)
def test_quantity(phrase, want):
    assert ratio.quantity(phrase) == want


TITLES = [
    ("American Depositary Shares, each representing two (2) ordinary shares", (2.0, "ordinary shares")),
    ("American depositary shares, each representing one-half of one ordinary share", (0.5, None)),
    ("American Depositary Shares, each representing one-tenth of an equity share", (0.1, None)),
    ("American Depositary Shares representing 0.25 shares of Common Stock", (0.25, "common stock")),
    ("American Depositary Shares", None),
]


@pytest.mark.parametrize("title,want", TITLES)
def test_title_ratio(title, want):
    got = ratio.ratio(title)
    assert (got and got[0]) == (want and want[0])
    if want and want[1]:
        assert got[1] == want[1]


def test_prose_ratio():
    assert ratio.ratio("Each ADS represents five equity shares.", prose=True)[:2] == (5.0, "equity shares")
    assert ratio.ratio("percentage of shares held by each individual that ADS represents 5% shares", prose=True) is None
    assert ratio.ratio("4 ADSs represent 1 share", prose=True)[0] == 0.25
    long = "American depositary shares " + "x " * 400 + "each ADS represents two ordinary shares"
    assert any("two ordinary shares" in s for s in ratio.ratio_sentences(long))


def test_votes():
    got = ratio.votes("Our Class B common stock has ten votes per share and our Class A common stock has one vote per share.")
    assert [(c, n) for c, n, _, _ in got] == [("Class B", 10.0), ("Class A", 1.0)]
    assert ratio.votes("Holders have one vote for each share of Common Stock.")[0][:2] == ("Common Stock", 1.0)
    assert ratio.votes("The Class C capital stock has no voting rights.")[0][:2] == ("Class C", 0.0)
    assert ratio.votes("Each share of Class B Common Stock has 1/10,000 of the voting rights of a share of Class A Common Stock.")[0][:3] == ("Class B", 1 / 10000, "Class A")
    assert ratio.votes(None) == [] and ratio.votes("") == []


@given(st.text(max_size=200))
def test_parsers_take_any_text(text):
    ratio.quantity(text), ratio.ratio(text), ratio.ratio(text, True), ratio.votes(text), ratio.ratio_sentences(text), ratio.business_description(text, "10-K")


def test_business_description():
    text = "Item 1. Business 5\nItem 1A. Risk 9\nItem 1. Business\n" + "We make things. " * 60 + "\nItem 1A. Risk Factors"
    assert ratio.business_description(text, "10-K").startswith("We make things.")
    assert ratio.business_description("Item 1. Business " + "y" * 9000, "10-K") == "y" * 3999
    assert ratio.business_description(None, "10-K") is None

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from filigree.operators import country, derived, facts, idioms, ledger, manifest, submission
from filigree.sources import landing
from filigree.sources.instance import parse_instance


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


XML = b"""<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:d="http://xbrl.sec.gov/dei/2024" xmlns:g="http://fasb.org/us-gaap/2024">
<context id="c0"><entity><identifier scheme="s">0000000123</identifier></entity><period><startDate>2024-01-01</startDate><endDate>2024-12-31</endDate></period></context>
<context id="cA"><entity><identifier scheme="s">0000000123</identifier><segment><xbrldi:explicitMember dimension="us-gaap:StatementClassOfStockAxis">us-gaap:CommonClassAMember</xbrldi:explicitMember></segment></entity><period><instant>2025-01-31</instant></period></context>
<unit id="u1"><measure>iso4217:USD</measure></unit><unit id="u2"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit><unit id="u3"><measure>shares</measure></unit>
<d:EntityRegistrantName contextRef="c0">Example Corp</d:EntityRegistrantName>
<d:Security12bTitle contextRef="cA">Class A Common Stock</d:Security12bTitle>
<d:TradingSymbol contextRef="cA">EXA</d:TradingSymbol>
<d:EntityCommonStockSharesOutstanding contextRef="c0" unitRef="u3">1,000</d:EntityCommonStockSharesOutstanding>
<g:Revenues contextRef="c0" unitRef="u1" decimals="-3">5000</g:Revenues>
<g:EarningsPerShareBasic contextRef="c0" unitRef="u2" xsi:nil="true"/></xbrl>"""


def test_instance_to_cover_tables(spark):
    f = landing.instances(spark.createDataFrame([("f1", XML), ("f2", b"<broken"), ("f3", None)], "filing_key string, content binary"))
    found = {r["concept"]: r for r in f.where("filing_key = 'f1'").collect()}
    assert len(found) == 6
    assert (found["EntityCommonStockSharesOutstanding"]["value_num"], found["EntityCommonStockSharesOutstanding"]["unit"]) == (1000.0, "shares")
    eps = found["EarningsPerShareBasic"]
    assert (eps["value"], eps["value_num"], eps["unit"], eps["is_nil"]) == (None, None, "USD/shares", True)
    title = found["Security12bTitle"]
    assert (title["period_type"], title["segment"], title["is_dimensioned"], title["entity_cik"]) == ("instant", "us-gaap:StatementClassOfStockAxis=us-gaap:CommonClassAMember", True, "123")
    assert f.where("filing_key = 'f2' and error is not null").count() == 1 and f.where("filing_key = 'f3'").count() == 0
    entities, securities = facts.cover_pages(f.where("error is null"))
    e = entities.collect()
    assert len(e) == 1 and (e[0]["registrant_name"], e[0]["common_shares_outstanding"]) == ("Example Corp", 1000.0)
    s = securities.collect()
    assert [(r["security_class"], r["security_type"], r["trading_symbol"], r["shares_outstanding"]) for r in s] == [("CommonClassA", "equity", "EXA", 1000.0)]


def test_instance_tolerates_entities_and_controls():
    assert parse_instance(b'<?xml version="1.0"?><a xmlns:g="g"><g:X contextRef="c">A&nbsp;&amp;\x01B</g:X></a>')[0]["value"].startswith("A&")
    assert parse_instance(b"") == [] and "error" in parse_instance(b"x")[0]


FACT = "filing_key string, ordinal int, concept string, value string, dimensions map<string,string>, namespace string"


def cover(spark, *items):
    return spark.createDataFrame([(k, i, c, v, d, "http://x/dei/2024") for i, (k, c, v, d) in enumerate(items)], FACT).withColumn("is_dimensioned", F.size("dimensions") > 0)


def test_security_variants(spark):
    axis = facts.CLASS_AXES[0]
    f = cover(
        spark,
        ("single", "Security12bTitle", "Common Stock", {}), ("single", facts.SHARES, "7", {}),
        ("otc", facts.SHARES, "9", {}),
        ("pref", "Security12bTitle", "Preferred Stock", {axis: "x:PreferredStockMember"}), ("pref", facts.SHARES, "5", {}),
        ("two", "TradingSymbol", "A", {axis: "x:CommonClassAMember"}), ("two", "TradingSymbol", "B", {axis: "x:CommonClassBMember"}), ("two", facts.SHARES, "5", {}),
        ("exchange", "Security12bTitle", "Common Stock", {"dei:EntityListingsExchangeAxis": "x:NyseMember"}),
        ("other", "TradingSymbol", "Z", {"my:Axis": "my:CommonStockMember"}), ("other", facts.SHARES, "3", {}),
        (None, "TradingSymbol", "Z", {}),
    )
    got = {}
    for r in facts.security_facts(f).collect():
        got.setdefault(r["filing_key"], []).append((r["security_class"], r["trading_symbol"], r["shares_outstanding"]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        "single": [("CommonStock", None, 7.0)],
        "otc": [("CommonStock", None, 9.0)],
        "pref": [("PreferredStock", None, None)],
        "two": [("CommonClassA", "A", None), ("CommonClassB", "B", None)],
        "exchange": [("CommonStock", None, None)],
        "other": [("CommonStock", "Z", 3.0)],
    }


INDEX = """Description: sample
CIK|Company Name|Form Type|Date Filed|File Name
--------------------------------------------------
123|Example Corp|10-K|20250402|edgar/data/123/0000000123-25-000007.txt
456|Owner Person|4|20250402|edgar/data/456/0000000123-25-000008.txt
123|Example Corp|4|20250402|edgar/data/123/0000000123-25-000008.txt
abc|Bad Cik|8-K|20250402|edgar/data/9/0000000009-25-000001.txt
789|No Accession|8-K|20250402|edgar/data/789/readme.txt"""


def test_index_lines(spark):
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(INDEX.split("\n"))], "idx_date string, line_no int, value string")
    got = rows(landing.index_lines(lines).select("accession_number", "cik", "filing_date", "ticker"), "accession_number", "cik")
    assert got == [("0000000123-25-000007", 123, "2025-04-02", ""), ("0000000123-25-000008", 123, "2025-04-02", ""), ("0000000123-25-000008", 456, "2025-04-02", "")]


def test_listing_and_tickers(spark):
    listing = spark.createDataFrame([("2025-QTR2", {"item": [{"name": n} for n in ("master.20250402.idx", "company.20250402.idx", "master.20250701.idx")]})], "quarter string, directory struct<item:array<struct<name:string>>>")
    assert rows(landing.index_files(listing, "2025-04-01", "2025-06-30")) == [("2025-04-02", "2025-QTR2", "master.20250402.idx")]
    raw = json.dumps({"0": {"cik_str": 123, "ticker": "EXA", "title": "E"}, "1": {"cik_str": 123, "ticker": "EXB", "title": "E"}})
    t = landing.ticker_rows(spark.createDataFrame([(raw,)], "value string"))
    assert rows(manifest.first_ticker(t)) == [(123, "EXA")]
    asked = spark.createDataFrame([("exb",), ("0007",), ("none",)], "query string")
    assert sorted(rows(manifest.resolve(asked, t)), key=str) == [("0007", "7"), ("exb", "123"), ("none", None)]


def test_submissions_json_and_bulk_zip(spark, tmp_path):
    doc = {"cik": "123", "name": "E", "tickers": ["EXA"], "addresses": {"business": {"street1": "1 St", "city": "X", "stateOrCountry": "DE", "stateOrCountryDescription": "", "zipCode": "1"}}, "formerNames": [{"name": "Old"}], "filings": {"recent": {"form": ["10-K", "8-K"], "accessionNumber": ["a", "b"], "filingDate": ["2025-01-01"]}}}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    s = landing.submissions(spark, str(tmp_path / "s.json"))
    p = manifest.profile(s).collect()[0]
    assert (p["cik"], p["business_address"], p["former_names"]) == (123, "1 St, X, 1", "Old")
    f = manifest.parallel_rows(s, "filings.recent", ["cik"])
    assert rows(f.select("pos", "form", "filingDate"), "pos") == [(0, "10-K", "2025-01-01"), (1, "8-K", None)]
    with zipfile.ZipFile(tmp_path / "bulk.zip", "w") as z:
        z.writestr("CIK0000000123.json", json.dumps(doc))
        z.writestr("CIK0000000123-submissions-001.json", "{}")
        z.writestr("CIK0000000009.json", "not json")
    assert rows(landing.bulk_profiles(spark, str(tmp_path / "bulk.zip")).select("cik", "name")) == [("123", "E")]


def test_links(spark):
    df = spark.createDataFrame([(123, "0000000123-25-000007", "ex-20250101.htm", True), (123, "0000000123-25-000007", "x.txt", True), (123, "0000000123-25-000007", "e.htm", False), (123, "0000000123-25-000007", "", None)], "cik long, a string, d string, i boolean")
    got = rows(df.select(manifest.instance_url(F.col("cik"), F.col("a"), F.col("d"), F.col("i")), manifest.links(F.col("cik"), F.col("a"), F.col("d"))["filing_url"]))
    assert got[0][0].endswith("/123/000000012325000007/ex-20250101_htm.xml") and [g[0] for g in got[1:]] == [None] * 3 and got[3][1] is None


SUBMISSION = """<SEC-HEADER>
CONFORMED PERIOD OF REPORT:	20241231
FILER:
	STATE OF INCORPORATION:			DE
	SEC ACT:		1934 Act
	SEC FILE NUMBER:	001-1
	BUSINESS ADDRESS:
		STREET 1:		1 MAIN ST
		CITY:			DOVER
		STATE:			DE
		ZIP:			19901
</SEC-HEADER>
<DOCUMENT>
<TYPE>EX-31.1
<SEQUENCE>2
<FILENAME>ex31.htm
<TEXT>
<html>exhibit</html>
</TEXT>
</DOCUMENT>
<DOCUMENT>
<TYPE>10-K
<SEQUENCE>1
<FILENAME>ex-20250101.htm
<DESCRIPTION>annual
<TEXT>
<XBRL><html>main</html></XBRL>
</TEXT>
</DOCUMENT>
<DOCUMENT>
<TYPE>GRAPHIC
<SEQUENCE>3
<FILENAME>pic.jpg
<TEXT>
bytes
</TEXT>
</DOCUMENT>"""


def test_submission(spark):
    df = spark.createDataFrame([("a", SUBMISSION, None), ("b", SUBMISSION, "PIC.jpg"), ("c", "", None), ("d", None, None)], "accession_number string, text string, wanted string")
    docs = submission.documents(df, keys=["accession_number", "wanted"])
    assert rows(docs.where("accession_number = 'a'").select("pos", "seq", "type", "filename", "description"), "pos") == [(0, "2", "EX-31.1", "ex31.htm", None), (1, "1", "10-K", "ex-20250101.htm", "annual"), (2, "3", "GRAPHIC", "pic.jpg", None)]
    best = submission.primary(docs, ["accession_number", "wanted"], "wanted")
    assert rows(best.select("accession_number", "filename"), "accession_number") == [("a", "ex-20250101.htm"), ("b", "pic.jpg")]
    h = submission.header_fields(df).where("accession_number = 'a'").collect()[0]
    assert (h["incorporation_code"], h["business_street_1"], h["business_city"], h["business_state"], h["business_zip"], h["mail_city"], h["n_filers"]) == ("DE", "1 MAIN ST", "DOVER", "DE", "19901", None, 1)


def test_enriched(spark):
    s = "cik long, accession_number string, report_date string, act string, file_number string, is_xbrl boolean, filing_url string, xbrl_instance_url string, primary_document string, enriched int, text string"
    df = spark.createDataFrame([(1, "0000000001-25-000001", None, None, None, None, "u", None, "", 0, SUBMISSION), (2, "x", "d", "a", "f", True, "u", "i", "p", 0, None)], s)
    one, two = submission.enriched(df).orderBy("cik").collect()
    assert (one["report_date"], one["act"], one["file_number"], one["primary_document"], one["enriched"], one["is_xbrl"]) == ("2024-12-31", "1934 Act", "001-1", "ex31.htm", 1, False)
    assert tuple(two)[2:10] == ("d", "a", "f", True, "u", "i", "p", 0)


STATEMENTS = """Substantially all of our revenue is derived from the United States.
The majority of our long-lived assets are located in China.
Net sales increased primarily due to higher volume in Europe.
A majority of our assets support these processes.
the majority of our long-lived  assets are located in china."""


def test_statements(spark):
    df = spark.createDataFrame([("a", STATEMENTS), ("b", None), ("c", "")], "accession_number string, text string")
    got = rows(submission.statements(df).select("category", "quantifier", "subject", "geographies"), "pos")
    assert got == [("revenue", "substantially all", "revenue", "the United States"), ("assets", "the majority", "long-lived assets", "China"), ("assets", "a majority", "assets", "ROC")]


def test_tables(spark):
    page = "<h2>Revenue by country</h2><table><tr><th colspan=2>Net sales</th><th></th></tr><tr><td rowspan=2>US</td><td>1</td></tr><tr><td>2<table><tr><td>inner segment</td></tr></table></td></tr><tr><td> </td></tr></table><p>x</p><table><tr><td>plain</td></tr></table>"
    df = spark.createDataFrame([("a", page), ("b", None), ("c", "<table>")], "accession_number string, html string")
    got = submission.tables(df).orderBy("table_index").collect()
    assert [r["table_index"] for r in got][:2] == [0, 1]
    assert got[0]["cells"][0] == ["Net sales", "Net sales"] and got[0]["cells"][1] == ["US", "1"] and got[0]["cells"][2][0] == "US"
    assert got[0]["caption"] == "Revenue by country" and "geographic" in got[0]["categories"]
    assert submission.tables(df, categories=["product"]).count() == 0
    with pytest.raises(ValueError):
        submission.tables(df, categories=["x"])


def test_codes(spark):
    df = spark.createDataFrame([("ca",), ("A1",), ("Z4",), ("2M",), ("",), (None,), ("!!",)], "code string")
    got = {r["code"]: (r["name"], r["kind"], r["country"]) for r in country.decoded(df, "code", "").collect()}
    assert got["ca"] == ("California", "us_state", "United States") and got["A1"][2] == "Canada" and got["Z4"][2] == "Canada" and got["2M"][2] == "Germany"
    assert got[""] == got[None] == (None, "missing", None) and got["!!"] == (None, "unknown", None)
    texts = spark.createDataFrame([("England and Wales",), ("Delaware",), ("Republic of China",), ("People's Republic of China",), ("the Georgia company",), ("",), (None,), ("xyz",)], "t string")
    got = {r["t"]: r["c"] for r in country.text_to_country(texts, "t", "c").collect()}
    assert got == {"England and Wales": "United Kingdom", "Delaware": "United States", "Republic of China": "Taiwan", "People's Republic of China": "China", "the Georgia company": "United States", "": None, None: None, "xyz": None}


def test_incorporation_ladder(spark):
    cases = [("DE", "NV", None, "mismatch"), ("DE", None, "Nevada", "mismatch"), ("DE", "DE", "Nevada", "agree"), (None, None, None, "unknown"), ("DE", None, None, "unconfirmed"), ("DE", None, "State of Delaware", "agree"), (None, "DE", "Nevada", "review")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, xbrl_incorp_code string, header_incorp_code string, text_incorp string, want string")
    out = country.incorporation_check(df).collect()
    assert all(r["incorp_status"] == r["want"] for r in out) and "Germany" in out[0]["iso_trap"]


def test_assignment_and_validation(spark):
    prof = spark.createDataFrame([(1, "K3", "HK", "Hong Kong"), (2, None, "x", "y"), (3, "", "x", "y"), (4, "X0", "x", "y")], "cik long, incorporation_code string, hq_address string, hq_country string")
    ev = spark.createDataFrame([(1, None, "Cayman Islands", [], False, None), (2, "DE", None, ["A, Canada"], True, "two"), (3, None, "England and Wales", None, None, None), (4, None, "England and Wales", None, None, None)], "cik long, header_code string, cover_text string, cover_addresses array<string>, dual_hq boolean, dual_hq_evidence string")
    got = {r["cik"]: r for r in country.assignments(prof, ev).collect()}
    assert (got[1]["incorporation_agreement"], got[1]["status"]) == ("mismatch", "review")
    assert (got[2]["incorporation_code"], got[2]["incorporation_country"], got[2]["hq_address"], got[2]["status"]) == ("DE", "United States", "A, Canada", "review")
    assert (got[3]["incorporation_name"], got[3]["incorporation_country"]) == ("England and Wales", "United Kingdom")
    assert got[4]["incorporation_agreement"] == "review" and "same country" in got[4]["issues"]
    key = "accession_number string, "
    one = country.validated(
        spark.createDataFrame([("a",)], "accession_number string"),
        spark.createDataFrame([("a", "DE", "Dublin 4", "L2")], key + "incorporation_state string, address_city string, address_state string"),
        spark.createDataFrame([("a", "DE", "DUBLIN", "L2")], key + "incorporation_code string, business_city string, business_state string"),
        spark.createDataFrame([("a", "Delaware", ["x"], False, None)], key + "incorporation_text string, addresses array<string>, dual_hq boolean, dual_hq_evidence string"),
    ).collect()[0]
    assert (one["incorp_status"], one["address_status"], one["status"]) == ("agree", "agree", "ok")


def test_snapshot_diff(spark):
    s = "cik long, incorporation_code string, incorporation_country string, hq_country string, status string, hq_address string"
    old = spark.createDataFrame([(1, "", "a", "US", "ok", "1 Main St."), (2, "x", "a", "US", "ok", "z")], s)
    new = spark.createDataFrame([(1, None, "a", "CA", "ok", "1 MAIN ST"), (3, "x", "a", "US", "ok", "z")], s)
    assert rows(country.snapshot_diff(old, new), "cik") == [(1, "changed", "hq_country", "US", "CA"), (2, "removed", "", None, None), (3, "added", "", None, None)]
    assert country.snapshot_diff(old, old).count() == 0


def test_ledger(spark):
    t = spark.createDataFrame([("d1", 1, "available"), ("d1", 2, "parsed"), ("d1", 5, "available"), ("d2", 3, "failed"), ("d3", 4, "empty")], "idx_date string, seq long, status string")
    now = ledger.current(t)
    assert rows(now.select("idx_date", "status"), "idx_date") == [("d1", "parsed"), ("d2", "failed"), ("d3", "empty")]
    assert rows(ledger.watermark(now)) == [("d3",)] and rows(ledger.pending(now, F.lit("d9"))) == [("d2",)]
    assert rows(ledger.watermark(now.limit(0))) == [(None,)]
    found = spark.createDataFrame([("d3",), ("d4",)], "idx_date string")
    assert rows(ledger.todo(found, now, F.lit("d9"))) == [("d2", "backlog"), ("d4", "discovered")]


def test_upsert(spark):
    s = "accession_number string, cik long, ticker string, report_date string, form_type string, enriched int"
    old = spark.createDataFrame([("a", 1, "EXA", "2024-12-31", "10-K", 1), ("z", 9, "Z", None, "4", 0)], s).selectExpr("*", "1 as first_seen_run", "1 as last_seen_run", "'t' as ingested_at", "cast(null as string) as updated_at")
    new = spark.createDataFrame([("a", 1, "", None, "10-K/A", 0), ("b", 2, "", None, "8-K", 0)], s)
    merged = ledger.upserted(old, new, F.lit(2), F.lit("n"))
    assert rows(merged.orderBy("cik")) == [("a", 1, "EXA", "2024-12-31", "10-K/A", 1, 1, 2, "t", "n"), ("b", 2, "", None, "8-K", 0, 2, 2, "n", None), ("z", 9, "Z", None, "4", 0, 1, 1, "t", None)]
    again = ledger.upserted(merged, new, F.lit(2), F.lit("n"))
    keep = [c for c in merged.columns if c != "updated_at"]
    assert rows(again.select(keep), "cik") == rows(merged.select(keep), "cik")
    folded = ledger.last_of_batch(spark.createDataFrame([("a", 1, "T", "d", "x", 1, 0), ("a", 1, "", None, "y", 0, 1)], s + ", pos int"), "pos")
    assert rows(folded.select("ticker", "report_date", "form_type", "enriched")) == [("T", "d", "y", 1)]


def test_industries(spark):
    df = spark.createDataFrame([(6798, None), (2086, None), (3835, None), (None, None), (6798, "302010"), (6798, "351010"), (7372, "101010"), (1311, "101010"), (None, "101010")], "sic int, sector_given string").withColumn("sic", F.col("sic").cast("string"))
    got = [(r["industry_code"], r["sector_code"], r["method"], r["confidence"]) for r in derived.classified(df.coalesce(1), "sector_given").collect()]
    assert sorted(got, key=str) == sorted([("35", None, "sic", "low"), ("45", None, "sic", "low"), (None, None, None, None), (None, None, None, None), ("30", "302010", "llm+sic", "review"), ("35", "351020", "llm+sic", "high"), ("10", "101010", "llm+sic", "high"), ("10", "101010", "llm+sic", "review"), ("10", "101010", "llm", "medium")], key=str)


def test_adr_tiers(spark):
    s = spark.createDataFrame([("a", "American Depositary Shares, each representing two (2) ordinary shares", None), ("b", "American Depositary Shares", None), ("c", "Common Stock, par value $0.01", None), ("d", "American depositary shares, each representing one-half of one ordinary share", None)], "accession_number string, security_title string, security_class string")
    t = spark.createDataFrame([("b", "Intro. Each ADS represents five equity shares. End."), ("a", "Each ADS represents nine shares.")], "accession_number string, text string")
    got = {r["accession_number"]: (r["shares_per_ads"], r["method"], r["display"]) for r in derived.adr_ratios(s, t).collect()}
    assert got["a"] == (2.0, "regex-title", "1 ADS : 2 ordinary shares") and got["b"] == (5.0, "regex-text", "1 ADS : 5 equity shares")
    assert got["d"][0] == 0.5 and got["d"][2].startswith("2 ADS : 1") and "c" not in got
    assert {r["method"] for r in derived.adr_ratios(s).where("accession_number = 'b'").collect()} == {None}


def test_voting(spark):
    t = spark.createDataFrame([(1, 0, "Class A Common Stock has one vote per share. Each share of Class B Common Stock has 1/10,000 of the voting rights of a share of Class A Common Stock."), (2, 0, "Nothing here."), (2, 1, "Holders have one vote for each share of Common Stock."), (3, 0, "Class A stock has one vote per share. Class A stock has two votes per share."), (4, 0, None)], "cik long, source_rank int, text string")
    got = rows(derived.voting_rights(t).select("cik", "class_label", "votes_per_share", "confidence"), "cik", "class_label")
    assert got == [(1, "Class A", 1.0, "high"), (1, "Class B", 0.0001, "high"), (2, "Common Stock", 1.0, "high"), (3, "Class A", 1.0, "review")]


def test_store(spark):
    k = "kind string, cik long, source_accession string, "
    old = spark.createDataFrame([("adr", 1, "a", "p", None, "approved", None, "t", "t"), ("adr", 2, "a", "p", "e", "edited", None, "t", "t"), ("adr", 4, "a", "p", None, "rejected", None, "t", "t")], k + "payload string, edited string, status string, review_note string, created_utc string, updated_utc string")
    new = spark.createDataFrame([("adr", 1, "a", "p"), ("adr", 2, "a", "q"), ("adr", 3, "a", "r")], k + "payload string")
    got = {r["cik"]: r for r in derived.saved(old, new, F.lit("n")).collect()}
    assert got[1]["status"] == "approved" and got[1]["updated_utc"] == "t"
    assert got[2]["status"] == "pending" and got[2]["edited"] is None and "superseded" in got[2]["review_note"]
    assert got[3]["status"] == "pending" and got[3]["created_utc"] == "n" and got[4]["status"] == "rejected"


def test_confidence_and_display(spark):
    df = spark.createDataFrame([("a", 0, "high", "m", "e1"), ("a", 1, "review", "k", "e2"), ("a", 2, None, "m", "e1"), ("b", 0, "high", None, None), ("b", 1, None, None, None)], "k string, pos int, confidence string, method string, evidence string")
    assert rows(derived.combined(df, "k"), "k") == [("a", "review", "k+m", "e1\ne2"), ("b", "medium", "", "")]
    assert df.limit(0).agg(derived.worst_confidence(F.col("confidence"))).collect()[0][0] == "medium"
    p = spark.sql("select 'Tech' as a, 'Tech' as b, cast(null as string) as c, 'Soft' as d")
    assert p.select(derived.path(p, "a", "b", "c", "d")).collect()[0][0] == "Tech > Soft"


def test_model_hook(spark):
    df = spark.createDataFrame([(1, "p"), (2, None)], "i int, prompt string")
    out = derived.with_model(df, "prompt", "answer", lambda: lambda p: '{"sector": "S"}', "sector string")
    assert [(r["i"], r["answer"] and r["answer"]["sector"]) for r in out.orderBy("i").collect()] == [(1, "S"), (2, None)]


def test_idioms(spark):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([1, 5, -2, 7, 1])] + [("h", 0, 1)], "g string, i int, v int")
    assert rows(idioms.sliding_max(df, "g", ["i"], "v", 3)) == [("g", 10)]
    assert idioms.combinations(df, "g", "v").count() == 6

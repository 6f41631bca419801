import gzip
import json
import zipfile

import pytest

from filigree.operators import derived
from filigree.plans import filing
from filigree.sources import fetch, landing
from test_operators import SUBMISSION


def test_one_plan_over_submissions(spark, tmp_path):
    body = "<html><h2>Net sales by country</h2><table><tr><td>US</td><td>5</td></tr></table><p>Delaware</p><p>(State of incorporation)</p><p>Substantially all of our revenue is derived from the United States.</p></html>"
    raw = spark.createDataFrame([("a", SUBMISSION.replace("<html>main</html>", body)), ("b", None)], "accession_number string, text string")
    out = filing.processed(raw)
    assert [r["category"] for r in out["statements"].collect()] == ["revenue"]
    assert [r["cells"] for r in out["tables"].collect()] == [[["US", "5"]]]
    assert out["covers"].collect()[0]["incorporation_text"] == "Delaware"
    assert out["documents"].count() == 3 and out["headers"].count() == 2
    filing.write_html(out["html"], str(tmp_path / "h"), "accession_number", "filename")
    assert spark.read.parquet(str(tmp_path / "h")).collect()[0]["slug"] == "a_ex-20250101.htm"


def test_company_results_into_the_store(spark):
    profiles = spark.createDataFrame([(1, "6798"), (2, None)], "cik long, sic string")
    securities = spark.createDataFrame([(1, "x", "American Depositary Shares, each representing two ordinary shares", None)], "cik long, accession_number string, security_title string, security_class string")
    texts = spark.createDataFrame([(1, "x", 0, "Holders have one vote for each share of Common Stock.")], "cik long, accession_number string, source_rank int, text string")
    got = {(r["kind"], r["cik"]): (r["source_accession"], json.loads(r["payload"])) for r in filing.company_results(profiles, securities, texts).collect()}
    assert got["icb", 1][1]["industry_code"] == "35" and got["adr", 1][1][0]["shares_per_ads"] == 2.0 and got["voting", 1] == ("x", [{"class_label": "Common Stock", "votes_per_share": 1.0, "confidence": "high"}])
    assert got["icb", 2][0] == "" and derived.headline is not None


def test_start_date(spark):
    rows = [("2025-01-02", "parsed"), ("2025-01-05", "empty"), ("2025-01-03", "failed")]
    led = spark.createDataFrame(rows, "idx_date string, status string")
    assert filing.start_date(led).collect()[0][0] == "2025-01-03"
    assert filing.start_date(led.where("status <> 'failed'")).collect()[0][0] == "2025-01-06"
    assert filing.start_date(led, "2024-12-01").collect()[0][0] == "2024-12-01"
    assert filing.start_date(led.limit(0)).collect()[0][0] is None


def reader(*answers):
    waits, left = [], list(answers)

    def get(url, headers):
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return fetch.PoliteReader(get, 1.0, pause=waits.append), waits


def test_polite_reader(tmp_path):
    r, waits = reader((429, b""), (429, b""), (200, b"x"))
    assert r.read("u") == b"x" and waits == [1.0, 10.0, 1.0, 20.0, 1.0]
    with pytest.raises(fetch.Blocked):
        reader(*[(429, b"")] * 4)[0].read("u")
    with pytest.raises(fetch.Missing):
        reader((404, b""))[0].read("u")
    with pytest.raises(ConnectionError):
        reader(*[OSError()] * 4)[0].read("u")
    assert reader((206, b"y" * 12_000), (206, b"z</SEC-HEADER>"))[0].read_head("u") == b"z</SEC-HEADER>"
    assert reader((200, b"a"), (404, b""))[0].land([("f", "u"), ("g", "v")], str(tmp_path)) == {"g": "v"}
    assert (tmp_path / "f").read_bytes() == b"a" and reader()[0].land([("f", "u")], str(tmp_path)) == {}


def test_quarters_that_are_not_published():
    r, _ = reader((200, b"a"), (403, b""), (404, b""))
    assert r.listings([("q1", "u"), ("q2", "v"), ("q3", "w")]) == {"q1": b"a"}


def test_daily_index_files(spark, tmp_path):
    body = "Description: x\nCIK|Company Name|Form Type|Date Filed|File Name\n" + "-" * 40 + "\n1|Nestl\xe9|10-K|20240105|edgar/data/1/0000000001-24-000001.txt\nbad line\n"
    (tmp_path / "master.20240105.idx").write_bytes(body.encode("latin-1"))
    (tmp_path / "master.20240108.idx.gz").write_bytes(gzip.compress(body.replace("|10-K|", "|8-K|").encode("latin-1")))
    got = sorted(tuple(r) for r in landing.one_day(spark, str(tmp_path)).select("idx_date", "cik", "entity_name", "form_type", "filing_date").collect())
    assert got == [("2024-01-05", 1, "Nestl\xe9", "10-K", "2024-01-05"), ("2024-01-08", 1, "Nestl\xe9", "8-K", "2024-01-05")]


def test_damaged_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "MEMBERS", 2)
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(5):
            z.writestr(f"CIK{i}.json", json.dumps({"cik": str(i), "name": "N" * 200}))
        z.writestr("CIK0-submissions-001.json", "{}")
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    at = raw.index(b"CIK3.json") + len("CIK3.json") + 3
    raw[at : at + 8] = b"\xff" * 8
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    (tmp_path / "b.zip").write_bytes(b"no archive")
    assert sorted(r["cik"] for r in landing.bulk_profiles(spark, str(tmp_path)).collect()) == ["0", "1", "2", "4"]


def test_texts_of_any_charset_and_identity(spark, tmp_path):
    for i, raw in enumerate(("é".encode(), b"\x93x\x94", b"\x81y")):
        (tmp_path / f"0000000001-24-00000{i}.txt").write_bytes(raw)
    got = {r["accession_number"][-1]: r["text"] for r in landing.raw_submissions(spark, str(tmp_path)).collect()}
    assert got == {"0": "é", "1": "\u201cx\u201d", "2": "\x81y"}
    df = spark.createDataFrame([("k", None, 1, "T"), ("l", b"<x", 2, "U")], "filing_key string, content binary, cik long, ticker string")
    row = landing.instances(df).collect()
    assert [(r["filing_key"], r["cik"], r["ticker"], r["error"] is not None) for r in row] == [("l", "2", "U", True)]

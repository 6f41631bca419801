import pytest
from pyspark.sql import functions as F

from filigree.plans.snapshots import SnapshotTable, month_before, write_month
from filigree.streaming import incremental

SCHEMA = "accession_number string, cik long, ticker string, form_type string, enriched int, pos int"


def test_new_files_are_merged_once(spark, tmp_path):
    landing, table, runs = (str(tmp_path / n) for n in ("in", "filings", "runs"))
    spark.createDataFrame([("a", 1, "A", "10-K", 0, 0), ("a", 1, "", "10-K/A", 1, 1)], SCHEMA).write.parquet(landing)

    def run():
        q = incremental.ingest(incremental.read_new(spark, landing, SCHEMA), SnapshotTable(spark, table), SnapshotTable(spark, runs), str(tmp_path / "c"), "pos")
        q.awaitTermination()
        return [tuple(r) for r in SnapshotTable(spark, table).read().select("accession_number", "ticker", "form_type", "enriched").orderBy("accession_number").collect()]

    assert run() == [("a", "A", "10-K/A", 1)]
    spark.createDataFrame([("b", 2, "B", "8-K", 0, 0)], SCHEMA).write.mode("append").parquet(landing)
    assert run() == [("a", "A", "10-K/A", 1), ("b", "B", "8-K", 0)]
    before = SnapshotTable(spark, table).versions()
    assert run() and SnapshotTable(spark, table).versions() == before


def test_counts_equal_the_batch(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    got = incremental.stream_counts(spark, str(tmp_path / "in"), df.schema, ["k"])
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in df.groupBy("k").count().collect()}


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.write(spark.range(3))
    t.write(t.read().unionByName(spark.range(2)))
    assert t.read().count() == 5 and len(t.versions()) == 2
    for m in ("2025-01", "2025-03"):
        write_month(spark.range(1).select(F.lit(m).alias("m")), str(tmp_path / "months"), m)
    assert month_before(spark, str(tmp_path / "months"), "2025-03").collect()[0]["m"] == "2025-01"
    assert month_before(spark, str(tmp_path / "months"), "2025-01") is None and month_before(spark, str(tmp_path / "none"), "2025-01") is None


def test_interleaved_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = SnapshotTable(spark, path), SnapshotTable(spark, path)
    a.write(spark.range(1))
    assert a.read().count() == b.read().count() == 1
    a.write(spark.range(2))
    with pytest.raises(RuntimeError):
        b.write(spark.range(3))
    assert b.read().count() == 2
    real = SnapshotTable._current
    stale = real(b)
    a.write(spark.range(4))
    b._current, b._seen = lambda: stale, stale[0]  # it looked just before the other one committed
    with pytest.raises(RuntimeError):
        b.write(spark.range(5))
    del b._current
    assert b.read().count() == 4 and len(b.versions()) == 3


def test_parts_and_retired_versions(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), keep=2)
    rows = lambda *r: spark.createDataFrame(r, "k string, n int")
    t.write(rows(("a", 1), ("b", 1)), F.col("k"))
    first = t._current()[1]
    t.write(rows(("b", 2)), F.col("k"))
    t.write(rows(("c", 3)), F.col("k"))
    assert sorted(tuple(r) for r in t.read().select("k", "n").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert [tuple(r) for r in t.read(["b"]).collect()] == [("b", 2)] and t.read(["z"]) is None
    folders = {p.name for p in (tmp_path / "t").glob("v=*/part_=*")}
    assert folders == {"part_=a", "part_=b", "part_=c"} and len(t.versions()) == 2
    assert t._current()[1]["a"] == first["a"] and not (tmp_path / "t" / first["b"]).exists()


def test_a_batch_rewrites_its_years(spark, tmp_path):
    landing, table, runs = (str(tmp_path / n) for n in ("in", "filings", "runs"))
    schema = SCHEMA
    spark.createDataFrame([("1-23-1", 1, "A", "10-K", 0, 0), ("1-24-1", 1, "A", "10-K", 0, 1)], schema).write.parquet(landing)

    def run():
        t = SnapshotTable(spark, table)
        incremental.ingest(incremental.read_new(spark, landing, schema), t, SnapshotTable(spark, runs), str(tmp_path / "c"), "pos").awaitTermination()
        return t._current()[1]

    first = run()
    spark.createDataFrame([("1-24-2", 2, "B", "8-K", 0, 0)], schema).write.mode("append").parquet(landing)
    second = run()
    assert first.keys() == second.keys() == {"23", "24"} and first["23"] == second["23"] and first["24"] != second["24"]
    assert SnapshotTable(spark, table).read().count() == 3
    assert sorted(r["rows"] for r in SnapshotTable(spark, runs).read().collect()) == [1, 2]


def test_failed_days_stay(spark):
    ledger = spark.createDataFrame([("d1", "failed"), ("d2", "parsed")], "idx_date string, status string")
    found = spark.createDataFrame([("d2",), ("d3",)], "idx_date string")

    def day(d):
        if d == "d1":
            raise OSError("no")
        return "parsed"

    assert incremental.retry_backlog(ledger, found, "d9", day) == [("d1", "failed"), ("d3", "parsed")]


def test_failing_merge_reports(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "x string, y int").write.parquet(str(tmp_path / "in"))
    q = incremental.ingest(incremental.read_new(spark, str(tmp_path / "in"), "x string, y int"), SnapshotTable(spark, str(tmp_path / "t")), SnapshotTable(spark, str(tmp_path / "r")), str(tmp_path / "c"), "pos")
    with pytest.raises(Exception):
        q.awaitTermination()

"""Readers of a landing zone: submissions JSON, index files, tickers, raw submissions, tagged instances.

Fetching is rate-limited and serial by its nature; it lands bytes, and all
that follows is parallel.
"""

from __future__ import annotations

import gzip
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from filigree.sources.instance import FACT_SCHEMA, FACTS, parse_instances

_ADDRESS = "street1 string, street2 string, city string, stateOrCountry string, stateOrCountryDescription string, zipCode string"
_RECENT = "form array<string>, accessionNumber array<string>, filingDate array<string>, primaryDocument array<string>, reportDate array<string>, fileNumber array<string>, act array<string>, size array<bigint>, isXBRL array<int>, isInlineXBRL array<int>"
SUBMISSIONS = (
    "cik string, name string, entityType string, sic string, sicDescription string, category string, fiscalYearEnd string, ein string, phone string, tickers array<string>, exchanges array<string>, "
    f"stateOfIncorporation string, stateOfIncorporationDescription string, addresses struct<business:struct<{_ADDRESS.replace(' string', ':string')}>, mailing:struct<{_ADDRESS.replace(' string', ':string')}>>, formerNames array<struct<name:string>>, "
    f"filings struct<recent:struct<{', '.join(f'{n}:{k}' for n, k in (c.split(' ') for c in _RECENT.split(', ')))}>>"
)
INDEX_RE = r"^[^|]*[0-9]+[^|]*\|.*\|.*\|.*\|.*"
ACCESSION_RE = r"([0-9]{10}-[0-9]{2}-[0-9]{6})"


def submissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSIONS).json(path, multiLine=True)


#: Members of an archive that one task reads.
MEMBERS = 2000


def bulk_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles out of zip archives of any size; continuation shards and members that are damaged or don't parse are left out.

    A first pass reads the archives' directories alone and cuts them into ranges
    of members, which are spread over tasks that read only their own; damaged
    archives have no members.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("path").to_pylist():
                try:
                    with _opened(file) as raw, zipfile.ZipFile(raw) as z:
                        n = len(z.infolist())
                except (zipfile.BadZipFile, ValueError):  # Arrow names a position before the file invalid
                    n = 0
                starts = list(range(0, n, MEMBERS))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(starts), pa.string()), pa.array(starts, pa.int64())], names=["path", "start"])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as raw, zipfile.ZipFile(raw) as z:
                    for info in z.infolist()[row["start"] : row["start"] + MEMBERS]:
                        name = info.filename
                        if not (name.startswith("CIK") and name.endswith(".json") and "-submissions-" not in name):
                            continue
                        try:
                            text = z.read(info).decode("utf-8", "replace")
                        except (zipfile.BadZipFile, ValueError, zlib.error, EOFError, NotImplementedError, RuntimeError):
                            continue
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text])], names=["member", "json"])

    files = spark.read.format("binaryFile").load(path).select("path")  # names only; the contents aren't read
    parts = files.mapInArrow(ranges, "path string, start long").repartition("path", "start")
    kind = spark.createDataFrame([], SUBMISSIONS).schema
    return parts.mapInArrow(members, "member string, json string").select("member", F.from_json("json", kind).alias("p")).where("p.cik is not null").select("member", "p.*")


def _opened(uri: str):  # noqa: ANN202
    """A seekable stream of a file of any file system that Arrow knows."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return system.open_input_file(name)


def daily_index(spark: SparkSession, path: str) -> DataFrame:
    """idx_date, line_no and value of the lines of daily index files (master.yyyymmdd.idx, also gzipped), which are Latin-1."""

    @F.pandas_udf(StringType())
    def text(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: (gzip.decompress(b) if bytes(b[:2]) == b"\x1f\x8b" else bytes(b)).decode("latin-1"))

    files = spark.read.format("binaryFile").load(path)
    day = iso_date(F.regexp_extract("path", r"\.([0-9]{8})\.idx(?:\.gz)?$", 1))
    lines = files.select(day.alias("idx_date"), text("content").alias("text")).where("idx_date <> ''")
    return lines.select("idx_date", F.posexplode(F.split("text", "\r?\n")).alias("line_no", "value"))


def one_day(spark: SparkSession, path: str, tickers: DataFrame | None = None) -> DataFrame:
    """The filings of landed daily index files."""
    return index_lines(daily_index(spark, path), tickers)


def quarter_listing_url(date: Column) -> Column:
    """Address of the listing of a quarter's index files."""
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/daily-index/"), F.year(date).cast("string"), F.lit("/QTR"), F.quarter(date).cast("string"), F.lit("/index.json"))


def checked_date(c: Column) -> Column:
    """The date of a yyyy-mm-dd argument; null for anything else."""
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def index_lines(lines: DataFrame, tickers: DataFrame | None = None, line: str = "value", at: str = "line_no", key: str = "idx_date") -> DataFrame:
    """Filings of daily index lines (key, at, line): after a file's rule of dashes, with a numeric cik and an accession number.

    The file is the window: the rule's line number is one aggregate a file.
    """
    rule = lines.where(F.col(line).rlike("^-{11,}")).groupBy(key).agg(F.min(at).alias("rule_"))
    rows = lines.where(F.col(line).rlike(r"^\s*[0-9]+\s*\|") & (F.size(F.split(line, r"\|")) >= 5))
    rows = rows.join(rule, key).where(F.col(at) > F.col("rule_"))
    part = F.split(line, r"\|")
    field = lambda i: F.trim(F.get(part, F.lit(i)))
    out = rows.select(key, F.col(at), field(0).cast("bigint").alias("cik"), field(1).alias("entity_name"), field(2).alias("form_type"), iso_date(field(3)).alias("filing_date"), F.regexp_extract(field(4), ACCESSION_RE, 1).alias("accession_number")).where("accession_number <> ''")
    if tickers is None:
        return out.withColumn("ticker", F.lit(""))
    return out.join(tickers.select(F.col("cik").cast("bigint").alias("cik"), F.col("ticker").alias("t_")), "cik", "left").withColumn("ticker", F.coalesce("t_", F.lit(""))).drop("t_")


def iso_date(c: Column) -> Column:
    """yyyy-mm-dd of eight digits; anything else as it is."""
    return F.regexp_replace(c, "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")


def quarter_label(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("-QTR"), F.quarter(date).cast("string"))


def quarters(start: Column, end: Column) -> Column:
    """Array of the first days of the quarters from start's to end's."""
    return F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 months"))


def index_url(date: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/daily-index/"), F.year(date).cast("string"), F.lit("/QTR"), F.quarter(date).cast("string"), F.lit("/master."), F.date_format(date, "yyyyMMdd"), F.lit(".idx"))


def index_files(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Published daily index files of quarter listings (quarter, directory.item) within the inclusive dates."""
    items = listing.select("quarter", F.inline("directory.item"))
    day = iso_date(F.regexp_extract("name", r"^master\.([0-9]{8})\.idx(?:\.gz)?$", 1))
    return items.withColumn("idx_date", day).where((F.col("idx_date") != "") & F.col("idx_date").between(start, end)).select("idx_date", "quarter", F.col("name").alias("file")).distinct().orderBy("idx_date")


def ticker_rows(raw: DataFrame, json: str = "value") -> DataFrame:
    """pos, cik, ticker and title of a ticker file's JSON map, in the order of its keys."""
    kind = "map<string,struct<cik_str:bigint,ticker:string,title:string>>"
    return raw.select(F.posexplode(F.map_entries(F.from_json(json, kind))).alias("pos", "e")).select("pos", F.col("e.value.cik_str").alias("cik"), "e.value.ticker", "e.value.title")


@F.pandas_udf(StringType())
def decode_bytes(raw: pd.Series) -> pd.Series:
    """Strict UTF-8, else Windows-1252, else Latin-1."""

    def one(b: bytes | None) -> str | None:
        for charset in ("utf-8", "cp1252"):
            try:
                return None if b is None else bytes(b).decode(charset)
            except UnicodeDecodeError:
                continue
        return bytes(b).decode("latin-1")

    return raw.map(one)


def raw_submissions(spark: SparkSession, path: str) -> DataFrame:
    """accession_number and text of raw submission files; UTF-8 is decoded inside the JVM, other bytes in Arrow batches."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", ACCESSION_RE, 1).alias("accession_number"), "content")
    return files.select("accession_number", decoded_text(F.col("content")).alias("text"))


def decoded_text(raw: Column) -> Column:
    """The text of bytes: UTF-8 inside the JVM, and only other bytes go to Python; each file is read once."""
    good = F.is_valid_utf8(raw.cast("string"))
    return F.coalesce(F.when(good, raw.cast("string")), decode_bytes(F.when(~good, raw)))


IDENTITY = ("cik", "ticker", "entity_name", "form_type", "filing_date", "accession_number", "source_url")


def grouping_key(accession: Column, url: Column) -> Column:
    """What facts of a filing are grouped by: its accession number, else the address that they came from."""
    return F.coalesce(F.nullif(accession, F.lit("")), F.nullif(url, F.lit("")))


#: Documents that are turned into Python objects at once, and rows from which a batch is handed on.
PARSED, FACT_ROWS = 200, 5000


def instances(df: DataFrame, content: str = "content", key: str = "filing_key") -> DataFrame:
    """Facts of tagged instances (key, bytes), with those of the identity columns that df has; a file that doesn't parse gives one row with its error.

    Rows without content, such as filings without an instance, are skipped.
    """
    identity = [c for c in IDENTITY if c in df.columns and c != key]
    slim = df.where(F.col(content).isNotNull()).select(F.col(key).cast("string").alias("filing_key"), F.col(content).cast("binary").alias("content"), *[F.col(c).cast("string").alias(c) for c in identity])
    schema = pa.schema([*_ARROW, *[(c, pa.string()) for c in identity]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stamps, contents = batch.select([c for c in batch.schema.names if c != "content"]), batch.column("content")
            rows: list[tuple] = []
            where: list[int] = []
            for start in range(0, batch.num_rows, PARSED):
                for i, found in enumerate(parse_instances(contents.slice(start, PARSED).to_pylist()), start):
                    rows += found
                    where += [i] * len(found)
                    if len(rows) >= FACT_ROWS:
                        yield built(rows, where, stamps)
                        rows, where = [], []
            if rows:
                yield built(rows, where, stamps)

    def built(rows: list[tuple], where: list[int], stamps: pa.RecordBatch) -> pa.RecordBatch:
        by_name = dict(zip(FACTS, zip(*rows))) | dict(zip(stamps.schema.names, stamps.take(pa.array(where)).columns))
        return pa.RecordBatch.from_arrays([c if isinstance(c := by_name[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)

    return slim.mapInArrow(run, FACT_SCHEMA + "".join(f", {c} string" for c in identity))


_ARROW = pa.schema(
    [("filing_key", pa.string()), ("ordinal", pa.int32()), ("concept", pa.string()), ("namespace", pa.string()), ("value", pa.string()), ("value_num", pa.float64()), ("unit", pa.string()), ("decimals", pa.string()), ("is_numeric", pa.bool_()), ("is_nil", pa.bool_())]
    + [(n, pa.string()) for n in ("context_ref", "period_type", "period_start", "period_end", "period", "entity_cik")]
    + [("dimensions", pa.map_(pa.string(), pa.string())), ("is_dimensioned", pa.bool_()), ("segment", pa.string()), ("error", pa.string())]
)

"""Raw submissions: documents, primary document, statements and tables."""

from __future__ import annotations

import html.parser
import json
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree import data
from filigree.functions import text as tx

_HTML_NAME = r"(?i)\.html?$"


def field(block: Column, name: str) -> Column:
    """Value of an unclosed tag up to the end of its line; null if blank or absent."""
    return tx.blank_to_null(F.trim(F.regexp_extract(block, rf"(?i)<{name}>([^\r\n<]*)", 1)))


def documents(df: DataFrame, text: str = "text", keys: Sequence[str] = ("accession_number",)) -> DataFrame:
    """The documents of each submission: pos, seq, type, filename, description and body."""
    blocks = F.regexp_extract_all(F.col(text), F.lit(r"(?is)<DOCUMENT>(.*?)</DOCUMENT>"), F.lit(1))
    rows = df.select(*keys, F.posexplode(blocks).alias("pos", "block"))
    head = F.regexp_extract("block", r"(?is)^(.*?)<TEXT>", 1)
    body = F.regexp_extract("block", r"(?is)<TEXT>\s*(.*?)\s*(?:</TEXT>|$)", 1)
    return rows.select(*keys, "pos", field(head, "SEQUENCE").alias("seq"), field(head, "TYPE").alias("type"), field(head, "FILENAME").alias("filename"), field(head, "DESCRIPTION").alias("description"), body.alias("body"))


def primary(docs: DataFrame, keys: Sequence[str] = ("accession_number",), named: str | None = None) -> DataFrame:
    """The document of the name in column named, else the HTML document of lowest sequence that is no exhibit, else the first HTML document."""
    seq = F.coalesce(F.col("seq").try_cast("int"), F.lit(9999))
    is_html = F.col("filename").rlike(_HTML_NAME) | F.col("body").rlike(r"(?i)<html")
    rank = F.when(is_html & ~F.coalesce(F.col("type").rlike("(?i)^EX-"), F.lit(False)), 1).when(is_html, 2)
    if named:
        rank = F.when(F.lower("filename") == F.lower(named), 0).otherwise(rank)
    order = F.struct(rank, F.when(rank == 2, 0).otherwise(seq), F.col("pos"))
    columns = [c for c in docs.columns if c not in keys]
    best = docs.where(rank.isNotNull()).groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("d"))
    return best.select(*keys, "d.*")


def sentence_rows(df: DataFrame, text: str = "text", keys: Sequence[str] = ("accession_number",)) -> DataFrame:
    return df.select(*keys, F.posexplode(tx.sentences(F.col(text))).alias("pos", "statement"))


def statements(df: DataFrame, text: str = "text", keys: Sequence[str] = ("accession_number",), quantifiers: Sequence[str] | None = None, subjects: Mapping[str, Sequence[str]] | None = None, places: Sequence[str] | None = None, longest: int = 500, word_boundary: bool = False) -> DataFrame:
    """Sentences with a quantifier, a subject and a place or strong cue; of equal ones of a filing the first."""
    rows = sentence_rows(df, text, keys).where(F.length("statement") <= longest)
    s = F.col("statement")
    rows = rows.withColumn("quantifier", tx.quantifier(s, quantifiers)).where("quantifier is not null")
    rows = rows.withColumn("s_", tx.subject(s, subjects)).where("s_ is not null").withColumn("g_", tx.places(s, places, word_boundary)).where((F.size("g_") > 0) | tx.strong_cue(s))
    key = F.trim(F.regexp_replace(F.lower(s), r"\s+", " "))
    first = rows.withColumn("k_", key).withColumn("n_", F.row_number().over(Window.partitionBy(*keys, "k_").orderBy("pos"))).where("n_ = 1")
    return first.select(*keys, "pos", F.col("s_.category").alias("category"), "quantifier", F.col("s_.subject").alias("subject"), tx.blank_to_null(F.array_join("g_", ", ")).alias("geographies"), "statement")


class _Tables(html.parser.HTMLParser):
    """Collects every table (nested ones too) with the text before it and its grid."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.before: list[str] = []
        self.found: list[dict] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            caption = re.sub(r"\s+", " ", " ".join(self.before)).strip()[-400:]
            self.found.append({"caption": caption, "text": [], "rows": [], "cell": None})
            self.open.append(self.found[-1])
        elif self.open and tag == "tr":
            self.open[-1]["rows"].append([])
            self.open[-1]["cell"] = None
        elif self.open and tag in ("td", "th"):
            if not self.open[-1]["rows"]:
                self.open[-1]["rows"].append([])
            at = dict(attrs)
            span = lambda name: max(1, min(1000, int(m[0]))) if name in at and (m := re.match(r"\d+", (at[name] or "").strip())) else 1
            self.open[-1]["cell"] = {"text": [], "cols": span("colspan"), "rows": span("rowspan")}
            self.open[-1]["rows"][-1].append(self.open[-1]["cell"])
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "div") and not self.open:
            self.before.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif self.open and tag in ("td", "th", "tr"):
            self.open[-1]["cell"] = None

    def handle_data(self, text: str) -> None:
        if not self.open:
            if text.strip():
                self.before = [*self.before[-20:], text]
            return
        for t in self.open:
            t["text"].append(text)
            if t["cell"] is not None:
                t["cell"]["text"].append(text)


def grid(rows: list[list[dict]]) -> list[list[str | None]]:
    """Cells with spans filled in; blank cells null, all-null rows and columns gone."""
    out: list[dict[int, str | None]] = []
    hanging: dict[int, tuple[int, str | None]] = {}
    for row in rows:
        line: dict[int, str | None] = {c: v for c, (_, v) in hanging.items()}
        hanging = {c: (n - 1, v) for c, (n, v) in hanging.items() if n > 1}
        at = 0
        for cell in row:
            value = " ".join("".join(cell["text"]).split()) or None
            for _ in range(cell["cols"]):
                while at in line:
                    at += 1
                line[at] = value
                if cell["rows"] > 1:
                    hanging[at] = (cell["rows"] - 1, value)
                at += 1
        out.append(line)
    used = sorted({c for line in out for c, v in line.items() if v is not None})
    return [[line.get(c) for c in used] for line in out if any(line.get(c) is not None for c in used)]


#: A start tag (name, attributes), end tag (name) or text (the rest) of plain markup; attributes hold no entities.
_TOKEN = re.compile(r"""<([A-Za-z][A-Za-z0-9]*)((?:\s+[A-Za-z][A-Za-z-]*=(?:"[^"<>&]*"|'[^'<>&]*'|[^\s"'<>=`&/]+))*)\s*>|</([A-Za-z][A-Za-z0-9]*)>|([^<&]+)""", re.A)
_ATTRIBUTE = re.compile(r"""([A-Za-z-]+)=(?:"([^"]*)"|'([^']*)'|(\S+))""", re.A)
#: Elements whose content isn't markup, or is so only in some versions of the library.
_RAW = re.compile(r"<(?:script|style|title|textarea|xmp|iframe|noembed|noframes|noscript|plaintext)", re.I)


def _tokens(markup: str) -> list[tuple[str, str, str, str]] | None:
    """(start tag, attributes, end tag, text) of markup made of plain tags and text alone; else None."""
    if _RAW.search(markup):
        return None
    out, at = [], 0
    for m in _TOKEN.finditer(markup):
        begin, end = m.span()
        if begin != at:
            return None
        at = end
        out.append(m.groups(""))
    return out if at == len(markup) else None


def parse_tables(markup: str | None) -> list[tuple[int, str, str, list[list[str | None]]]]:
    """(index, caption, own text, grid) of every table; only markup that isn't plain goes through the library's parser, which is slow."""
    parser = _Tables()
    tokens = _tokens(markup or "")
    if tokens is None:
        parser.feed(markup or "")
        parser.close()
    else:
        for start, attrs, end, text in tokens:
            if text:
                parser.handle_data(text)
            elif start:
                parser.handle_starttag(start.lower(), [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attrs)] if attrs else [])
            else:
                parser.handle_endtag(end.lower())
    return [(i, t["caption"], " ".join("".join(t["text"]).split()), grid(t["rows"])) for i, t in enumerate(parser.found)]


#: A batch of tables is handed on from so many tables or characters of text.
TABLES, TABLE_CHARS = 1000, 1_000_000


def tables(df: DataFrame, markup: str = "html", key: str = "accession_number", categories: Sequence[str] | None = None) -> DataFrame:
    """Tables that match a keyword category (one of categories, if given): table_index, categories, keywords, caption, n_rows, n_cols and cells."""
    slim = df.select(F.col(key).alias("key_"), F.col(markup).alias("markup_"))
    kinds = (pa.int32(), pa.string(), pa.string(), pa.list_(pa.list_(pa.string())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            where: list[int] = []
            chars = 0
            for i, page in enumerate(batch.column(1)):
                for t in parse_tables(page.as_py()):
                    if t[3]:
                        found.append(t)
                        where.append(i)
                        chars += len(t[2])
                if len(found) >= TABLES or chars >= TABLE_CHARS:
                    yield built(batch.column(0), where, found)
                    found, where, chars = [], [], 0
            if found:
                yield built(batch.column(0), where, found)

    def built(keys: pa.Array, where: list[int], found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys.take(pa.array(where)), *(pa.array(c, kind) for c, kind in zip(zip(*found), kinds))], names=["key_", "table_index", "caption", "own", "cells"])

    rows = slim.mapInArrow(run, f"key_ {slim.schema['key_'].dataType.simpleString()}, table_index int, caption string, own string, cells array<array<string>>")
    rows = rows.withColumn("keywords", tx.matched_categories(F.concat_ws(" \n ", "caption", "own"))).withColumn("categories", F.array_sort(F.map_keys("keywords"))).where(F.size("categories") > 0)
    if categories is not None:
        unknown = set(categories) - set(data.grouped("table"))
        if unknown:
            raise ValueError(f"no such category: {sorted(unknown)}")
        rows = rows.where(F.arrays_overlap("categories", F.array(*map(F.lit, categories))))
    return rows.select(F.col("key_").alias(key), "table_index", "categories", "keywords", F.substring("caption", 1, 200).alias("caption"), F.size("cells").alias("n_rows"), F.size(F.get("cells", F.lit(0))).alias("n_cols"), "cells")


def table_json(cells: list[list[str | None]]) -> str:
    return json.dumps(cells, ensure_ascii=False)


HEADER_END = "</SEC-HEADER>"


def header_fields(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the filer-database values of the header: incorporation code, addresses and number of filers."""
    t = F.col(text)
    inside = F.regexp_extract(t, r"(?is)<SEC-HEADER>(.*?)</SEC-HEADER>", 1)
    head = F.when(inside != "", inside).when(F.instr(t, "<DOCUMENT>") > 1, F.substring_index(t, "<DOCUMENT>", 1)).otherwise(F.substring(t, 1, 8000))
    value = lambda block, name: tx.blank_to_null(F.trim(F.regexp_extract(block, rf"(?i){name}:[^\S\r\n]*([^\r\n]+)", 1)))
    out = df.withColumn("head_", head)
    block = lambda name: F.substring(F.regexp_extract("head_", rf"(?is){name} ADDRESS:(.*)$", 1), 1, 600)
    for kind, name in (("business", "BUSINESS"), ("mail", "MAIL")):
        for column, label in (("street_1", "STREET 1"), ("street_2", "STREET 2"), ("city", "CITY"), ("state", r"(?<!\w )STATE"), ("zip", "ZIP")):
            out = out.withColumn(f"{kind}_{column}", value(block(name), label))
    filers = F.regexp_count("head_", F.lit(r"(?m)^\s*FILER:"))
    named = F.col("head_").rlike("(?i)COMPANY CONFORMED NAME").cast("int")
    return out.withColumn("incorporation_code", value(F.col("head_"), "STATE OF INCORPORATION")).withColumn("n_filers", F.when(filers > 0, filers).otherwise(named)).drop("head_")


def enriched(df: DataFrame, text: str = "text") -> DataFrame:
    """Index rows completed from the head of their submission (column text); rows without a text stay as they are.

    report_date, act and file_number change when found; is_xbrl is always
    overwritten; both document links are made anew when a primary document is
    found, and only then the row becomes enriched.
    """
    from filigree.operators.manifest import instance_url, links

    t = F.col(text)
    head, body = F.substring_index(t, HEADER_END, 1), F.when(t.contains(HEADER_END), F.substring_index(t, HEADER_END, -1)).otherwise(t)
    get = lambda block, pattern: tx.blank_to_null(F.trim(F.regexp_extract(block, pattern, 1)))
    period = F.regexp_replace(get(head, r"(?i)CONFORMED PERIOD OF REPORT:\s*(\d{8})"), r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    document = get(body, r"(?i)<FILENAME>([^\r\n<]+)")
    inline = F.substring_index(body, "</DOCUMENT>", 1).contains("<XBRL>")
    found = df.withColumn("document_", document).withColumn("inline_", inline)
    url = links(F.col("cik"), F.col("accession_number"), F.col("document_"))["filing_url"]
    has = F.col("document_").isNotNull()
    return (
        found.withColumn("report_date", F.coalesce(period, "report_date"))
        .withColumn("act", F.coalesce(get(head, r"(?i)SEC ACT:[^\S\r\n]*([^\r\n]+)"), "act"))
        .withColumn("file_number", F.coalesce(get(head, r"(?i)SEC FILE NUMBER:[^\S\r\n]*([^\r\n]+)"), "file_number"))
        .withColumn("is_xbrl", F.when(t.isNull(), F.col("is_xbrl")).otherwise(F.col("inline_")))
        .withColumn("filing_url", F.when(has, url).otherwise(F.col("filing_url")))
        .withColumn("xbrl_instance_url", F.when(has, instance_url(F.col("cik"), F.col("accession_number"), F.col("document_"), F.col("inline_"))).otherwise(F.col("xbrl_instance_url")))
        .withColumn("primary_document", F.coalesce("document_", "primary_document"))
        .withColumn("enriched", F.greatest("enriched", has.cast("int")))
        .drop("document_", "inline_")
    )

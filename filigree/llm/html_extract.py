"""HTML content extraction by the maximum-scoring subsequence.

A page is a sequence of tags and runs of text.  Words score positive and tags
negative; the weights are log odds of standing in the content, counted over
labelled pages (those that mark their content by an article element, whose own
tags are left out of the counts).  One linear scan finds the contiguous region
of the greatest sum.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DROP_RE = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)"
TOKEN_RE = r"<[^>]*>|[^<]+"
WORD_RE = r"[^ \t\n\r]+"
_DROP = re.compile(DROP_RE.replace("$", r"\Z"))
_TOKEN, _WORD, _NAME = re.compile(TOKEN_RE), re.compile(WORD_RE), re.compile(r"^</?([a-zA-Z][a-zA-Z0-9]*)")
#: Elements with weights of their own; all others share one.
ELEMENTS = sorted(
    set(
        "a abbr address article aside audio b base blockquote body br button canvas caption cite code col colgroup dd del details div dl dt em embed fieldset figcaption figure font footer form "
        "h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main mark meta nav noscript object ol optgroup option p param picture pre q s samp section select "
        "small source span strong sub summary sup svg table tbody td textarea tfoot th thead time title tr u ul var video".split()
    )
)
OTHER, WORDS, DEFAULT = "other", "#words", -1000
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def tokens(html: str | None) -> list[str]:
    """Tags and runs of text without comments, scripts and styles."""
    return _TOKEN.findall(_DROP.sub("", html)) if html else []


def token_class(token: str) -> str:
    if token[0] != "<":
        return WORDS
    name = _NAME.match(token)
    return name[1].lower() if name and name[1].lower() in _KNOWN else OTHER


_KNOWN = frozenset(ELEMENTS)


def _marked(classes: list[str], found: list[str]) -> tuple[int, int] | None:
    """Tokens between the first article tag and the first end tag after it."""
    begin = next((i for i, (c, t) in enumerate(zip(classes, found)) if c == "article" and t[1] != "/"), None)
    if begin is None:
        return None
    end = next((i for i in range(begin + 1, len(found)) if classes[i] == "article" and found[i][1] == "/"), None)
    return None if end is None else (begin, end)


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, int]:
    """Integer weights (thousandths of log odds) of the classes from their counts (inside, outside) of labelled content."""
    inside, outside, kinds = sum(a for a, _ in counts.values()), sum(b for _, b in counts.values()), len(counts)
    out = {}
    for name, (a, b) in counts.items():
        odds = math.log((a + 1) * (outside + kinds) / ((b + 1) * (inside + kinds)))
        out[name] = math.floor(1000 * (max(odds, 0.05) if name == WORDS else min(odds, -0.05)) + 0.5)
    return out


def best_region(scores: list[int]) -> tuple[int, int, int]:
    """(first, after last, score) of the contiguous run of the greatest sum; (0, 0, 0) if no sum is positive.

    Of equal ones the one that ends first, and of these the shortest.
    """
    best, low, at, total, found = 0, 0, 0, 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= low:
            low, at = total, i
        total += s
        if total - low > best:
            best, found = total - low, (at, i + 1)
    return *found, best


def fit(pages: DataFrame, html: str = "html") -> dict[str, int]:
    """Weights by the counts over all labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within: Counter[str] = Counter()
        around: Counter[str] = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                found = tokens(page)
                classes = [token_class(t) for t in found]
                content = _marked(classes, found)
                if content:
                    for i, (c, t) in enumerate(zip(classes, found)):
                        if c != "article":
                            (within if content[0] < i < content[1] else around)[c] += len(_WORD.findall(t)) if c == WORDS else 1
        names = sorted({*within, *around})
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([within[n] for n in names], pa.int64()), pa.array([around[n] for n in names], pa.int64())], names=["name", "inside", "outside"])

    counts = pages.select(html).mapInArrow(run, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return weights({r["name"]: (r["inside"], r["outside"]) for r in counts.collect()})  # one row an element of ELEMENTS


def extract_page(html: str | None, weight: dict[str, int]) -> tuple[int, int, int, str]:
    """(first token, token after the last, score, text) of a page's content."""
    found = tokens(html)
    scores = []
    for t in found:
        c = token_class(t)
        scores.append(len(_WORD.findall(t)) * weight.get(c, 50) if c == WORDS else weight.get(c, DEFAULT))
    first, end, score = best_region(scores)
    text = " ".join(w for t in found[first:end] if t[0] != "<" for w in _WORD.findall(t))
    for code, char in ENTITIES:
        text = text.replace(code, char)
    return first, end, score, text


def extract(pages: DataFrame, weight: dict[str, int], page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, first_token, end_token, score and content of every page.

    content has the words of the region parted by blanks, with the ENTITIES
    decoded; a null or empty page, or one without words, has empty content,
    tokens 0 and score 0.  Repeated rows give repeated rows, an empty table an
    empty one.
    """
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = list(zip(*(extract_page(h, weight) for h in batch.column("html").to_pylist()))) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(done[0], pa.int32()), pa.array(done[1], pa.int32()), pa.array(done[2], pa.int64()), pa.array(done[3], pa.string())], names=["page_id", "first_token", "end_token", "score", "content"])

    return slim.mapInArrow(run, f"page_id {slim.schema['page_id'].dataType.simpleString()}, first_token int, end_token int, score long, content string")


def extract_sql() -> str:
    """SQL of extract() with the weights of fit()."""
    names = ", ".join(f"'{e}'" for e in ELEMENTS)
    decoded = "coalesce(string_agg(words, ' ' order by i) filter (where words <> ''), '')"
    for code, char in ENTITIES:
        decoded = f"replace({decoded}, '{code}', '{char.replace(chr(39), chr(39) * 2)}')"
    return rf"""with cleaned as (select page_id, regexp_extract_all(regexp_replace(coalesce(html, ''), '{DROP_RE}', '', 'g'), '{TOKEN_RE}') as ts from pages),
token as (select page_id, unnest(ts) as t, unnest(range(0, len(ts)))::int as i from cleaned),
classed as (select page_id, i, t, case when t[1] <> '<' then '{WORDS}' when lower(regexp_extract(t, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) in ({names}) then lower(regexp_extract(t, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) else '{OTHER}' end as c,
  case when t[1] <> '<' then len(regexp_extract_all(t, '{WORD_RE}')) else 1 end as n, case when t[1] <> '<' then array_to_string(regexp_extract_all(t, '{WORD_RE}'), ' ') else '' end as words from token),
opened as (select page_id, min(i) as a from classed where c = 'article' and t[2] <> '/' group by page_id),
marked as (select o.page_id, a, min(i) as z from opened o join classed c on c.page_id = o.page_id and c.c = 'article' and c.t[2] = '/' and i > a group by all),
counted as (select c, sum(n) filter (where i > a and i < z) as inside, sum(n) filter (where i < a or i > z) as outside from classed join marked using (page_id) where c <> 'article' group by c),
counts as (select c, coalesce(inside, 0)::double as inside, coalesce(outside, 0)::double as outside from counted),
odds as (select c, ln((inside + 1) * (sum(outside) over () + count(*) over ()) / ((outside + 1) * (sum(inside) over () + count(*) over ()))) as o from counts),
weight as (select c, floor(1000 * (case when c = '{WORDS}' then greatest(o, 0.05) else least(o, -0.05) end) + 0.5)::bigint as w from odds),
scored as (select page_id, i, words, case when c = '{WORDS}' then n * coalesce(w, 50) else coalesce(w, {DEFAULT}) end as s from classed left join weight using (c)),
summed as (select *, sum(s) over (partition by page_id order by i) as total from scored),
lowest as (select *, min(total - s) over (partition by page_id order by i rows unbounded preceding) as low from summed),
ends as (select page_id, i as z, low, total - low as score, row_number() over (partition by page_id order by total - low desc, i) as nth from lowest),
best as (select page_id, z, low, score from ends where nth = 1 and score > 0),
region as (select b.page_id, b.z, b.score, max(s.i) as a from best b join summed s on s.page_id = b.page_id and s.i <= b.z and s.total - s.s = b.low group by all)
select p.page_id, coalesce(any_value(r.a), 0)::int as first_token, coalesce(any_value(r.z) + 1, 0)::int as end_token, coalesce(any_value(r.score), 0)::bigint as score, {decoded} as content
from pages p left join region r using (page_id) left join scored s on s.page_id = p.page_id and s.i between r.a and r.z group by p.page_id"""

"""Tagged instance documents to facts, with contexts and units resolved."""

from __future__ import annotations

import functools
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence

XBRLI, XBRLDI = "http://www.xbrl.org/2003/instance", "http://xbrl.org/2006/xbrldi"
_NIL = "{http://www.w3.org/2001/XMLSchema-instance}nil"
_STRUCTURAL = (XBRLI, "http://www.xbrl.org/2003/linkbase", "http://www.w3.org/1999/xlink", XBRLDI)
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")
FACT_SCHEMA = (
    "filing_key string, ordinal int, concept string, namespace string, value string, value_num double, unit string, decimals string, is_numeric boolean, is_nil boolean, context_ref string, "
    "period_type string, period_start string, period_end string, period string, entity_cik string, dimensions map<string,string>, is_dimensioned boolean, segment string, error string"
)
#: The columns after filing_key, in the order of the parsers' rows.
FACTS = (
    "ordinal", "concept", "namespace", "value", "value_num", "unit", "decimals", "is_numeric", "is_nil", "context_ref",
    "period_type", "period_start", "period_end", "period", "entity_cik", "dimensions", "is_dimensioned", "segment", "error",
)


@functools.lru_cache(10_000)
def _split(tag: str) -> tuple[str, str]:
    space, _, local = tag[1:].rpartition("}") if tag[:1] == "{" else ("", "", tag)
    return space, local


def _text(e: ET.Element | None) -> str | None:
    return ((e.text or "").strip() or None) if e is not None else None


_IN = f"{{{XBRLI}}}"
_ENTITY, _PERIOD, _SCENARIO, _SEGMENT, _IDENTIFIER = (_IN + n for n in ("entity", "period", "scenario", "segment", "identifier"))
_DATES = {_IN + n: i for i, n in enumerate(("instant", "startDate", "endDate"))}
_EXPLICIT, _TYPED = (f"{{{XBRLDI}}}{n}" for n in ("explicitMember", "typedMember"))
_MEASURE, _DIVIDE, _SIDES = _IN + "measure", _IN + "divide", {_IN + "unitNumerator": 0, _IN + "unitDenominator": 1}
#: Columns of FACT_SCHEMA from period_type to segment for a context that isn't there.
_NO_CONTEXT = (None, None, None, None, None, (), False, "")


def _context(e: ET.Element) -> tuple:
    """Columns of FACT_SCHEMA from period_type to segment."""
    dates: list[ET.Element | None] = [None, None, None]
    who, segments, scenarios = None, [], []
    for part in e:
        tag = part.tag
        if tag == _PERIOD:
            for x in part:
                i = _DATES.get(x.tag)
                if i is not None and dates[i] is None:
                    dates[i] = x
        elif tag == _ENTITY:
            for x in part:
                if x.tag == _SEGMENT:
                    segments.append(x)
                elif x.tag == _IDENTIFIER and who is None:
                    who = x
        elif tag == _SCENARIO:
            scenarios.append(part)
    dims = {}
    for box in segments + scenarios:
        for m in box:
            if m.tag == _EXPLICIT:
                dims[(m.get("dimension") or "").strip()] = _text(m) or ""
            elif m.tag == _TYPED:
                dims[(m.get("dimension") or "").strip()] = next((_text(c) or "" for c in m), "")
    instant, start, end = map(_text, dates)
    period = instant if instant else f"{start}/{end}" if start or end else None
    kind = "instant" if instant else "duration" if start or end else None
    segment = "; ".join([f"{a}={m}" for a, m in sorted(dims.items())])
    return kind, start, instant or end, period, (_text(who) or "").lstrip("0") or None, tuple(dims.items()), bool(dims), segment


def _unit(e: ET.Element) -> str | None:
    name = lambda m: (_text(m) or "").rpartition(":")[2]
    plain, sides = [], ([], [])
    for part in e:
        if part.tag == _MEASURE:
            plain.append(name(part))
        elif part.tag == _DIVIDE:
            for side in part:
                if (i := _SIDES.get(side.tag)) is not None:
                    sides[i].extend(name(m) for m in side if m.tag == _MEASURE)
    return "*".join(sides[0]) + "/" + "*".join(sides[1]) if sides[0] or sides[1] else "*".join(plain) or None


def _root(raw: bytes) -> ET.Element:
    try:
        return ET.fromstring(raw)
    except ET.ParseError:  # once more without control characters and unknown entities
        text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", raw.decode("utf-8", "replace"))
        text = re.sub(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)[A-Za-z]*;?", "&amp;", text)
        return ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text))


def _facts(root: ET.Element) -> list[tuple]:
    contexts = {e.get("id"): _context(e) for e in root.iter(_IN + "context")}
    units = {e.get("id"): _unit(e) for e in root.iter(_IN + "unit")}
    rows: list[tuple] = []
    for e in root:
        ref = e.get("contextRef")
        if ref is None:
            continue
        space, local = _split(e.tag)
        if space in _STRUCTURAL:
            continue
        unit = e.get("unitRef")
        nil = e.get(_NIL) == "true"
        value = None if nil else ("".join(e.itertext()) if len(e) else e.text or "").strip() or None
        number = None
        if unit is not None and value:
            bare = value.replace(",", "")
            number = float(bare) if _NUMBER.fullmatch(bare) else None
        rows.append((len(rows), local, space, value, number, units.get(unit), e.get("decimals"), unit is not None, nil, ref, *contexts.get(ref, _NO_CONTEXT), None))
    return rows


def _one(raw: bytes | None) -> list[tuple]:
    if not raw:
        return []
    try:
        root = _root(bytes(raw))
    except ET.ParseError as problem:
        return [(None,) * (len(FACTS) - 1) + (str(problem),)]
    return _facts(root)


#: Documents that may be read in one go hold at most so many bytes; so many of these are.
_SMALL, _TOGETHER = 16_384, 50
_WHOLE = re.compile(rb"<[A-Za-z_].*</[^<>]*>", re.S)


def _together(raws: Sequence[bytes]) -> list[list[tuple]] | None:
    """The rows of documents that are read as one, parted by marks; None unless each of them is one element from its first byte to its last."""
    try:
        root = ET.fromstring(b"<r>" + b"<mark/>".join(raws) + b"</r>")
    except ET.ParseError:
        return None
    if len(root) != 2 * len(raws) - 1 or any(e.tag != "mark" for e in root[1::2]):
        return None
    return [_facts(e) for e in root[::2]]


def parse_instances(raws: Sequence[bytes | None]) -> Iterator[list[tuple]]:
    """The rows of each document, in the order of FACTS.

    Most of the cost of a small document is that of a parser, so small ones without a
    declaration share one; where such a group can't be read as a whole, each is read alone.
    """
    at = 0
    while at < len(raws):
        end = at
        while end < len(raws) and end - at < _TOGETHER and (raw := raws[end]) and len(raw) <= _SMALL and _WHOLE.fullmatch(raw):
            end += 1
        found = _together(raws[at:end]) if end - at > 1 else None
        if found is None:
            end = max(end, at + 1)
            found = map(_one, raws[at:end])
        yield from found
        at = end


def parse_instance(raw: bytes | None) -> list[dict]:
    """Rows of FACT_SCHEMA without filing_key; one row with error where the document can't be parsed."""
    rows = (dict(zip(FACTS, r)) for r in _one(raw))
    return [{"error": r["error"]} if r["error"] else r | {"dimensions": list(r["dimensions"])} for r in rows]

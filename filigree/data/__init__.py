"""Static vocabularies and dimension tables; all are of fixed, small size."""

from __future__ import annotations

import functools
import itertools
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_HERE = Path(__file__).parent


@functools.cache
def sections(name: str) -> dict[str, list[str]]:
    """The lines of a data file by [section], in order."""
    out: dict[str, list[str]] = {}
    current: list[str] = []
    for line in (_HERE / f"{name}.txt").read_text(encoding="utf-8").splitlines():
        if line.startswith("["):
            current = out.setdefault(line.strip("[]"), [])
        elif line:
            current.append(line)
    return out


def expanded(line: str) -> list[str]:
    """The phrases of a line whose {a|b} stand for either."""
    parts = re.split(r"\{([^}]*)\}", line)
    return ["".join(choice) for choice in itertools.product(*[p.split("|") if i % 2 else [p] for i, p in enumerate(parts)])]


def phrases(section: str) -> list[str]:
    """The phrases of a section of the vocabulary, each once."""
    return list(dict.fromkeys(p for line in sections("vocabulary")[section] for p in expanded(line)))


def grouped(kind: str) -> dict[str, list[str]]:
    """The sections "kind:name" by name, in order."""
    return {k.split(":")[1]: phrases(k) for k in sections("vocabulary") if k.startswith(f"{kind}:")}


def pairs(section: str) -> list[tuple[str, str]]:
    """(left, right) of the lines "left = right"."""
    return [tuple(line.split(" = ", 1)) for line in phrases(section)]


_KINDS = {"state": "us_state", "province": "ca_province", "country": "country"}


@functools.cache
def codes() -> list[tuple[str, str, str, str]]:
    """(code, name, kind, country) of every jurisdiction code."""
    out = []
    for section, kind in _KINDS.items():
        for line in sections("jurisdictions")[section]:
            name, code = line.rsplit(" = ", 1)
            country = {"state": "United States", "province": "Canada"}.get(section) or re.sub(r"\s*\(.*?\)", "", name).strip()
            out.append((code, name, kind, country))
    return out


@functools.cache
def place_names() -> list[tuple[str, str, int]]:
    """(lower-case name, country, rank): longest first, of equal length states before provinces before countries before aliases."""
    found: dict[tuple[str, str], tuple[int, int]] = {}
    for _, name, kind, country in codes():
        key = name.split(",")[0] if kind == "ca_province" else re.sub(r"\s*\(.*?\)", "", name).strip()
        found.setdefault((plain(key), country), (-len(plain(key)), list(_KINDS.values()).index(kind)))
    for text, country in pairs("alias"):
        found.setdefault((plain(text), country), (-len(plain(text)), 9))
    ordered = sorted((k for k in found if k[0]), key=lambda k: (found[k], k))
    return [(name, country, i) for i, (name, country) in enumerate(ordered)]


def plain(text: str) -> str:
    """Lower-case letters with single blanks."""
    return re.sub(r"\s+", " ", re.sub(r"[^a-z ]", " ", text.lower())).strip()


@functools.cache
def industries() -> list[tuple[str, ...]]:
    """(code, name) of industry, supersector, sector and subsector in one row each subsector."""
    out, path = [], [("", "")] * 3
    for line in (_HERE / "industries.txt").read_text(encoding="utf-8").splitlines():
        depth = (len(line) - len(line.lstrip())) // 2
        code, name = line.strip().split(" ", 1)
        if depth < 3:
            path = [*path[:depth], (code, name), *path[depth + 1 :]]
        else:
            out.append((*path[0], *path[1], *path[2], code, name))
    return out


@functools.cache
def sic_ranges() -> list[tuple[int, int, str, str | None]]:
    """(first, last, industry code, sector hint) of the ranges of standard industry codes."""
    out = []
    for line in (_HERE / "sic_ranges.txt").read_text().splitlines():
        industry, *ranges = line.split()
        for r in ranges:
            span, _, hint = r.partition(":")
            low, high = map(int, span.split("-"))
            out.append((low, high, industry, hint or None))
    return sorted(out)


def code_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(codes(), "code string, name string, kind string, country string")


def industry_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(industries(), ", ".join(f"{n}_code string, {n} string" for n in ("industry", "supersector", "sector", "subsector")))


def sic_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sic_ranges(), "sic_start int, sic_end int, industry_code string, sector_hint string")

"""Column functions over names, titles, markup and prose; all run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree import data

NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Without format characters, blanks of any kind collapsed; '' is null."""
    return blank_to_null(F.trim(F.regexp_replace(F.regexp_replace(c, r"\p{Cf}", ""), r"(?U)\s+", " ")))


def to_float(c: Column) -> Column:
    """A plain decimal number, thousands commas allowed; else null."""
    bare = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return F.when(bare.rlike(NUMBER_RE), bare.try_cast("double"))


def member_label(c: Column) -> Column:
    """The local name of an axis member without its ending."""
    return F.regexp_replace(F.regexp_replace(c, "^[^:]*:", ""), "Member$", "")


def security_type(member: Column, title: Column) -> Column:
    """debt, warrant, equity or other, by the first that the words name."""
    words = F.lower(F.concat_ws(" ", F.coalesce(member, F.lit("")), F.coalesce(title, F.lit(""))))
    return F.when(words.rlike("note|debenture|bond"), "debt").when(words.contains("warrant"), "warrant").when(words.rlike("stock|class|ordinary|share|preferred|depositary|capital|unit"), "equity").otherwise("other")


def class_label(title: Column) -> Column:
    low, out = F.lower(title), F.lit(None).cast("string")
    for word, label in (("preferred", "PreferredStock"), ("capital", "CapitalStock"), ("ordinary", "OrdinaryShares"), ("common", "CommonStock")):
        out = F.when(low.contains(word), label).otherwise(out)
    return out


def is_common(class_name: Column) -> Column:
    """Does a class label name common or ordinary equity?"""
    return F.lower(class_name).rlike("commonstock|commonclass|ordinary|capitalstock|commonshare|commonunit|^class")


def segment_string(dimensions: Column) -> Column:
    """axis=member of a map, sorted by axis, parted by '; '."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(dimensions)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")


def html_clean(c: Column, strip_styles: bool = False) -> Column:
    """Markup without hidden metadata, inline wrappers, scripts and comments."""
    c = F.regexp_replace(c, r"(?is)<ix:(header|hidden|references|resources)\b.*?</ix:\1\s*>", "")
    c = F.regexp_replace(c, r"(?i)</?ix:[^>]*>", "")
    c = F.regexp_replace(c, r"(?is)<script\b.*?</script\s*>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    if strip_styles:
        c = F.regexp_replace(F.regexp_replace(c, r"(?is)<style\b.*?</style\s*>", ""), r"(?i)\sstyle\s*=\s*(\"[^\"]*\"|'[^']*')", "")
    return F.regexp_replace(F.regexp_replace(c, r">\s+<", "> <"), "[ \\t\\r\\f\\x0B]{2,}", " ")


ENTITIES = (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&rsquo;", "’"), ("&amp;", "&"))
_CLOSE = "p|div|tr|li|h[1-6]|td|th|section|article|ul|ol|table|thead|tbody|caption|blockquote|figcaption"


def html_text(c: Column) -> Column:
    """Visible text, one line a block, without empty lines."""
    c = F.regexp_replace(c, r"(?is)<(style|script)\b.*?</\1\s*>|<!--.*?-->", "")
    c = F.regexp_replace(c, rf"(?i)<br\s*/?>|</(?:{_CLOSE})\s*>", "\n")
    c = F.regexp_replace(c, r"<[^>]*>", "")
    for code, char in ENTITIES:
        c = F.replace(c, F.lit(code), F.lit(char))
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(F.regexp_replace(x, "[ \\t\\r\\u00a0]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


SPLIT_RE = r"""([.!?;])\s+([A-Z("'“])"""


def sentences(c: Column) -> Column:
    """Array of the sentences: lines, cut after terminal punctuation before a capital, quote or bracket."""
    marked = F.regexp_replace(F.replace(c, F.lit("\n"), F.lit("\x01")), SPLIT_RE, "$1\x01$2")
    return F.filter(F.transform(F.split(marked, "\x01"), lambda s: F.trim(s)), lambda s: s != "")


def matched_categories(c: Column, vocabulary: Mapping[str, Sequence[str]] | None = None) -> Column:
    """map category -> matched keywords (substrings, any case)."""
    vocabulary = data.grouped("table") if vocabulary is None else vocabulary
    low = F.lower(c)
    words = F.create_map(*[x for k, v in vocabulary.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.map_filter(F.transform_values(words, lambda _, v: F.filter(v, lambda w: F.contains(low, w))), lambda _, v: F.size(v) > 0)


def quantifier(sentence: Column, vocabulary: Sequence[str] | None = None) -> Column:
    """The first quantifier in list order; a weak one doesn't count where an explanation follows it."""
    low = F.lower(sentence)
    weak = F.array(*map(F.lit, data.phrases("weak")))
    tail = low.rlike(rf"\b({'|'.join(data.phrases('weak'))})\s+({'|'.join(w.replace(' ', '[ ]') for w in data.phrases('tail'))})")
    every = F.array(*map(F.lit, data.phrases("quantifier") if vocabulary is None else vocabulary))
    return F.get(F.filter(every, lambda q: F.contains(low, q) & ~(F.array_contains(weak, q) & tail)), F.lit(0))


def subject(sentence: Column, vocabulary: Mapping[str, Sequence[str]] | None = None) -> Column:
    """struct(category, subject) of the first subject phrase as whole words; null if none."""
    low, out = F.lower(sentence), F.lit(None).cast("struct<category:string,subject:string>")
    every = [(k, w) for k, v in (data.grouped("subject") if vocabulary is None else vocabulary).items() for w in v]
    for k, w in reversed(every):
        out = F.when(low.rlike(rf"\b{re.escape(w)}\b"), F.struct(F.lit(k).alias("category"), F.lit(w).alias("subject"))).otherwise(out)
    return out


def places(sentence: Column, vocabulary: Sequence[str] | None = None, word_boundary: bool = False) -> Column:
    """Place names in list order without those that an earlier one holds.

    By default a name counts as a bare substring; word_boundary asks for whole words.
    """
    low = F.lower(sentence)
    every = F.array(*map(F.lit, data.phrases("place") if vocabulary is None else vocabulary))
    hit = (lambda g: F.regexp_like(low, F.concat(F.lit(r"(?<![a-z])\Q"), F.lower(g), F.lit(r"\E(?![a-z])")))) if word_boundary else (lambda g: F.contains(low, F.lower(g)))
    none = F.lit(None).cast("string")
    held = lambda found, g: F.exists(found, lambda f: F.contains(F.lower(f), F.lower(g)))
    return F.filter(F.aggregate(F.filter(every, hit), F.array(none), lambda found, g: F.when(F.coalesce(held(found, g), F.lit(False)), found).otherwise(F.array_append(found, g))), lambda x: x.isNotNull())


def strong_cue(sentence: Column) -> Column:
    low = F.lower(sentence)
    return F.exists(F.array(*map(F.lit, data.phrases("cue"))), lambda cue: F.contains(low, cue))


def normal_name(c: Column) -> Column:
    """A jurisdiction's name for comparison; null is ''."""
    c = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\b(the )?(state|commonwealth|province|country)( of| or province of)?\b", " ")
    c = F.regexp_replace(c, r"\b(federal republic|republic|kingdom|people s republic|islands?) of\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[^a-z ]", " "), r"\s+", " "))


def same_name(a: Column, b: Column, strict: bool = False) -> Column:
    """Normal names of one place: equal, one within the other (unless strict), or the same words."""
    words = lambda c: F.array_sort(F.array_distinct(F.split(c, " ")))
    alike = (a == b) | (words(a) == words(b))
    return (a != "") & (b != "") & (alike if strict else alike | F.contains(a, b) | F.contains(b, a))


def normal_address(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def joined(*parts: Column, by: str = ", ") -> Column:
    """The parts that are neither null nor ''; null if there is none."""
    return blank_to_null(F.concat_ws(by, *map(blank_to_null, parts)))


def slug(*parts: Column) -> Column:
    """A file name of the parts."""
    out = F.regexp_replace(F.regexp_replace(F.concat_ws("_", *map(blank_to_null, parts)), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.coalesce(blank_to_null(out), F.lit("filing"))


def with_base(html: Column, href: Column) -> Column:
    """Markup with a base address after its first head tag, or in front where it has none."""
    tag = F.concat(F.lit('<base href="'), href, F.lit('">'))
    at = F.regexp_instr(html, F.lit(r"(?i)<head(\s[^>]*)?>"))
    head = F.regexp_extract(html, r"(?i)<head(?:\s[^>]*)?>", 0)
    cut = at + F.length(head) - 1
    return F.when(at > 0, F.concat(F.substring(html, F.lit(1), cut), tag, F.substring(html, cut + 1, F.length(html)))).otherwise(F.concat(tag, html))

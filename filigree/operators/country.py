"""Jurisdictions: codes, free text, cover pages, validation ladders, monthly assignments and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree import data
from filigree.functions import text as tx

WATCHED = ("incorporation_code", "incorporation_country", "hq_country", "status")
WATCHED_NORMAL = ("hq_address",)


def decoded(df: DataFrame, code: str, prefix: str) -> DataFrame:
    """df with {prefix}name, {prefix}kind and {prefix}country of a code; kind is missing or unknown where it decodes to nothing."""
    table = data.code_table(df.sparkSession).select(F.col("code").alias("code_"), F.col("name").alias(f"{prefix}name"), F.col("kind").alias("kind_"), F.col("country").alias(f"{prefix}country"))
    key = F.upper(F.trim(F.col(code)))
    out = df.join(F.broadcast(table), key == F.col("code_"), "left")  # 309 rows
    kind = F.when(F.coalesce(key, F.lit("")) == "", "missing").otherwise(F.coalesce("kind_", F.lit("unknown")))
    return out.withColumn(f"{prefix}kind", kind).drop("code_", "kind_")


def _trie(words: list[str]) -> str:
    """A pattern of the longest of the words (letters and blanks) at a place."""
    out, ends = [], "" in words
    by_first: dict[str, list[str]] = {}
    for w in words:
        if w:
            by_first.setdefault(w[0], []).append(w[1:])
    for letter in sorted(by_first):
        out.append(letter + _trie(by_first[letter]))
    if not out:
        return ""
    return f"(?:{'|'.join(out)})" + ("?" if ends else "")


def text_to_country(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the country of a free-text jurisdiction: an alias, else the longest name that it holds as whole words.

    Names of equal length are taken in order state, province, country.  The fixed
    list of names is part of the expression, so nothing is joined or shuffled.
    One pattern finds the longest name from each word on; only those are ranked,
    so the cost grows with the words of the text and not with the names.
    """
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.col(text)), "[^a-z ]", " "), r"\s+", " "))
    aliases = F.create_map(*[x for t, c in data.pairs("alias") for x in (F.lit(data.plain(t)), F.lit(c))])
    ranks: dict[str, tuple[int, str]] = {}
    for name, place, rank in data.place_names():
        ranks.setdefault(name, (rank, place))
    best = F.create_map(*[x for n, (r, c) in ranks.items() for x in (F.lit(n), F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")))])
    held = F.regexp_extract_all(F.concat(F.lit(" "), F.col("plain_"), F.lit(" ")), F.lit(rf"(?<= )(?=({_trie(list(ranks))}) )"), F.lit(1))
    found = F.array_min(F.transform(held, lambda n: F.try_element_at(best, n)))["c"]
    return df.withColumn("plain_", plain).withColumn(out, F.when(F.col("plain_") != "", F.coalesce(F.try_element_at(aliases, F.col("plain_")), found))).drop("plain_")


_COUNTRIES = "U[.]?S[.]?A[.]?|United States|United Kingdom|England|Ireland|Germany|France|Netherlands|Switzerland|Luxembourg|Israel|China|Hong Kong|Singapore|Japan|Australia|Brazil|Mexico|Panama|Bermuda|Cayman|Jersey|Guernsey|Marshall Islands|Canada|Quebec|Québec|Ontario|British Columbia"
CUE_RE = rf"(?i)\b({_COUNTRIES})\b"
OFFICE_RE = r"(?i)\b(corporate headquarters|head office|registered office|principal (executive )?office)\b"
LABEL_RE = r"(?i)((state|jurisdiction|country|province)[^)]*incorporat)|(incorporat\w*\s+(or|of)\s+organization)"
END_RE = r"(?i)securities registered pursuant to section 12"
_NOISE = r"(?i)i\.?r\.?s\.?|identification|employer|zip code|exact name|telephone|commission|file number|registrant|mark one|form 10-|form 20-|annual report|securities exchange act"


def is_noise(line: Column) -> Column:
    """Labels, numbers and other lines of a cover that hold no value."""
    return (line == "") | F.lower(line).isin("n/a", "na", "none", "not applicable", "not applicable.", "-", "—") | line.startswith("(") | line.endswith(")") | line.rlike(r"^[\d\-\s]+$") | line.rlike(_NOISE)


def canonical_country(c: Column) -> Column:
    low = F.replace(F.lower(c), F.lit("."), F.lit(""))
    return F.when(low.isin("usa", "us", "united states"), "United States").when(low.isin("quebec", "québec", "ontario", "british columbia", "canada"), "Canada").otherwise(F.initcap(c))


def cover(df: DataFrame, text: str, key: str) -> DataFrame:
    """key, incorporation_text, addresses, countries, dual_hq and dual_hq_evidence of the first 8,000 characters of a cover text."""
    lines = F.filter(F.transform(F.split(F.substring(F.col(text), 1, 8000), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = df.select(key, F.posexplode_outer(lines).alias("n", "line"))
    w = Window.partitionBy(key)
    rows = rows.withColumn("end_", F.coalesce(F.min(F.when(F.col("line").rlike(END_RE), F.col("n"))).over(w), F.lit(70))).where("n is null or n < end_")
    useful = F.when(~is_noise(F.col("line")), F.col("line"))
    rows = rows.withColumn("useful_", useful).withColumn("near_", F.last("useful_", ignorenulls=True).over(w.orderBy("n").rowsBetween(-5, -1)))
    anchor = F.col("useful_").isNotNull() & F.col("line").contains(",") & F.col("line").rlike(CUE_RE) & (F.length("line") < 120)
    country = F.when(anchor, canonical_country(F.regexp_extract("line", CUE_RE, 1)))
    ordered = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct("n", c.alias("v"))))), lambda x: x["v"]))
    found = rows.groupBy(key).agg(
        F.min_by("near_", F.when(F.col("line").rlike(LABEL_RE), F.col("n"))).alias("incorporation_text"),
        ordered(F.when(anchor, F.col("line"))).alias("addresses"),
        ordered(country).alias("countries"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("line").rlike(OFFICE_RE) & F.col("line").startswith("("), F.struct("n", "line")))), lambda x: F.regexp_replace(x["line"], "^[(]+|[)]+$", "")).alias("offices"),
    )
    many = F.when(F.size("countries") >= 2, F.concat(F.lit("addresses in multiple countries: "), F.array_join("countries", ", ")))
    marks = F.when(F.size("offices") >= 2, F.concat(F.size("offices").cast("string"), F.lit(" 'headquarters/office' markers: "), F.array_join("offices", "; ")))
    return found.withColumn("dual_hq", (F.size("countries") >= 2) | (F.size("offices") >= 2)).withColumn("dual_hq_evidence", tx.blank_to_null(F.concat_ws("; ", many, marks))).drop("offices")


def iso_trap(code: Column, name: Column, kind: Column) -> Column:
    """A warning where a state's code read as an ISO code names another country."""
    table = F.create_map(*[x for c, v in data.pairs("collision") for x in (F.lit(c), F.lit(v))])
    other = F.try_element_at(table, code)
    return F.when(kind.isin("us_state", "ca_province"), F.concat(F.lit("code '"), code, F.lit("' = "), name, F.lit("; as an ISO code it would be "), other))


def incorporation_check(df: DataFrame, strict: bool = False) -> DataFrame:
    """df (xbrl_incorp_code, header_incorp_code, text_incorp) with decoded names, iso_trap, incorp_status and incorp_issue.

    Status: mismatch if both codes are there and differ, or if text and code
    name different places and no second code corroborates; unknown without a
    source; agree if codes are equal or all names are alike; unconfirmed with
    one source; else review.
    """
    out = decoded(decoded(df, "xbrl_incorp_code", "xbrl_"), "header_incorp_code", "header_").drop("xbrl_country", "header_country", "header_kind")
    code, header = (F.coalesce(F.upper(F.trim(c)), F.lit("")) for c in ("xbrl_incorp_code", "header_incorp_code"))
    names = [tx.normal_name(F.col(c)) for c in ("xbrl_name", "header_name", "text_incorp")]
    present = F.filter(F.array(*names), lambda x: x != "")
    same = lambda a, b: tx.same_name(a, b, strict)
    differ = (names[0] != "") & (names[2] != "") & ~same(names[0], names[2])
    codes_differ, equal = (code != "") & (header != "") & (code != header), (code != "") & (code == header)
    alike = F.forall(present, lambda a: F.forall(present, lambda b: same(a, b)))
    status = (
        F.when(codes_differ, "mismatch").when(differ & ~equal, "mismatch").when(F.size(present) == 0, "unknown").when(equal, "agree").when(F.size(present) == 1, "unconfirmed").when(alike, "agree").otherwise("review")
    )
    issue = F.when(codes_differ, F.concat(F.lit("XBRL incorporation "), code, F.lit(" != header "), header)).when(differ & equal, F.concat(F.lit("note: cover text says '"), F.col("text_incorp"), F.lit("'"))).when(differ, F.concat(F.lit("cover text says '"), F.col("text_incorp"), F.lit("' but XBRL code is "), code))
    unknown = F.when((code != "") & (F.col("xbrl_kind") == "unknown"), F.concat(F.lit("XBRL incorporation code '"), code, F.lit("' is unknown")))
    return out.withColumn("iso_trap", iso_trap(code, F.col("xbrl_name"), F.col("xbrl_kind"))).withColumn("incorp_status", status).withColumn("incorp_issue", tx.blank_to_null(F.concat_ws("; ", issue, unknown)))


def address_check(df: DataFrame) -> DataFrame:
    """df (xbrl_city, header_city, xbrl_country, header_country, dual_hq) with address_status: dual_hq, mismatch, agree or unknown."""
    x, h = tx.normal_address(F.col("xbrl_city")), tx.normal_address(F.col("header_city"))
    city = (x != "") & (h != "") & ~F.contains(x, h) & ~F.contains(h, x)
    country = F.coalesce(F.col("xbrl_country") != F.col("header_country"), F.lit(False))
    return df.withColumn("address_status", F.when(F.coalesce("dual_hq", F.lit(False)), "dual_hq").when(city | country, "mismatch").when((x != "") | (h != ""), "agree").otherwise("unknown"))


def validated(filings: DataFrame, entities: DataFrame, headers: DataFrame, covers: DataFrame, key: str = "accession_number") -> DataFrame:
    """Filings cross-checked between tagged facts, filer header and cover text, with status ok or review."""
    e = entities.select(key, F.col("incorporation_state").alias("xbrl_incorp_code"), F.col("address_city").alias("xbrl_city"), F.col("address_state").alias("xbrl_state"))
    h = headers.select(key, F.col("incorporation_code").alias("header_incorp_code"), F.col("business_city").alias("header_city"), F.col("business_state").alias("header_state"))
    c = covers.select(key, F.col("incorporation_text").alias("text_incorp"), F.col("addresses").alias("cover_addresses"), "dual_hq", "dual_hq_evidence")
    joined = filings.join(e, key, "left").join(h, key, "left").join(c, key, "left")
    checked = incorporation_check(joined)
    for side in ("xbrl", "header"):
        checked = decoded(checked, f"{side}_state", f"{side}_office_").withColumnRenamed(f"{side}_office_country", f"{side}_country").drop(f"{side}_office_name", f"{side}_office_kind")
    checked = address_check(checked)
    bad = F.col("incorp_status").isin("mismatch", "review") | F.col("address_status").isin("mismatch", "dual_hq") | (F.col("iso_trap").isNotNull() & (F.col("incorp_status") != "agree"))
    return checked.withColumn("status", F.when(bad, "review").otherwise("ok"))


def assignments(profiles: DataFrame, evidence: DataFrame, key: str = "cik") -> DataFrame:
    """One row a company: profile values, completed and reconciled with the evidence of its latest filing.

    profiles: key, incorporation_code, hq_address, hq_country.  evidence: key,
    header_code, cover_text, cover_addresses, dual_hq, dual_hq_evidence.  Where
    the profile has no code, the header's counts, else the cover's country.
    """
    df = profiles.join(evidence, key, "left")
    df = text_to_country(decoded(decoded(df, "incorporation_code", "p_"), "header_code", "h_"), "cover_text", "t_country")
    p, h = (F.coalesce(F.upper(F.trim(c)), F.lit("")) for c in ("incorporation_code", "header_code"))
    pn, hn, tn = (tx.normal_name(F.col(c)) for c in ("p_name", "h_name", "cover_text"))
    differ = (pn != "") & (tn != "") & ~tx.same_name(pn, tn)
    same_land = F.coalesce(F.col("p_country") == F.col("t_country"), F.lit(False))
    present = F.filter(F.array(pn, hn, tn), lambda x: x != "")
    alike = F.forall(present, lambda a: F.forall(present, lambda b: tx.same_name(a, b)))
    agreement = F.when((p != "") & (h != "") & (p != h), "mismatch").when(differ & ~same_land, "mismatch").when(F.size(present) == 0, "unknown").when(((p != "") & (p == h)) | ((F.size(present) >= 2) & alike), "agree").when(F.size(present) == 1, "unconfirmed").otherwise("review")
    missing = p == ""
    by_header = missing & (h != "")
    addresses = F.coalesce(F.size("cover_addresses") > 0, F.lit(False))
    dual = F.coalesce("dual_hq", F.lit(False))
    issues = F.array_compact(
        F.array(
            F.when(dual, F.concat(F.lit("dual headquarters: "), F.coalesce("dual_hq_evidence", F.lit("")))),
            F.when(by_header, F.concat(F.lit("incorporation from the latest header: "), F.col("header_code"))),
            F.when(missing & ~by_header & F.col("cover_text").isNotNull(), F.concat(F.lit("incorporation from the latest cover: "), F.col("cover_text"))),
            F.when((p != "") & (h != "") & (p != h), F.concat(F.lit("profile "), p, F.lit(" != header "), h)),
            F.when(differ, F.concat(F.lit("cover says '"), F.col("cover_text"), F.lit("'"), F.when(same_land, F.lit(" (same country)")).otherwise(F.lit("")))),
        )
    )
    out = df.select(
        key,
        F.when(missing, F.nullif(F.col("header_code"), F.lit(""))).otherwise(F.col("incorporation_code")).alias("incorporation_code"),
        F.when(~missing, F.col("p_name")).when(by_header, F.col("h_name")).otherwise(F.col("cover_text")).alias("incorporation_name"),
        F.when(~missing, F.col("p_country")).when(by_header, F.col("h_country")).otherwise(F.col("t_country")).alias("incorporation_country"),
        F.when(addresses, F.array_join("cover_addresses", " | ")).otherwise(F.col("hq_address")).alias("hq_address"),
        F.when(addresses, "filing_cover").otherwise("edgar_profile").alias("hq_source"),
        "hq_country",
        dual.alias("dual_hq"),
        agreement.alias("incorporation_agreement"),
        iso_trap(p, F.col("p_name"), F.col("p_kind")).alias("iso_trap"),
        F.array_join(issues, "; ").alias("issues"),
    )
    bad = F.col("incorporation_agreement").isin("mismatch", "review") | F.col("dual_hq") | (F.col("iso_trap").isNotNull() & (F.col("incorporation_agreement") != "agree"))
    return out.withColumn("status", F.when(bad, "review").otherwise("ok"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "cik", watched: tuple[str, ...] = WATCHED, normal: tuple[str, ...] = WATCHED_NORMAL) -> DataFrame:
    """key, change_type, field, old_value and new_value: companies added and removed, and watched fields that changed.

    Null and '' are equal; fields in normal are compared by letters and digits alone.
    """
    fields = [*watched, *normal]
    side = lambda df, s: df.select(F.col(key), F.lit(True).alias(f"in_{s}"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"{f}_{s}") for f in fields])
    both = side(before, "old").join(side(after, "new"), key, "full_outer")
    test = lambda f: tx.normal_address(F.col(f"{f}_old")) != tx.normal_address(F.col(f"{f}_new")) if f in normal else F.col(f"{f}_old") != F.col(f"{f}_new")
    change = lambda kind, name, old, new: F.struct(F.lit(kind).alias("change_type"), F.lit(name).alias("field"), F.nullif(old, F.lit("")).alias("old_value"), F.nullif(new, F.lit("")).alias("new_value"))
    none = F.lit(None).cast("string")
    moved = F.array_compact(F.array(*[F.when(test(f), change("changed", f, F.col(f"{f}_old"), F.col(f"{f}_new"))) for f in fields]))
    rows = F.when(F.col("in_old").isNull(), F.array(change("added", "", none, none))).when(F.col("in_new").isNull(), F.array(change("removed", "", none, none))).otherwise(moved)
    return both.select(key, F.explode(rows).alias("c")).select(key, "c.*")

"""Tidy facts: contexts and units, cover tables, concept pivots.

A fact row has filing_key, ordinal (document order), concept, namespace, value,
dimensions (map axis -> member) and period columns.  "First" always means of
least ordinal, so results don't depend on partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.functions.text import class_label, clean_text, is_common, member_label, security_type, segment_string, to_float

CLASS_AXES = ("us-gaap:StatementClassOfStockAxis", "ifrs-full:ClassesOfShareCapitalAxis")
OTHER_AXES = ("dei:EntityListingsExchangeAxis", "dei:LegalEntityAxis")
SHARES = "EntityCommonStockSharesOutstanding"
_LISTING = {"security_title": "Security12bTitle", "trading_symbol": "TradingSymbol", "no_trading_symbol_flag": "NoTradingSymbolFlag", "exchange": "SecurityExchangeName", "trading_currency": "SecurityTradingCurrency", "par_value": "EntityListingParValuePerShare"}
#: Column of each entity-level concept; others go to the map extra.
ENTITY = {
    "registrant_name": "EntityRegistrantName",
    "cik_dei": "EntityCentralIndexKey",
    "document_type": "DocumentType",
    "period_end": "DocumentPeriodEndDate",
    "fiscal_year_focus": "DocumentFiscalYearFocus",
    "fiscal_period_focus": "DocumentFiscalPeriodFocus",
    "fiscal_year_end": "CurrentFiscalYearEndDate",
    "amendment_flag": "AmendmentFlag",
    "incorporation_state": "EntityIncorporationStateCountryCode",
    "tax_id": "EntityTaxIdentificationNumber",
    "file_number": "EntityFileNumber",
    "filer_category": "EntityFilerCategory",
    "current_reporting_status": "EntityCurrentReportingStatus",
    "interactive_data_current": "EntityInteractiveDataCurrent",
    "shell_company": "EntityShellCompany",
    "small_business": "EntitySmallBusiness",
    "emerging_growth_company": "EntityEmergingGrowthCompany",
    "address_line1": "EntityAddressAddressLine1",
    "address_line2": "EntityAddressAddressLine2",
    "address_city": "EntityAddressCityOrTown",
    "address_state": "EntityAddressStateOrProvince",
    "address_zip": "EntityAddressPostalZipCode",
    "phone_area_code": "CityAreaCode",
    "phone_local": "LocalPhoneNumber",
    "common_shares_outstanding": SHARES,
}


def with_contexts(facts: DataFrame, contexts: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Facts with the columns of their context and unit; a missing context leaves nulls and no dimensions."""
    out = facts.join(contexts, ["filing_key", "context_ref"], "left")
    if units is not None:
        out = out.join(units, ["filing_key", "unit_ref"], "left")
    dims = F.coalesce("dimensions", F.create_map().cast("map<string,string>"))
    return out.withColumn("dimensions", dims).withColumn("is_dimensioned", F.size("dimensions") > 0).withColumn("segment", segment_string(F.col("dimensions")))


def cover_facts(facts: DataFrame) -> DataFrame:
    """Facts of the cover namespace that belong to a filing."""
    return facts.where(F.col("namespace").contains("/dei/") & F.col("filing_key").isNotNull())


def first_value(value: Column, ordinal: Column, where: Column | None = None) -> Column:
    """The first non-null value."""
    good = value.isNotNull() if where is None else value.isNotNull() & where
    return F.min_by(F.when(good, value), F.when(good, ordinal))


def pivot_concepts(facts: DataFrame, periods: Sequence[str], consolidated_only: bool = True) -> DataFrame:
    """concept by period with the first value of each."""
    rows = facts.where(~F.col("is_dimensioned")) if consolidated_only else facts
    return rows.groupBy("concept").agg(*[first_value(F.col("value_num"), F.col("ordinal"), F.col("period") == p).alias(p) for p in periods])


def entity_facts(facts: DataFrame) -> DataFrame:
    """One row a filing of the entity-level cover facts that have no dimension."""
    rows = cover_facts(facts).where(~F.col("is_dimensioned") & ~F.col("concept").isin(*_LISTING.values())).withColumn("clean", clean_text(F.col("value")))
    held = F.array_sort(F.collect_list(F.when(F.col("clean").isNotNull(), F.struct("concept", "ordinal", "clean"))))
    first = F.filter("held", lambda x, i: (i == 0) | (x["concept"] != F.get("held", i - 1)["concept"]))
    known = F.map_from_entries(F.transform(first, lambda x: F.struct(x["concept"], x["clean"])))
    found = rows.groupBy("filing_key").agg(held.alias("held")).select("filing_key", known.alias("m"))
    value = lambda c: F.element_at("m", F.lit(c))
    columns = [(to_float(value(c)) if c == SHARES else value(c)).alias(n) for n, c in ENTITY.items()]
    extra = F.map_filter("m", lambda k, _: ~k.isin(*ENTITY.values()))
    return found.select("filing_key", *columns, F.concat(value("CityAreaCode"), F.lit("-"), value("LocalPhoneNumber")).alias("phone"), extra.alias("extra"))


def security_member(dimensions: Column, axes: Column) -> Column:
    """The member on the first canonical axis, else on the first other axis of axes; null if none."""
    other = F.get(F.filter(axes, lambda a: F.map_contains_key(dimensions, a)), F.lit(0))
    return F.coalesce(*[F.element_at(dimensions, F.lit(a)) for a in CLASS_AXES], F.element_at(dimensions, other))


def security_facts(facts: DataFrame) -> DataFrame:
    """One row a filing and listed security, with the company's share total attached to a sole common line that lacks shares."""
    rows = cover_facts(facts).withColumn("clean", clean_text(F.col("value")))
    listing = F.col("concept").isin(*_LISTING.values())
    w = Window.partitionBy("filing_key")
    axes = F.array_sort(F.array_except(F.array_distinct(F.flatten(F.collect_set(F.when(listing, F.map_keys("dimensions"))).over(w))), F.array(*map(F.lit, OTHER_AXES))))
    rows = rows.withColumn("axes", axes).withColumn("member", security_member(F.col("dimensions"), F.col("axes")))
    rows = rows.withColumn("undim_total", first_value(to_float(F.col("clean")), F.col("ordinal"), (F.col("concept") == SHARES) & F.col("member").isNull()).over(w))
    pick = lambda c: first_value(F.col("clean"), F.col("ordinal"), F.col("concept") == c)
    known = rows.groupBy("filing_key", "member", "undim_total").agg(
        F.min("ordinal").alias("first_ordinal"),
        *[pick(c).alias(n) for n, c in _LISTING.items()],
        to_float(pick(SHARES)).alias("shares"),
        F.bool_or(listing & F.col("clean").isNotNull()).alias("listed"),
    )
    built = known.where("member is not null or listed").withColumn("security_class", F.when(F.col("member").isNull(), class_label(F.col("security_title"))).otherwise(member_label(F.col("member"))))
    built = built.withColumn("security_type", security_type(F.col("member"), F.col("security_title"))).withColumn("shares_outstanding", F.when(F.col("member").isNull(), F.coalesce("shares", "undim_total")).otherwise(F.col("shares")))
    only_total = rows.where("undim_total is not null").groupBy("filing_key", "undim_total").agg(F.min("ordinal").alias("first_ordinal"))
    names = list(_LISTING)
    synthetic = only_total.join(built.select("filing_key").distinct(), "filing_key", "left_anti").select("filing_key", "undim_total", "first_ordinal", F.lit(None).cast("string").alias("member"), *[F.lit(None).cast("string").alias(n) for n in names], F.lit("CommonStock").alias("security_class"), F.lit("equity").alias("security_type"), F.col("undim_total").alias("shares_outstanding"))
    every = built.select(synthetic.columns).unionByName(synthetic)
    lacking = F.coalesce((F.col("security_type") == "equity") & is_common(F.col("security_class")) & F.col("shares_outstanding").isNull(), F.lit(False))
    every = every.withColumn("lacks", lacking).withColumn("n_lacking", F.sum(F.col("lacks").cast("int")).over(w))
    attached = F.when(F.col("lacks") & (F.col("n_lacking") == 1), F.col("undim_total")).otherwise(F.col("shares_outstanding"))
    return every.select("filing_key", "member", "security_class", "security_type", *names, attached.alias("shares_outstanding"), "first_ordinal")


def cover_pages(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, securities)."""
    return entity_facts(facts), security_facts(facts)

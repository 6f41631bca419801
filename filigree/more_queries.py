"""Queries of everyday operations, of readers over generated files, and of the reviewed store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree import data
from filigree.functions import text as tx
from filigree.operators import derived, facts, idioms, manifest
from filigree.queries import _FILINGS_SQL, _STORE_SQL, _day, _filings, _query, _spread, _store, _table, _values
from filigree.sources import landing

# ---- everyday operations

@_query("select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::bigint as q, (l_quantity::bigint * 3 + l_linenumber) % 7 as m, l_quantity::bigint // 5 as whole, l_quantity >= 25 and not l_returnflag = 'N' as both, l_quantity < 3 or l_linenumber = 1 as either, l_quantity::bigint::varchar as s, l_partkey::double / 4 as quarter, try_cast(l_returnflag as int) as bad from lineitem")
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arithmetic, comparison, boolean logic and casts."""
    q, n = F.col("l_quantity").cast("bigint"), F.col("l_linenumber")
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", q.alias("q"), ((q * 3 + n) % 7).alias("m"), F.floor(q / 5).alias("whole"), ((F.col("l_quantity") >= 25) & ~(F.col("l_returnflag") == "N")).alias("both"), ((F.col("l_quantity") < 3) | (n == 1)).alias("either"), q.cast("string").alias("s"), (F.col("l_partkey").cast("double") / 4).alias("quarter"), F.col("l_returnflag").try_cast("int").alias("bad"))


_LISTS_SQL = "lists as (select o_custkey as k, list(o_orderkey order by o_orderkey) as a from orders group by 1)"


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("a"))


def _joined(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@_query(f"with {_LISTS_SQL} select k, a[1] as first, a[-1] as last, array_to_string(a[2:3], ',') as slice, array_to_string(list_append(a, 0), ',') as appended, array_to_string(list_reverse_sort(a), ',') as sorted, len(a)::int as n, list_sum(a)::bigint as total, list_min(a) as least, list_max(a) as most from lists")
def list_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("a", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return _lists(spark, sf_dir).select("k", F.element_at("a", 1).alias("first"), F.element_at("a", -1).alias("last"), _joined(F.slice("a", 2, 2)).alias("slice"), _joined(F.array_append("a", F.lit(0))).alias("appended"), _joined(F.sort_array("a", False)).alias("sorted"), F.size("a").alias("n"), total.alias("total"), F.array_min("a").alias("least"), F.array_max("a").alias("most"))


@_query("""with c as (select user_id, event_type, count(*) as n from events group by 1, 2), s as (select user_id, list({'k': event_type, 'v': n} order by event_type) as e from c group by 1)
select user_id, list_filter(e, lambda x: x.k = 'click')[1].v as clicks, coalesce(list_filter(e, lambda x: x.k = 'none')[1].v, 0) as none, array_to_string(list_transform(e, lambda x: x.k), ',') as keys, list_sum(list_transform(e, lambda x: x.v))::bigint as total, array_to_string(list_transform(e, lambda x: x.k || '=' || x.v), ',') || ',extra=1' as merged from s""")
def dictionary_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("m"))
    merged = F.map_concat("m", F.create_map(F.lit("extra"), F.lit(1).cast("bigint")))
    return maps.select("user_id", F.try_element_at("m", F.lit("click")).alias("clicks"), F.coalesce(F.try_element_at("m", F.lit("none")), F.lit(0)).alias("none"), F.array_join(F.map_keys("m"), ",").alias("keys"), F.aggregate(F.map_values("m"), F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"), F.array_join(F.transform(F.map_entries(merged), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("merged"))


@_query("select c_custkey, c_name || '/' || c_nationkey as joined, c_nationkey + 1 as next from customer")
def tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named tuples, their fields, and a copy with one replaced."""
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("t"))
    return rows.withColumn("u", F.col("t").withField("nation", F.col("t.nation") + 1)).select("c_custkey", F.concat("t.name", F.lit("/"), "t.nation").alias("joined"), F.col("u.nation").alias("next"))


@_query("""select p_partkey, upper(p_name) as up, lower(p_type) as low, trim('  ' || p_name || ' ') as bare, replace(p_name, 'a', '@') as replaced, string_split(p_type, ' ')[-1] as word, array_to_string(string_split(p_type, ' '), '-') as dashed, instr(p_type, 'A')::int as at, length(p_type) - length(replace(p_type, 'E', '')) as es,
  starts_with(p_type, 'S') as starts, regexp_full_match(p_partkey::varchar, '[0-9]+') as digits, printf('%05d|%s', p_partkey, left(p_name, 3)) as formatted, repeat('ab', (p_partkey % 4)::int) as repeated from part""")
def string_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("p_type")
    return _table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower(t).alias("low"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("bare"), F.replace("p_name", F.lit("a"), F.lit("@")).alias("replaced"), F.element_at(F.split(t, " "), -1).alias("word"), F.array_join(F.split(t, " "), "-").alias("dashed"), F.instr(t, "A").alias("at"),
        (F.length(t) - F.length(F.replace(t, F.lit("E"), F.lit("")))).cast("bigint").alias("es"), t.startswith("S").alias("starts"), F.col("p_partkey").cast("string").rlike("^[0-9]+$").alias("digits"), F.format_string("%05d|%s", "p_partkey", F.left("p_name", F.lit(3))).alias("formatted"), F.repeat(F.lit("ab"), (F.col("p_partkey") % 4).cast("int")).alias("repeated"),
    )


@_query(f"with {_LISTS_SQL} select k, array_to_string(list_transform(list_filter(a, lambda x: x % 2 = 0), lambda x: x * x), ',') as squares, len(list_distinct(list_transform(a, lambda x: x % 10)))::int as digits, array_to_string(list_transform(a, lambda x: x // 4), ',') as nested from lists")
def comprehensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.filter("a", lambda x: x % 2 == 0)
    nested = F.transform("a", lambda x: F.floor(x / 4))
    return _lists(spark, sf_dir).select("k", _joined(F.transform(even, lambda x: x * x)).alias("squares"), F.size(F.array_distinct(F.transform("a", lambda x: x % 10))).alias("digits"), _joined(nested).alias("nested"))


@_query("with recursive f(i, a, b) as (select 0, 0::bigint, 1::bigint union all select i + 1, b, a + b from f where i < 60) select p_partkey, a as fibonacci from part join f on i = p_partkey % 61")
def fibonacci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", idioms.fibonacci((F.col("p_partkey") % 61).cast("int")).alias("fibonacci"))


@_query("with recursive f(i, a) as (select 0, 1::bigint union all select i + 1, a * (i + 1) from f where i < 20) select p_partkey, a as by_product, a as built_in from part join f on i = p_partkey % 21")
def factorials(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("p_partkey") % 21).cast("int")
    return _table(spark, sf_dir, "part").select("p_partkey", idioms.factorial(n).alias("by_product"), F.factorial(n).alias("built_in"))


@_query("select o_orderkey, round(o_custkey / nullif(o_orderkey % 5, 0), 6) as ratio, coalesce(try_cast(case when o_orderkey % 3 = 0 then 'x' else o_orderkey::varchar end as bigint), -1) as number from orders")
def safe_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Division by zero and failed casts give null or a default."""
    text = F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(F.col("o_orderkey").cast("string"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.round(idioms.divided(F.col("o_custkey"), F.col("o_orderkey") % 5), 6).alias("ratio"), F.coalesce(text.try_cast("bigint"), F.lit(-1).cast("bigint")).alias("number"))


@_query("select n_regionkey, array_to_string(list(n_name order by length(n_name), n_name), ',') as by_length, array_to_string(list(n_name order by n_name desc), ',') as falling from nation group by 1")
def sort_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("a"))
    by = F.transform(F.array_sort(F.transform("a", lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))), lambda s: s["x"])
    return names.select("n_regionkey", F.array_join(by, ",").alias("by_length"), F.array_join(F.sort_array("a", False), ",").alias("falling"))


@_query(f"with {_LISTS_SQL} select k, list_contains(a, k) as held, len(list_filter(a, lambda x: x < k * 4))::int as place, coalesce(list_position(a, a[(len(a) + 1) // 2]), 0)::int - 1 as middle, -1 as absent from lists")
def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership, place of insertion and binary search."""
    middle = F.element_at("a", F.floor((F.size("a") + 1) / 2).cast("int"))
    return _lists(spark, sf_dir).select("k", F.array_contains("a", F.col("k")).alias("held"), idioms.bisect_left(F.col("a"), F.col("k") * 4).alias("place"), idioms.binary_search(F.col("a"), middle).alias("middle"), idioms.binary_search(F.col("a"), F.lit(-5)).alias("absent"))


@_query(f"with {_LISTS_SQL} select k, list_sum(list_transform(a, lambda x: x % 3))::bigint as mapped, len(list_filter(a, lambda x: x % 3 = 0))::int as filtered, list_max(a) as reduced, len(list_filter(a, lambda x: x % 7 = 0)) > 0 as any_, len(list_filter(a, lambda x: x <= k)) = 0 as all_ from lists")
def higher_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """map, filter, reduce, any and all."""
    k, zero = F.col("k"), F.lit(0).cast("bigint")
    return _lists(spark, sf_dir).select("k", F.aggregate(F.transform("a", lambda x: x % 3), zero, lambda s, x: s + x).alias("mapped"), F.size(F.filter("a", lambda x: x % 3 == 0)).alias("filtered"), F.reduce("a", zero, lambda s, x: F.greatest(s, x)).alias("reduced"), F.exists("a", lambda x: x % 7 == 0).alias("any_"), F.forall("a", lambda x: x > k).alias("all_"))


@_query(r"select doc_id, regexp_extract(text, '[A-Z][a-z]+') as first, len(regexp_extract_all(text, '[0-9]+'))::int as numbers, length(regexp_replace(text, '[aeiou]', '', 'g')) as without_vowels, len(regexp_split_to_array(text, '[,;]'))::int as parts from documents")
def regular_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract(t, "[A-Z][a-z]+", 0).alias("first"), F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), 0)).alias("numbers"), F.length(F.regexp_replace(t, "[aeiou]", "")).cast("bigint").alias("without_vowels"), F.size(F.split(t, "[,;]")).alias("parts"))


@_query("select o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') as built, strftime(o_orderdate, '%d.%m.%Y') as shown, strftime(try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') as parsed, strftime(o_orderdate::date + 45, '%Y-%m-%d') as later, (o_orderdate::date - date '1992-01-01')::int as days, strftime(o_orderdate::date::timestamp - interval 5 hour, '%Y-%m-%d %H:%M') as there from orders")
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.make_date(F.year(d), F.month(d), F.lit(1)).cast("string").alias("built"), F.date_format(d, "dd.MM.yyyy").alias("shown"), F.try_to_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").cast("string").alias("parsed"), F.date_add(d, 45).cast("string").alias("later"), F.date_diff(d, F.lit("1992-01-01").cast("date")).alias("days"), F.date_format(F.from_utc_timestamp(d.cast("timestamp"), "-05:00"), "yyyy-MM-dd HH:mm").alias("there"))


@_query(f"with {_LISTS_SQL} select k, abs(k - 700)::bigint as distance, round(k / 7.0, 2)::double as rounded, pow(k % 10, 3)::double as cube, k // 7 as quotient, k % 7 as remainder, array_to_string(list_transform(a, lambda x, i: (i - 1) || ':' || x), ',') as numbered, array_to_string(list_reverse(a), ',') as backwards, sqrt(k)::double as root, ceil(k / 7.0)::bigint as up, floor(k / 7.0)::bigint as down from lists")
def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """abs, round, pow, divmod, enumerate, reversed, sqrt, ceil and floor."""
    k = F.col("k")
    return _lists(spark, sf_dir).select("k", F.abs(k - 700).cast("bigint").alias("distance"), F.round(k / 7.0, 2).alias("rounded"), F.pow(k % 10, F.lit(3)).alias("cube"), F.floor(k / 7).alias("quotient"), (k % 7).alias("remainder"), F.array_join(F.transform("a", lambda x, i: F.concat(i.cast("string"), F.lit(":"), x.cast("string"))), ",").alias("numbered"), _joined(F.reverse("a")).alias("backwards"), F.sqrt(k).alias("root"), F.ceil(k / 7).alias("up"), F.floor(k / 7).alias("down"))


@_query("select a.n_regionkey, a.n_name as a, b.n_name as b from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_name <> b.n_name")
def permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idioms.permutations(_table(spark, sf_dir, "nation"), "n_regionkey", "n_name")


# ---- readers

@_query("select o_orderkey::varchar as filing_key, 'ordinal' || 0 as kind, 0::int as ordinal, 'Revenue' as concept, (o_orderkey * 3)::varchar as value, (o_orderkey * 3)::double as value_num, 'USD/shares' as unit, strftime(o_orderdate, '%Y-%m-%d') as period, 'instant' as period_type, nullif(o_custkey::varchar, '0') as entity_cik, 'us:ClassAxis=us:A' || (o_custkey % 3) as segment, true as is_dimensioned, false as is_nil from orders union all select o_orderkey::varchar, 'ordinal1', 1, 'DocumentType', case when o_orderkey % 4 = 0 then null else '10-K' end, null, null, strftime(o_orderdate, '%Y-%m-%d') || '/2030-01-01', 'duration', nullif(o_custkey::varchar, '0'), '', false, o_orderkey % 4 = 0 from orders")
def instance_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged instances of two facts an order, with contexts, a divided unit, dimensions and nil values."""
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), _day("o_orderdate")
    who = F.concat(F.lit("<entity><identifier scheme='s'>00"), c, F.lit("</identifier>"))
    xml = F.concat(
        F.lit("<xbrl xmlns='http://www.xbrl.org/2003/instance' xmlns:d='http://xbrl.org/2006/xbrldi' xmlns:u='http://fasb.org/us-gaap/2024' xmlns:e='http://xbrl.sec.gov/dei/2024' xmlns:xsi='http://www.w3.org/2001/XMLSchema-instance'><!-- two facts --><context id='a'>"), who, F.lit("<segment><d:explicitMember dimension='us:ClassAxis'>us:A"), c % 3, F.lit("</d:explicitMember></segment></entity><period><instant>"), day, F.lit("</instant></period></context><context id='b'>"), who, F.lit("</entity><period><startDate>"), day,
        F.lit("</startDate><endDate>2030-01-01</endDate></period></context><unit id='x'><divide><unitNumerator><measure>iso:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit><u:Revenue contextRef='a' unitRef='x' decimals='0'> "), k * 3, F.lit(" </u:Revenue><e:DocumentType contextRef='b'"), F.when(k % 4 == 0, " xsi:nil='true'/>").otherwise(">10-K</e:DocumentType>"), F.lit("</xbrl>"),
    )
    found = landing.instances(_spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey").select(k.alias("filing_key"), xml.cast("binary").alias("content")))
    return found.select("filing_key", F.concat(F.lit("ordinal"), "ordinal").alias("kind"), "ordinal", "concept", "value", "value_num", "unit", "period", "period_type", "entity_cik", "segment", "is_dimensioned", "is_nil")


@_query("select c_custkey, c_name || case c_custkey % 3 when 0 then ' é' when 1 then ' “x”' else ' ' || chr(129) end as text from customer")
def charset_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes as UTF-8, Windows-1252 or Latin-1."""
    k = F.col("c_custkey")
    tail = F.when(k % 3 == 0, F.unhex(F.lit("20C3A9"))).when(k % 3 == 1, F.unhex(F.lit("20937894"))).otherwise(F.unhex(F.lit("2081")))
    raw = F.concat(F.encode("c_name", "UTF-8"), tail)
    return _table(spark, sf_dir, "customer").select("c_custkey", landing.decoded_text(raw).alias("text"))


@_query("select distinct strftime(o_orderdate, '%Y-%m-%d') as idx_date, year(o_orderdate) || '-QTR' || quarter(o_orderdate) as quarter, 'master.' || strftime(o_orderdate, '%Y%m%d') || '.idx' as file from orders where o_orderdate::date between '1993-01-01' and '1996-06-30'")
def index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files of the quarters' listings within explicit dates."""
    d = F.col("o_orderdate").cast("date")
    names = F.array(F.concat(F.lit("master."), F.date_format(d, "yyyyMMdd"), F.lit(".idx")), F.concat(F.lit("form."), F.date_format(d, "yyyyMMdd"), F.lit(".idx")))
    items = _table(spark, sf_dir, "orders").select(landing.quarter_label(d).alias("quarter"), F.explode(names).alias("name")).distinct()
    listing = items.groupBy("quarter").agg(F.struct(F.collect_list(F.struct("name")).alias("item")).alias("directory"))
    return landing.index_files(listing, "1993-01-01", "1996-06-30")


@_query("select distinct 'https://www.sec.gov/Archives/edgar/daily-index/' || year(o_orderdate) || '/QTR' || quarter(o_orderdate) || '/index.json' as url from orders")
def quarter_listing_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(landing.quarter_listing_url(F.col("o_orderdate").cast("date")).alias("url")).distinct()


@_query("select o_orderkey, case o_orderkey % 3 when 0 then 'acc' || o_orderkey when 1 then 'url' || o_orderkey end as filing_key, case when o_orderkey % 4 = 0 then null else strftime(o_orderdate, '%Y-%m-%d') end as checked from orders")
def keys_and_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping keys of filings, and checked date arguments."""
    k = F.col("o_orderkey")
    accession = F.when(k % 3 == 0, F.concat(F.lit("acc"), k)).otherwise("")
    url = F.when(k % 3 < 2, F.concat(F.lit("url"), k))
    text = F.when(k % 8 == 0, "1995-02-30").when(k % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(_day("o_orderdate"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", landing.grouping_key(accession, url).alias("filing_key"), landing.checked_date(text).cast("string").alias("checked"))


@_query("select c_custkey as cik, c_name as entity_name, 'T' || c_custkey as ticker, case when c_custkey % 2 = 0 then 'NV' end as incorporation_code, c_custkey || ' Main St' || case when c_custkey % 3 = 0 then ', Floor 2' else '' end || ', City, 0' || c_nationkey as business_address, null::varchar as mailing_address, 'Old ' || c_custkey || '; Older' as former_names from customer")
def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrants out of submissions JSON."""
    k = F.col("c_custkey")
    address = F.struct(F.concat(k, F.lit(" Main St")).alias("street1"), F.when(k % 3 == 0, "Floor 2").otherwise("").alias("street2"), F.lit("City").alias("city"), F.concat(F.lit("0"), "c_nationkey").alias("zipCode"))
    whole = F.struct(F.format_string("%010d", k).alias("cik"), F.col("c_name").alias("name"), F.array(F.concat(F.lit("T"), k), F.lit("U")).alias("tickers"), F.when(k % 2 == 0, "NV").otherwise("").alias("stateOfIncorporation"), F.struct(address.alias("business")).alias("addresses"), F.array(F.struct(F.concat(F.lit("Old "), k).alias("name")), F.struct(F.lit("Older").alias("name"))).alias("formerNames"))
    parsed = _table(spark, sf_dir, "customer").select(F.from_json(F.to_json(whole), spark.createDataFrame([], landing.SUBMISSIONS).schema).alias("p")).select("p.*")
    return manifest.profile(parsed).select("cik", "entity_name", "ticker", "incorporation_code", "business_address", "mailing_address", "former_names")


@_query("select l_orderkey as filing_key, l_linenumber as ordinal, l_partkey, l_quantity, strftime(o_orderdate, '%Y-%m-%d') as period, case l_returnflag when 'N' then 'USD' when 'R' then 'shares' end as unit from lineitem join orders on l_orderkey = o_orderkey")
def facts_units_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filing_key"), F.lit("c").alias("context_ref"), F.col("l_returnflag").alias("unit_ref"), F.col("l_linenumber").alias("ordinal"), "l_partkey", "l_quantity")
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filing_key"), "o_orderdate")
    contexts = o.select("filing_key", F.lit("c").alias("context_ref"), _day("o_orderdate").alias("period"), F.create_map().cast("map<string,string>").alias("dimensions"))
    units = o.select("filing_key", F.inline(F.array(F.struct(F.lit("N").alias("unit_ref"), F.lit("USD").alias("unit")), F.struct(F.lit("R").alias("unit_ref"), F.lit("shares").alias("unit")))))
    return facts.with_contexts(rows, contexts, units).select("filing_key", "ordinal", "l_partkey", "l_quantity", "period", "unit")


# ---- derived facts and the store

@_query("select c_custkey, case when c_custkey % 3 = 0 then 0.5 else 2 + c_custkey % 4 end::double as ratio, 'regex-text' as method, case when c_custkey % 3 = 0 then '2 ADS : 1 ordinary shares' else '1 ADS : ' || (2 + c_custkey % 4) || ' ordinary shares' end as display from customer where c_custkey % 5 <> 0 union all select c_custkey, null, null, null from customer where c_custkey % 5 = 0")
def prose_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without a ratio, whose filings' prose states it."""
    k = F.col("c_custkey")
    words = F.get(F.array(*map(F.lit, ("two", "three", "four", "five"))), (k % 4).cast("int"))
    said = F.concat(F.lit("We are a company. Each American Depositary Share represents "), F.when(k % 3 == 0, "one-half of one ordinary share").otherwise(F.concat(words, F.lit(" ordinary shares"))), F.lit(" of ours. Holders hold 5% of it."))
    text = F.when(k % 5 == 0, "Nothing is stated here about ratios.").otherwise(said)
    c = _table(spark, sf_dir, "customer").select("c_custkey", k.cast("string").alias("accession_number"), text.alias("text"))
    securities = c.select("c_custkey", "accession_number", F.lit("American Depositary Shares").alias("security_title"), F.lit(None).cast("string").alias("security_class"))
    out = derived.adr_ratios(securities, c.select("accession_number", "text"))
    return out.select("c_custkey", F.col("shares_per_ads").alias("ratio"), "method", F.regexp_replace("display", " ordinary.*| of ours.*| shares$", " ordinary shares").alias("display"))


@_query("select c_custkey as cik, 'Class ' || x.c as class_label, round(case x.c when 'A' then (2 + c_custkey % 3) else (2 + c_custkey % 3) / 10000.0 end::double, 6) as votes, case when x.c = 'A' and c_custkey % 2 = 0 then 'review' else 'high' end as confidence from customer, (values ('A'), ('B')) x(c)")
def relative_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of one class as a share of another's; a second source doesn't count, a second number asks for review."""
    k = F.col("c_custkey")
    n = F.get(F.array(*map(F.lit, ("two", "three", "four"))), (k % 3).cast("int"))
    first = F.concat(F.lit("Our Class A common stock has "), n, F.lit(" votes per share. Each share of Class B Common Stock has 1/10,000 of the voting rights of a share of Class A Common Stock."), F.when(k % 2 == 0, " Once Class A common stock had nine votes per share.").otherwise(""))
    texts = _spread(_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select(k.alias("cik"), F.inline(F.array(F.struct(F.lit(0).alias("source_rank"), first.alias("text")), F.struct(F.lit(1).alias("source_rank"), F.lit("Class C common stock has seven votes per share.").alias("text")))))
    return derived.voting_rights(texts).select("cik", "class_label", F.round("votes_per_share", 6).alias("votes"), "confidence")


@_query("select c_custkey, case c_custkey % 3 when 0 then 'Tech / Software' when 1 then '1 ADS : 2 shares' else 'Class A = 10' end as headline, case when c_custkey % 2 = 0 then 'Energy > Oil' else 'Energy > Gas > Oil' end as path, case c_custkey % 4 when 0 then 'approved' when 1 then 'edited' else 'pending' end as status from customer")
def displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines by kind, paths without repeated names, and review states."""
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "icb").when(k % 3 == 1, "adr").otherwise("voting")
    payload = F.when(k % 3 == 0, '{"sector":"Tech","industry":"Software"}').when(k % 3 == 1, '{"display":"1 ADS : 2 shares"}').otherwise('{"class_label":"Class A","votes_per_share":"10"}')
    rows = _table(spark, sf_dir, "customer").withColumns({"a": F.lit("Energy"), "b": F.when(k % 2 == 0, "Energy").otherwise("Gas"), "c": F.lit("Oil")})
    asked = F.when(k % 4 == 0, "approved").when(k % 4 == 1, "edited").when(k % 4 == 2, "odd")
    return rows.select("c_custkey", derived.headline(kind, payload).alias("headline"), derived.path(rows, "a", "b", "c").alias("path"), derived.review_status(asked).alias("status"))


@_query(f"with {_STORE_SQL} select cik, count(*) as n_facts, count(*) filter (status = 'pending') as n_pending from store group by cik")
def company_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.company_counts(_store(spark, sf_dir))


@_query(f"with {_STORE_SQL} select cik, status, updated_utc from store order by updated_utc desc, cik limit 14")
def recent_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature."""
    return derived.recent_facts(_store(spark, sf_dir)).select("cik", "status", "updated_utc")


@_query(f"with t(ic, i, sc, s, ec, e, uc, u) as (values {_values(data.industries())}) select p_partkey, sector, count(distinct uc)::int as n, string_agg(distinct uc, ',' order by uc) as codes from (select p_partkey, (select list(distinct ec order by ec) from t)[(p_partkey % 45 + 1)::int] as sector from part) join t on ec = sector group by 1, 2")
def sector_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subsectors of a sector."""
    codes = F.array(*[F.lit(c) for c in sorted({r[4] for r in data.industries()})])
    rows = _table(spark, sf_dir, "part").select("p_partkey", F.get(codes, (F.col("p_partkey") % 45).cast("int")).alias("sector"))
    found = derived.subsectors_of(rows, "sector")
    return found.select("p_partkey", "sector", F.size("subsectors").alias("n"), F.array_join(F.transform("subsectors", lambda s: s["code"]), ",").alias("codes"))


@_query(f"with {_FILINGS_SQL} select accession_number, form_type, filing_date from filings where accession_number = (select min(accession_number) from filings)")
def filing_by_accession(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _filings(spark, sf_dir)
    wanted = f.agg(F.min("accession_number").alias("accession_number"))
    return f.join(F.broadcast(wanted), "accession_number").select("accession_number", "form_type", "filing_date")  # one row


@_query(f"with {_FILINGS_SQL} select accession_number, form_type, filing_date from filings order by filing_date desc, accession_number limit 60")
def newest_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a list of filings; the limit is the feature."""
    return manifest.filings(_filings(spark, sf_dir)).limit(60).select("accession_number", "form_type", "filing_date")


@_query(r"""select page_id, case when regexp_matches(html, '(?i)<head(\s[^>]*)?>') then regexp_replace(html, '(?i)(<head(\s[^>]*)?>)', '\1<base href="http://x/">') else '<base href="http://x/">' || html end as html from pages""")
def base_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", tx.with_base(F.col("html"), F.lit("http://x/")).alias("html"))

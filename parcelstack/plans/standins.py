"""Domain feeds derived from the driver's TPC-H-style tables.

The driver only provides generic tables, so each property-record feed is a
deterministic projection of one of them (joins and aggregates where a feed
needs them). The column expressions are SQL text shared by the Spark build
(`F.expr`) and the DuckDB oracle, with a tiny dialect map for the four
functions whose names differ. Row counts grow with the input tables; no
row subset, cap or sample is taken.

| feed              | from                         | shape                                   |
|-------------------|------------------------------|-----------------------------------------|
| raw parcels       | orders x customer x nation   | one row per order; pid = customer       |
| tax cases         | orders                       | two listings with different columns     |
| foreclosures      | supplier                     | address-keyed sale notices              |
| estates           | orders x customer            | decedent names in five spellings        |
| code cases        | events                       | pid = user id, status from event type   |
| demolitions       | supplier                     | pid = supplier key                      |
| instruments       | lineitem                     | twelve type texts, dashed parcel ids    |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..sources import feeds as FD
from ..sources import ingest

# Functions whose names differ between Spark SQL and DuckDB.
DIALECTS = {
    "spark": {
        "ms": "cast(unix_millis(cast({x} as timestamp)) as string)",
        "bdy": "date_format({x}, 'MMM d, yyyy')",
        "mdy": "date_format({x}, 'MM/dd/yyyy')",
        "pad6": "format_string('%06d', {x})",
    },
    "duckdb": {
        "ms": "cast(epoch_ms({x}) as string)",
        "bdy": "strftime({x}, '%b %-d, %Y')",
        "mdy": "strftime({x}, '%m/%d/%Y')",
        "pad6": "printf('%06d', {x})",
    },
}


def _d(dialect: str, fn: str, x: str) -> str:
    return DIALECTS[dialect][fn].format(x=x)


def lettered(x: str, dialect: str) -> str:
    """A surname unique per key: the key, zero-padded to 6+ digits, spelled A-J."""
    return f"translate({_d(dialect, 'pad6', x)}, '0123456789', 'ABCDEFGHIJ')"


def dashed(x: str) -> str:
    """Parcel id as printed on listings: ddd-ddd-dd of the 8-padded key (longer keys keep all digits)."""
    p = f"({pid8(x)})"
    return f"substr({p}, 1, 3) || '-' || substr({p}, 4, 3) || '-' || substr({p}, 7)"


def pid8(x: str) -> str:
    return f"CASE WHEN length(cast({x} as string)) < 8 THEN lpad(cast({x} as string), 8, '0') ELSE cast({x} as string) END"


def money(x: str) -> str:
    return f"cast(cast(floor({x}) as bigint) as string)"


# ------------------------------------------------------------------ raw parcels
def parcel_exprs(dialect: str) -> dict[str, str]:
    """Over orders o, customer c, nation n and per-customer total `tot_price`."""
    L = lettered("c_custkey", dialect)
    # two parcels (units) to an address, however many customers there are
    num = "cast(cast(floor(c_custkey / 2) as bigint) as string)"
    ward = "'WARD ' || cast(cast(floor(c_custkey / 2) as bigint) % 25 as string)"
    first = "c_mktsegment || ' ' || chr(cast(65 + c_nationkey as int))"
    return {
        "objectid_1": "o_orderkey",
        "pid": pid8("o_custkey"),
        "nc_pin": "cast(o_custkey * 7 as string)",
        "address": f"{num} || ' ' || {ward} || ' STREET ANYTOWN NC'",
        "streetnumber": num,
        "streetname": f"{ward} || ' STREET'",
        "loccity": "'ANYTOWN'",
        "ownrfrstnme": (f"CASE WHEN c_acctbal < 0 THEN '' WHEN c_custkey % 7 = 0 THEN {first} || ' JR' "
                        f"ELSE {first} END"),
        "ownrlstnme": f"CASE WHEN c_acctbal < 0 THEN {L} || ' HOLDINGS LLC' ELSE {L} END",
        "ownr2frstnme": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PARTNER' ELSE '' END",
        "ownr2lstnme": f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN {L} ELSE '' END",
        "mailaddr1": (f"CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'PO BOX ' || cast(c_custkey as string) "
                      f"WHEN c_mktsegment = 'MACHINERY' THEN {num} || ' ' || {ward} || ' AVE' "
                      f"ELSE {num} || ' ' || {ward} || ' STREET' END"),
        "mailaddr2": "''",
        "city": "'ANYTOWN'",
        "state": "'NC'",
        "zipcode": "'28200'",
        "bldgtype": "'SFR'",
        "landuse_description": "'SINGLE FAMILY RESIDENTIAL'",
        "lusecode": "'R100'",
        "grade": "'AVERAGE'",
        "storyheight": "'1 STORY'",
        "vacorimprov": "CASE WHEN c_acctbal < 500 THEN 'VACANT' ELSE 'IMPROVED' END",
        "ownertyped": ("CASE WHEN c_acctbal < 0 THEN 'CORPORATION' WHEN c_mktsegment = 'BUILDING' THEN '' "
                       "ELSE 'INDIVIDUAL' END"),
        "exemption": ("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOMESTEAD ELDERLY' "
                      "WHEN c_mktsegment = 'FURNITURE' THEN 'DISABLED VETERAN' "
                      "WHEN c_mktsegment = 'BUILDING' THEN 'DISABLED' ELSE '' END"),
        "typeofdeed": "'DEED'",
        "validsale": "CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END",
        "deed_book": "cast(o_orderkey % 9000 as string)",
        "deed_page": "cast(o_orderkey % 500 as string)",
        "neighborhood": "'NB' || cast(c_nationkey as string)",
        "neighbordesc": "n_name",
        "taxmundist": "'ANYTOWN'",
        "yearbuilt": "cast(1900 + c_custkey % 120 as string)",
        "heatedarea": "cast(1000 + c_custkey % 2000 as string)",
        "bedrooms": "cast(1 + c_custkey % 5 as string)",
        "totmarkval": f"CASE WHEN c_custkey % 11 = 0 THEN '' ELSE {money('tot_price / 4')} END",
        "totalvalue": money("tot_price / 5"),
        "totlandval": money("abs(c_acctbal) * 10"),
        "totalbldgval": money("tot_price / 8"),
        "saleprice": f"CASE WHEN o_orderkey % 50 = 0 THEN '0' ELSE {money('o_totalprice')} END",
        "saledate": _d(dialect, "ms", "o_orderdate"),
    }


def tax_a_exprs(dialect: str) -> dict[str, str]:
    """Listing A (orders of any status but P): parcel in the cell."""
    return {
        "_source": "'kania'",
        "county": ("CASE WHEN o_orderkey % 10 = 0 THEN 'Union' WHEN o_orderkey % 10 = 1 THEN '' "
                   "ELSE 'Mecklenburg' END"),
        "courtfile": "'24CVD' || cast(o_orderkey as string)",
        "address": "'PARCEL ' || cast(o_custkey as string) || ' ANYTOWN NC'",
        "street": "'PARCEL ' || cast(o_custkey as string)",
        "city": "'ANYTOWN NC'",
        "addressparcel_raw": dashed("o_custkey"),
        "saledate": "cast(cast(o_orderdate as date) as string)",
        "tax_value": "'$' || " + money("o_totalprice"),
        "openingbid": "'$' || " + money("o_totalprice / 10"),
        "ourfilenbr": "'F' || cast(o_orderkey as string)",
        "_row": "o_orderkey",
    }


def tax_b_exprs(dialect: str) -> dict[str, str]:
    """Listing B (orders with status P): parcel = order key."""
    return {
        "_source": "'rbcwb'",
        "county": "'Mecklenburg'",
        "courtfile": "'24CVD' || cast(o_orderkey as string)",
        "address": "'LOT ' || cast(o_orderkey as string)",
        "name": "'OWNER ' || cast(o_custkey as string)",
        "zip": "'28200'",
        "addressparcel": "cast(o_orderkey as string)",
        "status": "'OPEN'",
        "_row": "o_orderkey + 1000000000000",
    }


def foreclosure_exprs(dialect: str) -> dict[str, str]:
    """Over supplier s."""
    num, ward = "cast(s_suppkey as string)", "'WARD ' || cast(s_suppkey % 25 as string)"
    day = "cast(s_suppkey % 200 as int)"
    return {
        "detail_id": "s_suppkey",
        "detail_url": "'https://notices.example/detail?id=' || cast(s_suppkey as string)",
        "posted_date": f"cast(DATE '2001-01-01' + {day} as string)",
        "address": (f"CASE WHEN s_suppkey % 5 = 0 THEN {num} || ' ' || {ward} || ' St Unit 4, Anytown, NC, 28200' "
                    f"ELSE {num} || ' ' || {ward} || ' St, Anytown, NC, 28200' END"),
        "county": "CASE WHEN s_suppkey % 9 = 0 THEN 'Union' ELSE 'Mecklenburg' END",
        "auction_date": f"cast(DATE '2001-01-01' + cast(s_suppkey % 200 + 30 as int) as string)",
        "sp_case_number": ("CASE WHEN s_suppkey % 4 = 0 THEN '' "
                           "WHEN s_suppkey % 4 = 1 THEN '24SP' || cast(s_suppkey as string) "
                           "WHEN s_suppkey % 4 = 2 THEN '24CV' || cast(s_suppkey as string) "
                           "ELSE '23SP00' || cast(s_suppkey as string) END"),
        "deed_book": "cast(s_suppkey * 3 as string)",
        "deed_page": "cast(s_suppkey % 97 as string)",
        "summary": ("CASE WHEN s_suppkey % 6 = 0 THEN 'Tax foreclosure sale. ' "
                    "WHEN s_suppkey % 6 = 1 THEN 'Mecklenburg County, Plaintiff, against ' "
                    "WHEN s_suppkey % 6 = 2 THEN 'Sale under lien of Shoal Creek HOA against ' "
                    "WHEN s_suppkey % 6 = 3 THEN 'Mecklenburg County v. ' "
                    "ELSE 'Substitute trustee sale under deed of trust by ' END "
                    "|| s_name || ' recorded in Book ' || cast(s_suppkey * 3 as string) "
                    "|| ' at Page ' || cast(s_suppkey % 97 as string)"),
        "_row": "s_suppkey",
    }


def estate_exprs(dialect: str) -> dict[str, str]:
    """Over orders o, customer c (the decedent is the customer)."""
    L = lettered("c_custkey", dialect)
    seg, ini = "c_mktsegment", "chr(cast(65 + c_nationkey as int))"
    return {
        "detail_id": "o_orderkey",
        "detail_url": "'https://notices.example/probate?id=' || cast(o_orderkey as string)",
        "posted_date": (f"CASE WHEN o_orderkey % 3 = 0 THEN cast(cast(o_orderdate as date) as string) "
                        f"WHEN o_orderkey % 3 = 1 THEN {_d(dialect, 'bdy', 'o_orderdate')} "
                        f"ELSE {_d(dialect, 'mdy', 'o_orderdate')} END"),
        "heading": f"{L} || ', ' || {seg}",
        "decedent_name": (f"CASE WHEN o_orderkey % 5 = 0 THEN {seg} || ' ' || {ini} || ' ' || {L} "
                          f"WHEN o_orderkey % 5 = 1 THEN {L} || ', ' || {seg} || ' ' || {ini} "
                          f"WHEN o_orderkey % 5 = 2 THEN {seg} || ' ' || {L} "
                          f"WHEN o_orderkey % 5 = 3 THEN {L} "
                          f"WHEN {seg} = 'HOUSEHOLD' THEN 'PARTNER ' || {L} "
                          f"ELSE {seg} || ' SMITH' END"),
        "county": "CASE WHEN o_orderkey % 7 = 0 THEN 'Union' ELSE 'Mecklenburg' END",
        "case_number": "'24E' || cast(o_orderkey as string)",
        "summary": "'Notice to creditors of the estate of ' || c_name",
        "_source": "'mecktimes'",
        "_row": "o_orderkey",
    }


def code_case_exprs(dialect: str) -> dict[str, str]:
    """Over events: every event is a case on parcel user_id."""
    return {
        "OBJECTID": "event_id",
        "ParcelId": "cast(user_id as string)",
        "CaseNumber": "'HNS' || cast(event_id as string)",
        "CaseType": "CASE WHEN value > 250 THEN 'Housing' ELSE 'Nuisance' END",
        "CaseStatus": ("CASE WHEN event_type = 'error' THEN 'Open' WHEN event_type = 'signup' THEN 'New' "
                       "WHEN event_type = 'purchase' THEN 'Pending' ELSE 'Closed' END"),
        "FullAddress": "'CASE SITE ' || cast(user_id as string)",
        "DateCreated": "cast(cast(ts as date) as string)",
        "DateClosed": ("CASE WHEN event_type = 'click' OR event_type = 'view' "
                       "THEN cast(cast(ts as date) + 30 as string) ELSE '' END"),
        "Conclusion": "event_type",
        "_source": "'charlotte_hns'",
        "_row": "event_id",
    }


def code_demo_exprs(dialect: str) -> dict[str, str]:
    """Over supplier s: every supplier key is a parcel with a demolition order."""
    return {
        "OBJECTID": "s_suppkey",
        "ParcelId": "cast(s_suppkey as string)",
        "CaseNumber": "'DEMO' || cast(s_suppkey as string)",
        "CaseType": "'Demolition'",
        "CaseStatus": "'Open'",
        "FullAddress": "'CASE SITE ' || cast(s_suppkey as string)",
        "DateCreated": "cast(DATE '2001-01-01' + cast(s_suppkey % 200 as int) as string)",
        "_source": "'charlotte_demo'",
        "_row": "s_suppkey",
    }


def instrument_exprs(dialect: str) -> dict[str, str]:
    """Over lineitem l: twelve type texts from return flag, line status, line parity."""
    return {
        "_source": "'rod_csv_import'",
        "doc_type": ("CASE l_returnflag || l_linestatus || cast(l_linenumber % 2 as string) "
                     "WHEN 'AF0' THEN 'Deed of Trust' "
                     "WHEN 'AF1' THEN 'ASSIGNMENT OF DEED OF TRUST' "
                     "WHEN 'AO0' THEN 'Notice of Substitute Trustee Sale' "
                     "WHEN 'AO1' THEN 'Abstract of Judgment' "
                     "WHEN 'NF0' THEN 'Claim of Lien' "
                     "WHEN 'NF1' THEN 'Quit Claim Deed' "
                     "WHEN 'NO0' THEN 'Notice of Lis Pendens' "
                     "WHEN 'NO1' THEN 'Release of Lien' "
                     "WHEN 'RF0' THEN 'Satisfaction of Deed of Trust' "
                     "WHEN 'RF1' THEN 'satisfaction of judgment' "
                     "WHEN 'RO0' THEN 'HOA ASSN LIEN' "
                     "ELSE 'Mechanic''s Lien' END"),
        "recorded_date": "cast(cast(l_shipdate as date) as string)",
        "instrument_id": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
        "book": "cast(l_partkey as string)",
        "page": "cast(l_suppkey as string)",
        "grantor": "'GRANTOR ' || cast(l_suppkey as string)",
        "grantee": "'GRANTEE ' || cast(l_partkey as string)",
        "legal_description": "'LOT ' || cast(l_linenumber as string)",
        "amount": money("l_extendedprice"),
        "pid_raw": dashed("l_orderkey"),
        "_row": "l_orderkey * 8 + l_linenumber",
    }


# ------------------------------------------------------------------ markup, rendered from whole tables
# Long text in front of what the extractors look for, entities of all kinds.
FILLER = "repeat('lorem ipsum ', 200)"


def notice_page_expr(d: str) -> str:
    """Over supplier: a result page with the notice and a block without an id."""
    return (f"'<html><main><div class=\"col-md-11 pnsr-block odd\"><a href=\"?detail=' || cast(s_suppkey as string) || '\">x</a>' "
            f"|| '<span class=\"result-date\"> 2001-02-0' || cast(1 + s_suppkey % 9 as string) || ' </span>' "
            f"|| '<div class=\"notice-heading\">' || cast(s_suppkey as string) || ' O&rsquo;Hara St &#8211; Anytown, NC</div>' "
            f"|| '<div class=\"notice-summary\"><p>' || {FILLER} || '</p> CASE 24 SP ' || {_d(d, 'pad6', 's_suppkey')} || ' of ' || s_name "
            f"|| ' recorded in Book ' || cast(1 + s_suppkey % 900 as string) || ' at Page ' || cast(1 + s_suppkey % 90 as string) "
            f"|| CASE WHEN s_suppkey % 2 = 0 THEN ' &mdash; Tax foreclosure &amp;amp; sale' ELSE ' under lien of Shoal HOA' END || '</div>' "
            f"|| '<strong>County:</strong> Mecklenburg</b><strong>Auction Date:</strong> 2001-09-01 <' || '</div>' "
            f"|| '<div class=\"col-md-11 pnsr-block\">no id</div><div id=\"search-results-pagination\">1 2 3</div></main></html>'")


def estate_page_expr(d: str) -> str:
    """Over orders: a page with one estate notice; the name is in the text or only in the heading."""
    return (f"'<div class=\"col-md-11 pnsr-block\"><i>detail=' || cast(o_orderkey as string) || '</i>' "
            f"|| '<span class=\"result-date\">2001-03-01</span><div class=\"notice-heading\">D&rsquo;Arcy, Ann ' || {lettered('o_custkey', d)} || '</div>' "
            f"|| '<div class=\"notice-summary\">' || {FILLER} || CASE WHEN o_orderkey % 2 = 0 THEN ' claims against Jo Ann ' || {lettered('o_custkey', d)} "
            f"|| ', deceased' ELSE ' no name given' END || ' 24 E ' || {_d(d, 'pad6', 'o_custkey')} || '</div>' "
            f"|| '<strong>County:</strong> Union<' || '</main>'")


def listing_page_expr(d: str) -> str:
    """Over customer: a listing table with empty cells and entities."""
    return ("'<table class=\"t\"><tr><th>Name</th></tr><tr><td></td></tr><tr><td>O&rsquo;' || c_name || '</td><td> </td><td>' "
            "|| cast(c_custkey as string) || ' Elm &amp; Oak</td><td>28200</td><td>' || " + dashed("c_custkey")
            + " || '</td><td>24&#45;' || cast(c_custkey as string) || '</td><td><b>Open</b></td></tr></table>'")


def listing_json_expr(d: str) -> str:
    """Over customer: a listing payload with one row and one placeholder row."""
    return ("'[{\"value\":{\"addressparcel\":\"(parcel ' || cast(c_custkey as string) || ') ' || cast(c_custkey as string) "
            "|| ' O&rsquo;Hara Ct<br>Anytown<br>' || cast(c_custkey + 10000 as string) || '\",\"saletimetaxvalue\":\"10:00 AM<br>$1,200.50\",' "
            "|| '\"openingbid\":\"<b>$5</b>\",\"courtfile\":\"24CVD' || cast(c_custkey as string) || '\"}},{\"addressparcel\":\"&nbsp;\"}]'")


# ------------------------------------------------------------------ Spark side
def read_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{d}/{name}.parquet")


_t = read_table


def _sel(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(v).alias(k) for k, v in exprs.items()])


def _conform(df: DataFrame, schema, extra=("_row",)) -> DataFrame:
    """Select the feed schema (missing columns null) plus helper columns."""
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *[F.col(c) for c in extra if c in have])


def raw_parcels(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    tot = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("tot_price"))
    src = (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # 25 rows at any scale
            .join(tot, "o_custkey"))
    return _conform(_sel(src, parcel_exprs("spark")), FD.RAW_PARCEL)


def tax_cases(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    a = _sel(o.where("o_orderstatus <> 'P'"), tax_a_exprs("spark")) \
        .withColumn("pid_normalized", N.pid_digits("addressparcel_raw"))
    b = _sel(o.where("o_orderstatus = 'P'"), tax_b_exprs("spark")) \
        .withColumn("pid_normalized", N.pid_digits("addressparcel"))
    return ingest.union_listings(a, b, keep=("_row",))


def foreclosures(spark: SparkSession, d: str) -> DataFrame:
    return _conform(_sel(_t(spark, d, "supplier"), foreclosure_exprs("spark")), FD.FORECLOSURE)


def estates(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    return _conform(_sel(o.join(c, o.o_custkey == c.c_custkey), estate_exprs("spark")), FD.ESTATE)


def code_cases(spark: SparkSession, d: str) -> DataFrame:
    return _conform(_sel(_t(spark, d, "events"), code_case_exprs("spark")), FD.CODE_CASE)


def code_demos(spark: SparkSession, d: str) -> DataFrame:
    return _conform(_sel(_t(spark, d, "supplier"), code_demo_exprs("spark")), FD.CODE_CASE)


def instruments(spark: SparkSession, d: str) -> DataFrame:
    df = _sel(_t(spark, d, "lineitem"), instrument_exprs("spark"))
    df = (N.with_doctype_code(df)
            .withColumn("pid", N.pid_digits("pid_raw"))
            .withColumn("extra", F.create_map().cast("map<string,string>")))
    return _conform(df, FD.INSTRUMENT)


def feeds(spark: SparkSession, d: str) -> FD.Feeds:
    return FD.Feeds(
        parcels_raw=raw_parcels(spark, d),
        tax=tax_cases(spark, d),
        foreclosures=foreclosures(spark, d),
        estates=estates(spark, d),
        code_cases=code_cases(spark, d),
        code_demos=code_demos(spark, d),
        instruments=instruments(spark, d),
    )

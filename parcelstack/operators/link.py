"""Linking feeds to parcels.

Every feed row becomes zero or more *evidence* rows in one long table:

    pid, pattern, fires, flag, source, feed_rank, row_ord, rkey, detail, sale_ts

`pattern` set -> a signal in that pattern's list (it adds the pattern only
when `fires`); `flag` set -> one flag row (duplicates kept, they count). A
row may carry both. `feed_rank, row_ord` is the attachment order used to
break recency ties; `rkey` is the recency key (W2); `detail` is the signal
payload as map<string,string>.

The pid-keyed feeds (tax, code cases, demolition orders, instruments) are
unioned first and meet the parcel table in ONE join, so the parcel side is
scanned and shuffled once however many feeds there are. A filter of the pids
(`keyfilter`) goes first where one is given: rows that can meet no parcel are
not shuffled. Spark/AQE pick broadcast (measured size under the threshold) or
sort-merge, and split a skewed pid partition of the feed side at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import normalize as N
from .keyfilter import with_hit

EVIDENCE_COLS = ["pid", "pattern", "fires", "flag", "source", "feed_rank", "row_ord", "rkey", "detail", "sale_ts"]

FEED_RANK = {"tax": 1, "foreclosure": 2, "estate": 3, "code": 4, "demo": 5}
for _i, _code in enumerate(K.INSTRUMENT_ORDER):
    FEED_RANK["rod_" + _code] = 6 + _i
FEED_RANK["transfer"] = 6 + len(K.INSTRUMENT_ORDER)


def row_ord(df: DataFrame) -> Column:
    """A stable order of feed rows, the same wherever and however often a row
    is evaluated: a stored sequence `_row` when the feed has one, else its own
    id (notices and cases come in id order), else a hash of the whole row
    (listings and instruments carry no id; among such ties the order is
    arbitrary but fixed)."""
    for c in ("_row", "detail_id", "OBJECTID"):
        if c in df.columns:
            own = F.col(c).cast("long")
            break
    else:
        own = F.lit(None).cast("long")
    plain = [F.to_json(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes]
    return F.coalesce(own, F.xxhash64(*plain))


def detail_map(pairs: list[tuple[str, Column]]) -> Column:
    return F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))]).cast("map<string,string>")


def recency_key(pairs: list[tuple[str, Column]]) -> Column:
    """First non-empty of posted, auction, saledate, created, closed; else ''."""
    d = dict(pairs)
    cands = [N.nonblank(d[f].cast("string")) for f in K.RECENCY_FIELDS if f in d]
    return F.coalesce(*cands, F.lit("")) if cands else F.lit("")


def _ev(df: DataFrame, pattern, fires, flag, source, rank: int, pairs, order: Column | None = None, more: tuple = ()) -> DataFrame:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        F.col("pid"),
        lit(pattern).cast("string").alias("pattern"),
        lit(fires).cast("boolean").alias("fires"),
        lit(flag).cast("string").alias("flag"),
        lit(source).cast("string").alias("source"),
        F.lit(rank).alias("feed_rank"),
        (order if order is not None else F.col("_ord")).alias("row_ord"),
        recency_key(pairs).alias("rkey"),
        detail_map(pairs).alias("detail"),
        *([F.col("sale_ts")] if "sale_ts" in df.columns else [F.lit(None).cast("timestamp").alias("sale_ts")]),
        *more,
    )


def _county_is(col, allowed: list[str]) -> Column:
    return F.lower(N.clean(col)).isin(allowed)


# ------------------------------------------------------------------ pid-keyed feeds
def tax_candidates(tax: DataFrame, county: str = K.DEFAULT_COUNTY) -> DataFrame:
    """Tax cases of the county or with blank county, keyed by normalized pid."""
    t = tax.where(_county_is("county", [county, ""])).withColumn("_ord", row_ord(tax)) \
        .withColumn("pid", N.clean("pid_normalized"))
    pairs = [
        ("source", F.col("_source")),
        ("courtfile", F.coalesce(N.nonblank(F.col("courtfile")), F.col("ourfilenbr"))),
        ("saledate", F.col("saledate")), ("status", F.col("status")),
        ("openingbid", F.col("openingbid")), ("tax_value", F.col("tax_value")),
        ("name", F.col("name")),
        ("address", F.coalesce(N.nonblank(F.col("address")), F.col("street"))),
    ]
    return _ev(t, "tax", True, None, F.col("_source"), FEED_RANK["tax"], pairs)


def latest_case_rows(cases: DataFrame) -> DataFrame:
    """One row per case number, the highest object id (the `dedup_cases`
    option): a case whose status changed is counted once, in its last state.
    `row_number() = 1` runs as a partial group limit before the shuffle."""
    from pyspark.sql import Window
    w = Window.partitionBy("CaseNumber").orderBy(F.col("OBJECTID").desc_nulls_last())
    return cases.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def code_candidates(cases: DataFrame, open_only: bool = True, dedup_cases: bool = False) -> DataFrame:
    """Code cases keyed by the 8-padded parcel id; open statuses only (the
    status filter runs before the parcel join), or all rows with `ok` false for
    the closed ones. `dedup_cases` (default off, as the reference) keeps only the
    latest row per case number before anything else."""
    if dedup_cases:
        cases = latest_case_rows(cases)
    c = cases.withColumn("_ord", row_ord(cases)).withColumn("pid", N.pid_padded("ParcelId"))
    if open_only:
        c = c.where(F.col("CaseStatus").isin(K.CODE_OPEN_STATUSES))
    pairs = [
        ("source", F.lit("charlotte_hns")), ("case", F.col("CaseNumber")), ("type", F.col("CaseType")),
        ("status", F.col("CaseStatus")), ("address", F.col("FullAddress")),
        ("created", F.col("DateCreated")), ("closed", F.col("DateClosed")), ("conclusion", F.col("Conclusion")),
    ]
    housing = F.when(F.col("CaseType").isin(K.CODE_HIGH_SIGNAL_TYPES), F.lit("code_housing_case"))
    if open_only:
        return _ev(c, "code", True, housing, "charlotte_hns", FEED_RANK["code"], pairs)
    c = c.withColumn("ok", F.coalesce(F.col("CaseStatus").isin(K.CODE_OPEN_STATUSES), F.lit(False)))
    return _ev(c, "code", True, housing, "charlotte_hns", FEED_RANK["code"], pairs, more=("ok",))


def demo_candidates(demos: DataFrame) -> DataFrame:
    d = demos.withColumn("_ord", row_ord(demos)).withColumn("pid", N.pid_padded("ParcelId"))
    pairs = [
        ("source", F.lit("charlotte_demo")), ("case", F.col("CaseNumber")), ("status", F.col("CaseStatus")),
        ("address", F.col("FullAddress")), ("created", F.col("DateCreated")),
    ]
    return _ev(d, "code", True, "demolition_order", "charlotte_demo", FEED_RANK["demo"], pairs)


def instrument_rules(spark) -> DataFrame:
    """The per-code rule table (8 rows, a fixed dimension of the feed)."""
    rows = [(c, *K.INSTRUMENT_RULES[c][:4], bool(K.INSTRUMENT_RULES[c][4]), FEED_RANK["rod_" + c])
            for c in K.INSTRUMENT_ORDER]
    return spark.createDataFrame(rows, "doc_type_code string, _r_pattern string, _r_source string, _r_flag string, "
                                       "_r_label string, _r_fires boolean, _r_rank int")


def instrument_pid(instr: DataFrame) -> Column:
    """Parcel id of an instrument: the first of its three id fields that is not blank."""
    own = [N.nonblank(F.col(c).cast("string")) for c in ("pid", "parcel_id", "ParcelId") if c in instr.columns]
    return N.pid_digits(N.clean(F.coalesce(*own, F.lit(""))))


def instrument_candidates(instr: DataFrame) -> DataFrame:
    """Recorded instruments by type code, in ONE pass over the feed: lien /
    transfer / jfc signals and their flags; satisfactions only flag. Codes
    nobody reads are dropped by the inner join with the 8-row rule table,
    broadcast (its size is fixed by the code list, not by the data)."""
    rules = F.broadcast(instrument_rules(instr.sparkSession))
    i = (instr.withColumn("_ord", row_ord(instr))
         .join(rules, "doc_type_code")
         .withColumn("pid", instrument_pid(instr)))
    base = [("source", F.col("_r_source")),
            ("doc_type", F.coalesce(N.nonblank(F.col("doc_type")), F.col("_r_label"))),
            ("instrument_id", F.col("instrument_id")), ("book", F.col("book")), ("page", F.col("page")),
            ("recorded_date", F.col("recorded_date")), ("grantor", F.col("grantor")),
            ("grantee", F.col("grantee"))]
    detail = (F.when(F.col("_r_pattern").isNull(), F.create_map().cast("map<string,string>"))
              .when(F.col("_r_pattern") == "lien", detail_map(base + [("amount", F.col("amount"))]))
              .otherwise(detail_map(base)))
    return i.select(
        "pid", F.col("_r_pattern").alias("pattern"), F.col("_r_fires").alias("fires"), F.col("_r_flag").alias("flag"),
        F.col("_r_source").alias("source"), F.col("_r_rank").alias("feed_rank"), F.col("_ord").alias("row_ord"),
        F.lit("").alias("rkey"), detail.alias("detail"), F.lit(None).cast("timestamp").alias("sale_ts"))


def attach_by_pid(cands: DataFrame, parcels: DataFrame, words=None) -> DataFrame:
    """Inner equi-join of candidate evidence with the parcel table on pid.
    `words`: `keyfilter.key_words` of the parcels' pids."""
    keys = parcels.select("pid", "sale_ts")
    # no parcel has a blank pid (P8): blank keys cannot match, and dropping
    # them first keeps them from piling onto one reducer as a hot key
    cands = with_hit(cands.drop("sale_ts"), "pid", words, "_may").where("_may")
    return cands.join(keys, "pid").select(*EVIDENCE_COLS)


# ------------------------------------------------------------------ address-keyed feed
def foreclosure_notices(fc: DataFrame, county: str = K.DEFAULT_COUNTY) -> DataFrame:
    """Notices of the county with their class (P4) and address key."""
    return (fc.where(_county_is("county", [county]))
            .withColumn("_ord", row_ord(fc))
            .withColumn("pattern", N.notice_pattern("summary", "sp_case_number"))
            .withColumn("k", N.street_key("address"))
            .withColumn("addr_num", F.col("k.num")).withColumn("addr_name", F.col("k.name")).drop("k"))


def attach_by_address(notices: DataFrame, addr_index: DataFrame) -> DataFrame:
    """Equi-join on (house number, street name): every parcel at the address."""
    return _address_evidence(notices.where((F.col("addr_num") != "") & (F.col("addr_name") != ""))
                             .join(addr_index, ["addr_num", "addr_name"]))


def _address_evidence(j: DataFrame) -> DataFrame:
    pairs = [
        ("source", F.lit("mecktimes")), ("case", F.col("sp_case_number")), ("posted", F.col("posted_date")),
        ("auction", F.col("auction_date")), ("deed_book", F.col("deed_book")), ("deed_page", F.col("deed_page")),
        ("summary", F.coalesce(F.col("summary"), F.lit(""))), ("url", F.col("detail_url")),
    ]
    return _ev(j, F.col("pattern"), True, None, "mecktimes", FEED_RANK["foreclosure"], pairs)


# ------------------------------------------------------------------ name-keyed feed
NOTICE_COLS = ["_ord", "detail_id", "decedent_name", "posted_date", "case_number", "detail_url"]


def estate_notices(est: DataFrame, county: str = K.DEFAULT_COUNTY) -> DataFrame:
    """Notices of the county with their probe-side decedent keys."""
    return (est.where(_county_is("county", [county]))
            .withColumn("_ord", row_ord(est))
            .withColumn("_tok", N.name_tokens(N.normalize_owner("decedent_name")))
            .withColumn("keys", N.decedent_keys_from_tokens("_tok")).drop("_tok"))


def attach_by_name(notices: DataFrame, key_index: DataFrame) -> DataFrame:
    """Any-key match: explode the notice keys, equi-join the owner-key index,
    keep distinct (notice, pid) with the matched key as evidence (the
    smallest when several keys hit). Notices without keys are skipped
    (counted as unsafe by the metrics)."""
    own = NOTICE_COLS
    probe = notices.select(*own, F.explode(N.joined_keys("keys")).alias("name_key"))
    # the payload (five short texts) travels with the keys: no second join
    j = (probe.join(key_index.select("name_key", "pid", "sale_ts"), "name_key")
         .groupBy(*own, "pid").agg(F.min("name_key").alias("match_key"), F.max("sale_ts").alias("sale_ts")))
    return _name_evidence(j)


def _name_evidence(j: DataFrame, *more: str) -> DataFrame:
    pairs = [
        ("source", F.lit("mecktimes")), ("decedent", F.coalesce(F.col("decedent_name"), F.lit(""))),
        ("posted", F.col("posted_date")), ("case", F.col("case_number")), ("url", F.col("detail_url")),
        # match evidence: name linkage yields false matches by its own account
        ("match_key", F.col("match_key")),
    ]
    return _ev(j, "estate", True, None, "mecktimes", FEED_RANK["estate"], pairs, more=more)


# ------------------------------------------------------------------ links: one linkage for evidence and metrics
LINK_COLS = EVIDENCE_COLS + ["state"]
ATTACHED, UNMATCHED, UNSAFE, CLOSED = LINK_STATES = ("attached", "unmatched", "skipped_unsafe", "closed_skipped")
FEED_OF_RANK = {r: {"foreclosure": "foreclosures", "estate": "estates", "code": "code_cases", "demo": "code_demos"}.get(f, f)
                for f, r in FEED_RANK.items() if f != "transfer"}


def _bare(df: DataFrame, keep: Column) -> DataFrame:
    """Payload only where `keep`: rows that are merely counted stay narrow."""
    own = ("pid", "feed_rank", "row_ord")
    return df.select(*[F.col(c) if c in own or c not in EVIDENCE_COLS else F.when(keep, F.col(c)).alias(c) for c in df.columns])


def link_by_pid(cands: DataFrame, parcels: DataFrame, words=None) -> DataFrame:
    """Every candidate row with its state; rows that attach to no parcel are
    without payload. `ok` false marks rows that count but never attach (closed
    cases). Ids that are blank (they would pile onto one reducer) or that the
    filter `words` (`keyfilter.key_words` of the pids) misses match no parcel
    and are not joined."""
    cands = with_hit(cands.drop("sale_ts"), "pid", words, "_may")
    may = F.col("_may")
    keys = parcels.select("pid", "sale_ts", F.lit(True).alias("_hit"))
    alone = _bare(cands.where(~may), F.lit(False)).withColumns({"sale_ts": F.lit(None).cast("timestamp"), "_hit": F.lit(None).cast("boolean")})
    met = _bare(cands.where(may), F.col("ok")).join(keys, "pid", "left")
    joined = _bare(met, F.col("_hit").isNotNull()).unionByName(alone)
    state = F.when(F.col("_hit").isNull(), UNMATCHED).when(F.col("ok"), ATTACHED).otherwise(CLOSED)
    return joined.withColumn("state", state).select(*LINK_COLS)


def link_by_address(notices: DataFrame, addr_index: DataFrame) -> DataFrame:
    """A row per notice and parcel at its address, one for a notice without."""
    full = (F.col("addr_num") != "") & (F.col("addr_name") != "")
    index = addr_index.select("addr_num", "addr_name", "pid", "sale_ts")
    alone = notices.where(~full).withColumns({"pid": F.lit(None).cast("string"), "sale_ts": F.lit(None).cast("timestamp")})
    joined = notices.where(full).join(index, ["addr_num", "addr_name"], "left").unionByName(alone)
    return _address_evidence(joined).withColumn("state", F.when(F.col("pid").isNull(), UNMATCHED).otherwise(ATTACHED))


def link_by_name(notices: DataFrame, key_index: DataFrame) -> DataFrame:
    """A row per notice and parcel that shares a key. A notice without keys has
    one row of its own state; one of which some key meets no parcel has a row
    without a pid (it is unmatched if it has no other). Notices are expected
    with their keys stored: where `keys` is still an expression, Spark copies
    the whole chain into filters it infers from the explode."""
    own = NOTICE_COLS
    probe = notices.select(*own, F.explode_outer(F.when(F.size("keys") > 0, N.joined_keys("keys"))).alias("name_key"))
    keyed = F.col("name_key").isNotNull()
    index = key_index.select("name_key", "pid", "sale_ts")
    joined = (probe.where(keyed).join(index, "name_key", "left").groupBy(*own, "pid")
              .agg(F.min("name_key").alias("match_key"), F.max("sale_ts").alias("sale_ts"))
              .withColumn("state", F.when(F.col("pid").isNull(), UNMATCHED).otherwise(ATTACHED)))
    unsafe = probe.where(~keyed).select(*own, F.lit(None).cast("string").alias("pid"), F.lit(None).cast("string").alias("match_key"),
                                        F.lit(None).cast("timestamp").alias("sale_ts"), F.lit(UNSAFE).alias("state"))
    return _name_evidence(joined.unionByName(unsafe), "state")


def evidence_of(links: DataFrame) -> DataFrame:
    return links.where(F.col("state") == ATTACHED).select(*EVIDENCE_COLS)


def feed_metrics(links: DataFrame) -> DataFrame:
    """(feed, attached, unmatched, skipped_unsafe, closed_skipped), one row per
    feed, read off the links: no feed, parcel or key is joined a second time.

    attached counts (row, parcel) pairs; the others count rows. A notice of the
    name feed is unmatched when none of its keys met a parcel.
    """
    named = F.col("feed_rank") == FEED_RANK["estate"]
    whole = links.where(~(named & (F.col("state") == UNMATCHED))).groupBy("feed_rank", "state").agg(F.count(F.lit(1)).alias("n"))
    missed = (links.where(named & F.col("state").isin(ATTACHED, UNMATCHED)).groupBy("row_ord")
              .agg(F.max(F.col("state") == ATTACHED).alias("hit")).where(~F.col("hit"))
              .select(F.lit(FEED_RANK["estate"]).alias("feed_rank"), F.lit(UNMATCHED).alias("state"))
              .groupBy("feed_rank", "state").agg(F.count(F.lit(1)).alias("n")))
    # one global aggregate, so every feed reports, empty ones with zeros
    cell = lambda r, s: F.coalesce(F.sum(F.when((F.col("feed_rank") == r) & (F.col("state") == s), F.col("n"))), F.lit(0)).alias(f"{s}_{r}")
    row = whole.unionByName(missed).agg(*[cell(r, s) for r in FEED_OF_RANK for s in LINK_STATES])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feed"), *[F.col(f"{s}_{r}").alias(s) for s in LINK_STATES]) for r, f in FEED_OF_RANK.items()])).alias("m")).select("m.*")

"""Top signals per pattern (W1, W2), lead records (P9) and ranking (O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K


def top_signals(signals: DataFrame, k: int = K.SIGNAL_CAP_PER_PATTERN, within: tuple[str, ...] = ()) -> DataFrame:
    """Keep the k most recent signals per (pid, pattern): recency key
    descending (text order), ties in attachment order.

    `row_number() <= k` plans as a WindowGroupLimit: each map task keeps only
    its own top k per group before the shuffle, so a hot (pid, pattern)
    moves at most k rows per task. `within`: columns that the pid determines;
    rows dealt out by them are not dealt out again.
    """
    w = Window.partitionBy(*within, "pid", "pattern").orderBy(F.col("rkey").desc(), "feed_rank", "row_ord")
    return (signals.where(F.col("pattern").isNotNull())
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def signals_map(top: DataFrame) -> DataFrame:
    """pid -> map(pattern -> [detail, ...] in rank order); at most 6 x k entries."""
    per = (top.groupBy("pid", "pattern")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "detail")),
                             lambda a, b: a["rank"] - b["rank"]).alias("lst"))
           .select("pid", "pattern", F.transform("lst", lambda s: s["detail"]).alias("lst")))
    return per.groupBy("pid").agg(F.map_from_entries(F.collect_list(F.struct("pattern", "lst"))).alias("signals"))


def lead_records(scored: DataFrame, sig_map: DataFrame) -> DataFrame:
    """The 72-column lead record; leads with no firing pattern are dropped."""
    from ..functions import normalize as N
    s = scored.where(F.size("patterns") > 0).join(sig_map, "pid", "left")
    s = N.with_owner_parsed(s, "owner1_first", "owner1_last", "owner_parsed")
    s = N.with_owner_parsed(s, "owner2_first", "owner2_last", "owner2_parsed")
    txt = lambda c: F.coalesce(N.nonblank(F.col(c)), F.lit(""))
    return s.select(
        "pid", txt("nc_pin").alias("nc_pin"),
        F.when(F.col("pid") != "", F.concat(F.lit(K.PARCEL_URL_PREFIX), F.col("pid"))).otherwise("")
        .alias("polaris_url"),
        txt("address").alias("address"), txt("street_num").alias("street_num"),
        txt("street_name").alias("street_name"), txt("loc_city").alias("city"),
        txt("owner").alias("owner"), txt("owner2").alias("owner2"),
        "owner_parsed", "owner2_parsed",
        "is_entity",
        *[txt(c).alias(c) for c in ["mail_addr", "mail_addr2", "mail_city", "mail_state", "mail_zip"]],
        "year_built", "eff_year_built",
        *[txt(c).alias(c) for c in ["building_type", "land_use", "land_use_code", "grade", "story_height",
                                    "vacant_or_improved", "exterior_wall", "foundation", "roof_cover",
                                    "heat", "heat_fuel"]],
        "heated_area", "total_area", "bedrooms", "fullbath", "halfbath", "fireplaces", "residential_units",
        "gis_acres", "total_acres", "legal_acres",
        "total_market_value", "total_value", "land_value", "building_value",
        "sale_price", "sale_date",
        *[txt(c).alias(c) for c in ["deed_type", "valid_sale", "deed_book", "deed_page"]],
        F.coalesce(N.nonblank(F.col("neighborhood_desc")), N.nonblank(F.col("neighborhood")), F.lit(""))
        .alias("neighborhood"),
        txt("tax_district").alias("tax_district"), txt("owner_type").alias("owner_type"),
        txt("exemption").alias("exemption"),
        "estimated_equity_pct", "years_owned", "is_absentee", "is_likely_landlord", "is_homestead",
        "is_senior", "is_disabled_veteran", "is_disabled", "is_likely_inherited", "lot_value_pct",
        "distress_score", "patterns", "stack_count", "tier", "raw_score", "flags",
        F.coalesce(F.col("signals"), F.create_map().cast("map<string,array<map<string,string>>>")).alias("signals"),
        F.col("is_absentee").alias("absentee"),
        "tier_rank",
    )


def with_position(records: DataFrame) -> DataFrame:
    """Adds `position`, the 1-based place in the ranking, without a global
    sort: a place is the number of records with a better (tier, stack, score),
    of records of the same one in earlier pid buckets, and of those before it
    in its own bucket. Scores are few; buckets are pid prefixes."""
    score = ["tier_rank", "stack_count", "raw_score"]
    r = records.withColumn("_bucket", F.substring("pid", 1, 5))
    buckets = r.groupBy(*score, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    levels = buckets.groupBy(*score).agg(F.sum("_n").alias("_n"))
    better = Window.orderBy(*[F.col(c).desc() for c in score]).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.withColumn("_better", F.coalesce(F.sum("_n").over(better), F.lit(0))).drop("_n")
    earlier = Window.partitionBy(*score).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*score, "_bucket").orderBy("pid"))
    return (r.withColumn("_own", own).join(buckets, [*score, "_bucket"]).join(levels, score)
            .withColumn("position", F.col("_better") + F.col("_earlier") + F.col("_own"))
            .drop("_bucket", "_own", "_earlier", "_better"))


def signals_text(signals) -> "F.Column":
    """A record's signals as sorted text: pattern:place:source:case, ..."""
    one = F.transform(F.map_entries(signals), lambda e: F.transform(e["value"], lambda d, i: F.concat_ws(
        ":", e["key"], (i + 1).cast("string"), F.coalesce(d["source"], F.lit("")), F.coalesce(d["case"], F.lit("")))))
    return F.array_join(F.array_sort(F.flatten(one)), ",")


def rank_leads(records: DataFrame) -> DataFrame:
    """Tier rank, stack count, raw score, all descending; pid breaks ties.
    A range-partitioned sort: no single-task global ordering."""
    return records.orderBy(F.col("tier_rank").desc(), F.col("stack_count").desc(),
                           F.col("raw_score").desc(), F.col("pid").asc())

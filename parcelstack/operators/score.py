"""Per-parcel fold (A1, A2), transfer rules (J13, M9, M10/J10), scores and
derived fields (M1-M8, M11, F6-F8, F12) and the tier (M3).

The fold is one groupBy('pid') over the evidence table with bounded,
partially-aggregated state (a set of at most six patterns, a flag count and
a small flag set, one boolean), so a parcel with a huge share of evidence
rows does not hold a large group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import normalize as N


def _one_decimal(x: Column) -> Column:
    """Rounded to one decimal by the number's exact binary value."""
    return F.replace(F.format_number(x, 1), F.lit(","), F.lit("")).cast("double")


def as_of_ts(as_of: str) -> Column:
    """The run's 'now' as a UTC timestamp (midnight of the given date)."""
    return F.to_timestamp(F.lit(as_of))


def fold(evidence: DataFrame) -> DataFrame:
    """pid -> distinct firing patterns, flag rows, estate-then-sale test."""
    return finish_fold(fold_state(evidence))


def fold_state(evidence: DataFrame) -> DataFrame:
    """The fold's state per pid, which `merge_states` can add to.

    Evidence rows carry the parcel's sale timestamp, so the estate interval
    rule (0 <= whole days from posted to sale <= 548) folds in the same pass.
    """
    posted = F.when(F.col("pattern") == "estate", N.parse_posted(F.col("detail")["posted"]))
    ev = evidence.withColumn("_posted", posted)
    est_hit = (F.col("sale_ts").isNotNull() & F.col("_posted").isNotNull()
               & N.days_between(F.col("sale_ts"), F.col("_posted")).between(0, K.TRANSFER_ESTATE_DAYS))
    return ev.groupBy("pid").agg(
        F.array_sort(F.collect_set(F.when(F.col("fires"), F.col("pattern")))).alias("patterns0"),
        F.count("flag").alias("n_flags0"),
        F.array_sort(F.collect_set("flag")).alias("flag_set0"),
        F.coalesce(F.bool_or(est_hit), F.lit(False)).alias("rule_b"),
        F.count_if(F.col("source") == "charlotte_hns").alias("n_open_cases"),
    )


def merge_states(states: DataFrame, *keys: str) -> DataFrame:
    """One state per pid (and `keys`, which the pid determines) of several:
    sets united, counts added. A pid has a state or two here, so the lists
    are short."""
    both = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return states.groupBy(*keys, "pid").agg(
        both("patterns0"), F.sum("n_flags0").alias("n_flags0"), both("flag_set0"),
        F.bool_or("rule_b").alias("rule_b"), F.sum("n_open_cases").alias("n_open_cases"))


def finish_fold(state: DataFrame) -> DataFrame:
    """A3: two or more attached open cases add one repeat-violator flag."""
    repeat = F.col("n_open_cases") >= 2
    return (state.withColumn("n_flags0", F.col("n_flags0") + repeat.cast("int"))
                 .withColumn("flag_set0", F.array_sort(F.array_union(
                     "flag_set0", F.when(repeat, F.array(F.lit("code_repeat_violator"))).otherwise(F.array())
                     .cast("array<string>")))))


def _truthy(x: Column) -> Column:
    """Python truthiness of a float that may be null: not null and not 0 (NaN is true)."""
    return x.isNotNull() & ((x != 0) | F.isnan(x))


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def value_or_total(market: Column, total: Column) -> Column:
    """`market or total` (M11): a falsy market value falls through to total."""
    return F.when(_truthy(market), market).otherwise(total)


def transfer_rule_a(p_sale_ts: Column, sale_price: Column, value: Column, now: Column) -> Column:
    """Recent sale (<= 730 whole days before now; future sales pass) at a
    nominal price (< 1000, zero and negative included, or < 5% of value)."""
    recent = p_sale_ts.isNotNull() & (N.days_between(now, p_sale_ts) <= K.TRANSFER_RECENT_DAYS)
    tv_ok = _finite(value) & (value > 0)
    nominal = (sale_price < K.TRANSFER_NOMINAL_PRICE) | (tv_ok & (sale_price / value < K.TRANSFER_VALUE_SHARE))
    return recent & sale_price.isNotNull() & F.coalesce(nominal, F.lit(False))


WEIGHT_KEYS = ["PATTERN_WEIGHTS", "ABSENTEE_POINTS", "VALUE_OVER_500K_POINTS", "DEMOLITION_POINTS", "VACANT_POINTS",
               "HEIRS_POINTS", "DISTRESS_PER_PATTERN", "DISTRESS_FLAG_CAP", "DISTRESS_ABSENTEE", "DISTRESS_SENIOR",
               "DISTRESS_EQUITY", "DISTRESS_YEARS"]


def weights(overrides: dict | None = None):
    """Score weights: the fixed defaults, with named overrides (for example
    DISTRESS_SENIOR=0 to stop age-related exemptions from raising a score)."""
    from types import SimpleNamespace
    w = {k: getattr(K, k) for k in WEIGHT_KEYS}
    for k, v in (overrides or {}).items():
        if k not in w:
            raise KeyError(f"unknown weight {k}")
        w[k] = v
    return SimpleNamespace(**w)


def score_leads(folded: DataFrame, parcels: DataFrame, as_of: str, weight_overrides: dict | None = None) -> DataFrame:
    """Join the fold with the parcel row (J11) and compute every score field.

    Output keeps the parcel columns plus: patterns, stack_count, tier,
    tier_rank, raw_score, flags, distress_score and the derived fields. Leads
    with no pattern are kept here (P7 drops them in `records`).
    """
    now = as_of_ts(as_of)
    W = weights(weight_overrides)
    L = folded.join(parcels, "pid")
    value = value_or_total(F.col("total_market_value"), F.col("total_value"))
    rule_a = transfer_rule_a(F.col("sale_ts"), F.col("sale_price"), value, now)
    rule_b = F.col("rule_b") & F.col("sale_ts").isNotNull()
    fired = rule_a | rule_b
    L = (L.withColumn("rule_a", rule_a).withColumn("rule_b", rule_b).withColumn("transfer_fired", fired)
         .withColumn("patterns", F.array_sort(F.array_union(
             "patterns0", F.when(F.col("transfer_fired"), F.array(F.lit("transfer"))).otherwise(F.array())
             .cast("array<string>"))))
         .withColumn("n_flags", F.col("n_flags0") + F.col("rule_a").cast("int") + F.col("rule_b").cast("int"))
         .withColumn("flag_set", F.array_union("flag_set0", F.filter(F.array(
             F.when(F.col("rule_a"), F.lit("nominal_consideration_recent_sale")),
             F.when(F.col("rule_b"), F.lit("post_estate_recent_sale"))), lambda x: x.isNotNull())))
         .withColumn("stack_count", F.size("patterns")))
    L = L.withColumn("tier", tier(F.col("stack_count"))) \
         .withColumn("tier_rank", F.when(F.col("tier") == K.TIER_HOT, 3).when(F.col("tier") == K.TIER_WARM, 2)
                     .otherwise(1))

    # ---- raw_score (M1) and the flags it adds
    has = lambda p: F.array_contains("patterns", p)
    pat_pts = sum((F.when(has(p), F.lit(w)).otherwise(F.lit(0)) for p, w in W.PATTERN_WEIGHTS.items()), F.lit(0))
    val0 = F.coalesce(F.when(_truthy(F.col("total_market_value")), F.col("total_market_value")),
                      F.when(_truthy(F.col("total_value")), F.col("total_value")), F.lit(0.0))
    high_value = _finite(val0) & (val0 >= K.HIGH_VALUE)
    vacant = F.upper(F.col("vacant_or_improved")).startswith("V")
    heirs = has("estate") & F.upper(F.col("owner_type")).isin(K.HEIRS_OWNER_TYPES)
    demo = F.array_contains("flag_set", "demolition_order")
    L = (L.withColumn("raw_score", (pat_pts
                                    + F.when(F.col("absentee"), W.ABSENTEE_POINTS).otherwise(0)
                                    + F.when(high_value, W.VALUE_OVER_500K_POINTS).otherwise(0)
                                    + F.when(demo, W.DEMOLITION_POINTS).otherwise(0)
                                    + F.when(vacant, W.VACANT_POINTS).otherwise(0)
                                    + F.when(heirs, W.HEIRS_POINTS).otherwise(0)).cast("int"))
         .withColumn("flags", F.array_sort(F.array_union("flag_set", F.filter(F.array(
             F.when(F.col("absentee"), F.lit("absentee_owner")),
             F.when(high_value, F.lit("value_over_500k")),
             F.when(vacant, F.lit("vacant")),
             F.when(heirs, F.lit("heirs_property_indicator"))), lambda x: x.isNotNull())))))

    # ---- derived fields
    sp, tmv, lv = F.col("sale_price"), value, F.col("land_value")
    equity = F.when(_finite(sp) & _finite(tmv) & (tmv > 0) & (sp > 0),
                    _one_decimal(F.greatest(F.lit(0.0), F.least(F.lit(100.0), (1.0 - sp / tmv) * 100.0))))
    years = F.when(F.col("sale_ts").isNotNull(),
                   F.round(N.days_between(now, F.col("sale_ts")) / 365.25, 1))
    yb = F.col("year_built")
    age = F.when(_truthy(yb), F.year(now) - yb.try_cast("int")).otherwise(F.lit(0))
    ex = N.exemption_flags("exemption")
    L = (L.withColumn("estimated_equity_pct", equity)
         .withColumn("years_owned", years)
         .withColumn("is_absentee", F.col("absentee"))
         .withColumn("is_entity", N.is_entity("owner"))
         .withColumn("is_likely_landlord", (F.col("absentee") & ~F.col("is_entity")) | N.is_landlord_entity("owner")))
    for k, c in ex.items():
        L = L.withColumn(k, c)
    yo = F.coalesce(F.col("years_owned"), F.lit(0.0))
    L = (L.withColumn("is_likely_inherited", (yo >= 25) & (F.coalesce(age, F.lit(0)) >= 50)
                      & ~F.col("is_entity") & ~F.col("is_homestead"))
         .withColumn("lot_value_pct", F.when(lv.isNotNull() & _finite(tmv) & (tmv > 0),
                                             _one_decimal(F.least(F.lit(100.0), lv / tmv * 100.0))))
         .withColumn("distress_score", (
             F.col("stack_count") * W.DISTRESS_PER_PATTERN
             + F.least(F.lit(W.DISTRESS_FLAG_CAP), F.col("n_flags"))
             + F.when(F.col("is_absentee"), W.DISTRESS_ABSENTEE).otherwise(0)
             + F.when(F.col("is_senior"), W.DISTRESS_SENIOR).otherwise(0)
             + F.when(F.coalesce(F.col("estimated_equity_pct") >= K.DISTRESS_EQUITY_MIN, F.lit(False)),
                      W.DISTRESS_EQUITY).otherwise(0)
             + F.when(yo >= K.DISTRESS_YEARS_MIN, W.DISTRESS_YEARS).otherwise(0)).cast("int")))
    return L


def tier(stack: Column) -> Column:
    return (F.when(stack >= 3, F.lit(K.TIER_HOT)).when(stack == 2, F.lit(K.TIER_WARM))
            .otherwise(F.lit(K.TIER_ACTIVE)))


def transfer_evidence(scored: DataFrame) -> DataFrame:
    """The parcel-derived transfer signal, one per lead where a rule fired."""
    from .link import FEED_RANK
    f = scored.where("transfer_fired")
    return f.select(
        "pid", F.lit("transfer").alias("pattern"), F.lit(True).alias("fires"),
        F.lit(None).cast("string").alias("flag"), F.lit("polaris_sale").alias("source"),
        F.lit(FEED_RANK["transfer"]).alias("feed_rank"), F.lit(0).cast("long").alias("row_ord"),
        F.lit("").alias("rkey"),
        F.create_map(F.lit("source"), F.lit("polaris_sale"),
                     F.lit("sale_date_ms"), F.col("sale_date").cast("string"),
                     F.lit("sale_price"), F.col("sale_price").cast("string"),
                     F.lit("total_market_value"), F.col("total_market_value").cast("string"))
        .cast("map<string,string>").alias("detail"),
        "sale_ts")

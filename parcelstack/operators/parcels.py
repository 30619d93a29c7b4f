"""Parcel master: clean-up projection (P1), blank-key drop (P8), first row per
pid (A9/W3), absentee (F11) and the two derived join-key indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from .keyfilter import may_meet

# cleaned column <- raw text field
TEXT_COLS = [
    ("nc_pin", "nc_pin"), ("address", "address"), ("street_num", "streetnumber"),
    ("street_name", "streetname"), ("loc_city", "loccity"),
    ("owner1_first", "ownrfrstnme"), ("owner1_last", "ownrlstnme"),
    ("owner2_first", "ownr2frstnme"), ("owner2_last", "ownr2lstnme"),
    ("mail_addr", "mailaddr1"), ("mail_addr2", "mailaddr2"), ("mail_city", "city"),
    ("mail_state", "state"), ("mail_zip", "zipcode"), ("building_type", "bldgtype"),
    ("land_use", "landuse_description"), ("land_use_code", "lusecode"), ("grade", "grade"),
    ("story_height", "storyheight"), ("vacant_or_improved", "vacorimprov"),
    ("construction_frame", "frame"), ("exterior_wall", "extwall"), ("foundation", "foundation"),
    ("roof_cover", "roofcover"), ("heat", "heat"), ("heat_fuel", "heatfuel"),
    ("deed_type", "typeofdeed"), ("valid_sale", "validsale"), ("nal_desc", "naldesc"),
    ("deed_book", "deed_book"), ("deed_page", "deed_page"), ("grantor", "grantor"),
    ("owner_type", "ownertyped"), ("exemption", "exemption"), ("neighborhood", "neighborhood"),
    ("neighborhood_desc", "neighbordesc"), ("tax_district", "taxmundist"),
    ("tax_fire_district", "taxfiredist"), ("tax_special_district", "taxspecdist"),
    ("legal_desc", "legaldesc"), ("x_coord", "xcoord"), ("y_coord", "ycoord"),
]
# cleaned column <- raw numeric field (try_cast to double; bad text -> null)
NUM_COLS = [
    ("year_built", "yearbuilt"), ("eff_year_built", "effyearblt"), ("heated_area", "heatedarea"),
    ("total_area", "totalarea"), ("base_area", "basearea"), ("finished_area", "finarea"),
    ("garage_finished", "fingarage"), ("garage_unfinished", "unfingarag"), ("bedrooms", "bedrooms"),
    ("fullbath", "fullbath"), ("halfbath", "halfbath"), ("three_qtr_bath", "threequabath"),
    ("fireplaces", "fireplaces"), ("residential_units", "resunits"), ("commercial_units", "comunits"),
    ("gis_acres", "gisacres"), ("total_acres", "totalac"), ("legal_acres", "legalacres"),
    ("total_market_value", "totmarkval"), ("total_value", "totalvalue"), ("land_value", "totlandval"),
    ("building_value", "totalbldgval"), ("yard_value", "totalyardval"), ("sale_price", "saleprice"),
]


def first_row_per_pid(raw: DataFrame) -> DataFrame:
    """Keep, per stripped pid, the row with the lowest object id; drop blank pids.

    `row_number() = 1` plans as a WindowGroupLimit that runs partially before
    the shuffle (each map task keeps only its first row per pid), so a pid
    holding a large share of rows does not land whole on one reducer, and no
    wide struct is built per row.
    """
    from pyspark.sql import Window
    keyed = raw.withColumn("pid", N.clean("pid")).where(F.col("pid") != "")
    w = Window.partitionBy("pid").orderBy(F.col("objectid_1").asc_nulls_last())
    return keyed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def clean_parcels(raw: DataFrame) -> DataFrame:
    """One cleaned row per pid (71 columns + typed sale columns + address key
    + owner name keys)."""
    r = first_row_per_pid(raw)
    text = [N.clean(src).alias(dst) for dst, src in TEXT_COLS]
    nums = [N.num(src).alias(dst) for dst, src in NUM_COLS]
    out = r.select(
        "pid", "objectid_1", *text, *nums,
        F.col("saledate").cast("string").alias("sale_date_raw"),
    )
    out = (out
           .withColumn("owner", N.join_nonempty("owner1_first", "owner1_last"))
           .withColumn("owner2", N.join_nonempty("owner2_first", "owner2_last"))
           .withColumn("sale_ts", N.ms_to_ts("sale_date_raw"))
           .withColumn("sale_date", F.col("sale_date_raw").try_cast("double").try_cast("bigint"))
           .withColumn("addr_key", N.street_key("address")))
    # owner name keys, materialized with the parcel (normalized names and
    # tokens staged as columns so each projection stays small)
    out = (out.withColumn("_n1", N.normalize_owner("owner")).withColumn("_n2", N.normalize_owner("owner2"))
           .withColumn("_t1", N.name_tokens("_n1")).withColumn("_t2", N.name_tokens("_n2"))
           .withColumn("name_keys", F.array_union(N.owner_keys_from_tokens("_t1"), N.owner_keys_from_tokens("_t2")))
           .drop("_n1", "_n2", "_t1", "_t2"))
    out = (out
           .withColumn("absentee", (F.col("address") != "") & (F.col("mail_addr") != "")
                       & (F.col("addr_key.name") != N.street_key("mail_addr")["name"])))
    return out


def address_index(parcels: DataFrame) -> DataFrame:
    """(addr_num, addr_name, pid, sale_ts) for every parcel with a full address key."""
    return (parcels.select("pid", "sale_ts", F.col("addr_key.num").alias("addr_num"),
                           F.col("addr_key.name").alias("addr_name"))
            .where((F.col("addr_num") != "") & (F.col("addr_name") != "")))


def owner_key_index(parcels: DataFrame, words=None) -> DataFrame:
    """(name_key, pid) pairs, distinct, from both owners' index-side keys.

    The keys are a column of the cleaned parcels (`name_keys`), so the index
    is one explode of a stored column. pid is unique per parcel row and the
    keys of both owners are de-duplicated per row, so the pairs are already
    distinct: no shuffle here. The index is only joined with the (small)
    probe keys of notices, which Spark/AQE broadcast by measured size.
    `words` (`keyfilter.key_words` of the notices) drops keys that no notice
    has before the explode, so few are moved where the join shuffles.
    """
    if "name_keys" not in parcels.columns:
        staged = (parcels.select("pid", "sale_ts", N.normalize_owner("owner").alias("_n1"),
                                 N.normalize_owner("owner2").alias("_n2"))
                  .select("pid", "sale_ts", N.name_tokens("_n1").alias("_t1"), N.name_tokens("_n2").alias("_t2")))
        parcels = staged.select("pid", "sale_ts", F.array_union(N.owner_keys_from_tokens("_t1"),
                                                                N.owner_keys_from_tokens("_t2")).alias("name_keys"))
    parcels = may_meet(parcels.select("pid", "sale_ts", "name_keys"), "name_keys", words)
    return parcels.select("pid", "sale_ts", F.explode(N.joined_keys("name_keys")).alias("name_key"))

"""Typed feed schemas and the JSON-lines scans.

Each feed has an explicit StructType (no inference). Raw numbers arrive as
numbers or numeric text, so they are read as STRING and converted with
try_cast later. A missing optional feed is an empty DataFrame of the same
schema, so every downstream step runs unchanged (and does no work).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()

# Raw parcel fields that are read (68) plus the ordering id.
PARCEL_TEXT_FIELDS = [
    "pid", "nc_pin", "address", "streetnumber", "streetname", "loccity",
    "ownrfrstnme", "ownrlstnme", "ownr2frstnme", "ownr2lstnme",
    "mailaddr1", "mailaddr2", "city", "state", "zipcode", "bldgtype",
    "landuse_description", "lusecode", "grade", "storyheight", "vacorimprov", "frame",
    "extwall", "foundation", "roofcover", "heat", "heatfuel", "typeofdeed",
    "validsale", "naldesc", "deed_book", "deed_page", "grantor", "ownertyped",
    "exemption", "neighborhood", "neighbordesc", "taxmundist", "taxfiredist", "taxspecdist",
    "legaldesc", "xcoord", "ycoord",
]
PARCEL_NUMERIC_FIELDS = [
    "yearbuilt", "effyearblt", "heatedarea", "totalarea", "basearea", "finarea",
    "fingarage", "unfingarag", "bedrooms", "fullbath", "halfbath", "threequabath",
    "fireplaces", "resunits", "comunits", "gisacres", "totalac", "legalacres",
    "totmarkval", "totalvalue", "totlandval", "totalbldgval", "totalyardval", "saleprice",
    "saledate",
]
RAW_PARCEL = T.StructType(
    [T.StructField("objectid_1", T.LongType())]
    + [T.StructField(f, S) for f in PARCEL_TEXT_FIELDS + PARCEL_NUMERIC_FIELDS]
)

TAX_CASE = T.StructType([T.StructField(f, S) for f in [
    "_source", "county", "courtfile", "address", "pid_normalized",
    "street", "city", "addressparcel_raw", "saledate", "saletime", "tax_value", "openingbid",
    "currentbid", "specialprice", "closedate", "ourfilenbr",
    "name", "zip", "addressparcel", "status", "last_day_for_upset",
]])

FORECLOSURE = T.StructType([T.StructField("detail_id", T.LongType())] + [T.StructField(f, S) for f in [
    "detail_url", "posted_date", "address", "county", "auction_date", "sp_case_number",
    "deed_book", "deed_page", "summary",
]])

ESTATE = T.StructType([T.StructField("detail_id", T.LongType())] + [T.StructField(f, S) for f in [
    "detail_url", "posted_date", "heading", "decedent_name", "county", "case_number", "summary", "_source",
]])

CODE_CASE = T.StructType([T.StructField("OBJECTID", T.LongType())] + [T.StructField(f, S) for f in [
    "ParcelId", "CaseNumber", "CaseType", "CaseStatus", "FullAddress", "DateCreated", "DateClosed",
    "Conclusion", "_source",
]])

INSTRUMENT = T.StructType([T.StructField(f, S) for f in [
    "_source", "doc_type", "doc_type_code", "recorded_date", "instrument_id", "book", "page",
    "grantor", "grantee", "legal_description", "amount", "pid", "parcel_id", "ParcelId",
]] + [T.StructField("extra", T.MapType(S, S))])


_REJECT = T.StructType([T.StructField("file", S), T.StructField("line", S)])
_REJECT_COUNTS = T.StructType([T.StructField("file", S), T.StructField("n_rows", T.LongType()), T.StructField("n_rejected", T.LongType())])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_jsonl(spark: SparkSession, path: str | None, schema: T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines with a declared schema.

    Lenient (default): lines that are no JSON object are dropped, blank lines
    skipped, and a missing path yields an empty feed. Strict (the parcel
    master): the path must exist and such a line fails the job. Ids are read
    as text and converted after, so a quoted id or one with a fraction (5.0)
    keeps its row; an id that is no number is null.
    """
    if path is None:
        if strict:
            raise FileNotFoundError("parcel master path is required")
        return empty(spark, schema)
    text = T.StructType([T.StructField(f.name, S if f.dataType == T.LongType() else f.dataType) for f in schema.fields])
    reader = spark.read.schema(text).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    try:
        rows = reader.json(path)
        return rows.select(*[
            F.col(f.name).try_cast("decimal(38,6)").try_cast("bigint").alias(f.name) if f.dataType == T.LongType() else F.col(f.name)
            for f in schema.fields])
    except AnalysisException as e:
        if strict or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


@dataclass
class LineScan:
    """A JSON-lines scan in three parts: typed rows, lines that are no JSON
    object of the schema, and both counted per file."""
    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def scan_lines(spark: SparkSession, path: str | None, schema: T.StructType, strict: bool = False) -> LineScan:
    """JSON lines split into rows and rejects (file, line); blank lines are
    neither. counts is (file, n_rows, n_rejected), one partial aggregate over
    the text. A missing path has no rows unless `strict`; strict also fails,
    naming the files, if any line is rejected. Ids are read as in read_jsonl."""
    text = T.StructType([T.StructField(f.name, S if f.dataType == T.LongType() else f.dataType) for f in schema.fields])
    try:
        lines = spark.read.text(path) if path is not None else None
    except AnalysisException as e:
        if strict or e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = None
    if lines is None:
        if strict:
            raise FileNotFoundError("parcel master path is required")
        return LineScan(empty(spark, schema), empty(spark, _REJECT), empty(spark, _REJECT_COUNTS))
    lines = lines.select(F.col("_metadata.file_name").alias("file"), F.trim("value").alias("line")).where("line <> ''")
    known = T.StructType([*text.fields, T.StructField("_corrupt", S)])
    parsed = lines.withColumn("r", F.from_json("line", known, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    # an object either parses whole or leaves its text behind; other JSON values are no objects
    good = F.col("line").startswith("{") & F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    parsed = parsed.withColumn("good", F.coalesce(good, F.lit(False)))
    counts = parsed.groupBy("file").agg(F.count_if("good").alias("n_rows"), F.count_if(~F.col("good")).alias("n_rejected"))
    if strict:
        bad = counts.where("n_rejected > 0").orderBy(F.desc("n_rejected"), "file").limit(5).collect()
        if bad:
            raise ValueError("lines that are no JSON object: " + ", ".join(f"{r.file} ({r.n_rejected})" for r in bad))
    own = [F.col(f"r.{f.name}").try_cast("decimal(38,6)").try_cast("bigint").alias(f.name) if f.dataType == T.LongType()
           else F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    return LineScan(parsed.where("good").select(*own), parsed.where(~F.col("good")).select("file", "line"), counts)


@dataclass
class Feeds:
    """All inputs of one lead build. Optional feeds may be empty DataFrames."""
    parcels_raw: DataFrame
    tax: DataFrame
    foreclosures: DataFrame
    estates: DataFrame
    code_cases: DataFrame
    code_demos: DataFrame
    instruments: DataFrame

    def names(self):
        return [f.name for f in fields(self)]


def load_feeds(spark: SparkSession, paths: dict) -> Feeds:
    """Feeds from JSON-lines paths; absent keys or files are empty feeds."""
    g = paths.get
    return Feeds(
        parcels_raw=read_jsonl(spark, g("parcels"), RAW_PARCEL, strict=True),
        tax=read_jsonl(spark, g("tax"), TAX_CASE),
        foreclosures=read_jsonl(spark, g("foreclosures"), FORECLOSURE),
        estates=read_jsonl(spark, g("estates"), ESTATE),
        code_cases=read_jsonl(spark, g("code_cases"), CODE_CASE),
        code_demos=read_jsonl(spark, g("code_demos"), CODE_CASE),
        instruments=read_jsonl(spark, g("instruments"), INSTRUMENT),
    )

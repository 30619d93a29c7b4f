"""Summaries, filters and export over lead records.

Counts and rows come from the same `matches(filters)` predicate, so a
filtered count always equals the number of rows the same filter returns.
All outputs are small aggregates or distributed row sets; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .rank import with_position


def tier_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


def pattern_counts(records: DataFrame) -> DataFrame:
    """Records per pattern; a record counts once per pattern it has."""
    return (records.select(F.explode("patterns").alias("pattern"))
            .groupBy("pattern").agg(F.count(F.lit(1)).alias("n")))


def high_confidence(records: DataFrame) -> Column:
    """Warm AND (demolition order OR housing case OR absentee owner)."""
    return ((F.col("tier") == K.TIER_WARM)
            & (F.array_contains("flags", "demolition_order") | F.array_contains("flags", "code_housing_case")
               | F.col("is_absentee")))


def high_confidence_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(high_confidence(records)).alias("high_confidence_warm"),
                       F.count(F.lit(1)).alias("total"))


def matches(spec: dict) -> Column:
    """One predicate from a dashboard-style filter spec.

    Keys (all optional): patterns (any of), min_equity / max_equity,
    min_years / max_years, absentee, senior, entity, demolition (bool), text
    (case-insensitive substring over address, owner, pid, and the signal
    payload when `search_signals` is set). A null comparison is false.
    """
    conds = []
    if spec.get("patterns"):
        conds.append(F.size(F.array_intersect("patterns", F.array(*[F.lit(p) for p in spec["patterns"]]))) > 0)
    if "min_equity" in spec:
        conds.append(F.col("estimated_equity_pct") >= spec["min_equity"])
    if "max_equity" in spec:
        conds.append(F.col("estimated_equity_pct") <= spec["max_equity"])
    if "min_years" in spec:
        conds.append(F.col("years_owned") >= spec["min_years"])
    if "max_years" in spec:
        conds.append(F.col("years_owned") <= spec["max_years"])
    if "absentee" in spec:
        conds.append(F.col("is_absentee") == F.lit(bool(spec["absentee"])))
    if "senior" in spec:
        conds.append(F.col("is_senior") == F.lit(bool(spec["senior"])))
    if "entity" in spec:
        conds.append(F.col("is_entity") == F.lit(bool(spec["entity"])))
    if "demolition" in spec:
        conds.append(F.array_contains("flags", "demolition_order") == F.lit(bool(spec["demolition"])))
    if spec.get("text"):
        t = spec["text"].lower()
        hay = [F.lower(F.col("address")), F.lower(F.col("owner")), F.lower(F.col("pid"))]
        if spec.get("search_signals"):
            hay.append(F.lower(F.to_json("signals")))
        hit = F.lit(False)
        for h in hay:
            hit = hit | h.contains(t)
        conds.append(hit)
    pred = F.lit(True)
    for c in conds:
        pred = pred & F.coalesce(c, F.lit(False))
    return pred


def filtered_counts(records: DataFrame, spec: dict) -> DataFrame:
    return tier_counts(records.where(matches(spec)))


def export_rows(records: DataFrame, spec: dict) -> DataFrame:
    """Skip-trace export shape (S8): owner parts, mailing address, blank contacts."""
    r = records.where(matches(spec))
    blank = F.lit("")
    return r.select(
        "pid", F.col("owner_parsed.first_name").alias("owner_first"),
        F.col("owner_parsed.middle_name").alias("owner_middle"),
        F.col("owner_parsed.last_name").alias("owner_last"),
        "mail_addr", "mail_addr2", "mail_city", "mail_state", "mail_zip",
        blank.alias("phone1"), blank.alias("phone2"), blank.alias("phone3"),
        blank.alias("email1"), blank.alias("email2"))


def dry_run_distribution(scored: DataFrame, n: int) -> DataFrame:
    """Tier and pattern-hit distribution over the first n leads by pid,
    zero-pattern leads included (counted as active). The limit is the feature."""
    sample = scored.orderBy("pid").limit(n)
    tiers = sample.groupBy("tier").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("tier").alias("kind"), F.col("tier").alias("key"), "n")
    pats = sample.select(F.explode("patterns").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("pattern").alias("kind"), F.col("p").alias("key"), "n")
    return tiers.unionByName(pats)


def run_summary(records: DataFrame, run_id: str = "") -> DataFrame:
    """The one-row run summary (T11): total, tier and pattern counts as maps,
    warm high-confidence count. One small union of aggregates, folded once."""
    tiers = tier_counts(records).select(F.lit("tier").alias("kind"), F.col("tier").alias("key"), "n")
    pats = pattern_counts(records).select(F.lit("pattern").alias("kind"), F.col("pattern").alias("key"), "n")
    hc = high_confidence_count(records)
    tot = hc.select(F.explode(F.array(
        F.struct(F.lit("total").alias("kind"), F.lit("total").alias("key"), F.col("total").alias("n")),
        F.struct(F.lit("total").alias("kind"), F.lit("high_confidence_warm").alias("key"),
                 F.col("high_confidence_warm").alias("n")))).alias("r")).select("r.*")
    rows = F.collect_list(F.struct("kind", "key", "n"))

    def as_map(kind):
        return F.map_from_entries(F.transform(F.filter(rows, lambda r: r["kind"] == kind),
                                              lambda r: F.struct(r["key"], r["n"])))
    folded = tiers.unionByName(pats).unionByName(tot).agg(
        as_map("total").alias("totals"), as_map("tier").alias("tier_counts"),
        as_map("pattern").alias("pattern_counts"))
    fixed = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    return folded.select(
        F.current_timestamp().alias("generated_at"), F.lit(run_id).alias("source_commit"),
        F.col("totals")["total"].alias("total"), "tier_counts", "pattern_counts",
        F.col("totals")["high_confidence_warm"].alias("high_confidence_warm"),
        fixed(K.PATTERNS_LEGEND).alias("patterns_legend"), fixed(K.TIER_RULES).alias("tier_rules"))


def write_outputs(ranked: DataFrame, summary: DataFrame, out_dir: str) -> None:
    """Ranked records as JSON-lines part files plus the one-row summary.
    No single-document size limit and no driver collection."""
    ranked.write.mode("overwrite").json(f"{out_dir}/records")
    summary.coalesce(1).write.mode("overwrite").json(f"{out_dir}/summary")


def write_document(records: DataFrame, summary: DataFrame, path: str, records_per_part: int = 200_000) -> None:
    """S7 as one JSON object: the summary's fields, then `records` in rank
    order. Text parts of one line a record; their texts one after another, in
    order of file name, are the object. The first line opens it, the last one
    closes it. Positions range-partition the rows, so no task holds more than
    its share and nothing is collected. Null fields are written as nulls."""
    as_json = lambda df: F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    ranked = with_position(records)
    body = ranked.select("position", F.concat(F.when(F.col("position") > 1, ",").otherwise(""),
                                              as_json(records)).alias("value"))
    opened = F.concat(F.regexp_replace(as_json(summary), r"\}$", ""), F.lit(',"records":['))
    head = summary.select(F.lit(0).cast("long").alias("position"), opened.alias("value"))
    tail = records.sparkSession.range(1).select(F.lit((1 << 63) - 1).alias("position"), F.lit("]}").alias("value"))
    rows = head.unionByName(body).unionByName(tail)
    (rows.repartitionByRange("position").sortWithinPartitions("position").select("value")
     .write.mode("overwrite").option("maxRecordsPerFile", records_per_part).text(path))


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of a document that `write_document` wrote, with `place`,
    their 1-based place in it. `schema`: of a record. Files are read by lines
    and in blocks, however large they are: a line's place is the number of
    lines in earlier files and blocks and of those before it in its own, where
    a scan numbers lines upwards."""
    # the block is selected with the line: Spark fills it in while it reads
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"),
                                         F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    blocks = lines.groupBy("file", "at").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1))  # one row a block
    starts = blocks.select("file", "at", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("file", "at").orderBy("n"))
    lines = lines.withColumn("own", own).join(starts, ["file", "at"]).select((F.col("start") + F.col("own") - 1).alias("place"), "line")
    lines = lines.where((F.col("place") > 0) & (F.col("line") != "]}"))
    one = F.from_json(F.regexp_replace("line", "^,", ""), schema)
    return lines.select("place", one.alias("r")).select("place", "r.*")


def write_export_csv(records: DataFrame, spec: dict, out_dir: str) -> None:
    export_rows(records, spec).write.mode("overwrite").option("header", True).csv(out_dir)

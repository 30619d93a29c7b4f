"""Instrument CSV import (S4, P2, P3, F5), per-type snapshots (S5, ST4) and
the tax listing snapshot (S6, ST3).

Header aliases are resolved once on the driver from the file's column names
(metadata only); every row operation is a Spark column expression.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import normalize as N
from ..session import ensure_checkpoint_dir
from . import feeds as FD


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/parcelstack-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_files(rows: DataFrame, key: str, folder: str) -> None:
    """One text file per value of `key` (its other column), in a partition
    folder named by it. The time goes into making files, so keys are dealt out
    to all cores first: a table of few splits would keep most of them idle."""
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    rows.repartition(tasks, key).write.partitionBy(key).text(folder)


# Files of a batch, at most about: what the driver holds of each while a folder is listed and planned is some KB.
FILES_PER_BATCH = 16_384


def file_batches(rows: DataFrame, key: str) -> list[DataFrame]:
    """`rows` dealt out by `key` into parts of about FILES_PER_BATCH files for
    `write_files`, all rows of a key in one of them."""
    n = -(-rows.count() // FILES_PER_BATCH)
    own = F.pmod(F.xxhash64(key), F.lit(n))
    return [rows.where(own == b) for b in range(n)] if n > 1 else [rows]


def detect_column(fields: list[str], aliases: list[str]) -> str | None:
    """Header matched after trim, lower, spaces -> '_'; first alias wins,
    and of headers that read alike the last one."""
    norm = {}
    for f in fields:
        norm[f.strip().lower().replace(" ", "_")] = f
    for a in aliases:
        if a in norm:
            return norm[a]
    return None


def read_instrument_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV with a header row, every column as text; a UTF-8 BOM on the first
    header name is dropped. Quoted cells may hold commas, doubled quotes and,
    with `multi_line`, line breaks (files are then not split between tasks).
    All files of one read must have the same header (a file that differs fails
    the read); `import_folder` takes folders of several layouts."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8")
          .option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False).csv(path))
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(header, files): the first line of each file of a folder and the files
    that have it. Lines of a file are numbered in reading order within its first
    block, so the first is a partial aggregate over one pass of the text."""
    # the block is selected with the line: Spark fills it in while it reads
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    header = F.regexp_replace("header", "^\ufeff|\r$", "")
    return first.groupBy(header.alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files"))


def import_folder(spark: SparkSession, path: str, doctype_override: str | None = None, multi_line: bool = True) -> DataFrame:
    """S4 over a folder whose files need not share a header: files are grouped
    by their header, each layout's aliases are resolved on its own, and the
    normalized rows are one union. Only headers and file names pass the driver;
    an empty file has no rows."""
    layouts = [r.files for r in file_headers(spark, path).orderBy("header").collect()]
    parts = [normalize_instruments(read_instrument_csv(spark, files, multi_line), doctype_override) for files in layouts]
    return reduce(DataFrame.unionByName, parts) if parts else FD.empty(spark, FD.INSTRUMENT)


def normalize_instruments(raw: DataFrame, doctype_override: str | None = None) -> DataFrame:
    """Resolve the ten logical columns, normalize pid and type code, keep
    every other column in `extra` (map<string,string>)."""
    cols = raw.columns
    found = {name: detect_column(cols, aliases) for name, aliases in K.INSTRUMENT_ALIASES}
    used = {c for c in found.values() if c}

    def txt(name):
        c = found[name]
        return N.clean(F.col(f"`{c}`")) if c else F.lit("")

    doc_col = found["doc_type"]
    over = F.lit(doctype_override or "")
    doc_raw = F.coalesce(N.nonblank(F.coalesce(F.col(f"`{doc_col}`"), F.lit(""))) if doc_col else F.lit(None),
                         N.nonblank(over), F.lit(""))
    rest = [c for c in cols if c not in used]
    extra = (F.map_from_arrays(F.array(*[F.lit(c) for c in rest]),
                               F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rest]))
             if rest else F.create_map().cast("map<string,string>"))
    out = raw.select(
        F.lit("rod_csv_import").alias("_source"),
        doc_raw.alias("doc_type"),
        txt("recorded_date").alias("recorded_date"), txt("instrument_id").alias("instrument_id"),
        txt("book").alias("book"), txt("page").alias("page"), txt("grantor").alias("grantor"),
        txt("grantee").alias("grantee"), txt("legal_description").alias("legal_description"),
        txt("amount").alias("amount"),
        (N.pid_digits(F.col(f"`{found['pid']}`")) if found["pid"] else F.lit("")).alias("pid"),
        extra.cast("map<string,string>").alias("extra"))
    out = N.with_doctype_code(out)
    return out.withColumn("doc_type_code", F.when(F.col("doc_type_code") == "", "unknown")
                          .otherwise(F.col("doc_type_code")))


def cap_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """O3: the ingest `--limit N` (schema checks on a small run); None = all rows."""
    return df if limit is None else df.limit(int(limit))


def write_by_type(instruments: DataFrame, target: str) -> None:
    """S5 / ST4: one folder per type code; a code present in this import
    replaces its folder, other codes' folders stay (dynamic overwrite). The
    lines are compressed: they repeat every field name."""
    (instruments.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
     .partitionBy("doc_type_code").json(target))


def read_instruments(spark: SparkSession, target: str) -> DataFrame:
    """The per-type instrument store as one feed (partition column restored)."""
    return spark.read.schema(FD.INSTRUMENT).json(target)


def import_summary(instruments: DataFrame) -> DataFrame:
    """Rows per type code of an import."""
    return instruments.groupBy("doc_type_code").agg(F.count(F.lit(1)).alias("rows"))


def union_listings(*listings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tax listings of different columns as one feed (schema TAX_CASE, what
    a listing lacks is null), with further columns named in `keep`."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), listings)
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in FD.TAX_CASE.fields], *[F.col(c) for c in keep])


def write_tax_snapshot(tax: DataFrame, target: str, mode: str = "per_source") -> None:
    """S6 / ST3: the tax listing snapshot.

    mode='whole' rewrites everything with exactly this run's rows (a source
    that failed this run loses its rows, as in the scraper); mode='per_source'
    (default, named deliberate change) replaces only the sources present in
    this run, keeping the last good rows of the others.
    """
    w = tax.write.partitionBy("_source").mode("overwrite").option("compression", "gzip")
    if mode == "per_source":
        w = w.option("partitionOverwriteMode", "dynamic")
    elif mode == "whole":
        w = w.option("partitionOverwriteMode", "static")
    else:
        raise ValueError(mode)
    w.json(target)


def read_tax_snapshot(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(FD.TAX_CASE).json(target)

"""Incremental refresh (ST1, ST2) with Structured Streaming.

ST1  append with id dedup: a notice id already held is skipped, the first
     version of a new id wins. The stream keeps one flag per id in Spark's
     state store, so a micro-batch reads nothing that earlier ones wrote: rows
     of an id that has a flag go, of a new id the first by `order_col` (then by
     content) stays. The highest id so far is a side value of each batch.
ST2  append by monotone cursor: rows whose object id is above the highest one
     seen are new. Rows at or below it (a page that arrived late, or again)
     are compared with the ids already held, so none is lost or doubled. Of
     rows of one id in one batch the one with the least row hash stays.

Both write a micro-batch to a folder of its own (`_batch=N`) by overwriting: a
batch that is replayed after a failure replaces its own rows (Spark replays it
on the state it had before), so the result holds every row once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_EXACT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _earlier(spark: SparkSession, path: str, epoch: int) -> DataFrame | None:
    """What batches before `epoch` wrote; None if there is nothing yet."""
    try:
        return spark.read.parquet(path).where(F.col("_batch") < epoch)
    except AnalysisException as e:  # first batch: no target yet
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _first_rows(batch: DataFrame, id_col: str, order) -> DataFrame:
    cols = [c for c in batch.columns if c != id_col]
    return (batch.groupBy(id_col).agg(F.min_by(F.struct(*cols), order).alias("r"))
            .select(id_col, "r.*"))


def first_versions(stream: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """The rows of a stream whose id is new, one per id (rows without an id
    count as one id); `order_col` is numeric, its nulls last. The state holds
    one flag per id, the rows travel as JSON texts."""
    def first(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, best = state.exists, None
        for rows in chunks:  # an id's rows of the batch come in chunks; only the best row so far is held
            if not held and len(rows):  # compared as they are: frames sorted for each id cost far more than its few rows
                some = min((order is None, order or 0, row) for order, row in zip(rows["_order"].array, rows["_row"].array, strict=True))
                best = some if best is None else min(best, some)
        if best is not None:
            state.update((True,))
            yield pd.DataFrame({"_row": [best[2]]})

    rows = stream.select(F.col(id_col).alias("_id"), F.col(order_col).cast("decimal(38,9)").alias("_order"),
                         F.to_json(F.struct("*"), {"ignoreNullFields": "false", **_EXACT_TIME}).alias("_row"))
    new = rows.groupBy("_id").applyInPandasWithState(first, "_row string", "seen boolean", "append", GroupStateTimeout.NoTimeout)
    return new.select(F.from_json("_row", stream.schema, _EXACT_TIME).alias("r")).select("r.*")


def _side(target: str) -> str:
    return target.rstrip("/") + "_highest"


def write_new_rows(new: DataFrame, target: str, id_col: str, epoch: int) -> None:
    """One batch's rows as one set of files, and the highest id up to it."""
    spark = new.sparkSession
    new.write.mode("overwrite").parquet(f"{target}/_batch={epoch}")
    before = _earlier(spark, _side(target), epoch)
    mine = spark.read.schema(new.schema).parquet(f"{target}/_batch={epoch}").agg(F.max(id_col).alias("highest_id"), F.count(F.lit(1)).alias("n_new"))
    if before is not None:
        last = before.agg(F.max("highest_id")).first()[0]
        mine = mine.withColumn("highest_id", F.greatest("highest_id", F.lit(last).cast("long")))
    mine.select(F.col("highest_id").cast("long").alias("highest_id"), "n_new").write.mode("overwrite").parquet(f"{_side(target)}/_batch={epoch}")


def highest_id(spark: SparkSession, target: str) -> DataFrame:
    """(highest_id, n_held) of a feed, from the side values of its batches."""
    return spark.read.schema("highest_id long, n_new long, _batch int").parquet(_side(target)).agg(
        F.max("highest_id").alias("highest_id"), F.coalesce(F.sum("n_new"), F.lit(0)).alias("n_held"))


def run_dedup_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str,
                     id_col: str, order_col: str, files_per_batch: int = 1) -> None:
    """Run ST1 over every file now in `source_dir` (Trigger.AvailableNow)."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source_dir)
    q = (first_versions(stream, id_col, order_col)
         .writeStream.option("checkpointLocation", checkpoint).outputMode("append")
         .foreachBatch(lambda df, epoch: write_new_rows(df, target, id_col, epoch))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def cursor_append_batch(batch: DataFrame, target: str, oid_col: str, epoch: int) -> None:
    """ST2 for one micro-batch. The cursor of a batch is a row of the side
    table `<target>_cursor`, so finding it never scans the target; the ids of
    the target are read only when the batch has rows at or below the cursor."""
    spark = batch.sparkSession
    cursor_path = target.rstrip("/") + "_cursor"
    cursors = _earlier(spark, cursor_path, epoch)
    last = cursors.agg(F.max("cursor")).first()[0] if cursors is not None else None
    new = _first_rows(batch, oid_col, F.xxhash64(*batch.columns))
    if last is not None:
        late = new.where(F.col(oid_col) <= last)
        new = new.where(F.col(oid_col) > last)
        if not late.isEmpty():
            new = new.unionByName(late.join(_earlier(spark, target, epoch).select(oid_col), oid_col, "left_anti"))
    new.sortWithinPartitions(oid_col).write.mode("overwrite").parquet(f"{target}/_batch={epoch}")
    highest = spark.read.parquet(f"{target}/_batch={epoch}").agg(F.max(oid_col).alias("cursor"))
    highest.select(F.greatest("cursor", F.lit(last).cast("long")).alias("cursor")).where("cursor IS NOT NULL") \
        .write.mode("overwrite").parquet(f"{cursor_path}/_batch={epoch}")


def run_cursor_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str, checkpoint: str,
                      oid_col: str, files_per_batch: int = 1) -> None:
    """Run ST2 over every file now in `source_dir` (Trigger.AvailableNow)."""
    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source_dir)
         .writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, epoch: cursor_append_batch(df, target, oid_col, epoch))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def batch_first_versions(rows: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """The batch equivalent of ST1 over all rows at once (for equality tests)."""
    return _first_rows(rows, id_col, F.col(order_col))

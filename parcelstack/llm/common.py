"""Helpers shared by the operators: column selection, lineage cuts, text slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Bytes of text that one Python step holds as arrays at a time. Rows are never
# cut: a single longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

# What separates words in the operators' contracts: space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a compressed Parquet table in the shared folder: for wide or
    long tables that several later scans read."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text) of every row, a null text as empty; whatever other
    columns the input has are left out, so their names cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows holding about `limit` bytes of `column`."""
    col = batch.column(batch.schema.get_field_index(column))
    if len(col) == 0:
        return
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64))
    lo = 0
    while lo < len(col):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column without nulls as (all UTF-8 bytes, row offsets)."""
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start[i], start[i]+1, ... of each run, all runs one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)

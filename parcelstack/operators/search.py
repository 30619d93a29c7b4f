"""Free-text search over lead records by a postings table.

`build_postings` is run once per build: every searched text (address, owner,
pid, and the signal payload as JSON), lower-cased, is listed under each of its
distinct trigrams. A search reads the postings of its own trigrams only, keeps the texts
that hold all of them, and tests those records by the substring itself, so
results equal `report.matches` whatever the text. Texts of fewer than three
characters have no trigram: they are searched by the substring test alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import report

GRAM = 3
# Characters of a block: its lists are made at once, in about 60 bytes a character.
BLOCK_CHARS = 1 << 20
# Folders of the postings table; a search of g trigrams opens at most g of them.
BUCKETS = 64
PLAIN = ("address", "owner", "pid")
PAYLOAD = "signals"


def _bucket(gram):
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def posting_lists(fields: tuple[str, ...], block_chars: int = BLOCK_CHARS):
    """A function over Arrow batches of a pid and a text for each field: (gram,
    field, pids) of each block of rows, a pid once in a list. Its work is that
    of sorting the block's characters; a text is never cut."""
    def of_block(texts: list[str], pids: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
        n, sizes = len(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        if len(chars) < GRAM:
            return
        # characters by their place in the block's own alphabet, so that a trigram and its row are one number
        seen = np.zeros(0x110000, bool)
        seen[chars] = True
        alphabet = np.flatnonzero(seen)
        a = len(alphabet)
        if n > 1 and a ** GRAM * n >= 1 << 63:
            for half in (slice(0, n // 2), slice(n // 2, n)):
                yield from of_block(texts[half], pids[half])
            return
        place = np.zeros(0x110000, np.int64)
        place[alphabet] = np.arange(a)
        at = place[chars]
        row = np.repeat(np.arange(n), sizes)
        whole = row[2:] == row[:-2]  # a trigram does not run into the next text
        keys = np.unique((((at[:-2] * a + at[1:-1]) * a + at[2:]) * n + row[:-2])[whole])
        codes, row = keys // n, keys % n
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        if len(first):
            c = codes[first]
            text = np.stack([c // (a * a), c // a % a, c % a], 1)
            text = alphabet[text].astype("<u4").tobytes().decode("utf-32-le")
            yield (pa.array([text[i:i + GRAM] for i in range(0, len(text), GRAM)]),
                   pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pids.take(pa.array(row))))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, col in zip(fields, batch.columns[1:], strict=True):
                held, own = col.drop_null().cast(pa.binary()), batch.column(0).filter(col.is_valid())
                block = np.cumsum(pc.binary_length(held).to_numpy(zero_copy_only=False).astype(np.int64)) // block_chars
                ends = [*(np.flatnonzero(np.diff(block)) + 1), len(held)] if len(held) else []
                for lo, hi in zip([0, *ends], ends):  # noqa: B905
                    texts = [t.decode("utf-8", "replace") for t in held[lo:hi].to_pylist()]
                    for gram, pids in of_block(texts, own[lo:hi]):
                        yield pa.RecordBatch.from_arrays([gram, pa.array([f] * len(gram)), pids], ["gram", "field", "pids"])

    return lists


def build_postings(records: DataFrame, path: str) -> None:
    """(bucket, gram, field, pids) of every record's texts, a list for each
    block of records, sorted by gram in the files, so that a search skips other
    buckets and row groups. What moves are lists: a gram that most records hold
    is dealt over the tasks by its blocks."""
    texts = [F.lower(F.col(f)).alias(f"t_{f}") for f in PLAIN] + [F.lower(F.to_json(PAYLOAD)).alias(f"t_{PAYLOAD}")]
    lists = records.select("pid", *texts).mapInArrow(posting_lists((*PLAIN, PAYLOAD)), "gram string, field string, pids array<string>")
    rows = lists.withColumn("bucket", _bucket("gram"))
    rows = rows.repartition("bucket", F.pmod(F.xxhash64(F.get("pids", F.lit(0))), F.lit(16)))
    rows.sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gram string, field string, pids array<string>, bucket int").parquet(path)


def candidates(postings: DataFrame, text: str, payload: bool = False) -> DataFrame:
    """(pid) of the records one of whose texts holds every trigram of `text`
    (at least three characters, lower case)."""
    asked = sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})
    buckets = [r[0] for r in postings.sparkSession.createDataFrame([(g,) for g in asked], "gram string")
               .select(_bucket("gram")).distinct().collect()]
    held = postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin(asked))
    if not payload:
        held = held.where(F.col("field") != PAYLOAD)
    held = held.select("field", F.explode("pids").alias("pid"))
    # pids are one row a record, so counting distinct grams is counting rows
    full = held.groupBy("pid", "field").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(asked))
    return full.select("pid").distinct()


def search(records: DataFrame, postings: DataFrame, spec: dict) -> DataFrame:
    """The records that `report.matches(spec)` selects, its text looked up in
    the postings first."""
    text = (spec.get("text") or "").lower()
    if len(text) >= GRAM:
        records = records.join(candidates(postings, text, bool(spec.get("search_signals"))), "pid", "left_semi")
    return records.where(report.matches(spec))

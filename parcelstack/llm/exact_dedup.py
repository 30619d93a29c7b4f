"""Exact dedup (operator 8): Golomb-coded fingerprint exchange.

1. Every partition sorts the fingerprints of its texts and sends, per owner of
   a fingerprint range, one Golomb-Rice coded message (gaps of sorted values;
   a fingerprint is sent once however often the partition has it, with a bit
   for "more than once here"). A hot text therefore costs one code a partition.
2. Owners decode all messages of their range and answer each with a bitmap:
   which of its fingerprints are duplicated.
3. Senders turn bitmaps back into suspect fingerprints. These set bits of a
   filter of bounded size (at most FILTER_BITS), which is broadcast; texts
   whose bit is unset are unique and never move. Saturation of the filter
   costs traffic, not results.
4. Suspects alone are shuffled with their bytes: grouping by fingerprint and
   text itself verifies equality (and collapses copies before the shuffle).

Messages are checkpointed, so a sender's bitmap still fits if a task reruns.

Defined results: a null text counts as empty, and all empty texts are equal;
of equal texts the largest doc_id stays (null ids lose to any other; where
all are null `copies` marks every row kept, as its SQL does, and `dedup` keeps
one of them); rows that repeat both a doc_id and text are the same document and
share its verdict;
other columns are passed through or ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

FINGERPRINT_BITS = 48
# Fingerprints that a sender holds before it sends them off; a partition with
# more sends several messages to an owner.
MESSAGE_FINGERPRINTS = 1 << 20
# Distinct fingerprints that an owner is to hold at most, on average.
OWNER_FINGERPRINTS = 1 << 20
# Upper bound of the broadcast filter: 2^28 bits are 32 MB.
FILTER_BITS = 28
FILTER_CHUNK = 1 << 12


def rice_encode(values: np.ndarray, span: int) -> tuple[int, bytes]:
    """Golomb-Rice code of sorted distinct values in [0, span): (parameter,
    code). Quotients of the gaps stand in unary in front, remainders behind."""
    n = len(values)
    k = max(0, (span // n).bit_length() - 1)
    gaps = np.diff(values, prepend=-1) - 1
    q, r = gaps >> k, gaps & ((1 << k) - 1)
    unary = np.zeros(int(q.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(q + 1) - 1] = 1
    low = ((r[:, None] >> np.arange(k - 1, -1, -1)) & 1).astype(np.uint8).ravel()
    return k, len(unary).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(low).tobytes()


def rice_decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The values of rice_encode."""
    n_unary = int.from_bytes(code[:8], "little")
    mid = 8 + (n_unary + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[8:mid], dtype=np.uint8), count=n_unary)
    q = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(code[mid:], dtype=np.uint8), count=n * k).reshape(n, k).astype(np.int64)
    r = low @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64)) if k else np.zeros(n, dtype=np.int64)
    return np.cumsum((q << k) + r + 1) - 1


def owner_bits_for(spark, fingerprints: int) -> int:
    """log2 of the number of owners: set by the number of fingerprints, so that
    an owner's group stays bounded, and enough of them for the shuffle's tasks.
    Owners are ranges, so fingerprints have to be evenly spread over theirs."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(3, (tasks // 4).bit_length(), (fingerprints // OWNER_FINGERPRINTS).bit_length())


def text_bytes_of(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


MESSAGE = "sender long, owner int, n int, k int, code binary, again binary"


def messages(rows: DataFrame, owner_bits: int, of=None) -> DataFrame:
    """One row per (sender, owner) with the sender's sorted fingerprints: the
    rows' column `fp`, or what `of` yields as `fp` of batches of the rows. It
    runs in the sending step itself, as a step of its own before this one would
    keep a second Python worker, with all its memory, at every core."""
    low = FINGERPRINT_BITS - owner_bits

    def send(batches):
        sender = TaskContext.get().partitionId() << 24

        def flush(held):
            fp, count = np.unique(np.concatenate(held), return_counts=True)
            owner = fp >> low
            edge = np.searchsorted(owner, np.arange((1 << owner_bits) + 1))
            rows = []
            for o in np.flatnonzero(np.diff(edge)).tolist():
                a, b = int(edge[o]), int(edge[o + 1])
                k, code = rice_encode(fp[a:b] - (o << low), 1 << low)
                rows.append((sender, o, b - a, k, code, np.packbits(count[a:b] > 1).tobytes()))
            return pa.RecordBatch.from_pydict(dict(zip(
                ("sender", "owner", "n", "k", "code", "again"),
                (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)), strict=True)))

        held, n = [], 0
        for batch in of(batches) if of else batches:
            fp = np.asarray(batch.column("fp"), dtype=np.int64)
            if len(fp):
                held.append(fp)
                n += len(fp)
            if n >= MESSAGE_FINGERPRINTS:
                yield flush(held)
                held, n, sender = [], 0, sender + 1
        if held:
            yield flush(held)

    return rows.mapInArrow(send, MESSAGE)


def bitmaps(sent: DataFrame) -> DataFrame:
    """The owners' answers: (sender, owner, bitmap of duplicated fingerprints)."""
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        values = [rice_decode(n, k, c) for n, k, c in zip(group["n"], group["k"], group["code"], strict=True)]
        again = [np.unpackbits(np.frombuffer(a, dtype=np.uint8), count=n).astype(bool)
                 for n, a in zip(group["n"], group["again"], strict=True)]
        fp, inverse, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        twice = count > 1
        twice[inverse[np.concatenate(again)]] = True
        marks = np.split(twice[inverse], np.cumsum([len(v) for v in values])[:-1])
        return pd.DataFrame({"sender": group["sender"], "owner": group["owner"],
                             "bitmap": [np.packbits(m).tobytes() for m in marks]})

    return sent.select("sender", "owner", "n", "k", "code", "again").groupBy("owner").applyInPandas(
        answer, "sender long, owner int, bitmap binary")


def suspects(sent: DataFrame, owner_bits: int) -> DataFrame:
    """(fp) of every fingerprint that occurs more than once."""
    low = FINGERPRINT_BITS - owner_bits

    def read(batches):
        for batch in batches:
            rows = batch.to_pydict()
            out = [rice_decode(n, k, c)[np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=n).astype(bool)] + (o << low)
                   for o, n, k, c, m in zip(*(rows[x] for x in ("owner", "n", "k", "code", "bitmap")), strict=True)]
            if out:
                yield pa.RecordBatch.from_pydict({"fp": pa.array(np.concatenate(out), pa.int64())})

    back = sent.drop("again").join(bitmaps(sent), ["sender", "owner"])
    return back.select("owner", "n", "k", "code", "bitmap").mapInArrow(read, "fp long").distinct()


def suspect_filter_bits(suspect: DataFrame) -> tuple[np.ndarray, int]:
    """(packed bits, log2 of their number): set for every fingerprint in `fp`."""
    n = suspect.count()
    bits = min(FILTER_BITS, max(16, (32 * n).bit_length()))

    def chunk(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(FILTER_CHUNK, dtype=np.uint8)
        marks[group["bit"].to_numpy()] = 1
        return pd.DataFrame({"chunk": group["chunk"][:1], "marks": [np.packbits(marks).tobytes()]})

    slot = F.shiftright("fp", FINGERPRINT_BITS - bits)
    rows = (suspect.select(slot.alias("slot")).distinct()
            .select(F.expr(f"slot div {FILTER_CHUNK}").alias("chunk"), F.expr(f"int(slot % {FILTER_CHUNK})").alias("bit"))
            .groupBy("chunk").applyInPandas(chunk, "chunk long, marks binary").collect())
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in rows:  # at most 2^FILTER_BITS / FILTER_CHUNK rows of 512 bytes
        table[r.chunk * FILTER_CHUNK // 8:][:FILTER_CHUNK // 8] = np.frombuffer(r.marks, dtype=np.uint8)
    return table, bits


def holds(table: np.ndarray, bits: int, fp: np.ndarray) -> np.ndarray:
    """Whether the filter has the bit of each fingerprint."""
    at = fp >> (FINGERPRINT_BITS - bits)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def id_fingerprint(column: str = "doc_id"):
    """Fingerprint of an id column."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - FINGERPRINT_BITS)


def suspect_filter(spark, suspect: DataFrame):
    """A predicate on a fingerprint column that holds for every suspect, and
    for few others while the filter is not saturated."""
    shared = spark.sparkContext.broadcast(suspect_filter_bits(suspect))

    @F.pandas_udf("boolean")
    def suspected(fp: pd.Series) -> pd.Series:
        return pd.Series(holds(*shared.value, fp.fillna(0).to_numpy(dtype=np.int64)))

    return suspected


def copies(docs: DataFrame, owner_bits: int | None = None, smallest: bool = False) -> DataFrame:
    """All columns of `docs` under `doc` (a struct), with text (null as
    empty), keep_id, group_size and kept. `owner_bits`: 2^bits owners; by
    default `owner_bits_for` the rows. `smallest`: the smallest
    doc_id of a group stays instead of the largest."""
    spark = docs.sparkSession
    if owner_bits is None:
        owner_bits = owner_bits_for(spark, docs.count())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col("doc_id").cast("long").alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("fp", F.shiftrightunsigned(F.xxhash64("body"), 64 - FINGERPRINT_BITS))
    sent = cut(messages(rows.select("fp"), owner_bits))
    suspected = suspect_filter(spark, cut(suspects(sent, owner_bits)))
    alone = rows.where(~suspected("fp")).select("doc", "id", "body", F.col("id").alias("keep_id"),
                                                F.lit(1).cast("long").alias("group_size"))
    some = rows.where(suspected("fp"))
    groups = some.groupBy("fp", "body").agg((F.min if smallest else F.max)("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # the redundant key gives the join an exchange of its own, whose large
    # partitions (the copies of one text) can be split at run time
    spread = F.xxhash64(F.lit(1), "body").alias("spread")
    some = some.select("*", spread).join(groups.select("*", spread), ["fp", "body", "spread"]).select("doc", "id", "body", "keep_id", "group_size")
    return alone.unionAll(some).select("doc", F.col("body").alias("text"), "keep_id", "group_size",
                                       F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Where every row of
    a text is without a doc_id, one of them stays: the one whose columns have
    the smallest hash (rows of one hash are equal, so any of them)."""
    kept = copies(docs).where("kept")
    nameless = F.col("doc.doc_id").isNull() & (F.col("group_size") > 1)
    one = kept.where(nameless).groupBy("text").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return kept.where(~nameless).select("doc.*").unionAll(one.select("doc.*"))

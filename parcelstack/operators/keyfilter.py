"""A prefilter of join keys: which keys of a large array column may meet a
smaller side's keys, tested before they are exploded and shuffled.

The smaller side's keys set bits of a table of 64-bit words, a single row that
reaches the large side's scan as a scalar subquery. Its size is set by a count
of the distinct keys, BITS_A_KEY bits each, and never above MAX_BITS (8 MB);
with fewer than MIN_BITS_A_KEY bits a key there (more than 8.4 million keys)
there is no filter and the join takes all keys. Keys that hit a bit by chance
only cost traffic, since the join follows; none that matches is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY = 16
MIN_BITS_A_KEY = 8
MAX_BITS = 26


def _slot(key, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def key_words(rows: DataFrame, keys: str) -> tuple[DataFrame, int] | None:
    """(one row `words` array<bigint>, log2 of its bits) of the keys in the
    array column `keys` of a stored table; None if there are too many."""
    n = rows.select(F.explode(keys).alias("key")).agg(F.approx_count_distinct("key")).first()[0]
    if n * MIN_BITS_A_KEY > 1 << MAX_BITS:
        return None
    bits = min(max(10, (n * BITS_A_KEY).bit_length()), MAX_BITS)
    slots = rows.select(F.explode(keys).alias("key")).where("key IS NOT NULL").select(_slot("key", bits).alias("slot"))
    words = slots.select(F.expr("slot div 64").alias("i"), F.expr("shiftleft(1L, int(slot % 64))").alias("w"))
    blank = rows.sparkSession.range((1 << bits) // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    full = words.unionByName(blank).groupBy("i").agg(F.bit_or("w").alias("w"))
    table = full.agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("t"))
    return table.select(F.transform("t", lambda x: x["w"]).alias("words")), bits


def _hit(key: Column, words: Column, bits: int) -> Column:
    slot = _slot(key, bits)
    word = F.get(words, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1


def with_hit(rows: DataFrame, key: str, words: tuple[DataFrame, int] | None, out: str) -> DataFrame:
    """`rows` with the boolean `out`: false where `key` is null, blank or none
    of the filter's keys. The key is bound once, as the element of an array, so
    that its own expression is not repeated in filters of `out`."""
    def may(k, word_col=None, bits=0):
        full = F.coalesce(k, F.lit("")) != ""
        return full if word_col is None else full & _hit(k, word_col, bits)

    if words is None:
        return rows.withColumn(out, may(F.col(key)))
    table, bits = words
    held = rows.withColumn("_words", table.scalar())
    one = F.transform(F.array(key), lambda k: may(k, F.col("_words"), bits))
    return held.withColumn(out, F.element_at(one, 1)).drop("_words")


def may_meet(rows: DataFrame, keys: str, words: tuple[DataFrame, int] | None) -> DataFrame:
    """`rows` with only those keys in the array column `keys` that may be among
    the filter's; rows that keep none go."""
    if words is None:
        return rows
    table, bits = words

    own = rows.columns
    held = rows.withColumn("_words", table.scalar()).withColumn(keys, F.filter(keys, lambda k: _hit(k, F.col("_words"), bits)))
    return held.where(F.size(keys) > 0).select(*own)

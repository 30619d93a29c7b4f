"""Mixing sources to target weights (operator 4), DataFrame functions only.

Each source is its documents one after another (in hash-bucket order, those
without a doc_id dealt by a hash of their text), packed
into blocks of `block` words; the last block may be short. Output shards draw
multinomial source counts, slot by slot from a hash of (seed, slot); slots of
a source that drew more than its quota go to the sources that drew less, so
each source ends with exactly the slots that its target needs. The i-th slot
of a source is block i of a pseudorandom permutation of its blocks, drawn anew
for each pass over the source (the last, possibly short block ends a pass);
slots and document pieces meet on (source, block). A source's last slot is cut
to what its target still needs. Since a target is at most `cap` times its
source, no block is passed more than `cap` times.

Offsets are running totals in two levels (buckets, then rows of a bucket), so
a source with a third of all rows still spreads over many tasks.

Defined results: a null or empty text has 0 words and is never taken; the null
source is a source, ordered last; weights repeat over the sources in code
point order; with no words at all every target is 0; rows that repeat a doc_id
are documents of their own; other columns are ignored; reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, stored, texts


def doc_sizes(docs: DataFrame, keys: tuple = ()) -> DataFrame:
    """(doc_id, source, size, content, keys): the words and a hash of every
    whole text."""
    t = texts(docs, F.col("source").cast("string").alias("source"), *keys)
    return t.select("doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"),
                    F.xxhash64("text").alias("content"), *keys)


def source_targets(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_no, n_docs, source_size, target): `share` of all words
    split by weight, none above `cap` times its source, the excess reshared.

    With sources ordered by cap * size / weight, those that reach their cap
    are the first ones, and the common level of the rest is the largest of
    (words left after the caps before) / (weights from here on)."""
    by = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    no = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("source_no", no)
    by = by.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                         (F.col("source_no") % len(weights) + 1).cast("int")))
    most = F.col("source_size") * cap
    order = W.orderBy(most / F.col("w"), "source_no")
    level = ((F.sum("source_size").over(W.partitionBy()) * F.lit(share)
              - F.coalesce(F.sum(most).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
    by = by.withColumn("level", level)
    by = by.withColumn("target", F.least(most.cast("double"), F.max("level").over(W.partitionBy()) * F.col("w")))
    return by.select("source", "source_no", "n_docs", "source_size", "target")


def running_total(df: DataFrame, key: list[str], bucket: str, order: list[str], value, name: str) -> DataFrame:
    """Adds `name`: the sum of `value` over the rows of the same key before
    this one, rows ordered by bucket, then `order`."""
    totals = df.groupBy(*key, bucket).agg(F.sum(value).alias("_t"))
    before = W.partitionBy(*key).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("_b", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    inside = W.partitionBy(*key, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return df.join(totals, [*key, bucket]).withColumn(name, F.col("_b") + F.col("_i")).drop("_b", "_i")


def draw_slots(spark, quotas: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(slot, shard, source_no, position): multinomial draws of a source for
    every slot, settled to the quotas. `quotas`: (source_no, quota)."""
    # a slot's draw r in [0, n) falls into the interval of a source; intervals
    # are found by equal pieces, at most 4,096 and one more per source
    piece = n_slots // 4096 + 1
    hi = F.sum("quota").over(W.orderBy("source_no").rowsBetween(W.unboundedPreceding, 0))
    spans = quotas.where("quota > 0").withColumn("hi", hi).withColumn("lo", F.col("hi") - F.col("quota"))
    spans = spans.withColumn("piece", F.explode(F.expr(f"sequence(lo div {piece}, (hi - 1) div {piece})")))
    drawn = spark.range(n_slots).select(F.col("id").alias("slot"), F.expr(f"id div {shard_slots}").alias("shard"),
                                        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n_slots)).alias("r"))
    drawn = drawn.withColumn("piece", F.expr(f"r div {piece}"))
    drawn = drawn.join(spans, "piece").where("r >= lo and r < hi").select("slot", "shard", "source_no", "quota")
    # counts per shard and source, and where a shard's slots start in each source
    counts = drawn.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.withColumn("far", F.expr("shard div 1024"))
    starts = running_total(counts, ["source_no"], "far", ["shard"], "c", "start").select("shard", "source_no", "start")
    nth = F.row_number().over(W.partitionBy("shard", "source_no").orderBy("slot")) - 1
    drawn = drawn.withColumn("nth", nth).join(starts, ["shard", "source_no"])
    drawn = drawn.withColumn("position", F.col("start") + F.col("nth")).select(
        "slot", "shard", "source_no", "quota", "position")
    drawn = cut(drawn)
    got = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("got"))
    level = quotas.join(got, "source_no", "left").select(
        "source_no", "quota", F.coalesce("got", F.lit(0)).alias("got"))
    prior = W.orderBy("source_no").rowsBetween(W.unboundedPreceding, -1)
    for name, x in (("over", F.col("got") - F.col("quota")), ("under", F.col("quota") - F.col("got"))):
        level = level.withColumn(name, F.greatest(x, F.lit(0)))
        level = level.withColumn(f"{name}_at", F.coalesce(F.sum(name).over(prior), F.lit(0)))
    surplus = drawn.where("position >= quota").join(level.select("source_no", "over_at"), "source_no").select(
        "slot", "shard", (F.col("over_at") + F.col("position") - F.col("quota")).alias("nth"))
    missing = level.where("under > 0").select(
        "source_no", "got", "under_at", F.explode(F.expr("sequence(0L, under - 1)")).alias("j")).select(
        "source_no", (F.col("got") + F.col("j")).alias("position"), (F.col("under_at") + F.col("j")).alias("nth"))
    moved = surplus.join(missing, "nth").select("slot", "shard", "source_no", "position")
    return drawn.where("position < quota").select("slot", "shard", "source_no", "position").unionByName(moved)


def pass_blocks(targets: DataFrame, seed: int, stretch: int = 4096) -> DataFrame:
    """(source_no, pass, block, h): every block of every pass over a source and
    the hash that ranks it. The sources lie in one partition, so their
    stretches of blocks are dealt out to tasks before blocks become rows."""
    spread = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    perm = targets.where("quota > 0").select("source_no", "blocks", F.explode(F.expr(
        "sequence(0L, (quota - 1) div blocks)")).alias("pass"))
    perm = perm.select("*", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {stretch})")).alias("piece"))
    perm = perm.repartition(spread, F.xxhash64("source_no", "pass", "piece"))
    perm = perm.select("source_no", "pass", "blocks", F.explode(F.expr(
        f"sequence(piece * {stretch}, least(piece * {stretch} + {stretch - 1}, blocks - 1))")).alias("block"))
    rank = F.when(F.col("block") < F.col("blocks") - 1, F.shiftrightunsigned(
        F.xxhash64(F.lit(seed + 1), "source_no", "pass", "block"), 1)).otherwise(F.lit((1 << 63) - 1))
    return perm.select("source_no", "pass", "block", rank.alias("h"))


def plan(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, cap: int = 2, block: int = 256,
         shard_slots: int = 1024, seed: int = 20240229, keys: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). documents: doc_id, source_no, size, source_size,
    target, start (words of its source before it). pieces: what the mix takes,
    in output order of (shard, slot): shard, slot, pass, source_no, start,
    doc_id, first_word, n_words. (source_no, start) tells documents with words
    apart. `keys`: columns of `docs` that are kept in documents and order rows
    of equal doc_id and text."""
    spark = docs.sparkSession
    sizes = cut(doc_sizes(docs, keys))
    targets = cut(source_targets(sizes, weights, share, cap)
                  .withColumn("take", F.round("target").cast("long"))
                  .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
                  .withColumn("passes", F.expr("if(source_size > 0, take div source_size, 0L)"))
                  .withColumn("quota", F.expr(
                      f"if(source_size > 0, passes * blocks + (take - passes * source_size + {block - 1}) div {block}, 0L)")))
    total = targets.agg(F.sum("quota").alias("slots"), F.sum("n_docs").alias("docs")).first()
    n_slots, n_docs = total.slots or 0, total.docs or 0
    # documents in their sources; about sqrt(n) buckets
    buckets = 1 << ((n_docs.bit_length() + 1) // 2)
    placed = sizes.withColumn("s", F.col("source")).drop("source").join(
        targets, F.col("s").eqNullSafe(F.col("source"))).select("doc_id", "source_no", "size", "source_size", "target", "content", *keys)
    dealt = F.when(F.col("doc_id").isNull(), F.col("content")).otherwise(F.xxhash64("doc_id"))
    placed = placed.withColumn("bucket", F.pmod(dealt, F.lit(buckets)))
    placed = running_total(placed, ["source_no"], "bucket", ["doc_id", "size", "content", *keys], "size", "start")
    placed = placed.drop("bucket", "content")
    placed = cut(placed)
    parts = placed.where("size > 0").withColumn("block", F.explode(F.expr(
        f"sequence(start div {block}, (start + size - 1) div {block})"))).select(
        "source_no", "block", "start", "doc_id", F.greatest("start", F.col("block") * block).alias("lo"),
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block).alias("hi"))
    slots = draw_slots(spark, targets.select("source_no", "quota"), n_slots, shard_slots, seed)
    info = targets.select("source_no", "source_size", "take", "blocks")
    slots = slots.join(info, "source_no").select(
        "slot", "shard", "source_no", F.expr("position div blocks").alias("pass"),
        F.expr("position % blocks").alias("nth"),
        F.expr(f"take - (position div blocks) * source_size - (position % blocks) * {block}").alias("left"))
    # permutations: blocks of a pass ranked by a hash, the last block last
    perm = pass_blocks(targets, seed)
    rank_buckets = 1 << ((n_slots.bit_length() + 1) // 2)
    shift = 63 - (rank_buckets.bit_length() - 1)
    perm = perm.withColumn("hb", F.shiftright("h", shift)).withColumn("one", F.lit(1).cast("long"))
    perm = running_total(perm, ["source_no", "pass"], "hb", ["h", "block"], "one", "nth").select(
        "source_no", "pass", "nth", "block")
    taken = slots.join(perm, ["source_no", "pass", "nth"]).join(parts, ["source_no", "block"])
    end = F.least("hi", F.col("block") * block + F.col("left"))
    taken = taken.withColumn("n_words", end - F.col("lo")).where("n_words > 0").select(
        "shard", "slot", "pass", "source_no", "start", "doc_id", (F.col("lo") - F.col("start")).alias("first_word"), "n_words")
    return placed, taken


def taken_words(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    sums = pieces.groupBy("source_no", "start").agg(F.sum("n_words").alias("sum"))
    full = placed.where("size > 0").join(sums, ["source_no", "start"], "left")
    cols = ["doc_id", "size", "source_size", "target"]
    return full.select(*cols, F.coalesce("sum", F.lit(0)).cast("long").alias("taken")).unionByName(
        placed.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row per document and pass that takes words of
    it, with the input's columns; text holds the words taken, joined by one
    space (the unchanged text where a pass takes all of it), n_chars its
    length. Every row of the input is a document of its own, whether its doc_id
    is null or repeated: rows are stored once with a number, and the pieces of
    (source_no, start) meet their row by it."""
    kept = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                              F.monotonically_increasing_id().alias("_row")))
    placed, pieces = plan(kept.select("doc.doc_id", "doc.text", "doc.source", "_row"), keys=("_row",), **options)
    runs = pieces.groupBy("source_no", "start", "pass").agg(
        F.sum("n_words").alias("_n"), F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_runs"))
    runs = runs.join(placed.where("size > 0").select("source_no", "start", "_row", "size"), ["source_no", "start"]).select(
        "_row", "_n", "_runs", F.col("size").alias("_size"))
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    part = F.expr("array_join(flatten(transform(_runs, r -> slice(_words, int(r.first_word) + 1, int(r.n_words)))), ' ')")
    out = kept.join(runs, "_row").select("doc", "_n", "_runs", "_size", F.col("doc.text").alias("text"))
    out = out.withColumn("_words", F.when(F.col("_n") < F.col("_size"), words))
    out = out.withColumn("text", F.when(F.col("_n") < F.col("_size"), part).otherwise(F.col("text")))
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[made.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])

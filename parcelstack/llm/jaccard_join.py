"""N-gram Jaccard join (operator 5): grouped prefix join.

Documents are sets of word shingles; two link when 100 * intersection >=
threshold * union. Linked sets share a shingle among the first
n - ceil(threshold% * n) + 1 of each, under any one order of all shingles. The
order used is rare first, by a sketch of document frequencies over all
documents (fixed size, hash-indexed counters; ties by hash), so passages that
very many documents share come last and hardly ever into a prefix.

1. Copies of a whole text are collapsed first (`exact_dedup.copies`).
2. One scan sums the sketch; a second sends the prefix shingles through the
   fingerprint exchange, which finds those that occur twice; a third lists per
   document its prefix shingles that do (texts are scanned again, not moved).
3. Documents of identical prefix and size form a group. Per shingle and size
   band the group that shares most with others is the hub; each group is
   paired with the hubs that it shares most shingles with, and each member
   with its group's head. Verified pairs make first components.
4. Shingles whose documents lie in several components still may hide links:
   all pairs across components there that pass the size filter are verified
   too. Pairs inside a component need no check, since they change nothing.
   One shingle of the two must lie in the shorter prefix that suffices for
   the smaller set (n - ceil(2t / (1 + t) * n) + 1). Of shingles with the same
   documents one is looked at, as the others give the same pairs.

A pair is verified in two steps: the parities of the shingle counts per hash
bin (128 bytes a document) differ in no more bins than the sets differ in
shingles, which bounds the intersection from above, and only pairs that this
leaves open are compared by their whole sets.

So the work stays linear in a group of near copies, however large, while no
link between components is lost; the result is the components.

Defined results: documents without words have no shingles and link with
nothing; with fewer words than a shingle the whole sequence is one shingle;
only A-Z are folded to lower case; rows without an id have a component of
null and connect nothing; rows that repeat id and text are one document;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import words as H
from .common import cut, ragged, slices, stored, texts
from .components import components
from .exact_dedup import (FINGERPRINT_BITS, copies, holds, id_fingerprint, messages, owner_bits_for, suspect_filter,
                          suspect_filter_bits, suspects, text_bytes_of)

SKETCH_BITS = 18
SKETCH_CHUNK = 4096
# Parity bits of a document: sets of a few thousand shingles that miss the
# threshold by some hundredths are told apart by them.
PARITIES = 1024
# Documents of one shingle that a task pairs with as many others at a time.
BLOCK = 1024
# Hubs that a group is paired with before components are first formed.
HUBS = 2


def shingle_sets(part: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = H.word_hashes(part.column("text"), lower=True)
    h = H.window_hashes(words, k)
    out, lo = [], 0
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(h[lo:lo + n - k + 1]))
        elif n:
            out.append(H.window_hashes(words[lo:lo + n], n))
        else:
            out.append(np.zeros(0, np.uint64))
        lo += n
    return out


def prefix_fp(p: np.ndarray) -> np.ndarray:
    """Fingerprints of prefix shingles. Prefixes prefer small hashes among
    equal counts; mixed again, they spread evenly over owners and filter."""
    return (H.mix(p, 11) >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)


def prefix(s: np.ndarray, sketch: np.ndarray, threshold: int) -> np.ndarray:
    """The first n - ceil(threshold% n) + 1 shingles in order of (count, hash)."""
    if not len(s):
        return s
    order = np.argsort(sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
    return s[order[:len(s) - (threshold * len(s) + 99) // 100 + 1]]


def frequency_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Counters of how many documents hold the shingles of each hash slot."""
    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part, k)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                total += np.bincount((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        if total.any():
            from pyspark import TaskContext
            rows = total.reshape(-1, SKETCH_CHUNK)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(np.arange(len(rows), dtype=np.int32)),
                "salt": pa.array(np.full(len(rows), TaskContext.get().partitionId() % 64, dtype=np.int32)),
                "c": pa.array([r.tobytes() for r in rows], pa.binary())})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH_CHUNK, dtype=np.int64)
        for c in group["c"]:
            total += np.frombuffer(c, dtype=np.int64)
        return pd.DataFrame({"chunk": group["chunk"][:1], "salt": group["salt"][:1], "c": [total.tobytes()]})

    form = "chunk int, salt int, c binary"
    parts = docs.select("text").mapInArrow(count, form).groupBy("chunk", "salt").applyInPandas(add, form)
    rows = parts.groupBy("chunk").applyInPandas(add, form).collect()  # 2^SKETCH_BITS counters in all
    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for r in rows:
        sketch[r.chunk * SKETCH_CHUNK:(r.chunk + 1) * SKETCH_CHUNK] = np.frombuffer(r.c, dtype=np.int64)
    return sketch


def prefixes(live: DataFrame, k: int, threshold: int) -> DataFrame:
    """(doc_id, n, gid, tokens, n_short, bins): set size, group, the prefix
    shingles that occur in more than one document's prefix (n_short of them in
    the shorter prefix), and parity bits of the set."""
    spark = live.sparkSession
    sketch = spark.sparkContext.broadcast(frequency_sketch(live, k))

    def tokens(batches):
        for batch in batches:
            for part in slices(batch):
                own = [prefix(s, sketch.value, threshold) for s in shingle_sets(part, k)]
                flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_pydict({"fp": pa.array(prefix_fp(flat))})

    # a text has a word for two bytes at most, and its prefix about (100 - threshold)% of its shingles
    owner_bits = owner_bits_for(spark, text_bytes_of(live) * (100 - threshold) // 200 + live.count())
    sent = cut(messages(live.select("text"), owner_bits, of=tokens))
    known = spark.sparkContext.broadcast(suspect_filter_bits(cut(suspects(sent, owner_bits))))

    def rows(batches):
        table, bits = known.value
        for batch in batches:
            for part in slices(batch):
                n, gid, toks, n_short, bins = [], [], [], [], []
                for s in shingle_sets(part, k):
                    p = prefix(s, sketch.value, threshold)
                    twice = holds(table, bits, prefix_fp(p))
                    n.append(len(s))
                    gid.append(int(H.mix((H.mix(p, 3) * np.arange(1, 2 * len(p), 2, dtype=np.uint64)).sum(dtype=np.uint64, keepdims=True),
                                         len(s)).view(np.int64)[0]))
                    toks.append(p[twice].view(np.int64))
                    short = len(s) + (-200 * threshold * len(s) // (100 * (100 + threshold))) + 1 if len(s) else 0
                    n_short.append(int(twice[:max(short, 0)].sum()))
                    bins.append(parities(s))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int32()), pa.array(gid, pa.int64()), pa.array(toks, pa.list_(pa.int64())),
                     pa.array(n_short, pa.int32()), pa.array(bins, pa.binary())],
                    ["doc_id", "n", "gid", "tokens", "n_short", "bins"])

    return stored(live.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n int, gid long, tokens array<long>, n_short int, bins binary"))


def parities(s: np.ndarray) -> bytes:
    """Whether a set has an odd number of shingles, per hash bin, as bits."""
    count = np.bincount((s & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def parity_rows(col) -> np.ndarray:
    """The parity bits of a column, a row of 64-bit words each."""
    words = np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint64)
    return words.reshape(len(col), len(words) // max(1, len(col)))


def may_reach(na: np.ndarray, nb: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: int) -> np.ndarray:
    """Whether sets of these sizes and parity bits can reach the threshold:
    each bin whose parities differ holds a shingle that one of the two lacks."""
    both = (na + nb - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)) // 2
    return 100 * both >= threshold * (na + nb - both)


def possible(docs: DataFrame, pairs: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose parity bits leave the threshold possible."""
    def bound(batches):
        for batch in batches:
            na, nb = (np.asarray(batch.column(c), dtype=np.int64) for c in ("na", "nb"))
            x, y = (parity_rows(batch.column(c)) for c in ("xa", "xb"))
            yield batch.select(["a", "b"]).filter(pa.array(may_reach(na, nb, x, y, threshold), pa.bool_()))

    x, y = (docs.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("bins").alias(f"x{c}")) for c in "ab")
    return pairs.distinct().join(x, "a").join(y, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(bound, "a long, b long")


def dealt(entries: DataFrame) -> DataFrame:
    """`entries` in cells (token, lo, hi), with their own `block` (lo or hi).
    A shingle of at most BLOCK documents is one cell. In a larger one the
    components of more than BLOCK documents are cut into blocks of their own,
    the others share blocks, each whole in one; every two blocks make a cell,
    but for two of one component. So documents of different components meet
    once, and those of one component at most inside a shared block."""
    cols = ["token", "lo", "hi", "block", "doc_id", "n", "root", "short", "bins"]
    zero = F.lit(0).cast("long")
    small = entries.where(F.col("c") <= BLOCK).select("*", *[zero.alias(x) for x in ("lo", "hi", "block")]).select(*cols)
    big = entries.where(F.col("c") > BLOCK)
    per_root = cut(big.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m")))
    large = F.col("m") > BLOCK
    lots = per_root.groupBy("token", F.when(large, F.col("root")).alias("lot")).agg(F.sum("m").alias("m"))
    lots = lots.withColumn("blocks", F.expr(f"(m + {BLOCK - 1}) div {BLOCK}"))
    pieces = lots.select("token", "lot", "blocks", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("part"))
    number = F.row_number().over(W.partitionBy("token").orderBy(F.col("lot").asc_nulls_first(), "part")).cast("long")
    pieces = cut(pieces.withColumn("block", number))
    x, y = (pieces.select("token", F.col("lot").alias(f"lot_{c}"), F.col("block").alias(c)) for c in ("lo", "hi"))
    cells = x.join(y, "token").where("lo <= hi AND (lot_lo IS NULL OR NOT lot_lo <=> lot_hi)").select("token", "lo", "hi")
    sides = cells.select("token", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    # a component's own blocks, or the shared ones; the redundant key lets a hot key's partition be split
    spread = F.xxhash64(F.lit(7), "token", "root").alias("spread")
    of_root = per_root.select("token", "root", F.when(large, F.col("root")).alias("lot"), spread)
    placed = big.select("*", spread).join(of_root, ["token", "root", "spread"]).drop("spread")
    first = pieces.groupBy("token", F.col("lot").alias("of")).agg(F.min("block").alias("first"), F.max("blocks").alias("blocks"))
    whole = F.xxhash64(F.when(F.col("lot").isNull(), F.col("root")).otherwise(F.col("doc_id")))
    placed = placed.join(first.withColumnRenamed("token", "t"), (F.col("token") == F.col("t")) & F.col("lot").eqNullSafe(F.col("of")))
    placed = placed.withColumn("block", F.col("first") + F.pmod(whole, F.col("blocks"))).drop("t", "of")
    return small.unionByName(placed.join(sides, ["token", "block"]).select(*cols))


def across(entries: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of one shingle's documents that lie in different components
    and that sizes and parity bits leave possible. No pair inside a component is
    formed: linked copies that share a shingle with one other document cost a
    pair each. A shingle with many documents is dealt out as cells of two
    blocks each, so no task holds more than a few blocks; pairs are formed and
    tested as arrays and only the possible ones become rows."""
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["token", "lo", "hi", "block", "root", "doc_id"]
    e = dealt(entries).repartition(n, "token", "lo", "hi").sortWithinPartitions(*order)

    def pairs_of(rows: pa.Table):
        cols = {c: np.asarray(rows.column(c)) for c in ("token", "lo", "hi", "block", "doc_id", "n", "root", "short")}
        size = len(cols["n"])
        new = np.r_[True, (np.diff(cols["token"]) != 0) | (np.diff(cols["lo"]) != 0) | (np.diff(cols["hi"]) != 0)]
        edge = np.r_[np.flatnonzero(new), size]
        # a row's partners: from the end of its block's rows, or inside one block of its component's rows, to the end of the cell
        inside = cols["lo"] == cols["hi"]
        turn = np.r_[True, new[1:] | (np.diff(cols["block"]) != 0) | (inside[1:] & (np.diff(cols["root"]) != 0))]
        run = np.r_[np.flatnonzero(turn), size]
        start = np.repeat(run[1:], np.diff(run))
        after = np.repeat(edge[1:], np.diff(edge)) - start
        bins = parity_rows(rows.column("bins"))
        done = np.r_[0, np.cumsum(after)]
        lo = 0
        while lo < size:  # about a quarter of a million pairs at a time
            hi = max(lo + 1, int(np.searchsorted(done, done[lo] + (1 << 18), side="right")) - 1)
            k = after[lo:hi]
            i = np.repeat(np.arange(lo, hi), k)
            j = ragged(start[lo:hi], k)
            small = np.where(cols["n"][i] <= cols["n"][j], i, j)  # of equal sizes either prefix suffices
            ni, nj = cols["n"][i].astype(np.int64), cols["n"][j].astype(np.int64)
            ok = (cols["short"][small] | ((ni == nj) & (cols["short"][i] | cols["short"][j]))) & (
                100 * np.minimum(ni, nj) >= threshold * np.maximum(ni, nj))
            i, j, ni, nj = i[ok], j[ok], ni[ok], nj[ok]
            for at in range(0, len(i), 1 << 15):
                x, y, nx, ny = (v[at:at + (1 << 15)] for v in (i, j, ni, nj))
                ok = may_reach(nx, ny, bins[x], bins[y], threshold)
                u, v = cols["doc_id"][x[ok]], cols["doc_id"][y[ok]]
                if len(u):
                    yield np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1)
            lo = hi

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            rows = rows.combine_chunks()
            key = np.stack([np.asarray(rows.column(c)) for c in ("token", "lo", "hi")])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            at = int(change[-1]) if len(change) else 0  # the last cell may go on in the next batch
            yield from emit(rows.slice(0, at))
            held = rows.slice(at)
        if held is not None:
            yield from emit(held)

    def emit(rows):
        found, n = [], 0
        for pairs in chain(pairs_of(rows) if rows.num_rows else (), [None]):
            if pairs is not None:
                found.append(pairs)
                n += len(pairs)
            if found and (pairs is None or n > 1 << 18):  # None: no more
                p = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_pydict({"a": pa.array(p[:, 0]), "b": pa.array(p[:, 1])})
                found, n = [], 0

    return e.mapInArrow(run, "a long, b long")


def verify(live: DataFrame, pairs: DataFrame, k: int, threshold: int) -> DataFrame:
    """(a, b) of the pairs whose whole shingle sets reach the threshold. Only
    texts that are in a pair move, as their sets."""
    def sets(batches):
        for batch in batches:
            for part in slices(batch):
                part = part.filter(pa.array(holds(*asked.value, np.asarray(part.column("fp"), dtype=np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(part, k)], pa.binary())], ["doc_id", "s"])

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = cut(pairs.distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    asked = live.sparkSession.sparkContext.broadcast(suspect_filter_bits(ids.select(id_fingerprint().alias("fp"))))
    s = live.select("doc_id", "text", id_fingerprint().alias("fp")).mapInArrow(sets, "doc_id long, s binary")
    with_a = pairs.join(s.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
    both = with_a.join(s.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    return cut(both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long").distinct())


def links(live: DataFrame, k: int = 5, threshold: int = 80) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n), links (a, b)): set sizes, and verified links that connect
    whatever any links connect. `live`: (doc_id, text), copies collapsed."""
    docs = prefixes(live, k, threshold)
    some = docs.where("n > 0 AND doc_id IS NOT NULL")
    groups = stored(some.groupBy("gid", "n").agg(F.min("doc_id").alias("head"), F.first("tokens").alias("tokens")))
    # sizes whose ratio is below the threshold never link, so bands overlap by one step at most
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / threshold))).cast("int")
    posts = groups.select("head", band.alias("band"), F.explode("tokens").alias("token"))
    # a group's weight: how often its shingles occur in other groups
    shared = posts.groupBy("token", "band").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    spread = F.xxhash64("token", "band").alias("spread")
    met = stored(posts.select("*", spread).join(shared.select("token", "band", "c", spread), ["token", "band", "spread"]).drop("spread"))
    weight = met.groupBy("head").agg(F.sum("c").alias("weight"))
    hub = met.join(weight, "head").groupBy("token", "band").agg(F.max_by("head", F.struct("weight", -F.col("head"))).alias("hub"))
    near = met.select("*", spread).join(hub.select("token", "band", "hub", spread), ["token", "band", "spread"])
    near = near.where("head <> hub").groupBy("head", "hub").agg(F.count(F.lit(1)).alias("c"))
    place = F.row_number().over(W.partitionBy("head").orderBy(F.desc("c"), "hub"))
    near = near.withColumn("place", place).where(F.col("place") <= HUBS)
    members = some.select("doc_id", "gid", "n", F.xxhash64("gid").alias("spread")).join(
        groups.select("gid", "n", "head", F.xxhash64("gid").alias("spread")), ["gid", "n", "spread"]).where("doc_id <> head")
    pairs = cut(near.select(F.col("head").alias("a"), F.col("hub").alias("b")).unionAll(
        members.select(F.col("doc_id").alias("a"), F.col("head").alias("b"))).distinct())
    found = verify(live, possible(docs, pairs, threshold), k, threshold)
    # across components: shingles, and groups, whose documents are not yet connected
    roots = components(found)
    placed = some.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    entries = placed.select("doc_id", "n", "gid", "root", "n_short", "bins", F.posexplode(F.concat(F.array("gid"), "tokens")).alias("at", "token"))
    entries = entries.select("doc_id", "n", "gid", "root", "bins", "token", (F.col("at") <= F.col("n_short")).alias("short"))
    # of shingles with the same documents, in the same prefixes, one gives every pair
    same = [F.bit_xor(F.xxhash64(F.lit(x), "doc_id", "n", "gid", "short")).alias(f"same_{x}") for x in (8, 9)]
    open_ = entries.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("c"), *same).where("r0 < r1")
    open_ = open_.groupBy("c", "same_8", "same_9").agg(F.min("token").alias("token"))
    entries = entries.drop("gid")
    spread = F.xxhash64(F.lit(5), "token").alias("spread")
    entries = entries.select("*", spread).join(open_.select("token", "c", spread), ["token", "spread"]).drop("spread")
    tried = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = cut(across(entries, threshold).distinct()).join(tried, ["a", "b"], "left_anti")
    return docs.select("doc_id", "n"), found.unionAll(verify(live, rest, k, threshold))


def similar_components(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    def own_size(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(s) for s in shingle_sets(part, k)], pa.int64())})

    every = copies(texts(docs), smallest=True).select(
        F.col("doc.doc_id").alias("doc_id"), F.when(F.col("kept"), F.col("text")).alias("text"), "keep_id", "kept")
    every = stored(every)
    live = every.where("kept AND doc_id IS NOT NULL").select("doc_id", "text")
    sizes, found = links(live, k, threshold)
    roots = components(found)
    sizes = sizes.groupBy("doc_id").agg(F.max("n").alias("n"))
    of = cut(sizes.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        F.col("doc_id").alias("keep_id"), "n", F.coalesce("root", "doc_id").alias("root")))
    out = every.where("keep_id IS NOT NULL").select("doc_id", "keep_id").join(of, "keep_id", "left")
    root = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id")))
    out = out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), root.alias("component_id"))
    # texts that occur only without an id: each row still has its text
    none = F.lit(None).cast("long")
    nameless = every.where("keep_id IS NULL").select("text").mapInArrow(own_size, "n long")
    return out.unionAll(nameless.select(none.alias("doc_id"), F.col("n").alias("n_shingles"), none.alias("component_id")))


def keep_representatives(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, without near duplicates: of each
    component the document with the smallest id stays. Only rows that may have
    to go are shuffled."""
    gone = cut(similar_components(docs, k, threshold).where("doc_id > component_id").select(
        F.col("doc_id").alias("_gone")).distinct())
    suspected = suspect_filter(docs.sparkSession, gone.select(id_fingerprint("_gone").alias("fp")))
    fp = id_fingerprint(F.col("doc_id").cast("long"))
    maybe = F.coalesce(suspected(fp), F.lit(False)) & F.col("doc_id").isNotNull()
    rest = docs.where(maybe).join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    return docs.where(~maybe).unionByName(rest)

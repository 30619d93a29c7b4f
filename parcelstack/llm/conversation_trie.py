"""Conversation prefix trie (operator 13): a z-fast trie built in batches.

Conversations are rebuilt as sequences of (role, text) turns. Every prefix of a
sequence has a signature: a digest of the running XOR of digests of (position,
role, text), so signatures of all prefixes come from one scan. Equal sequences
are one class; its smallest conv_id represents it from there on.

The compacted trie is a table of nodes. A node's edge covers depths lo < d <= hi
of a representative's path; its extent is the prefix of depth hi. It is found
through its handle: the signature at the two-fattest depth in (lo, hi] (the one
with most trailing zeros). Each batch of classes

1. locates its exit nodes by fat binary search: probe the handle table at the
   two-fattest depth of what is left of (a, b]; a hit whose extent is a prefix
   moves a up to it, another hit is the exit node, a miss moves b down. Below
   the last extent the exit node is the child named by the next signature;
2. finds how far it follows the exit node's edge, splits the edge there, and
   hangs off what is new, cut where the batch itself branches or ends.

Sizes are then summed per compacted node over the paths of the classes and the
edges are expanded into one row per prefix. Everything is joins and sums over
rows of (class, depth); no conversation, node or path is held in one row, and
turns of a conversation meet in a task only CHUNK turn numbers at a time.

Defined results: null roles and texts count as empty; turns order by turn (null
first), then role and text, and repeated rows are turns of their own; rows
without a conv_id belong to no conversation; other columns are ignored; an
empty table has no conversation and gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

CHUNK = 4096
# Sixteenths of the classes that each batch inserts: small first, then doubling.
BATCHES = (1, 3, 12)
# Bytes of member ids that travel in one row to be digested.
ID_BYTES = 1 << 20
PARTS = 4


def _scan(df: DataFrame, key: list[str], position: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Running aggregates within each key in order: name -> aggregate, over
    chunks of CHUNK values of the position and the totals of earlier chunks."""
    df = df.withColumn("_chunk", F.floor(F.coalesce(F.col(position), F.lit(-(1 << 63))) / CHUNK))
    totals = df.groupBy(*key, "_chunk").agg(*[F.expr(e).alias(f"_{n}") for n, e in sums.items()])
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    join = {"bit_xor": "bit_xor", "sum": "sum", "count": "sum"}
    before = totals.select(*key, "_chunk", *[F.coalesce(F.expr(f"{join[e.split('(')[0]]}(_{n})").over(earlier), F.lit(0)).alias(f"_{n}")
                                             for n, e in sums.items()])
    here = Window.partitionBy(*key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    add = {n: (lambda a, b: a.bitwiseXOR(b)) if e.startswith("bit_xor") else (lambda a, b: a + b) for n, e in sums.items()}
    df = df.select("*", *[F.expr(e).over(here).alias(f"here_{n}") for n, e in sums.items()]).join(before, [*key, "_chunk"])
    for n in sums:
        df = df.withColumn(n, add[n](F.col(f"here_{n}"), F.col(f"_{n}")))
    return df.drop("_chunk", *[f"here_{n}" for n in sums], *[f"_{n}" for n in sums])


def rebuilt(conversations: DataFrame, group: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id of every conversation; conv_id, d, role, text of every rebuilt
    turn, d from 1): the first h turns of conversation c - c % group, then the
    conversation's own after its first h; h = crc32(decimal c) % shared."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = stored(_scan(rows, ["c"], "turn", ["turn", "role", "text"], {"k": "count(1)"}).drop("turn"))
    convs = (own.where("k = 1").select("c").withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % shared)
             .withColumn("base", F.col("c") - F.col("c") % group))
    head = own.where(F.col("k") < shared).select(F.col("c").alias("base"), "k", "role", "text")
    lent = convs.join(head, "base").where("k <= h").select("c", F.col("k").alias("d"), "role", "text")
    size = lent.groupBy("c").agg(F.count("*").alias("lent"))
    kept = (own.join(convs.select("c", "h"), "c").where("k > h").join(size, "c", "left")
            .select("c", (F.col("k") - F.col("h") + F.coalesce("lent", F.lit(0))).alias("d"), "role", "text"))
    return convs.select("c"), lent.unionByName(kept)


def _signature(parts: list[Column]) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", *[p.cast("string") for p in parts]), 256)), 1, 16)


def _root() -> Column:
    return _signature([F.lit(0)] * PARTS)


def prefixes(turns: DataFrame) -> DataFrame:
    """(c, d, sig, psig, w): the signature of each prefix and of the one before
    it, and the running number of words, from (c, d, role, text)."""
    digest = F.sha2(F.concat(F.col("d").cast("string"), F.lit(","), F.length("role").cast("string"), F.lit(","), "role", "text"), 256)
    rows = turns.select("c", "d", F.size(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))).cast("long").alias("n"), digest.alias("x"))
    rows = rows.select("c", "d", "n", *[F.conv(F.substring("x", 1 + 15 * k, 15), 16, 10).cast("long").alias(f"x{k}") for k in range(PARTS)])
    rows = _scan(rows, ["c"], "d", ["d"], {"w": "sum(n)"} | {f"s{k}": f"bit_xor(x{k})" for k in range(PARTS)})
    now = [F.col(f"s{k}") for k in range(PARTS)]
    return rows.select("c", "d", _signature(now).alias("sig"),
                       _signature([s.bitwiseXOR(F.col(f"x{k}")) for k, s in enumerate(now)]).alias("psig"), "w")


def _two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] with most trailing zeros, 0 <= a < b."""
    low = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def _addressed(edges: DataFrame, path: DataFrame) -> DataFrame:
    """Nodes (ext, hsig, nsig, parent, lo, hi, rep) of edges (rep, lo, hi): the
    signatures of extent, handle and name, and the extent of the parent."""
    edges = edges.withColumn("f", _two_fattest(F.col("lo"), F.col("hi")))
    at = edges.select("rep", "lo", "hi", "f", F.explode(F.array_distinct(F.array("hi", "f", F.col("lo") + 1))).alias("d"))
    found = at.join(path.select(F.col("c").alias("rep"), "d", "sig", "psig"), ["rep", "d"])
    pick = lambda col, d: F.max(F.when(F.col("d") == d, F.col(col)))
    return found.groupBy("rep", "lo", "hi").agg(
        pick("sig", F.col("hi")).alias("ext"), pick("sig", F.col("f")).alias("hsig"),
        pick("sig", F.col("lo") + 1).alias("nsig"), pick("psig", F.col("lo") + 1).alias("parent"))


def locate(batch: DataFrame, path: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """(c, len, rep, ext, lo, hi, a): the exit node of each class (c, len) by
    fat binary search, null where it leaves the trie at an extent of depth a."""
    sigs = path.select("c", "d", "sig")
    handles = nodes.select(F.col("hsig").alias("sig"), "ext", "lo", "hi", "rep")
    state = batch.select("c", "len", F.lit(0).cast("long").alias("a"), F.col("len").alias("b"),
                         *[F.lit(None).cast(t).alias(n) for n, t in (("ext", "binary"), ("lo", "long"), ("hi", "long"), ("rep", "long"))])
    # probed depths lose trailing zeros each time, so there are as many probes as binary digits
    for _ in range(longest.bit_length()):
        open_ = F.col("a") < F.col("b")
        done, active = state.where(~open_), state.where(open_).select("c", "len", "a", "b").withColumn("d", _two_fattest(F.col("a"), F.col("b")))
        hit = active.join(sigs, ["c", "d"]).join(handles, "sig", "left").select("c", "len", "a", "b", F.col("d").alias("f"), "ext", "lo", "hi", "rep")
        hit = hit.join(sigs.select("c", F.col("d").alias("hi"), "sig"), ["c", "hi"], "left")
        follows = F.col("ext").isNotNull() & F.col("sig").eqNullSafe(F.col("ext"))
        leaves = F.col("ext").isNotNull() & ~follows
        state = stored(done.unionByName(hit.select(
            "c", "len", F.when(follows, F.col("hi")).otherwise(F.col("a")).alias("a"),
            F.when(leaves, F.col("a")).when(follows, F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            *[F.when(leaves, F.col(n)).alias(n) for n in ("ext", "lo", "hi", "rep")])))
    named = state.where("ext IS NULL").select("c", "len", "a").withColumn("d", F.col("a") + 1)
    named = (named.join(sigs, ["c", "d"], "left")
             .join(nodes.select(F.col("nsig").alias("sig"), "ext", "lo", "hi", "rep"), "sig", "left"))
    cols = ["c", "len", "a", "rep", "ext", "lo", "hi"]
    return stored(state.where("ext IS NOT NULL").select(cols).unionByName(named.select(cols)))


def insert(batch: DataFrame, path: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """The nodes after a batch of classes (c, len) has been added; `longest` is
    0 while the trie is empty, and all classes leave it at the root."""
    exits = locate(batch, path, nodes, longest)
    on_edge = exits.where("ext IS NOT NULL")
    mine = on_edge.join(path.select("c", "d", "sig"), "c").where("d > lo AND d <= hi")
    along = (mine.join(path.select(F.col("c").alias("rep"), "d", "sig"), ["rep", "d", "sig"])
             .groupBy("c").agg(F.max("d").alias("m")))
    left = stored(exits.join(along, "c", "left").select("c", "len", "rep", "ext", "lo", "hi", F.coalesce("m", "a").alias("m")))
    # edges of the trie cut where a class leaves them
    cuts = left.where("ext IS NOT NULL AND m > lo AND m < hi").select("ext", "rep", "lo", "hi", "m").distinct()
    split = cuts.select("ext").distinct()
    ends = cuts.select("ext", "rep", "lo", F.col("m").alias("hi")).unionByName(cuts.select("ext", "rep", "lo", "hi").distinct())
    above = F.lag("hi").over(Window.partitionBy("ext").orderBy("hi"))
    pieces = ends.select("rep", F.coalesce(above, F.col("lo")).alias("lo"), "hi")
    # paths below: cut where the batch branches or a class ends
    below = path.join(left.select("c", "len", "m"), "c").where("d > m")
    fork = (below.where("d > m + 1").groupBy("psig").agg(F.min("sig").alias("x"), F.max("sig").alias("y"))
            .where("x <> y").select(F.col("psig").alias("sig")))
    extents = fork.unionByName(below.where("d = len").select("sig")).distinct()
    stops = below.join(extents, "sig").select("c", "m", "sig", "d")
    above = F.lag("d").over(Window.partitionBy("c").orderBy("d"))
    hung = (stops.select("sig", F.struct("c", F.coalesce(above, F.col("m")).alias("lo"), F.col("d").alias("hi")).alias("e"))
            .groupBy("sig").agg(F.min("e").alias("e")).select(F.col("e.c").alias("rep"), "e.lo", "e.hi"))
    fresh = _addressed(pieces.unionByName(hung), path)
    return stored(nodes.join(split, "ext", "left_anti").unionByName(fresh))


def build(classes: DataFrame, path: DataFrame, longest: int) -> DataFrame:
    """The compacted trie (rep, lo, hi, ext, hsig, nsig, parent) without its
    root, of classes (c, len) with paths (c, d, sig, psig)."""
    spark = classes.sparkSession
    nodes = spark.createDataFrame([], "rep long, lo long, hi long, ext binary, hsig binary, nsig binary, parent binary")
    part = F.pmod(F.xxhash64("c"), F.lit(sum(BATCHES)))
    at = 0
    for width in BATCHES:
        nodes = insert(classes.where((part >= at) & (part < at + width)), path, nodes, longest if at else 0)
        at += width
    return nodes


def member_digests(members: DataFrame) -> DataFrame:
    """(ext, ends_sha256): SHA-256 of the comma-joined ascending ids of (ext,
    id). Sorted runs of ids become texts of bounded size first, each task a part
    of the order; digests then run over those texts, one at a time."""
    def pack(batches):
        ext, first, ids, size = None, None, [], 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([ext], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)], pa.string())],
                                              ["ext", "first", "ids"])
        for batch in batches:
            for e, c in zip(batch.column("ext").to_pylist(), batch.column("id").to_pylist(), strict=True):
                if ids and (e != ext or size > ID_BYTES):
                    yield row()
                    ids, size = [], 0
                if not ids:
                    ext, first = e, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield row()

    def digest(batches):
        ext, state = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([ext], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["ext", "ends_sha256"])
        for batch in batches:
            for e, text in zip(batch.column("ext").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if e != ext:
                    if state is not None:
                        yield done()
                    ext, state = e, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
        if state is not None:
            yield done()

    runs = stored(members.repartitionByRange("ext", "id").sortWithinPartitions("ext", "id").mapInArrow(pack, "ext binary, first long, ids string"))
    return runs.repartition("ext").sortWithinPartitions("ext", "first").mapInArrow(digest, "ext binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(conversations)
    convs = stored(convs)
    every = stored(prefixes(turns))
    ends = every.groupBy("c").agg(F.max(F.struct("d", "sig", "w")).alias("e")).select("c", "e.*")
    ends = stored(convs.join(ends, "c", "left").select(
        "c", F.coalesce("d", F.lit(0)).alias("len"), F.coalesce("sig", _root()).alias("ext"), F.coalesce("w", F.lit(0)).alias("words")))
    classes = stored(ends.groupBy("ext").agg(F.min("c").alias("c"), F.count("*").alias("copies"), F.first("len").alias("len"), F.first("words").alias("words")))
    path = stored(every.join(classes.select("c"), "c", "left_semi"))
    whole = classes.agg(F.max("len").alias("longest"), F.min("c").alias("first"), F.sum("copies").alias("n"),
                        F.sum(F.col("copies") * F.col("words")).alias("all_words")).first()
    nodes = build(classes.where("len > 0").select("c", "len"), path, whole.longest or 0)

    # sizes of compacted nodes from the paths of the classes
    on_path = stored(path.join(nodes.select(F.col("ext").alias("sig")), "sig")
                     .join(classes.select("c", "copies", "words", F.col("ext").alias("end")), "c")
                     .select("c", F.col("sig").alias("ext"), "d", "w", "copies", "words", "end"))
    size = stored(on_path.groupBy("ext").agg(
        F.min("c").alias("conv_id"), F.sum("copies").alias("n_convs"), F.sum(F.col("copies") * F.col("words")).alias("all_words")))
    # a class owns the words of those nodes of its path of which it is the smallest member
    foreign = (on_path.join(size.select("ext", "conv_id"), "ext").where("conv_id <> c")
               .groupBy("c").agg(F.max("w").alias("w")))
    inner = nodes.select(F.col("parent").alias("end")).distinct().withColumn("inner", F.lit(1))
    mine = stored(classes.withColumnRenamed("ext", "end").join(foreign, "c", "left").join(inner, "end", "left")
                  .select("c", "words", (F.col("words") - F.coalesce("w", F.lit(0))).alias("own"),
                          F.when(F.col("inner").isNull(), 1).otherwise(0).alias("leaf")))
    below = (on_path.select("c", "ext").join(mine.select("c", "own", "leaf"), "c")
             .groupBy("ext").agg(F.sum("own").alias("owned"), F.sum("leaf").alias("n_leaves")))
    # saved = words of all members below, less the words of each distinct node once
    smallest = mine.select(F.col("c").alias("conv_id"), F.col("words").alias("_words"), F.col("own").alias("_own"))
    size = (size.join(below, "ext").join(smallest, "conv_id")
            .withColumn("saving", F.col("all_words") - (F.col("owned") - F.col("_own") + F.col("_words")))
            .select("ext", "conv_id", "n_convs", "n_leaves", "saving"))
    children = nodes.groupBy(F.col("parent").alias("ext")).agg(F.count("*").alias("children"))
    digests = stored(member_digests(ends.select("ext", F.col("c").alias("id"))))
    owner = size.select(F.col("ext").alias("parent"), F.col("conv_id").alias("above"))
    compact = (nodes.select("ext", "rep", "lo", "hi", "parent").join(size, "ext").join(children, "ext", "left")
               .join(digests, "ext", "left").join(owner, "parent", "left"))

    # edges expanded: one row per depth, by chunks of depths
    chunk = lambda d: F.floor(d / CHUNK)
    edges = compact.withColumn("chunk", F.explode(F.sequence(chunk(F.col("lo") + 1), chunk(F.col("hi")))))
    steps = every.select(F.col("c").alias("rep"), "d", "w", chunk(F.col("d")).alias("chunk"))
    here = edges.join(steps, ["rep", "chunk"]).where("d > lo AND d <= hi")
    # the words down to a depth leave those of the node itself in: take them off one turn before
    before = every.select(F.col("c").alias("rep"), (F.col("d") + 1).alias("d"), F.col("w").alias("w_before"))
    here = here.join(before, ["rep", "d"], "left").withColumn("w_before", F.coalesce("w_before", F.lit(0)))
    top, tail = F.col("d") == F.col("lo") + 1, F.col("d") == F.col("hi")
    none = hashlib.sha256(b"").hexdigest()
    inside = here.select(
        "conv_id", F.col("d").alias("depth"),
        F.when(~top, F.col("conv_id")).when(F.col("lo") == 0, F.lit(whole.first)).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs", F.when(~tail, F.lit(1)).otherwise(F.coalesce("children", F.lit(0))).cast("long").alias("n_children"), "n_leaves",
        (F.col("saving") - (F.col("n_convs") - 1) * F.col("w_before")).alias("saved_tokens"),
        F.when(tail, F.coalesce("ends_sha256", F.lit(none))).otherwise(F.lit(none)).alias("ends_sha256"))
    if not whole.n:
        return inside
    top = mine.agg(F.sum("own").alias("owned"), F.sum("leaf").alias("n_leaves")).first()
    ending = digests.where(F.col("ext") == _root()).first()
    root = (whole.first, 0, None, whole.n, nodes.where("lo = 0").count(), top.n_leaves, whole.all_words - top.owned,
            ending.ends_sha256 if ending else none)
    return conversations.sparkSession.createDataFrame([root], inside.schema).unionByName(inside)

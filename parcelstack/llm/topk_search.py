"""Exact top-k search (operator 10): block-at-a-time pruning.

Vectors are cut into ranges of ids; a range holds blocks of consecutive
vectors with, per dimension, the largest and smallest component (a dimension
is a term whose maximum serves positive query weights and whose minimum
negative ones). Three passes:

1. Every query is scored against a sample of all vectors; its kth score there
   is a floor: no vector below it is among the k best.
2. Every query meets the term maxima of all blocks (1/64 of the vectors). Where
   no block's sum of maxima reaches the query's floor, range and query part.
3. The pairs left are shipped: a range goes once to a group of query batches,
   with the queries that need it and their floors. A query orders the blocks by
   their summed maxima and scores block after block through the block's forward
   index (its component matrix) until the next bound is below its kth score.
   All queries of a batch advance together, one block each per wave.

Packets hold a bounded number of bytes whatever the vectors' length, in the
narrowest integers that fit; they meet by number, in cells of bounded size. The
best k of each cell meet in a last top-k per query. The sample decides how much
is shipped, never what is found.

Defined results: vectors that are null, or hold null or non-finite components,
take no part, nor do rows without an id; vectors of different lengths are
compared as if padded with zeros; equal scores go to the smaller vec_id; rows
repeating id and vector count once, and a query id that has several vectors
asks with the smallest one in array order; other columns are ignored; an empty
table gives no rows. Scores beyond 64 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

BLOCK = 128
RANGE_COMPONENTS = 1 << 19  # of a range's vectors (8,192 of 64 dimensions)
BATCH_COMPONENTS = 1 << 17  # of a query batch
CELL_RANGES = 16            # ranges whose maxima meet a query batch in one cell
CELL_BATCHES = 16           # query batches that share a shipped range
SAMPLE_VECTORS = 4096       # vectors, about, that give the floors

_PACKET = "packet long, n int, ids binary, m binary, width int"
_FLOOR = np.iinfo(np.int64).min


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part: floor(scale * x)."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _bytes(m: np.ndarray) -> tuple[bytes, int]:
    """A matrix in the narrowest integers that hold it, and their width."""
    lo, hi = int(m.min(initial=0)), int(m.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= lo and hi < 1 << 8 * w - 1)
    return m.astype(f"<i{width}").tobytes(), width


def _matrix(raw: bytes, width: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<i{width}").reshape(-1, dims).astype(np.int64)


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64)


def _packed(rows: DataFrame, size: int, n: int, dims: int, once: bool) -> DataFrame:
    """Rows in order of id, `size` at most to a packet; `once` keeps one
    vector of each id."""
    def pack(batches):
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId() << 24, 0
        ids, mats, held, last = [], [], 0, None

        def flush():
            m, width = _bytes(np.stack(mats))
            return pa.RecordBatch.from_pydict({
                "packet": pa.array([part + at], pa.int64()), "n": pa.array([held], pa.int32()),
                "ids": pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                "m": pa.array([m], pa.binary()), "width": pa.array([width], pa.int32())})

        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v"), strict=True):
                x = np.zeros(dims, dtype=np.int64)
                own = v.values.to_numpy(zero_copy_only=False)
                x[:len(own)] = own
                if last is not None and last[0] == i and (once or np.array_equal(last[1], x)):
                    continue
                last = (i, x)
                ids.append(i)
                mats.append(x)
                held += 1
                if held == size:
                    yield flush()
                    ids, mats, held, at = [], [], 0, at + 1
        if held:
            yield flush()

    spread = rows.repartitionByRange(max(1, -(-n // size)), "vec_id").sortWithinPartitions("vec_id", "v")
    return cut(spread.mapInArrow(pack, _PACKET))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def _extremes(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest components of each block."""
    edges = np.arange(0, len(m), BLOCK)
    return np.maximum.reduceat(m, edges), np.minimum.reduceat(m, edges)


def _bounds(q: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return _product(np.maximum(q, 0), hi) + _product(np.minimum(q, 0), lo)


def search_cell(ids: np.ndarray, m: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int, floors: np.ndarray | None = None) -> tuple:
    """(query number, id, score) of the best k of each query among the vectors
    of one range that reach its floor, by block-at-a-time pruning."""
    edges = np.arange(0, len(ids), BLOCK)
    bound = _bounds(q, *_extremes(m))
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = np.full(len(q), _FLOOR) if floors is None else floors.copy()
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    active = np.arange(len(q))
    for wave in range(len(edges)):
        block = order[active, wave]
        live = bound[active, block] >= kth[active]
        active, block = active[live], block[live]
        if not len(active):
            break
        found = [best]
        by = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(block[by]) != 0, True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            who, at = active[by[a:b]], edges[block[by[a]]]
            s = _product(q[who], m[at:at + BLOCK])
            i, j = np.nonzero((s >= kth[who][:, None]) & (ids[at:at + BLOCK][None, :] != q_ids[who][:, None]))
            found.append((who[i], ids[at + j], s[i, j]))
        who, cand, score = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.lexsort((cand, -score, who))
        who, cand, score = who[by], cand[by], score[by]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
        rank = np.arange(len(who)) - np.repeat(first, np.diff(np.r_[first, len(who)]))
        kth[who[rank == k - 1]] = score[rank == k - 1]
        keep = rank < k
        best = (who[keep], cand[keep], score[keep])
    return best


def _meet(a: DataFrame, b: DataFrame, n_a: int, n_b: int, work, schema: str) -> DataFrame:
    """`work` on every cell of a grid of n_a x n_b: each packet of `a` meets
    each of `b` once. Packets spread by the hash of their numbers."""
    def place(n):
        return F.pmod(F.xxhash64("packet"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = a.withColumn("_a", place(n_a)).withColumn("_b", every(n_b))
    right = b.withColumn("_b", place(n_b)).withColumn("_a", every(n_a))
    return left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInPandas(work, schema)


def _sampled(ranges: DataFrame, n: int, dims: int, sample: int) -> DataFrame:
    """About `sample` vectors of all, evenly from the ranges."""
    share = min(1.0, sample / max(1, n))

    def choose(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = np.flatnonzero(np.random.default_rng(r["packet"]).random(r["n"]) < share)
                if len(at):
                    m, width = _bytes(_matrix(r["m"], r["width"], dims)[at])
                    yield pa.RecordBatch.from_pylist([{**r, "n": len(at), "ids": _ids(r["ids"])[at].tobytes(), "m": m, "width": width}],
                                                     schema=batch.schema)

    return ranges.mapInArrow(choose, _PACKET)


def _with_floors(batches: DataFrame, sample: DataFrame, n_batches: int, dims: int, k: int) -> DataFrame:
    """Query batches with each query's kth score among the sample (the least
    number where the sample has fewer vectors than k)."""
    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        floors = []
        for r in b.itertuples():
            q_ids, q = _ids(r.ids), _matrix(r.m, r.width, dims)
            best = np.full((len(q), k), _FLOOR)
            for s in a.itertuples():
                score = _product(q, _matrix(s.m, s.width, dims))
                score[q_ids[:, None] == _ids(s.ids)[None, :]] = _FLOOR
                both = np.concatenate([best, score], axis=1)
                best = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            floors.append(best.min(axis=1).tobytes())
        return b.drop(columns=["_a", "_b"]).assign(floors=floors)

    return _meet(sample, batches, 1, n_batches, work, f"{_PACKET}, floors binary")


def _maxima(ranges: DataFrame, dims: int) -> DataFrame:
    """(packet, hi, lo): the extremes of each range's blocks."""
    def reduce(batches):
        for batch in batches:
            for r in batch.to_pylist():
                hi, lo = _extremes(_matrix(r["m"], r["width"], dims))
                yield pa.RecordBatch.from_pydict({"packet": pa.array([r["packet"]], pa.int64()), "hi": [hi.tobytes()], "lo": [lo.tobytes()]})

    return ranges.mapInArrow(reduce, "packet long, hi binary, lo binary")


def _pairs(maxima: DataFrame, batches: DataFrame, n_ranges: int, n_batches: int, dims: int) -> DataFrame:
    """(range, packet, n, who): the queries (numbers within batch `packet`)
    whose floor some block of the range may reach."""
    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in b.itertuples():
            q, floors = _matrix(r.m, r.width, dims), _ids(r.floors)
            for s in a.itertuples():
                most = _bounds(q, _matrix(s.hi, 8, dims), _matrix(s.lo, 8, dims)).max(axis=1)
                who = np.flatnonzero(most >= floors).astype(np.int32)
                if len(who):
                    out.append((s.packet, r.packet, len(who), who.tobytes()))
        return pd.DataFrame(out, columns=["range", "packet", "n", "who"])

    return _meet(maxima, batches, max(1, -(-n_ranges // CELL_RANGES)), n_batches, work, "range long, packet long, n int, who binary")


def _shipped(pairs: DataFrame, batches: DataFrame, n_batches: int, dims: int) -> DataFrame:
    """(range, team, ids, m, width, floors): per pair only the queries that
    need the range; `team` numbers a group of batches."""
    def choose(rows):
        for batch in rows:
            for r in batch.to_pylist():
                at = np.frombuffer(r["who"], dtype=np.int32)
                m, width = _bytes(_matrix(r["m"], r["width"], dims)[at])
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array([r["range"]], pa.int64()), "team": pa.array([r["team"]], pa.int32()), "ids": [_ids(r["ids"])[at].tobytes()],
                    "m": [m], "width": pa.array([width], pa.int32()), "floors": [_ids(r["floors"])[at].tobytes()]})

    team = F.pmod(F.xxhash64("packet"), F.lit(max(1, -(-n_batches // CELL_BATCHES)))).cast("int")
    met = pairs.drop("n").join(batches, "packet").withColumn("team", team)
    return met.mapInArrow(choose, "range long, team int, ids binary, m binary, width int, floors binary")


class Search:
    """The passes of one search; `pairs` (range, packet, n, who) is what pass 2 left."""

    def __init__(self, rows: DataFrame, queries: DataFrame, k: int = 5, sample: int = SAMPLE_VECTORS):
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
        asked = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
        self.k, self.dims = k, max(1, size.d or 0, asked.d or 0)
        per_range, per_batch = max(BLOCK, RANGE_COMPONENTS // self.dims), max(BLOCK, BATCH_COMPONENTS // self.dims)
        n_ranges, self.n_batches = max(1, -(-size.n // per_range)), max(1, -(-asked.n // per_batch))
        self.ranges = _packed(rows, per_range, size.n, self.dims, once=False)
        batches = _packed(queries, per_batch, asked.n, self.dims, once=True)
        floored = _with_floors(batches, _sampled(self.ranges, size.n, self.dims, sample), self.n_batches, self.dims, k)
        self.batches = cut(floored)
        self.pairs = cut(_pairs(_maxima(self.ranges, self.dims), self.batches, n_ranges, self.n_batches, self.dims))

    def best(self) -> DataFrame:
        """(query_id, rank, vec_id, score) of the k best of each query."""
        dims, k = self.dims, self.k
        asks = _shipped(self.pairs, self.batches, self.n_batches, dims)
        team = F.pmod(F.xxhash64("packet"), F.lit(max(1, -(-self.n_batches // CELL_BATCHES)))).cast("int")
        wanted = self.pairs.select("range", team.alias("team")).distinct()
        given = self.ranges.select(F.col("packet").alias("range"), "ids", "m", "width").join(wanted, "range")

        def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = [[np.zeros(0, np.int64)] * 3]
            for s in a.itertuples():
                ids, m = _ids(s.ids), _matrix(s.m, s.width, dims)
                for r in b.itertuples():
                    q_ids = _ids(r.ids)
                    who, cand, score = search_cell(ids, m, q_ids, _matrix(r.m, r.width, dims), k, _ids(r.floors))
                    out.append([q_ids[who], cand, score])
            return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})

        met = given.groupBy("range", "team").cogroup(asks.groupBy("range", "team")).applyInPandas(
            cell, "query_id long, vec_id long, score long")
        place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product of
    every query, the query's own id left out. Both inputs: (vec_id, v)."""
    return Search(rows, queries, k).best()

"""Substring dedup (operator 7): level-wise doubling.

A window of `window` words is removed where the same words also start in a
document with a smaller id. Candidates grow level by level: windows of a
quarter of the length first, those repeated are extended to half, those still
repeated to the whole length.

1. Copies of a whole text are settled first: all but the one with the smallest
   id lose every word that a window covers, and take no further part.
2. At a quarter of the length, only content-chosen anchors are looked at: the
   windows whose hash is smallest among `half + 1` neighbouring ones. Every
   full window holds an anchor in its first half, and a repeated one holds the
   same anchor in all its copies, so none is missed.
3. Which anchors repeat is found by the fingerprint exchange of `exact_dedup`
   (sorted compressed hashes to owners, bitmaps back); a filter of bounded size
   carries the answer back over the texts, which are scanned again instead of
   shuffled. A saturated filter costs candidates, not results.
4. The same at half the length, for the anchors left.
5. Full windows around the anchors left are grouped by their hash; documents
   above the smallest id of a window lose the words it covers.

Windows are judged on the input; 96 hash bits stand for a window's words.

Defined results: null and empty texts and texts of fewer than `window` words
lose nothing; the same window within one document is no repetition; rows
without an id neither lose words nor cost others any; rows that share an id
are not compared with each other, and each loses the windows that its own
words repeat; words are joined by one space; one row out per row in; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as H
from .common import cut, slices, stored, texts
from .exact_dedup import (FINGERPRINT_BITS, copies, holds, id_fingerprint, messages, owner_bits_for, suspect_filter_bits,
                          suspects, text_bytes_of)


def anchors(h: np.ndarray, valid: np.ndarray, reach: int) -> np.ndarray:
    """Positions whose hash is the smallest in some run of `reach` valid
    neighbouring positions. h: per position of the flat array, valid: positions
    that hold a whole window, rows one after another."""
    n = len(h)
    if not len(valid):
        return valid
    top = np.iinfo(np.uint64).max
    g = np.full(n + 2 * reach, top, dtype=np.uint64)
    g[valid] = np.minimum(h[valid], top - np.uint64(1))

    def sliding(x, op):  # over x[i:i + reach], by doubling
        k, m = 1, x
        while 2 * k <= reach:
            m = op(m[:-k], m[k:])
            k *= 2
        return op(m[:len(x) - reach + 1], m[reach - k:][:len(x) - reach + 1]) if k < reach else m[:len(x) - reach + 1]

    low = sliding(g, np.minimum)[:n]
    ok = np.zeros(n + reach, dtype=bool)
    ok[valid] = True
    inside = np.r_[0, np.cumsum(ok)]
    full = (inside[reach:reach + n] - inside[:n]) == reach
    # a run must not reach over a row's end: valid positions of two rows are
    # never adjacent, since the last words of a row start no whole window
    low = np.where(full, low, np.uint64(0))
    high = sliding(np.r_[np.zeros(reach - 1, np.uint64), low, np.zeros(reach, np.uint64)], np.maximum)[:n]
    return valid[high[valid] == g[valid]]


class _Levels:
    """Candidate positions of a batch, level by level."""

    def __init__(self, part: pa.RecordBatch, window: int):
        self.window, self.half, self.quarter = window, window // 2, max(2, window // 4)
        self.words, self.counts = H.word_hashes(part.column("text"))
        long_enough = np.repeat(self.counts >= window, self.counts)
        at = H.whole_windows(self.counts, self.quarter)
        self.at = at[long_enough[at]] if len(at) else at

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """(anchor positions, their hashes)."""
        h = H.window_hashes(self.words, self.quarter)
        h = np.r_[h, np.zeros(len(self.words) - len(h), np.uint64)]
        at = anchors(h, self.at, self.window - self.half + 1)
        return at, h[at]

    def second(self, known: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchors that repeat, extended to half the length."""
        at, h = self.first()
        at = at[holds(known, bits, _fp(h))]
        ends = np.repeat(np.cumsum(self.counts), self.counts)
        at = at[at + self.half <= ends[at]]
        h = H.window_hashes(self.words, self.half)
        return at, h[at]

    def third(self, known: np.ndarray, bits: int, known2: np.ndarray, bits2: int) -> np.ndarray:
        """Positions of full windows around the anchors left."""
        at, h = self.second(known, bits)
        at = at[holds(known2, bits2, _fp(h))]
        mark = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.add.at(mark, np.maximum(at - (self.window - self.half), 0), 1)
        np.add.at(mark, at + 1, -1)
        near = np.cumsum(mark[:-1]) > 0
        full = H.whole_windows(self.counts, self.window)
        return full[near[full]] if len(full) else full


def _fp(h: np.ndarray) -> np.ndarray:
    """Fingerprints of window hashes. Anchors are the smallest hashes of their
    surroundings; mixed again, they spread evenly over owners and filter."""
    return (H.mix(h, 7) >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)


def _level(window: int, known):
    """Batches of texts to fingerprints of one level's windows; `known`: what
    earlier levels found."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                levels = _Levels(part, window)
                _, h = levels.second(*known.value) if known is not None else levels.first()
                yield pa.RecordBatch.from_pydict({"fp": pa.array(_fp(h), pa.int64())})

    return run


def _full_windows(live: DataFrame, window: int, known, known2) -> DataFrame:
    """(h1, h2, doc_id, row, pos) of the full windows that may repeat."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                levels = _Levels(part, window)
                at = levels.third(*known.value, *known2.value)
                of = np.repeat(np.arange(part.num_rows), levels.counts)[at]
                begin = np.cumsum(levels.counts) - levels.counts
                h1 = H.window_hashes(levels.words, window, 1)
                h2 = H.window_hashes(levels.words, window, 2)
                yield pa.RecordBatch.from_pydict({
                    "h1": pa.array(h1[at].view(np.int64)), "h2": pa.array((h2[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    "doc_id": part.column("doc_id").take(pa.array(of)), "row": part.column("row").take(pa.array(of)),
                    "pos": pa.array((at - begin[of]).astype(np.int32))})

    return live.where("doc_id IS NOT NULL").mapInArrow(run, "h1 long, h2 int, doc_id long, row long, pos int")


def _repeated(live: DataFrame, level, owner_bits: int):
    """The broadcast filter of a level's repeated fingerprints."""
    return live.sparkSession.sparkContext.broadcast(suspect_filter_bits(
        cut(suspects(cut(messages(live.select("text"), owner_bits, of=level)), owner_bits))))


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, text): the words kept, joined by one space."""
    spark = docs.sparkSession
    rows = copies(texts(docs), smallest=True)
    rows = stored(rows.select(F.col("doc.doc_id").alias("doc_id"), "text",
                              (F.col("kept") | F.col("doc.doc_id").isNull()).alias("first"),
                              F.monotonically_increasing_id().alias("row")))
    live = rows.where("first").select("doc_id", "row", "text")
    # an anchor for about half the distance within which one is chosen; words take two bytes or more
    owner_bits = owner_bits_for(spark, text_bytes_of(live) // (window - window // 2 + 1))
    named = live.where("doc_id IS NOT NULL")
    known = _repeated(named, _level(window, None), owner_bits)
    known2 = _repeated(named, _level(window, known), owner_bits)
    full = _full_windows(live, window, known, known2)
    lowest = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    # the redundant key gives the join an exchange of its own, whose large
    # partitions (a window in very many documents) can be split at run time
    spread = F.xxhash64("h1", "h2").alias("spread")
    hits = full.select("*", spread).join(lowest.select("h1", "h2", "low", spread), ["h1", "h2", "spread"]).where("doc_id > low")
    hits = cut(hits.groupBy("row").agg(F.collect_set("pos").alias("at")))  # at most a document's words
    known3 = spark.sparkContext.broadcast(suspect_filter_bits(hits.select(id_fingerprint("row").alias("fp"))))
    # documents that may lose words meet their positions; no other text moves
    rows = rows.withColumn("fp", F.when(F.col("first") & F.col("doc_id").isNotNull(), id_fingerprint("row")))
    form = "doc_id long, n_words long, n_removed long, text string"

    def is_hit(part):
        fp = part.column("fp")
        return holds(*known3.value, np.asarray(fp.fill_null(0), dtype=np.int64)) & np.asarray(fp.is_valid())

    def untouched(batches):
        for batch in batches:
            for part in slices(batch):
                part = part.filter(pa.array(~is_hit(part)))
                yield _strip(part, [None] * part.num_rows, [not x for x in part.column("first").to_pylist()], window)

    def candidates(batches):
        for batch in batches:
            yield batch.filter(pa.array(is_hit(batch))).select(["doc_id", "row", "text"])

    def strip(batches):
        for batch in batches:
            for part in slices(batch):
                yield _strip(part, part.column("at").to_pylist(), [False] * part.num_rows, window)

    touched = rows.select("doc_id", "row", "text", "fp").mapInArrow(candidates, "doc_id long, row long, text string").join(hits, "row", "left")
    return rows.mapInArrow(untouched, form).unionAll(touched.select("doc_id", "text", "at").mapInArrow(strip, form))


def _strip(part: pa.RecordBatch, positions: list, whole: list, window: int) -> pa.RecordBatch:
    """What is left of each text without the windows at `positions`, or without
    any window where `whole`."""
    n_words, n_removed, kept = [], [], []
    for text, at, every in zip(part.column("text"), positions, whole, strict=True):
        own = text.as_buffer().to_pybytes().split()
        left = own
        if every and len(own) >= window:
            left = []
        elif at:
            at = np.array(at)
            edge = np.zeros(len(own) + window + 1, dtype=np.int64)
            edge[at] += 1
            edge[at + window] -= 1
            left = [own[i] for i in np.flatnonzero(np.cumsum(edge)[:len(own)] == 0).tolist()]
        n_words.append(len(own))
        n_removed.append(len(own) - len(left))
        kept.append(b" ".join(left))
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])

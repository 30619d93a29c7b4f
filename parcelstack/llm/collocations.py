"""Phrase collocation mining (operator 11): the stripes pattern.

A word keys a stripe: an associative counter of the next word and of the word
after that ("." where a piece ends; no word holds a full stop). Every position
of a text adds one to one entry of one stripe, so a single structure holds all
counts: an entry with both words is a three-word extension, the entries of one
next word add up to a two-word phrase, and a whole stripe adds up to its word.

1. A first pass finds hot words and pairs, those with 1 in HOT of all positions
   or more: a slice reports what is frequent within it, so at most 2 * HOT keys
   pass the driver however large the corpus is.
2. Each task sums the stripes of a slice of texts in numpy and sends them,
   sorted and compressed, to their owners by a hash of the word. Stripes of
   hot words are dealt in segments by the next word, of hot pairs by both.
3. Owners merge stripes elementwise, in memory bounded by their distinct
   entries, and keep what reaches the least count. Segments are added up.
4. The rest works on frequent phrases alone: joins of extensions with prefix
   totals give the cuts, the maxima of extensions give subsumption.

Blocks and owners follow the corpus: an owner has about ENTRIES positions.

Defined results: a null text counts as empty, a null lang as "und"; rows that
repeat count each time; texts without words add nothing; ties are ordered as
the ranking says; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, text_bytes, texts
from .words import mix, word_hashes

# Bytes of text summed at a time: a task holds about 60 bytes of arrays for each.
SLICE = 2 << 20
ENTRIES = 1 << 20
HOT = 4096
END = "."

_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_ENTRY = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("f", pa.int64())])
_COUNTS = "lang string, w1 string, w2 string, w3 string, f long"


def word_array(col: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all words folded to lower case, row of each, whether it follows on from
    the word before within one piece)."""
    raw, offsets = text_bytes(col)
    raw = _FOLD[raw]
    kind = _KIND[raw]
    inside = kind == 0
    edge = np.unique(offsets[(offsets > 0) & (offsets < len(raw))])
    turn = inside[1:] != inside[:-1]
    start, end = np.r_[inside[:1], turn & inside[1:]], np.r_[turn & inside[:-1], inside[-1:]]
    start[edge], end[edge - 1] = inside[edge], inside[edge - 1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    lengths = np.flatnonzero(end) + 1 - starts
    first = np.cumsum(lengths) - lengths
    data = raw[inside]
    bounds = np.r_[first, len(data)].astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data))
    row = np.searchsorted(offsets, starts, side="right") - 1
    pieces = np.searchsorted(np.flatnonzero(kind == _BREAK), starts)
    joined = np.r_[False, (row[1:] == row[:-1]) & (pieces[1:] == pieces[:-1])]
    return words, row, joined


def _dense(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs as a * width + b, number of each row's pair)."""
    return np.unique(a * width + b, return_inverse=True)


class Stripes:
    """The stripes of one slice: distinct entries with their counts."""

    def __init__(self, part: pa.RecordBatch):
        words, row, joined = word_array(part.column("text"))
        self.n = len(words)
        if not self.n:
            return
        coded = words.dictionary_encode()
        self.words = pa.concat_arrays([coded.dictionary, pa.array([END])])
        langs = part.column("lang").dictionary_encode()
        self.langs = langs.dictionary
        width = len(self.words)
        w1 = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        w2 = np.full(self.n, width - 1)
        w2[:-1] = np.where(joined[1:], w1[1:], width - 1)
        w3 = np.full(self.n, width - 1)
        w3[:-1] = np.where(joined[1:], w2[1:], width - 1)
        self.hash = np.r_[_word_keys(coded.dictionary), np.uint64(1)]
        one, in_one = _dense(lang, w1, width)
        two, in_two = _dense(in_one, w2, width)
        self.one, self.two, self.width = one, two, width
        self.in_one, self.in_two, self.w3 = in_one, in_two, w3
        self.key1 = mix(_lang_keys(self.langs)[one // width] ^ self.hash[one % width])
        self.key2 = mix(self.key1[two // width] + self.hash[two % width], 2)

    def frequent(self, hot: int) -> pa.RecordBatch:
        """Keys of words and pairs that have 1 in 2 * hot of the positions or
        more, and the number of positions under a null key."""
        keys, counts = [], []
        if self.n:
            for key, where in ((self.key1, self.in_one), (self.key2, self.in_two)):
                c = np.bincount(where, minlength=len(key))
                top = c * 2 * hot >= self.n
                keys.append(key[top])
                counts.append(c[top])
        keys = np.concatenate(keys or [np.zeros(0, np.uint64)]).view(np.int64)
        counts = np.concatenate([*counts, [self.n]]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(keys, pa.int64()), pa.array([None], pa.int64())]),
                                           pa.array(counts)], ["key", "f"])

    def blocks(self, owners: int, hot: np.ndarray):
        """(owner, its entries in the order of their prefixes)."""
        entry, count = np.unique(self.in_two * self.width + self.w3, return_counts=True)
        in_two, w3 = entry // self.width, entry % self.width
        in_one = self.two[in_two] // self.width
        k1, k2 = self.key1[in_one], self.key2[in_two]
        key = np.where(_among(self.key2, hot)[in_two], mix(k2 + self.hash[w3], 3),
                       np.where(_among(self.key1, hot)[in_one], k2, k1))
        owner = (key % np.uint64(owners)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        in_two, in_one, w3, count, owner = in_two[order], in_one[order], w3[order], count[order], owner[order]
        lo = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        whole = pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.one[in_one] // self.width)), self.words.take(pa.array(self.one[in_one] % self.width)),
             self.words.take(pa.array(self.two[in_two] % self.width)), self.words.take(pa.array(w3)), pa.array(count, pa.int64())],
            schema=_ENTRY)
        for a, b in zip(lo.tolist(), [*lo[1:].tolist(), len(owner)], strict=True):
            yield int(owner[a]), whole.slice(a, b - a)


def _word_keys(words: pa.Array) -> np.ndarray:
    return word_hashes(words)[0] * np.uint64(0x9E3779B97F4A7C15)


def _lang_keys(langs: pa.Array) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in langs.to_pylist()], dtype=np.uint64)


def _key1(table: pa.Table) -> np.ndarray:
    """The key of each row's lang and first word, as Stripes has it."""
    langs = table["lang"].combine_chunks().dictionary_encode()
    return mix(_lang_keys(langs.dictionary)[langs.indices.to_numpy(zero_copy_only=False)] ^ _word_keys(table["w1"].combine_chunks()))


def _among(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    return hot[at] == keys


def _packed(block: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ENTRY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(block)
    return sink.getvalue().to_pybytes()


def _sum(table: pa.Table, *keys: str) -> pa.Table:
    out = table.group_by(list(keys), use_threads=False).aggregate([("f", "sum")])
    return out.rename_columns([*keys, "f"])


def _frequent(docs: DataFrame, share: int) -> tuple[int, np.ndarray]:
    """(number of positions, sorted keys of hot words and pairs: 2 * share each
    at most, as no position adds to more than one word and one pair)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                yield Stripes(part).frequent(share)

    sums = stored(docs.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f")))
    total = sums.where("key IS NULL").first()
    n = total.f if total else 0
    hot = sums.where(F.col("key").isNotNull() & (F.col("f") * (2 * share) >= n)).select("key").collect()
    return n, np.sort(np.array([r.key for r in hot], dtype=np.int64).view(np.uint64))


def phrase_counts(docs: DataFrame, least: int = 10, share: int = HOT, entries: int = ENTRIES) -> DataFrame:
    """(lang, w1, w2, w3, f): how often each word (w2 and w3 null), two-word
    and three-word phrase occurs, where it does `least` times or more, and, with
    w1 null, the number of words of each lang. Words and pairs with 1 in `share`
    of all positions are dealt in segments; an owner gets about `entries`
    positions. Neither changes results."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    rows = texts(docs, lang).select("lang", "text").where(F.length("text") > 0)
    n, hot = _frequent(rows, share)
    owners = max(1, -(-n // entries))

    def send(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                s = Stripes(part)
                if s.n:
                    for owner, block in s.blocks(owners, hot):
                        yield pa.RecordBatch.from_arrays([pa.array([owner], pa.int32()), pa.array([_packed(block)], pa.binary())], ["owner", "body"])

    def merge(batches):
        held, size, limit = [], 0, 2 * entries
        for batch in batches:
            for body in batch.column("body"):
                held.append(pa.ipc.open_stream(body.as_buffer()).read_all())
                size += held[-1].num_rows
                if size > limit:
                    held = [_sum(pa.concat_tables(held), "lang", "w1", "w2", "w3")]
                    size = held[0].num_rows
                    limit = max(limit, 2 * size)
        if not held:
            return
        found = _sum(pa.concat_tables(held), "lang", "w1", "w2", "w3")
        pairs = _sum(found, "lang", "w1", "w2")
        words = _sum(pairs, "lang", "w1")
        pairs = pairs.filter(pc.not_equal(pairs["w2"], END))
        full = found.filter(pc.and_(pc.not_equal(found["w3"], END), pc.greater_equal(found["f"], least)))
        # totals of hot keys are sums of a segment here and cannot be judged yet
        key1 = _key1(words)
        key2 = mix(_key1(pairs) + _word_keys(pairs["w2"].combine_chunks()), 2)
        words, pairs = (t.filter(pa.array(_among(k, hot) | (t["f"].to_numpy() >= least))) for t, k in ((words, key1), (pairs, key2)))
        langs = _sum(found, "lang")
        for t in (full, pairs, words, langs):
            for name in ("w1", "w2", "w3"):
                if name not in t.column_names:
                    t = t.append_column(name, pa.nulls(t.num_rows, pa.string()))
            yield from t.select(["lang", "w1", "w2", "w3", "f"]).to_batches(1 << 16)

    sent = rows.mapInArrow(send, "owner int, body binary").repartitionById(owners, F.col("owner"))
    merged = stored(sent.select("body").mapInArrow(merge, _COUNTS))
    sums = merged.groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f"))
    return stored(sums.where(F.col("w1").isNull() | (F.col("f") >= least)))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (wide[0] * wide[0]), wide[1] * wide[2])


def collocations(docs: DataFrame, least: int = 10, inside_percent: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two or three words
    that occurs `least` times or more, but for those within a longer such
    phrase that has `inside_percent` of their occurrences or more."""
    counts = phrase_counts(docs, least)
    n = counts.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
    words = counts.where("w1 IS NOT NULL AND w2 IS NULL")
    two = counts.where("w2 IS NOT NULL AND w3 IS NULL")
    three = counts.where("w3 IS NOT NULL").withColumnRenamed("f", "a")
    two = (two.withColumnRenamed("f", "a").drop("w3")
           .join(words.select("lang", "w1", F.col("f").alias("f1")), ["lang", "w1"])
           .join(words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("f2")), ["lang", "w2"]))
    longer = (three.select("lang", "w1", "w2", "a")
              .unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
              .groupBy("lang", "w1", "w2").agg(F.max("a").alias("most")))
    pairs = (two.join(longer, ["lang", "w1", "w2"], "left")
             .where(F.col("most").isNull() | (100 * F.col("most") < inside_percent * F.col("a")))
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                     _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score")))
    first = two.select("lang", "w1", "w2", F.col("f1").alias("l1"), F.col("a").alias("l2"))
    rest = two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("f2").alias("r2"))
    cuts = (three.join(first, ["lang", "w1", "w2"]).join(rest, ["lang", "w2", "w3"])
            .withColumn("s1", _score(F.col("a"), F.col("l1"), F.col("r1")))
            .withColumn("s2", _score(F.col("a"), F.col("l2"), F.col("r2"))))
    early = F.col("s1") <= F.col("s2")
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                          F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                          F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                          F.least("s1", "s2").alias("score"))
    return pairs.unionByName(triples).join(n, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def ranked(phrases: DataFrame, first: int = 2000) -> DataFrame:
    """The `first` phrases of each lang by score, occurrences and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))

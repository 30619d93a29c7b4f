"""Toxicity (operator 3): non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text is unlabelled. A
linear numpy classifier over words and parts of words minimises the
class-prior-corrected risk  pi * R_p(+) + max(0, R_u(-) - pi * R_p(-));  where
the bracket falls below zero, a step is taken against it instead.

Training takes a bounded sample (`n_positive` and `n_unlabelled` documents,
whole texts). The features are those over-represented among the positives of
the sample. Scoring reads every whole text, without a shuffle; the model (at
most `n_features` strings and numbers) is broadcast.

Defined results: null and empty texts score as a text without any feature;
without positives, every text scores 0; one row out per row in, repeated rows
alike; a document with several label rows is toxic if one of them says so;
null labels and ids teach nothing; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, texts

_WORDS = re.compile(r"[^\W\d_]+")
# Words a Python worker remembers the features of.
MEMORY = 500_000


def beginnings(word: str) -> list[str]:
    return [word[:k] for k in (4, 5, 6) if len(word) >= k]


def parts(word: str) -> list[str]:
    """Features of a word: itself, its beginnings, and its 5-grams."""
    return [f"={word}", *(f"^{b}" for b in beginnings(word)), *(word[i:i + 5] for i in range(1, len(word) - 4))]


def document_parts(text: str) -> set[str]:
    """Features of a text: those of its words, and the beginnings that at
    least two different words of it share."""
    words = set(_WORDS.findall(text.lower()))
    shared = Counter(b for w in words for b in beginnings(w))
    return {p for w in words for p in parts(w)} | {f"2{b}" for b, n in shared.items() if n > 1}


class _Known(dict):
    """word -> (numbers of its features, of its beginnings if shared) in the model."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word):
        if len(self) > MEMORY:
            self.clear()
        get = self.vocabulary.get
        self[word] = found = (tuple(i for i in map(get, parts(word)) if i is not None),
                              tuple(i for i in (get(f"2{b}") for b in beginnings(word)) if i is not None))
        return found

    def of(self, text: str) -> set[int]:
        """The model's features in a text."""
        found, once = set(), set()
        for w in set(_WORDS.findall(text.lower())):
            own, shared = self[w]
            if own:
                found.update(own)
            for i in shared:
                (found if i in once else once).add(i)
        return found


class Model:
    def __init__(self, vocabulary: dict[str, int], weights: np.ndarray, bias: float):
        self.vocabulary, self.weights, self.bias = vocabulary, weights, bias

    def scores(self, texts_: list[str], known: _Known | None = None) -> np.ndarray:
        known = _Known(self.vocabulary) if known is None else known
        z = np.full(len(texts_), self.bias)
        for k, t in enumerate(texts_):
            found = known.of(t)
            if found:
                z[k] += self.weights[list(found)].sum()
        return _sigmoid(z)


def train_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
               decay: float = 3e-5) -> tuple[np.ndarray, float]:
    """(weights, bias) by Adam on the non-negative risk with the sigmoid loss
    (bounded, so the features chosen on the positives cannot outweigh them)."""
    x_p, x_u = np.c_[pos, np.ones(len(pos))], np.c_[unl, np.ones(len(unl))]
    w = np.zeros(x_p.shape[1])
    w[-1] = -1
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        s_p, s_u = _sigmoid(x_p @ w), _sigmoid(x_u @ w)
        toward = x_p.T @ (s_p * (1 - s_p)) / len(x_p)  # gradient of R_p(-), and of R_p(+) with its sign turned
        against = x_u.T @ (s_u * (1 - s_u)) / len(x_u) - prior * toward
        grad = against - prior * toward if s_u.mean() - prior * s_p.mean() >= 0 else -against
        grad = grad + decay * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id="doc_id", folds: int = 3, fold: int = 1):
    """Rows whose labels training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, n_positive: int = 1500, n_unlabelled: int = 4500,
        n_features: int = 1024, prior: float | None = None) -> Model | None:
    """Learns from documents and the toxic marks of `labels`, both without the
    held-out rows. `prior`: share of toxic text among the unlabelled; by
    default that of the labelled rows. None without positives."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where(~held_out())
    totals = marks.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("p")).first()
    if not totals.p:
        return None
    prior = min(0.9, max(1e-4, totals.p / totals.n)) if prior is None else prior

    def u(seed):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / float(1 << 53)

    rows = texts(docs).where("doc_id IS NOT NULL").where(~held_out())
    ids = marks.where("toxic = 1").where(u(11) < n_positive / totals.p).select("doc_id").limit(2 * n_positive)
    n_rows = max(1, rows.select("doc_id").count())
    drawn = rows.join(F.broadcast(ids), "doc_id").select(F.lit(1).alias("y"), "text").unionAll(  # at most 2 * n_positive ids
        rows.where(u(12) < n_unlabelled / n_rows).limit(2 * n_unlabelled).select(F.lit(0).alias("y"), "text"))
    drawn = cut(drawn)
    n = {r.y: r["count"] for r in drawn.groupBy("y").count().collect()}
    if 1 not in n or 0 not in n:
        return None

    def document_frequencies(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[y].update(document_parts(t))
        for y, c in seen.items():
            items = list(c.items())
            for i in range(0, len(items), 50_000):
                part = items[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in part]), pa.array([n * (y == 1) for _, n in part], pa.int64()),
                     pa.array([n * (y == 0) for _, n in part], pa.int64())], ["part", "p", "u"])

    df = drawn.mapInArrow(document_frequencies, "part string, p long, u long").groupBy("part").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")).where("p >= 3")
    # two-proportion z of the part among positives and unlabelled
    a, b = F.col("p") / n[1], F.col("u") / n[0]
    pooled = (F.col("p") + F.col("u")) / (n[1] + n[0])
    df = df.withColumn("z", (a - b) / F.sqrt(pooled * (1 - pooled) * (1 / n[1] + 1 / n[0]) + 1e-12)).where("z > 4.5")
    best = [r.part for r in df.orderBy(F.desc("z"), "part").limit(n_features).select("part").collect()]
    vocabulary = {p: i for i, p in enumerate(best)}

    def found(batches):
        known = _Known(vocabulary)
        for batch in batches:
            hits = [sorted(known.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(hits, pa.list_(pa.int32()))], ["y", "hits"])

    sample = drawn.mapInArrow(found, "y int, hits array<int>").collect()  # bounded by the sample parameters
    sample.sort(key=lambda r: (r.y, r.hits))
    x = np.zeros((len(sample), len(vocabulary)))
    for k, r in enumerate(sample):
        x[k, r.hits] = 1
    y = np.array([r.y for r in sample])
    weights, bias = train_nnpu(x[y == 1], x[y == 0], prior)
    return Model(vocabulary, weights, bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        known = _Known(m.vocabulary) if m is not None else None
        for batch in batches:
            for part in slices(batch):
                s = m.scores(part.column("text").to_pylist(), known) if m is not None else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")

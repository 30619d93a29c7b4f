"""Language ID (operator 1): hierarchical discrimination.

Texts become hashed character 1- to 3-gram frequencies (lower case, everything
but letters as one kind of space). One-versus-rest linear support vector
machines choose the language family; within it, one-versus-one linear SVMs
vote among its languages. Margins are turned into probabilities (Platt), and
the score is that of the family times the weakest pairwise one of the winner.

Training takes a bounded sample (`sample_rows` rows in all, spread evenly over
the languages); whole texts are read in training and in prediction. Prediction
is narrow: no shuffle, the model (n_classes x buckets numbers) is broadcast.

Defined results: null texts and texts without a letter are `und` with score 0;
with nothing to learn from, every text is `und`; ties in votes go to the first
language in code point order; one row out per row in, repeated rows alike;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

BUCKET_BITS = 12
UNDETERMINED = "und"

# Families of ISO 639-1 codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk", "pl", "cs", "sk"),
    "indic": ("hi", "mr", "ne", "bn", "as", "gu", "pa", "or", "ur"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
}

_LETTERS = None


def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else 32."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)
    return _LETTERS


def features(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row-normalised n-gram matrix, whether each text has a letter)."""
    n = len(texts_)
    out = np.zeros((n, 1 << BUCKET_BITS), dtype=np.float32)
    some = np.zeros(n, dtype=bool)
    table = _letters()
    for i, t in enumerate(texts_):
        if not t:
            continue
        c = table[np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        space = c == 32
        c = c[~(space & np.r_[False, space[:-1]])]  # runs of spaces as one
        some[i] = len(c) > 1
        if not some[i]:
            continue
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:]
        three = (two[:-1] * np.uint32(0x85EBCA77)) ^ c[2:]
        grams = np.concatenate([c * np.uint32(0xC2B2AE3D), two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)])
        x = np.sqrt(np.bincount(grams >> np.uint32(32 - BUCKET_BITS), minlength=1 << BUCKET_BITS))
        out[i] = x / np.linalg.norm(x)
    return out, some


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 150) -> tuple[np.ndarray, float, float]:
    """(weights, bias, slope) of a linear SVM with squared hinge loss for y in
    {-1, 1}, classes weighted evenly, by accelerated gradient descent; slope
    fits P(y = 1) = 1 / (1 + exp(-slope * margin))."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    x1 = np.c_[x, np.ones(len(x), dtype=np.float32)]
    w = v = np.zeros(x1.shape[1], dtype=np.float32)
    rate = 1 / (1 / c + 2 * 2.0)  # rows have norm sqrt(2)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        grad = v / c - 2 * ((share * y * slack) @ x1)
        new = v - rate * grad
        w, v = new, new + k / (k + 3) * (new - w)
    margin = y * (x1 @ w)
    slope = 1.0
    for _ in range(50):  # Newton on the log loss, held finite by a weak prior
        p = 1 / (1 + np.exp(np.clip(slope * margin, -30, 30)))
        g = -(share * p * margin).sum() + 1e-4 * slope
        h = (share * p * (1 - p) * margin * margin).sum() + 1e-4
        slope -= np.clip(g / h, -5, 5)
    return w[:-1], float(w[-1]), float(max(slope, 0.1))


class Model:
    """Family machines, and pairwise machines within each family."""

    def __init__(self, x: np.ndarray, lang: list[str], families: dict[str, tuple]):
        home = {code: f for f, codes in families.items() for code in codes}
        y = np.array(lang, dtype=object)
        self.langs = sorted(set(lang))
        of = {code: home.get(code, code) for code in self.langs}
        self.families = sorted(set(of.values()))
        self.members = {f: [code for code in self.langs if of[code] == f] for f in self.families}
        fam = np.array([of[code] for code in lang], dtype=object)
        self.first = [fit_svm(x, np.where(fam == f, 1, -1).astype(np.float32)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = {}
        for codes in self.members.values():
            for i, a in enumerate(codes):
                for b in codes[i + 1:]:
                    at = (y == a) | (y == b)
                    self.pairs[a, b] = fit_svm(x[at], np.where(y[at] == a, 1, -1).astype(np.float32))

    @staticmethod
    def _p(x, machine) -> np.ndarray:
        w, b, slope = machine
        return 1 / (1 + np.exp(-np.clip(slope * (x @ w + b), -30, 30).astype(np.float64)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of feature rows."""
        n = len(x)
        if self.first:
            p = np.stack([self._p(x, m) for m in self.first], axis=1)
            fam, p_fam = p.argmax(axis=1), p.max(axis=1)
        else:
            fam, p_fam = np.zeros(n, dtype=int), np.ones(n)
        out, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
        for k, f in enumerate(self.families):
            at = np.flatnonzero(fam == k)
            codes = self.members[f]
            votes, worst = np.zeros((len(at), len(codes))), np.ones((len(at), len(codes)))
            for i, a in enumerate(codes):
                for j in range(i + 1, len(codes)):
                    pa_ = self._p(x[at], self.pairs[a, codes[j]])
                    votes[:, i] += pa_ >= 0.5
                    votes[:, j] += pa_ < 0.5
                    worst[:, i], worst[:, j] = np.minimum(worst[:, i], pa_), np.minimum(worst[:, j], 1 - pa_)
            best = votes.argmax(axis=1)
            out[at] = np.array(codes, dtype=object)[best]
            score[at] = p_fam[at] * worst[np.arange(len(at)), best]
        return out, score


def held_out(doc_id="doc_id", folds: int = 5):
    """Rows that training never sees: crc32 of the id as text, modulo folds, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def fit(labelled: DataFrame, sample_rows: int = 2400, families: dict[str, tuple] | None = None) -> Model | None:
    """Learns from (doc_id, text, lang): about `sample_rows` rows in all (never
    more than twice that), an even share of each language, chosen by a hash of
    the id. None if no row has a language and a letter."""
    rows = texts(labelled, F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    each = max(8, sample_rows // len(counts))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / float(1 << 53)
    quota = F.create_map(*[x for code, n in counts.items() for x in (F.lit(code), F.lit(each / n))])

    def vectors(batches):
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                x, some = features(part.column("text").to_pylist())
                keep = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())],
                    ["lang", "x"]).filter(keep)

    drawn = (rows.where(u < quota[F.col("lang")]).select("lang", "text").limit(2 * each * len(counts))
             .mapInArrow(vectors, "lang string, x binary").collect())
    if not drawn:
        return None
    drawn.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.stack([np.frombuffer(r.x, dtype=np.float16) for r in drawn]).astype(np.float32)
    return Model(x, [r.lang for r in drawn], FAMILIES if families is None else families)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                lang, score = np.full(part.num_rows, UNDETERMINED, dtype=object), np.zeros(part.num_rows)
                if m is not None:
                    x, some = features(part.column("text").to_pylist())
                    lang[some], score[some] = m.predict(x[some])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None, min_score: float = 0.25) -> DataFrame:
    """The rows of `docs`, all columns, whose language is determined with at
    least `min_score`; without a model (nothing to learn from) those that have
    a letter. Rows go through Python whole, so none is joined back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch.rename_columns([f"c{i}" for i in range(len(names))]), f"c{at}", 1 << 20):
                x, keep = features([t or "" for t in part.column(at).to_pylist()])
                if m is not None:
                    score = np.zeros(part.num_rows)
                    score[keep] = m.predict(x[keep])[1]
                    keep = score >= min_score
                yield part.filter(pa.array(keep)).rename_columns(names)

    return docs.mapInArrow(run, docs.schema)

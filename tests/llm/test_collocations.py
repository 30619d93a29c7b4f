"""Operator 11 against a brute-force version."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from parcelstack.llm import collocations
from parcelstack.llm.common import slices

from .helpers import documents, edge_rows, prose

FOLD = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least, percent=50):
    """rows: (text, lang) -> {(lang, phrase): (a, l, r, n, score)}."""
    f = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    n = Counter()
    for key, a in f.items():
        if len(key) == 2:
            n[key[0]] += a
    candidates = {key: a for key, a in f.items() if len(key) > 2 and a >= least}
    out = {}
    for (lang, *w), a in candidates.items():
        longer = [b for (other, *v), b in candidates.items() if other == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang, " ".join(w)] = (a, f[lang, *w[:k]], f[lang, *w[k:]], n[lang], score)
    return out


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["The", "of", "a", "été", "dog's", "x-y", " ", "日本", "zz"]
    text = lambda: "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ! "]) for _ in range(rnd.randint(0, 60)))
    return [(k, text(), rnd.choice(["en", "en", "fr", None, "und"])) for k in range(n)]


def result(df):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_against_brute_force(spark):
    from parcelstack.llm.collocations import collocations
    rows = corpus(3, 120)
    want = by_hand([r[1:] for r in rows], 4)
    assert len(want) > 100
    assert result(collocations(documents(spark, rows), least=4)) == want


def test_edges(spark):
    from parcelstack.llm.collocations import collocations, ranked
    rows = [r for r in edge_rows()] * 4
    got = result(collocations(documents(spark, rows), least=10))
    assert got == by_hand([(r[1], r[2]) for r in rows], 10)
    assert ranked(collocations(documents(spark, rows[:3]))).count() == 0
    assert ranked(collocations(documents(spark, rows).limit(0))).count() == 0


def test_overlaps_and_exact_scores(spark):
    from parcelstack.llm.collocations import collocations
    rows = [(1, "a a a a a a a a a a a a a a", "en"), (2, ("b c. " * 7 + "b d c. ") * 3, "en")]
    assert result(collocations(documents(spark, rows))) == by_hand([r[1:] for r in rows], 10)
    # floor(10^6 * a * a / (l * r)) where products pass 64 bits
    from parcelstack.llm.collocations import _score
    from pyspark.sql import functions as F
    a, left, right = 3_000_000_000_001, 3_000_000_000_007, 9_999_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(_score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1000000 * a * a // (left * right)


def test_hot_words_in_segments_change_nothing(spark):
    from parcelstack.llm.collocations import phrase_counts
    rows = corpus(5, 60) + [(1000 + k, "of the " * 30 + prose(k, 30), "en") for k in range(30)]
    docs = documents(spark, rows).repartition(6)
    plain = sorted(map(str, phrase_counts(docs, 3).collect()))
    assert sorted(map(str, phrase_counts(docs, 3, share=5, entries=200).collect())) == plain


def test_few_keys_pass_the_driver(spark):
    from parcelstack.llm.collocations import _frequent
    docs = documents(spark, [(k, prose(k, 400), "en") for k in range(40)]).select("lang", "text")
    n, hot = _frequent(docs, 8)
    assert n == 16000 and 0 <= len(hot) <= 32


def test_ranking(spark):
    from parcelstack.llm.collocations import ranked
    rows = [("en", p, a, 9, 9, 9, s) for p, a, s in (("z z", 5, 7), ("a a", 5, 7), ("é a", 5, 7), ("b b", 6, 7), ("c c", 1, 8))]
    got = ranked(spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long"), first=4)
    assert [(r.rank, r.phrase) for r in sorted(got.collect(), key=lambda r: r.rank)] == [(1, "c c"), (2, "b b"), (3, "a a"), (4, "z z")]


def test_a_slice_holds_little():
    """Counting long batches holds a bounded number of arrays at a time."""
    text = " ".join(prose(k, 400) for k in range(50))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 400, "text": [text[k:] for k in range(400)]})
    assert batch.nbytes > 6 << 20
    tracemalloc.start()
    for part in slices(batch, limit=collocations.SLICE):
        for _, block in collocations.Stripes(part).blocks(8, np.zeros(0, np.uint64)):
            assert block.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20

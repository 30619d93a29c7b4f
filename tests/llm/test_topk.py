"""Operator 10 against all inner products."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelstack.llm import topk_search as K


def brute(rows, asked, k=5):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    out = []
    first = {}
    for i, v in ints:
        first[i] = min(v, first.get(i, v))
    for q in sorted({i for i, _ in ints if i in asked}):
        best = sorted((-sum(a * b for a, b in zip(first[q], v)), i) for i, v in ints if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best[:k], 1)]
    return out


def run(spark, rows, every=5):
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, rank string, `range` string")
    ints = K.integer_vectors(df)
    return [tuple(r) for r in K.top_k(ints, ints.where(f"vec_id % {every} = 0")).orderBy("query_id", "rank").collect()]


def test_against_all_products(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (3 if i % 50 == 0 else 1)]) for i in range(700)]
    assert run(spark, rows) == brute(rows, set(range(0, 700, 5)))


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, None), (9, [float("nan"), 1.0]), (11, [None, 1.0]),
            (12, [float("inf"), 1.0]), (None, [1.0, 1.0]), (13, [-1.0, -1.0]), (14, [1.0]), (16, [1.0, 2.0, 3.0]), (10, []), (20, [1e-9, -1e-9])]
    assert run(spark, rows) == brute(rows, {0, 5, 10, 20})
    assert run(spark, []) == [] and run(spark, [(3, [1.0])]) == [] and run(spark, [(5, [1.0])]) == []


def test_ranges_that_cannot_reach_a_floor_are_not_shipped(spark, monkeypatch):
    """Small packets: many ranges and batches, a third of all rows under one id."""
    monkeypatch.setattr(K, "RANGE_COMPONENTS", 0)  # 128 vectors to a range
    monkeypatch.setattr(K, "BATCH_COMPONENTS", 0)
    rng = np.random.default_rng(2)
    far = {0: 4.0, 1: -4.0}
    rows = [(i, [float(x) for x in rng.normal(size=3) * 0.1 + far.get(i // 700, 0.0)]) for i in range(2100)]
    rows += [(900, [float(x) for x in rng.normal(size=3)]) for _ in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = K.integer_vectors(df)
    search = K.Search(ints, ints.where("vec_id % 5 = 0"), sample=300)
    n_ranges, n_asked = search.ranges.count(), search.batches.agg({"n": "sum"}).first()[0]
    shipped = search.pairs.agg({"n": "sum"}).first()[0]
    assert n_ranges > 20 and search.batches.count() > 3 and n_asked < shipped < n_ranges * n_asked * 0.6
    assert [tuple(r) for r in search.best().orderBy("query_id", "rank").collect()] == brute(rows, set(range(0, 2100, 5)))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 400), st.integers(1, 30))
def test_cell_is_exact(seed, n, spread):
    rng = np.random.default_rng(seed)
    m = rng.integers(-spread, spread + 1, (n, 4))
    ids = np.arange(n) * 2
    q_ids, q = np.array([0, 2, 999]), rng.integers(-spread, spread + 1, (3, 4))
    who, cand, score = K.search_cell(ids, m, q_ids, q, 5)
    for j in range(3):
        s = m @ q[j]
        want = sorted((-int(x), int(i)) for x, i in zip(s, ids) if i != q_ids[j])[:5]
        assert sorted((-int(x), int(i)) for w, i, x in zip(who, cand, score) if w == j) == want


def test_large_components_stay_exact():
    a = np.array([[1 << 40, 3]])
    assert K._product(a, np.array([[1 << 20, 1]]))[0, 0] == (1 << 60) + 3

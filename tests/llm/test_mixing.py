"""Operator 4 against the rules of the mix."""

import os
from collections import Counter, defaultdict

import pytest

from parcelstack.llm import mixing

from .helpers import WORD, documents, edge_rows, prose

SF = "/root/testdata/sf0.001"


def targets(size, weights=(3, 1, 2), share=1.5, cap=2):
    """By definition: share by weight, cap, share the excess again until none is above."""
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), share * sum(size.values())
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * unit >= cap * size[s] - 1e-9}
        if not full:
            return out | {s: w[s] * unit for s in open_}
        for s in full:
            out[s] = cap * size[s]
            left -= out[s]
        open_ -= full
    return out


def check(docs, rows, **options):
    placed, pieces = mixing.plan(docs, **options)
    got = mixing.taken_words(placed, pieces).collect()
    assert len(got) == len(rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    want = targets(size)
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.5
    again = mixing.taken_words(*mixing.plan(docs, **options)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    return placed, pieces, got


@pytest.mark.parametrize("block", [7, 256])
def test_mix(spark, block):
    rows = [(i, prose(i, 5 + i * 7 % 200), None, [None, "b", "a", "hot", "hot", "hot", "tiny"][i % 7]) for i in range(80)]
    rows += [(900, None, None, "b"), (901, "", None, "nothing"), (902, "one", None, "tiny")]
    _, pieces, _ = check(documents(spark, rows), rows, block=block, shard_slots=16)
    seen = defaultdict(set)
    for p in pieces.collect():
        words = set(range(p.first_word, p.first_word + p.n_words))
        key = (p.doc_id, p["pass"])
        assert not words & seen[key]
        seen[key] |= words


def test_edges(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    placed, pieces = mixing.plan(docs)
    got = mixing.taken_words(placed, pieces).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    assert mixing.taken_words(*mixing.plan(docs.limit(0))).count() == 0
    empty = documents(spark, [(1, None, None, "a"), (2, "", None, None)])
    assert [(r.target, r.taken) for r in mixing.taken_words(*mixing.plan(empty)).collect()] == [(0.0, 0)] * 2


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(i, prose(i, 40 + i), None, "ab"[i % 2]) for i in range(40)]
    docs = documents(spark, rows)
    out = mixing.mixed_documents(docs, block=32)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.taken_words(*mixing.plan(docs, block=32)).collect()}
    words, text = Counter(), dict((r[0], r[1]) for r in rows)
    for r in out.collect():
        own = WORD.findall(r.text)
        words[r.doc_id] += len(own)
        assert r.n_chars == len(r.text) and not Counter(own) - Counter(WORD.findall(text[r.doc_id]))
    assert {i: words[i] for i in taken} == taken


def test_mixed_documents_tell_rows_without_or_of_one_id_apart(spark):
    rows = [(None if i % 3 else i, prose(i, 40 + i % 9), None, "ab"[i % 2]) for i in range(40)]
    rows += [(900, prose(900, 60), None, "a")] * 3 + [(901, prose(k, 50), None, "b") for k in (901, 902)] + [(None, prose(903, 30), None, None)] * 2
    size, most = Counter(), Counter()
    for _, text, _, source in rows:
        size[source] += len(WORD.findall(text))
        for w in WORD.findall(text):
            most[source, w] += 2
    want = targets(size)
    docs = documents(spark, rows)
    got = mixing.mixed_documents(docs, block=32).collect()
    taken, used, by_id = Counter(), Counter(), Counter()
    for r in got:
        own = WORD.findall(r.text)
        assert any(r.doc_id == i and r.source == s and not Counter(own) - Counter(WORD.findall(t)) for i, t, _, s in rows)
        taken[r.source] += len(own)
        used.update((r.source, w) for w in own)
        by_id[r.doc_id, r.source] += len(own)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
    assert not used - most
    planned = Counter()
    source = {(r[0], len(WORD.findall(r[1])), size[r[3]]): r[3] for r in rows}
    for r in mixing.taken_words(*mixing.plan(docs, block=32)).collect():
        planned[source[r.doc_id, r.size, r.source_size]] += r.taken
    assert taken == planned
    assert all(by_id[i, s] <= 2 * sum(len(WORD.findall(t)) for j, t, _, z in rows if (j, z) == (i, s)) for i, s in by_id)
    assert Counter(map(tuple, mixing.mixed_documents(docs.repartition(3), block=32).collect())) == Counter(map(tuple, got))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_query(spark):
    from parcelstack.llm import queries as Q
    rows = [(r.doc_id, r.text, None, r.source) for r in Q.table(spark, SF, "documents").collect()]
    check(Q.table(spark, SF, "documents"), rows)
    assert Q.op4_mix(spark, SF).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_permutations_come_from_several_tasks(spark):
    """One source's blocks become rows in several tasks, each block of a pass once."""
    targets = spark.createDataFrame([(0, 40_000, 50_000), (1, 0, 0)], "source_no int, blocks long, quota long").coalesce(1)
    rows = mixing.pass_blocks(targets, 1).selectExpr("source_no", "pass", "block", "h", "spark_partition_id() as task").collect()
    assert len({r.task for r in rows}) >= 4
    assert sorted((r["pass"], r.block) for r in rows) == [(p, b) for p in (0, 1) for b in range(40_000)]
    assert {r.h for r in rows if r.block == 39_999} == {(1 << 63) - 1}

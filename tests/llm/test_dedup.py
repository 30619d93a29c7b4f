"""Operators 5, 7 and 8 against brute force."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelstack.llm import exact_dedup, jaccard_join, substring_dedup
from parcelstack.llm import words as H

from .helpers import documents, edge_rows, near_components, prose, without_repeats

SF = "/root/testdata/sf0.001"


@given(st.sets(st.integers(0, (1 << 40) - 1), min_size=1, max_size=300))
def test_rice_round_trip(values):
    v = np.array(sorted(values), dtype=np.int64)
    k, code = exact_dedup.rice_encode(v, 1 << 40)
    assert exact_dedup.rice_decode(len(v), k, code).tolist() == v.tolist()


@settings(max_examples=50)
@given(st.lists(st.text(alphabet=" \t\nab é\x1c", max_size=20), min_size=1, max_size=5))
def test_word_hashes_split_like_the_pattern(texts):
    import pyarrow as pa

    from .helpers import WORD
    h, n = H.word_hashes(pa.array(texts))
    words = [w for t in texts for w in WORD.findall(t)]
    assert n.tolist() == [len(WORD.findall(t)) for t in texts]
    assert len({(w, x) for w, x in zip(words, h.tolist(), strict=True)}) == len(set(words)) == len(set(h.tolist()))


def test_exact_copies(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    got = exact_dedup.copies(docs).select("doc.doc_id", "keep_id", "group_size", "kept").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    keep = {i: max(x for x in g if x is not None) for g in groups.values() for i in g if i is not None}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert not r.kept and r.keep_id == 6
        else:
            assert r.keep_id == keep[r.doc_id] and r.kept == (r.doc_id == r.keep_id)
    assert {r.doc_id: r.group_size for r in got if r.doc_id is not None}[6] == 4
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted(set(keep.values()))
    assert exact_dedup.copies(docs.limit(0)).count() == 0


def test_one_row_stays_of_a_text_without_any_id(spark):
    rows = [(None, "no id", x, "s") for x in ("en", "fr", "fr", None)] + [(None, None, "en"), (None, "", "en"), (None, "alone"), (None, "named"), (3, "named"), (3, "named")]
    docs = documents(spark, rows)
    got = [exact_dedup.dedup(x).select("doc_id", "text", "lang").collect() for x in (docs, docs.repartition(3, "lang"))]
    assert sorted((r.doc_id or 0, r.text or "") for r in got[0]) == [(0, ""), (0, "alone"), (0, "no id"), (3, "named"), (3, "named")]
    assert sorted(got[0], key=str) == sorted(got[1], key=str)
    assert exact_dedup.dedup(docs).columns == docs.columns


def near_rows():
    """Copies, near copies in chains, groups with a shared beginning, a common passage, short texts."""
    rnd = random.Random(5)
    common = prose(99, 60).split()
    rows, i = [], 0
    for g in range(8):
        base = prose(100 + g, 150).split()
        for _ in range(rnd.randint(1, 7)):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 4, 6])):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(9999)}"
            if rnd.random() < 0.3:
                w = w[:rnd.randint(100, 150)]
            rows.append((i, " ".join(w + (common if g % 2 else []))))
            i += 1
    chain = prose(300, 200).split()
    for k in range(12):
        rows.append((i, " ".join(chain[k * 8:k * 8 + 100])))
        i += 1
    rows += [(i, "One two"), (i + 1, "one  TWO"), (i + 2, "one two three"), (i + 3, None), (i + 4, ""), (i + 5, " ")]
    return rows


def test_jaccard_components(spark):
    rows = near_rows() + [(1000 + k, t) for k, t in near_rows()[:5]]
    n, want = near_components(rows)
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], want[i]) for i in n}
    kept = jaccard_join.keep_representatives(documents(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_links_found_across_components_alone(spark, monkeypatch):
    """Without hubs every link must come out of the cells, many to a shingle."""
    monkeypatch.setattr(jaccard_join, "HUBS", 0)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    rows = near_rows()
    n, want = near_components(rows)
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], want[i]) for i in n}


def test_near_misses_and_repeated_shingles_form_few_pairs(spark, monkeypatch):
    """Documents that miss the threshold by some hundredths leave hardly a
    pair, and shingles with the same documents are looked at once."""
    monkeypatch.setattr(jaccard_join, "HUBS", 0)
    seen, across = {}, jaccard_join.across

    def watched(entries, threshold):
        out = across(entries, threshold)
        seen.update(tokens=entries.select("token").distinct().count(), pairs=out.count())
        return out

    monkeypatch.setattr(jaccard_join, "across", watched)
    rnd, base, passage = random.Random(8), prose(500, 600).split(), prose(600, 200)
    rows = []
    for i in range(24):
        w = list(base)
        for at in rnd.sample(range(600), 17):
            w[at] = f"own{i}x{at}"
        rows.append((i, " ".join(w)))
    n, want = near_components(rows)
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], want[i]) for i in n}
    assert seen["pairs"] <= 24  # of 276
    rows = [(i, f"{passage} tail{i} of its own") for i in range(4)]
    n, want = near_components(rows)
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], want[i]) for i in n}
    assert seen["tokens"] <= 4


def test_parity_bound_loses_no_pair():
    """Whatever shares enough shingles passes, also with hashes that collide."""
    rnd = np.random.default_rng(3)
    x = np.unique(rnd.integers(0, 1 << 62, 5000, dtype=np.uint64))
    for own in (0, 1, 50, 400, 555):
        y = np.unique(np.r_[x[own:], rnd.integers(0, 1 << 62, own, dtype=np.uint64) & np.uint64((1 << 62) - 64)])
        both = len(np.intersect1d(x, y))
        rows = [jaccard_join.parity_rows(pa.array([jaccard_join.parities(s)])) for s in (x, y)]
        sizes = [np.array([len(s)]) for s in (x, y)]
        for t in (80, 90, 99):
            linked = 100 * both >= t * (len(x) + len(y) - both)
            assert not linked or jaccard_join.may_reach(*sizes, *rows, t)[0]


def cell_pairs(cells):
    """Pairs of rows that the cells' tasks form."""
    by = {}
    for r in cells.collect():
        by.setdefault((r.token, r.lo, r.hi), []).append(r)
    return [(x, y) for rows in by.values() for i, x in enumerate(rows) for y in rows[i + 1:]
            if (x.block != y.block if x.lo != x.hi else x.root != y.root)]


def test_cells_hold_pairs_of_different_components_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    sizes = {1: [30], 2: [30, 1], 3: [1] * 13, 4: [9, 2, 2, 1, 8, 1], 5: [1, 1, 1]}  # members of each component
    rows, doc = [], 0
    for token, parts in sizes.items():
        for root, m in enumerate(parts):
            for _ in range(m):
                rows.append((token, doc, 10, 100 * token + root, True, bytes([1] * 128), sum(parts)))
                doc += 1
    entries = spark.createDataFrame(rows, "token long, doc_id long, n int, root long, short boolean, bins binary, c long")
    formed = [(x.token, *sorted((x.doc_id, y.doc_id))) for x, y in cell_pairs(jaccard_join.dealt(entries))]
    want = {(a[0], a[1], b[1]) for i, a in enumerate(rows) for b in rows[i + 1:] if a[0] == b[0] and a[3] != b[3]}
    assert len(formed) == len(set(formed)) and set(formed) == want
    assert sum(t == 2 for t, _, _ in formed) == 30  # linked copies and one other: a pair each
    found = [tuple(r) for r in jaccard_join.across(entries, 80).collect()]
    assert len(found) == len(set(found)) and set(found) == {(a, b) for _, a, b in want}


def test_jaccard_edges(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    got = jaccard_join.similar_components(docs).collect()
    assert len(got) == len(rows)
    n, want = near_components([(r[0], r[1]) for r in rows if r[0] is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (n[r.doc_id], want[r.doc_id])
    assert jaccard_join.similar_components(docs.limit(0)).count() == 0


def test_texts_without_any_id_have_their_size(spark):
    rows = [(None, prose(800, 30)), (None, prose(800, 30)), (None, "one two"), (None, ""), (None, None), (1, prose(801, 20)), (None, prose(801, 20))]
    got = jaccard_join.similar_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 0, 0), (0, 1, 0), (0, 16, 0), (0, 26, 0), (0, 26, 0), (1, 16, 1)]


@pytest.mark.parametrize("window", [50, 9])
def test_substring_removal(spark, window):
    rnd = random.Random(window)
    passages = [prose(500 + k, 70).split() for k in range(4)]
    rows = []
    for i in range(40):
        w = prose(600 + i, rnd.randint(0, 120)).split()
        for _ in range(rnd.randint(0, 3)):
            p, at = rnd.choice(passages), rnd.randint(0, len(w))
            w[at:at] = p[rnd.randint(0, 15):rnd.randint(50, 70)]
        rows.append((i, "  ".join(w)))
    rows += [(100, rows[3][1]), (101, "same " * 130), (102, "same " * 70), (103, None), (104, " \n")]
    want = without_repeats(rows, window)
    got = substring_dedup.remove_repeats(documents(spark, rows), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == want


def test_substring_edges(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    got = substring_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    want = without_repeats([(r[0], r[1]) for r in rows if r[0] is not None], 50)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.text) == want[r.doc_id]
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_rows_of_one_id_lose_their_own_positions(spark):
    low, a, b, c = (prose(k, 80) for k in (700, 701, 702, 703))
    rows = [(1, low), (2, a + " " + low), (2, b), (2, low.rsplit(" ", 20)[0]), (2, low + " " + c), (3, a)]
    want = {(2, a + " " + low): (160, 80, a), (2, b): (80, 0, b), (2, rows[3][1]): (60, 60, ""), (2, rows[4][1]): (160, 80, c), (1, low): (80, 0, low), (3, a): (80, 80, "")}
    got = substring_dedup.remove_repeats(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == sorted((i, *w) for (i, _), w in want.items())


def test_anchors_cover_every_window():
    rng = np.random.default_rng(3)
    for _ in range(20):
        h = rng.integers(0, rng.choice([3, 1 << 60]), 200).astype(np.uint64)
        valid = np.r_[np.arange(0, 90), np.arange(101, 190)]
        found = set(substring_dedup.anchors(h, valid, 26).tolist())
        for lo in [*range(0, 90 - 25), *range(101, 190 - 25)]:
            assert found & set(range(lo, lo + 26))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_queries_against_brute_force(spark):
    from parcelstack.llm import queries as Q
    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]
    n, want = near_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op5_jaccard_join(spark, SF).collect()} == {
        i: (n[i], want[i]) for i in n}
    cut = without_repeats(rows, 50)
    assert {r.doc_id: (r.n_words, r.n_removed) for r in Q.op7_substring_dedup(spark, SF).collect()} == {
        i: x[:2] for i, x in cut.items()}


def test_owners_follow_the_data_and_share_it_evenly(spark):
    """No owner's group grows with the corpus, and anchors or prefixes (small hashes) do not pile onto the first owners."""
    few = exact_dedup.owner_bits_for(spark, 1000)
    assert few == exact_dedup.owner_bits_for(spark, 0) >= 3
    for n in (10**8, 10**10):
        bits = exact_dedup.owner_bits_for(spark, n)
        assert n / exact_dedup.OWNER_FINGERPRINTS <= 1 << bits <= max(1 << few, 2 * n / exact_dedup.OWNER_FINGERPRINTS)
    rng = np.random.default_rng(3)
    small = np.sort(rng.integers(0, 1 << 63, 40_000, dtype=np.uint64))[:4000]
    for fp in (substring_dedup._fp(small), jaccard_join.prefix_fp(small)):
        assert fp.min() >= 0 and fp.max() < 1 << exact_dedup.FINGERPRINT_BITS
        share = np.bincount(fp >> (exact_dedup.FINGERPRINT_BITS - 3), minlength=8)
        assert share.min() > 350 and share.max() < 650


def test_many_owners_give_the_same_rows(spark):
    docs = documents(spark, edge_rows())
    want = sorted(exact_dedup.copies(docs, 3).select("doc.doc_id", "keep_id", "group_size", "kept").collect(), key=str)
    assert sorted(exact_dedup.copies(docs, 9).select("doc.doc_id", "keep_id", "group_size", "kept").collect(), key=str) == want


def test_fingerprints_are_made_and_sent_in_one_python_step(spark, monkeypatch):
    docs = documents(spark, near_rows())
    plans = []
    for module in (jaccard_join, substring_dedup):
        monkeypatch.setattr(module, "cut", lambda df, f=module.cut: (plans.append(df._jdf.queryExecution().executedPlan().toString()), f(df))[1])
    jaccard_join.similar_components(docs).collect()
    assert any("again" in p for p in plans)
    n = len(plans)
    substring_dedup.remove_repeats(docs).collect()
    assert any("again" in p for p in plans[n:])
    # a worker at every core for each step that a task runs one behind another
    assert max(p.count("MapInArrow") for p in plans if "Exchange" not in p and "Join" not in p) == 1

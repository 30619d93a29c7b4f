"""The corpus pipeline: each stage against brute force on its own input."""

import hashlib
import os
from collections import Counter

import pytest

import corpus_pipeline

from .helpers import WORD, documents, edge_rows, near_components, prose
from .test_mixing import targets

SF = "/root/testdata/sf0.001"


def stages(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_stages(spark, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    from parcelstack.llm.queries import model_path
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = stages(spark, docs, tmp_path)
    rows = [t.collect() for t in tables]
    assert all(t.columns == docs.columns for t in tables[:-1])
    # language: text with a letter stays
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if r.text and any(c.isalpha() for c in r.text)}
    last = {}
    for r in rows[1]:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in rows[2]) == sorted(last.values())
    _, roots = near_components([(r.doc_id, r.text) for r in rows[2]])
    assert sorted(r.doc_id for r in rows[3]) == sorted(set(roots.values()))
    size, own = Counter(), {}
    for r in rows[3]:
        own[r.doc_id] = (r.source, len(WORD.findall(r.text)))
        size[r.source] += own[r.doc_id][1]
    want, taken, by_doc = targets(size), Counter(), Counter()
    for r in rows[4]:
        n = len(WORD.findall(r.text))
        taken[r.source] += n
        by_doc[r.doc_id] += n
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
    assert all(n <= 2 * own[i][1] for i, n in by_doc.items())
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    made = Counter((r.doc_id, " ".join(map(str, library.encode(r.text, add_eos=True)))) for r in rows[4])
    assert Counter((r.doc_id, r.ids) for r in rows[5]) == made
    assert all(r.ids_sha256 == hashlib.sha256(r.ids.encode()).hexdigest() for r in rows[5])


def test_edge_rows_and_empty_table(spark, tmp_path):
    rows = [r for r in edge_rows() if r[0] is not None]
    docs = documents(spark, rows)
    tables = stages(spark, docs, tmp_path / "a")
    assert tables[-1].count() > 0 and {0, 1, 2, 3}.isdisjoint({r.doc_id for r in tables[1].collect()})
    assert stages(spark, docs.limit(0), tmp_path / "b")[-1].count() == 0


def test_null_and_repeated_ids_pass_all_stages(spark, tmp_path):
    pytest.importorskip("sentencepiece")
    rows = [(i, prose(i, 60), "en", "ab"[i % 2]) for i in range(8)] + [(None, prose(20 + i, 60), "en", "ab"[i % 2]) for i in range(8)]
    rows += [(30, prose(30, 60), "en", "b")] * 2
    tables = [t.collect() for t in stages(spark, documents(spark, rows), tmp_path)]
    assert [sorted(map(str, ((r.doc_id, r.text) for r in t))) for t in tables[1:4]] == [sorted(map(str, (r[:2] for r in rows)))] * 3
    size = Counter(s for *_, s in rows for _ in range(60))
    want, taken, by_doc = targets(size), Counter(), Counter()
    for r in tables[4]:
        taken[r.source] += len(WORD.findall(r.text))
        by_doc[r.doc_id] += len(WORD.findall(r.text))
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
    assert by_doc[None] > 0 and by_doc[30] <= 2 * 2 * 60 and all(n <= 2 * 60 for i, n in by_doc.items() if i not in (None, 30))
    assert len(tables[5]) == len(tables[4])

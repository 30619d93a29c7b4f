"""Operators 1 and 3: held-out accuracy and defined results."""

import os
import zlib

import numpy as np
import pytest

from parcelstack.llm import language_id, toxicity

from .helpers import documents, edge_rows

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@needs_tables
def test_language_held_out(spark):
    from parcelstack.llm import queries as Q
    lang = {r.doc_id: r.lang for r in Q.table(spark, SF, "documents").collect()}
    got = Q.op1_language_id(spark, SF).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


@needs_tables
def test_language_edges(spark):
    from parcelstack.llm import queries as Q
    model = language_id.fit(Q.table(spark, SF, "documents"))
    assert model.members["romance"] == ["es", "fr"]
    rows = edge_rows()
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    letterless = {0, 1, 2, 3}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == letterless
    assert all(r.score == 0 for i, r in got.items() if i in letterless)
    assert got[8].lang_pred == "en"
    kept = language_id.keep_identified(docs, model)
    assert kept.schema == docs.schema
    assert {0, 1, 2, 3}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() == len(rows) - 4
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_without_labels(spark):
    docs = documents(spark, [(1, "some text", None), (2, None, "en")])
    assert language_id.fit(docs) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    one = language_id.fit(documents(spark, [(1, "some text", "xx"), (2, "more", "xx")]))
    assert {r.lang_pred for r in language_id.predict(docs, one).collect()} == {"xx", "und"}


@needs_tables
def test_toxicity_held_out(spark):
    from parcelstack.llm import queries as Q
    toxic = {r.doc_id: r.toxic for r in Q.table(spark, SF, "labels").collect()}
    got = Q.op3_toxicity(spark, SF).collect()
    assert len(got) == Q.table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in got)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    clean = [p for y, p in held if y == 0]
    assert sum(clean) <= 0.03 * len(clean) and sum(p for y, p in held if y == 1) > 0


def test_toxicity_learns_from_positives_and_unlabelled(spark):
    import random
    rnd = random.Random(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = rnd.choices(words, k=60)
        if i % 6 == 0:
            w[rnd.randrange(60)] = rnd.choice(["Blarg!", "snoofle", "(grumph)"])
            if i % 12 == 0:
                labels.append((i, 1))
        elif i % 5 == 0:
            labels.append((i, 0))
        rows.append((i, " ".join(w)))
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), prior=0.17)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i] >= 0.7 for i in range(0, 600, 6)]) > 0.95
    assert np.mean([got[i] >= 0.7 for i in range(600) if i % 6]) < 0.02
    edge = toxicity.score(documents(spark, edge_rows()), model).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r.score < 0.7 for r in edge)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_without_positives(spark):
    docs = documents(spark, [(1, "a b c"), (None, None)])
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0, 0.0]


def test_nnpu_gradient_separates():
    rng = np.random.default_rng(0)
    pos = np.c_[np.ones(80), rng.integers(0, 2, 80)]
    unl = np.c_[np.r_[np.ones(40), np.zeros(360)], rng.integers(0, 2, 400)]
    w, b = toxicity.train_nnpu(pos, unl, prior=0.1)
    assert b < 0 < w[0] + b and abs(w[1]) < w[0]


def test_without_a_model_every_document_with_a_letter_stays(spark):
    docs = documents(spark, [(1, "some text", None), (2, "日本", None), (3, "7 !!", None), (4, "", None), (5, None, None), (None, "x", None)])
    kept = language_id.keep_identified(docs, language_id.fit(docs))
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2]

"""Operators 2 and 9 against the sentencepiece library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from .helpers import documents, edge_rows

sentencepiece = pytest.importorskip("sentencepiece")
from parcelstack.llm.queries import model_path  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def encoder():
    from parcelstack.llm.bpe import encoder
    return encoder(model_path())


def test_edges(spark, library):
    from parcelstack.llm import sentencepiece_codec as C
    from parcelstack.llm.token_counts import count_tokens, over_limit
    rows = edge_rows()
    docs = documents(spark, rows)
    want = sorted((-1 if r[0] is None else r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows)
    got = over_limit(count_tokens(docs, model_path())).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    text = {r[0]: r[1] or "" for r in rows}
    encoded = C.encode(docs, model_path(), decoded=True)
    for r in encoded.collect():
        ids = library.encode(text[r.doc_id], add_eos=True)
        assert r.ids == ids and r.decoded == library.decode(ids)
    for r in C.decode(encoded, model_path()).collect():
        assert r.decoded == library.decode(library.encode(text[r.doc_id]))
    for r in C.digests(encoded).collect():
        ids = library.encode(text[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert count_tokens(docs.limit(0), model_path()).count() == 0
    assert C.encode(docs.limit(0), model_path()).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=st.sampled_from("ab theing ▁\n\té日🙂<s>/0x1A\u0000"), max_size=80), st.text(max_size=30)), max_size=6))
def test_any_text(encoder, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, n = encoder.encode(texts)
    assert encoder.counts(texts).tolist() == (n - 1).tolist()
    flat, at = ids.tolist(), 0
    for t, k, d in zip(texts, n.tolist(), encoder.model.decode(ids, n), strict=True):
        assert flat[at:at + k] == library.encode(t, add_eos=True)
        assert d == library.decode(flat[at:at + k])
        at += k


def test_long_runs(encoder, library):
    for t in ("a" * 3000, " " * 777 + "x" + " " * 50, "aab" * 2000, "the" * 2000, "=-" * 999, "0123456789abcdef" * 500):
        ids, n = encoder.encode([t])
        assert ids.tolist() == library.encode(t, add_eos=True)


def test_special_strings_are_text(encoder, library):
    for t in ("<s>", "</s><unk>", "<0x0A>", "a<s> b"):
        assert encoder.encode([t])[0].tolist() == library.encode(t, add_eos=True)


def test_model_is_built_in_linear_time():
    import time

    from parcelstack.llm.bpe import Model
    start = time.process_time()
    Model(model_path())
    assert time.process_time() - start < 10


def test_registered_queries_over_a_whole_table(spark, library):
    import os

    from parcelstack.llm.queries import op2_token_counts, op9_sentencepiece, table
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    counts, digests = {}, {}
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_eos=True)
        counts[r.doc_id] = (len((r.text or "").encode()), len(ids) - 1, len(ids) - 1 > 4096)
        digests[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op2_token_counts(spark, sf).collect()} == counts
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op9_sentencepiece(spark, sf).collect()} == digests

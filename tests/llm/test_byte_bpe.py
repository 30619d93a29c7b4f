"""Operator 12 against the tiktoken library."""

import base64
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from .helpers import documents, edge_rows

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    from parcelstack.llm.byte_bpe import Codec
    return Codec(PATH, PATTERN)


def check(codec, library, texts):
    ids, n, starts, ends = codec.encode(texts)
    at = 0
    for t, k, raw in zip(texts, n.tolist(), codec.decode(ids, n), strict=True):
        want = library.encode_ordinary(t)
        assert ids[at:at + k].tolist() == want and raw == t.encode()
        # every token lies within the characters that it names
        for i, a, b in zip(want, starts[at:at + k].tolist(), ends[at:at + k].tolist(), strict=True):
            assert library.decode_single_token_bytes(i) in t[a:b].encode()
        at += k
    assert at == len(ids)


def test_edges(spark, library):
    from parcelstack.llm import byte_bpe as B
    rows = edge_rows()
    docs = documents(spark, rows)
    text = {r[0]: r[1] or "" for r in rows}
    encoded = B.encode(docs, PATH, PATTERN)
    got = encoded.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode_ordinary(text[r.doc_id])
    for r in B.decode(encoded, PATH, PATTERN).collect():
        assert r.decoded == text[r.doc_id] and bytes(r.raw) == text[r.doc_id].encode()
    for r in B.digests(docs, PATH, PATTERN).collect():
        ids = library.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    for f in (B.encode, B.digests):
        assert f(docs.limit(0), PATH, PATTERN).count() == 0


def test_split_characters(spark, library):
    from parcelstack.llm import byte_bpe as B
    ids = library.encode_ordinary("\U00010348𐍈日")
    rows = spark.createDataFrame([(1, ids), (2, ids[:1]), (3, []), (4, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: (r.decoded, bytes(r.raw)) for r in B.decode(rows, PATH, PATTERN).collect()}
    assert len(ids) > 3 and got[1][0] == "\U00010348𐍈日"
    part = library.decode_single_token_bytes(ids[0])
    assert got[2] == (part.decode("utf-8", "replace"), part) and "�" in got[2][0]
    assert got[3] == got[4] == ("", b"")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=st.sampled_from("ab theing's\n\t  \x1c\x85é日🙂<|>0129=-_"), max_size=80), st.text(max_size=30)), max_size=6))
def test_any_text(codec, library, texts):
    check(codec, library, [t.encode("utf-8", "ignore").decode() for t in texts])


def test_long_runs_and_bounded_memory(codec, library, monkeypatch):
    from parcelstack.llm import byte_bpe as B
    texts = ["a" * 3000, " " * 777 + "x" + " " * 50, "aab" * 2000, "=-" * 999, "<|endoftext|> <|endoftext|>", "x  y" * 50, "日" * 500, "w" * 70 + " b"]
    check(codec, library, texts)
    monkeypatch.setattr(B, "MEMORY_IDS", 50)
    for k in range(5):
        check(codec, library, [*texts, f"other {k}"])
        assert all(len(u) <= B.LONG_UNIT for u in codec.codes)
        assert len(codec.codes) == len(codec.count)


def test_byte_table():
    from parcelstack.llm.byte_bpe import byte_table
    from tokenizers import pre_tokenizers
    assert sorted(byte_table()) == sorted(pre_tokenizers.ByteLevel.alphabet())


def test_registered_query_over_a_whole_table(spark, library):
    import os
    from parcelstack.llm.queries import op12_byte_bpe, table
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    want = {}
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op12_byte_bpe(spark, sf).collect()} == want

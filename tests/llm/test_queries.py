"""Registered queries: columns and types of the contracts, and their SQL."""

import os
import sys

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

CONTRACTS = {
    "op1": [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")],
    "op2": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")],
    "op3": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op4": [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")],
    "op5": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")],
    "op6": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op7": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")],
    "op8": [("doc_id", "bigint"), ("keep_id", "bigint"), ("group_size", "bigint"), ("kept", "boolean"), ("text_sha256", "string")],
    "op9": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
    "op10": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")],
    "op11": [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")],
    "op12": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
    "op13": [("conv_id", "bigint"), ("depth", "bigint"), ("parent_conv_id", "bigint"), ("n_convs", "bigint"), ("n_children", "bigint"), ("n_leaves", "bigint"),
             ("saved_tokens", "bigint"), ("ends_sha256", "string")],
}


def test_registered_with_the_entry():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == set(CONTRACTS)


@pytest.mark.parametrize("op", list(CONTRACTS))
def test_columns(spark, op):
    from parcelstack.llm.queries import QUERIES
    query = next(f for name, f in QUERIES.items() if name.startswith(f"{op}_"))
    assert query(spark, SF).dtypes[:len(CONTRACTS[op])] == CONTRACTS[op]


def test_against_sql(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from compare import compare

    from parcelstack.llm.queries import ORACLE_SQL
    res = compare(spark, SF, names=list(ORACLE_SQL), verbose=False)
    assert all(v[0] == "ok" for v in res.values()), res

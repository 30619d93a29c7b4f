"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same check at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["pid", "patterns", "stack_count", "tier"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_queries_match_oracle(spark):
    import __spark_entry__ as E
    from compare import compare
    from parcelstack.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    res = compare(spark, SF, names=list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad

"""The key prefilter loses no match and drops most other keys before the explode."""

import pytest

from parcelstack.operators import keyfilter, parcels as P


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    notices = spark.createDataFrame([(i, [f"K{i}", f"J{i}"]) for i in range(50)] + [(50, []), (51, None), (52, [None, "K1"])], "id long, keys array<string>")
    parcels = spark.createDataFrame([(f"p{i}", None, [f"K{i}", f"X{i}", "COMMON"]) for i in range(2000)] + [("none", None, []), ("null", None, None)],
                                    "pid string, sale_ts timestamp, name_keys array<string>")
    return notices, parcels


def test_no_match_is_lost_and_most_others_go(spark, sides):
    notices, parcels = sides
    index = P.owner_key_index(parcels, keyfilter.key_words(notices, "keys"))
    kept = {(r.pid, r.name_key) for r in index.collect()}
    assert kept >= {(f"p{i}", f"K{i}") for i in range(50)}
    assert len(kept) < 50 + 4002 * 0.3
    assert kept <= {(r.pid, r.name_key) for r in P.owner_key_index(parcels).collect()}
    p = index._jdf.queryExecution().executedPlan().toString()
    assert "_words" in p or "scalar-subquery" in p.lower() or "Subquery" in p
    assert p.index("Generate") < p.index("filter(")  # printed top down: keys are tested below the explode


def test_too_many_keys_mean_no_filter_and_none_an_empty_index(spark, sides, monkeypatch):
    notices, parcels = sides
    assert P.owner_key_index(parcels, keyfilter.key_words(notices.limit(0), "keys")).count() == 0
    monkeypatch.setattr(keyfilter, "MAX_BITS", 9)
    assert keyfilter.key_words(notices, "keys") is None
    assert P.owner_key_index(parcels, None).count() == 6000

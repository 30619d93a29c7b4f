"""Plan shapes that scale depends on, and a hot key holding a third of a feed."""

from pyspark.sql import functions as F

from conftest import make_feeds
from parcelstack.operators import link, parcels as P, rank, score
from parcelstack.plans import build


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_is_partial_group_limit(spark):
    raw = make_feeds(spark, parcels_raw=[{"objectid_1": i, "pid": str(i % 3)} for i in range(9)]).parcels_raw
    p = plan(P.first_row_per_pid(raw))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top_signals_is_partial_group_limit(spark):
    df = spark.createDataFrame([("p", "code", "k", 4, i) for i in range(10)],
                               "pid string, pattern string, rkey string, feed_rank int, row_ord long")
    p = plan(rank.top_signals(df))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_fold_aggregates_partially(spark):
    ev = spark.createDataFrame(
        [("p", "code", True, None, "charlotte_hns", 4, i, "", {}, None) for i in range(10)],
        "pid string, pattern string, fires boolean, flag string, source string, feed_rank int, row_ord long, "
        "rkey string, detail map<string,string>, sale_ts timestamp")
    p = plan(score.fold(ev))
    assert "partial_collect_set" in p and "partial_count" in p


def test_hot_parcel(spark):
    """One parcel holds a third of all code cases: results stay whole and exact."""
    parcels = [{"objectid_1": i, "pid": f"{i:08d}"} for i in range(1, 31)]
    cases = [{"OBJECTID": i, "ParcelId": "1", "CaseStatus": "Open", "CaseType": "Housing"} for i in range(300)]
    cases += [{"OBJECTID": 1000 + i, "ParcelId": str(2 + i % 29), "CaseStatus": "Open"} for i in range(600)]
    f = make_feeds(spark, parcels_raw=parcels, code_cases=cases)
    b = build.build_leads(f, "2024-06-01")
    recs = {r["pid"]: r for r in b.records.collect()}
    assert len(recs) == 30
    hot = recs["00000001"]
    assert hot["flags"] == ["code_housing_case", "code_repeat_violator"]
    assert hot["distress_score"] == 10 + 20          # flag rows 301, capped at 20
    assert len(hot["signals"]["code"]) == 3          # whole feed linked, top 3 kept per pattern
    assert b.evidence.where(F.col("pid") == "00000001").count() == 300


def test_metrics_and_name_join_plans(spark):
    f = make_feeds(spark, parcels_raw=[{"objectid_1": 1, "pid": "00000001", "ownrfrstnme": "JO ANN", "ownrlstnme": "WHITFIELD"}],
                   estates=[{"detail_id": 1, "county": "Mecklenburg", "decedent_name": "Jo Ann Whitfield"},
                            {"detail_id": 2, "county": "Mecklenburg", "decedent_name": "Max Quillfeather Stone"},
                            {"detail_id": 3, "county": "Mecklenburg", "decedent_name": "Cher"}])
    b = build.build_leads(f, "2024-06-01")
    metrics = link.feed_metrics(b.links)
    assert "Join" not in plan(metrics)
    m = {r["feed"]: r for r in metrics.collect()}
    assert len(m) == 5 + 8
    assert tuple(m["estates"])[1:] == (1, 1, 1, 0)
    assert tuple(m["tax"])[1:] == (0, 0, 0, 0)
    # keys are read as stored: no filter of the join holds a regular expression
    notices = build.materialize(link.estate_notices(f.estates))
    p = plan(link.attach_by_name(notices, P.owner_key_index(b.parcels)))
    assert "regexp" not in p and "rlike" not in p.lower()


def test_estate_pages_move_as_keys_and_are_cut_once(spark):
    from parcelstack.plans import queries
    p = queries.estate_extract(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lorem" not in p[p.index("Repartition"):]  # the long texts are made after the shuffle
    assert p.count("</main, 1)") == 1  # a filter on blocks does not cut them again


def test_queries_over_parcels_wait_for_the_parcel_table_only(spark, monkeypatch):
    from parcelstack.plans import queries
    for kept in ("_BUILDS", "_PARCELS", "_FEEDS"):
        monkeypatch.setattr(queries, kept, {})
    monkeypatch.setattr(build, "build_links", lambda *a, **k: (_ for _ in ()).throw(AssertionError("links are not asked for")))
    d = "/root/testdata/sf0.001"
    rows = [q(spark, d).count() for q in (queries.owner_parse, queries.entity_flags, queries.street_normalize)]
    assert rows[0] > 0 and set(rows) == {queries.parcel_table(spark, d).count()}


def test_cluster_settings():
    from parcelstack.session import cluster_settings
    s = cluster_settings(100 * 1024 ** 4, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_settings(10, 8)["spark.sql.shuffle.partitions"] == "16"

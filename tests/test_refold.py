"""The incremental fold: drops merged into a state equal the whole fold."""

import pytest
from pyspark.sql import functions as F

from parcelstack.operators import link, rank, score
from parcelstack.streaming import refold

SCHEMA = ("pid string, pattern string, fires boolean, flag string, source string, feed_rank int, row_ord long, rkey string, "
          "detail map<string,string>, sale_ts timestamp")


def evidence(spark, n=300):
    rows = []
    for i in range(n):
        pid = "hot" if i % 3 == 0 else None if i == 7 else f"p{i % 17}"  # a hot parcel, a row of none
        pattern = ("tax", "estate", None)[i % 5 % 3]
        rows.append((pid, pattern, i % 4 != 0, ("demolition_order", None)[i % 2],
                     ("charlotte_hns", "kania")[i % 7 > 1], 1 + i % 6, i, f"2024-0{1 + i % 9}-01", {"posted": "Jan 2, 2024"}, None))
    return spark.createDataFrame(rows, SCHEMA)


def facts(fold):
    return sorted((r.pid, tuple(r.patterns0), r.n_flags0, tuple(r.flag_set0), r.rule_b, r.n_open_cases) for r in fold.collect())


def tops(top):
    return sorted((r.pid, r.pattern, r["rank"], r.row_ord) for r in top.collect())


def test_drops_equal_the_whole_fold(spark, tmp_path):
    ev = evidence(spark)
    state = str(tmp_path / "state")
    for n in [0, 1, 1, 2, 3, 4]:
        refold.apply_drop(ev.where(F.col("row_ord") % 5 == n), state, n, n_buckets=8)
    live = ev.where("pid IS NOT NULL")
    assert facts(refold.current_fold(spark, state)) == facts(score.fold(live))
    assert tops(rank.top_signals(refold.read_state(spark, state, "top"))) == tops(rank.top_signals(live))


def test_a_drop_reads_and_replaces_its_own_buckets(spark, tmp_path):
    ev = evidence(spark)
    state = str(tmp_path / "state")
    refold.apply_drop(ev, state, 0, n_buckets=8)
    one = refold.apply_drop(ev.where("pid = 'p3'"), state, 1)
    assert len(one) == 1
    held = refold.versions(spark, state)
    assert {b for b, v in held.items() if v == 1} == set(one) and len(held) > 1
    files = refold.read_state(spark, state, "fold", one).inputFiles()
    assert files and all(f"_drop=1/_bucket={one[0]}/" in f for f in files)
    live = ev.where("pid IS NOT NULL")
    twice = live.unionByName(live.where("pid = 'p3'"))
    assert facts(refold.current_fold(spark, state)) == facts(score.fold(twice))


def test_a_drop_that_failed_runs_again_and_empty_drops_change_nothing(spark, tmp_path):
    ev = evidence(spark).where("pid IS NOT NULL")
    state = str(tmp_path / "state")
    assert refold.read_state(spark, state, "fold").count() == 0
    refold.apply_drop(ev.where("row_ord < 200"), state, 0, n_buckets=4)
    # the rows of a drop that was not committed lie there
    refold._bucketed(score.fold_state(ev), 4).write.partitionBy("_bucket").parquet(f"{state}/fold/_drop=1")
    refold.apply_drop(ev.where("row_ord >= 200"), state, 1)
    assert refold.apply_drop(ev.limit(0), state, 2) == []
    assert facts(refold.current_fold(spark, state)) == facts(score.fold(ev))
    with pytest.raises(ValueError):
        refold.apply_drop(ev, state, -1)

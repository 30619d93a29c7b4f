"""What keeps the lead build's driver memory, shuffles and stores in proportion."""

import glob

import pytest

from conftest import make_feeds
from parcelstack.functions import normalize as N
from parcelstack.operators import keyfilter, link, parcels as P
from parcelstack.plans import build, queries
from parcelstack.sources import extract as X, ingest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def small(spark):
    owners = [{"pid": f"{i:08d}", "objectid_1": i, "ownrfrstnme": "ANNA B", "ownrlstnme": f"SURNAME{chr(65 + i)}X", "saledate": "993945600000"} for i in range(1, 9)]
    cases = [{"OBJECTID": i, "ParcelId": p, "CaseNumber": f"H{i}", "CaseStatus": s} for i, (p, s) in enumerate(
        [("1", "Open"), ("2", "Closed"), ("77777", "Open"), ("77778", "Closed"), (None, "Open"), ("3", "Open"), ("3", "Open")])]
    tax = [{"pid_normalized": p, "courtfile": f"T{i}"} for i, p in enumerate(["00000001", "", None, "99999999"])]
    fe = make_feeds(spark, parcels_raw=owners, code_cases=cases, tax=tax)
    return fe, build.materialize(P.clean_parcels(fe.parcels_raw))


def test_no_side_is_broadcast_by_its_estimated_size(spark, small):
    fe, parcels = small
    for df in (link.attach_by_pid(link.code_candidates(fe.code_cases), parcels),
               link.attach_by_name(link.estate_notices(fe.estates), P.owner_key_index(parcels)),
               link.attach_by_address(link.foreclosure_notices(fe.foreclosures), P.address_index(parcels))):
        first_plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in first_plan and "BroadcastHashJoin" not in first_plan


def test_filter_of_pids_keeps_every_link_and_state(spark, small):
    fe, parcels = small
    cands = link.tax_candidates(fe.tax).withColumn("ok", F.lit(True)).unionByName(link.code_candidates(fe.code_cases, open_only=False))
    words = build.pid_filter(parcels, build.materialize)
    sides = [link.link_by_pid(cands, parcels, w) for w in (None, words)]
    plain, kept = [sorted(map(str, df.collect())) for df in sides]
    assert plain == kept and len(kept) == 11
    states = {(r.feed_rank, r.state): r["count"] for r in sides[1].groupBy("feed_rank", "state").count().collect()}
    assert states == {(1, "attached"): 1, (1, "unmatched"): 3, (4, "attached"): 3, (4, "closed_skipped"): 1, (4, "unmatched"): 3}
    # rows that attach to nothing carry no payload
    assert {r.detail is None for r in sides[1].where("state <> 'attached'").collect()} == {True}
    assert {r.detail is None for r in sides[1].where("state = 'attached'").collect()} == {False}
    a, b = [sorted(map(str, link.attach_by_pid(link.code_candidates(fe.code_cases), parcels, w).collect())) for w in (None, words)]
    assert a == b and len(a) == 3


def test_repeated_keys_count_once_for_the_size_of_the_filter(spark, monkeypatch):
    monkeypatch.setattr(keyfilter, "MAX_BITS", 10)
    rows = spark.range(1000).select(F.array(F.lit("SAME"), F.concat(F.lit("K"), F.col("id") % 5)).alias("keys"))
    assert keyfilter.key_words(rows, "keys")[1] == 10


def test_a_pair_of_tokens_is_joined_in_one_order(spark):
    rows = spark.createDataFrame([(["A B C", "C B A", "A C", "C A", "X X", "ONE"],), ([],), (None,)], "keys array<string>")
    assert [r[0] for r in rows.select(N.joined_keys("keys")).collect()] == [["A B C", "C B A", "A C", "X X", "ONE"], [], None]
    names = spark.createDataFrame([("MARY ANN SMITHERS",), ("SMITHERS MARY",), ("MARY SMITHERS",), ("BO LI",), ("MARY",)], "n string")
    o = names.select(F.col("n").alias("o"), N.owner_keys("n").alias("ok"), N.joined_keys(N.owner_keys("n")).alias("oj"))
    d = names.select(F.col("n").alias("d"), N.decedent_keys("n").alias("dk"), N.joined_keys(N.decedent_keys("n")).alias("dj"))
    low = lambda a, b: F.array_min(F.array_intersect(a, b))
    pairs = o.crossJoin(d).select("o", "d", low("ok", "dk").alias("all"), low("oj", "dj").alias("joined")).collect()
    assert all(r["all"] == r["joined"] for r in pairs) and sum(r["all"] is not None for r in pairs) > 4


def test_only_the_feeds_that_are_read_are_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(queries.build, "materialize", lambda df: stored.append(df) or df)
    fe = queries._StoredFeeds(make_feeds(spark, tax=[{"courtfile": "T"}]))
    assert fe.tax.count() == 1 and fe.tax.count() == 1 and len(stored) == 1
    assert len(fe.names()) == 7 and not hasattr(fe, "other")


def test_stores_by_type_and_source_are_compressed(spark, tmp_path):
    fe = make_feeds(spark, instruments=[{"doc_type_code": "dot", "book": "7"}], tax=[{"_source": "kania", "courtfile": "T"}])
    ingest.write_by_type(fe.instruments, f"{tmp_path}/rod")
    ingest.write_tax_snapshot(fe.tax, f"{tmp_path}/tax")
    for folder in ("rod", "tax"):
        files = glob.glob(f"{tmp_path}/{folder}/*/part-*")
        assert files and all(f.endswith(".gz") for f in files)
    assert ingest.read_instruments(spark, f"{tmp_path}/rod").first().book == "7"
    assert ingest.read_tax_snapshot(spark, f"{tmp_path}/tax").first().courtfile == "T"


def test_files_of_a_table_of_one_split_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from parcelstack import session
    session.configure(spark)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 4 * spark.sparkContext.defaultParallelism
    pages = [(i, f"u{i}", f"<article>x\n<p><b>Head {i}</b>&amp; a sale</p>\n<p><b>Two</b> text</article>") for i in range(40)]
    spark.createDataFrame([*pages, (40, "u", None)], "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    events = [(i * 100, "open", float(i)) for i in range(60)]
    spark.createDataFrame(events, "event_id long, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, name: str(tmp_path / name))
    got = queries.page_files(spark, str(tmp_path))
    wanted = queries.page_extract(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(*got.columns).collect()))
    assert got.count() == 80
    assert queries.payload_files(spark, str(tmp_path)).count() == 60
    for name, folders in (("page-files", 41), ("payload-files", 12)):
        files = glob.glob(str(tmp_path / name / "*" / "part-*"))
        assert len(files) == len({f.rsplit("/", 2)[1] for f in files}) == folders  # a file each
        assert len({f.rsplit("/part-", 1)[1][:5] for f in files}) > 2  # number of the task


def test_rows_of_one_key_share_a_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k long, t string").coalesce(1)
    ingest.write_files(rows, "k", str(tmp_path / "f"))
    from parcelstack.sources import extract as X
    assert sorted((r.k or "", r.html) for r in X.read_whole_files(spark, str(tmp_path / "f")).collect()) == [("", "c\n"), ("1", "a\na\n"), ("2", "b\n")]


def test_postings_are_lists_made_in_one_pass_of_a_text(spark, tmp_path):
    """A row a trigram, field and block, not one a record; long, short, empty and null texts, characters beyond 16 bits."""
    from parcelstack.operators import search
    smile = "\U0001F600"
    owners = ["Ann Maple", "ANN MAPLE", "", "ab", None, f"x{smile}{smile}y café", "lorem ipsum " * 20_000 + "the end"]
    rows = [(f"{i:08d}", "1 ELM ST", o, {"tax": [{"case": f"24sp{i}"}]}) for i, o in enumerate(owners)]
    records = spark.createDataFrame(rows, "pid string, address string, owner string, signals map<string,array<map<string,string>>>").coalesce(1)
    search.build_postings(records, str(tmp_path / "p"))
    postings = search.read_postings(spark, str(tmp_path / "p"))
    held = [(r.gram, r.field, r.pids) for r in postings.where("field <> 'signals'").collect()]
    texts = [(f, r[0], (r[k] or "").lower()) for r in rows for k, f in ((1, "address"), (2, "owner"), (0, "pid"))]
    assert len(held) < len({(g, f) for g, f, _ in held}) * 2
    assert sorted((g, f, p) for g, f, pids in held for p in pids) == sorted({(t[i:i + 3], f, p) for f, p, t in texts for i in range(len(t) - 2)})
    find = lambda text, **more: sorted(r.pid[-1] for r in search.search(records, postings, {"text": text, **more}).select("pid").collect())
    assert find("n maple") == ["0", "1"] and find(f"{smile}{smile}Y") == ["5"] and find("m the end") == ["6"] and find("ab") == ["3"]
    assert find("24SP3") == [] and find("24SP3", search_signals=True) == ["3"] and len(find("elm")) == 7


def test_blocks_of_a_few_characters_give_the_same_postings():
    import pyarrow as pa
    from parcelstack.operators import search
    texts = ["abcabc", None, "", "bcab", "abc" * 9, "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(list("012345")), pa.array(texts)], ["pid", "t"])
    want = sorted({(t[i:i + 3], p) for p, t in zip("012345", texts) for i in range(len(t or "") - 2)})
    for chars in (1, 8, 1 << 20):
        got = [r for b in search.posting_lists(("t",), chars)(iter([batch])) for r in b.to_pylist()]
        assert sorted((r["gram"], p) for r in got for p in r["pids"]) == want and all(r["field"] == "t" for r in got)


def test_a_document_is_read_by_lines_in_blocks(spark, tmp_path):
    """A file of many blocks: every line keeps its place, and no file is one value."""
    from parcelstack.operators import report
    schema = "pid string, tier string, tier_rank int, stack_count int, raw_score int, patterns array<string>, flags array<string>, is_absentee boolean, note string"
    rows = [(f"{i * 7919 % 100000:08d}", "WARM", i % 3, i % 4, i % 5, ["tax"], [], False, "line\nbreak " + "x" * (i % 90)) for i in range(700)]
    records = spark.createDataFrame(rows, schema)
    out = str(tmp_path / "doc")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        report.write_document(records, report.run_summary(records), out)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert spark.read.text(out).rdd.getNumPartitions() > 2 * len(glob.glob(out + "/part-*"))
        back = report.read_document(spark, out, records.schema)
        got = [(r.place, r.pid, r.note) for r in back.orderBy("place").collect()]
        plan = back._jdf.queryExecution().analyzed().toString().lower()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    ranked = records.orderBy(F.desc("tier_rank"), F.desc("stack_count"), F.desc("raw_score"), "pid").collect()
    assert got == [(i, r.pid, r.note) for i, r in enumerate(ranked, 1)]
    assert "posexplode" not in plan  # of the lines of a whole file


def test_pages_are_written_and_read_in_batches(spark, tmp_path, monkeypatch):
    """No folder of files is larger than a batch; the rows are those of one folder, null and repeated ids included."""
    pages = [(i, f"u{i}", f"<article><p><b>Head {i}</b>&amp; a sale</p><p><b>Two</b> text</article>") for i in range(30)]
    pages += [(None, "u", "<p><b>None</b> x</article>"), (3, "u", "<p><b>Again</b> y</article>"), (31, "u", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    listed = []
    read = X.read_whole_files
    monkeypatch.setattr(X, "read_whole_files", lambda s, folder, *a: listed.append(folder) or read(s, folder, *a))
    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, name: str(tmp_path / f"{name}-{len(listed)}"))
    want = sorted(map(str, queries.page_files(spark, str(tmp_path)).collect()))
    assert len(listed) == 1 and len(want) == 62
    monkeypatch.setattr(ingest, "FILES_PER_BATCH", 8)
    got = queries.page_files(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == want and len(listed) == 1 + 5
    assert max(len(glob.glob(f"{f}/*/part-*")) for f in listed[1:]) < 20


def test_a_drop_moves_the_held_signals_once(spark, tmp_path, monkeypatch):
    from parcelstack.operators import rank
    from parcelstack.streaming import refold
    from test_refold import evidence
    plans = []
    top = rank.top_signals
    def seen(*a, **k):  # noqa: E306
        plans.append(top(*a, **k))
        return plans[-1]
    monkeypatch.setattr(rank, "top_signals", seen)
    ev = evidence(spark)
    for n in range(2):
        refold.apply_drop(ev.where(F.col("row_ord") % 2 == n), str(tmp_path / "s"), n, n_buckets=4)
    plan = plans[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_bucket") == 1 and plan.count("Exchange hashpartitioning(") <= 2  # another one: of the drop's own rows

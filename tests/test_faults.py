"""Inputs that used to give wrong or missing rows."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import make_feeds
from parcelstack.functions import normalize as N
from parcelstack.operators import link, parcels as P, rank, score
from parcelstack.plans import standins
from parcelstack.sources import extract, feeds as FD, ingest


def test_ids_of_any_spelling_keep_their_row(spark, tmp_path):
    p = tmp_path / "cases.jsonl"
    p.write_text('{"OBJECTID":"5","ParcelId":"1"}\n{"OBJECTID":6.0}\n{"OBJECTID":7}\nnot json\n\n{"OBJECTID":"x","ParcelId":"9"}\n')
    rows = FD.read_jsonl(spark, str(p), FD.CODE_CASE).select("OBJECTID", "ParcelId").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(5, "1"), (6, None), (7, None), (None, "9")], key=str)


def test_csv_cells_with_quotes_commas_and_line_breaks(spark, tmp_path):
    p = tmp_path / "rod.csv"
    p.write_text('Grantor,Legal,Parcel ID,Record Date,record_date\n"ACME ""BEST"" LLC, INC","LOT 1\nBLOCK 2",108-201-04,2024-01-01,2025-05-05\n')
    r = ingest.normalize_instruments(ingest.read_instrument_csv(spark, str(p))).collect()
    assert len(r) == 1
    assert (r[0].grantor, r[0].legal_description, r[0].pid) == ('ACME "BEST" LLC, INC', "LOT 1\nBLOCK 2", "10820104")
    assert r[0].recorded_date == "2025-05-05"  # of headers that read alike the last one


@pytest.mark.parametrize("raw", ["-12", "+7", "12", "", "A1", "123456789", "-12345678", "-1234567", "00000012"])
def test_padding_is_zfill(spark, raw):
    df = spark.createDataFrame([(raw,)], "x string")
    assert df.select(N.pid_padded("x")).first()[0] == raw.zfill(8)


def test_long_keys_keep_all_digits(spark):
    r = spark.createDataFrame([(1234567890,), (42,)], "k long").select(F.expr(standins.dashed("k"))).collect()
    assert [x[0].replace("-", "") for x in r] == ["1234567890", "00000042"]


def test_one_decimal_is_that_of_the_binary_value(spark):
    xs = [99.25, 0.25, 0.35, 12.35, 1234.55, 99.95]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(score._one_decimal(F.col("x"))).collect()] == [float(f"{x:.1f}") for x in xs]
    assert math.isclose(round(99.25, 1), 99.2)


def test_notices_are_classified_by_their_whole_text(spark):
    page = ('<div class="col-md-11 pnsr-block x"><a href="?detail=7"></a><span class="result-date">Jan 2, 2024</span>'
            '<div class="notice-heading">5 Elm St, Anytown, NC</div><div class="notice-summary">' + "word " * 500
            + 'Sale under lien of Shoal HOA &rsquo;</div><strong>County:</strong> Mecklenburg<</div><div id="search-results-pagination">')
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    n = extract.notice_fields(extract.split_blocks(pages, extract.BLOCK_START, extract.BLOCK_END_MARKS))
    assert n.first().summary.endswith("HOA ’") and n.first().detail_url.endswith("real_estate&detail=7")
    parcels = P.clean_parcels(make_feeds(spark, parcels_raw=[{"objectid_1": 1, "pid": "1", "address": "5 ELM STREET ANYTOWN NC"}]).parcels_raw)
    ev = link.attach_by_address(link.foreclosure_notices(n), P.address_index(parcels)).collect()
    assert [(e.pid, e.pattern) for e in ev] == [("1", "lien")] and len(ev[0].detail["summary"]) > 2000
    assert "summary_display" in extract.notice_fields(
        extract.split_blocks(pages, extract.BLOCK_START, extract.BLOCK_END_MARKS), display=True).columns


def test_all_entities_are_decoded_in_cells(spark):
    df = spark.createDataFrame([("<table><tr><th>a</th></tr><tr>" + "".join(
        f"<td>{c}</td>" for c in ["O&rsquo;NEIL &#8211; X", "b", "", "c&amp;lt;", "d", "e", "f"]) + "</tr></table>",)], "html string")
    assert extract.table_rows(df).first().cells == ["O’NEIL – X", "b", "c&lt;", "d", "e", "f"]
    cell = spark.createDataFrame([("12 Oak&rsquo;s Ct<br>Town<br>10820104",)], "x string").select(extract.listing_cell("x").alias("c")).first().c
    assert (cell.pid, cell.street, cell.city) == ("10820104", "12 Oak’s Ct", "Town")


def test_signals_carry_their_own_notice_however_rows_are_dealt(spark):
    parcels = [{"objectid_1": i, "pid": f"{i:08d}", "ownrfrstnme": "JORDAN", "ownrlstnme": f"FAMILYN{chr(65 + i // 26)}{chr(65 + i % 26)}"} for i in range(200)]
    estates = [{"detail_id": 1000 + i, "decedent_name": f"JORDAN FAMILYN{chr(65 + i // 26)}{chr(65 + i % 26)}", "county": "Mecklenburg",
                "case_number": f"24E{i}"} for i in range(200)]
    f = make_feeds(spark, parcels_raw=parcels, estates=estates)
    index = P.owner_key_index(P.clean_parcels(f.parcels_raw))
    ev = link.attach_by_name(link.estate_notices(f.estates.repartition(7)), index).collect()
    assert len(ev) == 200
    assert all(e.detail["case"] == f"24E{int(e.pid)}" and e.row_ord == 1000 + int(e.pid) for e in ev)


def test_order_of_rows_without_an_id_is_stable(spark):
    tax = make_feeds(spark, tax=[{"courtfile": str(i), "pid_normalized": "1"} for i in range(50)]).tax
    a, b = ({r.courtfile: r.o for r in df.select("courtfile", link.row_ord(df).alias("o")).collect()} for df in (tax, tax.repartition(5)))
    assert a == b and len(set(a.values())) == 50


def test_instruments_use_the_first_id_that_is_there(spark):
    rows = [{"pid": "", "parcel_id": "108-201-04"}, {"pid": "7", "parcel_id": "8"}, {"ParcelId": "9"}, {}]
    i = make_feeds(spark, instruments=rows).instruments
    assert sorted(r[0] for r in i.select(link.instrument_pid(i)).collect()) == ["", "00000007", "00000009", "10820104"]


def test_positions_are_those_of_the_ranking(spark):
    rows = [(f"{i * 37 % 100000:08d}", 1 + i % 3, i % 2, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "pid string, tier_rank int, stack_count int, raw_score int")
    got = sorted(rank.with_position(df).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 301))
    assert [r.pid for r in got] == [r.pid for r in rank.rank_leads(df).collect()]


def test_refresh_replaces_a_replayed_batch_and_takes_late_rows(spark, tmp_path):
    from parcelstack.streaming import incremental as inc
    t = str(tmp_path / "t")
    batch = lambda ids: spark.createDataFrame([(i, str(i)) for i in ids], "OBJECTID long, x string")
    for ids, epoch in (([5, 6, 6], 0), ([1, 6, 9], 1), ([1, 6, 9], 1), ([2, 3, 9], 2)):
        inc.cursor_append_batch(batch(ids), t, "OBJECTID", epoch)
    assert sorted(r.OBJECTID for r in spark.read.parquet(t).collect()) == [1, 2, 3, 5, 6, 9]


def test_dedup_stream_survives_a_lost_batch_and_takes_late_drops(spark, tmp_path, monkeypatch):
    from parcelstack.streaming import incremental as inc
    schema = spark.createDataFrame([], "detail_id long, seq long, v string, at timestamp").schema
    src, target, ckpt = (str(tmp_path / x) for x in ("src", "target", "ckpt"))

    def drop(*rows):
        spark.createDataFrame([(*r, None) for r in rows], schema).coalesce(1).write.mode("append").json(src)

    def run():
        inc.run_dedup_stream(spark, src, schema, target, ckpt, id_col="detail_id", order_col="seq")

    drop((1, 2, "second"), (1, 1, "first"), (2, 5, "b"), (2, None, "no order"))
    run()
    drop((1, 0, "late"), (9, 1, "c"), (3, 4, "d"), (3, 4, "e"), (None, 1, "x"), (None, 0, "y"))
    write, failures = inc.write_new_rows, []

    def lost(df, *a):  # the batch is written, its side value is not
        df.write.mode("overwrite").parquet(f"{target}/_batch={a[-1]}")
        failures.append(a[-1])
        raise RuntimeError("executor lost")

    monkeypatch.setattr(inc, "write_new_rows", lost)
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(inc, "write_new_rows", write)
    assert len(failures) == 1
    run()
    drop((4, 1, "f"), (9, 0, "late"), (None, 0, "z"))
    run()
    got = {r.detail_id: r.v for r in spark.read.parquet(target).collect()}
    assert got == {1: "first", 2: "b", 3: "d", 4: "f", 9: "c", None: "y"}
    assert spark.read.parquet(target).count() == 6
    assert tuple(inc.highest_id(spark, target).first()) == (9, 6)


def test_no_scratch_folder_on_a_cluster():
    from parcelstack.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())

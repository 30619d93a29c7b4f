"""Scans, import, extraction and incremental refresh on invented inputs."""

import json
import os

from pyspark.sql import functions as F

from parcelstack.sources import extract as X, feeds as FD, ingest
from parcelstack.streaming import incremental as inc


def test_jsonl_lenient_and_missing(spark, tmp_path):
    p = tmp_path / "tax.jsonl"
    p.write_text('{"_source": "kania", "pid_normalized": "00000001"}\n\nnot json\n{"_source": "rbcwb"}\n')
    df = FD.read_jsonl(spark, str(p), FD.TAX_CASE)
    assert sorted(r["_source"] for r in df.collect()) == ["kania", "rbcwb"]
    assert FD.read_jsonl(spark, str(tmp_path / "absent.jsonl"), FD.TAX_CASE).count() == 0


def test_detect_column():
    cols = ["Record Date", " Doc ID ", "Type", "Document Type", "Tax ID"]
    assert ingest.detect_column(cols, ["recorded_date", "date", "record_date"]) == "Record Date"
    assert ingest.detect_column(cols, ["instrument_id", "doc_id"]) == " Doc ID "
    assert ingest.detect_column(cols, ["doc_type", "type", "instrument_type", "document_type"]) == "Type"
    assert ingest.detect_column(cols, ["amount"]) is None


def test_import_csv_and_per_type_store(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_text("﻿Record Date,Doc ID,Instrument Type,Tax ID,Consideration,Remarks\n"
                   "2024-01-02,A1,Quit Claim Deed,108-201-04,10,x\n"
                   "2024-01-03,A2,Satisfaction of Deed of Trust,12,,y\n"
                   "2024-01-04,A3,,123456789,5,z\n", encoding="utf-8")
    df = ingest.normalize_instruments(ingest.read_instrument_csv(spark, str(csv)), doctype_override="judgment")
    got = {r["instrument_id"]: r for r in df.collect()}
    assert got["A1"]["doc_type_code"] == "quitclaim" and got["A1"]["pid"] == "10820104"
    assert got["A2"]["doc_type_code"] == "dot" and got["A2"]["pid"] == "00000012"
    assert got["A3"]["doc_type"] == "judgment" and got["A3"]["pid"] == "123456789"
    assert got["A1"]["extra"] == {"Remarks": "x"}
    target = str(tmp_path / "store")
    ingest.write_by_type(df, target)
    ingest.write_by_type(df.where(F.col("doc_type_code") == "dot").withColumn("book", F.lit("B")), target)
    back = {r["instrument_id"]: r for r in ingest.read_instruments(spark, target).collect()}
    assert set(back) == {"A1", "A2", "A3"} and back["A2"]["book"] == "B"   # only the dot folder replaced


def test_tax_snapshot_modes(spark, tmp_path):
    rows = [("kania", "1"), ("rbcwb", "2")]
    df = spark.createDataFrame(rows, "_source string, courtfile string")
    for mode, expect in [("per_source", {"1", "2"}), ("whole", {"1"})]:
        t = str(tmp_path / mode)
        ingest.write_tax_snapshot(df, t, mode)
        ingest.write_tax_snapshot(df.where("_source = 'kania'"), t, mode)
        assert {r["courtfile"] for r in ingest.read_tax_snapshot(spark, t).collect()} == expect


NOTICE_PAGE = (
    '<main><div class="col-md-11 pnsr-block odd"><a href="?detail=101">x</a>'
    '<span class="result-date"> Jan 5, 2024 </span><div class="notice-heading">1 Main St &amp; Co</div>'
    '<div class="notice-summary">Sale 24 SP 1234, Book 123 at Page 45. <b>TAX</b>  foreclosure</div>'
    '<strong>County:</strong> Mecklenburg <br><strong>Auction Date:</strong> 2024-02-01 <br></div>'
    '<div class="col-md-11 pnsr-block"><a href="?detail=102">y</a><div class="notice-heading">Doe, Jane Q</div>'
    '<div class="notice-summary">Claims against the estate 24 E 555</div>'
    '<strong>County:</strong> Union<</div><div id="search-results-pagination">1 2</div><div '
    'class="col-md-11 pnsr-block"><a href="?detail=999">after pagination</a></div></main>')


def test_notice_extraction(spark):
    pages = spark.createDataFrame([(1, "u", NOTICE_PAGE)], "page_id long, url string, html string")
    blocks = X.split_blocks(pages, X.BLOCK_START, X.BLOCK_END_MARKS)
    assert blocks.count() == 3
    n = {r["detail_id"]: r for r in X.notice_fields(blocks).collect()}
    assert 999 not in n or n[999]["summary"] == ""
    a = n[101]
    assert (a["posted_date"], a["address"], a["county"], a["auction_date"]) == \
        ("Jan 5, 2024", "1 Main St & Co", "Mecklenburg", "2024-02-01")
    assert (a["sp_case_number"], a["deed_book"], a["deed_page"]) == ("24SP1234", "123", "45")
    assert a["summary"] == "Sale 24 SP 1234, Book 123 at Page 45. TAX foreclosure"
    e = {r["detail_id"]: r for r in X.estate_fields(blocks).collect()}[102]
    assert (e["decedent_name"], e["case_number"], e["county"]) == ("JANE Q DOE", "24E555", "Union")


def test_decedent_phrase(spark):
    df = spark.createDataFrame([("In the matter of the estate of Mary Ann Smith, deceased, late of", "Smith, M")],
                               "s string, h string")
    assert df.select(X.decedent_from(F.col("s"), F.col("h"))).first()[0] == "MARY ANN SMITH"


def test_listing_cell(spark):
    df = spark.createDataFrame([("123 Oak St<br>Anytown NC 28200<br>01234567",),
                                ("(parcel 10820104) 9 Pine Ln<br>City",)], "c string")
    got = [tuple(r) for r in df.select(X.listing_cell("c").alias("x")).select("x.pid", "x.street", "x.city").collect()]
    assert got == [("01234567", "123 Oak St", "Anytown NC 28200"), ("10820104", "9 Pine Ln", "City")]


def test_table_rows(spark):
    html = ("<p>x</p><table><tr><th>Name</th><th>Addr</th></tr><tr><td>A &amp; B</td><td></td><td>1 X St</td>"
            "<td>28200</td><td>108-201-04</td><td>24CVD1</td><td>Open</td></tr><tr><td>short</td></tr></table>"
            "<table><tr><td>second table ignored</td></tr></table>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = X.listing_b_rows(pages).collect()
    assert len(r) == 1
    assert (r[0]["name"], r[0]["address"], r[0]["zip"], r[0]["pid_normalized"], r[0]["status"]) == \
        ("A & B", "1 X St", "28200", "10820104", "Open")   # empty cell removed before positions


def test_feature_rows(spark):
    payload = json.dumps({"features": [{"attributes": {"OBJECTID": 1, "ParcelId": "4"}},
                                       {"attributes": {"ParcelId": "5"}}]})
    df = spark.createDataFrame([(payload,)], "payload string")
    got = X.feature_rows(df, "struct<OBJECTID: bigint, ParcelId: string>", "hns", "OBJECTID").collect()
    assert [(r["OBJECTID"], r["ParcelId"], r["_source"]) for r in got] == [(1, "4", "hns")]


def _drop(spark, rows, d, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(d)


def test_incremental_dedup_equals_batch(spark, tmp_path):
    schema = "detail_id long, seq long, v string"
    drops = [[(1, 1, "a"), (2, 2, "b"), (1, 3, "a2")], [(2, 4, "b2"), (3, 5, "c")], [(3, 6, "c2"), (4, 7, "d")]]
    src = str(tmp_path / "src")
    for rows in drops:
        _drop(spark, rows, src, schema)
    target = str(tmp_path / "target")
    inc.run_dedup_stream(spark, src, spark.createDataFrame([], schema).schema, target, str(tmp_path / "ck"),
                         id_col="detail_id", order_col="seq")
    got = sorted((r["detail_id"], r["v"]) for r in spark.read.parquet(target).collect())
    allrows = spark.createDataFrame([r for d in drops for r in d], schema)
    want = sorted((r["detail_id"], r["v"]) for r in inc.batch_first_versions(allrows, "detail_id", "seq").collect())
    assert got == want == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    # a re-run over the same files does nothing (checkpointed offsets)
    inc.run_dedup_stream(spark, src, spark.createDataFrame([], schema).schema, target, str(tmp_path / "ck"),
                         id_col="detail_id", order_col="seq")
    assert spark.read.parquet(target).count() == 4


def test_cursor_refresh(spark, tmp_path):
    schema = "OBJECTID long, CaseStatus string"
    src = str(tmp_path / "pages")
    _drop(spark, [(1, "Open"), (2, "Open")], src, schema)
    _drop(spark, [(2, "Closed"), (3, "Open")], src, schema)       # repeated page after a crash
    target = str(tmp_path / "cases")
    inc.run_cursor_stream(spark, src, spark.createDataFrame([], schema).schema, target, str(tmp_path / "ck"),
                          "OBJECTID")
    got = sorted((r["OBJECTID"], r["CaseStatus"]) for r in spark.read.parquet(target).collect())
    assert got == [(1, "Open"), (2, "Open"), (3, "Open")]    # id 2 is never re-read (documented hazard)


def test_import_summary_and_cap(spark):
    df = spark.createDataFrame([("dot",), ("dot",), ("quitclaim",)], "doc_type_code string")
    assert {r["doc_type_code"]: r["rows"] for r in ingest.import_summary(df).collect()} == {"dot": 2, "quitclaim": 1}
    assert ingest.cap_rows(df, 2).count() == 2 and ingest.cap_rows(df, None).count() == 3


def test_listing_a_rows(spark):
    payload = json.dumps([
        {"value": {"addressparcel": "(Parcel 10820104) 9 Pine Ln<br>Anytown NC", "saletimetaxvalue":
                   "10:00 AM<br>$12,300.00", "openingbid": "<b>$1,000</b>", "courtfile": "24CVD1", "saledate": "2024-03-01"}},
        {"value": {"addressparcel": "&nbsp;"}},
        {"addressparcel": "5 Elm Rd<br>Town<br>01234567", "saletimetaxvalue": "$5", "county": "Union"}])
    rows = X.listing_a_rows(spark.createDataFrame([(payload,)], "payload string")).collect()
    assert len(rows) == 2
    a, b = rows
    assert (a["pid_normalized"], a["street"], a["city"], a["tax_value"], a["saletime"], a["openingbid"]) == \
        ("10820104", "9 Pine Ln", "Anytown NC", "$12,300.00", "10:00 AM", "$1,000")
    assert (b["pid_normalized"], b["county"], a["county"]) == ("01234567", "Union", "Mecklenburg")


def test_strict_parcel_scan(spark, tmp_path):
    import pytest
    p = tmp_path / "parcels.jsonl"
    p.write_text('{"pid": "1", "objectid_1": 1}\n{broken\n')
    with pytest.raises(Exception):
        FD.read_jsonl(spark, str(p), FD.RAW_PARCEL, strict=True).collect()
    with pytest.raises(FileNotFoundError):
        FD.read_jsonl(spark, None, FD.RAW_PARCEL, strict=True)


def test_run_job_from_jsonl(spark, tmp_path):
    from parcelstack.plans.build import run_job
    d = tmp_path / "raw"
    d.mkdir()
    (d / "parcels.jsonl").write_text("\n".join(json.dumps(r) for r in [
        {"objectid_1": 1, "pid": "00000002", "address": "12 OAK ST CHARLOTTE NC", "ownrfrstnme": "BOB"},
        {"objectid_1": 2, "pid": "00000003", "address": "12 OAK ST CHARLOTTE NC", "ownrlstnme": "CONDO"}]) + "\n")
    (d / "tax.jsonl").write_text(json.dumps({"_source": "kania", "county": "", "pid_normalized": "00000002"}) + "\n")
    (d / "fc.jsonl").write_text(json.dumps({"detail_id": 1, "address": "12 Oak St, Charlotte, NC, 28202",
                                            "county": "Mecklenburg", "summary": "HOA lien sale"}) + "\n")
    out = str(tmp_path / "out")
    run_job(spark, {"parcels": str(d / "parcels.jsonl"), "tax": str(d / "tax.jsonl"),
                    "foreclosures": str(d / "fc.jsonl"), "estates": str(d / "absent.jsonl")},
            out, "2024-06-01", run_id="t1", export_filter={"patterns": ["tax"]})
    recs = {r["pid"]: r for r in spark.read.json(out + "/records").collect()}
    assert recs["00000002"]["tier"] == "warm" and recs["00000003"]["tier"] == "active"
    s = spark.read.json(out + "/summary").first()
    assert s["total"] == 2 and s["source_commit"] == "t1"
    assert spark.read.option("header", True).csv(out + "/export").count() == 1


def test_lines_split_into_rows_and_rejects(spark, tmp_path):
    import pytest
    from parcelstack.sources import feeds as FD
    a, b = tmp_path / "in" / "a.jsonl", tmp_path / "in" / "b.jsonl"
    a.parent.mkdir()
    a.write_text('{"OBJECTID": 5.0, "ParcelId": 7}\n\n  \n{"OBJECTID": "6"}\n{"OBJECTID": 7, "Par\nnot json\n[1]\n"x"\n[{"OBJECTID": 1}]\nnull\n{}\n')
    b.write_text('{"OBJECTID": 8, "other": [1, 2]}\n')
    scan = FD.scan_lines(spark, str(a.parent), FD.CODE_CASE)
    assert sorted((r.OBJECTID or 0, r.ParcelId) for r in scan.rows.collect()) == [(0, None), (5, "7"), (6, None), (8, None)]
    assert {(r.file, r.line) for r in scan.rejects.collect()} == {("a.jsonl", x) for x in ('{"OBJECTID": 7, "Par', "not json", "[1]", '"x"', '[{"OBJECTID": 1}]', "null")}
    assert {tuple(r) for r in scan.counts.collect()} == {("a.jsonl", 3, 6), ("b.jsonl", 1, 0)}
    assert scan.rows.schema == FD.CODE_CASE
    with pytest.raises(ValueError, match=r"a.jsonl \(6\)"):
        FD.scan_lines(spark, str(a.parent), FD.CODE_CASE, strict=True)
    assert FD.scan_lines(spark, str(b), FD.CODE_CASE, strict=True).rows.count() == 1
    none = FD.scan_lines(spark, str(tmp_path / "none"), FD.CODE_CASE)
    assert none.rows.count() == none.rejects.count() == none.counts.count() == 0
    for path in (None, str(tmp_path / "none")):
        with pytest.raises(Exception):
            FD.scan_lines(spark, path, FD.CODE_CASE, strict=True)


def test_folder_of_exports_with_different_headers(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    (d / "a.csv").write_text("\ufeffDoc ID,Tax ID,Instrument Type,Clerk\r\nA1,123-456-78,DEED OF TRUST,Kim\r\n")
    (d / "b.csv").write_text('type,instrument,pid,grantor\nQUITCLAIM,B1,9,"Doe, ""Jo""\nand heirs"\nQUITCLAIM,B2,10,x\n')
    (d / "c.csv").write_text("Doc ID,Tax ID,Instrument Type,Clerk\nC1,7,DEED OF TRUST,Lee\n")
    (d / "empty.csv").write_text("")
    got = {r.instrument_id: r for r in ingest.import_folder(spark, str(d)).collect()}
    assert set(got) == {"A1", "B1", "B2", "C1"}
    assert got["A1"].pid == "12345678" and got["A1"].extra == {"Clerk": "Kim"} and got["C1"].extra == {"Clerk": "Lee"}
    assert got["B1"].grantor == 'Doe, "Jo"\nand heirs' and got["B1"].extra == {} and got["B2"].pid == "00000010"
    headers = ingest.file_headers(spark, str(d)).collect()
    assert sorted(len(r.files) for r in headers) == [1, 2]
    (tmp_path / "nothing").mkdir()
    (tmp_path / "nothing" / "x.csv").write_text("")
    assert ingest.import_folder(spark, str(tmp_path / "nothing")).count() == 0


def test_whole_files(spark, tmp_path):
    from parcelstack.sources import extract as X
    (tmp_path / "p" / "day=2024-01-02").mkdir(parents=True)
    (tmp_path / "p" / "day=2024-01-02" / "a.html").write_text("<p><b>One\nline</b> text &amp; more\r\n</article> tail")
    (tmp_path / "p" / "day=2024-01-03").mkdir()
    (tmp_path / "p" / "day=2024-01-03" / "b.html").write_text("<p><b>Two</b> x")
    got = {r.day: r for r in X.read_whole_files(spark, str(tmp_path / "p")).collect()}
    assert got["2024-01-02"].html == "<p><b>One\nline</b> text &amp; more\r\n</article> tail" and got["2024-01-02"].url.endswith("a.html")
    rows = X.read_whole_files(spark, str(tmp_path / "p")).withColumnRenamed("day", "page_id")
    assert {r.page_id: r.summary for r in X.page_sections(rows).collect()} == {"2024-01-02": "One line text & more", "2024-01-03": "Two x"}
    assert X.read_whole_files(spark, str(tmp_path / "none")).count() == 0


def test_union_of_listings(spark):
    from parcelstack.sources import feeds as FD
    a = spark.createDataFrame([("kania", "1 Elm", "$5", 1)], "_source string, street string, tax_value string, _row long")
    b = spark.createDataFrame([("rbcwb", "Jo", "Open", 2, "x")], "_source string, name string, status string, _row long, other string")
    out = ingest.union_listings(a, b, keep=("_row",))
    assert out.columns == [*FD.TAX_CASE.names, "_row"]
    assert sorted((r._source, r.street, r.name, r.tax_value, r.status, r._row) for r in out.collect()) == [
        ("kania", "1 Elm", None, "$5", None, 1), ("rbcwb", None, "Jo", None, "Open", 2)]
    assert ingest.union_listings(a.limit(0)).count() == 0


def _decoded(spark, texts):
    from parcelstack.sources.extract import html_unescape, html_unescape_all
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", html_unescape("t").alias("one"), html_unescape_all(F.array("t", F.lit("&lt;"))).alias("all"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    rows = sorted((r["i"], r["one"], r["all"]) for r in out.collect())
    assert all(r[2] == [r[1], "<"] for r in rows)
    return [r[1] for r in rows]


def test_entities_without_python(spark):
    """Every name with and without its semicolon, every kind of number, and random runs of the characters that matter."""
    import html
    import random
    from html.entities import html5
    texts = ["", "&", "a & b", "&&amp;&", "&amp;lt;", "&#;", "&#x;", "&#xg;", "&notit;", "&ampersand", "&LT", "&nosuch;", "&" + "a" * 40 + ";"]
    for n in html5:
        texts += [f"x&{n}y", f"&{n.rstrip(';')} z", f"&{n.rstrip(';')}Q;"]
    edges = {0, 9, 10, 11, 12, 13, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1F600, 0x10FFFE, 0x10FFFF, 0x110000, 10**12}
    for n in sorted(edges | set(range(1, 300))):
        texts += [f"&#{n};", f"&#00{n}b", f"&#x{n:x};", f"&#X{n:X}g", f"&#x000{n:x}"]
    rng = random.Random(7)
    texts += ["".join(rng.choice(["&", "&", "#", "x", ";", "amp", "lt", "not", "in", "1", "38", "f", " ", "<", "\n", "\u00e9", "\U0001f600"])
                      for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    got = _decoded(spark, texts)
    wrong = [(t, g, html.unescape(t)) for t, g in zip(texts, got, strict=True) if g != html.unescape(t)]
    assert not wrong, wrong[:10]


def test_entities_null(spark):
    from parcelstack.sources.extract import html_unescape
    assert spark.createDataFrame([(None,)], "t string").select(html_unescape("t").alias("r")).first()["r"] is None


def test_extraction_by_plain_search(spark):
    """Blocks, summaries and ends of texts are found as their patterns find them."""
    import re
    from pyspark.sql import functions as F
    from parcelstack.sources import extract as X
    o, e = X.SUMMARY_START, X.SUMMARY_END
    blocks = ["", "none", f"{o}open", f"{e}{o}a{e}b{e}", f"x{o}{e}", f"{o}a{o}b{e}c", f"{o}é\nz{e}"]
    ends = ["", " ", "a", " a ", "a\t \n", "\x0b a\x0c b\r", "a \u2028", "\xa0a\xa0", "a\x85", "a&#10;", "&#9; a &#x2028;", "a  b\n\nc"]
    got = [r[0] for r in spark.createDataFrame([(b,) for b in blocks], "b string").select(X._between(F.col("b"), o, e)).collect()]
    found = [re.search(f"(?s){o}(.*?){e}", b) for b in blocks]
    assert got == [m[1] if m else "" for m in found]
    df = spark.createDataFrame([(x,) for x in [*ends, None]], "x string").select(
        X.strip_tags("x"), X.N.clean(X.html_unescape(F.regexp_replace(F.regexp_replace("x", "<[^>]+>", " "), r"\s+", " "))))
    assert all(a == b for a, b in df.collect())
    pages = ["no block", "a<<b</e>c<<d|x</e><<", "<<</e|"]
    rows = X.split_blocks(spark.createDataFrame([(x,) for x in pages], "html string"), "<<", ["|x", "</e"]).collect()
    want = [(n, re.sub(r"(?s)(?:\|x|</e).*$", "", b)) for x in pages for n, b in enumerate(x.split("<<")) if n]
    assert [(r.block_no, r.block) for r in rows] == want


def test_first_version_of_an_id_with_nulls_and_ties(spark, tmp_path):
    """The first by order, nulls last, then by content; ids seen before add nothing."""
    from parcelstack.streaming import incremental as inc
    schema, src, target = "id long, seq long, v string", str(tmp_path / "src"), str(tmp_path / "t")
    for rows in ([(1, None, "a"), (1, 5, "c"), (1, 5, "b"), (2, None, "z"), (2, None, "y"), (3, 0, "q"), (3, -1, "r"), (None, 1, "n")],
                 [(1, 0, "late"), (4, 2, "w"), (None, 0, "m")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
    inc.run_dedup_stream(spark, src, spark.createDataFrame([], schema).schema, target, str(tmp_path / "c"), id_col="id", order_col="seq")
    got = sorted(((r.id or 0, r.seq, r.v) for r in spark.read.parquet(target).collect()), key=str)
    assert got == sorted([(1, 5, "b"), (2, None, "y"), (3, -1, "r"), (0, 1, "n"), (4, 2, "w")], key=str)

"""Row-level rules on literal inputs (F1-F14, P3, P4), each trap included."""

import pytest
from pyspark.sql import functions as F

from parcelstack.functions import normalize as N


def one(spark, expr, *vals, schema="a string"):
    df = spark.createDataFrame([vals], schema)
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("addr,num,name", [
    ("9738 STEELE CREEK RD", "9738", "CREEK RD"),          # unit word inside a name (no word boundary)
    ("1 UNITED DR", "1", "DR"),
    ("5 STERLING RD", "5", "RD"),
    ("101 ST JAMES DR", "101", "ST"),                        # cut at the first suffix word
    ("12 FOO LOOP CHARLOTTE NC", "12", "FOO LOOP CHARLOTTE NC"),  # unknown suffix keeps the city
    ("PO BOX 12", "", ""),
    ("123A MAIN ST", "123", "A MAIN ST"),
    ("9738 Loughlin Ln, Charlotte, NC, 28273", "9738", "LOUGHLIN LN"),
    ("9738 LOUGHLIN LN CHARLOTTE NC", "9738", "LOUGHLIN LN"),
    ("77 Elm Avenue Apt 4B 28202", "77", "ELM AVE"),
    ("5 Court Square", "5", "CT"),
    ("", "", ""),
])
def test_street_key(spark, addr, num, name):
    r = one(spark, N.street_key(F.col("a")), addr)
    assert (r["num"], r["name"]) == (num, name)


def test_street_key_null(spark):
    r = one(spark, N.street_key(F.col("a")), None)
    assert (r["num"], r["name"]) == ("", "")


@pytest.mark.parametrize("site,mail,expected", [
    ("12 OAK ST CHARLOTTE NC", "99 OAK ST", False),   # house number ignored
    ("12 OAK ST CHARLOTTE NC", "12 ELM ST", True),
    ("12 OAK ST CHARLOTTE NC", "PO BOX 12", True),    # PO box has no number -> '' name
    ("12 OAK ST CHARLOTTE NC", "", False),
    ("", "12 ELM ST", False),
])
def test_absentee(spark, site, mail, expected):
    assert one(spark, N.is_absentee(F.col("a"), F.col("b")), site, mail, schema="a string, b string") is expected


@pytest.mark.parametrize("raw,norm", [
    ("John A Smith Jr", "JOHN A SMITH"),
    ("ACME HOLDINGS, L.L.C.", "ACME HOLDINGS L L C"),   # multi-word noise never matches one token
    ("Mary-Ann O'Neil", "MARY ANN O NEIL"),
    ("SMITH FAMILY TRUST", "SMITH"),
    ("V SMITH", "V SMITH"),                              # V is a suffix, not noise
    ("", ""),
])
def test_normalize_owner(spark, raw, norm):
    assert one(spark, N.normalize_owner(F.col("a")), raw) == norm


def test_owner_keys(spark):
    keys = one(spark, N.owner_keys(F.col("a")), "ANNA MARIE WALKER")
    assert keys == ["ANNA MARIE", "MARIE ANNA", "ANNA MARIE WALKER", "WALKER MARIE ANNA", "WALKER ANNA MARIE",
                    "ANNA WALKER", "WALKER ANNA"]
    assert one(spark, N.owner_keys(F.col("a")), "AL LEE") == []          # 2+3 < 8: no two-word key
    assert one(spark, N.owner_keys(F.col("a")), "CHER") == []
    assert one(spark, N.owner_keys(F.col("a")), "JOHN WALKER") == ["JOHN WALKER", "WALKER JOHN"]


@pytest.mark.parametrize("norm,keys", [
    ("JOHN Q PUBLIC", ["JOHN Q PUBLIC", "PUBLIC Q JOHN", "PUBLIC JOHN Q", "JOHN PUBLIC", "PUBLIC JOHN"]),
    ("MARY SMITH", []),                  # common surname guard
    ("MARY LONG", []),                   # four-letter surname
    ("MARY ELLEN SMITH", ["MARY ELLEN SMITH", "SMITH ELLEN MARY", "SMITH MARY ELLEN"]),
    ("CHER", []),
    ("JOHN JOHN JOHN", ["JOHN JOHN JOHN"]),   # duplicates removed, order kept
])
def test_decedent_keys(spark, norm, keys):
    assert one(spark, N.decedent_keys(F.col("a")), norm) == keys


@pytest.mark.parametrize("owner,entity,landlord", [
    ("ACME HOLDINGS LLC", True, True),
    ("FOO LLC, BAR", False, False),        # 'LLC,' is not a token
    ("SMITH CO", False, False),            # CO without a dot
    ("SMITH CO. INC", True, False),
    ("SMITH PA", True, False),             # PA as a name part
    ("REID LLC", True, True),              # REI inside REID
    ("ESTATE OF JOHN DOE", True, False),
    ("", False, False),
])
def test_entity(spark, owner, entity, landlord):
    assert one(spark, N.is_entity(F.col("a")), owner) is entity
    assert one(spark, N.is_landlord_entity(F.col("a")), owner) is landlord


@pytest.mark.parametrize("first,last,parsed", [
    ("BRIAN K JR", "SMITH SR", ("BRIAN", "K", "SMITH SR", "JR", False)),   # JR in both fields: last keeps SR
    ("JOHN", "DOE III", ("JOHN", "", "DOE", "III", False)),
    ("ACME", "HOLDINGS LLC", ("", "", "", "", True)),
    ("Mary  Ann", "Lee", ("Mary", "Ann", "Lee", "", False)),
    (None, "V", ("", "", "", "V", False)),
    ("JANE Q.", "DOE JR.", ("JANE", "Q.", "DOE", "JR", False)),
])
def test_parse_owner(spark, first, last, parsed):
    df = spark.createDataFrame([(first, last)], "a string, b string")
    r = N.with_owner_parsed(df, "a", "b", "r").first()["r"]
    assert (r["first_name"], r["middle_name"], r["last_name"], r["suffix"], r["is_entity"]) == parsed


@pytest.mark.parametrize("summary,case,pattern", [
    ("NOTICE OF TAX FORECLOSURE SALE", "24SP1", "tax"),
    ("Mecklenburg County, Plaintiff", "", "tax"),
    ("MECKLENBURG COUNTY VS DOE", "", "tax"),
    ("SHOAL CREEK sale", "24SP1", "lien"),                 # 'HOA' substring
    ("Homeowner's Association lien", "", "lien"),
    ("trustee sale", "24SP9", "jfc"),
    ("execution sale", "24CV9", "lien"),
    ("anything", "", "jfc"),                               # default
])
def test_notice_pattern(spark, summary, case, pattern):
    assert one(spark, N.notice_pattern(F.col("a"), F.col("b")), summary, case, schema="a string, b string") == pattern


@pytest.mark.parametrize("text,code", [
    ("Deed of Trust", "dot"),
    ("Satisfaction of Deed of Trust", "dot"),        # order hazard
    ("satisfaction of judgment", "judgment"),
    ("hoa assn lien", "asgn"),
    ("substitution of trustee", "substitution_of_trustee"),
    ("Mechanic's Lien", "mechanic's_lien"),
    ("QCD", "quitclaim"),
    ("  Release of Lien ", "satisfaction"),
    ("", ""),
])
def test_doctype(spark, text, code):
    assert one(spark, N.canonical_doctype(F.col("a")), text) == code
    df = spark.createDataFrame([(text,)], "doc_type string")
    assert N.with_doctype_code(df).first()["doc_type_code"] == code


@pytest.mark.parametrize("raw,digits,padded", [
    ("123-45-678", "12345678", "123-45-678"),
    ("", "", "00000000"),            # blank pads to 00000000 on the code-case path
    ("123456789", "123456789", "123456789"),
    ("12", "00000012", "00000012"),
    (" 4 ", "00000004", "00000004"),
])
def test_pids(spark, raw, digits, padded):
    assert one(spark, N.pid_digits(F.col("a")), raw) == digits
    assert one(spark, N.pid_padded(F.col("a")), raw) == padded


def test_dates(spark):
    import datetime as dt
    for s in ["2024-01-05", "Jan 5, 2024", "01/05/2024", "January 5, 2024", "2024-1-5"]:
        assert one(spark, N.parse_posted(F.col("a")), s) == dt.datetime(2024, 1, 5)
    assert one(spark, N.parse_posted(F.col("a")), "soon") is None
    assert one(spark, N.ms_to_ts(F.col("a")), "0") is None
    assert one(spark, N.ms_to_ts(F.col("a")), "nan") is None
    assert one(spark, N.ms_to_ts(F.col("a")), "4102444800000") is None
    assert one(spark, N.ms_to_ts(F.col("a")), "1.5e12") == dt.datetime(2017, 7, 14, 2, 40)


def test_days_floor(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 12, 0))], "a timestamp, b timestamp")
    assert df.select(N.days_between(F.col("a"), F.col("b"))).first()[0] == -1   # floor, like timedelta.days


def test_exemption(spark):
    df = spark.createDataFrame([("HOMESTEAD ELDERLY",), ("DISABLED VETERAN",), ("DISABLED",), ("ELDER EXCLUSION",), ("ELDER  ",)], "e string")
    ex = N.exemption_flags("e")
    got = [tuple(r) for r in df.select(*[ex[k] for k in ["is_homestead", "is_senior", "is_disabled_veteran",
                                                          "is_disabled"]]).collect()]
    assert got == [(True, True, False, False), (False, False, True, False), (False, False, False, True),
                   (False, True, False, False), (False, False, False, False)]

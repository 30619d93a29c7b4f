"""Operator 6 against a brute-force scan."""

import hashlib
import os
import random
import re
import string

import pytest

from parcelstack.llm import secret_scan

from .helpers import documents, edge_rows

SF = "/root/testdata/sf0.001"


def any_case(word):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYS = "|".join([any_case(w) for w in ("password", "passwd", "secret", "token")] + [any_case("api") + "_?" + any_case("key")])
PATTERNS = [("assign", re.compile(rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
            ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = []
    for k, (name, pattern, group, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return sorted(found)


def check(rows, got):
    text = {}
    for i, t in rows:
        text.setdefault(i, t)
    assert len(got) == len(rows)
    for r in got:
        spans = base_spans(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(s for *_, s in spans).encode()).hexdigest(), text[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in spans) for j in range(3)]
        mine = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert mine == [s for *_, s in spans]


TRICKY = ["password:token:abcdefgh", "Token = 'abc' SECRET=\"abcdef\"", "api-key: zzzzzzz apikey:zzzzzz API_KEY  =  'q1w2e3r4'", "ſecret=abcdefg toKen=abcdefg",
          "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16 + "AKIA0000", "AKIAAKIA" + "1" * 14, "é🙂 " + "0af" * 8 + "," + "f" * 23, "password=" + "a1" * 30, "passwordpassword=abcdef",
          "token==abcdef", "secret: \n abcdef", "x" * 50 + "deadbeef" * 4 + "password=deadbeefdeadbeefdeadbeefdead", "password=abc" * 400]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + k, r[1]) for k, r in enumerate(edge_rows())] + [(0, TRICKY[0])]
    check(rows, secret_scan.digests(secret_scan.scan(documents(spark, rows))).collect())
    assert secret_scan.digests(secret_scan.scan(documents(spark, []))).count() == 0


def test_random_strings_are_added_and_regular_ones_not(spark):
    rnd = random.Random(4)
    rows, secret, plain = [], {}, set()
    for i in range(300):
        s = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(40))
        rows.append((i, f"some words {s} and more"))
        secret[i] = f"random:11:{11 + 40}"
    for i in range(300, 600):
        rows.append((i, f"some words {rnd.choice(['aaaaaaaaaaaaaaaaaaaaB1', 'AbAbAbAbAbAbAbAb1111111111111', 'Version1Version1Version1Version1Version1'])} and more"))
        plain.add(i)
    rows.append((600, "password=" + "Zx9" * 10 + "Q7"))  # overlaps a base span
    got = {r.doc_id: r for r in secret_scan.digests(secret_scan.scan(documents(spark, rows))).collect()}
    assert sum(got[i].spans == s for i, s in secret.items()) > 0.9 * len(secret)
    assert sum(got[i].n_random for i in plain) == 0
    assert got[600].n_random == 0 and got[600].n_assign == 1


def test_candidates_of_every_alphabet_reach_the_battery(spark):
    rnd = random.Random(6)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    shapes = {"base36": (lower + digits, 32), "upper base36": (upper + digits, 32), "base32": (lower + "234567", 32),
              "upper base32": (upper + "234567", 32), "letters": (lower, 32), "upper letters": (upper, 32),
              "both letters": (lower + upper, 32), "digits": (digits, 22), "hex": (digits + "ABCDEF", 32), "short": (lower + upper, 20),
              "base64": (lower + upper + digits + "+/", 40), "base64url": (lower + upper + digits + "-_", 40),
              "any": (lower + upper + digits + "+/-_", 60)}
    rows, of = [], {}
    for name, (alphabet, n) in shapes.items():
        for _ in range(40):
            of[len(rows)] = name, n
            rows.append((len(rows), "some words " + "".join(rnd.choice(alphabet) for _ in range(n)) + " and more"))
    for _ in range(40):
        of[len(rows)] = "uuid", 36
        h = "".join(rnd.choice("0123456789abcdef") for _ in range(32))
        rows.append((len(rows), f"some words {h[:8]}-{h[8:12]}-4{h[13:16]}-{h[16:20]}-{h[20:]} and more"))
    plain = ["-" * 40, "_" * 25, "/" * 20, "internationalization", "xyz789" * 5, "deadbeef-" * 4, "A" * 30, "1" * 22,
             "state-of-the-art-and-other-words", "usr/local/share/python/site/packages", "ABABABABABABABABABABABAB", "abcdefghijklmnopqrstuvwxyz"]
    first = len(rows)
    rows += [(first + i, f"some words {t} and more") for i, t in enumerate(plain)]
    got = {r.doc_id: r for r in secret_scan.digests(secret_scan.scan(documents(spark, rows))).collect()}
    found = {name: sum(got[i].spans == f"random:11:{11 + n}" for i, (x, n) in of.items() if x == name) for name in {*shapes, "uuid"}}
    assert all(n >= 34 for n in found.values()), found
    assert [t for i, t in enumerate(plain) if got[first + i].spans] == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_query(spark):
    from parcelstack.llm import queries as Q
    rows = [(r.doc_id, r.text) for r in Q.table(spark, SF, "documents").collect()]
    check(rows, Q.op6_secret_scan(spark, SF).collect())


def test_plan_has_no_python(spark):
    rows = secret_scan.digests(secret_scan.scan(documents(spark, [(1, "a")])))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

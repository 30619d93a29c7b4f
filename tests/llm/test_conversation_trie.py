"""Operator 13 against a brute-force version."""

import hashlib
import random
import zlib
from collections import defaultdict

from .helpers import WORD


def by_hand(rows):
    """rows: (conv_id, turn, role, text) -> the nodes by definition."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    new = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        new[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            members[tuple(new[c][:d])].append(c)
    kids = defaultdict(list)
    for g in members:
        if g:
            kids[g[:-1]].append(g)

    def below(g):
        out, todo = [], [g]
        while todo:
            x = todo.pop()
            out.append(x)
            todo.extend(kids[x])
        return out

    nodes = set()
    for g, who in members.items():
        sub = below(g)
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in sub if x)
        ends = ",".join(str(c) for c in who if len(new[c]) == len(g))
        nodes.add((who[0], len(g), members[g[:-1]][0] if g else None, len(who), len(kids[g]), sum(not kids[x] for x in sub), saved,
                   hashlib.sha256(ends.encode()).hexdigest()))
    return nodes


def table(spark, rows):
    full = [(*r, "x", "y", 1) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, d string, ext string, c long").repartition(5)


def nodes(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def talk(seed, n, depth, words):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "user", "bot"]), " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, words))))
            for c in range(n) for t in range(rnd.randint(1, depth))]


def test_against_brute_force(spark):
    from parcelstack.llm.conversation_trie import prefix_trie
    rows = talk(1, 90, 9, 1) + talk(2, 150, 3, 2)[:100]
    rows += [(500 + c, t, "user", "same") for c in range(30) for t in range(17 + c % 3)]
    rows += [(900 + c, t, "user", "same" if t != 5 + c else "other") for c in range(12) for t in range(23)]
    assert nodes(prefix_trie(table(spark, rows))) == by_hand(rows)


def test_edges(spark, monkeypatch):
    from parcelstack.llm import conversation_trie as T
    rows = [(0, 1, "user", "a b"), (0, 1, "user", "a b"), (0, None, None, None), (0, -5, "", ""), (7, 2, "user", None), (-3, 1, "bot", "x"), (-20, 0, "bot", "y z"),
            (None, 1, "user", "lost"), (21, 0, "user", ""), (22, 0, "user", " \n\t "), (23, 0, "u", "ser"), (24, 0, "us", "er"), (40, 0, "user", "word " * 40000),
            (41, 0, "user", "word " * 40000), (41, 1, "user", "word " * 40000), (41, 2, "a", "b"), (41, 3, "a", "b"), (41, 9000, "a", "c"), (41, -9000, "a", "d")]
    assert nodes(T.prefix_trie(table(spark, rows))) == by_hand(rows)
    assert T.prefix_trie(table(spark, rows).limit(0)).count() == 0
    # h turns or fewer and no conversation to lend any: members of the root alone
    bare = [c for c in range(60) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:3]
    got = nodes(T.prefix_trie(table(spark, [(c, 0, "user", "x") for c in bare])))
    assert got == by_hand([(c, 0, "user", "x") for c in bare]) and len(got) == 1 and next(iter(got))[5] == 1
    # long conversations are scanned in chunks, long lists of members digested in parts
    monkeypatch.setattr(T, "CHUNK", 4)
    monkeypatch.setattr(T, "ID_BYTES", 8)
    rows = [(c, t, "user", "same" if t != 20 else str(c % 3)) for c in range(40) for t in range(30)]
    assert nodes(T.prefix_trie(table(spark, rows))) == by_hand(rows)


def test_two_fattest(spark):
    from parcelstack.llm.conversation_trie import _two_fattest
    from pyspark.sql import functions as F
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    zeros = lambda x: (x & -x).bit_length()
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("f", _two_fattest(F.col("a"), F.col("b")))
    for r in df.collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=zeros)

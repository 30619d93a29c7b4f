"""Fixtures and brute-force versions for the operator tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# names that the operators use inside; input columns of these names must not disturb them
CLASH = ["size", "start", "row", "kind", "block", "pass", "fp", "body", "n", "ids", "h1", "token", "keep_id", "u", "v", "at", "_words"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), *["x"] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    import random
    rnd = random.Random(seed)
    syl = ["the", "an", "ti", "on", "er", "sh", "wh", "ea", "ing", "re", "nt"]
    return " ".join("".join(rnd.choice(syl) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters."""
    a = prose(1, 120)
    return [(0, None, "en", "s1"), (1, "", "en", None), (2, " \n\t ", None, "s1"), (3, "7 !!", "en", "s2"), (4, "a", "en", "s2"),
            (5, a, "en", "s1"), (6, a, "en", "s1"), (6, a, "en", "s1"), (7, a.upper(), "en", "s3"), (None, a, "en", "s3"),
            (8, prose(2, 30000), "en", "s1"), (9, "x" * 20000, "en", None), (10, "naïve 日本語 🙂\u0000   end ▁▁", "fr", "s2"),
            (11, a + " tail", "en", "s1"), (12, prose(3, 4), "en", "s2"), (13, prose(3, 4).title(), "en", "s2")]


def components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k=5):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def near_components(rows, k=5, threshold=80):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    linked = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * len(sets[a] | sets[b]):
                linked.append((a, b))
    return {i: len(s) for i, s in sets.items()}, components(ids, linked)


def without_repeats(rows, window):
    """{doc_id: (n_words, n_removed, kept)} by definition."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    low = {}
    for i, w in words.items():
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            low[key] = min(i, low.get(key, i))
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if low[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out

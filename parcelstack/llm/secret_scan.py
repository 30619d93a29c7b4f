"""Secret scans (operator 6): patterns plus a randomness test battery,
DataFrame functions only.

Base spans come from three patterns. Beyond them, every run of 20 or more
characters of a usual encoding is a candidate: its encoding is inferred as the
smallest standard alphabet that holds all its characters (digits, hex, hex with
hyphens, letters of one case, base32, base36, letters, base62, base64, URL-safe
base64, or all of these), and over that alphabet three tests ask whether it
looks drawn at random: chi-squared uniformity, runs above and
below the middle of the alphabet, and lag-one serial correlation. Fisher's
method combines them. Candidates for which randomness is rejected are
dropped, the others reported; the false discovery rate of the rejections is
held per length class (Benjamini-Hochberg over a histogram of p-values, so no
class is ever sorted in one task).

Positions come from what lies between matches (`split`) and the matches
themselves, summed up per document.

Defined results: null and empty texts have no spans; positions count code
points; matches are the leftmost non-overlapping ones of each pattern, short
ones dropped after matching; a candidate that overlaps a base span is not
added; one row out per row in, repeated rows alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, texts

# The base kinds with (pattern, group that the length applies to, least length).
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # maximal runs, so the least length can stand in the pattern
)
RANDOM = ("random", r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20)
KINDS = (*(k[0] for k in BASE), RANDOM[0])

_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
# alphabets by size; the first that covers a candidate is inferred, and the last covers every one
ENCODINGS = (
    _DIGITS,
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _DIGITS + "abcdef-",
    _DIGITS + "ABCDEF-",
    _LOWER,
    _UPPER,
    _UPPER + "234567",
    _LOWER + "234567",
    _LOWER + _DIGITS,
    _UPPER + _DIGITS,
    _UPPER + _LOWER,
    _UPPER + _LOWER + _DIGITS,
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "-_",
    _UPPER + _LOWER + _DIGITS + "+/-_",
)

_HIT = "array<struct<kind:int,nth:int,gap:int,len:int,keep:boolean,token:string>>"


def _hits(number: int, pattern: str, group: int, least: int, token: bool) -> Column:
    """Matches of one pattern in `text`: what lies before each, and its length."""
    text, p = F.col("text"), F.lit(pattern)
    found = F.arrays_zip(F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group)),
                         F.split(text, pattern, -1))

    def hit(z, i):
        whole, part, before = z.getField("0"), z.getField("1"), z.getField("2")
        return F.struct(F.lit(number).alias("kind"), i.alias("nth"), F.char_length(before).alias("gap"),
                        F.char_length(whole).alias("len"), (F.char_length(part) >= least).alias("keep"),
                        (whole if token else F.lit(None).cast("string")).alias("token"))

    matches = F.filter(F.transform(found, hit), lambda h: h.getField("len").isNotNull())
    return F.when(F.rlike(text, p), matches).otherwise(F.array().cast(_HIT)).cast(_HIT)


def _tail(z: str) -> str:
    """Upper tail of the standard normal, by its logistic approximation."""
    return f"(1 / (1 + exp(least(700D, 0.07056D * pow({z}, 3) + 1.5976D * {z}))))"


def battery(rows: DataFrame) -> DataFrame:
    """Adds p to rows with `token`: the combined p-value of randomness over
    the inferred encoding; null only where `token` is."""
    body = F.regexp_replace("token", "=+$", "")
    # covered: nothing is left of it without the alphabet's characters
    alpha = F.coalesce(*[F.when(F.translate(body, a, "") == "", F.lit(a)) for a in ENCODINGS])
    rows = rows.withColumn("body", body).withColumn("alpha", alpha)
    rows = rows.withColumn("a", F.char_length("alpha").cast("double")).withColumn("n", F.char_length("body").cast("double"))
    rows = rows.withColumn("squares", F.expr(
        "aggregate(transform(split(alpha, ''), c -> n - char_length(replace(body, c, ''))), 0D, (s, x) -> s + x * x)"))
    rows = rows.withColumn("chi", F.expr("((a / n * squares - n) - (a - 1)) / sqrt(2 * (a - 1) * (n - 1) / n)"))
    rows = rows.withColumn("bits", F.expr(
        "translate(body, alpha, concat(repeat('0', int(a / 2)), repeat('1', int(a) - int(a / 2))))"))
    rows = rows.withColumn("ones", F.expr("n - char_length(replace(bits, '1', ''))"))
    rows = rows.withColumn("runs", F.expr(
        "1 + (n - char_length(replace(bits, '01', ''))) / 2 + (n - char_length(replace(bits, '10', ''))) / 2"))
    rows = rows.withColumn("mean_runs", F.expr("2 * ones * (n - ones) / n + 1"))
    rows = rows.withColumn("var_runs", F.expr("(mean_runs - 1) * (mean_runs - 2) / (n - 1)"))
    rows = rows.withColumn("z_runs", F.expr("if(var_runs > 0, abs(runs - mean_runs) / sqrt(var_runs), 40D)"))
    rows = rows.withColumn("v", F.expr(
        "transform(filter(split(body, ''), c -> c <> ''), c -> cast(instr(alpha, c) as double))"))
    rows = rows.withColumn("mu", F.expr("aggregate(v, 0D, (s, x) -> s + x) / n"))
    rows = rows.withColumn("ss", F.expr("aggregate(v, 0D, (s, x) -> s + (x - mu) * (x - mu))"))
    rows = rows.withColumn("lag", F.expr(
        "aggregate(zip_with(slice(v, 1, int(n) - 1), slice(v, 2, int(n) - 1), (x, y) -> (x - mu) * (y - mu)), 0D, (s, x) -> s + x)"))
    rows = rows.withColumn("z_lag", F.expr("if(ss > 0, abs((lag / ss + 1 / n) * sqrt(n)), 40D)"))
    logs = " + ".join(f"ln(greatest(1e-300D, {p}))" for p in (
        _tail("least(40D, chi)"), f"2 * {_tail('least(40D, z_runs)')}", f"2 * {_tail('least(40D, z_lag)')}"))
    rows = rows.withColumn("half", F.expr(f"if(alpha IS NULL, NULL, greatest(0D, -({logs})))"))
    rows = rows.withColumn("p", F.expr("exp(-half) * (1 + half + half * half / 2)"))
    return rows.drop("body", "alpha", "a", "squares", "chi", "bits", "ones", "runs", "mean_runs", "var_runs", "z_runs",
                     "v", "mu", "ss", "lag", "z_lag", "half")


def rejections(tested: DataFrame, rate: float = 0.05) -> DataFrame:
    """(class, from_bin): per length class, from which bin of -20 log10(p) on
    randomness is rejected."""
    bins = tested.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("c"))
    worse = W.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    bins = bins.withColumn("k", F.sum("c").over(worse)).withColumn("m", F.sum("c").over(W.partitionBy("class")))
    return bins.where(F.pow(F.lit(10.0), -F.col("bin") / 20) <= rate * F.col("k") / F.col("m")).groupBy("class").agg(
        F.min("bin").alias("from_bin"))


def scan(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """(row, doc_id, kind, start, end) of every span; rows with null kind are
    no spans, and every document has one row at least. `row` tells the rows of
    the input apart."""
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    patterns = (*BASE, RANDOM)
    hits = F.concat(*[_hits(i, p, g, least, token=i == len(BASE)) for i, (_, p, g, least) in enumerate(patterns)])
    rows = rows.select("row", "doc_id", F.explode_outer(hits).alias("h")).select("row", "doc_id", "h.*")
    by_kind = W.partitionBy("row", "kind").orderBy("nth")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(by_kind.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("start", F.col("end") - F.col("len"))
    # a row whose match is too short stays without a kind, for its document
    rows = rows.withColumn("kind", F.when(F.col("keep"), F.col("kind")))
    base = F.col("kind") < len(BASE)
    order = W.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, W.unboundedFollowing))
    rows = rows.withColumn("over", F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)))
    rows = rows.withColumn("kind", F.when(base | ~F.col("over"), F.col("kind")))
    rows = battery(rows.withColumn("token", F.when(F.col("kind") == len(BASE), F.col("token"))))
    rows = rows.withColumn("class", F.floor(F.log2("n")).cast("int"))
    rows = rows.withColumn("bin", F.when(F.col("p").isNotNull(), F.least(F.lit(400), F.floor(-20 * F.log10(
        F.greatest("p", F.lit(1e-30)))).cast("int"))))
    rows = cut(rows.select("row", "doc_id", "kind", "start", "end", "class", "bin"))
    limits = rejections(rows.where("bin IS NOT NULL"), rate)
    rows = rows.join(F.broadcast(limits), "class", "left")  # one row per power of two of the length
    secret = (F.col("kind") < len(BASE)) | (F.col("bin") < F.coalesce("from_bin", F.lit(1 << 30)))
    return rows.select("row", "doc_id", F.when(secret, F.col("kind")).alias("kind"), "start", "end")


def digests(spans: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base kinds, base_sha256,
    spans, n_random."""
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    one = F.when(F.col("kind").isNotNull(), F.struct(
        "start", "kind", F.concat_ws(":", name, F.col("start"), F.col("end")).alias("s")))
    count = [F.sum((F.coalesce("kind", F.lit(-1)) == i).cast("long")).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    out = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *count, F.sort_array(F.collect_list(one)).alias("all"))
    joined = lambda a: F.array_join(F.transform(a, lambda x: x.getField("s")), ",")
    base = F.filter("all", lambda x: x.getField("kind") < len(BASE))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(base), 256).alias("base_sha256"),
                      joined(F.col("all")).alias("spans"), "n_random")

"""Column builders for identifiers, street addresses and owner names.

Every function takes Columns and returns a Column, so the work stays inside
Catalyst / whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _lit_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def _at(arr, i) -> Column:
    """1-based element access that yields null when out of range (ANSI-safe)."""
    return F.try_element_at(arr, i if isinstance(i, Column) else F.lit(i))


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """null -> '' and strip surrounding whitespace (not only spaces)."""
    return F.regexp_replace(F.coalesce(col_(c).cast("string"), F.lit("")), r"^\s+|\s+$", "")


def nonblank(c) -> Column:
    """'' -> null, for coalesce chains that mimic Python `a or b`."""
    c = col_(c)
    return F.when(c != "", c)


def join_nonempty(*cols) -> Column:
    """Join the non-empty cleaned parts with one space."""
    return F.concat_ws(" ", *[nonblank(clean(c)) for c in cols])


# ---------------------------------------------------------------- identifiers
# Both pid rules are one regex over a zero-prefixed string, so the input is
# referenced once: nested or pushed-down copies of the rule stay linear.
_PID8_RE = r"^0{7}$|^0{7}(?=\d{9,}$)|^\d*?(?=\d{8}$)"


def pid_digits(c) -> Column:
    """Keep digits; left-pad to 8 when there are 1..8, else unchanged ('' stays '').

    (Spark's lpad would truncate longer input; the regex never does.)
    """
    d = F.regexp_replace(F.coalesce(col_(c).cast("string"), F.lit("")), r"\D", "")
    return F.regexp_replace(F.concat(F.lit("0000000"), d), _PID8_RE, "")


def pid_padded(c) -> Column:
    """Strip, then zero-fill to 8 keeping non-digits (blank -> 00000000); the
    zeros go behind a leading sign, and longer ids stay as they are."""
    signed = F.regexp_replace(clean(c), r"(?s)^([+-]?)(.*)$", "$100000000$2")
    # too many zeros now: drop as many as the width allows, behind the sign
    return F.regexp_replace(signed, r"(?s)^([+-]?)0{8}(?=.{8,}$)|(?s)^([+-])0*?(?=.{7}$)|(?s)^0*?(?=.{8}$)", "$1$2")


# ---------------------------------------------------------------- addresses
_SUFFIX_CUT = "^(.*?) (" + "|".join(K.STREET_SUFFIX) + ") "


def street_key(c) -> Column:
    """Address key struct(num, name) from a free-form street address.

    Steps: upper; drop ', <city>, NC <zip>' tail; drop trailing ZIP; drop
    unit designators (no word boundary, on purpose); take the leading house
    number; the rest becomes single-spaced alphanumeric tokens cut after the
    first known suffix word, which is replaced by its canonical form. All
    regex and map lookups: stays inside generated code.
    """
    s = F.upper(F.coalesce(col_(c).cast("string"), F.lit("")))
    s = F.regexp_replace(s, r",\s*\w[\w\s]*,?\s*NC[\s,0-9-]*$", "")
    s = F.regexp_replace(s, r"\s+\d{5}(-\d{4})?$", "")
    s = F.regexp_replace(s, r"\s+(UNIT|APT|STE|SUITE|#)\s*\S+", "")
    num = F.regexp_extract(s, r"^\s*(\d+)", 1)
    rest = F.regexp_replace(F.regexp_replace(s, r"^\s*\d+", ""), "[^A-Z0-9 ]", " ")
    t = F.trim(F.regexp_replace(rest, " +", " "))
    padded = F.concat(F.lit(" "), t, F.lit(" "))
    sfx = F.regexp_extract(padded, _SUFFIX_CUT, 2)
    pre = F.trim(F.regexp_extract(padded, _SUFFIX_CUT, 1))
    canon = F.element_at(_lit_map(K.STREET_SUFFIX), sfx)
    name = F.when(sfx == "", t).otherwise(F.trim(F.concat(pre, F.lit(" "), canon)))
    return F.struct(num.alias("num"), F.when(num != "", name).otherwise(F.lit("")).alias("name"))


def is_absentee(site, mail) -> Column:
    """Both addresses non-blank and their street names differ (number ignored)."""
    s, m = clean(site), clean(mail)
    return (s != "") & (m != "") & (street_key(s)["name"] != street_key(m)["name"])


# ---------------------------------------------------------------- owner names
# Single-word noise tokens. Multi-word entries ('L L C', 'ET AL', ...) can
# never equal one token, so they never apply and are left out of the regex.
_NOISE_RE = " (?:" + "|".join(t for t in K.NAME_NOISE if " " not in t) + ")(?= )"


def normalize_owner(c) -> Column:
    """Upper, non-alphanumerics to spaces, drop noise tokens, single-space join."""
    up = F.regexp_replace(F.upper(F.coalesce(col_(c).cast("string"), F.lit(""))), "[^A-Z0-9 ]", " ")
    padded = F.concat(F.lit(" "), F.regexp_replace(up, " +", " "), F.lit(" "))
    kept = F.regexp_replace(padded, _NOISE_RE, "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def _toks(norm) -> Column:
    n = col_(norm)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.split(n, " "))


def owner_keys(norm) -> Column:
    """Index-side name keys of a normalized owner name (array<string>)."""
    return owner_keys_from_tokens(_toks(norm))


def decedent_keys(norm) -> Column:
    """Probe-side keys of a normalized decedent name, distinct, in order."""
    return decedent_keys_from_tokens(_toks(norm))


def name_tokens(norm) -> Column:
    """Tokens of a normalized name (empty array for '')."""
    return _toks(norm)


def owner_keys_from_tokens(t) -> Column:
    """Index-side name keys of a normalized owner name (array<string>).

    From the first three tokens a, b, c: 'a b' and 'b a' when len(a)+len(b) >= 8;
    'a b c', 'c b a', 'c a b'; 'a c' and 'c a' when len(a)+len(c) >= 8.
    Fewer than two tokens gives no key.
    """
    t = col_(t)
    n = F.size(t)
    a, b, c = _at(t, 1), _at(t, 2), _at(t, 3)
    ab = (n >= 2) & (F.length(a) + F.length(b) >= 8)
    three = n >= 3
    ac = three & (F.length(a) + F.length(c) >= 8)
    none = F.array().cast("array<string>")
    return F.concat(
        F.when(ab, F.array(F.concat_ws(" ", a, b), F.concat_ws(" ", b, a))).otherwise(none),
        F.when(three, F.array(F.concat_ws(" ", a, b, c), F.concat_ws(" ", c, b, a),
                              F.concat_ws(" ", c, a, b))).otherwise(none),
        F.when(ac, F.array(F.concat_ws(" ", a, c), F.concat_ws(" ", c, a))).otherwise(none),
    )


def decedent_keys_from_tokens(t) -> Column:
    """Probe-side keys from a token array, distinct, in order.

    Three or more tokens: 'p0 p1 p2', 'p2 p1 p0', 'pLast p0 p1'. Then
    'first last' and 'last first' when the last token has >= 5 letters and is
    not a common surname. Fewer than two tokens gives no key.
    """
    t = col_(t)
    n = F.size(t)
    p0, p1, p2 = _at(t, 1), _at(t, 2), _at(t, 3)
    last = _at(t, -1)
    three = n >= 3
    two_ok = (n >= 2) & (F.length(last) >= 5) & ~F.array_contains(_lit_array(K.COMMON_SURNAMES), last)
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(
        F.when(three, F.array(F.concat_ws(" ", p0, p1, p2), F.concat_ws(" ", p2, p1, p0),
                              F.concat_ws(" ", last, p0, p1))).otherwise(none),
        F.when(two_ok, F.array(F.concat_ws(" ", p0, last), F.concat_ws(" ", last, p0))).otherwise(none),
    ))


def joined_keys(keys) -> Column:
    """The keys that a name join needs. Both sides hold a key of two tokens in
    both orders or in none, so the order that sorts first finds the same pairs
    (and is the smaller match); other keys all stay."""
    def needed(k):
        a, b = F.substring_index(k, " ", 1), F.substring_index(k, " ", -1)
        return (F.concat(a, F.lit(" "), b) != k) | (a <= b)
    return F.filter(col_(keys), needed)


# ---------------------------------------------------------------- classifiers
def _alternation(tokens) -> str:
    import re
    return "(?:" + "|".join(re.escape(t) for t in tokens) + ")"


# ' tok ' or ' tok.' inside ' ' + upper(owner) + ' ', as one regex
_ENTITY_RE = " " + _alternation(K.ENTITY_TOKENS) + "[ .]"
_LANDLORD_RE = _alternation(K.LANDLORD_TOKENS)


def is_entity(c) -> Column:
    """Any entity token appears as ' tok ' or ' tok.' in ' ' + upper(owner) + ' '."""
    raw = F.coalesce(col_(c).cast("string"), F.lit(""))
    up = F.concat(F.lit(" "), F.upper(raw), F.lit(" "))
    return (raw != "") & up.rlike(_ENTITY_RE)


def is_landlord_entity(c) -> Column:
    """An entity whose name contains a landlord token as a plain substring."""
    up = F.upper(F.coalesce(col_(c).cast("string"), F.lit("")))
    return is_entity(c) & up.rlike(_LANDLORD_RE)


def with_owner_parsed(df, first: str, last: str, out: str):
    """Adds `out`: struct(first_name, middle_name, last_name, suffix, is_entity,
    full_name). Entities get empty parts. A trailing suffix of the first field
    is taken first; a suffix at the end of the last field is removed only when
    the first field gave none (it then stays, re-joined with single spaces).

    Staged projections: the cleaned fields and token arrays are columns first,
    so each stage stays small enough for generated code and no intermediate is
    re-evaluated."""
    t = f"_{out}_"
    none = F.array().cast("array<string>")
    sfx = _lit_array(K.NAME_SUFFIXES)
    df = df.withColumn(t + "ff", clean(first)).withColumn(t + "lf", clean(last))
    df = (df.withColumn(t + "full", F.regexp_replace(F.concat(F.col(t + "ff"), F.lit(" "), F.col(t + "lf")),
                                                     r"^\s+|\s+$", ""))
            .withColumn(t + "parts", F.when(F.col(t + "ff") == "", none).otherwise(F.split(t + "ff", r"\s+")))
            .withColumn(t + "ltoks", F.when(F.col(t + "lf") == "", none).otherwise(F.split(t + "lf", r"\s+"))))
    df = (df.withColumn(t + "ent", is_entity(t + "full"))
            .withColumn(t + "p", F.upper(F.regexp_replace(_at(F.col(t + "parts"), -1), r"\.+$", "")))
            .withColumn(t + "l", F.upper(F.regexp_replace(_at(F.col(t + "ltoks"), -1), r"\.+$", ""))))
    df = (df.withColumn(t + "h1", F.coalesce(F.array_contains(sfx, F.col(t + "p")), F.lit(False)))
            .withColumn(t + "h2", F.coalesce(F.array_contains(sfx, F.col(t + "l")), F.lit(False))))
    h1, h2, parts, ltoks = F.col(t + "h1"), F.col(t + "h2"), F.col(t + "parts"), F.col(t + "ltoks")
    rest = F.when(h1, F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    df = df.withColumn(t + "rest", rest)
    r = F.col(t + "rest")
    blank = F.lit("")
    ent = F.col(t + "ent")
    last_name = (F.when(h1 & h2, F.array_join(ltoks, " "))
                 .when(h2, F.array_join(F.slice(ltoks, 1, F.greatest(F.size(ltoks) - 1, F.lit(0))), " "))
                 .otherwise(F.col(t + "lf")))
    parsed = F.struct(
        F.when(ent, blank).otherwise(F.coalesce(_at(r, 1), blank)).alias("first_name"),
        F.when(ent | (F.size(r) <= 1), blank).otherwise(F.array_join(F.slice(r, 2, F.size(r)), " "))
        .alias("middle_name"),
        F.when(ent, blank).otherwise(last_name).alias("last_name"),
        F.when(ent, blank).when(h1, F.col(t + "p")).when(h2, F.col(t + "l")).otherwise(blank).alias("suffix"),
        ent.alias("is_entity"), F.col(t + "full").alias("full_name"))
    return df.withColumn(out, parsed).drop(*[c for c in df.columns if c.startswith(t)])


def exemption_flags(c) -> dict[str, Column]:
    ex = F.upper(clean(c))
    return {
        "is_homestead": ex.contains("HOMESTEAD"),
        "is_senior": ex.contains("ELDERLY") | ex.contains("ELDER ") | ex.contains("OVER 65"),
        "is_disabled_veteran": ex.contains("DISABLED VET") | ex.contains("VETERAN"),
        "is_disabled": ex.contains("DISABLED") & ~ex.contains("VET"),
    }


def notice_pattern(summary, case) -> Column:
    """Ordered classifier of a sale notice into 'tax', 'lien' or 'jfc'."""
    s = F.upper(F.coalesce(col_(summary).cast("string"), F.lit("")))
    k = F.upper(F.coalesce(col_(case).cast("string"), F.lit("")))
    county, plaintiff = K.COUNTY_PLAINTIFF
    versus = F.lit(False)
    for v in K.COUNTY_VERSUS:
        versus = versus | s.contains(v)
    hoa = F.lit(False)
    for h in K.HOA_PHRASES:
        hoa = hoa | s.contains(h)
    return (F.when(s.contains(K.TAX_PHRASE), "tax")
            .when(s.contains(county) & s.contains(plaintiff), "tax")
            .when(versus, "tax")
            .when(hoa, "lien")
            .when(k.contains("SP"), "jfc")
            .when(k.contains("CV"), "lien")
            .otherwise("jfc"))


def doctype_key(c) -> Column:
    return F.lower(clean(c))


def doctype_from_key(key) -> Column:
    """Code from a precomputed `doctype_key`: exact lookup; else the first code
    key (in table order) contained in it; else the key with spaces -> '_'."""
    key = col_(key)
    chain = None
    for k, v in K.DOCTYPE_CODES:
        chain = F.when(key.contains(k), v) if chain is None else chain.when(key.contains(k), v)
    chain = chain.otherwise(F.regexp_replace(key, " ", "_"))
    return F.coalesce(F.element_at(_lit_map(dict(K.DOCTYPE_CODES)), key), chain)


def canonical_doctype(c) -> Column:
    """Canonical instrument code of a free-text type (one expression).

    For large inputs prefer `with_doctype_code`, which computes the key once
    in its own projection instead of inside every CASE branch."""
    raw = F.coalesce(col_(c).cast("string"), F.lit(""))
    return F.when(raw == "", F.lit("")).otherwise(doctype_from_key(doctype_key(c)))


def with_doctype_code(df, src: str = "doc_type", out: str = "doc_type_code"):
    """Add the canonical code column: key projected once, then the lookup."""
    raw = F.coalesce(F.col(src).cast("string"), F.lit(""))
    return (df.withColumn("_dt_key", doctype_key(src))
              .withColumn(out, F.when(raw == "", F.lit("")).otherwise(doctype_from_key("_dt_key")))
              .drop("_dt_key"))


# ---------------------------------------------------------------- numbers, dates
def num(c) -> Column:
    """Number or numeric text -> double; anything else -> null (ANSI-safe)."""
    return F.expr(f"try_cast({_sql(c)} as double)") if isinstance(c, str) else c.try_cast("double")


def _sql(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def ms_to_ts(c) -> Column:
    """Epoch milliseconds (number or text) -> timestamp; only 0 < v < 2100-01-01."""
    v = col_(c).cast("string").try_cast("double")
    v = F.when(~F.isnan(v), v)
    ms = v.try_cast("bigint")
    return F.when((ms > 0) & (ms < F.lit(K.MAX_EPOCH_MS)), F.timestamp_millis(ms))


def parse_posted(c) -> Column:
    """Posted date text in one of four formats, first that parses wins."""
    s = clean(c)
    parsed = [F.try_to_timestamp(s, F.lit(fmt)) for fmt in K.POSTED_DATE_FORMATS]
    return F.when(s != "", F.coalesce(*parsed))


def days_between(later, earlier) -> Column:
    """Whole days of (later - earlier), floored like Python's timedelta.days."""
    secs = F.unix_seconds(later) - F.unix_seconds(earlier)
    return F.floor(secs / F.lit(86400)).cast("long")

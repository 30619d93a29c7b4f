"""DuckDB SQL for the correctness gate: the same rules written as plain SQL.

Every query is one WITH ... SELECT over the driver's pre-registered views.
The stand-in feed projections come from `standins` (shared expressions);
everything after them (normalization, linkage, fold, scores) is written
here independently in SQL. Regexes avoid look-around, so RE2 and Java agree.
"""

from __future__ import annotations

from .. import constants as K
from . import standins as S

D = "duckdb"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _sel(exprs: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in exprs.items())


# ------------------------------------------------------------------ SQL column rules
def clean(x: str) -> str:
    return f"regexp_replace(coalesce(cast({x} as varchar), ''), '^\\s+|\\s+$', '', 'g')"


def nonblank(x: str) -> str:
    return f"nullif({x}, '')"


def pid_digits(x: str) -> str:
    d = f"regexp_replace(coalesce(cast({x} as varchar), ''), '\\D', '', 'g')"
    return f"(CASE WHEN length({d}) BETWEEN 1 AND 8 THEN lpad({d}, 8, '0') ELSE {d} END)"


def pid_padded(x: str) -> str:
    c = clean(x)
    sign = f"regexp_extract({c}, '^[+-]')"
    return (f"(CASE WHEN length({c}) >= 8 THEN {c} "
            f"ELSE {sign} || lpad(substr({c}, length({sign}) + 1), 8 - length({sign})::INT, '0') END)")


_SUFFIX_ALT = "|".join(K.STREET_SUFFIX)
_SUFFIX_MAP = "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in K.STREET_SUFFIX.items()) + "}"


def street_steps(x: str, p: str) -> list[tuple[str, str]]:
    """(alias, expr) steps computing {p}num and {p}name from column x."""
    return [
        (f"{p}s1", f"regexp_replace(regexp_replace(regexp_replace(upper(coalesce({x}, '')), "
                   f"',\\s*\\w[\\w\\s]*,?\\s*NC[\\s,0-9-]*$', ''), '\\s+\\d{{5}}(-\\d{{4}})?$', ''), "
                   f"'\\s+(UNIT|APT|STE|SUITE|#)\\s*\\S+', '', 'g')"),
        (f"{p}num", f"regexp_extract({p}s1, '^\\s*(\\d+)', 1)"),
        (f"{p}t", f"trim(regexp_replace(regexp_replace(regexp_replace({p}s1, '^\\s*\\d+', ''), "
                  f"'[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"),
        (f"{p}sfx", f"regexp_extract(' ' || {p}t || ' ', '^(.*?) ({_SUFFIX_ALT}) ', 2)"),
        (f"{p}pre", f"trim(regexp_extract(' ' || {p}t || ' ', '^(.*?) ({_SUFFIX_ALT}) ', 1))"),
        (f"{p}name", f"CASE WHEN {p}num = '' THEN '' WHEN {p}sfx = '' THEN {p}t "
                     f"ELSE trim({p}pre || ' ' || {_SUFFIX_MAP}[{p}sfx]) END"),
    ]


def owner_parse_steps(first: str, last: str, p: str) -> list[tuple[str, str]]:
    """(alias, expr) steps of the owner-name parse: {p}first_name, {p}middle_name,
    {p}last_name, {p}suffix, {p}is_entity, {p}full_name."""
    sfx = _list(K.NAME_SUFFIXES)
    split = lambda x: f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"
    return [
        (f"{p}ff", clean(first)), (f"{p}lf", clean(last)),
        (f"{p}full_name", f"regexp_replace({p}ff || ' ' || {p}lf, '^\\s+|\\s+$', '', 'g')"),
        (f"{p}parts", split(f"{p}ff")), (f"{p}ltoks", split(f"{p}lf")),
        (f"{p}plast", f"upper(regexp_replace({p}parts[-1], '\\.+$', ''))"),
        (f"{p}llast", f"upper(regexp_replace({p}ltoks[-1], '\\.+$', ''))"),
        (f"{p}has1", f"(len({p}parts) > 0 AND coalesce(list_contains({sfx}, {p}plast), FALSE))"),
        (f"{p}has2", f"(len({p}ltoks) > 0 AND coalesce(list_contains({sfx}, {p}llast), FALSE))"),
        (f"{p}rest", f"CASE WHEN {p}has1 THEN {p}parts[1:len({p}parts) - 1] ELSE {p}parts END"),
        (f"{p}is_entity", is_entity(f"{p}full_name")),
        (f"{p}first_name", f"CASE WHEN {p}is_entity THEN '' ELSE coalesce({p}rest[1], '') END"),
        (f"{p}middle_name", f"CASE WHEN {p}is_entity OR len({p}rest) <= 1 THEN '' "
                            f"ELSE array_to_string({p}rest[2:], ' ') END"),
        (f"{p}last_name", f"CASE WHEN {p}is_entity THEN '' WHEN {p}has1 AND {p}has2 THEN array_to_string({p}ltoks, ' ') "
                          f"WHEN {p}has2 THEN array_to_string({p}ltoks[1:len({p}ltoks) - 1], ' ') ELSE {p}lf END"),
        (f"{p}suffix", f"CASE WHEN {p}is_entity THEN '' WHEN {p}has1 THEN {p}plast WHEN {p}has2 THEN {p}llast "
                       f"ELSE '' END"),
    ]


def norm_owner(x: str) -> str:
    toks = (f"string_split(regexp_replace(upper(coalesce({x}, '')), '[^A-Z0-9 ]', ' ', 'g'), ' ')")
    return (f"array_to_string(list_filter({toks}, lambda t: t <> '' AND NOT list_contains("
            f"{_list(K.NAME_NOISE)}, t)), ' ')")


def toks(norm: str) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda t: t <> '')"


def owner_keys(tk: str) -> str:
    """Index keys from a token list expression."""
    a, b, c = f"{tk}[1]", f"{tk}[2]", f"{tk}[3]"
    n = f"len({tk})"
    ab = f"({n} >= 2 AND length({a}) + length({b}) >= 8)"
    three = f"({n} >= 3)"
    ac = f"({three} AND length({a}) + length({c}) >= 8)"
    keys = [f"CASE WHEN {ab} THEN {a} || ' ' || {b} END", f"CASE WHEN {ab} THEN {b} || ' ' || {a} END",
            f"CASE WHEN {three} THEN {a} || ' ' || {b} || ' ' || {c} END",
            f"CASE WHEN {three} THEN {c} || ' ' || {b} || ' ' || {a} END",
            f"CASE WHEN {three} THEN {c} || ' ' || {a} || ' ' || {b} END",
            f"CASE WHEN {ac} THEN {a} || ' ' || {c} END", f"CASE WHEN {ac} THEN {c} || ' ' || {a} END"]
    return f"list_filter([{', '.join(keys)}], lambda k: k IS NOT NULL)"


def decedent_keys(tk: str) -> str:
    p0, p1, p2, last = f"{tk}[1]", f"{tk}[2]", f"{tk}[3]", f"{tk}[-1]"
    n = f"len({tk})"
    three = f"({n} >= 3)"
    two = f"({n} >= 2 AND length({last}) >= 5 AND NOT list_contains({_list(K.COMMON_SURNAMES)}, {last}))"
    keys = [f"CASE WHEN {three} THEN {p0} || ' ' || {p1} || ' ' || {p2} END",
            f"CASE WHEN {three} THEN {p2} || ' ' || {p1} || ' ' || {p0} END",
            f"CASE WHEN {three} THEN {last} || ' ' || {p0} || ' ' || {p1} END",
            f"CASE WHEN {two} THEN {p0} || ' ' || {last} END",
            f"CASE WHEN {two} THEN {last} || ' ' || {p0} END"]
    return f"list_filter([{', '.join(keys)}], lambda k: k IS NOT NULL)"


def is_entity(x: str) -> str:
    import re
    alt = "|".join(re.escape(t) for t in K.ENTITY_TOKENS)
    return (f"(coalesce({x}, '') <> '' AND regexp_matches(' ' || upper(coalesce({x}, '')) || ' ', "
            f"{_q(' (?:' + alt + ')[ .]')}))")


def is_landlord(x: str) -> str:
    import re
    alt = "|".join(re.escape(t) for t in K.LANDLORD_TOKENS)
    return f"({is_entity(x)} AND regexp_matches(upper(coalesce({x}, '')), {_q('(?:' + alt + ')')}))"


def notice_pattern(summary: str, case: str) -> str:
    s, k = f"upper(coalesce({summary}, ''))", f"upper(coalesce({case}, ''))"
    return (f"CASE WHEN contains({s}, 'TAX FORECLOSURE') THEN 'tax' "
            f"WHEN contains({s}, 'MECKLENBURG COUNTY') AND contains({s}, 'PLAINTIFF') THEN 'tax' "
            f"WHEN contains({s}, 'MECKLENBURG COUNTY V') OR contains({s}, 'MECKLENBURG COUNTY VS') THEN 'tax' "
            f"WHEN contains({s}, 'HOA') OR contains({s}, 'HOMEOWNERS ASSOC') "
            f"OR contains({s}, 'HOMEOWNER''S ASSOC') THEN 'lien' "
            f"WHEN contains({k}, 'SP') THEN 'jfc' WHEN contains({k}, 'CV') THEN 'lien' ELSE 'jfc' END")


def canonical_doctype(x: str) -> str:
    key = f"lower({clean(x)})"
    exact = " ".join(f"WHEN {key} = {_q(k)} THEN {_q(v)}" for k, v in K.DOCTYPE_CODES)
    contains = " ".join(f"WHEN contains({key}, {_q(k)}) THEN {_q(v)}" for k, v in K.DOCTYPE_CODES)
    return (f"(CASE WHEN coalesce({x}, '') = '' THEN '' {exact} {contains} "
            f"ELSE replace({key}, ' ', '_') END)")


def parse_posted(x: str) -> str:
    c = clean(x)
    return (f"(CASE WHEN {c} = '' THEN NULL ELSE coalesce(try_strptime({c}, '%Y-%m-%d'), "
            f"try_strptime({c}, '%b %d, %Y'), try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%B %d, %Y')) END)")


def days_between(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS BIGINT)"


def ms_to_ts(x: str) -> str:
    v = f"TRY_CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT)"
    return f"(CASE WHEN {v} > 0 AND {v} < {K.MAX_EPOCH_MS} THEN make_timestamp({v} * 1000) END)"


def recency(fields: dict[str, str]) -> str:
    parts = [nonblank(fields[f]) for f in K.RECENCY_FIELDS if f in fields]
    return f"coalesce({', '.join(parts + ["''"])})"


# ------------------------------------------------------------------ stand-in CTEs
def feed_ctes() -> str:
    """Stand-in feeds as CTEs: raw_parcels, tax, fc, est, cases, demos, instr."""
    pe, ta, tb = S.parcel_exprs(D), S.tax_a_exprs(D), S.tax_b_exprs(D)
    ins = S.instrument_exprs(D)
    return f"""
tot AS (SELECT o_custkey AS tk, sum(o_totalprice) AS tot_price FROM orders GROUP BY o_custkey),
raw_parcels AS (
  SELECT {_sel(pe)} FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN tot ON tk = o_custkey),
tax AS (
  SELECT *, {pid_digits('addressparcel_raw')} AS pid_normalized FROM (
    SELECT {_sel(ta)} FROM orders WHERE o_orderstatus <> 'P')
  UNION ALL BY NAME
  SELECT *, {pid_digits('addressparcel')} AS pid_normalized FROM (
    SELECT {_sel(tb)} FROM orders WHERE o_orderstatus = 'P')),
fc AS (SELECT {_sel(S.foreclosure_exprs(D))} FROM supplier),
est AS (SELECT {_sel(S.estate_exprs(D))} FROM orders JOIN customer ON o_custkey = c_custkey),
cases AS (SELECT {_sel(S.code_case_exprs(D))} FROM events),
demos AS (SELECT {_sel(S.code_demo_exprs(D))} FROM supplier),
instr AS (SELECT *, {canonical_doctype('doc_type')} AS doc_type_code, {pid_digits('pid_raw')} AS pid
          FROM (SELECT {_sel(ins)} FROM lineitem))"""


_PARCEL_TEXT = ["nc_pin", "address", "streetnumber", "streetname", "loccity", "ownrfrstnme", "ownrlstnme",
                "ownr2frstnme", "ownr2lstnme", "mailaddr1", "vacorimprov", "ownertyped", "exemption",
                "neighborhood", "neighbordesc", "taxmundist", "typeofdeed", "validsale", "deed_book", "deed_page"]


def parcel_ctes() -> str:
    """parcels: one cleaned row per pid (lowest object id), with keys and absentee."""
    s = (street_steps("address", "a_") + street_steps("mail_addr", "m_")
         + owner_parse_steps("owner1_first", "owner1_last", "o1_"))
    chain, prev = [], "p1"
    for i, (alias, expr) in enumerate(s):
        name = f"ps{i}"
        chain.append(f"{name} AS (SELECT *, {expr} AS {alias} FROM {prev})")
        prev = name
    own = "concat_ws(' ', nullif(owner1_first, ''), nullif(owner1_last, ''))"
    own2 = "concat_ws(' ', nullif(owner2_first, ''), nullif(owner2_last, ''))"
    return f"""
p0 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {clean('pid')} AS cpid, row_number() OVER (PARTITION BY {clean('pid')} ORDER BY objectid_1) AS rn
    FROM raw_parcels) WHERE rn = 1 AND cpid <> ''),
p1 AS (
  SELECT cpid AS pid, objectid_1, {clean('address')} AS address, {clean('mailaddr1')} AS mail_addr,
    {clean('mailaddr2')} AS mail_addr2, {clean('city')} AS mail_city, {clean('state')} AS mail_state,
    {clean('zipcode')} AS mail_zip,
    {clean('ownrfrstnme')} AS owner1_first, {clean('ownrlstnme')} AS owner1_last,
    {clean('ownr2frstnme')} AS owner2_first, {clean('ownr2lstnme')} AS owner2_last,
    {clean('vacorimprov')} AS vacant_or_improved, {clean('ownertyped')} AS owner_type,
    {clean('exemption')} AS exemption, {clean('neighborhood')} AS neighborhood,
    {clean('neighbordesc')} AS neighborhood_desc,
    TRY_CAST(yearbuilt AS DOUBLE) AS year_built, TRY_CAST(totmarkval AS DOUBLE) AS total_market_value,
    TRY_CAST(totalvalue AS DOUBLE) AS total_value, TRY_CAST(totlandval AS DOUBLE) AS land_value,
    TRY_CAST(saleprice AS DOUBLE) AS sale_price, saledate AS sale_date_raw,
    {ms_to_ts('saledate')} AS sale_ts
  FROM p0),
{', '.join(chain)},
parcels AS (
  SELECT *, {own} AS owner, {own2} AS owner2,
    (address <> '' AND mail_addr <> '' AND a_name <> m_name) AS absentee
  FROM {prev}),
addr_idx AS (SELECT pid, sale_ts, a_num AS addr_num, a_name AS addr_name FROM parcels
             WHERE a_num <> '' AND a_name <> ''),
key_idx AS (
  SELECT DISTINCT pid, sale_ts, name_key FROM (
    SELECT pid, sale_ts, unnest(list_concat({owner_keys(toks(norm_owner('owner')))},
                                            {owner_keys(toks(norm_owner('owner2')))})) AS name_key
    FROM parcels))"""


def _map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: CAST({v} AS VARCHAR)" for k, v in pairs.items()) + "}"


def evidence_ctes(county: str = K.DEFAULT_COUNTY) -> str:
    """ev: the long evidence table (pid, pattern, fires, flag, source, feed_rank,
    row_ord, rkey, detail, sale_ts)."""
    from ..operators.link import FEED_RANK as R
    cty = f"lower({clean('county')})"
    tax_d = {"source": "_source", "courtfile": "coalesce(nullif(courtfile, ''), ourfilenbr)",
             "saledate": "saledate", "status": "status", "openingbid": "openingbid", "tax_value": "tax_value",
             "name": "name", "address": "coalesce(nullif(address, ''), street)"}
    code_d = {"source": "'charlotte_hns'", "case": "CaseNumber", "type": "CaseType", "status": "CaseStatus",
              "address": "FullAddress", "created": "DateCreated", "closed": "DateClosed",
              "conclusion": "Conclusion"}
    demo_d = {"source": "'charlotte_demo'", "case": "CaseNumber", "status": "CaseStatus",
              "address": "FullAddress", "created": "DateCreated"}
    fc_d = {"source": "'mecktimes'", "case": "sp_case_number", "posted": "posted_date",
            "auction": "auction_date", "deed_book": "deed_book", "deed_page": "deed_page",
            "summary": "coalesce(summary, '')", "url": "detail_url"}
    es_d = {"source": "'mecktimes'", "decedent": "coalesce(decedent_name, '')", "posted": "posted_date",
            "case": "case_number", "url": "detail_url"}
    ins_parts = []
    for code in K.INSTRUMENT_ORDER:
        pattern, source, flag, label, fires = K.INSTRUMENT_RULES[code]
        if pattern is None:
            det = "MAP {}::MAP(VARCHAR, VARCHAR)"
            rk = "''"
        else:
            dd = {"source": _q(source),
                  "doc_type": f"coalesce(nullif(doc_type, ''), {_q(label)})",
                  "instrument_id": "instrument_id", "book": "book", "page": "page",
                  "recorded_date": "recorded_date", "grantor": "grantor", "grantee": "grantee"}
            if pattern == "lien":
                dd["amount"] = "amount"
            det, rk = _map(dd), recency(dd)
        pat = _q(pattern) if pattern else "NULL"
        fl = _q(flag) if flag else "NULL"
        src = _q(source) if source else "NULL"
        ins_parts.append(
            f"SELECT {pid_digits(clean('pid'))} AS pid, {pat}::VARCHAR AS pattern, {str(fires).upper()} AS fires, "
            f"{fl}::VARCHAR AS flag, {src}::VARCHAR AS source, {R['rod_' + code]} AS feed_rank, "
            f"_row AS row_ord, {rk} AS rkey, {det} AS detail FROM instr WHERE doc_type_code = {_q(code)}")
    ins_sql = "\n  UNION ALL ".join(ins_parts)
    return f"""
pid_cands AS (
  SELECT {clean('pid_normalized')} AS pid, 'tax' AS pattern, TRUE AS fires, NULL::VARCHAR AS flag,
    _source AS source, {R['tax']} AS feed_rank, _row AS row_ord, {recency(tax_d)} AS rkey, {_map(tax_d)} AS detail
  FROM tax WHERE {cty} IN ({_q(county)}, '')
  UNION ALL
  SELECT {pid_padded('ParcelId')}, 'code', TRUE,
    CASE WHEN CaseType IN ({', '.join(_q(t) for t in K.CODE_HIGH_SIGNAL_TYPES)}) THEN 'code_housing_case' END,
    'charlotte_hns', {R['code']}, _row, {recency(code_d)}, {_map(code_d)}
  FROM cases WHERE CaseStatus IN ({', '.join(_q(s) for s in K.CODE_OPEN_STATUSES)})
  UNION ALL
  SELECT {pid_padded('ParcelId')}, 'code', TRUE, 'demolition_order', 'charlotte_demo', {R['demo']}, _row,
    {recency(demo_d)}, {_map(demo_d)}
  FROM demos
  UNION ALL {ins_sql}),
ev_pid AS (SELECT c.*, p.sale_ts FROM pid_cands c JOIN parcels p USING (pid)),
fcn AS (
  SELECT * FROM (SELECT *, {notice_pattern('summary', 'sp_case_number')} AS npattern FROM fc
                 WHERE lower({clean('county')}) = {_q(county)})),
{', '.join(f"fcs{i} AS (SELECT *, {e} AS {a} FROM {'fcn' if i == 0 else f'fcs{i-1}'})"
           for i, (a, e) in enumerate(street_steps('address', 'f_')))},
ev_addr AS (
  SELECT i.pid, n.npattern AS pattern, TRUE AS fires, NULL::VARCHAR AS flag, 'mecktimes' AS source,
    {R['foreclosure']} AS feed_rank, n._row AS row_ord, {recency(fc_d)} AS rkey, {_map(fc_d)} AS detail,
    i.sale_ts
  FROM fcs{len(street_steps('address', 'f_')) - 1} n JOIN addr_idx i
    ON n.f_num = i.addr_num AND n.f_name = i.addr_name
  WHERE n.f_num <> '' AND n.f_name <> ''),
esn AS (
  SELECT *, {decedent_keys(toks(norm_owner('decedent_name')))} AS keys FROM est
  WHERE lower({clean('county')}) = {_q(county)}),
ev_name AS (
  SELECT pid, 'estate' AS pattern, TRUE AS fires, NULL::VARCHAR AS flag, 'mecktimes' AS source,
    {R['estate']} AS feed_rank, _row AS row_ord, {recency(es_d)} AS rkey, {_map(es_d)} AS detail, sale_ts
  FROM (SELECT DISTINCT n.detail_id, n._row, n.decedent_name, n.posted_date, n.case_number, n.detail_url,
                 i.pid, i.sale_ts FROM
          (SELECT detail_id, _row, decedent_name, posted_date, case_number, detail_url,
                  unnest(keys) AS name_key FROM esn) n
        JOIN key_idx i ON n.name_key = i.name_key)
  ),
ev AS (SELECT * FROM ev_pid UNION ALL BY NAME SELECT * FROM ev_addr UNION ALL BY NAME SELECT * FROM ev_name)"""


def lead_ctes(as_of: str) -> str:
    """folded -> scored leads with every score field."""
    now = f"TIMESTAMP '{as_of} 00:00:00'"
    posted = parse_posted("detail['posted']")
    value = ("(CASE WHEN total_market_value IS NOT NULL AND (total_market_value <> 0 OR isnan(total_market_value)) "
             "THEN total_market_value ELSE total_value END)")
    val0 = ("coalesce(CASE WHEN total_market_value <> 0 OR isnan(total_market_value) THEN total_market_value END, "
            "CASE WHEN total_value <> 0 OR isnan(total_value) THEN total_value END, 0.0)")
    pat_pts = " + ".join(f"(CASE WHEN list_contains(patterns, {_q(p)}) THEN {w} ELSE 0 END)"
                         for p, w in K.PATTERN_WEIGHTS.items())
    ex = "upper(exemption)"
    return f"""
folded AS (
  SELECT pid,
    list_sort(list_distinct(list(pattern) FILTER (WHERE fires AND pattern IS NOT NULL))) AS patterns0,
    count(flag) AS n_flags0,
    list_sort(list_distinct(list(flag) FILTER (WHERE flag IS NOT NULL))) AS flag_set0,
    coalesce(bool_or(pattern = 'estate' AND sale_ts IS NOT NULL AND {posted} IS NOT NULL
      AND {days_between('sale_ts', posted)} BETWEEN 0 AND {K.TRANSFER_ESTATE_DAYS}), FALSE) AS rule_b0,
    count(*) FILTER (WHERE source = 'charlotte_hns') AS n_open_cases
  FROM ev GROUP BY pid),
l0 AS (
  SELECT f.*, p.* EXCLUDE (pid),
    (p.sale_ts IS NOT NULL AND {days_between(now, 'p.sale_ts')} <= {K.TRANSFER_RECENT_DAYS}
      AND p.sale_price IS NOT NULL AND coalesce(p.sale_price < {K.TRANSFER_NOMINAL_PRICE}
      OR ({value} IS NOT NULL AND NOT isnan({value}) AND {value} > 0
          AND p.sale_price / {value} < {K.TRANSFER_VALUE_SHARE}), FALSE)) AS rule_a,
    (f.rule_b0 AND p.sale_ts IS NOT NULL) AS rule_b,
    (f.n_open_cases >= 2) AS repeat_v
  FROM folded f JOIN parcels p USING (pid)),
l1 AS (
  SELECT *,
    list_sort(list_distinct(list_concat(patterns0,
      CASE WHEN rule_a OR rule_b THEN ['transfer'] ELSE [] END))) AS patterns,
    n_flags0 + repeat_v::INT + rule_a::INT + rule_b::INT AS n_flags,
    list_distinct(list_concat(flag_set0, list_filter([
      CASE WHEN repeat_v THEN 'code_repeat_violator' END,
      CASE WHEN rule_a THEN 'nominal_consideration_recent_sale' END,
      CASE WHEN rule_b THEN 'post_estate_recent_sale' END], lambda x: x IS NOT NULL))) AS flag_set,
    (rule_a OR rule_b) AS transfer_fired
  FROM l0),
l2 AS (
  SELECT *, len(patterns) AS stack_count,
    CASE WHEN len(patterns) >= 3 THEN 'hot' WHEN len(patterns) = 2 THEN 'warm' ELSE 'active' END AS tier,
    CASE WHEN len(patterns) >= 3 THEN 3 WHEN len(patterns) = 2 THEN 2 ELSE 1 END AS tier_rank,
    ({val0} >= {K.HIGH_VALUE} AND NOT isnan({val0})) AS high_value,
    upper(vacant_or_improved) LIKE 'V%' AS vacant,
    (list_contains(patterns, 'estate') AND upper(owner_type) IN ({', '.join(_q(x) for x in K.HEIRS_OWNER_TYPES)})) AS heirs,
    {is_entity('owner')} AS is_entity,
    contains({ex}, 'HOMESTEAD') AS is_homestead,
    (contains({ex}, 'ELDERLY') OR contains({ex}, 'ELDER ') OR contains({ex}, 'OVER 65')) AS is_senior,
    (contains({ex}, 'DISABLED VET') OR contains({ex}, 'VETERAN')) AS is_disabled_veteran,
    (contains({ex}, 'DISABLED') AND NOT contains({ex}, 'VET')) AS is_disabled,
    CASE WHEN sale_price IS NOT NULL AND NOT isnan(sale_price) AND {value} IS NOT NULL AND NOT isnan({value})
      AND {value} > 0 AND sale_price > 0
      THEN printf('%.1f', greatest(0.0, least(100.0, (1.0 - sale_price / {value}) * 100.0)))::DOUBLE END AS estimated_equity_pct,
    CASE WHEN sale_ts IS NOT NULL THEN round({days_between(now, 'sale_ts')} / 365.25, 1) END AS years_owned,
    CASE WHEN land_value IS NOT NULL AND {value} IS NOT NULL AND NOT isnan({value}) AND {value} > 0
      THEN printf('%.1f', least(100.0, land_value / {value} * 100.0))::DOUBLE END AS lot_value_pct,
    CASE WHEN year_built IS NOT NULL AND (year_built <> 0 OR isnan(year_built))
      THEN year({now}) - TRY_CAST(trunc(year_built) AS INT) ELSE 0 END AS structure_age
  FROM l1),
scored AS (
  SELECT *,
    ({pat_pts} + CASE WHEN absentee THEN {K.ABSENTEE_POINTS} ELSE 0 END
      + CASE WHEN high_value THEN {K.VALUE_OVER_500K_POINTS} ELSE 0 END
      + CASE WHEN list_contains(flag_set, 'demolition_order') THEN {K.DEMOLITION_POINTS} ELSE 0 END
      + CASE WHEN vacant THEN {K.VACANT_POINTS} ELSE 0 END
      + CASE WHEN heirs THEN {K.HEIRS_POINTS} ELSE 0 END) AS raw_score,
    list_sort(list_distinct(list_concat(flag_set, list_filter([
      CASE WHEN absentee THEN 'absentee_owner' END, CASE WHEN high_value THEN 'value_over_500k' END,
      CASE WHEN vacant THEN 'vacant' END, CASE WHEN heirs THEN 'heirs_property_indicator' END],
      lambda x: x IS NOT NULL)))) AS flags,
    absentee AS is_absentee,
    ((absentee AND NOT {is_entity('owner')}) OR {is_landlord('owner')}) AS is_likely_landlord,
    (coalesce(years_owned, 0) >= 25 AND coalesce(structure_age, 0) >= 50 AND NOT is_entity
      AND NOT is_homestead) AS is_likely_inherited,
    (stack_count * {K.DISTRESS_PER_PATTERN} + least({K.DISTRESS_FLAG_CAP}, n_flags)
      + CASE WHEN absentee THEN {K.DISTRESS_ABSENTEE} ELSE 0 END
      + CASE WHEN is_senior THEN {K.DISTRESS_SENIOR} ELSE 0 END
      + CASE WHEN coalesce(estimated_equity_pct >= {K.DISTRESS_EQUITY_MIN}, FALSE) THEN {K.DISTRESS_EQUITY} ELSE 0 END
      + CASE WHEN coalesce(years_owned, 0) >= {K.DISTRESS_YEARS_MIN} THEN {K.DISTRESS_YEARS} ELSE 0 END)
      AS distress_score
  FROM l2),
leads AS (SELECT * FROM scored WHERE stack_count > 0)"""


def pipeline(as_of: str, select: str) -> str:
    return f"WITH {feed_ctes()},\n{parcel_ctes()},\n{evidence_ctes()},\n{lead_ctes(as_of)}\n{select}"


def metrics_ctes(county: str = K.DEFAULT_COUNTY) -> str:
    cty = f"lower({clean('county')})"
    rod = "\n  UNION ALL ".join(
        f"SELECT 'rod_{c}' AS feed, count(p.pid) AS attached, count(*) - count(p.pid) AS unmatched, "
        f"0 AS skipped_unsafe, 0 AS closed_skipped FROM instr i LEFT JOIN parcels p "
        f"ON {pid_digits(clean('i.pid'))} = p.pid WHERE i.doc_type_code = {_q(c)}"
        for c in K.INSTRUMENT_ORDER)
    last = len(street_steps('address', 'f_')) - 1
    return f"""
est_hits AS (
  SELECT _row, count(DISTINCT i.pid) AS n FROM
    (SELECT _row, unnest(keys) AS name_key FROM esn) n JOIN key_idx i USING (name_key) GROUP BY _row),
metrics AS (
  SELECT 'tax' AS feed, count(p.pid) AS attached, count(*) - count(p.pid) AS unmatched,
    0 AS skipped_unsafe, 0 AS closed_skipped
  FROM tax t LEFT JOIN parcels p ON {clean('t.pid_normalized')} = p.pid WHERE {cty.replace('county', 't.county')} IN ({_q(county)}, '')
  UNION ALL
  SELECT 'foreclosures', count(i.pid), count(*) FILTER (WHERE i.pid IS NULL), 0, 0
  FROM fcs{last} n LEFT JOIN addr_idx i ON n.f_num = i.addr_num AND n.f_name = i.addr_name
    AND n.f_num <> '' AND n.f_name <> ''
  UNION ALL
  SELECT 'estates', coalesce(sum(h.n) FILTER (WHERE len(e.keys) > 0), 0),
    count(*) FILTER (WHERE len(e.keys) > 0 AND h.n IS NULL), count(*) FILTER (WHERE len(e.keys) = 0), 0
  FROM esn e LEFT JOIN est_hits h USING (_row)
  UNION ALL
  SELECT 'code_cases', count(*) FILTER (WHERE p.pid IS NOT NULL AND c.CaseStatus IN
      ({', '.join(_q(s) for s in K.CODE_OPEN_STATUSES)})),
    count(*) FILTER (WHERE p.pid IS NULL), 0,
    count(*) FILTER (WHERE p.pid IS NOT NULL AND NOT coalesce(c.CaseStatus IN
      ({', '.join(_q(s) for s in K.CODE_OPEN_STATUSES)}), FALSE))
  FROM cases c LEFT JOIN parcels p ON {pid_padded('c.ParcelId')} = p.pid
  UNION ALL
  SELECT 'code_demos', count(p.pid), count(*) - count(p.pid), 0, 0
  FROM demos c LEFT JOIN parcels p ON {pid_padded('c.ParcelId')} = p.pid
  UNION ALL {rod})"""


def top_ctes() -> str:
    from ..operators.link import FEED_RANK as R
    return f"""
sigs AS (
  SELECT pid, pattern, source, feed_rank, row_ord, rkey, detail FROM ev WHERE pattern IS NOT NULL
  UNION ALL
  SELECT pid, 'transfer', 'polaris_sale', {R['transfer']}, 0, '', NULL FROM l1 WHERE transfer_fired),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid, pattern
                   ORDER BY rkey DESC, feed_rank, row_ord) AS rank FROM sigs) WHERE rank <= {K.SIGNAL_CAP_PER_PATTERN})"""


# One lead filter, used for both the counts and the rows (P10).
FILTER_SPEC = {"patterns": ["estate", "code"], "min_equity": 0.0, "max_equity": 100.0,
               "absentee": True, "text": "ward"}


# Each toggle of the interactive filters on its own (P10), payload text included.
TOGGLES = {
    "years_min": {"min_years": 5.0}, "years_max": {"max_years": 6.0}, "senior": {"senior": True}, "not_senior": {"senior": False},
    "entity": {"entity": True}, "demolition": {"demolition": True}, "no_demolition": {"demolition": False},
    "payload": {"text": "demo1", "search_signals": True},
}


# Searches answered from postings: two fields, payload, a short text, none found.
SEARCHES = {
    "place": {"text": "Ward 1"}, "payload": {"text": "demo1", "search_signals": True}, "number": {"text": "0000001"},
    "short": {"text": "10", "absentee": True}, "pattern": {"text": "ward", "patterns": ["estate", "code"]}, "none": {"text": "no such text"},
}


def filter_sql(spec=FILTER_SPEC) -> str:
    conds = []
    if spec.get("patterns"):
        conds.append(f"len(list_intersect(patterns, {_list(spec['patterns'])})) > 0")
    if "min_equity" in spec:
        conds.append(f"estimated_equity_pct >= {spec['min_equity']}")
    if "max_equity" in spec:
        conds.append(f"estimated_equity_pct <= {spec['max_equity']}")
    if "absentee" in spec:
        conds.append(f"is_absentee = {str(spec['absentee']).upper()}")
    for key, cond in (("min_years", "years_owned >= {}"), ("max_years", "years_owned <= {}")):
        if key in spec:
            conds.append(cond.format(spec[key]))
    for key, col in (("senior", "is_senior"), ("entity", "is_entity"), ("demolition", "list_contains(flags, 'demolition_order')")):
        if key in spec:
            conds.append(f"{col} = {str(spec[key]).upper()}")
    if spec.get("text"):
        t = spec["text"].lower()
        payload = (f" OR pid IN (SELECT pid FROM top WHERE contains(lower(CAST(detail AS VARCHAR)), {_q(t)}))"
                   if spec.get("search_signals") else "")
        conds.append(f"(contains(lower(address), {_q(t)}) OR contains(lower(owner), {_q(t)}) "
                     f"OR contains(lower(pid), {_q(t)}){payload})")
    return " AND ".join(f"coalesce({c}, FALSE)" for c in conds) or "TRUE"


AS_OF = "2001-08-02"
INGEST_LIMIT = 500  # O3
DRY_RUN_N = 100


def unescape_sql(x: str) -> str:
    """The entities present in the page table, `&amp;` last (single pass)."""
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "\u00b7"),
                 ("&copy;", "\u00a9"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]:
        x = f"replace({x}, {_q(a)}, {_q(b)})"
    return x


def page_sql() -> str:
    text = clean(unescape_sql("regexp_replace(regexp_replace(block, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')"))
    head = unescape_sql(clean("regexp_extract(block, '^([^<]*)', 1)"))
    return f"""
WITH parts AS (SELECT page_id, string_split(html, '<p><b>') AS ps FROM pages),
blocks AS (SELECT page_id, unnest(range(1, len(ps))) AS block_no,
                  regexp_replace(unnest(ps[2:]), '</article>.*$', '', 's') AS block FROM parts),
t AS (SELECT page_id, block_no, block, {text} AS txt FROM blocks)
SELECT page_id, CAST(block_no AS BIGINT) AS block_no, {head} AS heading, txt AS summary,
  CAST(length(txt) AS BIGINT) AS text_len, {notice_pattern('txt', "''")} AS pattern FROM t"""


def record_sql() -> str:
    """The 72 columns of the lead record, from the raw row of each lead."""
    from ..operators.parcels import NUM_COLS, TEXT_COLS
    pe = S.parcel_exprs(D)
    raw = [f"{clean(src) if src in pe else _q('')} AS {dst}" for dst, src in TEXT_COLS]
    raw += [f"{f'TRY_CAST({src} AS DOUBLE)' if src in pe else 'NULL::DOUBLE'} AS {dst}" for dst, src in NUM_COLS]
    name = lambda n: f"concat_ws(' ', nullif(r.owner{n}_first, ''), nullif(r.owner{n}_last, ''))"
    full = lambda n: f"regexp_replace(r.owner{n}_first || ' ' || r.owner{n}_last, '^\\s+|\\s+$', '', 'g')"
    own = ["nc_pin", "address", "street_num", "street_name", "mail_addr", "mail_addr2", "mail_city", "mail_state", "mail_zip",
           "year_built", "eff_year_built", "building_type", "land_use", "land_use_code", "grade", "story_height",
           "vacant_or_improved", "exterior_wall", "foundation", "roof_cover", "heat", "heat_fuel", "heated_area", "total_area",
           "bedrooms", "fullbath", "halfbath", "fireplaces", "residential_units", "gis_acres", "total_acres", "legal_acres",
           "total_market_value", "total_value", "land_value", "building_value", "sale_price", "deed_type", "valid_sale",
           "deed_book", "deed_page", "tax_district", "owner_type", "exemption"]
    derived = ["estimated_equity_pct", "years_owned", "is_absentee", "is_likely_landlord", "is_homestead", "is_senior",
               "is_disabled_veteran", "is_disabled", "is_likely_inherited", "lot_value_pct", "tier", "is_entity"]
    whole = ["distress_score", "stack_count", "raw_score", "tier_rank"]
    return f"""
rec AS (SELECT cpid, saledate AS sale_date_text, {', '.join(raw)} FROM p0),
sig AS (SELECT pid, string_agg(s, ',' ORDER BY s) AS signals FROM (
  SELECT pid, pattern || ':' || rank || ':' || coalesce(detail['source'], source, '') || ':' || coalesce(detail['case'], '') AS s
  FROM top) GROUP BY pid)
SELECT l.pid, CASE WHEN l.pid <> '' THEN {_q(K.PARCEL_URL_PREFIX)} || l.pid ELSE '' END AS polaris_url,
  r.loc_city AS city, {name(1)} AS owner, {name(2)} AS owner2, {full(1)} AS owner_parsed, {full(2)} AS owner2_parsed,
  {', '.join('r.' + c for c in own)},
  TRY_CAST(TRY_CAST(r.sale_date_text AS DOUBLE) AS BIGINT) AS sale_date,
  coalesce(nullif(r.neighborhood_desc, ''), nullif(r.neighborhood, ''), '') AS neighborhood,
  {', '.join('l.' + c for c in derived)}, {', '.join(f'CAST(l.{c} AS BIGINT) AS {c}' for c in whole)},
  array_to_string(l.patterns, ',') AS patterns, array_to_string(l.flags, ',') AS flags,
  coalesce(sig.signals, '') AS signals, l.is_absentee AS absentee
FROM leads l JOIN rec r ON r.cpid = l.pid LEFT JOIN sig ON sig.pid = l.pid"""


def query_sql() -> dict[str, str]:
    base = f"WITH {feed_ctes()},\n{parcel_ctes()},\n{evidence_ctes()},\n{lead_ctes(AS_OF)}"
    withm = base + "," + metrics_ctes()
    witht = base + "," + top_ctes()
    own = ("concat_ws(' ', nullif(owner1_first, ''), nullif(owner1_last, ''))")
    return {
        "stack_tier": base + """
SELECT pid, array_to_string(patterns, ',') AS patterns, CAST(stack_count AS BIGINT) AS stack_count, tier FROM leads""",
        "lead_scores": base + """
SELECT pid, CAST(raw_score AS BIGINT) AS raw_score, CAST(distress_score AS BIGINT) AS distress_score,
  array_to_string(flags, ',') AS flags, CAST(n_flags AS BIGINT) AS n_flags FROM leads""",
        "incremental_fold": base + """
SELECT pid, CAST(raw_score AS BIGINT) AS raw_score, CAST(distress_score AS BIGINT) AS distress_score,
  array_to_string(flags, ',') AS flags, CAST(n_flags AS BIGINT) AS n_flags FROM leads""",
        "derived_fields": base + """
SELECT pid, estimated_equity_pct, years_owned, is_absentee, is_entity, is_likely_landlord, is_homestead,
  is_senior, is_disabled_veteran, is_disabled, is_likely_inherited, lot_value_pct FROM leads""",
        "first_row_per_key": f"WITH {feed_ctes()},\n{parcel_ctes()}" + """
SELECT cpid AS pid, objectid_1, saleprice, saledate FROM p0""",
        "signal_join_pid": base + """
SELECT pid, pattern, flag, source, CAST(feed_rank AS BIGINT) AS feed_rank, row_ord, rkey FROM ev_pid""",
        "unmatched_by_feed": withm + """
SELECT feed, CAST(attached AS BIGINT) AS attached, CAST(unmatched AS BIGINT) AS unmatched,
  CAST(skipped_unsafe AS BIGINT) AS skipped_unsafe, CAST(closed_skipped AS BIGINT) AS closed_skipped FROM metrics""",
        "address_join": base + """
SELECT row_ord AS detail_id, pid, pattern FROM ev_addr""",
        "name_key_join": base + """
SELECT row_ord AS detail_id, pid FROM ev_name""",
        "notice_classify": f"WITH {feed_ctes()}" + f"""
SELECT detail_id, {notice_pattern('summary', 'sp_case_number')} AS pattern FROM fc""",
        "doctype_canonical": f"WITH {feed_ctes()}" + """
SELECT doc_type, doc_type_code, count(*) AS n FROM instr GROUP BY doc_type, doc_type_code""",
        "repeat_flag": base + """
SELECT pid, count(*) AS n_open FROM ev_pid WHERE source = 'charlotte_hns' GROUP BY pid HAVING count(*) >= 2""",
        "transfer_rules": base + """
SELECT pid, rule_a, rule_b, transfer_fired FROM l1""",
        "top_signals": witht + """
SELECT pid, pattern, CAST(rank AS BIGINT) AS rank, source, rkey, CAST(feed_rank AS BIGINT) AS feed_rank,
  CAST(row_ord AS BIGINT) AS row_ord FROM top""",
        "incremental_top": witht + """
SELECT pid, pattern, CAST(rank AS BIGINT) AS rank, source, rkey, CAST(feed_rank AS BIGINT) AS feed_rank,
  CAST(row_ord AS BIGINT) AS row_ord FROM top""",
        "rank_leads": base + """
SELECT row_number() OVER (ORDER BY tier_rank DESC, stack_count DESC, raw_score DESC, pid) AS position, pid, tier, CAST(tier_rank AS BIGINT) AS tier_rank, CAST(stack_count AS BIGINT) AS stack_count,
  CAST(raw_score AS BIGINT) AS raw_score FROM leads""",
        "lead_document": base + """
SELECT row_number() OVER (ORDER BY tier_rank DESC, stack_count DESC, raw_score DESC, pid) AS position, pid, tier, CAST(tier_rank AS BIGINT) AS tier_rank, CAST(stack_count AS BIGINT) AS stack_count,
  CAST(raw_score AS BIGINT) AS raw_score FROM leads""",
        "tier_summary": base + """
SELECT tier, count(*) AS n FROM leads GROUP BY tier""",
        "pattern_summary": base + """
SELECT pattern, count(*) AS n FROM (SELECT unnest(patterns) AS pattern FROM leads) GROUP BY pattern""",
        "high_confidence": base + """
SELECT count(*) FILTER (WHERE tier = 'warm' AND (list_contains(flags, 'demolition_order')
  OR list_contains(flags, 'code_housing_case') OR is_absentee)) AS high_confidence_warm, count(*) AS total FROM leads""",
        "filter_counts": base + f"""
SELECT tier, count(*) AS n FROM leads WHERE {filter_sql()} GROUP BY tier""",
        "lead_export": base + f"""
SELECT pid, o1_first_name AS owner_first, o1_middle_name AS owner_middle, o1_last_name AS owner_last,
  mail_addr, mail_addr2, mail_city, mail_state, mail_zip,
  '' AS phone1, '' AS phone2, '' AS phone3, '' AS email1, '' AS email2
FROM leads WHERE {filter_sql()}""",
        "owner_parse": f"WITH {feed_ctes()},\n{parcel_ctes()}" + """
SELECT pid, o1_first_name AS first_name, o1_middle_name AS middle_name, o1_last_name AS last_name,
  o1_suffix AS suffix, o1_is_entity AS is_entity, o1_full_name AS full_name FROM parcels""",
        "entity_flags": f"WITH {feed_ctes()},\n{parcel_ctes()}" + f"""
SELECT pid, owner, {is_entity('owner')} AS is_entity, {is_landlord('owner')} AS is_landlord FROM parcels""",
        "street_normalize": f"WITH {feed_ctes()},\n{parcel_ctes()}" + """
SELECT pid, a_num AS addr_num, a_name AS addr_name, m_name AS mail_name, absentee FROM parcels""",
        "dry_run": base + f"""
, sample AS (SELECT * FROM scored ORDER BY pid LIMIT {DRY_RUN_N})
SELECT 'tier' AS kind, tier AS key, count(*) AS n FROM sample GROUP BY tier
UNION ALL
SELECT 'pattern', pattern, count(*) FROM (SELECT unnest(patterns) AS pattern FROM sample) GROUP BY pattern""",
        "lead_record": witht + "," + record_sql(),
        "run_summary": base + """
SELECT 'tier_counts' AS kind, tier AS key, count(*) AS n FROM leads GROUP BY tier
UNION ALL SELECT 'pattern_counts', pattern, count(*) FROM (SELECT unnest(patterns) AS pattern FROM leads) GROUP BY pattern
UNION ALL SELECT 'total', 'total', count(*) FROM leads
UNION ALL SELECT 'total', 'high_confidence_warm', count(*) FILTER (WHERE tier = 'warm' AND (list_contains(flags, 'demolition_order')
  OR list_contains(flags, 'code_housing_case') OR is_absentee)) FROM leads""",
        "import_summary": f"WITH {feed_ctes()}" + """
SELECT CASE WHEN doc_type_code = '' THEN 'unknown' ELSE doc_type_code END AS doc_type_code, count(*) AS rows
FROM instr GROUP BY ALL""",
        "feed_scan": f"WITH {feed_ctes()}" + """
SELECT OBJECTID, ParcelId, CaseNumber, CaseStatus, DateCreated FROM cases""",
        "feature_scan": """
SELECT event_id AS OBJECTID, event_type AS CaseType, value, 'layer' AS _source FROM events""",
        "filter_toggles": witht + "\n" + "\nUNION ALL ".join(
            f"SELECT {_q(name)} AS toggle, tier, count(*) AS n FROM leads WHERE {filter_sql(spec)} GROUP BY tier"
            for name, spec in TOGGLES.items()),
        "search_postings": witht + "\n" + "\nUNION ALL ".join(
            f"SELECT {_q(name)} AS search, pid, tier FROM leads WHERE {filter_sql(spec)}" for name, spec in SEARCHES.items()),
        "page_extract": page_sql(),
        "page_files": page_sql(),
        "payload_files": """
SELECT event_id AS OBJECTID, event_type AS CaseType, value, 'layer' AS _source FROM events""",
        "notice_extract": """
SELECT s_suppkey AS detail_id,
  'https://mecktimes.com/public-notice/search-detail?indexgroup=real_estate&detail=' || s_suppkey AS detail_url,
  '2001-02-0' || (1 + s_suppkey % 9) AS posted_date, s_suppkey || ' O\u2019Hara St \u2013 Anytown, NC' AS address,
  'Mecklenburg' AS county, '2001-09-01' AS auction_date, '24SP' || printf('%06d', s_suppkey) AS sp_case_number,
  CAST(1 + s_suppkey % 900 AS VARCHAR) AS deed_book, CAST(1 + s_suppkey % 90 AS VARCHAR) AS deed_page,
  repeat('lorem ipsum ', 200) || 'CASE 24 SP ' || printf('%06d', s_suppkey) || ' of ' || s_name || ' recorded in Book '
    || (1 + s_suppkey % 900) || ' at Page ' || (1 + s_suppkey % 90)
    || CASE WHEN s_suppkey % 2 = 0 THEN ' \u2014 Tax foreclosure &amp; sale' ELSE ' under lien of Shoal HOA' END AS summary,
  CASE WHEN s_suppkey % 2 = 0 THEN 'tax' ELSE 'lien' END AS pattern FROM supplier""",
        "estate_extract": """
SELECT o_orderkey AS detail_id,
  'https://mecktimes.com/public-notice/search-detail?indexgroup=probate&detail=' || o_orderkey AS detail_url,
  '2001-03-01' AS posted_date, 'D\u2019Arcy, Ann ' || nm AS heading,
  CASE WHEN o_orderkey % 2 = 0 THEN 'JO ANN ' || nm ELSE 'ANN ' || nm || ' D\u2019ARCY' END AS decedent_name,
  'Union' AS county, '24E' || printf('%06d', o_custkey) AS case_number,
  repeat('lorem ipsum ', 200) || CASE WHEN o_orderkey % 2 = 0 THEN 'claims against Jo Ann ' || nm || ', deceased' ELSE 'no name given' END
    || ' 24 E ' || printf('%06d', o_custkey) AS summary, 'mecktimes_probate' AS _source
FROM (SELECT *, translate(printf('%06d', o_custkey), '0123456789', 'ABCDEFGHIJ') AS nm FROM orders)""",
        "listing_extract": """
SELECT 'rbcwb' AS _source, c_custkey || ' Elm & Oak' AS address, '24-' || c_custkey AS courtfile,
  CASE WHEN length(c_custkey::VARCHAR) < 8 THEN lpad(c_custkey::VARCHAR, 8, '0') ELSE c_custkey::VARCHAR END AS pid_normalized,
  'Mecklenburg' AS county, 'O\u2019' || c_name AS name, 'Open' AS status,
  NULL::VARCHAR AS street, NULL::VARCHAR AS tax_value, NULL::VARCHAR AS saletime FROM customer
UNION ALL
SELECT 'kania', '(parcel ' || c_custkey || ') ' || c_custkey || ' O\u2019Hara Ct | Anytown | ' || (c_custkey + 10000), '24CVD' || c_custkey,
  CASE WHEN length(c_custkey::VARCHAR) < 8 THEN lpad(c_custkey::VARCHAR, 8, '0') ELSE c_custkey::VARCHAR END, 'Mecklenburg',
  NULL, NULL, c_custkey || ' O\u2019Hara Ct', '$1,200.50', '10:00 AM' FROM customer""",
        "instrument_import": f"WITH {feed_ctes()}" + """
SELECT instrument_id, doc_type, CASE WHEN doc_type_code = '' THEN 'unknown' ELSE doc_type_code END AS doc_type_code,
  recorded_date, pid, amount, book, page, grantor, grantee, legal_description, CAST(1 AS BIGINT) AS n_extra,
  'line ' || CAST(_row AS VARCHAR) AS notes FROM instr""",
        "snapshot_overwrite": f"WITH {feed_ctes()}" + """
SELECT _source, courtfile, pid_normalized, county, saledate FROM tax""",
        "mixed_import": f"WITH {feed_ctes()}" + """
SELECT instrument_id, doc_type, CASE WHEN doc_type_code = '' THEN 'unknown' ELSE doc_type_code END AS doc_type_code,
  recorded_date, pid, amount, book, page, grantor, grantee, legal_description, CAST(1 AS BIGINT) AS n_extra,
  'line ' || CAST(_row AS VARCHAR) AS notes FROM instr""",
        "feed_rejects": f"WITH {feed_ctes()}" + """
SELECT '{"OBJECTID":' || CAST(OBJECTID AS VARCHAR) AS line FROM cases""",
        "feed_scan_counts": f"WITH {feed_ctes()}" + """
SELECT 'lenient' AS scan, count(*) AS n_rows, count(*) AS n_rejected FROM cases
UNION ALL SELECT 'strict', count(*), 0 FROM orders
UNION ALL SELECT 'missing', 0, 0""",
        "ingest_limit": f"WITH {feed_ctes()}" + f"""
SELECT least({INGEST_LIMIT}, count(*)) AS n FROM cases""",
        "incremental_highest": """
SELECT max(user_id) AS highest_id, count(DISTINCT user_id) AS n_held FROM events""",
        "cursor_refresh": """
SELECT event_id AS OBJECTID, CAST(user_id AS VARCHAR) AS ParcelId, event_type AS CaseStatus, value FROM events""",
        "incremental_dedup": """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    }

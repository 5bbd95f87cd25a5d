"""SQL text for the oracle: the normalisers, validators and scores written independently for DuckDB."""

from __future__ import annotations

from brightsieve.functions import vocab as V
from brightsieve.plans.leads import RAW

LEADS = RAW.format(customer="customer", nation="nation")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def inlist(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def case(x: str, table: dict) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


def title(x: str) -> str:
    return rf"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(substr({x}, i - 1, 1), '\p{{L}}') THEN lower(substr({x}, i, 1)) ELSE upper(substr({x}, i, 1)) END), '')"


def phone(x: str) -> str:
    d = digits(x)
    return f"CASE WHEN length({d}) = 11 AND starts_with({d}, '1') THEN '+' || {d} WHEN length({d}) = 10 THEN '+1' || {d} END"


def state(x: str) -> str:
    s = f"upper({strip(x)})"
    return f"CASE WHEN {x} = '' THEN NULL ELSE coalesce(CASE WHEN {s} IN {inlist(V.STATES)} THEN {s} END, {case(s, V.STATE_NAMES)}, {case(s, V.STATE_VARIATIONS)}) END"


def zip5(x: str) -> str:
    d = digits(x)
    return f"CASE length({d}) WHEN 9 THEN substr({d}, 1, 5) WHEN 5 THEN {d} WHEN 4 THEN '0' || {d} WHEN 3 THEN '00' || {d} END"


def capitalized(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


def name_title(x: str) -> str:
    def by(sep):
        return f"array_to_string(list_transform(string_split({x}, {q(sep)}), lambda w: {capitalized('w')}), {q(sep)})"

    return f"CASE WHEN contains({x}, '-') THEN {by('-')} WHEN contains({x}, '''') THEN {by(chr(39))} ELSE {capitalized(x)} END"


def age_bucket(x: str) -> str:
    s = f"lower({strip(x)})"
    span = r"'(\d+)\s*(?:-|to)\s*(\d+)'"
    lo, hi = (f"TRY_CAST(regexp_extract({s}, {span}, {k}) AS BIGINT)" for k in (1, 2))
    groups = rf"list_filter(list_transform(regexp_split_to_array({s}, '[,;/&]|\band\b'), lambda g: {case(strip('g'), V.AGE_GROUPS)}), lambda g: g IS NOT NULL)"
    ladder = f"CASE WHEN {lo} = 0 AND {hi} <= 1 THEN 'INFANT' WHEN {lo} <= 1 AND {hi} <= 3 THEN 'INFANT_TODDLER' WHEN {lo} = 0 AND {hi} <= 5 THEN 'BIRTH_TO_5' WHEN {lo} = 0 AND {hi} <= 12 THEN 'BIRTH_TO_12' WHEN {lo} >= 1 AND {hi} <= 3 THEN 'TODDLER' WHEN {lo} >= 3 AND {hi} <= 5 THEN 'PRESCHOOL' WHEN {lo} >= 5 AND {hi} <= 12 THEN 'SCHOOL_AGE' ELSE 'MIXED_AGES' END"
    several = f"CASE WHEN len(list_distinct({groups})) > 2 THEN 'MIXED_AGES' WHEN list_contains({groups}, 'INFANT') AND list_contains({groups}, 'TODDLER') THEN 'INFANT_TODDLER' ELSE {groups}[1] END"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE coalesce({case(s, V.AGE_GROUPS)}, CASE WHEN regexp_matches({s}, {span}) THEN {ladder} END, {several}, 'UNKNOWN') END"


def age_years(x: str) -> str:
    s = f"lower({x})"
    n = rf"TRY_CAST(regexp_extract({s}, '(\d+(?:\.\d+)?)', 1) AS DOUBLE)"
    return f"CAST(round_even(CASE WHEN contains({s}, 'week') THEN {n} / 52 WHEN contains({s}, 'month') THEN {n} / 12 ELSE {n} END, 0) AS INTEGER)"


def capacity(x: str) -> str:
    s = strip(x)
    told = rf"regexp_extract({s}, '(?i)(\d+)\s*(?:children|kids|child|spaces|capacity|enrollment)', 1)"
    return rf"CASE WHEN lower({s}) IN {inlist(V.NO_CAPACITY)} THEN NULL ELSE TRY_CAST(coalesce(nullif({told}, ''), regexp_extract({s}, '(\d+)', 1)) AS INTEGER) END"


def license_status(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'UNKNOWN' ELSE coalesce({case(s, V.LICENSE_STATUS)}, CASE WHEN upper({s}) IN {inlist(V.LICENSE_STATUSES)} THEN upper({s}) END, 'UNKNOWN') END"


def before_hyphen(x: str, table: dict, known: list[str]) -> str:
    s = f"lower({strip(f'string_split({x}, {q(chr(45))})[1]')})"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'UNKNOWN' ELSE coalesce({case(s, table)}, CASE WHEN upper({s}) IN {inlist(known)} THEN upper({s}) END, 'OTHER') END"


def address(x: str) -> str:
    s = f"' ' || upper({strip(x)}) || ' '"
    for short, full in V.STREET_TYPES.items():
        s = f"replace({s}, {q(short)}, {q(full)})"
    return rf"regexp_replace({strip(s)}, '\s+', ' ', 'g')"


EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"


def email(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN regexp_matches({s}, {EMAIL}) THEN {s} END"


def website(x: str) -> str:
    s = f"string_split(string_split(rtrim(regexp_replace(regexp_replace(lower({strip(x)}), '^https?://', ''), '^www\\.', ''), '/'), '?')[1], '#')[1]"
    return f"CASE WHEN regexp_matches({s}, '^[a-z0-9.-]+\\.[a-z]{{2,}}$') THEN 'https://' || {s} END"


def boolean(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN {s} IN {inlist(V.TRUE_WORDS)} THEN 'true' WHEN {s} IN {inlist(V.FALSE_WORDS)} THEN 'false' END"


def valid_phone(x: str) -> str:
    d = digits(x)
    return f"CASE WHEN length({d}) = 11 AND starts_with({d}, '1') THEN substr({d}, 2) WHEN length({d}) = 10 THEN {d} END"


def valid_zip(x: str) -> str:
    s = f"regexp_replace({x}, '[^0-9-]', '', 'g')"
    return rf"CASE WHEN regexp_matches({s}, '^\d{{5}}(-\d{{4}})?$') THEN substr({s}, 1, 5) WHEN regexp_matches({s}, '^\d{{4}}$') THEN '0' || {s} END"


def valid_state(x: str) -> str:
    s = f"upper({strip(x)})"
    return f"coalesce(CASE WHEN {s} IN {inlist(V.STATES)} THEN {s} END, {case(s, V.VALIDATOR_STATES)})"


#: The canonical leads.
CANONICAL = f"""
SELECT row_ix, company, {phone('raw_phone')} AS phone, lower(trim(raw_email)) AS email, {title('adr')} AS address1, nation AS city, raw_state AS state, raw_zip AS zip,
  {capacity('raw_capacity')} AS capacity, {age_bucket('raw_ages')} AS ages_served, {age_years('raw_ages')} AS min_age,
  CASE WHEN row_ix % 2 = 0 THEN {age_years('raw_ages')} END AS max_age,
  CASE WHEN row_ix % 3 > 0 THEN 'L' || CAST(row_ix AS VARCHAR) END AS license_number,
  CASE WHEN row_ix % 4 > 0 THEN {license_status('raw_status')} END AS license_status,
  CASE WHEN raw_name IS NOT NULL THEN {name_title('fn')} END AS first_name, {name_title('ln')} AS last_name, segment AS source_file
FROM (SELECT *, {address('raw_address')} AS adr, regexp_extract({strip('raw_name')}, '^([A-Za-z''\\-]+)', 1) AS fn,
  nullif(regexp_extract({strip('raw_name')}, '^[A-Za-z''\\-]+\\s+([A-Za-z''\\-]+)', 1), '') AS ln FROM ({LEADS}))
"""

_OK = {
    "phone": f"({valid_phone('phone')}) IS NOT NULL", "email": f"(length(email) <= 254 AND regexp_matches({strip('email')}, {EMAIL}))",
    "state": f"({valid_state('state')}) IS NOT NULL", "zip": f"({valid_zip('zip')}) IS NOT NULL",
}
_PLACES = "((address1 IS NOT NULL)::INT + (city IS NOT NULL)::INT + (state IS NOT NULL)::INT + (zip IS NOT NULL)::INT)"
_GENERIC = inlist(V.GENERIC_COMPANIES)

#: Points and flags of each check over the canonical leads.
POINTS = {
    "company": f"CASE WHEN company IS NULL THEN 0 WHEN length(trim(company)) < 2 OR lower(trim(company)) IN {_GENERIC} THEN 5 ELSE 15 END",
    "phone": f"CASE WHEN phone IS NULL THEN 0 WHEN {_OK['phone']} THEN 15 ELSE 5 END",
    "email": f"CASE WHEN email IS NOT NULL AND {_OK['email']} THEN 10 ELSE 0 END",
    "address": f"CASE WHEN {_PLACES} = 4 THEN CASE WHEN {_OK['state']} AND {_OK['zip']} THEN 15 ELSE 10 END WHEN {_PLACES} >= 2 THEN 8 WHEN {_PLACES} = 1 THEN 5 ELSE 0 END",
    "capacity": "CASE WHEN capacity IS NULL OR capacity <= 0 THEN 0 WHEN capacity > 1000 THEN 5 ELSE 10 END",
    "license": "5 * ((license_number IS NOT NULL)::INT + (license_status IS NOT NULL)::INT)",
    "contact_name": "5 * ((first_name IS NOT NULL)::INT + (last_name IS NOT NULL)::INT)",
    "ages": "CASE WHEN min_age IS NOT NULL AND max_age IS NOT NULL THEN 10 WHEN ages_served IS NOT NULL THEN 5 ELSE 0 END",
    "duplicate": "5",
}
FLAGS = [
    ("company IS NULL", "missing_company"), ("length(trim(company)) < 2", "company_too_short"), (f"length(trim(company)) >= 2 AND lower(trim(company)) IN {_GENERIC}", "company_generic_value"),
    ("phone IS NULL", "missing_phone"), (f"phone IS NOT NULL AND NOT {_OK['phone']}", "invalid_phone_format"),
    ("email IS NULL", "missing_email"), (f"email IS NOT NULL AND NOT {_OK['email']}", "invalid_email_format"),
    (f"{_PLACES} = 4 AND NOT {_OK['state']}", "invalid_state"), (f"{_PLACES} = 4 AND NOT {_OK['zip']}", "invalid_zip"), (f"{_PLACES} BETWEEN 1 AND 3", "incomplete_address"), (f"{_PLACES} = 0", "missing_address"),
    ("capacity IS NULL", "missing_capacity"), ("capacity <= 0", "invalid_capacity"), ("capacity > 1000", "capacity_unusually_high"),
    ("license_number IS NOT NULL AND license_status IS NULL", "missing_license_status"), ("license_number IS NULL AND license_status IS NOT NULL", "missing_license_number"), ("license_number IS NULL AND license_status IS NULL", "missing_license_info"),
    ("(first_name IS NULL) <> (last_name IS NULL)", "partial_contact_name"), ("first_name IS NULL AND last_name IS NULL", "missing_contact_name"),
    ("(min_age IS NULL OR max_age IS NULL) AND ages_served IS NOT NULL", "ages_served_only"), ("(min_age IS NULL OR max_age IS NULL) AND ages_served IS NULL", "missing_age_info"),
]
_FLAG_LIST = "list_filter([" + ", ".join(f"CASE WHEN {w} THEN {q(n)} END" for w, n in FLAGS) + "], lambda f: f IS NOT NULL)"
SCORED = f"SELECT *, CAST({' + '.join(f'({p})' for p in POINTS.values())} AS INTEGER) AS score, {_FLAG_LIST} AS flags FROM ({CANONICAL})"

#: Leaders by the sequential definition, as rounds of a recursive query over (phone, email).
DEDUP = f"""
WITH RECURSIVE l AS MATERIALIZED (SELECT row_ix AS ix, nullif(lower(trim(phone)), '') AS p, nullif(lower(trim(email)), '') AS e FROM ({CANONICAL})),
walk(ix, ps, es, led) AS (
  SELECT CAST(-1 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), FALSE
  UNION ALL
  SELECT r.ix, CASE WHEN r.lead AND r.p IS NOT NULL THEN list_append(ps, r.p) ELSE ps END, CASE WHEN r.lead AND r.e IS NOT NULL THEN list_append(es, r.e) ELSE es END, r.lead
  FROM (SELECT l.ix, l.p, l.e, w.ps, w.es, NOT (l.p IS NOT NULL AND list_contains(w.ps, l.p)) AND NOT (l.e IS NOT NULL AND list_contains(w.es, l.e)) AS lead
        FROM walk w JOIN l ON l.ix = w.ix + 1) r),
lead AS (SELECT l.*, row_number() OVER (ORDER BY l.ix) AS number FROM l JOIN walk w ON w.ix = l.ix AND w.led)
SELECT l.ix AS row_ix, o.number IS NULL AS is_duplicate,
  'cluster_' || lpad(CAST(coalesce(o.number, CASE WHEN b.ix < l.ix THEN b.number END, a.number) AS VARCHAR), 6, '0') AS duplicate_cluster_id
FROM l LEFT JOIN lead o ON o.ix = l.ix LEFT JOIN lead a ON a.p = l.p LEFT JOIN lead b ON b.e = l.e
"""

#: D3: names and addresses within the edits that their ratio allows, then the longest common subsequence by bits of a 128-bit number.
FUZZY = """
WITH t AS MATERIALIZED (SELECT p_partkey AS ix, lower(trim(concat_ws(' ', p_name, CAST(p_size AS VARCHAR)))) AS c, lower(trim(concat_ws(' ', p_brand, p_type))) AS a FROM part),
near AS (SELECT x.s AS s1, y.s AS s2, field FROM (SELECT DISTINCT c AS s, 'c' AS field, 0.85 AS least FROM t UNION ALL SELECT DISTINCT a, 'a', 0.90 FROM t) x
  JOIN (SELECT DISTINCT c AS s, 'c' AS field FROM t UNION ALL SELECT DISTINCT a, 'a' FROM t) y USING (field)
  WHERE x.s <> '' AND x.s < y.s AND levenshtein(x.s, y.s) <= (1 - least) * (length(x.s) + length(y.s)) + 1e-9),
bits AS (SELECT field, s1, s2, (CAST(1 AS HUGEINT) << length(s1)) - 1 AS full_,
  list_transform(string_split(s2, ''), lambda ch: list_sum(list_transform(range(length(s1)), lambda i: CASE WHEN s1[CAST(i AS INTEGER) + 1] = ch THEN CAST(1 AS HUGEINT) << CAST(i AS INTEGER) ELSE CAST(0 AS HUGEINT) END))) AS masks FROM near),
lcs AS (SELECT field, s1, s2, length(s1) - bit_count(list_reduce(list_prepend(full_, list_transform(masks, lambda m: CAST(m AS HUGEINT))), lambda v, m: ((v + (v & m)) | (v - (v & m))) & full_)) AS n FROM bits),
alike AS (SELECT field, s1, s2, 2.0 * n / (length(s1) + length(s2)) AS r FROM lcs),
every AS (SELECT field, s1, s2, CAST(r AS DOUBLE) AS r FROM alike UNION ALL SELECT field, s2, s1, CAST(r AS DOUBLE) FROM alike
  UNION ALL SELECT DISTINCT 'c', c, c, CAST(1 AS DOUBLE) FROM t WHERE c <> '' UNION ALL SELECT DISTINCT 'a', a, a, CAST(1 AS DOUBLE) FROM t WHERE a <> ''),
met AS (SELECT x.ix AS ix1, y.ix AS ix2, e.r AS s, x.a AS a1, y.a AS a2 FROM t x JOIN every e ON e.field = 'c' AND e.s1 = x.c AND e.r >= CAST(0.85 AS DOUBLE) JOIN t y ON y.c = e.s2 AND x.ix < y.ix)
SELECT ix1, ix2, CASE WHEN f.r >= CAST(0.9 AS DOUBLE) THEN (s + f.r) / 2 ELSE s END AS score
FROM met LEFT JOIN every f ON f.field = 'a' AND f.s1 = a1 AND f.s2 = a2 WHERE f.r >= CAST(0.9 AS DOUBLE) OR s >= CAST(0.95 AS DOUBLE)
"""

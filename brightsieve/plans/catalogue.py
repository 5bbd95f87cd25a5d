"""The registered queries of the lead engine and the SQL that each is held against."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.functions import normalize as N
from brightsieve.functions import validate as Va
from brightsieve.functions.vocab import TARGETS
from brightsieve.operators import classify, dedup, intervals, profile, quality, rules
from brightsieve.plans import leads, mapping, oracle as o, relational
from brightsieve.plans.pipeline import union_all
from brightsieve.session import table
from brightsieve.sources import files, store
from brightsieve.storage import new_path

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# --- normalisers and validators over the raw leads ---


def _over_raw(name: str, column: str, function, sql: str) -> None:
    @query(name, f"SELECT row_ix, {sql} AS value FROM ({o.LEADS})")
    def run(spark, sf_dir):
        return leads.raw(spark, sf_dir).select("row_ix", function(F.col(column)).alias("value"))


_over_raw("n01_phone_e164", "raw_phone", N.phone, o.phone("raw_phone"))
_over_raw("n02_state_usps", "raw_state", N.state, o.state("raw_state"))
_over_raw("n03_zip5", "raw_zip", N.zip5, o.zip5("raw_zip"))
_over_raw("n07_age_bucket", "raw_ages", N.age_bucket, o.age_bucket("raw_ages"))
_over_raw("n08_age_years", "raw_ages", N.age_years, o.age_years("raw_ages"))
_over_raw("n09_capacity", "raw_capacity", N.capacity, o.capacity("raw_capacity"))
_over_raw("n10_license_status", "raw_status", N.license_status, o.license_status("raw_status"))
_over_raw("n11_license_type", "raw_type", N.license_type, o.before_hyphen("raw_type", o.V.LICENSE_TYPE, o.V.LICENSE_TYPES))
_over_raw("n12_facility_type", "raw_type", N.facility_type, o.before_hyphen("raw_type", o.V.FACILITY_TYPE, o.V.FACILITY_TYPES))
_over_raw("n13_email", "raw_email", N.email, o.email("raw_email"))
_over_raw("n16_boolean", "raw_flag", N.boolean, o.boolean("raw_flag"))
_over_raw("v01_email", "raw_email", lambda c: Va.email(c)["value"], f"CASE WHEN length({o.strip('raw_email')}) <= 254 THEN {o.email('raw_email')} END")
_over_raw("v02_phone", "raw_phone", lambda c: Va.phone(c)["formatted"], f"regexp_replace({o.valid_phone('raw_phone')}, '^(...)(...)(....)$', '(\\1) \\2-\\3')")
_over_raw("v03_zip", "raw_zip", lambda c: Va.zip_code(c)["value"], o.valid_zip("raw_zip"))
_over_raw("v04_state", "raw_state", lambda c: Va.state(c)["value"], o.valid_state("raw_state"))


@query("n04_address_title", f"SELECT row_ix, {o.title('adr')} AS value FROM (SELECT row_ix, {o.address('raw_address')} AS adr FROM ({o.LEADS}))")
def n04(spark, sf_dir):
    return leads.raw(spark, sf_dir).select("row_ix", N.address(F.col("raw_address")).alias("value"))


@query("n05_name_parts", f"SELECT row_ix, first_name, last_name FROM ({o.CANONICAL})")
def n05(spark, sf_dir):
    return leads.raw(spark, sf_dir).select("row_ix", N.name(F.col("raw_name")).alias("n")).select("row_ix", "n.first_name", "n.last_name")


@query("n06_name_title", f"SELECT c_custkey, {o.name_title('x')} AS value FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) || '-o''neil' WHEN 1 THEN 'o''' || c_mktsegment ELSE c_mktsegment END AS x FROM customer)")
def n06(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    x = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lower("c_mktsegment"), F.lit("-o'neil"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("o'"), "c_mktsegment")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", N.name_title(x).alias("value"))


@query("n14_website", f"SELECT page_id AS id, {o.website('url')} AS value FROM pages UNION ALL SELECT row_ix, {o.website('raw_site')} FROM ({o.LEADS})")
def n14(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), N.website(F.col("url")).alias("value"))
    return pages.union(leads.raw(spark, sf_dir).select("row_ix", N.website(F.col("raw_site"))))


@query("n15_county", f"SELECT row_ix, CASE WHEN raw_county <> '' THEN {o.title('x')} || ' County' END AS value FROM (SELECT row_ix, raw_county, regexp_replace({o.strip('raw_county')}, '(?i)\\s+county$', '') AS x FROM ({o.LEADS}))")
def n15(spark, sf_dir):
    return leads.raw(spark, sf_dir).select("row_ix", N.county(F.col("raw_county")).alias("value"))


# --- rules ---


def _ruled(spark, sf_dir, name: str, key: str, transformations: dict, mappings: dict | None = None, **options) -> DataFrame:
    df = table(spark, sf_dir, name)
    schema = rules.Schema(mappings or {}, transformations)
    return df.select(key, rules.compile_target("company", schema, df.columns, **options).alias("value"))


def _rule(name: str, source: str, key: str, transformations: dict, sql: str, mappings: dict | None = None, **options) -> None:
    @query(name, f"SELECT {key}, {sql} AS value FROM {source}")
    def run(spark, sf_dir):
        return _ruled(spark, sf_dir, source, key, transformations, mappings, **options)


_PRIORITY = {"target_column": "company", "source_column": "o_orderpriority"}
_rule("r01_regex", "orders", "o_orderkey", {"a": _PRIORITY | {"regex": r"^\d-(?P<word>[A-Z]+)$"}}, "regexp_extract(o_orderpriority, '^\\d-([A-Z]+)$', 1)")
_rule("r02_regex_format", "orders", "o_orderkey", {"a": _PRIORITY | {"regex": r"^(\d)-(\w+)", "format": r"\g<2> (\1)"}}, "regexp_replace(o_orderpriority, '^(\\d)-(\\w+).*$', '\\2 (\\1)')")
_rule("r03_condition", "orders", "o_orderkey", {"a": _PRIORITY | {"condition": "urgent|high"}}, "CASE WHEN regexp_matches(o_orderpriority, '(?i)urgent|high') THEN o_orderpriority END")
_rule("r04_condition_value", "orders", "o_orderkey", {"a": _PRIORITY | {"condition": "low", "value": "later"}}, "CASE WHEN regexp_matches(o_orderpriority, '(?i)low') THEN 'later' END")
_rule("r05_mapping", "part", "p_partkey", {"a": {"target_column": "company", "source_column": "P_BRAND", "mapping": {"brand#1": "one", " BRAND#2 ": 2, "Brand#1": "uno"}}}, "CASE lower(p_brand) WHEN 'brand#1' THEN 'uno' WHEN 'brand#2' THEN '2' END")
_rule("r06_value", "part", "p_partkey", {"a": {"target_column": "company", "source_column": "p_name", "value": 7}}, "'7'")
_rule(
    "r07_combined", "events", "event_id",
    {"a": {"target_column": "company", "source_column": "props", "regex": r'"k":\s*(\d+)', "condition": r"^\d$", "mapping": {"1": "one", "2": "two", "3": "three"}}},
    "CASE regexp_extract(props, '\"k\":\\s*(\\d+)', 1) WHEN '1' THEN 'one' WHEN '2' THEN 'two' WHEN '3' THEN 'three' END",
)
_OVERLAY = {"a": _PRIORITY | {"regex": "[A-Z]{4,}"}, "b": _PRIORITY | {"condition": "^1", "value": "first"}}
_rule("r08_overlay_last_wins", "orders", "o_orderkey", _OVERLAY, "CASE WHEN starts_with(o_orderpriority, '1') THEN 'first' ELSE regexp_extract(o_orderpriority, '[A-Z]{4,}') END", {"company": "o_orderpriority"})
_rule("r08_overlay_first_wins", "orders", "o_orderkey", _OVERLAY, "coalesce(nullif(regexp_extract(o_orderpriority, '[A-Z]{4,}'), ''), CASE WHEN starts_with(o_orderpriority, '1') THEN 'first' END, o_orderpriority)", {"company": "o_orderpriority"}, overlay="first_wins")


@query("r09_default_rules", "SELECT o_orderkey, CASE WHEN starts_with(o_orderpriority, '1') THEN 'own' ELSE regexp_extract(o_orderpriority, '[A-Z]{4,}') END AS value FROM orders")
def r09(spark, sf_dir):
    """Of two rules called b the schema's counts; the default rule a stays."""
    orders = table(spark, sf_dir, "orders")
    own = rules.Schema({"company": "o_orderpriority"}, {"b": _PRIORITY | {"condition": "^1", "value": "own"}})
    defaults = rules.Schema({"company": ""}, {"a": _PRIORITY | {"regex": "[A-Z]{4,}"}, "b": _PRIORITY | {"condition": "^2", "value": "default"}})
    return orders.select("o_orderkey", rules.compile_target("company", rules.overlaid(own, defaults), orders.columns).alias("value"))


@query("p01_canonical_projection", f"SELECT row_ix, company, CASE WHEN raw_name IS NOT NULL THEN {o.name_title('fn')} END AS first_name, {o.age_years('raw_ages')} AS min_age, CASE WHEN raw_type <> '' THEN {o.before_hyphen('raw_type', o.V.FACILITY_TYPE, o.V.FACILITY_TYPES)} END AS facility_type, CAST(NULL AS VARCHAR) AS county FROM (SELECT *, regexp_extract({o.strip('raw_name')}, '^([A-Za-z''\\-]+)', 1) AS fn FROM ({o.LEADS}))")
def p01(spark, sf_dir):
    schema = rules.Schema({"company": "COMPANY", "first_name": "raw_name", "min_age": "raw_ages", "facility_type": "raw_type"})
    return rules.transform(leads.raw(spark, sf_dir), schema, ["company", "first_name", "min_age", "facility_type", "county"], keep=("row_ix",))


_HEADERS = [" Facility Kind", "Organization", "E-Mail", "Town", "Max", "Permit", "Status", "Website URL"]


_TABLE_HEADERS = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "labels": ["doc_id", "quality", "toxic"], "leads": _HEADERS}


@query("p03_fingerprint", " UNION ALL ".join(f"SELECT '{n}' AS source, substr(sha256(array_to_string(list_sort(list_transform([" + ", ".join(o.q(h) for h in hs) + "], lambda c: lower(trim(c)))), '|')), 1, 16) AS fingerprint" for n, hs in _TABLE_HEADERS.items()))
def p03(spark, sf_dir):
    """The headers of three tables as they are read, and of a messy lead file."""
    found = {n: table(spark, sf_dir, n).columns if n != "leads" else hs for n, hs in _TABLE_HEADERS.items()}
    rows = spark.createDataFrame(list(found.items()), "source string, headers array<string>")
    return rows.select("source", mapping.fingerprint_column(F.col("headers")).alias("fingerprint"))


#: What the rules of P4-P7 give for _HEADERS, worked out by hand ("Status" holds the pattern "st" of a state, too).
_MAPPED = """('company', 'Organization'), ('facility_type', ' Facility Kind'), ('address1', NULL), ('address2', NULL), ('city', 'Town'), ('state', 'Status'), ('zip', NULL), ('county', NULL),
('phone', NULL), ('phone2', NULL), ('email', 'E-Mail'), ('website_address', 'Website URL'), ('first_name', NULL), ('last_name', NULL), ('capacity', 'Max'), ('min_age', NULL), ('max_age', NULL),
('ages_served', NULL), ('license_status', 'Status'), ('license_number', 'Permit'), ('license_type', NULL)"""


@query("p04_fallback_mapping", f"SELECT target, source, CAST(9.0 / 21 AS DOUBLE) AS confidence FROM (VALUES {_MAPPED}) v(target, source)")
def p04(spark, sf_dir):
    found, share = mapping.fallback(_HEADERS)
    return spark.createDataFrame([(t, found.get(t), share) for t in TARGETS], "target string, source string, confidence double")


# --- duplicates ---


@query("d01_exact_single_key", f"WITH l AS (SELECT row_ix, phone FROM ({o.CANONICAL})) SELECT row_ix, phone IS NOT NULL AND row_ix > min(row_ix) OVER (PARTITION BY phone) AS is_duplicate FROM l")
def d01_single(spark, sf_dir):
    return dedup.mark_exact(leads.canonical(spark, sf_dir).select("row_ix", "phone"), ("phone",)).select("row_ix", "is_duplicate")


@query("d01_exact_two_key", o.DEDUP)
def d01_two(spark, sf_dir):
    return dedup.mark_exact(leads.canonical(spark, sf_dir)).select("row_ix", "is_duplicate", "duplicate_cluster_id")


@query("d03_fuzzy_pairs", o.FUZZY)
def d03(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_ix"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("company"), F.concat_ws(" ", "p_brand", "p_type").alias("address1"))
    return dedup.fuzzy_pairs(part)


@query("d06_dup_summary", f"""WITH d AS ({o.DEDUP.replace('WITH RECURSIVE', 'WITH RECURSIVE', 1)})
SELECT count(*) AS total_records, count(*) - count_if(is_duplicate) AS unique_records, count_if(is_duplicate) AS duplicate_records,
  round(count_if(is_duplicate) * 100.0 / count(*), 2) AS duplicate_rate, count(DISTINCT duplicate_cluster_id) AS clusters,
  round(count(*) / count(DISTINCT duplicate_cluster_id), 2) AS average_cluster_size FROM d""")
def d06(spark, sf_dir):
    return dedup.summary(dedup.mark_exact(leads.canonical(spark, sf_dir)))


# --- quality ---


def _check(i: int, name: str) -> None:
    @query(f"q{i:02d}_{name}", f"SELECT row_ix, CAST({o.POINTS[name]} AS INTEGER) AS points FROM ({o.CANONICAL})")
    def run(spark, sf_dir):
        df = leads.canonical(spark, sf_dir)
        points = {n: p for n, p, _ in quality.checks(df.columns)}[name]
        return df.select("row_ix", points.cast("int").alias("points"))


for _i, _n in enumerate(o.POINTS, 1):
    _check(_i, _n)


@query("q_total_score", f"SELECT row_ix, score AS data_quality_score, CASE WHEN len(flags) > 0 THEN '[\"' || array_to_string(flags, '\", \"') || '\"]' END AS data_quality_flags FROM ({o.SCORED})")
def q_total(spark, sf_dir):
    scored = quality.score(leads.canonical(spark, sf_dir))
    return scored.select("row_ix", "data_quality_score", quality.flags_json(F.col("data_quality_flags")).alias("data_quality_flags"))


@query("q10_summary", f"""SELECT count(*) AS total_records, round(avg(score), 2) AS average_score, round(median(score), 2) AS median_score, min(score) AS min_score, max(score) AS max_score,
  count_if(score >= 90) AS excellent, count_if(score >= 70 AND score < 90) AS good, count_if(score >= 50 AND score < 70) AS fair, count_if(score >= 30 AND score < 50) AS poor, count_if(score < 30) AS very_poor
FROM ({o.SCORED})""")
def q10(spark, sf_dir):
    return quality.summary(quality.score(leads.canonical(spark, sf_dir)))


@query("q10_top_flags", f"SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM ({o.SCORED})) GROUP BY flag ORDER BY n DESC, flag LIMIT 10")
def q10_flags(spark, sf_dir):
    return quality.top_flags(quality.score(leads.canonical(spark, sf_dir)))


# --- statistics and profiles ---


def _stored(spark, sf_dir) -> DataFrame:
    return quality.score(leads.canonical(spark, sf_dir).withColumn("is_duplicate", F.col("row_ix") % 10 == 0))


_STORED = f"(SELECT *, row_ix % 10 = 0 AS is_duplicate, score - CASE WHEN row_ix % 10 = 0 THEN 5 ELSE 0 END AS data_quality_score FROM ({o.SCORED}))"
query("a01_a02_a05_totals", f"SELECT count(*) AS total_records, count_if(is_duplicate) AS duplicates, round(avg(data_quality_score), 2) AS avg_score, min(data_quality_score) AS min_score, max(data_quality_score) AS max_score FROM {_STORED}")(lambda s, d: store.totals(_stored(s, d)))
query("a03_by_source", f"SELECT source_file, count(*) AS n FROM {_STORED} GROUP BY source_file")(lambda s, d: store.by_source(_stored(s, d)))
query("a04_by_state", f"SELECT state, count(*) AS n FROM {_STORED} WHERE state IS NOT NULL GROUP BY state")(lambda s, d: store.by_state(_stored(s, d)))
query("k07_export_filter", f"SELECT row_ix, company, data_quality_score FROM {_STORED} WHERE NOT is_duplicate")(lambda s, d: store.unique(_stored(s, d)).select("row_ix", "company", "data_quality_score"))


@query("a06_run_stats", f"SELECT 5 AS files, count(*) AS records, count_if(is_duplicate) AS duplicates, round(avg(data_quality_score), 2) AS average_score FROM {_STORED}")
def a06(spark, sf_dir):
    return _stored(spark, sf_dir).agg(F.count_distinct("source_file").cast("int").alias("files"), F.count(F.lit(1)).alias("records"), F.count_if("is_duplicate").alias("duplicates"), F.round(F.avg("data_quality_score"), 2).alias("average_score"))


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINES = "(" + " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS x FROM lineitem" for c in _LI) + ")"


@query("a07_nunique", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM orders" for c in ("o_custkey", "o_orderstatus", "o_orderpriority")))
def a07(spark, sf_dir):
    return profile.distinct_counts(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


_MISSING = ["company", "phone", "email", "address1", "zip"]


@query("a08_missing", f"WITH l AS ({o.CANONICAL}) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS missing, round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS percent FROM l" for c in _MISSING))
def a08(spark, sf_dir):
    return profile.missing(leads.canonical(spark, sf_dir).select(_MISSING))


@query("a09_a10_a11_numeric", f"""SELECT c AS "column", count(x) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median,
  quantile_cont(x, 0.75) AS q75, max(x) AS max, round(var_samp(x), 4) AS variance, round(skewness(x), 5) AS skewness, round(kurtosis(x), 5) AS kurtosis FROM {_LINES} GROUP BY c""")
def a09(spark, sf_dir):
    p = profile.numeric(table(spark, sf_dir, "lineitem"), _LI)
    places = {"mean": 6, "std": 6, "variance": 4, "skewness": 5, "kurtosis": 5}
    return p.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in p.columns])


@query("a12_top_values", """SELECT * FROM (SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank FROM (
  SELECT 'p_type' AS "column", p_type AS value, count(*) AS n FROM part GROUP BY p_type UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY p_size)) WHERE rank <= 5""")
def a12(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"), ["p_type", "p_size"])


@query("a13_duplicate_rows", "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT p_name, p_brand, p_size FROM part)) AS BIGINT) AS duplicate_rows FROM part")
def a13(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "part").select("p_name", "p_brand", "p_size"))


@query("a14_shape", "SELECT c AS \"column\", t AS type, (SELECT count(*) FROM nation) AS rows FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) v(c, t)")
def a14(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))


# --- sinks, unions, classification, sources ---


@query("k03_upsert", """WITH old AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_orderpriority AS company, o_orderstatus AS city FROM orders WHERE o_orderkey % 3 > 0),
new AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'new ' || o_orderpriority END AS company, CAST(NULL AS VARCHAR) AS city FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.record_id, n.record_id) AS record_id, coalesce(n.company, o.company) AS company, coalesce(n.city, o.city) AS city,
  CASE WHEN o.record_id IS NOT NULL AND n.record_id IS NOT NULL THEN 'updated' WHEN n.record_id IS NOT NULL THEN 'inserted' END AS did
FROM old o FULL OUTER JOIN new n ON o.record_id = n.record_id""")
def k03(spark, sf_dir):
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    old = orders.where(key % 3 > 0).select(key.cast("string").alias("record_id"), F.col("o_orderpriority").alias("company"), F.col("o_orderstatus").alias("city"))
    new = orders.where(key % 2 == 0).select(key.cast("string").alias("record_id"), F.when(key % 4 != 0, F.concat(F.lit("new "), "o_orderpriority")).alias("company"), F.lit(None).cast("string").alias("city"))
    return store.merged(old, new).withColumnRenamed("__did", "did").drop("__rows")


@query("k03_same_key", """WITH old AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_id, o_orderpriority AS company, o_orderstatus AS city FROM orders WHERE o_orderkey % 3 > 0),
r AS (SELECT CAST(l_orderkey AS VARCHAR) AS record_id, (l_linenumber, l_partkey, l_suppkey) AS place, CASE WHEN l_linenumber % 2 = 1 OR l_quantity < 40 THEN 'part ' || l_partkey END AS company, CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS city FROM lineitem WHERE l_orderkey % 2 = 0),
new AS (SELECT record_id, arg_max(company, place) FILTER (WHERE company IS NOT NULL) AS company, arg_max(city, place) FILTER (WHERE city IS NOT NULL) AS city, count(*) AS n FROM r GROUP BY record_id)
SELECT coalesce(o.record_id, n.record_id) AS record_id, coalesce(n.company, o.company) AS company, coalesce(n.city, o.city) AS city,
  CASE WHEN n.record_id IS NULL THEN 0 WHEN o.record_id IS NULL THEN 1 ELSE 0 END AS inserted, CASE WHEN n.record_id IS NULL THEN 0 WHEN o.record_id IS NULL THEN n - 1 ELSE n END AS updated
FROM old o FULL OUTER JOIN new n ON o.record_id = n.record_id""")
def k03_same_key(spark, sf_dir):
    """K3 with several rows a key, in the order of their line numbers."""
    key = F.col("o_orderkey")
    old = table(spark, sf_dir, "orders").where(key % 3 > 0).select(key.cast("string").alias("record_id"), F.col("o_orderpriority").alias("company"), F.col("o_orderstatus").alias("city"))
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 2 = 0").select(
        F.col("l_orderkey").cast("string").alias("record_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.when((F.col("l_linenumber") % 2 == 1) | (F.col("l_quantity") < 40), F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("company"), F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("city"),
    )
    inserted = F.when(F.col("__did") == "inserted", 1).otherwise(0)
    out = store.merged(old, rows, order=["l_linenumber", "l_partkey", "l_suppkey"])
    return out.select("record_id", "company", "city", inserted.cast("long").alias("inserted"), (F.coalesce("__rows", F.lit(0)) - inserted).cast("long").alias("updated"))


@query("k01_commit", """SELECT CAST(c_custkey AS VARCHAR) AS record_id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS company, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS phone, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS city
FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0""")
def k01_commit(spark, sf_dir):
    """K1, K3: three writers at once at one location, each with columns of its own; none loses what another has committed."""
    customer, where, k = table(spark, sf_dir, "customer"), new_path(spark, "commits"), F.col("c_custkey")
    store.LeadStore(spark, where, "k01_first").create()
    parts = [customer.where(k % n == 0).select(k.cast("string").alias("record_id"), F.col(c).cast("string").alias(to)) for n, c, to in ((2, "c_name", "company"), (3, "c_mktsegment", "phone"), (5, "c_nationkey", "city"))]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda p: store.LeadStore(spark, where, f"k01_{p[0]}").upsert(p[1]), enumerate(parts)))
    return store.LeadStore(spark, where, "k01_last").frame().select("record_id", "company", "phone", "city")


@query("k05_record_hash", """SELECT p_partkey, sha256('{' || '"p_brand": "' || p_brand || '", "p_name": "' || p_name || '"}') AS hash FROM part""")
def k05(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", store.record_hash(None, ["p_name", "p_brand"]).alias("hash"))


query("k06_string_hash", "SELECT p_partkey, sha256(p_name) AS hash FROM part")(lambda s, d: table(s, d, "part").select("p_partkey", store.string_hash(F.col("p_name")).alias("hash")))


@query("u01_union_by_name", "SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT s_name AS name, s_nationkey AS nationkey FROM supplier")
def u01(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return union_all([c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment")), s.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))])


_DESCRIBED = "SELECT p_partkey, p_name || CASE p_partkey % 9 WHEN 0 THEN ' Learning Center' WHEN 1 THEN ' group home' WHEN 2 THEN ' After School club' WHEN 3 THEN ' Head Start' WHEN 4 THEN ' pre-k room' WHEN 5 THEN ' FOSTER' WHEN 6 THEN ' in-home' ELSE '' END AS text FROM part"
_HITS = " ".join("WHEN " + " OR ".join(f"contains(lower(text), {o.q(w)})" for w in ws) + f" THEN {o.q(n)}" for n, ws in o.V.FACILITY_KEYWORDS.items())


@query("c01_keyword_classifier", f"SELECT p_partkey, coalesce(c, 'Other') AS category, CAST(CASE WHEN c IS NULL THEN 0.5 ELSE 0.7 END AS DOUBLE) AS confidence FROM (SELECT p_partkey, CASE {_HITS} END AS c FROM ({_DESCRIBED}))")
def c01(spark, sf_dir):
    part = spark.sql(_DESCRIBED.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    return classify.classify(part, "text").select("p_partkey", "category", "confidence")


@query("s01_csv_roundtrip", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, 'a;b' AS note FROM nation")
def s01(spark, sf_dir):
    """Written to the shared folder with semicolons, read with the delimiter sniffed."""
    path = new_path(spark, "nation-csv")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey"), "n_name", F.lit("a;b").alias("note")).write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(spark, path, lineage=False, through_spark=True)


for _name, (_spark_sql, _duck_sql) in relational.SQL_QUERIES.items():
    query(_name, _duck_sql)(relational.runner(_spark_sql))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads, duplicates, scores, and a row per state."""
    scored = quality.score(dedup.mark_exact(leads.canonical(spark, sf_dir)))
    return scored.groupBy(N.state(F.col("state")).alias("state")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_duplicate").alias("duplicates"), F.round(F.avg("data_quality_score"), 2).alias("average_score")).orderBy("state")


@query("s02_csv_edges", """SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 1 THEN n_name || chr(10) || 'x' END AS name, CASE WHEN n_nationkey % 3 = 0 THEN '007' END AS code
FROM (SELECT CAST(n_nationkey AS VARCHAR) AS k, n_nationkey, n_name FROM nation) WHERE n_nationkey % 5 <> 4""".replace("SELECT n_nationkey,", "SELECT k AS n_nationkey,", 1))
def s02(spark, sf_dir):
    """Rows with all fields, rows too short (kept), rows too long (left out), quoted line ends."""
    path, k = new_path(spark, "edges-csv"), F.col("n_nationkey")
    quoted = F.concat(F.lit('"'), F.col("n_name"), F.lit('\nx"'))
    line = F.concat_ws(",", k.cast("string"), F.when(k % 3 != 1, quoted), F.when(k % 3 == 0, F.lit("007")))
    line = F.when(k % 5 == 4, F.concat_ws(",", k.cast("string"), F.lit("a,b,c"))).otherwise(line)
    body = table(spark, sf_dir, "nation").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("value"))  # 25 rows
    body.select(F.concat(F.lit("n_nationkey,name,code\n"), "value").alias("value")).write.text(path)
    return files.read_csv(spark, path, lineage=False, through_spark=True)


@query("k03_reopened", """SELECT CAST(n_nationkey AS VARCHAR) AS record_id, CASE WHEN n_nationkey % 2 = 0 THEN 'second ' || n_name ELSE n_name END AS company, CASE WHEN n_nationkey < 20 THEN 'c' END AS city
FROM nation WHERE n_nationkey < 20 OR n_nationkey % 2 = 0""")
def k03_reopened(spark, sf_dir):
    """Upserts through two stores opened one after the other at one location."""
    nation, where, k = table(spark, sf_dir, "nation"), new_path(spark, "reopened"), F.col("n_nationkey")
    store.LeadStore(spark, "sqlite:///" + where, "k03_first").upsert(nation.where(k < 20).select(k.cast("string").alias("record_id"), F.col("n_name").alias("company"), F.lit("c").alias("city")))
    again = store.LeadStore(spark, where, "k03_second")
    again.upsert(nation.where(k % 2 == 0).select(k.cast("string").alias("record_id"), F.concat(F.lit("second "), "n_name").alias("company")))
    return store.LeadStore(spark, where, "k03_third").frame().select("record_id", "company", "city")


@query("k04_prepare", """SELECT p_partkey, '["' || p_brand || '", "' || p_type || '"]' AS data_quality_flags, substr(repeat(p_name, 40), 1, 500) AS company, 'b' AS batch_id FROM part""")
def k04(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.array("p_brand", "p_type").alias("data_quality_flags"), F.repeat("p_name", 40).alias("company"))
    return store.prepare(part, "b").select("p_partkey", "data_quality_flags", "company", "batch_id")


@query("flagship", f"""WITH d AS ({o.DEDUP}), s AS ({o.SCORED})
SELECT {o.state('state')} AS state, count(*) AS n, count_if(is_duplicate) AS duplicates, round(avg(score - CASE WHEN is_duplicate THEN 5 ELSE 0 END), 2) AS average_score FROM s JOIN d USING (row_ix) GROUP BY 1""")
def flagship_query(spark, sf_dir):
    return flagship(spark, sf_dir)


@query("s02_csv_parts", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, sha256(text) AS text_sha256, length(text) AS n FROM documents WHERE text <> ''")
def s02_csv_parts(spark, sf_dir):
    """Whole texts with quotes and line ends as CSV, read in parts."""
    path = new_path(spark, "documents-csv")
    table(spark, sf_dir, "documents").where("text <> ''").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    rows = files.read_csv(spark, path, delimiter=",", lineage=False, strings=False, through_spark=True)
    return rows.select("doc_id", "lang", F.sha2("text", 256).alias("text_sha256"), F.char_length("text").cast("long").alias("n"))


_SPANS = """SELECT o_orderkey, o_custkey, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS s, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) + CASE WHEN o_orderkey % 500 = 0 THEN 20000 ELSE o_orderkey % 400 END AS e FROM orders"""


def _spans(spark, sf_dir):
    """Days that orders are open, from one day to a year, some for decades."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day.alias("s"), (day + F.when(F.col("o_orderkey") % 500 == 0, 20000).otherwise(F.col("o_orderkey") % 400)).alias("e"))


@query("rel_interval_overlap", f"WITH o AS ({_SPANS}) SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.s <= b.e AND b.s <= a.e")
def rel_interval_overlap(spark, sf_dir):
    """2.12: orders of a customer that are open at the same time."""
    o = _spans(spark, sf_dir)
    return intervals.overlap_join(o, o, ("s", "e"), keys=["o_custkey"]).where("l.o_orderkey < r.o_orderkey").select(F.col("l.o_orderkey").alias("a"), F.col("r.o_orderkey").alias("b"))


@query("rel_interval_contains", f"WITH o AS ({_SPANS}) SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey AND a.s <= b.s AND b.e <= a.e")
def rel_interval_contains(spark, sf_dir):
    """2.12: orders of a customer that are open while another one is, from beginning to end."""
    o = _spans(spark, sf_dir)
    return intervals.overlap_join(o, o, ("s", "e"), keys=["o_custkey"], contains=True).where("l.o_orderkey <> r.o_orderkey").select(F.col("l.o_orderkey").alias("a"), F.col("r.o_orderkey").alias("b"))


@query("rel_interval_one_long", """WITH p AS (SELECT p_partkey, CASE WHEN p_partkey = 1 THEN 0 ELSE CAST(floor(p_retailprice * 100) AS BIGINT) END AS s, CASE WHEN p_partkey = 1 THEN 1000000000 ELSE CAST(floor(p_retailprice * 100) AS BIGINT) + p_size END AS e FROM part)
SELECT a.p_partkey, count(*) AS n FROM p a JOIN p b ON a.s <= b.e AND b.s <= a.e GROUP BY a.p_partkey""")
def rel_interval_one_long(spark, sf_dir):
    """2.12: how many ranges of prices each one meets, without an equal key; one of them meets all."""
    cents = F.floor(F.col("p_retailprice") * 100)
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") == 1, 0).otherwise(cents).alias("s"), F.when(F.col("p_partkey") == 1, 1_000_000_000).otherwise(cents + F.col("p_size")).alias("e"))
    return intervals.overlap_counts(p, p, ("s", "e")).groupBy(F.col("l.p_partkey").alias("p_partkey")).agg(F.sum("n").alias("n"))

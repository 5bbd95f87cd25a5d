"""URL filters: host-suffix and path-prefix expressions, short hash prefixes, full digests.

Every URL is expanded into the (host suffix, path prefix) expressions that a
rule could have. Expressions meet the rules in an equi-join on the first 32
bits of their SHA-256 alone (rules that share them are one row); the full digest
confirms a meeting afterwards, and the longest rule wins. All of it is DataFrame functions.

Defined cases: a null URL, or one without ``://``, has empty host and path and
gets the default verdict. Of equal rules with different verdicts ``block``
holds. Rules with a null part are ignored. Repeated rows come back as often as
they were given. An empty table gives an empty result. Columns other than the
id and the URL are not read, so their names may clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this many are broadcast (at most some 64 MB); more are joined by a salted shuffle.
BROADCAST_RULES = 200_000
#: Copies of each rule in a shuffled join, so that a rule that many URLs fit is dealt over as many tasks.
SALT = 32
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SEP = "\u0000"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(_SEP), path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """``id_col, url, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict`` (strings; verdict ``allow`` or ``block``).
    A rule fits its host and all subdomains where the path starts with the rule's path.
    """
    known = (
        rules.select(F.col("host").alias("rh"), F.col("path").alias("rp"), F.col("verdict").alias("rv"))
        .where("rh is not null and rp is not null and rv is not null")
        .groupBy("rh", "rp")
        .agg(F.max("rv").alias("rv"))
    )
    n = known.limit(BROADCAST_RULES + 1).count()
    # Only these label counts and path lengths can meet a rule; both sets are bounded by the longest host and path.
    labels = sorted(r[0] for r in known.select(F.size(F.split("rh", r"\.")).alias("n")).distinct().collect())
    lengths = sorted(r[0] for r in known.select(F.length("rp").alias("n")).distinct().collect())
    digests = known.select(
        F.substring(_digest(F.col("rh"), F.col("rp")), 1, 8).alias("key"),
        _digest(F.col("rh"), F.col("rp")).alias("full"),
        F.struct(F.length(F.concat("rh", "rp")).alias("len"), F.col("rv").alias("verdict"), F.concat("rh", "rp").alias("rule")).alias("hit"),
    )
    # rules by their short prefix: nearly always one, so that a join multiplies no row
    digests = digests.groupBy("key").agg(F.collect_list(F.struct("full", "hit")).alias("known"))
    page = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    depth = F.size(F.split("host", r"\."))
    hosts = F.array_compact(F.array(*[F.when(depth >= c, F.substring_index("host", ".", -c)) for c in labels] or [F.lit(None).cast("string")]))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in lengths] or [F.lit(None).cast("string")]))
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: _digest(h, p))))
    opened = page.withColumn("all", expressions).withColumn("width", F.greatest(F.size("all"), F.lit(1))).select(
        "id", "url", "host", "path", "width", F.explode_outer("all").alias("digest")
    ).withColumn("short", F.substring("digest", 1, 8))
    if n <= BROADCAST_RULES:
        met = opened.join(F.broadcast(digests), F.col("short") == F.col("key"), "left")
    else:
        spread = digests.withColumn("rs", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        met = opened.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALT)).cast("int")).join(
            spread, (F.col("short") == F.col("key")) & (F.col("salt") == F.col("rs")), "left"
        )
    confirmed = F.filter("known", lambda r: r["full"] == F.col("digest"))
    met = met.withColumn("hit", F.get(confirmed, F.lit(0))["hit"])
    judged = met.groupBy("id", "url", "host", "path", "width").agg(F.max("hit").alias("best"), F.count(F.lit(1)).alias("rows"))
    copies = (F.col("rows") / F.col("width")).cast("int")
    return judged.select(
        F.col("id").alias(id_col), F.col("url"), "host", "path",
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


#: The rules of the registered query: fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).select("page_id", "host", "path", "rule", "verdict")


SQL = {
    "op2_url_filters": r"""
WITH r(rh, rp, rv) AS (VALUES %s),
p AS (
  SELECT page_id, row_number() OVER () AS rid,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages)
SELECT page_id, host, path,
  arg_max(rh || rp, length(rh || rp)) AS rule,
  coalesce(arg_max(rv, length(rh || rp)), 'allow') AS verdict
FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
GROUP BY rid, page_id, host, path
""" % ", ".join(repr(r) for r in RULES)
}

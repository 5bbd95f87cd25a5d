"""Raw leads derived from the driver tables: messy strings, the same in Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.functions import normalize as N
from brightsieve.session import table

#: Portable SQL; the braces name the tables.
RAW = """
SELECT c.c_custkey AS row_ix,
  CASE WHEN c.c_custkey % 17 = 0 THEN NULL WHEN c.c_custkey % 29 = 0 THEN 'unknown' WHEN c.c_custkey % 31 = 0 THEN 'X' ELSE concat(c.c_name, ' Learning Center') END AS company,
  CASE c.c_custkey % 7 WHEN 0 THEN NULL
    WHEN 1 THEN concat('(', substring(p.d, 1, 3), ') ', substring(p.d, 4, 3), '-', substring(p.d, 7, 4))
    WHEN 2 THEN concat(substring(p.d, 1, 3), '.', substring(p.d, 4, 3), '.', substring(p.d, 7, 4))
    WHEN 3 THEN concat('1', p.d) WHEN 4 THEN concat('+1 ', p.d) WHEN 5 THEN substring(p.d, 4, 7) ELSE p.d END AS raw_phone,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL WHEN c.c_custkey % 11 = 0 THEN 'not-an-email'
    ELSE concat('  User', CAST((c.c_custkey * 31) % 1201 AS VARCHAR(20)), '@Example.COM ') END AS raw_email,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL
    ELSE concat(CAST(c.c_custkey % 900 + 1 AS VARCHAR(20)), ' n. o''brien', CASE c.c_custkey % 4 WHEN 0 THEN ' st' WHEN 1 THEN '  ave.' WHEN 2 THEN ' blvd apt 5th' ELSE ' main-st' END) END AS raw_address,
  CASE c.c_nationkey % 6 WHEN 0 THEN 'texas' WHEN 1 THEN ' CA ' WHEN 2 THEN 'Calif.' WHEN 3 THEN 'ohio' WHEN 4 THEN 'ZZ' ELSE NULL END AS raw_state,
  CASE c.c_custkey % 6 WHEN 0 THEN '02134' WHEN 1 THEN '2134' WHEN 2 THEN '501' WHEN 3 THEN '10001-1234' WHEN 4 THEN '9021x' ELSE NULL END AS raw_zip,
  CASE c.c_custkey % 5 WHEN 0 THEN 'Licensed for 40 children' WHEN 1 THEN '12' WHEN 2 THEN 'N/A' WHEN 3 THEN '2000' ELSE '0' END AS raw_capacity,
  CASE c.c_custkey % 8 WHEN 0 THEN '0-5' WHEN 1 THEN '6 weeks to 5 years' WHEN 2 THEN '2 to 3' WHEN 3 THEN 'Infants and Toddlers' WHEN 4 THEN '30 months'
    WHEN 5 THEN '5 - 12 yrs' WHEN 6 THEN 'infant, preschool; school age' ELSE NULL END AS raw_ages,
  CASE c.c_custkey % 9 WHEN 0 THEN ' Licensed' WHEN 1 THEN 'under review' WHEN 2 THEN 'DENIED' WHEN 3 THEN 'Temporary ' WHEN 4 THEN 'whatever' WHEN 5 THEN '' WHEN 6 THEN 'inactive' WHEN 7 THEN 'voluntarily_closed' ELSE NULL END AS raw_status,
  CASE c.c_custkey % 6 WHEN 0 THEN 'CHILD CARE FAMILY - K820015716' WHEN 1 THEN 'Group Home' WHEN 2 THEN ' regular - 12 ' WHEN 3 THEN 'Montessori-School' WHEN 4 THEN 'exempt' ELSE NULL END AS raw_type,
  CASE c.c_custkey % 6 WHEN 0 THEN 'Anne-Marie O''Brien' WHEN 1 THEN 'Dr. Jane Doe' WHEN 2 THEN 'Smith, John' WHEN 3 THEN 'cher' WHEN 4 THEN NULL ELSE ' o''neil mc-donald ' END AS raw_name,
  CASE c.c_custkey % 5 WHEN 0 THEN 'los angeles COUNTY' WHEN 1 THEN ' o''brien' WHEN 2 THEN 'st. mary''s  county' WHEN 3 THEN '' ELSE NULL END AS raw_county,
  CASE c.c_custkey % 6 WHEN 0 THEN 'https://www.Foo.com/' WHEN 1 THEN 'foo.com/en/25#top' WHEN 2 THEN 'http://bar.org?x=1' WHEN 3 THEN 'WWW.baz.net#a' WHEN 4 THEN 'nodot' ELSE NULL END AS raw_site,
  CASE c.c_custkey % 6 WHEN 0 THEN ' Yes' WHEN 1 THEN 'off' WHEN 2 THEN '1' WHEN 3 THEN 'maybe' WHEN 4 THEN 'TRUE' ELSE NULL END AS raw_flag,
  c.c_mktsegment AS segment, n.n_name AS nation
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT c_custkey, CAST(2125550000 + (c_custkey * 7919) % 1009 AS VARCHAR(20)) AS d FROM {customer}) p ON p.c_custkey = c.c_custkey
"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW, customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads with normalised columns, as scoring, duplicates and the store use them."""
    r = raw(spark, sf_dir)
    c = F.col
    return r.select(
        "row_ix", "company", N.phone(c("raw_phone")).alias("phone"), F.lower(F.trim("raw_email")).alias("email"), N.address(c("raw_address")).alias("address1"),
        c("nation").alias("city"), c("raw_state").alias("state"), c("raw_zip").alias("zip"), N.capacity(c("raw_capacity")).alias("capacity"),
        N.age_bucket(c("raw_ages")).alias("ages_served"), N.age_years(c("raw_ages")).alias("min_age"),
        F.when(c("row_ix") % 2 == 0, N.age_years(c("raw_ages"))).alias("max_age"),
        F.when(c("row_ix") % 3 > 0, F.concat(F.lit("L"), c("row_ix").cast("string"))).alias("license_number"),
        F.when(c("row_ix") % 4 > 0, N.license_status(c("raw_status"))).alias("license_status"),
        N.name(c("raw_name"))["first_name"].alias("first_name"), N.name(c("raw_name"))["last_name"].alias("last_name"),
        c("segment").alias("source_file"),
    )

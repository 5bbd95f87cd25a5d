"""Record quality Q1 to Q10: nine weighted checks, flags, and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.functions import validate, vocab
from brightsieve.functions.text import strip

BANDS = (("excellent", 90), ("good", 70), ("fair", 50), ("poor", 30), ("very_poor", None))


def _has(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name).cast("string") != "")


def checks(columns: list[str]) -> list[tuple[str, Column, list[Column]]]:
    """(check, points, flags) in the order of flags; columns that a frame lacks count as missing."""

    def has(name: str) -> Column:
        return _has(name) if name in columns else F.lit(False)

    def col(name: str) -> Column:
        return F.col(name).cast("string") if name in columns else F.lit(None).cast("string")

    def flag(when: Column, name: str) -> Column:
        return F.when(when, F.lit(name))

    company = F.lower(strip(col("company")))
    short, generic = F.length(company) < 2, company.isin(vocab.GENERIC_COMPANIES)
    phone_ok, email_ok = validate.phone(col("phone"))["valid"], validate.email(col("email"))["valid"]
    state_ok = ~has("state") | validate.state(col("state"))["valid"]
    zip_ok = ~has("zip") | validate.zip_code(col("zip"))["valid"]
    places = sum((F.when(has(n), 1).otherwise(0) for n in ("address1", "city", "state", "zip")), F.lit(0))
    capacity = col("capacity").try_cast("double")
    number, status = has("license_number"), has("license_status")
    first, last = has("first_name"), has("last_name")
    both_ages = has("min_age") & has("max_age")
    duplicate = F.lower(col("is_duplicate")) == "true"
    return [
        ("company", F.when(~has("company"), 0).when(short | generic, 5).otherwise(15),
         [flag(~has("company"), "missing_company"), flag(has("company") & short, "company_too_short"), flag(has("company") & ~short & generic, "company_generic_value")]),
        ("phone", F.when(~has("phone"), 0).when(phone_ok, 15).otherwise(5), [flag(~has("phone"), "missing_phone"), flag(has("phone") & ~phone_ok, "invalid_phone_format")]),
        ("email", F.when(has("email") & email_ok, 10).otherwise(0), [flag(~has("email"), "missing_email"), flag(has("email") & ~email_ok, "invalid_email_format")]),
        ("address", F.when((places == 4) & state_ok & zip_ok, 15).when(places == 4, 10).when(places >= 2, 8).when(places == 1, 5).otherwise(0),
         [flag((places == 4) & ~state_ok, "invalid_state"), flag((places == 4) & ~zip_ok, "invalid_zip"), flag(places.between(1, 3), "incomplete_address"), flag(places == 0, "missing_address")]),
        ("capacity", F.when(capacity.isNull() | (capacity <= 0), 0).when(capacity > 1000, 5).otherwise(10),
         [flag(col("capacity").isNull(), "missing_capacity"), flag(col("capacity").isNotNull() & (capacity.isNull() | (capacity <= 0)), "invalid_capacity"), flag(capacity > 1000, "capacity_unusually_high")]),
        ("license", F.when(number & status, 10).when(number | status, 5).otherwise(0),
         [flag(number & ~status, "missing_license_status"), flag(status & ~number, "missing_license_number"), flag(~number & ~status, "missing_license_info")]),
        ("contact_name", F.when(first & last, 10).when(first | last, 5).otherwise(0), [flag((first | last) & ~(first & last), "partial_contact_name"), flag(~first & ~last, "missing_contact_name")]),
        ("ages", F.when(both_ages, 10).when(has("ages_served"), 5).otherwise(0), [flag(~both_ages & has("ages_served"), "ages_served_only"), flag(~both_ages & ~has("ages_served"), "missing_age_info")]),
        ("duplicate", F.when(duplicate, 0).otherwise(5), [flag(duplicate, "marked_duplicate")]),
    ]


def score(df: DataFrame) -> DataFrame:
    """``df`` with data_quality_score (int) and data_quality_flags (array of strings, null if there is none)."""
    told = checks(df.columns)
    points = sum((p for _, p, _ in told), F.lit(0)).cast("int")
    flags = F.array_compact(F.array(*[f for _, _, fs in told for f in fs]))
    scored = df.withColumns({"data_quality_score": points, "data_quality_flags": flags})
    return scored.withColumn("data_quality_flags", F.when(F.size("data_quality_flags") > 0, F.col("data_quality_flags")))


def flags_json(flags: Column) -> Column:
    """The flags as JSON text with blanks after commas, null if there is none."""
    return F.when(flags.isNotNull(), F.concat(F.lit('["'), F.array_join(flags, '", "'), F.lit('"]')))


def summary(scored: DataFrame) -> DataFrame:
    """One row: total, average, median, least, greatest, and the counts of the five bands."""
    s = F.col("data_quality_score")
    above = None
    bands = []
    for name, least in BANDS:
        inside = F.lit(True) if least is None else s >= least
        bands.append(F.count_if(inside if above is None else inside & (s < above)).alias(name))
        above = least
    return scored.agg(F.count(F.lit(1)).alias("total_records"), F.round(F.avg(s), 2).alias("average_score"), F.round(F.median(s), 2).alias("median_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"), *bands)


def top_flags(scored: DataFrame, n: int = 10) -> DataFrame:
    """The commonest flags; ties in order of name."""
    # explode() would have Spark filter on the array's size first, and work out every check twice
    return scored.select(F.explode_outer("data_quality_flags").alias("flag")).where("flag is not null").groupBy("flag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "flag").limit(n)

"""Validators V1 to V4: structs of ``valid`` and ``value``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightsieve.functions import vocab as V
from brightsieve.functions.normalize import EMAIL
from brightsieve.functions.text import lookup, strip


def _told(value: Column, *more: Column) -> Column:
    return F.struct(value.isNotNull().alias("valid"), value.alias("value"), *more)


def email(c: Column) -> Column:
    """V1: lower-cased, at most 254 characters."""
    s = F.lower(strip(c))
    return _told(F.when((F.length(s) <= 254) & s.rlike(EMAIL), s))


def phone(c: Column) -> Column:
    """V2: ten digits after a leading 1 of eleven is dropped; ``formatted`` as (XXX) XXX-XXXX."""
    d = F.regexp_replace(c, "[^0-9]", "")
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    value = F.when(F.length(d) == 10, d)
    formatted = F.concat(F.lit("("), F.substring(value, 1, 3), F.lit(") "), F.substring(value, 4, 3), F.lit("-"), F.substring(value, 7, 4))
    return _told(value, formatted.alias("formatted"))


def zip_code(c: Column) -> Column:
    """V3: five digits, ZIP+4 with its hyphen, or four digits padded."""
    s = F.regexp_replace(c, "[^0-9-]", "")
    return _told(F.when(s.rlike(r"^\d{5}(-\d{4})?$"), F.left(s, F.lit(5))).when(s.rlike(r"^\d{4}$"), F.concat(F.lit("0"), s)))


def state(c: Column, full_names: bool = False) -> Column:
    """V4: codes and eight names; ``full_names`` adds all state names."""
    s = F.upper(strip(c))
    found = F.coalesce(F.when(s.isin(V.STATES), s), lookup(s, V.VALIDATOR_STATES))
    return _told(F.coalesce(found, lookup(s, V.STATE_NAMES)) if full_names else found)

"""Field normalisers N1 to N16: ``Column -> Column``, all built-in expressions.

Null and empty input gives null unless a docstring says otherwise.
``NORMALIZERS`` maps target names to functions; ``register`` adds one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightsieve.functions import vocab as V
from brightsieve.functions.text import capitalize, lookup, present, strip, title


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def phone(c: Column) -> Column:
    """E.164 for ten digits, or eleven that begin with 1."""
    d = _digits(c)
    return F.when((F.length(d) == 11) & d.startswith("1"), F.concat(F.lit("+"), d)).when(F.length(d) == 10, F.concat(F.lit("+1"), d))


def state(c: Column) -> Column:
    """USPS code of a code, full name or shortened name."""
    s = F.upper(strip(c))
    return F.when(present(c), F.coalesce(F.when(s.isin(V.STATES), s), lookup(s, V.STATE_NAMES), lookup(s, V.STATE_VARIATIONS)))


def zip5(c: Column) -> Column:
    """Five digits; nine are cut, three and four padded."""
    d = _digits(c)
    n = F.length(d)
    return F.when(n == 9, F.left(d, F.lit(5))).when(n == 5, d).when(n == 4, F.concat(F.lit("0"), d)).when(n == 3, F.concat(F.lit("00"), d))


def address(c: Column) -> Column:
    """Street types in full, single blanks, Python's title case."""
    s = F.concat(F.lit(" "), F.upper(strip(c)), F.lit(" "))
    for short, full in V.STREET_TYPES.items():
        s = F.replace(s, F.lit(short), F.lit(full))
    return F.when(present(c), title(F.regexp_replace(strip(s), r"(?U)\s+", " ")))


def name_title(c: Column) -> Column:
    """Parts between hyphens (else apostrophes) capitalised."""
    hyphens = F.array_join(F.transform(F.split(c, "-", -1), capitalize), "-")
    apostrophes = F.array_join(F.transform(F.split(c, "'", -1), capitalize), "'")
    return F.when(c.contains("-"), hyphens).when(c.contains("'"), apostrophes).otherwise(capitalize(c))


def name(c: Column) -> Column:
    """Struct of first_name and last_name."""
    word = r"[A-Za-z'\-]+"
    s = strip(c)
    first, last = F.regexp_extract(s, rf"^({word})", 1), F.regexp_extract(s, rf"^{word}\s+({word})", 1)
    halves = F.transform(F.split(s, ",", -1), strip)
    parts = F.filter(F.split(s, r"(?U)\s+", -1), lambda p: p != "")

    def dropped(from_end: bool, known: list[str], of: Column) -> Column:
        """How many at one end are all among ``known``."""
        seq = F.reverse(of) if from_end else of
        begin = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
        return F.aggregate(
            seq, begin, lambda a, p: F.struct((a["n"] + F.when(a["on"] & F.upper(p).isin(known), 1).otherwise(0)).alias("n"), (a["on"] & F.upper(p).isin(known)).alias("on"))
        )["n"]

    rest = F.slice(parts, dropped(False, V.NAME_TITLES, parts) + 1, F.size(parts))
    core = F.slice(rest, 1, F.size(rest) - dropped(True, V.NAME_SUFFIXES, rest))
    plain = first != ""
    swapped = s.contains(",") & (F.size(halves) == 2)
    return F.struct(
        F.when(present(c), F.when(plain, name_title(first)).when(swapped, name_title(F.get(halves, F.lit(1)))).when(F.size(core) > 1, name_title(F.get(core, F.lit(0))))).alias("first_name"),
        F.when(
            present(c),
            F.when(plain, F.when(last != "", name_title(last))).when(swapped, name_title(F.get(halves, F.lit(0))))
            .when(F.size(core) == 1, name_title(F.get(core, F.lit(0)))).when(F.size(core) > 1, name_title(F.array_join(F.slice(core, 2, F.size(core)), " "))),
        ).alias("last_name"),
    )


def age_bucket(c: Column) -> Column:
    """Canonical age bucket; UNKNOWN where nothing fits."""
    s = F.lower(strip(c))
    span = r"(\d+)\s*(?:-|to)\s*(\d+)"
    lo, hi = (F.regexp_extract(s, span, k).try_cast("bigint") for k in (1, 2))
    ladder = (
        F.when((lo == 0) & (hi <= 1), "INFANT").when((lo <= 1) & (hi <= 3), "INFANT_TODDLER").when((lo == 0) & (hi <= 5), "BIRTH_TO_5")
        .when((lo == 0) & (hi <= 12), "BIRTH_TO_12").when((lo >= 1) & (hi <= 3), "TODDLER").when((lo >= 3) & (hi <= 5), "PRESCHOOL")
        .when((lo >= 5) & (hi <= 12), "SCHOOL_AGE").otherwise("MIXED_AGES")
    )
    named = F.filter(F.transform(F.split(s, r"[,;/&]|\band\b", -1), lambda p: lookup(strip(p), V.AGE_GROUPS)), lambda p: p.isNotNull())
    several = (
        F.when(F.size(F.array_distinct(named)) > 2, "MIXED_AGES")
        .when(F.array_contains(named, "INFANT") & F.array_contains(named, "TODDLER"), "INFANT_TODDLER").otherwise(F.get(named, F.lit(0)))
    )
    return F.when(present(c), F.coalesce(lookup(s, V.AGE_GROUPS), F.when(s.rlike(span), ladder), several, F.lit("UNKNOWN")))


def age_years(c: Column) -> Column:
    """Whole years; weeks and months converted, halves to even."""
    s = F.lower(strip(c))
    n = F.regexp_extract(s, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    return F.bround(F.when(s.contains("week"), n / 52).when(s.contains("month"), n / 12).otherwise(n), 0).try_cast("int")


def capacity(c: Column) -> Column:
    """The number before a capacity word, else the first number."""
    s = strip(c)
    told = F.regexp_extract(s, r"(?i)(\d+)\s*(?:children|kids|child|spaces|capacity|enrollment)", 1)
    n = F.when(told != "", told).otherwise(F.regexp_extract(s, r"(\d+)", 1)).try_cast("int")
    return F.when(~F.lower(s).isin(V.NO_CAPACITY), n)


def license_status(c: Column) -> Column:
    """Canonical status; UNKNOWN for empty and unknown values."""
    s = F.lower(strip(c))
    found = F.coalesce(lookup(s, V.LICENSE_STATUS), F.when(F.upper(s).isin(V.LICENSE_STATUSES), F.upper(s)), F.lit("UNKNOWN"))
    return F.when(present(c), found).otherwise("UNKNOWN")


def _before_hyphen(c: Column) -> Column:
    s = strip(c)
    head = F.regexp_extract(s, r"^\s*([^\-]+?)\s*-", 1)
    return F.lower(F.when(head != "", strip(head)).otherwise(s))


def license_type(c: Column) -> Column:
    """What stands before the first hyphen; OTHER if not known, UNKNOWN if empty."""
    s = _before_hyphen(c)
    found = F.coalesce(lookup(s, V.LICENSE_TYPE), F.when(F.upper(s).isin(V.LICENSE_TYPES), F.upper(s)), F.lit("OTHER"))
    return F.when(present(c), found).otherwise("UNKNOWN")


def facility_type(c: Column) -> Column:
    """As N11 for facilities."""
    s = _before_hyphen(c)
    found = F.coalesce(lookup(s, V.FACILITY_TYPE), F.when(F.upper(s).isin(V.FACILITY_TYPES), F.upper(s)), F.lit("OTHER"))
    return F.when(present(c), found).otherwise("UNKNOWN")


EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def email(c: Column) -> Column:
    """Lower case, if well-formed."""
    s = F.lower(strip(c))
    return F.when(s.rlike(EMAIL), s)


def website(c: Column) -> Column:
    """``https://`` and a bare domain."""
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "^https?://", ""), r"^www\.", "")
    s = F.substring_index(F.substring_index(F.regexp_replace(s, "/+$", ""), "?", 1), "#", 1)
    return F.when(s.rlike(r"^[a-z0-9.-]+\.[a-z]{2,}$"), F.concat(F.lit("https://"), s))


def county(c: Column) -> Column:
    """Title case with one ``County``."""
    return F.when(present(c), F.concat(title(F.regexp_replace(strip(c), r"(?i)\s+county$", "")), F.lit(" County")))


def boolean(c: Column) -> Column:
    """The strings ``true`` and ``false``."""
    s = F.lower(strip(c.cast("string")))
    return F.when(s.isin(V.TRUE_WORDS), "true").when(s.isin(V.FALSE_WORDS), "false")


#: By target column, as the rule engine and ``apply_normalizers`` use them.
NORMALIZERS: dict[str, Callable[[Column], Column]] = {
    "phone": phone, "phone2": phone, "state": state, "zip": zip5, "address1": address,
    "first_name": lambda c: name(c)["first_name"], "last_name": lambda c: name(c)["last_name"],
    "ages_served": age_bucket, "min_age": age_years, "max_age": age_years, "capacity": capacity, "license_status": license_status,
    "license_type": license_type, "facility_type": facility_type, "email": email, "website_address": website, "county": county,
    "boolean": boolean, "address": address,
}


def register(target: str, function: Callable[[Column], Column]) -> None:
    """a normaliser of one's own; a pandas UDF serves as well."""
    NORMALIZERS[target] = function


def detail(target: str, c: Column) -> Column:
    """Struct of value, valid, error and original, as a report on one value."""
    value = NORMALIZERS[target](c)
    error = F.when(~present(c.cast("string")) | c.isNull(), "empty_value").when(value.isNull(), "invalid_value")
    return F.struct(value.alias("value"), (value.isNotNull() & error.isNull()).alias("valid"), error.alias("error"), c.alias("original"))

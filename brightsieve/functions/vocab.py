"""Vocabularies and lookup tables, stated plainly so that results equal the specification's."""

# USPS codes: fixed values.
STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY DC PR GU VI"
).split()

# State names: fixed values.
STATE_NAMES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT",
    "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA",
    "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI",
    "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH",
    "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK",
    "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN",
    "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA", "WEST VIRGINIA": "WV", "WISCONSIN": "WI",
    "WYOMING": "WY", "DISTRICT OF COLUMBIA": "DC", "PUERTO RICO": "PR", "VIRGIN ISLANDS": "VI", "GUAM": "GU",
}

# Shortened state names of the normaliser: fixed values.
STATE_VARIATIONS = {
    "CALIF": "CA", "CALIF.": "CA", "TEX": "TX", "TEX.": "TX", "NEV": "NV", "NEV.": "NV",
    "OKLA": "OK", "OKLA.": "OK", "FLA": "FL", "FLA.": "FL", "PENN": "PA", "PENNA": "PA",
}

# State names that the validator knows: fixed values.
VALIDATOR_STATES = {
    "CALIF": "CA", "CALIFORNIA": "CA", "TEX": "TX", "TEXAS": "TX", "NEV": "NV", "NEVADA": "NV", "OKLA": "OK", "OKLAHOMA": "OK",
}

# Street types, in the order of replacement: fixed values.
STREET_TYPES = {
    " ST ": " STREET ", " ST. ": " STREET ", " AVE ": " AVENUE ", " AVE. ": " AVENUE ", " RD ": " ROAD ", " RD. ": " ROAD ",
    " BLVD ": " BOULEVARD ", " BLVD. ": " BOULEVARD ", " DR ": " DRIVE ", " DR. ": " DRIVE ", " LN ": " LANE ", " LN. ": " LANE ",
    " CT ": " COURT ", " CT. ": " COURT ", " CIR ": " CIRCLE ", " CIR. ": " CIRCLE ", " PL ": " PLACE ", " PL. ": " PLACE ",
}

# Titles and suffixes of names: fixed values.
NAME_TITLES = ["DR", "DR.", "DOCTOR", "MR", "MR.", "MRS", "MRS.", "MS", "MS.", "MISS", "PROF", "PROF.", "SIR", "MADAM"]
NAME_SUFFIXES = ["JR", "JR.", "SR", "SR.", "II", "III", "IV", "V", "PHD", "PH.D", "MD", "M.D.", "ESQ", "ESQ."]

# Age groups: fixed values.
AGE_GROUPS = {
    "infant": "INFANT", "infants": "INFANT", "baby": "INFANT", "babies": "INFANT", "toddler": "TODDLER", "toddlers": "TODDLER",
    "preschool": "PRESCHOOL", "preschooler": "PRESCHOOL", "preschoolers": "PRESCHOOL", "pre-k": "PRESCHOOL", "prek": "PRESCHOOL",
    "pre-school": "PRESCHOOL", "school age": "SCHOOL_AGE", "school-age": "SCHOOL_AGE", "schoolage": "SCHOOL_AGE", "school": "SCHOOL_AGE",
    "kindergarten": "KINDERGARTEN", "infant toddler": "INFANT_TODDLER", "infant/toddler": "INFANT_TODDLER", "birth to 5": "BIRTH_TO_5",
    "birth-5": "BIRTH_TO_5", "0-5": "BIRTH_TO_5", "birth to 12": "BIRTH_TO_12", "birth-12": "BIRTH_TO_12", "0-12": "BIRTH_TO_12",
    "all ages": "MIXED_AGES", "mixed ages": "MIXED_AGES", "mixed": "MIXED_AGES",
}

# License statuses: fixed values.
LICENSE_STATUS = {
    "licensed": "ACTIVE", "valid": "ACTIVE", "current": "ACTIVE", "good standing": "ACTIVE", "active": "ACTIVE", "open": "ACTIVE",
    "approved": "ACTIVE", "full permit": "ACTIVE", "permit": "ACTIVE", "in good standing": "ACTIVE", "conditional": "CONDITIONAL",
    "probation": "PROBATION", "monitored": "PROBATION", "probationary": "PROBATION", "temporary": "TEMPORARY", "temp": "TEMPORARY",
    "pending": "PENDING", "application submitted": "PENDING", "under review": "PENDING", "application": "PENDING", "in progress": "PENDING",
    "provisional": "PENDING", "suspended": "SUSPENDED", "on hold": "SUSPENDED", "revoked": "REVOKED", "denied": "REVOKED",
    "cancelled": "REVOKED", "canceled": "REVOKED", "expired": "EXPIRED", "lapsed": "EXPIRED", "past due": "EXPIRED", "delinquent": "EXPIRED",
    "closed": "CLOSED", "inactive": "CLOSED", "terminated": "CLOSED", "voluntarily closed": "VOLUNTARILY_CLOSED",
    "voluntary closure": "VOLUNTARILY_CLOSED",
}
LICENSE_STATUSES = "ACTIVE CONDITIONAL PROBATION TEMPORARY PENDING SUSPENDED REVOKED EXPIRED CLOSED DENIED VOLUNTARILY_CLOSED UNKNOWN".split()

# License types: fixed values.
LICENSE_TYPE = {
    "regular": "REGULAR", "standard": "REGULAR", "full": "REGULAR", "provisional": "PROVISIONAL", "temporary": "TEMPORARY", "temp": "TEMPORARY",
    "initial": "INITIAL", "new": "INITIAL", "renewal": "RENEWAL", "renew": "RENEWAL", "registered": "REGISTERED", "registration": "REGISTERED",
    "exempt": "EXEMPT", "exemption": "EXEMPT", "group": "GROUP", "group home": "GROUP", "home": "HOME", "family home": "HOME", "family": "HOME",
    "center": "CENTER", "child care center": "CENTER",
}
LICENSE_TYPES = "REGULAR PROVISIONAL TEMPORARY INITIAL RENEWAL REGISTERED EXEMPT GROUP HOME CENTER OTHER UNKNOWN".split()

# Facility types: fixed values.
FACILITY_TYPE = {
    "child care center": "CENTER", "center": "CENTER", "daycare center": "CENTER", "day care center": "CENTER", "child care family": "FAMILY_HOME",
    "family child care": "FAMILY_HOME", "family home": "FAMILY_HOME", "family day care": "FAMILY_HOME", "family": "FAMILY_HOME",
    "home": "FAMILY_HOME", "group home": "GROUP_HOME", "group": "GROUP_HOME", "school-age": "SCHOOL_AGE", "school age": "SCHOOL_AGE",
    "school age program": "SCHOOL_AGE", "before/after school": "SCHOOL_AGE", "head start": "HEAD_START", "early head start": "EARLY_HEAD_START",
    "montessori": "MONTESSORI", "montessori school": "MONTESSORI", "religious": "RELIGIOUS", "church": "RELIGIOUS", "faith-based": "RELIGIOUS",
    "drop in": "DROP_IN", "drop-in": "DROP_IN", "exempt": "EXEMPT", "preschool": "CENTER", "nursery school": "CENTER",
}
FACILITY_TYPES = "CENTER FAMILY_HOME GROUP_HOME SCHOOL_AGE HEAD_START EARLY_HEAD_START MONTESSORI RELIGIOUS DROP_IN EXEMPT OTHER UNKNOWN".split()

# Booleans and values that stand for no capacity: fixed values.
TRUE_WORDS = ["true", "t", "yes", "y", "1", "on", "active"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "off", "inactive"]
NO_CAPACITY = ["n/a", "na", "unknown", "none", "", "null"]
GENERIC_COMPANIES = ["unknown", "n/a", "na", "none", "null", "test"]

# Keywords of the facility classifier, the first hit in this order decides: fixed values.
FACILITY_KEYWORDS = {
    "Child Care Center": ["center", "daycare center", "day care center", "learning center", "child care", "childcare", "academy", "preschool", "pre-school"],
    "Family Child Care": ["family care", "family child care", "home daycare", "home care", "in-home", "family home", "residential care"],
    "Group Home": ["group home", "group care", "group childcare"],
    "School Age Program": ["school age", "after school", "before school", "school program"],
    "Head Start": ["head start", "early head start"],
    "Preschool": ["preschool", "pre-school", "pre school", "pre-k", "pre k"],
    "Residential": ["residential", "group home", "shelter", "foster"],
}

# The canonical columns, in order: fixed values.
TARGETS = (
    "company facility_type address1 address2 city state zip county phone phone2 email website_address first_name last_name "
    "capacity min_age max_age ages_served license_status license_number license_type"
).split()
INTEGER_TARGETS = ("capacity", "min_age", "max_age")

# Patterns of the fallback mapping: fixed values.
COLUMN_PATTERNS = {
    "company": ["name", "organization"],
    "phone": ["phone"],
    "email": ["e-mail", "mail"],
    "address1": ["address"],
    "city": ["town", "municipality"],
    "state": ["province", "st"],
    "zip": ["postal", "zipcode", "postcode"],
    "capacity": ["cap", "max", "total", "size"],
    "license_number": ["license", "credential", "permit", "certification"],
    "license_status": ["status"],
}

# What counts as missing in source files: fixed values.
NA_TOKENS = [
    "", "NA", "N/A", "n/a", "NULL", "null", "None", "NaN", "nan", "-NaN", "-nan", "#N/A", "#NA", "<NA>", "#N/A N/A",
    "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
]

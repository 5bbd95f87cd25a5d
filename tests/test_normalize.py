import pytest
from pyspark.sql import functions as F

from brightsieve.functions import normalize as N
from brightsieve.functions import validate as V

CASES = [
    ("phone", "(212) 555-0790", "+12125550790"), ("phone", "5550790", None), ("phone", "1 212 555 0790", "+12125550790"), ("phone", "", None),
    ("state", " texas ", "TX"), ("state", "Penna", "PA"), ("state", "ZZ", None), ("state", "pr", "PR"),
    ("zip", "10001-1234", "10001"), ("zip", "2134", "02134"), ("zip", "501", "00501"), ("zip", "12", None),
    ("address1", "42 n. o'brien  ave.", "42 N. O'Brien Avenue"), ("address1", "5th o'brien main-st", "5Th O'Brien Main-St"), ("address1", None, None),
    ("ages_served", "0-5", "BIRTH_TO_5"), ("ages_served", "2 to 3", "TODDLER"), ("ages_served", "Infants and Toddlers", "INFANT_TODDLER"),
    ("ages_served", "6 weeks to 5 years", "UNKNOWN"), ("ages_served", "5 - 12 yrs", "SCHOOL_AGE"), ("ages_served", "infant; preschool, school", "MIXED_AGES"),
    ("min_age", "30 months", 2), ("min_age", "6 weeks", 0), ("min_age", "5 - 12 yrs", 5), ("min_age", "none", None),
    ("capacity", "Licensed for 40 children", 40), ("capacity", "N/A", None), ("capacity", "0", 0),
    ("license_status", "DENIED", "REVOKED"), ("license_status", "", "UNKNOWN"), ("license_status", "inactive", "CLOSED"),
    ("license_type", " regular - 12", "REGULAR"), ("license_type", "odd", "OTHER"),
    ("facility_type", "CHILD CARE FAMILY - K820015716", "FAMILY_HOME"), ("facility_type", "school-age", "OTHER"),
    ("email", " A@B.Co ", "a@b.co"), ("email", "a@b", None),
    ("website_address", "https://www.Foo.com/", "https://foo.com"), ("website_address", "foo.com/en/25#top", None), ("website_address", "foo.com/?x=1", None),
    ("county", "los angeles COUNTY", "Los Angeles County"), ("boolean", "Yes", "true"), ("boolean", "off", "false"), ("boolean", "x", None),
]


def test_values(spark):
    for target in {c[0] for c in CASES}:
        rows = [(i, v) for i, (t, v, _) in enumerate(CASES) if t == target]
        got = spark.createDataFrame(rows, "i int, v string").select("i", N.NORMALIZERS[target](F.col("v")).alias("r")).collect()
        for r in got:
            assert r.r == CASES[r.i][2], CASES[r.i]


@pytest.mark.parametrize("name, first, last", [
    ("Dr. Jane Doe", "Dr", None), ("Smith, John", "Smith", None), ("Anne-Marie O'Brien", "Anne-Marie", "O'Brien"), ("Émile Zola", "Émile", "Zola"),
    ("Ünal, Émile", "Émile", "Ünal"), ("Émile Zola Jr.", "Émile", "Zola"), (None, None, None),
])
def test_names(spark, name, first, last):
    r = spark.createDataFrame([(name,)], "v string").select(N.name(F.col("v")).alias("n")).first().n
    assert (r.first_name, r.last_name) == (first, last)


@pytest.mark.parametrize("value, code", [("Texas", "TX"), ("Ohio", None), ("oh", "OH")])
def test_validator_state(spark, value, code):
    assert spark.createDataFrame([(value,)], "v string").select(V.state(F.col("v")).alias("s")).first().s.value == code


def test_validators(spark):
    r = spark.createDataFrame([("1 212 555 0790", "123456789", "12345-6789")], "p string, a string, b string")
    r = r.select(V.phone(F.col("p")).alias("p"), V.zip_code(F.col("a")).alias("a"), V.zip_code(F.col("b")).alias("b")).first()
    assert (r.p.formatted, r.a.valid, r.b.value) == ("(212) 555-0790", False, "12345")


def test_no_python_in_plans(spark):
    df = spark.createDataFrame([("x",)], "v string")
    plan = df.select(*[f(F.col("v")).alias(n) for n, f in N.NORMALIZERS.items()])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_registered(spark):
    N.register("shout", lambda c: F.upper(c))
    r = spark.createDataFrame([("a",), (None,)], "v string").select(N.detail("shout", F.col("v")).alias("d")).collect()
    assert (r[0].d.value, r[0].d.valid, r[1].d.error) == ("A", True, "empty_value")
    del N.NORMALIZERS["shout"]

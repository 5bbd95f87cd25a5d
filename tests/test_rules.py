import re

import pytest
from pyspark.sql import functions as F

from brightsieve.operators import rules as R


def model(rule: R.Rule, v):
    """One rule over one value, by Python's re."""
    if rule.regex is not None:
        if v is None or not v.strip():
            v = ""
        else:
            m = re.search(rule.regex, v, re.I)
            v = "" if m is None else ((m.expand(rule.format) if rule.format else m.group(1) if m.re.groups else m.group(0)) or "").strip() or None
    if rule.condition is not None:
        ok = v is not None and v.strip() and re.search(rule.condition, v, re.I)
        v = (str(rule.value) if rule.value is not None else v) if ok else None
    if rule.mapping is not None:
        v = {str(k).strip().lower(): str(x) for k, x in rule.mapping.items()}.get(v.strip().lower()) if v is not None else None
    return str(rule.value) if rule.value is not None and rule.condition is None else v


VALUES = ["Type A - 12", " licensed ", "", None, "ÉCOLE 7", "no match", "K8200 - open", "a-b", "12", "straße"]
RULES = [
    dict(regex=r"(\d+)"), dict(regex=r"[a-z]+"), dict(regex=r"(?P<word>\w+)\s*-\s*(\w+)", format=r"\g<2>/\g<word>"), dict(regex=r"(x)?a", format=r"<\1>"), dict(regex=r"(zz)?a"),
    dict(condition=r"^type|é"), dict(condition=r"\d", value=5), dict(mapping={"Licensed": "yes", " LICENSED": "YES", "12": 12}), dict(value=True),
    dict(regex=r"(\w+)", mapping={"type": "T", "licensed": "L"}), dict(regex=r"(\w+)", condition="^k", value="K"), dict(regex=r"(\d+)", condition=r"^1", mapping={"12": "dozen"}),
    dict(regex=r"\Aa.b\Z"),
]


def test_rules_follow_the_model(spark):
    df = spark.createDataFrame(list(enumerate(VALUES)), "i int, v string")
    made = [R.Rule(target_column="company", source_column="v", **r) for r in RULES]
    out = df.select("i", *[R.apply_rule(r, F.col("v"), R.SETTINGS).alias(f"r{k}") for k, r in enumerate(made)]).collect()
    for row in out:
        for k, r in enumerate(made):
            assert row[f"r{k}"] == model(r, VALUES[row.i]), (RULES[k], VALUES[row.i])


def test_untranslatable_patterns_use_python(spark):
    df = spark.createDataFrame([("aXb",), (None,)], "v string")
    assert [r[0] for r in df.select(R.regex(F.col("v"), r"(a)?(?(1)X|y)")).collect()] == ["a", ""]


@pytest.mark.parametrize("bad", [
    dict(target_column="a"), dict(target_column="", value=1), dict(target_column="a", mapping={}), dict(target_column="a", mapping={"x": None}),
    dict(target_column="a", format="x"), dict(target_column="a", regex="("), dict(target_column="a", regex="a", format=r"\3"),
])
def test_invalid_rules(bad):
    with pytest.raises((ValueError, re.error, IndexError)):
        R.Rule(**bad)


def test_invalid_schemas():
    for kw in (dict(settings={"odd": True}), dict(settings={"case_sensitive": 1}), dict(confidence=2), dict(transformations={"a": {"target_column": "x", "value": 1}})):
        with pytest.raises(ValueError):
            R.Schema(**kw)


def test_projection(spark):
    df = spark.createDataFrame([("Jane Doe", "3 to 5", " 7 ", "a@b.c")], "Contact string, AGES string, City string, mail string")
    schema = R.Schema({"first_name": "contact", "min_age": "ages", "city": "city", "email": "mail"}, {"e": {"target_column": "email", "regex": "nothing"}})
    r = R.transform(df, schema).first()
    assert (r.first_name, r.min_age, r.city, r.email, r.county) == ("Jane", 3, "7", "", None)
    assert R.transform(df, schema, overlay="first_wins").first().email == "a@b.c"
    assert R.transform(df, schema, strict=True).first().city is None


def test_defaults_lie_under_the_schema(tmp_path):
    p = tmp_path / "rules.yaml"
    p.write_text("transformations:\n  a: {target_column: email, regex: x}\n  b: {target_column: city, source_column: town, value: v}\n  c: {target_column: zip, value: 1}\nsettings: {case_sensitive: true, trim_whitespace: false}\n")
    own = R.Schema({"email": "mail"}, {"a": {"target_column": "email", "regex": "own"}, "d": {"target_column": "email", "condition": "q"}}, {"case_sensitive": False})
    got = R.overlaid(own, R.load_rules(str(p)))
    assert {k: r.regex or r.value or r.condition for k, r in got.transformations.items()} == {"a": "own", "b": "v", "d": "q"} and list(got.transformations) == ["a", "b", "d"]
    assert got.settings == {"case_sensitive": False, "trim_whitespace": False} and R.overlaid(own, None) is own

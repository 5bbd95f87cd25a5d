"""The rule engine: declarative rules per target column, compiled to one ``Column`` each.

A rule runs regex, condition, mapping and value in this order over its source;
rules of a target overlay each other, later ones first ("last_wins"), or the
other way round ("first_wins"). The result is one projection, so that Catalyst
prunes columns and generates code for all rules together.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.functions import normalize
from brightsieve.functions.text import UntranslatableRegex, groups, java_regex, present, strip, template_parts
from brightsieve.functions.vocab import INTEGER_TARGETS, TARGETS

log = logging.getLogger(__name__)
SETTINGS = {"case_sensitive": False, "skip_empty_values": True, "log_unmatched_rules": True, "trim_whitespace": True, "normalize_case": False}


@dataclass
class Rule:
    target_column: str
    source_column: str | None = None
    regex: str | None = None
    format: str | None = None
    condition: str | None = None
    value: str | int | float | bool | None = None
    mapping: dict | None = None
    description: str | None = None

    def __post_init__(self):
        if not str(self.target_column or "").strip():
            raise ValueError("a rule needs a target_column")
        if self.mapping is not None and not self.mapping:
            raise ValueError("a mapping can't be empty")
        if self.mapping and any(v is None for v in self.mapping.values()):
            raise ValueError("a mapping can't give null")
        if self.format and not self.regex:
            raise ValueError("a format needs a regex")
        if not any(x is not None for x in (self.regex, self.condition, self.mapping, self.value)):
            raise ValueError("a rule needs a regex, condition, mapping or value")
        for pattern in (self.regex, self.condition):
            if pattern is not None:
                re.compile(pattern)
        if self.format:
            template_parts(self.format, self.regex)


@dataclass
class Schema:
    """A mapping of target to source columns, rules by name, settings and a confidence."""

    mappings: dict[str, str] = field(default_factory=dict)
    transformations: dict[str, Rule] = field(default_factory=dict)
    settings: dict[str, bool] = field(default_factory=dict)
    confidence: float = 0.0

    def __post_init__(self):
        self.transformations = {k: r if isinstance(r, Rule) else Rule(**r) for k, r in self.transformations.items()}
        if unknown := set(self.settings) - set(SETTINGS):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        if any(not isinstance(v, bool) for v in self.settings.values()):
            raise ValueError("settings are true or false")
        if not 0 <= self.confidence <= 1:
            raise ValueError("the confidence lies between 0 and 1")
        for name, rule in self.transformations.items():
            if rule.target_column not in self.mappings and not rule.source_column:
                raise ValueError(f"{name}: its target is not mapped and it has no source")


def find_column(columns: list[str], wanted: str | None) -> str | None:
    """The column of that name, else the first that differs in case only."""
    if wanted is None or wanted in columns:
        return wanted
    return next((c for c in columns if c.lower() == wanted.lower()), None)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _python_regex(pattern: str, template: str | None, case_sensitive: bool):
    """The fallback for patterns without a Java equivalent: an Arrow pandas UDF."""
    flags = 0 if case_sensitive else re.IGNORECASE

    @F.pandas_udf("string")
    def found(values: pd.Series) -> pd.Series:
        compiled = re.compile(pattern, flags)

        def one(v):
            m = None if v is None else compiled.search(v)
            if m is None:
                return ""
            return ((m.expand(template) if template else m.group(1) if compiled.groups else m.group(0)) or "").strip() or None

        return values.map(one, na_action=None)

    return found


def regex(c: Column, pattern: str, template: str | None = None, case_sensitive: bool = False, skip_empty: bool = True) -> Column:
    """Group 1 (else the match), or the filled template; empty if nothing matches, null if the group is empty."""
    blank = c.isNull() | (strip(c) == "") if skip_empty else c.isNull()
    try:
        java = java_regex(pattern, not case_sensitive)
    except UntranslatableRegex:
        return F.when(blank, "").otherwise(_python_regex(pattern, template, case_sensitive)(c))
    if template:
        parts = [F.lit(p) if isinstance(p, str) else F.regexp_extract(c, java, p) for p in template_parts(template, pattern)]
        got = F.concat(*parts) if parts else F.lit("")
    else:
        got = F.regexp_extract(c, java, 1 if groups(pattern) else 0)
    return F.when(blank, "").when(~c.rlike(java), "").otherwise(F.nullif(strip(got), F.lit("")))


def condition(c: Column, pattern: str, value=None, case_sensitive: bool = False) -> Column:
    """The input, or a constant, where the pattern is found."""
    try:
        hit = c.rlike(java_regex(pattern, not case_sensitive))
    except UntranslatableRegex:
        hit = _python_regex(f"({pattern})|\\Z", None, case_sensitive)(c).isNotNull()
    return F.when((strip(c) != "") & hit, c if value is None else F.lit(_text(value)))


def _text(value) -> str:
    return str(value)


def mapped(c: Column, table: dict, case_sensitive: bool = False) -> Column:
    """The table's value for the stripped key; of keys that differ in case only the last counts."""
    keys: dict[str, str] = {}
    for k, v in table.items():
        k = str(k).strip()
        keys[k if case_sensitive else k.lower()] = _text(v)
    key = strip(c) if case_sensitive else F.lower(strip(c))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in keys.items() for x in kv]), key)


def apply_rule(rule: Rule, c: Column, settings: dict) -> Column:
    """The steps of one rule over its source."""
    sensitive, skip = settings["case_sensitive"], settings["skip_empty_values"]
    if rule.regex is not None:
        c = regex(c, rule.regex, rule.format, sensitive, skip)
    if rule.condition is not None:
        c = condition(c, rule.condition, rule.value, sensitive)
    if rule.mapping is not None:
        c = mapped(c, rule.mapping, sensitive)
    if rule.value is not None and rule.condition is None:
        c = F.lit(_text(rule.value))
    return c


def overlaid(own: Schema, defaults: Schema | None) -> Schema:
    """``own`` over ``defaults``: rules and settings of one name are the schema's, the others stay, defaults first.

    A default rule without a source whose target the schema doesn't map has nothing to work on and is left out.
    """
    if defaults is None:
        return own
    usable = {k: r for k, r in defaults.transformations.items() if r.source_column or r.target_column in own.mappings}
    return Schema(dict(own.mappings), usable | own.transformations, defaults.settings | own.settings, own.confidence)


def load_rules(path: str) -> Schema:
    """A YAML file of default ``transformations`` and ``settings``; rules without a source apply where their target is mapped."""
    with open(path) as f:
        data = yaml.safe_load(f) or {}
    rules = {k: Rule(**r) for k, r in (data.get("transformations") or {}).items()}
    return Schema({r.target_column: "" for r in rules.values()}, rules, data.get("settings") or {})


#: Targets that a composite parser fills where no rule does.
PARSED = ("first_name", "last_name", "min_age", "max_age", "ages_served", "license_type", "facility_type", "address1", "address2", "city")


def compile_target(target: str, schema: Schema, columns: list[str], overlay: str = "last_wins", apply_normalizers: bool = False, strict: bool = False) -> Column:
    """The expression of one target column over a source with ``columns``."""
    settings = SETTINGS | schema.settings
    source = find_column(columns, schema.mappings.get(target))
    base = _quoted(source).cast("string") if source else None
    rules = [(n, r) for n, r in schema.transformations.items() if r.target_column == target]
    layers: list[Column] = []
    for name, rule in rules:
        own = find_column(columns, rule.source_column) or source
        c = _quoted(own).cast("string") if own else base if base is not None else layers[-1] if layers else None
        if c is None:
            if rule.value is None or rule.condition is not None:
                log.warning("rule %s has no source column and is left out", name)
                continue
            c = F.lit(None).cast("string")
        try:
            layers.append(apply_rule(rule, c, settings))
        except (re.error, IndexError, KeyError, ValueError) as e:
            log.warning("rule %s is left out: %s", name, e)
    out = base if base is not None else F.lit(None).cast("string")
    if layers:
        # first_wins: later rules, and the source itself, only fill what is empty
        ranked = layers[::-1] if overlay == "last_wins" else [F.nullif(x, F.lit("")) for x in layers]
        out = F.coalesce(*ranked, out)
    elif base is not None and not rules and target in PARSED:
        if target in ("address2", "city"):
            out = F.lit(None).cast("string") if strict else strip(base)
        else:
            parse = normalize.NORMALIZERS[target]
            out = F.when(present(base), parse(base))
    if apply_normalizers and target in normalize.NORMALIZERS and target not in PARSED:
        out = normalize.NORMALIZERS[target](out.cast("string"))
    return out.try_cast("int") if target in INTEGER_TARGETS else out.cast("string")


def transform(df: DataFrame, schema: Schema, targets: list[str] | None = None, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """The canonical projection, one select; ``keep`` passes columns through."""
    columns = [c for c in df.columns if c not in keep]
    return df.select(*[compile_target(t, schema, columns, **options).alias(t) for t in targets or TARGETS], *keep)

"""Text helpers with Python's semantics, as Catalyst expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Both ends without any Unicode white space (``trim`` takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Neither null nor empty: what the specification treats as a value."""
    return c.isNotNull() & (c != "")


def title(c: Column) -> Column:
    """``str.title``: a letter is upper case where no letter precedes it (``initcap`` looks at blanks only)."""
    chars = F.split(c, "")
    told = F.transform(
        F.sequence(F.lit(0), F.size(chars) - 1),
        lambda i: F.when((i > 0) & F.get(chars, i - 1).rlike(r"\p{L}"), F.lower(F.get(chars, i))).otherwise(F.upper(F.get(chars, i))),
    )
    return F.array_join(told, "")


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The table's value for ``c``, null where it has none."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


class UntranslatableRegex(ValueError):
    """The pattern has a construct without a Java equivalent."""


_FLAGS = re.compile(r"^\(\?([aiLmsux]+)\)")


def java_regex(pattern: str, ignore_case: bool = True) -> str:
    """A Python pattern in Java's dialect: Unicode classes and case, named groups, end of text."""
    re.compile(pattern)
    if re.search(r"\(\?\(|\(\?P>|\\[gX]", pattern):
        raise UntranslatableRegex(pattern)
    out = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{m[1].replace('_', 'x')}>", pattern)
    out = re.sub(r"\(\?P=(\w+)\)", lambda m: rf"\\k<{m[1].replace('_', 'x')}>", out)
    out = re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", out)
    inline = _FLAGS.match(out)
    flags = ("iu" if ignore_case else "") + "U"
    if inline:
        out = out[inline.end() :]
        flags += "".join(f for f in inline[1] if f in "msx" or f == "i" and "i" not in flags)
    return f"(?{flags}){out}"


def groups(pattern: str) -> int:
    return re.compile(pattern).groups


def template_parts(template: str, pattern: str) -> list[str | int]:
    """A replacement template (``\\1``, ``\\g<1>``, ``\\g<name>``) as literals and group numbers."""
    names = re.compile(pattern).groupindex
    parts: list[str | int] = []
    at = 0
    for m in re.finditer(r"\\g<(\w+)>|\\(\d{1,2})|\\(.)", template):
        if m.start() > at:
            parts.append(template[at : m.start()])
        key = m[1] or m[2]
        if key is None:
            parts.append({"n": "\n", "t": "\t", "r": "\r"}.get(m[3], m[3] if m[3] == "\\" else m[0]))
        else:
            number = int(key) if key.isdigit() else names[key]
            if number > groups(pattern):
                raise IndexError(f"no group {number} in {pattern}")
            parts.append(number)
        at = m.end()
    if at < len(template):
        parts.append(template[at:])
    return parts

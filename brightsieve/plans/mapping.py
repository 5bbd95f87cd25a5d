"""Schema mapping on the driver: fingerprints, fallback mapping, model replies, the cache."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import re
import time
from typing import Protocol

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.functions.vocab import COLUMN_PATTERNS, TARGETS
from brightsieve.operators.rules import Rule, Schema, overlaid
from brightsieve.sources.files import SourceConfig

log = logging.getLogger(__name__)


def fingerprint(columns: list[str]) -> str:
    """The identity of a set of column names."""
    return hashlib.sha256("|".join(sorted(c.strip().lower() for c in columns)).encode()).hexdigest()[:16]


def fingerprint_column(names: Column) -> Column:
    """P3 over an array column of names."""
    return F.left(F.sha2(F.array_join(F.array_sort(F.transform(names, lambda c: F.lower(F.trim(c)))), "|"), 256), F.lit(16))


def fallback(columns: list[str], targets: list[str] = TARGETS, patterns: dict[str, list[str]] = COLUMN_PATTERNS) -> tuple[dict[str, str], float]:
    """Equal names, then patterns, then parts of names; and the share of targets mapped."""
    lower = {c: c.lower().strip() for c in columns}
    found: dict[str, str] = {}
    for t in targets:
        same = next((c for c in columns if lower[c] == t.lower()), None)
        if same:
            found[t] = same
    for t in (t for t in targets if t not in found):
        hit = next((c for p in patterns.get(t, ()) for c in columns if p.lower() in lower[c] or lower[c] in p.lower()), None)
        if hit:
            found[t] = hit
    for t in (t for t in targets if t not in found):
        hit = next((c for c in columns if any(len(p) > 3 and p in lower[c] for p in t.split("_"))), None)
        if hit:
            found[t] = hit
    return found, len(found) / len(targets)


class Client(Protocol):
    """L1, F2: whatever completes a prompt."""

    def complete(self, prompt: str) -> str: ...


class OfflineClient:
    """L2: answers without a model."""

    def complete(self, prompt: str) -> str:
        if "mappings" in prompt:
            return '{"mappings": {}, "transformations": {}, "confidence": 0.0}'
        if "is_same" in prompt:
            return "[]"
        return '[{"category": "Other", "confidence": 0.5}]' if "category" in prompt else "{}"


class CachedClient:
    """L1, L4: a cap on calls, a cache that ages, and retries around a client."""

    def __init__(self, client: Client, calls: int = 100, hours: float = 24, retries: int = 3, sleep=time.sleep):
        self.client, self.most, self.ttl, self.retries, self.sleep = client, calls, hours * 3600, retries, sleep
        self.calls, self.hits, self.held = 0, 0, {}

    def complete(self, prompt: str) -> str:
        key = hashlib.sha256(prompt.encode()).hexdigest()[:32]
        if key in self.held and time.time() - self.held[key][0] < self.ttl:
            self.hits += 1
            return self.held[key][1]
        if self.calls >= self.most:
            return OfflineClient().complete(prompt)
        self.calls += 1
        for attempt in range(self.retries):
            try:
                answer = self.client.complete(prompt)
                self.held[key] = (time.time(), answer)
                return answer
            except Exception:
                if attempt + 1 < self.retries:
                    self.sleep(2**attempt)
        return OfflineClient().complete(prompt)

    def batch(self, prompts: list[str]) -> list[str]:
        return [self.complete(p) for p in prompts]

    def clear(self) -> None:
        self.held.clear()

    def usage(self) -> dict:
        return {"calls": self.calls, "max_calls": self.most, "cache_size": len(self.held), "cache_hits": self.hits}


_SHARED: list[CachedClient] = []


def shared_client(client: Client | None = None, **options) -> CachedClient:
    """L4: one client for the whole driver; what is given after the first call is ignored until ``forget_shared_client``."""
    if not _SHARED:
        _SHARED.append(CachedClient(client or OfflineClient(), **options))
    return _SHARED[0]


def forget_shared_client() -> None:
    _SHARED.clear()


def extract_json(text: str) -> str:
    """The first balanced object, without code fences; braces inside strings don't count."""
    text = re.sub(r"```(?:json)?", "", text)
    start = text.find("{")
    if start < 0:
        raise ValueError("no JSON object")
    decoder_depth, inside, escaped = 0, False, False
    for i, ch in enumerate(text[start:], start):
        if inside:
            inside, escaped = (inside if escaped or ch != '"' else False), (ch == "\\" and not escaped)
        elif ch == '"':
            inside = True
        elif ch in "{}":
            decoder_depth += 1 if ch == "{" else -1
            if not decoder_depth:
                return text[start : i + 1]
    return text[start:]


def sanitize_json(text: str) -> str:
    """Comments and trailing commas go, stray backslashes are doubled; strings stay as they are."""
    out, at = [], 0
    for m in re.finditer(r'"(?:[^"\\]|\\.)*"', text, re.S):
        out += [_outside(text[at : m.start()]), re.sub(r'\\(?!["\\/bfnrtu])', r"\\\\", m[0])]
        at = m.end()
    joined = "".join([*out, _outside(text[at:])])
    return re.sub(r",(\s*[}\]])", r"\1", joined).strip()


def _outside(part: str) -> str:
    part = re.sub(r"//[^\n]*|/\*.*?\*/", "", part, flags=re.S)
    return re.sub(r",(\s*[}\]])", r"\1", part)


def error_context(text: str, error: json.JSONDecodeError, around: int = 3) -> str:
    """Where a reply can't be read: the position, and the lines about it with a pointer."""
    lines, row = text.split("\n"), error.lineno - 1
    told = [f"{error.msg}: line {error.lineno}, column {error.colno} (character {error.pos})"]
    for i in range(max(0, row - around), min(len(lines), row + around + 1)):
        told.append(f"{'>' if i == row else ' '} {i + 1:4d} | {lines[i]}")
        if i == row:
            told.append(" " * (9 + error.colno - 1) + "^")
    return "\n".join(told)


def parse_reply(text: str) -> Schema:
    """A reply as a validated schema."""
    body = extract_json(text)
    try:
        data = json.loads(body)
    except ValueError:
        body = sanitize_json(body)
        try:
            data = json.loads(body)
        except json.JSONDecodeError as e:
            log.warning("a reply can't be read: %s", error_context(body, e))
            raise
    if not isinstance(data.get("mappings"), dict) or not isinstance(data.get("transformations", {}), dict):
        raise ValueError("mappings and transformations are objects")
    return Schema(data["mappings"], data.get("transformations", {}), data.get("settings", {}), float(data.get("confidence", 0.0)))


def prompt(df: DataFrame, attempt: int = 1, rows: int = 5) -> str:
    """The columns and a few rows; stricter words when asked again."""
    sample = [{k: v.isoformat() if hasattr(v, "isoformat") else v.decode("utf-8", "replace") if isinstance(v, (bytes, bytearray)) else v for k, v in r.asDict().items()} for r in df.limit(rows).collect()]
    again = "" if attempt == 1 else "\nThe last reply could not be read. Reply with one JSON object only: no comments, no fences, no trailing commas."
    return f"Map the source columns to the target columns. Reply as JSON with mappings, transformations, settings, confidence.\nTargets: {json.dumps(TARGETS)}\nSources: {json.dumps(df.dtypes)}\nRows: {json.dumps(sample, default=str)}{again}"


def generate(df: DataFrame, client: Client | None = None, attempts: int = 3, patterns: dict[str, list[str]] | None = None) -> tuple[Schema, str]:
    """G1: a schema and its origin; the fallback mapping where no reply can be used."""
    for attempt in range(1, attempts + 1) if client else ():
        try:
            schema = parse_reply(client.complete(prompt(df, attempt)))
            if schema.mappings:
                return schema, "llm"
        except (ValueError, KeyError, TypeError):
            continue
    found, share = fallback(df.columns, patterns=patterns or COLUMN_PATTERNS)
    return Schema(found, {}, {}, share), "fallback"


class SchemaCache:
    """A YAML document per fingerprint; entries say whether a model or the fallback made them."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    def _path(self, key: str) -> str:
        return os.path.join(self.folder, f"schema_{key}.yaml")

    def get(self, columns: list[str]) -> tuple[Schema, str] | None:
        path = self._path(fingerprint(columns))
        if not os.path.exists(path):
            return None
        with open(path) as f:
            doc = yaml.safe_load(f)
        return Schema(doc["mapping"], doc["transformations"], doc["settings"], doc["metadata"]["confidence"]), doc["metadata"].get("origin", "llm")

    def save(self, columns: list[str], schema: Schema, origin: str) -> None:
        key = fingerprint(columns)
        rules = {k: {a: b for a, b in r.__dict__.items() if b is not None} for k, r in schema.transformations.items()}
        doc = {
            "metadata": {"schema_fingerprint": key, "created_at": time.strftime("%Y-%m-%dT%H:%M:%S"), "source_columns": list(columns), "confidence": schema.confidence, "num_mappings": len(schema.mappings), "num_transformations": len(rules), "origin": origin},
            "mapping": dict(schema.mappings), "transformations": rules, "settings": dict(schema.settings),
        }
        with open(self._path(key), "w") as f:
            yaml.safe_dump(doc, f, sort_keys=False)

    def invalidate(self, columns: list[str]) -> bool:
        path = self._path(fingerprint(columns))
        if os.path.exists(path):
            os.remove(path)
            return True
        return False

    def keys(self) -> list[str]:
        return sorted(n[7:-5] for n in os.listdir(self.folder) if n.startswith("schema_") and n.endswith(".yaml"))

    def clear(self) -> int:
        keys = self.keys()
        for k in keys:
            os.remove(self._path(k))
        return len(keys)

    def stats(self) -> dict:
        return {"entries": len(self.keys()), "folder": self.folder}


def configured(schema: Schema, source: SourceConfig | None) -> Schema:
    """``schema`` with what the registry says of the source: its column map, and its rules (by name, or in lists by target)."""
    if source is None or source.name == "default":
        return schema
    rules = {}
    for name, told in source.transformations.items():
        for i, rule in enumerate(told if isinstance(told, list) else [told]):
            rules[f"{name}_{i}" if isinstance(told, list) else name] = Rule(**({"target_column": name} | rule if isinstance(told, list) else rule))
    mappings = dict(schema.mappings) | dict(source.column_map)
    rules = {k: r for k, r in rules.items() if r.source_column or r.target_column in mappings}
    return Schema(mappings, schema.transformations | rules, schema.settings, schema.confidence)


def schema_for(df: DataFrame, cache: SchemaCache | None = None, client: Client | None = None, source: SourceConfig | None = None, defaults: Schema | None = None) -> Schema:
    """From the cache, else generated and kept; a fallback entry is made anew once there is a client.

    What the registry says of the source lies over it, and it over the default rules (R9).
    """
    held = cache.get(df.columns) if cache else None
    if held and (held[1] == "llm" or client is None):
        schema = held[0]
    else:
        schema, origin = generate(df, client, patterns=source.column_map if source and source.name == "default" else None)
        if cache:
            cache.save(df.columns, schema, origin)
    return overlaid(configured(schema, source), defaults)

import random

import pytest
from pyspark.sql import functions as F

from brightsieve.llm import url_rules as U


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]
    fits = [(len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[1] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.com/en/1?x#y", "https://www.example.com/en/", "http://x.net/es", "http://x.net/es/a", "http://net/fr/?q", "http://COM",
    "http://com/", "http://a.b.c.d.e.com/x", "http://example.com?/en/", "http://example.com:80/en/", "x://É.com/é://", "http://notexample.com/en/", "a://b://c/", "http://" + "s." * 3000 + "com/" + "p/" * 5000,
]


@pytest.fixture
def pages(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(4, URLS[4], "h", "r"), (None, URLS[5], None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string")


def judged(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_brute_force(spark, pages, monkeypatch, broadcast):
    rng = random.Random(1)
    rules = [*U.RULES, ("e.com", "", "block"), ("example.com", "/en/", "allow")]
    rules += [(f"h{rng.randrange(9)}.net", "/" + "p/" * rng.randrange(3), rng.choice(["allow", "block"])) for _ in range(30)]
    if not broadcast:
        monkeypatch.setattr(U, "BROADCAST_RULES", 2)
    table = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    want = sorted(((r.page_id, *brute(r.url, rules)) for r in pages.collect()), key=str)
    assert judged(U.filter_urls(pages, table)) == want


def test_empty(spark, pages):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in U.filter_urls(pages, none, default="block").collect()} == {"block"}
    assert U.filter_urls(pages.where(F.lit(False)), none).count() == 0

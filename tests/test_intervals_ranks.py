"""Interval joins against all pairs, and exact percentiles against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from brightsieve.operators import intervals, ranks
from brightsieve.plans import catalogue


def pairs(a, b, keyed, contains):
    out = []
    for i, k, s, e in a:
        for j, m, t, f in b:
            if None in (s, e, t, f) or s > e or t > f or keyed and (k is None or k != m):
                continue
            if contains and s <= t and f <= e or not contains and s <= f and t <= e:
                out.append((i, j))
    return sorted(out)


def made(rng, n):
    rows = []
    for i in range(n):
        s = rng.randint(-3_000, 3_000)
        size = rng.choice([0, 0, 1, 2, 3, 7, 8, 9, 100, 1_000, 1 << 40])
        rows.append((i, rng.choice(["a", "a", "a", "b", None]), s, s + rng.randint(0, size)))
    return rows + [(n, "a", None, 3), (n + 1, "a", 5, None), (n + 2, "a", 5, 4), (n + 3, "a", -(1 << 62), 1 << 62), (n + 4, "b", 0, 0), (n + 4, "b", 0, 0)]


@pytest.mark.parametrize("long", [50_000, 3])
def test_all_pairs(spark, monkeypatch, long):
    monkeypatch.setattr(intervals, "LONG", long)
    rng = random.Random(long)
    a, b = made(rng, 120), made(rng, 90)
    left, right = (spark.createDataFrame(x, "id int, k string, s long, e long") for x in (a, b))
    for keyed, contains in ((True, False), (False, False), (True, True), (False, True)):
        got = intervals.overlap_join(left, right, ("s", "e"), keys=["k"] if keyed else None, contains=contains)
        assert sorted((r.l.id, r.r.id) for r in got.collect()) == pairs(a, b, keyed, contains)


def test_other_names_points_and_empty_sides(spark):
    left = spark.createDataFrame([(1, 10, 20), (2, 15, 15)], "id int, s int, e int")
    points = spark.createDataFrame([(7, 15, "l"), (8, 21, "__bin")], "p int, at int, r string")
    got = intervals.overlap_join(left, points, ("s", "e"), ("at", "at"))
    assert sorted((r.l.id, r.r.p, r.r.r) for r in got.collect()) == [(1, 7, "l"), (2, 7, "l")]
    for a, b in ((left.limit(0), points), (left, points.where("false"))):
        none = intervals.overlap_join(a, b, ("s", "e"), ("at", "at"))
        assert none.count() == 0 and none.columns == ["l", "r"]


def test_no_side_is_compared_with_all_of_the_other(spark):
    """20,000 short intervals and one that covers them: no operator makes more than a few rows for each."""
    rows = spark.range(20_000).selectExpr("id", "id * 10 AS s", "IF(id = 0, 1000000, id * 10 + 5) AS e")
    got = intervals.overlap_join(rows, rows, ("s", "e"))
    assert got.count() == 3 * 20_000 - 2
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_counts_are_those_of_the_join(spark):
    rng = random.Random(5)
    a, b = made(rng, 150), made(rng, 110)
    left, right = (spark.createDataFrame(x, "id int, k string, s long, e long") for x in (a, b))
    for keyed in (True, False):
        got = intervals.overlap_counts(left, right, ("s", "e"), keys=["k"] if keyed else None).collect()
        rows = [r[0] for r in pairs(a, b, keyed, False)]
        times = {i: sum(r[0] == i for r in a) for i in set(rows)}
        assert sorted((r.l.id, r.n) for r in got) == sorted((r[0], rows.count(r[0]) // times[r[0]]) for r in a if r[0] in times)
    assert intervals.overlap_counts(left, right.limit(0), ("s", "e")).count() == 0


def test_the_query_counts_without_pairs(spark, tmp_path):
    """200,000 prices, the same but for two: 4e10 pairs, which no plan may make."""
    parts = spark.range(200_000).selectExpr("id AS p_partkey", "CASE WHEN id = 2 THEN 500.0D ELSE 900.0D END AS p_retailprice", "CAST(id % 50 AS INT) AS p_size")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r.n for r in catalogue.rel_interval_one_long(spark, str(tmp_path)).collect()}
    assert len(got) == 200_000 and got[1] == 200_000 and got[2] == 2 and got[0] == got[7] == 199_999


def percentile(values, share):
    held = sorted(values, key=lambda v: (math.isnan(v), v))
    p = (len(held) - 1) * share
    a, b = held[math.floor(p)], held[math.ceil(p)]
    return a if a == b else (math.ceil(p) - p) * a + (p - math.floor(p)) * b


@pytest.mark.parametrize("few,accuracy", [(200_000, 10_000), (50, 100), (20, 20)])
def test_percentiles(spark, monkeypatch, few, accuracy):
    monkeypatch.setattr(ranks, "FEW", few)
    monkeypatch.setattr(ranks, "ACCURACY", accuracy)
    rng = random.Random(few)
    columns = {
        "x": [rng.gauss(0, 1e6) for _ in range(3_000)],
        "ties": [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(3_000)],
        "odd": [rng.choice([0.0, -1e300, 1e300, math.inf, -math.inf, rng.random()]) for _ in range(3_000)],
        "skew": [10.0 ** rng.randint(-20, 20) for _ in range(3_000)],
    }
    df = spark.createDataFrame([*map(tuple, zip(*columns.values()))], ", ".join(f"{c} double" for c in columns)).withColumn("none", F.lit(None).cast("double"))
    shares = [0.0, 0.25, 0.5, 0.75, 1.0, 0.999]
    got = ranks.percentiles(df, [*columns, "none"], shares)
    for c, values in columns.items():
        for share, v in zip(shares, got[c]):
            want = percentile(values, share)
            assert v == want or math.isnan(want) and math.isnan(v), (c, share)
    assert got["none"] == [None] * 6


def test_nan_and_bad_ranks(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    got = ranks.values_at(df, {"x": [0, 1, 2]})
    assert (got["x", 0], got["x", 1]) == (1.0, 2.0) and math.isnan(got["x", 2])
    with pytest.raises(ValueError):
        ranks.values_at(df, {"x": [3]})
    assert ranks.percentiles(df, [], [0.5]) == {}

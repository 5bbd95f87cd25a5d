"""Exact order statistics without holding a column in one task.

A rank's value is looked for in a range of values that narrows: a sketch of what lies in the
range (``percentile_approx``, of bounded size) gives a narrower one, whose counts tell whether the rank
is in it, or is one of the ties at its ends. Once at most FEW values of a range are left, they
are counted as rows and the rank is found by running counts over
them. Every pass is one aggregation for all columns and ranks; only bounds and counts, a row of
them, reach the driver. As in Spark's own order, NaN comes after all numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a range that are counted value by value; the sketch's accuracy.
FEW, ACCURACY = 200_000, 10_000


def _narrowed(x: Column, low, high) -> Column:
    return (x >= F.lit(low)) & (x <= F.lit(high))


def values_at(df: DataFrame, ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values at ``ranks`` (from 0, below each column's number of values) of columns, as doubles, nulls left out."""
    every = {c: F.col(f"`{c}`").cast("double") for c in ranks}
    x = {c: F.when(~F.isnan(v), v) for c, v in every.items()}
    ends = df.agg(*[f(v[c]).alias(f"{n}{i}") for i, c in enumerate(ranks) for n, f, v in (("all", F.count, every), ("n", F.count, x), ("a", F.min, x), ("b", F.max, x))]).first()
    open_, found = {}, {}  # open: low, high, values below, values inside
    for i, c in enumerate(ranks):
        for r in ranks[c]:
            if not 0 <= r < ends[f"all{i}"]:
                raise ValueError(f"{c} has {ends[f'all{i}']} values, none at {r}")
            if r < ends[f"n{i}"]:
                open_[c, r] = (ends[f"a{i}"], ends[f"b{i}"], 0, ends[f"n{i}"])
            else:
                found[c, r] = math.nan
    while True:
        found |= {t: low for t, (low, high, _, _) in open_.items() if low == high}
        open_ = {t: v for t, v in open_.items() if t not in found}
        wide = {t: v for t, v in open_.items() if v[3] > FEW}
        if not wide:
            break
        shares = {t: [min(1.0, max(0.0, (t[1] - below) / n + d / ACCURACY)) for d in (-2, 2)] for t, (_, _, below, n) in wide.items()}
        told = df.agg(*[F.percentile_approx(F.when(_narrowed(x[t[0]], v[0], v[1]), x[t[0]]), shares[t], ACCURACY).alias(f"q{i}") for i, (t, v) in enumerate(wide.items())]).first()
        tried = {t: tuple(told[f"q{i}"]) for i, t in enumerate(wide)}
        parts = [(f"{n}{i}", F.count_if(f)) for i, (t, (low, high)) in enumerate(tried.items()) for n, f in (("b", x[t[0]] < F.lit(low)), ("l", x[t[0]] == F.lit(low)), ("h", x[t[0]] == F.lit(high)), ("i", _narrowed(x[t[0]], low, high)))]
        counts = df.agg(*[f.alias(n) for n, f in parts]).first()
        for i, (t, (low, high)) in enumerate(tried.items()):
            below, lowest, highest, inside = (counts[f"{n}{i}"] for n in "blhi")
            old = wide[t]
            if t[1] < below:  # the sketch has missed: what lies below its range is left
                open_[t] = (old[0], math.nextafter(low, -math.inf), old[2], below - old[2])
            elif t[1] >= below + inside:
                open_[t] = (math.nextafter(high, math.inf), old[1], below + inside, old[2] + old[3] - below - inside)
            elif t[1] < below + lowest or t[1] >= below + inside - highest:
                found[t] = low if t[1] < below + lowest else high
            else:  # ties at the ends don't keep a range wide
                open_[t] = (math.nextafter(low, math.inf), math.nextafter(high, -math.inf), below + lowest, inside - lowest - highest)
    if open_:
        targets = list(open_.items())
        rows = df.select(F.explode(F.array(*[F.when(_narrowed(x[t[0]], v[0], v[1]), F.struct(F.lit(i).alias("t"), x[t[0]].alias("x"))) for i, (t, v) in enumerate(targets)])).alias("s")).where("s is not null").select("s.*")
        upto = F.sum("n").over(W.partitionBy("t").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow))
        rank = F.element_at(F.array(*[F.lit(t[1] - v[2]).cast("long") for t, v in targets]), F.col("t") + 1)
        counted = rows.groupBy("t", "x").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto).withColumn("rank", rank)
        for r in counted.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).collect():
            found[targets[r.t][0]] = r.x
    return found


def percentiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """Exact percentiles of columns, interpolated between neighbouring ranks; None for columns without values."""
    if not columns:
        return {}
    n = df.agg(*[F.count(F.col(f"`{c}`").cast("double")).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    sizes = {c: n[f"n{i}"] for i, c in enumerate(columns)}
    places = {c: [(sizes[c] - 1) * s for s in shares] for c in columns if sizes[c]}
    found = values_at(df, {c: sorted({f(p) for p in ps for f in (math.floor, math.ceil)}) for c, ps in places.items()}) if places else {}

    def between(c, p):
        a, b = found[c, math.floor(p)], found[c, math.ceil(p)]
        return a if a == b else (math.ceil(p) - p) * a + (p - math.floor(p)) * b

    return {c: [between(c, p) for p in places[c]] if c in places else [None] * len(shares) for c in columns}

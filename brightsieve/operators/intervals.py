"""Joins of intervals of any length: overlap, containment, and points in ranges; how many each one meets.

An interval belongs to the level whose bins, 2^level wide, are the narrowest that are
not shorter than it, and so lies in two bins of its level at most. Of two intervals that overlap, the
shorter visits the bins of the longer one's level, two at most again: an equi-join by keys,
level and bin, in which the pair is taken in the first bin that both touch.
An interval visits only levels that the other side has, so that it is written a few times however long others are.

A level that few intervals have, long ones as a rule, is met by broadcast: LONG rows
over all such levels at most. So a bin of a very long interval, in which all others
meet it, is no task of its own. Bounds are whole numbers.

Where only the number of intervals met is asked, no pair is made: an interval meets all that begin
no later than it ends, but for those that end before it begins. Both are running sums over the bounds.

Defined cases: an interval with a null or reversed bound meets nothing; bounds belong to
it; null keys meet nothing; equal rows meet as often as they occur; an empty side gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightsieve.storage import written

#: Intervals of sparse levels that are broadcast at most.
LONG = 50_000


def _bin(bound: Column, level: Column) -> Column:
    return F.call_function("shiftright", bound, level)


def _side(df: DataFrame, keys: list[str], start: str, end: str, prefix: str) -> DataFrame:
    """``k0.. , __start, __end, __level, row`` of the intervals that can meet any."""
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(start).cast("long").alias("__start"), F.col(end).cast("long").alias("__end"), F.struct(*df.columns).alias(prefix))
    rows = rows.where((F.col("__start") <= F.col("__end")) & reduce(lambda a, b: a & b, [F.col(f"k{i}").isNotNull() for i in range(len(keys))], F.lit(True)))
    length = F.greatest(F.col("__end").cast("double") - F.col("__start").cast("double"), F.lit(1.0))
    # of long ones the logarithm can be one too low: the wider level is right as well
    level = F.ceil(F.log2(length)).cast("int") + F.when(length >= 2.0**45, 1).otherwise(0)
    return rows.withColumn("__level", F.least(level, F.lit(63)))


def _own(rows: DataFrame) -> DataFrame:
    """Each interval once for each bin of its level."""
    return rows.withColumn("__bin", F.explode(F.array_distinct(F.array(_bin(F.col("__start"), F.col("__level")), _bin(F.col("__end"), F.col("__level"))))))


def _visiting(rows: DataFrame, levels: list[int], own_too: bool) -> DataFrame:
    """Each interval once for each bin that it touches of ``levels``, which are above its own (or its own)."""
    up = F.filter(F.array(*[F.lit(v) for v in levels]).cast("array<int>"), lambda v: (v >= F.col("__level")) if own_too else (v > F.col("__level")))
    out = rows.withColumn("__at", F.explode(up)).drop("__level").withColumnRenamed("__at", "__level")
    return out.withColumn("__bin", F.explode(F.array_distinct(F.array(_bin(F.col("__start"), F.col("__level")), _bin(F.col("__end"), F.col("__level"))))))


def overlap_join(left: DataFrame, right: DataFrame, bounds: tuple[str, str], other: tuple[str, str] | None = None, keys: list[str] | None = None, contains: bool = False) -> DataFrame:
    """``l, r``: structs of the rows whose intervals overlap (with ``contains``: the left one holds the right one), with equal ``keys``.

    ``bounds`` names the left side's first and last value, ``other`` the right side's (the same by default).
    """
    keys = keys or []
    sides = [_side(left, keys, *bounds, "l"), _side(right, keys, *(other or bounds), "r")]
    counts = [{r["__level"]: r["n"] for r in s.groupBy("__level").agg(F.count(F.lit(1)).alias("n")).collect()} for s in sides]  # 63 levels at most
    out = []
    for k, own_too in ((1, True), (0, False)):  # the right side is as long or longer, then the left side is longer
        long, short = sides[k], sides[1 - k]
        few, room = [], LONG
        for level, n in sorted(counts[k].items(), key=lambda x: x[1]):
            if n <= room:
                few.append(level)
                room -= n
        for levels, sparse in ((few, True), ([v for v in counts[k] if v not in few], False)):
            if not levels or not counts[1 - k]:
                continue
            held = _own(long.where(F.col("__level").isin(levels)))
            names = [c for c in held.columns if c not in ("l", "r")]
            held = held.select(*[F.col(c).alias(f"o{c}") for c in names], "r" if k else "l")
            seen = _visiting(short, levels, own_too)
            met = seen.join(F.broadcast(held) if sparse else held, [F.col(c) == F.col(f"o{c}") for c in names if c not in ("__start", "__end")])
            first = F.greatest(_bin(F.col("__start"), F.col("__level")), _bin(F.col("o__start"), F.col("__level")))
            met = met.where((F.col("__bin") == first) & (F.col("__start") <= F.col("o__end")) & (F.col("o__start") <= F.col("__end")))
            if contains:
                a, b = ("", "o") if k else ("o", "")  # the left side's and the right side's bounds
                met = met.where((F.col(f"{a}__start") <= F.col(f"{b}__start")) & (F.col(f"{b}__end") <= F.col(f"{a}__end")))
            out.append(met.select("l", "r"))
    if not out:
        return left.select(F.struct(*left.columns).alias("l")).where("false").crossJoin(right.select(F.struct(*right.columns).alias("r")).where("false"))
    return reduce(DataFrame.unionByName, out)


def overlap_counts(left: DataFrame, right: DataFrame, bounds: tuple[str, str], other: tuple[str, str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """``l, n``: the left side's rows that ``overlap_join`` would return, with the number of the right side's rows that each one meets."""
    keys = keys or []
    rows, met = _side(left, keys, *bounds, "l").drop("__level"), _side(right, keys, *(other or bounds), "r")
    ks = [f"k{i}" for i in range(len(keys))]

    def points(df, bound, begins, ends):
        return df.groupBy(*ks, F.col(bound).alias("__at")).agg(begins.alias("__begins"), ends.alias("__ends"))

    none, one = F.lit(0).cast("long"), F.count(F.lit(1))
    asked = [rows.select(*ks, F.col(b).alias("__at")).distinct().select(*ks, "__at", none.alias("__begins"), none.alias("__ends")) for b in ("__start", "__end")]
    every = reduce(DataFrame.unionByName, [points(met, "__start", one, F.min(none)), points(met, "__end", F.min(none), one), *asked])
    every = every.groupBy(*ks, "__at").agg(F.sum("__begins").alias("__begins"), F.sum("__ends").alias("__ends"))
    held = written(every.repartitionByRange(*ks, "__at").withColumn("__part", F.spark_partition_id()), "bounds")
    # a key has as many that begin as that end, so that sums over all keys before differ by nothing
    sums = held.groupBy("__part").agg(F.sum("__begins").alias("b"), F.sum("__ends").alias("e"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    sums = sums.select("__part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("b", "e")])
    within = W.partitionBy("__part").orderBy(*ks, "__at")
    run = held.join(F.broadcast(sums), "__part")
    begun = F.col("b") + F.sum("__begins").over(within)
    ended = F.col("e") + F.sum("__ends").over(within) - F.col("__ends")
    run = written(run.select(*ks, "__at", begun.alias("__begun"), ended.alias("__ended")), "running")
    out = rows.join(run.select(*ks, F.col("__at").alias("__end"), "__begun"), [*ks, "__end"])
    out = out.join(run.select(*ks, F.col("__at").alias("__start"), "__ended"), [*ks, "__start"])
    return out.select("l", (F.col("__begun") - F.col("__ended")).alias("n")).where("n > 0")

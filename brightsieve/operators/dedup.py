"""Duplicate detection: leaders in row order over exact keys, fuzzy pairs, summary.

Row i is a duplicate iff an earlier leader shares its phone or e-mail; else it
leads a cluster. That is the lexicographically first maximal independent set of
the "shares a key" graph. A few rounds decide nearly all rows: an
undecided row that comes first for all of its keys leads, and what shares a key with a leader is decided. What
is left then, chains in which each row waits for the one before, goes by ranges of
rows in order: the rows of a range, of bounded number, are scanned one after the other, and leaders decide
rows of the ranges to come. So the number of rounds is PEEL and one for each RANGE
rows that are left, however long chains are.

A key of very many rows is met by broadcast: keys that more than HOT rows have and more
than a thousandth of all rows are a thousand at most. Rows without a key don't take part in its joins.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightsieve.functions.text import strip
from brightsieve.storage import drop_written, numbered, written


def _keyed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``ix`` and k0, k1, ...: keys stripped and lower-cased, empty ones null."""
    return df.select(F.col(order).alias("ix"), *[F.nullif(F.lower(strip(F.col(k).cast("string"))), F.lit("")).alias(f"k{i}") for i, k in enumerate(keys)])


#: Rounds before ranges; undecided rows that are scanned at once; rows from which a key counts as frequent.
PEEL, RANGE, HOT = 4, 200_000, 10_000


def _frequent(rows: DataFrame, n: int) -> list[DataFrame]:
    """For each key, those that more than HOT rows, and more than a thousandth of all, have: a thousand at most."""
    least = max(HOT, rows.count() // 1000)
    return [written(rows.where(f"k{i} is not null").groupBy(f"k{i}").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select(f"k{i}"), "frequent") for i in range(n)]


def _met(rows: DataFrame, by: DataFrame, key: str, frequent: DataFrame, how: str) -> DataFrame:
    """``rows`` joined (left or left_anti) with ``by``, which has a key once; frequent keys by broadcast, rows without one by no join."""
    marked = rows.where(F.col(key).isNotNull()).join(F.broadcast(frequent.withColumn("__hot", F.lit(True))), key, "left")
    hot = marked.where("__hot").drop("__hot").join(F.broadcast(by.join(F.broadcast(frequent), key, "left_semi")), key, how)
    others = marked.where("__hot is null").drop("__hot").join(by, key, how)
    return hot.unionByName(others).unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def _scanned(rows: DataFrame, n: int) -> DataFrame:
    """The leading rows among ``rows``, no more than fit a task, by a scan in order."""
    def scan(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("ix", kind="stable")
        led, leads = [set() for _ in range(n)], []
        for keys in zip(*[some[f"k{i}"] for i in range(n)]):
            lead = not any(k is not None and k in held for k, held in zip(keys, led))
            leads.append(lead)
            if lead:
                for k, held in zip(keys, led):
                    held.add(k)
        return some[leads]

    return rows.groupBy().applyInPandas(scan, rows.schema)


def leaders(rows: DataFrame, n: int, frequent: list[DataFrame] | None = None) -> DataFrame:
    """The leading rows of ``rows`` (ix, k0 ... k(n-1)); ix is a number that no two rows share."""
    undecided, found = written(rows, "undecided"), []
    frequent = frequent or _frequent(undecided, n)

    def without(df, new):
        rest = df.join(new.select("ix"), "ix", "left_anti")
        for i in range(n):
            rest = _met(rest, new.select(f"k{i}").where(f"k{i} is not null"), f"k{i}", frequent[i], "left_anti")
        return rest.select(rows.columns)

    left = undecided.count()
    for _ in range(PEEL):
        if left <= RANGE:
            break
        # a key hands on one row, the first; a row leads if all of its keys do
        firsts = [undecided.where(f"k{i} is not null").groupBy(f"k{i}").agg(F.min_by(F.struct(rows.columns), "ix").alias("r")).select("r.*") for i in range(n)]
        keys = sum(F.col(f"k{i}").isNotNull().cast("int") for i in range(n))
        led = reduce(DataFrame.unionByName, firsts).groupBy(rows.columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == keys).drop("n")
        new = written(led.unionByName(undecided.where(keys == 0)), "leaders")
        found.append(new)
        before, undecided = undecided, written(without(undecided, new), "undecided")
        drop_written(before)
        left = undecided.count()
    if left:
        ranges = -(-left // RANGE)
        shares = [k / ranges for k in range(1, ranges)]
        bounds = sorted(set(undecided.agg(F.percentile_approx("ix", shares, 20 * ranges)).first()[0])) if shares else []
        for low, high in zip([None, *bounds], [*bounds, None]):
            some = undecided.where((F.lit(low is None) | (F.col("ix") > low)) & (F.lit(high is None) | (F.col("ix") <= high)))
            found.append(written(_scanned(some, n), "leaders"))
            if high is not None:  # what later ranges lose by this one
                before, undecided = undecided, written(without(undecided.where(F.col("ix") > high), found[-1]), "undecided")
                drop_written(before)
    return reduce(DataFrame.unionByName, found) if found else rows.where("false")


def mark_exact(df: DataFrame, keys: tuple[str, ...] = ("phone", "email"), order: str = "row_ix") -> DataFrame:
    """``df`` with is_duplicate and duplicate_cluster_id; the last key's leader decides if it comes before."""
    rows = written(_keyed(df, list(keys), order), "keyed")
    frequent = _frequent(rows, len(keys))
    lead = written(numbered(leaders(rows, len(keys), frequent), "ix", name="number", start=1), "numbered")
    named = rows.join(lead.select("ix", F.col("number").alias("own")), "ix", "left")
    for i in range(len(keys)):
        by = lead.where(f"k{i} is not null").select(f"k{i}", F.col("ix").alias(f"l{i}"), F.col("number").alias(f"n{i}"))
        named = _met(named, by, f"k{i}", frequent[i], "left")
    earlier = [F.when(F.col(f"l{i}") < F.col("ix"), F.col(f"n{i}")) for i in reversed(range(len(keys)))]
    number = F.coalesce("own", *earlier)
    told = named.select(F.col("ix").alias(order), F.col("own").isNull().alias("is_duplicate"), F.format_string("cluster_%06d", number).alias("duplicate_cluster_id"))
    return df.drop("is_duplicate", "duplicate_cluster_id").join(told, order)


def summary(df: DataFrame) -> DataFrame:
    """Records, unique ones, duplicates, their rate in percent, clusters and their mean size."""
    n, dup, clusters = F.count(F.lit(1)), F.count_if("is_duplicate"), F.count_distinct("duplicate_cluster_id")
    return df.agg(
        n.alias("total_records"), (n - dup).alias("unique_records"), dup.alias("duplicate_records"),
        F.round(F.when(n > 0, dup * 100.0 / n).otherwise(0.0), 2).alias("duplicate_rate"), clusters.alias("clusters"),
        F.round(F.when(clusters > 0, n / clusters).otherwise(0.0), 2).alias("average_cluster_size"),
    )


def indel_ratio(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|) with the bit-parallel LCS of Hyyro; 0 if both are empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    places: Counter = Counter()
    for i, ch in enumerate(a):
        places[ch] |= 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & places[ch]
        v = ((v + u) | (v - u)) & full
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def indel(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio(x or "", y or "") for x, y in zip(a, b)])


def _close(a: str, b: str, ratio: float):
    """Whether strings can have an Indel ratio of ``ratio``: no more single-character edits than it allows insertions and deletions."""
    return F.levenshtein(a, b) <= (1 - ratio) * (F.length(a) + F.length(b)) + 1e-9


def _like(names: DataFrame, ratio: float) -> DataFrame:
    """``n1, n2, s``: numbers of strings (c, n) with an Indel ratio of ``ratio`` or more, once for a pair, each with itself.

    No pair is lost: strings with an Indel ratio of t share so many bigrams that
    the rarest ceil(p |a|) + 1 of each must meet (prefix filter), where
    p = (2 - 1.5 t) + (1 - 1.5 t) t / (2 - t).
    """
    grams = F.when(F.length("c") < 2, F.array("c")).otherwise(F.transform(F.sequence(F.lit(1), F.length("c") - 1), lambda i: F.substring("c", i, F.lit(2))))
    every = names.select("c", "n", F.explode(grams).alias("g")).groupBy("c", "n", "g").agg(F.count(F.lit(1)).alias("times"))
    every = every.select("c", "n", "g", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
    common = every.groupBy("g", "time").agg(F.count(F.lit(1)).alias("held"))
    ranked = every.join(common, ["g", "time"]).groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("held", "g", "time"))).alias("gs"))
    share = (2 - 1.5 * ratio) + (1 - 1.5 * ratio) * ratio / (2 - ratio)
    prefix = ranked.select("c", "n", F.explode(F.slice("gs", 1, (F.ceil(F.length("c") * share) + 1).cast("int"))).alias("t")).select("c", "n", "t.g", "t.time")
    near = prefix.select(F.col("c").alias("c1"), F.col("n").alias("n1"), "g", "time").join(prefix.select(F.col("c").alias("c2"), F.col("n").alias("n2"), "g", "time"), ["g", "time"])
    reach = (2 - ratio) / ratio
    near = near.where((F.col("n1") < F.col("n2")) & (F.length("c1") <= F.length("c2") * reach) & (F.length("c2") <= F.length("c1") * reach)).select("c1", "n1", "c2", "n2").distinct()
    alike = near.where(_close("c1", "c2", ratio)).withColumn("s", indel("c1", "c2")).where(F.col("s") >= ratio).select("n1", "n2", "s")
    return alike.unionByName(names.select(F.col("n").alias("n1"), F.col("n").alias("n2"), F.lit(1.0).alias("s")))


#: Rows of equal company and address that make one piece at most, or so; pairs of rows that a task compares, or so.
PIECE, LOAD = 1_000, 16_000_000


def fuzzy_pairs(df: DataFrame, order: str = "row_ix", company: float = 0.85, address: float = 0.90, alone: float = 0.95) -> DataFrame:
    """D3: ``ix1, ix2, score`` of rows with like companies and addresses, or with nearly equal companies.

    No pair is lost. Distinct companies are compared once (``_like``), and so are distinct addresses
    that meet by them. Rows of equal company and address go as pieces, and become pairs of rows last.
    The pieces of a company are dealt to as many tasks as its pairs ask for.
    """
    text = lambda c: F.lower(strip(F.coalesce(F.col(c), F.lit(""))))
    rows = df.select(F.col(order).alias("ix"), text("company").alias("c"), text("address1").alias("a")).where("c != ''")
    number = F.monotonically_increasing_id()
    names = written(rows.select("c").distinct().withColumn("n", number), "names")
    places = written(rows.select("a").distinct().withColumn("n", number), "addresses")
    alike = written(_like(names, company), "alike")
    coded = rows.join(names.withColumnRenamed("n", "c_n"), "c").join(places.withColumnRenamed("n", "a_n"), "a").select("ix", "c_n", "a_n", (F.col("a") != "").alias("told"))
    coded = written(coded.where("ix is not null"), "coded")
    sizes = coded.groupBy("c_n", "a_n").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    pieces = coded.join(sizes, ["c_n", "a_n"]).groupBy("c_n", "a_n", "told", F.pmod(F.xxhash64("ix"), F.col("pieces")).alias("piece")).agg(F.collect_list("ix").alias("ixs"))
    pieces = written(pieces.withColumn("p", number).drop("piece"), "pieces")

    # a company's share of tasks, by the pairs of rows that its pieces make with those of like companies
    held = pieces.groupBy("c_n").agg(F.sum(F.size("ixs")).alias("held"))
    loads = alike.join(held.select(F.col("c_n").alias("n1"), F.col("held").alias("h1")), "n1").join(held.select(F.col("c_n").alias("n2"), F.col("held").alias("h2")), "n2")
    loads = loads.groupBy("n2").agg(F.sum(F.col("h1").cast("double") * F.col("h2")).alias("load"))
    loads = written(loads.select("n2", "load", F.least(F.ceil(F.col("load") / LOAD), F.lit(10_000)).cast("int").alias("shares")), "loads")
    tasks = int((loads.agg(F.sum("load")).first()[0] or 0) / LOAD) + 1
    left = alike.join(pieces.select(F.col("c_n").alias("n1"), F.col("a_n").alias("a1"), F.col("told"), F.col("p").alias("p1"), F.col("ixs").alias("ixs1")), "n1")
    left = left.join(loads.select("n2", "shares"), "n2").withColumn("share", F.pmod(F.xxhash64("p1"), F.col("shares")).cast("int"))
    right = pieces.select(F.col("c_n").alias("n2"), F.col("a_n").alias("a2"), F.col("p").alias("p2"), F.col("ixs").alias("ixs2")).join(loads.select("n2", "shares"), "n2")
    right = right.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))

    def met(*columns):
        one, two = (d.select("n2", "share", *[c for c in columns if c in d.columns]).repartition(min(tasks, 10_000), "n2", "share") for d in (left, right))
        return one.join(two.hint("shuffle_hash"), ["n2", "share"])

    both = met("n1", "a1", "a2", "told", "s").where("a1 != a2").select(F.least("a1", "a2").alias("x"), F.greatest("a1", "a2").alias("y")).distinct()
    both = both.join(places.select(F.col("n").alias("x"), F.col("a").alias("ax")), "x").join(places.select(F.col("n").alias("y"), F.col("a").alias("ay")), "y")
    near = both.where(_close("ax", "ay", address)).withColumn("sa", indel("ax", "ay")).where(F.col("sa") >= address)
    near = written(near.select("x", "y", "sa"), "addresses-alike")

    pairs = met("n1", "a1", "a2", "told", "s", "p1", "p2", "ixs1", "ixs2").where((F.col("n1") != F.col("n2")) | (F.col("p1") <= F.col("p2")))
    pairs = pairs.withColumns({"x": F.least("a1", "a2"), "y": F.greatest("a1", "a2")}).join(near, ["x", "y"], "left")
    sa = F.when(F.col("a1") != F.col("a2"), F.col("sa")).when(F.col("told"), F.lit(1.0))
    score = F.when(sa.isNotNull(), (F.col("s") + sa) / 2).when(F.col("s") >= alone, F.col("s"))
    pairs = pairs.withColumn("score", score).where("score is not null").select((F.col("p1") == F.col("p2")).alias("own"), "score", "ixs1", "ixs2")
    out = pairs.select("own", "score", F.explode("ixs1").alias("u"), "ixs2").select("own", "score", "u", F.explode("ixs2").alias("v"))
    out = out.where("IF(own, u < v, u != v)")
    return out.select(F.least("u", "v").alias("ix1"), F.greatest("u", "v").alias("ix2"), "score")


def arbitrate(pairs: DataFrame, judge, low: float = 0.70, high: float = 0.85) -> DataFrame:
    """Pairs scored in [low, high) stay only if ``judge`` (a Column -> boolean Column) says so; others stay."""
    between = (F.col("score") >= low) & (F.col("score") < high)
    return pairs.where(~between | judge(pairs))


def parse_decisions(response):
    """The first JSON array in a model's reply, as (index, is_same) structs."""
    shape = "array<struct<pair:int,is_same:boolean>>"
    # up to the last bracket, so that brackets inside strings end nothing; where text follows, up to the first
    return F.coalesce(*[F.from_json(F.regexp_extract(response, p, 1), shape) for p in (r"(?s)(\[.*\])", r"(?s)(\[.*?\])")])

"""CSV files of any size in many tasks, quoted line ends included.

Spark's text reader splits a file at line ends wherever its blocks begin, so that a
block may begin inside a quoted value. What a line does to that is a function of
two values: whether its end is inside quotes if its beginning is outside, and if it is inside
(``_ends``, a fold over what lies between its quotes). Lines without quotes change nothing; others
set a value or swap it, so that the value at any line follows from the last line that set it and the number of
swaps since: running aggregates within a block, and the same over the blocks, of
which there is one row each. Lines of one record are then put together; records of
one line, nearly all, are not moved for that.

A first pass over the file tells whether any record has several lines at all, whether
all bytes are UTF-8, and where each file's first line is. Without such records lines
are parsed where they are read. Records are parsed by Spark's own CSV functions.

Defined cases: an unclosed quote goes to the end of its file; a quote within an
unquoted value is a character; empty lines are left out; a carriage return
before a line end belongs to it outside quotes; files that have nothing but the header give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE = "__place"


def _ends(line: Column, inside: bool, delimiter: str, quote: str, escape: str) -> Column:
    """Whether the line's end is inside quotes. The fold's states: 0 outside, 1 inside, 2 a quote inside has just been met."""
    if escape != quote:  # what is escaped is neither
        line = F.regexp_replace(line, f"(?s){re.escape(escape)}.", "  ")
    between = F.split(line, re.escape(quote))
    first = F.struct(F.lit(int(inside)).alias("state"), F.lit(not inside).alias("start"))

    def step(held, part):
        # a quote opens at a value's beginning only; one inside closes unless another follows at once
        at_quote = F.when(held["state"] == 0, F.when(held["start"], 1).otherwise(0)).when(held["state"] == 1, 2).otherwise(1)
        after = F.when((at_quote == 2) & (part != ""), 0).otherwise(at_quote)
        return F.struct(after.cast("int").alias("state"), F.when(after == 0, part.endswith(delimiter)).otherwise(False).alias("start"))

    head = F.element_at(between, 1)
    begun = F.struct(first["state"].alias("state"), (first["start"] & ((head == "") | head.endswith(delimiter))).alias("start"))
    done = F.aggregate(F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0))), begun, step)
    return F.when(F.contains(line, F.lit(quote)), done["state"] == 1).otherwise(inside)


def _lines(spark: SparkSession, path: str, delimiter: str, quote: str, escape: str) -> DataFrame:
    """``file, block, row, value, out, within``: each line with where it ends if it begins outside, and inside, quotes."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value"
    )
    return rows.withColumns({"out": _ends(F.col("value"), False, delimiter, quote, escape), "within": _ends(F.col("value"), True, delimiter, quote, escape)})


def _records(lines: DataFrame) -> DataFrame:
    """``file, block, row, value``: whole records, by where their first lines are."""
    sets, swaps = F.col("out") == F.col("within"), F.col("out") & ~F.col("within")
    upto = W.partitionBy("file", "block").orderBy("row").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("file", "block").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    counted = lines.withColumn("swaps", F.sum(swaps.cast("long")).over(upto))
    marked = counted.withColumns({
        "mark": F.last(F.when(sets, F.struct("swaps", F.col("out").alias("to"))), ignorenulls=True).over(before),
        "met": F.coalesce(F.lag("swaps").over(W.partitionBy("file", "block").orderBy("row")), F.lit(0)),
    })
    # the same over whole blocks: one row each
    blocks = lines.withColumn("swap", swaps.cast("long")).groupBy("file", "block").agg(
        F.sum("swap").alias("n"), F.max_by(F.when(sets, F.struct("row", F.col("out").alias("to"))), F.when(sets, F.col("row"))).alias("set")
    )
    since = lines.where(swaps).join(blocks.select("file", "block", "set"), ["file", "block"]).where(F.col("set").isNull() | (F.col("row") > F.col("set.row"))).groupBy("file", "block").agg(F.count(F.lit(1)).alias("tail"))
    ordered = W.partitionBy("file").orderBy("block")
    told = blocks.join(since, ["file", "block"], "left").withColumn("tail", F.coalesce("tail", F.lit(0)))
    run = told.withColumn("total", F.sum(F.when(F.col("set").isNull(), F.col("n")).otherwise(F.col("tail"))).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
    last = F.last(F.when(F.col("set").isNotNull(), F.struct(F.col("set.to").alias("to"), (F.col("total") - F.col("tail")).alias("base"))), ignorenulls=True)
    begun = run.withColumns({"from": last.over(ordered.rowsBetween(W.unboundedPreceding, -1)), "sum": F.coalesce(F.lag("total").over(ordered), F.lit(0))})
    odd = lambda c: c % 2 == 1
    entry = F.when(F.col("from").isNull(), odd(F.col("sum"))).otherwise(F.col("from.to") != odd(F.col("sum") - F.col("from.base")))
    state = F.when(F.col("mark").isNull(), F.col("entry") != odd(F.col("met"))).otherwise(F.col("mark.to") != odd(F.col("met") - F.col("mark.swaps")))
    lined = marked.join(begun.select("file", "block", entry.alias("entry")), ["file", "block"]).withColumn("inside", state)
    lined = lined.withColumn("open", F.when(F.col("inside"), F.col("within")).otherwise(F.col("out")))
    alone = lined.where(~F.col("inside") & ~F.col("open")).select("file", "block", "row", "value")
    # lines of longer records: by the record's first line, which may lie blocks before
    several = lined.where(F.col("inside") | F.col("open")).select("file", "block", "row", "value", "inside")
    start = F.when(~F.col("inside"), F.struct("block", "row"))
    own = several.withColumn("first", F.last(start, ignorenulls=True).over(upto))
    latest = several.groupBy("file", "block").agg(F.max(start).alias("latest"))
    carried = latest.withColumn("carried", F.last("latest", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))).drop("latest")
    keyed = own.join(carried, ["file", "block"]).withColumn("first", F.coalesce("first", "carried"))
    joined = keyed.groupBy("file", "first").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "row", "value"))), lambda x: x["value"]), "\n").alias("value"))
    return alone.unionByName(joined.select("file", F.col("first.block").alias("block"), F.col("first.row").alias("row"), "value"))


def read(spark: SparkSession, path: str, names: list[str], header: list[int], delimiter: str, quote: str = '"', escape: str | None = None, encoding: str | None = None) -> DataFrame:
    """The records but for each file's first lines, which begin at the bytes ``header``: ``names``, one field more (``__over``), the record (``__raw``) and its place (file, block, row).

    Without an ``encoding`` a file is UTF-8, or Latin-1 if any of its bytes isn't.
    """
    escape = escape or quote
    lines = _lines(spark, path, delimiter, quote, escape)
    told = lines.groupBy("file").agg(
        F.max((F.col("out") & (F.col("value") != "")).cast("int")).alias("long"), F.max((~F.is_valid_utf8("value")).cast("int")).alias("other")
    ).collect()  # a row for each file, as the driver lists them too
    body = lines
    if header and told:
        # a line lies in the block that begins last before it; of the blocks that hold these lines there is one as a rule
        early = lines.where(F.col("block") <= header[-1]).groupBy("file", "block").agg(F.min("row").alias("first")).collect()
        blocks: dict[str, dict[int, list[int]]] = {}
        for r in early:
            blocks.setdefault(r.file, {})[r.block] = [r.first, 0]
        for own in blocks.values():
            for at in header:
                own[max((b for b in own if b < at), default=min(own))][1] += 1
        least = [(f, b, row + n) for f, own in blocks.items() for b, (row, n) in own.items() if n]
        marks = F.broadcast(spark.createDataFrame(least, "file string, block long, least long"))
        body = lines.join(marks, ["file", "block"], "left").where(F.col("least").isNull() | (F.col("row") >= F.col("least"))).drop("least")
    records = _records(body) if any(r.long for r in told) else body.select("file", "block", "row", "value")
    latin = [r.file for r in told if r.other] if not encoding else [r.file for r in told] if encoding != "UTF-8" else []
    value = F.col("value")
    if latin:
        value = F.when(F.col("file").isin(latin), F.decode(value.cast("binary"), encoding or "ISO-8859-1")).otherwise(value)
    value = F.regexp_replace(value, "\r\\z", "")
    shape = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__over", "__raw"]])
    options = {"sep": delimiter, "quote": quote, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__raw", "multiLine": "true"}
    text = records.withColumn("value", value).where("value != ''")
    parsed = text.select(F.struct("file", "block", "row").alias(PLACE), F.from_csv("value", _ddl(shape), options).alias("r"))
    return parsed.select(*[F.col("r").getField(n).alias(n) for n in [*names, "__over", "__raw"]], PLACE)


def _ddl(shape: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in shape.fields)

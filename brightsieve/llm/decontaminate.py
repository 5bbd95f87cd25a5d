"""Benchmark decontamination over a distributed positional inverted index.

A benchmark item becomes windows of ten consecutive words (an item of fewer is
one window). The corpus is hashed once into a table of words by position, which
tells how often each benchmark term occurs. For the terms that windows are
looked up by, the rarest of each, postings are stored: a row (term, successor,
document, position), in files by bucket of the term and sorted by it. A look-up
reads the postings of its terms only. Each posting less the term's place in the
window is a place where the window may begin, and the offset-adjusted lists of
the rarest terms are intersected there. What the intersection leaves is
compared word for word, which makes phrase matches exact. ``proximity`` asks
the same postings for the rarest terms within a span instead.

All of it is DataFrame functions. Common terms cost nothing, since only the
rarest have postings; a window that is common itself has postings in
proportion to its occurrences. Defined cases: null and wordless texts have no
words and are clean; wordless items have no window; equal windows of several
items count for each; terms that are equally rare are taken by their place;
rows that repeat come back as given; an empty benchmark
leaves all clean. Further columns are kept by ``stage`` and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.llm.base import ascii_lower, new_path, sheltered, written

WINDOW, RAREST = 10, 3
#: What is broadcast has this many rows and bytes at most, counted before; more is joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Folders that postings are dealt over by their term.
BUCKETS = 16
#: What separates words.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def raw_words(text: Column) -> Column:
    """The words of a text before A-Z are lower-cased (splitting is several times as fast as extracting)."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN, -1)
    return F.transform(F.array(parts), _inner)[0]


def _inner(parts: Column) -> Column:
    """Without the empty strings that a separator at either end leaves."""
    lead = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    trail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, lead + 1, F.size(parts) - lead - trail)


def words(text: Column) -> Column:
    """The words of a text: runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters."""
    return F.transform(raw_words(text), ascii_lower)


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``wid, phrase, len, items``: the distinct windows and the items (as strings) that have them."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    cut = items.select("item", "w", F.explode(starts).alias("i")).select("item", F.slice("w", F.col("i"), F.lit(size)).alias("phrase"))
    found = cut.groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return found.select(F.struct(F.xxhash64("phrase").alias("a"), F.hash("phrase").alias("b")).alias("wid"), "phrase", F.size("phrase").alias("len"), "items")


def _small(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast, if its rows and their bytes are few enough."""
    sizes = [F.octet_length(F.to_json(F.struct(c)) if not t.startswith(("int", "bigint", "string", "boolean")) else F.col(c).cast("string")) for c, t in df.dtypes]
    held = sum((F.coalesce(x, F.lit(0)) for x in sizes), F.lit(8 * len(sizes)))
    n, size = df.select(held.alias("b")).limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words, written to the shared folder: ``doc_id, th, n_words`` and ``h``, the words' 32-bit hashes by position.

    Unlike words whose hashes agree only make candidates, which are compared word for word.
    """
    hashes = F.transform(raw_words(F.col(text_col)), lambda w: F.hash(ascii_lower(w)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), hashes.alias("h"))
    return written(rows.select("doc_id", "th", F.size("h").cast("long").alias("n_words"), "h"), "index")


def anchors(tokens: DataFrame, wins: DataFrame) -> DataFrame:
    """``term, next, wid, place, bit, whole``: each window's rarest terms by their count in the corpus, and what follows each.

    A window with a term that the corpus lacks can't occur and has no row.
    """
    terms = wins.select("wid", "len", F.posexplode(F.transform("phrase", lambda w: F.hash(w))).alias("place", "h"), F.transform("phrase", lambda w: F.hash(w)).alias("all"))
    vocabulary, every = terms.select("h").distinct(), tokens.select(F.explode("h").alias("h"))
    if vocabulary.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        every = every.join(F.broadcast(vocabulary), "h", "left_semi")
    counts = every.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    known = terms.join(counts, "h").groupBy("wid", "len", "all").agg(F.sort_array(F.collect_list(F.struct("n", "place", "h"))).alias("by"))
    known = known.where(F.size("by") == F.col("len"))
    followed = F.filter("by", lambda t: (t["place"] + 1 < F.col("len")) | (F.col("len") == 1))
    rare = known.select("wid", "all", F.slice(followed, 1, RAREST).alias("by"))
    return rare.select("wid", "all", F.size("by").alias("k"), F.posexplode("by").alias("rank", "t")).select(
        F.col("t.h").alias("term"), F.get("all", F.col("t.place") + 1).alias("next"), "wid", F.col("t.place").alias("place"),
        F.expr("shiftleft(1, rank)").alias("bit"), F.expr("shiftleft(1, k) - 1").alias("whole"),
    )


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The inverted index of the terms in ``terms``, stored: ``term, next, doc_id, th, pos``, a term's postings side by side in its bucket."""
    # equal hashes (of copies and repeated rows) are one document here: a text's hash and id name it
    wanted = _small(terms.select("term").distinct())
    pairs = F.arrays_zip("h", F.slice("h", 2, F.greatest(F.size("h"), F.lit(1))).alias("x"))
    every = tokens.select("doc_id", "th", F.posexplode(pairs).alias("pos", "p"))
    every = every.select(F.col("p").getField("h").alias("term"), F.col("p").getField("x").alias("next"), "doc_id", "th", "pos").join(wanted, "term", "left_semi")
    path = new_path(tokens.sparkSession, "postings")
    bucketed = every.withColumn("bucket", F.pmod(F.hash("term"), F.lit(BUCKETS)))
    bucketed.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(path)
    return tokens.sparkSession.read.schema(bucketed.schema).parquet(path)


def looked_up(index: DataFrame, terms: DataFrame, followed: bool = True) -> DataFrame:
    """The postings of ``terms`` with its columns; ``followed``: only where the term's successor is the window's."""
    asked = terms.withColumnsRenamed({"term": "t", "next": "nx"}).withColumn("b", F.pmod(F.hash("t"), F.lit(BUCKETS)))
    same = (F.col("bucket") == F.col("b")) & (F.col("term") == F.col("t"))
    if not followed:
        found = index.join(_small(asked), same)
    else:
        found = index.join(_small(asked.where("nx is not null")), same & (F.col("next") == F.col("nx")))
        alone = asked.where("nx is null")
        if alone.limit(1).count():
            found = found.unionByName(index.join(_small(alone), same))
    return found.drop("bucket", "b", "t", "nx")


def candidates(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id, th, wid, start`` where the postings of all of a window's rarest terms meet."""
    found = looked_up(index, terms)
    at = found.select("doc_id", "th", "wid", (F.col("pos") - F.col("place")).alias("start"), "bit", "whole").where("start >= 0")
    met = at.groupBy("doc_id", "th", "wid", "start", "whole").agg(F.bit_or("bit").alias("seen"))
    return met.where("seen = whole").select("doc_id", "th", "wid", "start")


def matches(docs: DataFrame, tokens: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``doc_id, th, matches, n_hit, items`` of each text (``th`` is its hash) that holds a window.

    ``tokens`` is the ``index`` of ``docs``. Matches are (start, len), in order; n_hit counts the words inside any of them.
    """
    wins = written(windows(benchmark, item_col, item_text, size), "windows")
    terms = written(anchors(tokens, wins), "anchors")
    met = candidates(postings(tokens, terms), terms).join(_small(wins.select("wid", "len")), "wid")
    per = met.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "len", "wid"))).alias("found"))
    per = written(per.select(F.col("doc_id").alias("cid"), F.col("th").alias("cth"), "found"), "candidates")
    text = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("cid")) & (F.col("th") == F.col("cth"))
    keys = per.select("cid", "cth")
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # two longs a row
        text = text.join(F.broadcast(keys), same, "left_semi")
    held = text.dropDuplicates(["doc_id", "th"]).join(per, same)
    # a lambda's argument holds the words, so that they are cut once for all candidates
    cut = F.flatten(F.transform(F.array(words(F.col("text"))), lambda w: F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["len"].alias("len"), c["wid"].alias("wid"), F.slice(w, c["start"] + 1, c["len"]).alias("said")))))
    said = held.select("doc_id", "th", F.explode(cut).alias("c")).select("doc_id", "th", "c.start", "c.len", "c.wid", "c.said")
    exact = said.join(_small(wins.select("wid", "phrase")), "wid").where(F.col("said") == F.col("phrase"))
    exact = written(exact.select("doc_id", "th", "wid", "start", "len"), "exact")
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def cover(acc, m):
        end = F.greatest(acc["end"], m["start"] + m["len"])
        return F.struct(end.alias("end"), (acc["hit"] + end - F.greatest(acc["end"], m["start"])).cast("long").alias("hit"))

    at = exact.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "len"))).alias("matches"))
    named = exact.select("doc_id", "th", "wid").distinct().join(_small(wins.select("wid", F.explode("items").alias("item"))), "wid")
    named = named.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("item")).alias("items")).select(F.col("doc_id").alias("iid"), F.col("th").alias("ith"), "items")
    out = at.join(named, F.col("doc_id").eqNullSafe(F.col("iid")) & (F.col("th") == F.col("ith")))
    return written(out.select("doc_id", "th", "matches", F.aggregate("matches", begin, cover, lambda acc: acc["hit"]).alias("n_hit"), "items"), "matches")


def proximity(docs: DataFrame, benchmark: DataFrame, span: int = 2 * WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``doc_id, wid, first, last``: where all of a window's rarest terms occur, in any order, within ``span`` words.

    Positions are dealt into blocks of ``span`` words, each posting to its own and the
    block before, so that terms ``span`` apart at most share a block; blocks are small.
    """
    wins = written(windows(benchmark, item_col), "windows")
    tokens = index(docs, id_col, text_col)
    terms = written(anchors(tokens, wins), "anchors")
    found = looked_up(postings(tokens, terms), terms, followed=False)
    block = F.floor(F.col("pos") / span).cast("int")
    dealt = found.select("doc_id", "th", "wid", "pos", "bit", "whole", F.explode(F.array(block, block - 1)).alias("block"))
    lists = dealt.groupBy("doc_id", "th", "wid", "block", "whole").agg(F.sort_array(F.collect_set(F.struct("pos", "bit"))).alias("at"), F.bit_or("bit").alias("seen"))

    def from_here(a):
        near = F.filter("at", lambda b: (b["pos"] >= a["pos"]) & (b["pos"] < a["pos"] + span))
        begin = F.struct(F.lit(0).alias("seen"), F.lit(-1).alias("last"))
        end = F.aggregate(near, begin, lambda acc, b: F.when(acc["seen"] == F.col("whole"), acc).otherwise(F.struct(acc["seen"].bitwiseOR(b["bit"]).alias("seen"), b["pos"].alias("last"))))
        return F.struct(a["pos"].alias("first"), end["last"].alias("last"), (end["seen"] == F.col("whole")).alias("all"))

    spans = lists.where("seen = whole").select("doc_id", "wid", F.explode(F.transform("at", from_here)).alias("s")).where("s.all")
    return spans.select("doc_id", "wid", "s.first", "s.last").distinct()


def _found(found: DataFrame) -> DataFrame:
    """``found`` under names that clash with none, broadcast if it is small."""
    return _small(found.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("n_hit").alias("__n_hit"), F.col("items").alias("__items")))


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    tokens = index(docs)
    told = tokens.select("doc_id", "th", "n_words").join(_found(matches(docs, tokens, bench)), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    return told.select(
        "doc_id", "n_words", F.coalesce("__n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("__items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("__items", ","), F.lit("")), 256).alias("items_sha256"), F.col("__n_hit").isNotNull().alias("contaminated"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold any benchmark window go; the others, null texts among them, keep all columns."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return sheltered(docs, lambda rows: _clean(rows, bench))


def _clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    found = _found(matches(docs, index(docs), bench))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th")), "left_anti")


SQL = {
    "op4_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS p
  FROM (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
gram AS (SELECT rid, l, i, array_to_string(w[i:i + l - 1], ' ') AS p
  FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)),
met AS (SELECT rid, i, gram.l AS l, item_id FROM gram JOIN win ON gram.p = win.p AND gram.l = win.l),
hit AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + l)) AS k FROM met) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
}

"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased; keys
of LEAST characters count, by two 64-bit hashes. Documents come in batches. A
batch's distinct keys, each with the least document that holds it, are written
bucketed and sorted by hash; a merge anti-join with every run leaves the keys
that no earlier batch has seen, which become a run of their own. FANOUT runs of
one level are merged into one of the next, so that a batch meets
(FANOUT - 1) log(batches) runs, and a key is rewritten once a level. Runs are
bucketed alike, so these joins move nothing but the new batch. A line goes if its
key's owner, the document that its run names, is another document.

``LineRuns`` keeps its runs in a folder: a run is named by the first and last batch
that it covers and counts once Spark has marked it as whole; one that covers
others replaces them. A store can so be opened again and take further batches;
what an earlier batch has owns the line. ``dedup`` deals one table into batches
of ascending ids, so that the least id owns.

Which documents hold a key is never gathered: keys are counted and their least
document found before the shuffle; the few keys that more than 1/HOT of
a batch's lines have (HOT of them at most) meet the lines by broadcast, others by
shuffle. Positions of dropped lines are gathered by document only.

Defined cases: a null or empty text is one empty line and stays; a null id counts
as one document after all others; rows with one id are one document; repeated rows
come back repeated; documents without keys stay as they are; an empty
table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.llm.base import ascii_lower, new_path, remove, written

LEAST, BATCHES, FANOUT, HOT = 10, 4, 2, 256
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
_LAST = (1 << 63) - 1
_RUN = re.compile(r"run-(\d+)-(\d+)-(\d+)\Z")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, th, pos, h1, h2`` of every line whose key is long enough; th is a hash of the whole text."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text_col).alias("th"), F.posexplode(lines_of(F.col(text_col).cast("string"))).alias("pos", "line")
    )
    keys = rows.select("doc", "th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= LEAST)
    return keys.select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """The runs in ``folder``; ``buckets`` is fixed when the store is made (Spark's number of shuffle partitions by default)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.runs: list[tuple[int, int, str]] = []  # first batch, last batch, table
        found = sorted(self._whole(), key=lambda r: (r[0], -r[1]))
        self.buckets = found[0][2] if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        for first, last, _, path in found:
            if self.runs and self.runs[-1][1] >= last:  # a merged run covers it
                remove(spark, path)
                continue
            name = self._name()
            spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, owner BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'")
            self.runs.append((first, last, name))
        self.next = max((last for _, last, _ in self.runs), default=-1) + 1

    @staticmethod
    def _name() -> str:
        return f"line_run_{uuid.uuid4().hex}"

    def _path(self, first: int, last: int) -> str:
        return f"{self.folder}/run-{first}-{last}-{self.buckets}"

    def _whole(self):
        """(first, last, buckets, path) of the runs that were written whole; what a lost driver left half done goes."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(where) if fs.exists(where) else ():
            if m := _RUN.match(status.getPath().getName()):
                path = f"{self.folder}/{m[0]}"
                if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                    yield int(m[1]), int(m[2]), int(m[3]), path
                else:
                    remove(self.spark, path)

    def _write(self, keys: DataFrame, path: str) -> str:
        name = self._name()
        keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        return name

    def _drop(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, path)

    def _level(self, run: tuple[int, int, str]) -> int:
        return round(math.log(run[1] - run[0] + 1, FANOUT))

    def _compact(self) -> None:
        while len(self.runs) >= FANOUT and len({self._level(r) for r in self.runs[-FANOUT:]}) == 1:
            some = self.runs[-FANOUT:]
            first, last = some[0][0], some[-1][1]
            merged = self.spark.table(some[0][2])
            for _, _, name in some[1:]:
                merged = merged.unionByName(self.spark.table(name))
            made = self._write(merged.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY), self._path(first, last))
            self.runs[-FANOUT:] = [(first, last, made)]
            for a, b, name in some:
                self._drop(name, self._path(a, b))

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes a batch of ``key_rows`` (a written table: it is read twice); ``doc, th, pos`` of the lines that go, written."""
        at = f"{self.folder}/batch-{self.next}-{uuid.uuid4().hex}"
        batch = self._write(lines.groupBy(*KEY).agg(F.min("doc").alias("owner"), F.count(F.lit(1)).alias("n")), at)
        keys = self.spark.table(batch)
        fresh = keys.drop("n")
        for _, _, name in self.runs:
            fresh = fresh.join(self.spark.table(name).select(*KEY), KEY, "left_anti")
        path = self._path(self.next, self.next)
        remove(self.spark, path)
        own = self._write(fresh, path)
        # what more than one line has, or an earlier batch: by whom it is owned
        repeated = keys.where("n > 1").drop("owner").join(self.spark.table(own), KEY)
        for _, _, name in self.runs:
            repeated = repeated.unionByName(keys.drop("owner").join(self.spark.table(name), KEY))
        repeated = written(repeated, "line-owners")
        many = (keys.agg(F.sum("n")).first()[0] or 0) // HOT
        hot, others = repeated.where(F.col("n") > many).drop("n"), repeated.where(F.col("n") <= many).drop("n")
        held = lines.join(F.broadcast(hot), KEY, "left")
        gone = written(
            held.where("owner != doc").select("doc", "th", "pos").unionByName(held.where("owner IS NULL").drop("owner").join(others, KEY).where("owner != doc").select("doc", "th", "pos")),
            "lines-gone",
        )
        self.runs.append((self.next, self.next, own))
        self.next += 1
        self._drop(batch, at)
        self._compact()
        return gone

    def close(self, keep: bool = True) -> None:
        """Forgets the tables' names; without ``keep`` the runs go too."""
        for first, last, name in self.runs:
            self.spark.sql(f"DROP TABLE {name}")
            if not keep:
                remove(self.spark, self._path(first, last))
        self.runs = []


def kept(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the text left) of every row of ``docs``; ``gone`` is what ``LineRuns.add`` returned."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text_col).alias("th"), lines_of(F.col(text_col).cast("string")).alias("lines"))
    places = gone.groupBy("doc", "th").agg(F.collect_set("pos").alias("places"))
    joined = rows.join(places, ["doc", "th"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    # ``lines`` comes out of the join and is not split again for each place
    text = F.when(F.col("places").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("kept"))


def dedup(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``kept`` for all of ``docs``, dealt into ``batches`` of ascending ids, by runs that go afterwards."""
    spark = docs.sparkSession
    shares = [k / batches for k in range(1, batches)]
    bounds = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, 1000)).first()[0] if shares else []
    lines, path = key_rows(docs, id_col, text_col), new_path(spark, "lines")
    number = sum(((F.col("doc") > b).cast("int") for b in bounds or []), F.lit(0))
    lines.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    held = spark.read.schema(lines.withColumn("batch", F.lit(0)).schema).parquet(path)
    runs, gone = LineRuns(spark, new_path(spark, "line-runs")), None
    for b in range(len(bounds or []) + 1):
        some = runs.add(held.where(F.col("batch") == b).drop("batch"))
        gone = some if gone is None else gone.unionByName(some)
    runs.close(keep=False)
    remove(spark, path)
    return kept(docs, gone, id_col, text_col)


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SQL = {
    "op11_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, k.pos, k.line, coalesce(o.owner <> k.doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}

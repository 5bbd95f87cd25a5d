"""The lead table: create, append, upsert, statistics, export and ad-hoc SQL."""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightsieve.functions.vocab import INTEGER_TARGETS, TARGETS
from brightsieve.operators.quality import flags_json
from brightsieve.storage import drop_written, new_path, remove, written

#: Cut to 500 characters before loading.
CUT = ("company", "address1", "address2", "city", "email")

SCHEMA = T.StructType(
    [T.StructField(t, T.IntegerType() if t in INTEGER_TARGETS else T.StringType()) for t in TARGETS]
    + [T.StructField(n, T.StringType()) for n in ("source_file", "record_id", "duplicate_cluster_id", "data_quality_flags", "ai_duplicate_cluster_id", "raw_record_hash", "normalization_applied", "batch_id")]
    + [T.StructField("is_duplicate", T.BooleanType()), T.StructField("data_quality_score", T.IntegerType()), T.StructField("ai_facility_type_confidence", T.DoubleType())]
    + [T.StructField(n, T.TimestampType()) for n in ("created_at", "updated_at", "ingestion_timestamp")]
)


def record_hash(df: DataFrame, columns: list[str]):
    """K5: SHA-256 of the columns as JSON with sorted keys, nulls written out."""
    def item(c):
        # JSON's own escapes, control characters included, come from Spark's writer
        value = F.regexp_replace(F.to_json(F.struct(F.col(c).cast("string").alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1")
        return F.concat(F.lit(f'"{c}": '), F.when(F.col(c).isNull(), F.lit("null")).otherwise(value))

    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *[item(c) for c in sorted(columns)]), F.lit("}")), 256)


def string_hash(c):
    """K6."""
    return F.sha2(c, 256)


def prepare(df: DataFrame, batch_id: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """K4: batch, time and hash filled in, lists and maps as JSON text, times as ISO text where text is stored, long strings cut."""
    now = now or dt.datetime.now()
    batch_id = batch_id or now.strftime("batch_%Y%m%d_%H%M%S")
    business = [c for c in TARGETS if c in df.columns]
    add = {c: F.substring(c, 1, 500) for c in CUT if c in df.columns}
    if "data_quality_flags" in df.columns and dict(df.dtypes)["data_quality_flags"] != "string":
        add["data_quality_flags"] = flags_json(F.col("data_quality_flags"))
    stored = {f.name: f.dataType for f in SCHEMA.fields}
    for f in df.schema.fields:
        if f.name in add:
            continue
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # as Python's writer has it: a blank after commas and colons between values
            add[f.name] = F.to_json(f.name) if not isinstance(f.dataType, T.ArrayType) or not isinstance(f.dataType.elementType, T.StringType) else flags_json(F.col(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and isinstance(stored.get(f.name, T.StringType()), T.StringType):
            add[f.name] = F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss")
    add["batch_id"] = F.coalesce("batch_id", F.lit(batch_id)) if "batch_id" in df.columns else F.lit(batch_id)
    stamp = F.lit(now).cast("timestamp")
    add["ingestion_timestamp"] = F.coalesce("ingestion_timestamp", stamp) if "ingestion_timestamp" in df.columns else stamp
    if "is_duplicate" in df.columns:
        add["is_duplicate"] = F.col("is_duplicate").cast("boolean")
    out = df.withColumns(add)
    return out if "raw_record_hash" in df.columns else out.withColumn("raw_record_hash", record_hash(out, business))


def keyed(key: str = "record_id"):
    """Rows with a key; a null or empty one is an error of the row."""
    return F.col(key).isNotNull() & (F.col(key).cast("string") != "")


def folded(new: DataFrame, key: str = "record_id", order: list[str] | None = None) -> DataFrame:
    """One row for each key: every column's last value that isn't null, in row order, and how many rows the key had (``__rows``).

    ``order`` names what rows are ordered by; by default as they come. ``created_at`` is the first row's.
    The fold is an aggregate with partial results, so that a key of any number of rows is
    reduced where its rows are read. Rows that tie in the order count by all their columns.
    """
    columns = [c for c in new.columns if c != key]
    place = [F.col(c) for c in order] if order else [F.monotonically_increasing_id()]
    rows = new.withColumn("__place", F.struct(*place, *[F.col(c).cast("string") for c in columns] if order else [])).where(keyed(key))

    def value(c):
        if c == "created_at":
            return F.min_by(F.struct(c), "__place")[c]
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__place")))

    return rows.groupBy(key).agg(*[value(c).alias(c) for c in columns], F.count(F.lit(1)).alias("__rows"))


def merged(old: DataFrame, new: DataFrame, key: str = "record_id", now: dt.datetime | None = None, order: list[str] | None = None) -> DataFrame:
    """K3 as one full outer join: null never overwrites, created_at stays, updated_at is now.

    New rows of one key are folded in their order, as if each was inserted or updated after the other;
    rows without a key are left out. ``__did`` says what happened to the key, ``__rows`` by how many rows.
    """
    return joined(old, folded(new, key, order), key, now)


def joined(old: DataFrame, latest: DataFrame, key: str = "record_id", now: dt.datetime | None = None) -> DataFrame:
    """``merged`` for rows that are folded already."""
    stamp = F.lit(now or dt.datetime.now()).cast("timestamp")
    own = [c for c in old.columns if c != key]
    latest = latest.select(F.col(key), F.lit(True).alias("__new"), "__rows", *[F.col(c).alias(f"__{c}") for c in latest.columns if c not in (key, "__rows")])
    both = old.withColumn("__old", F.lit(True)).join(latest, key, "full_outer")

    def value(c):
        fresh = F.col(f"__{c}").cast(old.schema[c].dataType) if f"__{c}" in both.columns else F.lit(None)
        if c == "created_at":
            return F.coalesce(F.col(c), fresh, stamp)
        if c == "updated_at":
            return F.when(F.col("__new"), stamp).otherwise(F.col(c))
        return F.coalesce(fresh, F.col(c))

    return both.select(key, *[value(c).alias(c) for c in own], F.when(F.col("__old") & F.col("__new"), "updated").when(F.col("__new"), "inserted").alias("__did"), "__rows")


class LeadStore:
    """A Parquet table at a location that outlives the session.

    The folder ``_log`` holds a file for each version: its number, and the data folders of each
    bucket of keys. A version is written whole under another name and then takes its own only if no other
    writer has that yet, so that versions are never replaced and a run that ends at any step
    leaves the table as it was. A writer whose number was taken starts again from
    the newer version; if no bucket that it has read changed meanwhile, its data is kept as written. An upsert reads and
    rewrites the buckets that its keys fall into, a load only adds folders. The newest
    KEEP versions stay; data that only older ones named goes, so a frame should be read before
    KEEP further commits. ``vacuum`` removes what failed writers have left.

    The name is taken by a hard link on a local file system and by a rename elsewhere,
    which HDFS refuses if the name exists; a store whose rename replaces needs one writer at a time.
    A table of the older layout (``CURRENT`` and ``v*`` folders) is taken over when it is opened.
    """

    KEEP, ATTEMPTS = 10, 20

    def __init__(self, spark: SparkSession, location: str | None = None, name: str = "leads", buckets: int = 16):
        location = (location or "").removeprefix("sqlite:///") or None  # K11: a connection string or a bare path
        self.spark, self.name, self.root, self.buckets = spark, name, (location or new_path(spark, name)).rstrip("/"), buckets
        if self._version() is None:
            self._adopt()
        if (held := self._version()) is not None:
            self.buckets = self._snapshot(held)["buckets"]
            self.frame().createOrReplaceTempView(self.name)

    def _file(self, name: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, folder: str) -> list[str]:
        fs, where = self._file(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []

    def _version(self) -> int | None:
        return max((int(n[:-5]) for n in self._names("_log") if n.endswith(".json")), default=None)

    def _snapshot(self, version: int) -> dict:
        fs, where = self._file(f"_log/{version:020d}.json")
        # bytes, as the file has one long line
        stream = fs.open(where)
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _put(self, version: int, snapshot: dict) -> bool:
        """Writes a version's file whole, if there is none: False if another writer was first."""
        fs, made = self._file(f"_log/{version:020d}.{uuid.uuid4().hex}")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(snapshot).encode()))
        out.close()
        _, name = self._file(f"_log/{version:020d}.json")
        try:
            if made.toUri().getScheme() in (None, "file") and fs.getUri().getScheme() == "file":
                try:
                    os.link(made.toUri().getPath(), name.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            return not fs.exists(name) and fs.rename(made, name)
        finally:
            fs.delete(made, False)

    def _adopt(self) -> None:
        """Takes over a table of the older layout: the version that CURRENT names, else the latest."""
        whole = [n for n in self._names("") if n.startswith("v") and "_SUCCESS" in self._names(n)]
        if whole:
            fs, where = self._file("CURRENT")
            named = self.spark.read.text(where.toString(), wholetext=True).first()[0].strip() if fs.exists(where) else whole[-1]
            old = self.spark.read.schema(SCHEMA).parquet(f"{self.root}/{named if named in whole else whole[-1]}")
            self._put(0, {"buckets": self.buckets, "data": self._written(old)})

    def create(self) -> None:
        """K1: an empty table under the name, if there is none yet."""
        if self._version() is None:
            self._put(0, {"buckets": self.buckets, "data": {}})
            self.buckets = self._snapshot(self._version())["buckets"]
            self.frame().createOrReplaceTempView(self.name)

    def _bucket(self):
        return F.pmod(F.xxhash64("record_id"), F.lit(self.buckets)).cast("int")

    def _written(self, df: DataFrame) -> dict[str, list[str]]:
        """The rows in a new data folder: its part of each bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        df.withColumn("bucket", self._bucket()).write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        return {n.removeprefix("bucket="): [f"{folder}/{n}"] for n in self._names(folder) if n.startswith("bucket=")}

    def _rows(self, data: dict[str, list[str]]) -> DataFrame:
        paths = [f"{self.root}/{f}" for folders in data.values() for f in folders]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def _commit(self, base: int, change, touched: set[str] | None):
        """Adds a version in which ``change(snapshot's data)`` was made: what that returned beside the new data.

        ``touched`` are the buckets that the change has read (None: none); only if another
        writer has changed one of them is it made anew.
        """
        data, made = self._snapshot(base)["data"], None
        for _ in range(self.ATTEMPTS):
            if made is None:
                made = change({k: v for k, v in data.items() if touched is None or k in touched})
            fresh, told = made
            kept = data if touched is None else {k: v for k, v in data.items() if k not in touched}
            after = dict(kept)
            for k, v in fresh.items():
                after[k] = [*after.get(k, []), *v]
            if self._put(base + 1, {"buckets": self.buckets, "data": after}):
                self._forget(base + 1)
                self.frame().createOrReplaceTempView(self.name)
                return told
            base = self._version()
            newer = self._snapshot(base)["data"]
            if any(newer.get(k) != data.get(k) for k in touched or ()):
                for folder in {f.rsplit("/", 1)[0] for v in fresh.values() for f in v}:
                    remove(self.spark, f"{self.root}/{folder}")
                made = None
            data = newer
        raise RuntimeError(f"{self.root}: no version could be added in {self.ATTEMPTS} attempts, others write all the time")

    @staticmethod
    def _folders(data: dict[str, list[str]]) -> set[str]:
        return {f for v in data.values() for f in v}

    def _forget(self, version: int) -> None:
        """Removes versions older than the newest KEEP and the data that only they name."""
        numbers = [int(n[:-5]) for n in self._names("_log") if n.endswith(".json")]
        old = [n for n in numbers if n <= version - self.KEEP]
        if not old:
            return
        stay = set().union(*[self._folders(self._snapshot(n)["data"]) for n in numbers if n > version - self.KEEP])
        for n in old:
            try:
                gone = self._folders(self._snapshot(n)["data"]) - stay
            except Py4JJavaError:  # another writer has just removed it
                continue
            for folder in gone:
                remove(self.spark, f"{self.root}/{folder}")
            fs, where = self._file(f"_log/{n:020d}.json")
            fs.delete(where, False)

    def vacuum(self, hours: float = 24.0) -> int:
        """Removes data folders that no version names and that are older than any running writer's: how many."""
        named = set()
        for n in self._names("_log"):
            if n.endswith(".json"):
                named |= {f.rsplit("/", 1)[0] for f in self._folders(self._snapshot(int(n[:-5]))["data"])}
        gone = 0
        for n in self._names("data"):
            fs, where = self._file(f"data/{n}")
            if f"data/{n}" not in named and fs.getFileStatus(where).getModificationTime() / 1000 <= time.time() - hours * 3600:
                fs.delete(where, True)
                gone += 1
        return gone

    def frame(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of one that is still kept."""
        held = self._version() if version is None else version
        return self._rows(self._snapshot(held)["data"])

    def load(self, df: DataFrame) -> dict:
        """K2: appends without looking at keys."""
        self.create()
        rows = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
        fresh = self._written(rows)
        n = self._rows(fresh).count()
        self._commit(self._version(), lambda _: (fresh, None), None)
        return {"inserted": n, "table": self.name}

    def upsert(self, df: DataFrame, now: dt.datetime | None = None, order: list[str] | None = None) -> dict:
        """K3: counts of rows that inserted a key, that updated one, and that have no key. ``order``: see ``folded``."""
        self.create()
        new = written(folded(prepare(df, now=now), order=order), "upsert")
        touched = {str(r[0]) for r in new.select(self._bucket()).distinct().collect()}  # numbers below ``buckets``

        def change(data: dict[str, list[str]]):
            did = written(joined(self._rows(data), new, now=now), "merged")
            counts = did.agg(F.count_if(F.col("__did") == "inserted"), F.sum("__rows")).first()
            fresh = self._written(did.select([f.name for f in SCHEMA.fields]))
            drop_written(did)
            return fresh, (counts[0], (counts[1] or 0) - counts[0])

        inserted, updated = self._commit(self._version(), change, touched) if touched else (0, 0)
        drop_written(new)
        return {"inserted": inserted, "updated": updated, "errors": df.where(~F.coalesce(keyed(), F.lit(False))).count(), "table": self.name}

    def query(self, sql: str, params: list | None = None) -> DataFrame:
        """K9: any SQL over the session's views, with ``?`` for parameters."""
        return self.spark.sql(sql, args=list(params or []))

    def describe(self) -> DataFrame:
        """K10."""
        return self.spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(SCHEMA.fields)], "position int, column string, type string")

    def export_csv(self, path: str) -> None:
        """K7: rows that are no duplicates."""
        unique(self.frame()).write.mode("overwrite").option("header", True).csv(path)

    def stats(self) -> dict:
        """K8 from three small aggregates."""
        df = self.frame()
        total = totals(df).first().asDict()
        return total | {
            "by_source": {r.source_file: r.n for r in by_source(df).collect()},
            "by_state": {r.state: r.n for r in by_state(df).collect()},
        }


def unique(df: DataFrame) -> DataFrame:
    """Rows that are no duplicates."""
    return df.where(~F.col("is_duplicate"))


def totals(df: DataFrame) -> DataFrame:
    """A1, A2, A5: rows, duplicates, and average, least and greatest score."""
    s = F.col("data_quality_score")
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if("is_duplicate").alias("duplicates"), F.nullif(F.round(F.avg(s), 2), F.lit(0.0)).alias("avg_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"))


def by_source(df: DataFrame) -> DataFrame:
    """A3."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


def by_state(df: DataFrame) -> DataFrame:
    """A4, P10."""
    return df.where("state is not null").groupBy("state").agg(F.count(F.lit(1)).alias("n"))

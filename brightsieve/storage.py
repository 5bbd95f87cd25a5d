"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, a local session gets a temporary one; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if not held:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="brightsieve-"))
        held = spark.sparkContext.getCheckpointDir()
    return held.rstrip("/")


_OPEN: list[list[str]] = []


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/brightsieve/{what}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


@contextlib.contextmanager
def temporary(spark: SparkSession):
    """Tables written inside go when it ends; what is still to be read has to be written to a path from outside."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in made:
            remove(spark, path)


def written(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` written once and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a written table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_written(df: DataFrame) -> None:
    """Removes the table that ``written`` returned, once the last reader of it is done."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/brightsieve/" in path:
            remove(df.sparkSession, path)


def numbered(df: DataFrame, *order: str, name: str = "number", start: int = 0) -> DataFrame:
    """``df`` with consecutive numbers in the given order, without gathering it in one task.

    Rows are range partitioned, sorted and written; counts of the partitions (one row
    each) give each its offset.
    """
    place = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", place)
    held = written(ordered.withColumns({"__part": F.shiftright("__at", 33), "__row": F.col("__at").bitwiseAND((1 << 33) - 1)}).drop("__at"), "numbered")
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return held.join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part").withColumn(name, F.col("__before") + F.col("__row") + start).drop("__part", "__row", "__before")

"""S7 as Structured Streaming: files arrive, are projected by the same rules and upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.operators import quality, rules
from brightsieve.sources.store import LeadStore


def csv_stream(spark: SparkSession, folder: str, columns: list[str], files_per_trigger: int = 1, delimiter: str = ",") -> DataFrame:
    """Rows of a folder's CSV files as strings, with the file they came from."""
    reader = spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("sep", delimiter).option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.csv(folder)
    return rows.select(*columns, F.col("_metadata.file_name").alias("_source_file"))


def leads_stream(rows: DataFrame, schema: rules.Schema, key: str) -> DataFrame:
    """The compiled projection and scores over a stream; ``key`` becomes record_id."""
    return quality.score(rules.transform(rows, schema, keep=(key,))).withColumnRenamed(key, "record_id")


def upsert_stream(leads: DataFrame, store: LeadStore, checkpoint: str):
    """Starts the query that upserts each micro-batch; a batch that is repeated changes nothing."""
    return leads.writeStream.foreachBatch(lambda df, _: store.upsert(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unique_stream(rows: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    """Exact duplicates within the watermark dropped, state bounded by it."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)

"""Sharding by jump consistent hashing (Lamping and Veach).

A stable key's shard follows from the key and the number of shards alone: no
ring table is kept, and going from n to n+1 shards moves only the 1/(n+1) of
the keys that the new shard takes. Slots within a shard are dealt without ever
gathering a shard in one task: a shard is cut into hash-keyed blocks of bounded
size, block totals give each block its offset, and rows are numbered per block.

Defined cases: a null id hashes as 0 and comes first in its block; a null text
has 0 bytes and checksum 0; equal rows are counted before the shuffle and get
neighbouring slots; an empty table gives an empty result. Further columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Distinct rows that a block holds on average.
BLOCK_ROWS = 20_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys; the loop runs about ln(shards) times over the keys still jumping."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.full(len(key), -1, np.int64)
    jump = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            bucket[live] = jump[live]
            key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
            step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.int64) + 1)
            jump[live] = ((bucket[live] + 1) * step).astype(np.int64)
            live = live[jump[live] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards - 1``, of a long key; null counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(), shards).astype(np.int32))

    return jump(F.coalesce(key, F.lit(0)).cast("long"))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` for every row: slots run from 0 in each shard."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text_col, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    blocks = max(1, -(-docs.count() // (shards * BLOCK_ROWS)))
    kinds = (
        rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("shard", shard_of(F.col("doc_id"), shards))
        .withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks)).cast("int"))
    )
    within = W.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    numbered = kinds.withColumn("upto", F.sum("copies").over(within.rowsBetween(W.unboundedPreceding, W.currentRow)))
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        kinds.groupBy("shard", "block").agg(F.sum("copies").alias("held"))
        .select("shard", "block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    )
    return numbered.join(offsets, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard",
        F.explode(F.sequence(F.col("offset") + F.col("upto") - F.col("copies"), F.col("offset") + F.col("upto") - 1)).alias("slot"),
        "grown_shard",
    )


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

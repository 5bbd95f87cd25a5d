"""Profiles of a frame (A7 to A15): one aggregation over all columns, long results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brightsieve.operators.ranks import percentiles


def missing(df: DataFrame) -> DataFrame:
    """Nulls and their percentage by column, most first."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot("__n", df.columns, "column", "missing")
    return long.select("column", "missing", F.round(F.when(F.col("__n") > 0, F.col("missing") * 100.0 / F.col("__n")).otherwise(0.0), 2).alias("percent")).orderBy(F.desc("missing"), "column")


def numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, quartiles, variance, and bias-corrected skewness and kurtosis by column.

    The quartiles are found by narrowing ranges (``ranks``), so that no task holds a column's values.
    """
    columns = columns or [f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    quartiles = percentiles(df, columns, [0.25, 0.5, 0.75])

    def told(c):
        x = F.col(c).cast("double")
        n = F.count(x).cast("double")
        skew = F.when((n > 2) & (F.var_samp(x) > 0), F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(x))
        kurt = F.when((n > 3) & (F.var_samp(x) > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        return F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"), F.max(x).alias("max"), F.var_samp(x).alias("variance"), skew.alias("skewness"), kurt.alias("kurtosis"),
        )

    return df.agg(*[told(c).alias(f"c{i}") for i, c in enumerate(columns)]).select(F.explode(F.array(*[f"c{i}" for i in range(len(columns))])).alias("s")).select("s.*")


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values by column, nulls left out."""
    f = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[f(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "n_distinct")


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The commonest values of each column; ties in order of value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def shape(df: DataFrame) -> DataFrame:
    """Columns and their types, with the number of rows."""
    kinds = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("type")) for n, t in df.dtypes])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(kinds).alias("k"), "rows").select("k.column", "k.type", "rows")

"""Facility classification: keywords, or an injected client over distinct descriptions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.functions.vocab import FACILITY_KEYWORDS


def by_keywords(c: Column) -> Column:
    """Struct of original, category, confidence and source; the first keyword that the text contains decides."""
    text = F.lower(c)
    category = None
    for name, words in FACILITY_KEYWORDS.items():
        for word in words:
            hit = text.contains(word)
            category = F.when(hit, name) if category is None else category.when(hit, name)
    empty = c.isNull() | (c == "")
    return F.struct(
        c.alias("original"), F.when(empty, "Other").otherwise(F.coalesce(category, F.lit("Other"))).alias("category"),
        F.when(empty, 0.0).when(category.isNotNull(), 0.7).otherwise(0.5).alias("confidence"), F.lit("rules").alias("source"),
    )


def classify(df: DataFrame, column: str, client: Callable[[list[str]], list[dict]] | None = None, batch: int = 20) -> DataFrame:
    """``df`` with category, confidence and source.

    A client gets the distinct texts in batches and gives a category and confidence
    for each, in order; what it leaves out, and all without a client, goes by keywords.
    """
    if client is None:
        told = by_keywords(F.col(column))
        return df.withColumns({"category": told["category"], "confidence": told["confidence"], "source": told["source"]})
    texts = df.select(F.trim(column).alias("__text")).where("__text != ''").distinct()

    def ask(frames):
        for frame in frames:
            for at in range(0, len(frame), batch):
                own = frame["__text"].iloc[at : at + batch].tolist()
                got = list(client(own))[: len(own)]
                got += [{}] * (len(own) - len(got))
                yield pd.DataFrame({"__text": own, "__category": [g.get("category") for g in got], "__confidence": [g.get("confidence") for g in got]})

    answers = texts.mapInPandas(ask, "__text string, __category string, __confidence double")
    joined = df.withColumn("__text", F.trim(column)).join(answers, "__text", "left")
    rules = by_keywords(F.col(column))
    return joined.withColumns({
        "category": F.coalesce("__category", rules["category"]), "confidence": F.when(F.col("__category").isNotNull(), F.col("__confidence")).otherwise(rules["confidence"]),
        "source": F.when(F.col("__category").isNotNull(), "llm").otherwise("rules"),
    }).drop("__text", "__category", "__confidence")


def cache_stats(answers: DataFrame) -> DataFrame:
    """C4: how many texts each category holds."""
    return answers.groupBy("category").agg(F.count(F.lit(1)).alias("n"))

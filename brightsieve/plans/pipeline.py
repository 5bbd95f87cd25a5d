"""The lead pipeline: extract, map, normalise, deduplicate, score, upsert."""

from __future__ import annotations

import argparse
import datetime as dt
import os
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.operators import classify, dedup, quality, rules
from brightsieve.plans.mapping import SchemaCache, schema_for
from brightsieve.sources.csv_splits import PLACE
from brightsieve.sources.files import Registry, extract
from brightsieve.sources.store import LeadStore
from brightsieve.storage import numbered, written


def union_all(frames: list[DataFrame]) -> DataFrame:
    """By name, columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_leads(name: str, df: DataFrame, cache=None, client=None, source=None, defaults=None, **options) -> DataFrame:
    """The canonical columns of one source, with source_file, record_id and the row's place."""
    stem = os.path.splitext(name)[0]
    placed = df if PLACE in df.columns else df.withColumn(PLACE, F.monotonically_increasing_id())
    made = rules.transform(placed, schema_for(df.drop(PLACE), cache, client, source, defaults), keep=(PLACE,), **options)
    rows = numbered(made, PLACE, name="__n").drop(PLACE)
    return rows.withColumns({"source_file": F.lit(name), "record_id": F.format_string(f"{stem.replace('%', '%%')}_%08d", "__n")})


def enrich(leads: DataFrame, batch_id: str, describe: str | None = None, client=None) -> DataFrame:
    """Classification (if a column is named, its category takes its place), duplicates in file and row order, scores and batch."""
    if describe:
        told = classify.classify(leads.withColumn(describe, F.coalesce(describe, F.lit(""))), describe, client)
        leads = told.withColumns({describe: F.col("category"), "ai_facility_type_confidence": F.col("confidence")}).drop("category", "confidence", "source")
    ordered = numbered(leads, "source_file", "__n", name="row_ix").drop("__n")
    scored = quality.score(dedup.mark_exact(written(ordered, "leads")))
    return scored.drop("row_ix").withColumns({"batch_id": F.lit(batch_id), "ingestion_timestamp": F.current_timestamp()})


def run(spark: SparkSession, folder: str, pattern: str = "*", store: LeadStore | None = None, cache_dir: str | None = None, client=None, export: str | None = None, registry: Registry | None = None, defaults: rules.Schema | None = None, classifier=None) -> dict:
    """The whole pipeline; counts, mean score and seconds.

    ``classifier`` names facility types: True for keywords, or a client as ``classify`` takes it.
    """
    began = time.time()
    batch = dt.datetime.now().strftime("batch_%Y%m%d_%H%M%S")
    sources = extract(spark, folder, pattern, registry)
    if not sources:
        return {"files": 0, "records": 0, "duplicates": 0, "average_score": None, "seconds": time.time() - began}
    cache = SchemaCache(cache_dir) if cache_dir else None
    leads = union_all([to_leads(n, df, cache, client, registry.match(n) if registry else None, defaults) for n, df in sorted(sources.items())])
    final = written(enrich(leads, batch, "facility_type" if classifier else None, classifier if callable(classifier) else None), "final")
    store = store or LeadStore(spark)
    loaded = store.upsert(final)
    if export:
        store.export_csv(export)
    n = final.agg(F.count(F.lit(1)).alias("records"), F.count_if("is_duplicate").alias("duplicates"), F.round(F.avg("data_quality_score"), 2).alias("average_score")).first()
    return {"files": len(sources), **n.asDict(), "load": loaded, "stats": store.stats(), "seconds": time.time() - began}


def main(args: list[str] | None = None) -> None:
    from brightsieve.session import build_session

    p = argparse.ArgumentParser(description="lead pipeline")
    p.add_argument("folder")
    p.add_argument("--pattern", default="*")
    p.add_argument("--cache")
    p.add_argument("--export")
    p.add_argument("--store", help="where the lead table lies; it is kept from run to run")
    p.add_argument("--registry", help="a YAML file of sources")
    p.add_argument("--rules", help="a YAML file of default rules")
    p.add_argument("--classify", action="store_true", help="name facility types by keywords")
    a = p.parse_args(args)
    spark = build_session()
    print(run(
        spark, a.folder, a.pattern, LeadStore(spark, a.store) if a.store else None, a.cache, export=a.export,
        registry=Registry(a.registry) if a.registry else None, defaults=rules.load_rules(a.rules) if a.rules else None, classifier=a.classify or None,
    ))


if __name__ == "__main__":
    main()

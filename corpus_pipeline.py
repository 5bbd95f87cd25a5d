"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage works on all that the one before kept. The first four return the
columns of ``documents``; the last returns each document's token digests. The
driver counts this module as part of the llm subpackage.

Defined cases: an empty table stays empty through all stages; a null text counts
as empty (and stays null) in each; rows without an id are kept like others but
for near-dedup, where they stay only in groups in which no row has an id; of
repeated rows near-dedup keeps one; ties go by id, then by the text's hash;
columns beyond those of ``documents`` pass through the first four stages. What
a stage writes for itself is removed once its result is written, and its result
once the next one's is.
"""

from __future__ import annotations

from brightsieve.llm import bpe, decontaminate, pii, quality, simhash
from brightsieve.llm.base import new_path, remove, temporary

STAGES = [
    ("quality classifier", quality.stage),
    ("SimHash near-dedup", simhash.keep_one),
    ("benchmark decontamination", decontaminate.stage),
    ("PII", pii.stage),
    ("BPE encoding and decoding", bpe.stage),
]

#: Stages 1, 2, 4 and 5 are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, "pipeline-" + name.split()[0].lower())
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs

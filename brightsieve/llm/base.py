"""Helpers that the operators share: written tables (from ``brightsieve.storage``), ASCII lower case, and lean Arrow workers."""

from __future__ import annotations

import ctypes
import functools
import gc
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightsieve.storage import drop_written, new_path, remove, shared_dir, temporary, written

__all__ = ["ascii_lower", "drop_written", "lean", "new_path", "remove", "shared_dir", "sheltered", "slices", "temporary", "texts_of", "written"]

#: Bytes of text that are Python objects at once.
SLICE_BYTES = 2 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. ``lower`` is right, and much faster, where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def slices(batch: pa.RecordBatch, place: int, most: int = SLICE_BYTES):
    """``batch`` in runs of rows whose column ``place`` holds about ``most`` bytes; a longer value is a run of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        before = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, place: int) -> list[bytes]:
    """A text column as UTF-8; null counts as empty."""
    return [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]


def lean(run):
    """``run`` for ``mapInArrow``; when its task ends, memory that the worker no longer uses goes back to the system."""

    @functools.wraps(run)
    def running(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library: nothing to trim
                pass

    return running


def sheltered(docs: DataFrame, run) -> DataFrame:
    """``run(docs)``, which keeps all columns, with those whose names begin with two underscores, as the operators' own do, under others meanwhile."""
    names, taken = docs.columns, {c.lower() for c in docs.columns}
    if not any(c.startswith("__") for c in names):
        return run(docs)
    free = (n for n in (f"column{i}" for i in range(2 * len(names))) if n not in taken)
    other = [next(free) if c.startswith("__") else c for c in names]
    return run(docs.toDF(*other)).select(other).toDF(*names)

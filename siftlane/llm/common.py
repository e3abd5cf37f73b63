"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def worker_cache(name: str) -> dict:
    """A dict that outlives the task in a reused Python worker.  Callers bound
    its size; an empty one (a new worker) only costs time.  A worker keeps
    that of one operator: another's is dropped first."""
    mod = sys.modules.setdefault("_siftlane_worker", types.ModuleType("_siftlane_worker"))
    caches = mod.__dict__.setdefault("caches", {})
    if name not in caches:
        caches.clear()
    return caches.setdefault(name, {})


#: Rows of an Arrow batch that are Python objects at once.
SLICE_ROWS = 1000


def per_batch(fn: Callable[..., dict], *columns: str, schema: pa.Schema):
    """A mapInArrow function that calls ``fn(column values, ...)`` for every
    SLICE_ROWS rows and yields the dict of columns it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                yield pa.RecordBatch.from_pydict(fn(*(part.column(c).to_pylist() for c in columns)), schema=schema)

    return run

"""Arrow batches in pieces of bounded text."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from roost.sources.ship import ship_package

TEXT_BYTES = 4_000_000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARK_ROWS = "10000"
# Of ten thousand whole texts an executor holds several batches at once; a thousand keep a call as busy.
BATCH_ROWS = 1000


def ready_workers(spark: SparkSession) -> None:
    """Send the package; let rows travel in batches of BATCH_ROWS where the session has Spark's own number."""
    ship_package(spark)
    if spark.conf.get(ROWS_SETTING) == SPARK_ROWS:
        spark.conf.set(ROWS_SETTING, str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the machine: a worker outlives its task, and the next stage needs the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose values in ``column`` hold about ``most`` bytes, or elements of a list.

    A longer value is a piece of its own.
    """
    if not batch.num_rows:
        return
    values = batch.column(column)
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()

"""Arrow batches in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import SparkSession

SLICE_BYTES = 4 << 20
# Rows that Spark hands a Python worker at once where they hold texts; its own 10,000 take tens
# of megabytes, in the executor and once more in the worker, which keeps them.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run within hand their Python workers few rows at once."""
    rows = spark.conf.get(_ROWS)
    if 0 < int(rows) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_ROWS, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_ROWS, rows)


def sliced(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text, its first column, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for first, last in zip(starts, [*starts[1:], len(part)]):
            yield batch.slice(first, last - first)


def views(texts: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 bytes of every text without a copy; a null text is an empty one."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")
    missing = texts.is_null().to_numpy(zero_copy_only=False)
    for null, start, end in zip(missing, offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[0:0] if null else data[start:end]

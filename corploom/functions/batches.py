"""Arrow batches of bounded size, and workers that give memory back."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

_OWN_PAGES = 256 << 10  # arrays of this size and more get pages of their own


def _return_memory():
    """Arrays give their pages back when they are freed. Otherwise a worker, which Spark uses for
    many tasks, keeps what its largest batch ever took. Where the C library has no such setting,
    all stays as it is."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).mallopt(-3, _OWN_PAGES)  # fixed value: M_MMAP_THRESHOLD
    except (AttributeError, OSError):
        pass


_return_memory()


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_USUAL_ROWS, _FEW_ROWS = "10000", "1000"  # Spark's own setting, and some MB of ordinary documents


def small_batches(spark: SparkSession):
    """Spark hands texts to Python in batches of rows, which it holds on both sides. Its default fits
    narrow rows; whole documents fill 25 MB and more, and their ids four times as much. A setting of
    the session's own stays."""
    if spark.conf.get(_BATCH_ROWS) == _USUAL_ROWS:
        spark.conf.set(_BATCH_ROWS, _FEW_ROWS)

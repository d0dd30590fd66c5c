"""Bounds on what Python workers hold."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KEY, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bound_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Batches of so many bytes on their way to Python, where the session has Spark's own bound.

    A batch is held by the JVM, by Arrow and as Python's strings at once, and a worker that has served one stage serves
    the next, so several stages in one session hold what their largest batches took."""
    now = spark.conf.get(_KEY, f"{_DEFAULT}b")
    if now in (f"{_DEFAULT}b", str(_DEFAULT), "64m", "64MB"):
        spark.conf.set(_KEY, str(size))

"""Python workers import this package too; where they may not find it, Spark sends it to them."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch, unless the session has a number of its own: they hold whole texts.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Add the package to the session's files, once, unless the workers' path already holds it; keep batches small."""
    if spark.conf.get(_BATCH) == "10000":  # Spark's default; a batch of so many texts is too much for a worker
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _sent or _ROOT in path:
        return
    folder = tempfile.mkdtemp(prefix="salesmill-package-")  # read by the driver, which serves it to executors
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/salesmill", "zip", _ROOT, "salesmill"))
    _sent.add(app)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that start inside send so many rows in an Arrow batch, for rows of several MB."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)

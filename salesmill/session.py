"""Session helpers: a local builder for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def local_session(cpus: int | str | None = None, app: str = "salesmill") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        # The test tables are a few MB; without this a scan would use half of the cores.
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own machine.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="salesmill-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/salesmill/{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back; `codec` is Parquet's, by default the session's.

    For a result used several times in one plan: its lineage is cut, a lost executor costs one
    re-read, and the file sizes let Spark check its size before broadcasting it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(spark: SparkSession, steps: Sequence[Callable[[], object]]) -> list:
    """Submit independent steps from threads of their own, so Spark can run their jobs side by side."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]

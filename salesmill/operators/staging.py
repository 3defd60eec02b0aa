"""Staging: a full copy of each source table, replaced on every run."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from salesmill.operators.inference import SPARK_TYPES, TEXT, infer_column_types
from salesmill.operators.quality import union_all
from salesmill.session import in_parallel
from salesmill.sources.sink import write_table

log = logging.getLogger("salesmill")


def typed(df: DataFrame) -> DataFrame:
    """Cast text columns to the types that all of their values are written in; others stay as they are.

    Reads the source once more than the copy does.
    """
    found = {r["column"]: r["type"] for r in infer_column_types(df, parse_text=True).collect()}  # a row a column
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.col(f"`{c}`").cast(SPARK_TYPES[found[c]]) for c in text if found[c] != TEXT})


def stage_table(source: Mapping[str, DataFrame], name: str, target: str, infer: bool = False) -> DataFrame:
    """Replace one staging table. An empty source keeps its real columns.

    With `infer`, columns of an untyped extract get the types their values are written in.
    """
    df, path = typed(source[name]) if infer else source[name], f"{target}/{name}"
    write_table(df, path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    if staged.isEmpty():
        log.warning("%s is empty", name)
    return staged


def stage_all(
    spark: SparkSession, source: Mapping[str, DataFrame], target: str, infer: bool = False
) -> dict[str, DataFrame]:
    """Copy every table of `source`; each is written by its own distributed job."""
    names = list(source.keys())
    staged = in_parallel(spark, [partial(stage_table, source, n, target, infer) for n in names])
    return dict(zip(names, staged))


def staged_rows(staged: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows); a staged count reads Parquet footers only."""
    return union_all(
        staged[name].agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name in staged.keys()
    )

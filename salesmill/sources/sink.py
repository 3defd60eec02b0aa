"""Writing results out: Parquet folders by default, a database table where one is wanted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Rows a page when rows are inserted into a database.
PAGE_ROWS = 500


def jdbc_sink_options(url: str, table: str, page_rows: int = PAGE_ROWS, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(page_rows), **extra}


def write_table(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
) -> None:
    """Every task writes its own rows; nothing passes through the driver."""
    writer = df.write.format(fmt).mode(mode).options(**dict(options or {}))
    writer.save(path) if path else writer.save()

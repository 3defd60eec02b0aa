"""Reading source tables: whole, with the needed columns only, from any format Spark can read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: Predicates of one extract; each is one task and one string on the driver.
MAX_SPLITS = 4096


def extract(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    columns: Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """One source table with all its rows; `columns` prunes at the scan."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    return df.select(*columns) if columns else df


def jdbc_options(
    url: str,
    table: str,
    split_column: str | None = None,
    low: int | None = None,
    high: int | None = None,
    parts: int | None = None,
    fetch_size: int = 10_000,
    small: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Options for a JDBC extract that `parts` tasks read at once, cut by ranges of the split column.

    Only a table declared `small` may be read by one task.
    """
    if split_column is None and not small:
        raise ValueError(f"{table}: give a split column with low, high and parts, or declare the table small")
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if split_column is not None:
        if None in (low, high, parts):
            raise ValueError("a split column needs low, high and parts")
        opts.update(
            partitionColumn=split_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(parts),
        )
    return opts


def split_points(keys: DataFrame, column: str, parts: int) -> list:
    """Values that cut the rows of `keys` into `parts` of near-equal size: quantiles of a number, date or timestamp.

    `keys` may be the table itself, an earlier staging of it, or an index table. Equal values are never
    cut, so a value that makes up several parts gives fewer points. NULLs and empty tables give none.
    """
    kind = keys.schema[column].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"{column} is {kind.simpleString()}: split it by hash_predicates")
    if not 1 <= parts <= MAX_SPLITS:
        raise ValueError(f"{parts} parts, 1 to {MAX_SPLITS} are allowed")
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, shares, max(10_000, 20 * parts))).first()[0] or []
    return sorted(set(found))


def _literal(value) -> str:
    """A value as the database reads it; dates and times in quotes."""
    return f"'{value}'" if not isinstance(value, (int, float)) and not hasattr(value, "as_tuple") else str(value)


def range_predicates(column: str, points: Sequence) -> list[str]:
    """Conditions, one per part, that every row meets exactly one of; a NULL is in the first part."""
    points = [_literal(p) for p in points]
    if not points:
        return ["1 = 1"]
    middle = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(points, points[1:])]
    return [f"({column} <= {points[0]} OR {column} IS NULL)", *middle, f"{column} > {points[-1]}"]


def hash_predicates(column: str, parts: int, bucket: str = "MOD(ABS(CHECKSUM({column})), {parts})") -> list[str]:
    """Conditions, one per part, by a hash of a text key; `bucket` is the database's expression for 0 to parts - 1."""
    if not 1 <= parts <= MAX_SPLITS:
        raise ValueError(f"{parts} parts, 1 to {MAX_SPLITS} are allowed")
    number = bucket.format(column=column, parts=parts)
    first = f"({number} = 0 OR {column} IS NULL)"
    return [first, *[f"({number} = {i} AND {column} IS NOT NULL)" for i in range(1, parts)]]


def split_predicates(keys: DataFrame, column: str, parts: int, **hashed: str) -> list[str]:
    """Conditions for an extract that `parts` tasks read at once, derived from the key's values or, for text, its hash."""
    kind = keys.schema[column].dataType
    if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return range_predicates(column, split_points(keys, column, parts))
    return hash_predicates(column, parts, **hashed)


def extract_jdbc(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], columns: Iterable[str] | None = None, **properties: str
) -> DataFrame:
    """A database table by one task per predicate; `columns` prunes in the database."""
    df = spark.read.jdbc(url, table, predicates=list(predicates), properties={"fetchsize": "10000", **properties})
    return df.select(*columns) if columns else df

"""Column types of a staging table, judged by all of its rows instead of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

BOOLEAN, INTEGER, DOUBLE = "BOOLEAN", "INTEGER", "DOUBLE PRECISION"
NUMERIC, TIMESTAMP, TEXT = "NUMERIC(18,4)", "TIMESTAMP", "TEXT"

#: What a staged column of each type is in Spark.
SPARK_TYPES = {
    BOOLEAN: "boolean", INTEGER: "bigint", DOUBLE: "double", NUMERIC: "decimal(18,4)", TIMESTAMP: "timestamp_ntz", TEXT: "string",
}

# Written forms of values in an untyped text extract.
TEXT_FORMS = {
    BOOLEAN: r"^(?:[Tt]rue|[Ff]alse)$",
    INTEGER: r"^[+-]?[0-9]+$",
    NUMERIC: r"^[+-]?[0-9]+\.[0-9]+$",
    DOUBLE: r"^[+-]?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]+$",
    TIMESTAMP: r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?$",
}
DATE_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _declared(kind: T.DataType, date_as_timestamp: bool) -> str:
    if isinstance(kind, T.BooleanType):
        return BOOLEAN
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INTEGER
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return DOUBLE
    if isinstance(kind, T.DecimalType):
        return NUMERIC
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP
    if isinstance(kind, T.DateType) and date_as_timestamp:
        return TIMESTAMP
    return TEXT


def _found(c: Column, kind: T.DataType, parse_text: bool, date_as_timestamp: bool) -> Column:
    """Type of one value; NULL for a missing value."""
    if not (parse_text and isinstance(kind, T.StringType)):
        return F.when(c.isNotNull(), _declared(kind, date_as_timestamp))
    form = F.when(c.isNull(), F.lit(None))
    for name, pattern in TEXT_FORMS.items():
        form = form.when(c.rlike(pattern), name)
    return form.when(c.rlike(DATE_FORM), TIMESTAMP if date_as_timestamp else TEXT).otherwise(TEXT)


def _common(kinds: Column) -> Column:
    """One type for a set of types: the only one, whole numbers widened to decimals, else text."""
    numbers = F.array(F.lit(INTEGER), F.lit(NUMERIC))
    return (
        F.when(F.size(kinds) == 0, TEXT)
        .when(F.size(kinds) == 1, F.element_at(kinds, 1))
        .when(F.size(F.array_except(kinds, numbers)) == 0, NUMERIC)
        .otherwise(TEXT)
    )


def infer_column_types(
    df: DataFrame,
    null_as_text: bool = False,
    date_as_timestamp: bool = False,
    parse_text: bool = False,
) -> DataFrame:
    """(column, type) for every column, in one pass.

    `null_as_text` and `date_as_timestamp` are the rules of the older model. With `parse_text`
    the values of string columns are judged by how they are written; otherwise a string is text.
    Each column's set of types has at most seven members, so the one-row aggregate stays small.
    """
    lines = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if parse_text and isinstance(field.dataType, T.StringType):
            kind = _found(value, field.dataType, parse_text, date_as_timestamp)
            kinds = F.collect_set(F.coalesce(kind, F.lit(TEXT)) if null_as_text else kind)
        else:  # the declared type; what is left to learn is whether values are there, and whether some are not
            there = F.when(F.max(value.isNotNull()), F.array(F.lit(_declared(field.dataType, date_as_timestamp))))
            gone = F.when(F.max(value.isNull()) & F.lit(null_as_text), F.array(F.lit(TEXT)))
            none = F.array().cast("array<string>")
            kinds = F.array_union(F.coalesce(there, none), F.coalesce(gone, none))
        lines.append(F.struct(F.lit(field.name).alias("column"), kinds.alias("kinds")))
    return (
        df.agg(F.array(*lines).alias("_lines"))
        .select(F.inline("_lines"))
        .select("column", _common(F.col("kinds")).alias("type"))
    )

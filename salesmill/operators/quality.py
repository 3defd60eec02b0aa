"""The constraints of the warehouse as counting queries. Zero means the constraint holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from salesmill.schemas import Table


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _counter(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _per_column(df: DataFrame, rows: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One pass over `df`; one output row per entry, made of that entry's aggregates and literals."""
    line = F.array(*[F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows.values()])
    return df.agg(line.alias("_lines")).select(F.inline("_lines"))


def repeated_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (NULL keys do not count), and the rows too many."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    twice = df.where(known).groupBy(*keys).count().where("count > 1")
    return twice.agg(
        F.lit(table).alias("table"),
        F.lit("+".join(keys)).alias("key"),
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("rows_too_many"),
    )


def missing_values(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, {
        c: {
            "table": F.lit(table),
            "column": F.lit(c),
            "rows": F.count(F.lit(1)),
            "missing": _counter(F.col(c).isNull()),
        }
        for c in columns
    })


def orphans(df: DataFrame, table: str, column: str, target: DataFrame, target_name: str, target_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no target.

    References are counted per distinct value first: a value held by a third of all rows enters
    the join as one row.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
    known = target.select(F.col(target_column).alias("_ref"), F.lit(True).alias("_known"))
    return used.join(known, "_ref", "left").agg(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(target_name).alias("target"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("references"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("orphans"),
    )


def overflows(df: DataFrame, table: str, targets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Values that would not fit a decimal type; `targets` is label -> (expression, type)."""
    return _per_column(df, {
        label: {
            "table": F.lit(table),
            "column": F.lit(label),
            "type": F.lit(kind),
            "values": F.count(F.expr(source)),
            "overflows": _counter(F.expr(source).isNotNull() & F.expr(source).try_cast(kind).isNull()),
        }
        for label, (source, kind) in targets.items()
    })


def overlong(df: DataFrame, table: str, limits: Mapping[str, int]) -> DataFrame:
    return _per_column(df, {
        c: {
            "table": F.lit(table),
            "column": F.lit(c),
            "allowed": F.lit(limit).cast("bigint"),
            "longest": F.max(F.length(c)).cast("bigint"),
            "overlong": _counter(F.length(c) > limit),
        }
        for c, limit in limits.items()
    })


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()
    )


def against_expected(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Row counts beside the expected ones (columns table, expected)."""
    return counts.join(expected, "table", "full_outer").select(
        "table", "rows", "expected", F.col("rows").eqNullSafe(F.col("expected")).alias("as_expected")
    )


class QualityError(ValueError):
    """A constraint does not hold; nothing was published."""


def counters(table: Table) -> dict[str, Column]:
    """Aggregates that count broken constraints of single rows; also the number of rows."""
    broken = {f"{c} is missing": F.col(c).isNull() for c in table.required}
    broken |= {f"{c} is longer than {n}": F.length(c) > n for c, n in table.limits.items()}
    return {"rows": F.count(F.lit(1)), **{label: _counter(found) for label, found in broken.items()}}


def enforce(table: Table, counted: Mapping[str, int]) -> None:
    """Stop if any counter of `counters` other than the row count is above 0."""
    bad = {label: n for label, n in counted.items() if label != "rows" and n}
    if bad:
        raise QualityError(f"{table.name}: {bad}")


def _key_value(df: DataFrame, number: int, columns: Sequence[str]) -> Column:
    """A key as (check, a, b, text), for one column of all keys; check is NULL if the key is not complete."""
    whole = len(columns) < 3 and all(isinstance(df.schema[c].dataType, IntegralType) for c in columns)
    complete = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
    a, b = [F.col(c).cast("bigint") if whole else F.lit(None).cast("bigint") for c in (columns[0], columns[-1])]
    text = F.lit(None).cast("string") if whole else F.concat_ws("\x01", *[F.col(c).cast("string") for c in columns])
    return F.struct(F.when(complete, F.lit(number)).alias("check"), a.alias("a"), b.alias("b"), text.alias("text"))


def key_faults(df: DataFrame, table: Table, targets: Mapping[str, DataFrame]) -> DataFrame:
    """(check, values, lost): repeated keys and references without target, in one pass over `df`.

    Checks 0 and 1 are the surrogate and the natural key, `values` how many of their values come more than
    once; the next are the table's references in order, `lost` their rows without a row in the target. Every
    row gives its keys and references as values; equal values are counted before they are shuffled, and
    only repeated keys and distinct references reach the join.
    """
    keys = [[table.surrogate], list(table.natural)]
    checked = [*keys, *[[c] for c in table.references]]
    values = F.array(*[_key_value(df, i, columns) for i, columns in enumerate(checked)])
    counted = df.select(F.inline(values)).where("check is not null").groupBy("check", "a", "b", "text").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.where(f"check >= {len(keys)} or n > 1")
    if not table.references:
        return counted.groupBy("check").agg(F.count(F.lit(1)).alias("values"), F.lit(0).cast("bigint").alias("lost"))
    known = union_all(
        targets[name].select(F.lit(len(keys) + i).alias("check"), F.col(key).cast("bigint").alias("a"), F.lit(True).alias("known"))
        for i, (name, key) in enumerate(table.references.values())
    )
    return counted.join(known, ["check", "a"], "left").groupBy("check").agg(
        F.count(F.lit(1)).alias("values"),
        F.coalesce(F.sum(F.when(F.col("known").isNull() & (F.col("check") >= len(keys)), F.col("n"))), F.lit(0)).alias("lost"),
    )


def _word(value: Column) -> Column:
    return F.shiftright(value.cast("bigint"), 6)


def _bit(value: Column) -> Column:
    """The value's place in its word of 64 values, as one bit."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), value.cast("bigint").bitwiseAND(63).cast("int"))


def _key_bit(df: DataFrame, number: int, columns: Sequence[str]) -> Column:
    """A key as in `_key_value`, but with the word of its last whole number, and that number's bit."""
    key = _key_value(df, number, columns)
    if not all(isinstance(df.schema[c].dataType, IntegralType) for c in columns) or len(columns) > 2:
        return F.struct(key["check"].alias("check"), key["a"].alias("a"), key["b"].alias("b"), key["text"].alias("text"), F.lit(1).cast("bigint").alias("bit"))
    word, single = _word(F.col(columns[-1])), len(columns) == 1
    a, b = (word, F.lit(None).cast("bigint")) if single else (key["a"], word)
    return F.struct(key["check"].alias("check"), a.alias("a"), b.alias("b"), key["text"].alias("text"), _bit(F.col(columns[-1])).alias("bit"))


def doubtful_keys(df: DataFrame, table: Table, targets: Mapping[str, DataFrame]) -> DataFrame:
    """One row, `doubtful`: 0 if and only if `key_faults` has no fault to tell.

    Exact, but moves far less: 64 neighbouring values of a key or a reference meet in one row with a bit each.
    A key repeats where more values than bits were seen, a reference is lost where its bit is not the target's.
    """
    keys = [[table.surrogate], list(table.natural)]
    checked = [*keys, *[[c] for c in table.references]]
    values = F.array(*[_key_bit(df, i, columns) for i, columns in enumerate(checked)])
    seen = df.select(F.inline(values)).where("check is not null").groupBy("check", "a", "b", "text").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("bits"))
    repeated = (F.col("check") < len(keys)) & (F.col("n") > F.bit_count("bits"))
    if not table.references:
        return seen.agg(F.count_if(repeated).alias("doubtful"))
    known = union_all(
        targets[name].where(F.col(key).isNotNull()).select(F.lit(len(keys) + i).alias("check"), _word(F.col(key)).alias("a"), _bit(F.col(key)).alias("bit"))
        for i, (name, key) in enumerate(table.references.values())
    ).groupBy("check", "a").agg(F.bit_or("bit").alias("known"))
    lost = (F.col("check") >= len(keys)) & (F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint")))) != 0)
    return seen.join(known, ["check", "a"], "left").agg(F.count_if(repeated | lost).alias("doubtful"))


def enforce_keys(df: DataFrame, table: Table, targets: Mapping[str, DataFrame]) -> None:
    """Stop if the surrogate or the natural key of `df` repeats, or if a reference has no target.

    Faults are only counted and named once there are any.
    """
    if not doubtful_keys(df, table, targets).first()["doubtful"]:
        return
    keys, references = [[table.surrogate], list(table.natural)], list(table.references.items())
    for r in key_faults(df, table, targets).orderBy("check").collect():  # a row a check
        if r["check"] < len(keys):
            raise QualityError(f"{table.name}: {r['values']} values of {'+'.join(keys[r['check']])} come more than once")
        column, (name, _) = references[r["check"] - len(keys)]
        if r["lost"]:
            raise QualityError(f"{table.name}.{column}: {r['lost']} rows without a row in {name}")

"""Running totals and dense numbering over a global order without a one-task window.

The ordered column is cut into value ranges. A row's range depends on its value alone, so a task
run again after a lost executor puts every row where it was before. Totals per range give each
range its offset; the window then runs inside each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_RANGES = 8192


def range_count(df: DataFrame, wanted: int | None = None) -> int:
    """As many ranges as the session has shuffle partitions, within a bound for the driver."""
    n = wanted or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(n, MAX_RANGES))


def range_of(value: Column, points: Column, n: int) -> Column:
    """How many of the `n - 1` sorted cut points lie below `value` (0 .. n-1), in log2(n) steps."""
    steps = [1 << k for k in reversed(range(max(n - 1, 1).bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(points, at + step - 1) < value, at + step).otherwise(at),
    )
    return F.coalesce(found, F.lit(0))


def _cuts(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], max(10_000, 20 * n)))


def cut_points(df: DataFrame, order: str, n: int) -> Column:
    """Cut points found now, as a constant, for ranges that several queries must share: found twice they may
    differ, because approximate quantiles depend on the order in which rows and partial results come.
    """
    found = (_cuts(df, order, n).first()[0] if n > 1 else None) or []
    return F.array(*[F.lit(c) for c in found]).cast(f"array<{df.schema[order].dataType.simpleString()}>")


def with_ranges(df: DataFrame, order: str, n: int, cuts: Column | None = None) -> DataFrame:
    """Add `_range`; without `cuts` the cut points are a one-row subquery, so nothing runs until the result is used."""
    if n == 1:
        return df.withColumn("_range", F.lit(0))
    cuts = _cuts(df, order, n).scalar() if cuts is None else cuts
    return df.withColumn("_cuts", cuts).withColumn("_range", range_of(F.col(order), F.col("_cuts"), n)).drop("_cuts")


def _offsets(ranged: DataFrame, amount: Column, ascending: bool) -> DataFrame:
    """Total of all ranges before each one. One row per range: at most MAX_RANGES rows."""
    totals = ranged.groupBy("_range").agg(amount.alias("_total"))
    order = F.col("_range").asc() if ascending else F.col("_range").desc()
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_range", F.sum("_total").over(before).alias("_before"))


def dense_rank_by(df: DataFrame, key: str, out: str, start: int = 0, ranges: int | None = None) -> DataFrame:
    """Number the rows start+1, start+2, ... by ascending `key`, which must be unique and not NULL."""
    ranged = with_ranges(df, key, range_count(df, ranges))
    offsets = _offsets(ranged, F.count(F.lit(1)), ascending=True)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.lit(start).cast("bigint") + F.coalesce("_before", F.lit(0)) + F.col("_inside"))
        .drop("_range", "_inside", "_before")
    )


def running_total_desc(df: DataFrame, value: str, out: str, ranges: int | None = None) -> DataFrame:
    """Sum of `value` over all rows at or above this row's value; rows of equal value share it.

    A row without a value keeps a NULL total.

    Equal values are added up first, so however many rows share one value, the ordered part sees
    it once. The join back is a plain equi-join whose hot values adaptive execution can split.
    """
    by_value = df.groupBy(value).agg(F.sum(value).alias("_part"))
    ranged = with_ranges(by_value, value, range_count(df, ranges))
    offsets = _offsets(ranged, F.sum("_part"), ascending=False)
    upto = Window.partitionBy("_range").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        ranged.withColumn("_inside", F.sum("_part").over(upto))
        .join(F.broadcast(offsets), "_range")
        .select(F.col(value).alias("_value"), (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(out))
    )
    return df.join(sums, F.col(value) == F.col("_value"), "left").drop("_value")

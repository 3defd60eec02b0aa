"""Split conditions of a database extract, derived from the keys and tried on Spark's own SQL."""

import datetime

import pytest
from pyspark.sql import functions as F

from salesmill.sources.extract import hash_predicates, range_predicates, split_points, split_predicates


def parts(df, predicates):
    """Rows that meet each condition; every row must meet exactly one."""
    met = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    total = sum(met[1:], met[0])
    assert df.where(total != 1).count() == 0
    return [df.where(p).count() for p in predicates]


def test_quantiles_cut_skewed_keys_evenly(spark):
    ids = spark.range(10_000).select((F.col("id") * F.col("id")).alias("k"))  # low bounds and steps would be uneven
    predicates = split_predicates(ids, "k", 8)
    assert len(predicates) == 8
    assert all(1150 <= n <= 1350 for n in parts(ids, predicates))


def test_a_hot_value_is_not_cut_and_null_has_a_part(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    predicates = split_predicates(df, "k", 6)
    assert len(predicates) < 6
    counts = parts(df, predicates)
    assert sum(counts) == 3_000 and counts[0] >= 2_000


def test_dates_decimals_and_empty_tables(spark):
    days = spark.range(100).select(F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("id").cast("int")).alias("d"))
    assert sum(parts(days, split_predicates(days, "d", 4))) == 100
    prices = spark.range(100).select((F.col("id") / 7).cast("decimal(10,2)").alias("p"))
    assert max(parts(prices, split_predicates(prices, "p", 5))) <= 25
    assert split_predicates(days.limit(0), "d", 4) == ["1 = 1"] and split_points(days, "d", 1) == []
    assert range_predicates("k", [5]) == ["(k <= 5 OR k IS NULL)", "k > 5"]


def test_text_keys_are_cut_by_hash(spark):
    names = spark.range(2_000).select(F.when(F.col("id") > 0, F.concat(F.lit("n"), "id")).alias("k"))
    predicates = split_predicates(names, "k", 4, bucket="pmod(hash({column}), {parts})")
    assert all(400 <= n <= 600 for n in parts(names, predicates))
    assert hash_predicates("k", 2) == ["(MOD(ABS(CHECKSUM(k)), 2) = 0 OR k IS NULL)", "(MOD(ABS(CHECKSUM(k)), 2) = 1 AND k IS NOT NULL)"]
    with pytest.raises(ValueError, match="hash_predicates"):
        split_points(names, "k", 4)
    with pytest.raises(ValueError, match="1 to 4096"):
        hash_predicates("k", 0)

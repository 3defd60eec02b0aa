"""Range-wise running totals and numbering against the plain window."""

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from salesmill.operators.prefix import dense_rank_by, range_of, running_total_desc


def amounts(spark, n=20_000):
    """Many ties; one value is held by a third of all rows."""
    v = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)) - 100)
    return spark.range(n).select("id", v.cast("decimal(18,4)").alias("v"))


@pytest.mark.parametrize("ranges", [1, 2, 4, 16, 100])
def test_running_total_equals_window(spark, ranges):
    df = amounts(spark)
    plain = df.withColumn("want", F.sum("v").over(Window.orderBy(F.col("v").desc())))
    ours = running_total_desc(df, "v", "got", ranges)
    joined = ours.join(plain.select("id", "want"), "id")
    assert joined.count() == 20_000
    assert joined.where("got <> want").count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_dense_rank_equals_row_number(spark, ranges):
    df = spark.range(5_000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40)) - (1 << 39)).alias("k"))
    ours = dense_rank_by(df, "k", "got", start=10, ranges=ranges)
    want = ours.withColumn("want", F.row_number().over(Window.orderBy("k")) + 10)
    assert want.where("got <> want").count() == 0
    assert ours.count() == 5_000


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.integers(-(2**62), 2**62), min_size=1, max_size=30), ranges=st.integers(1, 9))
def test_dense_rank_of_any_keys(spark, keys, ranges):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r.n for r in dense_rank_by(df, "k", "n", ranges=ranges).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("n", [2, 3, 8, 9, 33])
def test_range_of_counts_lower_points(spark, n):
    points = [i * 10 for i in range(1, n)]
    df = spark.range(-5, n * 10 + 5).withColumn("p", F.array(*[F.lit(p) for p in points]))
    for r in rows(df.withColumn("r", range_of(F.col("id"), F.col("p"), n))):
        assert r["r"] == sum(p < r["id"] for p in points)


def test_only_range_totals_meet_in_one_task(spark):
    """A one-task exchange may carry one row per task or per range, never the rows themselves."""
    text = plan(running_total_desc(amounts(spark), "v", "got", 16))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1] or "partial_percentile" in lines[i + 1], lines[i + 1]
    for line in lines:
        if " Window [" in line:
            assert "windowspecdefinition(_range" in line


def test_hot_value_reaches_the_window_once(spark):
    df = spark.range(9_000).select(F.lit(5).cast("decimal(18,4)").alias("v"))
    assert running_total_desc(df, "v", "t", 4).select("t").distinct().collect()[0].t == 45_000

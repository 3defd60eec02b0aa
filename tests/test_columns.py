"""Expressions on hand-computed values."""

import pytest
from helpers import dec, values
from pyspark.sql import functions as F

from salesmill.functions import columns as fn


def over(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return values(df.select("i", expression(F.col("v")).alias("out")).orderBy("i"), "out")


def test_discount_bands(spark):
    inputs = [dec(x) for x in ("0", "0.50", "10", "10.01", "20", "30", "30.01")] + [None]
    assert over(spark, "decimal(5,2)", inputs, fn.discount_band) == [
        "Sem Desconto", "1-10%", "1-10%", "11-20%", "11-20%", "21-30%", "Acima de 30%", "Acima de 30%",
    ]


def test_abc_class(spark):
    inputs = [dec(x) for x in ("80", "80.01", "95", "95.01", "100")]
    assert [v[0] for v in over(spark, "decimal(5,2)", inputs, fn.abc_class)] == ["A", "B", "B", "C", "C"]


def test_customer_class(spark):
    inputs = [dec(x) for x in ("50000", "49999.99", "20000", "5000", "4999.99")] + [None]
    assert over(spark, "decimal(20,2)", inputs, fn.customer_class) == [
        "VIP", "Premium", "Premium", "Regular", "Basico", "Basico",
    ]


def test_continent_is_case_sensitive(spark):
    inputs = ["North America", "Europe", "Pacific", "AMERICA", None]
    assert over(spark, "string", inputs, fn.continent) == ["Américas", "Europa", "Ásia-Pacífico", "Outros", "Outros"]


def test_seller_code_is_cut_to_five_digits(spark):
    assert over(spark, "bigint", [27, 1234567], fn.seller_code) == ["V00027", "V12345"]


def test_week_position(spark):
    assert over(spark, "string", ["Monday", "Sunday", "Domingo", None], fn.week_position) == [1, 7, None, None]


def test_money_rounds_half_away_from_zero(spark):
    inputs = [dec("2.345"), dec("-2.345"), dec("2.344")]
    assert over(spark, "decimal(10,3)", inputs, fn.money) == [dec("2.35"), dec("-2.35"), dec("2.34")]


@pytest.mark.parametrize(
    "num, den, expected",
    [("1", "3", "33.33"), ("2", "3", "66.67"), ("-1", "8", "-12.50"), ("0.00005", "1", "0.01"), ("1", "0", None)],
)
def test_percent(spark, num, den, expected):
    df = spark.sql(f"SELECT CAST({num} AS DECIMAL(24,4)) AS n, CAST({den} AS DECIMAL(24,4)) AS d")
    out = df.select(fn.percent(F.col("n"), F.col("d")).alias("p")).first().p
    assert out == (None if expected is None else dec(expected))


def test_mean_is_rounded_once(spark):
    df = spark.createDataFrame([(dec("33.33"),), (dec("33.34"),), (None,)], "m decimal(5,2)")
    assert df.agg(fn.mean("m").alias("m")).first().m == dec("33.34")


def test_list_margin(spark):
    df = spark.createDataFrame(
        [(1, dec(100), dec(60)), (2, dec(0), dec(5)), (3, None, None), (4, dec(3), None)],
        "i int, price decimal(15,4), cost decimal(15,4)",
    )
    out = df.select("i", fn.list_margin(F.col("price"), F.col("cost")).alias("m")).orderBy("i")
    assert values(out, "m") == [dec("40.00"), dec("0.00"), dec("0.00"), dec("100.00")]

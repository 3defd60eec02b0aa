"""Day series and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmill.functions.columns import date_key, day_of_week

FIRST_DAY, LAST_DAY = "2008-01-01", "2030-12-31"
V1_LAST_DAY = "2025-12-31"


def day_series(df: DataFrame, start: Column, end: Column, name: str = "data_completa") -> DataFrame:
    """One row per day from `start` to `end` (both included) for each row of `df`."""
    step = F.expr("interval 1 day")
    return df.select(F.explode(F.sequence(start.cast("date"), end.cast("date"), step)).alias(name))


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    return day_series(spark.range(1), F.lit(start), F.lit(end))


def build_dim_tempo(spark: SparkSession, start: str = FIRST_DAY, end: str = LAST_DAY) -> DataFrame:
    day = F.col("data_completa")
    weekday = day_of_week(day)
    return _days(spark, start, end).select(
        date_key(day).alias("sk_tempo"),
        day,
        F.year(day).cast("smallint").alias("ano"),
        F.quarter(day).cast("smallint").alias("trimestre"),
        F.month(day).cast("smallint").alias("mes"),
        F.dayofmonth(day).cast("smallint").alias("dia"),
        F.weekofyear(day).cast("smallint").alias("semana_ano"),
        weekday.cast("smallint").alias("dia_semana"),
        F.date_format(day, "MMMM").alias("nome_mes"),
        F.date_format(day, "EEEE").alias("nome_dia_semana"),
        weekday.isin(0, 6).alias("eh_fim_semana"),
        F.lit(False).alias("eh_feriado"),
    )


def build_dim_date_v1(spark: SparkSession, start: str = FIRST_DAY, end: str = V1_LAST_DAY) -> DataFrame:
    day = F.col("data_completa")
    return _days(spark, start, end).select(
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("weekday_name"),
    )

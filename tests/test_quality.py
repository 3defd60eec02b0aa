"""Counting checks, type inference, staging and sources."""

import datetime
from types import SimpleNamespace

import pytest
from helpers import SMALL, dec, rows, values
from pyspark.sql import functions as F

from salesmill.operators import quality as q
from salesmill.operators.inference import infer_column_types
from salesmill.operators.staging import stage_all, staged_rows
from salesmill.session import scratch_path, scratch_root
from salesmill.sources.extract import extract, jdbc_options
from salesmill.sources.sink import jdbc_sink_options


def test_repeated_keys_ignore_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (None, 1), (None, 1)], "a int, b int")
    assert q.repeated_keys(df, "t", ["a", "b"]).first().asDict() == {"table": "t", "key": "a+b", "repeated_keys": 1, "rows_too_many": 2}


def test_missing_and_overlong(spark):
    df = spark.createDataFrame([("abc", None), (None, "x"), ("abcd", "y")], "a string, b string")
    assert {r["column"]: r["missing"] for r in rows(q.missing_values(df, "t", ["a", "b"]))} == {"a": 1, "b": 1}
    got = q.overlong(df, "t", {"a": 3}).first()
    assert (got.longest, got.overlong) == (4, 1)


def test_orphans_let_null_pass(spark):
    df = spark.createDataFrame([(1,), (1,), (7,), (7,), (None,)], "fk int")
    got = q.orphans(df, "t", "fk", spark.createDataFrame([(1,), (2,)], "id int"), "d", "id").first()
    assert (got.references, got.orphans) == (4, 2)


def test_overflow(spark):
    df = spark.createDataFrame([(dec("999.99"),), (dec("-1900"),), (None,)], "m decimal(18,2)")
    got = q.overflows(df, "t", {"m": ("m", "decimal(5,2)")}).first()
    assert (got["values"], got["overflows"]) == (2, 1)


def test_row_counts_against_expected(spark):
    expected = spark.createDataFrame([("a", 3), ("b", 2)], "`table` string, expected bigint")
    got = rows(q.against_expected(q.row_counts({"a": spark.range(3), "b": spark.range(1)}), expected), "table")
    assert [r["as_expected"] for r in got] == [True, False]


def inferred(spark, kind, items, **rules):
    df = spark.createDataFrame([(i,) for i in items], f"c {kind}")
    return infer_column_types(df, **rules).first().type


@pytest.mark.parametrize("kind, items, loose, strict", [
    ("int", [1, 2], "INTEGER", "INTEGER"),
    ("int", [1, None], "INTEGER", "TEXT"),
    ("int", [None], "TEXT", "TEXT"),
    ("int", [], "TEXT", "TEXT"),
    ("boolean", [True], "BOOLEAN", "BOOLEAN"),
    ("double", [1.5], "DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("decimal(9,2)", [dec("1.5")], "NUMERIC(18,4)", "NUMERIC(18,4)"),
    ("date", [datetime.date(2020, 1, 1)], "TEXT", "TIMESTAMP"),
    ("timestamp_ntz", [datetime.datetime(2020, 1, 1)], "TIMESTAMP", "TIMESTAMP"),
    ("string", ["1"], "TEXT", "TEXT"),
])
def test_declared_types(spark, kind, items, loose, strict):
    assert inferred(spark, kind, items) == loose
    assert inferred(spark, kind, items, null_as_text=True, date_as_timestamp=True) == strict


@pytest.mark.parametrize("items, kind", [
    (["1", "-2"], "INTEGER"), (["1", "2.5"], "NUMERIC(18,4)"), (["1", "1.5e0"], "TEXT"), (["1.5e0"], "DOUBLE PRECISION"),
    (["true", "False"], "BOOLEAN"), (["true", "1"], "TEXT"), (["2020-01-01"], "TEXT"), (["2020-01-01 10:00:00"], "TIMESTAMP"),
    (["1", None], "INTEGER"), ([None], "TEXT"), (["1", "2.5", "x"], "TEXT"),
])
def test_written_types(spark, items, kind):
    assert inferred(spark, "string", items, parse_text=True) == kind


def test_a_late_misfit_is_seen(spark):
    """All rows count, not a sample from the start."""
    df = spark.range(50_000).select(F.when(F.col("id") == 49_999, "x").otherwise(F.col("id").cast("string")).alias("c"))
    assert infer_column_types(df, parse_text=True).first().type == "TEXT"


def test_staging_replaces_and_keeps_columns_of_an_empty_table(spark, caplog):
    target = scratch_path(spark, "stage")
    stage_all(spark, {"a": spark.range(5), "b": spark.range(2)}, target)
    staged = stage_all(spark, {"a": spark.range(3), "b": spark.range(0)}, target)
    assert {r["table"]: r["rows"] for r in rows(staged_rows(staged))} == {"a": 3, "b": 0}
    assert staged["b"].columns == ["id"] and "b is empty" in caplog.text


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_extract_formats(spark, fmt):
    path = scratch_path(spark, fmt)
    spark.range(4).select("id", F.concat(F.lit("n"), "id").alias("name")).write.format(fmt).save(path)
    df = extract(spark, path, fmt, columns=["name"], schema="id bigint, name string")
    assert df.columns == ["name"] and sorted(values(df, "name")) == ["n0", "n1", "n2", "n3"]


def test_extract_prunes_at_the_scan(spark):
    df = extract(spark, f"{SMALL}/orders.parquet", columns=["o_orderkey"]).where("o_orderkey > 5")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in text and "GreaterThan(o_orderkey,5)" in text


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "Sales.Customer", "CustomerID", 1, 100, 8)
    assert got["partitionColumn"] == "CustomerID" and got["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")
    with pytest.raises(ValueError, match="declare the table small"):
        jdbc_options("jdbc:x", "t")
    assert "numPartitions" not in jdbc_options("jdbc:x", "t", small=True)
    assert jdbc_sink_options("jdbc:x", "t")["batchsize"] == "500"


def session_with(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_scratch_folder_comes_from_the_session():
    assert scratch_path(session_with("hdfs://x/tmp", "spark://m"), "t").startswith("hdfs://x/tmp/salesmill/app-1/t-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session_with(None, "spark://m"))
    local = scratch_root(session_with(None, "local[4]"))
    assert local == scratch_root(session_with(None, "local[4]"))

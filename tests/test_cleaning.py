from datetime import date

import pytest
from pyspark.errors import PySparkException

from patronage.operators import cleaning


def test_null_filters(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, "c")], "a int, b string")
    assert [tuple(r) for r in cleaning.drop_any_null(df).collect()] == [(2, "b")]
    assert [r["a"] for r in cleaning.drop_null_in(df, ["b"]).collect()] == [2, None]


def test_distinct_rows_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    assert cleaning.distinct_rows(df).count() == 2


def test_drop_columns_wants_known_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert cleaning.drop_columns(df, ["a"]).columns == ["b"]
    with pytest.raises(ValueError, match="no such columns"):
        cleaning.drop_columns(df, ["c"])


def test_to_int_cuts_fractions(spark):
    df = spark.createDataFrame([(3.9,), (-3.9,)], "x double")
    assert [r["x"] for r in cleaning.to_int(df, ["x"]).collect()] == [3, -3]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_to_int_refuses_nulls_text_and_large_numbers(spark, ansi):
    nulls = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(PySparkException, match="cannot cast null in x"):
        cleaning.to_int(nulls, ["x"]).collect()
    for values, kind in (("abc", "string"), (3e9, "double"), (2**40, "long")):
        with pytest.raises(PySparkException):
            cleaning.to_int(spark.createDataFrame([(values,)], f"x {kind}"), ["x"]).collect()


def test_add_date(spark, ansi):
    df = spark.createDataFrame([(1984, 2, 29), (1984, None, 29)], "y int, m int, d int")
    assert [r["born"] for r in cleaning.add_date(df, "born", "y", "m", "d").collect()] == [date(1984, 2, 29), None]
    bad = spark.createDataFrame([(1985, 2, 30)], "y int, m int, d int")
    with pytest.raises(PySparkException, match="no calendar date: 1985-02-30"):
        cleaning.add_date(bad, "born", "y", "m", "d").collect()


def test_move_column(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert cleaning.move_column(df, "d", 2).columns == ["a", "b", "d", "c"]

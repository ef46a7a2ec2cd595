import math
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patronage.operators import features

WORDS = "w string, n int"


def test_numeric_columns(spark):
    df = spark.createDataFrame([], "a int, b string, c decimal(7,2), d double, e date")
    assert features.numeric_columns(df) == ["a", "c", "d"]
    assert features.numeric_columns(df, exclude=["c"]) == ["a", "d"]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame(
        [(Decimal(1), 5, None), (Decimal(3), 5, None), (None, 5, None)],
        "x decimal(7,2), same int, nothing double",
    )
    rows = features.standard_scale(df, ["x", "same", "nothing"]).collect()
    assert [r["x"] for r in rows] == [-1.0, 1.0, None]
    assert [r["same"] for r in rows] == [0.0, 0.0, 0.0]
    assert [r["nothing"] for r in rows] == [None, None, None]
    stats = {r["column"]: (r["mean"], r["std"]) for r in features.scaler_stats(df, ["x"]).collect()}
    assert stats == {"x": (2.0, 1.0)}


def test_scaling_against_plain_python(spark):
    values = [((i * 37) % 101) / 7 for i in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    mean = sum(values) / len(values)
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    for row in features.standard_scale(df, ["x"]).collect():
        assert row["x"] == pytest.approx((values[row["i"]] - mean) / std, abs=1e-9)


@pytest.fixture
def scratch(tmp_path):
    return f"{tmp_path}/labels"


@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_codes_follow_binary_order_with_missing_last(spark, scratch, budget):
    labels = ["b", "B", "a", None, "é", "z", "", "a"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(labels)], WORDS)
    out = features.label_encode(df, ["w"], scratch, budget=budget)
    assert out.columns == ["w", "n"]
    codes = {r["n"]: r["w"] for r in out.collect()}
    order = sorted({v for v in labels if v is not None})
    assert codes == {
        i: len(order) if v is None else order.index(v) for i, v in enumerate(labels)
    }


def test_column_without_any_label(spark, scratch):
    df = spark.createDataFrame([(None, 1), (None, 2)], WORDS)
    assert [r["w"] for r in features.label_encode(df, ["w"], scratch).collect()] == [0, 0]


def test_numbers_are_ranked_as_numbers(spark, scratch):
    df = spark.createDataFrame([("x", 10), ("y", 9), ("x", 100)], WORDS)
    rows = features.label_encode(df, ["n", "w"], scratch).collect()
    assert sorted((r["n"], r["w"]) for r in rows) == [(0, 1), (1, 0), (2, 0)]


@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_nan_is_the_last_value_and_null_comes_after(spark, scratch, budget):
    values = [math.nan, 1.0, 2.0, 0.5, None, -0.0, 0.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    rows = features.label_encode(df, ["x"], scratch, budget=budget).collect()
    assert [r["x"] for r in sorted(rows)] == [4, 2, 3, 1, 5, 0, 0]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_unseen_values_fail(spark, scratch, budget, ansi):
    known = spark.createDataFrame([("a", 1), ("b", 1)], WORDS)
    df = spark.createDataFrame([("a", 1), (None, 2)], WORDS)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = features.label_encode(df, ["w"], f"{scratch}/a", fit_on=known, budget=budget).collect()
        assert [r["w"] for r in rows] == [0, 2]
        strange = df.unionAll(spark.createDataFrame([("zz", 3)], WORDS))
        with pytest.raises(PySparkException, match="unseen label in w: zz"):
            features.label_encode(strange, ["w"], f"{scratch}/b", fit_on=known, budget=budget).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_many_labels_are_ranked_over_several_blocks(spark, scratch):
    """20,000 labels in one column, a third of all rows under one label, next to a small column."""
    hot = F.when(F.col("id") % 3 == 0, "w7").otherwise(
        F.concat(F.lit("w"), (F.col("id") % 20_000).cast("string"))
    )
    df = spark.range(0, 60_000, 1, 8).select(
        "id", hot.alias("many"), F.concat(F.lit("k"), F.col("id") % 3).alias("three")
    )
    names = sorted({"w7" if i % 3 == 0 else f"w{i % 20_000}" for i in range(60_000)})
    ranked = features.label_map(df, ["many", "three"], f"{scratch}/map")
    got = {(r["column"], r["value"]): r["code"] for r in ranked.collect()}
    expected = {("many", name): code for code, name in enumerate(names)}
    expected |= {("three", f"k{i}"): i for i in range(3)}
    assert got == expected
    codes = features.label_encode(df, ["many", "three"], f"{scratch}/codes")
    known = df.select("id", F.col("many").alias("word"))
    for row in codes.join(known, "id").where("id % 997 = 0").collect():
        assert row["many"] == expected["many", row["word"]]
    assert codes.count() == 60_000


def test_statistics_taken_on_a_write_equal_those_of_a_scan(spark, tmp_path):
    rows = [(i * 0.5, i % 7, None) for i in range(100)] + [(None, 3, None)]
    df = spark.createDataFrame(rows, "a double, b int, empty double")
    observed, stats = features.observed_stats(df, ["a", "b", "empty"])
    observed.write.parquet(f"{tmp_path}/t")
    scanned = {r["column"]: (r["mean"], r["std"]) for r in features.scaler_stats(df, ["a", "b", "empty"]).collect()}
    taken = {row["column"]: (row["mean"], row["std"]) for row in stats()}
    assert taken["empty"] == scanned["empty"] == (None, None)
    for name in ("a", "b"):
        assert taken[name] == pytest.approx(scanned[name])
    scaled = features.standard_scale(df, ["a", "b", "empty"], stats())
    assert scaled.agg(F.sum("b")).first()[0] == pytest.approx(0, abs=1e-9)
    assert features.observed_stats(df, [])[1]() == []

import pytest
from pyspark.sql import functions as F

from patronage.operators.lookups import fits_broadcast, lookup_join, measured_bytes


def skewed(spark):
    """A third of the rows under one key, a third without a key, the rest spread and dangling."""
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id") % 400)
    return spark.range(0, 30_000, 1, 8).select("id", key.cast("int").alias("k"))


def dimension(spark):
    return spark.range(200).select(
        F.col("id").cast("int").alias("d"), F.concat(F.lit("v"), "id").alias("v")
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_ways_agree(spark, how):
    left, dim = skewed(spark), dimension(spark)
    small = lookup_join(left, dim, "k", "d", how, fits=True)
    large = lookup_join(left, dim, "k", "d", how, fits=False)
    assert small.columns == large.columns
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    if how == "left":
        assert large.count() == 30_000


def test_rows_without_key_are_spread(spark):
    joined = lookup_join(skewed(spark), dimension(spark), "k", "d", "left", fits=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyless = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    assert len(keyless) == 8
    assert max(row["count"] for row in keyless) < 2_500  # of 10,000


def test_only_a_measured_frame_is_broadcast(spark):
    dim = dimension(spark)
    sizes = measured_bytes({"dim": dim, "none": dim.where("d < 0")})
    assert sizes["none"] == 0
    assert 200 * 40 < sizes["dim"] < 200 * 100
    assert fits_broadcast({"dim": dim}) == {"dim": True}
    assert fits_broadcast({"dim": dim}, budget=1000) == {"dim": False}


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError, match="inner or left"):
        lookup_join(skewed(spark), dimension(spark), "k", "d", "full", fits=True)

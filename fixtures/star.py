"""The star schema of FIXTURES.md as DataFrames over the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.model import RETURNS_CHANNELS, SALES_CHANNELS
from patronage.plans.star import Star, star_from_tables
from patronage.sources.parquet import read_table

PRICE = "decimal(12,2)"

# Columns of the given tables.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return read_table(spark, sf_dir, name, SCHEMAS[name])


def _day_number(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return given(spark, sf_dir, "customer").select(
        key.cast("int").alias("c_customer_sk"),
        F.when(key % 11 == 0, F.lit(None))
        .when(key % 2 == 0, "Y")
        .otherwise("N")
        .alias("c_preferred_cust_flag"),
        _unless(key % 13 == 0, (key % 97).cast("int")).alias("c_current_cdemo_sk"),
        _unless(key % 17 == 0, (key % 60).cast("int")).alias("c_current_hdemo_sk"),
        F.col("c_nationkey").cast("int").alias("c_current_addr_sk"),
        F.lit("UNITED STATES").alias("c_birth_country"),
        (1930 + key % 70).cast("int").alias("c_birth_year"),
        (1 + key % 12).cast("int").alias("c_birth_month"),
        _unless(key % 19 == 0, (1 + key % 28).cast("int")).alias("c_birth_day"),
        F.when(key % 2 == 0, "Mr.").otherwise("Ms.").alias("c_salutation"),
        F.col("c_mktsegment").alias("c_first_name"),
        F.col("c_name").alias("c_last_name"),
        _unless(key % 23 == 0, F.concat("c_name", F.lit("@example.com"))).alias("c_email_address"),
    )


def _choice(number: Column, *values: str) -> Column:
    """values[0] where number is 0, and so on; the last value for all others."""
    chosen = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:-1], start=1):
        chosen = chosen.when(number == i, value)
    return chosen.otherwise(values[-1])


def customer_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = F.col("cd_demo_sk")
    keys = given(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 97).cast("int").alias("cd_demo_sk")
    )
    return keys.distinct().select(
        demo,
        F.when(demo % 2 == 0, "M").otherwise("F").alias("cd_gender"),
        _choice(demo % 5, "S", "M", "D", "W", "U").alias("cd_marital_status"),
        _choice(demo % 4, "Primary", "Secondary", "College", "Unknown").alias("cd_education_status"),
        (500 * (1 + demo % 20)).cast("int").alias("cd_purchase_estimate"),
        _choice(demo % 3, "Good", "Low Risk", "High Risk").alias("cd_credit_rating"),
        (demo % 7).alias("cd_dep_count"),
        (demo % 6).alias("cd_dep_employed_count"),
        (demo % 4).alias("cd_dep_college_count"),
    )


def household_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = F.col("hd_demo_sk")
    keys = given(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 60).cast("int").alias("hd_demo_sk")
    )
    return keys.distinct().select(
        demo,
        (8 + demo % 20).alias("hd_income_band_sk"),
        _choice(demo % 4, "0-500", "501-1000", ">10000", "Unknown").alias("hd_buy_potential"),
        (demo % 10).alias("hd_dep_count"),
        (demo % 6 - 1).alias("hd_vehicle_count"),
    )


def income_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return given(spark, sf_dir, "nation").select(
        key.cast("int").alias("ib_income_band_sk"),
        (key * 10000 + 1).cast("int").alias("ib_lower_bound"),
        ((key + 1) * 10000).cast("int").alias("ib_upper_bound"),
    )


def customer_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = given(spark, sf_dir, "nation")
    region = given(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.cast("int").alias("ca_address_sk"),
        F.col("n_name").alias("ca_city"),
        F.substring("r_name", 1, 2).alias("ca_state"),
        F.lit("United States").alias("ca_country"),
        (-5 - key % 4).cast("decimal(5,2)").alias("ca_gmt_offset"),
        _choice(key % 3, "apartment", "condo", "single family").alias("ca_location_type"),
    )


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    return orders.select(_day_number(F.col("o_orderdate")).alias("d_date_sk")).distinct()


# The line numbers that stand for each channel.
LINE_NUMBERS = {"store": (1, 3), "catalog": (4, 5), "web": (6, 7)}


def sale_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales of all channels, one row per line, with the flag that marks a returned line.

    Some buyers of each channel are unknown: their key is negative and in no customer row.
    """
    line, custkey, supplier = F.col("l_linenumber"), F.col("o_custkey"), F.col("l_suppkey")
    price, date = F.col("l_extendedprice").cast(PRICE), F.col("o_orderdate")
    unknown = (
        ((line <= 3) & (custkey % 7 == 3))
        | (line.isin(4, 5) & (custkey % 5 == 1))
        | ((line >= 6) & (custkey % 3 == 2))
    )
    buyer = F.when(unknown, -1 - custkey).otherwise(custkey).cast("int")
    day = _day_number(date) + F.when(F.year(date) > 2000, 1_000_000).otherwise(0)
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.when(line <= 3, "store").when(line <= 5, "catalog").otherwise("web").alias("channel"),
        _unless(supplier % 50 == 7, buyer).alias("customer_sk"),
        _unless(supplier % 50 == 0, day).alias("sale_date"),
        F.col("l_partkey").cast("int").alias("item_sk"),
        _unless(supplier % 50 == 3, price).alias("price"),
        (price - F.col("l_quantity").cast("decimal(4,0)") * 1200).cast(PRICE).alias("profit"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_returnflag").alias("return_flag"),
    )


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_lines(given(spark, sf_dir, "lineitem"), given(spark, sf_dir, "orders"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the union of the three sales tables holds, from one join of lines and orders."""
    return all_lines(spark, sf_dir).drop("return_flag")


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the union of the three returns tables holds, from one join of lines and orders."""
    return all_lines(spark, sf_dir).where(F.col("return_flag") == "R").select(
        "channel",
        "customer_sk",
        F.col("price").alias("return_amount"),
        F.col("quantity").alias("return_quantity"),
    )


def facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three sales and three returns tables under their own column names.

    Each reads only the lines of its channel, so the shuffles of all three together are those
    of one; Spark shares the shuffle of the orders.
    """
    lineitem, orders = given(spark, sf_dir, "lineitem"), given(spark, sf_dir, "orders")
    lines = {
        name: sale_lines(lineitem.where(F.col("l_linenumber").between(*numbers)), orders)
        for name, numbers in LINE_NUMBERS.items()
    }
    tables = {}
    for sold in SALES_CHANNELS:
        tables[sold.table] = lines[sold.name].select(
            F.col("customer_sk").alias(sold.customer),
            F.col("sale_date").alias(sold.date),
            F.col("item_sk").alias(sold.item),
            F.col("price").alias(sold.price),
            F.col("profit").alias(sold.profit),
            F.col("quantity").alias(sold.quantity),
        )
    for back in RETURNS_CHANNELS:
        tables[back.table] = lines[back.name].where(F.col("return_flag") == "R").select(
            F.col("customer_sk").alias(back.customer),
            F.col("price").alias(back.amount),
            F.col("quantity").alias(back.quantity),
        )
    return tables


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customer": customer(spark, sf_dir),
        "customer_demographics": customer_demographics(spark, sf_dir),
        "household_demographics": household_demographics(spark, sf_dir),
        "income_band": income_band(spark, sf_dir),
        "customer_address": customer_address(spark, sf_dir),
        "date_dim": date_dim(spark, sf_dir),
    }


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All twelve tables."""
    return {**dimensions(spark, sf_dir), **facts(spark, sf_dir)}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star over the twelve tables, as the jobs read it."""
    return star_from_tables(tables(spark, sf_dir))

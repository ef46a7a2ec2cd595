"""One registered query per operator and job, over the given tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import star as fx
from patronage.functions import null_default
from patronage.model import CATALOG_RETURNS, CATALOG_SALES, MONEY, STORE_SALES
from patronage.operators import aggregates as agg
from patronage.operators import cleaning, features
from patronage.operators.channels import union_returns, union_sales
from patronage.operators.profiles import inner_dims
from patronage.plans import customer_360 as c360
from patronage.plans import customer_analytics as analytics
from patronage.plans import feature_step as step
from patronage.plans.ingest import ingest, ingest_parquet
from patronage.plans.star import Star
from patronage.session import shared_dir
from patronage.sources import parquet
from patronage.sources.catalog import CatalogDatabase
from patronage.sources.feature_table import save_features, stored_features, write_features

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = "c_customer_sk"
SCALED = (
    "catalog_sales_amount",
    "web_sales_amount",
    "store_sales_amount",
    "catalog_net_profit",
    "web_net_profit",
    "store_net_profit",
    "catalog_return_amount",
    "web_return_amount",
    "store_return_amount",
    "total_sales_amount",
    "total_net_profit",
    "total_return_amount",
    "store_transaction_count",
    "return_rate_percentage",
)


def query(function: Query) -> Query:
    """Register under the function's name, less a trailing underscore."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def money(*names: str) -> list:
    return [F.col(name).cast(MONEY).alias(name) for name in names]


def counts(*names: str) -> list:
    return [F.col(name).cast("bigint").alias(name) for name in names]


def scratch(spark: SparkSession) -> str:
    """Unused folder for what a query stores; its result reads it, so the caller removes it.

    The harness names the shared folder of a session on one machine that has none.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not known and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="patronage-"))
    return f"{shared_dir(spark)}/patronage-{uuid.uuid4().hex}"


# Sources and sinks


@query
def scan_table(spark, sf_dir):
    return parquet.read_table(spark, sf_dir, "orders")


@query
def list_tables(spark, sf_dir):
    return parquet.table_counts(spark, sf_dir)


@query
def table_schema(spark, sf_dir):
    return parquet.table_schemas(spark, sf_dir, counted=True)


@query
def typed_cast(spark, sf_dir):
    declared = [
        ("l_orderkey", "int"),
        ("l_partkey", "bigint"),
        ("l_suppkey", "mediumint"),
        ("l_linenumber", "tinyint"),
        ("l_quantity", "smallint"),
        ("l_extendedprice", "decimal(12,2)"),
        ("l_discount", "decimal(4,2)"),
        ("l_tax", "decimal(4,2)"),
        ("l_returnflag", "char"),
        ("l_linestatus", "varchar"),
        ("l_shipdate", "date"),
    ]
    return parquet.typed_cast(parquet.read_table(spark, sf_dir, "lineitem"), declared)


@query
def typed_cast_datetime(spark, sf_dir):
    declared = [
        ("event_id", "int"),
        ("ts", "datetime"),
        ("user_id", "int unsigned"),
        ("event_type", "enum"),
        ("value", "double"),
        ("props", "json"),
    ]
    return parquet.typed_cast(parquet.read_table(spark, sf_dir, "events"), declared)


@query
def parquet_roundtrip(spark, sf_dir):
    base = scratch(spark)
    parquet.write_table(parquet.read_table(spark, sf_dir, "orders"), base, "orders")
    return parquet.read_table(spark, base, "orders")


@query
def ingest_manifest(spark, sf_dir):
    manifest = ingest_parquet(spark, sf_dir, scratch(spark), at_once=4)
    return manifest.select("table_name", "row_count", "column_count")


@contextmanager
def database(spark: SparkSession) -> Iterator[str]:
    """A database of the session's catalog, gone afterwards; what has been planned over its tables stays readable."""
    name = f"patronage_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query
def catalog_schema(spark, sf_dir):
    """The given tables as external tables of a catalog's database, listed, described and counted there."""
    with database(spark) as name:
        for table in parquet.list_tables(spark, sf_dir):
            place = parquet.table_path(sf_dir, table)
            columns = parquet.read_table(spark, sf_dir, table).schema.toDDL()
            spark.sql(f"CREATE TABLE {name}.{table} ({columns}) USING parquet OPTIONS (path '{place}')")
        return _kept(spark, CatalogDatabase(spark, name).table_schemas(counted=True))


def _kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """`df` written and read back, for what it reads is about to go."""
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.parquet(path)


class Interrupted(Exception):
    """What stops the writes that these queries interrupt."""


@query
def interrupted_write(spark, sf_dir):
    """A table whose replacement failed in the middle: its old rows."""
    base, orders = scratch(spark), parquet.read_table(spark, sf_dir, "orders")
    parquet.write_table(orders.where("o_orderkey % 2 = 0"), base, "orders")
    late = F.raise_error(F.lit("interrupted")).cast("string")
    status = F.when(F.col("o_orderkey") == F.lit(orders.agg(F.max("o_orderkey")).first()[0]), late).otherwise(F.col("o_orderstatus"))
    try:
        parquet.write_table(orders.withColumn("o_orderstatus", status), base, "orders")
    except PySparkException:
        return parquet.read_table(spark, base, "orders")
    raise AssertionError("the write was to fail")


@query
def resumed_ingest(spark, sf_dir):
    """An ingest that stopped at one table and went on under the same run: the manifest, and what the second call copied."""
    base, tables, read_again = scratch(spark), ["customer", "nation", "orders", "region", "supplier"], []

    def failing(name):
        if name == "orders":
            raise Interrupted(name)
        return parquet.read_table(spark, sf_dir, name)

    def reading(name):
        read_again.append(name)
        return parquet.read_table(spark, sf_dir, name)

    try:
        ingest(spark, failing, tables, base, run="first")
    except Interrupted:
        pass
    manifest = ingest(spark, reading, tables, base, run="first")
    return manifest.select("table_name", "row_count", F.col("table_name").isin(read_again).alias("copied_again"))


@query
def clustered_dates(spark, sf_dir):
    """A date range of a table that is stored in ranges of dates."""
    base = scratch(spark)
    parquet.write_table(parquet.read_table(spark, sf_dir, "orders"), base, "orders", cluster_by=["o_orderdate"], files=8)
    stored = parquet.read_table(spark, base, "orders")
    return stored.where(F.col("o_orderdate").between("1996-03-01", "1996-05-31"))


@query
def cast_faults(spark, sf_dir):
    """Values that do not fit their declared type, by column and row, as the failed write lists them."""
    declared = [("o_orderkey", "bigint"), ("o_custkey", "smallint"), ("o_totalprice", "decimal(7,2)"), ("o_orderstatus", "int")]
    orders = parquet.read_table(spark, sf_dir, "orders")
    try:
        parquet.write_table(parquet.located_cast(orders, declared), scratch(spark), "orders", fault_keys=["o_orderkey"])
    except parquet.CastFaults as faults:
        rows = spark.read.parquet(faults.path)
        found = rows.select("o_orderkey", F.explode("faults").alias("column_name", "value"))
        return found.groupBy("o_orderkey", "column_name").agg(F.count(F.lit(1)).alias("faults"))
    raise AssertionError("the write was to fail")


@query
def feature_table(spark, sf_dir):
    return _stored_features(spark, sf_dir)


@query
def feature_table_by_name(spark, sf_dir):
    """The feature table as a catalog table with its constraints, read by its name."""
    with database(spark) as name:
        rows = analytics.customer_analytics(fx.star(spark, sf_dir), "joined", ordered=False)
        save_features(rows, f"{name}.features")
        return _kept(spark, stored_features(spark, f"{name}.features"))


# Projections and expressions


@query
def dim_profile(spark, sf_dir):
    return c360.customer_profiles(fx.star(spark, sf_dir))


@query
def null_default_(spark, sf_dir):
    sales = fx.facts(spark, sf_dir)["store_sales"]
    return sales.select(
        "ss_item_sk",
        null_default(F.col("ss_customer_sk"), "int").alias("ss_customer_sk"),
        null_default(F.col("ss_ext_sales_price"), "decimal(12,2)").alias("ss_ext_sales_price"),
    )



@query
def channel_flags(spark, sf_dir):
    facts, customer = fx.facts(spark, sf_dir), fx.customer(spark, sf_dir).select(KEY)
    for name, prefix in (("catalog", "cs"), ("web", "ws")):
        flag = f"has_{name}_sales"
        buyer = f"{prefix}_bill_customer_sk"
        flags = agg.has_any_by(facts[f"{name}_sales"], buyer, f"{prefix}_item_sk", flag)
        customer = customer.join(flags, F.col(KEY) == F.col(buyer), "left").drop(buyer)
        customer = customer.withColumn(flag, null_default(F.col(flag), "bigint"))
    return customer


@query
def channel_pivot(spark, sf_dir):
    pivot = agg.channel_pivot(fx.sales(spark, sf_dir))
    names = [c for c in pivot.columns if c != "customer_sk"]
    amounts = [name for name in names if name.endswith("_sales")]
    rows = [name for name in names if name.endswith("_transactions")]
    return pivot.select("customer_sk", *money(*amounts), *counts(*rows))


@query
def channel_share(spark, sf_dir):
    totals = agg.profile_totals(fx.star(spark, sf_dir).ledger)
    shares = [value.alias(name) for name, value in c360.channel_share().items()]
    return totals.select("customer_sk", *shares)


@query
def return_rates(spark, sf_dir):
    totals = agg.profile_totals(fx.star(spark, sf_dir).ledger)
    rates = [value.alias(name) for name, value in c360.return_rates().items()]
    return totals.select("customer_sk", *rates)


def _store_customers(spark, sf_dir):
    """Measures of the known customers with a dated store sale."""
    star = fx.star(spark, sf_dir)
    totals = analytics.store_customer_totals(star, "per_channel")
    return totals.join(star.customer, F.col("customer_sk") == F.col(KEY), "left_semi")


@query
def return_rate_pct(spark, sf_dir):
    return _store_customers(spark, sf_dir).select("customer_sk", "return_rate_percentage")


@query
def channel_totals(spark, sf_dir):
    return _store_customers(spark, sf_dir).select(
        "customer_sk",
        *money("total_sales_amount", "total_net_profit", "total_return_amount"),
        *counts("active_channels_count"),
    )


@query
def net_sales(spark, sf_dir):
    totals = agg.profile_totals(fx.star(spark, sf_dir).ledger)
    return totals.select(
        "customer_sk", c360.profile_measures()["net_sales_amount"].alias("net_sales_amount")
    )


@query
def drop_pii(spark, sf_dir):
    return cleaning.drop_columns(fx.customer(spark, sf_dir), c360.PERSONAL_COLUMNS)


@query
def int_casts(spark, sf_dir):
    orders = parquet.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return cleaning.to_int(orders, ["o_totalprice"])


@query
def birth_date(spark, sf_dir):
    customer = fx.customer(spark, sf_dir).select(KEY, *c360.BIRTH_PARTS)
    complete = cleaning.drop_null_in(customer, c360.BIRTH_PARTS)
    return cleaning.add_date(complete, "birth_date", *c360.BIRTH_PARTS)


@query
def numeric_columns(spark, sf_dir):
    rows = analytics.customer_analytics(fx.star(spark, sf_dir), "joined", ordered=False).drop(*step.DROPPED)
    return rows.select(KEY, *features.numeric_columns(rows, exclude=step.UNSCALED))


# Row filters


@query
def dropna_any(spark, sf_dir):
    return cleaning.drop_any_null(fx.customer(spark, sf_dir))


@query
def dropna_subset(spark, sf_dir):
    return cleaning.drop_null_in(fx.customer(spark, sf_dir), ["c_preferred_cust_flag"])


@query
def distinct_rows(spark, sf_dir):
    traits = fx.customer(spark, sf_dir).select(
        "c_preferred_cust_flag", "c_current_hdemo_sk", "c_birth_month", "c_salutation"
    )
    return cleaning.distinct_rows(traits)


# Joins


@query
def left_join_agg(spark, sf_dir):
    totals = agg.left_join_totals(
        fx.customer(spark, sf_dir), KEY, fx.facts(spark, sf_dir)["catalog_sales"], CATALOG_SALES
    )
    return totals.select(
        KEY, *money("catalog_sales_amount", "catalog_net_profit"), *counts("catalog_quantity")
    )


@query
def store_agg(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    totals = agg.store_totals(
        star.customer,
        KEY,
        fx.facts(spark, sf_dir)["store_sales"],
        STORE_SALES,
        star.date_dim,
        star.fits("dates")["dates"],
    )
    return totals.select(
        KEY,
        *money("store_sales_amount", "store_net_profit"),
        *counts("store_quantity", "store_transaction_count"),
    )


def _returned(spark, sf_dir, mode):
    returns = fx.returns(spark, sf_dir)
    amounts = agg.returned_amounts(fx.customer(spark, sf_dir), KEY, returns, mode)
    return amounts.select(KEY, *money(*[c for c in amounts.columns if c != KEY]))


@query
def returns_fanout(spark, sf_dir):
    return _returned(spark, sf_dir, "joined")


@query
def returns_by_channel(spark, sf_dir):
    return _returned(spark, sf_dir, "per_channel")


@query
def inner_dims_(spark, sf_dir):
    star = fx.star(spark, sf_dir)
    return inner_dims(
        star.customer,
        star.household_demographics,
        star.customer_demographics,
        star.customer_address,
        star.fits("household", "demographics", "address"),
    )



# Aggregates


@query
def sum_by_customer(spark, sf_dir):
    sums = {
        "store_sales_amount": "ss_ext_sales_price",
        "store_net_profit": "ss_net_profit",
        "store_quantity": "ss_quantity",
    }
    totals = agg.sum_by(fx.facts(spark, sf_dir)["store_sales"], "ss_customer_sk", sums)
    return totals.select(
        "ss_customer_sk",
        *money("store_sales_amount", "store_net_profit"),
        *counts("store_quantity"),
    )


@query
def sum_coalesced(spark, sf_dir):
    totals = agg.returns_of(fx.facts(spark, sf_dir)["catalog_returns"], CATALOG_RETURNS)
    return totals.select(CATALOG_RETURNS.customer, *money("catalog_return_amount"))


@query
def transaction_counts(spark, sf_dir):
    return agg.count_by(fx.sales(spark, sf_dir), "customer_sk", "total_transactions")


@query
def avg_transaction(spark, sf_dir):
    sales = fx.sales(spark, sf_dir)
    return agg.average_by(sales, "customer_sk", "price", "avg_transaction_value")


@query
def distinct_days(spark, sf_dir):
    sales = fx.sales(spark, sf_dir)
    return agg.distinct_by(sales, "customer_sk", "sale_date", "distinct_purchase_days")


# Set operations and limits


@query
def sales_union(spark, sf_dir):
    return union_sales(fx.facts(spark, sf_dir))


@query
def returns_union(spark, sf_dir):
    return union_returns(fx.facts(spark, sf_dir))


@query
def top_customers(spark, sf_dir):
    return c360.top_customers(c360.customer_360(fx.star(spark, sf_dir)))


# Features


def _stored_features(spark, sf_dir):
    """The feature table as written and read back, so that a second pass does not rebuild it."""
    path = f"{scratch(spark)}/customer_analytics.parquet"
    write_features(analytics.customer_analytics(fx.star(spark, sf_dir), "joined", ordered=False), path)
    return spark.read.parquet(path)


def _rounded(df, names):
    return df.withColumns({name: F.round(name, 6) + F.lit(0.0) for name in names})


@query
def scaler_stats(spark, sf_dir):
    rows = analytics.customer_analytics(fx.star(spark, sf_dir), "joined", ordered=False)
    stats = features.scaler_stats(rows, SCALED)
    digits = {name: F.format_string("%.9e", F.col(name)).cast("double") for name in ("mean", "std")}
    return stats.withColumns(digits)


@query
def standard_scale(spark, sf_dir):
    rows = _stored_features(spark, sf_dir).select(KEY, *SCALED)
    return _rounded(features.standard_scale(rows, SCALED), SCALED)


@query
def label_map(spark, sf_dir):
    profiles = c360.customer_profiles(fx.star(spark, sf_dir))
    return features.label_map(profiles, step.ENCODED, scratch(spark))


@query
def label_encode(spark, sf_dir):
    profiles = c360.customer_profiles(fx.star(spark, sf_dir)).select(KEY, *step.ENCODED)
    return features.label_encode(profiles, step.ENCODED, scratch(spark))


@query
def feature_step(spark, sf_dir):
    return _rounded(step.feature_step(_stored_features(spark, sf_dir), scratch(spark)), SCALED)


# Jobs

#: The jobs, each over a star: here over the given tables, in the benchmark over stored ones.
JOBS: dict[str, Callable[[Star], DataFrame]] = {
    "customer_analytics": lambda star: analytics.customer_analytics(star, "joined"),
    "customer_analytics_per_channel": lambda star: analytics.customer_analytics(star, "per_channel"),
    "customer_360": c360.customer_360,
    "customer_360_clean": c360.customer_360_clean,
    "customer_360_clean_without_gender": lambda star: c360.customer_360_clean(star, keep_gender=False),
}


def _job(name: str) -> Query:
    return lambda spark, sf_dir: JOBS[name](fx.star(spark, sf_dir))


QUERIES.update({name: _job(name) for name in JOBS})

"""Table shapes: channel descriptors, the declared-type map, and the feature table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SalesChannel:
    """Where one channel's sales live and what its columns are called."""

    name: str
    table: str
    customer: str
    date: str
    item: str
    price: str
    profit: str
    quantity: str


@dataclass(frozen=True)
class ReturnsChannel:
    """Where one channel's returns live and what its columns are called."""

    name: str
    table: str
    customer: str
    amount: str
    quantity: str


def _sales(name: str, prefix: str, customer: str) -> SalesChannel:
    return SalesChannel(
        name=name,
        table=f"{name}_sales",
        customer=f"{prefix}_{customer}",
        date=f"{prefix}_sold_date_sk",
        item=f"{prefix}_item_sk",
        price=f"{prefix}_ext_sales_price",
        profit=f"{prefix}_net_profit",
        quantity=f"{prefix}_quantity",
    )


STORE_SALES = _sales("store", "ss", "customer_sk")
CATALOG_SALES = _sales("catalog", "cs", "bill_customer_sk")
WEB_SALES = _sales("web", "ws", "bill_customer_sk")
SALES_CHANNELS = (STORE_SALES, CATALOG_SALES, WEB_SALES)

STORE_RETURNS = ReturnsChannel(
    "store", "store_returns", "sr_customer_sk", "sr_return_amt", "sr_return_quantity"
)
CATALOG_RETURNS = ReturnsChannel(
    "catalog",
    "catalog_returns",
    "cr_refunded_customer_sk",
    "cr_return_amount",
    "cr_return_quantity",
)
WEB_RETURNS = ReturnsChannel(
    "web", "web_returns", "wr_refunded_customer_sk", "wr_return_amt", "wr_return_quantity"
)
RETURNS_CHANNELS = (STORE_RETURNS, CATALOG_RETURNS, WEB_RETURNS)

CHANNELS = ("catalog", "web", "store")


# Declared column type of the source -> stored type.
DECLARED_TYPES = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "decimal": T.DecimalType(38, 18),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "text": T.StringType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "mediumint": T.IntegerType(),
    "bigint": T.LongType(),
    "blob": T.BinaryType(),
    "enum": T.StringType(),
    "set": T.StringType(),
    "json": T.StringType(),
    "geometry": T.BinaryType(),
    "point": T.BinaryType(),
    # types the list above leaves out; any further name is stored as a string
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "year": T.IntegerType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
    "tinyblob": T.BinaryType(),
    "mediumblob": T.BinaryType(),
    "longblob": T.BinaryType(),
    "bit": T.BinaryType(),
    "bit(1)": T.BooleanType(),
}

# Unsigned types that need a wider stored type than their signed form.
UNSIGNED_TYPES = {
    "tinyint": T.ShortType(),
    "smallint": T.IntegerType(),
    "mediumint": T.IntegerType(),
    "int": T.LongType(),
    "bigint": T.DecimalType(20, 0),
}

TYPE_POLICIES = ("source", "widen")
_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def stored_type(declared: str, policy: str = "source") -> T.DataType:
    """Spark type for a declared type such as ``varchar``, ``decimal(12,2)`` or ``int unsigned``.

    ``source`` keeps a decimal's own precision; ``widen`` stores every decimal as
    ``decimal(38,18)``, which leaves 20 integer digits.
    """
    if policy not in TYPE_POLICIES:
        raise ValueError(f"type policy must be one of {TYPE_POLICIES}, not {policy!r}")
    name = declared.strip().lower()
    if policy == "source" and (match := _DECIMAL.match(name)):
        return T.DecimalType(int(match[1]), int(match[2]))
    base = re.match(r"\w*", name)[0]
    if "unsigned" in name.split() and base in UNSIGNED_TYPES:
        return UNSIGNED_TYPES[base]
    return DECLARED_TYPES.get(name, DECLARED_TYPES.get(base, T.StringType()))


MONEY = T.DecimalType(29, 2)
TOTAL = T.DecimalType(31, 2)
RATE = T.DecimalType(38, 6)

# The 33 columns of the feature table, in order.
FEATURE_TABLE = T.StructType(
    [
        T.StructField("c_customer_sk", T.IntegerType()),
        T.StructField("c_preferred_cust_flag", T.StringType()),
        T.StructField("hd_demo_sk", T.IntegerType()),
        T.StructField("hd_income_band_sk", T.IntegerType()),
        T.StructField("hd_buy_potential", T.StringType()),
        T.StructField("hd_dep_count", T.IntegerType()),
        T.StructField("hd_vehicle_count", T.IntegerType()),
        T.StructField("cd_gender", T.StringType()),
        T.StructField("cd_marital_status", T.StringType()),
        T.StructField("cd_education_status", T.StringType()),
        T.StructField("cd_credit_rating", T.StringType()),
        T.StructField("ca_city", T.StringType()),
        T.StructField("ca_state", T.StringType()),
        T.StructField("ca_country", T.StringType()),
        T.StructField("ca_location_type", T.StringType()),
        T.StructField("has_catalog_sales", T.LongType()),
        T.StructField("has_web_sales", T.LongType()),
        T.StructField("has_store_sales", T.IntegerType(), nullable=False),
        T.StructField("catalog_sales_amount", MONEY),
        T.StructField("web_sales_amount", MONEY),
        T.StructField("store_sales_amount", MONEY),
        T.StructField("catalog_net_profit", MONEY),
        T.StructField("web_net_profit", MONEY),
        T.StructField("store_net_profit", MONEY),
        T.StructField("catalog_return_amount", MONEY),
        T.StructField("web_return_amount", MONEY),
        T.StructField("store_return_amount", MONEY),
        T.StructField("total_sales_amount", TOTAL),
        T.StructField("total_net_profit", TOTAL),
        T.StructField("total_return_amount", TOTAL),
        T.StructField("active_channels_count", T.LongType()),
        T.StructField("store_transaction_count", T.LongType(), nullable=False),
        T.StructField("return_rate_percentage", RATE),
    ]
)

"""Bring the sales and returns of all channels to one shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.model import (
    RETURNS_CHANNELS,
    SALES_CHANNELS,
    ReturnsChannel,
    SalesChannel,
)
from patronage.operators.lookups import lookup_join


def tag_sales(table: DataFrame, channel: SalesChannel) -> DataFrame:
    """One channel's sales under the common names, tagged with the channel."""
    return table.select(
        F.lit(channel.name).alias("channel"),
        F.col(channel.customer).alias("customer_sk"),
        F.col(channel.date).alias("sale_date"),
        F.col(channel.item).alias("item_sk"),
        F.col(channel.price).alias("price"),
        F.col(channel.profit).alias("profit"),
        F.col(channel.quantity).alias("quantity"),
    )


def tag_returns(table: DataFrame, channel: ReturnsChannel) -> DataFrame:
    """One channel's returns under the common names, tagged with the channel."""
    return table.select(
        F.lit(channel.name).alias("channel"),
        F.col(channel.customer).alias("customer_sk"),
        F.col(channel.amount).alias("return_amount"),
        F.col(channel.quantity).alias("return_quantity"),
    )


def union_sales(
    tables: Mapping[str, DataFrame], channels: Sequence[SalesChannel] = SALES_CHANNELS
) -> DataFrame:
    """All rows of all sales tables (``UNION ALL``)."""
    return reduce(DataFrame.unionByName, [tag_sales(tables[c.table], c) for c in channels])


def union_returns(
    tables: Mapping[str, DataFrame], channels: Sequence[ReturnsChannel] = RETURNS_CHANNELS
) -> DataFrame:
    """All rows of all returns tables (``UNION ALL``)."""
    return reduce(DataFrame.unionByName, [tag_returns(tables[c.table], c) for c in channels])


def ledger(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sales and returns as one table, so that one shuffle on the customer serves both.

    Columns: channel, customer_sk; is_sale with sale_date, item_sk, price, profit, quantity;
    is_return with return_amount, return_quantity. A source that keeps a return on the row
    of its sale may set both flags on that row.
    """
    sold = sales.withColumns({"is_sale": F.lit(True), "is_return": F.lit(False)})
    returned = returns.withColumns({"is_sale": F.lit(False), "is_return": F.lit(True)})
    return sold.unionByName(returned, allowMissingColumns=True)


def drop_undated_store_sales(
    book: DataFrame, date_dim: DataFrame, dates_fit: bool, date_key: str = "d_date_sk"
) -> DataFrame:
    """Unmark store sales whose date is null or unknown; all else stays, returns included.

    The date dimension is only a filter here, so its other columns are not read. The lookup
    key is null on rows that need no check.
    """
    dates = date_dim.select(F.col(date_key).alias("known_date")).distinct()
    checked = F.col("is_sale") & (F.col("channel") == "store")
    keyed = book.withColumn("date_to_check", F.when(checked, F.col("sale_date")))
    found = lookup_join(keyed, dates, "date_to_check", "known_date", "left", fits=dates_fit)
    kept = F.col("is_sale") & ~(checked & F.col("known_date").isNull())
    return found.withColumn("is_sale", kept).drop("date_to_check", "known_date")

"""Per-customer aggregates.

Facts are aggregated by their own customer key before any join: the customer key is unique in
the customer table, so joining afterwards gives the same rows, and map-side partial aggregation
shrinks a hot customer to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import channel_value, null_default, presence_flag, total_of
from patronage.model import CHANNELS, ReturnsChannel, SalesChannel

FANOUT = "decimal(38,2)"
#: A returned amount beyond this does not fit the feature table's money columns.
MOST_RETURNED = "1" + "0" * 27


# One builder per rule; the helpers below and the aggregates of the jobs use the same.


def _kept(value: Column, where: Column | None) -> Column:
    return value if where is None else F.when(where, value)


def total(value: Column, where: Column | None = None) -> Column:
    """``SUM``: nulls are skipped, and a group without any value gives null."""
    return F.sum(_kept(value, where))


def rows(where: Column | None = None) -> Column:
    """``COUNT(*)`` of the rows that meet the condition."""
    return F.count(_kept(F.lit(1), where))


def values(value: Column, where: Column | None = None) -> Column:
    """``COUNT`` of the values that are not null."""
    return F.count(_kept(value, where))


def different(value: Column, where: Column | None = None) -> Column:
    """``COUNT(DISTINCT value)``, exact."""
    return F.countDistinct(_kept(value, where))


def different_days(day: Column, where: Column | None = None) -> Column:
    """``COUNT(DISTINCT day)``, exact, from sets that merge before the shuffle.

    A set holds at most the days of the calendar, however many rows a customer has. Values that
    nothing bounds belong to :func:`different`, which shuffles each by itself.
    """
    return F.size(F.collect_set(_kept(day, where))).cast("bigint")


def has_any(value: Column, where: Column | None = None) -> Column:
    """1 if any row has a value, else 0."""
    return F.max(presence_flag(_kept(value, where)))


def quotient(amount: Column, count: Column) -> Column:
    """An average as one division of exact sums."""
    return amount.cast("double") / count.cast("double")


def sum_by(table: DataFrame, key: str, sums: dict[str, str]) -> DataFrame:
    """``SUM`` per key: nulls are skipped, a group of nulls gives null. ``sums``: alias -> column."""
    return table.groupBy(key).agg(*[total(F.col(column)).alias(alias) for alias, column in sums.items()])


def sum_coalesced_by(table: DataFrame, key: str, sums: dict[str, str]) -> DataFrame:
    """``SUM(COALESCE(x, 0))`` per key: a group of nulls gives zero."""
    types = {field.name: field.dataType for field in table.schema.fields}
    return table.groupBy(key).agg(
        *[
            total(null_default(F.col(column), types[column])).alias(alias)
            for alias, column in sums.items()
        ]
    )


def count_by(table: DataFrame, key: str, alias: str) -> DataFrame:
    """``COUNT(*)`` per key."""
    return table.groupBy(key).agg(rows().alias(alias))


def average_by(table: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """``AVG`` per key over the non-null values."""
    return table.groupBy(key).agg(quotient(total(F.col(value)), values(F.col(value))).alias(alias))


def distinct_by(table: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """``COUNT(DISTINCT value)`` per key, exact."""
    return table.groupBy(key).agg(different(F.col(value)).alias(alias))


def has_any_by(table: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """1 per key if any row has a value, else 0."""
    return table.groupBy(key).agg(has_any(F.col(value)).alias(alias))


def left_join_totals(
    customer: DataFrame, customer_key: str, table: DataFrame, channel: SalesChannel
) -> DataFrame:
    """Every customer with one channel's totals; zero where the customer bought nothing there."""
    name = channel.name
    amount = table.schema[channel.price].dataType
    totals = sum_by(
        table,
        channel.customer,
        {
            f"{name}_sales_amount": channel.price,
            f"{name}_net_profit": channel.profit,
            f"{name}_quantity": channel.quantity,
        },
    )
    joined = customer.join(totals, F.col(customer_key) == F.col(channel.customer), "left")
    measures = [c for c in totals.columns if c != channel.customer]
    return joined.select(
        customer_key,
        *[null_default(F.col(c), totals.schema[c].dataType).alias(c) for c in measures],
    )


def store_totals(
    customer: DataFrame,
    customer_key: str,
    store_sales: DataFrame,
    channel: SalesChannel,
    date_dim: DataFrame,
    dates_fit: bool,
    date_key: str = "d_date_sk",
) -> DataFrame:
    """Totals of known customers over store sales on known dates; both joins are pure filters.

    The customer filter runs after the aggregation, where each customer is one row.
    """
    dates = date_dim.select(F.col(date_key).alias(channel.date)).distinct()
    dated = store_sales.join(F.broadcast(dates) if dates_fit else dates, channel.date, "left_semi")
    totals = (
        dated.where(F.col(channel.customer).isNotNull())
        .groupBy(F.col(channel.customer).alias(customer_key))
        .agg(
            total(F.col(channel.price)).alias("store_sales_amount"),
            total(F.col(channel.profit)).alias("store_net_profit"),
            total(F.col(channel.quantity)).alias("store_quantity"),
            rows().alias("store_transaction_count"),
        )
    )
    return totals.join(customer.select(customer_key), customer_key, "left_semi")


def channel_pivot(sales: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Amount and row count per customer and channel, side by side."""
    return sales.groupBy("customer_sk").agg(*pivoted(F.lit(True), channels))


def pivoted(sale: Column, channels: tuple[str, ...] = CHANNELS) -> list[Column]:
    """Amount and row count of the rows marked as sales, per channel; 0 where there are none."""
    channel, price, one = F.col("channel"), F.col("price"), F.lit(1)
    columns = []
    for name in channels:
        amount = channel_value(channel, name, F.when(sale, price))
        columns.append(total(amount).alias(f"{name}_sales"))
        columns.append(
            total(channel_value(channel, name, F.when(sale, one).otherwise(0))).alias(f"{name}_transactions")
        )
    return columns


def returned_columns(back: Column, channels: tuple[str, ...] = CHANNELS) -> list[Column]:
    """Returned amount and row count of the rows marked as returns, per channel."""
    columns = []
    for name in channels:
        here = back & (F.col("channel") == name)
        columns.append(total(F.col("return_amount"), here).alias(f"{name}_returned"))
        columns.append(rows(here).alias(f"{name}_return_rows"))
    return columns


def return_totals(returns: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Returned amount and row count per customer and channel, side by side."""
    known = returns.where(F.col("customer_sk").isNotNull())
    return known.groupBy("customer_sk").agg(*returned_columns(F.lit(True), channels))


def per_channel_return(name: str) -> Column:
    """A channel's own returned amount, from the columns of :func:`return_totals`."""
    return null_default(F.col(f"{name}_returned"), FANOUT)


def joined_return(name: str, channels: tuple[str, ...] = CHANNELS) -> Column:
    """A channel's returned amount as three joins under one GROUP BY would give it.

    Joining a customer to all three returns tables at once repeats each channel's rows once for
    every pair of rows of the others (an empty channel still leaves one row), so the sum is
    the channel's own sum times the other row counts. The product is taken here; the joined
    rows never exist. The product grows with the cube of a customer's returns: beyond 27 digits
    before the point it does not fit the feature table, and the job fails, ANSI mode or not, with
    the customer's key. ``per_channel`` has no such limit in practice.
    """
    value = per_channel_return(name)
    for other in channels:
        if other != name:
            count = F.greatest(F.coalesce(F.col(f"{other}_return_rows"), F.lit(0)), F.lit(1))
            value = F.try_multiply(value, count.cast("decimal(18,0)")).try_cast(FANOUT)
    reason = f" has joined returns in the {name} channel beyond 27 digits; use the mode per_channel"
    refused = F.raise_error(F.concat(F.lit("customer "), F.col("customer_sk").cast("string"), F.lit(reason)))
    fits = value.isNotNull() & (F.abs(value) < F.lit(MOST_RETURNED).cast("decimal(38,2)"))
    return F.when(fits, value).otherwise(refused.cast(FANOUT))


def returned_amounts(customer: DataFrame, customer_key: str, returns: DataFrame, mode: str) -> DataFrame:
    """Every customer with the returned amount of each channel; ``mode`` as in :func:`return_column`."""
    totals = return_totals(returns)
    joined = customer.join(totals, F.col(customer_key) == F.col("customer_sk"), "left")
    return joined.select(
        customer_key, *[return_column(mode, n).alias(f"{n}_return_amount") for n in CHANNELS]
    )


def return_column(mode: str, name: str) -> Column:
    """``joined``: amounts inflated by the three-way join. ``per_channel``: the true sums."""
    columns = {"joined": joined_return, "per_channel": per_channel_return}
    if mode not in columns:
        raise ValueError(f"returns mode must be one of {sorted(columns)}, not {mode!r}")
    return columns[mode](name)


def analytics_totals(book: DataFrame) -> DataFrame:
    """All per-customer measures of the customer analytics query, from one pass over the ledger."""
    columns = returned_columns(F.col("is_return"))
    for name in CHANNELS:
        sold = F.col("is_sale") & (F.col("channel") == name)
        columns.append(total(F.col("price"), sold).alias(f"{name}_sales_amount"))
        columns.append(total(F.col("profit"), sold).alias(f"{name}_net_profit"))
        if name == "store":
            columns.append(rows(sold).alias("store_transaction_count"))
        else:
            columns.append(has_any(F.col("item_sk"), sold).alias(f"has_{name}_sales"))
    return book.where(F.col("customer_sk").isNotNull()).groupBy("customer_sk").agg(*columns)


def profile_totals(book: DataFrame) -> DataFrame:
    """All per-customer measures of the customer 360 query, from one pass over the ledger.

    One shuffle, by customer: a task sends one row per customer it holds, with the set of the days
    in it, so a customer with very many rows arrives as one row per task. Totals over all channels are
    added up from the channels afterwards instead of being shuffled.
    """
    sale, back = F.col("is_sale"), F.col("is_return")
    columns = [
        values(F.col("price"), sale).alias("priced_transactions"),
        total(F.col("quantity"), sale).alias("total_items_purchased"),
        different_days(F.col("sale_date"), sale).alias("distinct_purchase_days"),
        rows(back).alias("total_returns"),
        total(F.col("return_amount"), back).alias("total_return_amount"),
        total(F.col("return_quantity"), back).alias("total_return_quantity"),
        *pivoted(sale),
    ]
    totals = book.where(F.col("customer_sk").isNotNull()).groupBy("customer_sk").agg(*columns)
    priced = F.col("priced_transactions") > 0
    amount = totals.schema["store_sales"].dataType
    sold = total_of(*[null_default(F.col(f"{name}_sales"), amount) for name in CHANNELS])
    return (
        totals.withColumn(
            "total_transactions", total_of(*[F.col(f"{name}_transactions") for name in CHANNELS])
        )
        .withColumn("total_sales_amount", F.when(priced, sold))
        .withColumn(
            "avg_transaction_value",
            F.when(priced, quotient(F.col("total_sales_amount"), F.col("priced_transactions"))),
        )
        .drop("priced_transactions")
    )


def returns_of(table: DataFrame, channel: ReturnsChannel) -> DataFrame:
    """One channel's ``SUM(COALESCE(amount, 0))`` per customer."""
    return sum_coalesced_by(table, channel.customer, {f"{channel.name}_return_amount": channel.amount})

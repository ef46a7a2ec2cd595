"""Customer analytics: one row per store customer that has all its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions import null_default, return_percentage, total_of
from patronage.model import CHANNELS, FEATURE_TABLE, MONEY
from patronage.operators.aggregates import analytics_totals, return_column
from patronage.operators.channels import drop_undated_store_sales
from patronage.operators.profiles import inner_dims
from patronage.plans.star import Star
from patronage.sources.feature_table import typed_features


def channel_totals(totals: DataFrame, returns_mode: str) -> DataFrame:
    """Measures of the query from the columns of ``analytics_totals``.

    A store amount that is null stays null and makes its total null; the rate is then 0.
    """
    amounts = {}
    for name in CHANNELS:
        for measure in ("sales_amount", "net_profit"):
            value = F.col(f"{name}_{measure}")
            amounts[f"{name}_{measure}"] = value if name == "store" else null_default(value, MONEY)
        amounts[f"{name}_return_amount"] = return_column(returns_mode, name)
    sums = {
        f"total_{measure}": total_of(*[F.col(f"{name}_{measure}") for name in CHANNELS])
        for measure in ("sales_amount", "net_profit", "return_amount")
    }
    one = F.lit(1)
    sums["has_store_sales"] = one
    sums["active_channels_count"] = F.col("has_catalog_sales") + F.col("has_web_sales") + one
    rate = return_percentage(F.col("total_return_amount"), F.col("total_sales_amount"))
    return (
        totals.withColumns(amounts).withColumns(sums).withColumn("return_rate_percentage", rate)
    )


def store_customer_totals(star: Star, returns_mode: str) -> DataFrame:
    """Measures of every customer with a dated store sale, one row each."""
    dates_fit = star.fits("dates")["dates"]
    book = drop_undated_store_sales(star.ledger, star.date_dim, dates_fit)
    totals = analytics_totals(book).where(F.col("store_transaction_count") > 0)
    return channel_totals(totals, returns_mode)


def customer_analytics(star: Star, returns_mode: str, ordered: bool = True) -> DataFrame:
    """The 33 feature columns, largest total sales first.

    ``returns_mode="joined"`` gives returned amounts as the original statement computes them:
    it joins the three returns tables at once, which multiplies each channel's returns by the row
    counts of the others. ``"per_channel"`` gives the amounts really returned. Totals and the
    return rate follow the choice.

    Ties are ordered by customer, so that a total shared by very many customers still spreads
    over the sort's tasks.
    """
    fits = star.fits("household", "demographics", "address", "dates")
    customers = inner_dims(
        star.customer,
        star.household_demographics,
        star.customer_demographics,
        star.customer_address,
        fits,
    )
    totals = store_customer_totals(star, returns_mode)
    joined = customers.join(totals, F.col("c_customer_sk") == F.col("customer_sk"), "inner")
    features = typed_features(joined, FEATURE_TABLE)
    if not ordered:
        return features
    return features.orderBy(F.desc("total_sales_amount"), F.asc("c_customer_sk"))

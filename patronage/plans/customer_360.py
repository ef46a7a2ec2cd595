"""Customer 360: one row per customer with attributes, sales, shares and returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import guarded_ratio, net_amount, null_default
from patronage.model import MONEY
from patronage.operators.aggregates import profile_totals
from patronage.operators.cleaning import (
    add_date,
    drop_any_null,
    drop_columns,
    move_column,
    to_int,
)
from patronage.operators.profiles import dim_profile
from patronage.plans.star import Star

# The 25 customer and dimension columns, in output order.
PROFILE_COLUMNS = (
    "c_customer_sk",
    "c_preferred_cust_flag",
    "c_birth_country",
    "c_birth_year",
    "c_birth_month",
    "c_birth_day",
    "c_salutation",
    "c_first_name",
    "c_last_name",
    "c_email_address",
    "cd_gender",
    "cd_marital_status",
    "cd_education_status",
    "cd_purchase_estimate",
    "cd_credit_rating",
    "dependent_count",
    "dependents_employed",
    "dependents_in_college",
    "hd_buy_potential",
    "household_dependent_count",
    "hd_vehicle_count",
    "income_lower_bound",
    "income_upper_bound",
    "ca_gmt_offset",
    "ca_location_type",
)

# Personal data removed by the cleaning job.
PERSONAL_COLUMNS = (
    "c_email_address",
    "c_birth_country",
    "c_salutation",
    "c_first_name",
    "c_last_name",
)

BIRTH_PARTS = ("c_birth_year", "c_birth_month", "c_birth_day")

# Columns the cleaning job turns into int.
INT_COLUMNS = (
    *BIRTH_PARTS,
    "store_transactions",
    "catalog_transactions",
    "web_transactions",
    "total_return_quantity",
)


def channel_share() -> dict[str, Column]:
    """Each channel's part of the customer's sales, 0..1; 0 where there are no sales."""
    total = F.col("total_sales_amount")
    return {
        f"{name}_sales_pct": guarded_ratio(null_default(F.col(f"{name}_sales"), MONEY), total)
        for name in ("store", "catalog", "web")
    }


def return_rates() -> dict[str, Column]:
    """Returns per sale, by rows and by amount; 0 where there are no sales."""
    returns = null_default(F.col("total_returns"), "bigint")
    returned = null_default(F.col("total_return_amount"), MONEY)
    return {
        "return_rate": guarded_ratio(returns, F.col("total_transactions")),
        "return_amount_rate": guarded_ratio(returned, F.col("total_sales_amount")),
    }


def profile_measures() -> dict[str, Column]:
    """The 17 measures from the columns of ``profile_totals``, in output order."""

    def count(name: str) -> Column:
        return null_default(F.col(name), "bigint")

    return {
        "total_transactions": count("total_transactions"),
        "total_sales_amount": null_default(F.col("total_sales_amount"), MONEY),
        "avg_transaction_value": null_default(F.col("avg_transaction_value"), "double"),
        "total_items_purchased": count("total_items_purchased"),
        "distinct_purchase_days": count("distinct_purchase_days"),
        **channel_share(),
        "store_transactions": count("store_transactions"),
        "catalog_transactions": count("catalog_transactions"),
        "web_transactions": count("web_transactions"),
        "total_returns": count("total_returns"),
        "total_return_amount": null_default(F.col("total_return_amount"), MONEY),
        "total_return_quantity": count("total_return_quantity"),
        **return_rates(),
        "net_sales_amount": net_amount(
            F.col("total_sales_amount"), F.col("total_return_amount"), MONEY
        ).cast(MONEY),
    }


def customer_profiles(star: Star) -> DataFrame:
    """Every customer with its dimension attributes, null where a dimension is missing."""
    profiles = dim_profile(
        star.customer,
        star.customer_demographics,
        star.household_demographics,
        star.income_band,
        star.customer_address,
        star.fits("demographics", "household", "bands", "address"),
    )
    return profiles.select(*PROFILE_COLUMNS)


def customer_360(star: Star) -> DataFrame:
    """All 42 columns for every customer, those without sales included."""
    customers = customer_profiles(star)
    totals = profile_totals(star.ledger)
    joined = customers.join(totals, F.col("c_customer_sk") == F.col("customer_sk"), "left")
    measures = [value.alias(name) for name, value in profile_measures().items()]
    return joined.select(*PROFILE_COLUMNS, *measures)


def clean_customer_360(profiles: DataFrame, keep_gender: bool = True) -> DataFrame:
    """Complete rows only, without personal data, with a birth date in third place.

    Rows are filtered before personal columns go, so a missing e-mail address removes the row.
    The original reordering loses ``cd_gender`` by an off-by-one; ``keep_gender=False``
    reproduces that.
    """
    complete = drop_any_null(profiles)
    anonymous = drop_columns(complete, PERSONAL_COLUMNS)
    dated = add_date(to_int(anonymous, INT_COLUMNS), "birth_date", *BIRTH_PARTS)
    ordered = move_column(drop_columns(dated, BIRTH_PARTS), "birth_date", 2)
    return ordered if keep_gender else drop_columns(ordered, ["cd_gender"])


def customer_360_clean(star: Star, keep_gender: bool = True) -> DataFrame:
    """Customer 360 followed by its cleaning."""
    return clean_customer_360(customer_360(star), keep_gender)


def top_customers(profiles: DataFrame, rows: int = 20) -> DataFrame:
    """The customers with the largest sales, ties by customer."""
    return profiles.orderBy(F.desc("total_sales_amount"), F.asc("c_customer_sk")).limit(rows)

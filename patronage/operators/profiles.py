"""Customer attributes from the dimension tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.lookups import lookup_join


def inner_dims(
    customer: DataFrame,
    household: DataFrame,
    demographics: DataFrame,
    address: DataFrame,
    fits: Mapping[str, bool],
) -> DataFrame:
    """Customers that have all three dimensions, with the attributes customer analytics shows.

    ``fits`` says of ``household``, ``demographics`` and ``address`` whether to broadcast them.
    """
    people = customer.select(
        "c_customer_sk",
        "c_preferred_cust_flag",
        "c_current_hdemo_sk",
        "c_current_cdemo_sk",
        "c_current_addr_sk",
    )
    homes = household.select(
        "hd_demo_sk", "hd_income_band_sk", "hd_buy_potential", "hd_dep_count", "hd_vehicle_count"
    )
    traits = demographics.select(
        "cd_demo_sk", "cd_gender", "cd_marital_status", "cd_education_status", "cd_credit_rating"
    )
    places = address.select("ca_address_sk", "ca_city", "ca_state", "ca_country", "ca_location_type")

    def join(left: DataFrame, dim: DataFrame, left_key: str, key: str, name: str) -> DataFrame:
        return lookup_join(left, dim, left_key, key, "inner", fits[name])

    people = join(people, homes, "c_current_hdemo_sk", "hd_demo_sk", "household")
    people = join(people, traits, "c_current_cdemo_sk", "cd_demo_sk", "demographics")
    people = join(people, places, "c_current_addr_sk", "ca_address_sk", "address")
    return people.drop(
        "c_current_hdemo_sk", "c_current_cdemo_sk", "c_current_addr_sk", "cd_demo_sk", "ca_address_sk"
    )


def dim_profile(
    customer: DataFrame,
    demographics: DataFrame,
    household: DataFrame,
    bands: DataFrame,
    address: DataFrame,
    fits: Mapping[str, bool],
) -> DataFrame:
    """Every customer with all its attributes, null where a dimension is missing.

    Income bands hang off the household, so they are joined to the few households and not to
    the many customers. ``fits`` as in :func:`inner_dims`, with ``bands``.
    """
    traits = demographics.select(
        "cd_demo_sk",
        "cd_gender",
        "cd_marital_status",
        "cd_education_status",
        "cd_purchase_estimate",
        "cd_credit_rating",
        F.col("cd_dep_count").alias("dependent_count"),
        F.col("cd_dep_employed_count").alias("dependents_employed"),
        F.col("cd_dep_college_count").alias("dependents_in_college"),
    )
    incomes = bands.select(
        "ib_income_band_sk",
        F.col("ib_lower_bound").alias("income_lower_bound"),
        F.col("ib_upper_bound").alias("income_upper_bound"),
    )
    homes = household.select(
        "hd_demo_sk",
        "hd_income_band_sk",
        "hd_buy_potential",
        F.col("hd_dep_count").alias("household_dependent_count"),
        "hd_vehicle_count",
    )
    places = address.select("ca_address_sk", "ca_gmt_offset", "ca_location_type")

    def join(left: DataFrame, dim: DataFrame, left_key: str, key: str, name: str) -> DataFrame:
        return lookup_join(left, dim, left_key, key, "left", fits[name])

    homes = join(homes, incomes, "hd_income_band_sk", "ib_income_band_sk", "bands")
    people = join(customer, traits, "c_current_cdemo_sk", "cd_demo_sk", "demographics")
    people = join(people, homes, "c_current_hdemo_sk", "hd_demo_sk", "household")
    return join(people, places, "c_current_addr_sk", "ca_address_sk", "address")

"""Feature step: clean, scale and encode the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from patronage.operators.cleaning import distinct_rows, drop_columns, drop_null_in
from patronage.operators.features import label_encode, numeric_columns, observed_stats, standard_scale

# The column roles of the feature table.
DROPPED = ("hd_demo_sk", "ca_city", "ca_country", "ca_state")
REQUIRED = ("c_preferred_cust_flag",)
ENCODED = (
    "cd_gender",
    "cd_marital_status",
    "cd_education_status",
    "cd_credit_rating",
    "ca_location_type",
    "hd_buy_potential",
)
# Numeric columns that are keys or categories, and so are not scaled.
UNSCALED = (
    "c_customer_sk",
    "hd_income_band_sk",
    "hd_dep_count",
    "hd_vehicle_count",
    "has_catalog_sales",
    "has_web_sales",
    "has_store_sales",
    "active_channels_count",
)


def clean_features(features: DataFrame) -> DataFrame:
    """Feature rows with a known flag, each once, without geography and household key.

    The customer key stays: later parts of the original step use it.
    """
    kept = drop_columns(features, DROPPED)
    return distinct_rows(drop_null_in(kept, REQUIRED))


def feature_step(
    features: DataFrame,
    scratch: str,
    encoded: Sequence[str] = ENCODED,
    unscaled: Sequence[str] = UNSCALED,
) -> DataFrame:
    """Scale every numeric column not in ``unscaled`` and encode the ``encoded`` ones.

    The cleaned rows are written once below ``scratch``, an unused folder that all executors
    share, and the statistics are taken on that write; the labels and the result then each read only
    the columns they need, and none repeats the clean-up. The result reads ``scratch`` too: remove it
    once the result has been written, as :func:`patronage.session.run_folder` does.
    """
    cleaned = clean_features(features)
    scaled = numeric_columns(cleaned, exclude=(*unscaled, *encoded))
    observed, stats = observed_stats(cleaned, scaled)
    observed.write.parquet(f"{scratch}/clean")
    clean = features.sparkSession.read.schema(cleaned.schema).parquet(f"{scratch}/clean")
    return label_encode(standard_scale(clean, scaled, stats()), encoded, scratch, fit_on=clean)

"""The inputs of the customer jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from patronage.model import RETURNS_CHANNELS, SALES_CHANNELS
from patronage.operators.channels import ledger, union_returns, union_sales
from patronage.operators.lookups import BROADCAST_BUDGET, fits_broadcast
from patronage.sources.parquet import read_table

DIMENSIONS = (
    "customer",
    "customer_demographics",
    "household_demographics",
    "income_band",
    "customer_address",
    "date_dim",
)


@dataclass(frozen=True)
class Star:
    """Everything the customer jobs read.

    ``ledger`` holds all sales and returns of all channels, see
    :func:`patronage.operators.channels.ledger`.
    """

    customer: DataFrame
    customer_demographics: DataFrame
    household_demographics: DataFrame
    income_band: DataFrame
    customer_address: DataFrame
    date_dim: DataFrame
    ledger: DataFrame
    #: Bytes up to which a dimension is broadcast.
    broadcast_budget: int = BROADCAST_BUDGET

    _measured: dict[str, bool] = field(default_factory=dict, init=False, repr=False)

    def fits(self, *names: str) -> dict[str, bool]:
        """Which of the named dimensions are small enough to broadcast.

        Each is measured once per star, those asked for together in one job.
        """
        sized = {
            "demographics": self.customer_demographics,
            "household": self.household_demographics,
            "bands": self.income_band,
            "address": self.customer_address,
            "dates": self.date_dim.select("d_date_sk"),
        }
        new = {name: sized[name] for name in names if name not in self._measured}
        if new:
            self._measured.update(fits_broadcast(new, self.broadcast_budget))
        return {name: self._measured[name] for name in names}


FACTS = tuple(channel.table for channel in (*SALES_CHANNELS, *RETURNS_CHANNELS))


def star_from_tables(
    tables: Mapping[str, DataFrame], broadcast_budget: int = BROADCAST_BUDGET
) -> Star:
    """Star over three sales tables, three returns tables and the dimensions."""
    book = ledger(union_sales(tables), union_returns(tables))
    dimensions = {name: tables[name] for name in DIMENSIONS}
    return Star(ledger=book, broadcast_budget=broadcast_budget, **dimensions)


def star_from_parquet(
    spark: SparkSession, base: str, broadcast_budget: int = BROADCAST_BUDGET
) -> Star:
    """Star over tables that :func:`patronage.plans.ingest.ingest` has written."""
    tables = {name: read_table(spark, base, name) for name in (*DIMENSIONS, *FACTS)}
    return star_from_tables(tables, broadcast_budget)
